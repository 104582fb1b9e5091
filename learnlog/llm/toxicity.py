"""Toxicity by a lexicon trie that Levenshtein automata walk, and context windows.

The lexicon is learned: words, and beginnings of words, that mark toxic documents among the
learning rows. The trie of its terms and the automata of their edit
distances are walked as one deterministic automaton, made as far as words need it; it reads the
distinct words of a task, all at once, a letter a step. A hit is a word of the lexicon,
something one edit away from a long one or two from a longer one, or a word that begins
as a learned stem does, letter by letter. The words around a hit tell quotation from abuse: quotation
marks, words of reporting, negation and second persons in a window. A logistic model over
sums of hit scores gives the probability of label 1.
"""

import re
from array import array
from collections import Counter, deque
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlog.llm.learning import class_weights, fit_logistic, labelled_sample, sigmoid
from learnlog.llm.shared import ChunkTable, map_texts, small_batches, spans
from learnlog.sources.tables import materialize

#: Labelled documents of each class that lexicon and weights are learned from, at most.
SAMPLE = 20_000
#: States of the automaton that a task keeps between its batches of words.
MOST_STATES = 200_000
#: Toxic learning documents that a term must occur in.
LEAST_DOCUMENTS = 5
#: Times as frequent among toxic learning documents as among others, at least.
LEAST_RATIO = 20.0
#: Letters from which a term may be misspelled by one edit, and by two.
ONE_EDIT, TWO_EDITS = 5, 9
#: Letters of a beginning of a word.
STEMS = range(4, 9)
#: Letters of a longest term.
LONGEST = 24
#: Words on each side of a hit that make its context.
CONTEXT = 6

# Words of reporting and negation, and second persons, in four languages.
REPORTING = frozenset(
    "said says say wrote writes called calls quoted quote word words term insult sagte schrieb "
    "nannte wort dit écrit appelé mot dijo escribió llamó palabra".split()
)
NEGATION = frozenset("not never no nicht nie kein keine pas jamais non nunca ni".split())
SECOND_PERSON = frozenset(
    "you your youre u du dich dein ihr euch tu toi ton vous votre tú te usted vosotros".split()
)
QUOTES = "\"“”„«»‹›"

_NOT_WORD = re.compile(r"[\W_]+")
_QUOTE = re.compile(f"[{QUOTES}]")
_TOKEN = re.compile(rf"[^\W_]+|[{QUOTES}]")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return _NOT_WORD.sub(" ", (text or "").lower()).split()


def edits_allowed(term: str) -> int:
    return (len(term) >= ONE_EDIT) + (len(term) >= TWO_EDITS)


@dataclass
class Lexicon:
    """Words and stems with their evidence, the log of how much more toxic texts use them."""

    words: list[str] = field(default_factory=list)
    stems: list[str] = field(default_factory=list)
    evidence: dict[str, float] = field(default_factory=dict)


class Automaton:
    """The trie of the lexicon, walked by all edit automata at once.

    A state is a set of trie nodes with the edits that reaching each has taken. States and
    transitions are made when a word first needs them and kept in tables, up to
    ``MOST_STATES``; so the lexicon has no bound and each of its words has its automaton.
    """

    def __init__(self, lexicon: Lexicon):
        self.children: list[dict[int, int]] = [{}]
        ends = [(self._insert(word), "word", word) for word in lexicon.words]
        ends += [(self._insert(stem), "stem", stem) for stem in lexicon.stems]
        self.letters = sorted({c for node in self.children for c in node})
        #: By code: kind, term, edits; code 0 is no hit.
        self.hits: list[tuple[str, str, int]] = [("", "", 9)]
        self.word_at: dict[int, tuple[str, int, int]] = {}  # word, edits allowed, its first code
        self.stem_at: dict[int, int] = {}
        for node, kind, term in ends:
            most = edits_allowed(term) if kind == "word" else 0
            if kind == "word":
                self.word_at[node] = (term, most, len(self.hits))
            else:
                self.stem_at[node] = len(self.hits)
            self.hits += [(kind, term, edits) for edits in range(most + 1)]
        # Edits worth following below each node; a child has a larger number than its parent.
        self.most = [0] * len(self.children)
        for node in range(len(self.children) - 1, -1, -1):
            own = self.word_at[node][1] if node in self.word_at else 0
            self.most[node] = max([own, *(self.most[c] for c in self.children[node].values())])
        self._forget()

    def _insert(self, term: str) -> int:
        node = 0
        for letter in map(ord, term):
            if letter not in self.children[node]:
                self.children.append({})
                self.children[node][letter] = len(self.children) - 1
            node = self.children[node][letter]
        return node

    def _forget(self) -> None:
        """Only the dead state 0 and the start 1."""
        self.numbers: dict[bytes, int] = {}
        self.pairs: list[bytes] = []
        self.step = np.full((1024, len(self.letters) + 1), -1, np.int32)
        self.accepts, self.begins = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self._number({})
        self._number({0: 0})

    def _number(self, reached: dict[int, int]) -> int:
        """The state of nodes and edits, with the nodes reached by leaving letters out."""
        queue = deque(reached.items())
        while queue:
            node, edits = queue.popleft()
            for child in self.children[node].values():
                if edits < self.most[child] and edits + 1 < reached.get(child, 99):
                    reached[child] = edits + 1
                    queue.append((child, edits + 1))
        key = array("q", sorted(4 * node + edits for node, edits in reached.items())).tobytes()
        state = self.numbers.get(key)
        if state is None:
            state = self.numbers[key] = len(self.pairs)
            self.pairs.append(key)
            if state == len(self.step):
                self.step = np.concatenate((self.step, np.full_like(self.step, -1)))
                self.accepts = np.concatenate((self.accepts, np.zeros_like(self.accepts)))
                self.begins = np.concatenate((self.begins, np.zeros_like(self.begins)))
            if not reached:
                self.step[state] = 0
            near = [
                (edits, word, code)
                for node, edits in reached.items()
                if node in self.word_at
                for word, most, code in (self.word_at[node],)
                if edits <= most
            ]
            if near:
                edits, _, code = min(near)
                self.accepts[state] = code + edits
            passed = [self.stem_at[n] for n, edits in reached.items() if n in self.stem_at and not edits]
            if passed:
                self.begins[state] = passed[0]
        return state

    def _fill(self, state: int, letter: int) -> None:
        point = self.letters[letter] if letter < len(self.letters) else None
        after: dict[int, int] = {}
        for pair in memoryview(self.pairs[state]).cast("q"):
            node, edits = pair >> 2, pair & 3
            child = self.children[node].get(point)
            moves = [(child, edits)] if child is not None else []
            if edits < self.most[node]:
                moves.append((node, edits + 1))  # a letter too many
                moves += [(c, edits + 1) for c in self.children[node].values() if c != child]
            for to, cost in moves:
                if cost <= self.most[to] and cost < after.get(to, 99):
                    after[to] = cost
        target = self._number(after)
        self.step[state, letter] = target

    def codes(self, words: list[str]) -> list[int]:
        """The hit code of each word: an exact term, else a stem, else a misspelled term."""
        if not self.letters:
            return [0] * len(words)
        if len(self.pairs) > MOST_STATES:
            self._forget()
        width = LONGEST + 3
        flat = "".join([w[:width].ljust(width, "\0") for w in words])
        points = np.frombuffer(flat.encode("utf-32-le"), "<u4").reshape(len(words), width)
        known = np.array(self.letters, np.uint32)
        at = np.minimum(np.searchsorted(known, points), len(known) - 1)
        letters = np.where(known[at] == points, at, len(known))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        state = np.ones(len(words), np.int64)
        stem = np.zeros(len(words), np.int64)
        for i in range(width):
            live = np.flatnonzero((sizes > i) & (state > 0))
            if not len(live):
                break
            now, letter = state[live], letters[live, i]
            missing = self.step[now, letter] < 0
            if missing.any():
                for key in np.unique(now[missing] * (len(known) + 1) + letter[missing]).tolist():
                    self._fill(*divmod(key, len(known) + 1))
            state[live] = self.step[now, letter]
            stem[live] = np.where(stem[live] > 0, stem[live], self.begins[state[live]])
        whole = np.where(sizes <= width, self.accepts[state], 0)
        exact = np.array([edits == 0 for _, _, edits in self.hits])
        return np.where((whole > 0) & (exact[whole] | (stem == 0)), whole, stem).tolist()


def _mine(rows: DataFrame, counts: dict[int, int]) -> Lexicon:
    """Terms by the learning documents of each class that use them."""
    small_batches(rows.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            keys = list(held)
            arrays = [
                pa.array([t for t, _ in keys], pa.string()),
                pa.array([y for _, y in keys], pa.int32()),
                pa.array([held[k] for k in keys], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["term", "label", "n"])

        for batch in batches:
            for label, text in zip(*(batch.column(c).to_pylist() for c in ("label", "text"))):
                words = {w for w in words_of(text) if len(w) <= LONGEST and not w.isdigit()}
                stems = {w[:n] + "*" for w in words for n in STEMS if n < len(w)}
                held.update((term, label) for term in chain(words, stems) if len(term) >= STEMS[0])
            if len(held) > 300_000:
                yield out()
                held.clear()
        yield out()

    found = rows.select("label", "text").mapInArrow(run, "term string, label int, n bigint")
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Lexicon()
    terms = found.groupBy("term").agg(
        *[F.sum(F.when(F.col("label") == y, F.col("n")).otherwise(0)).alias(f"n{y}") for y in (0, 1)]
    )
    ratio = ((F.col("n1") + 0.5) / (sizes[1] + 1.0)) / ((F.col("n0") + 0.5) / (sizes[0] + 1.0))
    terms = terms.where(F.col("n1") >= LEAST_DOCUMENTS).withColumn("ratio", ratio)
    terms = terms.where(F.col("ratio") >= LEAST_RATIO).withColumn("log_ratio", F.log("ratio"))
    best = F.desc(F.col("log_ratio") * F.sqrt("n1"))
    stem = F.endswith("term", F.lit("*"))
    # As many as the bounded sample has.
    words = terms.where(~stem).orderBy(best, "term").collect()
    stems = terms.where(stem).collect()
    lexicon = Lexicon([r["term"] for r in words])
    lexicon.evidence = {r["term"]: r["log_ratio"] for r in words}
    # A stem stands for those that begin with it.
    kept = set()
    for row in sorted(stems, key=lambda r: (len(r["term"]), r["term"])):
        short = row["term"][:-1]
        if not any(short[:n] in kept for n in range(1, len(short))):
            kept.add(short)
            lexicon.stems.append(short)
            lexicon.evidence[row["term"]] = row["log_ratio"]
    return lexicon


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray | None
    constant: float


FEATURES = (
    "abuse", "quoted", "misspelled", "stems", "negated", "addressed", "dense", "share", "evidence",
)


class Reader:
    """Finds hits in texts and reads their contexts."""

    def __init__(self, model: Model):
        automaton, evidence = Automaton(model.lexicon), model.lexicon.evidence
        self.table = ChunkTable(automaton.codes, limit=300_000)
        self.hits = automaton.hits
        self.evidence = [0.0] + [
            evidence[term + "*" * (kind == "stem")] / (1 + edits) for kind, term, edits in self.hits[1:]
        ]

    def marks(self, text: str, words: list[str], codes: np.ndarray) -> list[tuple]:
        """Each hit: code, word, quoted, negated, addressed to someone, among other hits."""
        tokens = words
        if _QUOTE.search(text):
            # The same words, with the marks between them.
            tokens = _TOKEN.findall(text.lower())
            code = self.table.rows.get
            codes = [0 if t in QUOTES else code(t) or 0 for t in tokens]
        found = np.flatnonzero(codes).tolist()
        made = []
        for place, i in enumerate(found):
            before, after = tokens[max(0, i - CONTEXT) : i], tokens[i + 1 : i + 1 + CONTEXT]
            around = {*before, *after}
            marked = any(t in QUOTES for t in before) and any(t in QUOTES for t in after)
            quoted = marked or not REPORTING.isdisjoint(before)
            negated = not NEGATION.isdisjoint(before[-2:])
            near = [j for j in found[max(0, place - 1) : place + 2] if j != i]
            dense = any(abs(j - i) <= CONTEXT for j in near)
            addressed = not SECOND_PERSON.isdisjoint(around)
            made.append((int(codes[i]), tokens[i], quoted, negated, addressed, dense))
        return made

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[str]]]:
        """The features of each text, and its distinct hits in ascending order."""
        words = [words_of(t) for t in texts]
        codes = np.array(self.table.look_up(list(chain.from_iterable(words))), np.int64)
        x, terms = np.zeros((len(texts), len(FEATURES))), [[] for _ in texts]
        for row, (a, b) in enumerate(spans(words)):
            if b == a or not codes[a:b].any():
                continue
            marks = self.marks(texts[row], words[row], codes[a:b])
            terms[row] = sorted({mark[1] for mark in marks})
            for code, _, quoted, negated, addressed, dense in marks:
                kind, _, edits = self.hits[code]
                plain = not quoted and not negated
                x[row] += (
                    plain and kind == "word" and not edits, quoted, edits > 0, kind == "stem",
                    negated, addressed, dense, 1, 0,
                )
                if plain:
                    x[row, -1] = max(x[row, -1], self.evidence[code])
            x[row, 7] = min(1.0, 20 * x[row, 7] / (b - a))
        x[:, :7] = np.log1p(x[:, :7])
        return x, terms


def fit(
    docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0, sample: int = SAMPLE
) -> Model:
    """Learn lexicon and weights from at most ``sample`` documents of each class, chosen by a
    hash of their ids; held-out ids are not used. Without both classes no term is known and
    every score is the share of label 1."""
    chosen, counts = labelled_sample(docs, labels, "toxic", modulus, held_out, sample)
    rows = materialize(chosen.select("doc_id", "label", "text"), "labelled")
    lexicon = _mine(rows, counts)
    model = Model(lexicon, None, (counts.get(1, 0) + 1) / (sum(counts.values()) + 2))
    if not counts.get(0) or not counts.get(1):
        return model
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        reader = Reader(shared.value)
        return lambda texts: [pa.array(reader.read(texts)[0].tolist(), pa.list_(pa.float64()))]

    found = map_texts(rows, [("x", pa.list_(pa.float64()))], make, keep=["label"]).collect()
    found.sort(key=lambda r: (r["doc_id"], r["label"]))
    x = np.array([r["x"] for r in found])
    y = np.array([r["label"] for r in found], int)
    model.weights = fit_logistic(x, y, class_weights(y, counts), l2=1e-3)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` (probability of label 1) and ``terms`` (the distinct hits, as
    they stand in the text, in ascending order).

    NULL and empty texts have no hits and score as texts without any. Repeated rows stay rows of
    their own; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        known = shared.value
        reader = Reader(known)

        def compute(texts: list[str | None]) -> list[pa.Array]:
            x, terms = reader.read(texts)
            if known.weights is None:
                made = np.full(len(texts), known.constant)
            else:
                made = sigmoid(x @ known.weights[:-1] + known.weights[-1])
            return [pa.array(made, pa.float64()), pa.array(terms, pa.list_(pa.string()))]

        return compute

    fields = [("score", pa.float64()), ("terms", pa.list_(pa.string()))]
    return map_texts(docs, fields, make)
