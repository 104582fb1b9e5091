"""Language identification by interpolated Kneser-Ney character models.

Every language gets a model of order ``ORDER`` over lower-cased letters, with runs of
all other characters as one space. Counts are taken over all learning documents by Spark: tasks
count the n-grams of their texts, and only counts are shuffled. The lower orders are
continuation counts, numbers of distinct characters before an n-gram, as Kneser
and Ney define them; all orders share one discount rule and interpolate with the next.

A model is kept as sorted arrays of n-gram hashes with log-probabilities and log back-off
weights; a text is scored by binary search of its n-gram hashes, all languages at once.
The language with the least cross-entropy per character is chosen; how sure that is comes from
the entropies by a curve fitted on learning documents. A text that the models together do not
predict about as well as the learning documents of its language is rejected; together, so
that a text that changes its language stays.

Where the n-grams of the corpus are more than a task should hold, tasks hold the exact values of the
most frequent ones, and the other n-grams of the texts meet theirs in a join (:class:`Rest`): what a
text gets does not depend on how many n-grams a task holds.
"""

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field, replace
from functools import lru_cache
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlog.llm.learning import fit_logistic, sigmoid
from learnlog.llm.shared import crc_part, filter_texts, map_texts, small_batches
from learnlog.sources.tables import materialize

#: Characters of an n-gram of the highest order; each takes 16 bits of a packed n-gram.
ORDER = 4
#: Probabilities that a broadcast model holds for one order, at most: n-grams times languages.
#: Beyond it the broadcast holds the most frequent n-grams, and texts are judged by way of
#: :class:`Rest`, which holds all. A model alone, without a session, then backs off from the others,
#: with the mass that they have in the totals.
MOST_CELLS = 8_000_000
#: Learning documents of each language that the curve and the limits are fitted on, at most.
CALIBRATION = 500
#: Distinct n-grams that a counting task gathers before it passes them on.
HELD_GRAMS = 1_000_000
UNKNOWN = "und"
#: What equal texts share: their hash, under a name that no column of documents has.
KEY = "__text_key"
SPACE = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters, or marks that letters carry; beyond the planes that
    have any, none is."""
    return np.array([unicodedata.category(chr(i))[0] in "LM" for i in range(0x32400)])


def symbols_of(text: str | None) -> np.ndarray:
    """Lower-cased letters with each run of other characters as one space.

    ``ORDER - 1`` spaces stand before the text and one behind it. A text without a letter has no
    symbols. Letters beyond 16 bits share the private codes, by their remainders.
    """
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4")
    letters = _letters()
    letter = letters[np.minimum(codes, len(letters) - 1)] & (codes < len(letters))
    if not letter.any():
        return np.zeros(0, np.uint64)
    codes = np.where(codes > 0xFFFF, 0xE000 + codes % 0x1900, codes)
    codes = np.concatenate([np.where(letter, codes, SPACE), [SPACE]])
    keep = codes != SPACE
    keep[1:] |= codes[:-1] != SPACE
    front = np.full(ORDER - 1, SPACE, np.uint64)
    return np.concatenate([front, codes[keep].astype(np.uint64)])


def packed_grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The packed n-grams of the highest order of all texts in a row, and how many each has."""
    symbols = [symbols_of(t) for t in texts]
    counts = np.array([max(0, len(s) - ORDER + 1) for s in symbols], np.int64)
    flat = np.concatenate([np.zeros(0, np.uint64), *symbols])
    if not len(flat):
        return flat, counts
    packed = flat.copy()
    for i in range(1, ORDER):
        packed[i:] |= flat[:-i] << np.uint64(16 * i)
    # The first ORDER - 1 symbols of a text are its leading spaces: no n-gram ends there.
    ends = np.ones(len(flat), bool)
    starts = np.cumsum([0, *map(len, symbols)])[:-1][counts > 0]
    for i in range(ORDER - 1):
        ends[starts + i] = False
    return packed[ends], counts


def spread(packed: np.ndarray) -> np.ndarray:
    """A one-to-one hash of packed n-grams that is even over 64 bits."""
    h = packed.astype(np.uint64)
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def count_grams(docs: DataFrame) -> DataFrame:
    """``lang``, ``gram`` (packed) and ``n`` over all whole texts of ``docs``.

    Tasks add up what they read, so the shuffle has a row for each distinct n-gram of
    a task; rows without a language or a letter count nothing.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def rows(lang: str) -> pa.RecordBatch:
            keys, counts = _merged(held.pop(lang))
            arrays = [
                pa.array([lang] * len(keys), pa.string()),
                pa.array(keys.view(np.int64), pa.int64()),
                pa.array(counts, pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["lang", "gram", "n"])

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            texts = batch.column("text")
            for lang in dict.fromkeys(langs):
                own = [texts[i].as_py() for i, other in enumerate(langs) if other == lang]
                grams, _ = packed_grams(own)
                if not len(grams):
                    continue
                parts = held.setdefault(lang, [])
                parts.append(np.unique(grams, return_counts=True))
                if sum(len(k) for k, _ in parts) > HELD_GRAMS:
                    held[lang] = [_merged(parts)]
                    if len(held[lang][0][0]) > HELD_GRAMS // 2:
                        yield rows(lang)
        for lang in list(held):
            yield rows(lang)

    counted = docs.where("lang is not null").select("lang", "text")
    counted = counted.mapInArrow(run, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class SortedHashes:
    """A sorted array of hashes, with the place where each leading bit pattern starts."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        bits = max(1, int(len(hashes)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.starts = np.searchsorted(hashes >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64))
        self.longest = int(np.diff(self.starts).max(initial=0))

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each wanted hash, or -1."""
        found = np.full(len(wanted), -1, np.int64)
        if not len(self.hashes):
            return found
        head = (wanted >> self.shift).astype(np.int64)
        place = self.starts[head]
        rest = np.flatnonzero(place < self.starts[head + 1])
        for _ in range(self.longest):
            at = place[rest]
            seen = self.hashes[at]
            same = seen == wanted[rest]
            found[rest[same]] = at[same]
            more = seen < wanted[rest]
            rest = rest[more]
            place[rest] += 1
            rest = rest[place[rest] < self.starts[head[rest] + 1]]
            if not len(rest):
                break
        return found


@dataclass
class Level:
    """One order: log-probabilities of n-grams, and log back-off weights of contexts, a
    column for each language."""

    grams: SortedHashes
    log_p: np.ndarray
    contexts: SortedHashes
    log_back: np.ndarray


@dataclass
class Rest:
    """All n-grams of a corpus that has more than a broadcast model holds, as tables.

    For each order, from the lowest: ``gram`` with ``shares``, what it has of the total of its
    context, and ``context`` with ``weights``, what is left for the order below; both by the place
    of the language. ``grams`` and ``values`` are the most frequent n-grams of the highest order
    with their exact log-probabilities, a column for each language and one for the mixture.
    """

    shares: list[DataFrame]
    weights: list[DataFrame]
    grams: SortedHashes
    values: np.ndarray


@dataclass
class Model:
    languages: list[str]
    levels: list[Level]  # from the lowest order to the highest
    unseen: np.ndarray  # log-probability of an unseen character, by language
    curve: np.ndarray  # of margin, log length and 1
    expected: np.ndarray  # mean cross-entropy of the mixture, by language of the text
    spread: np.ndarray  # deviation of that cross-entropy for one character
    limit: float  # deviations above the mean from which a text is rejected
    rest: Rest | None = field(default=None, repr=False)  # set if ``levels`` lack n-grams

    def log_p(self, packed: np.ndarray) -> np.ndarray:
        """Log-probability of the last character of each n-gram after the others."""
        return self._level(packed, len(self.levels))

    def _level(self, packed: np.ndarray, order: int) -> np.ndarray:
        if order == 0:
            return np.broadcast_to(self.unseen, (len(packed), len(self.languages)))
        level = self.levels[order - 1]
        mask = np.uint64((1 << (16 * order)) - 1)
        place = level.grams.find(spread(packed & mask))
        made = level.log_p[place]
        missing = np.flatnonzero(place < 0)
        if len(missing):
            rest = packed[missing]
            context = level.contexts.find(spread((rest & mask) >> np.uint64(16)))
            back = np.where((context >= 0)[:, None], level.log_back[context], 0)
            made[missing] = back + self._level(rest, order - 1)
        return made

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character, a column for each language and one for their even
        mixture, and the characters."""
        packed, counts = packed_grams(texts)
        total = np.zeros((len(texts), len(self.languages) + 1))
        some = np.flatnonzero(counts)
        if len(some):
            log_p = self.log_p(packed).astype(np.float64)
            mixture = np.log(np.exp(log_p).mean(axis=1, keepdims=True))
            starts = np.cumsum(counts[some]) - counts[some]
            total[some] = np.add.reduceat(np.concatenate([log_p, mixture], axis=1), starts)
        return -total / np.maximum(counts, 1)[:, None], counts

    def judge(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language (-1 without a letter), its probability, and whether it is rejected."""
        return self.decide(*self.entropies(texts))

    def decide(
        self, entropy: np.ndarray, counts: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As :meth:`judge`, from cross-entropies and numbers of characters."""
        if not self.languages:
            return np.full(len(counts), -1), np.zeros(len(counts)), np.ones(len(counts), bool)
        mixture, entropy = entropy[:, -1], entropy[:, :-1]
        best = entropy.argmin(axis=1)
        sure = sigmoid(_sureness(entropy, counts) @ self.curve[:-1] + self.curve[-1])
        far = (mixture - self.expected[best]) / self.spread[best] * _root(counts)
        none = counts == 0
        return np.where(none, -1, best), np.where(none, 0, sure), none | (far > self.limit)


def _root(counts: np.ndarray) -> np.ndarray:
    """Square root of the characters that count as independent of one another."""
    return np.sqrt(np.minimum(counts, 400))


def _sureness(entropy: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Margin of the best language before the next, alone and with the length."""
    if entropy.shape[1] > 1:
        ordered = np.partition(entropy, 1, axis=1)
        margin = ordered[:, 1] - ordered[:, 0]
    else:
        margin = np.ones(len(entropy))
    return np.column_stack([np.minimum(margin, 3), np.minimum(margin, 3) * np.log1p(counts)])


def _orders(counts: DataFrame) -> list[DataFrame]:
    """The n-grams of each order with the numbers Kneser-Ney counts, lowest order first."""
    levels = [counts]
    for order in range(ORDER - 1, 0, -1):
        mask = (1 << (16 * order)) - 1
        lower = levels[0].withColumn("gram", F.expr(f"gram & {mask}L"))
        levels.insert(0, lower.groupBy("lang", "gram").agg(F.count("*").alias("n")))
    return levels


def _kept(level: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """The ``most`` n-grams of each language, fewer where the last ones tie in number, with
    ``total``: the sum over all n-grams of their context, also those that are left out. And
    whether any is left out."""
    sizes = level.groupBy("lang", "n").agg(F.count("*").alias("grams")).collect()
    least: dict[str, int] = {}
    for lang in {r["lang"] for r in sizes}:
        total = 0
        for n, grams in sorted(((r["n"], r["grams"]) for r in sizes if r["lang"] == lang), reverse=True):
            total += grams
            if total > most:
                least[lang] = n + 1
                break
    context = F.shiftrightunsigned("gram", 16)
    totals = level.groupBy("lang", context.alias("context")).agg(F.sum("n").alias("total"))
    for lang, n in least.items():
        level = level.where((F.col("lang") != lang) | (F.col("n") >= n))
    kept = level.withColumn("context", context).join(totals, ["lang", "context"]).drop("context")
    return kept, bool(least)


def _discount(ones: int, twos: int) -> float:
    return ones / (ones + 2 * twos) if ones and twos else 0.5


def _build(languages: list[str], tables: list[dict], characters: int) -> tuple[list[Level], np.ndarray]:
    """Interpolated levels from, for each order, the kept n-grams and sums of each language.

    What an n-gram that is not kept would have of its context's total goes to the back-off, so
    the probabilities after a context sum to one whatever is kept.
    """
    unseen = np.full(len(languages), -np.log(characters + 1))
    model = Model(languages, [], unseen, np.zeros(3), unseen, unseen, 0.0)
    for order, table in enumerate(tables, 1):
        all_grams = np.unique(np.concatenate([table[lang][0] for lang in languages]))
        all_contexts = np.unique(all_grams >> np.uint64(16))
        lower = np.exp(model._level(all_grams, order - 1).astype(np.float64))
        p = np.array(lower)
        back = np.zeros((len(all_contexts), len(languages)))
        context_of = np.searchsorted(all_contexts, all_grams >> np.uint64(16))
        for column, lang in enumerate(languages):
            grams, n, totals, (ones, twos) = table[lang]
            discount = _discount(ones, twos)
            context = np.searchsorted(all_contexts, grams >> np.uint64(16))
            own = np.maximum(n - discount, 0)
            total = np.ones(len(all_contexts))
            total[context] = totals
            # As the sum of discounts where all n-grams are kept, and 1 where none is.
            weight = (total - np.bincount(context, own, len(all_contexts))) / total
            weight[np.bincount(context, minlength=len(all_contexts)) == 0] = 1.0
            back[:, column] = np.log(weight)
            p[:, column] *= weight[context_of]
            place = np.searchsorted(all_grams, grams)
            p[place, column] += own / total[context]
        sorted_by = np.argsort(spread(all_grams))
        context_by = np.argsort(spread(all_contexts))
        level = Level(
            SortedHashes(spread(all_grams)[sorted_by]),
            np.log(p)[sorted_by].astype(np.float32),
            SortedHashes(spread(all_contexts)[context_by]),
            back[context_by].astype(np.float32),
        )
        model.levels.append(level)
    return model.levels, unseen


def fit(
    docs: DataFrame, modulus: int = 4, held_out: int = 2, calibration: int = CALIBRATION
) -> Model:
    """Learn from ``text`` and ``lang`` of the rows that are not held out.

    Rows with a NULL ``doc_id`` or ``lang`` are not learned from. Counts cover
    all other rows; the curve of sureness and the limit of rejection are fitted on at most
    ``calibration`` documents of each language, those with the smallest hashes of their ids.
    Without any learning document every text is unknown.
    """
    spark = docs.sparkSession
    learned = docs.where((crc_part(modulus) != held_out) & F.col("lang").isNotNull())
    learned = learned.select("doc_id", "lang", "text")
    counts = materialize(count_grams(learned), "grams")
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not languages:
        none = np.zeros(0)
        return Model([], [], none, np.zeros(3), none, none, 0.0)
    most = max(1000, MOST_CELLS // len(languages) ** 2)
    tables, characters, short = [], 1, False
    orders = _orders(counts)
    for level in orders:
        ones = {
            r["lang"]: (r["ones"], r["twos"])
            for r in level.groupBy("lang")
            .agg(
                F.sum((F.col("n") == 1).cast("int")).alias("ones"),
                F.sum((F.col("n") == 2).cast("int")).alias("twos"),
            )
            .collect()
        }
        kept, cut = _kept(level, most)
        rows, short = kept.toArrow(), short or cut
        lang = rows.column("lang").to_pandas().to_numpy()
        gram = rows.column("gram").to_numpy().view(np.uint64)
        n = rows.column("n").to_numpy().astype(np.float64)
        total = rows.column("total").to_numpy().astype(np.float64)
        table = {}
        for name in languages:
            own = np.flatnonzero(lang == name)
            own = own[np.argsort(gram[own])]
            table[name] = (gram[own], n[own], total[own], ones[name])
        if not tables:
            characters = level.select("gram").distinct().count() if cut else len(np.unique(gram))
        tables.append(table)
    levels, unseen = _build(languages, tables, characters)
    flat = np.ones(len(languages))
    model = Model(languages, levels, unseen, np.array([4.0, 1.0, 0.0]), 0 * flat, flat, np.inf)
    if short:
        discounts = [{lang: _discount(*t[lang][3]) for lang in languages} for t in tables]
        model.rest = _rest(model, orders, discounts)
    return _calibrated(model, learned, calibration, spark)


def _mask(order: int) -> int:
    return (1 << (16 * order)) - 1


def _rest(model: Model, orders: list[DataFrame], discounts: list[dict[str, float]]) -> Rest:
    """Tables of all n-grams, from their numbers and the discounts of each order."""
    spark = orders[0].sparkSession
    shares, weights = [], []
    for level, discount in zip(orders, discounts):
        places = [(lang, i, discount[lang]) for i, lang in enumerate(model.languages)]
        places = spark.createDataFrame(places, "lang string, place int, discount double")
        rows = level.join(F.broadcast(places), "lang").select(
            "place",
            "gram",
            F.shiftrightunsigned("gram", 16).alias("context"),
            "n",
            F.expr("greatest(n - discount, 0D) as own"),
        )
        sums = rows.groupBy("place", "context").agg(
            F.sum("n").alias("total"), F.sum("own").alias("kept")
        )
        left = F.expr("map_from_entries(collect_list(struct(place, (total - kept) / total)))")
        held = F.expr("map_from_entries(collect_list(struct(place, own / total)))")
        weights.append(materialize(sums.groupBy("context").agg(left.alias("weights")), "weights"))
        rows = rows.join(sums, ["place", "context"])
        shares.append(materialize(rows.groupBy("gram").agg(held.alias("shares")), "shares"))
    frequent = orders[-1].groupBy("gram").agg(F.sum("n").alias("n"))
    sizes = frequent.groupBy("n").agg(F.count("*").alias("grams")).collect()
    least, room = 1, max(1000, MOST_CELLS // (len(model.languages) + 1))
    for n, grams in sorted(map(tuple, sizes), reverse=True):
        room -= grams
        if room < 0:
            least = n + 1
            break
    rest = Rest(shares, weights, SortedHashes(np.zeros(0, np.uint64)), np.zeros((0, 0)))
    rows = _values(replace(model, rest=rest), frequent.where(F.col("n") >= least)).toArrow()
    hashes = spread(rows.column("gram").to_numpy().view(np.uint64))
    by = np.argsort(hashes)
    values = rows.column("value").combine_chunks().flatten().to_numpy()
    values = values.reshape(len(by), len(model.languages) + 1)[by]
    return replace(rest, grams=SortedHashes(hashes[by]), values=values)


def _values(model: Model, wanted: DataFrame) -> DataFrame:
    """Distinct n-grams of the highest order, seen or not, with their log-probabilities in
    ``value``: an entry for each language and one for the mixture. Orders are joined from the lowest."""
    rest = model.rest
    needed = [wanted.select("gram").distinct()]
    for order in range(ORDER - 1, 0, -1):
        needed.insert(0, needed[0].selectExpr(f"gram & {_mask(order)}L as gram").distinct())
    below = None
    for order, (grams, shares, weights) in enumerate(zip(needed, rest.shares, rest.weights), 1):
        rows = grams.withColumn("context", F.shiftrightunsigned("gram", 16))
        if below is None:
            floor = [float(p) for p in np.exp(model.unseen)]
            rows = rows.withColumn("below", F.array(*map(F.lit, floor)))
        else:
            lower = F.expr(f"gram & {_mask(order - 1)}L")
            rows = rows.withColumn("lower", lower).join(below, "lower")
        rows = rows.join(shares, "gram", "left").join(weights, "context", "left")
        p = F.expr(
            "transform(below, (p, i) -> coalesce(try_element_at(weights, i), 1D) * p"
            " + coalesce(try_element_at(shares, i), 0D))"
        )
        below = rows.select(F.col("gram").alias("lower"), p.alias("below"))
    mixture = "aggregate(below, 0D, (a, p) -> a + p) / size(below)"
    return below.selectExpr(
        "lower as gram", f"transform(concat(below, array({mixture})), p -> ln(p)) as value"
    )


def _text_key():
    return F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias(KEY)


def _text_entropies(docs: DataFrame, model: Model) -> DataFrame:
    """For each distinct text its ``KEY``, the cross-entropies of :meth:`Model.entropies` and the
    characters as ``size``, with all n-grams: tasks add up the values that they hold and pass on
    the other n-grams, which meet their values in a join."""
    width = len(model.languages) + 1
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.rest.grams, model.rest.values))

    def make() -> Callable:
        frequent, values = shared.value

        def compute(texts: list[str | None]) -> list[pa.Array]:
            sizes, sums, others, numbers = [], [], [], []
            for text in texts:
                packed, counts = packed_grams([text])
                grams, n = np.unique(packed, return_counts=True)
                place = frequent.find(spread(grams))
                held = place >= 0
                sizes.append(int(counts[0]))
                sums.append((n[held] @ values[place[held]]).tolist() if held.any() else [0.0] * width)
                others.append(grams[~held].view(np.int64).tolist())
                numbers.append(n[~held].tolist())
            return [
                pa.array(sizes, pa.int64()),
                pa.array(sums, pa.list_(pa.float64())),
                pa.array(others, pa.list_(pa.int64())),
                pa.array(numbers, pa.list_(pa.int64())),
            ]

        return compute

    fields = [
        ("size", pa.int64()), ("sums", pa.list_(pa.float64())),
        ("others", pa.list_(pa.int64())), ("numbers", pa.list_(pa.int64())),
    ]
    texts = map_texts(docs.select(_text_key(), "text"), fields, make, key=KEY)
    texts = materialize(texts, "text-grams")
    # Copies of a text have the same rows: one of them counts.
    whole = texts.groupBy(KEY).agg(F.first("size").alias("size"), F.first("sums").alias("sums"))
    single = texts.select(KEY, F.explode(F.arrays_zip("others", "numbers")).alias("other"))
    single = single.groupBy(KEY, F.col("other.others").alias("gram"))
    single = single.agg(F.first("other.numbers").alias("n"))
    added = single.join(_values(model, single), "gram").groupBy(KEY)
    added = added.agg(F.array(*[F.expr(f"sum(n * value[{i}])") for i in range(width)]).alias("added"))
    entropy = "transform(sums, (s, i) -> -(s + coalesce(added[i], 0D)) / greatest(size, 1))"
    return whole.join(added, KEY, "left").selectExpr(KEY, f"{entropy} as entropy", "size")


def _judged(docs: DataFrame, model: Model) -> DataFrame:
    """The judgement of each distinct text by all n-grams: ``KEY`` and the columns of :func:`identify`."""
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, levels=[], rest=None))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entropy = batch.column("entropy").flatten().to_numpy(zero_copy_only=False)
            entropy = entropy.reshape(batch.num_rows, len(shared.value.languages) + 1)
            sizes = batch.column("size").to_numpy(zero_copy_only=False)
            made = _columns(shared.value, shared.value.decide(entropy, sizes))
            names = [KEY, *(name for name, _ in JUDGED)]
            yield pa.RecordBatch.from_arrays([batch.column(KEY), *made], names=names)

    schema = f"`{KEY}` binary, lang_pred string, score double, rejected boolean"
    return _text_entropies(docs, model).mapInArrow(run, schema)


def _calibrated(model: Model, learned: DataFrame, most: int, spark) -> Model:
    ids = learned.select("doc_id", "lang").withColumn("draw", F.xxhash64("doc_id"))
    chosen = None
    for lang in model.languages:
        own = ids.where(F.col("lang") == lang).orderBy("draw", "doc_id").limit(most)
        chosen = own if chosen is None else chosen.unionByName(own)
    sample = learned.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")
    if model.rest:
        sample = materialize(sample, "calibration")
        rows = sample.select("lang", _text_key()).join(_text_entropies(sample, model), KEY)
        return _fitted(model, rows.where("size > 0").collect())
    shared = spark.sparkContext.broadcast(model)

    def make() -> Callable:
        def compute(texts: list[str | None]) -> list[pa.Array]:
            entropy, counts = shared.value.entropies(texts)
            return [pa.array(entropy.tolist(), pa.list_(pa.float64())), pa.array(counts, pa.int64())]

        return compute

    fields = [("entropy", pa.list_(pa.float64())), ("size", pa.int64())]
    rows = map_texts(sample, fields, make, keep=["lang"])
    return _fitted(model, rows.where("size > 0").collect())


def _fitted(model: Model, rows: list) -> Model:
    """The model with curve, expectations and limit from ``lang``, ``entropy`` and ``size``."""
    if not rows:
        return model
    entropy = np.array([r["entropy"] for r in rows])
    mixture, entropy = entropy[:, -1], entropy[:, :-1]
    counts = np.array([r["size"] for r in rows])
    truth = np.array([model.languages.index(r["lang"]) for r in rows])
    right = (entropy.argmin(axis=1) == truth).astype(float)
    # One right and one wrong case without a margin keep the curve finite.
    x = np.concatenate([_sureness(entropy, counts), np.zeros((2, 2))])
    model.curve = fit_logistic(x, np.concatenate([right, [0, 1]]), np.ones(len(x)), l2=1e-4)
    for i in range(len(model.languages)):
        mine = (truth == i) & (right > 0)
        if mine.any():
            model.expected[i] = mixture[mine].mean()
            away = (mixture[mine] - model.expected[i]) * _root(counts[mine])
            model.spread[i] = max(1e-6, np.sqrt((away**2).mean()))
    far = (mixture - model.expected[truth]) / model.spread[truth] * _root(counts)
    # The learned texts are predicted better than new ones, so the limit lies well beyond theirs.
    model.limit = 2.5 * max(6.0, float(np.quantile(far, 0.999)))
    return model


def _shared(model: Model, docs: DataFrame):
    return docs.sparkSession.sparkContext.broadcast(replace(model, rest=None))


JUDGED = [("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())]


def _columns(model: Model, judgement: tuple) -> list[pa.Array]:
    names = [*model.languages, UNKNOWN]
    best, sure, rejected = judgement
    made = [[names[i] for i in best], sure, rejected]
    return [pa.array(values, kind) for values, (_, kind) in zip(made, JUDGED)]


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (probability that it is right) and ``rejected``.

    NULL texts and texts without a letter are ``und`` with score 0, and rejected. Of languages that
    predict a text equally well the first in order of names is taken. Repeated rows
    stay rows of their own; other columns are not read.
    """
    if model.rest:
        rows = docs.select("doc_id", _text_key()).join(_judged(docs, model), KEY)
        return rows.select("doc_id", *(name for name, _ in JUDGED))
    shared = _shared(model, docs)

    def make() -> Callable:
        def compute(texts: list[str | None]) -> list[pa.Array]:
            return _columns(shared.value, shared.value.judge(texts))

        return compute

    return map_texts(docs, JUDGED, make)


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose texts are not rejected."""
    if model.rest:
        known = _judged(docs, model).where("not rejected").select(KEY)
        return docs.select("*", _text_key()).join(known, KEY, "left_semi").drop(KEY)
    shared = _shared(model, docs)
    return filter_texts(docs, lambda: lambda texts: (~shared.value.judge(texts)[2]).tolist())
