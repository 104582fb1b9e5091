"""Document quality by a linear-chain conditional random field over lines.

Every line gets a label, good or bad, from its own features, those of the lines
before and after it, and the label of the line before. Forward-backward
marginals of the lines, weighted by their lengths, make a share of good text, which a
logistic curve turns into the probability of label 1.

Labels stand at documents: a first fit without a chain takes all lines of a document to
have its label; then lines of bad documents that this fit finds good count as good, unless
that leaves the document no bad line; the field learns from these.
"""

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from learnlog.llm.learning import class_weights, fit_logistic, labelled_sample, sigmoid
from learnlog.llm.shared import filter_texts, map_texts, small_batches

#: Labelled documents of each class that the field is fitted on, at most.
SAMPLE = 2_000
STEPS = 120

_UPPER = bytes(range(65, 91))
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_DIGITS = bytes(range(48, 58))
_MARKS = b".,;:!?'\"()-"
_SYMBOLS = bytes(
    i for i in range(33, 127) if not chr(i).isalnum() and i not in _MARKS
)
FEATURES = (
    "letters", "capitals", "digits", "symbols", "exclamation", "bars", "twice", "repeats",
    "word_length", "length", "seen",
)


def lines_of(text: str | None) -> list[str]:
    """The lines with a character other than white space; a text without any is one empty line."""
    return [line for line in (text or "").split("\n") if line and not line.isspace()] or [""]


def line_features(lines: list[str]) -> np.ndarray:
    """One row per line; all but the length are shares from 0 to 1."""
    rows, seen = [], set()
    for line in lines:
        raw = line.encode()
        n = len(raw) or 1
        letters = n - len(raw.translate(None, _LETTERS)) if raw else 0
        words = line.lower().split()
        w = len(words) or 1
        rows.append((
            letters / n,
            (len(raw) - len(raw.translate(None, _UPPER))) / (letters or 1),
            (len(raw) - len(raw.translate(None, _DIGITS))) / n,
            (len(raw) - len(raw.translate(None, _SYMBOLS))) / n,
            raw.count(b"!") / w,
            raw.count(b"|") / w,
            sum(map(eq, words, words[1:])) / w,
            1 - len(set(words)) / w,
            min(n / w, 40) / 40,
            min(len(raw), 2000) ** 0.5 / 45,
            line in seen,
        ))
        seen.add(line)
    return np.array(rows, float)


def with_neighbours(x: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the lines before and after it, zeros at the ends."""
    zero = np.zeros((1, x.shape[1]))
    before, after = np.concatenate([zero, x[:-1]]), np.concatenate([x[1:], zero])
    return np.concatenate([x, before, after, np.ones((len(x), 1))], axis=1)


class _Chains:
    """Many chains of lines, worked on together, one line of each at a time."""

    def __init__(self, lengths: list[int]):
        self.order = np.argsort([-n for n in lengths], kind="stable")
        starts = np.cumsum([0, *lengths[:-1]])
        sizes = np.array(lengths)[self.order]
        first = starts[self.order]
        active = [int((sizes > t).sum()) for t in range(int(sizes.max(initial=0)))]
        self.rows = [first[:n] + t for t, n in enumerate(active)]

    def marginals(self, emission: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of label 1 of each line, and the expected counts of label pairs."""
        score = np.stack([np.zeros(len(emission)), emission], axis=1)
        forward, backward = np.array(score), np.zeros_like(score)
        for t in range(1, len(self.rows)):
            now = self.rows[t]
            past = forward[self.rows[t - 1][: len(now)]]
            forward[now] += np.logaddexp(past[:, :1] + chain[0], past[:, 1:] + chain[1])
        pairs = np.zeros((2, 2))
        for t in range(len(self.rows) - 1, 0, -1):
            now = self.rows[t]
            past = self.rows[t - 1][: len(now)]
            ahead = score[now] + backward[now]
            both = forward[past][:, :, None] + chain[None] + ahead[:, None, :]
            both -= both.max(axis=(1, 2), keepdims=True)
            weight = np.exp(both)
            pairs += (weight / weight.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            backward[past] = np.logaddexp(
                chain[:, 0] + ahead[:, :1], chain[:, 1] + ahead[:, 1:]
            )
        total = forward + backward
        return sigmoid(total[:, 1] - total[:, 0]), pairs


@dataclass
class Model:
    """Line weights, label-pair weights (from, to) and the curve of the share of good text.

    Without labels of both classes there are no weights and ``constant`` is every score.
    """

    weights: np.ndarray | None
    chain: np.ndarray | None
    curve: tuple[float, float]
    constant: float


def _fit_field(x: np.ndarray, y: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Adam on the likelihood of the line labels, with a quadratic penalty."""
    chains = _Chains(lengths)
    seen = np.zeros((2, 2))
    for t in range(1, len(chains.rows)):
        now = chains.rows[t]
        np.add.at(seen, (y[chains.rows[t - 1][: len(now)]], y[now]), 1)
    params = np.zeros(x.shape[1] + 4)
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        p, pairs = chains.marginals(x @ params[:-4], params[-4:].reshape(2, 2))
        up = np.concatenate([x.T @ (y - p), (seen - pairs).ravel()]) / len(y) - 1e-3 * params
        mean, square = 0.9 * mean + 0.1 * up, 0.99 * square + 0.01 * up**2
        params = params + 0.15 * (mean / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.99**step)) + 1e-8
        )
    return params[:-4], params[-4:].reshape(2, 2)


def _shares(p: np.ndarray, sizes: np.ndarray, lengths: list[int]) -> np.ndarray:
    """Length-weighted share of good text of each document."""
    starts = np.cumsum([0, *lengths[:-1]])
    return np.add.reduceat(p * sizes, starts) / np.add.reduceat(sizes, starts)


def _logit(share: np.ndarray) -> np.ndarray:
    share = np.clip(share, 1e-3, 1 - 1e-3)
    return np.log(share / (1 - share))


def fit(
    docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, sample: int = SAMPLE
) -> Model:
    """Learn from at most ``sample`` documents of each class, chosen by a hash of their ids.

    Their line features are computed in tasks and fitted here. Held-out ids are not used.
    """
    rows, counts = labelled_sample(docs, labels, "quality", modulus, held_out, sample)
    small_batches(docs.sparkSession)

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [lines_of(t) for t in batch.column("text").to_pylist()]
            x = [line_features(own).astype(np.float32).tobytes() for own in lines]
            sizes = [[len(line) + 1 for line in own] for own in lines]
            arrays = [
                batch.column("label"), pa.array(x, pa.binary()),
                pa.array(sizes, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["label", "x", "sizes"])

    found = (
        rows.select("doc_id", "label", "text")
        .mapInArrow(features, "label int, x binary, sizes array<int>")
        .collect()
    )
    found.sort(key=lambda r: (r["label"], r["x"]))
    y = np.array([r["label"] for r in found], int)
    constant = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    if len(set(y.tolist())) < 2:
        return Model(None, None, (0.0, 0.0), constant)
    lengths = [len(r["sizes"]) for r in found]
    parts = [np.frombuffer(r["x"], np.float32).reshape(-1, len(FEATURES)) for r in found]
    x = np.concatenate([with_neighbours(part.astype(float)) for part in parts])
    sizes = np.concatenate([np.array(r["sizes"], float) for r in found])
    line_y = np.repeat(y, lengths)
    weight = np.repeat(class_weights(y, {0: 1, 1: 1}), lengths) * sizes
    alone = fit_logistic(x[:, :-1], line_y, weight)
    good = sigmoid(x[:, :-1] @ alone[:-1] + alone[-1]) > 0.5
    starts = np.cumsum([0, *lengths[:-1]])
    any_bad = np.repeat(np.add.reduceat((~good).astype(int), starts) > 0, lengths)
    line_y = np.where((line_y == 0) & any_bad & good, 1, line_y)
    weights, chain = _fit_field(x, line_y, lengths)
    p, _ = _Chains(lengths).marginals(x @ weights, chain)
    shares = _logit(_shares(p, sizes, lengths))
    curve = fit_logistic(shares[:, None], y, class_weights(y, counts), l2=1e-4)
    return Model(weights, chain, (float(curve[0]), float(curve[1])), constant)


def scorer(model: Model) -> Callable[[list[str | None]], np.ndarray]:
    def score(texts: list[str | None]) -> np.ndarray:
        if model.weights is None or not texts:
            return np.full(len(texts), model.constant)
        lines = [lines_of(t) for t in texts]
        lengths = [len(own) for own in lines]
        x = np.concatenate([with_neighbours(line_features(own)) for own in lines])
        sizes = np.array([len(line) + 1 for own in lines for line in own], float)
        p, _ = _Chains(lengths).marginals(x @ model.weights, model.chain)
        return sigmoid(_logit(_shares(p, sizes, lengths)) * model.curve[0] + model.curve[1])

    return score


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score``, the probability of label 1, of every whole text.

    NULL and blank texts are one empty line. Repeated rows stay; other columns are not read.
    """

    def make() -> Callable:
        compute = scorer(model)
        return lambda texts: [pa.array(compute(texts), pa.float64())]

    return map_texts(docs, [("score", pa.float64())], make)


def lines(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``good`` (the marginal of every line that is not blank, in order)."""

    def make() -> Callable:
        def compute(texts: list[str | None]) -> list[pa.Array]:
            made = []
            for text in texts:
                x = with_neighbours(line_features(lines_of(text)))
                if model.weights is None:
                    made.append([model.constant] * len(x))
                else:
                    chain = _Chains([len(x)])
                    made.append(chain.marginals(x @ model.weights, model.chain)[0].tolist())
            return [pa.array(made, pa.list_(pa.float64()))]

        return compute

    return map_texts(docs, [("good", pa.list_(pa.float64()))], make)


def keep_good(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that score ``least`` or more."""

    def make() -> Callable:
        compute = scorer(model)
        return lambda texts: (compute(texts) >= least).tolist()

    return filter_texts(docs, make)
