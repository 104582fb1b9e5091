"""Fill-in-middle: texts cut at two line ends and put together in another order.

The line ends of a text are a set of code point offsets in Roaring style: values are grouped
by their high 16 bits, and a group lies in the smallest of three containers, a sorted array, a
bitmap or a list of runs. Cumulative cardinalities tell the container that holds the k-th
value; a select inside it gives the value, hence the offset after the k-th line.
"""

import hashlib
from bisect import bisect_right
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlog.llm.shared import map_texts

#: Marks before the prefix, the suffix and the middle.
MARKERS = ("<P>", "<S>", "<M>")
#: Texts in a hundred that are transformed, and transformed ones that put the suffix first.
RATE, SUFFIX_FIRST = 100, 50
#: What the draws of a document are hashed with.
SALT = "7"

_CHUNK = 1 << 16  # values of a container


class ArrayContainer:
    """Sorted 16-bit values."""

    def __init__(self, values: np.ndarray):
        self.values = values.astype(np.uint16)

    def select(self, rank: int) -> int:
        return int(self.values[rank])


class BitmapContainer:
    """65 536 bits, with the ones before each word."""

    def __init__(self, values: np.ndarray):
        bits = np.zeros(_CHUNK, np.uint8)
        bits[values] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.upto = np.bitwise_count(self.words).cumsum(dtype=np.int64)

    def select(self, rank: int) -> int:
        word = int(np.searchsorted(self.upto, rank, side="right"))
        before = int(self.upto[word - 1]) if word else 0
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[rank - before])


class RunContainer:
    """Starts of runs of consecutive values, with the values up to the end of each."""

    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        self.starts = starts.astype(np.uint16)
        self.upto = lengths.cumsum(dtype=np.int64)

    def select(self, rank: int) -> int:
        run = int(np.searchsorted(self.upto, rank, side="right"))
        before = int(self.upto[run - 1]) if run else 0
        return int(self.starts[run]) + rank - before


def container(values: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container of sorted distinct values below 65 536."""
    breaks = np.flatnonzero(np.diff(values) != 1) + 1
    sizes = {"array": 2 * len(values), "bitmap": _CHUNK // 8, "runs": 4 * (len(breaks) + 1)}
    kind = min(sizes, key=sizes.get)
    if kind == "array":
        return ArrayContainer(values)
    if kind == "bitmap":
        return BitmapContainer(values)
    starts = np.concatenate(([0], breaks))
    return RunContainer(values[starts], np.diff(np.concatenate((starts, [len(values)]))))


class BoundarySet:
    """Ascending integers: their containers, high parts and cumulative cardinalities."""

    def __init__(self):
        self.high, self.containers, self.upto = [], [], []

    def __len__(self) -> int:
        return self.upto[-1] if self.upto else 0

    def append(self, high: int, values: np.ndarray) -> None:
        """Values with a larger high part than all before, given by their low 16 bits."""
        if len(values):
            self.upto.append(len(self) + len(values))
            self.high.append(high)
            self.containers.append(container(values))

    def select(self, rank: int) -> int:
        """The value with ``rank`` smaller ones in the set."""
        if not 0 <= rank < len(self):
            raise IndexError(rank)
        at = bisect_right(self.upto, rank)
        before = self.upto[at - 1] if at else 0
        return self.high[at] * _CHUNK + self.containers[at].select(rank - before)


def line_ends(text: str) -> BoundarySet:
    """The offsets of the last code point of each line."""
    found = BoundarySet()
    for high in range(-(-len(text) // _CHUNK)):
        part = text[high * _CHUNK : (high + 1) * _CHUNK]
        values = np.flatnonzero(np.frombuffer(part.encode("utf-32-le"), "<u4") == 10)
        last = (high + 1) * _CHUNK >= len(text)
        if last and not part.endswith("\n"):
            values = np.append(values, len(part) - 1)
        found.append(high, values)
    return found


def draws(doc_id: int | None, salt: str) -> tuple[int, ...]:
    """Four numbers below 2^32; a NULL id is hashed as an empty string."""
    name = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{salt}:{name}".encode()).hexdigest()
    return tuple(int(digest[8 * i : 8 * i + 8], 16) for i in range(4))


def transform(
    docs: DataFrame,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
    markers: tuple[str, str, str] = MARKERS,
    salt: str = SALT,
) -> DataFrame:
    """``doc_id``, ``n`` (lines), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Two draws of the document choose the cuts among the line ends and the start, a third
    whether the text is transformed at all (``rate`` in a hundred), a fourth whether the
    form is ``spm`` (``suffix_first`` in a hundred) or ``psm``. NULL and empty texts and
    those that hold a marker are ``plain``: the output is the text, without lengths.
    Equal ids with equal texts have equal results; every row has one. An empty table gives
    none. Only ``doc_id`` (an integer) and ``text`` are read.
    """
    p, s, m = markers

    def made(text: str, doc_id: int | None) -> tuple:
        ends = line_ends(text)
        n = len(ends)
        h = draws(doc_id, salt)
        if not n or h[2] % 100 >= rate or any(mark in text for mark in markers):
            return n, "plain", None, None, text
        cuts = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        a, b = (ends.select(k - 1) + 1 if k else 0 for k in cuts)
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h[3] % 100 < suffix_first:
            return n, "spm", a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
        return n, "psm", a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"

    def make() -> Callable:
        def compute(texts: list[str | None], doc_ids: list[int | None]) -> list[pa.Array]:
            rows = [made(t or "", i) for t, i in zip(texts, doc_ids)]
            columns = list(zip(*rows)) or [()] * len(fields)
            return [pa.array(c, kind) for c, (_, kind) in zip(columns, fields)]

        return compute

    fields = [
        ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()), ("output", pa.string()),
    ]
    return map_texts(docs, fields, make, with_keys=True)


def restored(
    output: str = "output", form: str = "form", markers: tuple[str, str, str] = MARKERS
) -> Column:
    """The text that an output was made of. A transformed text holds no marker, so the first
    of each kind after the leading one is where two parts meet."""
    p, s, m = markers

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        whole = F.substr(output, F.lit(len(first) + 1))
        one = F.substring_index(whole, second, 1)
        rest = F.substr(whole, F.char_length(one) + len(second) + 1)
        two = F.substring_index(rest, m, 1)
        return one, two, F.substr(rest, F.char_length(two) + len(m) + 1)

    prefix, suffix, middle = parts(p, s)
    suffix2, prefix2, middle2 = parts(s, p)
    return (
        F.when(F.col(form) == "psm", F.concat(prefix, middle, suffix))
        .when(F.col(form) == "spm", F.concat(prefix2, middle2, suffix2))
        .otherwise(F.col(output))
    )
