"""Benchmark decontamination by a broadcast hash set of normalized n-grams.

Texts are lower-cased in A-Z and cut into words. The windows of the benchmark,
``n`` consecutive words of an item or a shorter item as a whole, become rows of word
numbers with a sorted array of their hashes. The set is broadcast in blocks of a bounded
number of words. Tasks number the words of their documents, hash the runs that
consist of benchmark words only, look the hashes up, and verify each hit word by word.
"""

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate, chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlog.llm.shared import WORD_PATTERN, filter_texts, map_texts

#: Words in a window.
WINDOW = 10
#: Benchmark words in one broadcast block; each takes about 150 bytes there.
BLOCK_WORDS = 500_000

_LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
_WORD = re.compile(WORD_PATTERN)
# Bytes: A-Z to a-z, all other ASCII that is not a letter or digit to a space. Bytes of
# characters beyond ASCII stay, as those characters belong to words.
_FOLD = bytes(
    i + 32 if 65 <= i <= 90 else i if i >= 128 or chr(i).isalnum() else 32 for i in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


@dataclass
class Windows:
    """Distinct benchmark windows of one length: rows of word numbers in order of their hashes."""

    hashes: np.ndarray
    rows: np.ndarray
    multiplier: int
    item_starts: np.ndarray  # the items of window i are items[item_starts[i]:item_starts[i + 1]]
    items: np.ndarray


def _hashed(columns: Iterable[np.ndarray], multiplier: int) -> np.ndarray:
    total = None
    for column in columns:
        column = column.astype(np.uint64)
        total = column if total is None else total * np.uint64(multiplier) + column
    return total ^ (total >> np.uint64(29))


def _windows(found: dict[tuple[int, ...], set[int]]) -> Windows:
    rows = np.array(list(found), dtype=np.int32)
    multiplier = 0x9E3779B97F4A7C15
    while True:
        hashes = _hashed(rows.T, multiplier)
        if len(np.unique(hashes)) == len(hashes):
            break
        multiplier = (multiplier + 2) % (1 << 64)  # no two windows may share a hash
    order = np.argsort(hashes)
    items = [sorted(s) for s in found.values()]
    lists = [items[i] for i in order]
    starts = np.array([0, *accumulate(map(len, lists))])
    flat = np.fromiter(chain.from_iterable(lists), dtype=np.int64)
    return Windows(hashes[order], rows[order], multiplier, starts, flat)


@dataclass
class Block:
    """The set of one block of the benchmark."""

    numbers: dict[bytes, int]
    windows: dict[int, Windows]
    item_ids: list[str | None]


def build(items: list[tuple[str | None, str | None]], n: int) -> Block:
    numbers: dict[bytes, int] = {}
    found: dict[int, dict[tuple[int, ...], set[int]]] = {}
    for item, (_, text) in enumerate(items):
        ids = [numbers.setdefault(w, len(numbers)) for w in words_of(text)]
        size = min(n, len(ids))
        for i in range(len(ids) - size + 1 if size else 0):
            found.setdefault(size, {}).setdefault(tuple(ids[i : i + size]), set()).add(item)
    windows = {size: _windows(rows) for size, rows in found.items()}
    return Block(numbers, windows, [item_id for item_id, _ in items])


def _scanner(block: Block) -> Callable[[list[str | None]], list[pa.Array]]:
    def compute(texts: list[str | None]) -> list[pa.Array]:
        words = [words_of(t) for t in texts]
        # A None between documents: no window runs over it.
        flat = list(chain.from_iterable((*w, None) for w in words))
        ids = np.fromiter(map(block.numbers.get, flat, repeat(-1)), np.int64, len(flat))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes + 1) - sizes - 1
        unknown = np.concatenate([[0], np.cumsum(ids < 0)])
        edges = np.zeros(len(flat) + 1, np.int64)
        pairs: list[np.ndarray] = []
        for size, known in block.windows.items():
            at = np.flatnonzero(unknown[size:] == unknown[:-size]) if len(flat) >= size else []
            if not len(at):
                continue
            hashes = _hashed((ids[at + j] for j in range(size)), known.multiplier)
            place = np.minimum(np.searchsorted(known.hashes, hashes), len(known.hashes) - 1)
            same = known.hashes[place] == hashes
            at, place = at[same], place[same]
            exact = np.ones(len(at), bool)
            for j in range(size):
                exact &= ids[at + j] == known.rows[place, j]
            at, place = at[exact], place[exact]
            np.add.at(edges, at, 1)
            np.add.at(edges, at + size, -1)
            doc = np.searchsorted(starts, at, side="right") - 1
            for d, p in set(zip(doc.tolist(), place.tolist())):
                own = known.items[known.item_starts[p] : known.item_starts[p + 1]]
                pairs.append(np.stack([np.full(len(own), d), own]))
        hit = np.cumsum(edges)[:-1] > 0
        change = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
        spans: list[list[int]] = [[] for _ in texts]
        for a, b in change.reshape(-1, 2).tolist():
            d = int(np.searchsorted(starts, a, side="right")) - 1
            spans[d] += [a - int(starts[d]), b - int(starts[d])]
        items: list[set[int]] = [set() for _ in texts]
        for d, i in np.concatenate(pairs, axis=1).T.tolist() if pairs else ():
            items[d].add(i)
        names = [
            sorted({block.item_ids[i] for i in s if block.item_ids[i] is not None}) for s in items
        ]
        return [
            pa.array(sizes, pa.int64()),
            pa.array(spans, pa.list_(pa.int64())),
            pa.array([[n.encode() for n in own] for own in names], pa.list_(pa.binary())),
        ]

    return compute


def scan(
    docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Find the benchmark windows in every whole text.

    Returns ``doc_id``, ``n_words``, ``spans`` (array of start and end, in words, of each
    merged run of hit words: ``[s1, e1, s2, e2, ...]``) and ``items`` (the distinct item ids
    with a window in the text, as strings in ascending order). NULL or empty texts
    have no words; an item without words has no windows; a hit of an item without an id
    counts as a hit and names no item. Equal rows of ``docs`` give equal rows. An
    empty benchmark hits nothing. Other columns are not read.

    A benchmark of more than ``block_words`` words is scanned for in several blocks,
    and the hits of the blocks are merged by document: no broadcast grows beyond a block.
    """
    blocks = list(_blocks(benchmark, block_words))
    fields = [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.int64())),
        ("items", pa.list_(pa.binary())),
    ]

    def one(rows: list[tuple]) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(build(rows, n))
        keep = ["text"] if len(blocks) > 1 else []
        return map_texts(docs, fields, lambda: _scanner(shared.value), keep=keep)

    parts = [one(rows) for rows in blocks]
    if len(parts) > 1:
        parts = [_merged([part.withColumn("block", F.lit(b)) for b, part in enumerate(parts)])]
    return parts[0].withColumn("items", F.transform("items", lambda i: i.cast("string")))


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple]]:
    """The benchmark's items, dealt by hash into as many parts as its size asks for."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    most = F.coalesce(F.octet_length("text"), F.lit(0)) / 2 + 1  # a word and a space: two bytes
    total = items.agg(F.sum(most)).first()[0] or 0
    blocks = max(1, int(-(-total // block_words)))
    dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for block in range(blocks):
        yield [tuple(r) for r in items.where(dealt == block).collect()]


def _merged(parts: list[DataFrame]) -> DataFrame:
    """The hits of all blocks by document; equal rows count as one document that repeats."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = rows.withColumn("digest", F.sha2("text", 256)).drop("text")
    flat = rows.groupBy("doc_id", "digest", "n_words").agg(
        F.sum(F.when(F.col("block") == 0, 1).otherwise(0)).alias("times"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(
            F.flatten(
                F.collect_list(
                    F.expr(
                        "transform(sequence(0, size(spans) div 2),"
                        " i -> struct(get(spans, 2 * i) as a, get(spans, 2 * i + 1) as b))"
                    )
                )
            )
        ).alias("runs"),
    )
    # Runs in ascending order; one that starts in or at the end of the last extends it.
    joined = F.expr(
        """aggregate(filter(runs, r -> r.a is not null), cast(array() as array<bigint>), (acc, r) ->
             case when size(acc) > 0 and r.a <= element_at(acc, -1)
                  then concat(slice(acc, 1, size(acc) - 1),
                              array(greatest(element_at(acc, -1), r.b)))
                  else concat(acc, array(r.a, r.b)) end)"""
    )
    rows = flat.select("doc_id", "n_words", joined.alias("spans"), "items", "times")
    return rows.withColumn("time", F.explode(F.sequence(F.lit(1), "times"))).drop("time", "times")


def hit_words(spans: str = "spans"):
    """How many words the spans hold."""
    return F.expr(
        f"aggregate({spans}, struct(-1L as sign, 0L as total), (a, x) -> "
        "struct(-a.sign as sign, a.total + a.sign * x as total)).total"
    )


def remove_documents(
    docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose texts hold no benchmark window."""
    for rows in _blocks(benchmark, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(build(rows, n))

        def make(shared=shared):
            compute = _scanner(shared.value)
            return lambda texts: [not len(s) for s in compute(texts)[1]]

        docs = filter_texts(docs, make)
    return docs


def remove_spans(text: str, spans: list[int]) -> str:
    """``text`` without the words of ``spans`` and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
    kept, at = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        kept.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return "".join([*kept, text[at:]])
