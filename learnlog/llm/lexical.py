"""Ranked lexical search over a length-stratified index.

A term's share of a score depends on its count in the document and on the document's length
normaliser m alone. The index is a table of segments; in a segment documents lie by m, those
with equal m are a stratum, and a term's postings lie by stratum and, inside it, by count.
An impact is so worked out once per (term, stratum, count), not per posting, and the largest
count of each term bounds what any document of a stratum can score. A search visits the
strata of a segment in the order of their bounds and stops where a bound is below the k-th
best score so far.

A task of a scan makes its segments by itself and no text is shuffled. A stratum that holds a
third of all documents is spread over all segments. A segment is written and read by itself, so what
a task holds does not grow with the segments that it makes or visits.
"""

import itertools
import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from learnlog.llm.shared import map_texts, small_batches
from learnlog.sources.tables import materialize

#: Results per query.
TOP = 50
#: Text of a segment, in bytes, and its documents: a task holds one at a time.
SEGMENT_BYTES, SEGMENT_DOCS = 8 << 20, 16_384
#: Distinct (item, term) pairs of the queries that go to the tasks at once, about.
BLOCK_TERMS = 200_000
#: Strata of a segment that are scored before its bounds are looked at again; then four
#: times as many, and so on.
FIRST_STRATA = 8
#: Tasks' results are ranked in this many parts first, then over the parts.
PARTS = 64
#: Bytes of a text that are split into terms at a time.
BLOCK = 1 << 20

# The scale of a weight, and the parts of length and of saturation in a score.
SCALE, LENGTH_SHARE, SATURATION, UNIT = 1000, 50, 20, 1_000_000_000
# A-Z are lower-cased; digits, letters and all beyond ASCII make up terms.
_TERM_BYTES = bytes(
    i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i > 127 else 32
    for i in range(256)
)

_SEGMENT = [
    "ids", "known", "stratum_m", "stratum_ends", "terms", "df", "group_ends", "group_stratum",
    "group_count", "group_posting_ends", "postings",
]
#: How segments are written, a row group for each: Parquet's writer would gather at least 100 rows and its
#: reader hold them together. Dictionaries and statistics would keep whole values, the latter to the file's end.
_STORED = {
    "compression": "zstd",
    "parquet.block.row.count.limit": 1,
    "parquet.enable.dictionary": "false",
    "parquet.column.statistics.enabled": "false",
}


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, repeats included, some megabyte of text at a time."""
    start = 0
    while start < len(text):
        part = text[start : start + BLOCK].translate(_TERM_BYTES)
        start += len(part)
        while start < len(text) and not part.endswith(b" "):  # do not cut a term
            more = text[start : start + 4096].translate(_TERM_BYTES)
            cut = more.find(b" ") + 1 or len(more)
            part += more[:cut]
            start += cut
        yield part.split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def normaliser(n: int, n_docs: int, n_terms: int) -> int:
    return 100 - LENGTH_SHARE + (LENGTH_SHARE * n * n_docs) // n_terms


def impact(count: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (UNIT * count) // (SCALE * count + SATURATION * m)


@dataclass(frozen=True)
class Index:
    """A written index: its folder, the documents with a term, and their terms with repeats."""

    folder: str
    n_docs: int
    n_terms: int

    def segments(self, spark: SparkSession, *columns: str) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/segments").select(*columns)


def _bytes(column: pa.Array) -> list[bytes]:
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def text_lengths(docs: DataFrame) -> DataFrame:
    """``n_terms`` of every text."""

    def make() -> Callable:
        def compute(texts: list[str | None]) -> list[pa.Array]:
            made = [sum(map(len, terms_of((t or "").encode()))) for t in texts]
            return [pa.array(made, pa.int64())]

        return compute

    texts = docs.select(F.lit(0).alias("one"), "text")
    return map_texts(texts, [("n_terms", pa.int64())], make, key="one").select("n_terms")


class _Segment:
    """The documents of a segment while a task reads them."""

    def __init__(self):
        # Numbers in order of arrival; a factory that refers to the index would keep it from being freed.
        self.index = defaultdict(itertools.count().__next__)
        self.ids, self.lengths, self.distinct, self.size = [], [], [], 0
        self.terms, self.counts = [], []

    def add(self, doc_id: int | None, text: bytes) -> None:
        found = Counter()
        for terms in terms_of(text):
            found.update(terms)
        if found:
            self.ids.append(doc_id)
            self.lengths.append(found.total())
            self.distinct.append(len(found))
            self.terms.append(np.fromiter(map(self.index.__getitem__, found), np.int32, len(found)))
            self.counts.append(np.fromiter(found.values(), np.int64, len(found)))
        self.size += len(text)

    def row(self, n_docs: int, n_terms: int) -> pa.RecordBatch:
        """The segment as one row of little-endian arrays."""
        m_of = {n: normaliser(n, n_docs, n_terms) for n in set(self.lengths)}
        m = np.array([m_of[n] for n in self.lengths], np.int64)
        order = np.argsort(m, kind="stable")
        place = np.empty(len(m), np.int64)
        place[order] = np.arange(len(m))
        stratum_m, first = np.unique(m[order], return_index=True)
        stratum_ends = np.append(first[1:], len(m))
        stratum_of = np.repeat(np.arange(len(stratum_m)), np.diff(stratum_ends, prepend=0))

        terms, counts = np.concatenate(self.terms), np.concatenate(self.counts)
        owners = np.repeat(place, self.distinct)
        sort = np.lexsort((owners, counts, stratum_of[owners], terms))
        terms, counts, owners = terms[sort], counts[sort], owners[sort]
        strata = stratum_of[owners]
        new = np.ones(len(terms), bool)
        new[1:] = np.diff(terms).astype(bool) | np.diff(strata).astype(bool) | np.diff(counts).astype(bool)
        starts = np.flatnonzero(new)
        known = np.array([i is not None for i in self.ids], np.uint8)
        ids = np.array([i or 0 for i in self.ids], np.int64)
        columns = {
            "ids": ids[order],
            "known": known[order],
            "stratum_m": stratum_m,
            "stratum_ends": stratum_ends.astype(np.int32),
            "terms": b" ".join(self.index),
            "df": np.bincount(terms, minlength=len(self.index)).astype(np.int32),
            "group_ends": np.bincount(terms[starts], minlength=len(self.index)).cumsum().astype(np.int32),
            "group_stratum": strata[starts].astype(np.int32),
            "group_count": counts[starts].astype(np.int32),
            "group_posting_ends": np.append(starts[1:], len(terms)).astype(np.int32),
            "postings": owners.astype(np.int32),
        }
        arrays = [
            pa.array([v if isinstance(v, bytes) else v.tobytes()], pa.binary())
            for v in (columns[name] for name in _SEGMENT)
        ]
        return pa.RecordBatch.from_arrays(arrays, names=_SEGMENT)


def build(docs: DataFrame, folder: str) -> Index:
    """Write the index of all rows below ``folder``.

    Every row is a document, repeated ids too; NULL and empty texts and those without a term
    are in no count. One pass counts terms, a second writes segments. An empty table makes
    an empty index. Only ``doc_id`` (an integer) and ``text`` are read.
    """
    small_batches(docs.sparkSession)
    totals = text_lengths(docs).where("n_terms > 0").agg(
        F.count("*").alias("docs"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("terms")
    )
    n_docs, n_terms = totals.first()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = _Segment()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), _bytes(batch.column(1))):
                segment.add(doc_id, text)
                if segment.size >= SEGMENT_BYTES or len(segment.ids) >= SEGMENT_DOCS:
                    if segment.ids:
                        yield segment.row(n_docs, n_terms)
                    segment = _Segment()
        if segment.ids:
            yield segment.row(n_docs, n_terms)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    made = rows.mapInArrow(run, ", ".join(f"{name} binary" for name in _SEGMENT))
    made.write.options(**_STORED).parquet(f"{folder}/segments")
    stats = docs.sparkSession.createDataFrame([(n_docs, n_terms)], "n_docs bigint, n_terms bigint")
    stats.coalesce(1).write.parquet(f"{folder}/stats")
    return Index(folder, n_docs, n_terms)


def load(spark: SparkSession, folder: str) -> Index:
    return Index(folder, *spark.read.parquet(f"{folder}/stats").first())


def query_terms(queries: DataFrame, key: str = "item_id") -> DataFrame:
    """``key`` and ``terms``, the distinct ones, of each query; rows that repeat a key are one."""

    def make() -> Callable:
        def compute(texts: list[str | None]) -> list[pa.Array]:
            made = [list({t for part in terms_of((x or "").encode()) for t in part}) for x in texts]
            return [pa.array(made, pa.list_(pa.binary()))]

        return compute

    found = map_texts(queries, [("term", pa.list_(pa.binary()))], make, key=key)
    return found.select(key, F.explode("term").alias("term")).groupBy(key).agg(
        F.collect_set("term").alias("terms")
    )


class _Open:
    """What a segment holds of the terms of some queries: a row of the index, its columns as buffers."""

    def __init__(self, row: dict[str, pa.Buffer], numbers: dict[bytes, int]):
        kinds = {"ids": "<i8", "stratum_m": "<i8", "known": "u1"}
        a = {k: np.frombuffer(v, kinds.get(k, "<i4")) for k, v in row.items() if k != "terms"}
        self.ids, self.unknown = a["ids"], a["known"] == 0
        m = a["stratum_m"]
        self.strata = len(m)
        self.starts = np.append(0, a["stratum_ends"])
        self.terms = {}
        for at, term in enumerate(bytes(row["terms"]).split(b" ")):
            number = numbers.get(term)
            if number is None:
                continue
            first, end = int(a["group_ends"][at - 1]) if at else 0, int(a["group_ends"][at])
            strata = a["group_stratum"][first:end]
            # Once per stratum and count.
            impacts = impact(a["group_count"][first:end].astype(np.int64), m[strata])
            upto = a["group_posting_ends"][first:end]
            start = int(a["group_posting_ends"][first - 1]) if first else 0
            best = np.zeros(self.strata, np.int64)
            best[strata] = impacts  # counts ascend inside a stratum: its last is its largest
            ends = np.zeros(self.strata + 1, np.int64)
            ends[strata + 1] = upto - start
            self.terms[number] = (
                np.maximum.accumulate(ends),
                a["postings"][start : int(upto[-1])],
                np.repeat(impacts, np.diff(upto, prepend=start)),
                best,
            )

    def scored(self, first: int, end: int, terms: list[tuple]) -> tuple[int, np.ndarray]:
        """The first document of a run of strata, and the scores of all of them."""
        low, high = int(self.starts[first]), int(self.starts[end])
        total = np.zeros(high - low, np.int64)
        for w, (ends, postings, impacts, _) in terms:
            a, b = ends[first], ends[end]
            if b > a:
                total[postings[a:b] - low] += w * impacts[a:b]
        return low, total


class Best:
    """The best documents of one query so far: highest score, then smallest id, NULL last."""

    def __init__(self, top: int):
        self.top = top
        self.scores, self.ids, self.unknown = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def least(self) -> int:
        """The score that a document needs; one equal to it may still win by its id."""
        return max(1, int(self.scores[-1])) if len(self.scores) >= self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, unknown: np.ndarray) -> None:
        scores = np.concatenate((self.scores, scores))
        ids, unknown = np.concatenate((self.ids, ids)), np.concatenate((self.unknown, unknown))
        order = np.lexsort((ids, unknown, -scores))[: self.top]
        self.scores, self.ids, self.unknown = scores[order], ids[order], unknown[order]


def _runs(strata: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive strata as (first, end)."""
    strata = np.sort(strata)
    breaks = np.flatnonzero(np.diff(strata) != 1) + 1
    for part in np.split(strata, breaks):
        yield int(part[0]), int(part[-1]) + 1


def visit(segment: _Open, query: list[tuple[int, int]], best: Best) -> int:
    """Add a segment's documents to the best of a query of (term, weight); strata visited."""
    terms = [(w, segment.terms[t]) for t, w in query if w > 0 and t in segment.terms]
    if not terms:
        return 0
    bounds = np.zeros(segment.strata, np.int64)
    for w, (_, _, _, largest) in terms:
        bounds += w * largest
    order = np.argsort(-bounds, kind="stable")
    at, size = 0, FIRST_STRATA
    while at < len(order):
        chosen = order[at : at + size]
        chosen = chosen[bounds[chosen] >= best.least()]
        if not len(chosen):
            break
        at, size = at + len(chosen), 4 * size
        for first, end in _runs(chosen):
            low, total = segment.scored(first, end, terms)
            good = np.flatnonzero(total >= best.least())
            if len(good) > best.top:
                # Ties with the last place stay: ids decide among them.
                kth = np.partition(total[good], -best.top)[-best.top]
                good = good[total[good] >= kth]
            if len(good):
                best.add(total[good], segment.ids[low + good], segment.unknown[low + good])
    return at


def _frequencies(index: Index, spark: SparkSession, numbers) -> dict[int, int]:
    """The documents that hold each term of a block, by the term's number."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = numbers.value
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for terms, df in zip(*(c.to_pylist() for c in batch.columns)):
                df = np.frombuffer(df, "<i4")
                for at, term in enumerate(terms.split(b" ")):
                    number = wanted.get(term)
                    if number is not None:
                        total[number] += df[at]
        found = np.flatnonzero(total)
        arrays = [pa.array(found, pa.int64()), pa.array(total[found], pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["number", "df"])

    rows = index.segments(spark, "terms", "df").mapInArrow(run, "number bigint, df bigint")
    return dict(map(tuple, rows.groupBy("number").agg(F.sum("df").alias("df")).collect()))


def _candidates(index: Index, spark: SparkSession, items: list, key, top: int) -> DataFrame:
    """The best documents of each task for the queries of one block, (key, terms) rows."""
    context = spark.sparkContext
    vocabulary = sorted({t for _, terms in items for t in map(bytes, terms)})
    numbers = {t: i for i, t in enumerate(vocabulary)}
    sent = context.broadcast(numbers)
    weights = {t: weight(index.n_docs, df) for t, df in _frequencies(index, spark, sent).items()}
    plans = context.broadcast(
        [
            [(t, weights[t]) for t in sorted(numbers[bytes(x)] for x in terms) if weights.get(t, 0) > 0]
            for _, terms in items
        ]
    )
    keys = context.broadcast([k for k, _ in items])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in plans.value]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_buffer() for name in _SEGMENT}
                segment = _Open(row, sent.value)
                for query, found in zip(plans.value, best):
                    visit(segment, query, found)
        owners = np.repeat(np.arange(len(best)), [len(b.ids) for b in best])
        names = pa.array(keys.value, kind).take(pa.array(owners, pa.int64()))
        join = lambda parts, dtype: np.concatenate([np.empty(0, dtype), *parts])
        yield pa.RecordBatch.from_arrays(
            [
                names,
                pa.array(join((b.ids for b in best), np.int64), mask=join((b.unknown for b in best), bool)),
                pa.array(join((b.scores for b in best), np.int64)),
            ],
            names=["item", "doc_id", "score"],
        )

    kind = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}[key.simpleString()]
    schema = f"item {key.simpleString()}, doc_id bigint, score bigint"
    return index.segments(spark, *_SEGMENT).mapInArrow(run, schema)


def search(
    spark: SparkSession, index: Index, queries: DataFrame, top: int = TOP, key: str = "item_id"
) -> DataFrame:
    """``key``, ``rank`` (from 1), ``doc_id`` and ``score``: the ``top`` documents of each query.

    Only scores above zero count; equal scores rank by ascending ``doc_id``, NULL last, and
    documents that repeat an id have ranks of their own. A query without a known term has no
    row; rows of ``queries`` that repeat a key, NULL too, are one query. Queries go to the tasks in
    blocks of about ``BLOCK_TERMS`` terms, each a pass over the index; nothing else is broadcast.
    """
    items = materialize(query_terms(queries, key), "query-terms")
    size = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-size // BLOCK_TERMS)
    kind = items.schema[key].dataType
    found = spark.createDataFrame([], f"item {kind.simpleString()}, doc_id bigint, score bigint")
    for block in range(blocks if index.n_docs else 0):
        here = items.where(F.pmod(F.xxhash64(key), F.lit(blocks)) == block).collect()
        made = _candidates(index, spark, [tuple(r) for r in here], kind, top)
        made = made.withColumn("part", F.spark_partition_id() % PARTS)
        found = found.unionByName(materialize(made, "candidates"), allowMissingColumns=True)
    if "part" not in found.columns:
        found = found.withColumn("part", F.lit(0))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for by in (["item", "part"], ["item"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        found = found.withColumn("rank", rank).where(F.col("rank") <= top)
    return found.select(F.col("item").alias(key), "rank", "doc_id", "score")
