"""Line deduplication: a line found in several documents stays in the first of them only.

Every long enough line goes out as a row: the 128-bit hash of its normalised form, the
document and its place there. Distinct documents are counted per hash, hashes over the
threshold are joined back to the lines, and each document gets the places it loses. A line
that a third of all documents share is a skewed join key and an aggregate that is
combined map-side; its documents are never listed.
"""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlog.llm.shared import small_batches
from learnlog.sources.tables import materialize

#: Code points that a key has at least; shorter lines always stay.
LEAST_CHARS = 10
#: Documents that hold a key before it is dropped from all but the first.
THRESHOLD = 2
#: Bytes of a text that are split into lines at a time.
BLOCK = 1 << 20
#: Lines that a task sends at a time.
ROWS = 50_000

# The white space that a key loses at its ends, and lower case for A-Z.
EDGES = b" \t\n\x0b\x0c\r"
_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))


def blocks_of(text: bytes) -> Iterator[list[bytes]]:
    """The lines of a text, some megabyte of them at a time; an empty text is one line."""
    start = 0
    while True:
        end = text.rfind(b"\n", start, start + BLOCK)
        if end < 0:
            end = text.find(b"\n", start + BLOCK)
        if end < 0 or len(text) - start <= BLOCK:
            yield text[start:].split(b"\n")
            return
        yield text[start:end].split(b"\n")
        start = end + 1


def key_of(line: bytes, least: int) -> bytes | None:
    """The normalised line, None if it has fewer than ``least`` code points."""
    key = line.translate(_LOWER).strip(EDGES)
    if len(key) < least or (len(key) < 4 * least and len(key.decode("utf-8", "replace")) < least):
        return None
    return key


def _binary(column: pa.Array) -> list[bytes]:
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row per long enough line: ``doc_id``, ``text_key`` (a hash of the whole text),
    ``hi`` and ``lo`` (the hash of the normalised line) and ``place`` (its number from 0)."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest

        def made(batch: pa.RecordBatch, owners: list, digests: list, places: list) -> pa.RecordBatch:
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            taken = pa.array(owners, pa.int64())
            arrays = [batch.column(i).take(taken) for i in (0, 1)]
            arrays += [pa.array(halves[:, i].copy()) for i in (0, 1)]
            arrays.append(pa.array(places, pa.int32()))
            return pa.RecordBatch.from_arrays(
                arrays, names=["doc_id", "text_key", "hi", "lo", "place"]
            )

        for batch in batches:
            owners, digests, places = [], [], []
            for owner, text in enumerate(_binary(batch.column(2))):
                first = 0
                for block in blocks_of(text):
                    for place, line in enumerate(block, first):
                        key = key_of(line, least_chars)
                        if key is not None:
                            owners.append(owner)
                            digests.append(digest(key))
                            places.append(place)
                    first += len(block)
                    if len(owners) >= ROWS:
                        yield made(batch, owners, digests, places)
                        owners, digests, places = [], [], []
            yield made(batch, owners, digests, places)

    schema = f"doc_id {kind}, text_key bigint, hi bigint, lo bigint, place int"
    return rows.mapInArrow(run, schema)


def shared(found: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``hi``, ``lo``, ``keeper``: the hashes that ``threshold`` distinct documents hold, and
    the smallest ``doc_id`` among those. All rows with a NULL id count as one document."""
    holders = found.select("hi", "lo", "doc_id").distinct()
    counted = holders.groupBy("hi", "lo").agg(
        F.count("*").alias("documents"), F.min("doc_id").alias("keeper")
    )
    return counted.where(F.col("documents") >= threshold).drop("documents")


def _without() -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def kept(text: bytes, places: set) -> tuple[int, bytes]:
        first, stay = 0, []
        for block in blocks_of(text):
            stay += [line for place, line in enumerate(block, first) if place not in places]
            first += len(block)
        return first, b"\n".join(stay)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, texts = [], [], []
            for text, places in zip(_binary(batch.column(1)), batch.column(2).to_pylist()):
                if places:
                    n, text = kept(text, set(places))
                else:
                    n = text.count(b"\n") + 1
                n_lines.append(n)
                n_dropped.append(len(places or ()))
                texts.append(text)
            arrays = [
                batch.column(0),
                pa.array(n_lines, pa.int64()),
                pa.array(n_dropped, pa.int64()),
                pa.array(texts, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(
                arrays, names=["doc_id", "n_lines", "n_dropped", "kept"]
            )

    return run


def drop_lines(
    docs: DataFrame, threshold: int = THRESHOLD, least_chars: int = LEAST_CHARS
) -> DataFrame:
    """``doc_id``, ``n_lines`` (before dropping), ``n_dropped`` and ``kept``, the text of the
    lines that stay, of every row.

    A NULL or empty text is one empty line. A line whose key has ``least_chars`` code points
    and occurs in ``threshold`` documents stays only in the one with the smallest
    ``doc_id``, there at all its places. Rows that repeat an id are one document, each with a
    result of its own; rows with a NULL id are together one document after all others. A text
    that loses all its lines is empty. An empty table gives no rows. Only ``doc_id`` and
    ``text`` are read.
    """
    found = materialize(lines(docs, least_chars), "lines")
    common = materialize(shared(found, threshold), "shared-lines")
    # A set: rows that repeat a whole document name the same places.
    lost = (
        found.join(common, ["hi", "lo"])
        .where("not (doc_id <=> keeper)")
        .groupBy(F.col("doc_id").alias("id"), "text_key")
        .agg(F.collect_set("place").alias("places"))
    )
    texts = docs.select("doc_id", "text")
    same = texts["doc_id"].eqNullSafe(lost["id"]) & (F.xxhash64(texts["text"]) == lost["text_key"])
    rows = texts.join(lost, same, "left").select("doc_id", "text", "places")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_lines bigint, n_dropped bigint, kept string"
    return rows.mapInArrow(_without(), schema)
