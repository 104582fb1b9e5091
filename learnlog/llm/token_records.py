"""Token ids as length-delimited binary records, with an offset index.

A record is

    length    unsigned 64-bit, of the payload
    masked checksum of the 8 length bytes, unsigned 32-bit
    payload   one byte of flags (1: the document id is NULL; 2: ids take 4 bytes, not 2),
              the document id, signed 64-bit, then the ids, unsigned
    masked checksum of the payload, unsigned 32-bit
    one line feed

all little-endian. The checksum is CRC-32, rotated right by 15 bits plus a
constant, so that a checksum stored in checked data stays harmless. Spark's own
text writer lays the records down (the line feed is its separator), so any file
system Spark reaches will do and a lost task leaves no part behind.
"""

import os
import struct
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from learnlog.llm.shared import ChunkTable, map_texts, small_batches

#: Bytes of text that go into one file of records.
SHARD_BYTES = 32 << 20
#: Chunks that a worker keeps, some 200 bytes each.
KEPT_CHUNKS = 400_000
#: Bytes of text whose distinct chunks are looked up at a time.
SLICE_BYTES = 4 << 20

# The mask of the checksums.
ROTATION, ADDED = 15, 0xA282EAD8

_LENGTH, _CHECK, _HEAD = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<Bq")
_FRAME = _LENGTH.size + 2 * _CHECK.size + 1


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> ROTATION | crc << (32 - ROTATION)) + ADDED) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    """A whole record but for the line feed, which the writer adds."""
    length = _LENGTH.pack(len(payload))
    checks = _CHECK.pack(masked(length)), _CHECK.pack(masked(payload))
    return b"".join((length, checks[0], payload, checks[1]))


def records(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and payload of each record; a damaged file is a ValueError."""
    at = 0
    while at < len(content):
        head = content[at : at + _LENGTH.size]
        start = at + _LENGTH.size + _CHECK.size
        if len(head) < _LENGTH.size or content[start - 4 : start] != _CHECK.pack(masked(head)):
            raise ValueError(f"record at byte {at}: the length is damaged")
        size = _LENGTH.unpack(head)[0]
        payload = content[start : start + size]
        if content[start + size : start + size + 5] != _CHECK.pack(masked(payload)) + b"\n":
            raise ValueError(f"record at byte {at}: the payload is damaged")
        yield at, size + _FRAME, payload
        at += size + _FRAME


def packed(doc_id: int | None, wide: int, ids: bytes) -> bytes:
    return _HEAD.pack(wide | (doc_id is None), doc_id or 0) + ids


def unpacked(payload: bytes) -> tuple[int | None, bytes]:
    """The document id and the ids as little-endian unsigned 32-bit integers."""
    flags, doc_id = _HEAD.unpack_from(payload)
    ids = payload[_HEAD.size :]
    if not flags & 2:
        ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
    return None if flags & 1 else doc_id, ids


def folded(text: str) -> str:
    """The text with the pieces that no token crosses apart at spaces.

    Spaces and line feeds only divide: the tokenizer drops them. Latin-1 texts,
    which Unicode normalization leaves alone, are also lower-cased as the
    tokenizer does: fewer distinct chunks.
    """
    try:
        text.encode("latin-1")
        text = text.lower()
    except UnicodeEncodeError:
        pass
    return text.replace("\n", " ")


def chunks_of(text: str) -> list[str]:
    return folded(text).split(" ")


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallel part
    return Tokenizer.from_file(path)


class _Table(ChunkTable):
    """Chunk to ids as bytes, by the library.

    A chunk of lower-case Latin-1 letters, with or without a full stop or comma at its
    end, is one or two of the tokenizer's words; its letters go to the library's
    merge model directly, spelled as bytes. All other chunks pass the whole library.
    """

    def __init__(self, tokenizer, code: str):
        super().__init__(self._encode, limit=KEPT_CHUNKS)
        self.tokenizer, self.code = tokenizer, code
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(i) for i in range(256) if chr(i).isalpha()]
        self.spelled = str.maketrans({c: spell.pre_tokenize_str(c)[0][0] for c in letters})
        self.ends = {c: self._whole([c])[0] for c in ".,"} | {"": b""}

    def _whole(self, chunks: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def _encode(self, chunks: list[str]) -> list[bytes]:
        made, rest = {}, []
        tokenize = self.tokenizer.model.tokenize
        for chunk in chunks:
            end = chunk[-1:] if chunk[-1:] in (".", ",") else ""
            word = chunk[:-1] if end else chunk
            if word.isalpha() and word.islower() and (word.isascii() or max(word) < "\u0100"):
                ids = self.rows.get(word) or made.get(word)
                if ids is None:
                    tokens = tokenize(word if word.isascii() else word.translate(self.spelled))
                    ids = array(self.code, [t.id for t in tokens]).tobytes()
                made[chunk] = ids + self.ends[end]
            else:
                rest.append(chunk)
        made.update(zip(rest, self._whole(rest)))
        return [made[c] for c in chunks]


# Texts with all sorts of borders between words, and the second all Latin-1.
_PROBES = (
    "Of it, THE  end.\nÀ l'été, won't é ́x 12.5, a.b ... x!, (y). ǅz.\tq,\r\n ß. 中文 ok",
    "Of it, THE  end.\nÀ l'été, won't 12.5, a.b ... x!, (y). z.\tq,\r\n ßÿ. dû, ª",
)


@lru_cache(maxsize=2)
def _table(path: str, code: str) -> ChunkTable | None:
    """The table of this worker; None if a text's ids are not those of its chunks."""
    tokenizer = _tokenizer(path)
    table = _Table(tokenizer, code)
    for probe in _PROBES:
        whole = array(code, tokenizer.encode(probe, add_special_tokens=False).ids).tobytes()
        if b"".join(table.look_up(chunks_of(probe))) != whole:
            return None
    return table


def _wide(path: str, end_id: int) -> bool:
    """Whether an id may need more than 2 bytes."""
    return max(_tokenizer(path).get_vocab_size(), end_id + 1) > 1 << 16


def _encoder(path: str, end_id: int) -> Callable[[list[str | None]], list[bytes]]:
    """Texts to their ids with the end id, 2 or 4 bytes each."""
    tokenizer = _tokenizer(path)
    code = "I" if _wide(path, end_id) else "H"
    table, end = _table(path, code), array(code, [end_id]).tobytes()

    def by_chunk(texts: list[str | None]) -> list[bytes]:
        # Split, find the distinct chunks and put their ids back by position, all outside Python.
        split = pc.split_pattern(pa.array([folded(t or "") for t in texts], pa.string()), " ")
        chunks = split.flatten().dictionary_encode()
        made = pa.array(table.look_up(chunks.dictionary.to_pylist()), pa.binary())
        placed = made.take(chunks.indices)
        _, offsets, data = placed.buffers()
        ends = np.frombuffer(offsets, np.int32)[split.offsets.to_numpy()].tolist()
        ids = data.to_pybytes() if data else b""
        del split, chunks, made, placed, offsets, data
        pa.default_memory_pool().release_unused()  # else a worker holds the most it ever used
        return [ids[a:b] + end for a, b in zip(ends, ends[1:])]

    def whole(texts: list[str | None]) -> list[bytes]:
        found = tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
        return [array(code, [*e.ids, end_id]).tobytes() for e in found]

    return by_chunk if table else whole


def write(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, shard_bytes: int = SHARD_BYTES
) -> None:
    """Encode every whole text and write ``records`` and ``index`` below ``folder``.

    Records lie in ascending order of ``doc_id`` (NULL first, equal ids by text)
    over the files in order of their names. A NULL text is an empty text: only the end
    id. An empty table makes no records. Other columns are not read. ``doc_id``
    is an integer column.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    shards = max(1, -(-size // shard_bytes))

    def make():
        encode = _encoder(tokenizer_path, end_id)
        wide = 2 * _wide(tokenizer_path, end_id)

        def compute(texts: list[str | None], doc_ids: list[int | None]) -> list[pa.Array]:
            made = [
                framed(packed(doc_id, wide, ids))
                for doc_id, ids in zip(doc_ids, encode(texts))
            ]
            return [pa.array(made, pa.binary())]

        return compute

    ordered = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    framed_rows = map_texts(
        ordered, [("record", pa.binary())], make, with_keys=True, slice_chars=SLICE_BYTES
    )
    lines = framed_rows.select(F.col("record").cast("string"))
    lines.write.option("lineSep", "\n").option("compression", "none").text(f"{folder}/records")
    scanned = _scan_index(spark, folder)
    scanned.write.parquet(f"{folder}/index")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file of records: ``shard``, its number in order, and ``content``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
    shard = F.regexp_extract("path", r"part-(\d+)", 1).cast("bigint").alias("shard")
    return files.load(f"{folder}/records").select(shard, "content")


def _scan_index(spark: SparkSession, folder: str) -> DataFrame:
    """Where each record lies: ``shard``, ``offset``, ``length``, and what it holds."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(*(c.to_pylist() for c in batch.columns)):
                rows, first = [], 0
                for number, (offset, length, payload) in enumerate(records(content)):
                    doc_id, ids = unpacked(payload)
                    rows.append((shard, number, doc_id, offset, length, first, len(ids) // 4))
                    first += len(ids) // 4
                if rows:
                    columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["shard", "record", "doc_id", "offset", "length", "first", "n_tokens"]
    schema = ", ".join(f"`{n}` bigint" for n in names)
    small_batches(spark)
    return _files(spark, folder).mapInArrow(scan, schema)


def index(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: ``shard``, ``record`` (its number there), ``doc_id``, ``offset`` and
    ``length`` in bytes, ``start`` (tokens of all records before it) and ``n_tokens``."""
    rows = spark.read.parquet(f"{folder}/index")
    return rows.join(_shard_starts(rows), "shard").select(
        "shard", "record", "doc_id", "offset", "length",
        (F.col("shard_start") + F.col("first")).alias("start"), "n_tokens",
    )


def _shard_starts(rows: DataFrame) -> DataFrame:
    """Tokens in all files before each; the window runs over one row per file."""
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("shard_start")
    return totals.select("shard", start)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every record, checked: ``shard``, ``record``, ``doc_id``, ``start`` and ``ids`` (binary,
    little-endian unsigned 32-bit, with the end id)."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(*(c.to_pylist() for c in batch.columns)):
                rows, size, first = [], 0, 0
                for number, (_, _, payload) in enumerate(records(content)):
                    doc_id, ids = unpacked(payload)
                    rows.append((shard, number, doc_id, first, ids))
                    first, size = first + len(ids) // 4, size + len(ids)
                    if size > 4 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                yield batch_of(rows)

    kinds = [pa.int64()] * 4 + [pa.binary()]
    names = ["shard", "record", "doc_id", "first", "ids"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(names)
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    small_batches(spark)
    schema = "shard bigint, record bigint, doc_id bigint, first bigint, ids binary"
    rows = _files(spark, folder).mapInArrow(scan, schema)
    starts = _shard_starts(spark.read.parquet(f"{folder}/index"))
    return rows.join(F.broadcast(starts), "shard").select(
        "shard", "record", "doc_id", (F.col("shard_start") + F.col("first")).alias("start"), "ids"
    )


def shuffled(spark: SparkSession, folder: str, seed: int, parts: int) -> DataFrame:
    """All records in a random order that ``seed`` fixes, dealt to ``parts`` partitions.

    The order is drawn on the index; each file is then cut at the offsets that its part of
    the index names, and only the records travel.
    """
    drawn = index(spark, folder).withColumn("draw", F.xxhash64(F.lit(seed), "shard", "record"))
    cuts = drawn.groupBy("shard").agg(
        F.collect_list(F.struct("offset", "length", "draw")).alias("cuts")
    )

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, found in zip(*(c.to_pylist() for c in batch.columns)):
                for c in found:
                    part = content[c["offset"] : c["offset"] + c["length"]]
                    doc_id, ids = unpacked(next(records(part))[2])
                    arrays = [
                        pa.array([c["draw"]], pa.int64()),
                        pa.array([doc_id], pa.int64()),
                        pa.array([ids], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names=["draw", "doc_id", "ids"])

    files = _files(spark, folder).join(cuts, "shard").select("content", "cuts")
    rows = files.mapInArrow(cut, "draw bigint, doc_id bigint, ids binary")
    dealt = rows.repartition(parts, "draw").sortWithinPartitions("draw")
    return dealt.select("doc_id", "ids")
