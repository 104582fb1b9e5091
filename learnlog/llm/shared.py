"""What the operators share: table readers, Arrow tasks over texts, tables of chunks."""

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnlog.sources.tables import shared_folder

#: Characters of text that a task turns into Python objects at a time.
SLICE_CHARS = 1_000_000

#: What counts as a word where a contract says so (after lower-casing A-Z).
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder of this application's below the shared one."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/learnlog-{app}/{name}-{uuid.uuid4().hex}"


def small_batches(spark: SparkSession) -> None:
    """Bound what Spark hands to a Python worker at once; texts can be long."""
    for key, most in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", 2_000),
        ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20),
    ):
        value = spark.conf.get(key, None)
        now = int(value) if value and value.lstrip("-").isdigit() else 0
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def slices(lengths: Sequence[int], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``most`` bytes; a longer text ends its run."""
    start = size = 0
    for i, length in enumerate(lengths):
        size += length
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(lengths):
        yield start, len(lengths)


def map_texts(
    rows: DataFrame,
    fields: Sequence[tuple[str, pa.DataType]],
    make: Callable[[], Callable[[list[str | None]], Sequence[pa.Array]]],
    key: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] = (),
    with_keys: bool = False,
    slice_chars: int = SLICE_CHARS,
) -> DataFrame:
    """One row per row: ``key``, ``keep`` and the ``fields`` computed from ``text``.

    ``make`` runs in the task and gives the function that turns a list of texts
    into one Arrow array per field; with ``with_keys`` it gets the keys too. Only the named columns are read, so other
    columns of ``rows`` cannot clash with the new ones.
    """
    small_batches(rows.sparkSession)
    carried = list(dict.fromkeys([key, *keep]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            lengths = pc.binary_length(batch.column("__text")).fill_null(0).to_pylist()
            for a, b in slices(lengths, slice_chars):
                part = batch.slice(a, b - a)
                columns = [part.column(c) for c in carried]
                keys = [columns[0].to_pylist()] if with_keys else []
                made = compute(part.column("__text").to_pylist(), *keys)
                yield pa.RecordBatch.from_arrays(
                    [*columns, *made], names=[*carried, *(name for name, _ in fields)]
                )

    kinds = {
        pa.int64(): "bigint", pa.int32(): "int", pa.float64(): "double", pa.bool_(): "boolean",
        pa.string(): "string", pa.binary(): "binary", pa.list_(pa.int32()): "array<int>",
        pa.list_(pa.int64()): "array<bigint>", pa.list_(pa.float64()): "array<double>", pa.list_(pa.binary()): "array<binary>", pa.list_(pa.string()): "array<string>",
    }
    names = dict(zip(rows.columns, rows.schema))
    schema = ", ".join(
        [f"`{c}` {names[c].dataType.simpleString()}" for c in carried]
        + [f"`{name}` {kinds[kind]}" for name, kind in fields]
    )
    return rows.select(*carried, F.col(text).alias("__text")).mapInArrow(run, schema)


def filter_texts(
    docs: DataFrame, make: Callable[[], Callable[[list[str | None]], list[bool]]]
) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, for whose ``text`` the made function says so."""
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = make()
        for batch in batches:
            texts = batch.column("text")
            lengths = pc.binary_length(texts).fill_null(0).to_pylist()
            for a, b in slices(lengths):
                mask = pa.array(keep(texts.slice(a, b - a).to_pylist()), pa.bool_())
                yield batch.slice(a, b - a).filter(mask)

    return docs.mapInArrow(run, docs.schema)


class ChunkTable:
    """The distinct chunks that a task meets, each with what ``fill`` made of it.

    ``fill`` takes a list of new chunks and returns one value, never None, for
    each. The table holds at most ``limit`` chunks besides those of the texts at
    hand: a full table keeps only what the texts at hand use. A dropped chunk is
    made again when it comes back.
    """

    def __init__(self, fill: Callable[[list], Iterable], limit: int = 500_000):
        self.fill, self.limit, self.rows = fill, limit, {}

    def look_up(self, chunks: Sequence) -> list:
        """The value of each chunk, by position."""
        found = list(map(self.rows.get, chunks))
        new = list({c for c, value in zip(chunks, found) if value is None})
        if not new:
            return found
        made = dict(zip(new, self.fill(new)))
        if len(self.rows) + len(made) > self.limit:
            self.rows = {c: v for c, v in zip(chunks, found) if v is not None}
        self.rows.update(made)
        return [made[c] if value is None else value for c, value in zip(chunks, found)]


def spans(parts: Sequence[Sequence]) -> Iterator[tuple[int, int]]:
    """Where each of several lists starts and ends once they are joined."""
    end = 0
    for part in parts:
        start, end = end, end + len(part)
        yield start, end


def crc_part(modulus: int, key: str = "doc_id"):
    """The remainder that splits learning rows from held-out rows; NULL ids give NULL."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % F.lit(modulus)
