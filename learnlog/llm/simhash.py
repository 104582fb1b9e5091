"""SimHash fingerprints, linked within a bit distance by covering masks.

A radius r needs 2^(r+1) - 1 masks: every bit position gets a non-zero vector of r+1
bits, and mask v keeps the positions whose vector has an odd product with v. Any r
differing positions span at most r dimensions, so some v is orthogonal to all of them: its
mask keeps none of them, and the two fingerprints fall into one bucket there. No pair
within the radius is missed.

Equal fingerprints are one node. A bucket that more nodes share than a task should
compare is masked again on the positions its first mask left out. The vectors are dealt
evenly, so two levels leave at most 16 free bits: no such bucket holds more than 65 536 nodes.
Inside a bucket, nodes are compared by blocks, and a spanning forest of the links goes out.
"""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlog.llm.graph import components
from learnlog.llm.shared import map_texts
from learnlog.sources.tables import materialize

BITS = 64
#: Words in a shingle.
SHINGLE = 3
#: Largest bit distance of a link.
RADIUS = 3
#: Nodes of a bucket that one task compares at the first level.
BUCKET = 4096
#: Fixed value: the seed of the shingle hash.
SEED = 42

#: What tells texts under one id apart.
TEXT_KEY = "xxhash64(text, char_length(text))"

_LOWER_BYTES = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
_SPACE = bytes(32 if 9 <= i <= 13 else i for i in range(256))


def shingles_of(text: str | None, size: int) -> list[bytes]:
    """The word shingles of a text, repeats included; a shorter text is one shingle."""
    words = (text or "").encode().translate(_LOWER_BYTES).translate(_SPACE).split(b" ")
    words = [w for w in words if w]
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-size] + 1).tolist()]
    return [joined[a:b] for a, b in zip(starts, ends[size - 1 :].tolist())]


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half the hashes, as a signed 64-bit integer."""
    if not len(hashes):
        return 0
    bits = np.zeros(BITS, np.int64)
    for a in range(0, len(hashes), 65536):
        part = hashes[a : a + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = (2 * bits > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text_key`` (a hash of the text) and ``fingerprint`` (signed 64-bit) of
    every whole text.

    NULL texts and texts without a word have fingerprint zero. Repeated rows
    stay rows of their own; other columns are not read.
    """

    def make() -> Callable:
        def compute(texts: list[str | None]) -> list[pa.Array]:
            digest, made = xxhash.xxh64_intdigest, []
            for text in texts:
                found = shingles_of(text, shingle)
                hashes = np.fromiter((digest(s, SEED) for s in found), np.uint64, len(found))
                made.append(fingerprint_of(hashes))
            return [pa.array(made, pa.int64())]

        return compute

    keyed = docs.select("doc_id", F.expr(TEXT_KEY).alias("text_key"), "text")
    return map_texts(keyed, [("fingerprint", pa.int64())], make, keep=["text_key"])


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """Masks over the bit ``positions`` such that any ``radius`` of them escape some mask."""
    vectors = (1 << (radius + 1)) - 1
    assigned = [(p, 1 + i % vectors) for i, p in enumerate(positions)]
    return [
        sum(1 << p for p, vector in assigned if (vector & v).bit_count() & 1)
        for v in range(1, vectors + 1)
    ]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _free(mask: int) -> list[int]:
    return [p for p in range(BITS) if not mask >> p & 1]


def _forest(nodes: np.ndarray, prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the nodes of one bucket."""
    parent = np.arange(len(nodes))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for i in range(len(nodes) - 1):
        near = np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= radius
        others = np.flatnonzero(near) + i + 1
        if not len(others):
            continue
        a = root(i)
        for j in others[parent[others] != a].tolist():
            b = root(j)
            if a != b:
                parent[b] = a
                links.append((int(nodes[i]), int(nodes[j])))
    return links


def _linker(radius: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for nodes, prints in zip(*(c.to_pylist() for c in batch.columns)):
                links += _forest(np.array(nodes), np.array(prints, np.int64).view(np.uint64), radius)
            a, b = zip(*links) if links else ((), ())
            arrays = [pa.array(a, pa.int64()), pa.array(b, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

    return run


def _bucketed(rows: DataFrame, keys: list[str], bucket: int | None) -> tuple[DataFrame, DataFrame]:
    """Rows of buckets with two to ``bucket`` nodes, as lists, and those of larger ones as rows."""
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("size")).where("size > 1")
    sizes = materialize(sizes, "buckets")
    fit = F.col("size") <= bucket if bucket else F.lit(True)
    small = rows.join(sizes.where(fit).select(*keys), keys)
    lists = small.groupBy(*keys).agg(
        F.collect_list(F.struct("node", "fingerprint")).alias("members")
    )
    large = rows.join(sizes.where(~fit).select(*keys), keys)
    return lists.select("members.node", "members.fingerprint"), large


def links(nodes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links that connect what lies within ``radius`` differing bits.

    ``nodes`` has ``node`` and ``fingerprint``, both distinct. Returns ``a`` and ``b``: of
    each bucket a spanning forest of its links. Every pair within the radius shares a bucket,
    so the links have the components of all pairs within the radius.
    """
    first = covering_masks(list(range(BITS)), radius)
    keyed = nodes.select(
        "node",
        "fingerprint",
        F.posexplode(F.array(*[F.lit(_signed(m)) for m in first])).alias("table", "mask"),
    ).select("node", "fingerprint", "table", F.expr("fingerprint & mask").alias("key"))
    lists, large = _bucketed(keyed, ["table", "key"], bucket)
    # The second level masks the positions that the bucket's own mask left out.
    second = [[_signed(m) for m in covering_masks(_free(mask), radius)] for mask in first]
    masks = F.array(*[F.array(*[F.lit(m) for m in own]) for own in second])
    again = large.select(
        "node", "fingerprint", "table", "key", F.posexplode(masks[F.col("table")]).alias("inner", "m")
    ).withColumn("inner_key", F.expr("fingerprint & m"))
    deep, _ = _bucketed(again, ["table", "key", "inner", "inner_key"], None)
    both = lists.unionByName(deep)
    return both.mapInArrow(_linker(radius), "a bigint, b bigint").distinct()


def _grouped(docs: DataFrame, shingle: int, radius: int) -> DataFrame:
    """:func:`fingerprints` with ``component``, a fingerprint of the group, and
    ``component_id``, the smallest id in it."""
    prints = materialize(fingerprints(docs, shingle), "fingerprints")
    # A node is a distinct fingerprint, known by itself; its documents are never listed.
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    least = materialize(least, "nodes")
    nodes = least.select(F.col("fingerprint").alias("node"), "fingerprint")
    found = components(materialize(links(nodes, radius), "links"))
    members = least.join(found, least.fingerprint == found.node, "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")
    )
    ids = members.groupBy("component").agg(F.min("least").alias("component_id"))
    known = members.join(ids, "component").select("fingerprint", "component", "component_id")
    return prints.join(materialize(known, "ids"), "fingerprint")


def groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (signed) and ``component_id`` of every row.

    Documents are linked if their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the smallest ``doc_id`` that links reach, the own one included. Rows
    with a NULL id are linked too but lend no id: a component without any id has a NULL
    one. An empty table gives no rows.
    """
    return _grouped(docs, shingle, radius).select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each group, all its columns: the one with the smallest ``doc_id``, of
    several texts under that id the one with the smallest hash.

    Different texts under one id that are not alike are in different groups, and both stay.
    Of rows that repeat an id and its text one stays. Rows with a NULL id are kept: nothing
    names them.
    """
    named = _grouped(docs, shingle, radius).where("doc_id is not null")
    first = named.groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
    columns = docs.columns
    key = "_" * max(map(len, columns)) + "key"  # no column has this name
    kept = first.select("first.doc_id", F.col("first.text_key").alias(key))
    rows = docs.withColumn(key, F.expr(TEXT_KEY)).join(kept, ["doc_id", key], "left_semi")
    rows = rows.dropDuplicates(["doc_id", key]).select(*columns)
    return rows.unionByName(docs.where("doc_id is null").select(*columns))
