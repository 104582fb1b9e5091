"""Document fingerprints: bottom-k sketches of word shingles, in SQL expressions only.

A sketch is the ascending array of the ``k`` smallest distinct hashes of a text's shingles,
all of them if there are fewer. The sketch of several parts together is the bottom
k of their sketches' union; the share of the union's sketch that two sketches share
estimates their resemblance, and the place of the k-th hash the number of shingles.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnlog.sources.tables import materialize

#: Words in a shingle.
SHINGLE = 5
#: Hashes in a sketch; the standard error of a likeness is at most 0.5 / sqrt(K).
K = 128
#: Documents of one run of neighbours in order of their ids, on average.
RUN = 1_000
#: Quantiles of the ids that runs are laid out by; evenly within two of them.
QUANTILES = 256

_BLANKS = r"' \t\n\r\f\u000b'"


def shingle_hashes(text: str, size: int = SHINGLE) -> Column:
    """The hashes of the word shingles of column ``text``, repeats included.

    Words are lower-cased and stand between white space. A text of fewer words, but not none,
    is one shingle. Each lambda over a one-element array binds what it is given once.
    """
    parts = ", ".join(["h", *(f"hs[i + {j}]" for j in range(1, size))])
    return F.expr(
        f"""transform(
          array(transform(
            if(trimmed_ = '', array(), split(trimmed_, '\\\\s+')), w -> xxhash64(w))),
          hs -> case when size(hs) >= {size}
            then transform(slice(hs, 1, size(hs) - {size - 1}), (h, i) -> xxhash64({parts}))
            when size(hs) > 0 then array(xxhash64(hs))
            else cast(array() as array<bigint>) end)[0]""".replace(
            "trimmed_", f"btrim(lower(coalesce({text}, '')), {_BLANKS})"
        )
    )


def sketch(text: str, size: int = SHINGLE, k: int = K) -> Column:
    """The sketch of column ``text``; a NULL or blank text has an empty one."""
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, size))), 1, k)


def merged(a: str, b: str, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: str, b: str, k: int = K) -> Column:
    """Estimated share of common shingles in all shingles; 1 for two empty sketches.

    Exact if the union has at most ``k`` shingles.
    """
    union = merged(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, F.col(a)), F.col(b)))
    return F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(both / F.size(union))


def distinct_shingles(a: str, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    place = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / place)


def containment(a: str, b: str, k: int = K) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has too; 1 for an empty ``a``."""
    union = F.when(
        F.size(merged(a, b, k)) < k, F.size(merged(a, b, k)).cast("double")
    ).otherwise(
        (k - 1) / ((F.element_at(merged(a, b, k), -1).cast("double") + F.lit(2.0**63)) / 2.0**64)
    )
    common = resemblance(a, b, k) * union
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def fingerprint(a: str) -> Column:
    """A sketch as text: 16 hexadecimal digits a hash. Equal texts have equal ones."""
    return F.lower(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def _run_of(docs: DataFrame) -> Column:
    """A number that ascends with ``doc_id`` and that about RUN documents share.

    Ids are told apart by their quantiles, and evenly between two of them. NULL ids come first.
    """
    ids = docs.select("doc_id")
    rows = ids.count()
    shares = [i / QUANTILES for i in range(QUANTILES)]
    marks = ids.approxQuantile("doc_id", shares, 0.2 / QUANTILES) if rows else []
    edges = sorted({int(m) for m in marks}) or [0]
    within = max(1, -(-rows // (RUN * len(edges))))
    listed = ", ".join(f"{e}L" for e in [*edges, edges[-1] + 1])
    return F.expr(
        f"""transform(array(greatest(0, size(filter(array({listed}), e -> e <= doc_id)) - 1)), p ->
          transform(array(least({len(edges) - 1}, p)), q -> q * {within}L + greatest(0L, least(
            {within - 1}L, floor((double(doc_id) - array({listed})[q]) * {within}
              / (double(array({listed})[q + 1]) - array({listed})[q])))))[0])[0]"""
    )


def with_next(docs: DataFrame, size: int = SHINGLE, k: int = K) -> DataFrame:
    """Every document with the next one: ``doc_id``, ``text``, ``sketch``, ``next_text``,
    ``next_sketch``.

    Documents stand in ascending order of ``doc_id`` (NULL first, equal ids by text), and
    the first follows the last; a single document follows itself. NULL texts are empty.
    Repeated rows stay rows of their own; an empty table gives none; other columns are
    not read. ``doc_id`` is an integer column.

    Texts are shuffled once, by runs of neighbouring ids; each run also gets the first
    text of the run behind it.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.withColumn("run", F.coalesce(_run_of(rows), F.lit(-1)).cast("bigint"))
    firsts = rows.groupBy("run").agg(F.min("doc_id").alias("first_id"))
    # One row per run of documents, not of each document.
    order = Window.orderBy("run")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("run").over(order), F.max("run").over(whole))
    firsts = materialize(firsts.withColumn("before", before), "runs")
    heads = (
        rows.join(firsts.withColumnRenamed("run", "head_run"), F.col("run") == F.col("head_run"))
        .where(F.col("doc_id").eqNullSafe(F.col("first_id")))
        .groupBy("before")
        .agg(F.min("text").alias("text"))
        .select(F.lit(None).cast("bigint").alias("doc_id"), "text", F.col("before").alias("run"))
    )
    both = rows.withColumn("behind", F.lit(0)).unionByName(heads.withColumn("behind", F.lit(1)))
    dealt = both.repartition("run").withColumn("sketch", sketch("text", size, k))
    place = Window.partitionBy("run").orderBy("behind", F.asc_nulls_first("doc_id"), "text")
    return (
        dealt.withColumn("next_text", F.lead("text").over(place))
        .withColumn("next_sketch", F.lead("sketch").over(place))
        .where("behind = 0")
        .select("doc_id", "text", "sketch", "next_text", "next_sketch")
    )


def sketches(docs: DataFrame, size: int = SHINGLE, k: int = K) -> DataFrame:
    """``doc_id`` and ``sketch`` of every whole text; NULL and blank texts have empty ones."""
    return docs.select("doc_id", sketch("text", size, k).alias("sketch"))


def combined(rows: DataFrame, by: list[str], k: int = K) -> DataFrame:
    """One sketch for all the sketches of a group, of parts of a text or texts of a corpus.

    Hashes are made distinct before they are ranked, and of a large group's only the ``k``
    smallest of each of many shares come together.
    """
    hashes = rows.select(*by, F.explode("sketch").alias("hash")).distinct()
    share = hashes.withColumn("share", F.pmod(F.xxhash64("hash"), F.lit(64)))
    rank = Window.partitionBy(*by, "share").orderBy("hash")
    least = share.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    whole = F.slice(F.sort_array(F.collect_list("hash")), 1, k)
    return least.groupBy(*by).agg(whole.alias("sketch"))
