"""The question table: tag bands, bundles, communities, target statistics."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlog import schemas
from learnlog.functions.columns import filled_tags, part_bundle_key, tag_band
from learnlog.operators.ordered import running_totals
from learnlog.sources.tables import concurrently, materialize

STAT_COLUMNS = [
    "content_explation_false_mean",
    "content_explation_true_mean",
    "content_correctness",
    "content_correctness_std",
    "content_uncorrect_count",
    "content_correct_count",
    "content_elapsed_time_mean",
    "content_had_explanation_mean",
]


def tag_bands(questions: DataFrame) -> DataFrame:
    """``tags0`` to ``tags5``: the tags of each band of 32 as one string."""
    bands = [f"{tag_band(filled_tags(), band)} as tags{band}" for band in schemas.TAG_BANDS]
    return questions.selectExpr("*", *bands)


def label_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, label, code): distinct labels of each column numbered from 0 in order."""
    cells = ", ".join(f"struct('{c}' as column, {c} as label)" for c in columns)
    labels = df.selectExpr(f"inline(array({cells}))").where("label is not null").distinct()
    ranked = running_totals(
        labels.selectExpr("*", "1 as one"), order=["label"], sums=["one"], within=["column"]
    )
    return ranked.selectExpr("column", "label", "before_one as code")


def label_encode(
    df: DataFrame, columns: Sequence[str], codes: DataFrame | None = None
) -> DataFrame:
    """Replace each string column by the rank of its value among the distinct ones."""
    kept = df.columns
    codes = codes or materialize(label_codes(df, columns), "labels")
    for c in columns:
        own = codes.where(f"column = '{c}'").selectExpr(f"label as {c}", f"code as _code_{c}")
        df = df.join(own, c, "left")
    return df.selectExpr(*[f"_code_{c} as {c}" if c in columns else c for c in kept])


def bundle_sizes(questions: DataFrame) -> DataFrame:
    """Per bundle: number of questions."""
    return questions.groupBy("bundle_id").agg(F.count("question_id").alias("content_sub_bundle"))


def with_bundle_size(questions: DataFrame) -> DataFrame:
    sizes = materialize(bundle_sizes(questions), "bundle-sizes")
    return questions.join(sizes, "bundle_id", "left")


def join_communities(questions: DataFrame, communities: DataFrame) -> DataFrame:
    return questions.join(communities.select("question_id", "community"), "question_id", "left")


def with_content_stats(questions: DataFrame, contents: DataFrame) -> DataFrame:
    """Questions, keyed ``content_id``, with the statistics of their answers."""
    renamed = questions.withColumnRenamed("question_id", "content_id")
    return renamed.join(contents, "content_id", "left")


def part_stats(questions: DataFrame) -> DataFrame:
    """Per part: mean and variance (``_std``) of the per-question rate, and counts.

    Every question weighs the same, however often it was answered.
    """
    return questions.groupBy("part").agg(
        F.expr("avg(content_correctness) as part_correctness_mean"),
        F.expr("var_samp(content_correctness) as part_correctness_std"),
        F.expr("coalesce(sum(content_uncorrect_count), 0) as part_uncor_count"),
        F.expr("coalesce(sum(content_correct_count), 0) as part_cor_count"),
    )


def bundle_stats(questions: DataFrame) -> DataFrame:
    """Per bundle: number of questions and mean of the per-question rate."""
    return questions.groupBy("bundle_id").agg(
        F.count("content_id").alias("content_sub_bundle"),
        F.avg("content_correctness").alias("bundle_correctness_mean"),
    )


def rollups(questions: DataFrame, contents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The part and bundle statistics, written.

    Parts and bundles are far fewer than questions, so a plain shuffle join would
    put all questions of a large part into one task. Written, the tables are known
    to be small.
    """
    rates = with_content_stats(questions.select("question_id", "part", "bundle_id"), contents)
    rates = materialize(rates, "rates")
    parts, bundles = concurrently(
        questions.sparkSession,
        lambda: materialize(part_stats(rates), "parts"),
        lambda: materialize(bundle_stats(rates), "bundles"),
    )
    return parts, bundles


def with_question_stats(
    questions: DataFrame,
    contents: DataFrame,
    rolled_up: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Attach content, part and bundle statistics to the question table."""
    parts, bundles = rolled_up or rollups(questions, contents)
    joined = with_content_stats(questions, contents)
    return joined.join(parts, "part", "left").join(bundles, "bundle_id", "left")


def tag_codes(questions: DataFrame) -> DataFrame:
    """The codes of all tag bands, written."""
    return materialize(label_codes(tag_bands(questions), schemas.TAG_COLUMNS), "labels")


def question_features(
    questions: DataFrame,
    communities: DataFrame,
    contents: DataFrame,
    codes: DataFrame | None = None,
    rolled_up: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """All question features, one row per question, keyed ``content_id``.

    ``codes`` and ``rolled_up`` may be passed where they are already built.
    """
    codes = codes or tag_codes(questions)
    rows = join_communities(questions, communities)
    rows = with_question_stats(rows, contents, rolled_up)
    rows = label_encode(tag_bands(rows).drop("tags"), schemas.TAG_COLUMNS, codes)
    rows = rows.selectExpr("*", f"{part_bundle_key()} as part_bundle_id")
    return rows.select(*schemas.QUESTION_COLUMNS)
