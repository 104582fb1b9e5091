"""Target statistics per task container and per content.

``*_sums`` reduces a log to a small table, ``*_stats`` turns that into statistics
and ``attach`` joins them back. Fitting on the whole log repeats the usual
look-ahead; fit on the training rows and attach to the others to avoid it.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlog import schemas
from learnlog.functions.columns import ratio
from learnlog.operators.history import answered
from learnlog.sources.tables import materialize

_EXPLAINED = "prior_question_had_explanation"
_ELAPSED = "prior_question_elapsed_time"
_PIVOT = {
    "content_explation_false_mean": f"avg({schemas.TARGET}) filter (where {_EXPLAINED} = 0)",
    "content_explation_true_mean": f"avg({schemas.TARGET}) filter (where {_EXPLAINED} = 1)",
}
_TARGET_SUMS = {
    "s": f"sum({schemas.TARGET})",
    "n": f"count({schemas.TARGET})",
    "variance": f"var_samp({schemas.TARGET})",
}
_SUMS = {
    **_TARGET_SUMS,
    **_PIVOT,
    "elapsed": f"coalesce(sum({_ELAPSED}), 0)",
    "missing": f"count(*) filter (where {_ELAPSED} is null)",
    "content_had_explanation_mean": f"avg({_EXPLAINED})",
}
# Values of grouping_id() for (content_id, task_container_id).
_PER_CONTENT, _PER_CONTAINER, _OVERALL = 1, 2, 3


def _aggregates(columns: dict[str, str]) -> list:
    return [F.expr(f"{total} as {name}") for name, total in columns.items()]


def container_sums(log: DataFrame) -> DataFrame:
    return answered(log).groupBy("task_container_id").agg(*_aggregates(_TARGET_SUMS))


def content_sums(log: DataFrame) -> DataFrame:
    return answered(log).groupBy("content_id").agg(*_aggregates(_SUMS))


def log_sums(log: DataFrame) -> DataFrame:
    """The sums per content, per container and overall, from one scan of the log."""
    keys = ["content_id", "task_container_id"]
    grouped = answered(log).groupingSets([[keys[0]], [keys[1]], []], *keys)
    return grouped.agg(*_aggregates({**_SUMS, "level": "int(grouping_id())"}))


def split_sums(sums: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(contents, containers, overall) of :func:`log_sums`."""
    return (
        sums.where(f"level = {_PER_CONTENT}").drop("level", "task_container_id"),
        sums.where(f"level = {_PER_CONTAINER}").select("task_container_id", *_TARGET_SUMS),
        # One row, also for a log without answers.
        sums.where(f"level = {_OVERALL}").agg(
            F.expr("coalesce(max(n), 0) as n"),
            F.expr(f"max({ratio('elapsed', '(n - missing)')}) as elapsed_mean"),
        ),
    )


def container_stats(sums: DataFrame) -> DataFrame:
    """Per task container. The ``_std`` column holds the sample variance."""
    return sums.selectExpr(
        "task_container_id",
        "n - s as task_container_uncor_count",
        "s as task_container_cor_count",
        "variance as task_container_std",
        f"{ratio('s', 'n')} as task_container_correctness",
    )


def content_stats(sums: DataFrame, means: DataFrame) -> DataFrame:
    """Per content. The ``_std`` column holds the sample variance.

    The elapsed time is averaged as if filled by its mean: the missing ones add
    the mean once each.
    """
    return sums.crossJoin(F.broadcast(means.select("elapsed_mean"))).selectExpr(
        "content_id",
        "content_explation_false_mean",
        "content_explation_true_mean",
        f"{ratio('s', 'n')} as content_correctness",
        "variance as content_correctness_std",
        "n - s as content_uncorrect_count",
        "s as content_correct_count",
        "(elapsed + coalesce(missing * elapsed_mean, 0)) / n as content_elapsed_time_mean",
        "content_had_explanation_mean",
    )


def explanation_pivot(log: DataFrame) -> DataFrame:
    """Per content: mean target without and with an explanation seen before."""
    return answered(log).groupBy("content_id").agg(*_aggregates(_PIVOT))


def attach(rows: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Left join of a keyed statistics table; unseen keys get NULLs.

    ``stats`` should be a scan (:func:`materialize`), so that its true size
    decides between a broadcast and a skew-split shuffle join.
    """
    return rows.join(stats, key, "left")


def with_container_stats(rows: DataFrame, log: DataFrame) -> DataFrame:
    """Rows with the container statistics of ``log``."""
    stats = materialize(container_stats(container_sums(log)), "containers")
    return attach(rows, stats, "task_container_id")
