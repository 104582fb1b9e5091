"""The training matrix: history and question features side by side."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from learnlog import schemas
from learnlog.operators.encodings import (
    attach,
    container_stats,
    content_stats,
    log_sums,
    split_sums,
)
from learnlog.operators.history import (
    answered,
    history,
    means_of,
    replaced,
    user_runs,
)
from learnlog.operators.ordered import DEFAULT_LIMITS, SliceLimits
from learnlog.operators.questions import question_features, rollups, tag_codes
from learnlog.sources.tables import concurrently, materialize


Choice = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Encodings:
    """Everything fitted on a log, from written tables."""

    means: DataFrame
    contents: DataFrame
    containers: DataFrame
    questions: DataFrame


def fit_means(runs: DataFrame) -> DataFrame:
    """The means of a log's :func:`user_runs`, written: one row that later plans read."""
    return materialize(means_of(runs), "means")


def fit_log(
    log: DataFrame, runs: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(means, content statistics, container statistics): one scan for the sums, one for
    the means. ``runs`` are the log's :func:`user_runs`, where they are at hand."""
    sums, means = concurrently(
        log.sparkSession,
        lambda: materialize(log_sums(log), "sums"),
        lambda: fit_means(user_runs(log) if runs is None else runs),
    )
    contents, containers, _ = split_sums(sums)
    return means, content_stats(contents, means), container_stats(containers)


def fit(
    log: DataFrame,
    questions: DataFrame,
    communities: DataFrame,
    seen_only: bool = False,
    runs: DataFrame | None = None,
) -> Encodings:
    """Fit the fills and target statistics on the answered rows of ``log``.

    ``seen_only`` keeps the features of the questions answered in ``log``: enough
    for joining to the same log, and a smaller table to join. ``runs`` are the log's
    :func:`user_runs`, where they are at hand.
    """

    def from_log():
        means, contents, containers = fit_log(log, runs)
        return means, contents, containers, rollups(questions, contents)

    (means, contents, containers, rolled_up), codes = concurrently(
        log.sparkSession, from_log, lambda: tag_codes(questions)
    )
    features = question_features(questions, communities, contents, codes, rolled_up)
    if seen_only:
        features = features.where("content_correct_count is not null")
    return Encodings(means, contents, containers, materialize(features, "questions"))


def history_features(
    log: DataFrame,
    means: DataFrame,
    containers: DataFrame,
    limits: SliceLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """``row_id`` and the 27 interaction feature columns."""
    return _finish(user_runs(log, limits), means, containers)


def _finish(
    runs: DataFrame, means: DataFrame, containers: DataFrame, choose: Choice | None = None
) -> DataFrame:
    rows = history(runs, means)
    chosen = choose(rows) if choose else rows
    added = [c for c in chosen.columns if c not in rows.columns]
    rows = attach(chosen, containers, "task_container_id")
    return rows.select("row_id", *schemas.HISTORY_COLUMNS, *added)


def fit_history(log: DataFrame, limits: SliceLimits = DEFAULT_LIMITS) -> DataFrame:
    """The interaction features of a log with the means and statistics of the same log."""
    runs = user_runs(log, limits)
    means, _, containers = fit_log(log, runs)
    return _finish(runs, means, containers)


def join_questions(rows: DataFrame, questions: DataFrame) -> DataFrame:
    """Rows with the features of their question; NULLs without a question row."""
    return attach(rows, questions, "content_id")


def labelled_features(
    log: DataFrame, encodings: Encodings, limits: SliceLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Interaction and question features of every answered interaction."""
    rows = history_features(log, encodings.means, encodings.containers, limits)
    return join_questions(rows, encodings.questions)


def fit_labelled(
    log: DataFrame,
    questions: DataFrame,
    communities: DataFrame,
    limits: SliceLimits = DEFAULT_LIMITS,
    choose: Choice | None = None,
) -> DataFrame:
    """All features of a log, with encodings fitted on the same log.

    ``choose`` samples or splits the rows by ``row_id`` and ``user_id`` as soon as their
    history is known: what it drops, or takes several times, is not joined before.
    """
    runs = user_runs(log, limits)
    encodings = fit(log, questions, communities, seen_only=True, runs=runs)
    rows = _finish(runs, encodings.means, encodings.containers, choose)
    return join_questions(rows, encodings.questions)


def training_matrix(
    log: DataFrame,
    questions: DataFrame,
    communities: DataFrame,
    features: list[str] | None = None,
    limits: SliceLimits = DEFAULT_LIMITS,
    encodings: Encodings | None = None,
) -> DataFrame:
    """``row_id``, the ordered features and the target, one row per answered interaction.

    Pass ``encodings`` fitted on other rows for features without look-ahead.
    """
    if encodings is None:
        rows = fit_labelled(log, questions, communities, limits)
    else:
        rows = labelled_features(log, encodings, limits)
    return select_features(rows, features)


def select_features(rows: DataFrame, features: list[str] | None = None) -> DataFrame:
    return rows.select("row_id", *(features or schemas.FEATURES), schemas.TARGET)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; fractions are truncated toward zero by integer types."""
    return replaced(df, {name: f"cast({name} as {kind})" for name, kind in types.items()})


def labelled_questions(log: DataFrame, questions: DataFrame) -> DataFrame:
    """Answered rows with the question columns as read."""
    renamed = questions.withColumnRenamed("question_id", "content_id")
    return join_questions(answered(log), renamed)
