"""Per-user history features of an interaction log.

Running counts see lectures; everything else sees answered questions only, so
the answered filter sits between two window stages. Both stages, and the attempt
number per (user, content), share one hash exchange on ``user_id``. Users too
large for one task take the sliced plan of :mod:`learnlog.operators.ordered`.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlog import schemas
from learnlog.functions.columns import had_explanation, hours, is_answered, ratio
from learnlog.operators.ordered import (
    DEFAULT_LIMITS,
    SLICE,
    UP_TO_HERE,
    SliceLimits,
    carried_sums,
    carried_tail,
    split_heavy,
    window,
)
from learnlog.sources.tables import concurrently, materialize

# Gap features by how many answers they look back.
LAGS = {1: "lagtime", 2: "lagtime2", 3: "lagtime3"}
_DEPTH = max(LAGS)
_EXPLAINED = "prior_question_had_explanation"
_ELAPSED = "prior_question_elapsed_time"


def replaced(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Set columns to expressions over the input row, keeping their positions."""
    old = df.columns
    kept = [f"{columns[c]} as {c}" if c in columns else c for c in old]
    return df.selectExpr(*kept, *[f"{e} as {c}" for c, e in columns.items() if c not in old])


def answered(log: DataFrame) -> DataFrame:
    """Rows with a label; the explanation flag filled and turned into 0/1."""
    return replaced(log.where(is_answered()), {_EXPLAINED: had_explanation()})


# --- window stages --------------------------------------------------------------

# Totals that a slice of a heavy user adds to the slices after it.
_ALL_TOTALS = {
    "user_interaction_count": "count(*)",
    "user_lecture_sum": "sum(content_type_id)",
}
_ANSWER_TOTALS = {
    "_position": "count(*)",
    "_correct": f"sum({schemas.TARGET})",
    "_explained": f"sum({_EXPLAINED})",
}
_ATTEMPT_TOTALS = {"attempt_no": "count(*)"}


def _count_all(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    upto = window(keys, "row_id", UP_TO_HERE)
    return rows.selectExpr("*", *[f"{t} over {upto} as {n}" for n, t in _ALL_TOTALS.items()])


def _count_answered(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    by_row = window(keys, "row_id")
    upto = window(keys, "row_id", UP_TO_HERE)
    attempts = window([*keys, "content_id"], "row_id", UP_TO_HERE)
    return rows.selectExpr(
        "*",
        *[f"{t} over {upto} as {n}" for n, t in _ANSWER_TOTALS.items()],
        f"lag({_ELAPSED}, 1) over {by_row} as _elapsed1",
        *[f"lag(timestamp, {k}) over {by_row} as _ts{k}" for k in LAGS],
        f"count(*) over {attempts} as attempt_no",
    )


def _add(
    df: DataFrame, carried: DataFrame, keys: Sequence[str], totals: Mapping[str, str]
) -> DataFrame:
    """Add the totals of the earlier slices to the running totals of this one."""
    columns = df.columns
    shifts = carried.withColumnsRenamed({n: f"_carried_{n}" for n in totals})
    sums = {n: f"{n} + coalesce(_carried_{n}, 0)" for n in totals}
    joined = df.join(shifts, [*keys, SLICE], "left")
    return joined.selectExpr(*[f"{sums[c]} as {c}" if c in sums else c for c in columns])


def _count_all_sliced(sliced: DataFrame, carried: DataFrame) -> DataFrame:
    return _add(_count_all(sliced, ["user_id", SLICE]), carried, ["user_id"], _ALL_TOTALS)


def _carried_counts(sliced: DataFrame) -> DataFrame:
    return materialize(carried_sums(sliced, ["user_id"], _ALL_TOTALS), "carried-counts")


def _count_answered_sliced(sliced: DataFrame) -> DataFrame:
    questions = answered(sliced)
    pair = ["user_id", "content_id"]
    edges = ["timestamp", _ELAPSED]
    # Written, so that each join below is planned by the true size: a broadcast
    # where there are few slices, else a join on the slices' own partitioning.
    counts, carried, attempts, tail = concurrently(
        sliced.sparkSession,
        lambda: _carried_counts(sliced),
        lambda: materialize(carried_sums(questions, ["user_id"], _ANSWER_TOTALS), "carried"),
        lambda: materialize(carried_sums(questions, pair, _ATTEMPT_TOTALS), "attempts"),
        lambda: materialize(carried_tail(questions, "user_id", edges, _DEPTH, "_tail"), "tails"),
    )

    rows = _count_answered(answered(_count_all_sliced(sliced, counts)), ["user_id", SLICE])

    def lagged(column: str, source: str, k: int) -> str:
        # Rows at the start of a slice look back into the carried tail.
        before = f"get(_tail, cast({k} - _position as int)).{source}"
        return f"case when _position > {k} then {column} else {before} end"

    looked_back = {"_elapsed1": lagged("_elapsed1", _ELAPSED, 1)}
    looked_back |= {f"_ts{k}": lagged(f"_ts{k}", "timestamp", k) for k in LAGS}
    rows = replaced(rows.join(tail, ["user_id", SLICE], "left"), looked_back).drop("_tail")
    rows = _add(rows, carried, ["user_id"], _ANSWER_TOTALS)
    return _add(rows, attempts, pair, _ATTEMPT_TOTALS)


def _with_count_ratios(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        "*",
        f"{hours('timestamp / user_interaction_count')} as user_interaction_timestamp_mean",
        "user_lecture_sum / user_interaction_count as user_lecture_lv",
    )


def interaction_counts(log: DataFrame, limits: SliceLimits = DEFAULT_LIMITS) -> DataFrame:
    """Running interaction and lecture counts of every row, lectures included.

    Adds ``user_interaction_count``, ``user_interaction_timestamp_mean`` (hours),
    ``user_lecture_sum`` and ``user_lecture_lv``.
    """
    ordinary, sliced = split_heavy(log, limits)
    rows = _count_all(ordinary, ["user_id"])
    if sliced is not None:
        rows = rows.unionByName(_count_all_sliced(sliced, _carried_counts(sliced)).drop(SLICE))
    return _with_count_ratios(rows)


def user_runs(log: DataFrame, limits: SliceLimits = DEFAULT_LIMITS) -> DataFrame:
    """Answered rows with all running counts and raw lags, nothing filled."""
    ordinary, sliced = split_heavy(log, limits)
    rows = _count_answered(answered(_count_all(ordinary, ["user_id"])), ["user_id"])
    if sliced is not None:
        rows = rows.unionByName(_count_answered_sliced(sliced).drop(SLICE))
    return _with_count_ratios(rows)


# --- means that fill the gaps ---------------------------------------------------


def overall_sums(log: DataFrame) -> DataFrame:
    """One row: the number of answers and the mean elapsed time."""
    return answered(log).agg(F.expr("count(*) as n"), F.expr(f"avg({_ELAPSED}) as elapsed_mean"))


def means_of(runs: DataFrame) -> DataFrame:
    """One row: the mean of each column that is filled by its mean, from :func:`user_runs`.

    One aggregate over the windows' output. Only the columns it needs are read and
    shuffled, and nothing is sorted before that shuffle.
    """
    # Exact sums: epoch-scale milliseconds over many rows overflow a long.
    gaps = {
        name: f"sum(cast(timestamp - _ts{k} as decimal(20, 0)))" for k, name in LAGS.items()
    }
    after = "filter (where _position > 1)"
    totals = {
        "elapsed_mean": f"avg({_ELAPSED})",
        **{f"{name}_mean": ratio(gap, f"count(_ts{k})") for (k, name), gap in zip(LAGS.items(), gaps.values())},
        "changes": f"sum(coalesce({_ELAPSED}, 0) - coalesce(_elapsed1, 0)) {after}",
        "missing": f"sum(int({_ELAPSED} is null) - int(_elapsed1 is null)) {after}",
        "n": f"count(*) {after}",
    }
    sums = runs.agg(*[F.expr(f"{total} as {name}") for name, total in totals.items()])
    # A missing first or last value counts as the mean.
    delta = "(changes + coalesce(missing * elapsed_mean, 0))"
    lag_means = [f"{name}_mean" for name in LAGS.values()]
    return sums.selectExpr("elapsed_mean", *lag_means, f"{ratio(delta, 'n')} as delta_mean")


def global_means(log: DataFrame, limits: SliceLimits = DEFAULT_LIMITS) -> DataFrame:
    return means_of(user_runs(log, limits))


# --- features -------------------------------------------------------------------


def _lagtimes() -> dict[str, str]:
    return {
        name: hours(f"coalesce(cast(timestamp - _ts{k} as double), {name}_mean)")
        for k, name in LAGS.items()
    }


def _elapsed() -> dict[str, str]:
    filled = f"coalesce({_ELAPSED}, elapsed_mean)"
    change = f"{filled} - coalesce(_elapsed1, elapsed_mean)"
    delta = f"coalesce(case when _position > 1 then {change} end, delta_mean)"
    return {
        _ELAPSED: filled,
        # A cast to an integer truncates toward zero.
        "delta_prior_question_elapsed_time": f"cast({delta} as bigint)",
    }


def _prior_accuracy() -> dict[str, str]:
    correct = f"(_correct - {schemas.TARGET})"
    rate = ratio(correct, "(_position - 1)")
    return {
        "user_correct_count": correct,
        "user_uncorrect_count": f"_position - 1 - {correct}",
        "user_correctness": f"coalesce({rate}, {schemas.FIRST_ACCURACY}D)",
    }


def _explanation_counts() -> dict[str, str]:
    return {
        "explanation_mean": "_explained / _position",
        "explanation_true_count": "_explained",
        "explanation_false_count": "_position - _explained",
    }


def add_lagtimes(runs: DataFrame, means: DataFrame) -> DataFrame:
    """Hours since the first, second and third answer before this one."""
    rows = replaced(runs.crossJoin(F.broadcast(means)), _lagtimes())
    return rows.drop(*means.columns)


def add_elapsed(runs: DataFrame, means: DataFrame) -> DataFrame:
    """Fill the elapsed time by its mean; add its change since the last answer."""
    rows = replaced(runs.crossJoin(F.broadcast(means)), _elapsed())
    return rows.drop(*means.columns)


def add_prior_accuracy(runs: DataFrame) -> DataFrame:
    """Correct, incorrect and rate over the user's earlier answers only."""
    return replaced(runs, _prior_accuracy())


def add_explanation_counts(runs: DataFrame) -> DataFrame:
    """Explanations seen and not seen up to this row, and their rate."""
    return replaced(runs, _explanation_counts())


def history(runs: DataFrame, means: DataFrame) -> DataFrame:
    """All history features of :func:`user_runs`, filled, keyed by ``row_id``."""
    rows = runs.crossJoin(F.broadcast(means))
    computed = {
        **_lagtimes(),
        **_elapsed(),
        **_prior_accuracy(),
        **_explanation_counts(),
        "timestamp": hours("timestamp"),
    }
    present = {*rows.columns, *computed}
    columns = [c for c in schemas.HISTORY_COLUMNS if c in present]
    return rows.selectExpr(
        "row_id", *[f"{computed[c]} as {c}" if c in computed else c for c in columns]
    )


# --- state tables: one row per user or per (user, content) -----------------------


def lecture_totals(log: DataFrame) -> DataFrame:
    """Per user: lectures watched (``sum``) and interactions (``count``)."""
    return log.groupBy("user_id").agg(
        F.sum("content_type_id").alias("sum"), F.count("content_type_id").alias("count")
    )


def attempt_totals(log: DataFrame) -> DataFrame:
    """Per (user, content): number of attempts."""
    return answered(log).groupBy("user_id", "content_id").agg(F.count("*").alias("sum"))


def repeat_attempts(log: DataFrame) -> DataFrame:
    """The (user, content) pairs attempted more than once."""
    return attempt_totals(log).where("sum > 1")


def last_timestamps(log: DataFrame) -> DataFrame:
    """Per user: the latest answer time in milliseconds."""
    return answered(log).groupBy("user_id").agg(F.max("timestamp").alias("max_time_stamp"))


def previous_timestamps(log: DataFrame) -> DataFrame:
    """Per user: the latest time one and two answers back; NULL with too few rows.

    That is the latest time among all but the last row, or the last two. Six rows of a
    user tell it: the three latest times and the last three rows; the rank filter drops
    the others before the shuffle.
    """
    ends = answered(log).selectExpr(
        "user_id", "row_id", "timestamp", "explode(array('time', 'row')) as side"
    )
    order = "if(side = 'time', timestamp, row_id) desc, row_id desc"
    rank = f"row_number() over {window(['user_id', 'side'], order)} as _rank"
    ends = ends.selectExpr("*", rank).where("_rank <= 3")
    per_user = ends.groupBy("user_id").agg(
        F.expr("collect_list(struct(timestamp, row_id)) filter (where side = 'time') as times"),
        F.expr("max(row_id) filter (where side = 'row') as last"),
        F.expr("max(row_id) filter (where side = 'row' and _rank = 2) as second"),
    )
    latest = "array_max(transform(filter(times, t -> {0}), t -> t.timestamp))"
    not_last, not_two = "t.row_id <> last", "t.row_id <> last and t.row_id <> second"
    return per_user.selectExpr(
        "user_id",
        f"{latest.format(not_last)} as max_time_stamp2",
        f"{latest.format(not_two)} as max_time_stamp3",
    )


def last_elapsed(log: DataFrame, means: DataFrame) -> DataFrame:
    """Per user: the elapsed time of the last row, filled by the mean."""
    last = answered(log).groupBy("user_id").agg(F.max_by(_ELAPSED, "row_id").alias("last"))
    return last.crossJoin(F.broadcast(means)).selectExpr(
        "user_id", f"coalesce(last, elapsed_mean) as {_ELAPSED}"
    )


def explanation_totals(log: DataFrame) -> DataFrame:
    """Per user: explanations seen (``sum``) and answers (``count``)."""
    return answered(log).groupBy("user_id").agg(
        F.sum(_EXPLAINED).alias("sum"), F.count(_EXPLAINED).alias("count")
    )
