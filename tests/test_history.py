import brute
import logs
import pytest

from learnlog.operators import history, ordered
from learnlog.plans import matrix

FEATURES = [
    "timestamp",
    "prior_question_elapsed_time",
    "prior_question_had_explanation",
    "user_interaction_count",
    "user_interaction_timestamp_mean",
    "user_lecture_sum",
    "user_lecture_lv",
    "attempt_no",
    "lagtime",
    "lagtime2",
    "lagtime3",
    "delta_prior_question_elapsed_time",
    "user_correctness",
    "user_correct_count",
    "user_uncorrect_count",
    "explanation_mean",
    "explanation_true_count",
    "explanation_false_count",
]
PLAIN = ordered.DEFAULT_LIMITS
# Every user above two rows is heavy and cut into slices of at most five rows.
SLICED = ordered.SliceLimits(min_rows=2, max_users=1000, slice_rows=5)
# Only the largest user is heavy.
MIXED = ordered.SliceLimits(min_rows=120, max_users=1000, slice_rows=64)


def features(spark, rows, limits):
    log = logs.frame(spark, rows)
    runs = history.user_runs(log, limits)
    result = history.history(runs, matrix.fit_means(runs))
    return {r["row_id"]: r.asDict() for r in result.collect()}


@pytest.mark.parametrize("limits", [PLAIN, SLICED, MIXED], ids=["plain", "sliced", "mixed"])
@pytest.mark.parametrize("rows", [logs.edge_cases(), logs.random_log()], ids=["edges", "random"])
def test_history_equals_row_by_row(spark, rows, limits):
    expected = brute.history(rows)
    actual = features(spark, rows, limits)
    assert actual.keys() == expected.keys()
    for row_id, row in expected.items():
        for name in FEATURES:
            assert actual[row_id][name] == pytest.approx(row[name], rel=1e-9), (row_id, name)


@pytest.mark.parametrize("limits", [SLICED, MIXED], ids=["sliced", "mixed"])
def test_slices_change_nothing(spark, limits):
    log = logs.frame(spark, logs.random_log(900, seed=5))
    for build in (history.interaction_counts, history.user_runs):
        plain = build(log, PLAIN)
        sliced = build(log, limits).select(*plain.columns)
        assert sorted(map(str, plain.collect())) == sorted(map(str, sliced.collect()))


def test_slices_are_bounded_and_cover_the_log(spark):
    log = logs.frame(spark, logs.random_log())
    ordinary, sliced = ordered.split_heavy(log, MIXED)
    assert [r["user_id"] for r in sliced.select("user_id").distinct().collect()] == [0]
    assert ordinary.count() + sliced.count() == log.count()
    largest = sliced.groupBy("user_id", ordered.SLICE).count().agg({"count": "max"}).first()[0]
    assert largest <= MIXED.slice_rows


def _ids(kind):
    """Row ids of one user among those of others."""
    return {
        "interleaved": [7 * i for i in range(2000)],
        "clustered": [i * 10**9 + j for i in range(20) for j in range(100)],
        "one far away": [*range(1999), 10**15],
        "squares": [i * i for i in range(2000)],
        "few": list(range(90)),
    }[kind]


@pytest.mark.parametrize("slice_rows", [64, 101, 1])
@pytest.mark.parametrize("kind", ["interleaved", "clustered", "one far away", "squares", "few"])
def test_slices_are_balanced(spark, kind, slice_rows):
    ids = _ids(kind)
    rows = [(i, 1) for i in ids] + [(max(ids) + 1 + i, 2 + i) for i in range(500)]
    log = spark.createDataFrame(rows, "row_id long, user_id long")
    limits = ordered.SliceLimits(min_rows=80, max_users=100_000, slice_rows=slice_rows)
    ordinary, sliced = ordered.split_heavy(log, limits)
    assert ordinary.count() == 500
    found = sorted((r[ordered.SLICE], r["row_id"]) for r in sliced.collect())
    assert [i for _, i in found] == sorted(ids)  # slices ascend with the ids
    sizes = [list(s for s, _ in found).count(k) for k in sorted({s for s, _ in found})]
    assert max(sizes) <= slice_rows
    if slice_rows > 1:
        assert min(sizes[:-1], default=slice_rows) >= slice_rows // 2


def test_interleaved_heavy_users_change_nothing(spark):
    """Two heavy users whose ids alternate with those of many others."""
    rows = logs.random_log(900, seed=6)
    for i, r in enumerate(rows):
        r["user_id"] = 1 if i % 3 == 0 else 2 if i % 7 == 1 else 100 + i % 50
        r["row_id"] = 10 * r["row_id"]
    log = logs.frame(spark, rows)
    limits = ordered.SliceLimits(min_rows=80, max_users=100_000, slice_rows=40)
    _, sliced = ordered.split_heavy(log, limits)
    per_slice = sliced.groupBy("user_id", ordered.SLICE).count().collect()
    assert {r["user_id"] for r in per_slice} == {1, 2} and len(per_slice) < 20
    for build in (history.interaction_counts, history.user_runs):
        plain = build(log, PLAIN)
        cut = build(log, limits).select(*plain.columns)
        assert sorted(map(str, plain.collect())) == sorted(map(str, cut.collect()))


def test_slice_without_answers_keeps_the_older_tail(spark):
    rows = [logs.row(i, 1, i * 10, 1, 1 if i < 4 else None) for i in range(20)]
    rows += [logs.row(20 + i, 1, 1000 + i, 1, 0) for i in range(5)]
    expected = brute.history(rows)
    actual = features(spark, rows, ordered.SliceLimits(min_rows=2, slice_rows=4))
    for row_id, row in expected.items():
        for name in ("lagtime", "lagtime2", "lagtime3", "user_correct_count", "attempt_no"):
            assert actual[row_id][name] == pytest.approx(row[name]), (row_id, name)


def test_single_rows_leave_gaps_missing(spark):
    rows = [logs.row(i, i, 100, 1, i % 2) for i in range(3)]
    for row in features(spark, rows, PLAIN).values():
        assert row["lagtime"] is None and row["delta_prior_question_elapsed_time"] is None
        assert row["user_correctness"] == 0.67
        assert (row["user_correct_count"], row["user_uncorrect_count"]) == (0, 0)


def test_empty_log(spark):
    log = logs.frame(spark, [])
    runs = history.user_runs(log)
    assert history.history(runs, matrix.fit_means(runs)).count() == 0


@pytest.mark.parametrize("limits", [PLAIN, MIXED], ids=["plain", "mixed"])
def test_global_means_equal_the_windowed_means(spark, limits):
    log = logs.frame(spark, logs.random_log(500, seed=9))
    means = history.global_means(log, limits).first()
    gaps = history.user_runs(log).selectExpr(
        *[f"avg(timestamp - _ts{k}) as {name}" for k, name in history.LAGS.items()]
    )
    for name, value in gaps.first().asDict().items():
        assert means[f"{name}_mean"] == pytest.approx(value)
    rows = [r for r in brute.history(logs.random_log(500, seed=9)).values()]
    assert means["elapsed_mean"] == pytest.approx(
        sum(r["prior_question_elapsed_time"] for r in rows) / len(rows)
    )


def test_counts_balance_and_never_look_ahead(spark):
    rows = logs.random_log(300, seed=3)
    before = features(spark, rows, PLAIN)
    runs = history.user_runs(logs.frame(spark, rows))
    for row in runs.select("row_id", "_position").collect():
        mine = before[row["row_id"]]
        assert mine["user_correct_count"] + mine["user_uncorrect_count"] == row["_position"] - 1
    last = max(r["row_id"] for r in rows if r["answered_correctly"] != -1)
    changed = [
        {**r, "answered_correctly": 1 - r["answered_correctly"]} if r["row_id"] == last else r
        for r in rows
    ]
    after = features(spark, changed, PLAIN)
    for name in ("user_correct_count", "user_uncorrect_count", "user_correctness"):
        assert all(before[i][name] == after[i][name] for i in before)


def test_attempts_reach_their_totals(spark):
    log = logs.frame(spark, logs.random_log())
    highest = history.user_runs(log).groupBy("user_id", "content_id").agg({"attempt_no": "max"})
    totals = history.attempt_totals(log)
    assert sorted(map(tuple, highest.collect())) == sorted(map(tuple, totals.collect()))
    assert all(r["sum"] > 1 for r in history.repeat_attempts(log).collect())


def test_state_tables(spark):
    log = logs.frame(spark, logs.edge_cases())
    previous = {r["user_id"]: r for r in history.previous_timestamps(log).collect()}
    assert (previous[1]["max_time_stamp2"], previous[1]["max_time_stamp3"]) == (None, None)
    assert (previous[2]["max_time_stamp2"], previous[2]["max_time_stamp3"]) == (0, None)
    assert (previous[3]["max_time_stamp2"], previous[3]["max_time_stamp3"]) == (1000, 1000)
    last = {r["user_id"]: r[1] for r in history.last_timestamps(log).collect()}
    assert last == {1: 0, 2: 5000, 3: 12000, 5: 90}
    means = history.global_means(log)
    elapsed = {r["user_id"]: r[1] for r in history.last_elapsed(log, means).collect()}
    assert elapsed[3] == 900.0
    assert elapsed[5] == pytest.approx(means.first()["elapsed_mean"])  # missing, so filled
    lectures = {r["user_id"]: (r["sum"], r["count"]) for r in history.lecture_totals(log).collect()}
    assert lectures[3] == (2, 5) and lectures[4] == (2, 2) and lectures[1] == (0, 1)
    explained = {r["user_id"]: (r["sum"], r["count"]) for r in history.explanation_totals(log).collect()}
    assert explained[3] == (1, 3) and 4 not in explained


@pytest.mark.parametrize("bad", [{"max_users": 0}, {"max_users": 2_000_000}, {"slice_rows": 0}])
def test_limits_are_checked(bad):
    with pytest.raises(ValueError):
        ordered.SliceLimits(**bad)
