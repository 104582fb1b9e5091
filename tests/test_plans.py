"""What the planner does with the operators."""

import re

import logs
import pytest

from learnlog.operators import encodings, history, metrics, ordered, splits
from learnlog.plans import catalog, matrix
from learnlog.sources import fixtures

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    """The executed plan, with the decisions taken at run time."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def exchanges(plan, key):
    return len(re.findall(rf"(?<!Reused)Exchange hashpartitioning\({key}", plan))


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "log")
    logs.frame(spark, logs.random_log(500)).write.parquet(path)
    return spark.read.parquet(path)


def test_history_shuffles_once(log):
    plan = plan_of(history.user_runs(log))
    assert exchanges(plan, "user_id") == 1
    assert plan.count("Exchange") == 1


def test_matrix_shuffles_the_log_once(spark):
    plan = plan_of(catalog.training_matrix(spark, SF_DIR))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "SortMergeJoin" not in plan and "BatchEvalPython" not in plan


def test_answered_filter_stays_above_the_counts(log):
    plan = plan_of(history.user_runs(log))
    lines = plan.splitlines()
    windows = [i for i, line in enumerate(lines) if "Window [" in line]
    filters = [i for i, line in enumerate(lines) if "Filter" in line and "answered_correctly" in line]
    assert filters and windows[0] < filters[0] < windows[-1]


def test_unused_windows_and_columns_are_pruned(log):
    plan = plan_of(history.user_runs(log).select("row_id", "attempt_no"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "timestamp" not in schema and "elapsed" not in schema
    assert "lag(" not in plan


def test_filters_reach_the_scan(log):
    plan = plan_of(history.answered(log).select("row_id"))
    assert re.search(r"PushedFilters: \[.*answered_correctly", plan)
    assert "user_id" not in re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)


def test_means_sort_nothing_before_the_shuffle(log):
    plan = plan_of(history.global_means(log))
    assert exchanges(plan, "user_id") == 1
    before = plan.split("Exchange hashpartitioning(user_id")[1]
    assert "Sort [" not in before and "Generate" not in before
    columns = re.search(r"FileScan parquet \[([^\]]*)\]", before).group(1)
    assert "content_id" not in columns and "explanation" not in columns


def test_one_scan_for_all_sums(log):
    assert plan_of(encodings.log_sums(log)).count("FileScan") == 1


def test_samples_do_not_shuffle_the_rows(log):
    assert "Exchange hashpartitioning" not in plan_of(splits.sample_rows(log, 0.1, 1))
    plan = plan_of(splits.sample_n(log, 100, 1))
    assert "Sort [" not in plan.split("BroadcastExchange")[0]
    assert "TakeOrderedAndProject" not in plan


def test_results_do_not_depend_on_broadcasts(spark, log):
    """Without automatic broadcasts the lookups shuffle, and nothing changes."""
    questions, communities = fixtures.questions(spark, SF_DIR), fixtures.communities(spark, SF_DIR)
    usual = sorted(map(str, matrix.training_matrix(log, questions, communities).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = matrix.training_matrix(log, questions, communities)
        assert "SortMergeJoin" in plan_of(shuffled)
        assert sorted(map(str, shuffled.collect())) == usual
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_heavy_user_is_not_in_one_task(spark, log):
    limits = ordered.SliceLimits(min_rows=100, max_users=1000, slice_rows=50)
    plan = plan_of(history.user_runs(log, limits))
    assert "_slice" in plan and "LeftAnti" in plan
    for line in plan.splitlines():
        if "Exchange hashpartitioning(user_id" in line and "row_id" in line:
            # Whole rows move by user only where the heavy ones were taken out.
            assert "_slice" in line or "LeftAnti" in plan.split(line, 1)[1].split("Exchange")[0]


def test_samples_are_cut_before_the_joins(spark, tmp_path):
    """Below the sample's filter stand the windows, and no join of containers or questions."""
    log = fixtures.interactions(spark, SF_DIR)
    ids = history.answered(log).select("row_id")
    rows = matrix.fit_labelled(
        log,
        fixtures.questions(spark, SF_DIR),
        fixtures.communities(spark, SF_DIR),
        choose=lambda r: splits.repeated_folds(r, 1, folds=2, n=100, ids=ids),
    )
    lines = plan_of(rows).splitlines()
    cut = next(i for i, line in enumerate(lines) if "Filter" in line and "md5(" in line)
    joins = [i for i, line in enumerate(lines) if "Join" in line and "content_id" in line]
    assert joins and max(joins) < cut
    assert rows.count() == 200


def test_a_cut_sample_is_one_filtered_scan(log):
    """The ids are counted before; what is left is a filter by constants, without a join."""
    plan = plan_of(splits.sample_n(log, 100, 1, ids=log.select("row_id")))
    assert plan.count("FileScan") == 1 and "Join" not in plan and "Exchange" not in plan
    folds = plan_of(splits.repeated_folds(log, 1, folds=2, n=100))
    assert folds.count("FileScan") == 1 and "Join" not in folds and "Exchange" not in folds


def test_totals_within_groups_force_no_broadcast(spark, log):
    scored = log.where("answered_correctly >= 0").selectExpr(
        "user_id", "answered_correctly", "double(row_id % 50) as score"
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastExchange" not in plan_of(metrics.roc_auc(scored, within=["user_id"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_previous_times_move_few_rows(log):
    plan = plan_of(history.previous_timestamps(log))
    assert plan.count("FileScan") == 1
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning(user_id")[1]
