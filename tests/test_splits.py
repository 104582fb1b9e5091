import hashlib

import brute
import logs
import pytest
from pyspark.sql import functions as F

from learnlog.operators import metrics, ordered, splits


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(3000).selectExpr("id as row_id", "id % 97 as user_id")
    return df.cache()


@pytest.mark.parametrize("n", [0, 1, 777, 3000, 5000])
def test_sample_n_is_exact(spark, rows, n):
    drawn = {
        i: hashlib.md5(f"5:rows:{i}".encode()).hexdigest() for i in range(3000)
    }
    expected = sorted(drawn, key=lambda i: (drawn[i], i))[:n]
    sample = [r["row_id"] for r in splits.sample_n(rows, n, seed=5).collect()]
    assert sorted(sample) == sorted(expected)


@pytest.mark.parametrize("digits, ranked", [(1, 1), (1, 60), (2, 3), (3, 1)])
def test_cut_by_more_digits(spark, rows, monkeypatch, digits, ranked):
    """Prefixes are counted again until few rows are left, also where one ends at the cut."""
    monkeypatch.setattr(splits, "DIGITS", digits)
    monkeypatch.setattr(splits, "MOST_RANKED", ranked)
    draws = sorted((hashlib.md5(f"5:rows:{i}".encode()).hexdigest(), i) for i in range(3000))
    at_end = sum(d < "5" for d, _ in draws)  # the last row whose draw starts with a 4
    for n in (1, at_end, at_end + 1, 2999):
        sample = [r["row_id"] for r in splits.sample_n(rows, n, seed=5).collect()]
        assert sorted(sample) == sorted(i for _, i in draws[:n])
    folds = splits.repeated_folds(rows, seed=5, folds=2, n=at_end)
    first = [r["row_id"] for r in folds.where("fold = 0").collect()]
    assert sorted(first) == sorted(i for _, i in draws[:at_end])
    assert folds.where("fold = 1").count() == at_end


def test_equal_draws_are_cut_by_id(spark):
    ids = spark.createDataFrame([("ab" * 16, i) for i in range(50)], "draw string, id long")
    assert splits._cuts(ids, 20, []) == {(): ("ab" * 16, 19)}
    assert splits._cuts(ids, 50, []) == {}


def test_sample_of_nothing(spark, rows):
    assert splits.sample_n(rows.where("false"), 10, seed=1).count() == 0


def test_shares_are_close_and_seeded(spark, rows):
    some = splits.sample_rows(rows, 0.1, seed=1)
    assert 200 < some.count() < 400
    assert some.collect() == splits.sample_rows(rows, 0.1, seed=1).collect()
    assert some.collect() != splits.sample_rows(rows, 0.1, seed=2).collect()
    assert splits.sample_rows(rows, 1.0, seed=1).count() == 3000
    assert splits.sample_rows(rows, 0.0, seed=1).count() == 0


def test_split_keeps_held_out_users_out_of_training(spark, rows):
    split = splits.holdout_split(rows, seed=3, n=2500, user_share=0.2).collect()
    assert len(split) == 2500 and len({r["row_id"] for r in split}) == 2500
    new_users = {r["user_id"] for r in split if r["valid_kind"] == "new_user"}
    train_users = {r["user_id"] for r in split if r["split"] == "train"}
    assert new_users and not new_users & train_users
    assert {r["valid_kind"] for r in split if r["split"] == "train"} == {None}
    held_out = {r["user_id"] for r in splits.sample_users(rows, 0.2, seed=3).collect()}
    assert new_users <= held_out


def test_joins_by_identity_agree_with_the_predicates(spark, rows):
    users = splits.sample_users(rows, 0.2, seed=3)
    kept = splits.rows_of_users(rows, users)
    rest = splits.drop_rows(rows, kept)
    assert kept.count() + rest.count() == 3000
    marked = splits.holdout_split(rows, seed=3, user_share=0.2)
    assert kept.count() == marked.where("valid_kind = 'new_user'").count()
    union = splits.valid_union(rest.where("row_id < 50"), kept)
    assert union.count() == rest.where("row_id < 50").count() + kept.count()


def test_folds_are_the_splits_of_consecutive_seeds(spark, rows):
    folds = splits.repeated_folds(rows, seed=10, folds=3, n=1200)
    for i in range(3):
        one = splits.holdout_split(rows, seed=10 + i, n=1200)
        columns = ["row_id", "split", "valid_kind"]
        fold = folds.where(F.col("fold") == i).select(*columns)
        assert sorted(map(str, fold.collect())) == sorted(map(str, one.select(*columns).collect()))
    counts = splits.split_counts(folds).collect()
    assert len(counts) == 6 and sum(r["rows"] for r in counts) == 3600


def test_folds_at_the_edges(spark, rows):
    assert splits.repeated_folds(rows, seed=1, folds=2, n=0).collect() == []
    for folds in (0, -1):
        with pytest.raises(ValueError):
            splits.repeated_folds(rows, seed=1, folds=folds)


def test_samples_cut_from_ids(spark, rows):
    ids = rows.select("row_id")
    assert (
        splits.sample_n(rows, 777, seed=5, ids=ids).collect()
        == splits.sample_n(rows, 777, seed=5).collect()
    )


def test_marks_cover_all_rows(spark, rows):
    marked = splits.mark_holdout(rows, 3).collect()
    assert len(marked) == 3000
    assert sorted(map(str, marked)) == sorted(map(str, splits.holdout_split(rows, 3).collect()))


@pytest.mark.parametrize("partitions", ["1", "4"])
def test_running_totals(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(500).selectExpr("id % 3 as g", "(id * 7919) % 500 as o", "id % 5 as x")
        result = ordered.running_totals(df, ["o"], ["x"], ["g"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(result) == 500
    for g in range(3):
        total = 0
        for r in sorted((r for r in result if r["g"] == g), key=lambda r: r["o"]):
            assert r["before_x"] == total
            total += r["x"]


def test_auc(spark):
    log = [(r["prior_question_elapsed_time"] or 0.0, r["answered_correctly"], r["user_id"]) for r in
           logs.random_log(300) if r["answered_correctly"] != -1]
    scores = [(round(s, -4), y) for s, y, _ in log]  # many ties
    df = spark.createDataFrame(
        [(*p, u) for p, (_, _, u) in zip(scores, log)], "score double, answered_correctly int, fold int"
    )
    assert metrics.roc_auc(df).first()["auc"] == pytest.approx(brute.auc(scores))
    for r in metrics.roc_auc(df, within=["fold"]).collect():
        mine = [p for p, (_, _, u) in zip(scores, log) if u == r["fold"]]
        assert r["auc"] == pytest.approx(brute.auc(mine))


def test_auc_of_one_class_is_missing(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, answered_correctly int")
    assert metrics.roc_auc(df).first()["auc"] is None
    assert metrics.roc_auc(df.where("false")).first()["auc"] is None


def test_auc_agrees_with_the_built_in_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = spark.range(2000).selectExpr(
        "(id * 7919 % 2000) / 2000 as score", "int(id % 3 = 0 or id % 7 < 2) as answered_correctly"
    )
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="answered_correctly", numBins=0
    )
    assert metrics.roc_auc(df).first()["auc"] == pytest.approx(evaluator.evaluate(df), abs=1e-9)
