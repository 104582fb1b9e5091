import logs
import pytest

from learnlog import schemas
from learnlog.operators import encodings, history, lectures, questions
from learnlog.plans import matrix


def question_table(spark, rows):
    return spark.createDataFrame(rows, "question_id long, bundle_id long, part int, tags string")


QUESTIONS = [
    (10, 1, 1, "0 31 32 191"),  # tags on band edges
    (11, 1, 1, None),
    (12, 2, 2, "5 5 3"),  # order and duplicates kept
    (13, 2, 2, "160"),
    (14, 3, 2, "40 2"),
    (99, 4, 3, "7"),  # never answered
]


def test_tag_bands(spark):
    rows = questions.tag_bands(question_table(spark, QUESTIONS)).collect()
    bands = {r["question_id"]: [r[c] for c in schemas.TAG_COLUMNS] for r in rows}
    assert bands[10] == ["0 31", "32", "", "", "", "191"]
    assert bands[11] == ["", "", "", "", "", "188"]
    assert bands[12] == ["5 5 3", "", "", "", "", ""]
    assert bands[14] == ["2", "40", "", "", "", ""]


def test_label_codes_are_ranks_of_sorted_values(spark):
    words = ["b", "", "a", "10", "9", "b", "é", "Z", None] * 3
    df = spark.createDataFrame([(i, w, w) for i, w in enumerate(words)], "id int, x string, y string")
    order = {w: i for i, w in enumerate(sorted({w for w in words if w is not None}))}
    for r in questions.label_encode(df, ["x", "y"]).collect():
        assert r["x"] == r["y"] == order.get(words[r["id"]])


def test_question_features(spark):
    log = logs.frame(spark, logs.edge_cases())
    communities = spark.createDataFrame([(10, 7)], "question_id long, community int")
    encoded = matrix.fit(log, question_table(spark, QUESTIONS), communities)
    rows = {r["content_id"]: r for r in encoded.questions.collect()}
    assert encoded.questions.columns == schemas.QUESTION_COLUMNS
    assert len(rows) == len(QUESTIONS)

    ten = rows[10]  # answered 1, 0, 1, 0, 1, 1
    assert (ten["content_correct_count"], ten["content_uncorrect_count"]) == (4, 2)
    assert ten["content_correctness"] == pytest.approx(4 / 6)
    assert ten["content_correctness_std"] == pytest.approx(4 / 15)  # sample variance
    assert ten["part_bundle_id"] == 100001 and ten["community"] == 7
    assert ten["content_sub_bundle"] == 2

    once = rows[13]  # one answer: no variance; only with an explanation
    assert once["content_correctness_std"] is None
    assert once["content_explation_false_mean"] is None
    assert once["content_explation_true_mean"] == 0.0

    never = rows[99]
    assert never["content_correctness"] is None and never["content_correct_count"] is None
    assert never["part_correctness_mean"] is None
    assert (never["part_cor_count"], never["part_uncor_count"]) == (0, 0)

    rates = [rows[i]["content_correctness"] for i in (12, 13, 14)]  # part 2, unweighted
    mean = sum(rates) / 3
    assert ten["bundle_correctness_mean"] == pytest.approx((4 / 6 + 1) / 2)
    assert rows[12]["part_correctness_mean"] == pytest.approx(mean)
    assert rows[12]["part_correctness_std"] == pytest.approx(
        sum((r - mean) ** 2 for r in rates) / 2
    )


def test_seen_only_keeps_answered_questions(spark):
    log = logs.frame(spark, logs.edge_cases())
    communities = spark.createDataFrame([], "question_id long, community int")
    table = question_table(spark, QUESTIONS)
    whole = {r["content_id"]: r for r in matrix.fit(log, table, communities).questions.collect()}
    seen = matrix.fit(log, table, communities, seen_only=True).questions.collect()
    assert {r["content_id"]: r for r in seen} == {k: v for k, v in whole.items() if k != 99}


def test_container_variance_of_one_row_is_missing(spark):
    sums = encodings.container_sums(logs.frame(spark, logs.edge_cases()))
    stats = encodings.container_stats(sums).collect()
    by_box = {r["task_container_id"]: r for r in stats}
    assert by_box[3]["task_container_std"] is None
    assert by_box[3]["task_container_uncor_count"] == 1
    assert by_box[0]["task_container_cor_count"] == 6


def test_lecture_profile_counts_every_lecture(spark):
    rows = [logs.row(i, 1, i, 90, None) for i in range(300)]  # beyond an 8-bit sum
    rows += [logs.row(300, 2, 0, 91, None), logs.row(301, 3, 0, 404, None), logs.row(302, 4, 0, 1, 1)]
    table = spark.createDataFrame(
        [(90, 1, 2, "solving question"), (91, 1, 7, "concept")],
        "lecture_id long, tag int, part int, type_of string",
    )
    profile = lectures.lecture_profile(logs.frame(spark, rows), table)
    flags = {r["user_id"]: r.asDict() for r in profile.collect()}
    assert sorted(flags) == [1, 2, 3]  # no lecture, no row
    assert {k for k, v in flags[1].items() if k != "user_id" and v} == {
        "part_2",
        "type_of_solving_question",
    }
    assert {k for k, v in flags[2].items() if k != "user_id" and v} == {"part_7", "type_of_concept"}
    assert not any(v for k, v in flags[3].items() if k != "user_id")  # unknown lecture
    joined = lectures.join_lectures(logs.frame(spark, rows), table)
    assert joined.count() == 302


def test_matrix_has_one_row_per_answer(spark):
    rows = logs.random_log(400, seed=11)
    log = logs.frame(spark, rows)
    table = question_table(spark, [(i, i % 2, 1 + i % 3, str(i * 40)) for i in range(5)])
    communities = spark.createDataFrame([(0, 1)], "question_id long, community int")
    result = matrix.training_matrix(log, table, communities)
    assert result.columns == ["row_id", *schemas.FEATURES, schemas.TARGET]
    answered = {r["row_id"] for r in rows if r["answered_correctly"] != -1}
    found = result.select("row_id", "content_id", "part").collect()
    assert len(found) == len(answered) and {r["row_id"] for r in found} == answered
    # Content 5 has no question row: its question features are missing.
    assert all((r["part"] is None) == (r["content_id"] == 5) for r in found)
    tuning = matrix.training_matrix(log, table, communities, schemas.FEATURES_TUNING)
    assert len(tuning.columns) == 46 and "content_correctness" not in tuning.columns


def test_fit_on_train_apply_to_valid(spark):
    rows = logs.random_log(300, seed=2)
    train = logs.frame(spark, [r for r in rows if r["user_id"] % 2 == 0])
    valid = logs.frame(spark, [r for r in rows if r["user_id"] % 2 == 1])
    table = question_table(spark, [(i, 1, 1, "1") for i in range(6)])
    communities = spark.createDataFrame([(0, 1)], "question_id long, community int")
    encoded = matrix.fit(train, table, communities)
    result = matrix.training_matrix(valid, table, communities, encodings=encoded)
    expected = {
        r["content_id"]: r["content_correct_count"] for r in encoded.questions.collect()
    }
    for r in result.select("content_id", "content_correct_count").collect():
        assert r["content_correct_count"] == expected[r["content_id"]]
    assert result.count() == valid.where("answered_correctly <> -1").count()


def test_encodings_of_an_empty_log_keep_the_rows(spark):
    log = logs.frame(spark, logs.edge_cases())
    table = question_table(spark, QUESTIONS)
    communities = spark.createDataFrame([(10, 7)], "question_id long, community int")
    encoded = matrix.fit(log.where("false"), table, communities)
    result = matrix.training_matrix(log, table, communities, encodings=encoded)
    assert result.count() == log.where("answered_correctly <> -1").count()
    assert matrix.training_matrix(log.where("false"), table, communities).count() == 0


def test_one_scan_gives_the_same_sums(spark):
    log = logs.frame(spark, logs.random_log(300, seed=8))
    contents, containers, overall = encodings.split_sums(encodings.log_sums(log))
    for one, apart in (
        (contents, encodings.content_sums(log)),
        (containers, encodings.container_sums(log)),
        (overall, history.overall_sums(log)),
    ):
        assert one.columns == apart.columns
        rows, others = (sorted(map(tuple, df.collect()), key=lambda r: r[0]) for df in (one, apart))
        assert len(rows) == len(others)
        for row, other in zip(rows, others):
            assert row == pytest.approx(other)
