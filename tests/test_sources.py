import logs
import pytest

from learnlog.sources import readers, sinks, tables

LOG_HEADER = (
    "row_id,timestamp,user_id,content_id,content_type_id,task_container_id,user_answer,"
    "answered_correctly,prior_question_elapsed_time,prior_question_had_explanation\n"
)


def test_csv_files(spark, tmp_path):
    (tmp_path / "train.csv").write_text(
        LOG_HEADER + "0,0,115,5692,0,1,3,1,,\n1,56943,115,5716,0,2,2,1,37000.0,False\n"
        "2,118363,115,128,1,0,-1,-1,,True\n"
    )
    rows = readers.read_interactions(spark, str(tmp_path / "train.csv"), "csv").collect()
    assert [r["answered_correctly"] for r in rows] == [1, 1, -1]
    assert rows[0]["prior_question_elapsed_time"] is None
    assert rows[0]["prior_question_had_explanation"] is None
    assert rows[1]["prior_question_had_explanation"] is False
    assert "user_answer" not in rows[0].asDict()

    (tmp_path / "questions.csv").write_text(
        "question_id,bundle_id,correct_answer,part,tags\n0,0,0,1,51 131 162 38\n1,1,1,1,\n"
    )
    table = readers.read_questions(spark, str(tmp_path / "questions.csv"), "csv")
    assert [tuple(r) for r in table.collect()] == [(0, 0, 1, "51 131 162 38"), (1, 1, 1, None)]

    (tmp_path / "lectures.csv").write_text("lecture_id,tag,part,type_of\n89,159,5,solving question\n")
    table = readers.read_lectures(spark, str(tmp_path / "lectures.csv"), "csv")
    assert tuple(table.first()) == (89, 159, 5, "solving question")

    (tmp_path / "question_cmnts.csv").write_text(",question_id,community\n0,12,3\n")
    table = readers.read_communities(spark, str(tmp_path / "question_cmnts.csv"), "csv")
    assert tuple(table.first()) == (12, 3)


def test_a_reordered_csv_fails(spark, tmp_path):
    (tmp_path / "q.csv").write_text("bundle_id,question_id,correct_answer,part,tags\n0,0,0,1,5\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_questions(spark, str(tmp_path / "q.csv"), "csv").collect()


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_other_formats(spark, tmp_path, fmt):
    log = logs.frame(spark, logs.edge_cases())
    log.write.format(fmt).save(str(tmp_path / "log"))
    back = readers.read_interactions(spark, str(tmp_path / "log"), fmt)
    assert back.columns == log.columns
    assert sorted(map(str, back.collect())) == sorted(map(str, log.collect()))


def test_features_are_written_by_fold_and_split(spark, tmp_path):
    df = spark.createDataFrame([(0, "train", 1), (0, "valid", 2), (1, "train", 3)], "fold int, split string, x int")
    sinks.write_features(df, str(tmp_path / "out"), ["fold", "split"])
    assert (tmp_path / "out" / "fold=0" / "split=valid").is_dir()
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.where("fold = 1").select("x").collect() == [(3,)]
    sinks.write_features(df.where("fold = 1"), str(tmp_path / "out"), ["fold", "split"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_tables_go_to_the_shared_folder(spark):
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert tables.shared_folder(spark) == folder
    table = tables.materialize(spark.range(5).toDF("x"), "five")
    assert table.schema.names == ["x"] and table.count() == 5
    assert all(folder in path for path in table.inputFiles())
    empty = tables.materialize(spark.range(0).toDF("x"), "none")
    assert empty.count() == 0
