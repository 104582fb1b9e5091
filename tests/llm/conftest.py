import __spark_entry__
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    __spark_entry__.send_package(spark)


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs, empty, blank and very long texts, repeated rows, ties, and columns with the
    names of results."""
    good = "The cat and the dog sat on the mat of the old house, and it was good to be there. "
    rows = [
        (1, good * 3, "en", 1.5),
        (2, None, "en", None),
        (None, good, None, 0.0),
        (3, "", "de", None),
        (4, " \n\t\n ", None, None),
        (5, good * 3, "en", 2.0),
        (5, good * 3, "en", 2.0),
        (6, ("Der Hund und die Katze saßen auf der Matte. " * 4000) + "é中😀▁", "de", None),
        (7, "one", "en", None),
        (None, None, None, None),
        (8, "12 34 !!! \x00 ...", "fr", None),
        (9, "Le chien et le chat sont sur le tapis de la maison. " * 5, "fr", None),
    ]
    schema = "doc_id bigint, text string, lang string, score double"
    clashing = "n_words int, ids int, label int, run int, digest string, items int, spans int"
    frame = spark.createDataFrame(rows, schema)
    for column in clashing.split(", "):
        name, kind = column.split(" ")
        frame = frame.selectExpr("*", f"cast(null as {kind}) as {name}")
    return frame


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 1, 0), (3, 0, 0), (5, 1, 1), (6, 1, 0), (7, 0, 1), (9, 1, 0), (None, 1, 1), (8, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def benchmark(spark):
    words = "and it was good to be there the cat and the dog"
    rows = [(10, words), (11, "one"), (None, "saßen auf der matte"), (12, None), (13, ""), (10, words)]
    return spark.createDataFrame(rows, "item_id bigint, text string")
