"""Lecture rows of the log and each user's lecture profile."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlog import schemas
from learnlog.functions.columns import is_lecture, lecture_type
from learnlog.operators.history import replaced
from learnlog.sources.tables import materialize


def lecture_rows(log: DataFrame) -> DataFrame:
    return log.where(is_lecture())


def normalize_types(lectures: DataFrame) -> DataFrame:
    return replaced(lectures, {"type_of": lecture_type()})


def one_hot(lectures: DataFrame) -> DataFrame:
    """0/1 columns per part and per type, from the fixed lists of categories."""
    tests = {f"part_{p}": f"part = {p}" for p in schemas.LECTURE_PARTS}
    tests |= {f"type_of_{t}": f"type_of = '{t}'" for t in schemas.LECTURE_TYPES}
    flags = [f"coalesce(cast({test} as int), 0) as {name}" for name, test in tests.items()]
    kept = [c for c in lectures.columns if c not in ("part", "type_of")]
    return normalize_types(lectures).selectExpr(*kept, *flags)


def join_lectures(log: DataFrame, lectures: DataFrame) -> DataFrame:
    """Every lecture row with its lecture's flags; NULL flags without a lecture."""
    return lecture_rows(log).join(
        one_hot(lectures), F.expr("content_id = lecture_id"), "left"
    )


def lecture_profile(log: DataFrame, lectures: DataFrame) -> DataFrame:
    """Per user with a lecture: was each part and type ever watched (0/1).

    Rows are reduced to distinct (user, lecture) before the join, so a lecture
    that holds most of the rows is not shuffled row by row. The distinct pairs
    are written: the join then knows their size as well as the lectures'.
    """
    watched = materialize(
        lecture_rows(log).select("user_id", "content_id").distinct(), "watched-lectures"
    )
    joined = watched.join(one_hot(lectures), F.expr("content_id = lecture_id"), "left")
    return joined.groupBy("user_id").agg(
        *[F.expr(f"coalesce(max({c}), 0) as {c}") for c in schemas.LECTURE_FLAGS]
    )
