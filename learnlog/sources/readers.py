"""Readers for the interaction log and its dimension tables.

Every reader takes a path and a format (``csv``, ``parquet``, ``orc`` or
``json``), applies an explicit schema and returns only the columns that are
used, so the projection reaches the scan.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnlog import schemas


def _read(
    spark: SparkSession, path: str, fmt: str, layout: T.StructType, columns: list[str]
) -> DataFrame:
    if fmt == "csv":
        # The header is checked against the layout, so a file with other or
        # reordered columns fails instead of being read by position.
        df = spark.read.schema(layout).csv(path, header=True, enforceSchema=False)
        return df.select(*columns)
    if fmt == "json":
        wanted = T.StructType([layout[name] for name in columns])
        return spark.read.schema(wanted).json(path)
    df = spark.read.format(fmt).load(path)
    return df.select(*[F.col(name).cast(layout[name].dataType).alias(name) for name in columns])


def read_interactions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, fmt, schemas.INTERACTION_FILE, schemas.INTERACTION_COLUMNS)


def read_lectures(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    columns = ["lecture_id", "tag", "part", "type_of"]
    return _read(spark, path, fmt, schemas.LECTURE_FILE, columns)


def read_questions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    columns = ["question_id", "bundle_id", "part", "tags"]
    return _read(spark, path, fmt, schemas.QUESTION_FILE, columns)


def read_communities(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The first CSV column is an unnamed position and is checked by nothing."""
    columns = ["question_id", "community"]
    if fmt == "csv":
        df = spark.read.schema(schemas.COMMUNITY_FILE).csv(path, header=True)
        return df.select(*columns)
    return _read(spark, path, fmt, schemas.COMMUNITY_FILE, columns)
