"""The corpus pipeline: documents to clean, distinct, encoded documents, in five stages.

Every stage reads what the stage before it wrote, decides on all of it, and passes on
the documents that it keeps with all their columns; the last one gives the ids.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnlog.llm import decontaminate, language_kn, pieces, quality_crf, simhash
from learnlog.llm.shared import documents, table
from learnlog.sources.tables import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field finds good; it learns from their labels."""
    return quality_crf.keep_good(docs, quality_crf.fit(docs, table(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus has; the models learn from what is left of it."""
    return language_kn.keep_known(docs, language_kn.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: fingerprints of 3-word shingles, linked within 3 bits."""
    return simhash.keep_one(docs)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the ids as little-endian unsigned 32-bit integers, and what they decode to."""
    rows = pieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("contamination", contamination),
    ("encoding", encoding),
]

#: The stages learn models and hash as DuckDB cannot; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what the others keep is written to the shared folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
