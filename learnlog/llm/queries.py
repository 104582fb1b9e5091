"""The operators' queries over the given tables, with production parameters."""

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from learnlog.llm import (
    decontaminate,
    fill_in_middle,
    html_blocks,
    language_kn,
    lexical,
    licenses,
    line_dedup,
    oracle,
    pieces,
    quality_crf,
    simhash,
    sketches,
    token_records,
    toxicity,
)
from learnlog.llm.shared import crc_part, documents, new_folder, table


def op1_token_records(spark: SparkSession, d: str) -> DataFrame:
    folder = new_folder(spark, "token-records")
    path = public_tokenizers.path("word_bpe_49k.json")
    token_records.write(documents(spark, d), folder, path, end_id=2)
    return token_records.read(spark, folder).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def _scored(rows: DataFrame, modulus: int, held_out: int) -> DataFrame:
    return rows.select(
        "doc_id",
        F.coalesce(crc_part(modulus) == held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_quality_crf(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    model = quality_crf.fit(docs, table(spark, d, "labels"), modulus=3, held_out=1)
    return _scored(quality_crf.score(docs, model), 3, 1)


def op3_language_kn(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    model = language_kn.fit(docs, modulus=4, held_out=2)
    return language_kn.identify(docs, model).select(
        "doc_id",
        F.coalesce(crc_part(4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        "rejected",
    )


def op4_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    model = toxicity.fit(docs, table(spark, d, "labels"), modulus=5, held_out=0)
    return _scored(toxicity.score(docs, model), 5, 0)


def op5_sketches(spark: SparkSession, d: str) -> DataFrame:
    rows = sketches.with_next(documents(spark, d))
    n = F.char_length("text")
    tail = F.floor(n / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - tail), F.substring("next_text", F.lit(1), tail)
    )
    rows = rows.select(
        "doc_id", n.cast("bigint").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited")
    )
    rows = rows.withColumn("edited_sketch", sketches.sketch("edited"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketches.fingerprint("sketch").alias("fingerprint"),
        sketches.fingerprint("edited_sketch").alias("edited_fingerprint"),
        sketches.resemblance("sketch", "edited_sketch").alias("near_edited"),
        sketches.resemblance("sketch", "next_sketch").alias("near_next"),
    )


def op6_licenses(spark: SparkSession, d: str) -> DataFrame:
    return licenses.summary(documents(spark, d))


def op7_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.groups(documents(spark, d)).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op8_pieces(spark: SparkSession, d: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.round_trip(documents(spark, d), path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_html_blocks(spark: SparkSession, d: str) -> DataFrame:
    found = html_blocks.extract(table(spark, d, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op10_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    found = decontaminate.scan(documents(spark, d), table(spark, d, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.hit_words().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def _sha256(column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def op11_fill_in_middle(spark: SparkSession, d: str) -> DataFrame:
    made = fill_in_middle.transform(documents(spark, d))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        _sha256(F.col("output")).alias("output_sha256"),
        _sha256(fill_in_middle.restored()).alias("restored_sha256"),
    )


def op12_lexical_search(spark: SparkSession, d: str) -> DataFrame:
    index = lexical.build(documents(spark, d), new_folder(spark, "lexical"))
    return lexical.search(spark, index, table(spark, d, "benchmark"))


def op13_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = line_dedup.drop_lines(documents(spark, d))
    return rows.select("doc_id", "n_lines", "n_dropped", _sha256(F.col("kept")).alias("kept_sha256"))


def queries() -> dict:
    return {
        "op1_token_records": op1_token_records,
        "op2_quality_crf": op2_quality_crf,
        "op3_language_kn": op3_language_kn,
        "op4_toxicity": op4_toxicity,
        "op5_sketches": op5_sketches,
        "op6_licenses": op6_licenses,
        "op7_simhash": op7_simhash,
        "op8_pieces": op8_pieces,
        "op9_html_blocks": op9_html_blocks,
        "op10_decontaminate": op10_decontaminate,
        "op11_fill_in_middle": op11_fill_in_middle,
        "op12_lexical_search": op12_lexical_search,
        "op13_line_dedup": op13_line_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.statements()
