"""The four inputs as projections of the driver's ``events`` and ``part`` tables.

See FIXTURES.md. All four are plain projections of whole tables: no window, no
join and no aggregate, so a query's cost is the operator's own.
"""

from pyspark.sql import DataFrame, SparkSession

EPOCH_MS = 1704067200000  # 2024-01-01T00:00:00Z
ID_SHIFT = 5  # contents below it have no question and no lecture row


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    ts = "cast(ts as timestamp)"
    return events.selectExpr(
        "event_id as row_id",
        f"unix_millis({ts}) - {EPOCH_MS} as timestamp",
        "user_id",
        "cast(get_json_object(props, '$.k') as bigint) as content_id",
        "case when event_type = 'signup' then 1 else 0 end as content_type_id",
        f"cast(hour({ts}) as bigint) as task_container_id",
        "case when event_type = 'signup' then -1 when event_type in ('click', 'purchase') then 1"
        " else 0 end as answered_correctly",
        "case when value >= 2 then value * 1000 end as prior_question_elapsed_time",
        f"case when value >= 1 then minute({ts}) % 3 = 0 end as prior_question_had_explanation",
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = (
        "concat_ws(' ', cast((p_partkey * 37) % 188 as string), "
        "cast((p_partkey * 11 + p_size) % 188 as string), cast(p_size * 3 as string))"
    )
    return spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(
        f"p_partkey + {ID_SHIFT} as question_id",
        "cast(substring(p_brand, 7) as bigint) as bundle_id",
        "p_size % 7 + 1 as part",
        f"case when p_size % 10 <> 0 then {tags} end as tags",
    )


def lectures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(
        f"p_partkey + {ID_SHIFT} as lecture_id",
        "p_size as tag",
        "p_size % 7 + 1 as part",
        "case p_partkey % 4 when 0 then 'concept' when 1 then 'intention'"
        " when 2 then 'solving question' else 'starter' end as type_of",
    )


def communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet").where("p_type <> 'ECONOMY'")
    return part.selectExpr(
        f"p_partkey + {ID_SHIFT} as question_id", "cast(p_partkey % 5 as int) as community"
    )
