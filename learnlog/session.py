"""Session settings the library is tuned for. Any Spark session works."""

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None, app: str = "learnlog", shared: str | None = None, **conf: str
) -> SparkSession:
    """``shared`` is the folder that driver and executors share, for written tables."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
