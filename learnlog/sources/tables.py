"""Tables written to and read back from the cluster's shared folder."""

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting: one machine is then
    the whole cluster and a temporary folder is shared by definition.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getConf().get(_SETTING)
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="learnlog-")
    spark.conf.set(_SETTING, folder)
    return folder


def new_table(spark: SparkSession, name: str) -> str:
    """A path for a new table of this application in the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/learnlog-{app}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a scan of it.

    Cuts the lineage, so a lost executor re-reads files instead of recomputing,
    and gives the planner the true size: a later join broadcasts the table only
    if it is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles (with
    skew splitting) otherwise.
    """
    return written(df, name)[1]


def written(df: DataFrame, name: str) -> tuple[str, DataFrame]:
    """As :func:`materialize`, with the path, for a table that is deleted before the end."""
    spark = df.sparkSession
    path = new_table(spark, name)
    df.write.parquet(path)
    return path, spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_tables(spark: SparkSession) -> None:
    """Delete what this application has written to the shared folder.

    For the end of a run: frames that read those tables cannot be computed afterwards.
    """
    app = spark.sparkContext.applicationId
    delete(spark, f"{shared_folder(spark)}/learnlog-{app}")


def concurrently(
    spark: SparkSession, *builds: Callable[[], Result], at_once: int | None = None
) -> list[Result]:
    """Run independent builds at once, so that their small jobs share the cluster."""
    with ThreadPoolExecutor(min(len(builds), at_once or len(builds))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(build)) for build in builds]
        return [build.result() for build in running]
