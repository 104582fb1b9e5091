"""Writers for feature tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_features(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    fmt: str = "parquet",
) -> None:
    """Write a feature table, one folder per value of the ``partition_by`` columns.

    Each task writes its own rows; there is no shuffle by the partition columns,
    so a fold or split that holds most of the rows stays spread over many files.
    """
    df.write.mode(mode).partitionBy(*partition_by).format(fmt).save(path)
