"""Parquet scans.

``spark.read.parquet`` is lazy: filters and column selections applied later
are pushed into the scan by Catalyst (``PushedFilters`` / ``ReadSchema``), so
readers return the full logical table and let the plan prune it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from matchday.schemas import require_columns


def table_path(base: str, name: str) -> str:
    """``base/name.parquet``: a file or a folder, on any filesystem."""
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(
    spark: SparkSession,
    base: str,
    name: str,
    expected: T.StructType | list[str] | None = None,
) -> DataFrame:
    """Read one Parquet table and optionally check its columns."""
    df = spark.read.parquet(table_path(base, name))
    if expected is not None:
        require_columns(df, expected, what=name)
    return df


def save_bucketed(
    df: DataFrame,
    name: str,
    path: str,
    key: str = "match_id",
    buckets: int = 64,
) -> DataFrame:
    """Write ``df`` as an external Parquet table bucketed and sorted by
    ``key`` and return it read back from the catalog.

    Every operator that groups or joins events and match sheets keys on the
    match first.  When both tables are bucketed on ``match_id`` with the same
    number of buckets, those aggregations and the sheet-to-length join read
    their input already clustered: Spark plans them without an exchange.
    Choose ``buckets`` so that one bucket file is a few hundred MB.
    """
    (
        df.write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)
