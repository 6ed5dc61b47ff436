"""Partitioned parquet tables written one period at a time, and versioned tables.

A snapshot table is partitioned by its period column.  A load step reads only the
partition directories it needs (no listing of the whole table) and replaces only
the partitions it produces (dynamic partition overwrite): re-running a period
replaces what that period wrote, and untouched periods are never rewritten.

A step whose output replaces its own input (an open slice, a month's arrays, a table
reloaded with its deduplicated self) writes a *version* instead: a folder
``<col>=<value>`` of its own, complete once Spark has put its ``_SUCCESS`` file there.
Readers take the newest complete version, so the one before stays readable until the
new one is whole, a crash in between loses nothing, and writing a version again
replaces it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def overwrite_partitions(df: DataFrame, path: str, partition_col: str,
                         files_per_partition: int | None = None) -> None:
    """Replace the ``partition_col`` partitions present in ``df`` (others stay as they are).

    By default there is no repartition: a daily step has a single partition value,
    and hashing on it alone would funnel the whole day into one writer task; every
    task writes its own file into the partitions it holds.  For a backfill spanning
    many periods, ``files_per_partition`` bounds the file count instead: rows are
    spread by (period, deterministic row hash mod n), so each period is written by
    at most n tasks, one file each, and a retried task gets the same rows.
    """
    if files_per_partition:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_partition))
        df = df.repartition(F.col(partition_col), salt)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col).parquet(path))


def _literal(value) -> str:
    return value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else str(value)


def partition_path(path: str, col: str, value) -> str:
    return f"{path.rstrip('/')}/{col}={_literal(value)}"


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Spark sees them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there.  Any other trouble (permissions, a bad address) raises."""
    fs, p = hadoop_path(spark, path)
    return bool(fs.exists(p))


def read_partition(spark: SparkSession, path: str, schema: StructType, col: str, value) -> DataFrame:
    """One partition of a table, read by its directory; an empty frame only if that is missing."""
    part = partition_path(path, col, value)
    if not exists(spark, part):
        return spark.createDataFrame([], schema)
    # the declared schema (partition column included) spares a footer read per step
    return conform(spark.read.schema(schema).option("basePath", path).parquet(part), schema)


def has_partition(spark: SparkSession, path: str, col: str, value) -> bool:
    """Whether a partition was written (its directory is made only when it gets rows)."""
    return exists(spark, partition_path(path, col, value))


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The whole table at ``path`` with its declared schema, or an empty one before the first write."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return conform(spark.read.parquet(path), schema)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


# ---- versions ------------------------------------------------------------------
def write_version(df: DataFrame, path: str, col: str, value) -> None:
    """Write (or write again) one version; an empty result is a version too."""
    df.write.mode("overwrite").parquet(partition_path(path, col, value))


def versions(spark: SparkSession, path: str, col: str) -> list[str]:
    """Values of the complete versions under ``path``, in ascending text order."""
    if not exists(spark, path):
        return []
    fs, p = hadoop_path(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n[len(col) + 1:] for n in names
                  if n.startswith(f"{col}=") and exists(spark, f"{path.rstrip('/')}/{n}/_SUCCESS"))


def read_version(spark: SparkSession, path: str, schema: StructType, col: str, value) -> DataFrame:
    """One version with its declared schema; an empty frame for ``None``."""
    if value is None:
        return spark.createDataFrame([], schema)
    return conform(spark.read.schema(schema).parquet(partition_path(path, col, value)), schema)


def latest(names: list[str], before: str | None = None) -> str | None:
    """The newest version, or the newest one before a value (numbers as text need equal width)."""
    kept = [n for n in names if before is None or n < before]
    return kept[-1] if kept else None


def drop_versions(spark: SparkSession, path: str, col: str, keep: int = 2) -> None:
    """Delete all but the newest ``keep`` versions."""
    for n in versions(spark, path, col)[:-keep or None]:
        fs, p = hadoop_path(spark, partition_path(path, col, n))
        fs.delete(p, True)
