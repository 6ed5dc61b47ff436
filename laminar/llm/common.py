"""Shared helpers: reading inputs, cutting lineage through the shared folder, table-wide constants."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.plans.tables import hadoop_path
from laminar.session import scratch_path

# Fixed by the task: a word is a run of anything but these six white-space bytes.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# While a step is written: shuffle files are freed at once when it is done, and batches to Python workers stay small, as
# texts may be long.
_STEP_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
              "spark.sql.execution.arrow.maxRecordsPerBatch": "1024"}


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the cluster's checkpoint folder and read it back: a durable lineage cut.

    The shuffle files of the write are freed with it, as nothing reads them any more.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name), {k: spark.conf.get(k, None) for k in _STEP_CONF}
    try:
        for k, v in _STEP_CONF.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def drop(*settled: DataFrame) -> None:
    """Delete written steps that nothing reads any more."""
    for df in settled:
        files = df.inputFiles()
        if files:
            folder = files[0].rsplit("/", 1)[0]
            fs, path = hadoop_path(df.sparkSession, folder)
            fs.delete(path, True)


_held: dict = {}


def held(key: tuple, make: Callable):
    """What a Python worker keeps from task to task (tables of known words): one thing at a time.

    Asking for another key lets the former go, so idle workers do not pile up the tables of past stages.
    """
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def release() -> None:
    """Let go what earlier stages held in this worker; called by passes that hold nothing themselves."""
    _held.clear()


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null (computed inside the JVM)."""
    padded = F.concat(F.lit(" "), text)  # a leading separator makes the piece before the first word empty
    pieces = F.size(F.split(padded, SPACES)) - 1
    return F.coalesce(F.when(padded.rlike(r"[\x20\x09-\x0D]$"), pieces - 1).otherwise(pieces), F.lit(0)).cast("long")


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
