"""Writes into tables with a primary key: inserts that honour it, and upserts without a period in it.

The database refused a row whose key was taken (or NULL), and updated rows by key wherever they were.  Files know
no keys, so both are joins with the part of the target that can matter:

* an insert anti-joins the arriving rows with the target's keys, of which only the arriving periods'
  partitions are read and only those that pass a bit filter of the arriving keys are shuffled;
* an upsert works on a table partitioned by a hash of its key: only the partitions that the source
  touches are read, joined and replaced, all other files stay.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from laminar.operators.upsert import upsert
from laminar.plans.tables import conform, exists, overwrite_partitions, partition_path, read_table
from laminar.session import scratch_path

OK, NULL_KEY, REPEATED, TAKEN = "ok", "null_key", "repeated_key", "taken_key"
ROW = "arriving_row"
BITS_PER_KEY = 16  # of the filter: one key in 16 that is not arriving passes by chance
MAX_FILTER_WORDS = 1 << 21  # 64-bit words of the broadcast filter (32 MB); beyond, the join goes without
MAX_PARTITIONS = 10_000  # partition values handed to the scan as literals


class KeyTaken(ValueError):
    """An insert met a key that is NULL, repeated or already in the table."""


@dataclass
class Inserted:
    """What an insert did: rows put in, and the rows left out with their ``verdict`` (a written table)."""

    n_rows: int
    rejected: DataFrame


def key_filter(arriving: DataFrame, keys: Sequence[str], n_keys: int) -> tuple[DataFrame, int] | None:
    """A bit filter of the arriving keys as ``(word, bits)``, and its number of bits; None if it grew too large."""
    bits = 64
    while bits < BITS_PER_KEY * n_keys:
        bits *= 2
    if bits // 64 > MAX_FILTER_WORDS:
        return None
    place = _place(keys, bits)
    one = F.expr("shiftleft(1L, cast(_place % 64 as int))")
    words = (arriving.select(place.alias("_place")).select((F.col("_place") / 64).cast("long").alias("_word"), one.alias("_bit"))
             .groupBy("_word").agg(F.bit_or("_bit").alias("_bits")))
    return words, bits


def _place(keys: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(bits))


def taken_keys(target: DataFrame, arriving: DataFrame, keys: Sequence[str], n_keys: int) -> DataFrame:
    """The keys of ``target`` that can be among the arriving ones (all that are, and few others)."""
    have = target.select(*keys)
    made = key_filter(arriving, keys, n_keys)
    if made is None:
        return have
    words, bits = made
    place = _place(keys, bits)
    return (have.withColumn("_word", (place / 64).cast("long")).withColumn("_bit", (place % 64).cast("int"))
            .join(F.broadcast(words), "_word").where(F.expr("getbit(_bits, _bit) = 1")).select(*keys))


def judge_insert(target: DataFrame, arriving: DataFrame, keys: Sequence[str], n_keys: int, row: str = ROW) -> DataFrame:
    """``arriving`` with a ``verdict``: ok, or why the key forbids the row.

    Rows are told apart by the column ``row``; of several with one key the one with the smallest is ok, if
    the key is free.  Keys are reduced before they meet the target, so a frequent key is one row there.
    """
    keys = list(keys)
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    taken = taken_keys(target, arriving, keys, n_keys).distinct().withColumn("_taken", F.lit(True))
    firsts = arriving.groupBy(*keys).agg(F.min(row).alias("_first")).join(taken, keys, "left")
    verdict = (F.when(null_key, NULL_KEY).when(F.col("_taken"), TAKEN).when(F.col(row) != F.col("_first"), REPEATED)
               .otherwise(OK))
    return arriving.join(firsts, keys, "left").select(*arriving.columns, verdict.alias("verdict"))


def insert_keyed(spark: SparkSession, rows: DataFrame, path: str, schema: StructType, keys: Sequence[str],
                 on_conflict: str = "fail", partition_by: str | None = None) -> Inserted:
    """Append ``rows`` to the table at ``path`` under its primary key ``keys``.

    ``on_conflict``: ``fail`` writes nothing and raises ``KeyTaken`` if any key is NULL, repeated among the rows or taken;
    ``skip`` leaves out rows whose key is taken, and repeated ones after the first, but still raises for NULL keys
    (a key is NOT NULL); ``reject`` leaves out all three kinds and returns them.  So a second run of
    one insert raises or changes nothing.  One writer at a time: files have no locks.

    With ``partition_by`` (a key column) only the partitions of the arriving rows are read.
    """
    if on_conflict not in ("fail", "skip", "reject"):
        raise ValueError(f"unknown outcome {on_conflict!r}")
    numbered = StructType([*schema.fields, StructField(ROW, LongType())])
    staged, judged_at = scratch_path(spark, "arriving"), scratch_path(spark, "judged")
    conform(rows, schema).withColumn(ROW, F.monotonically_increasing_id()).write.parquet(staged)
    arriving = spark.read.schema(numbered).parquet(staged)
    target = read_table(spark, path, schema)
    if partition_by:
        target = only_partitions(target, arriving, partition_by)
    judge_insert(target, arriving, keys, arriving.count()).drop(ROW).write.partitionBy("verdict").parquet(judged_at)
    refused = [v for v in (NULL_KEY, REPEATED, TAKEN) if exists(spark, partition_path(judged_at, "verdict", v))]
    if (on_conflict == "fail" and refused) or (on_conflict == "skip" and NULL_KEY in refused):
        raise KeyTaken(f"insert into {path} on ({', '.join(keys)}): {', '.join(refused)}")
    judged = spark.read.schema(StructType([*schema.fields, StructField("verdict", StringType())])).parquet(judged_at)
    good = judged.where(F.col("verdict") == OK).drop("verdict")
    n_good = good.count()
    if n_good:
        writer = good.write.mode("append")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return Inserted(n_good, judged.where(F.col("verdict") != OK))


def only_partitions(target: DataFrame, arriving: DataFrame, partition_by: str) -> DataFrame:
    """``target`` limited to the arriving partition values, as literals so that the scan lists those folders only."""
    values = [r[0] for r in arriving.select(partition_by).where(F.col(partition_by).isNotNull()).distinct()
              .limit(MAX_PARTITIONS + 1).collect()]
    return target.where(F.col(partition_by).isin(values)) if len(values) <= MAX_PARTITIONS else target


# ---- upserts by key hash ---------------------------------------------------------
SLOT = "key_slot"


def _slotted(df: DataFrame, keys: Sequence[str], slots: int) -> DataFrame:
    return df.withColumn(SLOT, F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(slots)).cast("int"))


def create_keyed(rows: DataFrame, path: str, keys: Sequence[str], slots: int) -> None:
    """Write a table partitioned by the hash of its key into ``slots`` (choose about 1 GB a slot)."""
    _slotted(rows, keys, slots).repartition(SLOT).write.partitionBy(SLOT).parquet(path)


def read_keyed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return read_table(spark, path, schema)


def upsert_table(spark: SparkSession, source: DataFrame, path: str, schema: StructType, keys: Sequence[str], slots: int,
                 update_cols: Sequence[str] | None = None) -> list[int]:
    """Upsert ``source`` into the table at ``path``; the slots it touched (all other files stay as they are).

    The source is staged once, its slots are found (at most ``slots`` values), and only their partitions are read,
    joined and replaced, by a dynamic overwrite of a staged result: the table is never read while it is replaced, and a
    failed job leaves it as it was.  A key that stands twice in the source fails the job.
    """
    staged = scratch_path(spark, "upsert-source")
    _slotted(source, keys, slots).write.parquet(staged)
    src = spark.read.parquet(staged)
    touched = sorted(r[0] for r in src.select(SLOT).distinct().collect())
    if not touched:
        return []
    with_slot = StructType([*schema.fields, StructField(SLOT, IntegerType())])
    target = (spark.read.schema(with_slot).parquet(path) if exists(spark, path) else spark.createDataFrame([], with_slot))
    merged = upsert(target.where(F.col(SLOT).isin(touched)), src, [*keys, SLOT], update_cols)
    result = scratch_path(spark, "upsert-result")
    merged.write.parquet(result)
    overwrite_partitions(spark.read.schema(with_slot).parquet(result).repartition(SLOT), path, SLOT)
    return touched
