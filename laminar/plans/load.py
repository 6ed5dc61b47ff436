"""Loads that write: bucketed table load, layout trial, versioned self-rewrite."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from laminar.operators.dedup import dedup
from laminar.operators.joins import HOT_ROWS, hot_keys
from laminar.operators.reports import MAP_NAME, SALT, SLICE, player_match_from_tables, salt_star, slice_partials, tops_of_slices
from laminar.plans.layout import in_order
from laminar.plans.tables import latest, overwrite_partitions, read_version, versions, write_version
from laminar.session import scratch_path
from laminar.sources.readers import read_csv
from laminar.sources.schemas import TABLES


def load_bucketed(spark: SparkSession, df: DataFrame, path: str, bucket_col: str | Sequence[str] = "match_id",
                  buckets: int = 16, drop_null: str | None = None, name: str | None = None,
                  files_per_bucket: int = 1, mode: str = "overwrite") -> DataFrame:
    """Write ``df`` as a table bucketed and sorted by ``bucket_col``; return the table.

    One job replaces a driver loop of per-value slices.  With ``files_per_bucket=1``
    the data is repartitioned into ``buckets`` tasks by the bucketing hash, so each
    task writes exactly one sorted file.  With ``files_per_bucket=k > 1`` every row
    also gets a deterministic salt in [0, k) (a hash of the whole row, stable under
    task retries) and tasks are range-partitioned on ``bucket * k + salt``: a bucket
    -- including one holding a hot key -- is written by about k tasks, each task
    holds about one bucket, and the bucket layout is unchanged (a bucket may simply
    have several files).  The sort spills instead of running out of memory.  Later
    joins on ``bucket_col`` between tables with the same bucket count need no
    exchange.  ``drop_null`` keeps the per-value loop's behaviour of never loading
    rows whose slice column is NULL; ``mode='append'`` with the table's ``name`` adds to an
    existing table as the per-slice loads did.  A bucket is one task unless
    ``files_per_bucket`` is raised; size ``buckets`` times that to the table.
    """
    if mode == "append" and name is None:
        raise ValueError("appending needs the name of the table")
    out = df if drop_null is None else df.where(F.col(drop_null).isNotNull())
    bucket_cols = [bucket_col] if isinstance(bucket_col, str) else list(bucket_col)
    name = name or f"laminar_{uuid.uuid4().hex[:12]}"
    if files_per_bucket <= 1:
        out = out.repartition(buckets, *bucket_cols)
    else:
        bucket = F.pmod(F.hash(*[F.col(c) for c in bucket_cols]), F.lit(buckets))
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in out.columns]), F.lit(files_per_bucket))
        out = (out.withColumn("_slot", bucket * files_per_bucket + salt)
               .repartitionByRange(buckets * files_per_bucket, "_slot").drop("_slot"))
    (out.write.mode(mode).bucketBy(buckets, *bucket_cols).sortBy(*bucket_cols)
        .option("path", path).saveAsTable(name))
    return spark.table(name)


BUCKET_BYTES = 128 << 20  # a bucket's rows in memory, about: one task sorts them
MOST_BUCKETS = 1 << 16


def bucket_count(*tables: DataFrame, least: int = 16) -> int:
    """Buckets for tables that are joined by them: so many that a bucket of the largest holds about ``BUCKET_BYTES``.

    Every table's rows are counted; a row is taken to need 8 bytes a column and 24 more for a string.
    """
    def in_memory(df: DataFrame) -> int:
        return df.count() * sum(32 if isinstance(f.dataType, StringType) else 8 for f in df.schema.fields)

    return min(MOST_BUCKETS, max(least, *(-(-in_memory(df) // BUCKET_BYTES) for df in tables)))


def file_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Path and bytes of every data file under ``path``, from a listing (no content is read)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
            .load(path).select("path", F.col("length").alias("bytes")))


def layout_report(spark: SparkSession, df: DataFrame, columns: Sequence[str], root: str) -> DataFrame:
    """Write ``df`` once per candidate sort column (sorted within partitions) and report
    on each layout: (sort_column, n_rows, sorted, bytes, files, mb).

    ``df`` is computed once and written as is -- that write is the ``unsorted``
    layout -- to a folder below ``root`` (a shared location, so the input survives an
    executor loss).  Every sorted layout reads that table back, so all layouts start
    from the same input splits and nothing upstream is recomputed.  Sizes come from
    a file listing.  ``sorted`` says whether every file is in the order of its column (NULL for the
    unsorted one); each task checks the rows it reads (see ``layout.in_order``).
    """
    root = root.rstrip("/")
    base = f"{root}/layout=unsorted"
    df.write.mode("overwrite").parquet(base)
    for c in columns:
        spark.read.parquet(base).sortWithinPartitions(c).write.mode("overwrite").parquet(f"{root}/layout={c}")
    checks = [in_order(spark.read.parquet(f"{root}/layout={c}"), [c]).withColumn("sort_column", F.lit(c)) for c in columns]
    checks.insert(0, spark.read.parquet(base).agg(F.count(F.lit(1)).alias("n_rows"), F.lit(None).cast("boolean").alias("sorted"))
                  .withColumn("sort_column", F.lit("unsorted")))
    report = checks[0]
    for c in checks[1:]:
        report = report.unionByName(c)
    sizes = (file_bytes(spark, root).withColumn("sort_column", F.regexp_extract("path", "layout=([^/]+)/", 1))
             .groupBy("sort_column").agg(F.sum("bytes").cast("long").alias("bytes"), F.count(F.lit(1)).alias("files"))
             .withColumn("mb", F.round(F.col("bytes") / (1024 * 1024), 2)))
    return report.join(sizes, "sort_column").select("sort_column", "n_rows", "sorted", "bytes", "files", "mb")


def reload_dedup(spark: SparkSession, path: str, schema, keys: Sequence[str],
                 order: Sequence[str] | None = None) -> DataFrame:
    """Reload a versioned table with its deduplicated self, and return the table.

    The newest complete version is read, its deduplicated rows become the next version, and from then on readers
    of the newest version see those: the swap is the new version's completion.
    """
    now = latest(versions(spark, path, "v"))
    deduped = dedup(read_version(spark, path, schema, "v", now), keys, order)
    write_version(deduped, path, "v", f"{int(now or 0) + 1:09d}")
    return read_version(spark, path, schema, "v", latest(versions(spark, path, "v")))


def load_salted_star(spark: SparkSession, matches: DataFrame, details: DataFrame, medals_players: DataFrame, root: str,
                     buckets: int | None = None, salts: int = 16, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The fact's sources as tables bucketed by (match, salt): ``match_fact_salted`` joins them without an exchange,
    and a hot match is read by as many tasks as its salts have buckets.

    The hot matches are found once and written, as each of the three loads reads them.  Without ``buckets`` their
    number grows with the largest table.
    """
    path = f"{root.rstrip('/')}/hot_matches"
    hot_keys(details, ["match_id"], hot_rows).write.mode("overwrite").parquet(path)
    parts = salt_star(matches, details, medals_players, salts, hot_rows, spark.read.parquet(path))
    buckets = buckets or bucket_count(matches, details, medals_players)
    return tuple(load_bucketed(spark, df, f"{root.rstrip('/')}/{name}", ["match_id", SALT], buckets)
                 for df, name in zip(parts, ("matches", "match_details", "medal_matches_players")))


def load_report_slices(spark: SparkSession, matches: DataFrame, details: DataFrame, maps: DataFrame, path: str, slice_of: Column,
                       slices: Sequence[str]) -> DataFrame:
    """Load (or load again) some slices of the report table at ``path``, and return the top-1 reports over all slices.

    ``slice_of`` names a match's slice, an expression over ``matches``.  Only the matches of the given slices are read
    and joined; their partitions are replaced, the other slices' partial aggregates stay.
    """
    wanted = matches.withColumn(SLICE, slice_of.cast("string")).where(F.col(SLICE).isin(list(slices)))
    # a match has one slice, so it can ride along as the playlist's companion through the distinct
    pm = player_match_from_tables(wanted.withColumn("playlist_id", F.struct("playlist_id", SLICE)), details, maps)
    pm = pm.select("match_id", "player_gamertag", "player_total_kills", MAP_NAME, F.col(f"playlist_id.{SLICE}").alias(SLICE),
                   F.col("playlist_id.playlist_id").alias("playlist_id"))
    named = spark.createDataFrame([(s,) for s in slices], f"{SLICE} string")
    staged = scratch_path(spark, "report-slices")
    slice_partials(pm, named).write.parquet(staged)
    overwrite_partitions(spark.read.parquet(staged), path, SLICE, files_per_partition=1)
    return tops_of_slices(spark.read.schema("report string, name string, total long, n long, slice string").parquet(path))


def load_star(spark: SparkSession, sources: dict[str, str], prefix: str, root: str, buckets: int | None = None,
              bucketed: Sequence[str] = ("matches", "match_details", "medal_matches_players")) -> dict[str, DataFrame]:
    """Load CSV files of the star tables into created tables, and return them by name.

    Every table is created from its declared schema, empty, then the file, read against that schema, is appended.
    Fact tables are bucketed by ``match_id``, all into as many buckets; the others are plain.  Without ``buckets`` their
    number grows with the largest fact table, so that what one task sorts does not.  A table of that name is replaced.
    """
    facts = [read_csv(spark, path, name) for name, path in sources.items() if name in bucketed]
    buckets = buckets or (bucket_count(*facts) if facts else 0)
    out = {}
    for name, path in sources.items():
        table = f"{prefix}_{name}"
        create_table(spark, table, TABLES[name], f"{root.rstrip('/')}/{name}", buckets if name in bucketed else 0)
        rows = read_csv(spark, path, name)
        if name in bucketed:
            out[name] = load_bucketed(spark, rows, f"{root.rstrip('/')}/{name}", "match_id", buckets, name=table, mode="append")
        else:
            rows.write.mode("append").format("parquet").saveAsTable(table)
            out[name] = spark.table(table)
    return out


@contextmanager
def match_bucket_join(spark: SparkSession):
    """Within it, tables bucketed by a join's first key only are joined on more keys without an exchange."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def create_table(spark: SparkSession, name: str, schema, path: str, buckets: int = 0, bucket_col: str = "match_id") -> None:
    """Create an empty parquet table with a declared schema, dropping an older one of that name."""
    drop_table(spark, name)
    w = spark.createDataFrame([], schema).write.format("parquet").mode("overwrite").option("path", path)
    if buckets:
        w = w.bucketBy(buckets, bucket_col).sortBy(bucket_col)
    w.saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def rewrite_dedup(spark: SparkSession, path: str, new_path: str, keys: Sequence[str],
                  order: Sequence[str] | None = None) -> DataFrame:
    """Reload a table with its deduplicated self, as a new version.

    A path cannot be overwritten while it is read, so the deduplicated rows go to
    ``new_path``; the caller swaps its table pointer to the new version, and the old
    one stays readable until then (no truncate-then-reload window).
    """
    deduped = dedup(spark.read.parquet(path), keys, order)
    deduped.write.mode("errorifexists").parquet(new_path)
    return spark.read.parquet(new_path)
