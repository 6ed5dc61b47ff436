"""Order checks without a shuffle, and sizes of orders from samples."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from laminar.plans.layout import column_bytes, estimate_layouts, in_order
from laminar.plans.load import file_bytes
from laminar.session import scratch_path


def written(spark, df, order=()):
    path = scratch_path(spark, "lay")
    (df.sortWithinPartitions(*order) if order else df).write.parquet(path)
    return path


def test_in_order(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "é", "b", ""]), rng.choice([None, *range(5)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "s string, n int, i long").repartition(3, "i")
    for order in (["s"], ["n"], ["s", "n"], ["n", "s", "i"]):
        sorted_ = spark.read.parquet(written(spark, df, order))
        r = in_order(sorted_, order).first()
        assert (r.n_rows, r["sorted"]) == (3000, True)
        assert not in_order(spark.read.parquet(written(spark, df)), order).first()["sorted"]
    assert not in_order(spark.read.parquet(written(spark, df, ["s", F.col("n").desc()])), ["s", "n"]).first()["sorted"]
    nothing = in_order(spark.read.schema("s string").parquet(written(spark, df.where("false").select("s"))), ["s"]).first()
    assert (nothing.n_rows, nothing["sorted"]) == (0, True)


def test_one_row_out_of_place_is_found_at_batch_borders(spark):
    n, before = 2000, spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        for wrong in (99, 100, 101, 1999):
            df = spark.range(0, n, 1, 1).select(F.when(F.col("id") == wrong, F.lit(0)).otherwise(F.col("id")).alias("v"))
            assert not in_order(spark.read.parquet(written(spark, df)), ["v"]).first()["sorted"]
        assert in_order(spark.read.parquet(written(spark, spark.range(0, n, 1, 1))), ["id"]).first()["sorted"]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_no_shuffle_of_rows(spark):
    table = spark.read.parquet(written(spark, spark.range(100)))
    plan = in_order(table, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") > plan.index("Window")  # only what the tasks found is exchanged


def test_bytes_follow_runs_and_kinds():
    flat, runs = np.arange(8000) % 8, np.repeat(np.arange(8), 1000)
    (d1, i1), (d2, i2) = column_bytes(pa.array(flat)), column_bytes(pa.array(runs))
    assert d1 == d2 == 64 and i1 == 8000 * 3 / 8 and i2 == 8 * 3
    assert column_bytes(pa.array(["x"] * 100))[1] <= 3


def test_estimated_ranking_equals_the_written_one(spark):
    rng = np.random.default_rng(3)
    n = 60000
    cols = {"few": rng.integers(0, 4, n), "some": rng.integers(0, 60, n), "many": rng.integers(0, 20000, n), "tied": rng.integers(0, 4, n)}
    cols["tied"] = cols["some"] // 15
    import pandas as pd
    base = written(spark, spark.createDataFrame(pd.DataFrame(cols)).repartition(4))
    orders = [["few"], ["some"], ["many"], ["few", "some"], []]
    guess = {r.sort_columns: r.est_bytes for r in estimate_layouts(spark, base, orders, sampled=0.5).collect()}
    real = {}
    for o in orders:
        path = written(spark, spark.read.parquet(base), o)
        real[",".join(o) or "unsorted"] = file_bytes(spark, path).agg(F.sum("bytes")).first()[0]
    assert sorted(guess, key=guess.get) == sorted(real, key=real.get)
