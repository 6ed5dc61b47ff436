"""Inserts under a primary key and upserts by key hash."""

import os

import pytest
from pyspark.sql import functions as F

from laminar.plans import keyed
from laminar.plans.keyed import KeyTaken, create_keyed, insert_keyed, judge_insert, read_keyed, upsert_table
from laminar.session import scratch_path

ROWS = "day string, id long, v string"


def frame(spark, rows, schema=ROWS):
    return spark.createDataFrame(rows, schema)


def table(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("day", "id", "v").collect())


@pytest.mark.parametrize("by", [None, "day"])
def test_insert_outcomes(spark, by):
    path, keys = scratch_path(spark, "t"), ["day", "id"]
    first = frame(spark, [("a", 1, "x"), ("a", 2, "x"), ("b", 1, "x")])
    assert insert_keyed(spark, first, path, first.schema, keys, partition_by=by).n_rows == 3
    with pytest.raises(KeyTaken, match="taken_key"):
        insert_keyed(spark, first, path, first.schema, keys, partition_by=by)
    assert insert_keyed(spark, first, path, first.schema, keys, "skip", by).n_rows == 0
    assert table(spark, path) == [("a", 1, "x"), ("a", 2, "x"), ("b", 1, "x")]

    more = frame(spark, [("a", 2, "y"), ("a", 3, "y"), ("a", 3, "y"), ("c", 9, "y"), (None, 5, "y"), ("a", None, "y")])
    with pytest.raises(KeyTaken, match="null_key"):
        insert_keyed(spark, more, path, more.schema, keys, "skip", by)
    with pytest.raises(KeyTaken, match="repeated_key"):
        insert_keyed(spark, more, path, more.schema, keys, "fail", by)
    assert len(table(spark, path)) == 3  # neither wrote anything
    done = insert_keyed(spark, more, path, more.schema, keys, "reject", by)
    assert done.n_rows == 2
    assert sorted((r.verdict, r.day or "", r.id or 0) for r in done.rejected.collect()) == [
        ("null_key", "", 5), ("null_key", "a", 0), ("repeated_key", "a", 3), ("taken_key", "a", 2)]
    assert table(spark, path) == [("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("b", 1, "x"), ("c", 9, "y")]
    again = insert_keyed(spark, more, path, more.schema, keys, "reject", by)
    assert again.n_rows == 0 and again.rejected.count() == 6
    empty = insert_keyed(spark, more.where("false"), path, more.schema, keys, "reject", by)
    assert empty.n_rows == 0 and empty.rejected.count() == 0


def test_insert_reads_only_the_arriving_partitions(spark):
    path = scratch_path(spark, "t")
    old = frame(spark, [(f"d{i}", j, "x") for i in range(5) for j in range(20)])
    insert_keyed(spark, old, path, old.schema, ["day", "id"], partition_by="day")
    arriving = frame(spark, [("d1", 3, "n"), ("d1", 77, "n"), ("d9", 1, "n")]).withColumn(keyed.ROW, F.monotonically_increasing_id())
    target = keyed.only_partitions(spark.read.schema(old.schema).parquet(path), arriving, "day")
    judged = judge_insert(target, arriving, ["day", "id"], 3)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "PartitionFilters: [day" in plan
    assert {(r.day, r.id, r.verdict) for r in judged.collect()} == {("d1", 3, "taken_key"), ("d1", 77, "ok"), ("d9", 1, "ok")}


def test_the_filter_lets_arriving_keys_through_and_few_others(spark, monkeypatch):
    target = spark.range(20000).select(F.lit("d").alias("day"), F.col("id"))
    arriving = spark.range(0, 40000, 97).select(F.lit("d").alias("day"), F.col("id"))
    n = arriving.count()
    passed = {r.id for r in keyed.taken_keys(target, arriving, ["day", "id"], n).collect()}
    assert set(range(0, 20000, 97)) <= passed and len(passed) < 20000 / 97 + 20000 / keyed.BITS_PER_KEY * 2
    monkeypatch.setattr(keyed, "MAX_FILTER_WORDS", 1)
    assert keyed.taken_keys(target, arriving, ["day", "id"], n).count() == 20000  # too large a filter: the join alone decides


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_upserts_replace_only_the_touched_slots(spark):
    path, keys, slots = scratch_path(spark, "t"), ["id"], 8
    base = frame(spark, [(i, f"n{i}", 0) for i in range(200)], "id long, name string, n long")
    create_keyed(base, path, keys, slots)
    before = files(path.replace("file:", ""))
    source = frame(spark, [(3, "new3", 7), (500, "new500", 9)], "id long, name string, n long")
    touched = upsert_table(spark, source, path, base.schema, keys, slots, update_cols=["n"])
    after = files(path.replace("file:", ""))
    kept = {f for f in before if f in after and before[f] == after[f]}
    assert {f.split("key_slot=")[1].split("/")[0] for f in set(before) - kept} <= {str(t) for t in touched}
    assert len({f.split("key_slot=")[1].split("/")[0] for f in kept}) == slots - len(touched)
    rows = {r.id: (r.name, r.n) for r in read_keyed(spark, path, base.schema).collect()}
    assert len(rows) == 201 and rows[3] == ("n3", 7) and rows[500] == ("new500", 9) and rows[4] == ("n4", 0)
    assert upsert_table(spark, source.where("false"), path, base.schema, keys, slots) == []
    with pytest.raises(Exception, match="duplicate key"):
        upsert_table(spark, source.unionByName(source), path, base.schema, keys, slots)
    assert read_keyed(spark, path, base.schema).count() == 201


def test_upsert_into_a_table_not_there_yet(spark):
    path = scratch_path(spark, "t")
    source = frame(spark, [(1, "a", 1), (2, "b", 2)], "id long, name string, n long")
    assert upsert_table(spark, source, path, source.schema, ["id"], 4)
    assert sorted(tuple(r) for r in read_keyed(spark, path, source.schema).collect()) == [(1, "a", 1), (2, "b", 2)]
