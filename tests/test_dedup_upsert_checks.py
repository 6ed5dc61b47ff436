"""Hand-made cases: keep-first dedup, upsert, domain and key checks."""

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from laminar.operators.checks import domain_summary, domain_violations, key_violations
from laminar.operators.dedup import dedup
from laminar.operators.upsert import upsert


def test_dedup_keeps_first_nulls_last_and_groups_null_keys(spark):
    df = spark.createDataFrame([
        (1, "x", None, 3.0), (1, "x", "b", 1.0), (1, "x", "a", 9.0), (1, "x", "a", 2.0),
        (None, "y", "z", 1.0), (None, "y", "c", 1.0),
        (2, "w", None, None),
    ], "k int, k2 string, a string, b double")
    got = {(r.k, r.k2): (r.a, r.b) for r in dedup(df, ["k", "k2"]).collect()}
    assert got == {(1, "x"): ("a", 2.0), (None, "y"): ("c", 1.0), (2, "w"): (None, None)}
    assert dedup(df, ["k", "k2"]).columns == df.columns


def test_dedup_custom_order_and_any_row(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 3)], "k int, a string, n int")
    assert dedup(df, ["k"], order=["n"]).collect()[0].a == "b"
    assert dedup(df, ["k"], any_row=True).count() == 1


def test_dedup_output_passes_key_check(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 1)], "k int, v int")
    assert key_violations(dedup(df, ["k"]), ["k"]).count() == 0
    assert {(r.k, r.n_rows) for r in key_violations(df, ["k"]).collect()} == {(1, 2), (2, 2)}


def test_key_check_flags_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (3, 1)], "k int, v int")
    assert [r.k for r in key_violations(df, ["k"]).collect()] == [None]


def test_domain_check(spark):
    df = spark.createDataFrame([("star",), ("meh",), (None,)], "c string")
    assert [r.c for r in domain_violations(df, "c", ["star", "bad"]).collect()] == ["meh"]
    r = domain_summary(df, "c", ["star", "bad"]).collect()[0]
    assert (r.n_rows, r.n_null, r.n_violations) == (3, 1, 1)


T = "k int, d int, name string, v string"


def test_upsert_updates_chosen_columns_inserts_and_keeps(spark):
    tgt = spark.createDataFrame([(1, 1, "old", "a"), (2, 1, "keep", "b")], T)
    src = spark.createDataFrame([(1, 1, "new", "A"), (3, 1, "ins", "c")], T)
    got = {(r.k, r.d): (r.name, r.v) for r in upsert(tgt, src, ["k", "d"], ["v"]).collect()}
    assert got == {(1, 1): ("old", "A"), (2, 1): ("keep", "b"), (3, 1): ("ins", "c")}


def test_upsert_is_idempotent(spark):
    tgt = spark.createDataFrame([(1, 1, "a", "a")], T)
    src = spark.createDataFrame([(1, 1, "a", "z"), (2, 2, "b", "b")], T)
    once = upsert(tgt, src, ["k", "d"])
    twice = upsert(once, src, ["k", "d"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_upsert_rejects_duplicate_source_key(spark):
    tgt = spark.createDataFrame([(1, 1, "a", "a")], T)
    src = spark.createDataFrame([(1, 1, "x", "x"), (1, 1, "y", "y")], T)
    with pytest.raises((Py4JJavaError, PySparkException)):
        upsert(tgt, src, ["k", "d"]).collect()
