"""CSV inference, activity registers and key counts kept up by loads."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from laminar.operators.checks import key_violations
from laminar.operators.register import activity_counts, active_days, advance, roll_up
from laminar.plans.registers import checked_load, register_load_days, standing_violations
from laminar.session import scratch_path
from laminar.sources.infer import compare_schema, infer_schema
from laminar.sources.readers import read_csv


def csv(spark, columns):
    """A header CSV whose columns hold these texts."""
    path, n = scratch_path(spark, "csv"), max(len(v) for v in columns.values())
    rows = [tuple(v[i] if i < len(v) else None for v in columns.values()) for i in range(n)]
    spark.createDataFrame(rows, StructType.fromDDL(", ".join(f"`{c}` string" for c in columns))).coalesce(1).write.option("header", "true").csv(path)
    return path


def test_narrowest_types(spark):
    columns = {
        "i": ["1", "-7", "2147483647"], "l": ["1", "2147483648"], "l2": ["-9223372036854775808"],
        "d": ["1", "9223372036854775808"], "wide": ["9" * 39], "f": ["1", "2.5", "-.5e3"], "day": ["2024-01-31", "2024-02-29"],
        "time": ["2024-01-31", "2024-01-31 10:00:00", "2024-01-31T10:00:00.123Z"], "yes": ["true", "FALSE"], "none": [None],
        "baddate": ["2024-02-30"], "mixed": ["1", "2024-01-01"], "text": ["1", "x"], "nan": ["NaN"], "yn": ["true", "1"]}
    path = csv(spark, columns)
    got = {f.name: f.dataType.simpleString() for f in infer_schema(spark, path).fields}
    assert got == {"i": "int", "l": "bigint", "l2": "bigint", "d": "decimal(38,0)", "wide": "double", "f": "double", "day": "date",
                   "time": "timestamp", "yes": "boolean", "none": "string", "baddate": "string", "mixed": "string",
                   "text": "string", "nan": "string", "yn": "string"}
    read_csv(spark, path, infer_schema(spark, path)).collect()  # every value fits its type


def test_differences_from_the_declared_schema(spark):
    path = csv(spark, {"a": ["1", "2"], "b": ["1", "x"], "c": [None], "e": ["3"], "f": ["99999999999"]})
    report = {r.column_name: (r.inferred, r.declared, r.n_values, r.verdict)
              for r in compare_schema(spark, path, StructType.fromDDL("a bigint, b int, c float, d string, f int")).collect()}
    assert report == {"a": ("int", "bigint", 2, "wider"), "b": ("string", "int", 2, "conflict"), "c": ("void", "float", 0, "wider"),
                      "d": (None, "string", None, "missing"), "e": ("int", None, 1, "undeclared"), "f": ("bigint", "int", 1, "conflict")}


def test_a_file_without_rows(spark):
    path = csv(spark, {"a": ["1"], "b": ["x"]})
    empty = scratch_path(spark, "csv")
    spark.read.option("header", "true").csv(path).where("a = 'none'").coalesce(1).write.option("header", "true").csv(empty)
    assert [f.dataType.simpleString() for f in infer_schema(spark, empty).fields] in ([], ["string", "string"])


DAY0 = dt.date(2024, 1, 20)


def random_activity(rng, days):
    return sorted({(u, f"b{rng.randrange(3)}", DAY0 + dt.timedelta(days=rng.randrange(days))) for u in range(25)
                   for _ in range(rng.randrange(0, 20))})


@pytest.mark.parametrize("step", [1, 5, 30])
def test_counts_of_every_day_equal_the_raw_activity(spark, step):
    rng, days = random.Random(step), 33 if step == 1 else 90
    rows = random_activity(rng, days)
    act = spark.createDataFrame(rows + rows[:5], "user long, browser string, day date")
    last, windows = DAY0 + dt.timedelta(days=days - 1), {"dau": 1, "wau": 7, "mau": 28, "all": 31}
    got = {tuple(r) for r in register_load_days(spark, act, ["user", "browser"], ["user"], scratch_path(spark, "reg"), DAY0, last,
                                                step, windows).collect()}
    want = set()
    for d in (DAY0 + dt.timedelta(days=i) for i in range(days)):
        counts = [len({u for u, _, a in rows if 0 <= (d - a).days < n}) for n in windows.values()]
        if any(0 <= (d - a).days < 64 for _, _, a in rows):
            want.add((d, *counts))
    assert got == want


def test_registers_cross_month_ends_and_forget(spark):
    act = spark.createDataFrame([(1, DAY0), (1, DAY0 + dt.timedelta(days=20)), (2, DAY0), (None, DAY0)], "user long, day date")
    one = advance(spark.createDataFrame([], "user long, register long"), act, ["user"], DAY0, DAY0)
    assert {(r.user, r.register) for r in one.collect()} == {(1, 1), (2, 1), (None, 1)}
    two = advance(one, act, ["user"], DAY0 + dt.timedelta(days=1), DAY0 + dt.timedelta(days=63))
    found = {r.user: (r.n, r.w) for r in two.select("user", active_days(F.col("register"), 64).alias("n"),
                                                   active_days(F.col("register"), 7, 40).alias("w")).collect()}
    assert found == {1: (2, 1), 2: (1, 0), None: (1, 0)}
    assert {r.user for r in advance(two, act, ["user"], DAY0 + dt.timedelta(days=64), DAY0 + dt.timedelta(days=64)).collect()} == {1}
    assert advance(two, act, ["user"], DAY0 + dt.timedelta(days=64), DAY0 + dt.timedelta(days=127)).count() == 0
    with pytest.raises(ValueError):
        activity_counts(roll_up(two, ["user"]), DAY0, 40)


def test_loads_check_their_own_keys(spark):
    rng, path, keys = random.Random(3), scratch_path(spark, "counts"), ["day", "id"]
    loaded = []
    for load in range(4):
        rows = [(rng.choice(["a", "b", "c", None]), rng.choice([*range(30), None]), load) for _ in range(20)]
        loaded += rows
        touched = {r[0] for r in rows}
        df = spark.createDataFrame(rows, "day string, id long, v long")
        now = {tuple(r) for r in checked_load(spark, df, path, keys, F.col("day")).collect()}
        whole = {tuple(r) for r in key_violations(spark.createDataFrame(loaded, "day string, id long, v long"), keys).collect()}
        assert {tuple(r) for r in standing_violations(spark, path, keys).collect()} == whole
        assert now == {v for v in whole if v[0] in touched}
    again = spark.createDataFrame([("a", 1, 0), ("a", 2, 0)], "day string, id long, v long")
    assert checked_load(spark, again, path, keys, F.col("day"), replace=True).count() == 0
    kept = [r for r in loaded if r[0] != "a"] + [("a", 1, 0), ("a", 2, 0)]
    whole = {tuple(r) for r in key_violations(spark.createDataFrame(kept, "day string, id long, v long"), keys).collect()}
    assert {tuple(r) for r in standing_violations(spark, path, keys).collect()} == whole
