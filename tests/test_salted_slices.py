"""The salted star over buckets, and reports kept per slice."""

import random

from pyspark.sql import functions as F

from laminar.operators import reports
from laminar.operators.joins import hot_keys
from laminar.plans import load
from laminar.plans.load import load_report_slices, load_salted_star, load_star, match_bucket_join
from laminar.session import scratch_path


def star(spark, rng, hot=400):
    matches = [(f"m{i}", f"map{i % 4}", rng.choice(["p", "q", None]), f"{2020 + i % 3}-01-05") for i in range(60)] + [(None, "map0", "p", None)]
    details = [(f"m{rng.randrange(50)}", f"g{rng.randrange(30)}", rng.randrange(40)) for _ in range(200)]
    details += [("m7", f"g{i}", i % 9) for i in range(hot)] + [("m7", None, 3), (None, "g1", 2)]
    medals = [(m, g, rng.randrange(5)) for m, g, _ in rng.sample(details, 250)] + [("m7", "nobody", 1)]
    return (spark.createDataFrame(matches, "match_id string, mapid string, playlist_id string, completion_date string").withColumn("completion_date", F.to_date("completion_date")),
            spark.createDataFrame(details, "match_id string, player_gamertag string, player_total_kills int"),
            spark.createDataFrame(medals, "match_id string, player_gamertag string, medal_id long"),
            spark.createDataFrame([(f"map{i}", f"Map {i}") for i in range(3)], "mapid string, name string"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_hot_match_is_joined_by_several_tasks_without_an_exchange(spark):
    m, d, p, _ = star(spark, random.Random(1))
    want = rows(reports.match_fact(m, d, p, skew_safe=False))
    tables = load_salted_star(spark, m, d, p, scratch_path(spark, "star"), buckets=8, salts=8, hot_rows=100)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with match_bucket_join(spark):
            fact = reports.match_fact_salted(*tables)
            assert "Exchange" not in fact._jdf.queryExecution().executedPlan().toString()
            assert rows(fact) == want
            tasks = fact.where("match_id = 'm7'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    total = sum(r["count"] for r in tasks)
    assert total > 400 and len(tasks) >= 4 and max(r["count"] for r in tasks) < total / 2


def test_hot_keys_are_bounded_and_any_number_of_them_is_right(spark):
    _, d, _, _ = star(spark, random.Random(2))
    assert [r.match_id for r in hot_keys(d, ["match_id"], 1, most=1).collect()] == ["m7"]
    assert hot_keys(d, ["match_id"], 1, most=5).count() == 5


def test_reports_after_any_reload_equal_the_whole(spark):
    m, d, p, maps = star(spark, random.Random(3))
    path, year = scratch_path(spark, "slices"), F.year("completion_date")

    def whole(matches, details):
        pm = reports.player_match_from_tables(matches.where("completion_date is not null"), details, maps)
        out = [("kills", *reports.top_avg_kills(pm).first()), ("playlist", *reports.top_playlist(pm).first()), ("map", *reports.top_map(pm).first())]
        return sorted((r, n, float(v)) for r, n, v in out)

    def got(df):
        return sorted((r.report, r.name, r.value) for r in df.collect())

    assert got(load_report_slices(spark, m, d, maps, path, year, ["2020", "2021", "2022"])) == whole(m, d)
    fewer = d.where("player_total_kills < 20")
    mixed = d.join(m.select("match_id", year.alias("y")), "match_id").where("y <> 2021 or player_total_kills < 20").drop("y")
    assert got(load_report_slices(spark, m, fewer, maps, path, year, ["2021"])) == whole(m, mixed)
    none = m.where("year(completion_date) <> 2022")  # a slice without matches replaces what was there
    assert got(load_report_slices(spark, none, mixed, maps, path, year, ["2022"])) == whole(none, mixed)
    assert got(load_report_slices(spark, m, d, maps, path, year, ["2022", "2021"])) == whole(m, d)


def buckets_of(spark, table):
    return int(next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r.col_name == "Num Buckets"))


def test_buckets_grow_with_the_largest_table(spark, monkeypatch):
    m, d, p, _ = star(spark, random.Random(5))
    want = rows(reports.match_fact(m, d, p, skew_safe=False))
    monkeypatch.setattr(load, "BUCKET_BYTES", d.count() * 72 // 40)
    root, found = scratch_path(spark, "star"), []
    monkeypatch.setattr(load, "hot_keys", lambda *a: found.append(hot_keys(*a)) or found[-1])
    monkeypatch.setattr(reports, "hot_keys", load.hot_keys)
    tables = load_salted_star(spark, m, d, p, root, salts=8, hot_rows=100)
    with match_bucket_join(spark):
        assert rows(reports.match_fact_salted(*tables)) == want
    assert len(found) == 1
    assert len({f.rsplit("_", 1)[1] for f in tables[1].inputFiles()}) > 16


def test_a_star_of_csv_files_has_buckets_by_its_size(spark, monkeypatch):
    files = {}
    for name, n in (("matches", 30), ("match_details", 400)):
        schema = load.TABLES[name]
        df = spark.range(n).select(*[(F.concat(F.lit("m"), "id") if f.name == "match_id" else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
        files[name] = scratch_path(spark, f"{name}_csv")
        df.write.option("header", "true").csv(files[name])
    monkeypatch.setattr(load, "BUCKET_BYTES", 4000)
    root = scratch_path(spark, "star")
    prefix = f"laminar_{root[-12:]}"
    loaded = load_star(spark, files, prefix, root)
    assert {name: df.count() for name, df in loaded.items()} == {"matches": 30, "match_details": 400}
    found = {buckets_of(spark, f"{prefix}_{name}") for name in files}
    assert len(found) == 1 and found.pop() > 16
