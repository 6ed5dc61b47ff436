"""The package-level API, used as the README shows, on the smallest stand-ins."""

import datetime as dt

from pyspark.sql import functions as F

import laminar as lm
from laminar.sources import roles
from tests.conftest import SF_SMALL


def test_readme_flow(spark):
    films = roles.actor_films(spark, SF_SMALL)
    actors = lm.cumulate_years(films, seed=roles.ACTOR_SEED_YEAR)
    scd = lm.scd2_backfill(actors)
    assert scd.count() == 710

    latest = actors.where(F.col("current_year") == 2000)
    nxt = lm.cumulate_year_step(latest, films, seed=roles.ACTOR_SEED_YEAR)
    assert nxt.select(F.max("current_year")).first()[0] == 2001
    assert nxt.count() == actors.where("current_year = 2001").count()

    events, devices = roles.events(spark, SF_SMALL), roles.devices(spark, SF_SMALL)
    act = lm.user_activity(events, devices)
    snap = lm.datelist_backfill(act, ["user_id", "browser_type"], "2024-01-01", "2024-01-30",
                                "device_actives", as_of="2024-01-14")
    bits = lm.datelist_int(snap, ["user_id", "browser_type"], "device_actives", "2024-01-01")
    assert bits.count() == snap.count() > 0
    month = lm.reduce_month(lm.daily_counts(events), dt.date(2024, 1, 1), dt.date(2024, 1, 30))
    assert month.select(F.min(F.size("hit_array"))).first()[0] == 30

    m, d, p = (roles.matches(spark, SF_SMALL), roles.match_details(spark, SF_SMALL),
               roles.medal_matches_players(spark, SF_SMALL))
    assert lm.match_fact(m, d, p).count() > 0
    with lm.shared_player_match(m, d, roles.maps(spark, SF_SMALL)) as pm:
        assert lm.top_playlist(pm).count() == 1
    assert lm.check_key(lm.dedup(roles.game_details(spark, SF_SMALL), ["l_orderkey", "l_linenumber"]),
                        ["l_orderkey", "l_linenumber"]).count() == 0


def test_apply_scale_conf_sets_and_can_be_restored(spark):
    from laminar.session import SCALE_CONF, apply_scale_conf
    before = {k: spark.conf.get(k, None) for k in SCALE_CONF}
    try:
        apply_scale_conf(spark, {"spark.sql.shuffle.partitions": "4096"})
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4096"
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before["spark.sql.shuffle.partitions"]
