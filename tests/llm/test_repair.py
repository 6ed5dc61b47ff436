"""Conversation repair against a search over edits, row by row."""

import hashlib
import random
import re
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

import laminar.llm.repair as repair_module
from laminar.llm.fourrussians import tables
from laminar.llm.repair import digests, repair

TURNS = "conv_id long, turn long, role string, text string"
STEP = {"": "su", "s": "u", "u": "a", "a": "u"}
WANTED = {"": "user", "s": "user", "u": "assistant", "a": "user"}


def judge(rows):
    """Fault of each row: blank, duplicate, truncated or none."""
    seen, out = set(), []
    for role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired lines): every edit string is tried, with memory."""
    faults = judge(rows)

    @cache
    def best(i, state, put_in):
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if put_in < 3:
            c, a, lines = best(i, WANTED[state][0], put_in + 1)
            found.append((3 + c, "I" + a, (WANTED[state] + ":", *lines)))
        if i < len(rows):
            (role, text), fault = rows[i], faults[i]
            c, a, lines = best(i + 1, state, 0)
            found.append((4 + c, "D" + a, lines))
            if fault not in ("blank", "duplicate"):
                cut = 3 if fault == "truncated" else 0
                if role[:1] and role[0] in STEP[state]:
                    c, a, lines = best(i + 1, role[0], 0)
                    found.append((cut + c, "K" + a, (f"{role}:{text}", *lines)))
                c, a, lines = best(i + 1, WANTED[state][0], 0)
                found.append((3 + cut + c, "R" + a, (f"{WANTED[state]}:{text}", *lines)))
        return min(found) if found else (10**9, "", ())

    return best(0, "", 0)


def expected(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role if role is not None else " ", text if text is not None else " "))
    out = {}
    for conv, said in convs.items():
        said.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        turns = [t for t, _, _ in said if t is not None]
        plain = [r[1:] for r in said]
        faults, pairs = judge(plain), [a[0][:1] + b[0][:1] for a, b in zip(plain, plain[1:])]
        cost, audit, lines = cheapest(plain)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def repaired(df):
    done = repair(df)
    got = done.summary.join(digests(done).withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left")
    cols = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    assert done.rows.count() == done.summary.select(F.sum(F.length(F.replace("audit", F.lit("D"), F.lit(""))))).first()[0]
    return {r.conv_id: (*[r[c] for c in cols], r.digest or hashlib.sha256(b"").hexdigest()) for r in got.collect()}


def random_rows(rng, convs, longest):
    rows = []
    for conv in range(convs):
        turn = 0
        for _ in range(rng.randrange(1, longest)):
            turn += rng.choice([1, 1, 1, 1, 2, 3])
            role = rng.choice(["user", "assistant"] * 5 + ["system", "tool", "", None, "useless", "System"])
            text = rng.choice([f"text {turn}.", f"more {turn}?", f"é {turn}!\n\t", "same.", "cut off", f"cut {turn} ", "", " \n", None, "wait. "])
            rows.append((conv, turn, role, text))
            if rng.random() < 0.1:
                rows.append((conv, turn, role, text))
    return rows


@pytest.mark.parametrize("chunk", [1024, 3])
def test_random_conversations(spark, monkeypatch, chunk):
    monkeypatch.setattr(repair_module, "CHUNK", chunk)
    rows = random_rows(random.Random(chunk), 60, 18)
    df = spark.createDataFrame(rows, TURNS).repartition(4).withColumn("at", F.lit("clash")).withColumn("conv", F.lit("clash"))
    assert repaired(df) == expected(rows)


def test_nulls_and_empty_table(spark):
    rows = [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (7, None, "user", "a."), (7, None, "user", "a."), (8, None, None, None),
            (9, 4, "assistant", "x" * 3_000_000 + "."), (9, 9, "tool", "!"), (10, 0, "user", ""), (11, 5, "system", "s.")]
    assert repaired(spark.createDataFrame(rows, TURNS)) == expected(rows)
    done = repair(spark.createDataFrame([], TURNS))
    assert done.summary.count() == 0 and digests(done).count() == 0


def test_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(repair_module, "CHUNK", 16)
    monkeypatch.setattr(repair_module, "PIECE", 500)
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "tool"]), rng.choice([f"t{t}.", f"t{t}", "again."])) for t in range(120)]
    rows += [(2, 0, "user", "hi."), (2, 1, "assistant", "yes.")]
    assert repaired(spark.createDataFrame(rows, TURNS).repartition(5)) == expected(rows)


def test_block_tables_equal_the_search():
    table, rng = tables(), random.Random(2)
    names = ["user", "assistant", "system", "tool"]
    for _ in range(300):
        rows = [(rng.choice(names), rng.choice([f"{i}.", f"{i}", ""])) for i in range(rng.randrange(0, 11))]
        kinds = [0 if f == "blank" else 1 + 4 * (f == "truncated") + "suat".index(r[0]) for (r, _), f in zip(rows, judge(rows))]
        vector, added, states = table.summarize(np.array(kinds, int))
        cost, audit, _ = cheapest(tuple(rows))
        assert added[table.end] + table.vectors[vector[table.end]][0] == cost
        assert table.trace(np.array(kinds, int), table.end, 0) + table.closing(int(states[table.end][0])) == audit
