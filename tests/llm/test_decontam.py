"""Benchmark windows in documents against plain search."""

import random
import re

import pytest
from pyspark.sql import functions as F

import laminar.llm.decontam as decontam
from laminar.llm.decontam import covered, find_windows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, win string"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i: i + size]), set()).add("" if item is None else str(item))
    lengths, out = {len(w) for w in windows}, []
    for doc, text in docs:
        w = words(text)
        spans = sorted((i, n) for n in lengths for i in range(len(w) - n + 1) if tuple(w[i: i + n]) in windows)
        found = set().union(*[windows[tuple(w[i: i + n])] for i, n in spans])
        hit = {p for i, n in spans for p in range(i, i + n)}
        out.append((doc, len(w), tuple(spans), tuple(sorted(found)), len(hit)))
    return sorted(out, key=repr)


def got(spark, docs, items):
    rows = find_windows(docs, items).withColumn("hit", covered(F.col("spans"))).collect()
    return sorted(((r.doc_id, r.n_words, tuple(tuple(s) for s in r.spans), tuple(r["items"]), r.hit) for r in rows), key=repr)


def frames(spark, docs, items):
    return (spark.createDataFrame([(d, t, "clash") for d, t in docs], "doc_id long, text string, hash string").repartition(3),
            spark.createDataFrame([(i, t, "clash") for i, t in items], ITEMS))


@pytest.mark.parametrize("block", [64 << 20, 3000])
def test_random_texts(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
    rng = random.Random(5)
    vocabulary = ["a", "b", "the", "Über", "ÉTÉ", "été", "日本", "x1", "z"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", "-", ", ", "_"]) for _ in range(n))

    items = [(i, text(rng.choice([0, 1, 2, 3, 5, 9, 10, 11, 30]))) for i in range(25)]
    docs = [(i, text(rng.randrange(0, 60))) for i in range(40)]
    docs += [(100 + i, text(7) + items[i][1].upper() + " " + text(5)) for i in range(25)]
    assert got(spark, *frames(spark, docs, items)) == expected(docs, items)


def test_odd_rows(spark, edge):
    items = [(1, None), (2, ""), (3, "... !"), (None, "same text twice here now"), (5, "same TEXT twice here now"), (5, "short"),
             (6, "word " * 12), (7, "nothing like this occurs in any of the documents given here at all")]
    docs = [(r.doc_id, r.text) for r in edge.collect()] + [(None, "Short one."), (None, None), (9, "short and different")]
    assert got(spark, *frames(spark, docs, items)) == expected(docs, items)
    assert expected(docs, items)


def test_empty_tables(spark):
    docs, items = [(1, "one two")], [(1, "one")]
    assert got(spark, *frames(spark, docs, [])) == expected(docs, [])
    assert got(spark, *frames(spark, [], items)) == []
    assert got(spark, *frames(spark, [], [])) == []


def test_passage_of_many_items_and_documents(spark):
    passage = " ".join(f"w{i}" for i in range(14))
    items = [(i, f"{passage} item {i} ends here") for i in range(60)]
    docs = [(i, f"start {i} {passage} then on {passage}") for i in range(120)] + [(500 + i, f"w{i} w{i + 1} clean") for i in range(40)]
    assert got(spark, *frames(spark, docs, items)) == expected(docs, items)
