"""Merkle manifest against a plain recursive build, with odd rows, subsets of leaves and tampering."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from laminar.llm.merkle import ARITY, FIELDS, build_manifest, fold, leaf_digest, path_digest, prove


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i: i + ARITY]) for i in range(0, len(out[-1]), ARITY)])
    return out


def siblings(tree, pos):
    out = []
    for level in tree[:-1]:
        first = pos - pos % ARITY
        out.append(("".join(level[first: pos]), "".join(level[pos + 1: first + ARITY])))
        pos //= ARITY
    return out


def expected(rows):
    """leaf, subroot, root and path of every row (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        ranked = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[g] = ranked, levels([leaf_of(r) for r in ranked])
    upper = levels([trees[g][1][-1][0] for g in order])
    out = []
    for i, g in enumerate(order):
        ranked, tree = trees[g]
        for pos, r in enumerate(ranked):
            out.append((r[0], leaf_of(r), tree[-1][0], upper[-1][0], tuple(siblings(tree, pos) + siblings(upper, i))))
    return sorted(out, key=repr)


def proven(df, wanted=None):
    rows = prove(build_manifest(df), wanted).select("kept.doc_id", "leaf", "subroot", "root", "path").collect()
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, tuple(tuple(s) for s in r.path)) for r in rows), key=repr)


def rows_of(df):
    return [tuple(r) for r in df.select(*FIELDS).collect()]


@pytest.mark.parametrize("sizes", [[1], [1, 1], [3, 9, 10], [1, 2, 4, 5, 7, 28, 300], [800], [1] * 31])
def test_equals_the_plain_build(spark, sizes):
    rows = [(i * 7 % 1009, f"s{g}é" if g else None, None, i, f"text\n{i}") for g, n in enumerate(sizes) for i in range(n)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert proven(df) == expected(rows)


def test_odd_rows(spark, edge, nothing):
    extra = spark.createDataFrame([(None, "no id", None, None, None), (None, None, None, None, 4)], edge.select(*FIELDS[:1], "text", "lang", "source", "n_chars").schema)
    df = edge.unionByName(extra, allowMissingColumns=True).withColumn("rank", F.lit("clash")).withColumn("tree", F.lit("clash"))
    assert proven(df) == expected(rows_of(df))
    assert prove(build_manifest(nothing)).count() == 0


def test_many_repeated_rows(spark):
    rows = [(5, "s", "en", 1, "same")] * 700 + [(i, "s", "en", 1, "other") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert proven(df) == expected(rows)


def test_wanted_leaves_only(spark):
    rows = [(i, f"s{i % 3}", "en", i, "x") for i in range(500)] + [(900, "alone", "en", 1, "y")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    wanted = spark.createDataFrame([("s1", 0), ("s1", 100), ("alone", 0), ("s2", 99)], "tree string, rank long")
    ids = {1, 301, 900, 299}
    assert proven(df, wanted) == [e for e in expected(rows) if e[0] in ids]


def test_folding_finds_tampering(spark):
    rows = [(i, f"s{i % 2}", "en", 3, "a\nb" if i % 5 else "ab") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    seen = leaf_digest(*[F.col(c) for c in FIELDS[:-1]], F.replace("text", F.lit("\n"), F.lit("")))
    out = prove(build_manifest(df.withColumn("seen", seen), keep=("doc_id", "seen")))
    for r in out.select("kept.doc_id", "root", "path", path_digest(F.col("path")).alias("digest"),
                        fold(F.col("leaf"), F.col("path")).alias("whole"), fold(F.col("kept.seen"), F.col("path")).alias("bent")).collect():
        assert r.whole == r.root and (r.bent == r.root) == (r.doc_id % 5 == 0)
        assert r.digest == sha(*[s.left + s.right for s in r.path])
