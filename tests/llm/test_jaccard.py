"""The Jaccard join against brute force, and the bounds its candidates rest on."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from laminar.llm import jaccard
from laminar.llm.components import components
from laminar.llm.jaccard import jaccard_components
from tests.llm.conftest import EDGE


def grams(text, width=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return set(zip(*(w[i:] for i in range(width)))) if len(w) >= width else ({tuple(w)} if w else set())


def brute(rows, percent=85):
    sets = [(i, grams(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


def run(spark, rows, **kw):
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), **kw)
    return sorted(map(tuple, got.collect()))


def near_copies(seed, n, words):
    """Groups of drifting copies, so that many pairs lie on both sides of the threshold."""
    rng = random.Random(seed)
    rows, base = [], []
    for i in range(n):
        if i % 25 == 0:
            base = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, words))]
        copy = list(base)
        for _ in range(rng.randrange(0, 4)):
            copy[rng.randrange(len(copy))] = f"w{rng.randrange(60)}"
        if rng.random() < 0.3:
            base = copy
        rows.append((i, " ".join(copy)))
    return rows


@pytest.mark.parametrize("words,seed", [(12, 1), (60, 2), (240, 3)])
def test_components_equal_brute_force(spark, words, seed):
    rows = near_copies(seed, 200, words)
    assert run(spark, rows) == brute(rows)


def test_edge_rows(spark, edge, nothing):
    assert sorted(map(tuple, jaccard_components(edge).collect())) == brute([(i, t) for i, t, _, _ in EDGE])
    assert jaccard_components(nothing).count() == 0


def test_every_linked_pair_shares_a_key():
    rng = np.random.default_rng(5)
    for _ in range(600):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        drop = int(rng.integers(0, max(1, int(len(a) * 0.09) + 1)))
        add = int(rng.integers(0, max(1, int(len(a) * 0.09) + 1)))
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**63, add).astype(np.uint64)]))
        inter = len(np.intersect1d(a, b))
        if 100 * inter < 85 * (len(a) + len(b) - inter):
            continue
        often = np.sort(rng.permutation(np.union1d(a, b))[: int(rng.integers(0, 60))])  # whatever counts as frequent
        assert len(np.intersect1d(jaccard.keys(a, 85, often), jaccard.keys(b, 85, often))), (len(a), len(b), inter)
        x, y = (np.array(jaccard.parity_sketch(s)).view(np.uint64) for s in (a, b))
        assert sum(int(v).bit_count() for v in x ^ y) <= len(a) + len(b) - 2 * inter


def test_long_texts_hash_the_same_in_small_windows(monkeypatch):
    text = jaccard.normalized("Some Words, of every   length " * 50 + "x" * 300)
    whole = jaccard.word_hashes(text)
    monkeypatch.setattr(jaccard, "WINDOW", 37)
    assert (jaccard.word_hashes(text) == whole).all()


@pytest.mark.parametrize("plain", [1 << 15, 0])
def test_exact_comparison_equals_sets(monkeypatch, plain):
    monkeypatch.setattr(jaccard, "PLAIN", plain)
    rng = random.Random(8)
    for _ in range(400):
        width, names = rng.choice([1, 2, 4, 5]), [b"a", b"b", b"c", b"dd"][: rng.randrange(1, 5)]
        one, two = ([rng.choice(names) for _ in range(rng.randrange(1, 30))] for _ in range(2))

        def plain(w):
            return set(zip(*(w[i:] for i in range(width)))) if len(w) >= width else {tuple(w)}

        s, t, percent = plain(one), plain(two), rng.choice([10, 50, 85, 100])
        known = jaccard.Shingled(one, width)
        assert known.size == len(s)
        assert jaccard.linked(known, two, width, percent) == (100 * len(s & t) >= percent * len(s | t))


def test_frequent_passage_in_unlike_documents(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SAMPLE_SHARE", 1)
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    monkeypatch.setattr(jaccard, "PARTNERS", 2)
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 1)
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, passage + " " + " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(rng.choice([3, 8, 20, 40])))) for i in range(60)]
    rows += [(100 + i, t + f" end{i}") for i, t in rows[:20]] + [(200 + i, t) for i, t in rows[:10]] + [(300, passage), (None, 'a text of its own here')]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(jaccard.frequent_shingles(df, 4)) >= 26
    named = [(i, t) for i, t in rows if i is not None]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df).collect()}
    want = {i: (n, c) for i, n, c in brute(named)}
    assert {k: v for k, v in got.items() if k is not None} == want


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_other_columns_names_and_thresholds(spark):
    rows = [(1, "a b c d e f g h i j"), (2, "a b c d e f g h i k"), (3, "z")]
    df = spark.createDataFrame(rows, "key long, body string").withColumn("digest", F.lit("x"))
    got = {r["key"]: r.component_id for r in jaccard_components(df, percent=70, id_col="key", text_col="body").collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_unlike_long_texts_are_not_compared_word_by_word(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{rng.randrange(100000)}" for _ in range(rng.randrange(2600, 4600)))) for i in range(90)]
    words = rows[5][1].split()
    rows.append((200, " ".join(words[:1500] + ["other"] + words[1500:])))
    sent, links = [], jaccard._links

    def counted(pairs, *rest):
        sent.append(pairs.count())
        return links(pairs, *rest)

    monkeypatch.setattr(jaccard, "_links", counted)
    got = run(spark, rows, width=5, percent=80)
    assert [(i, c) for i, _, c in got if i != c] == [(200, 5)]
    assert sum(sent) <= 3


def test_long_sketches_of_two_sizes_never_part_a_linked_pair(spark):
    rng = np.random.default_rng(5)
    for size in (1100, 2040, 4090, 9000):
        one = np.sort(rng.integers(1, 2**63, size, dtype=np.uint64))
        two = np.sort(np.r_[one, rng.integers(1, 2**63, size // 5, dtype=np.uint64)])  # 100 * |one| >= 80 * |two|
        sides = [(len(s), jaccard.parity_sketch(s)[jaccard.SKETCH:]) for s in (one, two)]
        for (m, a), (n, b) in (sides, sides[::-1]):
            row = spark.createDataFrame([(m, n, a, b)], "a_n long, b_n long, a_long array<bigint>, b_long array<bigint>")
            assert row.select(jaccard._long_may_link(80)).first()[0]
            other = jaccard.parity_sketch(np.sort(rng.integers(1, 2**63, n, dtype=np.uint64)))[jaccard.SKETCH:]
            row = spark.createDataFrame([(m, n, a, other)], "a_n long, b_n long, a_long array<bigint>, b_long array<bigint>")
            assert not row.select(jaccard._long_may_link(80)).first()[0]


def test_linked_pairs_meet_in_a_key_that_one_of_them_has_undeleted():
    rng = np.random.default_rng(9)
    for _ in range(60):
        one = rng.integers(1, 2**63, int(rng.integers(20, 300)), dtype=np.uint64)
        gone = int(rng.integers(0, len(one) * 8 // 100 + 1))
        two = np.r_[one[gone:], rng.integers(1, 2**63, gone, dtype=np.uint64)]
        one, two = np.sort(one), np.sort(two)
        known = np.sort(np.union1d(one, two))
        a, b = (jaccard.marked_keys(s, 85, known) for s in (one, two))
        ka, kb = jaccard.unpack_keys(jaccard.pack_keys(a, np.zeros(len(a), np.int64)))[0], jaccard.unpack_keys(jaccard.pack_keys(b, np.ones(len(b), np.int64)))[0]
        both = set(ka >> 1) & set(kb >> 1)
        whole = set(ka[ka & 1 == 0] >> 1) | set(kb[kb & 1 == 0] >> 1)
        assert both & whole


def test_packed_keys_keep_their_classes():
    rng = np.random.default_rng(3)
    for listed in (1, 40, 70000):
        k = rng.integers(0, 2**63, 80000, dtype=np.uint64)
        c = rng.integers(-2**62, 2**62, listed, dtype=np.int64)[rng.integers(0, listed, len(k))]
        key, cls = jaccard.unpack_keys(jaccard.pack_keys(k, c))
        assert (cls == c).all()
        assert (key & 1 == (k & jaccard.DELETED).astype(np.int64)).all() and (key >> 1 == (k >> np.uint64(17)).astype(np.int64)).all()
