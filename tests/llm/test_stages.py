"""The pipeline's stages: bounds of the near-duplicate stage, and rows that ids do not tell apart."""

import random
from collections import Counter

import corpus_pipeline
from tests.llm.test_jaccard import grams, near_copies

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def kept(spark, rows):
    return sorted((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, documents(spark, rows), "").collect())


def brute_kept(rows, width=5, percent=80):
    """The row of the smallest id of every component, by the definition."""
    sets, label = [grams(t, width) for _, t in rows], list(range(len(rows)))
    for i, s in enumerate(sets):
        for j, t in enumerate(sets[:i]):
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                label = [label[j] if x == label[i] else x for x in label]
    return sorted(min(r for r, x in zip(rows, label) if x == c) for c in set(label))


def test_near_copies_between_the_bounds_go(spark):
    words = [f"w{i}" for i in range(100)]
    copy = [*words[:30], "x", *words[31:70], "y", *words[71:]]
    s, t = (grams(" ".join(w), 5) for w in (words, copy))
    assert 0.8 <= len(s & t) / len(s | t) < 0.85
    assert kept(spark, [(1, " ".join(words)), (2, " ".join(copy))]) == [(1, " ".join(words))]


def test_near_duplicates_equal_brute_force(spark):
    rows = [(1000 * k + i, t) for k, words in enumerate((12, 60, 240)) for i, t in near_copies(k + 7, 75, words)]
    random.Random(1).shuffle(rows)
    assert brute_kept(rows) != brute_kept(rows, 4, 85)
    assert kept(spark, rows) == brute_kept(rows)


def test_rows_with_null_or_repeated_ids_are_documents_of_their_own(spark):
    long, other = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(None, "no id stands here at all"), (None, "another text that has no id"), (1, "one two three four five"),
            (1, "six seven eight nine ten"), (2, long), (3, long), (3, other), (None, other), (4, None), (5, "a b c d e f"),
            (5, "a b c d e f")]
    want = {(None, "no id stands here at all"), (None, "another text that has no id"), (1, "one two three four five"),
            (1, "six seven eight nine ten"), (2, long), (3, other), (4, None), (5, "a b c d e f")}
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, documents(spark, rows), "").collect()]
    assert len(got) == len(want) and set(got) == want
    assert corpus_pipeline.known_language(spark, documents(spark, rows), "").count() == len(rows) - 1


def test_mixing_takes_each_row_by_itself(spark):
    texts = [f"{t} one two three" for t in "abcdefghij"]
    rows = [(1 if i % 2 else None, t) for i, t in enumerate(texts)]
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.mixed_sources(spark, documents(spark, rows), "").collect())
    assert set(got) == set(rows) and sum(got.values()) == 15 and max(got.values()) == 2
