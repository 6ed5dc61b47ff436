"""Prefix counts, merge replay and id planes against the public libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from laminar.llm import bitplanes, bpe, pieces, prefix, queries
from laminar.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.conftest import EDGE

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SIGNS = list("aabcde 'sStrRl1234567890\t\n\r\x0b\x1c\x85\xa0　éßİΣΩ日本語한국어🙂é‍!?.,-_²½ªºǅ") + ["<|endoftext|>", "'re", "'LL", "<|end"]


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 80))) for _ in range(n)]


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def test_prefix_counts_equal_the_library_at_every_prefix():
    lib, index = Tokenizer.from_file(WORD), prefix.PrefixIndex(WORD)
    for text in odd_texts(120):
        text = prefix.fold(text) if "<|" not in text else "".join(c for c in text if prefix.fold(c) == c)
        counts = prefix.counts_at(index.run([text])[0])
        want = [len(e.ids) for e in lib.encode_batch([text[:i] for i in range(len(text) + 1)], add_special_tokens=False)]
        assert counts.tolist() == want, repr(text)


def test_op2_equals_the_library(spark, edge, nothing):
    lib = Tokenizer.from_file(WORD)
    got = prefix.prefix_index(edge, WORD).select("doc_id", "n_bytes", "n_tokens").collect()
    want = [(i, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t, _, _ in EDGE]
    assert sorted(map(tuple, got)) == sorted(want)
    assert prefix.prefix_index(nothing, WORD).count() == 0
    rows = queries.op2_token_counts(spark, SF_SMALL).join(table(spark, SF_SMALL, "documents"), "doc_id").collect()
    assert len(rows) == 200
    for r in rows:
        n = len(lib.encode(r.text, add_special_tokens=False).ids)
        assert (r.n_tokens, r.over_limit, r.n_bytes) == (n, n > 2048, len(r.text.encode()))


def test_budget_is_read_off_the_index(edge):
    lib = Tokenizer.from_file(WORD)
    index = prefix.prefix_index(edge, WORD)
    texts = {i: t or "" for i, t, _, _ in EDGE}
    for r in prefix.fit_budget(index, 5).collect():
        text = prefix.fold(texts[r.doc_id])
        counts = [len(lib.encode(text[:k], add_special_tokens=False).ids) for k in range(min(len(text), 60) + 1)]
        if len(text) <= 60 and "<|" not in text:
            assert r.keep_chars == max(k for k, n in enumerate(counts) if n <= 5)


def test_merge_replay_equals_tiktoken(tik):
    replay = bpe.MergeReplay(bpe.load_ranks(RANKS))
    words = sorted({p for t in odd_texts(800) for p in pieces.split(t)})
    for w, ids in zip(words, replay.replay([w.encode() for w in words])):
        assert np.frombuffer(ids, "<u4").tolist() == tik.encode_ordinary(w), repr(w)


def test_lower_rank_pairs_that_arise_late_go_first():
    # "cd" (rank 3) only becomes possible after "ab" (rank 4) and "abc" (rank 2) beats the second "ab"
    ranks = {bytes([b]): 100 + b for b in range(256)} | {b"ab": 4, b"abab": 2, b"ababab": 1, b"bc": 5}
    replay = bpe.MergeReplay(ranks)

    def plain(w):
        parts = [bytes([b]) for b in w]
        while True:
            pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not pairs:
                return [ranks[p] for p in parts]
            i = min(pairs)[1]
            parts[i: i + 2] = [parts[i] + parts[i + 1]]

    for w in (b"ababab", b"abababab", b"abcab", b"aab", b"babab", b"ababcab"):
        assert np.frombuffer(replay.replay([b"zz", w])[1], "<u4").tolist() == plain(w), w


def test_small_stretches_and_a_small_table_change_nothing(tik, monkeypatch):
    monkeypatch.setattr(pieces, "STRETCH", 40)
    replay = bpe.MergeReplay(bpe.load_ranks(RANKS)).replay
    table_ = pieces.PieceTable(lambda new: replay([p.encode() for p in new]), limit=10)
    texts = ["Some words, then more words " * 9, "", "x" * 200, *odd_texts(50)]
    for t, ids in zip(texts, table_.run(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tik.encode_ordinary(t)


def scripts(rng, n):
    """Texts in scripts without ASCII letters, without spaces, or of signs and digits mostly."""
    def words(letters, gaps, size):
        return "".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 7))) + rng.choice(gaps) for _ in range(size))

    kinds = [("日本語の文章を書く漢字仮名", ["，", "。", "、", "“", "」", ""]), ("日本語の文章", [" ", "。 ", "\n"]),
             ("привет мир ёжик".replace(" ", ""), [" ", ", ", ".\n", "  ", "\u3000", "'s ", " 's"]), ("αβγδΣς", [" ", "·", "; "]),
             ("0123456789", [" ", ", ", "\n\n", " - "]), ("abc_xyz(){};=+", [";", " ", "{", "\t"]), ("กขคงจ่้", [" ", "ๆ", ""]),
             ("नमस्ते", [" ", "। ", ""]), ("e\u0301a\u0308o", [" ", "", "."])]
    return [words(a, g, n) for a, g in kinds]


def test_stretches_of_any_script_are_short_and_change_nothing(tik, monkeypatch):
    rng = random.Random(12)
    monkeypatch.setattr(pieces, "STRETCH", 40)
    texts = scripts(rng, 60)
    replay = bpe.MergeReplay(bpe.load_ranks(RANKS)).replay
    for t, ids in zip(texts, pieces.PieceTable(lambda new: replay([p.encode() for p in new])).run(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tik.encode_ordinary(t)
    byte, word = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
    texts += [t[:30] + "<|endoftext|>" + t[30:] for t in texts]
    for t, ids in zip(texts, bitplanes.Vocabulary(BYTE).run(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == byte.encode(t, add_special_tokens=False).ids
    for t, changes in zip(texts, prefix.PrefixIndex(WORD).run(texts)):
        assert int(np.frombuffer(changes, np.int8).sum(dtype=np.int64)) == len(word.encode(t, add_special_tokens=False).ids)
    monkeypatch.setattr(pieces, "STRETCH", 1 << 14)
    for t in scripts(rng, 1 << 14)[:6]:
        assert max(map(len, pieces.stretches(t))) < (1 << 14) + 200 and "".join(pieces.stretches(t)) == t


def test_op3_round_trip(spark, edge, nothing, tik):
    done = bpe.decode(bpe.encode(edge, RANKS), RANKS).collect()
    assert len(done) == len(EDGE)
    want = sorted((i, tik.encode_ordinary(t or ""), (t or "").encode()) for i, t, _, _ in EDGE)
    assert sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in done) == want
    assert bpe.decode(bpe.encode(nothing, RANKS), RANKS).count() == 0
    for r in queries.op3_byte_bpe(spark, SF_SMALL).join(table(spark, SF_SMALL, "documents"), "doc_id").collect():
        ids = tik.encode_ordinary(r.text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [0, 1, 4095, 4096, 10000])
def test_planes_round_trip(n, bits):
    ids = np.random.default_rng(n).integers(0, 2**32, n).astype("<u4")
    assert (bitplanes.unpack(bitplanes.pack(ids, bits)) == ids).all()


def test_op7_files_equal_the_library(spark, edge, nothing, tmp_path, monkeypatch):
    monkeypatch.setattr(bitplanes, "CHUNK", 50)
    lib = Tokenizer.from_file(BYTE)
    for bits in (False, True):
        out = f"{tmp_path}/{bits}"
        bitplanes.write_ids(edge, BYTE, 2, out, bits)
        rows = sorted(map(tuple, bitplanes.read_ids(spark, out).collect()), key=lambda r: r[1])
        ids = {i: lib.encode(t or "", add_special_tokens=False).ids + [2] for i, t, _, _ in EDGE}
        assert [r[0] for r in rows] == sorted(i for i, _, _, _ in EDGE)
        at = 0
        for doc, start, data in rows:
            assert (start, np.frombuffer(data, "<u4").tolist()) == (at, ids[doc])
            at += len(ids[doc])
        chunks = bitplanes.chunk_index(spark, out).orderBy("start").collect()
        assert sum(c.n_ids for c in chunks) == at and chunks[0].start == 0
    bitplanes.write_ids(nothing, BYTE, 2, f"{tmp_path}/none")
    assert bitplanes.read_ids(spark, f"{tmp_path}/none").count() == 0
    start = 0
    for r in queries.op7_token_id_planes(spark, SF_SMALL).join(table(spark, SF_SMALL, "documents"), "doc_id").orderBy("doc_id").collect():
        raw = np.array(lib.encode(r.text, add_special_tokens=False).ids + [2], "<u4").tobytes()
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(raw) // 4, zlib.crc32(raw))
        start += r.n_tokens


def test_a_null_id_is_written_first(spark, tmp_path):
    rows = spark.createDataFrame([(None, "b"), (3, "a")], "doc_id long, text string").withColumn("extra", F.lit(1))
    bitplanes.write_ids(rows, BYTE, 2, f"{tmp_path}/x")
    assert [r.doc_id for r in bitplanes.read_ids(spark, f"{tmp_path}/x").orderBy("start").collect()] == [-(1 << 63), 3]
