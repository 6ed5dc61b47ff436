"""Exact n-gram Jaccard join by universe partition and the pigeonhole principle.

A document's set holds its distinct ``width``-word shingles (the whole sequence when it
has fewer words; nothing when it has no words).  Documents link when
``100 * |A & B| >= percent * |A | B|``.

Candidates.  Sizes are cut into bands so that a linked pair lies in one band or in two
neighbouring ones.  Band ``k`` has a bound ``H`` on the symmetric difference of a pair
whose smaller set lies in it, and splits the universe of shingles by hash into
``m = H + 1`` segments (made even).  Two segments form a cell; since the cells together hold
at most ``H < m`` differing shingles, at least one cell of a linked pair differs in at
most one shingle, so one of its segments is equal.  A set therefore indexes each segment as it is, by one
key, unless that segment is a bad key; then its cell is indexed by the whole cell and its one-deletion
neighbourhood too.  Which it is, is the cost-based allocation: an exact key costs as many candidates as there
are sets with the same segment, a neighbourhood costs a key for every shingle of the cell.  The number of sets
with a segment is at most the frequency of its rarest shingle, and that is estimated from a sample of
the documents; an empty segment is shared by a good part of its band.  So a segment whose shingles are all
frequent goes the dearer way.  The choice depends on the segment alone, so both sets of a pair make the same one
for an equal segment, and no link is lost whatever the estimates are.  Each set is indexed
under its own band and the band below.  Of two sets that differ in one shingle of a cell one has the whole cell as it
is, so a key that all its members have by a deletion makes no pair, nor do two such members of any key.

Every key reaches the pairs of its members by stars: the member that shares the most keys
overall is the hub and is verified against each other member.  Members that are not connected
to each other after that are paired across components and verified too.  A pair is dropped
before that if its parity sketches differ in more bits than a linked pair may differ in
shingles; a sketch of fixed size says nothing about long sets, so pairs of these are also compared by sketches that
grow with the set.  All others are verified exactly, on the words.  For that one document is named for each class in question,
the texts of just these documents are read again, and a hub's text meets those of its partners once.
Documents with equal word sequences form one class first, so copies never multiply.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import drop, partitions, release, settle
from laminar.llm.components import components

U64 = np.uint64
_rng = np.random.default_rng(20240611)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE[_SPACE] = 0
_P = 0x9E3779B97F4A7C15
_PARTS = _rng.integers(1, 2**63, 64, dtype=np.uint64) | U64(1)
WINDOW = 1 << 21  # bytes hashed at once; bounds the temporary arrays for texts of any length


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (xor-shift and multiply)."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def normalized(text: str | None) -> bytes:
    """Words (A-Z lower-cased) joined by one space; surrogate-safe bytes."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())


@lru_cache(maxsize=2)
def _powers(n: int) -> np.ndarray:
    out = np.full(n, U64(_P))
    out[0] = 1
    return np.multiply.accumulate(out)


def class_digest(words: bytes) -> bytes:
    """128-bit name of a word sequence."""
    return hashlib.md5(words, usedforsecurity=False).digest()


def word_hashes(buf: bytes) -> np.ndarray:
    """64-bit hash of each word of a buffer of words separated by single spaces."""
    out, at = [], 0
    while at < len(buf):
        end = min(len(buf), at + WINDOW)
        if end < len(buf):
            cut = buf.find(b" ", end)
            end = len(buf) if cut < 0 else cut
        b = np.frombuffer(buf, np.uint8, end - at, at)
        space = b == 32
        start = ~space
        start[1:] &= space[:-1]
        starts = np.flatnonzero(start)
        if len(starts):
            sizes = np.diff(starts, append=len(b))
            place = np.arange(len(b)) - np.repeat(np.r_[0, starts] if starts[0] else starts,
                                                  np.r_[starts[0], sizes] if starts[0] else sizes)
            longest = 1 << int(place.max() + 1).bit_length()
            out.append(mix(np.add.reduceat(_BYTE[b] * _powers(max(longest, 64))[place], starts)))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one word sequence."""
    n = len(words)
    if n == 0:
        return words
    if n < width:
        key = np.array([n], np.uint64)
        for i in range(n):
            key = mix(key * U64(_P) + words[i: i + 1] * _PARTS[i])
        return key
    acc = words[: n - width + 1] * _PARTS[0]
    for i in range(1, width):
        acc = acc + words[i: n - width + 1 + i] * _PARTS[i % 64] * U64(2 * (i // 64) + 1)
    s = np.sort(mix(acc))
    return s[np.r_[True, s[1:] != s[:-1]]]


@lru_cache(maxsize=8)
def bands(percent: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower size bounds of the bands up to size ``reach``, and the number of segments of each."""
    low = [1]
    while low[-1] <= reach:
        low.append(max(low[-1] + 1, 100 * low[-1] // percent + 1))
    segments = []
    for k in range(len(low) - 1):
        a = low[k + 1] - 1
        total = a + 100 * a // percent
        h = max(s - 2 * -(-percent * s // (100 + percent)) for s in (total, total - 1) if s >= 2)
        segments.append(1 if h <= 0 else 2 * ((h + 2) // 2))
    return np.array(low), np.array(segments)


DELETED = U64(1)  # the bit of a key that tells how it was made


def keys(sets: np.ndarray, percent: int, frequent: np.ndarray) -> np.ndarray:
    """Index keys of one set under its own band and the band below; ``frequent`` holds sorted hashes of frequent shingles."""
    return marked_keys(sets, percent, frequent) & ~DELETED


def marked_keys(sets: np.ndarray, percent: int, frequent: np.ndarray) -> np.ndarray:
    """The ``keys`` of one set, each with a lowest bit that tells whether a deletion made it."""
    n = len(sets)
    low, segments = bands(percent, 1 << max(10, n.bit_length()))
    own = int(np.searchsorted(low, n, "right")) - 1
    rare = ~_among(sets, frequent)
    out = []
    for k in (own, own - 1):
        if k < 0:
            continue
        m, salt = int(segments[k]), mix(np.array([k + 1], np.uint64))
        if m == 1:
            out.append(mix(np.add.reduce(mix(sets ^ salt), keepdims=True) + salt) & ~DELETED)
            continue
        where = ((sets >> U64(32)) * U64(m) >> U64(32)).astype(np.int64)  # sets are sorted, so this is too
        value = mix(sets ^ salt)
        total = np.zeros(m, np.uint64)
        np.add.at(total, where, value)
        tag = mix((np.arange(m, dtype=np.uint64) + U64(1)) * U64(_P) + salt)
        good = np.bincount(where[rare], minlength=m) > 0  # holds a shingle that few sets have
        out.append(mix(total[good] + tag[good]) & ~DELETED)
        cell_poor = ~good[0::2] | ~good[1::2]
        if cell_poor.any():
            cells = np.flatnonzero(cell_poor)
            whole = total[0::2][cells] + total[1::2][cells]
            cell_tag = mix(tag[0::2][cells] + U64(7))
            out.append(mix(whole + cell_tag) & ~DELETED)
            lookup = np.full(m // 2, -1)
            lookup[cells] = np.arange(len(cells))
            at = lookup[where >> 1]
            inside = at >= 0
            at = at[inside]
            out.append(mix(whole[at] - value[inside] + cell_tag[at]) | DELETED)
    return np.concatenate(out)


SAMPLE_SHARE, SAMPLE_MOST = 32, 1 << 20  # the sample is one document in 32, a million at most
SEEN, FREQUENT = 6, 1 << 17  # a shingle of that many unlike sampled documents is frequent; so many of them are kept


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which items of ``x`` are in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def frequent_shingles(src: DataFrame, width: int) -> np.ndarray:
    """Hashes of shingles that many unlike documents have, by a bounded sample: they steer costs, not results.

    Near copies share a shingle too, but there an exact key is what finds them; so documents count as one if
    their least shingle (a min-hash) is the same.
    """
    n = src.count()
    every = max(SAMPLE_SHARE, -(-n // SAMPLE_MOST))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for text in batch.column(0):
                sets = shingles(word_hashes(normalized(text.as_py())), width)
                for at in range(0, len(sets), 1 << 16):
                    part = sets[at: at + (1 << 16)].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.full(len(part), sets.view(np.int64)[0]))], names=["shingle", "least"])

    sample = src.select("text").where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).distinct()
    counted = (sample.mapInArrow(run, "shingle long, least long").groupBy("shingle").agg(F.count_distinct("least").alias("seen"))
               .where(F.col("seen") >= SEEN))
    top = counted.orderBy(F.col("seen").desc(), "shingle").limit(FREQUENT).select("shingle").toArrow()
    return np.sort(top.column(0).to_numpy().astype(np.int64).view(np.uint64))


# Rows of the pass over the texts: memberships, classes with their sketches, packed index keys, members of shared keys.
_ROWS = "kind int, part int, doc_id {id}, digest binary, n long, x long, data binary, sketch array<bigint>"
SKETCH = 16  # 64-bit words of a parity sketch
LONG = 64 * SKETCH  # sets with more items than that have a long sketch too, with a bit an item or more
MEMBER, CLASS, KEYS, SHARED = 0, 1, 2, 3
FLUSH = 1 << 18  # index keys a task holds before it packs them by target partition; 16 a partition if that is more


def parity_sketch(sets: np.ndarray) -> list[int]:
    """Parities of the set's counts per hash cell: two sketches differ in at most as many bits as the sets in items.

    The sketch of ``SKETCH`` words is followed by that of a long set, which has a power of two of bits.
    """
    out = []
    for bits in (64 * SKETCH, *([1 << (len(sets) - 1).bit_length()] if len(sets) > LONG else [])):
        odd = np.bincount((sets & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
        out += np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()
    return out


def _may_link(percent: int) -> Column:
    """Whether sizes and sketches of the sides ``a`` and ``b`` allow a link (never false for a linked pair)."""
    bits = sum((F.bit_count(F.col(f"a_s{i}").bitwiseXOR(F.col(f"b_s{i}"))) for i in range(SKETCH)), F.lit(0))
    return (100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")) & (bits <= _may_differ(percent))


def _may_differ(percent: int) -> Column:
    """Items that only one side of a linked pair has, at most."""
    total = F.col("a_n") + F.col("b_n")
    least = F.ceil(percent * total / (100 + percent) - 1e-9)  # items a linked pair has in common
    return total - 2 * least


def _long_may_link(percent: int) -> Column:
    """Whether the long sketches of ``a`` and ``b`` allow a link; the larger one is folded if it has twice the bits."""
    def folded(one: str, other: str) -> Column:
        half = (F.size(one) / 2).cast("int")
        both = F.zip_with(F.slice(one, F.lit(1), half), F.slice(one, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(one) > F.size(other), both).otherwise(F.col(one))

    each = F.zip_with(folded("a_long", "b_long"), folded("b_long", "a_long"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    bits = F.aggregate(each, F.lit(0), lambda s, x: s + x)
    return F.coalesce(bits <= _may_differ(percent), F.lit(True))  # null where sizes differ by more


def _sketched(prefix: str) -> list[Column]:
    return [F.col("n").alias(f"{prefix}_n"), *[F.col("sketch")[i].alias(f"{prefix}_s{i}") for i in range(SKETCH)]]


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("doc_id", id_type), ("digest", pa.binary()),
                      ("n", pa.int64()), ("x", pa.int64()), ("data", pa.binary()),
                      ("sketch", pa.list_(pa.int64()))])


def pack_keys(k: np.ndarray, c: np.ndarray) -> bytes:
    """Keys and their classes in about ten bytes each: 48 bits of a key, and a class by its place in a list.

    Two keys that agree in these bits count as one, which makes a few more candidates and loses none.
    """
    listed, at = np.unique(c, return_inverse=True)
    place = at.astype(np.uint16 if len(listed) <= 1 << 16 else np.uint32)
    k = (k >> U64(16)) & ~DELETED | (k & DELETED)
    head = np.array([len(k), len(listed)], np.int64)
    return b"".join([head.tobytes(), listed.tobytes(), (k >> U64(16)).astype(np.uint32).tobytes(), place.tobytes(), k.astype(np.uint16).tobytes()])


def unpack_keys(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, m = (int(x) for x in np.frombuffer(data, np.int64, 2))
    kind = np.dtype(np.uint16 if m <= 1 << 16 else np.uint32)
    at = 16 + 8 * m
    high = np.frombuffer(data, np.uint32, n, at).astype(np.int64)
    place = np.frombuffer(data, kind, n, at + 4 * n)
    low = np.frombuffer(data, np.uint16, n, at + (4 + kind.itemsize) * n)
    return high << 16 | low, np.frombuffer(data, np.int64, m, 16)[place]


def _index_pass(parts: int, width: int, percent: int, frequent: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        seen: set[bytes] = set()  # classes this task has indexed (16 bytes each)
        held_key, held_class, held, turn = [], [], 0, 0

        def pack(schema):
            k, c = np.concatenate(held_key), np.concatenate(held_class)
            part = ((k >> U64(1)) % U64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            k, c, part = k[order], c[order], part[order]
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            return _batch(schema, [(KEYS, int(part[s]), None, None, None, None, pack_keys(k[s:e], c[s:e]), None)
                                   for s, e in zip(cuts, np.r_[cuts[1:], len(part)])])

        for batch in batches:
            schema = _schema(batch.schema.field(0).type)
            for at in range(0, batch.num_rows, 512):
                some, rows = batch.slice(at, 512), []
                for doc, text in zip(some.column(0).to_pylist(), some.column(1)):
                    turn += 1
                    words = normalized(text.as_py())
                    if not words:
                        rows.append((MEMBER, turn % parts, doc, None, 0, None, None, None))
                        continue
                    digest = class_digest(words)
                    sets = shingles(word_hashes(words), width)
                    rows.append((MEMBER, turn % parts, doc, digest, len(sets), None, None, None))
                    if digest in seen:
                        continue
                    seen.add(digest)
                    cls = int.from_bytes(digest[:8], "little", signed=True)
                    rows.append((CLASS, turn % parts, None, digest, len(sets), cls, None, parity_sketch(sets)))
                    k = marked_keys(sets, percent, frequent)
                    held_key.append(k)
                    held_class.append(np.full(len(k), cls, np.int64))
                    held += len(k)
                    if held >= max(FLUSH, 16 * parts):
                        yield pack(schema)
                        held_key, held_class, held = [], [], 0
                yield _batch(schema, rows)
        if held:
            yield pack(schema)

    return run


def _bucket_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unpack one partition's keys, and emit the members of each key that several classes share, one of them undeleted.

    Of a member made by a deletion ``part`` is 1, of others 0.
    """
    release()
    held_key, held_class, schema = [], [], None
    for batch in batches:
        schema = batch.schema
        kind = batch.column(0).to_numpy()
        for i in np.flatnonzero(kind == KEYS):
            k, c = unpack_keys(batch.column(6)[int(i)].as_py())
            held_key.append(k)
            held_class.append(c)
        yield batch.filter(pa.array(kind != KEYS))
    if held_key:
        k, c = np.concatenate(held_key), np.concatenate(held_class)
        held_key, held_class = [], []
        order = np.lexsort((k & 1, c, k >> 1))  # of a class that has a key both ways, the undeleted one comes first
        k, c = k[order], c[order]
        deleted, k = (k & 1).astype(np.int32), k >> 1
        fresh = np.r_[True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])]
        k, c, deleted = k[fresh], c[fresh], deleted[fresh]
        first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        size = np.diff(np.r_[first, len(k)])
        many = np.repeat((size > 1) & (np.minimum.reduceat(deleted, first) == 0), size)
        k, c, deleted = k[many], c[many], deleted[many]
        for at in range(0, len(k), 1 << 16):
            m = len(k[at: at + (1 << 16)])
            null = [pa.nulls(m, f.type) for f in schema]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, SHARED, np.int32)), pa.array(deleted[at: at + m]), null[2], null[3],
                                              pa.array(k[at: at + m]), pa.array(c[at: at + m]), null[6], null[7]], schema=schema)


def _words_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and compressed words of every text, equal ones of a task once."""
    release()
    seen: set[bytes] = set()
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            rows = []
            for text in batch.slice(at, 512).column(0):
                words = normalized(text.as_py())
                digest = class_digest(words)
                if words and digest not in seen:
                    seen.add(digest)
                    rows.append((digest, press.compress(words)))
            yield _batch(pa.schema([("digest", pa.binary()), ("data", pa.binary())]), rows)


PLAIN = 1 << 15  # words up to which shingles are compared as sets of word tuples; longer lists are coded in arrays


class Shingled:
    """The distinct shingles of a word list, for exact comparison with other lists.

    Long lists are coded without loss: words by number, then step by step each prefix of a shingle, which takes a
    twentieth of the memory of tuples.
    """

    def __init__(self, words: list[bytes], width: int) -> None:
        self.words, self.width = words, min(width, len(words))
        self.grams = self._tuples(words) if len(words) <= PLAIN else None
        if self.grams is not None:
            self.size = len(self.grams)
            return
        self.numbers: dict[bytes, int] = {}
        code, *rest = self._columns(np.fromiter((self.numbers.setdefault(w, len(self.numbers)) for w in words), np.int64, len(words)))
        self.steps, self.size = [], len(np.unique(code))
        for nxt in rest:
            known, code = np.unique(code * len(self.numbers) + nxt, return_inverse=True)
            self.steps.append(known)
            self.size = len(known)

    def _tuples(self, words: list[bytes]) -> set:
        return set(zip(*(words[i:] for i in range(self.width))))

    def _columns(self, ids: np.ndarray) -> list[np.ndarray]:
        count = len(ids) - self.width + 1
        return [ids[i: i + count] for i in range(self.width)]

    def compare(self, words: list[bytes]) -> tuple[int, int]:
        """How many distinct shingles ``words`` has in common, and how many it has; it is no shorter than a shingle."""
        if self.grams is not None:
            other = self._tuples(words)
            return len(self.grams & other), len(other)
        code, *rest = self._columns(np.fromiter((self.numbers.get(w, -1) for w in words), np.int64, len(words)))
        for nxt, known in zip(rest, self.steps):
            both = code * len(self.numbers) + nxt
            at = np.minimum(np.searchsorted(known, both), len(known) - 1)
            code = np.where((code >= 0) & (nxt >= 0) & (known[at] == both), at, -1)
        return len(np.unique(code[code >= 0])), Shingled(words, self.width).size


def linked(one: Shingled, other: list[bytes], width: int, percent: int) -> bool:
    """Whether two non-empty word lists link; lists shorter than a shingle are one shingle each."""
    if min(len(one.words), len(other)) < width:
        return one.words == other
    inter, size = one.compare(other)
    return 100 * inter >= percent * (one.size + size - inter)


def _verify_pass(width: int, percent: int):
    """Pairs that link, of rows ``(hub, salt, partner, data)`` in order: a hub's own text comes before its partners'."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        words = zstandard.ZstdDecompressor()
        hub, own = None, None
        for batch in batches:
            out = []
            for start in range(0, batch.num_rows, 256):
                for a, b, data in zip(*(batch.slice(start, 256).column(i).to_pylist() for i in (0, 2, 3))):
                    text = words.decompress(data).split()
                    if b is None:
                        hub, own = a, Shingled(text, width)
                    elif hub == a and linked(own, text, width, percent):
                        out.append((a, b))
            yield _batch(pa.schema([("a", pa.binary()), ("b", pa.binary())]), out)

    return run


def _sieved(pairs: DataFrame, long: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` without those whose long sketches tell that they do not link."""
    side = {s: long.select(F.col("digest").alias(f"{s}_digest"), F.col("n").alias(f"{s}_n"), F.col("long").alias(f"{s}_long")) for s in "ab"}
    both = pairs.join(side["a"], F.col("a") == F.col("a_digest"), "left").join(side["b"], F.col("b") == F.col("b_digest"), "left")
    return both.where(F.col("a_long").isNull() | F.col("b_long").isNull() | _long_may_link(percent)).select("a", "b")


def _candidates(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes ``(a, b)`` as digests, those that sizes and sketches allow to link."""
    side = {s: classes.select(F.col("x").alias(s), F.col("digest").alias(f"{s}_digest"), *_sketched(s)) for s in "ab"}
    left = pairs.join(side["a"], "a").alias("l")
    return left.join(side["b"].alias("r"), (F.col("l.b") == F.col("r.b")) & _may_link(percent)
                     & (F.col("a_digest") != F.col("b_digest"))).select(F.col("a_digest").alias("a"), F.col("b_digest").alias("b"))


BROADCAST_IDS = 1 << 20  # ids of documents to read again that are broadcast; more are joined by shuffle
PARTNERS = 4096  # texts compared with one copy of a hub's


def _texts(digests: DataFrame, member: DataFrame, src: DataFrame) -> DataFrame:
    """``(digest, data)`` of the wanted classes: ids first, then only these documents' texts."""
    named = settle(member.join(digests, "digest", "left_semi").groupBy("digest").agg(F.min("doc_id").alias("wanted")), "named")
    ids = named.select("wanted").distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    some = src.join(ids, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")  # an id may be null or repeated
    texts = settle(some.select("text").mapInArrow(_words_pass, "digest binary, data binary")
                   .join(named.select("digest"), "digest", "left_semi").dropDuplicates(["digest"]), "texts")
    drop(named)
    return texts


def _links(pairs: DataFrame, member: DataFrame, src: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs of digests whose texts really link.  ``a`` is the hub: its text is sent once for many partners."""
    pairs = settle(pairs, "pairs")
    texts = _texts(pairs.select(F.col("a").alias("digest")).unionByName(pairs.select(F.col("b").alias("digest"))).distinct(), member, src)
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).alias("salts"))
    salted = pairs.join(salts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"))
    partners = salted.join(texts.withColumnRenamed("digest", "b"), "b").select("a", "salt", "b", "data")
    hubs = (salts.join(texts.withColumnRenamed("digest", "a"), "a")
            .select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("binary").alias("b"), "data"))
    both = (hubs.unionByName(partners).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first()))
    found = settle(both.mapInArrow(_verify_pass(width, percent), "a binary, b binary"), "links")
    drop(pairs, texts)
    return found


BLOCK = 1024  # members of a key that are compared in one place


def _across(rest: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of one key that lie in different components, none of them the key's hub, if they may link.

    Two members that have the key by a deletion make no pair: if they link, another key tells.

    The members of a key are dealt into blocks, and pairs of blocks meet in different tasks.
    """
    many = rest.groupBy(F.col("key").alias("k")).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = rest.join(many, F.col("key") == F.col("k")).withColumn("block", F.pmod(F.xxhash64("cls", F.lit("block")), F.col("blocks")))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    one = dealt.select("key", F.col("block").alias("i"), every.alias("j"), F.col("cls").alias("a"), F.col("digest").alias("da"),
                       F.col("comp").alias("ca"), F.col("hub").alias("ha"), F.col("deleted").alias("xa"), *_sketched("a")).alias("l")
    two = dealt.select("key", every.alias("i"), F.col("block").alias("j"), F.col("cls").alias("b"), F.col("digest").alias("db"),
                       F.col("comp").alias("cb"), F.col("deleted").alias("xb"), *_sketched("b")).alias("r")
    meet = (F.col("l.key") == F.col("r.key")) & (F.col("l.i") == F.col("r.i")) & (F.col("l.j") == F.col("r.j"))
    wanted = (F.col("ca") < F.col("cb")) & (F.col("ha") != F.col("a")) & (F.col("ha") != F.col("b")) & (F.col("xa") + F.col("xb") < 2)
    return (one.join(two, meet & wanted & _may_link(percent))
            .select(F.least("da", "db").alias("a"), F.greatest("da", "db").alias("b")).distinct())


def jaccard_components(docs: DataFrame, width: int = 4, percent: int = 85,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``(id, n_shingles, component_id)``.

    Words are runs of bytes other than the six ASCII white-space bytes, A-Z lower-cased.
    ``component_id`` is the smallest id reachable over links, itself included.  Null and
    empty texts have ``n_shingles`` 0 and stand alone.  Repeated rows and equal texts are
    one class (linked, since their sets are equal).  An empty table gives no rows; other
    columns are ignored.  Texts of any length are used whole.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ddl = _ROWS.format(id=src.schema["doc_id"].dataType.simpleString())
    rows = settle(src.mapInArrow(_index_pass(parts, width, percent, frequent_shingles(src, width)), ddl)
                  .repartitionById(parts, "part").mapInArrow(_bucket_pass, ddl), "jaccard")
    member = rows.where(F.col("kind") == MEMBER).select("doc_id", "digest", "n")
    classes = rows.where(F.col("kind") == CLASS).select("x", "digest", "n", F.slice("sketch", 1, SKETCH).alias("sketch"))
    long = (rows.where((F.col("kind") == CLASS) & (F.col("n") > LONG))
            .select("digest", "n", F.slice("sketch", F.lit(SKETCH + 1), F.size("sketch")).alias("long")).dropDuplicates(["digest"]))
    shared = rows.where(F.col("kind") == SHARED).select(F.col("n").alias("key"), F.col("x").alias("cls"), F.col("part").alias("deleted"))
    # of the members of a key, the one in the most shared keys is the hub
    weighed = shared.join(shared.groupBy("cls").agg(F.count("*").alias("w")), "cls")
    hubs = weighed.groupBy("key").agg(F.max(F.struct("w", "cls"))["cls"].alias("hub"))
    star = settle(shared.join(hubs, "key"), "stars")
    # the classes that share a key with another one, once each
    classes = settle(classes.join(star.select(F.col("cls").alias("x")).distinct(), "x", "left_semi")
                     .dropDuplicates(["digest"]), "classes")
    spokes = star.where(F.col("hub") != F.col("cls")).select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct()
    first = _links(_sieved(_candidates(spokes, classes, percent), long, percent), member, src, width, percent)
    label = settle(components(first), "labels")

    # members of a key that the stars left in different components are paired too
    named = classes.join(label.select(F.col("node").alias("digest"), "component"), "digest", "left").select(
        F.col("x").alias("cls"), "digest", F.coalesce("component", "digest").alias("comp"), "n", "sketch")
    placed = star.join(named.select("cls", "comp"), "cls")
    split = (placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .where(F.col("lo") != F.col("hi")).select("key"))
    rest = settle(star.join(split, "key", "left_semi").join(named, "cls"), "rest")
    cross = settle(_sieved(_across(rest, percent), long, percent), "pairs")
    drop(rest, star, classes)
    if not cross.isEmpty():
        second = _links(cross, member, src, width, percent)
        if not second.isEmpty():
            label = settle(components(first.unionByName(second)), "labels")
        drop(second)
    drop(first, cross)

    labelled = settle(member.join(label.withColumnRenamed("node", "digest"), "digest", "left").select(
        "doc_id", "n", F.coalesce("component", "digest").alias("component")), "labelled")
    drop(rows, label)
    worded = labelled.where(F.col("n") > 0)
    # written, so that the join reads plain shuffles and a large component can be split
    lowest = settle(worded.groupBy("component").agg(F.min("doc_id").alias("component_id")), "lowest")
    out = worded.join(lowest, "component").select("doc_id", "n", "component_id").unionByName(
        labelled.where(F.col("n") == 0).select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return out.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
