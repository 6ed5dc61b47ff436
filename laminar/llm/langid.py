"""Language identification by prediction by partial matching (PPM) over bytes.

Each language has a context tree: for the last ``order`` bytes of a word and every shorter
context it holds how often each next byte followed.  A byte costs minus log2 of its
probability in the longest context that has seen it, plus the escapes (method C) of the
longer contexts that have not; a byte new to all contexts falls back to a uniform code.
The statistics are frozen after training, so a text's code length under a language is an
exact sum.  Contexts begin at a word's leading space, hence a word's code length does not depend
on its neighbours and each distinct word of a task is scored once.

Training sample.  At most ``sample`` documents per language, those with the smallest hash of their id, and of them
no more than the language's share of ``model_chars`` characters.  The languages' counts give a hash below
which a few times that many documents lie; only these are ranked, so no task ranks a whole language.  The trees built
from the sample are the broadcast model: its size is bounded by ``model_chars``, however many languages there are.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laminar.llm.common import held
from laminar.llm.jaccard import word_hashes
from laminar.llm.pieces import STRETCH, WHITE_CUT, stretches
from laminar.operators.joins import bounded_broadcast

ORDER = 5  # bytes of context; a context and its next byte fit one 64-bit key
SAMPLE = 600  # documents per language that the trees are fitted on
SAMPLE_CHARS = 200_000  # longer texts are not sampled
MODEL_CHARS = 64_000_000  # characters that all trees together are fitted on
SPARE = 4  # times the sample that is ranked: far above what chance leaves out
UNKNOWN = "und"
U64 = np.uint64


def _lower(text: str) -> list[bytes]:
    """The words of a text as lower-case UTF-8."""
    return text.lower().encode("utf-8", "surrogatepass").split()


def _layers(words: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all words (a leading space each), the context depth and owner of each byte to code."""
    flat = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)  # each word ends with the next one's space
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    owner = np.repeat(np.arange(len(words)), sizes)
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    depth = np.minimum(np.arange(len(owner)) - first + 1, order)  # bytes since the leading space, that included
    return flat, depth, owner


def _contexts(flat: np.ndarray, n: int, k: int) -> np.ndarray:
    """Keys of the ``k`` bytes before each of the bytes 1..n of ``flat`` (a length mark on top)."""
    key = np.full(n, U64(k + 1) << U64(56))
    at = np.arange(1, n + 1)
    for i in range(k):
        key |= flat[np.maximum(at - 1 - i, 0)].astype(np.uint64) << U64(8 * i + 8)
    return key


class Trees:
    """Frozen statistics of one language: sorted keys with code lengths, one lookup per order."""

    def __init__(self, seen: np.ndarray, count: np.ndarray):
        """``seen``: keys of context and next byte; ``count``: how often each occurred."""
        order = np.argsort(seen)
        self.key, count = seen[order], count[order].astype(np.float64)
        context = self.key & ~U64(0xFF)
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(context) else np.empty(0, int)
        total = np.add.reduceat(count, first) if len(first) else np.empty(0)
        kinds = np.diff(np.r_[first, len(context)])
        self.context = context[first]
        self.bits = -np.log2(count / np.repeat(total + kinds, kinds))
        self.escape = -np.log2(kinds / (total + kinds))

    def cost(self, flat: np.ndarray, depth: np.ndarray, order: int) -> np.ndarray:
        """Bits of each of the bytes 1.. of ``flat``."""
        n = len(depth)
        out, left = np.zeros(n), np.arange(n)
        for k in range(order, -1, -1):
            if not len(left) or not len(self.context):
                break
            at = left[depth[left] >= k]
            context = _contexts(flat, n, k)[at]
            key = context | flat[at + 1].astype(np.uint64)
            i = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = self.key[i] == key
            out[at[hit]] += self.bits[i[hit]]
            miss = at[~hit]
            j = np.minimum(np.searchsorted(self.context, context[~hit]), len(self.context) - 1)
            known = self.context[j] == context[~hit]
            out[miss[known]] += self.escape[j[known]]
            done = np.zeros(n, bool)
            done[at[hit]] = True
            left = left[~done[left]]
        out[left] += 8.0
        return out


def count_grams(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of every context (all orders) with its next byte, and their counts."""
    words = Counter()
    for t in texts:
        words.update(_lower(t))
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    flat, depth, owner = _layers(list(words), order)
    weight = np.fromiter(words.values(), np.int64, len(words))[owner]
    keys, weights = [], []
    for k in range(order + 1):
        at = np.flatnonzero(depth >= k)
        keys.append(_contexts(flat, len(depth), k)[at] | flat[at + 1].astype(np.uint64))
        weights.append(weight[at])
    key, where = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(where, np.concatenate(weights)).astype(np.int64)


def held_out(id_col: Column) -> Column:
    """Fixed by the task: documents whose crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, order: int = ORDER, sample: int = SAMPLE, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang", sample_chars: int = SAMPLE_CHARS,
        model_chars: int = MODEL_CHARS) -> dict[str, Trees]:
    """One context tree per language from a bounded sample of the labelled, not held-out rows.

    Rows with a null text or language, or of over ``sample_chars`` characters, are not learned from.  The counts of
    each language are summed by Spark; what reaches the driver is bounded by ``model_chars``.
    """
    ok = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(F.col(id_col))
                    & (F.length(text_col) <= sample_chars))
    slim = ok.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.length(text_col).alias("chars"),
                     F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 62)).alias("h"))
    # one row per language: how many documents it has, and the hash below which SPARE samples of them lie
    sizes = slim.groupBy("lang").agg(F.count("*").alias("n")).withColumn("share", F.lit(model_chars) / F.count("*").over(Window.partitionBy()))
    below = F.when(F.col("n") <= SPARE * sample, F.lit(1 << 62)).otherwise((F.lit(float(SPARE * sample << 62)) / F.col("n")).cast("long"))
    few = slim.join(bounded_broadcast(sizes.select("lang", below.alias("below"), "share")), "lang").where(F.col("h") < F.col("below"))
    rank = Window.partitionBy("lang").orderBy("h", "id")
    picked = (few.withColumn("r", F.row_number().over(rank)).withColumn("sum", F.sum("chars").over(rank.rowsBetween(Window.unboundedPreceding, 0)))
              .where((F.col("r") <= sample) & ((F.col("sum") <= F.col("share")) | (F.col("r") == 1))).select("lang", "id").distinct())
    rows = ok.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        bounded_broadcast(picked), ["lang", "id"], "left_semi").select("lang", "text")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                key, n = count_grams([t for a, t in zip(langs, texts) if a == lang], order)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key.view(np.int64)),
                                                  pa.array(n)], ["lang", "gram", "n"])

    counted = rows.mapInArrow(grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    got = counted.toArrow()
    langs = np.array(got.column("lang").to_pylist(), dtype=object)
    gram, n = got.column("gram").to_numpy().view(np.uint64), got.column("n").to_numpy()
    return {lang: Trees(gram[langs == lang], n[langs == lang]) for lang in sorted(set(langs.tolist()))}


class Scorer:
    """Code lengths of words under every language; up to ``limit`` words are kept, by their 64-bit hashes."""

    def __init__(self, trees: dict[str, Trees], order: int, limit: int = 3_000_000):
        self.langs, self.trees, self.order, self.limit = list(trees), list(trees.values()), order, limit
        self.forget()

    def forget(self) -> None:
        self.hash = np.empty(0, np.uint64)  # sorted
        self.bits = np.empty((0, len(self.langs)))

    def learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Score new words (their hashes sorted) and merge them into the table."""
        flat, depth, owner = _layers(words, self.order)
        cost = np.stack([np.bincount(owner, t.cost(flat, depth, self.order), len(words)) for t in self.trees], 1)
        where = np.searchsorted(self.hash, hashes)
        self.hash = np.insert(self.hash, where, hashes)
        self.bits = np.insert(self.bits, where, cost, 0)

    def texts(self, texts: list[str]) -> np.ndarray:
        """Total bits per text and language."""
        out = np.zeros((len(texts), len(self.langs)))
        group, size = [], 0
        for i, t in enumerate(texts):
            for s in stretches(t, WHITE_CUT):
                words = b" ".join(_lower(s))
                if words:
                    group.append((i, words))
                    size += len(words)
                if size >= STRETCH:
                    self._add(out, group)
                    group, size = [], 0
        if group:
            self._add(out, group)
        return out

    def _add(self, out: np.ndarray, group: list[tuple[int, bytes]]) -> None:
        buf = b" ".join(words for _, words in group)
        flat = np.frombuffer(buf, np.uint8)
        starts = np.r_[0, np.flatnonzero(flat == 32) + 1]
        kinds, first, which = np.unique(word_hashes(buf), return_index=True, return_inverse=True)
        place = np.searchsorted(self.hash, kinds)
        known = place < len(self.hash)
        known[known] = self.hash[place[known]] == kinds[known]
        if len(self.hash) + int((~known).sum()) > self.limit:
            self.forget()
            known[:] = False
        if not known.all():
            new = first[~known]
            ends = np.r_[starts[1:] - 1, len(buf)]
            self.learn(kinds[~known], [buf[s:e] for s, e in zip(starts[new].tolist(), ends[new].tolist())])
            place = np.searchsorted(self.hash, kinds)
        bits = self.bits[place][which]
        counts = [words.count(b" ") + 1 for _, words in group]
        sums = np.add.reduceat(bits, np.cumsum([0, *counts[:-1]]), axis=0)
        np.add.at(out, [i for i, _ in group], sums)


def predict(docs: DataFrame, trees: dict[str, Trees], order: int = ORDER, id_col: str = "doc_id",
            text_col: str = "text", carry: bool = False) -> DataFrame:
    """``(id, lang_pred, score)``, or with ``carry`` all input columns and these two: the language of the shortest code, and its posterior probability.

    Ties go to the first language in code point order.  A null text, a text without a letter,
    and any text when no language was learned give ``und`` with score 0.  Every input row gives one row;
    other columns do not matter (carried ones named like the two are replaced); an empty table gives no rows; texts
    are scored whole.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")] if carry else [id_col]
    src = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(text_col).alias("text"))
    model, name = docs.sparkSession.sparkContext.broadcast(trees), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = held(("langid", name), lambda: Scorer(model.value, order))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t or "" for t in part.column(len(kept)).to_pylist()]
                langs, scores = [], []
                bits = scorer.texts(texts) if scorer.langs else None
                for i, t in enumerate(texts):
                    if bits is None or not any(map(str.isalpha, t)):
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    best = int(bits[i].argmin())
                    langs.append(scorer.langs[best])
                    scores.append(float(1 / np.exp2(np.maximum(bits[i][best] - bits[i], -1000.0)).sum()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                                 [*part.schema.names[:-1], "lang_pred", "score"])

    ddl = ", ".join(f"c{i} {src.schema[i].dataType.simpleString()}" for i in range(len(kept)))
    return src.mapInArrow(run, f"{ddl}, lang_pred string, score double").toDF(*kept, "lang_pred", "score")
