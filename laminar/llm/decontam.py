"""Benchmark decontamination: exact containment of item windows by a prefix-filtered set join.

A window is a run of ``window`` consecutive words of a benchmark item (the whole item when it has fewer).  A
document contains a window only if it contains each of the window's shingles, so one shingle, the rarest,
is a sufficient prefix of the window's set:

1. count, over all documents, how often each shingle of the benchmark occurs;
2. order each window's shingles by that rarity; a window whose rarest shingle never occurs is settled here;
3. join the documents' shingles with the rarest shingle of each remaining window;
4. keep a match if the window, placed by the shingle's position, lies inside the document (length and position),
   and if the words there are those of the window (exact).

Scale.  The benchmark's side is broadcast in blocks whose size is bounded by ``BLOCK_BYTES``, with one scan of the
documents for each block, so neither a large benchmark nor a frequent shingle concentrates rows in a task.
Texts are never shuffled: what leaves a scan is one narrow row per document and one per real occurrence.
"""

from __future__ import annotations

import math
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import settle

# Fixed by the task: what separates words, after A-Z became a-z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 3  # words of a shingle; shorter windows are one shingle of all their words
BLOCK_BYTES = 64 << 20  # bound on what one block of the benchmark broadcasts
_ROW_BYTES = 160  # a broadcast row without its words


def lowered(text: Column) -> Column:
    """A-Z as a-z, nothing else changed; null as empty."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)  # ASCII only, where lower() changes just A-Z
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def words_of(text: Column) -> Column:
    return F.filter(F.split(lowered(text), SEPARATORS), lambda w: w != "")


def _shingles(words: Column, width: int) -> Column:
    """64-bit hashes of the shingles of ``width`` words, by position."""
    n = F.size(words)
    hashed = F.transform(F.sequence(F.lit(1), n - (width - 1)),
                         lambda i: F.xxhash64(F.lit(width), *[F.element_at(words, i + k) for k in range(width)]))
    return F.when(n >= width, hashed).otherwise(F.array().cast("array<bigint>"))


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, id_col: str = "item_id",
                 text_col: str = "text") -> DataFrame:
    """``(item, win, words, n, width)``: the distinct windows of each item; items without words have none."""
    split = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words_of(F.col(text_col)).alias("all"))
    n = F.size("all")
    parts = F.when(n >= window, F.transform(F.sequence(F.lit(1), n - (window - 1)), lambda i: F.slice("all", i, window)))
    parts = parts.when(n > 0, F.array("all")).otherwise(F.array().cast("array<array<string>>"))
    return (split.select("item", F.explode(parts).alias("words")).distinct()
            .select("item", F.md5(F.array_join("words", " ")).alias("win"), "words", F.size("words").alias("n"),
                    F.least(F.size("words"), F.lit(shingle)).alias("width")))


def _blocks(rows: DataFrame, size: Column, key: str) -> list[DataFrame]:
    """``rows`` in parts by hash of ``key``, each small enough to broadcast."""
    total = rows.agg(F.sum(size + _ROW_BYTES)).first()[0] or 0
    many = max(1, math.ceil(total / BLOCK_BYTES))
    return [rows if many == 1 else rows.where(F.pmod(F.xxhash64(F.lit("block"), key), F.lit(many)) == b) for b in range(many)]


def find_windows(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                 id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: ``(doc_id, n_words, spans, items)``.

    ``spans`` are the occurrences ``(start, length)`` of windows in words from 0, ascending; ``items`` the ids, as strings
    in ascending order, of the items with a window in the document.  Null and empty texts have no words; items
    without words occur nowhere; a null item id is written as an empty string, and items of one id are one.
    Repeated documents give repeated rows; null ids are kept.  Without documents there are no rows, without
    items no spans.  Other columns are ignored.
    """
    found = settle(item_windows(items, window, shingle, item_id, item_text), "item-windows")
    windows = found.select("win", "words", "n", "width").dropDuplicates(["win"])
    widths = sorted((r.width for r in found.select("width").distinct().collect()), reverse=True)  # shingle values at most
    src = (docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), words_of(F.col(text_col)).alias("doc"))
           .withColumn("n_words", F.size("doc")))
    # shingles of all widths in one array, an entry for the document itself at its end
    hashes = F.concat(*[_shingles(F.col("doc"), w) for w in widths], F.array(F.lit(0).cast("long")))
    tokens = src.select("id", "hash", "doc", "n_words", F.posexplode_outer(hashes).alias("at", "token"))

    # rarity of every shingle of the benchmark
    placed = windows.select("win", "width", "words", "n", F.posexplode(F.flatten(F.array(*[
        F.when(F.col("width") == w, _shingles(F.col("words"), w)).otherwise(F.array().cast("array<bigint>")) for w in widths or [1]])))
        .alias("offset", "token"))
    known = placed.select("token").distinct()
    counts = None
    for block in _blocks(known, F.lit(0), "token"):
        here = tokens.select("token").join(F.broadcast(block), "token").groupBy("token").agg(F.count("*").alias("seen"))
        counts = here if counts is None else counts.unionByName(here)
    # the rarest shingle of each window that can occur at all
    rare = (placed.join(settle(counts, "rarity"), "token", "left")
            .groupBy("win").agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "offset", "token")).alias("first"),
                                F.first("words").alias("words"), F.first("n").alias("n"), F.first("width").alias("width"))
            .where(F.col("first.seen") > 0)
            .select(F.col("first.token").alias("token"), F.col("first.offset").alias("offset"), "win", "words", "n", "width"))
    rare = settle(rare, "prefixes")

    # where the shingles of a width begin in the array of all
    begin, before = F.lit(0), F.lit(0)
    for w in widths:
        begin = F.when(F.col("width") == w, before).otherwise(begin)
        before = before + F.greatest(F.col("n_words") - (w - 1), F.lit(0))
    start = F.col("at") - begin - F.col("offset")
    itself = F.col("win").isNull() & (F.col("at") == before)
    inside = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    same = F.slice("doc", F.when(inside, start).otherwise(F.lit(0)) + 1, F.col("n")) == F.col("words")
    rows = None
    for i, block in enumerate(_blocks(rare, F.size("words") * 24 + F.octet_length(F.array_join("words", " ")), "token")):
        if i == 0:  # every document meets its own entry once
            block = block.unionByName(docs.sparkSession.createDataFrame([(0,)], "token long"), allowMissingColumns=True)
        here = (tokens.join(F.broadcast(block), "token").where(itself | (inside & same))
                .select("id", "hash", "n_words", "win", F.when(~itself, F.struct(start.alias("start"), F.col("n").alias("length"))).alias("span")))
        rows = here if rows is None else rows.unionByName(here)

    key = ["id", "hash", "n_words"]
    each = rows.groupBy(*key).agg(F.count(F.when(F.col("win").isNull(), 1)).alias("copies"),
                                  F.array_sort(F.collect_set("span")).alias("spans"), F.collect_set("win").alias("wins"))
    names = found.select("win", "item").distinct()
    if len(_blocks(names, F.octet_length("item") + 32, "win")) == 1:
        names = F.broadcast(names)
    whole = (each.select(*key, "copies", "spans", F.explode_outer("wins").alias("win")).join(names, "win", "left")
             .groupBy(*key).agg(F.first("copies").alias("copies"), F.first("spans").alias("spans"),
                                F.array_sort(F.collect_set("item")).alias("items")))
    return (whole.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select(F.col("id").alias(id_col), F.col("n_words").cast("long").alias("n_words"), "spans", "items"))


def covered(spans: Column) -> Column:
    """Number of positions that lie in any of ``spans``, which are ascending."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))

    def step(acc, s):
        end = s["start"] + s["length"]
        return F.struct(F.greatest(acc["end"], end).alias("end"),
                        (acc["total"] + F.greatest(F.lit(0), end - F.greatest(acc["end"], s["start"]))).alias("total"))

    return F.aggregate(spans, zero, step, lambda acc: acc["total"].cast("long"))
