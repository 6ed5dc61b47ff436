"""Registered queries of the text operators: thin digests over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.llm.bitplanes import read_ids, write_ids
from laminar.llm.bpe import encode
from laminar.llm.chat import format_chats, masked_texts, read_back
from laminar.llm.common import table
from laminar.llm.curves import nearest
from laminar.llm.decontam import covered, find_windows
from laminar.llm.jaccard import jaccard_components
from laminar.llm.langid import fit, held_out, predict
from laminar.llm.licenses import scan_licenses
from laminar.llm.merkle import FIELDS, build_manifest, fold, leaf_digest, path_digest, prove
from laminar.llm.mixing import mix
from laminar.llm.oracle import CONTROL, ORACLE
from laminar.llm.prefix import prefix_index
from laminar.llm.repair import digests, repair
from laminar.llm.vafile import top_k
from laminar.session import scratch_path

TOKEN_LIMIT = 2048
END_OF_TEXT = 2


STEPS = 8  # sequence numbers a turn may take


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations, and the conversation the task adds, as the log a chat service would have written.

    By a checksum of conversation and turn a row was sent whole, streamed in deltas, first written wrong and then
    edited, or broken off and regenerated.  Folding the log gives the rows again.  Rows whose turn
    is null or stands twice are whole messages: nothing tells which of them a delta would belong to.
    """
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    twice = rows.groupBy(F.col("conv_id").alias("c"), F.col("turn").alias("t")).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)
    added = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)],
                                  "conv_id long, turn long, role string, text string")
    every = rows.unionByName(added).join(
        twice, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")), "left")
    way = F.when(F.col("rows").isNotNull() | F.col("turn").isNull(), 0).otherwise(
        F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.col("turn").cast("string"))) % 4)
    third = (F.length("text") / 3).cast("int")
    one, two = F.substring(F.col("text"), F.lit(1), third), F.substring(F.col("text"), third + 1, third)
    three, wrong = F.substring(F.col("text"), 2 * third + 1, F.length("text")), F.reverse(F.col("text"))

    def events(*steps):
        return F.array(*[F.struct(F.lit(i).cast("long").alias("step"), F.lit(kind).alias("kind"), text.alias("piece")) for i, (kind, text) in enumerate(steps)])

    log = (F.when(F.col("way") == 1, events(("message", one), ("delta", two), ("delta", three)))
           .when(F.col("way") == 2, events(("message", wrong), ("edit", F.col("text"))))
           .when(F.col("way") == 3, events(("message", wrong), ("delta", one), ("regenerate", F.lit(None).cast("string")),
                                           ("delta", one), ("delta", F.concat(two, three))))
           .otherwise(events(("message", F.col("text")))))
    return every.withColumn("way", way).select("conv_id", "turn", "role", F.explode(log).alias("e")).select(
        "conv_id", (F.col("turn") * STEPS + F.col("e.step")).alias("seq"), F.col("e.kind").alias("kind"), F.col("turn").alias("msg"),
        "role", F.col("e.piece").alias("text"))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = format_chats(event_log(spark, sf_dir))
    turns = F.transform(read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(masked_texts(F.col("formatted"), F.col("loss_spans")), "")
    return done.select("conv_id", F.size(turns).cast("long").alias("n_turns"),
                       F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = prefix_index(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return index.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    both = encode(table(spark, sf_dir, "documents"), path, decoded=True)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op5_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_token_id_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), END_OF_TEXT, out)
    return read_ids(spark, out).select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                                       F.crc32("ids").alias("ids_crc32"))


def stand_in_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: one root per source, and file names that may declare a licence."""
    n = F.col("doc_id")

    def folder(letter: str, size: int):
        return F.concat(F.lit(letter), F.floor(n / size).cast("string"))

    path = (F.when(n % 1000 == 0, F.concat_ws("/", "source", folder("a", 1000), F.lit("LICENSE")))
            .when(n % 100 == 0, F.concat_ws("/", "source", folder("a", 1000), folder("b", 100), F.lit("LICENSE.txt")))
            .otherwise(F.concat_ws("/", "source", folder("a", 1000), folder("b", 100), folder("c", 10),
                                   F.concat(F.lit("f"), n.cast("string"), F.lit(".txt")))))
    return table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(stand_in_files(spark, sf_dir))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # what a tampered copy of the row would hash to; null where the row is left alone
    touched = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    seen = leaf_digest(*[F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in FIELDS])
    proven = prove(build_manifest(docs.withColumn("seen_leaf", F.when(touched, seen)), keep=("doc_id", "seen_leaf")))
    folded = fold(F.coalesce("kept.seen_leaf", "leaf"), F.col("path"))
    return (proven.select(F.col("kept.doc_id").alias("doc_id"), "leaf", "subroot", "root",
                          path_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def damaged_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with rows dropped, emptied, cut short, repeated or given another role, by a checksum of their key."""
    def said(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"))
    harm = F.crc32(F.concat_ws(":", said("conv_id"), said("turn"))) % 20
    rows = rows.withColumn("harm", harm).where(F.col("harm") != 0)
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("harm") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = repair(damaged_turns(spark, sf_dir))
    every = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id")).distinct()
    texts = digests(done).withColumnRenamed("conv_id", "kept")
    out = (every.join(done.summary, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
           .join(texts, F.col("id").eqNullSafe(F.col("kept")), "left"))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(F.col("id").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_windows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return (found.select("doc_id", "n_words", covered(F.col("spans")).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
            .withColumn("contaminated", F.col("n_hit") > 0))


__all__ = ["QUERIES", "ORACLE"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_token_counts": op2_token_counts,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_hilbert_neighbours": op5_hilbert_neighbours,
    "op6_language_id": op6_language_id,
    "op7_token_id_planes": op7_token_id_planes,
    "op8_license_scan": op8_license_scan,
    "op9_mix_sources": op9_mix_sources,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_decontamination": op13_decontamination,
}
