"""The corpus pipeline: each stage reads the documents its predecessor kept and writes what it keeps."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.llm.bpe import encode
from laminar.llm.common import settle, table
from laminar.llm.jaccard import jaccard_components
from laminar.llm.langid import UNKNOWN, fit, predict
from laminar.llm.mixing import mix

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1024  # texts sent to a Python worker at once
WIDTH, PERCENT = 5, 80  # words of a shingle and similarity from which documents are near duplicates
ROW = "row_of_stage"  # names a row within a stage, since ids may be null or repeated


def small_batches(spark: SparkSession) -> None:
    """Bound what a batch of texts takes in the executor and in its Python worker, unless the session asks for less."""
    if int(spark.conf.get(BATCH)) > BATCH_ROWS:
        spark.conf.set(BATCH, str(BATCH_ROWS))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay; texts that are null or hold no letter go.

    Null and repeated ids change nothing: every row is judged by its own text.
    """
    small_batches(spark)
    told = predict(docs, fit(docs), carry=True)
    return told.where(F.col("lang_pred") != UNKNOWN).select(*docs.columns)


def keyed(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` and the name of a column that tells its rows apart.

    That is ``doc_id`` if no id is null or repeated. Otherwise the rows are numbered by ``ROW`` and written to the
    shared folder, so that the numbers stay the same in every read.
    """
    unclear = docs.groupBy("doc_id").agg(F.count("*").alias("rows")).where(F.col("doc_id").isNull() | (F.col("rows") > 1))
    if unclear.isEmpty():
        return docs, "doc_id"
    return settle(docs.withColumn(ROW, F.monotonically_increasing_id()), name), ROW


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each linked group stays: the one with the smallest id (null last, then any one of that id's rows).

    Documents link when they share at least 80% of their distinct five-word shingles; the contract of
    ``op4_ngram_jaccard_join`` (four words, 85%) is that query's own. Every row is a document of its own:
    rows with a null id take part like others, and rows with one id but different texts both stay.
    Rows without words link to nothing and stay.
    """
    rows, key = keyed(docs, "documents")
    found = jaccard_components(rows, width=WIDTH, percent=PERCENT, id_col=key)
    if key == "doc_id":
        kept = found.where(F.col(key) == F.col("component_id")).select(key)
    else:
        named = found.join(rows.select(key, "doc_id"), key)
        first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", key))
        kept = named.groupBy("component_id").agg(first.alias("first")).select(F.col("first")[key].alias(key))
    return rows.join(kept, key, "left_semi").select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as its rate was rounded to: none, one or two times.

    Rows with a null or repeated id are documents of their own.
    """
    rows, key = keyed(docs, "documents")
    mixed = mix(rows) if key == "doc_id" else mix(rows, row_col=key)
    copies = mixed.where(F.col("copies") > 0).select(key, "copies")
    return (rows.join(copies, key).select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("nth"))
            .select(*docs.columns))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and a digest of the text they decode to; one row per row, whatever its id."""
    small_batches(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    both = encode(docs, path, decoded=True)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", mixed_sources),
    ("byte-level BPE", encoded),
]

# The rows of run() are not expressible in SQL; the tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = settle(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
