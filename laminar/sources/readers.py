"""Typed CSV reading: declared schemas, headers checked, bad values never turned into NULLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from laminar.sources.schemas import TABLES

REJECT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: StructType | str, keep_rejects: bool = False) -> DataFrame:
    """CSV with a header, read against a declared schema (no inference pass).

    The header must name the schema's columns in order, otherwise the read fails.  A value that does not
    fit its column's type fails the read too, unless ``keep_rejects``: then the line is kept in a
    last column ``_corrupt_record`` (NULL for good rows), for ``split_rejects``.
    """
    if isinstance(schema, str):
        schema = TABLES[schema]
    reader = spark.read.option("header", "true").option("enforceSchema", "false")
    if not keep_rejects:
        return reader.option("mode", "FAILFAST").schema(schema).csv(path)
    wide = StructType([*schema.fields]).add(REJECT, StringType())
    return (reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECT)
            .option("columnPruning", "false").schema(wide).csv(path))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)`` rows of a read with ``keep_rejects``; rejected ones with their line in ``_corrupt_record``."""
    good = df.where(F.col(REJECT).isNull()).drop(REJECT)
    return good, df.where(F.col(REJECT).isNotNull())
