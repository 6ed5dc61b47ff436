"""Types of a CSV with a header, found in one pass over its values.

Types form a lattice: ``int < long < decimal(38,0) < double < string``, ``date < timestamp < string``,
``boolean < string``, and nothing (a column without values) below all.  One aggregate counts, per column, the values
that each type can hold; it keeps a few counters per column and map task.  A column's type is the narrowest one that
holds all its values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampType)

WHOLE = r"^[+-]?[0-9]{1,38}$"
NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?(Z|[+-][0-9]{2}:[0-9]{2})?$"
TRUTH = ("true", "false")

# narrowest first; a type that holds all values of a column is taken before wider ones
LATTICE: list[tuple[str, DataType]] = [
    ("int", IntegerType()), ("bigint", LongType()), ("decimal(38,0)", DecimalType(38, 0)), ("double", DoubleType()),
    ("date", DateType()), ("timestamp", TimestampType()), ("boolean", BooleanType()), ("string", StringType())]
EMPTY = "void"  # no values: any type holds them
# what each type can hold beside itself
_ABOVE = {"int": {"bigint", "decimal(38,0)", "float", "double", "string"}, "bigint": {"decimal(38,0)", "double", "string"},
          "decimal(38,0)": {"double", "string"}, "float": {"double", "string"}, "double": {"string"},
          "date": {"timestamp", "string"}, "timestamp": {"string"}, "boolean": {"string"}}


def _holds(value: Column) -> dict[str, Column]:
    whole, number = value.rlike(WHOLE), value.rlike(NUMBER)
    return {
        "int": whole & value.try_cast("int").isNotNull(),
        "bigint": whole & value.try_cast("bigint").isNotNull(),
        "decimal(38,0)": whole,
        "double": number,
        "date": value.rlike(DATE) & value.try_cast("date").isNotNull(),
        "timestamp": (value.rlike(DATE) | value.rlike(TIME)) & value.try_cast("timestamp").isNotNull(),
        "boolean": F.lower(value).isin(*TRUTH),
    }


def _texts(spark: SparkSession, path: str) -> DataFrame:
    """The file with every column as text (only the first line is read for the names)."""
    return spark.read.option("header", "true").option("mode", "FAILFAST").csv(path)


def count_fits(spark: SparkSession, path: str) -> tuple[list[str], dict[str, dict[str, int]], int]:
    """Column names; per column its number of values and of those each type holds; number of rows."""
    df = _texts(spark, path)
    counts = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(df.columns):
        value = F.col(f"`{c}`")
        counts.append(F.count(value).alias(f"{i}:values"))
        counts += [F.count(F.when(fits, 1)).alias(f"{i}:{name}") for name, fits in _holds(value).items()]
    row = df.agg(*counts).first().asDict()
    found = {c: {"values": row[f"{i}:values"], "string": row[f"{i}:values"],
                 **{name: row[f"{i}:{name}"] for name, _ in LATTICE[:-1]}} for i, c in enumerate(df.columns)}
    return df.columns, found, row["rows"]


def narrowest(counts: dict[str, int]) -> str:
    """The narrowest type that holds all values of a column, ``void`` if it has none."""
    if not counts["values"]:
        return EMPTY
    return next(name for name, _ in LATTICE if counts[name] == counts["values"])


def infer_schema(spark: SparkSession, path: str) -> StructType:
    """A schema for ``read_csv``; columns without values are text."""
    names, counts, _ = count_fits(spark, path)
    types = dict(LATTICE)
    return StructType([StructField(n, types.get(narrowest(counts[n]), StringType())) for n in names])


def compare_schema(spark: SparkSession, path: str, declared: StructType) -> DataFrame:
    """One row per column of the file or of ``declared``: how the declared type stands to the values.

    ``verdict``: ``equal``; ``wider`` (the declared type holds all values, a narrower one would do); ``conflict`` (some value
    does not fit the declared type); ``missing`` from the file; ``undeclared``.
    """
    names, counts, n_rows = count_fits(spark, path)
    wanted = {f.name: f.dataType.simpleString() for f in declared.fields}
    rows = []
    for position, name in enumerate([*names, *[n for n in wanted if n not in counts]]):
        if name not in counts:
            rows.append((position, name, None, wanted[name], None, None, "missing"))
            continue
        found, given = narrowest(counts[name]), wanted.get(name)
        verdict = ("undeclared" if given is None else "equal" if found == given
                   else "wider" if found == EMPTY or given in _ABOVE.get(found, ()) else "conflict")
        rows.append((position, name, found, given, n_rows, counts[name]["values"], verdict))
    return spark.createDataFrame(rows, "position int, column_name string, inferred string, declared string, n_rows long, "
                                       "n_values long, verdict string")
