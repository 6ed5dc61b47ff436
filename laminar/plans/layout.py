"""Sort orders of a written table: what each would take on disk, and whether files are in order.

Columnar files store a column as a dictionary of its values and an index per row, run-length coded where values repeat and
bit-packed elsewhere.  So the size of an order follows from the runs and the distinct values that it gives
each column, and these are counted over a few sampled splits: no order is written to learn its size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LONG_RUN = 8  # equal values from which a run is coded as one
RUN_BYTES = 2  # header of a coded run, beside its value
SAMPLED = 0.25  # share of the splits that are looked at


def _codes(column: pa.Array) -> np.ndarray:
    """Dense ranks of a column's values, nulls lowest."""
    return pc.rank(column, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy(zero_copy_only=False).astype(np.int64)


def column_bytes(column: pa.Array) -> tuple[int, int]:
    """Estimated bytes of a column in the order it comes: its dictionary, and its indexes."""
    code = _codes(column)
    kinds = int(code.max()) if len(code) else 0
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    runs = np.diff(np.r_[starts, len(code)])
    bits = max(0, kinds - 1).bit_length()
    coded = int((runs >= LONG_RUN).sum()) * (RUN_BYTES + -(-bits // 8))
    packed = int(runs[runs < LONG_RUN].sum()) * bits / 8
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        texts = pc.binary_length(pc.unique(column).cast(pa.binary()))
        dictionary = (pc.sum(texts).as_py() or 0) + 4 * kinds  # a length goes before each
    else:
        dictionary = kinds * column.type.bit_width // 8
    return dictionary, int(coded + packed)


def estimate_layouts(spark: SparkSession, path: str, orders: Sequence[Sequence[str]], sampled: float = SAMPLED) -> DataFrame:
    """``(sort_columns, est_bytes)`` of each order of the table at ``path``, if its splits were sorted by it.

    Every order is a list of columns; an empty one is the order the rows are in.  Only a share of the files is read, picked by
    a hash of their place in the listing, one at least; a split is sorted in its own task, and only sums leave it.  Nothing
    is written.
    """
    files = sorted(spark.read.parquet(path).inputFiles())
    keep = max(1, round(len(files) * sampled))
    picked = sorted(range(len(files)), key=lambda i: zlib.crc32(str(i).encode()))[:keep]
    some = spark.read.option("basePath", path).parquet(*[files[i] for i in picked])
    columns, scale, out = some.columns, len(files) / keep, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)  # one split of the table, as it would be written to one file
        rows = pa.Table.from_batches(parts) if parts else None
        if rows is not None and rows.num_rows:
            total = sum(sum(column_bytes(rows.column(c).combine_chunks())) for c in columns)
            yield pa.RecordBatch.from_pydict({"bytes": pa.array([total], pa.int64())})

    for order in orders:
        laid = some.sortWithinPartitions(*order) if order else some
        one = laid.mapInArrow(run, "bytes long").agg((F.sum("bytes") * F.lit(scale)).cast("long").alias("est_bytes")).select(
            F.lit(",".join(order) or "unsorted").alias("sort_columns"), "est_bytes")
        out = one if out is None else out.unionByName(one)
    return out


def in_order(table: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row ``(n_rows, sorted)``: whether every file of a written table is in the order of the columns, nulls first.

    Each task checks the rows it reads, by their position in their file, and hands on the ends of what it read; these
    few rows are compared file by file.  No row of the table is shuffled.
    """
    order = list(order)
    kinds = ", ".join(f"`{c}`: {table.schema[c].dataType.simpleString()}" for c in order)
    rows = table.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            file, at = _codes(batch.column(0)), batch.column(1).to_numpy()
            after = np.zeros(n, np.int8)  # -1, 0, 1: how a row compares with the one before
            for c in range(2, batch.num_columns):
                code = _codes(batch.column(c))
                after[1:] = np.where(after[1:] == 0, np.sign(code[1:] - code[:-1]), after[1:])
            fresh = np.r_[True, (file[1:] != file[:-1]) | (at[1:] != at[:-1] + 1)]
            begin = np.flatnonzero(fresh)
            end = np.r_[begin[1:], n] - 1
            bad = np.add.reduceat((after < 0) & ~fresh, begin) > 0

            def ends(where: np.ndarray) -> pa.StructArray:
                return pa.StructArray.from_arrays([batch.column(c).take(pa.array(where)) for c in range(2, batch.num_columns)], names=order)

            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(begin)), pa.array(at[begin]), pa.array(end - begin + 1), pa.array(~bad), ends(begin), ends(end)],
                names=["file", "at", "n", "good", "low", "high"])

    spans = rows.mapInArrow(run, f"file string, at long, n long, good boolean, low struct<{kinds}>, high struct<{kinds}>")
    before = F.lag("high").over(Window.partitionBy("file").orderBy("at"))
    fine = F.col("good") & (before.isNull() | (before <= F.col("low")))
    return spans.select("n", fine.alias("fine")).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"),
                                                     F.coalesce(F.every("fine"), F.lit(True)).alias("sorted"))
