"""Exact top-k by inner product over vector-approximation files.

Vectors are scaled and floored to integers.  The approximation file has a row per block of candidates of one length: each
component's range in the block is cut into cells of equal power-of-two width, and a byte per component
names the cell.

1. Scan.  Query blocks meet the rows of the file; the lower cell corners give, by one matrix product, a lower and an upper
   bound of each query's product with each candidate.  No vector is read.  A candidate whose upper
   bound is below the k-th largest lower bound of its query cannot be in the answer; a task drops such ones by
   what it has seen, and the rest by the bounds of all tasks.
2. Read.  The exact vectors of each query's candidates are read by id, first those with the largest upper bounds,
   ``FIRST`` times k of them; then those whose upper bound is not below the k-th score found, until
   that is certain.

Queries are dealt into blocks that are broadcast ``QUERY_BLOCKS`` at a time, with one scan of the file each, so neither the
driver nor a task holds all queries; their number of rows per block is fixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laminar.llm.common import drop, settle
from laminar.llm.vectors import distinct_ids, matrix, usable

CELLS = 64  # cells per component
BLOCK = 2048  # candidates quantised together
QUERY_BLOCK = 512  # queries of a block, about
QUERY_BLOCKS = 16  # blocks broadcast at once
FIRST = 2
LONG = (1 << 63) - 1
_EXACT = 1 << 52  # sums below it are exact in double precision


def approximate(vectors: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The approximation of a block: cell numbers (bytes), lowest corner and cell width per component."""
    low = vectors.min(0)
    span = vectors.max(0).astype(np.uint64) - low.astype(np.uint64)  # wraps around to the right distance
    shift = np.zeros(len(low), np.uint64)
    while ((span >> shift) >= cells).any():
        shift += (span >> shift) >= cells
    cell = ((vectors.astype(np.uint64) - low.astype(np.uint64)) >> shift).astype(np.uint8)
    return cell, low, shift.astype(np.uint8)


def bounds(queries: np.ndarray, cell: np.ndarray, low: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all products of a query block with a block of candidates, from its approximation."""
    width = np.ldexp(1.0, shift.astype(int))
    corner = low.astype(float) + cell * width
    q = queries.astype(float)
    base, reach = q @ corner.T, width - 1
    most = float(np.abs(q).sum(1).max()) * float(np.abs(corner).max() + width.max())
    slack = 0.0 if most < _EXACT else most * q.shape[1] * 2.0 ** -50  # what rounding may have taken
    return base - (np.maximum(-q, 0) @ reach)[:, None] - slack, base + (np.maximum(q, 0) @ reach)[:, None] + slack


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two long matrices, saturated at the ends of a long."""
    most = a.shape[1] * max(1, int(np.abs(a.astype(float)).max())) * max(1, int(np.abs(b.astype(float)).max())) if a.size else 0
    if most < LONG // 2:
        return np.einsum("ij,ij->i", a, b)
    exact = (a.astype(object) * b.astype(object)).sum(1)
    return np.array([min(LONG, max(-LONG, int(s))) for s in exact], np.int64)


def _file_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the approximation file from ``(id, v)``."""
    for batch in batches:
        for dims, (at, block) in matrix(batch.column(1)).items():
            ids = batch.column(0).to_numpy()[at].astype("<i8")
            for i in range(0, len(ids), BLOCK):
                cell, low, shift = approximate(block[i: i + BLOCK])
                yield pa.RecordBatch.from_pydict({
                    "dims": pa.array([dims], pa.int32()), "ids": [ids[i: i + BLOCK].tobytes()], "low": [low.astype("<i8").tobytes()],
                    "shift": [shift.tobytes()], "cells": [cell.tobytes()]})


class Candidates:
    """Candidates of one query block that the bounds seen so far leave."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.lows = np.full((len(ids), k), -np.inf)  # the k largest lower bounds of each query
        self.kept: list[tuple] = []

    def add(self, ids: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> None:
        own = self.ids[:, None] == ids[None, :]
        lower[own], upper[own] = -np.inf, -np.inf
        both = np.concatenate([self.lows, lower], 1)
        self.lows = np.partition(both, both.shape[1] - self.k, axis=1)[:, -self.k:]
        q, c = np.nonzero((upper >= self.lows.min(1)[:, None]) & (upper > -np.inf))
        self.kept.append((q, ids[c], lower[q, c], upper[q, c]))

    def rows(self) -> tuple:
        q, ids, lower, upper = (np.concatenate(x) for x in zip(*self.kept))
        good = upper >= self.lows.min(1)[q]
        self.kept = [(q[good], ids[good], lower[good], upper[good])]
        return self.ids[q[good]], ids[good], lower[good], upper[good]


_FOUND = "query_id long, vec_id long, lower double, upper double"
PRUNE = 1 << 20  # candidates a task holds before it drops those that later bounds exclude


def _scan_pass(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Candidates] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                block, qids, qvecs, dims, ids, low, shift, cells = (c[i].as_py() for c in batch.columns)
                if (block, dims) not in held:
                    held[block, dims] = Candidates(np.frombuffer(qids, "<i8"), np.frombuffer(qvecs, "<i8").reshape(-1, dims), k)
                mine = held[block, dims]
                ids = np.frombuffer(ids, "<i8")
                mine.add(ids, *bounds(mine.vectors, np.frombuffer(cells, np.uint8).reshape(len(ids), dims),
                                      np.frombuffer(low, "<i8"), np.frombuffer(shift, np.uint8)))
                if len(mine.kept) > 1 and sum(len(x[0]) for x in mine.kept) > PRUNE:
                    mine.rows()
        for mine in held.values():
            cols = mine.rows()
            for at in range(0, len(cols[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(c[at: at + (1 << 16)]) for c in cols], ["query_id", "vec_id", "lower", "upper"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Query blocks ``(block, dims, rows)`` as ids and one matrix."""
    for batch in batches:
        for block, dims, rows in zip(*(c.to_pylist() for c in batch.columns)):
            ids = np.array([r["id"] for r in rows], "<i8").tobytes()
            vecs = np.array([r["v"] for r in rows], "<i8").tobytes()
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "dims": pa.array([dims], pa.int32()), "qids": [ids], "qvecs": [vecs]})


def _score_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact scores of ``(query_id, vec_id, q, v)``."""
    for batch in batches:
        score = np.empty(batch.num_rows, np.int64)
        right = matrix(batch.column(3))
        for dims, (at, q) in matrix(batch.column(2)).items():  # both sides of a pair have one length
            score[at] = products(q, right[dims][1])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], ["query_id", "vec_id", "score"])


def _scored(pairs: DataFrame, asked: DataFrame, rows: DataFrame, whole: Column) -> DataFrame:
    """Pairs of ids with the exact score of every row of the candidate's id (``whole`` of its vector as it is stored)."""
    mine = asked.select(F.col("id").alias("query_id"), F.col("v").alias("q"))
    read = rows.join(pairs, "vec_id").withColumn("v", whole)
    full = read.join(mine, "query_id").where(F.size("q") == F.size("v"))
    return full.select("query_id", "vec_id", "q", "v").mapInArrow(_score_pass, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k largest integer inner products per query, ties to smaller ids.

    Every component x becomes ``floor(scale * x)``.  Candidates are all rows but those with the query's own id, of the query's
    length.  Rows with a null id take no part.  Vectors that are null, empty or hold null or non-finite components take no part.  Repeated rows
    are candidates of their own; a repeated query id is answered once (its smallest vector).  Scores
    beyond a long saturate.  An empty table gives no rows; other columns are ignored.
    """
    def whole(stored: str) -> Column:
        return F.transform(stored, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))

    kept = vectors.where(usable(F.col(vec_col)) & F.col(id_col).isNotNull())
    rows = kept.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("stored"))
    src = kept.select(F.col(id_col).cast("long").alias("id"), whole(vec_col).alias("v"))
    asked = settle(distinct_ids(kept.where(is_query).select(F.col(id_col).cast("long").alias("id"), whole(vec_col).alias("v")), "id", "v"), "queries")
    file = settle(src.mapInArrow(_file_pass, "dims int, ids binary, low binary, shift binary, cells binary"), "approximation")

    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    dealt = asked.groupBy(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), F.size("v").alias("dims")).agg(
        F.collect_list(F.struct("id", "v")).alias("rows"))
    packed = settle(dealt.mapInArrow(_packed, "block long, dims int, qids binary, qvecs binary"), "query-blocks")
    scans = None
    for first in range(0, blocks, QUERY_BLOCKS):
        some = packed.where(F.col("block").between(first, first + QUERY_BLOCKS - 1))
        met = file.join(F.broadcast(some), "dims").select("block", "qids", "qvecs", "dims", "ids", "low", "shift", "cells")
        here = met.mapInArrow(_scan_pass(k), _FOUND)
        scans = here if scans is None else scans.unionByName(here)
    found = settle(scans, "candidates")

    # the k-th largest lower bound of each query leaves its candidates
    by_lower = Window.partitionBy("query_id").orderBy(F.col("lower").desc())
    bar = (found.withColumn("r", F.row_number().over(by_lower)).where(F.col("r") <= k).groupBy("query_id")
           .agg(F.min("lower").alias("bar"), F.count("*").alias("n")).select("query_id", F.when(F.col("n") == k, F.col("bar")).alias("bar")))
    left = (found.join(bar, "query_id").where(F.col("bar").isNull() | (F.col("upper") >= F.col("bar")))
            .groupBy("query_id", "vec_id").agg(F.max("upper").alias("upper")))
    by_upper = Window.partitionBy("query_id").orderBy(F.col("upper").desc(), "vec_id")
    left = settle(left.withColumn("r", F.row_number().over(by_upper)), "ordered")
    one = settle(_scored(left.where(F.col("r") <= FIRST * k).select("query_id", "vec_id"), asked, rows, whole("stored")), "first-scores")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    reached = (one.withColumn("r", F.row_number().over(best)).where(F.col("r") == k).select("query_id", F.col("score").alias("reached")))
    more = (left.where(F.col("r") > FIRST * k).join(reached, "query_id", "left")
            .where(F.col("reached").isNull() | (F.col("upper") >= F.col("reached").cast("double"))).select("query_id", "vec_id"))
    two = _scored(more, asked, rows, whole("stored"))
    done = settle(one.unionByName(two).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
                  .select("query_id", "rank", "vec_id", "score"), "top")
    drop(file, packed, found, left, one, asked)
    return done
