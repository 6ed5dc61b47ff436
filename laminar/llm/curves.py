"""Approximate nearest neighbours by cosine over shifted Hilbert curves.

Index.  Unit vectors are projected on ``DIMS`` random orthogonal directions, shifted at random, cut into cells
and numbered along a Hilbert curve; ``curves`` such orderings are kept.  Every row is in every ordering: the copies are
range-partitioned and sorted by (curve, key, id) and numbered through.

Search.  A query looks ``window`` places to both sides in every ordering.  Places are cut into blocks; a query
is sent to the blocks its window touches (queries travel, candidates do not), and each block holds at most
``BLOCK`` candidates while its queries stream by.  Blocks rank by exact cosine in double precision; the best of
all curves are merged.

Window.  It is fitted on a bounded sample: the exact neighbours of at most ``PROBES`` queries are found by one
scan, and the window is the smallest that reaches ``target`` of them in some ordering.  Data with
structure gets short windows; vectors without any need long ones.

Of equal vectors only the ``k + 1`` smallest ids can be in an answer, so only they are
candidates; a frequent vector does not fill the windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laminar.llm.common import partitions, settle
from laminar.llm.hilbert import hilbert_keys
from laminar.llm.vectors import matrix, usable

CURVES, DIMS, BITS = 16, 8, 6
BLOCK = 4096
PROBES, TARGET = 128, 0.96


def _frames(dims: int, curves: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Directions (curves, dims, used) and shifts (curves, used) of every ordering."""
    rng = np.random.default_rng([seed, dims])
    used = min(DIMS, dims)
    turn = np.stack([np.linalg.qr(rng.normal(size=(dims, dims)))[0][:, :used] for _ in range(curves)])
    return turn, rng.random((curves, used))


def _unit(m: np.ndarray) -> np.ndarray:
    m = m.astype(np.float64)
    scaled = m / np.abs(m).max(1, keepdims=True)  # neither overflow nor underflow of the squares
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def _key_pass(curves: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                for dims, (at, m) in matrix(part.column(1)).items():
                    turn, shift = _frames(dims, curves)
                    x, rows = _unit(m), part.take(pa.array(at))
                    for c in range(curves):
                        place = (np.clip(x @ turn[c] * np.sqrt(dims) / 8 + 0.5, 0, 1) + shift[c]) / 2
                        cell = np.minimum((place * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), dims * curves + c, np.int32)), pa.array(hilbert_keys(cell, BITS)),
                             *rows.columns], ["curve", "key", "id", "v", "candidate", "asks"])

    return run


def _number_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the task's number and each row's place within its task."""
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))],
                                         [*batch.schema.names, "part", "place"])
        at += n


def index(vectors: DataFrame, is_query: Column, k: int, curves: int = CURVES, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """Every usable row in every ordering: ``(curve, pos, id, v, candidate, asks)``, written to the shared folder."""
    spark = vectors.sparkSession
    zero = F.forall(vec_col, lambda x: x == 0)
    kept = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vec_col)) & ~F.coalesce(zero, F.lit(True)))
    rows = kept.select(F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda x: x.cast("double")).alias("v"),
                       F.coalesce(is_query, F.lit(False)).alias("asks"))
    # repeated rows of one id count once; the window alone has the filter, so it cuts down before the shuffle too
    each = rows.groupBy("id", "v").agg(F.max("asks").alias("asks"))
    equal = Window.partitionBy("h", "v").orderBy("id")
    first = (each.select("id", "v", F.xxhash64("v").alias("h")).withColumn("nth", F.row_number().over(equal))
             .where(F.col("nth") <= k + 1).select("id", "v", F.lit(True).alias("candidate"), F.lit(False).alias("asks")))
    asked = each.where("asks").select("id", "v", F.lit(False).alias("candidate"), "asks")
    rows = first.unionByName(asked).groupBy("id", "v").agg(F.max("candidate").alias("candidate"), F.max("asks").alias("asks"))
    ddl = "curve int, key long, id long, v array<double>, candidate boolean, asks boolean"
    order = ["curve", "key", "id"]
    sorted_rows = settle(rows.mapInArrow(_key_pass(curves), ddl).repartitionByRange(partitions(spark), *order)
                         .sortWithinPartitions(*order).mapInArrow(_number_pass, f"{ddl}, part int, place long"), "curves")
    # one row per task and curve: small enough for a window, and for a broadcast
    held = sorted_rows.groupBy("curve", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = held.select("curve", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return sorted_rows.join(F.broadcast(start), ["curve", "part"]).select(
        "curve", (F.col("start") + F.col("place") - F.col("first")).alias("pos"), "id", "v", "candidate", "asks")


def _rank(query: np.ndarray, query_ids: np.ndarray, cand: np.ndarray, ids: np.ndarray, k: int, near=None):
    """Rows (query id, id, cosine) of the k best ids of one block per query; both sides are unit vectors."""
    near = np.ones((len(query), len(cand)), bool) if near is None else near
    s = np.where(near & (query_ids[:, None] != ids[None, :]), query @ cand.T, -np.inf)
    best = s
    kinds, first = np.unique(np.sort(ids), return_index=True)
    if len(kinds) < len(ids):  # an id with several vectors counts by its best one
        best = np.maximum.reduceat(s[:, np.argsort(ids, kind="stable")], first, axis=1)
    some = min(len(kinds), k + 16)
    whole = some == len(kinds)
    edge = None if whole else -np.partition(-best, some - 1, axis=1)[:, some - 1]
    out = []
    for q in range(len(query)):
        # equal scores at the border: take all of them
        at = np.flatnonzero(s[q] > -np.inf if whole else (s[q] >= edge[q] - 1e-12) & (s[q] > -np.inf))
        if len(at):
            exact = np.einsum("ij,j->i", cand[at], query[q])
            order = np.lexsort((ids[at], -np.round(exact, 12)))
            order = order[np.sort(np.unique(ids[at][order], return_index=True)[1])[:k]]
            out += [(int(query_ids[q]), int(ids[at[o]]), float(exact[o])) for o in order]
    return out


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))],
                                      ["query_id", "vec_id", "score"])


_FOUND = "query_id long, vec_id long, score double"


def _search_pass(k: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, ids, pos, cand = None, [], [], []
        block = None  # the candidates of the current (curve, block); its queries follow them
        for batch in batches:
            curve, number, query = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            mark = np.flatnonzero(np.r_[True, (curve[1:] != curve[:-1]) | (number[1:] != number[:-1]) | (query[1:] != query[:-1])])
            for s, e in zip(mark, np.r_[mark[1:], len(curve)]):
                if (curve[s], number[s]) != here:
                    here, ids, pos, cand, block = (curve[s], number[s]), [], [], [], None
                part = batch.slice(s, e - s)
                rows = _unit(next(iter(matrix(part.column(5)).values()))[1])
                if not query[s]:
                    ids.append(part.column(4).to_numpy())
                    pos.append(part.column(3).to_numpy())
                    cand.append(rows)
                    continue
                if not ids:
                    continue
                if block is None:
                    block = np.concatenate(cand), np.concatenate(ids), np.concatenate(pos)
                for i in range(0, len(rows), 256):
                    at, qid = part.column(3).to_numpy()[i: i + 256], part.column(4).to_numpy()[i: i + 256]
                    near = np.abs(at[:, None] - block[2][None, :]) <= window
                    yield _emit(_rank(rows[i: i + 256], qid, block[0], block[1], k, near))

    return run


def _fit_window(placed: DataFrame, k: int, curves: int, target: float) -> int:
    """The smallest window that reaches ``target`` of the exact neighbours of at most ``PROBES`` queries."""
    one = placed.where(F.pmod(F.col("curve"), F.lit(curves)) == 0)
    picked = (one.where("asks").groupBy("id").agg(F.min("v").alias("v"))
              .orderBy(F.xxhash64("id"), "id").limit(PROBES).toArrow().combine_chunks())
    if not picked.num_rows:
        return 1
    probes = {d: (picked.column("id").to_numpy()[at], _unit(m)) for d, (at, m) in matrix(picked.column("v").combine_chunks()).items()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                for d, (at, m) in matrix(part.column(1)).items():
                    if d in probes:
                        yield _emit(_rank(probes[d][1], probes[d][0], _unit(m), part.column(0).to_numpy()[at], k))

    order = Window.partitionBy("query_id").orderBy(F.round("score", 12).desc(), "vec_id")
    true = (one.where("candidate").select("id", "v").mapInArrow(scan, _FOUND)
            .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("r", F.row_number().over(order))
            .where(F.col("r") <= k).select("query_id", "vec_id").toPandas())  # at most PROBES * k rows
    wanted = sorted(set(true["query_id"]) | set(true["vec_id"]))
    if not wanted:
        return 1
    at = placed.where(F.col("id").isin([int(i) for i in wanted])).groupBy("curve", "id").agg(F.min("pos").alias("pos")).toPandas()
    both = (true.merge(at.rename(columns={"id": "query_id", "pos": "a"}), on="query_id")
            .merge(at.rename(columns={"id": "vec_id", "pos": "b"}), on=["vec_id", "curve"]))
    gap = (both["a"] - both["b"]).abs().groupby([both["query_id"], both["vec_id"]]).min()
    return max(1, int(np.quantile(gap, target, method="higher")))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, curves: int = CURVES, target: float = TARGET,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found per query by cosine, ties to smaller ids.

    Candidates are all rows but the query's own id, of the query's length.  Null ids, null, empty and zero vectors and those with null or
    non-finite components take no part.  A repeated query id is answered once; repeated rows with one id count
    once.  An empty table gives no rows; other columns are ignored.
    """
    placed = index(vectors, is_query, k, curves, id_col, vec_col)
    window = _fit_window(placed, k, curves, target)
    block = F.floor(F.col("pos") / BLOCK)
    cand = placed.where("candidate").select("curve", block.alias("block"), F.lit(False).alias("query"), "pos", "id", "v")
    reach = F.sequence(F.floor(F.greatest(F.col("pos") - window, F.lit(0)) / BLOCK), F.floor((F.col("pos") + window) / BLOCK))
    asked = placed.where("asks").select("curve", F.explode(reach).alias("block"), F.lit(True).alias("query"), "pos", "id", "v")
    spread = partitions(vectors.sparkSession)
    found = (cand.unionByName(asked).repartition(spread, "curve", "block").sortWithinPartitions("curve", "block", "query")
             .mapInArrow(_search_pass(k, window), _FOUND))
    order = Window.partitionBy("query_id").orderBy(F.round("score", 12).desc(), "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
