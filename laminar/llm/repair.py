"""Repair of conversation structure at the least cost.

Rows of a conversation are taken by turn (null first; equal turns by a hash of role and text).  A row is blank (no
character but white space), else duplicate (its role and text came before), else truncated (its last such
character is none of ``.!?``).  The repaired conversation has role initials ``(s?(ua)+)?``; what edits
cost and how ties are broken is in :mod:`laminar.llm.fourrussians`.

Scale.  Rows are range-partitioned by conversation and turn, so a conversation that holds a third of all rows lies in many
partitions; their order is kept as one number.  Stretches of ``CHUNK`` places are the unit of work: each becomes a
string of symbols and, by block lookups, a function of the cost vector behind it.  One narrow record per
stretch is chained through a conversation, from its end for the vectors and back for the states, and then
the stretches are traced and written independently.  Rows with their texts are streamed, never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import partitions, settle
from laminar.llm.fourrussians import CLEAN, EXPECTED, GONE, INITIALS, KEPT, START, TRUNCATED, tables

CHUNK = 1024  # places of a stretch
PIECE = 1 << 20  # characters rendered at once
NAMES = {1: "system", 2: "user", 3: "assistant"}  # by state: what an edit writes
_SOLID = r"[^\x20\x09-\x0D]"
_END = r"[.!?][\x20\x09-\x0D]*\z"
_OTHER = 4  # initial classes 0-2 are s, u, a; a record's code is fault * _OTHER + class
_LEGAL = {(0, 1), (1, 2), (2, 1)}  # su, ua, au
_ILLEGAL = np.array([[(a, b) not in _LEGAL for b in range(_OTHER)] for a in range(_OTHER)])
_SYMBOL = np.array([*range(CLEAN, CLEAN + 4), *range(TRUNCATED, TRUNCATED + 4), *[GONE] * 4], np.int64)


@dataclass
class Repair:
    """``summary``: one row per conversation; ``records``: rows and edits of each stretch, in order."""

    summary: DataFrame
    records: DataFrame

    @property
    def rows(self) -> DataFrame:
        """Repaired rows ``(conv_id, chunk, alone, place, nth, edit, role, text)``, ordered by (conv_id, place, nth)."""
        return self.records.mapInArrow(_rendered, f"conv_id {_type(self.records)}, chunk long, alone boolean, place long, nth int, "
                                                  "edit string, role string, text string")


def _type(df: DataFrame) -> str:
    return df.schema["conv"].dataType.simpleString()


def _code() -> Column:
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == INITIALS[0], 0).when(initial == INITIALS[1], 1).when(initial == INITIALS[2], 2).otherwise(_OTHER - 1)
    fault = F.when(~F.col("text").rlike(_SOLID) | F.col("again"), 2).when(F.col("text").rlike(_END), 0).otherwise(1)
    return (fault * _OTHER + kind).cast("byte")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per stretch ``(conv, chunk, codes)``: what its ends look like, its illegal pairs and its function."""
    table = tables()
    for batch in batches:
        out = {k: [] for k in ("first", "last", "illegal", "vector", "added", "states")}
        for codes in batch.column(2):
            code = np.array(codes.as_py(), np.int64)
            kind = code % _OTHER
            vector, added, states = table.summarize(_SYMBOL[code])
            for key, value in zip(out, (int(kind[0]), int(kind[-1]), int(_ILLEGAL[kind[:-1], kind[1:]].sum()),
                                        vector.tobytes(), added.astype("<i8").tobytes(), states.tobytes())):
                out[key].append(value)
        yield pa.RecordBatch.from_pydict({"conv": batch.column(0), "chunk": batch.column(1), **out}, schema=pa.schema([
            ("conv", batch.schema.field(0).type), ("chunk", pa.int64()), ("first", pa.int32()), ("last", pa.int32()),
            ("illegal", pa.int64()), ("vector", pa.binary()), ("added", pa.binary()), ("states", pa.binary())]))


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of a conversation from its last stretch to its first: the vector behind and the state before each.

    A conversation's records are held as a few numbers per stretch until its first one was seen.
    """
    table = tables()
    held, conv, after, vector, cost, illegal = [], None, None, table.end, 0, 0
    out, schema = [], None

    def close():
        state, total = START, cost + table.vectors[vector][START]
        last = len(held) - 1
        for i, (chunk, behind, states) in enumerate(reversed(held)):
            out.append((conv, chunk, behind, state, i == last, len(held) == 1, total if i == 0 else 0, illegal if i == 0 else 0))
            state = states[state]

    def flush():
        cols = list(zip(*out)) if out else [[]] * 8
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    for batch in batches:
        schema = pa.schema([("conv", batch.schema.field(0).type), ("chunk", pa.int64()), ("behind", pa.int32()), ("state", pa.int32()),
                            ("closes", pa.bool_()), ("alone", pa.bool_()), ("cost", pa.int64()), ("illegal", pa.int64())])
        for key, chunk, first, last, inside, nxt, added, states in zip(*(c.to_pylist() for c in batch.columns)):
            if not held or key != conv:
                if held:
                    close()
                held, conv, after, vector, cost, illegal = [], key, None, table.end, 0, 0
            illegal += inside + (after is not None and bool(_ILLEGAL[last, after]))
            held.append((chunk, vector, tuple(states[4 * vector: 4 * vector + 4])))
            cost += int.from_bytes(added[8 * vector: 8 * vector + 8], "little")
            vector, after = nxt[vector], first
        if len(out) >= 4096:
            yield flush()
            out = []
    if held:
        close()
    if schema is not None:
        yield flush()


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of each stretch ``(conv, chunk, codes, behind, state, closes, alone)``."""
    table = tables()
    for batch in batches:
        audits = []
        for codes, behind, state, closes in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
            symbols = _SYMBOL[np.array(codes, np.int64)]
            audit = table.trace(symbols, behind, state)
            if closes:
                for edit, code in _steps(audit, codes):
                    state = _after(state, edit, code)
                audit += table.closing(state)
            audits.append(audit)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(4), batch.column(6), pa.array(audits, pa.string())],
                                         names=["conv", "chunk", "state", "alone", "audit"])


def _steps(audit: str, codes: list[int]) -> Iterator[tuple[str, int]]:
    """Edits with the code of the row they concern (inserts: of none)."""
    rows = iter(codes)
    for edit in audit:
        yield edit, -1 if edit == "I" else next(rows)


def _after(state: int, edit: str, code: int) -> int:
    if edit == "D":
        return state
    return KEPT[state, code % _OTHER] if edit == "K" else EXPECTED[state]


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired rows of stretches: records in order ``(conv, chunk, at, role, text, state, alone, audit)``, edits first."""
    audit, used, body, state, alone, chunk, conv = "", 0, 0, START, False, None, None
    for batch in batches:
        schema = pa.schema([("conv_id", batch.schema.field(0).type), ("chunk", pa.int64()), ("alone", pa.bool_()), ("place", pa.int64()),
                            ("nth", pa.int32()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
        for start in range(0, batch.num_rows, 256):
            out, some = [], batch.slice(start, 256)
            for key, block, at, role, text, begin, single, edits in zip(*(c.to_pylist() for c in some.columns)):
                if edits is not None:
                    conv, chunk, audit, used, state, alone = key, block, edits, 0, begin, single
                    body = len(audit.rstrip("I"))
                    continue
                nth = 0
                while audit[used] == "I":
                    state, used = EXPECTED[state], used + 1
                    out.append((conv, chunk, alone, at, nth, "I", NAMES[state], ""))
                    nth += 1
                edit, used = audit[used], used + 1
                if edit == "K":
                    state = KEPT[state, INITIALS.index(role[0])]
                    out.append((conv, chunk, alone, at, nth, edit, role, text))
                elif edit == "R":
                    state = EXPECTED[state]
                    out.append((conv, chunk, alone, at, nth, edit, NAMES[state], text))
                while body <= used < len(audit):  # inserts behind the last row
                    state, used, nth = EXPECTED[state], used + 1, nth + 1
                    out.append((conv, chunk, alone, at, nth, "I", NAMES[state], ""))
            cols = list(zip(*out)) if out else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def repair(turns: DataFrame) -> Repair:
    """Counts, cheapest edits and repaired rows of ``turns(conv_id, turn, role, text)``.

    Null roles and texts count as one space; a null conversation id is a conversation of its own; rows repeat as often as they
    stand there.  ``summary`` has ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)``: ``gaps``
    counts missing turns between the least and the largest, ``illegal`` neighbours whose initials are none of su,
    ua, au.  Other columns are ignored; an empty table gives no rows.
    """
    spark = turns.sparkSession
    src = turns.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    conv_type = src.schema["conv"].dataType.simpleString()
    order = ["conv", "turn", F.xxhash64("role", "text")]
    placed = settle(src.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order, "role", "text")
                    .withColumn("at", F.monotonically_increasing_id()), "turns")
    # the first of equal rows, told apart from the others by its place
    owner = F.coalesce(F.concat(F.lit("c"), F.col("conv").cast("string")), F.lit("-"))
    marked = placed.select("at", F.sha2(F.concat_ws("\n", owner, F.length("role").cast("string"), "role", "text"), 256).alias("name"))
    firsts = (marked.groupBy("name").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
              .where(F.col("rows") > 1).select("name", "first"))
    repeated = marked.join(firsts, "name").where(F.col("at") != F.col("first")).select("at", F.lit(True).alias("repeats"))
    solid = F.col("text").rlike(_SOLID)
    coded = settle(placed.join(repeated, "at", "left").withColumn("again", F.coalesce("repeats", F.lit(False)))
                   .select("conv", "turn", "at", _code().alias("code"), (F.col("again") & solid).alias("dup"), (~solid).alias("blank")), "codes")
    chunk = F.floor(F.col("at") / CHUNK)
    stretches = settle(coded.groupBy("conv", chunk.alias("chunk")).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("at", "code"))), lambda r: r["code"].cast("int")).alias("codes")), "stretches")
    summaries = stretches.mapInArrow(_summaries, f"conv {conv_type}, chunk long, first int, last int, illegal long, "
                                                 "vector binary, added binary, states binary")
    chain = settle(summaries.repartition("conv").sortWithinPartitions("conv", F.col("chunk").desc()).mapInArrow(
        _chained, f"conv {conv_type}, chunk long, behind int, state int, closes boolean, alone boolean, cost long, illegal long"), "chain")
    linked = chain.select(F.col("conv").alias("c"), F.col("chunk").alias("k"), "behind", "state", "closes", "alone")
    traced = settle(stretches.join(linked, F.col("conv").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")))
                    .select("conv", "chunk", "codes", "behind", "state", "closes", "alone")
                    .mapInArrow(_traced, f"conv {conv_type}, chunk long, state int, alone boolean, audit string"), "edits")

    counts = (coded.groupBy("conv", "turn").agg(F.count(F.when(F.col("blank"), 1)).alias("blank"), F.count(F.when(F.col("dup"), 1)).alias("duplicate"),
                                                F.count(F.when((F.col("code") >= _OTHER) & (F.col("code") < 2 * _OTHER), 1)).alias("truncated"))
              .groupBy("conv").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
                                   *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]))
    costs = chain.groupBy(F.col("conv").alias("c1")).agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    audits = traced.groupBy(F.col("conv").alias("c2")).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda r: r["audit"]), "").alias("audit"))
    summary = (counts.join(costs, F.col("conv").eqNullSafe(F.col("c1"))).join(audits, F.col("conv").eqNullSafe(F.col("c2")))
               .select(F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"))

    records = placed.select("conv", chunk.alias("chunk"), "at", "role", "text").unionByName(
        traced.withColumn("at", F.lit(-1).cast("long")), allowMissingColumns=True)
    return Repair(summary, records.select("conv", "chunk", "at", "role", "text", "state", "alone", "audit")
                  .repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "at"))


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of repaired rows: digests of conversations that are here as a whole, else their text in pieces."""
    key, schema, out = None, None, []
    digest, lines, size, nth = hashlib.sha256(), [], 0, 0

    def end_run():
        if key is not None and key[2]:
            digest.update("".join(lines).encode())
            out.append((key[0], key[1], 0, digest.hexdigest(), None))
        elif key is not None and lines:
            out.append((key[0], key[1], nth, None, "".join(lines)))

    def flush():
        cols = list(zip(*out)) if out else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    for batch in _rendered(batches):
        schema = pa.schema([("conv", batch.schema.field(0).type), ("chunk", pa.int64()), ("nth", pa.int32()), ("digest", pa.string()), ("piece", pa.string())])
        for start in range(0, batch.num_rows, 256):
            for conv, chunk, alone, role, text in zip(*(batch.slice(start, 256).column(i).to_pylist() for i in (0, 1, 2, 6, 7))):
                if key != (conv, chunk, alone):
                    end_run()
                    key, digest, lines, size, nth = (conv, chunk, alone), hashlib.sha256(), [], 0, 0
                    lines.append(f"{role}:{text}")
                else:
                    lines.append(f"\n{role}:{text}")
                size += len(lines[-1])
                if size >= PIECE:
                    if alone:
                        digest.update("".join(lines).encode())
                    else:
                        out.append((conv, chunk, nth, None, "".join(lines)))
                        nth += 1
                    lines, size = [], 0
            if len(out) >= 1024 or sum(len(o[4] or "") for o in out) >= PIECE:
                yield flush()
                out.clear()
    end_run()
    if schema is not None:
        yield flush()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose pieces ``(conv, chunk, nth, piece)`` come in order."""
    open_, conv, chunk, digest, out, schema = False, None, None, None, [], None
    for batch in batches:
        schema = pa.schema([("conv", batch.schema.field(0).type), ("digest", pa.string())])
        for i in range(batch.num_rows):
            key, part, piece = batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), batch.column(3)[i].as_py()
            if not open_ or key != conv:
                if open_:
                    out.append((conv, digest.hexdigest()))
                open_, conv, digest = True, key, hashlib.sha256()
            elif part != chunk:
                digest.update(b"\n")
            chunk = part
            digest.update(piece.encode())
    if open_:
        out.append((conv, digest.hexdigest()))
    if schema is not None:
        cols = list(zip(*out)) if out else [[]] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def digests(done: Repair) -> DataFrame:
    """``(conv_id, digest)``: SHA-256 of the ``role:text`` lines of each conversation that kept any row.

    Conversations within one stretch are digested where they are repaired, in the same pass; the text of longer ones moves
    once more, in pieces, and streams through the digest in order (SHA-256 admits no other way).
    """
    conv_type = _type(done.records)
    runs = settle(done.records.mapInArrow(_digested, f"conv {conv_type}, chunk long, nth int, digest string, piece string"), "digests")
    whole = runs.where(F.col("digest").isNotNull()).select("conv", "digest")
    pieces = (runs.where(F.col("piece").isNotNull()).select("conv", "chunk", "nth", "piece")
              .repartition("conv").sortWithinPartitions("conv", "chunk", "nth").mapInArrow(_joined, f"conv {conv_type}, digest string"))
    return whole.unionByName(pieces).withColumnRenamed("conv", "conv_id")
