"""Byte-level BPE by corpus-level merge replay, and its inverse.

The distinct pieces of a task's texts form the corpus.  An inverted index maps a token
pair (named by the token it merges into, whose id is its rank) to the positions where
it stands in the corpus.  Merges are applied in rank order to all their positions at
once; a merge changes only the two neighbouring pairs, which are re-indexed.  Pieces
never touch each other, so each ends as if merged alone, and the ids do not depend on
how the table is split into tasks.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import held
from laminar.llm.pieces import PieceTable


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class MergeReplay:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.token = ranks, {i: t for t, i in ranks.items()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.pairs: dict[tuple[int, int], int] = {}

    def merged(self, a: int, b: int) -> int:
        """The token a pair merges into, -1 if none."""
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) > 1 << 18:
                self.pairs.clear()
            got = self.pairs[a, b] = self.ranks.get(self.token[a] + self.token[b], -1)
        return got

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Ids of every word as little-endian unsigned 32-bit integers."""
        ids: list[int] = []
        after: list[int] = []  # position of the next token in the word, -1 at its end or once merged away
        before: list[int] = []
        starts: list[int] = []
        index: dict[int, list[int]] = {}
        merged, single = self.merged, self.single
        for w in words:
            at, n = len(ids), len(w)
            starts.append(at)
            ids.extend([single[b] for b in w])
            after.extend(range(at + 1, at + n))
            after.append(-1)
            before.append(-1)
            before.extend(range(at, at + n - 1))
            for i in range(at, at + n - 1):
                r = merged(ids[i], ids[i + 1])
                if r >= 0:
                    index.setdefault(r, []).append(i)
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            rank = heapq.heappop(heap)
            places = index.pop(rank, None)
            if places is None:
                continue
            places.sort()
            for k, i in enumerate(places):
                j = after[i]
                if j < 0 or ids[i] < 0 or merged(ids[i], ids[j]) != rank:
                    continue  # a neighbour changed since this place was indexed
                n = after[j]
                ids[i], ids[j], after[i] = rank, -1, n
                lower = False
                if n >= 0:
                    before[n] = i
                    r = merged(rank, ids[n])
                    if r >= 0:
                        if r not in index:
                            index[r] = [i]
                            heapq.heappush(heap, r)
                        else:
                            index[r].append(i)
                        lower = r < rank
                p = before[i]
                if p >= 0:
                    r = merged(ids[p], rank)
                    if r >= 0:
                        if r not in index:
                            index[r] = [p]
                            heapq.heappush(heap, r)
                        else:
                            index[r].append(p)
                        lower = lower or r < rank
                if lower:  # an earlier merge became possible: it goes first
                    rest = places[k + 1:]
                    if rest:
                        index.setdefault(rank, []).extend(rest)
                        heapq.heappush(heap, rank)
                    break
        out = []
        for s in starts:
            row = []
            while s >= 0:
                row.append(ids[s])
                s = after[s]
            out.append(array("I", row).tobytes())
        return out


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str):
        self.replay = MergeReplay(load_ranks(path))
        self.table = PieceTable(lambda new: self.replay.replay([p.encode("utf-8", "surrogatepass") for p in new]))

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.table.run(texts)

    def decode(self, packed: list[bytes | None]) -> list[bytes | None]:
        token = self.replay.token.__getitem__
        return [None if ids is None else b"".join(map(token, np.frombuffer(ids, "<u4").tolist())) for ids in packed]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``(id, ids)``: ids of the whole text, packed as little-endian unsigned 32-bit integers.

    With ``decoded`` a third column holds the bytes that the ids decode to.

    ``path`` names a rank file that executors can read.  A null or empty text has no ids.
    Every input row gives one row (repeated ids too); other columns are ignored; an empty
    table gives no rows.  Texts of any length are encoded whole, a stretch at a time.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = held(("bpe", path), lambda: Codec(path))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = codec.encode(texts)
                cols = [part.column(0), pa.array(ids, pa.binary())]
                if decoded:
                    cols.append(pa.array(codec.decode(ids), pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, ["id", "ids", "decoded"][: len(cols)])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, ids binary" + ", decoded binary" * decoded).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded`` added: the bytes of the ids (null ids give null)."""
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = held(("bpe", path), lambda: Codec(path))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = codec.decode(part.column(names.index(ids_col)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], [*names, "decoded"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{ddl}, decoded binary")
