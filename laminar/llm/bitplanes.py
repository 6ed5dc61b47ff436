"""Token ids as files of compressed bit or byte planes with a chunk index.

A chunk holds the ids of consecutive documents.  Its ids are cut into blocks of ``BLOCK``;
each block is transposed into planes (plane ``p`` holds the ``p``-th byte, or bit, of every
id), equal planes of all blocks lie side by side, and each plane is compressed by itself with zstandard
(a plane of zeros is left out).  One row of a Parquet file is one chunk: its index columns
(part, chunk, first and last document, number of documents and ids, ids before it in its part)
are read without the payload, so a reader finds the chunk of a document by the index alone.
Parts are ranges of documents in ascending order; a part is one task's output, so files are
written and read by Spark on any file system it reaches, and a lost task writes its part anew.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laminar.llm.common import held, partitions
from laminar.llm.pieces import PieceTable, byte_signs

BLOCK = 4096
CHUNK = 1 << 18  # ids after which a chunk ends (a document is never cut)
MAGIC = b"PLN1"


def _planes(ids: np.ndarray, bits: bool) -> np.ndarray:
    """Blocks of ids transposed: one row per plane, a block's stretch of a plane after another's."""
    rows = -len(ids) % BLOCK
    blocks = np.concatenate([ids, np.zeros(rows, "<u4")]).view(np.uint8).reshape(-1, BLOCK, 4)
    if not bits:
        return np.ascontiguousarray(blocks.transpose(2, 0, 1)).reshape(4, -1)
    one = np.unpackbits(blocks, axis=2, bitorder="little")  # block, id, bit
    return np.packbits(one.transpose(2, 0, 1), axis=2, bitorder="little").reshape(32, -1)


def pack(ids: np.ndarray, bits: bool = False, level: int = 1) -> bytes:
    """A chunk's frame: magic, count, plane kind, then each plane's length and compressed bytes."""
    press = zstandard.ZstdCompressor(level=level)
    body = [press.compress(p.tobytes()) if p.any() else b"" for p in _planes(ids.astype("<u4"), bits)]
    return b"".join([MAGIC, struct.pack("<IB", len(ids), len(body)), struct.pack(f"<{len(body)}I", *map(len, body)), *body])


def unpack(frame: bytes) -> np.ndarray:
    if frame[:4] != MAGIC:
        raise ValueError("not a frame of id planes")
    n, planes = struct.unpack_from("<IB", frame, 4)
    sizes = struct.unpack_from(f"<{planes}I", frame, 9)
    at, width = 9 + 4 * planes, -(-n // BLOCK) * BLOCK // (8 if planes == 32 else 1)
    rows, press = np.zeros((planes, width), np.uint8), zstandard.ZstdDecompressor()
    for p, size in enumerate(sizes):
        if size:
            rows[p] = np.frombuffer(press.decompress(frame[at: at + size]), np.uint8)
        at += size
    if planes == 4:
        flat = rows.reshape(4, -1, BLOCK).transpose(1, 2, 0)
    else:
        one = np.unpackbits(rows.reshape(32, -1, BLOCK // 8), axis=2, bitorder="little")
        flat = np.packbits(one.transpose(1, 2, 0), axis=2, bitorder="little")
    return np.ascontiguousarray(flat).reshape(-1, 4).view("<u4").ravel()[:n]


class Vocabulary:
    """The tokenizers library behind a table of known pieces; special strings become their ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        if self.tok.normalizer is not None or type(self.tok.pre_tokenizer).__name__ != "ByteLevel":
            raise ValueError(f"{path} is not a plain byte-level tokenizer")
        self.sign = byte_signs()
        self.table = PieceTable(self._encode)
        special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.special = {s: array("I", [i]).tobytes() for s, i in special.items()}
        found = "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))
        self.cut = re.compile(f"({found})") if special else None

    def _encode(self, new: list[str]) -> list[bytes]:
        """Ids of single pieces by the library's model, which takes bytes as printable signs."""
        encode, sign = self.model.tokenize, self.sign
        return [array("I", [t.id for t in encode(p.encode().decode("latin-1").translate(sign))]).tobytes() for p in new]

    def run(self, texts: list[str]) -> list[bytes]:
        odd = {i for i, t in enumerate(texts) if self.cut and self.cut.search(t)}
        plain = iter(self.table.run([t for i, t in enumerate(texts) if i not in odd]))
        out = []
        for i, t in enumerate(texts):
            if i not in odd:
                out.append(next(plain))
            else:
                out.append(b"".join(self.special.get(s) or self.table.run([s])[0] for s in self.cut.split(t)))
        return out


_INDEX = "part int, chunk int, first_doc long, last_doc long, n_docs long, n_ids long, before long"


def write_ids(docs: DataFrame, tokenizer: str, end_id: int, out: str, bits: bool = False,
              id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id``, and write the ids in ascending id order under ``out``.

    Null texts count as empty.  Repeated ids keep all their rows, ordered by a hash of the text;
    rows with a null id come first and are stored with the smallest long.  An
    empty table writes an empty file.  Other columns are ignored.
    """
    n = partitions(docs.sparkSession)
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("id"), F.xxhash64("text")]
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, part = held(("planes", tokenizer), lambda: Vocabulary(tokenizer)), TaskContext.get().partitionId()
        ids, waiting, docs_in, sizes, chunk, before = [], 0, [], [], 0, 0

        def frame():
            flat = np.frombuffer(b"".join(ids), "<u4")
            table = pack(np.array(sizes, "<u4"), bits)
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "chunk": pa.array([chunk], pa.int32()),
                 "first_doc": [docs_in[0]], "last_doc": [docs_in[-1]], "n_docs": [len(docs_in)], "n_ids": [len(flat)],
                 "before": [before], "docs": [np.array(docs_in, "<i8").tobytes()], "sizes": [table],
                 "planes": [pack(flat, bits)]})

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                for doc, coded in zip(piece.column(0).to_pylist(), vocab.run(piece.column(1).to_pylist())):
                    ids += [coded, end]
                    docs_in.append(doc)
                    sizes.append(len(coded) // 4 + 1)
                    waiting += sizes[-1]
                    if waiting >= CHUNK:
                        yield frame()
                        before += waiting
                        chunk += 1
                        ids, waiting, docs_in, sizes = [], 0, [], []
        if docs_in:
            yield frame()

    (src.repartitionByRange(n, *order).sortWithinPartitions(*order)
     .mapInArrow(run, f"{_INDEX}, docs binary, sizes binary, planes binary")
     .write.option("compression", "uncompressed").parquet(out))


def chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """The index of all chunks, with ``start``: ids of all chunks before (payload columns are not read)."""
    return _with_start(spark.read.parquet(path)).select(*[c.split()[0] for c in _INDEX.split(", ")], "start")


def _with_start(chunks: DataFrame) -> DataFrame:
    # one row per part, and there are as many parts as writing tasks: small enough for one window and a broadcast
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    return chunks.join(F.broadcast(starts), "part").withColumn("start", F.col("part_start") + F.col("before"))


def read_ids(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``(id, start, ids)`` per document: its ids packed as little-endian u32, and the ids of all before it."""
    src = _with_start(spark.read.parquet(path)).select("start", "docs", "sizes", "planes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, docs, sizes, planes in zip(*(c.to_pylist() for c in batch.columns)):
                n = unpack(sizes).astype(np.int64)
                ends = np.cumsum(n)
                raw = unpack(planes).tobytes()
                ids = [raw[4 * (e - k): 4 * e] for e, k in zip(ends.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(docs, "<i8")), pa.array(start + ends - n), pa.array(ids, pa.binary())],
                    [id_col, "start", "ids"])

    return src.mapInArrow(run, f"`{id_col}` long, start long, ids binary")
