"""Exact token counts at every prefix by dynamic programming over BPE prefixes.

The last token of the encoding of a prefix is the only vocabulary suffix of it that may follow
the last token of the shorter prefix before it (two neighbouring tokens stand if encoding
their text gives just them).  So one pass over a piece finds the count at every prefix,
without encoding any prefix anew.  A document's index holds the change of the count from
each character to the next; its running sum is the count at every prefix, which answers
truncation and budget questions later without a tokenizer.

The tokenizer is a lower-casing BPE with word ends (``</w>``): pieces are contractions,
runs of letters, single digits and runs of other signs, and white space is dropped.
Prefixes are those of the text in NFC and lower case (the same characters for nearly all
texts; never another count for the whole text).
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import accumulate
from operator import sub

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import held
from laminar.llm.pieces import WHITE, PieceTable, byte_signs

# Fixed by the tokenizer: its pieces.  A leading space is taken along; it adds no token.
_CONTRACTION = "'s|'t|'re|'ve|'m|'ll|'d"
_FULL = regex.compile(rf" ?(?:{_CONTRACTION})| ?\p{{L}}+| ?\p{{N}}| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+")
_BARE = regex.compile(rf"{_CONTRACTION}|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+")
_WHITE = frozenset(regex.findall(f"[{WHITE}]", "".join(map(chr, range(0x3001)))))
_ODD = re.compile("[^\x00-\x7fÀ-įĲ-ȿ]|İ")  # outside it, NFC and lower case are not plainly those of a text
_TWO_STEP = re.compile("'(?:re|ve|ll)")
END = "</w>"
NEVER = 1 << 60


class PrefixCounter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab = set(spec["model"]["vocab"])
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.rank = {m: i for i, m in enumerate(merges)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.sign = byte_signs()
        self.tokens = sorted(self.vocab)
        self.start = len(self.tokens)
        self.suffixes: dict = {}  # a trie of tokens read backwards: where a walk ends, no longer token can end
        for i, t in enumerate(self.tokens):
            node = self.suffixes
            for c in reversed(t.removesuffix(END) or t):
                node = node.setdefault(c, {})
            inner, final = node.get("", (-1, -1))
            node[""] = (inner, i) if t.endswith(END) and t != END else (i, final)
        self.stands: dict[int, bool] = {}
        self.previous: tuple = ("", [self.start], [0], [0])
        self.at_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None

    def _merge(self, symbols: list[str]) -> list[str]:
        rank = self.rank
        while len(symbols) > 1:
            ranks = [rank.get(p, NEVER) for p in zip(symbols, symbols[1:])]
            low = min(ranks)
            if low == NEVER:
                break
            best = ranks.index(low)
            symbols[best: best + 2] = [symbols[best] + symbols[best + 1]]
        return symbols

    def _symbols(self, token: str) -> list[str]:
        body = token.removesuffix(END)
        out = list(body)
        if body != token and body:
            out[-1] += END
        return out

    def may_follow(self, last: int, token: int) -> bool:
        """Whether ``token`` stands right after ``last`` (or at the start) in an encoding."""
        if len(self.stands) > 1 << 20:
            self.stands.clear()
        b = self.tokens[token]
        if last == self.start:
            got = self._merge(self._symbols(b)) == [b]
        else:
            a = self.tokens[last]
            got = self._merge(self._symbols(a) + self._symbols(b)) == [a, b]
        self.stands[last << 20 | token] = got
        return got

    def prefixes(self, piece: str) -> list[int]:
        """Token counts of every prefix of one piece, each taken as a piece of its own."""
        if piece.isascii() and piece.isprintable():
            w, ends = piece, None
        else:
            raw = [c.encode("utf-8", "surrogatepass") for c in piece]
            w = "".join(self.sign[b] for c in raw for b in c)
            ends = list(accumulate(map(len, raw)))
        # what the previous piece shares with this one is known already (pieces come sorted)
        old, last, count, closed = self.previous
        same = 0
        for a, b in zip(old, w):
            if a != b:
                break
            same += 1
        last, count, closed = last[: same + 1], count[: same + 1], closed[: same + 1]
        root, stands, follow = self.suffixes, self.stands, self.may_follow
        for i in range(same + 1, len(w) + 1):
            node, j, inner, final = root, i, -1, -1  # counts of the prefix as it stands inside a word and as a word
            while j and (inner < 0 or final < 0):
                j -= 1
                node = node.get(w[j])
                if node is None:
                    break
                found = node.get("")
                if found is None:
                    continue
                before = last[j]
                token, closing = found
                if inner < 0 and token >= 0:
                    ok = stands.get(before << 20 | token)
                    if ok is None:
                        ok = follow(before, token)
                    if ok:
                        inner = count[j] + 1
                        last.append(token)
                if final < 0 and closing >= 0:
                    ok = stands.get(before << 20 | closing)
                    if ok is None:
                        ok = follow(before, closing)
                    if ok:
                        final = count[j] + 1
            count.append(inner)
            closed.append(final)
        self.previous = (w, last, count, closed)
        return closed[1:] if ends is None else [closed[e] for e in ends]

    def piece_changes(self, piece: str) -> bytes:
        """Changes of the count over one piece of the split, as int32."""
        body = piece.lstrip(" ")
        lead = len(piece) - len(body)
        if not body or body[0] in _WHITE:
            return array("i", [0] * len(piece)).tobytes()
        counts = self.prefixes(body)
        if _TWO_STEP.fullmatch(body):  # its inner prefix is a sign and a letter, two pieces
            counts[1] = sum(self.prefixes(p)[-1] for p in _BARE.findall(body[:2]))
        return array("i", [*([0] * lead), counts[0], *map(sub, counts[1:], counts)]).tobytes()


def _split(text: str) -> list[str]:
    return _FULL.findall(text)


def fold(text: str) -> str:
    """NFC and lower case, character by character."""
    if not _ODD.search(text):
        return text.lower()
    return "".join(c.lower() for c in unicodedata.normalize("NFC", text))


class PrefixIndex:
    """Builds the change arrays of texts; one per Python worker and tokenizer."""

    def __init__(self, path: str):
        self.counter = PrefixCounter(path)
        self.table = PieceTable(self._pack_all, width=1, splitter=_split, single_digits=True, spaced_contractions=True)

    def _pack_all(self, new: list[str]) -> list[bytes]:
        known = {p: self._pack(p) for p in sorted(new, key=lambda p: p.lstrip(" "))}
        return [known[p] for p in new]

    def _pack(self, piece: str) -> bytes:
        changes = self.counter.piece_changes(piece)
        return array("b", array("i", changes)).tobytes()  # an OverflowError here would mean a jump of over 127

    def plain(self, texts: list[str]) -> list[bytes]:
        """Changes of texts without special strings."""
        return self.table.run([fold(t) for t in texts])

    def one(self, text: str) -> bytes:
        """Changes of a text in which special strings are tokens of their own."""
        out, at, spec = [], 0, self.counter.at_special
        for m in spec.finditer(text):
            base = self.plain([text[at: m.start()]])[0]
            whole = self.plain([text[at: m.end() - 1]])[0]
            jump = int(np.frombuffer(base, np.int8).sum(dtype=np.int64)) + 1 - int(
                np.frombuffer(whole, np.int8).sum(dtype=np.int64))
            out.append(whole + np.int8(jump).tobytes())
            at = m.end()
        return b"".join([*out, self.plain([text[at:]])[0]])

    def run(self, texts: list[str]) -> list[bytes]:
        spec = self.counter.at_special
        odd = {i for i, t in enumerate(texts) if spec and "<|" in t and spec.search(t)}
        out = iter(self.plain([t for i, t in enumerate(texts) if i not in odd]))
        return [self.one(t) if i in odd else next(out) for i, t in enumerate(texts)]


def prefix_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_chars, n_tokens, changes)`` per document.

    ``changes`` holds one signed byte per character: how the token count of the prefix
    changes there.  ``n_tokens`` is the last prefix's count, as the library gives it for the
    whole text with its default handling of special strings.  Null and empty texts have
    zero bytes and tokens.  Every input row gives one row; other columns are ignored; an empty
    table gives no rows; long texts are handled a stretch at a time.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held(("prefix", path), lambda: PrefixIndex(path))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                changes = index.run([t or "" for t in part.column(1).to_pylist()])
                total = [int(np.frombuffer(c, np.int8).sum(dtype=np.int64)) for c in changes]
                size = pc.fill_null(pc.binary_length(part.column(1)).cast(pa.int64()), 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), size, pa.array(list(map(len, changes)), pa.int64()),
                     pa.array(total, pa.int64()), pa.array(changes, pa.binary())],
                    ["id", "n_bytes", "n_chars", "n_tokens", "changes"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, n_bytes long, n_chars long, n_tokens long, changes binary"
                          ).withColumnRenamed("id", id_col)


def counts_at(changes: bytes) -> np.ndarray:
    """Token counts of all prefixes, from the empty one on."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(changes, np.int8), dtype=np.int64)])


def fit_budget(index: DataFrame, budget: int, id_col: str = "doc_id") -> DataFrame:
    """``(id, n_tokens, keep_chars)``: the longest prefix of at most ``budget`` tokens, read off the index."""
    src = index.select(id_col, "n_tokens", "changes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [len(c) if n <= budget else int(np.flatnonzero(counts_at(c) <= budget)[-1])
                    for n, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keep, pa.int64())],
                                             [id_col, "n_tokens", "keep_chars"])

    kind = src.schema[id_col].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, keep_chars long")
