"""Splitting text into pieces by the public byte-level pattern, and encoding each distinct piece once.

Texts of printable ASCII, tab, line ends and Latin letters are split by array operations on their bytes; all
others by the Unicode pattern, in which white space is spelled out because ``\\s`` of Python's engines
also holds four control codes.  A piece is known by its 64-bit hash; pieces not seen before are encoded
together, as one corpus, and results are put together by array gathers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import regex

U64 = np.uint64
# Fixed by the public tokenizers: contractions, runs of letters, of digits and of other signs.
WHITE = r"\t-\r \x85\xa0  -     　"
_FULL = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+"
                      rf"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
# No piece reaches from other signs into white space, so any such border will do (not behind a special string, which may
# take white space along).  Scripts without spaces are cut between a letter and a mark that does not combine with it.
WHITE_CUT = regex.compile(rf"[^{WHITE}>](?=[ \n])")
_CUT = regex.compile(rf"[^{WHITE}>](?=[ \n])|\p{{L}}(?=[^{WHITE}\p{{L}}\p{{N}}\p{{M}}<|])")
STRETCH = 1 << 20  # characters split at once, so a very long text needs no more memory than a short one

_STOP, _BLANK, _LINE, _LETTER, _DIGIT, _SIGN = range(6)  # classes of bytes; a zero byte stops a text
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[0], _CLASS[32], _CLASS[[9, 10, 13]] = _STOP, _BLANK, _LINE
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = _LETTER
# bytes of no plain text: control codes, and the lead bytes of anything but U+00C0 to U+023F
_FOREIGN = np.zeros(256, bool)
_FOREIGN[[*range(9), 11, 12, *range(14, 32), 127, 0xC0, 0xC1, 0xC2, *range(0xC9, 256)]] = True

_NONE = U64(2**64 - 1)  # stands for the end of a text; sorts last

_draw = np.random.default_rng(77)
_BYTE = _draw.integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_STEP = 0x9E3779B97F4A7C15
_powers = np.multiply.accumulate(np.r_[U64(1), np.full(255, U64(_STEP))])


def stretches(text: str, border: regex.Pattern = _CUT) -> Iterable[str]:
    """The text in stretches that end at piece borders; with ``WHITE_CUT`` only before white space, so words stay whole."""
    at = 0
    while len(text) - at > STRETCH:
        found = border.search(text, at + STRETCH)
        if not found:
            break
        yield text[at: found.start() + 1]
        at = found.start() + 1
    yield text[at:]


def split(text: str) -> list[str]:
    return _FULL.findall(text)


def foreign(flat: np.ndarray) -> np.ndarray:
    """Positions of bytes that make a text not plain."""
    pair = (flat[:-1] == 0xC3) & ((flat[1:] == 0x97) | (flat[1:] == 0xB7))  # the signs for times and division
    return np.flatnonzero(_FOREIGN[flat] | np.r_[pair, False])


def starts_of(flat: np.ndarray, single_digits: bool = False, spaced_contractions: bool = False) -> np.ndarray:
    """Where the pieces of plain texts begin; every text in ``flat`` ends with a zero byte, a piece of its own.

    ``single_digits`` makes each digit a piece, ``spaced_contractions`` lets a contraction take the space
    before it (as the other runs do).
    """
    kind = _CLASS[flat]
    before = np.r_[np.uint8(_STOP), kind[:-1]]
    white = (kind == _BLANK) | (kind == _LINE)
    white_before = np.r_[False, white[:-1]]
    solid_next = np.r_[kind[1:] >= _LETTER, False]
    goes_on = (before == kind) & (kind != _DIGIT) if single_digits else before == kind
    # a run starts where the class changes, unless one space leads it; of white space before a run the last sign splits off
    start = np.where(white, ~white_before | solid_next, ~goes_on & (before != _BLANK))
    start[kind == _STOP] = True
    mark = np.flatnonzero((flat == 39) & (before != _SIGN))
    if not spaced_contractions:
        mark = mark[before[mark] != _BLANK]
    if len(mark):
        padded = np.r_[flat, np.zeros(3, np.uint8)]
        one, two = padded[mark + 1], padded[mark + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        at, size = mark[short | long], np.where(short, 2, 3)[short | long]
        start[at + 1] = False
        end = at + size
        inside = end < len(flat)
        start[end[inside]] |= kind[end[inside]] == _LETTER
    return np.flatnonzero(start)


def hashes(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hash of each piece."""
    global _powers
    sizes = np.diff(starts, append=len(flat))
    if sizes.max() > len(_powers):
        _powers = np.multiply.accumulate(np.r_[U64(1), np.full(2 * int(sizes.max()), U64(_STEP))])
    place = np.arange(len(flat)) - np.repeat(starts, sizes)
    x = np.add.reduceat(_BYTE[flat] * _powers[place], starts)
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    return x ^ (x >> U64(29))


def byte_signs() -> dict[int, str]:
    """The printable sign that stands for each byte: itself if printable, else the next from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + k)
    return out


class PieceTable:
    """Encodes texts piece by piece; ``encode`` maps a list of new distinct pieces to packed results.

    Up to ``limit`` pieces are kept; past it the table starts anew, so memory stays bounded and
    results never change.  ``width`` is the size in bytes of the results' items.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = 3_000_000, width: int = 4,
                 splitter: Callable[[str], list[str]] = split, **rules):
        self.encode, self.limit, self.kind, self.splitter, self.rules = encode, limit, np.dtype(f"u{width}"), splitter, rules
        self.forget()

    def forget(self) -> None:
        self.hash = np.array([_NONE], np.uint64)  # sorted
        self.at = np.zeros(1, np.int64)  # where each piece's result begins in ``flat``
        self.size = np.zeros(1, np.int64)
        self.flat, self.used = np.empty(1 << 16, self.kind), 0

    def learn(self, new_hash: np.ndarray, pieces: list[str]) -> None:
        """Encode new pieces (their hashes sorted) and merge them into the table."""
        done = [np.frombuffer(r, self.kind) for r in self.encode(pieces)]
        size = np.fromiter(map(len, done), np.int64, len(done))
        need = self.used + int(size.sum())
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.empty(2 * need - self.used, self.kind)])
        self.flat[self.used: need] = np.concatenate(done)
        where = np.searchsorted(self.hash, new_hash)
        self.at = np.insert(self.at, where, self.used + np.cumsum(size) - size)
        self.size = np.insert(self.size, where, size)
        self.hash = np.insert(self.hash, where, new_hash)
        self.used = need

    def _group(self, texts: list[str]) -> list[bytes]:
        """Results of several texts at once."""
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        flat = np.frombuffer(b"\0".join(raw) + b"\0", np.uint8)
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
        strange = np.zeros(len(raw), bool)
        bad = foreign(flat)
        bad = bad[(flat[bad] != 0) | (ends[np.searchsorted(ends, bad, "right").clip(max=len(ends) - 1)] - 1 != bad)]
        strange[np.searchsorted(ends, bad, "right")] = True
        starts = starts_of(flat, **self.rules)
        if strange.any():  # the borders of these texts come from the Unicode pattern
            owner = np.searchsorted(ends, starts, "right")
            own = [starts[~strange[owner]]]
            for i in np.flatnonzero(strange):
                sizes = np.fromiter((len(p.encode("utf-8", "surrogatepass")) for p in self.splitter(texts[i])), np.int64)
                own.append(ends[i] - 1 - len(raw[i]) + np.r_[0, np.cumsum(sizes)])
            starts = np.sort(np.concatenate(own))
        key = hashes(flat, starts)
        stops = np.searchsorted(starts, ends - 1)  # each text's last piece, its zero byte, has no result
        key[stops] = _NONE
        kinds, first, which = np.unique(key, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hash, kinds)
        known = self.hash[place] == kinds
        if len(self.hash) + int((~known).sum()) > self.limit:
            self.forget()
            known = kinds == _NONE
        if not known.all():
            new = first[~known]
            data, stop = flat.tobytes(), np.r_[starts[1:], len(flat)]
            spans = zip(starts[new].tolist(), stop[new].tolist())
            self.learn(kinds[~known], [data[s:e].decode("utf-8", "surrogatepass") for s, e in spans])
            place = np.searchsorted(self.hash, kinds)
        at, size = self.at[place][which], self.size[place][which]
        upto = np.cumsum(size)
        out = self.flat[np.repeat(at - (upto - size), size) + np.arange(int(upto[-1]))].tobytes()
        cut = np.r_[0, upto[stops] * self.kind.itemsize].tolist()
        return [out[s:e] for s, e in zip(cut, cut[1:])]

    def run(self, texts: list[str]) -> list[bytes]:
        """The joined results of every text; texts are taken in groups of about ``STRETCH`` characters."""
        pieces = [(i, s) for i, t in enumerate(texts) for s in (stretches(t) if len(t) > STRETCH else (t,))]
        out: list[list[bytes]] = [[] for _ in texts]
        at = 0
        while at < len(pieces):
            end, size = at, 0
            while end < len(pieces) and (end == at or size + len(pieces[end][1]) <= STRETCH):
                size += len(pieces[end][1])
                end += 1
            for (i, _), done in zip(pieces[at:end], self._group([s for _, s in pieces[at:end]])):
                out[i].append(done)
            at = end
        return [o[0] if len(o) == 1 else b"".join(o) for o in out]
