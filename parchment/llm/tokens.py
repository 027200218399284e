"""Token ids of whole batches, equal to those of the tokenizers library.

Byte-level BPE first splits a text by the vocabulary's pattern and then merges within each piece, so a piece's ids don't
depend on the text around it.  Pieces of a batch are found by vector operations, and only those that a worker
hasn't seen lately are encoded.  A piece of up to 15 bytes is told by its bytes and length, as two words; a hash of them finds where it is
kept, and the words are compared there.  Longer pieces are kept by their bytes.  Texts with characters whose class may differ between Unicode versions, or with
the name of a special token, go to the tokenizers library whole.
"""

from __future__ import annotations

import base64
import unicodedata
from itertools import chain

import numpy as np

from parchment.llm.textbuf import U64, mix, run_starts

#: Characters below this are classed by table; blocks above still gain characters.
KNOWN = 0x3000
SPACE, LETTER, NUMBER, OTHER, UNSURE = range(5)
#: Pieces whose ids are kept, some 40 bytes each, and the latest of them, which are merged with the others when so many.
CACHE_PIECES, LATEST = 1_500_000, 1 << 16
#: Bytes of a piece that two words and its length hold; longer pieces kept at most.
SHORT, LONG_PIECES = 15, 200_000
SPECIAL = "<|endoftext|>"

_table: np.ndarray | None = None


def _classes() -> np.ndarray:
    global _table
    if _table is None:
        _table = np.full(KNOWN + 1, UNSURE, np.uint8)
        for c in range(KNOWN):
            kind = unicodedata.category(chr(c))
            white = chr(c).isspace() and c not in range(0x1C, 0x20)
            _table[c] = UNSURE if kind == "Cn" else SPACE if white else LETTER if kind[0] == "L" else NUMBER if kind[0] == "N" else OTHER
    return _table


def pieces(points: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the pattern's pieces, class of each character); begin: whether a text begins at a character.

    The pattern: contractions; runs of letters, of numbers or of others, each with one blank before it; white
    space up to the last character before a run.
    """
    kind = _classes()[np.minimum(points, KNOWN)]
    white = kind == SPACE
    prev_kind, prev_white, prev_point = np.roll(kind, 1), np.roll(white, 1), np.roll(points, 1)
    ends = np.roll(begin, -1)
    if len(ends):
        ends[-1] = True
    start = begin | (white & ~prev_white) | (~white & ~prev_white & (kind != prev_kind)) | (~white & prev_white & (prev_point != 32))
    start |= white & ~np.roll(white, -1) & ~ends  # the last white character before a run
    at = np.flatnonzero(start & (points == 39) & ~ends)  # contractions
    if len(at):
        after = points[at + 1]
        two = np.isin(after, [115, 116, 109, 100]) & ~begin[at + 1]
        third_ok = (at + 2 < len(points)) & ~ends[at + 1] & ~begin[at + 1]
        third = points[np.minimum(at + 2, len(points) - 1)]
        three = third_ok & (((after == 114) | (after == 118)) & (third == 101) | (after == 108) & (third == 108))
        for which, size in ((two, 2), (three, 3)):
            where = at[which]
            start[where + 1] = False
            past = where + size
            start[past[past < len(points)]] = True
    return np.flatnonzero(start), kind


class Encoder:
    """Encodes batches; keeps the ids of the latest pieces."""

    def __init__(self, json_path: str, rank_path: str):
        import tiktoken
        from public_tokenizers import PATTERN

        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("parchment", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.json_path, self.whole = json_path, None
        self._clear()

    def _clear(self) -> None:
        self.pool, self.used = np.zeros(1 << 18, np.uint32), 0
        self.begin, self.size, self.known = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32), 0
        self.words, self.long = np.zeros((1 << 16, 2), U64), {}
        # sorted names of pieces and where they are kept: all but the latest, and the latest
        self.levels = [(np.zeros(0, U64), np.zeros(0, np.int32)) for _ in range(2)]

    def _kept(self, names: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where pieces are kept, by their sorted names; -1 for those that aren't; whether another piece has the name)."""
        out = np.full(len(names), -1, np.int64)
        for have, slots in self.levels:
            if len(have):
                at = np.minimum(np.searchsorted(have, names), len(have) - 1)
                out = np.where(have[at] == names, slots[at], out)
        other = (out >= 0) & (self.words[out] != words).any(1)
        out[other] = -1
        return out, other

    def _keep(self, names: np.ndarray, words: np.ndarray, found: list[list[int]], named: np.ndarray) -> np.ndarray:
        """Keep the ids of new pieces; returns where.  Only those that are named are found again."""
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        total = int(sizes.sum())
        self.pool = _room(self.pool, self.used + total)
        self.pool[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
        self.begin, self.size = _room(self.begin, self.known + len(names)), _room(self.size, self.known + len(names))
        slots = np.arange(self.known, self.known + len(names), dtype=np.int32)
        self.begin[slots], self.size[slots] = self.used + np.cumsum(sizes) - sizes, sizes
        if len(self.words) < len(self.begin):
            self.words = np.concatenate((self.words, np.zeros((len(self.begin) - len(self.words), 2), U64)))
        self.words[slots] = words
        self.used, self.known = self.used + total, self.known + len(names)
        self.levels[1] = _merged(*self.levels[1], names[named], slots[named])
        if len(self.levels[1][0]) > LATEST:
            self.levels = [_merged(*self.levels[0], *self.levels[1]), (np.zeros(0, U64), np.zeros(0, np.int32))]
        return slots

    def _slots(self, buf: np.ndarray, data: bytes, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Where the ids of every piece are kept; new ones are encoded."""
        core, size = self.fast._core_bpe.encode_ordinary, high - low
        ids = lambda of: [core(data[a:b].decode()) for a, b in zip(low[of].tolist(), high[of].tolist(), strict=True)]
        out = np.empty(len(low), np.int64)
        short = np.flatnonzero(size <= SHORT)
        words = short_words(buf, low[short], size[short])
        h = mix(words[:, 0] ^ mix(words[:, 1]))
        first, inverse = _grouped(h)
        alike = (words[first[inverse]] == words).all(1)
        slot, other = self._kept(h[first], words[first])
        new = np.flatnonzero(slot < 0)
        if len(new):
            slot[new] = self._keep(h[first[new]], words[first[new]], ids(short[first[new]]), ~other[new])
        out[short] = slot[inverse]
        apart = short[~alike]  # another piece of this batch has the same hash
        if len(apart):
            out[apart] = self._keep(h[~alike], words[~alike], ids(apart), np.zeros(len(apart), bool))
        long = np.flatnonzero(size > SHORT)
        if len(long):
            texts = [data[a:b] for a, b in zip(low[long].tolist(), high[long].tolist(), strict=True)]
            fresh = [t for t in dict.fromkeys(texts) if t not in self.long]
            if fresh:
                kept = self._keep(np.zeros(len(fresh), U64), np.zeros((len(fresh), 2), U64), [core(t.decode()) for t in fresh], np.zeros(len(fresh), bool))
                self.long.update(zip(fresh, kept.tolist(), strict=True))
            out[long] = [self.long[t] for t in texts]
        return out

    def by_library(self, text: str) -> list[int]:
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.json_path)
        return self.whole.encode(text, add_special_tokens=False).ids

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of all texts of a chunk: text i has ids[ends[i]:ends[i + 1]]."""
        n_docs = len(off) - 1
        data = buf.tobytes()
        points = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
        byte_at = np.append(np.flatnonzero((buf & 0xC0) != 0x80), len(buf))
        first = np.searchsorted(byte_at, off)
        begin = np.zeros(len(points), bool)
        begin[first[:-1][first[:-1] < len(points)]] = True
        start, kind = pieces(points, begin)
        odd = np.flatnonzero(kind == UNSURE)
        whole = set((np.searchsorted(first, odd, "right") - 1).tolist())
        mark, at = SPECIAL.encode(), data.find(SPECIAL.encode())
        while at >= 0:
            whole.add(int(np.searchsorted(off, at, "right") - 1))
            at = data.find(mark, at + 1)
        low = byte_at[start]
        high = np.append(low[1:], len(buf))
        if self.known > CACHE_PIECES or self.used > CACHE_PIECES * 4 or len(self.long) > LONG_PIECES:
            self._clear()
        slot = self._slots(buf, data, low, high)
        size = self.size[slot]
        total = np.concatenate(([0], np.cumsum(size)))
        ids = self.pool[np.repeat(self.begin[slot] - total[:-1], size) + np.arange(total[-1])]
        ends = total[np.searchsorted(start, first)]
        if whole:
            parts = [np.array(self.by_library(data[off[i] : off[i + 1]].decode()), np.uint32) if i in whole else ids[ends[i] : ends[i + 1]] for i in range(n_docs)]
            ids = np.concatenate(parts)
            ends = np.concatenate(([0], np.cumsum([len(x) for x in parts])))
        return ids, ends


def short_words(buf: np.ndarray, low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of pieces of up to SHORT bytes and their length, as two words each: equal words, equal pieces."""
    room = np.concatenate((buf, np.zeros(16, np.uint8)))
    at = np.ndarray((len(room) - 7,), "<u8", room, strides=(1,))  # the eight bytes from each place
    part = lambda n: np.where(n >= 8, ~U64(0), (U64(1) << (U64(8) * np.minimum(n, 7).astype(U64))) - U64(1))
    out = np.empty((len(low), 2), U64)
    out[:, 0] = at[low] & part(size)
    out[:, 1] = (at[low + 8] & part(np.maximum(size - 8, 0))) | (size.astype(U64) << U64(56))
    return out


def _room(a: np.ndarray, n: int) -> np.ndarray:
    """An array that begins as a and has room for n values or more."""
    return a if len(a) >= n else np.concatenate((a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)))


def _merged(names: np.ndarray, slots: np.ndarray, more: np.ndarray, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted lists of names, with their slots, as one."""
    at = np.searchsorted(names, more)
    return np.insert(names, at, more), np.insert(slots, at, theirs)


def _grouped(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of one occurrence of each distinct value, which distinct value each place has)."""
    order = np.argsort(h)
    at = run_starts(h[order])
    inverse = np.empty(len(h), np.int64)
    inverse[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(h))))
    return order[at], inverse
