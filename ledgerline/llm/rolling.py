"""Keys of all windows of a block of texts, by array operations.

A key is one or two independent numbers of 64 bits (lanes). A word's is made of its length and its
bytes, eight at a time; a very long word's comes from a cryptographic hash. A longer window's is
made of the keys of two windows that cover it, level by level. Both use salted multiplying and shifting rounds
that are no ring operation; so no pattern of letters or words makes different windows meet, as it does
with a polynomial of a fixed modulus. Operators whose texts may be written to make keys meet draw the salts anew for each
run (fresh_salts) and ship them with the plan, so that nobody who writes a text knows them. Equal windows have equal keys wherever they stand. Two lanes are 128 bits: among the 1.7e13 windows of 100 TB
the expected number of different ones with equal keys is 4e-13.
"""

from __future__ import annotations

import secrets
from hashlib import blake2b

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEY = b"windows of words"
#: Bytes from which on a word is hashed as a whole; what is left of eight bytes that end a word.
_LONG = 256
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: What is added before each of the two mixing rounds, by lane.
Salts = list[list[np.uint64]]
_SALTS: Salts = [[np.uint64(x) for x in row] for row in np.random.default_rng(20240229).integers(1 << 62, 1 << 63, (2, 2), dtype=np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the word (in place)."""
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def fresh_salts() -> Salts:
    """Salts of two lanes that only this run knows."""
    return [[np.uint64(secrets.randbits(64)) for _ in range(2)] for _ in range(2)]


def pair(x: np.ndarray, y: np.ndarray, lane: int = 0, salts: Salts = _SALTS) -> np.ndarray:
    """Key of what the keys x and y cover, in this order."""
    h = mix(y + salts[lane][0])
    h ^= x
    h += salts[lane][1]
    return mix(h)


def doubled(h: np.ndarray, length: int, lane: int = 0, done: int = 1, salts: Salts = _SALTS) -> np.ndarray:
    """Keys of all windows of `length` places, from those of `done` places."""
    while done < length:
        step = min(done, length - done)
        if len(h) <= step:
            return h[:0]
        h = pair(h[:-step], h[step:], lane, salts)
        done += step
    return h


def distinct_keys(a: np.ndarray, b: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct keys (n x lanes) in ascending order, the first place of each (of two lanes), which of
    them every place has, and how often each occurs."""
    if b is None:
        keys, which, count = np.unique(a, return_inverse=True, return_counts=True)
        return keys[:, None], None, which, count
    order = np.lexsort((b, a))
    keys = np.stack([a[order], b[order]], 1)
    new = np.ones(len(order), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(1)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return keys[new], order[new], which, np.diff(np.append(np.flatnonzero(new), len(order)))


def text_buffer(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each starts (one number more)."""
    a = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    a = a.cast(pa.large_binary())
    if not len(a):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = a.buffers()
    o = np.frombuffer(offsets, np.int64)[a.offset : a.offset + len(a) + 1]
    d = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, np.uint8)
    return d, o - o[0]


def slices(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.Array:
    """The byte strings data[first:last] as one array."""
    lengths = last - first
    ends = np.cumsum(lengths)
    place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - lengths), lengths)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[place]))])


class Bytes:
    """Keys of the byte windows of a text buffer; a window has a multiple of 8 bytes or any number from 32 up."""

    def __init__(self, data: np.ndarray):
        n = max(0, len(data) - 7)
        self._eight = np.ndarray((n,), "<u8", np.ascontiguousarray(data), 0, (1,)).copy() if n else np.zeros(0, np.uint64)

    def windows(self, length: int) -> np.ndarray:
        """Key of the window of 16 or 32 bytes at every place."""
        h, done = self._eight, 8
        while done < length:
            h = pair(h[:-done], h[done:]) if len(h) > done else h[:0]
            done *= 2
        return h

    def spans(self, first: np.ndarray, last: np.ndarray, lane: int) -> np.ndarray:
        """Keys of data[first:last], of 32 bytes at least."""
        e = self._eight
        out = mix((last - first).astype(np.uint64))
        at = first.copy()
        while True:
            some = np.flatnonzero(at < last)
            if not len(some):
                return out
            p = np.minimum(at[some], last[some] - 32)
            piece = pair(pair(e[p], e[p + 8], lane), pair(e[p + 16], e[p + 24], lane), lane)
            out[some] = pair(out[some], piece, lane)
            at += 32


class Words:
    """The words (runs of bytes other than 0x20 and 0x09-0x0D) of a block of texts.

    start, end: each word's place in `data`; first: the first word of each text (one number
    more); text: each word's text.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, salts: Salts = _SALTS):
        self.data, self.salts = data, salts
        solid = ~SPACE[data]
        before, after = np.empty(len(data), bool), np.empty(len(data), bool)
        before[1:], after[:-1] = solid[:-1], solid[1:]
        if len(data):
            before[0] = after[-1] = False
            edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
            before[edges], after[edges - 1] = False, False
        starts = solid & ~before
        self.start, self.end = np.flatnonzero(starts), np.flatnonzero(solid & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self._kept = np.concatenate([_LOWER[data[solid]] if lower else data[solid], np.zeros(8, np.uint8)])
        self._lanes: dict[int, np.ndarray] = {}

    def lane(self, k: int) -> np.ndarray:
        """A lane of each word's key."""
        if k not in self._lanes:
            eight = np.ndarray((len(self._kept) - 7,), "<u8", self._kept, 0, (1,))
            lengths = self.end - self.start
            first = np.cumsum(lengths) - lengths
            h = mix(lengths.astype(np.uint64) + self.salts[k][1])
            short = lengths <= _LONG
            for at in range(0, int(lengths[short].max(initial=0)), 8):
                some = np.flatnonzero(short & (lengths > at)) if at else np.flatnonzero(short)
                x = eight[first[some] + at] & _MASKS[np.minimum(lengths[some] - at, 8)]
                h[some] = pair(h[some], x, k, self.salts)
            salt = b"".join(int(x).to_bytes(8, "little") for x in self.salts[0])
            for i in np.flatnonzero(~short).tolist():
                word = self._kept[first[i] : first[i] + lengths[i]].tobytes()
                h[i] = int.from_bytes(blake2b(word, digest_size=16, key=_KEY, salt=salt).digest()[8 * k : 8 * k + 8], "little")
            self._lanes[k] = h
        return self._lanes[k]

    def windows(self, length: int, at: np.ndarray | None = None, lanes: int = 1) -> tuple[np.ndarray, ...]:
        """First words of the windows of that many words (those of `at` only), and their keys, lane by lane."""
        at = np.arange(len(self.start)) if at is None else at
        at = at[at + length <= len(self.start)]
        at = at[self.text[at] == self.text[at + length - 1]]
        return at, *(doubled(self.lane(k), length, k, salts=self.salts)[at] for k in range(lanes))

    def wholes(self, texts: np.ndarray, lane: int = 0) -> np.ndarray:
        """Keys of all words of each of these (short) texts, by their number of words."""
        first, n = self.first[texts], np.diff(self.first)[texts]
        words = self.lane(lane)
        out = words[first]
        for k in range(1, int(n.max(initial=0))):
            some = np.flatnonzero(n > k)
            out[some] = pair(out[some], words[first[some] + k], lane, self.salts)
        return mix(out ^ mix(n.astype(np.uint64)))


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of n places the windows of one length at `starts` cover."""
    change = np.bincount(starts, minlength=n + 1) - np.bincount(starts + length, minlength=n + 1)
    return np.cumsum(change[:n]) > 0
