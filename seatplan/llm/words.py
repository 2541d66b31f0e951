"""Words of whole Arrow batches in numpy: bounds and 64-bit hashes, without a Python object per word.

A text is its UTF-8 bytes with A-Z lower-cased where asked; words are runs of bytes outside a separator set.
Hashes are polynomials modulo 2**64 over random byte values, then mixed. Two different words of a corpus with
a billion distinct words share a hash with a chance of a few per cent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

#: Bytes worked on at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _table(separators: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(separators)] = True
    return out


#: Space and \x09-\x0D.
WHITE = _table(b"\x20\x09\x0a\x0b\x0c\x0d")
#: The same and ASCII punctuation.
WHITE_OR_MARK = _table(b"\x20\x09\x0a\x0b\x0c\x0d" + bytes(c for c in range(33, 127) if not chr(c).isalnum()))


@dataclass
class Block:
    """Some rows' bytes and offsets, and the place of these rows in their batch."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The column cut between rows into blocks of about ``limit`` bytes; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield Block(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], at)
        at = to


@dataclass
class Words:
    starts: np.ndarray
    ends: np.ndarray
    #: Words of each row, and where they begin among all words.
    counts: np.ndarray
    first: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def words(block: Block, separators: np.ndarray = WHITE) -> Words:
    inside = ~separators[block.data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = block.offsets[:-1][np.diff(block.offsets) > 0]
    begins[edges] = inside[edges]
    stops[edges[1:] - 1] = inside[edges[1:] - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    first = np.searchsorted(starts, block.offsets)
    return Words(starts, ends, np.diff(first), first[:-1])


_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(33))) * U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U(29))) * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(32))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end]."""
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of the distinct keys (hashes) is met, and the index among these of every key; nothing is sorted."""
    every = np.arange(len(keys), dtype=np.int32)
    lead, left, salt = every.copy(), every, int(_BASE)
    shift = U(63 - max(8, len(keys).bit_length()))
    table = np.empty(1 << (64 - int(shift)), dtype=np.int32)
    while len(left):
        mine = keys[left]
        slot = ((mine * U(salt)) >> shift).astype(np.int64)
        table[slot] = left
        met = table[slot]
        same = keys[met] == mine
        lead[left[same]] = met[same]
        left, salt = left[~same], salt * int(_BASE) % (1 << 64)
    leads = lead == every
    return np.flatnonzero(leads), (np.cumsum(leads) - 1)[lead]


def tallied(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and how often each is there; ``keys`` are sorted in place, so large ones are not copied."""
    keys.sort()
    new = np.ones(len(keys), dtype=bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    first = np.flatnonzero(new)
    return keys[first], np.diff(first, append=len(keys))


def packed(values: np.ndarray) -> bytes:
    """Numbers with equal bytes side by side, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def windows(h: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within a row, in order, and their number in each row."""
    n = np.maximum(counts - size + 1, 0)
    if not n.sum():
        return np.zeros(0, dtype=np.uint64), n
    first = np.cumsum(counts) - counts
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    out = np.zeros(len(at), dtype=np.uint64)
    for j in range(size):
        out = out * _BASE + h[at + j]
    return mix(out + U(size)), n


def cut(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The flat values as one list for each row."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


class Lookup:
    """Places of keys in a sorted array of hashed keys. A slot table answers most; what shares a slot is searched for."""

    def __init__(self, keys: np.ndarray, heat: np.ndarray | None = None, bits: int | None = None):
        self.keys = keys.astype(np.uint64)
        bits = bits or min(22, max(8, int(len(keys)).bit_length() + 2))
        self.shift = U(64 - bits)
        self.slots = np.full(1 << bits, -1, dtype=np.int32)
        order = np.arange(len(keys)) if heat is None else np.argsort(heat, kind="stable")
        self.slots[((self.keys[order] * _BASE) >> self.shift).astype(np.int64)] = order

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        """Index of each wanted key, or -1."""
        wanted = wanted.astype(np.uint64, copy=False)
        if not len(self.keys):
            return np.full(len(wanted), -1, dtype=np.int64)
        at = self.slots[((wanted * _BASE) >> self.shift).astype(np.int64)].astype(np.int64)
        wrong = np.flatnonzero((at >= 0) & (self.keys[at] != wanted))
        if len(wrong):
            found = np.minimum(np.searchsorted(self.keys, wanted[wrong]), len(self.keys) - 1)
            at[wrong] = np.where(self.keys[found] == wanted[wrong], found, -1)
        return at
