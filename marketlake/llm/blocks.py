"""Texts of an Arrow batch as flat numpy arrays, in blocks of bounded size.

Every operator that reads words or characters does it here, without a Python step per word: the UTF-8 bytes of
some hundred texts lie in one array, and words, lines, shingles and their hashes are index arrays into it.
Words are maximal runs of bytes other than space, tab, LF, VT, FF and CR; A-Z count as a-z.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 17  # a block is one text, or several of about this many bytes together: its arrays stay in the cache
MULTIPLIER = 0x9E3779B97F4A7C15 // 8 * 8 + 5  # odd, and 5 modulo 8: its powers are spread
SEED = 20240229

_U = np.uint64
_mixers = np.random.default_rng(SEED + 1).integers(0, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)
_powers = {}


def powers(n: int, base: int = MULTIPLIER) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n at least."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, BLOCK_BYTES + 1)
        out = []
        for x in (base, pow(base, -1, 2**64)):
            steps = np.full(size, x, dtype=np.uint64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        have = tuple(out)
        if size <= 4 * BLOCK_BYTES:  # a huge text's powers aren't kept
            _powers[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values whose output bits all depend on all input bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def mix32(x: np.ndarray) -> np.ndarray:
    """The same for 32-bit values."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = MULTIPLIER) -> np.ndarray:
    """A hash of each values[start:end] (uint64): the same for the same run of values, wherever it lies."""
    up, down = powers(len(values), base)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _mixers[0])


def byte_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each data[start:end], eight bytes at a time."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    eights = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    length = ends - starts
    out = mix(length.astype(np.uint64) * _mixers[0])
    rows, at = np.arange(len(starts)), starts
    while len(rows):
        left = ends[rows] - at
        value = eights[at] & (_U(2**64 - 1) >> (_U(64) - _U(8) * np.minimum(left, 8).astype(np.uint64)))
        out[rows] = mix((out[rows] ^ value) * _mixers[1])
        more = left > 8
        rows, at = rows[more], at[more] + 8
    return out


@dataclass
class Block:
    """``texts``: the rows; ``data``: their UTF-8 bytes; ``at``: where each text begins, and the end."""

    rows: pa.RecordBatch
    data: np.ndarray
    at: np.ndarray

    def __len__(self) -> int:
        return len(self.at) - 1

    def column(self, name: str) -> pa.Array:
        return self.rows.column(self.rows.schema.get_field_index(name))

    @cached_property
    def lower(self) -> np.ndarray:
        return self.data | (((self.data - np.uint8(65)) < 26).view(np.uint8) << 5)

    def words(self) -> Words:
        solid = (self.data != 32) & ((self.data - np.uint8(9)) > 4)
        begins, ends = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1]
        ends[:-1] &= ~solid[1:]
        inner = self.at[(self.at > 0) & (self.at < len(solid))]
        begins[inner] = solid[inner]
        ends[inner - 1] = solid[inner - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        return Words(start, end, byte_hash(self.lower, start, end), np.searchsorted(start, self.at))

    @cached_property
    def _continued(self) -> np.ndarray:
        return np.flatnonzero(self.data.view(np.int8) < -64)  # bytes that don't begin a code point

    def chars_before(self, byte: np.ndarray) -> np.ndarray:
        """How many code points begin before each place."""
        return byte - np.searchsorted(self._continued, byte)


@dataclass
class Words:
    """Words of a block: byte ranges, hashes of their lower-cased bytes, and each text's first word (and the end)."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    at: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))


def blocks(batches: Iterable[pa.RecordBatch], text: str = "text", size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut Arrow batches into blocks; a null text counts as an empty one."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        if column.null_count:
            column = pc.fill_null(column, "")
        width = np.int64 if pa.types.is_large_string(column.type) else np.int32
        offsets = np.frombuffer(column.buffers()[1], dtype=width)[column.offset : column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        row = 0
        while row < len(column):
            stop = max(row + 1, int(np.searchsorted(offsets, int(offsets[row]) + size, side="right")) - 1)
            yield Block(batch.slice(row, stop - row), data[offsets[row] : offsets[stop]],
                        (offsets[row : stop + 1] - offsets[row]).astype(np.int64))
            row = stop


def shingles(words: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every n words in a row, and where each text's begin (and the end). A text of fewer than n words has
    its whole sequence as one shingle; a text without words has none."""
    count = np.diff(words.at)
    made = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    at = np.zeros(len(count) + 1, dtype=np.int64)
    np.cumsum(made, out=at[1:])
    first = np.arange(at[-1]) - np.repeat(at[:-1] - words.at[:-1], made)
    width = np.repeat(np.minimum(count, n), made)
    out = width.astype(np.uint64) * _mixers[1]
    for k in range(n):
        inside = k < width
        out += np.where(inside, words.hash[np.minimum(first + k, len(words.hash) - 1)], _U(0)) * _mixers[2 + k]
    return mix(out), at


def minhash(values: np.ndarray, starts: np.ndarray, functions: int, seed: int = SEED) -> np.ndarray:
    """For every run of values that begins at ``starts`` (none of them empty): the least value under each hash
    function, (runs, functions) uint32."""
    rng = np.random.default_rng(seed)
    masks = rng.integers(0, 2**32, functions, dtype=np.uint32)
    factors = rng.integers(0, 2**31, functions, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    low = values if values.dtype == np.uint32 else (values >> _U(32)).astype(np.uint32)
    turned = np.empty_like(low)
    out = np.empty((functions, len(starts)), dtype=np.uint32)
    for j in range(functions if len(starts) else 0):
        np.bitwise_xor(low, masks[j], out=turned)
        np.multiply(turned, factors[j], out=turned)
        np.minimum.reduceat(turned, starts, out=out[j])
    return np.ascontiguousarray(out.T)


def binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes as one Arrow binary value (the array must be C-contiguous, 2-d)."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def unpacked(column: pa.Array, dtype) -> np.ndarray:
    """The reverse of :func:`binary`: rows of equal width as a 2-d array."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros((0, 0), dtype=dtype)
    raw = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return raw.view(dtype).reshape(len(column), -1)
