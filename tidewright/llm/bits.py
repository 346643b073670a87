"""Compact sorted integers in memory-mapped files, read by vectors of positions.

``EliasFano`` keeps a non-decreasing sequence: low bits packed, high bits as a unary
bit vector with a running count per 64-bit word. ``Packed`` keeps integers of a fixed
number of bits. A file holds named arrays and is mapped, never read whole.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs

U64 = np.uint64
PACK_AT_ONCE = 1 << 16
#: place of the n-th set bit of a byte, at 8 * byte + n
IN_BYTE = np.zeros(256 * 8, np.uint8)
for _byte in range(256):
    _set = [b for b in range(8) if _byte >> b & 1]
    IN_BYTE[8 * _byte : 8 * _byte + len(_set)] = _set


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Words that hold ``width`` bits of each value, one word longer than needed."""
    out = []
    shifts = np.arange(width, dtype=U64)
    for i in range(0, len(values), PACK_AT_ONCE):
        some = values[i : i + PACK_AT_ONCE].astype(U64)
        bits = ((some[:, None] >> shifts) & U64(1)).astype(np.uint8)
        out.append(np.packbits(bits.ravel(), bitorder="little"))
    packed = np.concatenate(out) if out else np.zeros(0, np.uint8)
    words = np.zeros(len(packed) // 8 + 2, U64)
    words.view(np.uint8)[: len(packed)] = packed
    return words


def unpack(words: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.zeros(len(at), U64)
    bit = at.astype(U64) * U64(width)
    word, off = (bit >> U64(6)).astype(np.int64), bit & U64(63)
    # two shifts, as a shift by 64 is not defined
    both = (words[word] >> off) | ((words[word + 1] << U64(1)) << (U64(63) - off))
    return both & U64((1 << width) - 1)


def nth_bit(word: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Place of the n-th set bit of each word."""
    place = np.zeros(len(word), np.int64)
    n = n.astype(np.int64)
    for s in (32, 16, 8):
        below = np.bitwise_count(word & U64((1 << s) - 1)).astype(np.int64)
        up = n >= below
        word = np.where(up, word >> U64(s), word)
        n = np.where(up, n - below, n)
        place += s * up
    return place + IN_BYTE[8 * (word & U64(255)).astype(np.int64) + n]


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        self.high, self.ones, self.low = (arrays[f"{name}.{x}"] for x in ("high", "ones", "low"))
        self.zeros = arrays.get(f"{name}.zeros")
        self.width, self.n = (int(x) for x in arrays[f"{name}.shape"])

    @staticmethod
    def arrays(name: str, values: np.ndarray, universe: int, search: bool = False) -> dict[str, np.ndarray]:
        n = len(values)
        width = max(0, (universe // max(n, 1)).bit_length() - 1)
        values = values.astype(U64)
        high = (values >> U64(width)).astype(np.int64)
        bits = np.zeros(-(-(n + (universe >> width) + 2) // 64) * 64, np.uint8)
        bits[high + np.arange(n)] = 1
        words = np.packbits(bits, bitorder="little").view(U64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])[:-1]
        out = {f"{name}.high": words, f"{name}.ones": ones.astype(np.uint32 if n < 1 << 32 else U64),
               f"{name}.low": pack(values & U64((1 << width) - 1), width), f"{name}.shape": np.array([width, n], np.int64)}
        if search:
            out[f"{name}.zeros"] = (64 * np.arange(len(words)) - ones).astype(np.uint32 if len(bits) < 1 << 32 else U64)
        return out

    def _select(self, i: np.ndarray, counts: np.ndarray, flip: bool) -> np.ndarray:
        word = np.searchsorted(counts, i.astype(counts.dtype), side="right") - 1
        bits = self.high[word]
        return 64 * word + nth_bit(~bits if flip else bits, i - counts[word].astype(np.int64))

    def get(self, i: np.ndarray) -> np.ndarray:
        high = self._select(i, self.ones, False) - i
        return ((high.astype(U64) << U64(self.width)) | unpack(self.low, i, self.width)).astype(np.int64)

    def bounds(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values at places ``i`` and ``i`` + 1; the second bit mostly is in the first one's word."""
        at = self._select(i, self.ones, False)
        rest = (self.high[at >> 6] >> (at & 63).astype(U64)) >> U64(1)
        after = at + 1 + np.bitwise_count((rest & (~rest + U64(1))) - U64(1))
        far = np.flatnonzero(rest == 0)
        after[far] = self._select(i[far] + 1, self.ones, False)
        first, second = (((x - j).astype(U64) << U64(self.width)) | unpack(self.low, j, self.width) for x, j in ((at, i), (after, i + 1)))
        return first.astype(np.int64), second.astype(np.int64)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Position of each value, -1 if it is absent: the values that share its high bits
        lie between two zeros, and their low bits are searched."""
        if not self.n or not len(x):
            return np.full(len(x), -1, np.int64)
        high = (x >> U64(self.width)).astype(np.int64)
        stop = self._select(high, self.zeros, True) - high
        start = np.where(high > 0, self._select(np.maximum(high - 1, 0), self.zeros, True) - high + 1, 0)
        return find_between(self.low, self.width, start, stop, x & U64((1 << self.width) - 1))


def find_between(words: np.ndarray, width: int, start: np.ndarray, stop: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Position of each x among the sorted packed values of [start, stop), else -1."""
    out = np.full(len(x), -1, np.int64)
    at = np.flatnonzero(start < stop)
    low, high, x = start[at], stop[at] - 1, x[at].astype(U64)
    while len(at):
        mid = (low + high) >> 1
        value = unpack(words, mid, width)
        hit = value == x
        out[at[hit]] = mid[hit]
        less = value < x
        low, high = np.where(less, mid + 1, low), np.where(less, high, mid - 1)
        on = np.flatnonzero(~hit & (low <= high))
        at, low, high, x = at[on], low[on], high[on], x[on]
    return out


def store(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """Write the file beside its place, then move it there, so a task run twice does no harm."""
    head = json.dumps([[k, a.dtype.str, len(a)] for k, a in arrays.items()]).encode()
    head += b" " * (-len(head) % 8)
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(np.array([len(head)], U64).tobytes() + head)
        for a in arrays.values():
            raw = np.ascontiguousarray(a).tobytes()
            out.write(raw + b"\0" * (-len(raw) % 8))
    system.move(part, path)


def mapped(uri: str) -> dict[str, np.ndarray]:
    """The file's arrays, mapped. A store that cannot be mapped is copied to the worker's
    disk first, into a file that is gone when the worker ends."""
    system, path = fs.FileSystem.from_uri(uri)
    if isinstance(system, fs.LocalFileSystem):
        raw = np.memmap(path, np.uint8, "r")
    else:
        with tempfile.TemporaryFile() as own, system.open_input_stream(path) as source:
            while block := source.read(1 << 24):
                own.write(block)
            own.flush()
            raw = np.memmap(own, np.uint8, "r")
    raw = raw.view(np.ndarray)  # plain arrays are indexed with less ado
    size = int(raw[:8].view(U64)[0])
    out, at = {}, 8 + size
    for k, dtype, n in json.loads(raw[8:at].tobytes()):
        length = n * np.dtype(dtype).itemsize
        out[k] = raw[at : at + length].view(dtype)
        at += length + -length % 8
    return out
