"""Sets of word shingles as sorted 64-bit hashes, computed from whole texts with numpy."""

from __future__ import annotations

import hashlib

import numpy as np

#: The words of the contract, lower-cased in A-Z only.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WIDTH = 5

_BASE = 0x9E3779B97F4A7C15
_MASK = 2**64 - 1
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True


def _byte_values() -> np.ndarray:
    values = [int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "little") for b in range(256)]
    for b in range(ord("A"), ord("Z") + 1):
        values[b] = values[b + 32]
    return np.array(values, dtype=np.uint64)


_VALUE = _byte_values()


def _powers(base: int, n: int) -> np.ndarray:
    out, m = np.ones(n, dtype=np.uint64), 1
    while m < n:
        more = min(m, n - m)
        out[m : m + more] = out[:more] * np.uint64(int(out[m - 1]) * base & _MASK)
        m += more
    return out


_TABLES = [_powers(_BASE, 1 << 16), _powers(pow(_BASE, -1, 2**64), 1 << 16)]


def _tables(n: int) -> list[np.ndarray]:
    if n > len(_TABLES[0]):
        size = 1 << n.bit_length()
        _TABLES[:] = [_powers(_BASE, size), _powers(pow(_BASE, -1, 2**64), size)]
    return _TABLES


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def word_hashes(text: str) -> np.ndarray:
    """One hash per word: a polynomial over the word's bytes, from differences of one running sum."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    if not len(data):
        return np.empty(0, dtype=np.uint64)
    up, down = _tables(len(data))
    edges = np.flatnonzero(np.diff(np.concatenate(([True], _IS_SPACE[data], [True])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    running = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUE[data] * up[: len(data)], dtype=np.uint64, out=running[1:])
    return mixed((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; with fewer words, of the whole run."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    width = min(width, len(words))
    h = np.full(len(words) - width + 1, np.uint64(width))
    for k in range(width):
        h = mixed(h * np.uint64(_BASE) + words[k : k + len(h)])
    return np.unique(h)


def set_id(shingles: np.ndarray) -> int | None:
    """A digest of the set as a signed 64-bit number; equal sets have equal ids. None if empty."""
    if not len(shingles):
        return None
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def planes(values: np.ndarray) -> bytes:
    """Little-endian bytes by significance, so that small numbers leave long runs of zeros to compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def sorted_planes(values: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit values, as differences."""
    return planes(np.diff(values, prepend=np.uint64(0)))


def from_sorted_planes(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, np.uint64), dtype=np.uint64)
