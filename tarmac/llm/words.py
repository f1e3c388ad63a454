"""Vectorised words and word shingles of whole texts, shared by the text operators.

Words are runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z. A word is represented by a
64-bit hash that is the same on every worker and in every run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SEGMENT_BYTES = 1 << 19
SHINGLE = 5

_U = np.uint64
_ROOT = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _tables() -> tuple[np.ndarray, np.ndarray]:
    codes = np.arange(256)
    apart = (codes == 32) | ((codes >= 9) & (codes <= 13))
    lower = np.where((codes >= 65) & (codes <= 90), codes + 32, codes).astype(_U)
    value = mix(lower * _U(_ROOT) + _U(1))
    value[apart] = 0
    return apart, value


APART, VALUE = _tables()
_powers: dict[str, np.ndarray] = {}


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and their inverses modulo 2**64."""
    if "up" not in _powers or len(_powers["up"]) < size:
        n = max(size, SEGMENT_BYTES + 1)
        base = _ROOT | 1
        inverse = pow(base, -1, 1 << 64)
        for name, factor in (("up", base), ("down", inverse)):
            steps = np.full(n, factor, _U)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:size], _powers["down"][:size]


@dataclass
class Words:
    """Words of a batch of texts: those of text i are ``ptr[i]:ptr[i + 1]``."""

    hashes: np.ndarray
    ptr: np.ndarray
    starts: np.ndarray  # byte offsets within the text
    ends: np.ndarray

    def of(self, i: int) -> slice:
        return slice(self.ptr[i], self.ptr[i + 1])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after the other, and the offsets; null counts as empty."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of bounded size that end between words."""
    begin, total = 0, int(offsets[-1])
    while begin < total:
        end = min(total, begin + SEGMENT_BYTES)
        while end < total:
            cut = np.flatnonzero(APART[data[begin:end]])
            edge = offsets[np.searchsorted(offsets, end, side="right") - 1]
            last = max(int(cut[-1]) + begin + 1 if len(cut) else begin, int(edge))
            if last > begin:
                end = last
                break
            end = min(total, end + SEGMENT_BYTES)  # one very long word
        yield begin, end
        begin = end


def words_of(texts: pa.Array) -> Words:
    data, offsets = text_bytes(texts)
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    hashes, starts, ends = [], [], []
    for a, b in _segments(data, offsets):
        part = data[a:b]
        apart = APART[part]
        inside = ~apart
        first = inside.copy()
        first[1:] &= apart[:-1] | begins[a + 1 : b]
        last = inside.copy()
        last[:-1] &= apart[1:] | begins[a + 1 : b]
        at = np.flatnonzero(first)
        if not len(at):
            continue
        up, down = _power_tables(b - a)
        hashes.append(mix(np.add.reduceat(VALUE[part] * up, at) * down[at]))
        starts.append(at + a)
        ends.append(np.flatnonzero(last) + a + 1)
    if not hashes:
        return Words(np.zeros(0, _U), np.zeros(len(offsets), np.int64), *[np.zeros(0, np.int64)] * 2)
    start, end = np.concatenate(starts), np.concatenate(ends)
    ptr = np.searchsorted(start, offsets)
    shift = np.repeat(offsets[:-1], np.diff(ptr))
    return Words(np.concatenate(hashes), ptr, start - shift, end - shift)


_FACTORS = [_U((_ROOT * (2 * k + 3)) % (1 << 64) | 1) for k in range(64)]


def windows(hashes: np.ndarray, offsets: list[int]) -> np.ndarray:
    """Hash of the words at the given offsets from each position, where all of them exist."""
    n = len(hashes) - offsets[-1]
    if n <= 0:
        return np.zeros(0, _U)
    total = np.zeros(n, _U)
    for k, offset in enumerate(offsets):
        total += hashes[offset : offset + n] * _FACTORS[k]
    return mix(total)


def shingle_set(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingles of one text; fewer words than ``size`` give the whole sequence as one."""
    if len(hashes) == 0:
        return np.zeros(0, _U)
    if len(hashes) < size:
        return windows(hashes, list(range(len(hashes)))) ^ _U(len(hashes))
    return np.unique(windows(hashes, list(range(size))))
