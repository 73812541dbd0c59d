"""Texts of an Arrow batch as byte arrays: words, hashes of spans, packed sorted keys.

Everything here runs inside Spark tasks on one slab of whole texts at a time, so memory is
bounded by the slab (or by the largest single text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

SLAB_BYTES = 1 << 20

# Multipliers of the 64-bit hashes; any odd numbers with well mixed bits do.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_LENGTH = np.uint64(0xD6E8FEB86659FD93)
_STEP = np.uint64(0xA0761D6478BD642F)

_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _byte_values(fold: bool) -> np.ndarray:
    values = np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64)
    if fold:
        values[65:91] = values[97:123]
    return values


_VALUES = {fold: _byte_values(fold) for fold in (False, True)}

# Word bytes. Bytes above 127 belong to code points above 127, which both kinds of word hold.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
LETTER_OR_DIGIT = np.zeros(256, dtype=bool)
LETTER_OR_DIGIT[48:58] = LETTER_OR_DIGIT[65:91] = LETTER_OR_DIGIT[97:123] = True
LETTER_OR_DIGIT[128:] = True


def _grow(length: int) -> None:
    global _powers, _inverses
    if len(_powers) < length:
        size = max(length, SLAB_BYTES + 1)
        _powers = np.full(size, _BASE, dtype=np.uint64)
        _inverses = np.full(size, _INVERSE, dtype=np.uint64)
        _powers[0] = _inverses[0] = 1
        np.cumprod(_powers, out=_powers)
        np.cumprod(_inverses, out=_inverses)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that any of their bits can be used."""
    values = values ^ (values >> np.uint64(30))
    values *= _MIX_1
    values ^= values >> np.uint64(27)
    values *= _MIX_2
    values ^= values >> np.uint64(31)
    return values


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mix(left * _STEP + right)


class Slab:
    """Some whole texts: their bytes, their bounds and, on demand, prefix hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data
        self.offsets = offsets
        self._sums: dict[bool, np.ndarray] = {}

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def span_hashes(self, start: np.ndarray, end: np.ndarray, fold: bool = False) -> np.ndarray:
        """64-bit hashes of byte spans; with ``fold`` A-Z count as a-z."""
        if fold not in self._sums:
            size = len(self.data)
            _grow(size + 1)
            sums = np.zeros(size + 1, dtype=np.uint64)
            np.cumsum(_VALUES[fold][self.data] * _powers[:size], out=sums[1:])
            self._sums[fold] = sums
        sums = self._sums[fold]
        raw = (sums[end] - sums[start]) * _inverses[start]
        return mix(raw + (end - start).astype(np.uint64) * _LENGTH)

    def runs(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the maximal runs of bytes of a kind, cut at text bounds."""
        inside = member[self.data]
        size = len(inside)
        if not size:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        before = np.zeros(size, dtype=bool)
        before[1:] = inside[:-1]
        cuts = self.offsets[:-1]
        before[cuts[cuts < size]] = False
        after = np.zeros(size, dtype=bool)
        after[:-1] = inside[1:]
        ends = self.offsets[1:]
        after[ends[ends > 0] - 1] = False
        return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1

    def words(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of words, and for each text the index of its first word (and one end)."""
        start, end = self.runs(member)
        return start, end, np.searchsorted(start, self.offsets)


def slabs(texts: pa.Array, limit: int = SLAB_BYTES) -> Iterator[tuple[int, int, Slab]]:
    """Cut a string column into slabs of whole texts; null counts as empty.

    Yields the first row, the row after the last, and the slab.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    count = len(texts)
    if not count:
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, bounds, data = texts.buffers()
    offsets = np.frombuffer(bounds, dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + count + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(count, max(last, first + 1))
        part = whole[offsets[first] : offsets[last]]
        yield first, last, Slab(part, offsets[first : last + 1] - offsets[first])
        first = last


def repeated(values: np.ndarray) -> np.ndarray:
    """True where a value occurs more than once."""
    if len(values) < 2:
        return np.zeros(len(values), dtype=bool)
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    same = ordered[1:] == ordered[:-1]
    flags = np.zeros(len(values), dtype=bool)
    flags[order[1:][same]] = True
    flags[order[:-1][same]] = True
    return flags


def pack(values: np.ndarray) -> bytes:
    """Compress an integer array by byte planes."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return zstandard.compress(planes.tobytes(), 1)


def unpack(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    raw = np.frombuffer(zstandard.decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Compress an ascending array of unsigned 64-bit numbers."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)
