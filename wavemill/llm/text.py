"""Vectorised reading of Arrow text columns as UTF-8 bytes: word bounds and word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; bounds the temporary arrays whatever a text's length.
SEGMENT = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def separators(members: bytes) -> np.ndarray:
    """Table of 256 flags, true for the bytes that separate words."""
    table = np.zeros(256, bool)
    table[np.frombuffer(members, np.uint8)] = True
    return table


#: Space and the controls from tab to carriage return.
WHITE_SPACE = separators(b"\x20\x09\x0a\x0b\x0c\x0d")
#: All ASCII but letters and digits.
NON_LETTERS = separators(bytes(c for c in range(128) if not chr(c).isalnum()))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_groups(offsets: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``size`` bytes, one row at least."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, end
        row = end


def word_bounds(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = WHITE_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data``, which never cross rows, and the offsets of each row's words."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    gap = apart[data]
    before, after = np.empty_like(gap), np.empty_like(gap)
    before[0] = after[-1] = True
    before[1:], after[:-1] = gap[:-1], gap[1:]
    rows = np.flatnonzero(offsets[1:] > offsets[:-1])
    before[offsets[rows]] = True
    after[offsets[rows + 1] - 1] = True
    word = ~gap
    starts, ends = np.flatnonzero(word & before), np.flatnonzero(word & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
#: The same with A-Z counted as a-z.
_FOLDED = _LETTERS.copy()
_FOLDED[65:91] = _LETTERS[97:123]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    size = max(SEGMENT, 1 << (size - 1).bit_length())
    if size not in _powers:
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size, base & _MASK, np.uint64)
            table[0] = 1
            out.append(np.multiply.accumulate(table))
        if size > SEGMENT:
            return out[0], out[1]
        _powers[size] = (out[0], out[1])
    return _powers[size]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit polynomial hash of each word data[start:end]; ``fold`` reads A-Z as a-z. Starts and ends ascend."""
    letters = _FOLDED if fold else _LETTERS
    out, first = np.empty(len(starts), np.uint64), 0
    while first < len(starts):
        low = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, low + SEGMENT, "right")))
        high = int(ends[first:last].max())
        powers, inverse = _power_tables(int(high - low))
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(letters[data[low:high]] * powers[: high - low], out=sums[1:])
        at = starts[first:last] - low
        out[first:last] = (sums[ends[first:last] - low] - sums[at]) * inverse[at]
        first = last
    return mix(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's set of word shingles as sorted distinct hashes, one row after another, and the offsets of the rows.

    A-Z are lower-cased; a row with fewer words than ``words`` has its whole sequence as its one shingle; one without
    words has none.
    """
    starts, ends, at = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)
    factors = mix(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    many = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for k in range(words):
        many += hashes[k : k + len(many)] * factors[k]
    many = mix(many + np.uint64(words))
    sets, sizes = [], np.zeros(len(offsets), np.int64)
    for row in range(len(offsets) - 1):
        low, high = at[row], at[row + 1]
        if high - low >= words:
            own = np.sort(many[low : high - words + 1])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            own = own[keep]
        elif high > low:
            n = int(high - low)
            own = mix(np.array([(hashes[low:high] * factors[:n]).sum(dtype=np.uint64)], np.uint64) + np.uint64(n))
        else:
            continue
        sets.append(own)
        sizes[row + 1] = len(own)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.cumsum(sizes)
