"""Words of many texts at once: boundaries and 64-bit hashes from byte arrays, without a loop over words.

A batch of texts is one byte array and an array of offsets, as Arrow holds it. A word's hash is a
polynomial over its bytes (a Rabin-Karp hash, from one running sum over the array), followed by a
mixing step, so it depends on nothing but the word's bytes. The same running sum over word hashes gives
the hash of every window of words. All arithmetic is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

WHITE_SPACE = bytes([0x20, *range(0x09, 0x0E)])
#: Bytes that part words of ASCII letters, digits and all characters beyond ASCII.
NOT_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: A piece of a batch holds so many bytes, or one longer text.
PIECE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the odd base and of its inverse."""
    found = _powers.get(base)
    if found is None or len(found[0]) < n:
        size = max(n, 1 << 16)
        found = tuple(
            np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size - 1, b, np.uint64))]).astype(np.uint64)
            for b in (base, pow(base, -1, 1 << 64))
        )
        if size <= 4 * PIECE_BYTES:  # those of one very long text are not kept
            _powers[base] = found
    return found[0][:n], found[1][:n]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; no other byte changes, so UTF-8 stays UTF-8."""
    return np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)


@dataclass
class Words:
    """Words of a piece: byte ranges into ``data``, hashes, and where each text's words begin."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray  # of length texts + 1; the words of text i are bounds[i]:bounds[i + 1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges of ``data``."""
    n = len(data)
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def range_places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of the ranges, one range after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def distinct_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One range of each content, and for every range the number of its content among these.

    Contents are found by hash and compared byte by byte, so the result is exact.
    """
    _, first, number = np.unique(range_hashes(data, starts, ends), return_index=True, return_inverse=True)
    lengths, like = ends - starts, first[number]
    at = range_places(starts, lengths)
    if (lengths == lengths[like]).all() and (data[at] == data[at + np.repeat(starts[like] - starts, lengths)]).all():
        return first, number
    whole, seen = data.tobytes(), {}  # two contents of one hash
    number = np.array([seen.setdefault(whole[a:b], len(seen)) for a, b in zip(starts.tolist(), ends.tolist())])
    return np.unique(number, return_index=True)[1], number


def split_words(data: np.ndarray, offsets: np.ndarray, separators: bytes = WHITE_SPACE, lower: bool = False) -> Words:
    """Maximal runs of bytes that are no separators, within each text."""
    if lower:
        data = lower_ascii(data)
    n = len(data)
    is_word = np.ones(256, bool)
    is_word[list(separators)] = False
    flag = is_word[data]
    begin, end = flag.copy(), flag.copy()
    begin[1:] &= ~flag[:-1]
    end[:-1] &= ~flag[1:]
    first, last = offsets[:-1][np.diff(offsets) > 0], offsets[1:][np.diff(offsets) > 0] - 1
    begin[first] = flag[first]
    end[last] = flag[last]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return Words(data, starts, ends, range_hashes(data, starts, ends), np.searchsorted(starts, offsets))


def window_hashes(hashes: np.ndarray, bounds: np.ndarray, width: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every window of ``width`` consecutive words of one text."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = powers(n + 1, base)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=total[1:])
    inside = np.zeros(n + 1, np.int64)  # +1 where a text's window starts begin, -1 where they end
    counts = np.diff(bounds)
    whole = counts >= width
    np.add.at(inside, bounds[:-1][whole], 1)
    np.add.at(inside, bounds[1:][whole] - width + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside)[:n])
    return starts, mix((total[starts + width] - total[starts]) * down[starts])


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def pieces(batch: pa.RecordBatch, text: str = "text", size: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with about ``size`` bytes of text, each with its bytes and offsets; none is empty."""
    data, offsets = text_buffers(batch.column(text))
    row, rows = 0, batch.num_rows
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        stop = min(stop, rows)
        yield batch.slice(row, stop - row), data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def signed(x: np.ndarray) -> np.ndarray:
    """The 64 bits as a Spark long."""
    return np.ascontiguousarray(x).view(np.int64)
