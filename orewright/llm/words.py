"""Hashes of the words and shingles of many texts at once, over the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20  # bytes hashed at once; a longer word makes its segment longer
_P = 0x5851F42D4C957F2D
_P_INVERSE = pow(_P, -1, 1 << 64)

_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32

_powers = np.ones((2, 0), np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if _powers.shape[1] < n:
        size = max(n, SEGMENT)
        made = np.empty((2, size), np.uint64)
        for row, base in ((0, _P), (1, _P_INVERSE)):
            made[row] = base
            made[row, 0] = 1
            np.cumprod(made[row], out=made[row])
        _powers = made
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of a splitmix generator: every bit depends on every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offset of each text; missing texts are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hash, start, end) of the words of all texts, segment by segment; a word never crosses two texts."""
    begin = 0
    while begin < len(data):
        end = min(len(data), begin + SEGMENT)
        while end < len(data):  # cut behind a gap
            gaps = np.flatnonzero(_GAP[data[begin:end]])
            if len(gaps):
                end = begin + int(gaps[-1]) + 1
                break
            end = min(len(data), end + SEGMENT)
        part = data[begin:end]
        n = len(part)
        inside = ~_GAP[part]
        edge = np.zeros(n + 1, bool)
        lo, hi = np.searchsorted(offsets, [begin, end])
        edge[offsets[lo:hi] - begin] = True
        edge[n] = True
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | edge[1:n]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | edge[1:n]
        s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        power = _power_table(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((_FOLD[part].astype(np.uint64) + np.uint64(1)) * power[0, :n], out=sums[1:])
        hashes = mixed((sums[e] - sums[s]) * power[1, s] + (e - s).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        yield hashes, s + begin, e + begin
        begin = end


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z in lower case) in order, and where each text's words begin in them."""
    data, offsets = column_bytes(column)
    parts = list(word_spans(data, offsets))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    hashes = np.concatenate([p[0] for p in parts])
    starts = np.concatenate([p[1] for p in parts])
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than a shingle has make one shingle."""
    hashes, first = words_of(column)
    weights = np.random.default_rng(20).integers(1 << 62, 1 << 63, size, np.uint64) | np.uint64(1)
    n = len(hashes) - size + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for j in range(size):
        if n > 0:
            rolled += hashes[j : j + n] * weights[j]
    rolled = mixed(rolled)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= size:
            yield np.unique(rolled[a : b - size + 1])
        elif b > a:
            whole = (hashes[a:b] * weights[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            yield mixed(np.array([whole], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about so many bytes of text, one row at least."""
    at = batch.schema.get_field_index(column)
    lengths = np.frombuffer(batch.column(at).cast(pa.large_string()).fill_null("").buffers()[1], np.int64)
    lengths = lengths[-(batch.num_rows + 1) :] if batch.num_rows else lengths[:1]
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(lengths, lengths[begin] + most, "right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end
