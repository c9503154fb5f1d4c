"""Texts of Arrow batches as numpy arrays: bytes, words and their hashes, windows cut at minimizers."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text is a chunk of its own.
CHUNK = 1 << 20
U = np.uint64
_ODD = U(0xD6E8FEB86659FD93)
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``h``."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


class Kept(dict):
    """Values that a process makes once; it travels empty, and by value like the functions that use it."""

    def __reduce__(self) -> tuple:
        return Kept, ()


_POWERS = Kept()
#: A hash of each byte, and True for the bytes 20 and 09-0D (hexadecimal) that separate words.
_BYTES = mix(np.arange(1, 257, dtype=U) * U(_BASE))
_SEPARATORS = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^i and B^-i modulo 2^64 for i < n."""
    size = 1 << max(12, int(n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        up = np.full(size, _BASE, U)
        down = np.full(size, pow(_BASE, -1, 1 << 64), U)
        up[0] = down[0] = 1
        _POWERS[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    up, down = _POWERS[size]
    return up[:n], down[:n]


def byte_table() -> np.ndarray:
    return _BYTES


def separators() -> np.ndarray:
    return _SEPARATORS


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None and column.buffers()[2].size else np.zeros(0, np.uint8)
    if column.null_count:
        column = column.fill_null("")
        return text_buffers(column)
    return data, offsets


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, past the last row, bytes, lengths)`` for runs of rows of about ``limit`` bytes."""
    data, offsets = text_buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end, data[offsets[row]:offsets[end]], np.diff(offsets[row:end + 1])
        row = end


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray

    def per_doc(self, docs: int) -> np.ndarray:
        return np.bincount(self.doc, minlength=docs)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span: the sum of its mixed 8-byte pieces, each keyed by its place.

    It is no polynomial, which would give equal values to certain different spans whatever its base is.
    """
    if not len(start):
        return np.zeros(0, U)
    size = end - start
    lanes = np.maximum((size + 7) >> 3, 1)
    first = np.cumsum(lanes) - lanes
    place = np.arange(first[-1] + lanes[-1]) - np.repeat(first, lanes)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    value = np.ndarray(len(data) + 1, "<u8", padded, 0, (1,))[np.repeat(start, lanes) + 8 * place].astype(U)
    tail = (size - 8 * (lanes - 1)).astype(U)
    value[first + lanes - 1] &= np.where(tail == U(8), ~U(0), (U(1) << (U(8) * (tail & U(7)))) - U(1))
    keys = mix(np.arange(1, lanes.max() + 1, dtype=U) * _ODD)
    return mix(np.add.reduceat(mix(value ^ keys[place]), first) + size.astype(U))


def word_bounds(inside: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each run of ``inside``; the texts lie one behind the other, and no run crosses two."""
    begins = np.concatenate(([0], np.cumsum(lengths)))
    first = np.zeros(len(inside) + 1, bool)
    first[begins] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:-1]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return start, end, np.searchsorted(begins, start, "right") - 1


def words(data: np.ndarray, lengths: np.ndarray) -> Words:
    """The words of texts that lie one behind the other in ``data``."""
    start, end, doc = word_bounds(~separators()[data], lengths)
    return Words(start, end, doc, hash_spans(data, start, end))


#: A-Z as a-z, and the bytes of letters and digits: 0-9, a-z and all above 7F (hexadecimal).
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ALNUM = np.isin(np.arange(256), [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])


def grams(tokens: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` tokens, from runs of doubled length."""
    out, size, now, step = None, 0, mix(tokens), 1
    while True:
        if k & 1:
            if out is None:
                out = now
            else:
                n = len(now) - size
                out = mix(out[:max(n, 0)] * _ODD + now[size:])
            size += step
        k >>= 1
        if not k:
            return out
        now = now[:-step] * _ODD + now[step:]
        now ^= now >> U(29)
        step *= 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    step, now = 1, values
    while step * 2 <= width:
        now = np.minimum(now[:-step], now[step:])
        step *= 2
    n = len(values) - width + 1
    return np.minimum(now[:n], now[width - step:width - step + n])


class Segments(NamedTuple):
    """Maximal runs of windows of one text with the same minimizer at the same place."""

    doc: np.ndarray
    start: np.ndarray  # first window, counted in the text
    windows: np.ndarray
    gram: np.ndarray  # the minimizer's hash
    content: np.ndarray  # of all tokens of the segment


def segments(tokens: np.ndarray, lengths: np.ndarray, window: int, k: int) -> Segments:
    """Cut the windows of each text (``lengths`` tokens each) into segments.

    The minimizer of a window, the least hash of the ``k``-token runs in it, depends on the window's tokens alone.
    So equal windows lie in segments of the same ``gram``, and segments of equal ``gram`` and ``content``
    hold the same windows.
    """
    none = np.zeros(0, np.int64)
    if len(tokens) < window:
        return Segments(none, none, none, none.astype(U), none.astype(U))
    gram = grams(tokens, k)
    least = sliding_min(gram, window - k + 1)
    begins = np.concatenate(([0], np.cumsum(lengths)))
    valid = np.zeros(len(tokens) + 1, np.int8)
    full = lengths >= window
    np.add.at(valid, begins[:-1][full], 1)
    np.add.at(valid, begins[1:][full] - window + 1, -1)
    valid = np.cumsum(valid[:len(least)], dtype=np.int8) > 0
    cut = valid.copy()
    # Another value, or the same one at a later place.
    cut[1:] &= ~valid[:-1] | (least[1:] != least[:-1]) | (gram[:len(least) - 1] == least[:-1])
    start = np.flatnonzero(cut)
    doc = np.searchsorted(begins, start, "right") - 1
    last = np.minimum(np.append(start[1:], len(least)), begins[doc + 1] - window + 1)
    up, down = powers(len(gram) + 1)
    sums = np.zeros(len(gram) + 1, U)
    np.cumsum(gram * up[:-1], out=sums[1:])
    content = mix((sums[last + window - k] - sums[start]) * down[start] + (last - start).astype(U))
    return Segments(doc, start - begins[doc], last - start, least[start], content)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def unsigned(h: np.ndarray) -> np.ndarray:
    return h.view(U)


def merge_runs(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of half-open ranges as maximal runs."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], start[1:] > end[:-1]))
    firsts = np.flatnonzero(new)
    return start[firsts], end[np.append(firsts[1:], len(start)) - 1]
