"""Exact removal of repeated byte strings with a sparse suffix array that is sorted in ranges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, unsigned
from .repeats import (Kind, byte_tokens, compare_across, compare_segments, fetch_segments, find_segments, plan_ranges,
                      removed_lists, sample_splitters, token_runs)
from .shared import materialize, with_keys


def leading_words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place, first byte highest; zeros follow the end."""
    out = np.zeros(len(data) + 8, U)
    out[:len(data)] = data
    for step in (1, 2, 4):
        out[:-step] = (out[:-step] << U(8 * step)) | out[step:]
    return out


def multikey_sort(data: np.ndarray, place: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Whether a string of ``length`` bytes at ``place`` equals one before it in its group.

    Multikey quicksort by words of 8 bytes: within a class of strings equal so far, those whose next word equals the
    pivot's (the first string's) stay together, and only classes with other words are sorted by it. Single strings
    leave. The outer words come first, as strings of a group share their middle. Groups are in ascending order.
    """
    words = leading_words(data)
    at = np.arange(len(place))
    head = group.astype(np.int64)
    tail = length - 8
    for depth in [0, tail, *range(8, tail, 8)]:
        new = np.ones(len(at), bool)
        new[1:] = head[1:] != head[:-1]
        single = new & np.append(new[1:], True)
        if single.any():
            at, head, new = at[~single], head[~single], new[~single]
        if not len(at):
            break
        key = words[place[at] + depth]
        firsts = np.flatnonzero(new)
        sizes = np.diff(np.append(firsts, len(at)))
        other = np.logical_or.reduceat(key != np.repeat(key[firsts], sizes), firsts)
        rows = np.flatnonzero(np.repeat(other, sizes))
        if len(rows):
            by = rows[np.lexsort((key[rows], head[rows]))]
            at[rows], key[rows] = at[by], key[by]
        new[rows[1:]] |= key[rows[1:]] != key[rows[:-1]]
        head = np.cumsum(new)
    out = np.zeros(len(place), bool)
    if len(at):
        out[at[1:][head[1:] == head[:-1]]] = True
    return out


def sort_range(batches: Iterator[pa.RecordBatch], split_grams: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of one range of suffixes: ``key, start, windows, gram, repeat``.

    Sorted by minimizer, content and place. ``repeat`` is true for all but the first of equal contents; firsts are
    returned for comparison if their minimizer has other contents or other ranges hold some of it.
    """
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    gram, content, key, start, count, repeat = (table.column(c).to_numpy() for c in ("gram", "content", "key", "start", "windows", "repeat"))
    del table, held
    done = np.flatnonzero(repeat)
    order = np.argsort(np.where(repeat, 0, unsigned(np.ascontiguousarray(gram))), kind="stable")
    order = order[~repeat[order]]
    ordered = gram[order]
    same = ordered[1:] == ordered[:-1]
    keep = np.concatenate((same, [False])) | np.concatenate(([False], same)) | np.isin(ordered, split_grams)
    order = order[keep]
    order = order[np.lexsort((start[order], key[order], content[order], gram[order]))]
    new_gram = np.ones(len(order), bool)
    new_gram[1:] = gram[order][1:] != gram[order][:-1]
    new_content = new_gram.copy()
    new_content[1:] |= content[order][1:] != content[order][:-1]
    firsts = np.flatnonzero(new_gram)
    contents = np.add.reduceat(new_content, firsts) if len(firsts) else firsts
    several = np.repeat(contents > 1, np.diff(np.append(firsts, len(order)))) | np.isin(gram[order], split_grams)
    again, compare = order[~new_content], order[new_content & several]
    rows = np.concatenate((done, again, compare))
    flag = np.arange(len(rows)) < len(done) + len(again)
    yield pa.RecordBatch.from_arrays([pa.array(key[rows]), pa.array(start[rows]), pa.array(count[rows]), pa.array(gram[rows]), pa.array(flag)],
                                     ["key", "start", "windows", "gram", "repeat"])


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, spans, kept``.

    ``spans`` are the maximal runs of bytes covered by a string of ``length`` bytes that also starts earlier (in a document of
    smaller id, or earlier in the same one); ``kept`` has the other bytes of the UTF-8 text.

    The suffix array is sparse: it has a suffix for each minimizer, about one in 40 bytes, with the windows around it.
    Sampled splitters deal the suffixes by their leading token, the minimizer; a range is sorted in its task. Contents that
    tie on the token are fetched as text and their windows sorted by multikey quicksort; tokens so
    frequent that a splitter cuts them are compared across the boundaries of ranges by a join of window hashes.

    Null and empty texts have 0 bytes. Rows equal in id and text are one place: none of them is the earlier one, and each
    gets the same result. Different texts of one id, and null ids, count in the order of id (null first) and text.
    An empty table gives an empty result.
    """
    kind = Kind(byte_tokens, length, min(24, max(1, length // 2)))
    keyed, restore = with_keys(docs, id_col, text_col)
    ranges, n, size = plan_ranges(keyed)
    splitters = sample_splitters(keyed, kind, ranges, n, size)
    split_grams = splitters.gram.view(np.int64)

    dealt = find_segments(keyed, kind, splitters, ranges).repartitionById(ranges, "bucket")
    schema = "key long, start int, windows int, gram long, repeat boolean"
    sorted_ = materialize(dealt.mapInArrow(lambda batches: sort_range(batches, split_grams), schema), "suffixes")

    def compare(tokens: np.ndarray, place: np.ndarray, group: np.ndarray, data: np.ndarray) -> np.ndarray:
        return multikey_sort(data, place, group, length)

    fetched = fetch_segments(keyed, sorted_.filter("NOT repeat"), kind, splitters, ranges)
    compared = materialize(compare_segments(fetched, kind, compare), "compared")
    across = compare_across(compared.filter("h1 IS NOT NULL"))
    lists = removed_lists([sorted_.filter("repeat"), compared.filter("h1 IS NULL"), across])
    joined = keyed.join(lists.hint("shuffle_hash"), "key", "left").select("key", "text", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            sizes, gone, spans, kept = [], [], [], []
            for text, runs in zip(batch.column(1), batch.column(2)):
                raw = text.as_buffer() if text.is_valid else b""
                data = np.frombuffer(raw, np.uint8)
                low = high = np.zeros(0, np.int64)
                if runs.is_valid:
                    fields = runs.values
                    low, high = token_runs(fields.field(0).to_numpy().astype(np.int64), fields.field(1).to_numpy(), length)
                    edges = np.concatenate(([0], np.stack([low, high], 1).ravel(), [len(data)]))
                    raw = b"".join(data[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2]))
                sizes.append(len(data))
                gone.append(int((high - low).sum()))
                spans.append([{"start": a, "end": b} for a, b in zip(low.tolist(), high.tolist())])
                kept.append(bytes(raw))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(spans, span), pa.array(kept, pa.binary())],
                                             ["key", "n_bytes", "n_removed", "spans", "kept"])

    schema = "key long, n_bytes long, n_removed long, spans array<struct<start: int, end: int>>, kept binary"
    return restore(joined.mapInArrow(cut, schema)).select(F.col(id_col), "n_bytes", "n_removed", "spans", "kept")
