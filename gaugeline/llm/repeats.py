"""What both exact deduplications share: windows that occur more than once, found through their minimizers.

Windows of W tokens are cut into segments by minimizer (``arrays.segments``). Equal windows lie in segments with the same
minimizer, so only segments of a repeated minimizer are looked at; of those with the same content all but the first are
repeats as a whole, and the rest, one for each content, is compared window by window on the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, byte_table, chunks, grams, merge_runs, mix, segments, signed, unsigned, words

#: Segments of one task that are combined before they are sent; bounds a worker's memory.
FLUSH = 400_000
#: Windows that are compared at once, unless one minimizer has more.
COMPARED = 400_000
#: Documents and segments that the splitters are sampled from, and bytes of text in a segment, roughly.
SAMPLE_DOCS, SAMPLE, TEXT_PER_SEGMENT = 2_000, 20_000, 40
#: Bytes of text for each range of the partitioning, at most.
RANGE_BYTES = 64 << 20

#: Tokens of texts one behind the other: ``(tokens, tokens of each text, first byte, past the last byte)``.
Tokenise = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def byte_tokens(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    at = np.arange(len(data) + 1)
    return byte_table()[data], lengths, at[:-1], at[1:]


def word_tokens(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    found = words(data, lengths)
    return found.hash, found.per_doc(len(lengths)), found.start, found.end


class Kind(NamedTuple):
    tokenise: Tokenise
    window: int
    k: int


class Splitters(NamedTuple):
    """Lower bounds of the ranges 1, 2, ... as pairs of minimizer and content."""

    gram: np.ndarray
    content: np.ndarray

    def bucket(self, gram: np.ndarray, content: np.ndarray) -> np.ndarray:
        low = np.searchsorted(self.gram, gram, "left")
        high = np.searchsorted(self.gram, gram, "right")
        for value in np.unique(gram[high > low]):
            rows = gram == value
            first, last = np.searchsorted(self.gram, value, "left"), np.searchsorted(self.gram, value, "right")
            low[rows] = first + np.searchsorted(self.content[first:last], content[rows], "right")
        return low.astype(np.int32)

    def is_split(self, gram: np.ndarray) -> np.ndarray:
        """Whether a minimizer's segments can lie in several ranges."""
        return np.isin(gram, self.gram)


def _segments_of(batches: Iterator[pa.RecordBatch], kind: Kind) -> Iterator[tuple[np.ndarray, ...]]:
    """``(key, start, windows, gram, content)`` of the segments, FLUSH or somewhat more at a time."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        for row, end, data, lengths in chunks(batch.column(1)):
            tokens, counts, _, _ = kind.tokenise(data, lengths)
            found = segments(tokens, counts, kind.window, kind.k)
            held.append((keys[row:end][found.doc], found.start, found.windows, found.gram, found.content))
            size += len(found.doc)
            if size >= FLUSH:
                yield tuple(np.concatenate(c) for c in zip(*held))
                held, size = [], 0
    if size:
        yield tuple(np.concatenate(c) for c in zip(*held))


def sample_splitters(keyed: DataFrame, kind: Kind, ranges: int, docs: int, size: int) -> Splitters:
    """Splitters from about SAMPLE segments, thinned by hash, of about SAMPLE_DOCS whole documents chosen by hash."""
    expected = min(docs, SAMPLE_DOCS) * size / max(docs, 1) / TEXT_PER_SEGMENT
    thin = U(max(1, round(expected / SAMPLE)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, gram, content in _segments_of(batches, kind):
            some = content % thin == 0
            yield pa.RecordBatch.from_arrays([pa.array(signed(gram[some])), pa.array(signed(content[some]))], ["gram", "content"])

    some = keyed
    if docs > SAMPLE_DOCS:
        some = keyed.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int((1 << 30) * SAMPLE_DOCS / docs))
    rows = some.mapInArrow(run, "gram long, content long").collect()
    pairs = sorted({(r.gram % (1 << 64), r.content % (1 << 64)) for r in rows})  # a task sends a content once
    cuts = sorted({pairs[i * len(pairs) // ranges] for i in range(1, ranges)}) if pairs else []
    return Splitters(np.array([c[0] for c in cuts], U), np.array([c[1] for c in cuts], U))


def _repeats_inside(key: np.ndarray, start: np.ndarray, content: np.ndarray) -> np.ndarray:
    """True for all but the first (by key, start) row of each content."""
    order = np.argsort(content, kind="stable")
    ordered = content[order]
    same = ordered[1:] == ordered[:-1]
    rows = order[np.concatenate((same, [False])) | np.concatenate(([False], same))]
    out = np.zeros(len(key), bool)
    if len(rows):
        rows = rows[np.lexsort((start[rows], key[rows], content[rows]))]
        out[rows[1:][content[rows[1:]] == content[rows[:-1]]]] = True
    return out


def _rows(bucket, gram, content, key, start, count, repeat) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array(signed(gram)), pa.array(signed(content)), pa.array(key, pa.int64()),
         pa.array(start, pa.int32()), pa.array(count, pa.int32()), pa.array(repeat, pa.bool_())],
        ["bucket", "gram", "content", "key", "start", "windows", "repeat"])


SEGMENT = "bucket int, gram long, content long, key long, start int, windows int, repeat boolean"


def find_segments(keyed: DataFrame, kind: Kind, splitters: Splitters, ranges: int) -> DataFrame:
    """All segments with the range (``bucket``) that the splitters give them; rows marked ``repeat`` have the content of an earlier one of their task.

    A task combines its own segments first, so a content that many documents share reaches its range once per
    task. A minimizer with more contents than a range should hold is split between ranges.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, start, count, gram, content in _segments_of(batches, kind):
            repeat = _repeats_inside(key, start, content)
            bucket = splitters.bucket(gram, content)
            again = np.flatnonzero(repeat)
            if len(again):  # repeats that follow one another become one row
                joins = (key[again[1:]] == key[again[:-1]]) & (start[again[1:]] == start[again[:-1]] + count[again[:-1]])
                firsts = np.flatnonzero(np.concatenate(([True], ~joins)))
                count[again[firsts]] = np.add.reduceat(count[again], firsts)
                drop = np.ones(len(again), bool)
                drop[firsts] = False
                bucket[again] = key[again] % ranges
                gram[again] = content[again] = 0
                rows = np.delete(np.arange(len(key)), again[drop])
            else:
                rows = np.arange(len(key))
            for i in range(0, len(rows), 100_000):
                yield _rows(*(c[rows[i:i + 100_000]] for c in (bucket, gram, content, key, start, count, repeat)))

    return keyed.mapInArrow(run, SEGMENT)


def plan_ranges(keyed: DataFrame) -> tuple[int, int, int]:
    """Number of ranges, of documents, and of bytes."""
    docs, size = keyed.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    least = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-size // RANGE_BYTES)), docs, size


def fetch_segments(keyed: DataFrame, open_segments: DataFrame, kind: Kind, splitters: Splitters, ranges: int) -> DataFrame:
    """The text of each segment of ``open_segments (key, start, windows, gram)``, dealt by minimizer.

    Those of a split minimizer are dealt by document and marked ``split``.
    """
    lists = open_segments.groupBy("key").agg(F.collect_list(F.struct("start", "windows", "gram")).alias("parts"))
    joined = keyed.join(lists.hint("shuffle_hash"), "key").select("key", "text", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(2)
            for row, end, data, lengths in chunks(batch.column(1)):
                part = lists.slice(row, end - row)
                fields = part.flatten()
                start, count, gram = (fields.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                doc = np.repeat(np.arange(end - row), np.asarray(part.value_lengths()))
                _, counts, first, last = kind.tokenise(data, lengths)
                base = np.concatenate(([0], np.cumsum(counts)))[doc] + start
                low, high = first[base], last[base + count + kind.window - 2]
                size = high - low
                offsets = np.concatenate(([0], np.cumsum(size)))
                text = data[np.repeat(low - offsets[:-1], size) + np.arange(offsets[-1])]
                values = pa.Array.from_buffers(pa.binary(), len(low), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(text)])
                code = unsigned(np.ascontiguousarray(gram))
                split = splitters.is_split(code)
                key = keys[row:end][doc]
                bucket = np.where(split, key % ranges, np.searchsorted(splitters.gram, code, "left")).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(gram), pa.array(key), pa.array(start, pa.int32()),
                                                  pa.array(count, pa.int32()), pa.array(split), values],
                                                 ["bucket", "gram", "key", "start", "windows", "split", "text"])

    schema = "bucket int, gram long, key long, start int, windows int, split boolean, text binary"
    return joined.mapInArrow(run, schema).repartitionById(ranges, "bucket")


#: Given tokens, places of windows in ascending order of class, the classes, and the bytes, whether an equal window of the class came before.
Compare = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def compare_segments(fetched: DataFrame, kind: Kind, compare: Compare) -> DataFrame:
    """``key, start, windows, h1, h2``: runs of repeated windows, and (``h1`` not null) single windows still to be compared.

    A range holds all open segments of its minimizers, so equal windows meet there. Windows of a
    split minimizer leave with two hashes of their tokens.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches).combine_chunks()
        gram, key, start, count = (table.column(c).to_numpy() for c in ("gram", "key", "start", "windows"))
        split = table.column("split").to_numpy()
        text = table.column("text").chunk(0) if table.column("text").num_chunks == 1 else table.column("text").combine_chunks()
        order = np.lexsort((start, key, gram, split))
        new = np.ones(len(order), bool)
        new[1:] = gram[order][1:] != gram[order][:-1]
        total = np.cumsum(count[order])
        row = 0
        while row < len(order):
            end = int(np.searchsorted(total, (total[row - 1] if row else 0) + COMPARED, "right"))
            end = max(end, row + 1)
            while end < len(order) and not new[end]:
                end += 1
            rows = order[row:end]
            yield from _compare_rows(text.take(pa.array(rows)), gram[rows], key[rows], start[rows], count[rows], split[rows])
            row = end

    def _compare_rows(text, gram, key, start, count, split) -> Iterator[pa.RecordBatch]:
        offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + len(text) + 1].astype(np.int64)
        data = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        tokens, sizes, first, _ = kind.tokenise(data, np.diff(offsets))
        base = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        owner = np.repeat(np.arange(len(key)), count)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        place = base[owner] + step
        group = np.cumsum(np.concatenate(([0], gram[1:] != gram[:-1])))
        mine = split[owner]
        hit = np.zeros(len(owner), bool)
        whole = np.flatnonzero(~mine)
        hit[whole] = compare(tokens, place[whole], group[owner[whole]], data)
        runs = np.flatnonzero(hit)
        if len(runs):
            cut = np.ones(len(runs), bool)
            cut[1:] = (np.diff(runs) != 1) | (owner[runs[1:]] != owner[runs[:-1]])
            firsts = np.flatnonzero(cut)
            length = np.diff(np.append(firsts, len(runs)))
            at = runs[firsts]
            yield _flagged(key[owner[at]], start[owner[at]] + step[at], length, None, None)
        rest = np.flatnonzero(mine)
        if len(rest):
            h1 = grams(tokens, kind.window)[place[rest]]
            h2 = grams(mix(tokens ^ U(0xA5A5A5A5)), kind.window)[place[rest]]
            yield _flagged(key[owner[rest]], start[owner[rest]] + step[rest], np.ones(len(rest), np.int32), h1, h2)

    return fetched.mapInArrow(run, "key long, start int, windows int, h1 long, h2 long")


def _flagged(key, start, count, h1, h2) -> pa.RecordBatch:
    n = len(key)
    hashes = [pa.nulls(n, pa.int64())] * 2 if h1 is None else [pa.array(signed(h1)), pa.array(signed(h2))]
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(start, pa.int32()), pa.array(count, pa.int32()), *hashes],
                                      ["key", "start", "windows", "h1", "h2"])


def compare_across(windows: DataFrame) -> DataFrame:
    """Of windows ``(key, start, h1, h2)`` all but the first of each pair of hashes, joined to the firsts."""
    firsts = (windows.groupBy("h1", "h2").agg(F.min(F.struct("key", "start")).alias("first"), F.count("*").alias("n"))
              .filter("n > 1").drop("n"))
    joined = windows.join(firsts, ["h1", "h2"]).filter("first.key <> key OR first.start <> start")
    return joined.select("key", "start", F.lit(1).alias("windows"))


def removed_lists(runs: list[DataFrame]) -> DataFrame:
    """Per document the runs of repeated windows."""
    every = runs[0].select("key", "start", "windows")
    for more in runs[1:]:
        every = every.unionAll(more.select("key", "start", "windows"))
    return every.groupBy("key").agg(F.collect_list(F.struct("start", "windows")).alias("runs"))


def token_runs(starts: np.ndarray, counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of tokens that the windows cover."""
    return merge_runs(starts, starts + counts + window - 1)
