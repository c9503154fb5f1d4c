"""Find the words of documents that repeat passages of benchmark items."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kneser_ney import read_array, write_array
from .shared import shared_folder

#: Characters of benchmark text in one automaton, about 100 MB, of which a worker holds one; a larger benchmark is split.
PART_CHARS = 200_000
#: ASCII other than 0-9, a-z separates words; A-Z counts as a-z.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def normalise(text: str | None) -> list[bytes]:
    """The lower-cased words of a text as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def build_automaton(items: list[tuple[object, str | None]], window: int) -> ahocorasick.Automaton | None:
    """All windows of all items, each between spaces; the value is ``(words, item ids)``."""
    found: dict[str, tuple[int, list]] = {}
    for item, text in items:
        parts = normalise(text)
        size = min(window, len(parts))
        for i in range(len(parts) - size + 1 if size else 0):
            key = " " + b" ".join(parts[i:i + size]).decode() + " "
            ids = found.setdefault(key, (size, []))[1]
            if not ids or ids[-1] != item:
                ids.append(item)
    if not found:
        return None
    automaton = ahocorasick.Automaton()
    for key, value in found.items():
        automaton.add_word(key, value)
    automaton.make_automaton()
    return automaton


def scan(text: str | None, automaton: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, the runs of hit words, and the items with an occurring window."""
    parts = normalise(text)
    if not parts:
        return 0, [], set()
    line = " " + b" ".join(parts).decode("utf-8", "surrogatepass") + " "
    items: set = set()
    runs: list[tuple[int, int]] = []
    begins = None
    for at, (size, ids) in automaton.iter(line):
        if begins is None:
            begins = np.cumsum([0] + [len(p.decode("utf-8", "surrogatepass")) + 1 for p in parts])
        items.update(ids)
        last = int(np.searchsorted(begins, at))
        if runs and last - size <= runs[-1][1]:
            while runs and last - size <= runs[-1][1]:
                low, _ = runs.pop()
                size = max(size, last - low)
        runs.append((last - size, last))
    return len(parts), runs, items


def word_offsets(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as spans of the original text, in code points."""
    folded = text.encode("utf-8", "surrogatepass").translate(FOLD).decode("utf-8", "surrogatepass")
    starts = [i for i, c in enumerate(folded) if c != " " and (i == 0 or folded[i - 1] == " ")]
    ends = [i + 1 for i, c in enumerate(folded) if c != " " and (i + 1 == len(folded) or folded[i + 1] == " ")]
    return [(starts[a], ends[b - 1]) for a, b in runs]


class Windows(NamedTuple):
    """The items' windows: one automaton where the benchmark is small, else the files of its parts in the shared folder."""

    automaton: ahocorasick.Automaton | None
    folder: str
    parts: int
    window: int

    def automata(self) -> Iterator[ahocorasick.Automaton]:
        """One after the other, so that a worker holds one at a time."""
        if self.automaton is not None:
            yield self.automaton
        for part in range(self.parts):
            items = json.loads(read_array(f"{self.folder}/{part}", np.uint8).tobytes() or b"[]")
            if (automaton := build_automaton(items, self.window)) is not None:
                yield automaton


def cut_item(item: str, text: str, window: int, size: int) -> Iterator[tuple[str, str]]:
    """An item in pieces of about ``size`` characters that share ``window - 1`` words, so that each of its windows is in one piece."""
    if len(text) <= size:
        yield item, text
        return
    parts = [w.decode() for w in normalise(text)]
    ends = np.cumsum([len(w) + 1 for w in parts])
    begin = 0
    while begin < len(parts):
        end = int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + size))
        end = min(len(parts), max(end, begin + window))
        yield item, " ".join(parts[begin:end])
        if end == len(parts):
            return
        begin = end - window + 1


def prepare(benchmark: DataFrame, window: int, item_col: str, item_text_col: str) -> Windows:
    """The windows of all items. The size of the benchmark is summed up first: up to PART_CHARS characters become one automaton on the driver;
    of more, tasks write parts of at most about that size, and nothing of it passes the driver."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    rows = rows.filter("item IS NOT NULL AND text IS NOT NULL")
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    if size <= PART_CHARS:
        return Windows(build_automaton([tuple(r) for r in rows.collect()], window), "", 0, window)
    parts = -(-2 * size // PART_CHARS)
    folder = f"{shared_folder(benchmark.sparkSession)}/benchmark-{uuid.uuid4().hex[:12]}"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = [p for item, text in zip(*(c.to_pylist() for c in batch.columns)) for p in cut_item(item, text, window, PART_CHARS // 8)]
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pieces], pa.string()) for k in (0, 1)], ["item", "text"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, list[list[str]]] = {}
        for batch in batches:
            for part, item, text in zip(*(c.to_pylist() for c in batch.columns)):
                own.setdefault(part, []).append([item, text])
        for part, items in own.items():
            write_array(f"{folder}/{part}", np.frombuffer(json.dumps(sorted(items)).encode(), np.uint8))
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32())], ["part"])

    pieces = rows.mapInArrow(cut, "item string, text string").select(F.pmod(F.xxhash64("item", "text"), F.lit(parts)).cast("int").alias("part"), "item", "text")
    written = {r.part for r in pieces.repartitionById(parts, "part").mapInArrow(write, "part int").collect()}
    for part in set(range(parts)) - written:
        write_array(f"{folder}/{part}", np.zeros(0, np.uint8))
    return Windows(None, folder, parts, window)


def judge_all(texts: list[str | None], windows: Windows, per: int) -> list[tuple[int, int, list[str], list[tuple[int, int]], bool]]:
    """``(words, hit words, items, runs of hit words, contaminated)`` of each text."""
    totals, hits, items = [-1] * len(texts), [[] for _ in texts], [set() for _ in texts]
    for automaton in windows.automata():
        for i, text in enumerate(texts):
            totals[i], runs, found = scan(text, automaton)
            hits[i] += runs
            items[i] |= found
    out = []
    for text, total, own, found in zip(texts, totals, hits, items):
        total = len(normalise(text)) if total < 0 else total
        merged: list[tuple[int, int]] = []
        for low, high in sorted(own):
            if merged and low <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
            else:
                merged.append((low, high))
        n_hit = sum(high - low for low, high in merged)
        out.append((total, n_hit, sorted(found), merged, n_hit > 0 and per * n_hit >= total))
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, per: int = 20,
                       id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, items, spans, contaminated``.

    An item is known by its windows of ``window`` words (all its words if it has fewer). One Aho-Corasick automaton
    of all windows reads each text once. ``items`` has the ids (as sorted strings) of the items with an occurring window,
    ``spans`` the hit passages as ``start, end`` in code points of the original text; a document is
    ``contaminated`` if any word is and at least one of every ``per``.

    A benchmark of up to PART_CHARS characters goes to every worker as one automaton. Tasks write a larger one to the shared folder in parts of
    that size; a worker builds the automaton of one part at a time and reads the texts of a batch with it, so its memory is bounded.
    Null and empty texts have no words; null items and items without words hit nothing; items
    with equal texts are all reported. Rows of ``docs`` are judged one by one, whatever their id.
    """
    windows = prepare(benchmark, window, item_col, item_text_col)
    schema = "n_words long, n_hit long, items array<string>, spans array<struct<start: int, end: int>>, contaminated boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = batch.column(1).to_pylist()
            for text, (total, n_hit, items, runs, bad) in zip(texts, judge_all(texts, windows, per)):
                spans = [{"start": a, "end": b} for a, b in word_offsets(text, runs)] if runs else []
                rows.append((total, n_hit, items, spans, bad))
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                pa.array(cols[2], pa.list_(pa.string())),
                pa.array(cols[3], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array(cols[4], pa.bool_())], ["id", "n_words", "n_hit", "items", "spans", "contaminated"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, f"id {dict(plain.dtypes)['id']}, {schema}").withColumnRenamed("id", id_col)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13, per: int = 20, text_col: str = "text",
                        item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that ``find_contamination`` does not call contaminated."""
    windows = prepare(benchmark, window, item_col, item_text_col)
    position = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not j[4] for j in judge_all(batch.column(position).to_pylist(), windows, per)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
