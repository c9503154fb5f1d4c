"""Removal of repeated word sequences by minimizer segments, in place of a compacted de Bruijn graph."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import grams
from .repeats import (Kind, compare_across, compare_segments, fetch_segments, find_segments, plan_ranges, removed_lists,
                      sample_splitters, token_runs, word_tokens)
from .shared import materialize, with_keys


def equal_before(tokens: np.ndarray, place: np.ndarray, group: np.ndarray, window: int) -> np.ndarray:
    """Whether the window of tokens at ``place`` equals one before it in its group; hashes find, tokens verify."""
    out = np.zeros(len(place), bool)
    if not len(place):
        return out
    key = grams(tokens, window)[place]
    order = np.lexsort((key, group))
    same = (key[order][1:] == key[order][:-1]) & (group[order][1:] == group[order][:-1])
    a, b = place[order][:-1][same], place[order][1:][same]
    for i in range(window):
        if (tokens[a + i] != tokens[b + i]).any():
            raise ArithmeticError("two windows share a hash")
    out[order[1:][same]] = True
    return out


def remove_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, spans, kept``.

    ``spans`` are the maximal runs of words covered by a window of ``window`` words that also starts earlier (in a document
    of smaller id, or earlier in the same one); ``kept`` has the other words, joined by one space.

    Nodes are the minimizers of word k-mers, paths the segments of windows that have one, with their source coordinates; k-mers
    are not linked by edges. A node that occurs once is on no repeated path. A node does not branch where all its segments have one
    content hash: every one but the first is a repeat as a whole, by hash and not verified on the text. Paths of branching nodes are
    fetched from their source coordinates, verified word by word, and joined again where they agree. Nodes with
    more paths than a task should hold are salted; their windows are joined by hash.

    Null and empty texts have no words. Rows equal in id and text are one place: none of them is the earlier one, and each
    gets the same result. Different texts of one id, and null ids, count in the order of id (null first) and text.
    An empty table gives an empty result.
    """
    kind = Kind(word_tokens, window, min(6, max(1, window // 2)))
    keyed, restore = with_keys(docs, id_col, text_col)
    ranges, n, size = plan_ranges(keyed)
    splitters = sample_splitters(keyed, kind, ranges, n, size)
    split = splitters.gram.view(np.int64).tolist()

    dealt = find_segments(keyed, kind, splitters, ranges)
    salted = F.col("gram").isin(split) if split else F.lit(False)
    edges = dealt.withColumn("salt", F.when(salted | F.col("repeat"), F.col("bucket")).otherwise(0)).repartition(ranges, "gram", "salt")
    # Both windows group inside the partitioning by node and salt: nothing moves again.
    path, node = Window.partitionBy("gram", "salt", "content"), Window.partitionBy("gram", "salt")
    graph = (edges.withColumn("first", F.min(F.struct("key", "start")).over(path))
             .withColumn("branches", salted | (F.min("content").over(node) != F.max("content").over(node)))
             .withColumn("paths", F.count("*").over(node)))
    later = (F.col("first.key") != F.col("key")) | (F.col("first.start") != F.col("start"))
    repeated = graph.filter(F.col("repeat") | salted | (F.col("paths") > 1))
    known = materialize(repeated.select("key", "start", "windows", "gram", (F.col("repeat") | later).alias("repeat"), "branches"), "paths")

    def compare(tokens: np.ndarray, place: np.ndarray, group: np.ndarray, data: np.ndarray) -> np.ndarray:
        return equal_before(tokens, place, group, window)

    fetched = fetch_segments(keyed, known.filter("branches AND NOT repeat"), kind, splitters, ranges)
    compared = materialize(compare_segments(fetched, kind, compare), "compared")
    across = compare_across(compared.filter("h1 IS NOT NULL"))
    lists = removed_lists([known.filter("repeat"), compared.filter("h1 IS NULL"), across])
    joined = keyed.join(lists.hint("shuffle_hash"), "key", "left").select("key", "text", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            sizes, gone, spans, kept = [], [], [], []
            for text, runs in zip(batch.column(1), batch.column(2)):
                parts = text.as_buffer().to_pybytes().split() if text.is_valid else []
                low = high = np.zeros(0, np.int64)
                sizes.append(len(parts))
                if runs.is_valid:
                    fields = runs.values
                    low, high = token_runs(fields.field(0).to_numpy().astype(np.int64), fields.field(1).to_numpy(), window)
                    edges = [0, *np.stack([low, high], 1).ravel().tolist(), len(parts)]
                    parts = [w for a, b in zip(edges[::2], edges[1::2]) for w in parts[a:b]]
                gone.append(int((high - low).sum()))
                spans.append([{"start": a, "end": b} for a, b in zip(low.tolist(), high.tolist())])
                kept.append(b" ".join(parts).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(spans, span), pa.array(kept, pa.string())],
                                             ["key", "n_words", "n_removed", "spans", "kept"])

    schema = "key long, n_words long, n_removed long, spans array<struct<start: int, end: int>>, kept string"
    return restore(joined.mapInArrow(cut, schema)).select(F.col(id_col), "n_words", "n_removed", "spans", "kept")
