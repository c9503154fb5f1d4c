"""Quality rules on repetition inside a text, from suffix arrays over its words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, byte_table, chunks, hash_spans, mix, separators, words

# The symbols that are counted.
SYMBOLS = b"#*$%&|<>"


def suffix_array(tokens: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``tokens`` and the common prefix of each suffix with the one before it.

    A suffix ends at ``ends[i]``, the end of its text; equal prefixes count across texts, so
    callers make tokens differ between texts. Ranks by 1, 2, 4, ... tokens are refined only where they tie.
    """
    n = len(tokens)
    order = np.argsort(tokens, kind="stable")
    sorted_tokens = tokens[order]
    new = np.ones(n, bool)
    new[1:] = sorted_tokens[1:] != sorted_tokens[:-1]
    heads = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    levels, step = [rank.copy()], 1
    tied = ~(new & np.append(new[1:], True))
    slots = np.flatnonzero(tied)  # places of the suffix array that are not settled
    while len(slots):
        at = order[slots]
        after = at + step
        inside = after < ends[at]
        key = np.where(inside, rank[np.minimum(after, n - 1)], -1)
        head = rank[at]
        by = np.lexsort((key, head))
        at, key, head = at[by], key[by], head[by]
        order[slots] = at
        new = np.ones(len(at), bool)
        new[1:] = (head[1:] != head[:-1]) | (key[1:] != key[:-1]) | (key[1:] < 0)
        firsts = np.flatnonzero(new)
        sizes = np.diff(np.append(firsts, len(at)))
        rank[at] = np.repeat(slots[firsts], sizes)
        slots = slots[np.repeat(sizes > 1, sizes)]
        step *= 2
        levels.append(rank.copy())
    common = np.zeros(n, np.int64)
    if n > 1:
        a, b = order[:-1].copy(), order[1:].copy()
        first_a = a.copy()
        for level in range(len(levels) - 1, -1, -1):
            ok = (a < n) & (b < n)
            same = np.zeros(len(a), bool)
            same[ok] = levels[level][a[ok]] == levels[level][b[ok]]
            a[same] += 1 << level
            b[same] += 1 << level
        common[1:] = a - first_a
    return order, common


def longest_repeats(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position the length of the longest string from there that also occurs elsewhere."""
    order, common = suffix_array(tokens, ends)
    out = np.zeros(len(tokens), np.int64)
    out[order] = np.maximum(common, np.append(common[1:], 0))
    return out


def _covered(starts: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + sizes, -1)
    return np.cumsum(marks[:n]) > 0


def measure(data: np.ndarray, lengths: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """The counts of each of the texts that lie one behind the other in ``data``."""
    docs = len(lengths)
    found = words(data, lengths)
    n_words = found.per_doc(docs)
    doc_of = np.repeat(np.arange(docs), lengths)
    in_word = ~separators()[data]
    letters = in_word & ((data & 0xC0) != 0x80)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    out = {"n_words": n_words, "word_chars": np.bincount(doc_of[letters], minlength=docs),
           "n_symbols": np.bincount(doc_of[symbol[data]], minlength=docs)}

    begins = np.concatenate(([0], np.cumsum(lengths)))
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate((begins[:-1], breaks + 1)))
    end = np.sort(np.concatenate((breaks, begins[1:])))
    line_doc = np.minimum(np.searchsorted(begins, end, "left") - 1, docs - 1).clip(0)
    line_doc = np.maximum.accumulate(line_doc) if len(line_doc) else line_doc
    filled = np.concatenate(([0], np.cumsum(in_word)))
    full = filled[end] > filled[start]
    start, end, line_doc = start[full], end[full], np.searchsorted(begins, start[full], "right") - 1
    line = mix(hash_spans(data, start, end) ^ byte_table()[0] * (line_doc + 1).astype(U))
    _, first = np.unique(line, return_index=True)
    again = np.ones(len(line), bool)
    again[first] = False
    out["n_dup_lines"] = np.bincount(line_doc[again], minlength=docs)

    word_ends = np.cumsum(n_words)
    tokens = mix(found.hash ^ mix((found.doc + 1).astype(U)))
    repeat = longest_repeats(tokens, word_ends[found.doc]) if len(tokens) else np.zeros(0, np.int64)
    long = np.flatnonzero(repeat >= window)
    hit = _covered(long, repeat[long], len(tokens))
    out["n_repeat_words"] = np.bincount(found.doc[hit], minlength=docs)
    longest = np.zeros(docs, np.int64)
    np.maximum.at(longest, found.doc, repeat)
    out["longest_repeat"] = longest
    return out


def repetition_rules(docs: DataFrame, window: int = 8, min_words: int = 20, base_percent: int = 30,
                     max_covered: float = 0.25, max_longest: int = 60,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its counts, ``base_failed`` and ``kept``.

    A suffix array over the words of each text (texts of a chunk are sorted together, repeats never cross texts)
    gives by longest common prefixes the maximal repeated substrings. Those of ``window`` words or
    more are united: ``n_repeat_words`` is what they cover, first occurrences included, ``longest_repeat`` the
    longest repeated substring. The base rules ask for ``min_words`` words and at most ``base_percent`` of them
    repeated; the method keeps what passes them, has a covered fraction of at most ``max_covered`` and no repeat
    above ``max_longest`` words.

    Null and empty texts have 0 of everything and fail the base. Rows are judged one by one, whatever their id.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [measure(data, lengths, window) for _, _, data, lengths in chunks(batch.column(1))]
            cols = [np.concatenate([p[n] for p in parts] or [np.zeros(0, np.int64)]) for n in names]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols)], ["id", *names])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = plain.mapInArrow(run, f"id {dict(plain.dtypes)['id']}, " + ", ".join(f"{n} long" for n in names))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > base_percent * F.col("n_words"))
    good = (F.col("n_repeat_words") <= max_covered * F.col("n_words")) & (F.col("longest_repeat") <= max_longest)
    return counted.withColumn("base_failed", failed).withColumn("kept", ~failed & good).withColumnRenamed("id", id_col)
