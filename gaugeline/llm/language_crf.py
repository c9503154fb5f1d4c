"""Language identification with a linear-chain conditional random field over the words of a text."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, Words, byte_table, chunks, grams, mix, unsigned, words
from .quality_model import remainder

#: Rows of the weight table that features are hashed to.
ROWS = 1 << 16
#: Training: sequences of so many words from up to PIECES texts, so that languages switch inside; steps and their size.
LENGTH, PIECES, BATCH, STEPS, RATE = 48, 3, 48, 250, 0.3
#: What a task sends of a text that the field learns from: all of a short one, else so many pieces of LENGTH words, and bytes of a piece.
SENT, PIECE_BYTES = 8, 1024
#: Words that forward and backward run over at once.
WORDS = 1_000_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Model(NamedTuple):
    labels: list[str]
    weights: np.ndarray  # ROWS x labels
    transitions: np.ndarray  # from, to
    start: np.ndarray


def word_features(data: np.ndarray, found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the features of each word, one word's behind the other's, and how many each has.

    Affixes of 1 to 3 bytes at both ends, all runs of 2 and 3 bytes, and the word itself (the lexicon).
    """
    n = len(found.start)
    size = found.end - found.start
    padded = np.concatenate((byte_table()[data], np.zeros(3, U)))
    runs = {1: mix(padded), 2: grams(padded, 2), 3: grams(padded, 3)}
    parts, owners = [mix(found.hash + U(9))], [np.arange(n)]
    for k in (1, 2, 3):
        rows = np.flatnonzero(size >= k)
        parts += [mix(runs[k][found.start[rows]] + U(k)), mix(runs[k][found.end[rows] - k] + U(k + 3))]
        owners += [rows, rows]
    word_of = np.repeat(np.arange(n), size)
    at = np.arange(len(word_of)) - np.repeat(np.cumsum(size) - size, size) + found.start[word_of]
    for k in (2, 3):
        rows = np.flatnonzero(at + k <= found.end[word_of])
        parts.append(mix(runs[k][at[rows]] + U(k + 6)))
        owners.append(word_of[rows])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return (np.concatenate(parts)[order] % U(ROWS)).astype(np.int64), np.bincount(owner, minlength=n)


def distinct_words(found: Words) -> tuple[Words, np.ndarray]:
    """One occurrence of each word, and for each occurrence which of them it is."""
    _, pick, which = np.unique(found.hash, return_index=True, return_inverse=True)
    return Words(found.start[pick], found.end[pick], found.doc[pick], found.hash[pick]), which


def emissions(weights: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean weight of a word's features, times the root of their number, for each label."""
    if not len(counts):
        return np.zeros((0, weights.shape[1]), np.float32)
    sums = np.add.reduceat(weights[rows], np.cumsum(counts) - counts, axis=0)
    return sums / np.sqrt(counts)[:, None]


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of the labels of each word, and expected transitions and starts; sequences lie one behind the other.

    All sequences advance together, longest first, so those that have ended drop off the end. Messages are
    probabilities scaled to sum to one.
    """
    total, labels = scores.shape
    begins = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    begins, sizes = begins[order], lengths[order]
    live = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), "left")  # sequences longer than t
    local = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float32)
    step = np.exp(transitions - transitions.max()).astype(np.float32)
    first = np.exp(start - start.max()).astype(np.float32)
    ahead = np.empty((total, labels), np.float32)
    for t, n in enumerate(live):
        at = begins[:n] + t
        message = (first if t == 0 else ahead[at - 1] @ step) * local[at]
        ahead[at] = message / message.sum(axis=1, keepdims=True)
    marginals = np.empty((total, labels), np.float32)
    moves = np.zeros((labels, labels))
    back = np.ones((len(sizes), labels), np.float32)
    for t in range(len(live) - 1, -1, -1):
        n = live[t]
        more = live[t + 1] if t + 1 < len(live) else 0
        at = begins[:n] + t
        if more:
            after = local[at[:more] + 1] * back[:more]
            joint = ahead[at[:more]][:, :, None] * step * after[:, None, :]
            moves += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            message = after @ step.T
            back[:more] = message / message.sum(axis=1, keepdims=True)
        both = ahead[at] * back[:n]
        marginals[at] = both / both.sum(axis=1, keepdims=True)
    return marginals, moves, marginals[begins[:live[0] if len(live) else 0]].sum(axis=0)


def pieces(data: np.ndarray, lengths: np.ndarray, seeds: np.ndarray) -> list[list[str]]:
    """What is sent of each text: one that is short is a single piece; of others SENT places, by hash over all its words."""
    found = words(data, lengths)
    counts, ends = found.per_doc(len(lengths)), np.cumsum(lengths)
    out = []
    for n, first, size, end, seed in zip(counts, np.cumsum(counts) - counts, lengths, ends, seeds):
        spans = [(end - size, end)]
        if n and (n > SENT * LENGTH or size > SENT * PIECE_BYTES):
            spans = []
            for h in mix(np.arange(1, SENT + 1, dtype=U) * U(0x9E3779B97F4A7C15) ^ seed):
                word = first + int(h % U(n))
                start, stops = found.start[word], found.end[word:min(word + LENGTH, first + n)]
                spare = int(stops[0] - start) - PIECE_BYTES
                if spare > 0:  # a part of a very long word, from anywhere in it
                    start += int(mix(h[None])[0] % U(spare + 1))
                    spans.append((start, start + PIECE_BYTES))
                else:
                    spans.append((start, stops[np.searchsorted(stops, start + PIECE_BYTES, "right") - 1]))
        out.append([data[a:b].tobytes().decode("utf-8", "ignore") for a, b in spans])
    return out


def fit(sample: list[list[str]], labels: list[str], seed: int = 5) -> Model:
    """Maximise the conditional likelihood by adaptive gradient steps on sequences drawn from the pieces of each text.

    From a text that is a single piece sequences start anywhere, else where a piece starts.
    """
    names = sorted(set(labels))
    rng = np.random.default_rng(seed)
    all_rows, all_counts, all_which, all_words, known = [], [], [], [], 0
    for _, _, data, lengths in chunks(pa.array([p for own in sample for p in own], pa.string())):
        low = _LOWER[data]
        found = words(low, lengths)
        same, at = distinct_words(found)
        some_rows, some = word_features(low, same)
        all_rows.append(some_rows.astype(np.int32))
        all_counts.append(some)
        all_which.append(at + known)
        all_words.append(found.per_doc(len(lengths)))
        known += len(some)
    rows, counts, which, piece_words = (np.concatenate(x) for x in (all_rows, all_counts, all_which, all_words))
    offsets = np.cumsum(counts) - counts
    piece_begin = np.cumsum(piece_words) - piece_words
    has = np.array([len(own) for own in sample])
    first_piece = np.cumsum(has) - has
    label_of = np.array([names.index(x) for x in labels])
    by_label = [np.flatnonzero((label_of == k) & (np.add.reduceat(piece_words, first_piece) > 0)) for k in range(len(names))]
    by_label = [(k, docs) for k, docs in enumerate(by_label) if len(docs)]
    weights, transitions, start = np.zeros((ROWS, len(names)), np.float32), np.zeros((len(names),) * 2), np.zeros(len(names))
    seen = [np.full_like(weights, 1e-4), np.full_like(transitions, 1e-4), np.full_like(start, 1e-4)]
    for _ in range(STEPS if by_label else 0):
        picked, target, sizes = [], [], []
        for _ in range(BATCH):
            size = 0
            for _ in range(rng.integers(1, PIECES + 1)):
                k, docs = by_label[rng.integers(len(by_label))]
                doc = docs[rng.integers(len(docs))]
                one = first_piece[doc] + rng.integers(has[doc])
                begin = rng.integers(piece_words[one]) if has[doc] == 1 else 0
                piece = np.arange(begin, min(begin + 1 + rng.integers(LENGTH), piece_words[one])) + piece_begin[one]
                picked.append(piece)
                target.append(np.full(len(piece), k))
                size += len(piece)
            sizes.append(size)
        at, truth, sizes = which[np.concatenate(picked)], np.concatenate(target), np.array(sizes)
        n = counts[at]
        own = rows[np.repeat(offsets[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        marginals, moves, firsts = forward_backward(emissions(weights, own, n), sizes, transitions, start)
        error = -marginals.astype(np.float64)
        error[np.arange(len(truth)), truth] += 1
        each = np.repeat(error / np.sqrt(n)[:, None], n, axis=0)
        touched, back = np.unique(own, return_inverse=True)
        slope = np.stack([np.bincount(back, each[:, k], len(touched)) for k in range(len(names))], axis=1) / BATCH - 1e-5 * weights[touched]
        seen[0][touched] += slope ** 2
        weights[touched] += RATE * slope / np.sqrt(seen[0][touched])
        begins = np.cumsum(sizes) - sizes
        inner = np.ones(len(truth), bool)
        inner[begins] = False
        inner = np.flatnonzero(inner)
        slope = (np.bincount(truth[inner - 1] * len(names) + truth[inner], minlength=len(names) ** 2).reshape(moves.shape) - moves) / BATCH
        seen[1] += slope ** 2
        transitions += RATE * slope / np.sqrt(seen[1])
        slope = (np.bincount(truth[begins], minlength=len(names)) - firsts) / BATCH
        seen[2] += slope ** 2
        start += RATE * slope / np.sqrt(seen[2])
    return Model(names, weights, transitions, start)


def label_words(data: np.ndarray, lengths: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the labels of each word, and the words per text."""
    low = _LOWER[data]
    found = words(low, lengths)
    same, which = distinct_words(found)
    scores = emissions(model.weights, *word_features(low, same))[which]
    return scores, found.per_doc(len(lengths))


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def share(counts: list[int], fit_rows: int) -> int:
    """The most texts per language, at least one, such that all languages together have at most ``fit_rows``."""
    left, most = fit_rows, 1
    for i, n in enumerate(sorted(counts)):
        most = max(1, left // (len(counts) - i))
        if n > most:
            break
        left -= n
    return most


def train(docs: DataFrame, fit_rows: int, folds: int, held_fold: int, id_col: str, text_col: str, lang_col: str) -> Model | None:
    known = (docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).cast("string").rlike(r"\p{L}")).filter(remainder(id_col, folds) != held_fold)
             .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
                     F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string")).alias("by")))
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return None
    most = share(list(counts.values()), fit_rows)
    # A threshold per language, below which the first ones by hash surely are.
    below = [(lang, int((1 << 30) * min(1.0, (most + 6 * most ** 0.5 + 20) / n))) for lang, n in counts.items()]
    limits = docs.sparkSession.createDataFrame(below, "lang string, below long")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = unsigned(batch.column(1).to_numpy(zero_copy_only=False))
            parts = [p for a, b, data, lengths in chunks(batch.column(2)) for p in pieces(data, lengths, seeds[a:b])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(parts, pa.list_(pa.string()))], ["lang", "by", "pieces"])

    near = known.join(F.broadcast(limits), "lang").filter(F.pmod("by", F.lit(1 << 30)) < F.col("below")).select("lang", "by", "text")
    sent = near.mapInArrow(send, "lang string, by long, pieces array<string>").groupBy("lang", "by").agg(F.first("pieces").alias("pieces"))
    rows, taken = [], dict.fromkeys(counts, 0)
    for row in sorted(sent.collect(), key=lambda r: (r.by % (1 << 30), r.by, r.lang)):
        taken[row.lang] += 1
        if taken[row.lang] <= most:
            rows.append(row)
    return fit([r.pieces for r in rows], [r.lang for r in rows])


def identify_language(docs: DataFrame, fit_rows: int = 8_000, folds: int = 4, held_fold: int = 2, id_col: str = "doc_id",
                      text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, shares`` for each row of ``docs``.

    A linear-chain conditional random field labels the words of each whole text: affix, n-gram and lexicon features of a word
    are weighed per label, learned transitions tie neighbours, and forward-backward gives the probability of each label
    for each word, also where a text switches its language. ``shares`` has the mean probability by language,
    ``lang_pred`` the language with the largest, ``score`` that share.

    The field learns from at most ``fit_rows`` texts with a language and a letter, the first of each language by a hash of id and
    text among those whose crc32 of the id modulo ``folds`` is not ``held_fold``. All languages get the same number of texts;
    what a rare one has not is left to the others, and each one has a text at least. Its training sequences join pieces of several
    texts; of a long text tasks send pieces from places by hash over the whole text, so what the driver holds is bounded. ``und`` with score 0
    is the result for null texts, texts without a letter, and where nothing could be learned. Ties go to the first language
    in order. Rows are judged one by one, whatever their id.
    """
    model = train(docs, fit_rows, folds, held_fold, id_col, text_col, lang_col)
    names = model.labels if model else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple[np.ndarray, np.ndarray]] = []
            shares: list[np.ndarray] = []

            def flush() -> None:
                scores, counts = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                marginals, _, _ = forward_backward(scores, counts, model.transitions, model.start)
                owner = np.repeat(np.arange(len(counts)), counts)
                sums = np.stack([np.bincount(owner, marginals[:, k], len(counts)) for k in range(len(names))], axis=1)
                shares.append(sums / np.maximum(counts, 1)[:, None])
                held.clear()

            for _, _, data, lengths in chunks(batch.column(1)) if model else ():
                held.append(label_words(data, lengths, model))
                if sum(len(h[0]) for h in held) >= WORDS:
                    flush()
            if held:
                flush()
            table = np.concatenate(shares) if shares else np.zeros((batch.num_rows, 0))
            judged = np.array([has_letter(t) for t in batch.column(1).to_pylist()], bool) & bool(names)
            best = table.argmax(axis=1) if names else np.zeros(batch.num_rows, int)
            score = np.where(judged, np.minimum(table.max(axis=1), 1) if names else 0, 0.0)
            pred = [names[k] if ok else "und" for k, ok in zip(best, judged)]
            maps = [list(zip(names, row)) if ok else [] for row, ok in zip(table.tolist(), judged)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(maps, pa.map_(pa.string(), pa.float64()))], ["id", "lang_pred", "score", "shares"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = plain.mapInArrow(run, f"id {dict(plain.dtypes)['id']}, lang_pred string, score double, shares map<string, double>")
    return scored.select(F.col("id").alias(id_col), (remainder("id", folds) == held_fold).alias("held_out"), "lang_pred", "score", "shares")
