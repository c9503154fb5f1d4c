"""Toxicity: a linear-chain conditional random field tags toxic words; their marginals give document scores and offsets."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import ALNUM, LOWER, U, chunks, hash_spans, mix, signed, unsigned, word_bounds
from .language_crf import forward_backward, share
from .quality_model import remainder

#: Rows of the weight table, and the affixes in bytes that a word has as features at either end.
ROWS, AFFIXES = 1 << 18, range(2, 9)
#: Affixes that may mark a word as toxic, contexts that such a mark needs, and how much likelier (log likelihood ratio, ratio of rates) it must be.
MARKS, CONTEXTS, EVIDENCE, LIFT = range(4, 9), 4, 18.0, 20.0
#: Training: pieces of a text and their words, steps, pieces in a step, and the size of a step.
PIECES, LENGTH, STEPS, BATCH, RATE = 3, 24, 300, 64, 0.3
#: Bytes that a longer word is cut to in training, half from either end, and positions a lane of the forward pass has.
WORD_BYTES, LANE = 64, 64


class Tokens(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray


class Model(NamedTuple):
    weights: np.ndarray  # log odds of toxic, by feature row
    transitions: np.ndarray  # from, to; label 1 is toxic
    start: np.ndarray
    doc: np.ndarray  # of the logistic document score


def tokens(low: np.ndarray, lengths: np.ndarray) -> Tokens:
    """Runs of letters and digits in lower-cased bytes."""
    start, end, doc = word_bounds(ALNUM[low], lengths)
    return Tokens(start, end, doc, hash_spans(low, start, end))


def affix_hashes(low: np.ndarray, found: Tokens, sizes: range) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word and of its first and last bytes, one row per word, and which of them the word is long enough for."""
    padded = np.concatenate((np.zeros(8, np.uint8), low, np.zeros(8, np.uint8)))
    eight = np.ndarray(len(low) + 9, "<u8", padded, 0, (1,))
    head, tail, size = eight[found.start + 8].astype(U), eight[found.end].astype(U), found.end - found.start
    columns, has = [mix(found.hash + U(1))], [np.ones(len(size), bool)]
    for k in sizes:
        unused = U(64 - 8 * k)
        columns += [mix((head << unused) + U(2 * k)), mix(((tail >> unused) << unused) + U(2 * k + 1)) if unused else mix(tail + U(2 * k + 1))]
        has += [size >= k] * 2
    return np.stack(columns, axis=1), np.stack(has, axis=1)


def emissions(low: np.ndarray, found: Tokens, weights: np.ndarray) -> np.ndarray:
    """Log odds of toxic of each word by its own features; each distinct word is looked at once."""
    _, pick, which = np.unique(found.hash, return_index=True, return_inverse=True)
    hashes, has = affix_hashes(low, Tokens(*(a[pick] for a in found)), AFFIXES)
    return ((weights[(hashes % U(ROWS)).astype(np.int64)] * has).sum(axis=1) / np.sqrt(has.sum(axis=1)))[which]


def _chain(maps: np.ndarray) -> np.ndarray:
    """Composition ``maps[t] ... maps[0]`` applied to (1, 1), as odds, for each t.

    Lanes of LANE maps advance side by side; what enters a lane follows from the composed maps of the lanes before
    it by the same procedure. So a text of any length takes a few vector steps.
    """
    n = len(maps)
    lanes = max(1, -(-n // LANE))
    padded = np.tile(np.eye(2), (lanes * LANE, 1, 1))
    padded[:n] = maps
    steps = padded.reshape(lanes, LANE, 2, 2)
    enter = np.ones((lanes, 2))
    if lanes > 1:
        whole = steps[:, 0]
        for t in range(1, LANE):
            whole = steps[:, t] @ whole
            whole = whole / whole.sum(axis=(1, 2), keepdims=True)
        odds = _chain(whole[:-1])
        enter[1:, 0], enter[1:, 1] = odds / (1 + odds), 1 / (1 + odds)
    out = np.empty((lanes, LANE))
    x, y = enter.T
    for t in range(LANE):
        m = steps[:, t]
        x, y = m[:, 0, 0] * x + m[:, 0, 1] * y, m[:, 1, 0] * x + m[:, 1, 1] * y
        total = x + y
        x, y = x / total, y / total
        out[:, t] = x / y
    return out.ravel()[:n]


def log_odds(scores: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """Log odds of toxic of each word given its whole text, by forward-backward; texts lie one behind the other."""
    n = len(scores)
    if not n:
        return np.zeros(0)
    ratio = np.exp(np.clip(scores, -30, 30))
    step, first = np.exp(model.transitions), np.exp(model.start)
    begins = (np.cumsum(lengths) - lengths)[lengths > 0]
    # Forward: (toxic, clean) after a word from that before it; a first word forgets what came before.
    ahead = np.empty((n, 2, 2))
    ahead[:, 0, 0], ahead[:, 0, 1] = step[1, 1] * ratio, step[0, 1] * ratio
    ahead[:, 1, 0], ahead[:, 1, 1] = step[1, 0], step[0, 0]
    ahead[begins, 0, :], ahead[begins, 1, :] = (first[1] * ratio[begins])[:, None], first[0]
    # Backward, in reverse: what follows a word, from what follows the next one.
    after = np.empty((n, 2, 2))
    after[:, 0, 0], after[:, 0, 1] = step[1, 1] * np.append(ratio[1:], 1), step[1, 0]
    after[:, 1, 0], after[:, 1, 1] = step[0, 1] * np.append(ratio[1:], 1), step[0, 0]
    after[np.append(begins[1:], n) - 1] = 1.0
    return np.log(np.maximum(_chain(ahead), 1e-300)) + np.log(np.maximum(_chain(after[::-1])[::-1], 1e-300))


def document_features(odds: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text: one, its most toxic word's log odds, expected toxic words, and words, both as logs."""
    docs = len(counts)
    owner = np.repeat(np.arange(docs), counts)
    most = np.full(docs, -12.0)
    np.maximum.at(most, owner, np.clip(odds, -12, 12))
    expected = np.bincount(owner, 1 / (1 + np.exp(-np.clip(odds, -30, 30))), docs)
    return np.stack((np.ones(docs), most, np.log1p(expected), np.log1p(counts)), axis=1)


def tag(data: np.ndarray, lengths: np.ndarray, model: Model) -> tuple[Tokens, np.ndarray, np.ndarray]:
    low = LOWER[data]
    found = tokens(low, lengths)
    counts = np.bincount(found.doc, minlength=len(lengths))
    odds = log_odds(emissions(low, found, model.weights), counts, model) if len(found.start) else np.zeros(0)
    return found, counts, odds


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a small ridge."""
    beta, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [1e-2] * (x.shape[1] - 1)) * weight.sum() / 100
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge @ beta
        move = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(beta)), slope)
        beta = beta + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return beta


def fit(pieces: list[list[str]], flags: list[list[bool]], seed: int = 13) -> Model:
    """Maximise the conditional likelihood of the labelled words by adaptive gradient steps; half of the pieces of a step have toxic words."""
    rng = np.random.default_rng(seed)
    sizes = np.array([len(p) for p in pieces])
    data = np.frombuffer("\n".join(" ".join(p) for p in pieces).encode(), np.uint8)
    found = tokens(data, np.array([len(data)]))
    hashes, has = affix_hashes(data, found, AFFIXES)
    rows, counts = (hashes % U(ROWS)).astype(np.int64), has.sum(axis=1)
    truth = np.concatenate([np.array(f, np.int64) for f in flags])
    begins = np.cumsum(sizes) - sizes
    toxic = np.add.reduceat(truth, begins) > 0
    pools = [np.flatnonzero(toxic), np.flatnonzero(~toxic)]
    pools = [p for p in pools if len(p)]
    weights, transitions, start = np.zeros(ROWS), np.zeros((2, 2)), np.zeros(2)
    seen = [np.full(ROWS, 1e-4), np.full((2, 2), 1e-4), np.full(2, 1e-4)]
    for _ in range(STEPS):
        chosen = np.concatenate([p[rng.integers(len(p), size=BATCH // len(pools))] for p in pools])
        n = sizes[chosen]
        at = np.repeat(begins[chosen] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        own, mask, label = rows[at], has[at], truth[at]
        scores = np.zeros((len(at), 2), np.float32)
        scores[:, 1] = (weights[own] * mask).sum(axis=1) / np.sqrt(counts[at])
        marginals, moves, firsts = forward_backward(scores, n, transitions, start)
        each = np.repeat(((label - marginals[:, 1]) / np.sqrt(counts[at]))[:, None], own.shape[1], axis=1)[mask]
        touched, back = np.unique(own[mask], return_inverse=True)
        slope = np.bincount(back, each, len(touched)) / BATCH - 1e-5 * weights[touched]
        seen[0][touched] += slope ** 2
        weights[touched] += RATE * slope / np.sqrt(seen[0][touched])
        heads = np.cumsum(n) - n
        inner = np.ones(len(at), bool)
        inner[heads] = False
        inner = np.flatnonzero(inner)
        slope = (np.bincount(label[inner - 1] * 2 + label[inner], minlength=4).reshape(2, 2) - moves) / BATCH
        seen[1] += slope ** 2
        transitions += RATE * slope / np.sqrt(seen[1])
        slope = (np.bincount(label[heads], minlength=2) - firsts) / BATCH
        seen[2] += slope ** 2
        start += RATE * slope / np.sqrt(seen[2])
    return Model(weights.astype(np.float32), transitions, start, np.zeros(4))


def _sample(docs: DataFrame, labels: DataFrame, fit_rows: int, folds: int, held_fold: int, id_col: str, text_col: str,
            label_col: str) -> tuple[DataFrame, dict[bool, int], dict[bool, int]]:
    """``toxic, by, text`` of at most ``fit_rows`` training documents, the first of each label by hash of the id, the labels' counts, and how many are taken."""
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).filter(remainder(id_col, folds) != held_fold)
             .groupBy(F.col(id_col).alias("id")).agg((F.max(F.col(label_col)) > 0).alias("toxic")))
    by = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 30))
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    most = share(list(counts.values()), fit_rows) if counts else 0
    chosen = None
    for toxic, n in counts.items():
        below = int((1 << 30) * min(1.0, (most + 6 * most ** 0.5 + 20) / n))  # surely enough
        part = known.filter((F.col("toxic") == toxic) & (by < below)).orderBy(by, "id").limit(most)
        chosen = part if chosen is None else chosen.unionAll(part)
    if chosen is None:
        return known.select("toxic", F.lit(0).cast("long").alias("by"), F.lit("").alias("text")), counts, {}
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sample = texts.join(F.broadcast(chosen), "id")  # at most fit_rows rows of two values
    return (sample.select("toxic", F.xxhash64(F.col("id").cast("string"), "text").alias("by"), "text"), counts,
            {k: min(n, most) for k, n in counts.items()})


def find_marks(sample: DataFrame) -> np.ndarray:
    """Sorted hashes of words and affixes that occur in toxic texts far more often than their share.

    A mark is counted once for each pair of neighbours in toxic texts, so copies of one text are no evidence,
    and for each occurrence in the others.
    """
    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, lengths in chunks(batch.column(0)):
                low = LOWER[data]
                found = tokens(low, lengths)
                hashes, has = affix_hashes(low, found, MARKS)
                around = mix(np.append(found.hash[1:], U(0)) + mix(np.insert(found.hash[:-1], 0, U(0)))) if len(found.hash) else found.hash
                around = np.repeat(around[:, None], hashes.shape[1], axis=1)
                pairs = np.unique(np.stack((hashes[has], around[has])), axis=1) if has.any() else np.zeros((2, 0), U)
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.ascontiguousarray(p))) for p in pairs], ["mark", "context"])

    toxic = sample.filter("toxic").select("text").mapInArrow(contexts, "mark long, context long").distinct()
    often = toxic.groupBy("mark").agg(F.count("*").alias("n")).filter(F.col("n") >= CONTEXTS).toArrow()  # of at most fit_rows texts
    marks = unsigned(often.column("mark").to_numpy()) if often.num_rows else np.zeros(0, U)
    order = np.argsort(marks)
    marks, in_toxic = marks[order], often.column("n").to_numpy()[order] if often.num_rows else np.zeros(0)

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, words = np.zeros(len(marks), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            toxic = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            for a, b, data, lengths in chunks(batch.column(1)):
                low = LOWER[data]
                found = tokens(low, lengths)
                words += np.bincount(toxic[a:b][found.doc].astype(int), minlength=2)
                clean = Tokens(*(x[~toxic[a:b][found.doc]] for x in found))
                hashes, has = affix_hashes(low, clean, MARKS)
                values = hashes[has]
                at = np.minimum(np.searchsorted(marks, values), max(len(marks) - 1, 0))
                if len(marks):
                    sums += np.bincount(at[marks[at] == values], minlength=len(marks))
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-2, -1], some))), pa.array(np.concatenate((words, sums[some])))], ["at", "n"])

    rows = sample.select("toxic", "text").mapInArrow(occurrences, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    seen = {r["at"]: r.n for r in rows}
    clean = np.zeros(len(marks))
    for at, n in seen.items():
        if at >= 0:
            clean[at] = n
    words_clean, words_toxic = float(seen.get(-2, 0)), float(seen.get(-1, 0))
    if not words_clean or not words_toxic:
        return marks[:0]
    total = in_toxic + clean
    part = words_toxic / (words_toxic + words_clean)
    ratio = in_toxic * np.log(np.maximum(in_toxic / (total * part), 1e-12)) + np.where(clean > 0, clean * np.log(np.maximum(clean, 1) / (total * (1 - part))), 0)
    lift = (in_toxic / words_toxic) / ((clean + 0.5) / words_clean)
    return marks[(ratio >= EVIDENCE) & (lift >= LIFT)]


def labelled_pieces(sample: DataFrame, marks: np.ndarray) -> tuple[list[list[str]], list[list[bool]]]:
    """Words with labels, from up to PIECES places of each text: a word of a toxic text that has a mark is toxic.

    Places are chosen by hash over the whole text, in a toxic one among its toxic words; one without any is left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            toxic = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            seeds = unsigned(batch.column(1).to_numpy(zero_copy_only=False))
            for a, b, data, lengths in chunks(batch.column(2)):
                low = LOWER[data]
                found = tokens(low, lengths)
                hashes, has = affix_hashes(low, found, MARKS)
                at = np.minimum(np.searchsorted(marks, hashes), len(marks) - 1)
                flag = ((marks[at] == hashes) & has).any(axis=1) & toxic[a:b][found.doc]
                cuts = np.searchsorted(found.doc, np.arange(len(lengths) + 1))
                for doc in range(len(lengths)):
                    low_word, high_word = cuts[doc], cuts[doc + 1]
                    places = np.flatnonzero(flag[low_word:high_word]) if toxic[a + doc] else np.arange(high_word - low_word)
                    if not len(places):
                        continue
                    for h in mix(np.arange(1, PIECES + 1, dtype=U) * U(0x9E3779B97F4A7C15) ^ seeds[a + doc]):
                        middle = low_word + int(places[int(h % U(len(places)))])
                        first = max(low_word, middle - int((h >> U(32)) % U(LENGTH)))
                        span = range(first, min(first + LENGTH, high_word))
                        texts = [low[found.start[i]:found.end[i]].tobytes() for i in span]
                        half = WORD_BYTES // 2
                        out[0].append([(t if len(t) <= WORD_BYTES else t[:half] + t[-half:]) for t in texts])
                        out[1].append(flag[first:span.stop].tolist())
                        out[2].append(int(h >> U(1)))
            yield pa.RecordBatch.from_arrays([pa.array(out[2], pa.int64()), pa.array(out[0], pa.list_(pa.binary())), pa.array(out[1], pa.list_(pa.bool_()))],
                                             ["by", "words", "flags"])

    table = sample.mapInArrow(run, "by long, words array<binary>, flags array<boolean>").toArrow()  # at most fit_rows * PIECES * LENGTH words
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("by", "words", "flags"))))
    # A word that was cut inside a character is mended so that it stays one word.
    return [[w.decode("utf-8", "replace") for w in r[1]] for r in rows], [r[2] for r in rows]


def train(docs: DataFrame, labels: DataFrame, fit_rows: int, folds: int, held_fold: int,
          id_col: str, text_col: str, label_col: str) -> tuple[Model | None, float]:
    """The model, None where there is nothing to learn, and the share of toxic training documents."""
    sample, counts, taken = _sample(docs, labels, fit_rows, folds, held_fold, id_col, text_col, label_col)
    base = counts.get(True, 0) / max(1, sum(counts.values()))
    if len(counts) < 2:
        return None, base
    marks = find_marks(sample)
    if not len(marks):
        return None, base
    model = fit(*labelled_pieces(sample, marks))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.zeros((0, 4))]
            for _, _, data, lengths in chunks(batch.column(1)):
                _, n, odds = tag(data, lengths, model)
                parts.append(document_features(odds, n))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, np.concatenate(parts).T.copy())], ["toxic", *"abcd"])

    rows = sample.select("toxic", "text").mapInArrow(features, "toxic boolean, a double, b double, c double, d double").collect()
    table = np.array(sorted(tuple(map(float, r)) for r in rows))  # the order of rows from Spark is not stable
    toxic = table[:, 0]
    # Each label counts as often as it is among all training documents.
    weight = np.where(toxic > 0, counts[True] / taken[True], counts[False] / taken[False])
    return model._replace(doc=_logistic(table[:, 1:], toxic, weight)), base


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, fit_rows: int = 8_000, folds: int = 5,
                   held_fold: int = 0, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` for each row of ``docs``.

    A linear-chain conditional random field tags the words of each whole text as toxic or not, from affixes and the word itself,
    with learned transitions; forward-backward gives each word's marginal. The score is a logistic function of the largest
    marginal, of the expected number of toxic words and of the length. ``spans`` are ``start, end, score`` of the runs of words with a marginal of
    one half or more, in code points, end exclusive, with the largest marginal.

    The labels are of documents; words are labelled from them: a word or affix that is far more frequent in toxic documents than
    in the others (by distinct neighbours, so copies do not count) is a mark, and words of toxic documents with a mark are toxic.
    Everything is learned from at most ``fit_rows`` labelled documents, the first of either label by hash of the id, whose
    crc32 of the id modulo ``folds`` is not ``held_fold``; all documents are scored, by their texts alone.

    Null and empty texts get the score of a text without words. Repeated labels of one id count as their largest, null ones
    not at all. Without both labels, or without marks, every score is the share of toxic training documents (0 without any).
    Rows are scored one by one, whatever their id.
    """
    model, base = train(docs, labels, fit_rows, folds, held_fold, id_col, text_col, label_col)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, spans = [], []
            for _, _, data, lengths in chunks(batch.column(1)):
                if model is None:
                    scores.append(np.full(len(lengths), base))
                    spans += [[]] * len(lengths)
                    continue
                found, counts, odds = tag(data, lengths, model)
                scores.append(1 / (1 + np.exp(-np.clip(document_features(odds, counts) @ model.doc, -30, 30))))
                spans += _spans(data, lengths, found, odds)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(scores or [np.zeros(0)])), pa.array(spans, span)],
                                             ["id", "score", "spans"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = plain.mapInArrow(run, f"id {dict(plain.dtypes)['id']}, score double, spans array<struct<start: int, end: int, score: double>>")
    return scored.select(F.col("id").alias(id_col), (remainder("id", folds) == held_fold).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")


def _spans(data: np.ndarray, lengths: np.ndarray, found: Tokens, odds: np.ndarray) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in lengths]
    hit = np.flatnonzero(odds >= 0)
    if not len(hit):
        return out
    point = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    begins = np.cumsum(lengths) - lengths
    new = np.concatenate(([True], (np.diff(hit) > 1) | (found.doc[hit[1:]] != found.doc[hit[:-1]])))
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(hit)) - 1
    best = 1 / (1 + np.exp(-np.clip(np.maximum.reduceat(odds[hit], firsts), -30, 30)))
    for a, b, score in zip(hit[firsts], hit[lasts], best.tolist()):
        doc = found.doc[a]
        base = point[begins[doc]]
        out[doc].append({"start": int(point[found.start[a]] - base), "end": int(point[found.end[b]] - base), "score": score})
    return out
