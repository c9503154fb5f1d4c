"""Quality classifier: random-indexing word vectors, pooled per document, and a small network with calibrated scores."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, chunks, mix, words

#: Length of a word vector, rows of the table that words are hashed to, and signs in an index vector.
DIM, ROWS, SIGNS = 48, 1 << 14, 6
HIDDEN, STEPS, BATCH, RATE, DECAY = 24, 1500, 256, 0.01, 1e-4


class Model(NamedTuple):
    vectors: np.ndarray  # of words, by hash
    center: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float


def index_signs() -> np.ndarray:
    """Sparse vectors of a few signs at places given by hash: the random index of each row, before its scale."""
    out = np.zeros((ROWS, DIM), np.int8)
    for i in range(SIGNS):
        h = mix(np.arange(ROWS, dtype=U) * U(SIGNS) + U(i + 1))
        out[np.arange(ROWS), (h % U(DIM)).astype(np.int64)] += np.where(h >> U(63), 1, -1).astype(np.int8)
    return out


def word_rows(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word its row, its text, and its shape: has it capitals, small letters, digits, symbols, a last capital, many bytes."""
    found = words(data, lengths)
    if not len(found.start):
        return np.zeros(0, np.int64), found.doc, np.zeros(0, np.int64)
    classes = np.full(256, 8, np.uint8)
    classes[65:91], classes[97:123], classes[48:58], classes[128:] = 1, 2, 4, 2
    classes[list(b"#*$%&|<>")] = 16
    shape = np.bitwise_or.reduceat(classes[data], found.start)  # up to the next word; separators have none of the bits
    shape = (shape.astype(np.int64) & 23) | ((classes[data[found.end - 1]] == 1) << 3) | (((found.end - found.start) > 12) << 5)
    return (found.hash % U(ROWS)).astype(np.int64), found.doc, shape


def add_contexts(sums: np.ndarray, index: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> None:
    """Add to the row of each word the index signs of its neighbours, next ones twice and those behind them once."""
    rows, doc, _ = word_rows(data, lengths)
    if not len(rows):
        return
    at = np.arange(len(rows)) + 2 * doc + 2  # two empty places between texts
    signs = np.zeros((at[-1] + 3, DIM), np.int8)
    signs[at] = index[rows]
    near = np.zeros_like(signs)  # at most 6 * SIGNS in size
    near[2:-2] = 2 * (signs[1:-3] + signs[3:-1]) + signs[:-4] + signs[4:]
    order = np.argsort(rows, kind="stable")
    own = rows[order]
    firsts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    sums[own[firsts]] += np.add.reduceat(near[at[order]], firsts, axis=0, dtype=np.int32)


def context_vectors(texts: DataFrame) -> np.ndarray:
    """Word vectors: a word's index vector plus the sum, to length one, of those of its neighbours in all ``text``.

    Tasks sum whole numbers, so the order of rows and partitions does not matter; only the merged table reaches the driver.
    """
    names = [f"v{i}" for i in range(DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, sums = index_signs(), np.zeros((ROWS, DIM), np.int64)
        for batch in batches:
            for _, _, data, lengths in chunks(batch.column(0)):
                add_contexts(sums, index, data, lengths)
        some = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32())] + [pa.array(c) for c in sums[some].T.copy()], ["row", *names])

    parts = texts.select("text").mapInArrow(run, "row int, " + ", ".join(f"{n} long" for n in names))
    table = parts.groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    out = np.zeros((ROWS, DIM))
    if table.num_rows:
        out[table.column("row").to_numpy()] = np.stack([table.column(n).to_numpy() for n in names], axis=1)
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return (index_signs() / np.sqrt(SIGNS) + out / np.maximum(size, 1e-6)).astype(np.float32)


def pool(data: np.ndarray, lengths: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Per text the mean word vector, its length, the mix of word shapes, repeated neighbours and the size."""
    docs = len(lengths)
    rows, doc, shape = word_rows(data, lengths)
    counts = np.bincount(doc, minlength=docs)
    out = np.zeros((docs, DIM + 64 + 4), np.float32)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    starts = (np.cumsum(counts) - counts)[some]
    pooled = np.add.reduceat(vectors[rows], starts, axis=0) / counts[some, None]
    out[some, :DIM] = pooled
    shapes = np.bincount(doc * 64 + shape, minlength=docs * 64).reshape(docs, 64)
    out[some, DIM:DIM + 64] = shapes[some] / counts[some, None]
    pairs = np.unique(doc.astype(np.int64) * ROWS + rows)
    distinct = np.bincount(pairs // ROWS, minlength=docs)
    repeat = np.bincount(doc[1:][(rows[1:] == rows[:-1]) & (doc[1:] == doc[:-1])], minlength=docs)
    out[some, -4] = np.linalg.norm(pooled, axis=1)
    out[some, -3] = distinct[some] / counts[some]
    out[some, -2] = repeat[some] / counts[some]
    out[some, -1] = np.log1p(counts[some])
    return out


def forward(model: Model, features: np.ndarray) -> np.ndarray:
    hidden = np.tanh(np.clip((features - model.center) / model.scale, -8, 8) @ model.w1 + model.b1)
    return hidden @ model.w2 + model.b2


def probability(model: Model, features: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(forward(model, features) / model.temperature, -30, 30)))


def fit(vectors: np.ndarray, features: np.ndarray, labels: np.ndarray, seed: int = 11) -> Model:
    """Two layers by Adam on four fifths of the rows; the temperature minimises the log loss of the others."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(labels))
    held, rows = order[:len(order) // 5], order[len(order) // 5:]
    center, scale = features[rows].mean(axis=0), features[rows].std(axis=0)
    scale = np.where(scale < 1e-3, 1, scale)
    width = features.shape[1]
    params = [rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    x, y = np.clip((features[rows] - center) / scale, -8, 8), labels[rows]
    for step in range(1, STEPS + 1):
        batch = rng.integers(0, len(y), BATCH)
        hidden = np.tanh(x[batch] @ params[0] + params[1])
        error = 1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3][0], -30, 30))) - y[batch]
        back = error[:, None] * params[2] * (1 - hidden ** 2) / BATCH
        slopes = [x[batch].T @ back + DECAY * params[0], back.sum(axis=0), hidden.T @ error / BATCH + DECAY * params[2], np.array([error.mean()])]
        for i, slope in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.999 * second[i] + 0.001 * slope ** 2
            rate = RATE * min(1, 2 * (1 - step / (STEPS + 1)))
            params[i] = params[i] - rate * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    model = Model(vectors, center, scale, params[0], params[1], params[2], float(params[3][0]), 1.0)
    if len(held):
        raw, target = forward(model, features[held]), labels[held]
        losses = {t: np.mean(np.logaddexp(0, raw / t) - target * raw / t) for t in np.geomspace(0.25, 8, 41)}
        model = model._replace(temperature=float(min(losses, key=losses.get)))
    return model


def remainder(id_col: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (a null id is the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def train(docs: DataFrame, labels: DataFrame, fit_rows: int, folds: int, held_fold: int,
          id_col: str, text_col: str, label_col: str) -> Model | None:
    """A model from at most ``fit_rows`` labelled documents outside the held-out fold; None without both labels."""
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .filter(remainder(id_col, folds) != held_fold)
             .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col)).cast("double").alias("label")))
    by, count = F.xxhash64(F.col("id").cast("string")), known.count()
    if count > fit_rows:  # so that no task has to order more than about fit_rows
        known = known.filter(F.pmod(by, F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.1 * fit_rows / count)))
    chosen = known.orderBy(F.pmod(by, F.lit(1 << 30)), "id").limit(fit_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sample = texts.join(F.broadcast(chosen), "id")  # at most fit_rows rows of two numbers

    if not count:
        return None
    vectors = context_vectors(texts)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [pool(data, lengths, vectors) for _, _, data, lengths in chunks(batch.column(0))]
            rows = np.concatenate(parts) if parts else np.zeros((0, DIM + 68), np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([r.tobytes() for r in rows], pa.binary())], ["label", "features"])

    rows = sample.select("text", "label").mapInArrow(features, "label double, features binary").collect()
    y = np.array([r.label for r in rows])
    if len(set(y.tolist())) < 2:
        return None
    x = np.stack([np.frombuffer(r.features, np.float32) for r in rows])
    order = np.lexsort((y, *x.T[-4:]))  # the order of rows from Spark is not stable
    return fit(vectors, x[order], (y[order] > 0).astype(float))


def _scores(column: pa.Array, model: Model | None) -> np.ndarray:
    if model is None:
        return np.full(len(column), 0.5)
    parts = [probability(model, pool(data, lengths, model.vectors)) for _, _, data, lengths in chunks(column)]
    return np.concatenate(parts).astype(float) if parts else np.zeros(0)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fit_rows: int = 8_000,
                  folds: int = 5, held_fold: int = 0, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    Word vectors are random indexes: each word has a sparse vector of signs given by its hash, to which those of
    its neighbours in the texts of all rows are added, summed by Spark. A text is the mean of its words' vectors, with the mix of
    word shapes; two layers of numpy and a temperature give the probability of label 1.

    The network learns from at most ``fit_rows`` labelled documents, the first by hash of the id, whose crc32 of the id
    modulo ``folds`` is not ``held_fold``; all documents are scored over their whole texts, from the text alone.
    Null and empty texts get the score of a text without words. Repeated labels of one id count as their largest,
    null ones not at all; without labels of both kinds every score is 0.5. Rows are scored one by one, whatever their id.
    """
    model = train(docs, labels, fit_rows, folds, held_fold, id_col, text_col, label_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(batch.column(1), model))], ["id", "score"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = plain.mapInArrow(run, f"id {dict(plain.dtypes)['id']}, score double")
    return scored.select(F.col("id").alias(id_col), (remainder("id", folds) == held_fold).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fit_rows: int = 8_000,
                 folds: int = 5, held_fold: int = 0, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "quality") -> DataFrame:
    """The rows of ``docs``, all columns, that ``score_quality`` gives at least ``threshold``."""
    model = train(docs, labels, fit_rows, folds, held_fold, id_col, text_col, label_col)
    position = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column(position), model) >= threshold))

    return docs.mapInArrow(run, docs.schema)
