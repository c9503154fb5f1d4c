"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted arrays that workers memory-map."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, chunks, mix, signed, words
from .quality_model import remainder
from .shared import materialize, shared_folder

#: Tokens that a task combines before it sends them, and tokens for each part of the model; about so many
#: documents, and pairs of them thinned by hash, give the splits.
FLUSH, PART_TOKENS = 4_000_000, 3_000_000
SAMPLE_DOCS, SAMPLE = 2_000, 20_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Discounts(NamedTuple):
    """What is taken off counts of 1, 2, and 3 or more."""

    one: float
    two: float
    more: float

    def of(self, counts: np.ndarray) -> np.ndarray:
        return np.array([0, self.one, self.two, self.more])[np.minimum(counts, 3)]


def discounts(n: list[int]) -> Discounts:
    """From the numbers of n-grams seen 1, 2, 3 and 4 times (Chen and Goodman 1999), within (0, 1], (0, 2], (0, 3]."""
    n1, n2, n3, n4 = (max(x, 0) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return Discounts(*(min(max(d, 0.05), most) for d, most in zip(raw, (1, 2, 3))))


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = uri[5:] if not uri.startswith("file://") else uri[7:]
    return fs.FileSystem.from_uri(uri)


def write_array(uri: str, values: np.ndarray) -> None:
    """Write beside, then rename: a task that runs twice leaves one whole file."""
    store, path = _open(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    beside = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(beside) as out:
        out.write(np.ascontiguousarray(values).tobytes())
    store.move(beside, path)


def read_array(uri: str, kind: type) -> np.ndarray:
    """Memory-mapped where the shared folder is mounted, else read."""
    store, path = _open(uri)
    if not store.get_file_info(path).size:
        return np.zeros(0, kind)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with store.open_input_file(path) as source:
        return np.frombuffer(source.read(), kind)


def write_counts(uri: str, counts: np.ndarray) -> None:
    """In 32 bits where all counts of the part fit, else in 64; the size of the file tells."""
    write_array(uri, counts.astype(np.uint32 if counts.max(initial=0) < 1 << 32 else np.int64))


def read_counts(uri: str, n: int) -> np.ndarray:
    store, path = _open(uri)
    return read_array(uri, np.int64 if n and store.get_file_info(path).size == 8 * n else np.uint32)


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences, and counts, byte planes apart so that Spark's compression takes out the zeros."""
    steps = np.diff(keys, prepend=U(0)).astype(U)
    planes = steps.view(np.uint8).reshape(-1, 8).T
    return np.array([len(keys)], np.int64).tobytes() + planes.tobytes() + counts.astype(U).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    planes = np.frombuffer(blob, np.uint8, 8 * n, 8).reshape(8, n)
    counts = np.frombuffer(blob, np.uint8, 8 * n, 8 + 8 * n).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(U).ravel(), dtype=U), np.ascontiguousarray(counts.T).view(np.int64).ravel()


def merge(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their summed counts."""
    if not blobs:
        return np.zeros(0, U), np.zeros(0, np.int64)
    parts = [unpack(b) for b in blobs]
    return sum_by(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))


def sum_by(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    firsts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[firsts], np.add.reduceat(counts, firsts)


def count_of_counts(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


class Model(NamedTuple):
    """Where the arrays lie and the numbers that go with them. Ids: words by hash, then the end, then the start."""

    folder: str
    word_parts: list[int]  # words in each part of the vocabulary, dealt by the top bits of the hash
    pair_splits: np.ndarray  # least keys of the parts 1, 2, ... of the pairs
    id_parts: int
    train_tokens: int
    ends: int
    pair: Discounts
    single: Discounts
    single_total: int  # distinct pairs
    single_mass: float  # what the discounts leave for unseen words

    @property
    def words(self) -> int:
        return sum(self.word_parts)

    @property
    def distinct(self) -> int:
        return self.words + (self.ends > 0)


def part_of_hash(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> U(32)) * U(parts) >> U(32)).astype(np.int64)


class Arrays:
    """The open arrays of a model in one worker."""

    def __init__(self, model: Model):
        self.model = model
        self.base = np.concatenate(([0], np.cumsum(model.word_parts)))
        self.hashes = [read_array(f"{model.folder}/words/{p}", U) for p in range(len(model.word_parts))]
        self.counts = [read_counts(f"{model.folder}/word-counts/{p}", len(own)) for p, own in enumerate(self.hashes)]

    def open_pairs(self) -> Arrays:
        model = self.model
        self.pairs = [read_array(f"{model.folder}/pairs/{p}", U) for p in range(len(model.pair_splits) + 1)]
        self.pair_counts = [read_counts(f"{model.folder}/pair-counts/{p}", len(own)) for p, own in enumerate(self.pairs)]
        self.stats = [read_array(f"{model.folder}/stats/{p}", np.int64).reshape(5, -1) for p in range(model.id_parts)]
        return self

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id of each word (-1: unknown) and its count in training."""
        parts = len(self.hashes)
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        known, back = np.unique(hashes, return_inverse=True)
        cuts = np.searchsorted(part_of_hash(known, parts), np.arange(parts + 1))
        found, seen = np.full(len(known), -1, np.int64), np.zeros(len(known), np.int64)
        for p in range(parts):
            low, high = cuts[p], cuts[p + 1]
            own = self.hashes[p]
            if high > low and len(own):
                at = np.minimum(np.searchsorted(own, known[low:high]), len(own) - 1)
                hit = own[at] == known[low:high]
                found[low:high][hit] = self.base[p] + at[hit]
                seen[low:high][hit] = self.counts[p][at[hit]]
        ids[:], counts[:] = found[back], seen[back]
        return ids, counts

    def pair_count(self, keys: np.ndarray) -> np.ndarray:
        """Training counts of sorted distinct pairs."""
        out = np.zeros(len(keys), np.int64)
        cuts = np.concatenate(([0], np.searchsorted(keys, self.model.pair_splits), [len(keys)]))
        for p, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
            own = self.pairs[p]
            if high > low and len(own):
                at = np.minimum(np.searchsorted(own, keys[low:high]), len(own) - 1)
                hit = own[at] == keys[low:high]
                out[low:high][hit] = self.pair_counts[p][at[hit]]
        return out

    def stat(self, ids: np.ndarray) -> np.ndarray:
        """For sorted ids: pairs that begin so (all, seen once, twice, oftener) and distinct pairs that end so."""
        out = np.zeros((5, len(ids)), np.int64)
        parts, size = self.model.id_parts, id_part_size(self.model.words, self.model.id_parts)
        cuts = np.searchsorted(ids, np.arange(parts + 1) * size)
        for p, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
            if high > low:
                out[:, low:high] = self.stats[p][:, ids[low:high] - p * size]
        return out


def id_part_size(n_words: int, parts: int) -> int:
    return -(-(n_words + 2) // parts)


def _tokens(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the lower-cased words and the number of words of each text, about ``limit`` words at a time."""
    hashes, counts, size = [], [], 0
    for batch in batches:
        for _, _, data, lengths in chunks(batch.column(0)):
            found = words(_LOWER[data], lengths)
            hashes.append(found.hash)
            counts.append(found.per_doc(len(lengths)))
            size += len(found.hash)
            if size >= limit:
                yield np.concatenate(hashes), np.concatenate(counts)
                hashes, counts, size = [], [], 0
    if counts:
        yield np.concatenate(hashes), np.concatenate(counts)


def _pairs(hashes: np.ndarray, counts: np.ndarray, arrays: Arrays) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and second id of every pair, the start before and the end after each text, and counts of the second."""
    model = arrays.model
    ids, seen = arrays.ids(hashes)
    ends = np.cumsum(counts + 1) - 1
    second, known = np.empty(len(ids) + len(counts), np.int64), np.empty(len(ids) + len(counts), np.int64)
    word = np.ones(len(second), bool)
    word[ends] = False
    second[word], second[~word] = ids, model.words
    known[word], known[~word] = seen, model.ends
    first = np.empty_like(second)
    first[1:] = second[:-1]
    first[np.concatenate(([0], ends[:-1] + 1))] = model.words + 1
    return first, second, known


def _blobs(part: np.ndarray, keys: np.ndarray, counts: np.ndarray, parts: int, kind: int) -> pa.RecordBatch:
    """Sorted keys, whose parts ascend too, as one packed row for each part."""
    cuts = np.searchsorted(part, np.arange(parts + 1))
    rows = [p for p in range(parts) if cuts[p + 1] > cuts[p]]
    return pa.RecordBatch.from_arrays(
        [pa.array(rows, pa.int32()), pa.array([kind] * len(rows), pa.int32()),
         pa.array([pack(keys[cuts[p]:cuts[p + 1]], counts[cuts[p]:cuts[p + 1]]) for p in rows], pa.binary())], ["part", "kind", "packed"])


BLOB = "part int, kind int, packed binary"


def _collected(batches: Iterator[pa.RecordBatch]) -> dict[tuple[int, int], list[bytes]]:
    out: dict[tuple[int, int], list[bytes]] = {}
    for batch in batches:
        for part, kind, blob in zip(*(batch.column(c).to_pylist() for c in range(3))):
            out.setdefault((part, kind), []).append(blob)
    return out


def train(texts: DataFrame, folder: str) -> Model:
    """Count the words and pairs of ``texts (text)`` and write the arrays into ``folder``."""
    spark = texts.sparkSession
    docs, size = texts.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // (6 * PART_TOKENS)))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, _ in _tokens(batches, FLUSH):
            keys, counts = np.unique(hashes, return_counts=True)
            yield _blobs(part_of_hash(keys, parts), keys, counts, parts, 0)

    def write_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, _), blobs in _collected(batches).items():
            keys, counts = merge(blobs)
            write_array(f"{folder}/words/{part}", keys)
            write_counts(f"{folder}/word-counts/{part}", counts)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(keys)]), pa.array([int(counts.sum())])], ["part", "words", "tokens"])

    rows = texts.mapInArrow(count_words, BLOB).repartitionById(parts, "part").mapInArrow(write_words, "part int, words long, tokens long").collect()
    sizes = {r.part: r.words for r in rows}
    for part in set(range(parts)) - set(sizes):
        write_array(f"{folder}/words/{part}", np.zeros(0, U))
        write_array(f"{folder}/word-counts/{part}", np.zeros(0, np.uint32))
    model = Model(folder, [sizes.get(p, 0) for p in range(parts)], np.zeros(0, U), parts, sum(r.tokens for r in rows) + docs, docs,
                  Discounts(0, 0, 0), Discounts(0, 0, 0), 0, 1.0)
    if model.words + 2 >= 1 << 32:
        raise ValueError("a pair of ids must fit into 64 bits")

    def keys_of(arrays: Arrays, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        first, second, _ = _pairs(hashes, counts, arrays)
        return (first.astype(U) << U(32)) | second.astype(U)

    thin = U(max(1, round(min(docs, SAMPLE_DOCS) * model.train_tokens / max(docs, 1) / SAMPLE)))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = Arrays(model)
        for hashes, counts in _tokens(batches, FLUSH):
            keys = np.unique(keys_of(arrays, hashes, counts))
            yield pa.RecordBatch.from_arrays([pa.array(signed(keys[mix(keys) % thin == 0]))], ["key"])

    some = texts if docs <= SAMPLE_DOCS else texts.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int((1 << 30) * SAMPLE_DOCS / docs))
    drawn = some.mapInArrow(sample, "key long").collect()
    drawn = sorted(r.key % (1 << 64) for r in drawn)
    splits = np.array(sorted({drawn[i * len(drawn) // parts] for i in range(1, parts)}) if drawn else [], U)
    model = model._replace(pair_splits=splits)
    id_size = id_part_size(model.words, parts)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = Arrays(model)
        for hashes, counts in _tokens(batches, FLUSH):
            keys, found = np.unique(keys_of(arrays, hashes, counts), return_counts=True)
            yield _blobs(np.searchsorted(splits, keys, "right"), keys, found, len(splits) + 1, 0)

    def write_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Also sends, by id: how pairs begin (kinds 0 to 3) and how many end so (4); kind 5 has the counts of counts."""
        for (part, _), blobs in _collected(batches).items():
            keys, counts = merge(blobs)
            write_array(f"{folder}/pairs/{part}", keys)
            write_counts(f"{folder}/pair-counts/{part}", counts)
            first, second = keys >> U(32), keys & U(0xFFFFFFFF)
            for kind in range(5):
                chosen = slice(None) if kind in (0, 4) else counts == kind if kind < 3 else counts >= 3
                ids, values = sum_by((second if kind == 4 else first)[chosen], counts if kind == 0 else np.ones(len(counts), np.int64)[chosen])
                yield _blobs((ids // U(id_size)).astype(np.int64), ids, values, parts, kind)
            yield _blobs(np.zeros(5, np.int64), np.arange(5, dtype=U), np.array([*count_of_counts(counts), len(keys)]), 1, 5)

    sent = texts.mapInArrow(count_pairs, BLOB).repartitionById(len(splits) + 1, "part").mapInArrow(write_pairs, BLOB)
    sent = materialize(sent, "pair-stats")
    for part in range(len(splits) + 1):
        store, path = _open(f"{folder}/pairs/{part}")
        if store.get_file_info(path).type == fs.FileType.NotFound:
            write_array(f"{folder}/pairs/{part}", np.zeros(0, U))
            write_array(f"{folder}/pair-counts/{part}", np.zeros(0, np.uint32))
    totals = merge([bytes(r.packed) for r in sent.filter("kind = 5").select("packed").toLocalIterator()])[1].tolist() or [0] * 5

    def write_stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _collected(batches)
        for part in sorted({p for p, _ in found}):
            stats = np.zeros((5, id_size), np.int64)
            for kind in range(5):
                ids, values = merge(found.get((part, kind), []))
                stats[kind, ids.astype(np.int64) - part * id_size] = values
            write_array(f"{folder}/stats/{part}", stats)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([count_of_counts(stats[4]) + [int((stats[4] > 2).sum())]], pa.list_(pa.int64()))],
                                             ["part", "counts"])

    rows = sent.filter("kind < 5").repartitionById(parts, "part").mapInArrow(write_stats, "part int, counts array<long>").collect()
    for part in set(range(parts)) - {r.part for r in rows}:
        write_array(f"{folder}/stats/{part}", np.zeros((5, id_size), np.int64))
    ending = np.array([r.counts for r in rows]).sum(axis=0).tolist() if rows else [0] * 5
    single = discounts(ending[:4])
    left = single.one * ending[0] + single.two * ending[1] + single.more * ending[4]
    return model._replace(pair=discounts(totals[:4]), single=single, single_total=totals[4], single_mass=left / totals[4] if totals[4] else 1.0)


def log_probabilities(arrays: Arrays, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per text: number of tokens, known tokens, log10 probability by smoothed frequency and by the model."""
    model = arrays.model
    first, second, seen = _pairs(hashes, counts, arrays)
    owner = np.repeat(np.arange(len(counts)), counts + 1)
    base = np.log10((seen + 0.5) / (model.train_tokens + 0.5 * (model.distinct + 1)))

    ids, back = np.unique(second, return_inverse=True)
    known = ids >= 0
    ending = np.zeros(len(ids), np.int64)
    ending[known] = arrays.stat(ids[known])[4]
    single = np.full(len(ids), model.single_mass / (model.distinct + 1))
    if model.single_total:
        single += (ending - model.single.of(ending)) / model.single_total
    single = single[back]

    ids, back = np.unique(first, return_inverse=True)
    known = ids >= 0
    begin = np.zeros((4, len(ids)), np.int64)
    begin[:, known] = arrays.stat(ids[known])[:4]
    total = begin[0]
    weight = np.where(total > 0, (model.pair.one * begin[1] + model.pair.two * begin[2] + model.pair.more * begin[3]) / np.maximum(total, 1), 1.0)
    total, weight = total[back], weight[back]

    pair = np.zeros(len(second), np.int64)
    rows = np.flatnonzero((first >= 0) & (second >= 0))
    keys, back = np.unique((first[rows].astype(U) << U(32)) | second[rows].astype(U), return_inverse=True)
    pair[rows] = arrays.pair_count(keys)[back]
    chance = (pair - model.pair.of(pair)) / np.maximum(total, 1) + weight * single
    n = len(counts)
    return (counts + 1, np.bincount(owner[seen > 0], minlength=n), np.bincount(owner, base, n), np.bincount(owner, np.log10(chance), n))


def score_texts(docs: DataFrame, folds: int = 5, held_fold: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row of ``docs``.

    Tokens are the words, with A-Z as a-z, and one end. The model is an interpolated modified Kneser-Ney bigram model of all
    documents whose crc32 of the id modulo ``folds`` is not ``held_fold``: P(w|v) from the discounted count of the pair,
    backed by P(w) from the number of distinct words before w, backed by the same chance for every word. Spark counts words,
    then pairs of word ids; each task combines its own before it sends them in sorted, packed parts. The parts of
    the model, sorted arrays in the shared folder, are memory-mapped by the workers that score. Splits of the pairs are
    sampled, so a frequent word's pairs are spread over parts. ``score`` and ``base_score`` are log10 probabilities of the whole
    text, ``base_score`` by smoothed frequency alone. Perplexity is 10 ** (-score / n_tokens).

    Null and empty texts are one end. Rows count and are scored one by one, whatever their id. Without training
    documents every token is equally unlikely. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    held = remainder(id_col, folds) == held_fold
    folder = f"{shared_folder(docs.sparkSession)}/model-{uuid.uuid4().hex[:12]}"
    model = train(docs.filter(~held).select(text), folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = Arrays(model).open_pairs()
        for batch in batches:
            parts = []
            for _, _, data, lengths in chunks(batch.column(0), 4 << 20):
                found = words(_LOWER[data], lengths)
                parts.append(log_probabilities(arrays, found.hash, found.per_doc(len(lengths))))
            cols = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0)] * 4
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                              pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64())],
                                             ["id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    plain = docs.select(text, F.col(id_col).alias("id"), held.alias("held_out"))
    schema = f"id {dict(plain.dtypes)['id']}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    scored = plain.mapInArrow(run, schema).withColumn("train_tokens", F.lit(model.train_tokens).cast("long"))
    return scored.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
