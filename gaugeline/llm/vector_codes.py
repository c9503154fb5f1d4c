"""Product codes of vectors in whole numbers; nearest entries are found by distances to fixed pivots."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize

#: Pivots of each part position, and parts that are worked on at once.
PIVOTS, BLOCK = 8, 4096
#: Candidates that are measured one after the other before what is left is measured together.
WAVES = 6


def component_limit(width: int) -> int:
    """The largest size of a component such that squared distances of ``width`` of them stay below 2^60."""
    return math.isqrt((1 << 60) // max(width, 1)) // 2


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


def pick_pivots(entries: np.ndarray) -> np.ndarray:
    """Up to PIVOTS entries far from each other: the first one, then always the one farthest from those picked."""
    if not len(entries):
        return entries
    picked, gap = [0], squared(entries, entries[:1])
    while len(picked) < min(PIVOTS, len(entries)):
        picked.append(int(gap.argmax()))
        gap = np.minimum(gap, squared(entries, entries[picked[-1:]]))
    return entries[picked]


def to_pivots(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to the pivots."""
    return np.sqrt(np.stack([squared(rows, p[None]) for p in pivots], axis=1).astype(float)) if len(pivots) else np.zeros((len(rows), 0))


def nearest(rows: np.ndarray, known: np.ndarray, entries: np.ndarray, entry_known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and exact squared distance of the nearest entry of each row, ties to the lower index.

    By the triangle inequality the distance of a row and an entry is at least the difference of their distances to any
    pivot (``known``, ``entry_known``). Entries are measured in the order of these bounds, and those whose bound exceeds the best
    distance so far are never measured.
    """
    best, index = np.full(len(rows), np.iinfo(np.int64).max), np.zeros(len(rows), np.int64)
    most = max(np.abs(rows).max(initial=0), np.abs(entries).max(initial=0))
    if rows.shape[1] * (2 * int(most)) ** 2 < 1 << 31:  # then 32 bits are exact too
        rows, entries = rows.astype(np.int32), entries.astype(np.int32)
    for low in range(0, len(rows) if len(entries) else 0, BLOCK):
        part, near = rows[low:low + BLOCK], known[low:low + BLOCK]
        bound = np.zeros((len(part), len(entries)), np.float32)
        for p in range(near.shape[1]):
            np.maximum(bound, np.abs(near[:, p, None] - entry_known[None, :, p]), out=bound)
        # Less what rounding to 24 bits may have added to either distance and to their difference.
        reach = near.max(axis=1, initial=0) + entry_known.max(initial=0)
        bound -= reach[:, None] * np.float32(2.0 ** -20) + np.float32(1e-6)
        own_best, own_index, live = best[low:low + BLOCK], index[low:low + BLOCK], np.arange(len(part))
        for _ in range(min(WAVES, len(entries))):
            entry = bound[live].argmin(axis=1)
            still = bound[live, entry] <= np.sqrt(own_best[live].astype(float))
            live, entry = live[still], entry[still]
            gap = squared(part[live], entries[entry])
            bound[live, entry] = np.inf
            better = (gap < own_best[live]) | ((gap == own_best[live]) & (entry < own_index[live]))
            own_best[live[better]], own_index[live[better]] = gap[better], entry[better]
        at, entry = np.nonzero(bound[live] <= np.sqrt(own_best[live].astype(float))[:, None])
        if len(at):  # of equal distances the first one in the row, so the lowest index, is found
            gaps = np.full((len(live), len(entries)), np.iinfo(np.int64).max)
            gaps[at, entry] = squared(part[live[at]], entries[entry])
            entry = gaps.argmin(axis=1)
            gap = gaps[np.arange(len(live)), entry]
            better = (gap < own_best[live]) | ((gap == own_best[live]) & (entry < own_index[live]))
            own_best[live[better]], own_index[live[better]] = gap[better], entry[better]
    return index, best


def _ints(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of 64-bit numbers as rows of ``width``."""
    blob = b"".join(column.to_pylist())
    return np.frombuffer(blob, np.int64).reshape(len(column), width) if width else np.zeros((len(column), 0), np.int64)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def encode(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024,
           id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` for each row with a finite vector.

    Components are floored multiples of ``1 / scale``. A vector is cut into ``parts`` equal parts, each of which gets the index, two
    hex digits, of the nearest entry of its position's codebook. A codebook starts as the parts of the ``entries`` smallest ids;
    each of ``rounds`` rounds replaces an entry by the floored mean of its parts. ``error`` is the squared distance to the
    entries in the end, ``label_error`` its sum over a label (null is one label), the hash that of all entries.

    The distances of each part to a few fixed pivots are found once and written beside it. In each round an entry's distances to the
    pivots bound its distance to a part from below; entries are measured by exact integers in the order of the bounds, and the rest is
    pruned. A round sends a sum per entry and task; only codebooks reach the driver.

    Rows whose vector is null or has a null, NaN or infinite component are dropped. A null id comes last; rows of one id follow
    each other by their components. A vector of another length than the first id's, of a length that ``parts`` does not
    divide, or with a component too large for exact 64-bit distances stays, with null code and error, and takes no part.
    Empty input gives an empty result.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hex digits")
    spark = vectors.sparkSession
    value = F.col("vector")
    wide = F.transform(value, lambda x: x.cast("double"))
    whole = value.isNotNull() & F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label"))
    rows = rows.filter(F.coalesce(whole, F.lit(False))).select("id", "label", wide.alias("vector"))
    kinds = dict(rows.dtypes)
    order = [F.col("id").asc_nulls_last(), F.col("vector")]

    first = rows.orderBy(*order).select(F.size("vector").alias("n")).head(1)
    length = first[0].n if first else 0
    usable_length = length % parts == 0
    width = length // parts
    limit = component_limit(width)
    usable = (F.size("vector") == length) & F.forall("vector", lambda x: F.abs(x) * scale < float(limit)) if usable_length else F.lit(False)
    start = rows.filter(usable).orderBy(*order).limit(entries).select("vector").collect()
    book = np.array([np.floor(np.array(r.vector) * scale) for r in start], np.int64).reshape(len(start), parts, width).transpose(1, 0, 2)
    book = np.ascontiguousarray(book)
    pivots = [pick_pivots(b) for b in book]
    n_pivots = len(pivots[0])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
            lists = batch.column(2).filter(pa.array(good))
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ints = np.floor(flat * scale).astype(np.int64).reshape(len(lists), parts, width)
            known = np.concatenate([to_pivots(ints[:, p], pivots[p]) for p in range(parts)], axis=1).astype(np.float32)
            numbers, gaps = np.full(batch.num_rows, None, object), np.full(batch.num_rows, None, object)
            numbers[good], gaps[good] = [r.tobytes() for r in ints], [r.tobytes() for r in known]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(numbers.tolist(), pa.binary()), pa.array(gaps.tolist(), pa.binary())],
                                             ["id", "label", "numbers", "pivots"])

    table = materialize(rows.withColumn("usable", usable).mapInArrow(
        measure, f"id {kinds['id']}, label {kinds['label']}, numbers binary, pivots binary"), "parts")

    def blocks(numbers: pa.Array, gaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        known = np.frombuffer(b"".join(gaps.to_pylist()), np.float32).reshape(len(gaps), parts, n_pivots)
        return _ints(numbers, parts * width).reshape(len(numbers), parts, width), known

    for _ in range(rounds):
        near = [to_pivots(b, p).astype(np.float32) for b, p in zip(book, pivots)]

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, counts = np.zeros(book.shape, np.int64), np.zeros(book.shape[:2], np.int64)
            for batch in batches:
                ints, known = blocks(batch.column(0), batch.column(1))
                for p in range(parts):
                    index, _ = nearest(ints[:, p], known[:, p], book[p], near[p])
                    np.add.at(sums[p], index, ints[:, p])
                    counts[p] += np.bincount(index, minlength=book.shape[1])
            part, entry = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]),
                                              pa.array(sums[part, entry].tolist(), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

        if not book.size:
            break
        found = table.filter("numbers IS NOT NULL").select("numbers", "pivots").mapInArrow(assign, "part int, entry int, n long, sums array<long>")
        # Sums may pass 64 bits; what a task sends does not.
        total = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
        book = book.copy()
        for row in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total).collect():
            book[row.part, row.entry] = [int(row[f"s{i}"]) // row.n for i in range(width)]

    near = [to_pivots(b, p).astype(np.float32) for b, p in zip(book, pivots)]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = batch.column(2).is_valid()
            ints, known = blocks(batch.column(2).filter(good), batch.column(3).filter(good))
            index, gap = np.zeros((len(ints), parts), np.uint8), np.zeros(len(ints), np.int64)
            for p in range(parts):
                found, gaps = nearest(ints[:, p], known[:, p], book[p], near[p])
                index[:, p] = found
                gap += gaps
            codes, errors = np.full(batch.num_rows, None, object), np.full(batch.num_rows, None, object)
            mask = good.to_numpy(zero_copy_only=False).astype(bool)
            codes[mask], errors[mask] = [r.tobytes().hex() for r in index], gap.tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes.tolist(), pa.string()), pa.array(errors.tolist(), pa.int64())],
                                             ["id", "label", "code", "error"])

    coded = materialize(table.mapInArrow(code, f"id {kinds['id']}, label {kinds['label']}, code string, error long"), "codes")
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _oracle(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The rounds one after the other, every distance measured."""
    nearest = """a{r} AS (SELECT vec_id, label, k, x, arg_min(entry, gap * {entries} + entry) AS entry, min(gap) AS gap FROM (
    SELECT p.vec_id, p.label, p.k, p.x, b.entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS gap
    FROM part p JOIN b{r} b USING (k)) GROUP BY ALL)"""
    replaced = """b{s} AS (SELECT k, entry, COALESCE(m.x, b.x) AS x FROM b{r} b LEFT JOIN (
    SELECT k, entry, list(c ORDER BY i) AS x FROM (SELECT k, entry, i, floor(SUM(x[i]) / COUNT(*))::BIGINT AS c
      FROM a{r}, (SELECT unnest(range(1, (SELECT MAX(len(x)) FROM part) + 1)) AS i) GROUP BY ALL) GROUP BY ALL) m USING (k, entry))"""
    steps = []
    for r in range(rounds):
        steps += [nearest.format(r=r, entries=entries), replaced.format(r=r, s=r + 1)]
    steps.append(nearest.format(r=rounds, entries=entries))
    return f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS (SELECT vec_id, label, k, v[k * (len(v) // {parts}) + 1 : (k + 1) * (len(v) // {parts})] AS x FROM kept, (SELECT unnest(range({parts})) AS k)),
b0 AS (SELECT k, ROW_NUMBER() OVER (PARTITION BY k ORDER BY vec_id) - 1 AS entry, x FROM part QUALIFY entry < {entries}),
{", ".join(steps)},
coded AS (SELECT vec_id, label, lower(string_agg(printf('%02x', entry), '' ORDER BY k)) AS code, SUM(gap)::BIGINT AS error FROM a{rounds} GROUP BY 1, 2)
SELECT vec_id, code, error, SUM(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY k, entry)) FROM b{rounds}) AS codebooks_sha256 FROM coded"""


ORACLE = _oracle()
