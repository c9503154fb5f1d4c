"""Importance resampling towards a target: hashed word n-grams, whose CRCs come from running CRCs of the text."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import ALNUM, LOWER, Kept, chunks, word_bounds
from .shared import materialize

#: Reversed polynomial of CRC-32, and bytes that a lane of the running CRCs has.
POLYNOMIAL, LANE = 0xEDB88320, 512
_ONES = np.uint32(0xFFFFFFFF)
_SHIFTS = Kept()


def _byte_table() -> np.ndarray:
    """What a byte of the register becomes when it is shifted out."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_TABLE = _byte_table()


def _tables_of(images: np.ndarray) -> np.ndarray:
    """Four tables, by byte, of the GF(2)-linear map with these images of the 32 bits."""
    out = np.zeros((4, 256), np.uint32)
    values = np.arange(256)
    for bit in range(32):
        out[bit // 8] ^= np.where(values >> (bit % 8) & 1, images[bit], np.uint32(0)).astype(np.uint32)
    return out


def _apply(tables: np.ndarray, register: np.ndarray) -> np.ndarray:
    return (tables[0][register & 255] ^ tables[1][register >> 8 & 255] ^ tables[2][register >> 16 & 255] ^ tables[3][register >> 24])


def _shift_tables(power: int) -> np.ndarray:
    """The map of a register over ``2 ** power`` zero bytes, by squaring that of half as many."""
    if power not in _SHIFTS:
        bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
        if power == 0:
            images = _TABLE[bits & 255] ^ (bits >> 8)
        else:
            half = _shift_tables(power - 1)
            images = _apply(half, _apply(half, bits))
        _SHIFTS[power] = _tables_of(images)
    return _SHIFTS[power]


def shift(register: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Each register moved over its ``size`` in zero bytes: one map for each binary digit of the sizes."""
    out, left, power = register.copy(), size.copy(), 0
    while left.any():
        rows = np.flatnonzero(left & 1)
        if len(rows):
            out[rows] = _apply(_shift_tables(power), out[rows])
        left >>= 1
        power += 1
    return out


def running_crcs(data: np.ndarray) -> np.ndarray:
    """Registers, started at 0, before each byte and after the last: lanes of the text advance side by side, then each
    takes over what the lanes before it left."""
    lanes = max(1, -(-len(data) // LANE))
    padded = np.zeros(lanes * LANE, np.uint8)
    padded[:len(data)] = data
    columns = np.ascontiguousarray(padded.reshape(lanes, LANE).T)
    own = np.empty((LANE, lanes), np.uint32)
    register = np.zeros(lanes, np.uint32)
    for i in range(LANE):
        register = _TABLE[(register ^ columns[i]) & 255] ^ (register >> 8)
        own[i] = register
    tables, carried, left = [t.tolist() for t in _shift_tables(LANE.bit_length() - 1)], np.empty(lanes, np.uint32), 0
    for lane, total in enumerate(register.tolist()):
        carried[lane] = left
        left = tables[0][left & 255] ^ tables[1][left >> 8 & 255] ^ tables[2][left >> 16 & 255] ^ tables[3][left >> 24] ^ total
    for i in range(LANE):
        carried = _TABLE[carried & 255] ^ (carried >> 8)
        own[i] ^= carried
    return np.concatenate((np.zeros(1, np.uint32), own.T.ravel()[:len(data)]))


def substring_crcs(running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each substring: the later register without what the earlier one, shifted over the substring, put into it."""
    return running[end] ^ shift(running[start] ^ _ONES, end - start) ^ _ONES


def normalised(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words, each followed by one space, with their starts, ends and texts."""
    low = LOWER[data]
    inside = ALNUM[low]
    start, end, doc = word_bounds(inside, lengths)
    size = end - start
    at = np.cumsum(size + 1) - size - 1
    out = np.full(int((size + 1).sum()), 0x20, np.uint8)
    out[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = low[inside]
    return out, at, at + size, doc


def feature_buckets(data: np.ndarray, lengths: np.ndarray, least: int, most: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text of each run of ``least`` to ``most`` words, and the words of each text."""
    text, start, end, doc = normalised(data, lengths)
    running = running_crcs(text)
    found, owner = [], []
    for k in range(least, most + 1):
        n = max(0, len(start) - k + 1)
        whole = np.flatnonzero(doc[:n] == doc[k - 1:k - 1 + n])
        found.append(substring_crcs(running, start[whole], end[whole + k - 1]) % np.uint32(buckets))
        owner.append(doc[whole])
    return np.concatenate(found).astype(np.int64), np.concatenate(owner), np.bincount(doc, minlength=len(lengths))


def bucket_counts(texts: DataFrame, least: int, most: int, buckets: int) -> np.ndarray:
    """Features of all ``text`` by bucket; tasks send one sum per bucket, and ``buckets`` numbers reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, lengths in chunks(batch.column(0)):
                sums += np.bincount(feature_buckets(data, lengths, least, most, buckets)[0], minlength=buckets)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(sums[some])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares of each bucket, floored."""
    n, t, s = len(source), float(target.sum()), float(source.sum())
    return np.array([math.floor(1000 * math.log((a + 1.0) * (s + n) / ((b + 1.0) * (t + n)))) for a, b in zip(target.tolist(), source.tolist())], np.int64)


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, least: int = 1, most: int = 1,
             buckets: int = 10_000, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` for each row of ``docs``.

    Features are all runs of ``least`` to ``most`` lower-cased words, in buckets by the CRC-32 of their bytes. The weight of a document is
    the sum, over its features, of the log ratio of a bucket's share in ``target`` and in ``docs``, in floored thousandths; the score adds
    Gumbel noise from a hash of ``seed`` and the id, so the highest scores are a draw without replacement by weight. Of the documents with
    ``min_words`` words, ``percent`` per cent are drawn; ``rank`` is their place, null for all others.

    Each text is normalised to words and single spaces and read once, with a running CRC at every byte; the CRC of
    any run of words follows from two of them, whatever its length.

    Null and empty texts have no features and weight 0. Rows are scored one by one; a null id counts as the empty text and
    comes last among ties, rows that tie in all columns get ranks in any order. An empty target or table is no error.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    own = bucket_counts(texts.select("text"), least, most, buckets)
    table = gains(bucket_counts(target.select(F.col(target_col).cast("string")), least, most, buckets), own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.zeros((3, 0), np.int64)]
            for _, _, data, lengths in chunks(batch.column(1)):
                found, owner, n_words = feature_buckets(data, lengths, least, most, buckets)
                sums = np.zeros(len(lengths), np.int64)
                np.add.at(sums, owner, table[found])
                parts.append(np.stack((n_words, np.bincount(owner, minlength=len(lengths)), sums)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, np.concatenate(parts, axis=1))], ["id", "n_words", "n_features", "weight"])

    kind = dict(texts.dtypes)["id"]
    weighed = texts.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)
    noise = F.floor(-1000 * F.ln(-F.ln(uniform)))
    scored = weighed.withColumns({"score": (F.col("weight") + noise).cast("long"), "_enough": F.col("n_words") >= min_words})

    # A total order over ranges of the small rows; the place in a range and the rows before it give the rank.
    order = [F.col("_enough").desc(), F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_words"), F.col("n_features"), F.col("weight")]
    ordered = materialize(scored, "weights").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(ordered.withColumn("_at", F.monotonically_increasing_id()), "ranks")
    part = F.shiftrightunsigned("_at", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.count_if("_enough").alias("enough")).orderBy("part").collect()
    before, rows = 0, []
    for row in sizes:  # one for each partition of the shuffle
        rows.append((row.part, before))
        before += row.n
    drawn = sum(row.enough for row in sizes) * percent // 100
    offsets = docs.sparkSession.createDataFrame(rows, "_part long, _before long")
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    ranked = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("rank", F.when(place <= drawn, place))
    return ranked.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", "rank")


ORACLE = """
WITH shape AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS large, 'abcdefghijklmnopqrstuvwxyz' AS small, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+' AS word),
crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps),
doc_words AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, large, small), word)) AS w FROM documents, shape),
item_words AS (SELECT unnest(regexp_extract_all(translate(text, large, small), word)) AS w FROM benchmark, shape),
spelled AS (SELECT w, hex(encode(w)) AS digits FROM (SELECT w FROM doc_words UNION SELECT w FROM item_words)),
coded AS (SELECT w, list_transform(range(1, strlen(w) + 1), lambda i: (instr('0123456789ABCDEF', substr(digits, 2 * i - 1, 1)) - 1) * 16
    + instr('0123456789ABCDEF', substr(digits, 2 * i, 1)) - 1) AS code FROM spelled),
hashed AS (SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295, code),
    lambda c, b: xor(c // 256, steps[(xor(c, b) % 256) + 1]))) % 10000 AS bucket FROM coded, crc),
s AS (SELECT bucket, COUNT(*) AS n FROM doc_words JOIN hashed USING (w) GROUP BY 1),
t AS (SELECT bucket, COUNT(*) AS n FROM item_words JOIN hashed USING (w) GROUP BY 1),
gain AS (SELECT b.bucket, floor(1000 * ln((COALESCE(t.n, 0) + 1)::DOUBLE * ((SELECT COALESCE(SUM(n), 0) FROM s) + 10000)::DOUBLE
      / ((COALESCE(s.n, 0) + 1)::DOUBLE * ((SELECT COALESCE(SUM(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
    FROM (SELECT unnest(range(10000)) AS bucket) b LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
sums AS (SELECT doc_id, COUNT(*) AS n_features, SUM(gain)::BIGINT AS weight FROM doc_words JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY 1),
scored AS (SELECT d.doc_id, COALESCE(n_features, 0)::BIGINT AS n_features, COALESCE(weight, 0)::BIGINT AS weight,
    (COALESCE(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
    FROM documents d LEFT JOIN sums USING (doc_id)),
placed AS (SELECT doc_id, ROW_NUMBER() OVER (ORDER BY score DESC, doc_id) AS place, COUNT(*) OVER () * 10 // 100 AS drawn FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END::BIGINT AS rank FROM scored LEFT JOIN placed USING (doc_id)"""
