"""Mix sources to target weights by hash thresholds, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Sources are broadcast up to so many bytes; the other columns of a row take ROW_BYTES at most.
BROADCAST_BYTES, ROW_BYTES = 8 << 20, 200
#: Hash digits (4 bits each) by which one histogram is finer than the one before, and in all.
STEP, DIGITS = 3, 15


def source_targets(sized: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """One row per source: ``source, source_size, target, full`` (whole copies) and ``rest`` (words of one more).

    Sources by code point, null last, weigh ``weights``, repeated. They share ``share`` times all words by weight,
    none above ``cap`` times its own size. With r = limit / weight in ascending order, the sources
    below the level are a prefix, so the level follows from running sums over one row per source.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    values = F.array(*[F.lit(int(w)) for w in weights])
    ranked = sums.withColumn("w", F.element_at(values, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    filled = (
        ranked
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("before", F.sum("most").over(by_level) - F.col("most"))
        .withColumn("weight_left", F.sum("w").over(everything) - F.sum("w").over(by_level) + F.col("w"))
        .withColumn("level", (F.col("budget") - F.col("before")) / F.col("weight_left"))
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("most") / F.col("w"), F.col("level"))).over(everything))
    )
    target = F.when(F.col("level").isNull(), F.col("most")).otherwise(F.least("most", F.col("level") * F.col("w")))
    return (
        filled.withColumn("target", target)
        .withColumn("full", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.col("target") - F.col("full") * F.col("source_size"))
        .select("source", "source_size", "target", "full", "rest")
    )


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
                seed: str = "", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` for each row of ``docs``.

    A source whose target is above its size takes each document ``full`` times and those with a hash below
    a threshold once more. Histograms of words by source and hash bucket find the threshold: each refines only
    the bucket in which the one before passed the budget, until the last of the 60 hash bits. Documents
    below the threshold are taken, the one at it if that comes nearer to the target.

    Null or empty texts have size 0. Rows without a source are a source. Rows equal in id, source and
    text share a hash, so all or none are taken once more. An empty table gives an empty result.
    """
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("-")),
                               F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))))
    sized = materialize(docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.substring(digest, 1, DIGITS).alias("hash"),
    ), "sizes")
    sources = materialize(source_targets(sized, weights, share, cap), "sources")

    # One row per source: if these are small, they go to the documents, so a hot source is not gathered; beyond
    # the bound the join shuffles and adaptive execution splits a hot source.
    bytes_ = sources.agg(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + ROW_BYTES)).first()[0] or 0

    def join_source(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed("source", "_source")
        right = F.broadcast(right) if bytes_ <= BROADCAST_BYTES else right
        return left.join(right, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    # at: the digits of the bucket in which the budget is passed; base: the words in all buckets before it.
    edge = sources.filter("rest > 0").select("source", "rest", F.lit("").alias("at"), F.lit(0).cast("long").alias("base"))
    by_bucket = Window.partitionBy("source").orderBy("bucket")
    for digits in range(STEP, DIGITS + 1, STEP):
        inside = join_source(sized.filter("size > 0"), edge).filter(F.col("hash").startswith(F.col("at")))
        histogram = (inside.groupBy("source", F.substring("hash", 1, digits).alias("bucket"))
                     .agg(F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("base").alias("base")))
        running = histogram.withColumn("upto", F.col("base") + F.sum("words").over(by_bucket))
        edge = (running.filter("upto > rest").groupBy("source")
                .agg(F.min(F.struct("bucket", "upto", "words", "rest")).alias("e"))
                .select("source", F.col("e.rest").alias("rest"), F.col("e.bucket").alias("at"),
                        (F.col("e.upto") - F.col("e.words")).alias("base"), F.col("e.upto").alias("upto")))
        last, edge = edge, edge.drop("upto")
    threshold = last.select("source", F.col("at").alias("edge"), (F.col("upto") - F.col("rest") < F.col("rest") - F.col("base")).alias("edge_in"))
    threshold = threshold.withColumnRenamed("source", "_s")
    plan = (sources.join(threshold, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s"))
    more = (F.col("rest") > 0) & (F.col("edge").isNull() | (F.col("hash") < F.col("edge"))
                                  | ((F.col("hash") == F.col("edge")) & F.col("edge_in")))
    return join_source(sized, plan).withColumn("copies", F.col("full") + F.when(more, 1).otherwise(0)).select(
        F.col("doc_id").alias(id_col), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"), F.col("copies").cast("long").alias("copies"))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         substr(md5('|' || COALESCE(doc_id::VARCHAR, '-') || '|' || md5(COALESCE(text, ''))), 1, 15) AS hash
  FROM documents),
sums AS (SELECT source, SUM(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, CASE (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w,
                  source_size * 2.0::DOUBLE AS most FROM sums),
filled AS (SELECT *, SUM(source_size) OVER () * 1.5::DOUBLE AS budget,
                  SUM(most) OVER (ORDER BY most / w, source NULLS LAST) - most AS before,
                  SUM(w) OVER () - SUM(w) OVER (ORDER BY most / w, source NULLS LAST) + w AS weight_left FROM ranked),
leveled AS (SELECT *, MAX(CASE WHEN (budget - before) / weight_left <= most / w THEN (budget - before) / weight_left END) OVER () AS level
            FROM filled),
goals AS (SELECT source, source_size, CASE WHEN level IS NULL THEN most ELSE LEAST(most, level * w) END AS target FROM leveled),
parts AS (SELECT *, CASE WHEN source_size > 0 THEN FLOOR(target / source_size) ELSE 0 END AS fully FROM goals),
cut AS (SELECT *, target - fully * source_size AS rest FROM parts),
groups AS (SELECT s.source, hash, SUM(size) AS words FROM sized s GROUP BY 1, 2),
running AS (SELECT *, SUM(words) OVER (PARTITION BY source ORDER BY hash) AS upto FROM groups),
chosen AS (SELECT r.source, r.hash, c.rest > 0 AND (upto <= c.rest OR (upto - words <= c.rest AND upto - c.rest < c.rest - (upto - words))) AS extra
           FROM running r JOIN cut c ON r.source IS NOT DISTINCT FROM c.source)
SELECT s.doc_id, s.size, c.source_size, c.target,
       (s.size * (c.fully + CASE WHEN h.extra THEN 1 ELSE 0 END))::BIGINT AS taken,
       (c.fully + CASE WHEN h.extra THEN 1 ELSE 0 END)::BIGINT AS copies
FROM sized s JOIN cut c ON s.source IS NOT DISTINCT FROM c.source
JOIN chosen h ON h.source IS NOT DISTINCT FROM s.source AND h.hash = s.hash
"""
