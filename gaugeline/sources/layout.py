"""Clustered files: rows along a space-filling curve over series and time, so that one series' week lies in few row groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.session import run_folder

#: Binary digits of either side of the curve.
BITS = 12


def curve_key(series: Column, time: Column, bits: int = BITS) -> Column:
    """Place on the Z-order curve: the binary digits of two whole numbers below ``2 ** bits`` in turn."""
    place = F.lit(0).cast("long")
    for i in range(bits):
        for column, shift in ((series, 2 * i + 1), (time, 2 * i)):
            digit = F.shiftright(column.cast("long"), i).bitwiseAND(F.lit(1).cast("long"))
            place = place.bitwiseOR(F.shiftleft(digit, shift))
    return place


def series_ranks(df: DataFrame, series_col: str, bits: int = BITS) -> DataFrame:
    """``series, rank``: the series in order, evenly over the numbers below ``2 ** bits``.

    Few rows, one per series; they are ordered by range, and a place is that in its range after the sizes of the ranges before.
    """
    spark = df.sparkSession
    path = run_folder(spark, "series")
    named = df.select(F.col(series_col).alias("series")).filter("series IS NOT NULL").distinct()
    named.repartitionByRange("series").sortWithinPartitions("series").withColumn("at", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.schema(f"series {dict(df.dtypes)[series_col]}, at bigint").parquet(path).withColumn("part", F.shiftrightunsigned("at", 33))
    before, offsets = 0, []
    for row in placed.groupBy("part").count().orderBy("part").collect():  # one for each partition of the shuffle
        offsets.append((row["part"], before))
        before += row["count"]
    if not offsets:
        return spark.createDataFrame([], f"series {dict(df.dtypes)[series_col]}, rank bigint")
    place = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = spark.createDataFrame(offsets, "part bigint, before bigint")
    return placed.join(F.broadcast(sizes), "part").select("series", F.floor(place * (1 << bits) / before).cast("long").alias("rank"))


def write_clustered(df: DataFrame, path: str, series_col: str, time_col: str, files: int | None = None,
                    row_group_bytes: int = 128 << 20, bits: int = BITS) -> None:
    """Write ``df`` along the curve over the order of its series and its times.

    The least and largest series and time of a row group then enclose a small part of both, so a scan that asks for one series and
    some days skips nearly all of them; a bloom filter tells series that lie between these but are not there. A hot
    series is cut by time like any other. Rows without a series or a time come first.
    """
    ends = df.select(F.struct(F.min(time_col).alias("lo"), F.max(time_col).alias("hi")).alias("s")).scalar()

    def micros(moment: Column) -> Column:
        return F.unix_micros(moment.cast("timestamp"))

    lo, hi = micros(ends["lo"]), micros(ends["hi"])
    part = (micros(F.col(time_col)) - lo) / F.greatest(hi - lo + 1, F.lit(1))
    slot = F.coalesce(F.floor(part * (1 << bits)).cast("long"), F.lit(0).cast("long"))
    ranks = series_ranks(df, series_col, bits)
    ranked = df.join(ranks, F.col(series_col) == F.col("series"), "left")
    keyed = ranked.withColumn("_key", curve_key(F.coalesce("rank", F.lit(0).cast("long")), slot, bits)).drop("series", "rank")
    dealt = keyed.repartitionByRange(files, "_key") if files else keyed.repartitionByRange("_key")
    (dealt.sortWithinPartitions("_key", series_col, time_col).drop("_key").write
     .option("parquet.block.size", str(row_group_bytes)).option(f"parquet.bloom.filter.enabled#{series_col}", "true").parquet(path))
