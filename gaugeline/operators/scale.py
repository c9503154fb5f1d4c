"""Scaling and anomaly flags, over the whole table or per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import guarded
from gaugeline.operators import blocks as B


def _with_stats(df: DataFrame, measures, wanted, keys, time_col, block):
    """``df`` plus a lookup ``(stat, measure) -> Column``.

    Whole-table statistics are a one-row scalar subquery: no join, no shuffle of
    the rows. Per-series ones are attached block by block.
    """
    if not keys:
        makers = {"mean": F.avg, "std_pop": F.stddev_pop, "std_samp": F.stddev_samp,
                  "min": F.min, "max": F.max}
        stats = df.select(F.struct(*[makers[s](m).alias(f"{s}_{m}") for s in wanted for m in measures])
                          .alias("s")).scalar()
        return df, lambda s, m: stats[f"{s}_{m}"]
    if time_col is None:
        raise ValueError("statistics per series need time_col to cut the series into blocks")
    attached = B.attach_stats(B.with_block(df, keys, time_col, block), measures, wanted)
    return attached, lambda s, m: F.col(f"_{s}_{m}")


def _replaced(df: DataFrame, out: DataFrame, changes: dict[str, Column], keys) -> DataFrame:
    names = list(df.columns) + [c for c in changes if c not in df.columns]
    return B.restore(out.withColumns(changes), names, keys)


def normalize(df: DataFrame, measures: Sequence[str], keys: Sequence[str] = (),
              time_col: str | None = None, block: str = B.DEFAULT_BLOCK) -> DataFrame:
    """Min-Max scaling; a constant column becomes 0, NULL stays NULL."""
    out, stat = _with_stats(df, measures, ["min", "max"], list(keys), time_col, block)
    return _replaced(df, out, {
        m: (F.col(m) - stat("min", m)) / guarded(stat("max", m) - stat("min", m)) for m in measures}, keys)


def standardize_indexed(df: DataFrame, measures: Sequence[str], keys: Sequence[str], time_col: str,
                        tie: Sequence[str] = (), block: str = B.DEFAULT_BLOCK,
                        index: str = "_idx") -> DataFrame:
    """Z-score over each series, with the 0-based position of each row in its series.

    Statistics and positions come from one block summary, so one shuffle and one
    join serve both.
    """
    blocked = B.with_block(df, keys, time_col, block)
    numbered = blocked.withColumn("_rn", F.row_number().over(B.in_block(time_col, *tie)))
    out = B.attach_stats(numbered, measures, ["mean", "std_pop"], offset=True)
    scaled = {m: (F.col(m) - F.col(f"_mean_{m}")) / guarded(F.col(f"_std_pop_{m}")) for m in measures}
    scaled[index] = F.expr("cast(_rn - 1 + _offset AS bigint)")
    return B.restore(out.withColumns(scaled), [*df.columns, index], keys)


def standardize(df: DataFrame, measures: Sequence[str], keys: Sequence[str] = (),
                time_col: str | None = None, block: str = B.DEFAULT_BLOCK) -> DataFrame:
    """Z-score with the population deviation; a constant column becomes 0."""
    out, stat = _with_stats(df, measures, ["mean", "std_pop"], list(keys), time_col, block)
    return _replaced(df, out, {
        m: (F.col(m) - stat("mean", m)) / guarded(stat("std_pop", m)) for m in measures}, keys)


def flag_anomalies(df: DataFrame, measure: str, threshold: float = 3.0, keys: Sequence[str] = (),
                   time_col: str | None = None, block: str = B.DEFAULT_BLOCK,
                   flag: str = "is_anomaly") -> DataFrame:
    """Rows farther than ``threshold`` sample deviations from the mean; never NULL."""
    out, stat = _with_stats(df, [measure], ["mean", "std_samp"], list(keys), time_col, block)
    far = F.abs(F.col(measure) - stat("mean", measure)) > threshold * stat("std_samp", measure)
    return _replaced(df, out, {flag: F.coalesce(far, F.lit(False))}, keys)
