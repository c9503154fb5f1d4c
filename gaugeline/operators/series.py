"""Series operators: bins, gap filling, resampling, profiles, rain events.

Input rows are keyed by ``keys`` and a time; all work is cut into blocks
(see :mod:`gaugeline.operators.blocks`).
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeline import constants as C
from gaugeline.functions import epoch, interval_seconds, time_bin
from gaugeline.operators import blocks as B
from gaugeline.sources import commits

log = logging.getLogger(__name__)


def resample_mean(df: DataFrame, keys: Sequence[str], time_col: str, measures: Sequence[str],
                  interval: str = "1H", count: str | None = None,
                  block: str = B.DEFAULT_BLOCK) -> DataFrame:
    """Mean of every measure per series and time bin.

    Bins are counted from midnight of the first day of the series. An interval
    that divides a day gives the same bins from the epoch, with no first pass.
    """
    seconds = interval_seconds(interval)
    if 86400 % seconds == 0:
        binned = df.withColumn(time_col, time_bin(F.col(time_col), seconds))
    else:
        blocked = B.with_block(df, keys, time_col, block)
        first = (blocked.groupBy(B.SERIES, B.BLOCK).agg(F.min(time_col).alias("_first"))
                 .withColumn("_first", F.min("_first").over(B.whole())))
        origin = epoch(F.date_trunc("day", F.col("_first")))
        binned = B.restore(B.join_summary(blocked, first).withColumn(
            time_col, time_bin(F.col(time_col), seconds, origin)), df.columns, keys)
    aggregates = [F.avg(m).alias(m) for m in measures]
    if count:
        aggregates.append(F.count(F.lit(1)).alias(count))
    return binned.groupBy(*keys, time_col).agg(*aggregates)


def _lines(measures: Sequence[str], at: str, fill_lead: bool) -> list[Column]:
    """Values on the line between the known neighbours; the last one is held at the end.

    ``at`` is the position as SQL text. A leading gap takes the first value or stays NULL.
    """
    values = []
    for i, name in enumerate(measures):
        m, lead = B.sql_name(name), f"_next_x_{i}" if fill_lead else "NULL"
        values.append(F.expr(
            f"CASE WHEN {m} IS NOT NULL THEN {m} "
            f"WHEN _prev_at_{i} IS NULL THEN {lead} "
            f"WHEN _next_at_{i} IS NULL THEN _prev_x_{i} "
            f"ELSE _prev_x_{i} + (_next_x_{i} - _prev_x_{i}) / greatest(_next_at_{i} - _prev_at_{i}, 1) "
            f"* ({at} - _prev_at_{i}) END").alias(name))
    return values


def _bins_after(df: DataFrame, time_col: str, seconds: int, first: int, tail: Column | None) -> DataFrame:
    """Adds ``_gap``, the bins from a row to the next one (``_until``), and ``_low``, the first bin that is wanted, from ``first`` on."""
    start, low = epoch(F.col(time_col)), F.lit(first).cast("long")
    gap = F.greatest(F.coalesce((F.col("_until") - start) / seconds, F.lit(1)).cast("long"), F.lit(1).cast("long"))
    if tail is not None:
        low = F.greatest(low, F.ceil((tail - start) / seconds).cast("long"))
    return df.withColumns({"_gap": gap, "_low": low})


def _placed(df: DataFrame, time_col: str, seconds: int) -> DataFrame:
    return (df.withColumn(time_col, F.timestamp_seconds(epoch(F.col(time_col)) + F.col("_ahead") * seconds))
            .drop("_until", "_low", "_gap"))


def _spread(rows: DataFrame, time_col: str, seconds: int, per: int, tail: Column | None) -> DataFrame:
    """Each bin followed by the empty bins up to the next one, where these are no more than a block has; else the bin alone.

    ``_ahead`` is 0 on the bin itself and counts the empty bins after it. Rows stay where they are.
    """
    found = _bins_after(rows, time_col, seconds, 0, tail)
    high = F.when(F.col("_gap") > per, F.lit(0).cast("long")).otherwise(F.col("_gap") - 1)
    wanted = found.withColumn("_high", high).filter("_low <= _high")
    return _placed(wanted.withColumn("_ahead", F.explode(F.expr("sequence(_low, greatest(_low, _high), 1L)"))).drop("_high"), time_col, seconds)


def _long_gaps(summary: DataFrame, time_col: str, seconds: int, per: int, tail: Column | None, measures: Sequence[str]) -> DataFrame:
    """The empty bins of gaps that are longer than a block.

    Such a gap begins behind the last bin of a block, so the summary has all that its bins need and no row is looked at.
    It is cut into pieces of a block's length, which are dealt to all tasks: a gap of years is not the
    work of one task. The number of tasks is fixed, as merging them by the small size of the pieces would undo that.
    """
    ends = summary.withColumns({"_until": F.col("_until_next"), time_col: F.timestamp_seconds("_end"),
                                **{f"_prev_{part}_{i}": F.coalesce(f"_end_{part}_{i}", f"_before_{part}_{i}") for i in range(len(measures)) for part in ("at", "x")},
                                **{f"_next_{part}_{i}": F.col(f"_after_{part}_{i}") for i in range(len(measures)) for part in ("at", "x")}})
    found = _bins_after(ends, time_col, seconds, 1, tail).filter(f"_gap > {per} AND _low < _gap")
    piece = F.explode(F.expr(f"sequence(_low DIV {per}, (_gap - 1) DIV {per}, 1L)"))
    tasks = int(summary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.withColumn("_piece", piece).repartition(tasks, B.SERIES, B.BLOCK, "_piece")
    ahead = F.explode(F.expr(f"sequence(greatest(_low, _piece * {per}), least(_gap - 1, _piece * {per} + {per} - 1), 1L)"))
    return _placed(dealt.withColumn("_ahead", ahead), time_col, seconds)


def _bin_summary(bins: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Block summary with carried points, the last bin and the last known points of the block, the next block's first bin and the series' ends."""
    points = B.block_points(bins, "_at", measures, ["min(_at) AS _lo", "max(_at) AS _end"])
    kept = points.withColumns({f"_end_{part}_{i}": F.col(f"_last_{part}_{i}") for i in range(len(measures)) for part in ("at", "x")}) if measures else points
    return (B.carry_points(kept, measures)
            .withColumns({"_until_next": F.lead("_lo").over(B.along()),
                          "_first": F.min("_lo").over(B.whole()), "_last": F.max("_end").over(B.whole())})
            .drop("_lo"))


def dense_series(bins: DataFrame, keys: Sequence[str], time_col: str, measures: Sequence[str],
                 interval: str = "1H", fill: bool = True, last: int | None = None,
                 block: str = B.DEFAULT_BLOCK, passed: Sequence[str] = ()) -> DataFrame:
    """Every bin between a series' first and last one, with its 0-based ``step``.

    ``bins`` holds at most one row per series and bin. With ``fill``, inner gaps
    are interpolated and the end is held; leading gaps stay NULL. ``passed``
    columns keep their value on existing bins and are NULL elsewhere. ``last``
    keeps the last ``last`` bins: older blocks go no further than the summary.

    Gaps are expanded from the existing rows, so the spine needs no join: those of a block's length where the rows
    are, longer ones, in pieces that are dealt to all tasks, from the summary of the blocks.
    """
    keys, seconds = list(keys), interval_seconds(interval)
    per = max(1, interval_seconds(block) // seconds)
    filled = list(measures) if fill else []
    dated = bins.filter(F.col(time_col).isNotNull())
    blocked = B.with_block(dated, keys, time_col, block).withColumn("_at", epoch(F.col(time_col)))
    summary = _bin_summary(blocked, filled)
    tail = None if last is None else F.col("_last") - (last - 1) * seconds
    ends = [f"_end_{part}_{i}" for i in range(len(filled)) for part in ("at", "x")]
    beside = summary.drop("_end", *ends)

    def local(rows: DataFrame) -> DataFrame:
        ahead = rows.withColumn("_until", F.lead("_at").over(B.in_block("_at")))
        return B.neighbours(ahead, "_at", filled)

    if last is None:
        rows = B.join_summary(local(blocked), beside)
    else:
        until = F.coalesce(F.col("_until_next"), F.col("_last") + seconds)
        rows = local(B.join_summary(blocked, beside.filter(until > tail), "inner"))
    at = epoch(F.col(time_col))
    rows = B.beyond_block(rows, filled).withColumn("_until", F.coalesce("_until", "_until_next"))
    spine = _spread(rows, time_col, seconds, per, tail)
    here = F.col("_ahead") == 0
    plain = spine.withColumns({c: F.when(here, F.col(c)) for c in [*measures, *passed]})
    empty = {c: F.lit(None).cast(kind) for c, kind in bins.dtypes if c in (*measures, *passed)}
    gaps = _long_gaps(summary, time_col, seconds, per, tail, filled).withColumns(empty)
    plain = plain.select(*[c for c in plain.columns if c in gaps.columns]).unionByName(gaps.select(*[c for c in plain.columns if c in gaps.columns]))
    values = _lines(measures, f"unix_seconds({B.sql_name(time_col)})", False) if fill else list(measures)
    placed = plain.select(B.SERIES, time_col, *values, *passed,
                          ((at - F.col("_first")) / seconds).cast("long").alias("step"))
    return B.restore(placed, [*keys, time_col, *measures, *passed, "step"], keys)


def resample(df: DataFrame, keys: Sequence[str], time_col: str, measures: Sequence[str],
             interval: str = "1H", last: int | None = None,
             block: str = B.DEFAULT_BLOCK) -> DataFrame:
    """Bin means on a dense time axis, gaps interpolated forward."""
    bins = resample_mean(df, keys, time_col, measures, interval, block=block)
    return dense_series(bins, keys, time_col, measures, interval, True, last, block)


def flag_missing(bins: DataFrame, keys: Sequence[str], time_col: str, measures: Sequence[str],
                 count: str = "n_readings", interval: str = "1H",
                 block: str = B.DEFAULT_BLOCK) -> DataFrame:
    """Dense axis with ``data_quality`` 3 where a bin has no reading, else 1."""
    dense = dense_series(bins, keys, time_col, measures, interval, False, None, block, [count])
    quality = F.when(F.col(count).isNull(), C.QUALITY_MISSING).otherwise(C.QUALITY_OK)
    return dense.withColumn("data_quality", quality)


def recent_spine(ends: DataFrame, end_col: str, time_col: str = "hour", length: int = C.WINDOW_ROWS,
                 interval: str = C.SAMPLING) -> DataFrame:
    """The ``length`` bins up to and including each row's end moment."""
    seconds = interval_seconds(interval)
    back = F.explode(F.sequence(F.lit(length - 1), F.lit(0), F.lit(-1)))
    return (ends.withColumn("_back", back)
            .withColumn(time_col, F.timestamp_seconds(epoch(F.col(end_col)) - F.col("_back") * seconds))
            .drop("_back"))


def forward_fill(df: DataFrame, keys: Sequence[str], time_col: str, measures: Sequence[str],
                 tie: Sequence[str] = (), block: str = B.DEFAULT_BLOCK) -> DataFrame:
    """The last known value of each measure; leading gaps stay NULL. Rows without a time come first and carry on too."""
    blocked = B.with_block(df, keys, time_col, block, tie)
    order = [B.sql_name(c) for c in (time_col, *tie)]
    # A plain number, never NULL, keeps the summary a hash aggregate.
    position = (f"struct({', '.join(order)})" if tie else
                f"coalesce(unix_micros(cast({order[0]} AS timestamp)), -9223372036854775808L)")
    summary = B.carry_points(B.block_points(blocked, position, measures), measures)
    window = B.in_block(time_col, *tie).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = blocked.withColumns({m: F.last(m, ignorenulls=True).over(window) for m in measures})
    filled = {m: F.coalesce(F.col(m), F.col(f"_before_x_{i}")) for i, m in enumerate(measures)}
    return B.restore(B.join_summary(local, summary).withColumns(filled), df.columns, keys)


def interpolate(df: DataFrame, keys: Sequence[str], time_col: str, measures: Sequence[str],
                tie: Sequence[str] = (), block: str = B.DEFAULT_BLOCK) -> DataFrame:
    """Linear between known neighbours by row position; both ends take the nearest value."""
    blocked = B.with_block(df, keys, time_col, block, tie)
    placed = blocked.withColumn("_rn", F.row_number().over(B.in_block(time_col, *tie)))
    points = B.block_points(placed, "_rn", measures, ["count(*) AS _n"])
    summary = B.carry_points(points.withColumn("_offset", B.rows_before()), measures, "+ _offset")
    local = B.neighbours(placed, "_rn", measures, [time_col, *tie])
    near = B.beyond_block(B.join_summary(local, summary), measures, "+ _offset")
    lines = dict(zip(measures, _lines(measures, "_rn + _offset", True)))
    return B.restore(near.withColumns(lines), df.columns, keys)


def drop_missing(df: DataFrame, measures: Sequence[str] | None = None) -> DataFrame:
    """Rows without any missing value."""
    return df.na.drop("any", subset=list(measures) if measures else None)


def handle_missing(df: DataFrame, method: str, keys: Sequence[str], time_col: str,
                   measures: Sequence[str], tie: Sequence[str] = (),
                   block: str = B.DEFAULT_BLOCK) -> DataFrame:
    """Fill or drop by method name; an unknown name returns the input unchanged."""
    if method == "interpolate":
        return interpolate(df, keys, time_col, measures, tie, block)
    if method == "ffill":
        return forward_fill(df, keys, time_col, measures, tie, block)
    if method == "drop":
        return drop_missing(df, measures)
    log.warning("unknown method %r for missing values: rows are left as they are", method)
    return df


def _hour_of_day(df: DataFrame, time_col: str) -> DataFrame:
    return df.withColumn("hour_of_day", F.hour(time_col))


def daily_profile(df: DataFrame, keys: Sequence[str], time_col: str, measure: str) -> DataFrame:
    """Mean per series and hour of day."""
    return (_hour_of_day(df, time_col).groupBy(*keys, "hour_of_day")
            .agg(F.avg(measure).alias("profile"), F.count(measure).alias("n")))


def profile_residual(df: DataFrame, keys: Sequence[str], time_col: str, measure: str,
                     block: str = B.DEFAULT_BLOCK) -> DataFrame:
    """Adds ``hour_of_day``, its ``profile`` mean and the ``residual`` from it."""
    hourly = B.with_block(_hour_of_day(df, time_col), [*keys, "hour_of_day"], time_col, block)
    out = B.attach_stats(hourly, [measure], ["mean"])
    profile = F.when(F.col(measure).isNotNull(), F.col(f"_mean_{measure}"))
    found = out.withColumns({"profile": profile, "residual": F.col(measure) - profile})
    return B.restore(found, [*df.columns, "hour_of_day", "profile", "residual"], [*keys, "hour_of_day"])


def daily_amplitude(df: DataFrame, keys: Sequence[str], time_col: str, measure: str) -> DataFrame:
    """Amplitude of the daily sine that starts at 06:00."""
    phase = F.sin(2 * F.pi() * (F.hour(time_col) - 6) / 24)
    return df.groupBy(*keys).agg((2 * F.avg(F.col(measure) * phase)).alias("amplitude"))


def rain_events(df: DataFrame, keys: Sequence[str], time_col: str = "hour",
                measure: str = "rainfall", wet: float = C.WET_HOUR, interval: str = C.SAMPLING,
                block: str = B.DEFAULT_BLOCK) -> DataFrame:
    """Runs of adjacent wet hours: start, end, hours, total and peak.

    Rows of one hour belong to one event and are one of its ``hours``; ``total`` adds them all up.

    Runs are found per block; only those that touch a block border, two per block
    at most, are joined along the series.
    """
    return join_runs(rain_runs(df, keys, time_col, measure, wet, interval, block), keys, interval)


def rain_runs(df: DataFrame, keys: Sequence[str], time_col: str = "hour",
              measure: str = "rainfall", wet: float = C.WET_HOUR, interval: str = C.SAMPLING,
              block: str = B.DEFAULT_BLOCK) -> DataFrame:
    """Runs of adjacent wet hours inside blocks of time; ``border`` tells those that may go on in a neighbouring block.

    The runs of any set of blocks can be stored and joined with those of others later, by :func:`join_runs`.
    """
    keys, seconds, length = list(keys), interval_seconds(interval), interval_seconds(block)
    if length % seconds:
        raise ValueError("block must be a multiple of interval")
    at = epoch(F.col(time_col))
    wet_rows = B.with_block(df.filter((F.col(measure) >= wet) & F.col(time_col).isNotNull()),
                            keys, time_col, block)
    order = B.in_block(time_col)
    gap = at - F.lag(at).over(order)
    marked = wet_rows.withColumn("_gap", gap).withColumns({
        "_new": F.when(F.col("_gap").isin(0, seconds), 0).otherwise(1),
        "_hour": F.when(F.col("_gap") == 0, 0).otherwise(1)})
    runs = (marked.withColumn("_run", F.sum("_new").over(
                order.rowsBetween(W.unboundedPreceding, W.currentRow)))
            .groupBy(B.SERIES, B.BLOCK, "_run")
            .agg(F.min(time_col).alias("start"), F.max(time_col).alias("end"),
                 F.sum("_hour").alias("hours"), F.sum(measure).alias("total"),
                 F.max(measure).alias("peak")))
    # A run that starts or ends within one interval of the border, wherever the bins lie.
    border = ((epoch(F.col("start")) < F.col(B.BLOCK) * length + seconds)
              | (epoch(F.col("end")) >= (F.col(B.BLOCK) + 1) * length - seconds))
    return runs.select(*[F.col(f"{B.SERIES}.{k}").alias(k) for k in keys], "start", "end", "hours", "total", "peak",
                       border.alias("border"))


def join_runs(runs: DataFrame, keys: Sequence[str], interval: str = C.SAMPLING) -> DataFrame:
    """Events from runs of blocks: those inside a block as they are, those at borders joined along the series."""
    keys, seconds = list(keys), interval_seconds(interval)
    columns = [*keys, "start", "end", "hours", "total", "peak"]
    by_start = W.partitionBy(*keys).orderBy("start")
    follows = F.coalesce(epoch(F.lag("end").over(by_start)) == epoch(F.col("start")) - seconds, F.lit(False))
    crossing = (runs.filter("border").withColumn("_new", F.when(follows, 0).otherwise(1))
                .withColumn("_run", F.sum("_new").over(
                    by_start.rowsBetween(W.unboundedPreceding, W.currentRow)))
                .groupBy(*keys, "_run")
                .agg(F.min("start").alias("start"), F.max("end").alias("end"),
                     F.sum("hours").alias("hours"), F.sum("total").alias("total"),
                     F.max("peak").alias("peak"))
                .select(*columns))
    return runs.filter("NOT border").select(*columns).unionByName(crossing)


def store_rain_runs(days: DataFrame, path: str, batch: str, keys: Sequence[str], time_col: str = "hour", measure: str = "rainfall",
                    wet: float = C.WET_HOUR, interval: str = C.SAMPLING) -> None:
    """Append the runs of whole days, inside each day; the batch may be stored again. A day belongs to one batch.

    :func:`read_rain_events` joins them, so an event that goes on after midnight is one, whichever of its days was stored first.
    """
    commits.append_batch(rain_runs(days, keys, time_col, measure, wet, interval, "1 day"), path, batch)


def read_rain_events(spark: SparkSession, path: str, keys: Sequence[str], interval: str = C.SAMPLING) -> DataFrame:
    """The events of all days that are stored; of each day at most two runs are looked at again."""
    return join_runs(commits.read_batches(spark, path), keys, interval)
