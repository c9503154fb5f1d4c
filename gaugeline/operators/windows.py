"""Row windows of a series: sliding windows, training pairs, last rows, pooling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeline import constants as C
from gaugeline.functions import bind, guarded, softmax_weight
from gaugeline.operators import blocks as B
from gaugeline.operators import scale

#: Rows per piece of a series when windows are cut; 95 rows of each are sent twice.
CHUNK_ROWS = 2048


def _chunked(df: DataFrame, position: str, overlap: int, chunk: int) -> DataFrame:
    """Rows in pieces of ``chunk`` positions, each followed by the next ``overlap`` rows.

    ``_own`` tells the piece's rows from the copies.
    """
    if chunk < overlap:
        raise ValueError(f"a piece of {chunk} rows is shorter than the overlap of {overlap}")
    own = F.floor(F.col(position) / chunk).cast("long")
    shared = (F.col(position) % chunk < overlap) & (own > 0)
    pieces = F.explode(F.when(shared, F.array(own, own - 1)).otherwise(F.array(own)))
    return df.withColumn("_piece", pieces).withColumn("_own", F.col("_piece") == own)


def _positioned(df, keys, time_col, tie, used, position, block):
    """The ``used`` columns beside key and time, and the column of the position in the series."""
    if position is not None:
        return df, position
    df = df.select(*dict.fromkeys([*keys, time_col, *tie, *used]))
    placed = B.row_index(B.with_block(df, keys, time_col, block), [time_col, *tie])
    return B.restore(placed, [*df.columns, "_idx"], keys), "_idx"


def without_holes(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """``df``; computing it is an error if the numbers of a series span more or less than its rows, or some have none.

    With :func:`_one_by_one`, which finds equal numbers, as those lie in one piece, no hole is left. The check is an
    aggregate that is combined on the map side, so a hot series is no hot task.
    """
    series = df.groupBy(*keys).agg((F.max(position) - F.min(position) + 1).alias("reach"), F.count(position).alias("given"),
                                   F.count(F.lit(1)).alias("n"))
    whole = F.coalesce(F.col("reach") == F.col("n"), F.lit(False)) & (F.col("given") == F.col("n"))
    broken = series.agg(F.count_if(~whole).alias("n")).select("n").scalar()
    checked = F.when(broken > 0, F.raise_error(F.lit(f"{position} has holes"))).otherwise(F.col(position))
    return df.withColumn(position, checked)


def _one_by_one(pieces: DataFrame, order, position: str) -> DataFrame:
    """Pieces whose own rows count on by one; anything else is an error."""
    ahead = F.lead("_pos").over(order) - F.col("_pos")
    return pieces.withColumn("_own", F.when(ahead != 1, F.raise_error(F.lit(f"{position} has holes"))).otherwise(F.col("_own")))


def sliding_windows(df: DataFrame, keys: Sequence[str], time_col: str, features: Sequence[str],
                    length: int = C.WINDOW_ROWS, target: str | None = None, horizon: int = 1,
                    tie: Sequence[str] = (), position: str | None = None,
                    block: str = B.DEFAULT_BLOCK, chunk: int = CHUNK_ROWS, dense: bool = False) -> DataFrame:
    """Windows of ``length`` rows, stride 1, that are followed by ``horizon`` more rows.

    A series of n rows gives ``max(0, n - length - horizon + 1)`` windows, so the
    last full one, which has no next row, is left out. Columns: keys,
    ``window_start`` (time), ``window_id`` (0-based first row), ``window``
    (``array<array<double>>``, rows by features), and with ``target`` also
    ``label``, the target in the ``horizon`` rows after the window.

    Windows are built inside pieces of a series; the frame reads at most
    ``length + horizon`` rows. A regular series can pass its ``position`` column, which must
    count its rows without holes: a hole would hide windows at the ends of pieces, so it is an error. ``dense`` says that
    the position was made without holes, as ``step`` is, and saves the look at all of a series that finds those between pieces.
    """
    if position is not None and not dense:
        df = without_holes(df, keys, position)
    return _windows(df, keys, time_col, features, length, target, horizon, tie, position, block, chunk, position is not None)


def _windows(df, keys, time_col, features, length, target, horizon, tie, position, block, chunk, given) -> DataFrame:
    """Windows by a position that is ``given``, so that pieces have to check it, or by one that is made here."""
    used = [*features, *([target] if target else [])]
    placed, pos = _positioned(df, keys, time_col, tie, used, position, block)
    kept = placed.select(*keys, F.col(pos).alias("_pos"), F.col(time_col).alias("window_start"),
                         F.array(*[F.col(f).cast("double") for f in features]).alias("_row"),
                         *([F.array(F.col(target).cast("double")).alias("_target")] if target else []))
    pieces = _chunked(kept, "_pos", length + horizon - 1, chunk)
    order = W.partitionBy(*keys, "_piece").orderBy("_pos")
    columns = {"window": F.collect_list("_row").over(order.rowsBetween(0, length - 1)),
               "_follows": F.count(F.lit(1)).over(order.rowsBetween(length, length + horizon - 1))}
    if target:
        columns["label"] = F.flatten(
            F.collect_list("_target").over(order.rowsBetween(length, length + horizon - 1)))
    if given:
        pieces = _one_by_one(pieces, order, position)
    found = pieces.withColumns(columns).filter(
        F.col("_own") & (F.size("window") == length) & (F.col("_follows") == horizon))
    return found.select(*keys, "window_start", F.col("_pos").alias("window_id"), "window",
                        *(["label"] if target else []))


def training_pairs(df: DataFrame, keys: Sequence[str], time_col: str,
                   features: Sequence[str], target: str = C.TARGET, length: int = C.WINDOW_ROWS,
                   horizon: int = 1, per_series: bool = True, tie: Sequence[str] = (),
                   position: str | None = None, block: str = B.DEFAULT_BLOCK,
                   chunk: int = CHUNK_ROWS) -> DataFrame:
    """Windows of scaled features with the scaled target of the next ``horizon`` rows.

    Scaling is the Z-score over each series, or over the whole table.
    """
    wanted = list(dict.fromkeys([*features, target]))
    given = position is not None
    if given:
        df = without_holes(df, keys, position)
    if per_series and position is None:
        position = "_idx"
        scaled = scale.standardize_indexed(df, wanted, keys, time_col, tie, block, position)
    else:
        scaled = scale.standardize(df, wanted, keys if per_series else (), time_col, block)
    return _windows(scaled, keys, time_col, features, length, target, horizon, tie, position, block, chunk, given)


def horizon_errors(df: DataFrame, keys: Sequence[str], time_col: str, target: str = C.TARGET,
                   horizon: int = C.HORIZON, season: int = C.HORIZON, tie: Sequence[str] = (),
                   position: str | None = None, block: str = B.DEFAULT_BLOCK,
                   chunk: int = CHUNK_ROWS, dense: bool = False) -> DataFrame:
    """Squared error of the seasonal forecast by hour ahead, over every possible origin.

    Hour h ahead of an origin takes the value ``season`` rows before it. One row
    per hour ahead: ``hour_ahead, n, mse``. The errors of all hours are sums of
    the same aggregate, so origins are never multiplied by the horizon. ``position`` and ``dense`` are as in
    :func:`sliding_windows`.
    """
    if season < horizon:
        raise ValueError("the season must cover the horizon")
    if position is not None and not dense:
        df = without_holes(df, keys, position)
    placed, pos = _positioned(df, keys, time_col, tie, [target], position, block)
    rows = placed.select(*keys, F.col(pos).alias("_pos"), F.array(F.col(target).cast("double")).alias("_x"))
    pieces = _chunked(rows, "_pos", season + horizon - 1, chunk)
    # The row is the first of the season; its origin is the season's last row.
    order = W.partitionBy(*keys, "_piece").orderBy("_pos")
    if position is not None:
        pieces = _one_by_one(pieces, order, position)
    frame = order.rowsBetween(0, season + horizon - 1)
    spans = pieces.withColumn("_span", F.flatten(F.collect_list("_x").over(frame))).filter(
        F.col("_own") & (F.size("_span") == season + horizon))

    def errors(h: int) -> str:
        error = f"power(_span[{h - 1}] - _span[{season + h - 1}], 2)"
        return f"struct({h} AS hour_ahead, count({error}) AS n, avg({error}) AS mse)"

    hours = ", ".join(errors(h) for h in range(1, horizon + 1))
    return spans.agg(F.expr(f"array({hours})").alias("_hours")).select(F.inline("_hours"))


def last_rows(df: DataFrame, keys: Sequence[str], time_col: str, n: int = C.WINDOW_ROWS,
              tie: Sequence[str] = ()) -> DataFrame:
    """The last ``n`` rows per series with ``pos`` 1..n, oldest first, and their count ``n_rows``.

    The rank filter keeps ``n`` rows per series already before the shuffle.
    """
    newest = W.partitionBy(*keys).orderBy(F.col(time_col).desc(), *[F.col(c).desc() for c in tie])
    ranked = df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= n)
    kept = F.max("_rank").over(W.partitionBy(*keys))
    return (ranked.withColumn("n_rows", kept).withColumn("pos", F.col("n_rows") - F.col("_rank") + 1)
            .drop("_rank"))


def scale_history(recent: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Each history scaled by its own mean and population deviation.

    ``recent`` is the bounded output of :func:`last_rows`; adds ``mean_<f>`` and
    ``std_<f>``, the latter with 0 replaced by 1.
    """
    series = W.partitionBy(*keys)
    stats = {}
    for f in features:
        stats[f"mean_{f}"] = F.avg(f).over(series)
        stats[f"std_{f}"] = guarded(F.stddev_pop(f).over(series))
    scaled = {f: (F.col(f) - F.col(f"mean_{f}")) / F.col(f"std_{f}") for f in features}
    return recent.withColumns(stats).withColumns(scaled)


def unscale(values: Column, mean: Column, std: Column) -> Column:
    """Forecast array back in units of the target."""
    return F.transform(values, lambda v: v * std + mean)


def attention_pool(steps: DataFrame, window: Sequence[str], energy: str,
                   features: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Softmax of ``energy`` over each window's steps, and the weighted mean of the features.

    ``steps`` is long: one row per step, ``window`` names the columns that tell
    windows apart (a window is a bounded number of rows). Returns the steps with
    ``weight``, and one row per window with the ``context_<f>`` columns.
    """
    over = W.partitionBy(*window)
    weighted = (steps.withColumn("_peak", F.max(energy).over(over))
                .withColumn("_total", F.sum(F.exp(F.col(energy) - F.col("_peak"))).over(over))
                .withColumn("weight", softmax_weight(F.col(energy), F.col("_peak"), F.col("_total")))
                .drop("_peak", "_total"))
    context = weighted.groupBy(*window).agg(
        F.sum("weight").alias("total_weight"),
        *[F.sum(F.col("weight") * F.col(f)).alias(f"context_{f}") for f in features])
    return weighted, context


def pool_window(window: Column, energy: Column) -> Column:
    """Context vector of one ``array<array<double>>`` window and its energies, as an array."""
    def weighted_sum(raised: Column, total: Column) -> Column:
        rows = F.zip_with(window, raised, lambda row, w: F.transform(row, lambda x: x * w / total))
        zero = F.transform(window[0], lambda x: F.lit(0.0))
        return F.aggregate(rows, zero, lambda a, row: F.zip_with(a, row, lambda x, y: x + y))

    return bind(F.array_max(energy), lambda peak: bind(
        F.transform(energy, lambda e: F.exp(e - peak)), lambda raised: bind(
            F.aggregate(raised, F.lit(0.0), lambda a, x: a + x),
            lambda total: weighted_sum(raised, total))))
