"""Time blocks: ordered work on a series without one task per series.

A window over a whole station would put all its rows into one task, and one
station may hold a third of the data. Here a series is cut into blocks of fixed
length, ordered work runs per ``(keys, block)``, and what must cross a block
border travels in a summary of one row per block. The summary is built with
map-side aggregation, carried along each series (a few blocks per year of data),
and joined back on ``(keys, block)``, the partitioning the rows already have.

The series key is one struct column. It is never NULL, so joining on it adds no
filter to either side: rows with a NULL key form a series of their own as in any
SQL window, and both sides keep the same plan below, so Spark reads and shuffles
it once. Rows without a time sort before all others of their series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeline.functions import epoch, interval_seconds

SERIES, BLOCK = "_series", "_block"
#: First block of the rows without a time; all of them lie before every block of time.
NO_TIME = -(1 << 62)
#: Blocks that rows without a time and without an order are dealt to, and numbers of an order that a block has.
UNORDERED, ORDERED = 64, 100_000
#: 672 rows of an hourly series.
DEFAULT_BLOCK = "28 days"



#: Frames and windows as SQL text: one call to the engine per column.
_IN_BLOCK = f"PARTITION BY {SERIES}, {BLOCK} ORDER BY"
_ALONG = f"(PARTITION BY {SERIES} ORDER BY {BLOCK} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_BACK = f"(PARTITION BY {SERIES} ORDER BY {BLOCK} DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_WHOLE = f"(PARTITION BY {SERIES})"


def sql_name(name: str) -> str:
    """Column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def columns_of(texts: dict[str, str]) -> dict[str, Column]:
    return {name: F.expr(text) for name, text in texts.items()}


def _untimed_block(df: DataFrame, tie: Sequence[str], seconds: int) -> Column:
    """Block of a row without a time, so that a series of nothing else is not one task.

    Blocks follow the order of the first ``tie`` column where that is a number or a moment. Without a tie the rows
    have no order, and a hash deals them. A tie of another type leaves one block.
    """
    reach = 1 << 60
    if not tie:
        kept = [F.col(sql_name(c)) for c, kind in df.dtypes if "map<" not in kind and kind != "variant"]
        return F.lit(NO_TIME) + F.pmod(F.xxhash64(*kept), F.lit(UNORDERED))
    kind, order = dict(df.dtypes)[tie[0]], F.col(sql_name(tie[0]))
    if kind in ("tinyint", "smallint", "int", "bigint"):
        number = F.floor(order.cast("long") / F.lit(ORDERED))
    elif kind in ("date", "timestamp", "timestamp_ntz"):
        number = F.floor(epoch(order) / F.lit(seconds))
    else:
        return F.lit(NO_TIME)
    return F.lit(NO_TIME + reach) + F.coalesce(number.cast("long"), F.lit(-reach))


def with_block(df: DataFrame, keys: Sequence[str], time_col: str,
               block: str = DEFAULT_BLOCK, tie: Sequence[str] | None = None) -> DataFrame:
    """The key columns packed into the series key, and the block of each row.

    :func:`restore` unpacks them; meanwhile rows carry their key once. Given the ``tie`` that orders rows of one time, if only
    an empty one, rows without a time are dealt to many blocks in that order; else they are one block.
    """
    seconds = interval_seconds(block)
    moment = epoch(F.col(time_col))
    number = ((moment - F.pmod(moment, F.lit(seconds))) / seconds).cast("long")
    untimed = F.lit(NO_TIME) if tie is None else _untimed_block(df, list(tie), seconds)
    return df.withColumns({SERIES: F.struct(*keys), BLOCK: F.coalesce(number, untimed)}).drop(*keys)


def restore(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``columns`` in order, the keys among them unpacked."""
    return df.select(*[F.col(f"{SERIES}.{c}").alias(c) if c in keys else F.col(c) for c in columns])


def in_block(*order: Column | str):
    return W.partitionBy(SERIES, BLOCK).orderBy(*order)


def along():
    """Window over the block summary of one series, oldest first."""
    return W.partitionBy(SERIES).orderBy(BLOCK)


def whole():
    """Window over all blocks of one series."""
    return W.partitionBy(SERIES)


def join_summary(df: DataFrame, summary: DataFrame, how: str = "left") -> DataFrame:
    return df.join(summary, [SERIES, BLOCK], how)


def rows_before(count: str = "_n") -> Column:
    """Rows of a series in all earlier blocks, from the counts in the block summary."""
    return F.expr(f"coalesce(sum({count}) OVER {_ALONG}, 0)")


def row_index(df: DataFrame, order: Sequence[str], name: str = "_idx") -> DataFrame:
    """0-based position in the series, in ``order``; ``df`` carries its block.

    The count also looks at a hash of all columns (maps have none). It never exceeds that of the rows, so it
    changes no result, but both sides of the join then need the same columns, and the source is read once.
    """
    values = ", ".join(sql_name(c) for c, kind in df.dtypes if c not in (SERIES, BLOCK) and "map<" not in kind)
    hashed = f", count(nullif(xxhash64({values}), 0L))" if values else ", 0L"
    counts = df.groupBy(SERIES, BLOCK).agg(F.expr(f"greatest(count(*){hashed}) AS _n"))
    offsets = counts.select(SERIES, BLOCK, rows_before().alias("_offset"))
    numbered = df.withColumn("_rn", F.row_number().over(in_block(*order)))
    return (join_summary(numbered, offsets)
            .withColumn(name, F.expr("cast(_rn - 1 + coalesce(_offset, 0) AS bigint)"))
            .drop("_rn", "_offset"))


def block_points(df: DataFrame, position: str, measures: Sequence[str],
                 extra: Sequence[str] = ()) -> DataFrame:
    """One row per block with the position and value of its first and last known points.

    ``position`` and the ``extra`` aggregates are SQL texts.
    """
    points = list(extra)
    for i, m in enumerate(map(sql_name, measures)):
        # Position and value apart: plain numbers keep this a hash aggregate.
        at = f"CASE WHEN {m} IS NOT NULL THEN {position} END"
        points += [f"max({at}) AS _last_at_{i}", f"max_by({m}, {at}) AS _last_x_{i}",
                   f"min({at}) AS _first_at_{i}", f"min_by({m}, {at}) AS _first_x_{i}"]
    return df.groupBy(SERIES, BLOCK).agg(*map(F.expr, points))


def carry_points(blocks: DataFrame, measures: Sequence[str], shift: str = "") -> DataFrame:
    """Adds ``_before_at_<i>`` and ``_before_x_<i>``, the last known point of all earlier blocks for
    the i-th measure, and ``_after_...``, the first one of all later blocks. ``shift`` (SQL text
    such as ``+ _offset``) is added to positions that count from the start of a block.
    """
    if not measures:
        return blocks
    carried = {}
    for name, end, over in (("after", "first", _BACK), ("before", "last", _ALONG)):
        for i in range(len(measures)):
            carried[f"_{name}_at_{i}"] = f"last(_{end}_at_{i} {shift}, true) OVER {over}"
            carried[f"_{name}_x_{i}"] = f"last(_{end}_x_{i}, true) OVER {over}"
    ends = [f"_{end}_{part}_{i}" for end in ("last", "first") for part in ("at", "x")
            for i in range(len(measures))]
    return blocks.withColumns(columns_of(carried)).drop(*ends)


def neighbours(df: DataFrame, position: str, measures: Sequence[str],
               order: Sequence[str] = ()) -> DataFrame:
    """Adds ``_prev_at_<i>`` and ``_prev_x_<i>``, the i-th measure's known point at or before a row
    in its block, and ``_next_...``, the one after it.

    Rows are in ``order``, by default that of their position. Called before the
    summary is joined, the join needs no sort of its own.
    """
    names = [sql_name(c) for c in (list(order) or [position])]
    forward = f"({_IN_BLOCK} {', '.join(names)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    backward = (f"({_IN_BLOCK} {', '.join(n + ' DESC' for n in names)} "
                "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    found = {}
    for name, over in (("prev", forward), ("next", backward)):
        for i, m in enumerate(map(sql_name, measures)):
            found[f"_{name}_at_{i}"] = f"last(CASE WHEN {m} IS NOT NULL THEN {position} END, true) OVER {over}"
            found[f"_{name}_x_{i}"] = f"last({m}, true) OVER {over}"
    return df.withColumns(columns_of(found)) if found else df


def beyond_block(df: DataFrame, measures: Sequence[str], shift: str = "") -> DataFrame:
    """Completes the neighbours of the block by the carried points of the joined summary."""
    found = {}
    for near, far in (("prev", "before"), ("next", "after")):
        for i in range(len(measures)):
            found[f"_{near}_at_{i}"] = f"coalesce(_{near}_at_{i} {shift}, _{far}_at_{i})"
            found[f"_{near}_x_{i}"] = f"coalesce(_{near}_x_{i}, _{far}_x_{i})"
    return df.withColumns(columns_of(found)) if found else df


def attach_stats(df: DataFrame, measures: Sequence[str], wanted: Sequence[str],
                 offset: bool = False) -> DataFrame:
    """Adds ``_<stat>_<measure>`` over each whole series; ``df`` carries its block.

    ``wanted`` names among count, mean, std_pop, std_samp, min, max. Blocks are
    aggregated on the map side and merged, so no row moves to get its statistics
    other than to its block. ``offset`` also adds ``_offset``, the rows of the
    series before the block.
    """
    parts, means, spreads = [], {}, {}
    for i, m in enumerate(map(sql_name, measures)):
        parts += [f"count({m}) AS _n_{i}", f"avg({m}) AS _a_{i}", f"var_pop({m}) * count({m}) AS _q_{i}",
                  f"min({m}) AS _lo_{i}", f"max({m}) AS _hi_{i}"]
        means |= {f"_count_{i}": f"sum(_n_{i}) OVER {_WHOLE}",
                  f"_mean_{i}": f"sum(_n_{i} * _a_{i}) OVER {_WHOLE} / greatest(sum(_n_{i}) OVER {_WHOLE}, 1)",
                  f"_min_{i}": f"min(_lo_{i}) OVER {_WHOLE}", f"_max_{i}": f"max(_hi_{i}) OVER {_WHOLE}"}
        spreads[f"_square_{i}"] = f"sum(_q_{i} + _n_{i} * power(_a_{i} - _mean_{i}, 2)) OVER {_WHOLE}"
    stats = {"count": "_count_{0}", "mean": "_mean_{0}", "min": "_min_{0}", "max": "_max_{0}",
             "std_pop": "sqrt(_square_{0} / greatest(_count_{0}, 1))",
             "std_samp": "CASE WHEN _count_{0} > 1 THEN sqrt(_square_{0} / greatest(_count_{0} - 1, 1)) END"}
    if offset:
        parts.append("count(*) AS _rows")
        means["_offset"] = f"coalesce(sum(_rows) OVER {_ALONG}, 0)"
    blocks = df.groupBy(SERIES, BLOCK).agg(*map(F.expr, parts)).withColumns(columns_of(means))
    if any(stat.startswith("std") for stat in wanted):
        blocks = blocks.withColumns(columns_of(spreads))
    named = [F.expr(stats[stat].format(i)).alias(f"_{stat}_{m}") for stat in wanted for i, m in enumerate(measures)]
    return join_summary(df, blocks.select(SERIES, BLOCK, *named, *(["_offset"] if offset else [])))
