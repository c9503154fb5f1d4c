"""Forecasts for all stations in one plan: history, score, grade, record."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import constants as C
from gaugeline.functions import as_moment, guarded, rounded
from gaugeline.operators import kpis, risk, series, windows

#: A scorer turns the columns of :func:`histories` into an array of ``horizon`` levels.
Scorer = Callable[[int], Column]


def persistence(horizon: int = C.HORIZON) -> Column:
    """The last level, held."""
    return F.array_repeat(F.element_at("levels", -1), horizon)


def seasonal_naive(horizon: int = C.HORIZON, season: int = 24) -> Column:
    """The level one season earlier."""
    steps = F.sequence(F.lit(0), F.lit(horizon - 1))
    return F.transform(steps, lambda h: F.element_at("levels", (h % season) - season))


def trend(horizon: int = C.HORIZON) -> Column:
    """The least-squares line through the history, continued."""
    steps = F.sequence(F.lit(1), F.lit(horizon))
    return F.transform(steps, lambda h: F.col("intercept") + F.col("slope") * (F.col("n_rows") + h))


SCORERS: dict[str, Scorer] = {
    "persistence": persistence, "seasonal_naive": seasonal_naive, "trend": trend}


def histories(dense: DataFrame, keys: Sequence[str], time_col: str,
              features: Sequence[str] = tuple(C.FEATURES), target: str = C.TARGET,
              length: int = C.WINDOW_ROWS) -> DataFrame:
    """One row per series: its last ``length`` rows as arrays, with their statistics.

    ``levels`` is the target oldest first, ``rows`` the features, ``means`` and
    ``stds`` their own-window statistics, ``slope`` and ``intercept`` the trend.
    Only ``length`` rows per series get past the rank filter, so the arrays are small.
    """
    recent = windows.last_rows(dense, keys, time_col, length)
    names = list(dict.fromkeys([target, *features]))
    pairs = F.array_sort(F.collect_list(F.struct("pos", *names)))
    packed = recent.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(time_col).alias("last_time"), pairs.alias("_steps"),
        F.regr_slope(F.col(target), F.col("pos")).alias("slope"),
        F.regr_intercept(F.col(target), F.col("pos")).alias("intercept"),
        F.array(*[F.avg(f) for f in features]).alias("means"),
        F.array(*[guarded(F.stddev_pop(f)) for f in features]).alias("stds"),
        F.avg(target).alias("target_mean"), guarded(F.stddev_pop(target)).alias("target_std"))
    return packed.withColumns({
        "levels": F.transform("_steps", lambda s: s[target]),
        "rows": F.transform("_steps", lambda s: F.array(*[s[f] for f in features]))}).drop("_steps")


def scaled_input() -> Column:
    """The history scaled by its own mean and deviation, flattened to one vector."""
    def scale_row(row):
        centred = F.zip_with(row, F.col("means"), lambda x, m: x - m)
        return F.zip_with(centred, F.col("stds"), lambda x, s: x / s)

    return F.flatten(F.transform("rows", scale_row))


def long_enough(history: DataFrame, length: int = C.WINDOW_ROWS) -> DataFrame:
    return history.filter(F.col("n_rows") >= length)


def too_short(dense: DataFrame, keys: Sequence[str], length: int = C.WINDOW_ROWS) -> DataFrame:
    """Series that cannot be forecast, with the reason."""
    counts = dense.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    reason = F.format_string("insufficient history: %s of %s rows",
                             F.col("n_rows").cast("string"), F.lit(str(length)))
    return counts.filter(F.col("n_rows") < length).withColumn("reason", reason)


def score(history: DataFrame, scorer="seasonal_naive", horizon: int = C.HORIZON) -> DataFrame:
    """Adds ``predicted``, the unrounded levels of the next ``horizon`` hours.

    ``scorer`` is a name in :data:`SCORERS` or a fitted model. Scaling the input
    and un-scaling the output happen only for a model, which needs them.
    """
    if isinstance(scorer, str):
        return history.withColumn("predicted", SCORERS[scorer](horizon))
    scaled = scorer.predict(history, scaled_input())
    return scaled.withColumn("predicted", windows.unscale(
        F.col("predicted"), F.col("target_mean"), F.col("target_std")))


def assess(scored: DataFrame, as_of=None, station: str = "station_id", horizon: int = C.HORIZON) -> DataFrame:
    """Result rows: the highest level, its grade, and the hourly levels of the next ``horizon`` hours.

    The grade is taken from the unrounded maximum; rounding is for output.
    """
    scored = scored.withColumn("predicted", F.slice("predicted", 1, horizon))
    peak = scored.withColumn("_peak", F.array_max("predicted"))
    hourly = F.transform("predicted", lambda level, i: F.struct(
        (i + 1).alias("hour"), rounded(level).alias("level")))
    return risk.with_grade(peak, "_peak").withColumns({
        "location_id": F.col(station), "predict_time": as_moment(as_of),
        "max_predicted_water_level": rounded(F.col("_peak")),
        "hourly_predictions": hourly}).select(
        "location_id", "predict_time", "max_predicted_water_level", "hourly_predictions",
        "risk_level", "risk_name", "confidence", "n_rows", "last_time")


def forecast_all(dense: DataFrame, stations: DataFrame, scorer="seasonal_naive",
                 keys: Sequence[str] = ("station_id",), time_col: str = "hour",
                 features: Sequence[str] = tuple(C.FEATURES), length: int = C.WINDOW_ROWS,
                 horizon: int = C.HORIZON, as_of=None) -> DataFrame:
    """Forecast and grade of every station with enough history, with its name."""
    history = long_enough(histories(dense, keys, time_col, features, C.TARGET, length), length)
    result = assess(score(history, scorer, horizon), as_of, keys[0], horizon)
    return kpis.with_station_name(result, stations, "location_id")


def recent_series(readings_hourly: DataFrame, keys: Sequence[str] = ("station_id",),
                  time_col: str = "hour", measures: Sequence[str] = tuple(C.FEATURES),
                  length: int = C.WINDOW_ROWS, interval: str = C.SAMPLING) -> DataFrame:
    """The last ``length`` bins per station, resampled; what a forecast needs and no more."""
    return series.dense_series(readings_hourly, keys, time_col, measures, interval, True, length)


def prediction_records(results: DataFrame, model_version: str) -> DataFrame:
    """One storage row per station and hour ahead."""
    summary = F.to_json(F.struct("n_rows", F.date_format("last_time", "yyyy-MM-dd HH:mm:ss")
                                 .alias("last_time")))
    return results.withColumn("input_data_summary", summary).select(
        "location_id", "predict_time", F.inline("hourly_predictions").alias("predict_hour", "level"),
        "risk_level", "confidence", "input_data_summary").select(
        "location_id", "predict_time", "predict_hour", F.col("level").alias("predicted_water_level"),
        F.col("confidence").alias("confidence_score"), "risk_level",
        F.lit(model_version).alias("model_version"), "input_data_summary")


def mean_squared_error(pairs: DataFrame, by: Sequence[str] = (), predicted: str = "predicted",
                       actual: str = "actual") -> DataFrame:
    """Mean squared error of forecasts against actual levels."""
    error = F.pow(F.col(predicted) - F.col(actual), F.lit(2))
    return pairs.groupBy(*by).agg(F.avg(error).alias("mse"), F.count(error).alias("n"))
