"""Queries on series: scaling, resampling, gaps, profiles, windows."""

from pyspark.sql import functions as F

from gaugeline.catalog.base import (
    DAILY_BLOCK,
    MEASURES,
    Tables,
    c,
    qr,
    qrs,
    query,
    r,
    rs,
    sql_resample,
)
from gaugeline.operators import blocks as B
from gaugeline.operators import scale, series, windows
from gaugeline.plans import statistics
from gaugeline.session import run_folder

KEY = ["station_id"]
PAIR = ["water_level", "flow_rate"]
#: Short blocks, so that the thirty test days span several of them.
WEEK = "7 days"

def daily_gaps(t: Tables):
    known = F.col("n_readings") >= 2
    return t.daily.select("station_id", "day", F.when(known, F.col("water_level")).alias("water_level"),
                          F.when(known, F.col("flow_rate")).alias("flow_rate"))


def guard(expression: str) -> str:
    return f"CASE WHEN {expression} = 0 THEN 1 ELSE {expression} END"


def sql_scaled(source: str, time: str, measures: list[str], kind: str, over: str) -> str:
    def one(m):
        if kind == "minmax":
            spread = f"(MAX({m}) {over} - MIN({m}) {over})"
            return qr(f"({m} - MIN({m}) {over}) / ({guard(spread)})", m)
        return qr(f"({m} - AVG({m}) {over}) / ({guard(f'(STDDEV_POP({m}) {over})')})", m)

    return f"SELECT station_id, {time}, " + ", ".join(one(m) for m in measures) + f" FROM {source}"


@query("a1_normalize", sql_scaled("hour_wide", "hour", MEASURES, "minmax", "OVER ()"), "hour_wide")
def a1(spark, sf):
    return scale.normalize(Tables(spark, sf).hour_wide, MEASURES).select("station_id", "hour", *rs(MEASURES))


@query("a1_normalize_by_station",
       sql_scaled("daily_load", "day", PAIR, "minmax", "OVER (PARTITION BY station_id)"), "daily_load")
def a1_station(spark, sf):
    return scale.normalize(Tables(spark, sf).daily, PAIR, KEY, "day", DAILY_BLOCK).select(
        "station_id", "day", *rs(PAIR))


@query("a2_standardize", sql_scaled("hour_wide", "hour", MEASURES, "z", "OVER ()"), "hour_wide")
def a2(spark, sf):
    return scale.standardize(Tables(spark, sf).hour_wide, MEASURES).select("station_id", "hour", *rs(MEASURES))


@query("a2_standardize_by_station",
       sql_scaled("daily_load", "day", PAIR, "z", "OVER (PARTITION BY station_id)"), "daily_load")
def a2_station(spark, sf):
    return scale.standardize(Tables(spark, sf).daily, PAIR, KEY, "day", DAILY_BLOCK).select(
        "station_id", "day", *rs(PAIR))


#: Days from this one on are new: they are scaled by statistics of all days, of which the older ones are stored.
NEW_DAY = "1997-01-01"


def with_statistics(spark, t: Tables):
    """The new days, and merged statistics of two stored batches, of which the second was stored twice."""
    path = f"{run_folder(spark, 'statistics')}/days"
    daily = t.daily
    old, new = (daily.filter(f"day {sign} DATE '{NEW_DAY}'") for sign in ("<", ">="))
    for batch, part in (("old", old), ("new", new), ("new", new)):
        statistics.store(part, path, batch, KEY, "day", PAIR)
    return new, statistics.merged(statistics.load(spark, path), KEY, PAIR)


@query("a1_incremental", f"SELECT * FROM ({sql_scaled('daily_load', 'day', PAIR, 'minmax', 'OVER (PARTITION BY station_id)')}) s "
       f"WHERE day >= DATE '{NEW_DAY}'", "daily_load")
def a1_incremental(spark, sf):
    new, stats = with_statistics(spark, Tables(spark, sf))
    return statistics.normalize(new, stats, KEY, PAIR).select("station_id", "day", *rs(PAIR))


@query("a2_incremental", f"SELECT * FROM ({sql_scaled('daily_load', 'day', PAIR, 'z', 'OVER (PARTITION BY station_id)')}) s "
       f"WHERE day >= DATE '{NEW_DAY}'", "daily_load")
def a2_incremental(spark, sf):
    new, stats = with_statistics(spark, Tables(spark, sf))
    return statistics.standardize(new, stats, KEY, PAIR).select("station_id", "day", *rs(PAIR))


def sql_anomaly(source, time, over, threshold):
    return (f"SELECT station_id, {time}, COALESCE(ABS(flow_rate - AVG(flow_rate) {over}) > {threshold} * "
            f"STDDEV_SAMP(flow_rate) {over}, FALSE) AS is_anomaly FROM {source}")


@query("a3_anomalies", sql_anomaly("hour_wide", "hour", "OVER ()", 2.0), "hour_wide")
def a3(spark, sf):
    return scale.flag_anomalies(Tables(spark, sf).hour_wide, "flow_rate", 2.0).select(
        "station_id", "hour", "is_anomaly")


@query("a3_incremental", f"SELECT station_id, day, is_anomaly FROM ({sql_anomaly('daily_load', 'day', 'OVER (PARTITION BY station_id)', 2.0)}) s "
       f"WHERE day >= DATE '{NEW_DAY}'", "daily_load")
def a3_incremental(spark, sf):
    new, stats = with_statistics(spark, Tables(spark, sf))
    return statistics.anomalies(new, stats, KEY, ["flow_rate"], 2.0).select("station_id", "day", F.col("is_anomaly_flow_rate").alias("is_anomaly"))


@query("a3_anomalies_by_station",
       sql_anomaly("daily_load", "day", "OVER (PARTITION BY station_id)", 3.0), "daily_load")
def a3_station(spark, sf):
    return scale.flag_anomalies(Tables(spark, sf).daily, "flow_rate", 3.0, KEY, "day", DAILY_BLOCK).select(
        "station_id", "day", "is_anomaly")


@query("a4_hourly_mean", f"SELECT station_id, date_trunc('hour', ts) AS ts, {qr('AVG(value)', 'value')}, COUNT(*) AS n "
       "FROM reading GROUP BY 1, 2", "reading")
def a4(spark, sf):
    means = series.resample_mean(Tables(spark, sf).reading, KEY, "ts", ["value"], "1H", "n")
    return means.select("station_id", "ts", r("value"), "n")


@query("a4_seven_hour_mean", f"""
SELECT station_id, time_bucket(INTERVAL 7 HOUR, ts, origin) AS ts, {qr('AVG(value)', 'value')}, COUNT(*) AS n
FROM (SELECT *, date_trunc('day', MIN(ts) OVER (PARTITION BY station_id)) AS origin FROM reading) o GROUP BY 1, 2""",
       "reading")
def a4_seven(spark, sf):
    means = series.resample_mean(Tables(spark, sf).reading, KEY, "ts", ["value"], "7h", "n", WEEK)
    return means.select("station_id", "ts", r("value"), "n")


@query("j5_dense_spine", f"""
SELECT s.station_id, s.hour, {qr('h.water_level', 'water_level')}, h.n_readings,
       ROW_NUMBER() OVER (PARTITION BY s.station_id ORDER BY s.hour) - 1 AS step
FROM (SELECT station_id, unnest(generate_series(MIN(hour), MAX(hour), INTERVAL 1 HOUR)) AS hour
      FROM hour_wide GROUP BY 1) s LEFT JOIN hour_wide h USING (station_id, hour)""", "hour_wide")
def j5(spark, sf):
    dense = series.dense_series(Tables(spark, sf).hour_wide, KEY, "hour", ["water_level"], "1H", False,
                                block=WEEK, passed=["n_readings"])
    return dense.select("station_id", "hour", r("water_level"), "n_readings", "step")


@query("w7_forward_fill", f"SELECT station_id, hour, {qrs(MEASURES)} FROM (SELECT station_id, hour, " + ", ".join(
    f"LAST_VALUE({m} IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY hour ROWS UNBOUNDED PRECEDING) AS {m}"
    for m in MEASURES) + " FROM hour_wide) f", "hour_wide")
def w7(spark, sf):
    return series.handle_missing(Tables(spark, sf).hour_wide, "ffill", KEY, "hour", MEASURES, block=WEEK).select(
        "station_id", "hour", *rs(MEASURES))


#: A third of the hours without a time; they come before all others of their station, by their own order.
UNTIMED = """(SELECT station_id, CASE WHEN n_readings % 3 = 0 THEN NULL ELSE hour END AS hour, hour AS was, rainfall, flow_rate
  FROM hour_wide) u"""


@query("w7_rows_without_time", "SELECT station_id, hour, was, " + ", ".join(
    qr(f"LAST_VALUE({m} IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY hour NULLS FIRST, was ROWS UNBOUNDED PRECEDING)", m)
    for m in ("rainfall", "flow_rate")) + f" FROM {UNTIMED}", "hour_wide")
def w7_untimed(spark, sf):
    hours = Tables(spark, sf).hour_wide
    untimed = hours.withColumns({"was": F.col("hour"), "hour": F.when(F.col("n_readings") % 3 != 0, F.col("hour"))})
    return series.forward_fill(untimed, KEY, "hour", ["rainfall", "flow_rate"], tie=["was"], block=WEEK).select(
        "station_id", "hour", "was", *rs(["rainfall", "flow_rate"]))


@query("w7_value_before_all_times", f"SELECT station_id, hour, {qr('COALESCE(LAST_VALUE(rainfall IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY hour ROWS UNBOUNDED PRECEDING), 7.0)', 'rainfall')} "
       "FROM hour_wide UNION ALL SELECT DISTINCT station_id, NULL, 7.0 FROM hour_wide", "hour_wide")
def w7_before(spark, sf):
    """One reading without a time per station, and no tie: it fills what is missing up to the first known value."""
    hours = Tables(spark, sf).hour_wide.select("station_id", "hour", "rainfall")
    lone = hours.groupBy("station_id").agg(F.lit(None).cast("timestamp").alias("hour"), F.lit(7.0).alias("rainfall"))
    filled = series.forward_fill(hours.unionByName(lone), KEY, "hour", ["rainfall"], block=WEEK)
    return filled.select("station_id", "hour", F.when(F.col("hour").isNull(), F.col("rainfall")).otherwise(c(F.col("rainfall"))).alias("rainfall"))


@query("w8_interpolate", f"SELECT station_id, hour, {qrs(MEASURES)} FROM "
       f"({sql_resample('hour_wide', 'hour', '1 HOUR', MEASURES, True, False)}) f", "hour_wide")
def w8(spark, sf):
    return series.handle_missing(Tables(spark, sf).hour_wide, "interpolate", KEY, "hour", MEASURES,
                                 block=WEEK).select("station_id", "hour", *rs(MEASURES))


@query("w8_interpolate_daily", f"SELECT station_id, day, {qrs(PAIR)} FROM "
       f"({sql_resample('daily_gaps', 'day', '1 DAY', PAIR, True, False)}) f", "daily_gaps")
def w8_daily(spark, sf):
    return series.interpolate(daily_gaps(Tables(spark, sf)), KEY, "day", PAIR, block=DAILY_BLOCK).select(
        "station_id", "day", *rs(PAIR))


@query("w9_resample", f"SELECT station_id, hour, step, {qrs(MEASURES)} FROM resampled", "resampled")
def w9(spark, sf):
    dense = series.dense_series(Tables(spark, sf).hour_wide, KEY, "hour", MEASURES, block=WEEK)
    return dense.select("station_id", "hour", "step", *rs(MEASURES))


@query("w9_resample_daily", f"SELECT station_id, day, {qrs(PAIR)} FROM "
       f"({sql_resample('daily_gaps', 'day', '1 DAY', PAIR)}) f", "daily_gaps")
def w9_daily(spark, sf):
    return series.resample(daily_gaps(Tables(spark, sf)), KEY, "day", PAIR, "1D", block=DAILY_BLOCK).select(
        "station_id", "day", *rs(PAIR))


@query("w9_resample_six_hours", f"""
SELECT station_id, ts, {qrs(['value'])} FROM ({sql_resample('six', 'ts', '6 HOUR', ['value'])}) f""", "six")
def w9_six(spark, sf):
    return series.resample(Tables(spark, sf).reading, KEY, "ts", ["value"], "6h", block=WEEK).select(
        "station_id", "ts", r("value"))


@query("w10_missing_flag", """
SELECT s.station_id, s.hour, CASE WHEN h.n_readings IS NULL THEN 3 ELSE 1 END AS data_quality
FROM (SELECT station_id, unnest(generate_series(MIN(hour), MAX(hour), INTERVAL 1 HOUR)) AS hour
      FROM hour_wide GROUP BY 1) s LEFT JOIN hour_wide h USING (station_id, hour)""", "hour_wide")
def w10(spark, sf):
    return series.flag_missing(Tables(spark, sf).hour_wide, KEY, "hour", ["water_level"], block=WEEK).select(
        "station_id", "hour", "data_quality")


@query("w11_daily_profile", f"SELECT station_id, CAST(hour(hour) AS INTEGER) AS hour_of_day, "
       f"{qr('AVG(water_level)', 'profile')}, COUNT(water_level) AS n FROM hour_wide GROUP BY 1, 2", "hour_wide")
def w11(spark, sf):
    return series.daily_profile(Tables(spark, sf).hour_wide, KEY, "hour", "water_level").select(
        "station_id", "hour_of_day", r("profile"), "n")


@query("w11_residual", f"""
SELECT station_id, hour, CAST(hour(hour) AS INTEGER) AS hour_of_day,
       {qr('CASE WHEN water_level IS NOT NULL THEN AVG(water_level) OVER w END', 'profile')},
       {qr('water_level - AVG(water_level) OVER w', 'residual')}
FROM hour_wide WINDOW w AS (PARTITION BY station_id, hour(hour))""", "hour_wide")
def w11_residual(spark, sf):
    out = series.profile_residual(Tables(spark, sf).hour_wide, KEY, "hour", "water_level", WEEK)
    return out.select("station_id", "hour", "hour_of_day", r("profile"), r("residual"))


@query("w11_amplitude", f"SELECT station_id, "
       f"{qr('2 * AVG(water_level * sin(2 * pi() * (hour(hour) - 6) / 24))', 'amplitude')} FROM hour_wide GROUP BY 1",
       "hour_wide")
def w11_amplitude(spark, sf):
    return series.daily_amplitude(Tables(spark, sf).hour_wide, KEY, "hour", "water_level").select(
        "station_id", r("amplitude"))


@query("w12_rain_events", f"""
SELECT station_id, MIN(hour) AS start, MAX(hour) AS end, COUNT(*) AS hours, {qr('SUM(rainfall)', 'total')},
       {qr('MAX(rainfall)', 'peak')}
FROM (SELECT *, SUM(brk) OVER (PARTITION BY station_id ORDER BY hour ROWS UNBOUNDED PRECEDING) AS grp
      FROM (SELECT station_id, hour, rainfall,
                   CASE WHEN LAG(hour) OVER (PARTITION BY station_id ORDER BY hour) = hour - INTERVAL '1' HOUR
                        THEN 0 ELSE 1 END AS brk
            FROM hour_wide WHERE rainfall >= 0.5) a) g
GROUP BY station_id, grp""", "hour_wide")
def w12(spark, sf):
    return series.rain_events(Tables(spark, sf).hour_wide, KEY, block="1 day").select(
        "station_id", "start", "end", "hours", r("total"), r("peak"))


@query("w12_rain_events_half_hour", f"""
SELECT station_id, MIN(hour) AS start, MAX(hour) AS end, COUNT(*) AS hours, {qr('SUM(rainfall)', 'total')},
       {qr('MAX(rainfall)', 'peak')}
FROM (SELECT *, SUM(brk) OVER (PARTITION BY station_id ORDER BY hour ROWS UNBOUNDED PRECEDING) AS grp
      FROM (SELECT station_id, hour + INTERVAL 30 MINUTE AS hour, rainfall,
                   CASE WHEN LAG(hour) OVER (PARTITION BY station_id ORDER BY hour) = hour - INTERVAL '1' HOUR
                        THEN 0 ELSE 1 END AS brk
            FROM hour_wide WHERE rainfall >= 0.5) a) g
GROUP BY station_id, grp""", "hour_wide")
def w12_half_hour(spark, sf):
    """Bins between the whole hours: events that cross a block border stay whole."""
    shifted = Tables(spark, sf).hour_wide.withColumn("hour", F.col("hour") + F.expr("INTERVAL 30 MINUTES"))
    return series.rain_events(shifted, KEY, block="1 day").select("station_id", "start", "end", "hours", r("total"), r("peak"))


@query("w12_repeated_hours", f"""
SELECT station_id, MIN(hour) AS start, MAX(hour) AS end, COUNT(DISTINCT hour) AS hours, {qr('SUM(rainfall)', 'total')},
       {qr('MAX(rainfall)', 'peak')}
FROM (SELECT *, SUM(brk) OVER (PARTITION BY station_id ORDER BY hour) AS grp
      FROM (SELECT station_id, hour, rainfall,
                   CASE WHEN hour - LAG(hour) OVER (PARTITION BY station_id ORDER BY hour) <= INTERVAL '1' HOUR THEN 0 ELSE 1 END AS brk
            FROM (SELECT * FROM hour_wide UNION ALL SELECT * FROM hour_wide WHERE n_readings % 2 = 0) d WHERE rainfall >= 0.5) a) g
GROUP BY station_id, grp""", "hour_wide")
def w12_repeated(spark, sf):
    """Every other hour twice: an event stays one, and its hour one hour."""
    hours = Tables(spark, sf).hour_wide
    twice = hours.unionByName(hours.filter("n_readings % 2 = 0"))
    return series.rain_events(twice, KEY, block="1 day").select("station_id", "start", "end", "hours", r("total"), r("peak"))


@query("w12_incremental", f"""
SELECT station_id, MIN(hour) AS start, MAX(hour) AS end, COUNT(*) AS hours, {qr('SUM(rainfall)', 'total')},
       {qr('MAX(rainfall)', 'peak')}
FROM (SELECT *, SUM(brk) OVER (PARTITION BY station_id ORDER BY hour ROWS UNBOUNDED PRECEDING) AS grp
      FROM (SELECT station_id, hour, rainfall,
                   CASE WHEN LAG(hour) OVER (PARTITION BY station_id ORDER BY hour) = hour - INTERVAL '1' HOUR
                        THEN 0 ELSE 1 END AS brk
            FROM hour_wide WHERE rainfall >= 0.5) a) g
GROUP BY station_id, grp""", "hour_wide")
def w12_incremental(spark, sf):
    """Every day appended by itself, odd ones before even ones and one of them twice; the events are those of the whole table."""
    run = run_folder(spark, "rain")
    hours = Tables(spark, sf).hour_wide.withColumn("day", F.to_date("hour"))
    hours.write.partitionBy("day").parquet(f"{run}/hours")
    stored = spark.read.parquet(f"{run}/hours")
    days = sorted((r.day for r in stored.select("day").distinct().collect()), key=lambda d: (-(d.day % 2), d))
    for day in [*days, *days[:1]]:
        series.store_rain_runs(stored.filter(F.col("day") == F.lit(day)), f"{run}/runs", str(day), KEY)
    return series.read_rain_events(spark, f"{run}/runs", KEY).select("station_id", "start", "end", "hours", r("total"), r("peak"))


# Windows.

def sql_windows(source: str, time: str, feature: str, horizon: int = 1, label: str = "") -> str:
    ahead = f"(PARTITION BY station_id ORDER BY {time})"
    over = f"OVER (PARTITION BY station_id ORDER BY {time} ROWS BETWEEN CURRENT ROW AND 71 FOLLOWING)"
    return (f"SELECT station_id, {time} AS window_start, window_id, first_value AS first, last_value AS last, "
            f"{qr('total', 'total', 4)}{label} FROM (SELECT *, "
            f"ROW_NUMBER() OVER {ahead} - 1 AS window_id, {feature} AS first_value, "
            f"LEAD({feature}, 71) OVER {ahead} AS last_value, SUM({feature}) {over} AS total, "
            f"LEAD({time}, {71 + horizon}) OVER {ahead} AS following FROM {source}) w WHERE following IS NOT NULL")


def fingerprint(windows_df, time_col, *extra):
    """First, last and sum of the first feature of each window."""
    first = F.transform("window", lambda x: x[0])
    return windows_df.select(
        "station_id", "window_start", "window_id", F.element_at(first, 1).alias("first"),
        F.element_at(first, -1).alias("last"),
        c(F.aggregate(first, F.lit(0.0), lambda a, x: a + x), 4).alias("total"), *extra)


@query("w1_sliding_windows", sql_windows("(SELECT station_id, hour, CAST(n_readings AS DOUBLE) AS n FROM hour_wide) h",
                                         "hour", "n"), "hour_wide")
def w1(spark, sf):
    found = windows.sliding_windows(Tables(spark, sf).hour_wide, KEY, "hour", ["n_readings"], block=WEEK, chunk=256)
    return fingerprint(found, "hour")


@query("w1_sliding_windows_daily", sql_windows("daily_load", "day", "flow_rate"), "daily_load")
def w1_daily(spark, sf):
    return fingerprint(windows.sliding_windows(
        Tables(spark, sf).daily, KEY, "day", ["flow_rate", "water_level"], block=DAILY_BLOCK), "day")


@query("w1_window_positions", f"""
WITH numbered AS (SELECT station_id, hour, ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY hour) - 1 AS i,
    COUNT(*) OVER (PARTITION BY station_id) AS n, n_readings::DOUBLE AS readings, rainfall FROM hour_wide)
SELECT w.station_id, w.hour AS window_start, w.i AS window_id, CAST(s.i - w.i AS INTEGER) AS pos, s.readings, {qr('s.rainfall', 'rainfall')}
FROM numbered w JOIN numbered s ON s.station_id = w.station_id AND s.i BETWEEN w.i AND w.i + 11 WHERE w.i + 12 < w.n""", "hour_wide")
def w1_positions(spark, sf):
    """Every feature at every position of windows of 12 rows."""
    found = windows.sliding_windows(Tables(spark, sf).hour_wide, KEY, "hour", ["n_readings", "rainfall"], 12, block=WEEK, chunk=64)
    return found.select("station_id", "window_start", "window_id", F.posexplode("window").alias("pos", "row")).select(
        "station_id", "window_start", "window_id", "pos", F.col("row")[0].alias("readings"), c(F.col("row")[1]).alias("rainfall"))


@query("w1_holes", """
SELECT station_id, COUNT(*) - 5 AS windows FROM hour_wide GROUP BY 1 HAVING COUNT(*) > 5""", "hour_wide")
def w1_holes(spark, sf):
    """A given position that counts from any number on, checked to have no hole, gives the windows of the series."""
    hours = Tables(spark, sf).hour_wide
    placed = B.row_index(B.with_block(hours, KEY, "hour", WEEK), ["hour"])
    numbered = B.restore(placed.withColumn("place", F.col("_idx") + 1000), [*hours.columns, "place"], KEY)
    found = windows.sliding_windows(numbered, KEY, "hour", ["n_readings"], 5, position="place", chunk=64)
    return found.groupBy("station_id").agg(F.count(F.lit(1)).alias("windows"))


SCALED_DAILY = ("(SELECT station_id, day, " + ", ".join(
    f"({m} - AVG({m}) OVER s) / CASE WHEN STDDEV_POP({m}) OVER s = 0 THEN 1 ELSE STDDEV_POP({m}) OVER s END AS {m}"
    for m in ["flow_rate", "rainfall", "water_level"]) + " FROM daily_load WINDOW s AS (PARTITION BY station_id)) z")


def pairs(t: Tables, horizon: int):
    return windows.training_pairs(t.daily, KEY, "day", ["flow_rate", "rainfall"], "water_level", horizon=horizon,
                                  block=DAILY_BLOCK)


def edges(found):
    return found.withColumns({"first": c(F.col("first")), "last": c(F.col("last"))})


@query("w2_training_pairs", f"SELECT station_id, window_start, window_id, {qr('first', 'first')}, {qr('last', 'last')}, "
       f"total, {qr('label', 'label')} FROM ("
       + sql_windows(f"(SELECT *, LEAD(water_level, 72) OVER (PARTITION BY station_id ORDER BY day) AS label "
                     f"FROM {SCALED_DAILY}) l", "day", "flow_rate", 1, ", label") + ") e", "daily_load")
def w2(spark, sf):
    found = fingerprint(pairs(Tables(spark, sf), 1), "day", c(F.col("label")[0]).alias("label"))
    return edges(found)


@query("w3_horizon_labels", f"SELECT station_id, window_start, window_id, {qr('label_first', 'label_first')}, "
       f"{qr('label_last', 'label_last')}, {qr('label_sum', 'label_sum', 4)} FROM ("
       + sql_windows(f"(SELECT *, LEAD(water_level, 72) OVER d AS label_first, LEAD(water_level, 95) OVER d AS label_last, "
                     f"SUM(water_level) OVER (PARTITION BY station_id ORDER BY day ROWS BETWEEN 72 FOLLOWING "
                     f"AND 95 FOLLOWING) AS label_sum FROM {SCALED_DAILY} WINDOW d AS (PARTITION BY station_id ORDER BY day)) l",
                     "day", "flow_rate", 24, ", label_first, label_last, label_sum") + ") e", "daily_load")
def w3(spark, sf):
    found = pairs(Tables(spark, sf), 24)
    total = F.aggregate("label", F.lit(0.0), lambda a, x: a + x)
    return found.select(
        "station_id", "window_start", "window_id", c(F.element_at("label", 1)).alias("label_first"),
        c(F.element_at("label", -1)).alias("label_last"), c(total, 4).alias("label_sum"))


LAST_ROWS = """(SELECT *, n_rows - rank + 1 AS pos FROM (SELECT *, COUNT(*) OVER (PARTITION BY station_id) AS n_rows
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY day DESC) AS rank FROM daily_load) a
  WHERE rank <= 72) b) t"""


@query("w4_last_rows", f"SELECT station_id, day, pos, n_rows, {qrs(PAIR)} FROM {LAST_ROWS}", "daily_load")
def w4(spark, sf):
    return windows.last_rows(Tables(spark, sf).daily, KEY, "day").select(
        "station_id", "day", F.col("pos").cast("long").alias("pos"), F.col("n_rows").cast("long").alias("n_rows"),
        *rs(PAIR))


@query("w5_scale_history", "SELECT station_id, day, " + ", ".join(
    qr(f"({m} - AVG({m}) OVER s) / CASE WHEN STDDEV_POP({m}) OVER s = 0 THEN 1 ELSE STDDEV_POP({m}) OVER s END", m)
    for m in PAIR) + f" FROM {LAST_ROWS} WINDOW s AS (PARTITION BY station_id)", "daily_load")
def w5(spark, sf):
    recent = windows.last_rows(Tables(spark, sf).daily, KEY, "day")
    return windows.scale_history(recent, KEY, PAIR).select("station_id", "day", *rs(PAIR))


@query("w6_unscale", f"SELECT station_id, CAST(pos AS INTEGER) AS pos, {qr('water_level', 'level')} FROM {LAST_ROWS}",
       "daily_load")
def w6(spark, sf):
    scaled = windows.scale_history(windows.last_rows(Tables(spark, sf).daily, KEY, "day"), KEY, ["water_level"])
    packed = scaled.groupBy("station_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "water_level"))).alias("s"),
        F.max("mean_water_level").alias("mean"), F.max("std_water_level").alias("std"))
    levels = windows.unscale(F.transform("s", lambda x: x["water_level"]), F.col("mean"), F.col("std"))
    return packed.select("station_id", F.posexplode(levels).alias("at", "level")).select(
        "station_id", (F.col("at") + 1).alias("pos"), r("level"))


ATTENTION = f"""(SELECT *, EXP(energy - MAX(energy) OVER s) / SUM(EXP(energy - peak)) OVER s AS weight
  FROM (SELECT *, water_level / 10 AS energy, MAX(water_level / 10) OVER (PARTITION BY station_id) AS peak
        FROM {LAST_ROWS}) p WINDOW s AS (PARTITION BY station_id)) a"""


def attention(t: Tables):
    steps = windows.last_rows(t.daily, KEY, "day").withColumn("energy", F.col("water_level") / 10)
    return windows.attention_pool(steps, KEY, "energy", PAIR)


@query("w13_attention_weights", f"SELECT station_id, day, {qr('weight', 'weight')} FROM {ATTENTION}", "daily_load")
def w13(spark, sf):
    return attention(Tables(spark, sf))[0].select("station_id", "day", r("weight"))


@query("w13_attention_context", f"SELECT station_id, {qr('SUM(weight)', 'total_weight')}, "
       f"{qr('SUM(weight * water_level)', 'context_water_level')}, {qr('SUM(weight * flow_rate)', 'context_flow_rate')} "
       f"FROM {ATTENTION} GROUP BY 1", "daily_load")
def w13_context(spark, sf):
    return attention(Tables(spark, sf))[1].select(
        "station_id", *rs(["total_weight", "context_water_level", "context_flow_rate"]))


@query("w13_attention_arrays", f"""
SELECT station_id, window_id, {qr('SUM(EXP(level / 10) * level) / SUM(EXP(level / 10))', 'context_water_level')}
FROM (SELECT w.station_id, w.i AS window_id, x.water_level AS level
      FROM (SELECT *, COUNT(*) OVER (PARTITION BY station_id) AS n FROM numbered) w
      JOIN numbered x ON x.station_id = w.station_id AND x.i BETWEEN w.i AND w.i + 71
      WHERE w.i + 72 < w.n) s GROUP BY 1, 2""", "numbered")
def w13_arrays(spark, sf):
    dense = Tables(spark, sf).resampled.filter("water_level IS NOT NULL")
    found = windows.sliding_windows(dense, KEY, "hour", ["water_level"], block=WEEK, chunk=128)
    energy = F.transform("window", lambda x: x[0] / 10)
    return found.withColumn("context", windows.pool_window(F.col("window"), energy)).select(
        "station_id", "window_id", c(F.col("context")[0]).alias("context_water_level"))
