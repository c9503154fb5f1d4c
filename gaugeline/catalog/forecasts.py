"""Queries on forecasts: eligibility, scorers, risk results, records, errors."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gaugeline import constants as C
from gaugeline import functions as G
from gaugeline.catalog.base import (
    AS_OF,
    DAILY_BLOCK,
    VIEWS,
    Tables,
    half_up,
    qr,
    query,
    r,
    sql_confidence,
    sql_grade,
    sql_risk_name,
)
from gaugeline.operators import windows
from gaugeline.plans import forecast, model, monitor, tail
from gaugeline.session import run_folder
from gaugeline.sources import dims, tables

KEY = ["station_id"]

# Series of hours that saw the same number of readings: long and short ones.
VIEWS["by_count"] = (("hour_wide",), """
SELECT station_id || '/' || CAST(n_readings AS VARCHAR) AS station_id, hour, water_level FROM hour_wide""")
VIEWS["last72"] = (("resampled",), """
SELECT *, COUNT(*) OVER (PARTITION BY station_id) AS n, 73 - rn AS pos
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY hour DESC) AS rn FROM resampled) t
WHERE rn <= 72""")
VIEWS["seasonal"] = (("last72",), """
SELECT station_id, 25 - rn AS hour_ahead, water_level AS level FROM last72 WHERE rn <= 24 AND n = 72""")
VIEWS["forecast_result"] = (("seasonal", "station"), f"""
SELECT p.station_id AS location_id, COALESCE(s.name, p.station_id) AS station_name, mx,
       {half_up('mx')} AS max_predicted_water_level, {sql_grade('mx')} AS risk_level,
       {sql_risk_name('mx')} AS risk_name, {sql_confidence('mx')} AS confidence
FROM (SELECT station_id, MAX(level) AS mx FROM seasonal GROUP BY 1) p LEFT JOIN station s ON s.id = p.station_id""")


def by_count(t: Tables):
    key = F.concat_ws("/", "station_id", F.col("n_readings").cast("string"))
    return t.hour_wide.withColumn("station_id", key)


@query("j6_long_enough", """
SELECT station_id, hour FROM by_count QUALIFY COUNT(*) OVER (PARTITION BY station_id) >= 72""", "by_count")
def j6(spark, sf):
    rows = by_count(Tables(spark, sf))
    enough = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).filter("n >= 72")
    return rows.join(enough, KEY, "left_semi").select("station_id", "hour")


SHORT = """
SELECT station_id, COUNT(*) AS n_rows, 'insufficient history: ' || CAST(COUNT(*) AS VARCHAR) || ' of 72 rows' AS reason
FROM by_count GROUP BY 1 HAVING COUNT(*) < 72"""


@query("j7_too_short", """
SELECT DISTINCT station_id FROM by_count b WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT station_id FROM by_count GROUP BY 1 HAVING COUNT(*) >= 72) e WHERE e.station_id = b.station_id)""",
       "by_count")
def j7(spark, sf):
    rows = by_count(Tables(spark, sf))
    counts = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(counts.filter("n >= 72"), KEY, "left_anti").select("station_id")


@query("f7_insufficient_history", SHORT, "by_count")
def f7(spark, sf):
    return forecast.too_short(by_count(Tables(spark, sf)), KEY)


@query("f1_time_split", """
SELECT station_id, day, epoch(day)::BIGINT <= epoch(MIN(day) OVER s)::BIGINT
       + FLOOR((epoch(MAX(day) OVER s) - epoch(MIN(day) OVER s)) * CAST(0.8 AS DOUBLE)) AS is_train
FROM daily_load WINDOW s AS (PARTITION BY station_id)""", "daily_load")
def f1(spark, sf):
    return model.time_split(Tables(spark, sf).daily, KEY, "day", 0.8, block=DAILY_BLOCK).select(
        "station_id", "day", "is_train")


@query("f1_cutoff_split", """
SELECT station_id, hour, hour <= TIMESTAMP '2024-01-20 00:00:00' AS is_train FROM hour_wide""", "hour_wide")
def f1_cutoff(spark, sf):
    return model.time_split(Tables(spark, sf).hour_wide, KEY, "hour", cutoff="2024-01-20 00:00:00").select(
        "station_id", "hour", "is_train")


def history(t: Tables):
    return forecast.long_enough(forecast.histories(forecast.recent_series(t.hour_wide), KEY, "hour"))


def hours_ahead(scored):
    return scored.select("station_id", F.posexplode("predicted").alias("i", "level")).select(
        "station_id", (F.col("i") + 1).alias("hour_ahead"), r("level"))


@query("f4_persistence", f"""
SELECT station_id, CAST(unnest(range(1, 25)) AS INTEGER) AS hour_ahead, {qr('water_level', 'level')}
FROM last72 WHERE rn = 1 AND n = 72""", "last72")
def f4_persistence(spark, sf):
    return hours_ahead(forecast.score(history(Tables(spark, sf)), "persistence"))


@query("f4_seasonal_naive", f"SELECT station_id, CAST(hour_ahead AS INTEGER) AS hour_ahead, {qr('level', 'level')} FROM seasonal",
       "seasonal")
def f4_seasonal(spark, sf):
    return hours_ahead(forecast.score(history(Tables(spark, sf)), "seasonal_naive"))


@query("f4_trend", f"""
SELECT station_id, CAST(h AS INTEGER) AS hour_ahead, {qr('a + b * (72 + h)', 'level')}
FROM (SELECT station_id, regr_intercept(water_level, pos) AS a, regr_slope(water_level, pos) AS b,
             unnest(range(1, 25)) AS h FROM last72 WHERE n = 72 GROUP BY station_id) t""", "last72")
def f4_trend(spark, sf):
    return hours_ahead(forecast.score(history(Tables(spark, sf)), "trend"))


def fitted(t: Tables) -> model.LevelModel:
    """Model on the hourly series of all stations, split by time."""
    return model.fit_series(t.resampled, KEY, "hour", position="step")


@query("f2_fit_loss_history")
def f2(spark, sf):
    return fitted(Tables(spark, sf)).loss_history(spark)


def level_windows(t: Tables, length: int, horizon: int):
    """Windows of unscaled levels with the levels that follow."""
    rows = t.resampled.filter("water_level IS NOT NULL").select("station_id", "hour", "water_level")
    return windows.sliding_windows(rows, KEY, "hour", ["water_level"], length, "water_level", horizon)


#: Two levels of a series in a row, and three.
VIEWS["steps"] = (("numbered",), """
SELECT station_id, i, water_level AS x, LEAD(water_level) OVER w AS y, LEAD(water_level, 2) OVER w AS z
FROM numbered WINDOW w AS (PARTITION BY station_id ORDER BY i)""")
#: So weak a ridge that the fit is the line of least squares.
LINE = {"version": "line", "strengths": (1e-12,)}


@query("f2_inner_products", f"""
WITH ahead AS (SELECT water_level AS a, LEAD(water_level, 1) OVER w AS b, LEAD(water_level, 2) OVER w AS c,
                      LEAD(water_level, 3) OVER w AS d, LEAD(water_level, 4) OVER w AS e
               FROM numbered WINDOW w AS (PARTITION BY station_id ORDER BY i)),
whole AS (SELECT [1.0::DOUBLE, a, b, c, d, e] AS r FROM ahead WHERE e IS NOT NULL)
SELECT CAST(p.i AS INTEGER) AS i, CAST(q.j AS INTEGER) AS j, {qr('SUM(r[p.i + 1] * r[q.j + 1])', 'total', 3)}
FROM whole, range(6) p(i), range(6) q(j) GROUP BY 1, 2""", "numbered")
def f2_inner(spark, sf):
    """Every cell of the matrix that the fit solves, for windows of 3 hours and 2 hours ahead."""
    products = model.inner_products(level_windows(Tables(spark, sf), 3, 2))
    cells = [(i, j, float(x)) for i, row in enumerate(products) for j, x in enumerate(row)]
    return dims.local_table(spark, cells, i=pa.int32(), j=pa.int32(), total=pa.float64()).select("i", "j", r("total", 3))


@query("f2_normal_equations", "SELECT CAST(unnest(range(1, 25)) AS INTEGER) AS hour_ahead, TRUE AS solved")
def f2_solved(spark, sf):
    """Whether the coefficients solve the ridge equations of each hour ahead."""
    rows = Tables(spark, sf).resampled.filter("water_level IS NOT NULL")
    pairs = windows.training_pairs(rows, KEY, "hour", ["water_level"], horizon=24)
    found, products = model.fit(pairs, strengths=(0.01,)), model.inner_products(pairs)
    p, n = products.shape[0] - 24, products[0, 0]
    ridge = found.strength * n * np.diag([0.0] + [1.0] * (p - 1))
    beta = np.vstack([found.intercepts, found.weights.T])
    left = np.abs((products[:p, :p] + ridge) @ beta - products[:p, p:]).max(axis=0) / n
    return dims.local_table(spark, [(h + 1, bool(x < 1e-6)) for h, x in enumerate(left)],
                            hour_ahead=pa.int32(), solved=pa.bool_())


@query("f3_loss_of_fit", f"""
SELECT {qr('loss', 'train_loss')}, {qr('loss', 'scored_loss')}, n AS windows
FROM (SELECT (regr_syy(y, x) - regr_sxy(y, x) ** 2 / regr_sxx(y, x)) / COUNT(y) AS loss, COUNT(y) AS n FROM steps) s""",
       "steps")
def f3_loss(spark, sf):
    """The loss that the fit reports, and the loss of all windows scored with its coefficients."""
    pairs = level_windows(Tables(spark, sf), 1, 1)
    found = model.fit(pairs, horizon=1, **LINE)
    scored = found.predict(pairs, F.flatten("window"))
    return scored.agg(
        F.avg(F.pow(F.col("predicted")[0] - F.col("label")[0], 2)).alias("scored_loss"), F.count(F.lit(1)).alias("windows")
    ).withColumn("train_loss", F.lit(found.losses[0][2])).select(r("train_loss"), r("scored_loss"), "windows")


@query("f4_lines", f"""
SELECT CAST(1 AS INTEGER) AS hour_ahead, {qr('regr_intercept(y, x)', 'intercept')}, {qr('regr_slope(y, x)', 'slope')}
FROM steps WHERE z IS NOT NULL
UNION ALL SELECT 2, {qr('regr_intercept(z, x)', 'intercept')}, {qr('regr_slope(z, x)', 'slope')} FROM steps""", "steps")
def f4_lines(spark, sf):
    """With a window of one hour the model is a line of regression per hour ahead."""
    found = model.fit(level_windows(Tables(spark, sf), 1, 2), horizon=2, **LINE)
    return found.coefficients(spark).withColumn("slope", F.col("weights")[0]).select("hour_ahead", r("intercept"), r("slope"))


@query("s9_saved_model", f"""
SELECT station_id, i AS window_id, {qr('a + b * x', 'level')}
FROM steps, (SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM steps) f WHERE y IS NOT NULL""", "steps")
def s9(spark, sf):
    """Fit, save, load, and score every window with the loaded model."""
    pairs, path = level_windows(Tables(spark, sf), 1, 1), run_folder(spark, "model")
    model.fit(pairs, horizon=1, **LINE).save(spark, path)
    scored = model.LevelModel.load(spark, path).predict(pairs, F.flatten("window"))
    return scored.select("station_id", "window_id", F.col("predicted")[0].alias("level")).select(
        "station_id", "window_id", r("level"))


@query("s10_measured_accuracy", f"""
SELECT 'line' AS version, ROUND(GREATEST(0, 1 - loss / var_pop), 4) AS accuracy,
       strftime(lo, '%Y-%m-%d %H:%M:%S') || ' .. ' || strftime(hi, '%Y-%m-%d %H:%M:%S') AS training_data_range,
       CAST(1 AS SMALLINT) AS status
FROM (SELECT (regr_syy(y, x) - regr_sxy(y, x) ** 2 / regr_sxx(y, x)) / COUNT(y) AS loss, VAR_POP(y) FILTER (WHERE y IS NOT NULL) AS var_pop FROM steps) s,
     (SELECT MIN(hour) AS lo, MAX(hour) AS hi FROM resampled WHERE water_level IS NOT NULL) h""", "steps", "resampled")
def s10_measured(spark, sf):
    """The accuracy that is registered is the share of the variance that the fitted model explains, by its own loss."""
    t, path = Tables(spark, sf), f"{run_folder(spark, 'models')}/versions"
    pairs = level_windows(t, 1, 1)
    found = model.fit(pairs, horizon=1, **LINE)
    accuracy = pairs.agg(F.var_pop(F.col("label")[0]).alias("v")).select(model.explained(found, F.col("v"))).scalar()
    row = tables.register_model("line", t.resampled.filter("water_level IS NOT NULL"), "hour", {"horizon": 1}, accuracy, "line of regression", AS_OF)
    tables.append(row, "model_version", path, "line")
    return tables.read_table(spark, path, "model_version").select(
        "version", F.col("accuracy").cast("double").alias("accuracy"), "training_data_range", "status")


@query("f4_linear_model")
def f4_linear(spark, sf):
    t = Tables(spark, sf)
    return hours_ahead(forecast.score(history(t), fitted(t)))


@query("f5_flood_risk", f"""
SELECT location_id, TIMESTAMP '{AS_OF}' AS predict_time, max_predicted_water_level, risk_level, risk_name, confidence
FROM forecast_result""", "forecast_result")
def f5(spark, sf):
    scored = forecast.score(history(Tables(spark, sf)))
    return forecast.assess(scored, AS_OF).select(
        "location_id", "predict_time", "max_predicted_water_level", "risk_level", "risk_name", "confidence")


@query("f6_forecast_all", """
SELECT location_id, station_name, max_predicted_water_level, risk_level, risk_name, confidence, CAST(24 AS INTEGER) AS horizon
FROM forecast_result""", "forecast_result")
def f6(spark, sf):
    t = Tables(spark, sf)
    return monitor.flood_forecast(t.hour_wide, t.stations, as_of=AS_OF).select(
        "location_id", "station_name", "max_predicted_water_level", "risk_level", "risk_name", "confidence",
        F.size("hourly_predictions").alias("horizon"))


@query("f6_tail_index", """
SELECT location_id, station_name, max_predicted_water_level, risk_level, risk_name, confidence, CAST(24 AS INTEGER) AS horizon
FROM forecast_result""", "forecast_result")
def f6_tail(spark, sf):
    """From a stored table of which only the days are opened that the last 72 hours of a station depend on."""
    t, path = Tables(spark, sf), run_folder(spark, "tail")
    hours = t.hour_wide.withColumn("day", F.to_date("hour"))
    hours.write.partitionBy("day").parquet(f"{path}/hours")
    stored = spark.read.parquet(f"{path}/hours")
    half = F.lit(AS_OF).cast("timestamp")
    for batch, part in (("old", stored.filter(F.col("hour") < half)), ("new", stored.filter(F.col("hour") >= half)), ("new", stored.filter(F.col("hour") >= half))):
        tail.store_index(part, f"{path}/index", batch, KEY, "hour", C.FEATURES)
    days = tail.tail_days(tail.load(spark, f"{path}/index"), KEY, C.FEATURES)
    recent = tail.read_tail(stored, days, KEY).drop("day")
    return monitor.flood_forecast(recent, t.stations, as_of=AS_OF).select(
        "location_id", "station_name", "max_predicted_water_level", "risk_level", "risk_name", "confidence",
        F.size("hourly_predictions").alias("horizon"))


@query("f6_forecast_daily", f"""
SELECT station_id AS location_id, {half_up('MAX(water_level)')} AS max_predicted_water_level,
       {sql_grade('MAX(water_level)')} AS risk_level
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY day DESC) AS rn,
             COUNT(*) OVER (PARTITION BY station_id) AS n FROM daily_load) t
WHERE rn <= 24 AND n >= 72 GROUP BY 1""", "daily_load")
def f6_daily(spark, sf):
    t = Tables(spark, sf)
    results = forecast.forecast_all(t.daily, t.stations, "seasonal_naive", KEY, "day",
                                    ["water_level", "flow_rate", "rainfall"], as_of=AS_OF)
    return results.select("location_id", "max_predicted_water_level", "risk_level")


@query("a5_peak_level", f"SELECT station_id, {half_up('MAX(level)')} AS peak FROM seasonal GROUP BY 1", "seasonal")
def a5(spark, sf):
    scored = forecast.score(history(Tables(spark, sf)))
    return scored.select("station_id", G.rounded(F.array_max("predicted")).alias("peak"))


RECORDS = f"""
SELECT p.station_id AS location_id, TIMESTAMP '{AS_OF}' AS predict_time, CAST(p.hour_ahead AS SMALLINT) AS predict_hour,
       {half_up('p.level')} AS predicted_water_level, f.confidence AS confidence_score,
       CAST(f.risk_level AS SMALLINT) AS risk_level, 'seasonal-1' AS model_version,
       '{{"n_rows":72,"last_time":"' || strftime(l.last_time, '%Y-%m-%d %H:%M:%S') || '"}}' AS input_data_summary
FROM seasonal p JOIN forecast_result f ON f.location_id = p.station_id
JOIN (SELECT station_id, MAX(hour) AS last_time FROM resampled GROUP BY 1) l ON l.station_id = p.station_id"""


def records(t: Tables):
    results = monitor.flood_forecast(t.hour_wide, t.stations, as_of=AS_OF)
    return forecast.prediction_records(results, "seasonal-1")


@query("f8_prediction_records", RECORDS, "forecast_result", "resampled")
def f8(spark, sf):
    return records(Tables(spark, sf)).select(
        "location_id", "predict_time", F.col("predict_hour").cast("smallint").alias("predict_hour"),
        "predicted_water_level", "confidence_score", F.col("risk_level").cast("smallint").alias("risk_level"),
        "model_version", "input_data_summary")


@query("s11_stored_predictions", RECORDS, "forecast_result", "resampled")
def s11(spark, sf):
    """Appended to the stored table, twice as the same batch, and read back."""
    path = f"{run_folder(spark, 'predictions')}/records"
    conformed = tables.conform(records(Tables(spark, sf)), "flood_prediction_record", AS_OF)
    for _ in range(2):
        tables.append(conformed, "flood_prediction_record", path, AS_OF)
    return tables.read_table(spark, path, "flood_prediction_record").select(
        "location_id", "predict_time", "predict_hour",
        F.col("predicted_water_level").cast("double").alias("predicted_water_level"),
        F.col("confidence_score").cast("double").alias("confidence_score"), "risk_level", "model_version",
        "input_data_summary")


@query("k2_hourly_levels", f"SELECT station_id AS location_id, CAST(hour_ahead AS INTEGER) AS hour, {half_up('level')} AS level FROM seasonal",
       "seasonal")
def k2(spark, sf):
    t = Tables(spark, sf)
    return monitor.flood_forecast(t.hour_wide, t.stations, as_of=AS_OF).select(
        "location_id", F.inline("hourly_predictions").alias("hour", "level"))


@query("k2_long_horizon", f"""
SELECT station_id AS location_id, CAST(hour_ahead + later AS INTEGER) AS hour, {half_up('level')} AS level
FROM seasonal, (SELECT unnest([0, 24]) AS later) d""", "seasonal")
def k2_long(spark, sf):
    """All 48 hours of a forecast of 48 hours."""
    t = Tables(spark, sf)
    recent = forecast.recent_series(t.hour_wide)
    return forecast.forecast_all(recent, t.stations, horizon=48, as_of=AS_OF).select(
        "location_id", F.inline("hourly_predictions").alias("hour", "level"))


@query("a10_mse_by_hour_ahead", f"""
SELECT CAST(h AS INTEGER) AS hour_ahead, COUNT(*) AS n, {qr('AVG(POWER(a.water_level - f.water_level, 2))', 'mse')}
FROM numbered a JOIN numbered f ON f.station_id = a.station_id AND f.i = a.i - 24
CROSS JOIN (SELECT unnest(range(1, 25)) AS h) hours
JOIN (SELECT station_id, MAX(i) AS top FROM numbered GROUP BY 1) t ON t.station_id = a.station_id
WHERE a.i - 24 - h + 1 >= 0 AND a.i - 24 - h + 1 + 47 <= t.top GROUP BY 1""", "numbered")
def a10(spark, sf):
    rows = Tables(spark, sf).resampled.filter("water_level IS NOT NULL")
    errors = windows.horizon_errors(rows, KEY, "hour", position="step", chunk=128, dense=True)
    return errors.select("hour_ahead", "n", r("mse"))


@query("a10_mse_daily", f"SELECT station_id, {qr('AVG(POWER(previous - water_level, 2))', 'mse')}, COUNT(previous) AS n FROM "
       "(SELECT station_id, water_level, LAG(water_level) OVER (PARTITION BY station_id ORDER BY day) AS previous "
       "FROM daily_load) p GROUP BY 1", "daily_load")
def a10_daily(spark, sf):
    t = Tables(spark, sf)
    found = windows.sliding_windows(t.daily, KEY, "day", ["water_level"], 1, "water_level", 1, block=DAILY_BLOCK)
    pairs = found.select("station_id", F.col("window")[0][0].alias("predicted"), F.col("label")[0].alias("actual"))
    return forecast.mean_squared_error(pairs, KEY).select("station_id", r("mse"), "n")
