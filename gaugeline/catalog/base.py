"""Registry of queries and the shared SQL views of their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions import rounded
from gaugeline.operators import series
from gaugeline.sources import dims, testdata

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = testdata.AS_OF
MEASURES = ["water_level", "flow_rate", "rainfall", "temperature"]
#: Series of the daily table are blocked by year, so that blocks keep a useful size.
DAILY_BLOCK = "364 days"

# The SQL views, each usable by name in an oracle that lists it.
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "reading": ((), """
SELECT 'S00' || CAST(user_id % 5 + 1 AS VARCHAR) AS station_id,
       CASE event_type WHEN 'view' THEN 'water_level' WHEN 'click' THEN 'rainfall'
            WHEN 'purchase' THEN 'flow_rate' WHEN 'signup' THEN 'temperature'
            ELSE 'water_quality' END AS data_type,
       ts,
       CASE WHEN k = 0 THEN NULL WHEN event_type = 'view' THEN value / 5.0
            WHEN event_type = 'click' THEN value WHEN event_type = 'purchase' THEN value * 10.0
            WHEN event_type = 'signup' THEN value / 2.0 - 10.0 END AS value,
       CASE WHEN k > 0 AND event_type = 'error' THEN k * 15 / CAST(100 AS DOUBLE) END AS ph,
       CASE WHEN k > 0 AND event_type = 'error' THEN value END AS turbidity,
       CASE WHEN k > 0 AND event_type = 'error' THEN value / 20.0 END AS dissolved_oxygen,
       CASE WHEN k = 0 THEN 'sensor failure' END AS error,
       event_id, k
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) e"""),
    "hour_wide": (("reading",), """
SELECT station_id, date_trunc('hour', ts) AS hour,
       AVG(CASE WHEN data_type = 'water_level' THEN value END) AS water_level,
       AVG(CASE WHEN data_type = 'flow_rate' THEN value END) AS flow_rate,
       AVG(CASE WHEN data_type = 'rainfall' THEN value END) AS rainfall,
       AVG(CASE WHEN data_type = 'temperature' THEN value END) AS temperature,
       COUNT(*) AS n_readings
FROM reading GROUP BY 1, 2"""),
    "daily_load": ((), """
SELECT CAST(l_suppkey AS VARCHAR) AS station_id, l_shipdate AS day,
       AVG(l_quantity) AS water_level, SUM(l_quantity) AS flow_rate,
       AVG(l_discount) AS rainfall, COUNT(*) AS n_readings
FROM lineitem GROUP BY 1, 2"""),
    "station": ((), """
SELECT id, name, CAST(lat AS DOUBLE) AS lat, CAST(lng AS DOUBLE) AS lng
FROM (VALUES ('S001', 'upper reach', 30.05, 120.10), ('S002', 'middle reach', 30.15, 120.30),
  ('S003', 'lower reach', 30.25, 120.50), ('S004', 'reservoir', 29.50, 119.20)) AS t(id, name, lat, lng)"""),
    "sensor_range": ((), """
SELECT data_type, CAST(mn AS DOUBLE) AS min, CAST(mx AS DOUBLE) AS max, unit
FROM (VALUES ('water_level', 0.0, 50.0, 'm'), ('flow_rate', 0.0, 5000.0, 'm3/s'),
  ('rainfall', 0.0, 500.0, 'mm'), ('temperature', -10.0, 45.0, 'degC'), ('ph', 0.0, 14.0, ''),
  ('turbidity', 0.0, 1000.0, 'NTU'), ('dissolved_oxygen', 0.0, 20.0, 'mg/L')) AS t(data_type, mn, mx, unit)"""),
    "warning_threshold": ((), """
SELECT level, name, CAST(mn AS DOUBLE) AS min_level, CAST(cf AS DOUBLE) AS confidence
FROM (VALUES (1, 'blue', 15.0, 0.95), (2, 'yellow', 20.0, 0.92), (3, 'orange', 25.0, 0.88),
  (4, 'red', 30.0, 0.85)) AS t(level, name, mn, cf)"""),
    "station_batch": ((), """
SELECT CAST(l_suppkey AS VARCHAR) AS station_id, l_shipdate AS ts, l_orderkey, l_linenumber,
       l_quantity, l_discount, l_tax, l_returnflag = 'R' AS failed FROM lineitem"""),
}


def sql_grade(level: str) -> str:
    return (f"CASE WHEN {level} >= 30 THEN 4 WHEN {level} >= 25 THEN 3 WHEN {level} >= 20 THEN 2 "
            f"WHEN {level} >= 15 THEN 1 WHEN {level} IS NOT NULL THEN 0 END")


def sql_risk_name(level: str) -> str:
    return (f"CASE WHEN {level} >= 30 THEN 'red' WHEN {level} >= 25 THEN 'orange' "
            f"WHEN {level} >= 20 THEN 'yellow' WHEN {level} >= 15 THEN 'blue' "
            f"WHEN {level} IS NOT NULL THEN 'normal' END")


def sql_confidence(level: str) -> str:
    return (f"CAST(CASE WHEN {level} >= 30 THEN 0.85 WHEN {level} >= 25 THEN 0.88 "
            f"WHEN {level} >= 20 THEN 0.92 WHEN {level} >= 15 THEN 0.95 "
            f"WHEN {level} IS NOT NULL THEN 0.98 END AS DOUBLE)")


def sql_resample(source: str, time: str, interval: str, measures: list[str], fill_lead: bool = False,
                 dense: bool = True) -> str:
    """Dense axis and interpolation in SQL, measure by measure with window functions."""
    spine = (f"SELECT s.station_id, s.{time}, h.* EXCLUDE (station_id, {time}) FROM (SELECT station_id, "
             f"unnest(generate_series(MIN({time}), MAX({time}), INTERVAL {interval})) AS {time} "
             f"FROM {source} GROUP BY station_id) s LEFT JOIN {source} h "
             f"ON h.station_id = s.station_id AND h.{time} = s.{time}")
    base = spine if dense else f"SELECT * FROM {source}"
    over = "OVER (PARTITION BY station_id ORDER BY i ROWS BETWEEN"
    known = ", ".join(
        f"MAX(CASE WHEN {m} IS NOT NULL THEN i END) {over} UNBOUNDED PRECEDING AND CURRENT ROW) AS p_{m}, "
        f"MIN(CASE WHEN {m} IS NOT NULL THEN i END) {over} CURRENT ROW AND UNBOUNDED FOLLOWING) AS n_{m}"
        for m in measures)
    near = ", ".join(f"MAX({m}) OVER (PARTITION BY station_id, p_{m}) AS px_{m}, "
                     f"MAX({m}) OVER (PARTITION BY station_id, n_{m}) AS nx_{m}" for m in measures)
    lead = (lambda m: f"nx_{m}") if fill_lead else (lambda m: "NULL")
    # The grouping by a NULL position holds only unknown rows, so its maximum is NULL.
    values = ", ".join(
        f"CASE WHEN {m} IS NOT NULL THEN {m} WHEN px_{m} IS NULL THEN {lead(m)} "
        f"WHEN nx_{m} IS NULL THEN px_{m} ELSE px_{m} + (nx_{m} - px_{m}) / (n_{m} - p_{m}) "
        f"* (i - p_{m}) END AS {m}" for m in measures)
    return (f"SELECT station_id, {time}, i - 1 AS step, {values} FROM (SELECT *, {near} FROM (SELECT *, {known} "
            f"FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY {time}) AS i "
            f"FROM ({base}) b) d) k) n")


VIEWS["resampled"] = (("hour_wide",), sql_resample("hour_wide", "hour", "1 HOUR", MEASURES))
# The daily series with a level only where two lines or more were summed up.
VIEWS["daily_gaps"] = (("daily_load",), """
SELECT station_id, day, CASE WHEN n_readings >= 2 THEN water_level END AS water_level,
       CASE WHEN n_readings >= 2 THEN flow_rate END AS flow_rate FROM daily_load""")

VIEWS["six"] = (("reading",), """
SELECT station_id, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') AS ts, AVG(value) AS value
FROM reading GROUP BY 1, 2""")
VIEWS["numbered"] = (("resampled",), """
SELECT station_id, hour, water_level, ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY hour) - 1 AS i
FROM resampled WHERE water_level IS NOT NULL""")


def sql(body: str, *uses: str) -> str:
    """``body`` with the views it uses, in order of dependence."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in VIEWS[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in uses:
        add(name)
    body = body.strip()
    if not ordered:
        return body
    views = ",\n".join(f"{name} AS ({VIEWS[name][1].strip()})" for name in ordered)
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"


def query(name: str, body: str | None = None, *uses: str):
    """Register a query and, unless its result has no SQL form, the SQL that must agree."""
    def keep(run):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if body is not None:
            ORACLES[name] = sql(body, *uses)
        return run

    return keep


class Tables:
    """The test tables of one scale as monitoring tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return testdata.load(self.spark, self.sf_dir, name)

    @property
    def reading(self) -> DataFrame:
        return testdata.reading(self.spark, self.sf_dir)

    @property
    def hour_wide(self) -> DataFrame:
        return testdata.hour_wide(self.reading)

    @property
    def daily(self) -> DataFrame:
        return testdata.daily_load(self.spark, self.sf_dir)

    @property
    def batches(self) -> DataFrame:
        return testdata.station_batches(self.spark, self.sf_dir)

    @property
    def stations(self) -> DataFrame:
        return dims.stations(self.spark, testdata.KNOWN_STATIONS)

    @property
    def ranges(self) -> DataFrame:
        return dims.sensor_ranges(self.spark)

    @property
    def thresholds(self) -> DataFrame:
        return dims.warning_thresholds(self.spark)

    @property
    def resampled(self) -> DataFrame:
        return series.dense_series(self.hour_wide, ["station_id"], "hour", MEASURES)


#: Added before derived doubles are rounded for comparison. Engines add up in different
#: orders, so sums differ in the last bits; the shift keeps short decimals off the rounding edge.
SHIFT = 1.287e-7


def c(value: Column, digits: int = 6) -> Column:
    """Derived double, rounded for comparison across engines."""
    return rounded(value + SHIFT, digits)


def r(name: str, digits: int = 6) -> Column:
    return c(F.col(name), digits).alias(name)


def rs(names: list[str], digits: int = 6) -> list[Column]:
    return [r(n, digits) for n in names]


def qr(expression: str, name: str, digits: int = 6) -> str:
    return f"ROUND(({expression}) + {SHIFT}::DOUBLE, {digits}) + 0.0 AS {name}"


def qrs(names: list[str], digits: int = 6) -> str:
    return ", ".join(qr(n, n, digits) for n in names)


def half_up(expression: str, digits: int = 2) -> str:
    """Rounding of the decimal a double prints as, as Spark does it."""
    return f"(ROUND(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,20)), {digits})::DOUBLE + 0.0)"
