"""Queries on warnings: creation, fan-out, cancellation, lists, overview."""

from pyspark.sql import functions as F

from gaugeline import constants as C
from gaugeline.catalog.base import (
    AS_OF,
    VIEWS,
    Tables,
    half_up,
    query,
    sql_grade,
)
from gaugeline.operators import kpis, reshape, risk, warnings
from gaugeline.plans import monitor
from gaugeline.sources import testdata

def _sql_part(value: str) -> str:
    return f"COALESCE(length(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


#: The id by the columns of a warning.
SQL_ID = ("'WARN-' || strftime(publish_time, '%Y%m%d%H%M%S') || '-' || md5(" + " || ".join(map(_sql_part, (
    "epoch_us(publish_time)", "epoch_us(expire_time)", "warning_type", "warning_level", "title", "content", "affected_location")))
    + ") || '-' || affected_location")


def flood_text(column: int, level: str = "risk_level") -> str:
    """Title (1) or text (2) by level."""
    whens = " ".join(f"WHEN {row[0]} THEN '{row[column]}'" for row in C.FLOOD_TEXTS)
    return f"CASE {level} {whens} END"


# Every station-hour at risk as a warning published in that hour.
VIEWS["flood_warning"] = (("hour_wide", "station"), f"""
SELECT {SQL_ID} AS id,
       * FROM (
  SELECT 1 AS warning_type, risk_level AS warning_level,
         replace({flood_text(1)}, '%s', station_name) AS title,
         replace(regexp_replace({flood_text(2)}, '%s', station_name), '%s', level_text) AS content,
         station_id AS affected_location, hour AS publish_time, hour + INTERVAL 24 HOUR AS expire_time, 1 AS status
  FROM (SELECT h.station_id, h.hour, COALESCE(s.name, h.station_id) AS station_name,
               CAST({half_up('water_level')} AS VARCHAR) AS level_text, {sql_grade('water_level')} AS risk_level
        FROM hour_wide h LEFT JOIN station s ON s.id = h.station_id) g WHERE risk_level > 0) w""")
# Station-hours with a failed sensor cancel the warning of that hour, if there is one.
VIEWS["cancelled"] = (("hour_wide", "reading", "flood_warning"), """
SELECT DISTINCT w.id FROM flood_warning w JOIN reading r
  ON r.station_id = w.affected_location AND date_trunc('hour', r.ts) = w.publish_time WHERE r.error IS NOT NULL""")

PLAIN = ["id", "warning_type", "warning_level", "title", "content", "affected_location", "publish_time",
         "expire_time", "status"]


def flood_log(t: Tables, hours=None):
    """The warnings of all hours, or of the given ones."""
    graded = risk.with_grade(t.hour_wide if hours is None else hours, "water_level").withColumnsRenamed({"station_id": "location_id"})
    results = kpis.with_station_name(graded, t.stations, "location_id").withColumn(
        "max_predicted_water_level", F.round("water_level", 2))
    return warnings.generate_flood_warnings(results, F.col("hour"))


def cancels(t: Tables):
    """Ids of warnings published in an hour in which the station's sensor failed."""
    return flood_log(t, testdata.hour_wide(t.reading, failed=True).filter("n_failed > 0")).select("id")


@query("n1_flood_warnings", f"SELECT {', '.join(PLAIN)} FROM flood_warning", "flood_warning")
def n1(spark, sf):
    return flood_log(Tables(spark, sf)).select(*PLAIN)


@query("n1_forecast_warnings", f"""
SELECT warning_level, affected_location, publish_time, expire_time, status FROM (
  SELECT risk_level AS warning_level, location_id AS affected_location, TIMESTAMP '{AS_OF}' AS publish_time,
         TIMESTAMP '{AS_OF}' + INTERVAL 24 HOUR AS expire_time, 1 AS status
  FROM forecast_result WHERE risk_level > 0)""", "forecast_result")
def n1_forecast(spark, sf):
    t = Tables(spark, sf)
    return monitor.flood_warnings(t.hour_wide, t.stations, as_of=AS_OF).select(
        "warning_level", "affected_location", "publish_time", "expire_time", "status")


@query("n2_create_warnings", f"""
SELECT {SQL_ID} AS id, *
FROM (SELECT 3 AS warning_type, 2 AS warning_level, 'turbid water no. ' || CAST(event_id AS VARCHAR) AS title,
             'turbidity ' || CAST(turbidity AS VARCHAR) AS content,
             CASE WHEN k > 50 THEN station_id ELSE 'unknown area' END AS affected_location,
             TIMESTAMP '{AS_OF}' AS publish_time, TIMESTAMP '{AS_OF}' + INTERVAL 6 HOUR AS expire_time, 1 AS status
      FROM reading WHERE turbidity > 40) q""", "reading")
def n2(spark, sf):
    t = Tables(spark, sf)
    k = F.round(F.col("ph") * 100 / 15).cast("int")
    requests = t.reading.filter("turbidity > 40").select(
        F.lit(3).alias("warning_type"), F.lit(2).alias("warning_level"),
        F.concat(F.lit("turbid water no. "), F.col("event_id").cast("string")).alias("title"),
        F.concat(F.lit("turbidity "), F.col("turbidity").cast("string")).alias("content"),
        F.when(k > 50, F.col("station_id")).otherwise(" ").alias("affected_location"))
    return warnings.create_warnings(requests, AS_OF, 6)


@query("n2_unique_ids", """
SELECT COUNT(*) AS warnings, COUNT(DISTINCT event_id) AS ids, 1::BIGINT AS cancelled_by_one FROM reading WHERE turbidity > 40""",
       "reading")
def n2_ids(spark, sf):
    """Every request has its own id, and cancelling one id changes one warning."""
    log = n2(spark, sf)
    one = log.agg(F.min("id").alias("id"))
    state = warnings.current_state(log, one)
    return state.agg(F.count(F.lit(1)).alias("warnings"), F.countDistinct("id").alias("ids"),
                     F.sum((F.col("status") == 0).cast("bigint")).alias("cancelled_by_one"))


#: Requests that an id without the borders of its parts, NULLs or fractions of a second would take for one another.
ALIKE = [("'t|' || event_id", "'x'", 0), ("'t'", "event_id || '|x'", 0), ("'t' || event_id", "NULL", 0), ("'t' || event_id", "''", 0),
         ("'t' || event_id", "NULL", 1), ("'t' || event_id", "''", 0)]


@query("n2_adversarial_ids", f"""
WITH request AS (SELECT station_id, number, 3 AS warning_type, 2 AS warning_level, title, content,
    TIMESTAMP '{AS_OF}' + to_microseconds(micros) AS publish_time
  FROM reading, LATERAL (VALUES {', '.join(f"({i}, {t}, {x}, {m}::BIGINT)" for i, (t, x, m) in enumerate(ALIKE))}) v(number, title, content, micros)
  WHERE turbidity > 40),
cancelled AS (SELECT station_id, title, content, publish_time FROM request WHERE number IN (0, 3, 4))
SELECT r.station_id, COUNT(*) AS requests, COUNT(DISTINCT (title, content, publish_time)) AS ids,
       COUNT(*) FILTER (WHERE EXISTS (SELECT 1 FROM cancelled c WHERE c.station_id = r.station_id AND c.title = r.title
         AND c.content IS NOT DISTINCT FROM r.content AND c.publish_time = r.publish_time)) AS cancelled
FROM request r GROUP BY 1""", "reading")
def n2_adversarial(spark, sf):
    """Requests that are told apart by their columns have different ids, and only the one that is cancelled goes."""
    requests = None
    source = Tables(spark, sf).reading.filter("turbidity > 40")
    for number, (title, content, micros) in enumerate(ALIKE):
        more = source.select(F.lit(number).alias("number"), F.lit(3).alias("warning_type"), F.lit(2).alias("warning_level"),
                             F.expr(title).alias("title"), F.expr(content).cast("string").alias("content"),
                             F.col("station_id").alias("affected_location"), F.lit(micros).alias("micros"))
        requests = more if requests is None else requests.unionByName(more)
    at = F.timestamp_micros(F.unix_micros(F.lit(AS_OF).cast("timestamp")) + F.col("micros"))
    numbered = requests.withColumn("at", at)
    log = warnings.create_warnings(numbered, F.col("at"))
    gone = warnings.create_warnings(numbered.filter("number IN (0, 3, 4)"), F.col("at"))
    return warnings.current_state(log, gone).groupBy(F.col("affected_location").alias("station_id")).agg(
        F.count(F.lit(1)).alias("requests"), F.countDistinct("id").alias("ids"), F.count_if(F.col("status") == 0).alias("cancelled"))


@query("n3_fan_out", """
SELECT id AS warning_id, title, warning_level, affected_location,
       unnest(['system_notification', 'app_push', 'sms']) AS channel, TRUE AS success FROM flood_warning""",
       "flood_warning")
def n3(spark, sf):
    return warnings.fan_out(flood_log(Tables(spark, sf)))


@query("n3_delivery_results", """
SELECT id AS warning_id, 'app_push:' || CASE WHEN warning_level >= 2 THEN 'true' ELSE 'false' END || ',sms:'
       || CASE WHEN warning_level >= 2 THEN 'true' ELSE 'false' END AS sent FROM flood_warning""", "flood_warning")
def n3_results(spark, sf):
    results = warnings.delivery_results(flood_log(Tables(spark, sf)), ["app_push", "sms"], F.col("warning_level") >= 2)
    sent = F.transform("sent_results", lambda s: F.concat_ws(":", s["channel"], s["success"].cast("string")))
    return results.select("warning_id", F.concat_ws(",", sent).alias("sent"))


@query("n4_cancel", """
SELECT c.id, w.id IS NOT NULL AS found FROM (
  SELECT id FROM cancelled UNION ALL SELECT 'none-' || CAST(event_id AS VARCHAR) FROM reading WHERE error IS NOT NULL) c
LEFT JOIN flood_warning w ON w.id = c.id""", "cancelled")
def n4(spark, sf):
    t = Tables(spark, sf)
    strays = t.reading.filter("error IS NOT NULL").select(
        F.concat(F.lit("none-"), F.col("event_id").cast("string")).alias("id"))
    return warnings.cancel_outcomes(flood_log(t), cancels(t).unionByName(strays))


@query("j8_current_state", """
SELECT w.id, CASE WHEN c.id IS NOT NULL THEN 0 ELSE 1 END AS status FROM flood_warning w LEFT JOIN cancelled c ON c.id = w.id""",
       "cancelled")
def j8(spark, sf):
    t = Tables(spark, sf)
    return warnings.current_state(flood_log(t), cancels(t)).select("id", "status")


ACTIVE = f"""FROM flood_warning w WHERE expire_time > TIMESTAMP '{AS_OF}'
  AND NOT EXISTS (SELECT 1 FROM cancelled c WHERE c.id = w.id)"""


@query("n5_active_warnings", f"SELECT {', '.join(PLAIN)} {ACTIVE}", "cancelled")
def n5(spark, sf):
    t = Tables(spark, sf)
    return warnings.active_warnings(flood_log(t), cancels(t), AS_OF).select(*PLAIN)


@query("n6_display_list", f"""
SELECT id, CASE warning_level WHEN 1 THEN 'blue' WHEN 2 THEN 'yellow' WHEN 3 THEN 'orange' WHEN 4 THEN 'red' END AS level_name,
       title, content, affected_location, publish_time, expire_time {ACTIVE}""", "cancelled")
def n6(spark, sf):
    t = Tables(spark, sf)
    return warnings.display_list(warnings.active_warnings(flood_log(t), cancels(t), AS_OF))


@query("u2_append_history", """
SELECT id, warning_type, warning_level, affected_location FROM flood_warning
UNION ALL
SELECT 'WARN-20240125000000-' || lpad('0', 3, '0') || '-x', 2, 1, station_id FROM hour_wide WHERE water_level < 0.5""",
       "flood_warning")
def u2(spark, sf):
    t = Tables(spark, sf)
    dry = t.hour_wide.filter("water_level < 0.5").select(
        F.lit("WARN-20240125000000-000-x").alias("id"), F.lit(2).alias("warning_type"),
        F.lit(1).alias("warning_level"), F.col("station_id").alias("affected_location"))
    return reshape.append_rows(flood_log(t).select("id", "warning_type", "warning_level", "affected_location"), dry)


@query("a9_overview", f"""
SELECT (SELECT COUNT(*) FROM station) AS stations, (SELECT COUNT(*) {ACTIVE}) AS active_warnings,
       3 * (SELECT COUNT(*) FROM station) AS sensors, TIMESTAMP '{AS_OF}' AS updated""", "cancelled", "station")
def a9(spark, sf):
    t = Tables(spark, sf)
    return kpis.overview(t.stations, warnings.active_warnings(flood_log(t), cancels(t), AS_OF), AS_OF)
