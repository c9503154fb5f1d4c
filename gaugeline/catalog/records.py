"""Queries on readings and records: scans, reshaping, validation, lookups, expressions."""

from pyspark.sql import functions as F

from gaugeline import functions as G
from gaugeline.catalog.base import (
    AS_OF,
    MEASURES,
    Tables,
    c,
    half_up,
    qr,
    qrs,
    query,
    rs,
    sql_confidence,
    sql_grade,
    sql_risk_name,
)
from gaugeline.operators import kpis, reshape, risk, series, validate
from gaugeline.session import run_folder
from gaugeline.sources import commits, dims, layout, readings, tables

TIME_ISSUE = (f"CASE WHEN {{0}} > TIMESTAMP '{AS_OF}' THEN 'FUTURE' "
              f"WHEN {{0}} <= TIMESTAMP '{AS_OF}' - INTERVAL 8 DAY THEN 'EXPIRED' END")
LEVEL_BAD = "COALESCE(water_level < 0 OR water_level > 50, FALSE)"
RAIN_BAD = "COALESCE(rainfall < 0 OR rainfall > 500, FALSE)"
TEMP_BAD = "COALESCE(temperature < -10 OR temperature > 45, FALSE)"
LOGIC_BAD = "COALESCE(rainfall > 50 AND water_level < 1.0, FALSE)"


def sql_verdict(source: str, time: str) -> str:
    issue = TIME_ISSUE.format(time)
    return f"""SELECT *, pen = 0 AS is_valid,
       CASE WHEN pen >= 10 THEN CAST(0 AS DOUBLE) ELSE (10 - pen) / CAST(10 AS DOUBLE) END AS quality_score,
       concat_ws(',', CASE WHEN level_bad THEN 'RANGE:water_level' END,
         CASE WHEN rain_bad THEN 'RANGE:rainfall' END, CASE WHEN temp_bad THEN 'RANGE:temperature' END,
         CASE WHEN logic_bad THEN 'INCONSISTENT:rainfall' END, time_code || ':{time}') AS issue_codes
FROM (SELECT *, (CASE WHEN level_bad THEN 3 ELSE 0 END) + (CASE WHEN rain_bad THEN 2 ELSE 0 END)
           + (CASE WHEN temp_bad THEN 2 ELSE 0 END) + (CASE WHEN logic_bad THEN 3 ELSE 0 END)
           + (CASE WHEN time_code IS NOT NULL THEN 2 ELSE 0 END) AS pen
      FROM (SELECT *, {LEVEL_BAD} AS level_bad, {RAIN_BAD} AS rain_bad, {TEMP_BAD} AS temp_bad,
                   {LOGIC_BAD} AS logic_bad, {issue} AS time_code FROM {source}) flagged) scored"""


def verdicts(t: Tables):
    return validate.validate(t.hour_wide, "hour", AS_OF)


def issue_codes():
    codes = F.transform("issues", lambda i: F.concat(i["code"], F.lit(":"), i["field"]))
    return F.concat_ws(",", codes).alias("issue_codes")


# Scans and tables.

@query("s1_station_listing", """
SELECT s.id, s.name, s.lat, s.lng, COUNT(r.station_id) AS n_readings
FROM station s LEFT JOIN reading r ON r.station_id = s.id GROUP BY ALL""", "reading", "station")
def s1(spark, sf):
    t = Tables(spark, sf)
    counts = kpis.readings_per_station(t.reading)
    return (t.stations.join(counts, F.col("id") == F.col("station_id"), "left")
            .select("id", "name", "lat", "lng", F.coalesce("n_readings", F.lit(0)).alias("n_readings")))


@query("s2_sensor_ranges", """
SELECT s.data_type, s.min, s.max, s.unit, COUNT(r.value) AS n, MIN(r.value) AS lowest, MAX(r.value) AS highest
FROM sensor_range s LEFT JOIN reading r ON r.data_type = s.data_type GROUP BY ALL""", "reading", "sensor_range")
def s2(spark, sf):
    t = Tables(spark, sf)
    seen = t.reading.groupBy("data_type").agg(
        F.count("value").alias("n"), F.min("value").alias("lowest"), F.max("value").alias("highest"))
    return t.ranges.join(seen, "data_type", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("s3_warning_thresholds", f"""
SELECT w.level, w.name, w.min_level, w.confidence, COUNT(g.grade) AS n_hours
FROM warning_threshold w LEFT JOIN (SELECT {sql_grade('water_level')} AS grade FROM hour_wide) g
  ON g.grade = w.level GROUP BY ALL""", "hour_wide", "warning_threshold")
def s3(spark, sf):
    t = Tables(spark, sf)
    hours = (risk.with_grade(t.hour_wide, "water_level").groupBy("risk_level")
             .agg(F.count(F.lit(1)).alias("n_hours")))
    return (t.thresholds.join(hours, F.col("level") == F.col("risk_level"), "left")
            .select("level", "name", "min_level", "confidence",
                    F.coalesce("n_hours", F.lit(0)).alias("n_hours")))


@query("s4_scan_batches", """
SELECT station_id, COUNT(*) AS n_batches, 3 * COUNT(*) AS n_readings,
       COUNT(*) FILTER (WHERE failed) AS n_failed FROM station_batch GROUP BY 1""", "station_batch")
def s4(spark, sf):
    failed = F.size(F.filter("readings", lambda x: x["error"].isNotNull()))
    return Tables(spark, sf).batches.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("n_batches"), F.sum(F.size("readings")).alias("n_readings"),
        F.sum(failed).alias("n_failed"))


@query("s5_station_readings", """
SELECT station_id, data_type, ts, value, event_id FROM reading
WHERE station_id = 'S002' AND data_type = 'rainfall'""", "reading")
def s5(spark, sf):
    return readings.station_readings(Tables(spark, sf).reading, "S002", "rainfall").select(
        "station_id", "data_type", "ts", "value", "event_id")


@query("s5_clustered", """
SELECT station_id, data_type, ts, value, event_id FROM reading
WHERE station_id = 'S002' AND ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'""", "reading")
def s5_clustered(spark, sf):
    """A week of one station out of files that are laid along a curve over stations and time."""
    path = f"{run_folder(spark, 'clustered')}/readings"
    layout.write_clustered(Tables(spark, sf).reading, path, "station_id", "ts", row_group_bytes=1 << 20)
    week = readings.station_readings(spark.read.parquet(path), "S002").filter("ts >= '2024-01-08' AND ts < '2024-01-15'")
    return week.select("station_id", "data_type", "ts", "value", "event_id")


@query("s5_unknown_station", "SELECT station_id, data_type, ts, value FROM reading WHERE station_id = 'S999'",
       "reading")
def s5_unknown(spark, sf):
    return readings.station_readings(Tables(spark, sf).reading, "S999").select(
        "station_id", "data_type", "ts", "value")


def submissions(t: Tables):
    """Readings as submitted text: failed ones are cut off, water-quality ones lack the station."""
    station = F.when(F.col("data_type") != "water_quality", F.col("station_id"))
    text = F.to_json(F.struct(station.alias("station_id"), "data_type", "value",
                              G.iso_time(F.col("ts")).alias("timestamp")))
    cut = F.when(F.col("error").isNotNull(), F.substring(text, 1, 9)).otherwise(text)
    return t.reading.select("event_id", cut.alias("value"))


@query("s6_submissions", """
SELECT event_id, CASE WHEN error IS NOT NULL THEN NULL WHEN data_type = 'water_quality' THEN NULL
                      ELSE station_id END AS station_id,
       error IS NULL AND data_type <> 'water_quality' AS accepted,
       CASE WHEN error IS NOT NULL THEN 'MALFORMED' WHEN data_type = 'water_quality' THEN 'MISSING_STATION_ID'
            ELSE '' END AS problems,
       CASE WHEN error IS NULL THEN date_trunc('second', ts) END AS ts FROM reading""", "reading")
def s6(spark, sf):
    lines = submissions(Tables(spark, sf)).withColumnRenamed("value", "line")
    parsed = readings.parse_submissions(lines, "line")
    return parsed.select("event_id", "station_id", "accepted",
                         F.concat_ws(",", "problems").alias("problems"), F.col("timestamp").alias("ts"))


@query("s7_json_round_trip", """
SELECT station_id, data_type, ts, value, ph, turbidity, dissolved_oxygen, error, event_id FROM reading""",
       "reading")
def s7(spark, sf):
    source = Tables(spark, sf).reading
    text = source.select(tables.row_json(*source.columns).alias("line"))
    parsed = F.from_json("line", source.schema, tables.JSON_TIMES)
    return text.select(parsed.alias("r")).select("r.*")


def decimals(names):
    """Stored decimals as doubles, as engines hand decimals out in different types."""
    return [F.col(n).cast("double").alias(n) for n in names]


@query("s8_water_monitoring", "SELECT station_id AS location_id, ts AS timestamp, " + ", ".join(
    half_up(f"CASE WHEN data_type = '{m}' THEN value END") + f" AS {m}" for m in MEASURES) + """,
       CAST(CASE WHEN error IS NOT NULL THEN 2 ELSE 1 END AS SMALLINT) AS data_quality, CAST(1 AS SMALLINT) AS status
FROM reading""", "reading")
def s8(spark, sf):
    records = reshape.storage_records(Tables(spark, sf).reading)
    kept = tables.accepted(tables.conform(records, "water_monitoring_data", AS_OF))
    return kept.select("location_id", "timestamp", *decimals(MEASURES), "data_quality", "status")


@query("s8_rejected_quality", """
SELECT location_id, problems, COUNT(*) AS n, SUM(CASE WHEN ph_value IS NULL THEN 1 ELSE 0 END)::BIGINT AS no_ph
FROM (SELECT station_id AS location_id, ph AS ph_value, CASE WHEN k > 5 THEN 'CODE_WATER_QUALITY_LEVEL'
             WHEN k < 1 THEN 'CODE_WATER_QUALITY_LEVEL' ELSE '' END AS problems
      FROM reading WHERE data_type = 'water_quality') q GROUP BY ALL""", "reading")
def s8_rejected(spark, sf):
    t = Tables(spark, sf)
    level = F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("water_quality_level")
    station = F.concat(F.lit("S00"), (F.col("user_id") % 5 + 1).cast("string")).alias("location_id")
    ph = F.when(level > 0, level * 15 / F.lit(100.0)).alias("ph_value")
    rows = t.raw("events").filter("event_type NOT IN ('view', 'click', 'purchase', 'signup')").select(
        station, F.col("ts").alias("timestamp"), ph, level)
    conformed = tables.conform(rows, "water_quality_data", AS_OF)
    return conformed.groupBy("location_id", F.concat_ws(",", "problems").alias("problems")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("ph_value").isNull()).alias("no_ph"))


@query("s10_model_version", """
SELECT 'linear-1' AS version, 'levels by hour' AS description, CAST(0.9 AS DOUBLE) AS accuracy,
       '{"horizon":24,"window":72}' AS parameters_summary,
       strftime(MIN(hour), '%Y-%m-%d %H:%M:%S') || ' .. ' || strftime(MAX(hour), '%Y-%m-%d %H:%M:%S')
         AS training_data_range, CAST(1 AS SMALLINT) AS status FROM hour_wide""", "hour_wide")
def s10(spark, sf):
    row = tables.register_model("linear-1", Tables(spark, sf).hour_wide, "hour",
                                {"horizon": 24, "window": 72}, F.lit(0.9), "levels by hour", AS_OF)
    return row.select("version", "description", *decimals(["accuracy"]), "parameters_summary",
                      "training_data_range", "status")


@query("s6_stored_submissions", """
SELECT event_id % 5 AS batch, station_id, data_type, ts, value, 'accepted' AS fate FROM (
  SELECT event_id, CASE WHEN error IS NULL AND data_type <> 'water_quality' THEN station_id END AS station_id,
         CASE WHEN error IS NULL AND data_type <> 'water_quality' THEN data_type END AS data_type,
         date_trunc('second', ts) AS ts, value, error, data_type AS kind FROM reading) r WHERE error IS NULL AND kind <> 'water_quality'
UNION ALL
SELECT event_id % 5, NULL, NULL, NULL, NULL, CASE WHEN error IS NOT NULL THEN 'MALFORMED' ELSE 'MISSING_STATION_ID' END
FROM reading WHERE error IS NOT NULL OR data_type = 'water_quality'""", "reading")
def s6_stored(spark, sf):
    """Submitted lines from text files, in five batches of which one is stored twice; both tables read back."""
    run = run_folder(spark, "submissions")
    lines = submissions(Tables(spark, sf)).select("value", (F.col("event_id") % 5).alias("batch"))
    lines.write.partitionBy("batch").text(f"{run}/lines")
    for batch in (0, 1, 2, 2, 3, 4):
        text = spark.read.text(f"{run}/lines/batch={batch}").select(F.col("value").alias("line"), F.lit(batch).cast("long").alias("batch"))
        parsed = readings.parse_submissions(text, "line")
        readings.store_submissions(parsed, f"{run}/accepted", f"{run}/rejected", f"batch {batch}", "line")
    kept = commits.read_batches(spark, f"{run}/accepted").select(
        "batch", "station_id", "data_type", F.col("timestamp").alias("ts"), "value", F.lit("accepted").alias("fate"))
    lost = commits.read_batches(spark, f"{run}/rejected").select("batch", F.concat_ws(",", "problems").alias("fate"))
    return kept.unionByName(lost, allowMissingColumns=True)


@query("s7_json_files", """
SELECT station_id, data_type, ts, value, ph, turbidity, dissolved_oxygen, error, event_id FROM reading""", "reading")
def s7_files(spark, sf):
    """Exported to JSON files and imported from them."""
    source, path = Tables(spark, sf).reading, f"{run_folder(spark, 'json')}/out"
    tables.export_json(source, path)
    return tables.import_json(spark, path, source.schema)


def sql_stored(extra: str) -> str:
    return ("SELECT station_id AS location_id, ts AS timestamp, " + ", ".join(
        half_up(f"CASE WHEN data_type = '{m}' THEN value END") + f" AS {m}" for m in MEASURES)
        + f", CAST(CASE WHEN error IS NOT NULL THEN 2 ELSE 1 END AS SMALLINT) AS data_quality, CAST(1 AS SMALLINT) AS status{extra}")


@query("s8_appended_twice", sql_stored(", CAST(ts AS DATE) AS day") + " FROM reading", "reading")
def s8_twice(spark, sf):
    """Four batches, one appended three times, its first run with other rows, and one whose first run broke off before its commit: as one append."""
    path = f"{run_folder(spark, 'stored')}/water"
    records = tables.conform(reshape.storage_records(Tables(spark, sf).reading), "water_monitoring_data", AS_OF)
    part = F.pmod(F.unix_seconds("timestamp"), F.lit(4))
    tables.append(records.filter((part == 1) & (F.col("data_quality") == 2)), "water_monitoring_data", path, "1")
    rows, partitions = tables.laid_out(records.filter(part == 3).limit(10), "water_monitoring_data")
    commits.write_attempt(rows, path, partitions)
    for number in (0, 1, 1, 2, 3):
        tables.append(records.filter(part == number), "water_monitoring_data", path, str(number))
    stored = tables.read_table(spark, path, "water_monitoring_data")
    return stored.select("location_id", "timestamp", *decimals(MEASURES), "data_quality", "status", "day")


@query("s8_stored_station_day", sql_stored("") + f" FROM reading WHERE station_id = 'S002' AND CAST(ts AS DATE) = DATE '{AS_OF[:8]}10'", "reading")
def s8_day(spark, sf):
    """One station and day out of the stored table; the scan opens the folder of that day only."""
    path = f"{run_folder(spark, 'stored')}/water"
    records = tables.conform(reshape.storage_records(Tables(spark, sf).reading), "water_monitoring_data", AS_OF)
    tables.append(records, "water_monitoring_data", path, "all")
    stored = tables.read_table(spark, path).filter(f"day = DATE '{AS_OF[:8]}10' AND location_id = 'S002'")
    return stored.select("location_id", "timestamp", *decimals(MEASURES), "data_quality", "status")


# Reshaping.

FLAT = """
SELECT station_id, data_type, value, unit, ph, turbidity, dissolved_oxygen, error, ts FROM (
  SELECT station_id, 'water_level' AS data_type, l_quantity AS value, 'm' AS unit, NULL::DOUBLE AS ph,
         NULL::DOUBLE AS turbidity, NULL::DOUBLE AS dissolved_oxygen, NULL::VARCHAR AS error, ts FROM station_batch
  UNION ALL
  SELECT station_id, 'rainfall', CASE WHEN NOT failed THEN l_discount * 1000 END,
         CASE WHEN NOT failed THEN 'mm' END, NULL, NULL, NULL, CASE WHEN failed THEN 'sensor failure' END, ts
  FROM station_batch
  UNION ALL
  SELECT station_id, 'water_quality', NULL, NULL, l_tax * 100, l_quantity, l_discount * 100, NULL, ts
  FROM station_batch)"""


@query("p1_flatten", FLAT, "station_batch")
def p1(spark, sf):
    return reshape.flatten(Tables(spark, sf).batches)


@query("p2_storage_records", f"""
SELECT station_id AS location_id, ts AS timestamp, CASE WHEN error IS NOT NULL THEN 2 ELSE 1 END AS data_quality,
       CASE WHEN data_type = 'water_level' THEN value END AS water_level,
       CASE WHEN data_type = 'flow_rate' THEN value END AS flow_rate,
       CASE WHEN data_type = 'rainfall' THEN value END AS rainfall,
       CASE WHEN data_type = 'temperature' THEN value END AS temperature,
       ph AS ph_value, turbidity, dissolved_oxygen FROM ({FLAT}) f""", "station_batch")
def p2(spark, sf):
    return reshape.storage_records(reshape.flatten(Tables(spark, sf).batches))


@query("p3_first_per_hour", """
SELECT station_id, date_trunc('hour', ts) AS hour,
       arg_min_null(value, ts) FILTER (WHERE data_type = 'water_level') AS water_level,
       arg_min_null(value, ts) FILTER (WHERE data_type = 'rainfall') AS rainfall
FROM reading GROUP BY 1, 2""", "reading")
def p3(spark, sf):
    return reshape.first_per_hour(Tables(spark, sf).reading)


@query("p3_first_or_zero", """
SELECT station_id, date_trunc('hour', ts) AS hour,
       COALESCE(arg_min_null(value, ts) FILTER (WHERE data_type = 'water_level'), 0.0) AS water_level,
       COALESCE(arg_min_null(value, ts) FILTER (WHERE data_type = 'rainfall'), 0.0) AS rainfall
FROM reading GROUP BY 1, 2""", "reading")
def p3_default(spark, sf):
    return reshape.first_per_hour(Tables(spark, sf).reading, tie=("event_id",), default=F.lit(0.0))


# Validation.

@query("p4_range_check", """
SELECT r.event_id, r.data_type, r.value, CASE WHEN s.data_type IS NULL THEN 'UNKNOWN_TYPE'
         WHEN r.value < s.min OR r.value > s.max THEN 'RANGE' END AS issue,
       NOT (s.data_type IS NULL OR COALESCE(r.value < s.min OR r.value > s.max, FALSE)) AS in_range
FROM reading r LEFT JOIN sensor_range s ON s.data_type = r.data_type""", "reading", "sensor_range")
def p4(spark, sf):
    t = Tables(spark, sf)
    return validate.check_ranges(t.reading, t.ranges).select(
        "event_id", "data_type", "value", "issue", "in_range")


@query("p5_inconsistent", f"SELECT station_id, hour, {LOGIC_BAD} AS inconsistent FROM hour_wide", "hour_wide")
def p5(spark, sf):
    return Tables(spark, sf).hour_wide.select(
        "station_id", "hour",
        validate.inconsistent(F.col("water_level"), F.col("rainfall")).alias("inconsistent"))


@query("p6_validate", f"SELECT station_id, hour, is_valid, quality_score, issue_codes "
       f"FROM ({sql_verdict('hour_wide', 'hour')}) v", "hour_wide")
def p6(spark, sf):
    return verdicts(Tables(spark, sf)).select(
        "station_id", "hour", "is_valid", "quality_score", issue_codes())


@query("p6t_time_rule", f"SELECT event_id, ts, {TIME_ISSUE.format('ts')} AS issue FROM reading", "reading")
def p6t(spark, sf):
    return Tables(spark, sf).reading.select(
        "event_id", "ts", validate.time_issue(F.col("ts"), AS_OF).alias("issue"))


@query("p7_batch_validate", f"""
SELECT location_id, timestamp, is_valid, quality_score, issue_codes FROM ({sql_verdict(
    "(SELECT station_id AS location_id, ts AS timestamp, CASE WHEN data_type = 'water_level' THEN value END "
    "AS water_level, CASE WHEN data_type = 'rainfall' THEN value END AS rainfall, "
    "CASE WHEN data_type = 'temperature' THEN value END AS temperature FROM reading) s", 'timestamp')}) v""",
       "reading")
def p7(spark, sf):
    records = reshape.storage_records(Tables(spark, sf).reading)
    return validate.validate(records, as_of=AS_OF).select(
        "location_id", "timestamp", "is_valid", "quality_score", issue_codes())


@query("p8_keep_valid", f"SELECT station_id, hour, {qrs(MEASURES)}, n_readings FROM "
       f"({sql_verdict('hour_wide', 'hour')}) v WHERE is_valid AND quality_score >= 0.6", "hour_wide")
def p8(spark, sf):
    return validate.keep_valid(verdicts(Tables(spark, sf))).select(
        "station_id", "hour", *rs(MEASURES), "n_readings")


@query("p8_keep_by_score", f"SELECT station_id, hour, n_readings FROM "
       f"({sql_verdict('hour_wide', 'hour')}) v WHERE quality_score >= 0.8", "hour_wide")
def p8_score(spark, sf):
    return validate.keep_valid(verdicts(Tables(spark, sf)), 0.8, require_valid=False).select(
        "station_id", "hour", "n_readings")


GRADES = f"""SELECT station_id, hour, {sql_grade('water_level')} AS risk_level,
       {sql_risk_name('water_level')} AS risk_name, {sql_confidence('water_level')} AS confidence FROM hour_wide"""


@query("p9_risk_grade", GRADES, "hour_wide")
def p9(spark, sf):
    return risk.with_grade(Tables(spark, sf).hour_wide, "water_level").select(
        "station_id", "hour", "risk_level", "risk_name", "confidence")


@query("p10_display_band", """
SELECT station_id, hour, CASE WHEN water_level > 25 THEN 'high' WHEN water_level > 20 THEN 'elevated'
       WHEN water_level IS NOT NULL THEN 'normal' END AS band FROM hour_wide""", "hour_wide")
def p10(spark, sf):
    return Tables(spark, sf).hour_wide.select(
        "station_id", "hour", risk.display_band(F.col("water_level")).alias("band"))


@query("p11_missing_fields", """
SELECT event_id, concat_ws(',', CASE WHEN value IS NULL THEN 'value' END, CASE WHEN ph IS NULL THEN 'ph' END,
       CASE WHEN note IS NULL OR note = '' THEN 'note' END) AS missing
FROM (SELECT *, CASE WHEN data_type = 'rainfall' THEN '' ELSE data_type END AS note FROM reading) r""", "reading")
def p11(spark, sf):
    noted = Tables(spark, sf).reading.withColumn(
        "note", F.when(F.col("data_type") == "rainfall", "").otherwise(F.col("data_type")))
    marked = validate.missing_fields(noted, ["station_id", "value", "ph"], ["note"])
    return marked.select("event_id", F.concat_ws(",", "missing").alias("missing"))


@query("p12_features", f"SELECT {qrs(MEASURES)} FROM hour_wide", "hour_wide")
def p12(spark, sf):
    return Tables(spark, sf).hour_wide.select(*rs(MEASURES))


@query("p13_drop_missing", f"SELECT station_id, hour, {qrs(['water_level', 'rainfall'])} FROM hour_wide "
       "WHERE water_level IS NOT NULL AND rainfall IS NOT NULL", "hour_wide")
def p13(spark, sf):
    rows = series.handle_missing(Tables(spark, sf).hour_wide, "drop", ["station_id"], "hour",
                                 ["water_level", "rainfall"])
    return rows.select("station_id", "hour", *rs(["water_level", "rainfall"]))


@query("p14_unknown_method", f"SELECT station_id, hour, {qrs(MEASURES)}, n_readings FROM hour_wide", "hour_wide")
def p14(spark, sf):
    return series.handle_missing(Tables(spark, sf).hour_wide, "none such", ["station_id"], "hour",
                                 MEASURES).select("station_id", "hour", *rs(MEASURES), "n_readings")


@query("a6_validation_summary", f"SELECT station_id, COUNT(*) AS total, COUNT(*) FILTER (WHERE is_valid) AS valid, "
       f"COUNT(*) FILTER (WHERE NOT is_valid) AS invalid FROM ({sql_verdict('hour_wide', 'hour')}) v GROUP BY 1",
       "hour_wide")
def a6(spark, sf):
    return validate.validation_summary(verdicts(Tables(spark, sf)), ["station_id"])


@query("a6_issues_by_code", f"SELECT split_part(c, ':', 1) AS code, split_part(c, ':', 2) AS field, COUNT(*) AS n FROM "
       f"(SELECT unnest(string_split(issue_codes, ',')) AS c FROM ({sql_verdict('hour_wide', 'hour')}) v "
       f"WHERE issue_codes <> '') i GROUP BY 1, 2", "hour_wide")
def a6_codes(spark, sf):
    return validate.issues_by_code(verdicts(Tables(spark, sf)))


# Lookups and key figures.

@query("j1_station_name", """
SELECT r.event_id, r.station_id, COALESCE(s.name, r.station_id) AS station_name
FROM reading r LEFT JOIN station s ON s.id = r.station_id""", "reading", "station")
def j1(spark, sf):
    t = Tables(spark, sf)
    return kpis.with_station_name(t.reading, t.stations).select("event_id", "station_id", "station_name")


@query("j2_station_place", """
SELECT r.event_id, COALESCE(s.name, 'unknown') AS station_name, COALESCE(CAST(s.lat AS VARCHAR), '-') AS lat,
       COALESCE(CAST(s.lng AS VARCHAR), '-') AS lng
FROM reading r LEFT JOIN station s ON s.id = r.station_id""", "reading", "station")
def j2(spark, sf):
    t = Tables(spark, sf)
    return kpis.with_station_place(t.reading, t.stations).select("event_id", "station_name", "lat", "lng")


@query("j3_grade_by_band", GRADES, "hour_wide")
def j3(spark, sf):
    t = Tables(spark, sf)
    return risk.grade_by_band(t.hour_wide, "water_level", t.thresholds).select(
        "station_id", "hour", "risk_level", "risk_name", "confidence")


@query("j3_grade_by_station", """
SELECT h.station_id, h.hour, CASE WHEN h.water_level IS NOT NULL THEN COALESCE(MAX(w.level), 0) END AS risk_level
FROM hour_wide h LEFT JOIN (SELECT s.id, w.level, w.min_level + CAST(substr(s.id, 4) AS INT) AS lo
                            FROM station s, warning_threshold w) w
  ON w.id = h.station_id AND h.water_level >= w.lo
GROUP BY h.station_id, h.hour, h.water_level""", "hour_wide", "station", "warning_threshold")
def j3_station(spark, sf):
    t = Tables(spark, sf)
    offset = F.substring("id", 4, 1).cast("int")
    own = (t.stations.select("id", offset.alias("offset"))
           .withColumn("w", F.explode(t.thresholds.agg(F.collect_list(
               F.struct("level", "name", "min_level", "confidence"))).scalar()))
           .select(F.col("id").alias("station_id"), "w.level", "w.name",
                   (F.col("w.min_level") + F.col("offset")).alias("min_level"), "w.confidence"))
    return risk.grade_by_band(t.hour_wide, "water_level", own, ("station_id",)).select(
        "station_id", "hour", "risk_level")


@query("j4_station_overview", """
SELECT s.id, s.name, l.water_level, l.rainfall, l.updated FROM station s LEFT JOIN (
  SELECT station_id, arg_max_null(value, ts) FILTER (WHERE data_type = 'water_level') AS water_level,
         arg_max_null(value, ts) FILTER (WHERE data_type = 'rainfall') AS rainfall, MAX(ts) AS updated
  FROM reading GROUP BY 1) l ON l.station_id = s.id""", "reading", "station")
def j4(spark, sf):
    t = Tables(spark, sf)
    return kpis.station_overview(t.stations, kpis.latest_readings(t.reading))


@query("a7_collection_stats", """
SELECT COUNT(*) AS total_collections, MAX(hour) AS last_time, 'realtime' AS last_kind,
       arg_max(stations, hour) AS last_stations
FROM (SELECT date_trunc('hour', ts) AS hour, COUNT(DISTINCT station_id) AS stations FROM reading GROUP BY 1) c""",
       "reading")
def a7(spark, sf):
    return kpis.collection_stats(kpis.collection_log(Tables(spark, sf).reading, G.time_bin(F.col("ts"), 3600)))


@query("k1_last_collection", """
SELECT MAX(hour) AS last_time, arg_max(stations, hour) AS last_stations
FROM (SELECT date_trunc('hour', ts) AS hour, COUNT(DISTINCT station_id) AS stations FROM reading GROUP BY 1) c""",
       "reading")
def k1(spark, sf):
    log = kpis.collection_log(Tables(spark, sf).reading, G.time_bin(F.col("ts"), 3600))
    return kpis.collection_stats(log).select("last_time", "last_stations")


@query("a8_readings_per_station", "SELECT station_id, COUNT(*) AS n_readings FROM reading GROUP BY 1", "reading")
def a8(spark, sf):
    return kpis.readings_per_station(Tables(spark, sf).reading)


@query("k3_first_batch", """
SELECT station_id, ts, data_type, value FROM reading WHERE station_id = 'S003' ORDER BY ts, event_id LIMIT 1""",
       "reading")
def k3(spark, sf):
    return (readings.station_readings(Tables(spark, sf).reading, "S003").orderBy("ts", "event_id").limit(1)
            .select("station_id", "ts", "data_type", "value"))


@query("u1_append_rows", f"""
SELECT station_id, hour, water_level, rainfall, note FROM (
  SELECT station_id, hour, {qrs(['water_level', 'rainfall'])},
         NULL::VARCHAR AS note FROM hour_wide
  UNION ALL
  SELECT station_id, hour, 999.99, NULL, 'appended' FROM hour_wide WHERE n_readings > 3)""", "hour_wide")
def u1(spark, sf):
    hours = Tables(spark, sf).hour_wide
    more = hours.filter("n_readings > 3").select(
        "station_id", "hour", F.lit(999.99).alias("water_level"), F.lit("appended").alias("note"))
    return reshape.append_rows(
        hours.select("station_id", "hour", *rs(["water_level", "rainfall"])), more)


@query("u3_collection_log", """
SELECT date_trunc('hour', ts) AS collected_at, 'realtime' AS kind, COUNT(DISTINCT station_id) AS stations_count
FROM reading GROUP BY 1""", "reading")
def u3(spark, sf):
    return kpis.collection_log(Tables(spark, sf).reading, G.time_bin(F.col("ts"), 3600))


@query("u3_station_collection_log", """
SELECT DISTINCT date_trunc('hour', ts) AS collected_at, 'station_realtime' AS kind, station_id
FROM reading WHERE station_id = 'S001'""", "reading")
def u3_station(spark, sf):
    return kpis.station_collection_log(Tables(spark, sf).reading, G.time_bin(F.col("ts"), 3600), "S001")


# Scalar expressions.

@query("e1_parse_iso", """
SELECT event_id, CASE WHEN error IS NULL THEN date_trunc('second', ts) END AS parsed FROM reading""", "reading")
def e1(spark, sf):
    text = F.when(F.col("error").isNotNull(), "not a time").otherwise(G.iso_time(F.col("ts")))
    return Tables(spark, sf).reading.select("event_id", G.parse_iso(text).alias("parsed"))


@query("e2_format_time", """
SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS compact, strftime(ts, '%H:%M:%S') AS clock,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM reading""", "reading")
def e2(spark, sf):
    ts = F.col("ts")
    return Tables(spark, sf).reading.select(
        "event_id", G.compact_time(ts).alias("compact"), G.clock_time(ts).alias("clock"),
        G.iso_time(ts).alias("iso"))


@query("e3_add_hours_age", f"""
SELECT event_id, ts + INTERVAL 24 HOUR AS expires,
       CAST(FLOOR((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(ts)) / 86400000000) AS INTEGER) AS age FROM reading""",
       "reading")
def e3(spark, sf):
    ts = F.col("ts")
    return Tables(spark, sf).reading.select(
        "event_id", G.add_hours(ts, 24).alias("expires"), G.age_days(ts, G.as_moment(AS_OF)).alias("age"))


@query("e4_round_floor_abs", f"""
SELECT event_id, {half_up('value / 3')} AS third, GREATEST(CAST(0 AS DOUBLE), value - 20) AS above,
       ABS(value - 20) AS distance FROM reading""", "reading")
def e4(spark, sf):
    value = F.col("value")
    return Tables(spark, sf).reading.select(
        "event_id", G.rounded(value / 3).alias("third"), G.floor_zero(value - 20).alias("above"),
        F.abs(value - 20).alias("distance"))


@query("e5_hour_sine", f"""
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour_of_day, {qr('sin(2 * pi() * (hour(ts) - 6) / 24)', 'phase')}
FROM reading""", "reading")
def e5(spark, sf):
    hour = F.hour("ts")
    return Tables(spark, sf).reading.select(
        "event_id", hour.alias("hour_of_day"), c(F.sin(2 * F.pi() * (hour - 6) / 24)).alias("phase"))


@query("e6_text_template", """
SELECT event_id, 'Station ' || station_id || ' sent ' || data_type || ' no. ' || lpad(CAST(event_id AS VARCHAR), 9, '0')
       AS line FROM reading""", "reading")
def e6(spark, sf):
    line = F.format_string("Station %s sent %s no. %s", "station_id", "data_type",
                           G.numbered(F.col("event_id"), 9))
    return Tables(spark, sf).reading.select("event_id", line.alias("line"))


@query("e7_default_presence", """
SELECT event_id, COALESCE(value, 0.0) AS value_or_zero, value IS NOT NULL AS has_value FROM reading""", "reading")
def e7(spark, sf):
    return Tables(spark, sf).reading.select(
        "event_id", F.coalesce("value", F.lit(0.0)).alias("value_or_zero"),
        F.col("value").isNotNull().alias("has_value"))


@query("e8_code_label", f"""
SELECT station_id, hour, COALESCE(CASE {sql_grade('water_level')} WHEN 1 THEN 'blue' WHEN 2 THEN 'yellow'
       WHEN 3 THEN 'orange' WHEN 4 THEN 'red' END, 'unknown') AS label FROM hour_wide""", "hour_wide")
def e8(spark, sf):
    names = [(n, name) for n, name, _, _ in dims.C.WARNING_THRESHOLDS]
    graded = risk.with_grade(Tables(spark, sf).hour_wide, "water_level")
    return graded.select("station_id", "hour", G.code_label(F.col("risk_level"), names, "unknown").alias("label"))


@query("e9_hash_suffix", """
SELECT event_id, CAST(CAST('0x' || substr(md5(props || station_id), 1, 8) AS BIGINT) % 1000 AS BIGINT) AS suffix
FROM (SELECT r.event_id, r.station_id, e.props FROM reading r JOIN events e USING (event_id)) x""", "reading")
def e9(spark, sf):
    t = Tables(spark, sf)
    station = F.concat(F.lit("S00"), (F.col("user_id") % 5 + 1).cast("string"))
    return t.raw("events").select("event_id", G.hash_suffix(F.concat("props", station)).alias("suffix"))


@query("e10_tanh_exp", f"SELECT event_id, {qr('tanh(value / 1000)', 'tanh')}, {qr('exp(value / 1000)', 'exp', 4)} FROM reading", "reading")
def e10(spark, sf):
    value = F.col("value")
    return Tables(spark, sf).reading.select(
        "event_id", c(F.tanh(value / 1000)).alias("tanh"), c(F.exp(value / 1000), 4).alias("exp"))


@query("e11_row_json")
def e11(spark, sf):
    source = Tables(spark, sf).reading
    return source.select("event_id", tables.row_json(*source.columns).alias("line"))


@query("e11_parsed_row", """
SELECT event_id, station_id, data_type, ts, value, ph, turbidity, dissolved_oxygen, error FROM reading""", "reading")
def e11_parsed(spark, sf):
    """Every field of every row read back from its text."""
    source = Tables(spark, sf).reading
    names = ["event_id", "station_id", "data_type", "ts", "value", "ph", "turbidity", "dissolved_oxygen", "error"]
    types = dict(source.dtypes)
    shape = ", ".join(f"{name} {types[name]}" for name in names)
    lines = source.select(tables.row_json(*source.columns).alias("line"))
    return lines.select(F.from_json("line", shape, tables.JSON_TIMES).alias("row")).select("row.*")


@query("e12_guarded_division", f"""
SELECT event_id, {qr('value / CASE WHEN event_id % 4 = 0 THEN CAST(1 AS DOUBLE) ELSE event_id % 4 END', 'share')}
FROM reading""", "reading")
def e12(spark, sf):
    divisor = (F.col("event_id") % 4).cast("double")
    return Tables(spark, sf).reading.select("event_id", c(F.col("value") / G.guarded(divisor)).alias("share"))


@query("e13_recent_spine", """
SELECT station_id, unnest(generate_series(last_hour - INTERVAL 71 HOUR, last_hour, INTERVAL 1 HOUR)) AS hour
FROM (SELECT station_id, MAX(hour) AS last_hour FROM hour_wide GROUP BY 1) e""", "hour_wide")
def e13(spark, sf):
    ends = Tables(spark, sf).hour_wide.groupBy("station_id").agg(F.max("hour").alias("last_hour"))
    return series.recent_spine(ends, "last_hour").select("station_id", "hour")


@query("s4_malformed_batches", """
SELECT event_id % 10 = 0 AS malformed, COUNT(*) AS n, COUNT(CASE WHEN event_id % 10 <> 0 THEN value END) AS n_values
FROM reading GROUP BY 1""", "reading")
def s4_malformed(spark, sf):
    """Batches written as JSON lines, every tenth cut off, and read back: none vanishes."""
    fields = ["station_id", "data_type", "value", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")]
    line = F.to_json(F.struct("station_id", F.array(F.struct(*fields)).alias("readings")))
    cut = F.when(F.col("event_id") % 10 == 0, F.substring(line, 1, 25)).otherwise(line)
    path = f"{run_folder(spark, 's4')}/lines"
    Tables(spark, sf).reading.select(cut.alias("value")).write.text(path)
    flat = reshape.flatten(readings.read_batches(spark, path))
    return flat.groupBy(F.col("malformed").isNotNull().alias("malformed")).agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("n_values"))


@query("s8_overflow", """
SELECT COALESCE(CASE WHEN ABS(ROUND(value * 1000, 2)) >= 1000000 THEN 'OVERFLOW_WATER_LEVEL' END, '') AS problem, COUNT(*) AS n
FROM reading WHERE NOT isnan(COALESCE(value, 0)) GROUP BY 1""", "reading")
def s8_overflow(spark, sf):
    """A number too large for its column is a problem, not an accepted NULL."""
    rows = Tables(spark, sf).reading.select(
        F.col("station_id").alias("location_id"), F.col("ts").alias("timestamp"), (F.col("value") * 1000).alias("water_level"))
    conformed = tables.conform(rows, "water_monitoring_data", AS_OF)
    return conformed.groupBy(F.array_join("problems", ",").alias("problem")).agg(F.count(F.lit(1)).alias("n"))
