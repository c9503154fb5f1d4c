import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import reshape, risk, validate
from gaugeline.sources import dims

AS_OF = dt.datetime(2024, 1, 25)
RECORD = "water_level double, rainfall double, temperature double, timestamp timestamp"


def verdict(spark, level=None, rain=None, temperature=None, moment=AS_OF):
    df = spark.createDataFrame([(level, rain, temperature, moment)], RECORD)
    r = validate.validate(df, as_of=AS_OF).first()
    return r["is_valid"], r["quality_score"], [i["code"] for i in r["issues"]]


def test_good_record(spark):
    assert verdict(spark, 15.0, 20.0, 25.0) == (True, 1.0, [])


def test_outliers(spark):
    assert verdict(spark, 999.0, 999.0) == (False, 0.5, ["RANGE", "RANGE"])
    old = dt.datetime(2024, 1, 1)
    assert verdict(spark, 999.99, 999.99, moment=old) == (False, 0.3, ["RANGE", "RANGE", "EXPIRED"])


def test_everything_wrong_stops_at_zero(spark):
    assert verdict(spark, -1.0, 600.0, 50.0, AS_OF + dt.timedelta(seconds=1)) == (
        False, 0.0, ["RANGE", "RANGE", "RANGE", "INCONSISTENT", "FUTURE"])


def test_absent_fields_are_not_checked(spark):
    assert verdict(spark) == (True, 1.0, [])
    assert verdict(spark, None, 80.0) == (True, 1.0, [])


@pytest.mark.parametrize("level,rain,bad", [(5.0, 10.0, False), (0.5, 80.0, True), (1.0, 80.0, False), (0.5, 50.0, False)])
def test_logical_rule(spark, level, rain, bad):
    assert ("INCONSISTENT" in verdict(spark, level, rain)[2]) is bad


@pytest.mark.parametrize("age,code", [
    (dt.timedelta(seconds=-1), "FUTURE"), (dt.timedelta(0), None), (dt.timedelta(days=7, hours=23), None),
    (dt.timedelta(days=8) - dt.timedelta(microseconds=1), None), (dt.timedelta(days=8), "EXPIRED")])
def test_time_rule(spark, age, code):
    df = spark.createDataFrame([(AS_OF - age,)], "ts timestamp")
    assert df.select(validate.time_issue(F.col("ts"), AS_OF)).first()[0] == code


def test_range_check_of_long_readings(spark):
    rows = [("water_level", 10.0), ("water_level", 999.0), ("ph", 14.0), ("ph", 14.1), ("wind", 3.0),
            ("temperature", -10.0), ("temperature", None)]
    df = spark.createDataFrame(rows, "data_type string, value double")
    got = {(r["data_type"], r["value"]): r["issue"] for r in validate.check_ranges(df, dims.sensor_ranges(spark)).collect()}
    assert got == {("water_level", 10.0): None, ("water_level", 999.0): "RANGE", ("ph", 14.0): None,
                   ("ph", 14.1): "RANGE", ("wind", 3.0): "UNKNOWN_TYPE", ("temperature", -10.0): None,
                   ("temperature", None): None}


def test_filter_and_summary(spark):
    df = spark.createDataFrame([(15.0, 20.0, 25.0, AS_OF), (15.0, 20.0, 50.0, AS_OF), (99.0, 2.0, 5.0, AS_OF)], RECORD)
    verdicts = validate.validate(df, as_of=AS_OF)
    assert validate.keep_valid(verdicts).columns == df.columns
    assert validate.keep_valid(verdicts).count() == 1
    assert validate.keep_valid(verdicts, 0.8, require_valid=False).count() == 2
    r = validate.validation_summary(verdicts).first()
    assert (r["total"], r["valid"], r["invalid"]) == (3, 1, 2)
    codes = {(r["code"], r["field"]): r["n"] for r in validate.issues_by_code(verdicts).collect()}
    assert codes == {("RANGE", "temperature"): 1, ("RANGE", "water_level"): 1}


def test_missing_fields(spark):
    df = spark.createDataFrame([("S", "t"), (None, ""), ("", "t")], "station_id string, title string")
    got = [r["missing"] for r in validate.missing_fields(df, ["station_id"], ["title"]).collect()]
    assert got == [[], ["station_id", "title"], []]


@pytest.mark.parametrize("level,number", [(14.99, 0), (15.0, 1), (20.0, 2), (22.5, 2), (25.0, 3), (30.0, 4), (None, None)])
def test_grades(spark, level, number):
    df = spark.createDataFrame([("S", level)], "station_id string, water_level double")
    assert risk.with_grade(df, "water_level").first()["risk_level"] == number
    assert risk.grade_by_band(df, "water_level", dims.warning_thresholds(spark)).first()["risk_level"] == number
    own = dims.warning_thresholds(spark).withColumn("station_id", F.lit("S"))
    assert risk.grade_by_band(df, "water_level", own, ("station_id",)).first()["risk_level"] == number


def test_display_band_is_exclusive(spark):
    df = spark.createDataFrame([(20.0,), (20.1,), (25.0,), (25.1,)], "x double")
    assert [r[0] for r in df.select(risk.display_band(F.col("x"))).collect()] == ["normal", "elevated", "elevated", "high"]


def test_flatten_and_store(spark):
    ts = "2024-01-05T06:07:08.123456"
    readings = [
        {"station_id": "S1", "data_type": "water_level", "value": 3.5, "unit": "m", "timestamp": ts},
        {"station_id": "S1", "data_type": "rainfall", "error": "broken", "timestamp": ts},
        {"station_id": "S1", "data_type": "water_quality", "timestamp": "yesterday",
         "parameters": {"ph": float("nan"), "turbidity": 2.0, "dissolved_oxygen": 8.0}}]
    from gaugeline.schemas import STATION_BATCH
    batches = spark.createDataFrame([{"station_id": "S1", "readings": readings}, {"station_id": "S2", "readings": []}],
                                    STATION_BATCH)
    flat = reshape.flatten(batches)
    assert flat.count() == 3
    records = {r["data_quality"]: r for r in reshape.storage_records(flat.filter("data_type != 'water_quality'")).collect()}
    assert records[1]["water_level"] == 3.5 and records[1]["rainfall"] is None
    assert records[1]["timestamp"] == dt.datetime(2024, 1, 5, 6, 7, 8, 123456)
    assert records[2]["rainfall"] is None
    quality = reshape.storage_records(flat.filter("data_type = 'water_quality'")).first()
    assert (quality["ph_value"], quality["turbidity"], quality["timestamp"]) == (None, 2.0, None)


def test_first_reading_wins(spark):
    base = dt.datetime(2024, 1, 1, 5)
    rows = [("S", "water_level", base, None, 1), ("S", "water_level", base + dt.timedelta(minutes=1), 2.0, 2),
            ("S", "rainfall", base + dt.timedelta(minutes=9), 4.0, 4), ("S", "rainfall", base + dt.timedelta(minutes=9), 3.0, 3)]
    df = spark.createDataFrame(rows, "station_id string, data_type string, ts timestamp, value double, event_id int")
    r = reshape.first_per_hour(df, tie=["event_id"]).first()
    assert (r["hour"], r["water_level"], r["rainfall"]) == (base, None, 3.0)
    assert reshape.first_per_hour(df, tie=["event_id"], default=F.lit(0.0)).first()["water_level"] == 0.0
