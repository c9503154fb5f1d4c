import datetime as dt

from pyspark.sql import functions as F

from gaugeline.operators import kpis, warnings
from gaugeline.sources import dims

NOW = dt.datetime(2024, 1, 25, 12)
RESULT = "location_id string, station_name string, max_predicted_water_level double, risk_level int"


def results(spark):
    return spark.createDataFrame([("S001", "upper reach", 22.5, 3), ("S002", "middle reach", 9.0, 0),
                                  (None, "lower reach", 31.0, 4), ("S004", None, 15.5, 1), ("S005", "x", 1.0, 9)], RESULT)


def log(spark, as_of=NOW):
    return warnings.generate_flood_warnings(results(spark), as_of)


def test_generated_from_the_given_risk_level(spark):
    rows = {r["affected_location"]: r for r in log(spark).collect()}
    assert set(rows) == {"S001", "lower reach", "S004", "S005"}
    first = rows["S001"]
    assert first["warning_level"] == 3 and first["title"] == "ORANGE - upper reach"
    assert "upper reach: peak of 22.5 m" in first["content"]
    assert first["publish_time"] == NOW and first["expire_time"] == NOW + dt.timedelta(hours=24)
    assert first["status"] == 1 and first["warning_type"] == 1
    assert "unknown station" in rows["S004"]["title"]
    assert rows["S005"]["title"] == "NOTICE - x" and rows["S005"]["content"] == "x: level of 1.0 m."


def test_ids_are_stable_and_distinct(spark):
    ids = [r["id"] for r in log(spark).collect()]
    assert sorted(ids) == sorted(r["id"] for r in log(spark).collect())
    assert len(set(ids)) == 4 and all(i.startswith("WARN-20240125120000-") for i in ids)


def test_created_with_default_location(spark):
    df = spark.createDataFrame([(2, 1, "t", "c", ""), (2, 1, "u", "c", None), (3, 2, "v", "c", "dam")],
                               "warning_type int, warning_level int, title string, content string, affected_location string")
    rows = {r["title"]: r for r in warnings.create_warnings(df, NOW, 6).collect()}
    assert [rows[t]["affected_location"] for t in "tuv"] == ["unknown area", "unknown area", "dam"]
    assert rows["t"]["expire_time"] == NOW + dt.timedelta(hours=6)


def test_fan_out(spark):
    sent = warnings.fan_out(log(spark))
    assert sent.count() == 12 and {r["channel"] for r in sent.collect()} == {"system_notification", "app_push", "sms"}
    one = warnings.delivery_results(log(spark), ["sms"], F.lit(False)).first()
    assert [tuple(s) for s in one["sent_results"]] == [("sms", False)]


def test_cancel_and_expiry(spark):
    table = log(spark)
    ids = {r["affected_location"]: r["id"] for r in table.collect()}
    cancels = spark.createDataFrame([(ids["S001"],), (ids["S001"],), ("none",)], "id string")
    outcomes = {(r["id"], r["found"]) for r in warnings.cancel_outcomes(table, cancels).collect()}
    assert outcomes == {(ids["S001"], True), ("none", False)}
    states = {r["id"]: r["status"] for r in warnings.current_state(table, cancels).collect()}
    assert states[ids["S001"]] == 0 and sum(states.values()) == 3 and len(states) == 4
    later = NOW + dt.timedelta(hours=24)
    assert warnings.active_warnings(table, cancels, later - dt.timedelta(microseconds=1)).count() == 3
    assert warnings.active_warnings(table, cancels, later).count() == 0
    labels = {r["affected_location"]: r["level_name"] for r in
              warnings.display_list(warnings.active_warnings(table, cancels, NOW)).collect()}
    assert labels == {"lower reach": "red", "S004": "blue", "S005": "unknown"}
    r = kpis.overview(dims.stations(spark), warnings.active_warnings(table, cancels, NOW), NOW).first()
    assert (r["stations"], r["active_warnings"], r["sensors"]) == (5, 3, 15)


def test_empty_collection_log(spark):
    empty = spark.createDataFrame([], "collected_at timestamp, kind string, stations_count long")
    r = kpis.collection_stats(empty).first()
    assert r["total_collections"] == 0 and r["last_time"] is None


def test_requests_that_differ_have_different_ids(spark):
    from itertools import product
    said = [(t, c, p, m) for t, c, p, m in product(["a|b", "a", "", None, "1:a"], ["c", "b|c", "", None, "a1:"], ["dam", "d-am"], [0, 1])]
    df = spark.createDataFrame([(2, 1, *s) for s in said], "warning_type int, warning_level int, title string, content string, "
                               "affected_location string, micros long")
    at = F.timestamp_micros(F.unix_micros(F.lit(NOW)) + F.col("micros"))
    made = warnings.create_warnings(df.withColumn("at", at), F.col("at"))
    assert made.select("id").distinct().count() == len(said)
