import datetime as dt
import json

from pyspark.sql import functions as F

from gaugeline.schemas import STATION_BATCH
from gaugeline.sources import readings, tables

NOW = dt.datetime(2024, 1, 25)


def test_conform_types_defaults_and_rules(spark):
    rows = [("S1", NOW, 12.345, None, None), ("S9", NOW, 1.0, 1e9, 1), ("S8", NOW, float("nan"), 1.0, 2), (None, NOW, 1.0, 1.0, 1), ("S2", None, 1.0, 1.0, 2), ("S3", NOW, 1.0, 1.0, 7)]
    df = spark.createDataFrame(rows, "location_id string, timestamp timestamp, water_level double, flow_rate double, data_quality int")
    out = tables.conform(df, "water_monitoring_data", NOW)
    assert dict(out.dtypes)["water_level"] == "decimal(8,2)"
    good = {r["location_id"]: r for r in tables.accepted(out).collect()}
    assert set(good) == {"S1", "S8"} and good["S8"]["water_level"] is None
    good = good["S1"]
    assert (str(good["water_level"]), good["flow_rate"], good["data_quality"], good["status"]) == ("12.35", None, 1, 1)
    assert good["created_at"] == NOW and good["temperature"] is None
    assert sorted(r["problems"] for r in tables.rejected(out).collect()) == [
        ["CODE_DATA_QUALITY"], ["MISSING_LOCATION_ID"], ["MISSING_TIMESTAMP"], ["OVERFLOW_FLOW_RATE"]]


def test_text_that_is_no_number_is_a_problem(spark):
    df = spark.createDataFrame([("S1", NOW, "12.5"), ("S2", NOW, "high")], "location_id string, timestamp timestamp, water_level string")
    out = {r["location_id"]: r["problems"] for r in tables.conform(df, "water_monitoring_data", NOW).collect()}
    assert out == {"S1": [], "S2": ["TYPE_WATER_LEVEL"]}


def test_wide_ph_fits(spark):
    df = spark.createDataFrame([("S1", NOW, 12.5, 9)], "location_id string, timestamp timestamp, ph_value double, water_quality_level int")
    row = tables.conform(df, "water_quality_data", NOW).first()
    assert str(row["ph_value"]) == "12.50" and row["problems"] == ["CODE_WATER_QUALITY_LEVEL"]


def test_append_partitions_by_day(spark, tmp_path):
    path = str(tmp_path / "water")
    rows = [("S1", NOW + dt.timedelta(hours=h), float(h)) for h in range(48)]
    df = spark.createDataFrame(rows, "location_id string, timestamp timestamp, water_level double")
    for part in (df.filter("water_level < 30"), df.filter("water_level >= 30")):
        tables.append(tables.conform(part, "water_monitoring_data", NOW), "water_monitoring_data", path)
    back = tables.read_table(spark, path)
    assert back.count() == 48 and back.select("day").distinct().count() == 2
    pruned = back.filter(F.col("day") == "2024-01-25")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in pruned
    station = spark.createDataFrame([("S1", "upper")], "id string, name string")
    tables.append(tables.conform(station, "monitor_station", NOW), "monitor_station", str(tmp_path / "station"))
    assert tables.read_table(spark, str(tmp_path / "station")).first()["status"] == 1


def test_json_round_trip(spark, tmp_path):
    moment = dt.datetime(2024, 1, 5, 6, 7, 8, 123456)
    df = spark.createDataFrame([("S1", moment, "旱 é", None)], "id string, ts timestamp, note string, x double")
    tables.export_json(df, str(tmp_path / "out"))
    assert tables.import_json(spark, str(tmp_path / "out"), df.schema).collect() == df.collect()


def test_batches_from_json_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    batch = {"station_id": "S001", "readings": [
        {"station_id": "S001", "data_type": "water_level", "value": 8.1, "unit": "m", "timestamp": "2024-01-05T00:00:00"},
        {"station_id": "S001", "data_type": "water_quality", "timestamp": "2024-01-05T00:00:00",
         "parameters": {"ph": 7.0, "turbidity": 15.0, "dissolved_oxygen": 8.0}}]}
    (tmp_path / "in" / "a.json").write_text(json.dumps(batch) + "\n")
    df = readings.read_batches(spark, str(tmp_path / "in"))
    assert df.drop("_corrupt_record").schema == STATION_BATCH and len(df.first()["readings"]) == 2


def test_submissions(spark):
    lines = ['{"station_id": "S1", "data_type": "rainfall", "value": 3.5, "timestamp": "2024-01-05T00:00:00"}',
             '{"data_type": "rainfall", "value": 3.5}', '{"station_id": "S1"', "[1, 2]", ""]
    parsed = readings.parse_submissions(spark.createDataFrame([(x,) for x in lines], "value string"))
    problems = {r["accepted"]: [] for r in parsed.select("accepted").distinct().collect()}
    for r in parsed.collect():
        problems[r["accepted"]].append(r["problems"])
    assert problems[True] == [[]]
    assert sorted(p[0] for p in problems[False]) == ["MALFORMED", "MALFORMED", "MALFORMED", "MISSING_STATION_ID"]


def test_register_model(spark):
    df = spark.createDataFrame([(NOW,), (NOW + dt.timedelta(days=3),)], "ts timestamp")
    row = tables.register_model("v1", df, "ts", {"horizon": 24}, F.lit(0.91234), "first", NOW).first()
    assert row["training_data_range"] == "2024-01-25 00:00:00 .. 2024-01-28 00:00:00"
    assert (row["version"], str(row["accuracy"]), row["parameters_summary"]) == ("v1", "0.9123", '{"horizon":24}')
    assert row["problems"] == [] and row["deployed_at"] == NOW


def test_a_batch_that_is_appended_again_replaces_itself(spark, tmp_path):
    import pytest

    from gaugeline.sources import commits
    path = str(tmp_path / "water")
    shape = "location_id string, timestamp timestamp, water_level double"

    def conformed(*levels):
        return tables.conform(spark.createDataFrame([("S1", NOW + dt.timedelta(days=i), x) for i, x in enumerate(levels)], shape), "water_monitoring_data", NOW)

    def stored():
        return sorted(float(r.water_level) for r in tables.read_table(spark, path, "water_monitoring_data").collect())

    assert stored() == []
    rows, partitions = tables.laid_out(conformed(9.0), "water_monitoring_data")
    commits.write_attempt(rows, path, partitions)  # breaks off before its commit
    assert stored() == []
    with pytest.raises(ValueError, match="no committed batch"):
        commits.read_batches(spark, path)
    tables.append(conformed(1.0, 2.0), "water_monitoring_data", path, "2024-01-25, first/half")
    tables.append(conformed(3.0), "water_monitoring_data", path, "b")
    assert stored() == [1.0, 2.0, 3.0]
    tables.append(conformed(1.0, 2.5), "water_monitoring_data", path, "2024-01-25, first/half")
    assert stored() == [1.0, 2.5, 3.0]
    running = commits.write_attempt(rows, path, partitions)
    assert len(commits.clean(spark, path, [running])) == 2 and stored() == [1.0, 2.5, 3.0]
    commits.commit(spark, path, "c", running)
    assert stored() == [1.0, 2.5, 3.0, 9.0] and commits.clean(spark, path) == []
    back = tables.read_table(spark, path).filter(F.col("day") == "2024-01-26")
    assert "PartitionFilters: [isnotnull(day" in back._jdf.queryExecution().executedPlan().toString()
    tables.append(conformed().limit(0), "water_monitoring_data", path, "b")
    assert stored() == [1.0, 2.5, 9.0]


def test_submissions_are_stored_once(spark, tmp_path):
    from gaugeline.sources import commits
    lines = ['{"station_id": "S1", "data_type": "rainfall", "value": 3.5, "timestamp": "2024-01-05T00:00:00"}', '{"data_type": "rainfall"}', "no json", "no json"]
    parsed = readings.parse_submissions(spark.createDataFrame([(x,) for x in lines], "line string"), "line")
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    for _ in range(2):
        readings.store_submissions(parsed, good, bad, "one", "line")
    assert [(r.station_id, r.value, str(r.day)) for r in commits.read_batches(spark, good).collect()] == [("S1", 3.5, "2024-01-05")]
    assert sorted((r.line, r.problems[0]) for r in commits.read_batches(spark, bad).collect()) == [
        ("no json", "MALFORMED"), ("no json", "MALFORMED"), (lines[1], "MISSING_STATION_ID")]


def test_a_station_week_lies_in_few_row_groups(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from gaugeline.sources import layout
    rows = spark.range(200 * 2000).select(
        F.concat(F.lit("S"), F.lpad((F.col("id") % 200).cast("string"), 4, "0")).alias("station"),
        (F.lit(NOW) + F.make_interval(hours=(F.col("id") / 200).cast("int"))).alias("at"), F.rand(1).alias("x"))
    odd = spark.createDataFrame([(None, NOW, 1.0), ("S0001", None, 2.0)], "station string, at timestamp, x double")
    path = str(tmp_path / "clustered")
    layout.write_clustered(rows.unionByName(odd), path, "station", "at", files=4, row_group_bytes=32 << 10)
    back = spark.read.parquet(path)
    assert back.columns == ["station", "at", "x"] and back.count() == 400_002
    low, high = NOW + dt.timedelta(days=21), NOW + dt.timedelta(days=28)
    week = back.filter((F.col("station") == "S0042") & (F.col("at") >= F.lit(low)) & (F.col("at") < F.lit(high)))
    assert week.count() == 7 * 24
    hit = total = 0
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        for g in range(meta.num_row_groups):
            station, at = (meta.row_group(g).column(c).statistics for c in (0, 1))
            total += 1
            hit += station.min <= "S0042" <= station.max and at.min.replace(tzinfo=None) < high and at.max.replace(tzinfo=None) >= low
    assert total > 60 and 0 < hit <= 0.05 * total


def test_series_are_ranked_evenly(spark):
    from gaugeline.sources import layout
    named = spark.createDataFrame([(f"s{i:03d}",) for i in range(64)] * 3 + [(None,)], "k string")
    ranks = sorted(tuple(r) for r in layout.series_ranks(named, "k", 8).collect())
    assert ranks == [(f"s{i:03d}", i * 4) for i in range(64)]
    assert layout.series_ranks(named.limit(0), "k").count() == 0
    keys = {(a, b): r[0] for a in range(4) for b in range(4)
            for r in spark.range(1).select(layout.curve_key(F.lit(a), F.lit(b), 2)).collect()}
    assert keys == {(a, b): (a >> 1 & 1) << 3 | (b >> 1 & 1) << 2 | (a & 1) << 1 | (b & 1) for a in range(4) for b in range(4)}
