"""What is stored as days arrive gives the results of the whole table, and new days read no old ones."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import scale, series
from gaugeline.plans import statistics

START = dt.datetime(2024, 1, 1)
SHAPE = "station string, at timestamp, x double, rain double"


@pytest.fixture(scope="module")
def hours(spark):
    rng = random.Random(3)
    rows = [(s, START + dt.timedelta(hours=h), rng.choice([None, 1e9 + rng.random(), 4.0]), rng.choice([0.0, 0.0, 1.0, 2.5]))
            for s in ("a", "b", None) for h in range(24 * 6) if rng.random() < 0.9]
    rows += [("flat", START + dt.timedelta(hours=h), 7.0, 1.0) for h in range(24 * 6)] + [("empty", START, None, None)]
    return spark.createDataFrame(rows, SHAPE)


def close(a, b):
    return len(a) == len(b) and all(x[:2] == y[:2] and (x[2] == y[2] or abs(x[2] - y[2]) < 1e-6) for x, y in zip(a, b))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stored_statistics_scale_new_days(spark, hours, tmp_path):
    table, stats = str(tmp_path / "hours"), str(tmp_path / "stats")
    hours.withColumn("day", F.to_date("at")).write.partitionBy("day").parquet(table)
    stored = spark.read.parquet(table)
    for number in range(6):
        day = stored.filter(F.col("day") == F.lit((START + dt.timedelta(days=number)).date()))
        for _ in range(1 + (number == 5)):
            statistics.store(day, stats, str(number), ["station"], "at", ["x"])
    new = stored.filter("day = DATE '2024-01-06'")
    merged = statistics.merged(statistics.load(spark, stats), ["station"], ["x"])
    for found, whole in ((statistics.standardize(new, merged, ["station"], ["x"]), scale.standardize(hours, ["x"], ["station"], "at")),
                         (statistics.normalize(new, merged, ["station"], ["x"]), scale.normalize(hours, ["x"], ["station"], "at"))):
        scans = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
        readings = [line for line in scans if "rain#" in line]
        assert len(readings) == 1 and "= 2024-01-06)" in readings[0]
        assert close(rows(found.select("station", "at", "x")), rows(whole.filter("at >= '2024-01-06'").select("station", "at", "x")))
    flags = statistics.anomalies(new, merged, ["station"], ["x"], 1.0).select("station", "at", "is_anomaly_x")
    whole = scale.flag_anomalies(hours, "x", 1.0, ["station"], "at").filter("at >= '2024-01-06'").select("station", "at", "is_anomaly")
    assert rows(flags) == rows(whole) and any(r[2] for r in rows(flags))


def test_rain_events_across_appended_days(spark, hours, tmp_path):
    path = str(tmp_path / "runs")
    twice = hours.unionByName(hours.filter("hour(at) % 5 = 0"))  # some hours twice
    for number in (3, 0, 5, 1, 1, 4, 2):
        day = twice.filter(F.to_date("at") == F.lit((START + dt.timedelta(days=number)).date()))
        series.store_rain_runs(day, path, str(number), ["station"], "at", "rain")
    found = series.read_rain_events(spark, path, ["station"])
    assert rows(found) == rows(series.rain_events(twice, ["station"], "at", "rain")) and found.count() > 20
    flat = found.filter("station = 'flat'").collect()
    assert [(r.start, r.hours) for r in flat] == [(START, 144)]


def test_long_gaps_come_from_the_summary(spark):
    """Gaps shorter than, as long as and longer than a block, at its borders too, with and without a tail."""
    for hops in ([1, 23, 24, 25, 26, 100, 1, 1], [24, 24, 47, 48, 49], [1000], [5, 200, 3]):
        at = [0]
        for hop in hops:
            at.append(at[-1] + hop)
        data = [("s", START + dt.timedelta(hours=h), float(h) if i % 3 else None, float(i)) for i, h in enumerate(at)]
        bins = spark.createDataFrame(data, "k string, t timestamp, x double, n double")
        expected = []
        known = {h: x for (_, _, x, _), h in zip(data, at) if x is not None}
        for h in range(at[-1] + 1):
            before, after = [k for k in known if k <= h], [k for k in known if k >= h]
            x = None if not before else known[max(before)] if not after or max(before) == h else (
                known[max(before)] + (known[min(after)] - known[max(before)]) * (h - max(before)) / (min(after) - max(before)))
            expected.append((START + dt.timedelta(hours=h), x, h, float(at.index(h)) if h in at else None))
        for last in (None, 1, 7, 30, 150):
            found = series.dense_series(bins, ["k"], "t", ["x"], last=last, block="1 day", passed=["n"])
            got = sorted((r.t, r.x, r.step, r.n) for r in found.collect())
            want = expected[-last:] if last else expected
            assert len(got) == len(want), (hops, last)
            for a, b in zip(got, want):
                assert a[0] == b[0] and a[2:] == b[2:] and (a[1] is None) == (b[1] is None) and (a[1] is None or abs(a[1] - b[1]) < 1e-9), (hops, last, a, b)


def test_tail_index_opens_the_days_that_forecasts_need(spark, tmp_path):
    """Dense and sparse series, one whose measure was known long ago only, and one shorter than the tail."""
    from gaugeline.plans import forecast, tail
    rng = random.Random(5)
    data = []
    for k, hops, known in (("dense", 1, 0.9), ("sparse", 31, 0.5), ("old", 5, 0.0), (None, 2, 0.7)):
        data += [(k, START + dt.timedelta(hours=h), rng.random() if rng.random() < known else None, 1.0 * h) for h in range(0, 24 * 30, hops)]
    data += [("old", START + dt.timedelta(hours=1), 5.0, 0.0), ("short", START, 1.0, 1.0), ("short", START + dt.timedelta(hours=9), None, 2.0)]
    bins = spark.createDataFrame(data, "station_id string, hour timestamp, x double, y double")
    bins.withColumn("day", F.to_date("hour")).write.partitionBy("day").parquet(str(tmp_path / "t"))
    stored, path = spark.read.parquet(str(tmp_path / "t")), str(tmp_path / "index")
    tail.store_index(stored.filter("hour < '2024-01-20'"), path, "a", ["station_id"], "hour", ["x", "y"])
    tail.store_index(stored.filter("hour >= '2024-01-20'"), path, "b", ["station_id"], "hour", ["x", "y"])
    days = tail.tail_days(tail.load(spark, path), ["station_id"], ["x", "y"])
    found = tail.read_tail(stored, days, ["station_id"])
    assert found.select("day").distinct().count() < 12 and found.filter("station_id = 'dense'").select("day").distinct().count() <= 5
    for measures in (["x", "y"],):
        ends = [series.dense_series(t, ["station_id"], "hour", measures, last=72).drop("step") for t in (found.drop("day"), bins)]
        assert rows(ends[0]) == rows(ends[1])
    assert tail.read_tail(stored, days.limit(0), ["station_id"]).count() == 0


def test_rows_without_a_time_are_dealt_to_many_blocks(spark):
    from gaugeline.operators import blocks as B
    rng = random.Random(6)
    data = [("s", None if rng.random() < 0.9 else START + dt.timedelta(hours=i), rng.choice([None, None, float(i)]), i * 997) for i in range(20_000)]
    df = spark.createDataFrame(data, "k string, t timestamp, x double, n long").repartition(7)
    for tie in (["n"], []):
        sizes = [r["count"] for r in B.with_block(df, ["k"], "t", "28 days", tie).filter("t IS NULL").groupBy(B.BLOCK).count().collect()]
        assert len(sizes) > 50 and max(sizes) < 3 * sorted(sizes)[len(sizes) // 2]
    filled = series.forward_fill(df, ["k"], "t", ["x"], ["n"])
    plain = df.withColumn("x", F.expr("last(x, true) OVER (PARTITION BY k ORDER BY t, n ROWS UNBOUNDED PRECEDING)"))
    assert rows(filled) == rows(plain)
    data.sort(key=lambda r: (r[1] is not None, r[1] or START, r[3]))
    known = [i for i, r in enumerate(data) if r[2] is not None]
    place = {r[3]: i for i, r in enumerate(data)}
    for r in series.interpolate(df, ["k"], "t", ["x"], ["n"]).filter("n % 13 = 0").collect():
        i = place[r.n]
        low, high = max((k for k in known if k <= i), default=None), min((k for k in known if k >= i), default=None)
        a, b = data[low if low is not None else high][2], data[high if high is not None else low][2]
        want = a if low in (None, high) or high is None else a + (b - a) * (i - low) / (high - low)
        assert abs(r.x - want) < 1e-6
