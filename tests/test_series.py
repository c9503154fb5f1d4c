import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugeline.functions import interval_seconds
from gaugeline.operators import series
from tests.frames import SPARSE, START, close, hour, sparse_series

KEY = ["station_id"]
XY = ["x", "y"]


@pytest.fixture(scope="module", params=["6 hours", "1 day", "28 days"])
def block(request):
    return request.param


def per_station(rows, change):
    """Result of ``change`` on each station's pandas frame, as {(station, hour): (x, y)}."""
    frame = pd.DataFrame(rows, columns=["station_id", "hour", *XY])
    out = {}
    for station, part in frame.sort_values("hour").groupby("station_id"):
        changed = change(part.set_index("hour")[XY].astype(float))
        for moment, row in changed.iterrows():
            out[station, moment.to_pydatetime()] = (row["x"], row["y"])
    return out


def assert_same(df, want):
    got = {(r["station_id"], r["hour"]): (r["x"], r["y"]) for r in df.collect()}
    assert got.keys() == want.keys()
    for key, values in got.items():
        for a, b in zip(values, want[key]):
            assert close(a, b), (key, a, b)


@pytest.mark.parametrize("seed", [1, 2])
def test_interpolate_equals_pandas(spark, block, seed):
    rows = sparse_series(seed)
    df = spark.createDataFrame(rows, SPARSE)
    want = per_station(rows, lambda p: p.reset_index(drop=True).interpolate(
        method="linear", limit_direction="both").set_index(p.index))
    assert_same(series.interpolate(df, KEY, "hour", XY, block=block), want)


def test_forward_fill_equals_pandas(spark, block):
    rows = sparse_series(3)
    df = spark.createDataFrame(rows, SPARSE)
    assert_same(series.forward_fill(df, KEY, "hour", XY, block=block), per_station(rows, lambda p: p.ffill()))
    assert_same(series.forward_fill(df, KEY, "hour", XY, ["x"], block), per_station(rows, lambda p: p.ffill()))


@pytest.mark.parametrize("interval", ["1H", "3h", "7h"])
def test_resample_equals_pandas(spark, block, interval):
    if interval_seconds(block) % interval_seconds(interval) and interval != "7h":
        pytest.skip("not used together")
    rows = sparse_series(4, keep=0.3)
    df = spark.createDataFrame(rows, SPARSE)
    want = per_station(rows, lambda p: p.resample(interval.lower()).mean().interpolate(method="linear"))
    got = series.resample(df, KEY, "hour", XY, interval, block=block)
    assert_same(got, want)
    for station in ("S0", "S1", "S2"):
        steps = sorted(r["step"] for r in got.filter(F.col("station_id") == station).collect())
        assert steps == list(range(len(steps)))


@pytest.mark.parametrize("last", [1, 5, 72, 1000])
def test_resample_tail_is_the_tail(spark, block, last):
    df = spark.createDataFrame(sparse_series(5, keep=0.1), SPARSE)
    full = series.resample(df, KEY, "hour", XY, block=block).collect()
    tail = series.resample(df, KEY, "hour", XY, last=last, block=block).collect()
    ends = {}
    for r in full:
        ends[r["station_id"]] = max(ends.get(r["station_id"], START), r["hour"])
    want = {(r["station_id"], r["hour"]): (r["x"], r["y"], r["step"]) for r in full
            if r["hour"] > ends[r["station_id"]] - dt.timedelta(hours=last)}
    got = {(r["station_id"], r["hour"]): (r["x"], r["y"], r["step"]) for r in tail}
    assert got == want


def test_long_silence_spans_blocks(spark):
    rows = [("S", hour(0), 0.0, None), ("S", hour(1000), 1000.0, 2.0)]
    got = series.resample(spark.createDataFrame(rows, SPARSE), KEY, "hour", XY, block="1 day").collect()
    assert len(got) == 1001
    assert all(close(r["x"], r["step"]) for r in got)
    assert sum(r["y"] is not None for r in got) == 1


def test_missing_flag(spark):
    rows = [("S", hour(0), 1.0, 3), ("S", hour(2), None, 1)]
    bins = spark.createDataFrame(rows, "station_id string, hour timestamp, x double, n_readings long")
    got = series.flag_missing(bins, KEY, "hour", ["x"]).orderBy("hour").collect()
    assert [(r["n_readings"], r["data_quality"]) for r in got] == [(3, 1), (None, 3), (1, 1)]


def test_methods_by_name(spark):
    df = spark.createDataFrame(sparse_series(6, hours=20), SPARSE)
    assert series.handle_missing(df, "other", KEY, "hour", XY) is df
    whole = series.handle_missing(df, "drop", KEY, "hour", XY)
    assert whole.count() == df.filter("x IS NOT NULL AND y IS NOT NULL").count()


def test_null_key_is_a_series_of_its_own(spark):
    rows = [(None, hour(0), 1.0, None), (None, hour(1), None, None), ("S", hour(1), None, None)]
    got = series.forward_fill(spark.createDataFrame(rows, SPARSE), KEY, "hour", XY, block="1 day")
    assert sorted((r["station_id"] or "", r["x"] or 0) for r in got.collect()) == [("", 1.0), ("", 1.0), ("S", 0)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rain_events_equal_a_scan(spark, block, seed):
    rows = sparse_series(seed, keep=0.9, known=0.9)
    got = series.rain_events(spark.createDataFrame(rows, SPARSE), KEY, "hour", "x", 8.0, block=block)
    want = []
    frame = pd.DataFrame(rows, columns=["station_id", "hour", *XY]).sort_values("hour")
    for station, part in frame[frame.x >= 8.0].groupby("station_id"):
        run = (part.hour.diff() != pd.Timedelta("1h")).cumsum()
        for _, event in part.groupby(run):
            want.append((station, event.hour.min().to_pydatetime(), event.hour.max().to_pydatetime(), len(event),
                         round(event.x.sum(), 6), event.x.max()))
    assert sorted((r["station_id"], r["start"], r["end"], r["hours"], round(r["total"], 6), r["peak"])
                  for r in got.collect()) == sorted(want)


def test_profile_of_a_sine(spark):
    import math
    rows = [("S", hour(h), 8 + 1.5 * math.sin(2 * math.pi * (h - 6) / 24), None) for h in range(240)]
    df = spark.createDataFrame(rows, SPARSE)
    assert close(series.daily_amplitude(df, KEY, "hour", "x").first()["amplitude"], 1.5)
    residuals = series.profile_residual(df, KEY, "hour", "x", "1 day")
    assert residuals.count() == 240
    assert residuals.agg(F.max(F.abs("residual"))).first()[0] < 1e-9


def test_recent_spine(spark):
    ends = spark.createDataFrame([("S", hour(100))], "station_id string, last timestamp")
    hours = [r["hour"] for r in series.recent_spine(ends, "last").orderBy("hour").collect()]
    assert hours == [hour(h) for h in range(29, 101)]


def test_intervals():
    assert [interval_seconds(i) for i in ("1H", "30min", "7 hours", "28 days", "d")] == [
        3600, 1800, 25200, 28 * 86400, 86400]
    for bad in ("", "0h", "1 fortnight", "h1"):
        with pytest.raises(ValueError):
            interval_seconds(bad)


def test_two_rows_of_a_bin_invent_no_row(spark):
    import datetime as dt

    from gaugeline.operators import series
    rows = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1.0), ("a", dt.datetime(2024, 1, 1), 2.0), ("a", dt.datetime(2024, 1, 1, 2), 3.0)],
                                 "k string, hour timestamp, x double")
    out = series.dense_series(rows, ["k"], "hour", ["x"]).collect()
    assert sorted(r.hour.hour for r in out) == [0, 0, 1, 2]
    assert all(r.hour >= dt.datetime(2024, 1, 1) for r in out)
