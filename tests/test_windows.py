import math

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import windows
from tests.frames import SPARSE, close, hour

KEY = ["station_id"]


def numbered(spark, sizes):
    rows = [(s, hour(2 * i), float(i), 100.0 * i) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, SPARSE)


@pytest.mark.parametrize("block,chunk", [("7 hours", 8), ("28 days", 2048)])
def test_windows_have_a_next_row(spark, block, chunk):
    sizes = {"a": 4, "b": 5, "c": 6, "d": 40}
    found = windows.sliding_windows(numbered(spark, sizes), KEY, "hour", ["x", "y"], 5, block=block, chunk=chunk)
    rows = found.collect()
    for station, n in sizes.items():
        own = sorted((r for r in rows if r["station_id"] == station), key=lambda r: r["window_id"])
        assert [r["window_id"] for r in own] == list(range(max(0, n - 5)))
        for r in own:
            assert r["window"] == [[float(i), 100.0 * i] for i in range(r["window_id"], r["window_id"] + 5)]
            assert r["window_start"] == hour(2 * r["window_id"])


@pytest.mark.parametrize("n,count", [(71, 0), (72, 0), (73, 1)])
def test_default_length(spark, n, count):
    assert windows.sliding_windows(numbered(spark, {"a": n}), KEY, "hour", ["x"]).count() == count


def test_labels_follow_the_window(spark):
    found = windows.sliding_windows(numbered(spark, {"a": 20}), KEY, "hour", ["x"], 4, "y", 3, block="9 hours", chunk=7)
    rows = sorted(found.collect(), key=lambda r: r["window_id"])
    assert len(rows) == 14
    for r in rows:
        start = r["window_id"] + 4
        assert r["label"] == [100.0 * i for i in range(start, start + 3)]


def test_null_values_keep_their_place(spark):
    rows = [("a", hour(h), None if h % 2 else float(h), None) for h in range(6)]
    r = windows.sliding_windows(spark.createDataFrame(rows, SPARSE), KEY, "hour", ["x"], 4).orderBy("window_id").first()
    assert r["window"] == [[0.0], [None], [2.0], [None]]


def test_chunk_must_hold_the_overlap(spark):
    with pytest.raises(ValueError):
        windows.sliding_windows(numbered(spark, {"a": 9}), KEY, "hour", ["x"], 5, chunk=4)


def test_last_rows_and_history_scaling(spark):
    recent = windows.last_rows(numbered(spark, {"a": 3, "b": 10}), KEY, "hour", 5)
    assert sorted((r["station_id"], r["pos"], r["x"], r["n_rows"]) for r in recent.collect()) == [
        ("a", 1, 0.0, 3), ("a", 2, 1.0, 3), ("a", 3, 2.0, 3),
        *[("b", i + 1, float(i + 5), 5) for i in range(5)]]
    scaled = windows.scale_history(recent, KEY, ["x"])
    back = scaled.groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("s"),
        F.first("mean_x").alias("m"), F.first("std_x").alias("d")).withColumn(
        "x", windows.unscale(F.transform("s", lambda s: s["x"]), F.col("m"), F.col("d")))
    for r in back.collect():
        start = 0 if r["station_id"] == "a" else 5
        assert all(close(v, start + i) for i, v in enumerate(r["x"]))


def test_attention_weights_sum_to_one(spark):
    steps = numbered(spark, {"a": 3, "b": 6}).withColumn("energy", F.col("x") * 200)
    weighted, context = windows.attention_pool(steps, KEY, "energy", ["x", "y"])
    for r in context.collect():
        assert close(r["total_weight"], 1.0)
    assert weighted.filter("weight < 0 OR weight > 1").count() == 0
    small = numbered(spark, {"a": 3}).withColumn("energy", F.col("x"))
    r = windows.attention_pool(small, KEY, "energy", ["y"])[1].first()
    weights = [math.exp(i) for i in range(3)]
    want = sum(w * 100 * i for i, w in enumerate(weights)) / sum(weights)
    assert close(r["context_y"], want)
    arrays = windows.sliding_windows(numbered(spark, {"a": 4}), KEY, "hour", ["x", "y"], 3).withColumn(
        "context", windows.pool_window(F.col("window"), F.transform("window", lambda x: x[0])))
    assert close(arrays.first()["context"][1], want)


def test_horizon_errors_equal_a_scan(spark):
    values = [float((i * 7) % 11) for i in range(30)]
    rows = [("a", hour(i), v, None) for i, v in enumerate(values)]
    got = windows.horizon_errors(spark.createDataFrame(rows, SPARSE), KEY, "hour", "x", 3, 5, block="8 hours", chunk=9)
    rows = {r["hour_ahead"]: (r["n"], r["mse"]) for r in got.collect()}
    for h in (1, 2, 3):
        errors = [(values[s + h - 1] - values[s + 5 + h - 1]) ** 2 for s in range(30 - 5 - 3 + 1)]
        assert rows[h][0] == len(errors) and close(rows[h][1], sum(errors) / len(errors))


def test_a_hole_in_the_position_is_an_error(spark):
    import pytest
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F

    from gaugeline.operators import windows
    rows = spark.range(40).select(F.lit("a").alias("k"), F.timestamp_seconds(F.col("id") * 3600).alias("t"), F.col("id").alias("p"), F.rand(1).alias("x"))
    for chunk in (8, 64):
        whole = windows.sliding_windows(rows, ["k"], "t", ["x"], 4, position="p", chunk=chunk)
        assert whole.count() == 36
        holed = rows.filter("p <> 17")
        assert windows.sliding_windows(holed, ["k"], "t", ["x"], 4, chunk=chunk).count() == 35
        with pytest.raises(PySparkException, match="p has holes"):
            windows.sliding_windows(holed, ["k"], "t", ["x"], 4, position="p", chunk=chunk).collect()


def test_holes_and_repeats_anywhere_are_errors(spark):
    """A hole behind the last row of a piece, one as long as pieces, a number twice, and one of two series."""
    import pytest
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F

    from gaugeline.operators import windows

    def frame(positions, series="a"):
        return spark.createDataFrame([(series, p, 1.0) for p in positions], "k string, p long, x double").withColumn("t", F.timestamp_seconds("p"))

    def found(rows, chunk=256):
        return windows.sliding_windows(rows, ["k"], "t", ["x"], 72, position="p", chunk=chunk)

    assert found(frame(range(400))).count() == 328 and found(frame(range(7, 407))).count() == 328
    broken = [[*range(200), *range(1200, 1400)], [*range(256), *range(1256, 1400)], [*range(256), *range(512, 700)], [*range(256), *range(257, 400)],
              [*range(300), 299, *range(301, 400)], [*range(100), None, *range(100, 300)]]
    for positions in broken:
        for rows in (frame(positions), frame(positions).unionByName(frame(range(400), "b"))):
            with pytest.raises(PySparkException, match="p has holes"):
                found(rows).collect()
        with pytest.raises(PySparkException, match="p has holes"):
            windows.horizon_errors(frame(positions), ["k"], "t", "x", position="p", chunk=128).collect()
        with pytest.raises(PySparkException, match="p has holes"):
            windows.training_pairs(frame(positions), ["k"], "t", ["x"], "x", 5, position="p", chunk=128).collect()
