import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.operators import scale
from tests.frames import SPARSE, close, hour, sparse_series

KEY = ["station_id"]


@pytest.mark.parametrize("keys", [(), ("station_id",)])
def test_properties(spark, keys):
    df = spark.createDataFrame(sparse_series(1), SPARSE)
    by = list(keys) or [F.lit(1)]
    scaled = scale.standardize(df, ["x"], keys, "hour", "1 day")
    assert scaled.columns == df.columns and scaled.count() == df.count()
    for r in scaled.groupBy(*by).agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).collect():
        assert abs(r["m"]) < 1e-9 and close(r["s"], 1.0)
    spread = scale.normalize(df, ["x"], keys, "hour", "1 day")
    for r in spread.groupBy(*by).agg(F.min("x").alias("lo"), F.max("x").alias("hi")).collect():
        assert (r["lo"], r["hi"]) == (0.0, 1.0)
    assert scaled.filter("x IS NULL").count() == df.filter("x IS NULL").count()


def test_constant_column_becomes_zero(spark):
    df = spark.createDataFrame([("S", hour(h), 5.0, None) for h in range(5)], SPARSE)
    for keys in ((), KEY):
        for change in (scale.normalize, scale.standardize):
            assert [r["x"] for r in change(df, ["x"], keys, "hour").collect()] == [0.0] * 5


@pytest.mark.parametrize("keys", [(), ("station_id",)])
def test_anomalies_use_the_sample_deviation(spark, keys):
    values = [10.0] * 20 + [11.0] * 20 + [30.0, None]
    df = spark.createDataFrame([("S", hour(h), v, None) for h, v in enumerate(values)], SPARSE)
    known = np.array(values[:-1])
    want = abs(known - known.mean()) > 3.0 * known.std(ddof=1)
    flags = {r["hour"]: r["is_anomaly"] for r in scale.flag_anomalies(df, "x", 3.0, keys, "hour", "6 hours").collect()}
    assert [flags[hour(h)] for h in range(len(values))] == [*want.tolist(), False]


def test_one_row_is_no_anomaly(spark):
    df = spark.createDataFrame([("S", hour(0), 5.0, None)], SPARSE)
    for keys in ((), KEY):
        assert scale.flag_anomalies(df, "x", 0.0, keys, "hour").first()["is_anomaly"] is False
