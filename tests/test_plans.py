"""Plans: no window in a single task, no Python in batch operators, pruned scans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gaugeline.operators import blocks, series

SF = "/root/testdata/sf0.001"
#: These fit a model or run a stream first.
JOBS = {"f2_fit_loss_history", "f4_linear_model", *(n for n in entry.queries() if n.startswith("st"))}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - JOBS))
def test_batch_plan(spark, name):
    lines = plan(entry.queries()[name](spark, SF)).splitlines()
    for at, line in enumerate(lines):
        assert "Python" not in line and "Pandas" not in line
        assert "CartesianProduct" not in line and "BroadcastNestedLoopJoin" not in line
        if "Exchange SinglePartition" in line:
            # A single partition is for merging partial aggregates only.
            assert "Window" not in "".join(lines[max(0, at - 3):at])
            assert "Aggregate" in lines[at + 1]


def test_scan_is_pruned_and_filtered(spark):
    text = plan(entry.queries()["a2_standardize_by_station"](spark, SF))
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in text
    from gaugeline.catalog.base import Tables
    from gaugeline.sources import readings
    events = Tables(spark, SF).raw("events")
    picked = readings.station_readings(events, "view", station=F.col("event_type")).select("value")
    assert "EqualTo(event_type,view)" in plan(picked)


def test_hot_station_is_spread_over_blocks(spark):
    """Windows over a series are partitioned by its blocks, not by the series alone."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("w7_forward_fill", "w8_interpolate", "w9_resample", "a2_standardize_by_station"):
            lines = plan(entry.queries()[name](spark, SF)).splitlines()
            top = next(i for i, line in enumerate(lines) if "Join" in line) + 1  # the rows, beside their summary
            edge = lines[top].index(":- ")
            rows = [lines[top]]
            for line in lines[top + 1:]:
                if line[edge] != ":":
                    break
                rows.append(line)
            exchanges = [line for line in rows if "hashpartitioning(" + blocks.SERIES in line]
            assert exchanges and all(f"{blocks.BLOCK}#" in line for line in exchanges)
            for line in rows:
                if line.strip(" :+-").startswith("Window"):
                    assert f"[{blocks.SERIES}#" in line and f", {blocks.BLOCK}#" in line
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_last_rows_are_ranked_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(entry.queries()["w4_last_rows"](spark, SF))
    assert "WindowGroupLimit" in plan(entry.queries()["f6_forecast_all"](spark, SF))


@pytest.mark.parametrize("name", ["w9_resample", "w8_interpolate_daily", "w2_training_pairs", "a2_standardize_by_station",
                                  "w1_sliding_windows", "w1_sliding_windows_daily", "a10_mse_by_hour_ahead"])
def test_source_is_read_once(spark, name):
    """Rows and their block summary share the scan and its exchange."""
    df = entry.queries()[name](spark, SF)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_a_long_gap_is_dealt_to_all_tasks(spark):
    """Two rows 20 years apart: no task makes more than its share of the hours between them."""
    rows = spark.sql("SELECT 'S1' AS k, timestamp'2000-01-01' + make_interval(0, 0, 0, 0, h) AS hour, double(h) AS x "
                     "FROM VALUES (0), (175320) AS t(h)")
    dense = series.dense_series(rows, ["k"], "hour", ["x"])
    sizes = [r["n"] for r in dense.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 175321 and len(sizes) > 1 and max(sizes) < 0.6 * sum(sizes)
    line = dense.agg(F.max(F.abs(F.col("x") - F.col("step"))).alias("off"), F.countDistinct("step").alias("n")).first()
    assert line["off"] < 1e-6 and line["n"] == 175321
    tail = series.dense_series(rows, ["k"], "hour", ["x"], last=72)
    assert sorted(r["step"] for r in tail.collect()) == list(range(175320 - 71, 175321))
