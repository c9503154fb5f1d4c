"""What the queries that run a stream write for it."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from gaugeline.catalog import QUERIES, streams
from gaugeline.sources import testdata
from gaugeline.streaming import identity

SF = f"{'/root/testdata'}/sf0.001"


@pytest.fixture
def kept(monkeypatch, tmp_path):
    """The folder of a query's run."""
    monkeypatch.setattr(streams, "run_folder", lambda spark, name: str(tmp_path / name))
    return tmp_path


def sizes(path):
    return [os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.startswith("part-")]


def test_the_source_of_ingest_is_packed(spark, kept):
    """A line is some 400 bytes as text; the files are at least one for each core and micro-batch."""
    found = QUERIES["st1_ingest"](spark, SF)
    lines = testdata.load(spark, SF, "lineitem").count()
    assert found.agg(F.sum("good") + F.sum("dead")).first()[0] == 3 * lines
    assert sum(sizes(kept / "ingest/in")) < 150 * lines
    assert len(sizes(kept / "ingest/in")) == streams.BATCHES * spark.sparkContext.defaultParallelism


def test_lines_are_dealt_before_they_become_batches(spark):
    """The shuffle carries six plain columns, and the batches are the same."""
    dealt, plain = testdata.station_batches(spark, SF, parts=3), testdata.station_batches(spark, SF)
    below = dealt._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")
    assert len(below) == 2 and "array(" in below[0] and "array(" not in below[1]
    assert dealt.exceptAll(plain).count() == 0 and dealt.count() == plain.count()


def events(spark, path, files):
    """Events of ten days, 20 minutes apart, in so many files."""
    start, kinds = dt.datetime(2024, 1, 1), ("view", "click", "purchase", "signup", "error")
    rows = [(i, start + dt.timedelta(minutes=20 * i), i % 7, kinds[i % 5], i % 50 * 3.0, f'{{"k": {i % 9}}}') for i in range(720)]
    frame = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    frame.repartition(files, "event_id").write.parquet(f"{path}/events.parquet")
    return rows


def test_all_tasks_write_a_file_and_a_batch_takes_it_whole(spark, kept):
    """Several tasks write each of the five files, and there are five batches."""
    rows = events(spark, kept / "sf", 3)
    fates = {r.fate: (r.n, r.places) for r in QUERIES["st1_dedupe"](spark, str(kept / "sf")).collect()}
    cut = [r[0] for r in rows if r[0] % 29 == 0]
    undated = [r[0] for r in rows if r[0] % 29 and r[0] % 31 == 0]
    dated = [r[0] for r in rows if r[0] % 29 and r[0] % 31]
    count = {"malformed": sum(1 + (i % 11 == 0) for i in cut), "no time": sum(1 + (i % 11 == 0) for i in undated),
             "read once": len(dated), "repeat": sum(i % 11 == 0 for i in dated)}
    assert fates == {fate: (n, n) for fate, n in count.items()}
    assert [len(sizes(kept / f"once/in/{n}")) for n in range(5)] == [3] * 5
    assert {r.batch_id for r in spark.read.parquet(str(kept / "once/dead")).select("batch_id").distinct().collect()} == set(range(5))


@pytest.mark.parametrize("name", ["st2_late_hours", "st4_live_warnings"])
def test_batches_do_not_depend_on_the_files_of_a_table(spark, tmp_path, monkeypatch, name):
    found = []
    for files in (1, 4):
        monkeypatch.setattr(streams, "run_folder", lambda _, run, n=files: str(tmp_path / f"{run}{n}"))
        events(spark, tmp_path / f"sf{files}", files)
        found.append(sorted(str(r) for r in QUERIES[name](spark, str(tmp_path / f"sf{files}")).collect()))
    assert found[0] and found[0] == found[1]
    folder = "late4" if name == "st2_late_hours" else "warnings4"
    assert min(len(sizes(tmp_path / f"{folder}/in/{n}")) for n in range(5)) > 1


def test_rows_are_numbered_where_they_are(spark):
    """All rows of a micro-batch are of a few pieces of files, so a shuffle by piece would be a few tasks."""
    rows = spark.range(100).select(F.lit("f").alias("source_file"), (F.col("id") % 2).alias("source_block"), F.col("id").alias("source_row"))
    numbered = identity.number_rows(rows.filter("source_row > 50"), rows)
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan
    assert numbered.filter("source_row < 50").count() == 0 and numbered.agg(F.max("source_row")).first()[0] == 98
