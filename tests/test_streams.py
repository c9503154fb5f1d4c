"""Streaming results equal the batch results over the same files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from gaugeline import constants as C
from gaugeline.operators import kpis, reshape, warnings
from gaugeline.sources import readings, testdata
from gaugeline.streaming import jobs

SF = f"{'/root/testdata'}/sf0.001"
AS_OF = testdata.AS_OF
ONCE = {"availableNow": True}
READING = ("station_id string, data_type string, ts timestamp, value double, ph double, turbidity double, "
           "dissolved_oxygen double, error string, event_id long")


def write_in_order(spark, df, path, parts):
    """Files in event-time order, as a file source takes them by modification time."""
    rows = df.orderBy("ts").toPandas()
    size = -(-len(rows) // parts)
    for i in range(parts):
        name = f"{path}/part-{i:03d}.parquet"
        os.makedirs(path, exist_ok=True)
        rows.iloc[i * size:(i + 1) * size].to_parquet(name, index=False, coerce_timestamps="us", allow_truncated_timestamps=True)
        os.utime(name, (1_700_000_000 + i, 1_700_000_000 + i))


@pytest.fixture(scope="module")
def reading(spark):
    return testdata.reading(spark, SF)


@pytest.fixture(scope="module")
def reading_files(spark, reading, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("readings"))
    write_in_order(spark, reading, path, 5)
    return path


def stream(spark, path, schema=READING):
    times = schema.replace("timestamp", "timestamp_ntz")
    raw = spark.readStream.schema(times).option("maxFilesPerTrigger", 1).parquet(path)
    return raw.withColumns({f.name: F.col(f.name).cast("timestamp") for f in raw.schema
                            if f.dataType.simpleString() == "timestamp_ntz"})


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted([tuple(r) for r in picked.collect()], key=str)


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def test_ingest_equals_batch(spark, tmp_path):
    source, good, dead = (str(tmp_path / n) for n in ("in", "good", "dead"))
    batches = testdata.station_batches(spark, SF)
    batches.repartition(3).write.json(source)
    finish(jobs.ingest(readings.stream_batches(spark, source, max_files=1), good, dead, "1996-06-01 00:00:00",
                       trigger=ONCE, name="ingest_test"))
    verdicts = jobs.judged(reshape.flatten(batches), "1996-06-01 00:00:00")
    kept, lost = spark.read.parquet(good), spark.read.parquet(dead)
    assert kept.select("batch_id").distinct().count() == 3
    assert rows(kept.drop("batch_id")) == rows(jobs.good_rows(verdicts))
    assert rows(lost.drop("batch_id", "malformed")) == rows(jobs.dead_rows(verdicts))
    assert kept.count() + lost.count() == 3 * batches.count()


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    df = spark.range(10)
    for _ in range(2):
        jobs.write_batch(df, str(tmp_path / "t"), 3)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 10


def test_repeats_are_dropped(spark, reading, tmp_path):
    path = str(tmp_path / "in")
    write_in_order(spark, reading.unionByName(reading), path, 3)
    deduped = jobs.drop_repeats(stream(spark, path), "2 days")
    finish(deduped.writeStream.format("parquet").option("path", str(tmp_path / "out"))
           .option("checkpointLocation", str(tmp_path / "cp")).trigger(**ONCE).start())
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == reading.count()


def test_old_readings_are_no_late_ones(spark, tmp_path):
    """Readings far behind the newest event stay, one of each key."""
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    shape = "station_id string, data_type string, ts timestamp, value double"
    start = dt.datetime(2024, 1, 10)
    for number, days in enumerate([(0, 40), (-90, 40), (-90, 1), (41,)]):
        batch = spark.createDataFrame([("S1", "rainfall", start + dt.timedelta(days=d), 1.0) for d in days], shape)
        write_in_order(spark, batch, f"{path}/{number}", 1)
        os.utime(f"{path}/{number}/part-000.parquet", (1_700_000_000 + number, 1_700_000_000 + number))
    deduped = jobs.drop_repeats(stream(spark, f"{path}/*", shape), "2 days")
    assert deduped.columns == ["station_id", "data_type", "ts", "value"]
    finish(deduped.writeStream.format("parquet").option("path", out)
           .option("checkpointLocation", str(tmp_path / "cp")).trigger(**ONCE).start())
    got = [x[0] for x in rows(spark.read.parquet(out), "ts")]
    assert sorted(got) == [start + dt.timedelta(days=d) for d in (-90, 0, 1, 40, 41)]


def test_hourly_means_equal_batch(spark, reading, reading_files, tmp_path):
    out = str(tmp_path / "hourly")
    finish(jobs.store_hourly(stream(spark, reading_files), out, trigger=ONCE, name="hourly_test"))
    emitted = spark.read.parquet(out)
    closed = reading.agg(F.max("ts")).first()[0] - dt.timedelta(days=9)
    assert emitted.filter(F.col("hour") < closed).count() > 0
    columns = ["station_id", "hour", "n_readings", *[F.round(m, 6) for m in C.FEATURES]]
    want = testdata.hour_wide(reading).filter(F.col("hour") < closed)
    assert rows(emitted.filter(F.col("hour") < closed), *columns) == rows(want, *columns)


def test_latest_equals_batch(spark, reading, reading_files, tmp_path):
    out = str(tmp_path / "latest")
    finish(jobs.store_latest(stream(spark, reading_files), out, trigger=ONCE, name="latest_test"))
    got = rows(jobs.read_latest(spark, out), "station_id", "data_type", "ts", "value")
    assert got == rows(kpis.latest_readings(reading), "station_id", "data_type", "ts", "value")


def test_latest_is_compacted(spark, reading, reading_files, tmp_path):
    """Snapshots replace old batches, and a batch that runs again changes nothing."""
    out = str(tmp_path / "latest")
    finish(jobs.store_latest(stream(spark, reading_files), out, trigger=ONCE, name="compact_test", compact_every=2))
    assert sorted(d for d in os.listdir(out) if not d.startswith(".")) == ["_snapshots", "batch_id=3", "batch_id=4"]
    assert sorted(d for d in os.listdir(f"{out}/_snapshots") if not d.startswith(".")) == ["upto=2", "upto=4"]
    want = rows(kpis.latest_readings(reading), "station_id", "data_type", "ts", "value")
    assert rows(jobs.read_latest(spark, out), "station_id", "data_type", "ts", "value") == want
    jobs.compact_latest(spark, out, 4)
    jobs.compact_latest(spark, out, 5)
    assert rows(jobs.read_latest(spark, out), "station_id", "data_type", "ts", "value") == want


def test_a_batch_reads_no_old_day_of_the_log(spark, tmp_path):
    path, start = str(tmp_path / "log"), dt.datetime(2024, 1, 10)
    log = spark.createDataFrame([(f"w{i}", 1, 1, "t", "c", "S1", start, start + dt.timedelta(days=i), 1, (start + dt.timedelta(days=i)).date(), 0)
                                 for i in range(5)], jobs.LOG_SCHEMA)
    jobs.warning_log(spark, path).write(log, 0)
    recent = jobs.read_log(spark, path, "2024-01-13")
    assert {f.split("day=")[1][:10] for f in recent.inputFiles()} == {"2024-01-13", "2024-01-14"}
    assert rows(recent, "id", "day") == [("w3", dt.date(2024, 1, 13)), ("w4", dt.date(2024, 1, 14))]
    assert jobs.read_log(spark, path, "2025-01-01").count() == 0


LEVELS = "station_id string, station_name string, ts timestamp, water_level double"


def test_live_warnings(spark, tmp_path):
    source, log, cancels = (str(tmp_path / n) for n in ("in", "log", "cancel"))
    day = dt.datetime(2024, 1, 10)

    def feed(number, *levels):
        df = spark.createDataFrame([(s, f"name {s}", day + dt.timedelta(hours=h), x) for s, h, x in levels], LEVELS)
        os.makedirs(source, exist_ok=True)
        write_in_order(spark, df, f"{source}/{number}", 1)

    def run():
        finish(jobs.live_warnings(stream(spark, f"{source}/*", LEVELS), log, cancels, trigger=ONCE, name="warnings_test"))
        return rows(jobs.warning_log(spark, log).read(), "affected_location", "warning_level", "publish_time")

    feed(0, ("S1", 0, 16.0), ("S1", 1, 17.0), ("S2", 0, 3.0))
    first = run()
    assert first == [("S1", 1, day + dt.timedelta(hours=1))]
    feed(1, ("S1", 2, 16.5), ("S2", 2, 31.0))
    second = run()
    assert [x for x in second if x not in first] == [("S2", 4, day + dt.timedelta(hours=2))]
    table = jobs.warning_log(spark, log).read()
    jobs.cancel(table.filter("affected_location = 'S1'"), cancels, 1, day + dt.timedelta(hours=3))
    feed(2, ("S1", 4, 16.0), ("S2", 4, 32.0))
    third = run()
    assert [x for x in third if x not in second] == [("S1", 1, day + dt.timedelta(hours=4))]
    feed(3, ("S1", 27, 16.0), ("S2", 27, 32.0))
    fourth = run()
    assert [x for x in fourth if x not in third] == [("S2", 4, day + dt.timedelta(hours=27))]
    active = warnings.active_warnings(jobs.warning_log(spark, log).read(), jobs.read_cancels(spark, cancels), day + dt.timedelta(hours=27))
    assert rows(active, "affected_location", "warning_level") == [("S1", 1), ("S2", 4)]


def test_a_repeated_warning_batch_raises_once(spark, tmp_path):
    table = jobs.warning_log(spark, str(tmp_path / "log"))
    levels = spark.createDataFrame([("S1", "n", dt.datetime(2024, 1, 10), 22.0)], LEVELS)
    none = spark.createDataFrame([], jobs.CANCEL_SCHEMA)
    for _ in range(2):
        fresh = jobs.raised(levels, table.read(before=5), none, F.lit(dt.datetime(2024, 1, 10)).cast("timestamp"))
        table.write(fresh.withColumn("day", F.to_date("publish_time")), 5)
    assert table.read().count() == 1


def test_checkpoints_need_a_shared_folder(spark):
    from gaugeline.session import shared_folder
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_malformed_lines_reach_the_dead_letters(spark, tmp_path):
    source, good, dead = (str(tmp_path / n) for n in ("in", "good", "dead"))
    lines = ['{"station_id": "S1", "readings": [{"data_type": "water_level", "value": 5.0, "timestamp": "2024-01-01T00:00:00"}]}',
             '{"station_id": "S1", "readings": [{"data_ty', "no json at all"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(source)
    finish(jobs.ingest(readings.stream_batches(spark, source), good, dead, "2024-01-02 00:00:00", trigger=ONCE, name="malformed_test"))
    kept, lost = spark.read.parquet(good), spark.read.parquet(dead)
    assert (kept.count(), lost.count()) == (1, 2)
    assert {r.malformed for r in lost.collect()} == set(lines[1:])


def _raise(spark, tmp_path, name, days, **options):
    source, log, cancels = (str(tmp_path / n) for n in ("in", "log", "cancel"))
    df = spark.createDataFrame([("S1", "n", d, 16.0) for d in days], LEVELS)
    os.makedirs(source, exist_ok=True)
    write_in_order(spark, df, f"{source}/{name}", 1)
    finish(jobs.live_warnings(stream(spark, f"{source}/*", LEVELS), log, cancels, trigger=ONCE, name="future_test", **options))
    return rows(jobs.warning_log(spark, log).read(), "publish_time")


def test_an_event_of_the_future_silences_nothing(spark, tmp_path):
    start = dt.datetime(2024, 1, 10)
    assert _raise(spark, tmp_path, 0, [dt.datetime(2099, 1, 1)]) == []
    assert _raise(spark, tmp_path, 1, [start, dt.datetime(2098, 1, 1)]) == [(start,)]
    later = start + dt.timedelta(days=2)
    assert _raise(spark, tmp_path, 2, [later]) == [(start,), (later,)]


def test_a_long_warning_is_seen_while_it_is_in_force(spark):
    start = dt.datetime(2024, 1, 10)
    log = spark.createDataFrame([("w", 1, 1, "t", "c", "S1", start, start + dt.timedelta(days=6), 1, (start + dt.timedelta(days=6)).date(), 0)],
                                jobs.LOG_SCHEMA)
    none = spark.createDataFrame([], jobs.CANCEL_SCHEMA)
    for days, expected in ((5, 0), (7, 1)):
        now = F.lit(start + dt.timedelta(days=days)).cast("timestamp")
        levels = spark.createDataFrame([("S1", "n", start, 16.0)], LEVELS)
        assert jobs.raised(levels, log.filter(F.col("day") >= F.to_date(now)), none, now).count() == expected


READING_LINES = ['{"station_id": "S1", "readings": [{"data_type": "water_level", "value": 5.0, "timestamp": "2024-01-01T00:00:00"}]}',
                 "no json at all", "no json at all", '{"station_id": "S1", "readings": [{"data_ty',
                 '{"station_id": "S1", "readings": [{"data_type": "water_level", "value": 5.0, "timestamp": "at noon"}, '
                 '{"data_type": "water_level", "value": 5.0, "timestamp": "at noon"}]}',
                 '{"station_id": "S1", "readings": [{"data_type": "water_level", "value": 5.0, "timestamp": "2024-01-01T00:00:00"}]}']


def write_lines(path, number, lines):
    os.makedirs(path, exist_ok=True)
    name = f"{path}/{number}.json"
    with open(name, "w") as out:
        out.write("\n".join(lines) + "\n")
    os.utime(name, (1_700_000_000 + number, 1_700_000_000 + number))


def test_rows_without_a_key_are_no_repeats(spark, tmp_path):
    """Three malformed lines and two readings with a bad time are five dead letters with ``dedupe`` too."""
    source, good, dead = (str(tmp_path / n) for n in ("in", "good", "dead"))
    write_lines(source, 0, READING_LINES)
    finish(jobs.ingest(readings.stream_batches(spark, source), good, dead, "2024-01-02 00:00:00", dedupe="1 hour", trigger=ONCE, name="keyless_test"))
    assert (spark.read.parquet(good).count(), spark.read.parquet(dead).count()) == (1, 5)


def test_every_row_has_one_fate_however_late_it_is_repeated(spark, tmp_path):
    source, good, dead, seen = (str(tmp_path / n) for n in ("in", "good", "dead", "seen"))
    write_lines(source, 0, READING_LINES)
    write_lines(source, 1, READING_LINES[:2])
    write_lines(source, 2, ['{"station_id": "S1", "readings": [{"data_type": "water_level", "value": 6.0, "timestamp": "2024-01-01T01:00:00"}]}'])
    write_lines(source, 3, READING_LINES[:1] * 3)
    for run in range(2):
        finish(jobs.ingest_once(readings.stream_batches(spark, source, max_files=1), good, dead, seen, "2024-01-02 00:00:00", trigger=ONCE,
                                checkpoint=str(tmp_path / f"cp{run}"), name="once_test", merge_every=2))
        kept, lost = spark.read.parquet(good), spark.read.parquet(dead)
        assert rows(kept, "water_level") == [(5.0,), (6.0,)]
        assert lost.count() == 6 and lost.select("source_file", "source_block", "source_row").distinct().count() == 6
        assert rows(lost.filter("batch_id = 0"), "source_row") == [(1,), (2,), (3,), (4,), (5,)]
        assert spark.read.parquet(f"{seen}/repeats").agg(F.sum("repeats")).first()[0] == 5  # the second run replaced the first one's


def test_repeats_are_looked_up_on_their_days_only(spark, tmp_path):
    from gaugeline.streaming import identity
    from gaugeline.streaming.daylog import DayLog
    log = DayLog(spark, str(tmp_path), identity.SEEN_SCHEMA)
    start = dt.datetime(2024, 1, 1)
    for n in range(6):
        keys = spark.createDataFrame([("S1", "rainfall", start + dt.timedelta(days=d, hours=n)) for d in range(3)], identity.SEEN_SCHEMA)
        log.write(keys.withColumn("day", F.to_date("ts")), n)
    assert log.read(["2024-01-02"], 4).count() == 4
    assert {f.split("day=")[1][:10] for f in log.read(["2024-01-02"]).inputFiles()} == {"2024-01-02"}
    log.merge(4, 3)
    assert log.read().count() == 18 and log.read(["2024-01-02"], 3).count() == 3 and log.read(before=4).count() == 12
    assert len(log.read(["2024-01-03"], 4).inputFiles()) < 4
    log.merge(6, 2)
    assert log.read().count() == 18 and log.read(["2024-01-01"], 6).count() == 6
    assert log.read(["2030-01-01"]).count() == 0 and log.days_from("2024-01-02") == ["2024-01-02", "2024-01-03"]


def hours_of(spark, tmp_path, batches, merge_every=100, clock=None):
    from gaugeline.streaming import hours
    source, path, late = (str(tmp_path / n) for n in ("in", "hours", "late"))
    for number, batch in enumerate(batches):
        frame = spark.createDataFrame([("S1", kind, t, value) for kind, t, value in batch], "station_id string, data_type string, ts timestamp, value double")
        write_in_order(spark, frame, f"{source}/{number}", 1)
        os.utime(f"{source}/{number}/part-000.parquet", (1_700_000_000 + number, 1_700_000_000 + number))
    shape = "station_id string, data_type string, ts timestamp, value double"
    finish(hours.store_hours(stream(spark, f"{source}/*", shape), path, late, trigger=ONCE, name="hours_test", merge_every=merge_every, clock=clock))
    return hours.read_hours(spark, path), spark.read.parquet(late)


def test_a_late_row_corrects_its_hour_or_is_a_dead_letter(spark, tmp_path):
    day, h = dt.datetime(2024, 1, 20), dt.timedelta(hours=1)
    level, rain = "water_level", "rainfall"
    found, late = hours_of(spark, tmp_path, [
        [(level, day, 1.0), (level, day + h / 2, 2.0), (rain, day, 5.0)],
        [(level, day + 24 * h, 3.0), (level, None, 9.0)],
        [(level, day + h / 4, 6.0), (level, day - 192 * h, 7.0), (level, dt.datetime(2099, 1, 1), 8.0), (rain, day, None)],
        [(level, day + 240 * h, 4.0)],
        [(level, day + 24 * h, 5.0), (level, day + 48 * h, 5.0)]], 2, "2024-02-10 00:00:00")
    assert rows(found, "hour", level, rain, "n_readings", "closed") == [
        (day, 3.0, 5.0, 5, True), (day + 24 * h, 3.0, None, 1, True), (day + 48 * h, 5.0, None, 1, False), (day + 240 * h, 4.0, None, 1, False)]
    assert rows(late, "problem", "value") == [("FUTURE", 8.0), ("LATE", 5.0), ("LATE", 7.0), ("NO_TIME", 9.0)]


def test_a_batch_of_hours_that_runs_again_counts_once(spark, tmp_path):
    from gaugeline.streaming import hours
    path, late = str(tmp_path / "hours"), str(tmp_path / "late")
    start = dt.datetime(2024, 1, 1)
    for number, days in ((0, 0), (1, 10), (1, 10), (0, 0), (2, 1)):
        micro = spark.createDataFrame([("S1", "rainfall", start + dt.timedelta(days=days), 2.0)], "station_id string, data_type string, ts timestamp, value double")
        hours.store_batch(micro, number, path, late, "8 days", "1H", None)
    assert rows(hours.read_hours(spark, path), "hour", "rainfall", "n_readings") == [(start, 2.0, 1), (start + dt.timedelta(days=10), 2.0, 1)]
    assert spark.read.parquet(late).count() == 1


def test_a_batch_opens_no_old_cancellation(spark, tmp_path):
    path, day = str(tmp_path / "cancels"), dt.datetime(2024, 1, 10)
    logs = [spark.createDataFrame([(2, 1, "t", "c", "S1")], "warning_type int, warning_level int, title string, content string, affected_location string")
            .transform(warnings.create_warnings, day + dt.timedelta(days=d)) for d in range(4)]
    for number, log in enumerate(logs):
        jobs.cancel(log, path, number, day)
    jobs.cancel(spark.createDataFrame([("no warning",)], "id string"), path, 9, day)
    needed = jobs.read_cancels(spark, path, logs[2].unionByName(logs[3]))
    assert {f.split("day=")[1][:10] for f in needed.inputFiles()} == {"2024-01-12", "2024-01-13"} and needed.count() == 2
    assert jobs.read_cancels(spark, path).count() == 5


def test_a_cancellation_before_its_warning(spark, tmp_path):
    """Batches are merged meanwhile, and the cancelled warning leaves the way free for the next one."""
    source, log, cancels = (str(tmp_path / n) for n in ("in", "log", "cancel"))
    day = dt.datetime(2024, 1, 10)
    levels = spark.createDataFrame([("S1", "name S1", day, 16.0)], LEVELS)
    coming = jobs.raised(levels, jobs.warning_log(spark, log).read(), jobs.read_cancels(spark, cancels), F.lit(day))
    jobs.cancel(coming, cancels, 0, day)
    for number, hour in enumerate((0, 1, 2, 30, 31)):
        frame = spark.createDataFrame([("S1", "name S1", day + dt.timedelta(hours=hour), 16.0)], LEVELS)
        write_in_order(spark, frame, f"{source}/{number}", 1)
        os.utime(f"{source}/{number}/part-000.parquet", (1_700_000_000 + number, 1_700_000_000 + number))
    finish(jobs.live_warnings(stream(spark, f"{source}/*", LEVELS), log, cancels, trigger=ONCE, name="cancel_test", merge_every=2))
    made = jobs.warning_log(spark, log).read()
    assert [x[0] for x in rows(made, "publish_time")] == [day + dt.timedelta(hours=h) for h in (0, 1, 30)]
    assert rows(warnings.active_warnings(made, jobs.read_cancels(spark, cancels, made), day + dt.timedelta(hours=3)), "publish_time") == [
        (day + dt.timedelta(hours=1),), (day + dt.timedelta(hours=30),)]
