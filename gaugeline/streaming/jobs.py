"""Streaming jobs. Sinks of ``foreachBatch`` are keyed by batch id, so a batch
that runs again replaces its own output. Checkpoints live in the shared folder
named by ``spark.checkpoint.dir`` unless a path is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeline import constants as C
from gaugeline.functions import as_moment
from gaugeline.operators import reshape, risk, validate, warnings
from gaugeline.schemas import SOURCE
from gaugeline.session import folder_numbers, remove_folder, shared_folder
from gaugeline.streaming import identity
from gaugeline.streaming.daylog import BATCH, DayLog

DEDUPE_KEYS = identity.KEYS
ARRIVED, ROW = "_arrived", "_row"


def _start(stream: DataFrame, spark: SparkSession, name: str, checkpoint: str | None, mode: str,
           trigger: dict | None):
    return (stream.writeStream.outputMode(mode).queryName(name)
            .option("checkpointLocation", checkpoint or shared_folder(spark, f"streams/{name}"))
            .trigger(**(trigger or {"processingTime": "1 minute"})))


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write the output of one micro-batch; a re-run replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def drop_repeats(readings: DataFrame, delay: str) -> DataFrame:
    """One reading per station, type and time among those that arrive within ``delay`` of the first.

    The watermark runs on the time of arrival, so a reading is never too late, however old it
    is; keys leave the state ``delay`` after they arrived. Rows without a whole key repeat nothing: each has a name of its own.
    """
    own = F.when(~identity.has_key(), F.uuid())
    return (readings.withColumns({ARRIVED: F.current_timestamp(), ROW: own}).withWatermark(ARRIVED, delay)
            .dropDuplicatesWithinWatermark([*DEDUPE_KEYS, ROW]).drop(ARRIVED, ROW))


def judged(readings: DataFrame, as_of=None) -> DataFrame:
    """Storage records with their verdict and the required fields they lack."""
    records = reshape.storage_records(readings)
    return validate.missing_fields(validate.validate(records, "timestamp", as_of),
                                   ["location_id", "timestamp"])


def good_rows(verdicts: DataFrame) -> DataFrame:
    return validate.keep_valid(verdicts.filter(F.size("missing") == 0)).drop("missing", "malformed")


def dead_rows(verdicts: DataFrame) -> DataFrame:
    """Everything that :func:`good_rows` leaves out."""
    passed = (F.size("missing") == 0) & F.col("is_valid") & (F.col("quality_score") >= C.MIN_QUALITY)
    return verdicts.filter(~passed)


def ingest_once(batches: DataFrame, good_path: str, dead_path: str, seen_path: str, as_of=None, checkpoint: str | None = None,
                trigger: dict | None = None, name: str = "ingest_once", merge_every: int = 100) -> StreamingQuery:
    """As :func:`ingest`, of a file source, with each reading once however late it is repeated.

    Every row has a fate: it is good, a dead letter, or a repeat counted under ``seen_path``. The keys seen so far are a table by day,
    of which a batch reads the days it has readings of; no state is held in memory and none expires. Dead letters
    carry file, piece and number of their source row, so two lines that are equally malformed stay two. A batch that runs again
    finds the same keys seen and replaces its own output.
    """
    source = list(SOURCE[:2])
    readings = reshape.flatten(identity.with_source(batches), source)

    def store(micro: DataFrame, batch_id: int) -> None:
        session = micro.sparkSession
        seen = DayLog(session, f"{seen_path}/keys", identity.SEEN_SCHEMA)
        placed = identity.place_rows(micro).persist()
        try:
            keys = identity.judge_keys(placed, seen, batch_id).persist()  # all outputs follow from it, and it takes two shuffles
            fresh, keyless, repeats = identity.split_repeats(placed, keys)
            verdicts = judged(fresh.unionByName(keyless), as_of)
            write_batch(good_rows(verdicts).drop(*SOURCE), good_path, batch_id)
            write_batch(identity.number_rows(dead_rows(verdicts), placed), dead_path, batch_id)
            write_batch(repeats, f"{seen_path}/repeats", batch_id)
            seen.write(fresh.select(*identity.KEYS, F.to_date("ts").alias("day")), batch_id)
            keys.unpersist()
            if batch_id and batch_id % merge_every == 0:
                seen.merge(batch_id, merge_every)
        finally:
            placed.unpersist()

    return _start(readings, batches.sparkSession, name, checkpoint, "append", trigger).foreachBatch(store).start()


def ingest(batches: DataFrame, good_path: str, dead_path: str, as_of=None, dedupe: str | None = None,
           checkpoint: str | None = None, trigger: dict | None = None,
           name: str = "ingest") -> StreamingQuery:
    """Flatten and validate station batches; good rows and dead letters to two tables."""
    readings = reshape.flatten(batches)
    if dedupe:
        readings = drop_repeats(readings, dedupe)

    def store(micro: DataFrame, batch_id: int) -> None:
        verdicts = judged(micro, as_of).persist()
        try:
            write_batch(good_rows(verdicts), good_path, batch_id)
            write_batch(dead_rows(verdicts), dead_path, batch_id)
        finally:
            verdicts.unpersist()

    return _start(readings, batches.sparkSession, name, checkpoint, "append", trigger
                  ).foreachBatch(store).start()


def hourly_means(readings: DataFrame, watermark: str = C.EXPIRY, interval: str = C.SAMPLING) -> DataFrame:
    """Hourly mean per station and measure; a closed hour is emitted once."""
    def mean(kind):
        return F.avg(F.when(F.col("data_type") == kind, F.col("value"))).alias(kind)

    return (readings.withWatermark("ts", watermark)
            .groupBy("station_id", F.window("ts", interval))
            .agg(*[mean(kind) for kind in C.FEATURES], F.count(F.lit(1)).alias("n_readings"))
            .select("station_id", F.col("window.start").alias("hour"), *C.FEATURES, "n_readings"))


def store_hourly(readings: DataFrame, path: str, watermark: str = C.EXPIRY,
                 checkpoint: str | None = None, trigger: dict | None = None,
                 name: str = "hourly") -> StreamingQuery:
    return (_start(hourly_means(readings, watermark), readings.sparkSession, name, checkpoint,
                   "append", trigger).format("parquet").option("path", path).start())


def latest(readings: DataFrame) -> DataFrame:
    """Newest reading per station and type; state is one row each."""
    # Equal times are ordered by the values, so a re-run finds the same row.
    newest = F.max(F.struct("ts", "value", "ph", "turbidity", "dissolved_oxygen", "error"))
    return (readings.groupBy("station_id", "data_type").agg(newest.alias("r"))
            .select("station_id", "data_type", "r.*"))


def store_latest(readings: DataFrame, path: str, checkpoint: str | None = None,
                 trigger: dict | None = None, name: str = "latest", compact_every: int = 100) -> StreamingQuery:
    """Changed rows per micro-batch, joined to one snapshot every ``compact_every`` batches;
    :func:`read_latest` gives the view."""
    def store(micro: DataFrame, batch_id: int) -> None:
        write_batch(micro, path, batch_id)
        if batch_id and batch_id % compact_every == 0:
            compact_latest(micro.sparkSession, path, batch_id)

    return _start(latest(readings), readings.sparkSession, name, checkpoint, "update", trigger
                  ).foreachBatch(store).start()


#: Hidden from readers of the table's folder, as its name starts with an underscore.
SNAPSHOTS = "_snapshots"


def _newest(spark: SparkSession, path: str, snapshot: int | None) -> DataFrame:
    """One row per station and type, with its batch, of a snapshot and the batches after it."""
    after = [n for n in folder_numbers(spark, f"{path}/{BATCH}=*") if snapshot is None or n > snapshot]
    parts = [spark.read.parquet(f"{path}/{SNAPSHOTS}/upto={snapshot}")] if snapshot is not None else []
    if after or not parts:
        folders = [f"{path}/{BATCH}={n}" for n in after] or [path]
        parts.append(spark.read.option("basePath", path).parquet(*folders).withColumn(BATCH, F.col(BATCH).cast("long")))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    columns = [c for c in rows.columns if c not in ("station_id", "data_type")]
    return (rows.groupBy("station_id", "data_type").agg(F.max_by(F.struct(*columns), BATCH).alias("r"))
            .select("station_id", "data_type", "r.*"))


def compact_latest(spark: SparkSession, path: str, upto: int) -> None:
    """Write the view after batch ``upto`` as a snapshot.

    Batches and snapshots that the snapshot before it replaced are removed; those that this one replaces stay
    for readers that have listed them. A batch that runs again finds its snapshot done.
    """
    done = folder_numbers(spark, f"{path}/{SNAPSHOTS}/upto=*/_SUCCESS")
    if upto in done:
        return
    before = max((n for n in done if n < upto), default=None)
    _newest(spark, path, before).write.mode("overwrite").parquet(f"{path}/{SNAPSHOTS}/upto={upto}")
    if before is not None:
        for n in folder_numbers(spark, f"{path}/{BATCH}=*"):
            if n <= before:
                remove_folder(spark, f"{path}/{BATCH}={n}")
        for n in done:
            if n < before:
                remove_folder(spark, f"{path}/{SNAPSHOTS}/upto={n}")


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The last snapshot with the batches after it, however long the stream has run."""
    done = folder_numbers(spark, f"{path}/{SNAPSHOTS}/upto=*/_SUCCESS")
    return _newest(spark, path, done[-1] if done else None).drop(BATCH)


LOG_SCHEMA = ("id string, warning_type int, warning_level int, title string, content string, "
              "affected_location string, publish_time timestamp, expire_time timestamp, status int, "
              f"day date, {BATCH} bigint")
CANCEL_SCHEMA = f"id string, cancelled_at timestamp, day date, {BATCH} bigint"


def warning_log(spark: SparkSession, path: str) -> DayLog:
    """The warnings by the day of their expiry."""
    return DayLog(spark, path, LOG_SCHEMA.split(", day date")[0])


def cancel_log(spark: SparkSession, path: str) -> DayLog:
    """The cancellations by the day on which their warning was published, or will be; its id says so."""
    return DayLog(spark, path, CANCEL_SCHEMA.split(", day date")[0])


def read_log(spark: SparkSession, path: str, day: str, before: int | None = None) -> DataFrame:
    """Warnings that expire on ``day`` (as text) or later; folders of earlier days are not opened."""
    log = warning_log(spark, path)
    return log.read(log.days_from(day), before)


def raised(micro: DataFrame, log: DataFrame, cancels: DataFrame, now: Column) -> DataFrame:
    """New warnings of a micro-batch: one per station and grade without a warning in force.

    ``micro`` has ``station_id``, ``station_name`` and ``water_level``.
    """
    graded = risk.with_grade(micro, "water_level").filter("risk_level > 0")
    peaks = graded.groupBy(F.col("station_id").alias("location_id"), "risk_level").agg(
        F.max("water_level").alias("max_predicted_water_level"),
        F.max("station_name").alias("station_name"))
    in_force = warnings.active_warnings(log.filter(F.col("publish_time") <= now), cancels, now).select(
        F.col("affected_location").alias("location_id"), F.col("warning_level").alias("risk_level"))
    fresh = peaks.join(in_force, ["location_id", "risk_level"], "left_anti")
    return warnings.generate_flood_warnings(fresh, now)


def live_warnings(levels: DataFrame, log_path: str, cancel_path: str, as_of=None,
                  checkpoint: str | None = None, trigger: dict | None = None,
                  name: str = "warnings", clock=None, merge_every: int = 100) -> StreamingQuery:
    """Raise warnings on level crossings into the append-only log.

    ``levels`` has ``station_id``, ``station_name``, ``ts`` and ``water_level``.
    Events after ``clock`` (the time of processing) are no evidence and are left out. "Now" is the newest
    of the others in the micro-batch, so a re-run raises the same warnings, reads no log row of its
    own batch, and replaces its own files. The log is partitioned by the day of expiry; a batch reads the days on
    which a warning can still be in force, however long warnings last, and of the cancellations those
    of the days on which these warnings were published. Days with ``merge_every`` batches are merged.
    """
    spark = levels.sparkSession

    def store(micro: DataFrame, batch_id: int) -> None:
        session = micro.sparkSession
        past = micro.filter(F.col("ts") <= as_moment(clock)).persist()
        try:
            day = F.max("ts") if as_of is None else as_moment(as_of)
            last = past.agg(F.max("ts").alias("ts"), F.to_date(day).cast("string").alias("day")).first()
            if last["ts"] is None:
                return
            now = as_moment(last["ts"] if as_of is None else as_of)
            log = read_log(session, log_path, last["day"], batch_id)
            fresh = raised(past, log, read_cancels(session, cancel_path, log), now)
            warning_log(session, log_path).write(fresh.withColumn("day", F.to_date("expire_time")), batch_id)
            if batch_id and batch_id % merge_every == 0:
                warning_log(session, log_path).merge(batch_id, merge_every)
        finally:
            past.unpersist()

    return _start(levels, spark, name, checkpoint, "append", trigger).foreachBatch(store).start()


def cancel(requests: DataFrame, cancel_path: str, request_batch: int, as_of=None) -> None:
    """Append cancellation requests (column ``id``); they may name warnings yet to come. A batch of requests that is written again replaces itself."""
    published = F.try_to_date(F.regexp_extract("id", r"^WARN-(\d{8})", 1), "yyyyMMdd")
    rows = requests.select("id", as_moment(as_of).alias("cancelled_at"), published.alias("day"))
    cancel_log(requests.sparkSession, cancel_path).write(rows, request_batch)


def read_cancels(spark: SparkSession, cancel_path: str, log: DataFrame | None = None) -> DataFrame:
    """Cancellations; with ``log`` those only that can name one of its warnings: of the days on which these were published."""
    days = None if log is None else [str(r.day) for r in log.select(F.to_date("publish_time").alias("day")).distinct().collect()]
    return cancel_log(spark, cancel_path).read(days)
