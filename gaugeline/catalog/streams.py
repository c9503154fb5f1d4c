"""Queries that run a streaming job over a whole table to its end and read its sink."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeline.catalog.base import MEASURES, Tables, qr, qrs, query, rs, sql_grade
from gaugeline.catalog.records import LEVEL_BAD, RAIN_BAD
from gaugeline.catalog.warning_log import SQL_ID, flood_text
from gaugeline.operators import risk, warnings
from gaugeline.session import run_folder
from gaugeline.sources import readings, testdata
from gaugeline.streaming import hours, jobs

ALL = {"availableNow": True}
#: Packed at the least cost: JSON repeats its names in every reading.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
#: Micro-batches that the files of a source are dealt to, at least.
BATCHES = 4


class Run:
    """Folders of one run, below the shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, run_folder(spark, name)
        self.name = self.root.rsplit("/", 1)[-1]

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def options(self) -> dict:
        return {"checkpoint": self.path("checkpoint"), "trigger": ALL, "name": self.name}

    @property
    def parts(self) -> int:
        """Files of a source: a micro-batch has one for each core at least, as packed text is not split."""
        return max(BATCHES * self.spark.sparkContext.defaultParallelism, int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    def files(self, rows: DataFrame, kind: str, **options) -> tuple[str, int]:
        """``rows`` of so many ``parts`` as files of a source, and how many of them a micro-batch takes."""
        rows.write.format(kind).options(**options).save(self.path("in"))
        return self.path("in"), self.parts // BATCHES

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


STORED = """(SELECT station_id AS location_id, ts AS timestamp, 3 AS sensors, l_quantity AS water_level,
  CASE WHEN NOT failed THEN l_discount * 1000 END AS rainfall, NULL::DOUBLE AS temperature FROM station_batch) s"""
INGEST_TIME = "1996-06-01 00:00:00"


@query("st1_ingest", f"""
WITH flags AS (SELECT location_id, timestamp > TIMESTAMP '{INGEST_TIME}'
    OR timestamp <= TIMESTAMP '{INGEST_TIME}' - INTERVAL 8 DAY AS bad_time,
    {LEVEL_BAD} AS bad_level, {RAIN_BAD} AS bad_rain FROM {STORED})
SELECT location_id,
       SUM((CASE WHEN bad_time OR bad_level THEN 0 ELSE 1 END) + (CASE WHEN bad_time OR bad_rain THEN 0 ELSE 1 END)
         + (CASE WHEN bad_time THEN 0 ELSE 1 END))::BIGINT AS good,
       SUM((CASE WHEN bad_time OR bad_level THEN 1 ELSE 0 END) + (CASE WHEN bad_time OR bad_rain THEN 1 ELSE 0 END)
         + (CASE WHEN bad_time THEN 1 ELSE 0 END))::BIGINT AS dead FROM flags GROUP BY 1""", "station_batch")
def st1(spark, sf):
    """From JSON files, in several micro-batches."""
    run = Run(spark, "ingest")
    source, per = run.files(testdata.station_batches(spark, sf, parts=run.parts), "json", **PACKED)
    batches = readings.stream_batches(spark, source, max_files=per)
    jobs.ingest(batches, run.path("good"), run.path("dead"), INGEST_TIME, **run.options()).awaitTermination()
    both = run.read("good").select("location_id", F.lit(1).alias("good")).unionByName(
        run.read("dead").select("location_id", F.lit(0).alias("good")))
    return both.groupBy("location_id").agg(
        F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("dead"))


#: Five files of lines: every reading once, in the order of its time but for the last file, which has a seventh of them and a repeat of
#: every eleventh; one reading in 29 is cut off, one in 31 has no time.
LINE_FATE = """CASE WHEN event_id % 29 = 0 THEN 'malformed' WHEN event_id % 31 = 0 THEN 'no time' ELSE 'dated' END"""


def submitted_lines(t: Tables) -> DataFrame:
    """Readings as lines of JSON batches, with the ``file`` each line is in."""
    rows = t.reading.withColumn("fate", F.expr(LINE_FATE))
    ends = rows.select(F.struct(F.min("ts").alias("lo"), F.max("ts").alias("hi")).alias("s")).scalar()
    lo, hi = F.unix_micros(ends["lo"]), F.unix_micros(ends["hi"])
    slot = F.least(F.lit(3), F.floor(4 * (F.unix_micros("ts") - lo) / F.greatest(hi - lo, F.lit(1)))).cast("int")
    first = F.when(F.col("event_id") % 7 == 0, 4).otherwise(slot)
    files = F.when(F.col("event_id") % 11 == 0, F.array(first, F.lit(4))).otherwise(F.array(first))
    time = F.when(F.col("fate") == "no time", F.lit("at noon")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    line = F.to_json(F.struct("station_id", F.array(F.struct("data_type", "value", time.alias("timestamp"))).alias("readings")))
    # What is cut off is equal in all lines of a station, so only their places tell them apart.
    cut = F.when(F.col("fate") == "malformed", F.concat(F.lit("{"), F.col("station_id"))).otherwise(line)
    return rows.select(cut.alias("value"), F.explode(files).alias("file"))


def feed(run: Run, rows: DataFrame, files: int, kind: str, start: Callable[[], StreamingQuery]) -> None:
    """Each file's rows to a folder of its own, and ``start`` the stream, which goes on where it ended, to take them before the next is written.

    So a micro-batch is one file, however many tasks write it; the source has to take all parts at once.
    """
    for number in range(files):
        part = rows.filter(F.col("file") == number).drop("file")
        part.write.format(kind).save(run.path(f"in/{number}"))
        start().awaitTermination()


#: One reading in 11 of those that are dated came twice; both are of one file where the first one is in the last file.
@query("st1_dedupe", f"""
WITH line AS (SELECT *, {LINE_FATE} AS fate, CASE WHEN event_id % 11 = 0 THEN 2 ELSE 1 END AS copies FROM reading),
dated AS (SELECT station_id, data_type, ts, SUM(copies) AS copies FROM line WHERE fate = 'dated' GROUP BY 1, 2, 3),
fates AS (SELECT 'read once' AS fate, COUNT(*)::BIGINT AS n FROM dated
  UNION ALL SELECT 'repeat', SUM(copies - 1)::BIGINT FROM dated
  UNION ALL SELECT fate, SUM(copies)::BIGINT FROM line WHERE fate <> 'dated' GROUP BY 1)
SELECT fate, n, n AS places FROM fates""", "reading")
def st1_dedupe(spark, sf):
    """Every line has one fate: equal malformed lines and readings without a time are dead letters each, a repeat in a later batch is counted."""
    run, t = Run(spark, "once"), Tables(spark, sf)

    def start():
        batches = readings.stream_batches(spark, run.path("in/*"), max_files=None)
        return jobs.ingest_once(batches, run.path("good"), run.path("dead"), run.path("seen"), INGEST_TIME, merge_every=2, **run.options())

    feed(run, submitted_lines(t), 5, "text", start)
    dead = run.read("dead")
    fate = F.when(F.col("malformed").isNotNull(), "malformed").when(F.col("timestamp").isNull(), "no time").otherwise("read once")
    places = F.struct("source_file", "source_block", "source_row")
    lost = dead.groupBy(fate.alias("fate")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(places).alias("places"))
    kept = run.read("good").agg(F.lit("read once").alias("fate"), F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("places"))
    again = run.read("seen/repeats").agg(F.lit("repeat").alias("fate"), F.sum("repeats").alias("n"), F.sum("repeats").alias("places"))
    return lost.unionByName(kept).unionByName(again).groupBy("fate").agg(F.sum("n").alias("n"), F.sum("places").alias("places"))


#: Readings in five files: four in the order of time, and one with a fifth of all, from any time.
TIMED = """timed AS (SELECT *, CASE WHEN event_id % 5 = 3 THEN 4
    ELSE LEAST(3, floor(4 * (epoch_us(ts) - MIN(epoch_us(ts)) OVER ()) / GREATEST(MAX(epoch_us(ts)) OVER () - MIN(epoch_us(ts)) OVER (), 1)::DOUBLE)) END AS file
  FROM reading),
fated AS (SELECT *, CASE WHEN file = 4 AND ts < (SELECT MAX(ts) FROM timed WHERE file < 4) - INTERVAL 8 DAY THEN 'LATE' ELSE 'hour' END AS fate FROM timed)"""


def timed_files(t: Tables) -> DataFrame:
    rows = t.reading
    ends = rows.select(F.struct(F.min("ts").alias("lo"), F.max("ts").alias("hi")).alias("s")).scalar()
    lo, hi = F.unix_micros(ends["lo"]), F.unix_micros(ends["hi"])
    slot = F.least(F.lit(3), F.floor(4 * (F.unix_micros("ts") - lo) / F.greatest(hi - lo, F.lit(1))))
    return rows.withColumn("file", F.when(F.col("event_id") % 5 == 3, 4).otherwise(slot))


@query("st2_late_hours", f"""
WITH {TIMED}
SELECT fate, station_id, date_trunc('hour', ts) AS hour, """ + ", ".join(
    qr(f"AVG(CASE WHEN data_type = '{m}' AND fate = 'hour' THEN value END)", m) for m in MEASURES) + f""", COUNT(*) AS n_readings,
       fate = 'hour' AND date_trunc('hour', ts) + INTERVAL 1 HOUR + INTERVAL 8 DAY <= (SELECT MAX(ts) FROM fated WHERE fate = 'hour') AS closed
FROM fated GROUP BY 1, 2, 3""", "reading")
def st2_late(spark, sf):
    """Five batches; the last one corrects hours that were written before, and what is behind the delay is a dead letter."""
    run, rows = Run(spark, "late"), timed_files(Tables(spark, sf))

    def start():
        stream = spark.readStream.schema(rows.drop("file").schema).parquet(run.path("in/*"))
        return hours.store_hours(stream, run.path("hours"), run.path("dead"), merge_every=2, clock="2100-01-01 00:00:00", **run.options())

    feed(run, rows, 5, "parquet", start)
    means = hours.read_hours(spark, run.path("hours")).select(F.lit("hour").alias("fate"), "station_id", "hour", *rs(MEASURES), "n_readings", "closed")
    dead = run.read("dead").groupBy(F.col("problem").alias("fate"), "station_id", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("n_readings")).withColumn("closed", F.lit(False))
    return means.unionByName(dead, allowMissingColumns=True)


@query("st2_hourly_means", f"""
SELECT station_id, hour, {qrs(MEASURES)}, n_readings FROM hour_wide
WHERE hour + INTERVAL 1 HOUR <= (SELECT MAX(ts) - INTERVAL 8 DAY FROM reading)""", "hour_wide")
def st2(spark, sf):
    """Hours the watermark has closed; the others stay in the state."""
    run = Run(spark, "hourly")
    stream = testdata.reading(spark, sf, stream=True)
    jobs.store_hourly(stream, run.path("hourly"), **run.options()).awaitTermination()
    return run.read("hourly").select("station_id", "hour", *rs(MEASURES), "n_readings")


NEWEST = ", ".join(f"{c} DESC NULLS LAST" for c in ("ts", "value", "ph", "turbidity", "dissolved_oxygen", "error"))


@query("st3_latest", f"""
SELECT station_id, data_type, ts, value, ph, turbidity, dissolved_oxygen, error FROM reading
QUALIFY ROW_NUMBER() OVER (PARTITION BY station_id, data_type ORDER BY {NEWEST}) = 1""", "reading")
def st3(spark, sf):
    """In several micro-batches, with a snapshot after each."""
    run, rows = Run(spark, "latest"), testdata.reading(spark, sf)
    source, per = run.files(rows.repartition(run.parts, "event_id"), "parquet")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", per).parquet(source)
    jobs.store_latest(stream, run.path("latest"), compact_every=1, **run.options()).awaitTermination()
    return jobs.read_latest(spark, run.path("latest"))


#: Levels in five files by time; "now" of a batch is the newest of its events that is not after the clock.
CLOCK = "2024-01-24 00:00:00"


@query("st4_live_warnings", f"""
WITH level AS (SELECT station_id, ts, value, {sql_grade('value')} AS grade, CAST(LEAST(4, floor(5 * (epoch_us(ts) - MIN(epoch_us(ts)) OVER ())
      / GREATEST(MAX(epoch_us(ts)) OVER () - MIN(epoch_us(ts)) OVER (), 1)::DOUBLE)) AS INTEGER) AS file
    FROM reading WHERE data_type = 'water_level' AND value IS NOT NULL),
past AS (SELECT *, MAX(ts) OVER (PARTITION BY file) AS now FROM level WHERE ts <= TIMESTAMP '{CLOCK}'),
peak AS (SELECT file, now, station_id, grade, MAX(value) AS value FROM past WHERE grade > 0 GROUP BY ALL),
said AS (SELECT file, 1 AS warning_type, grade AS warning_level, replace({flood_text(1, 'grade')}, '%s', station_id) AS title,
      replace(regexp_replace({flood_text(2, 'grade')}, '%s', station_id), '%s', CAST(value AS VARCHAR)) AS content, station_id AS affected_location,
      now AS publish_time, now + INTERVAL 24 HOUR AS expire_time, 1 AS status FROM peak),
request AS (SELECT *, {SQL_ID} AS id FROM said),
gone AS (SELECT id FROM request WHERE warning_level = 2),
raised AS (SELECT * FROM request r WHERE NOT EXISTS (SELECT 1 FROM request o WHERE o.affected_location = r.affected_location
    AND o.warning_level = r.warning_level AND o.file < r.file AND o.expire_time > r.publish_time AND o.id NOT IN (SELECT id FROM gone)))
SELECT id, warning_type, warning_level, title, content, affected_location, publish_time, expire_time, id NOT IN (SELECT id FROM gone) AS stands FROM raised""",
       "reading")
def st4(spark, sf):
    """Five batches with events after the clock, and cancellations, some before their warnings, of all of level 2."""
    run, t = Run(spark, "warnings"), Tables(spark, sf)
    levels = t.reading.filter("data_type = 'water_level' AND value IS NOT NULL").selectExpr(
        "station_id", "station_id AS station_name", "ts", "value AS water_level")
    ends = levels.select(F.struct(F.min("ts").alias("lo"), F.max("ts").alias("hi")).alias("s")).scalar()
    lo, hi = F.unix_micros(ends["lo"]), F.unix_micros(ends["hi"])
    slot = F.least(F.lit(4), F.floor(5 * (F.unix_micros("ts") - lo) / F.greatest(hi - lo, F.lit(1))))
    rows = levels.withColumn("file", slot)
    # The warnings that will be: the ids follow from what they say.
    past = rows.filter(F.col("ts") <= F.lit(CLOCK).cast("timestamp"))
    nows = past.groupBy("file").agg(F.max("ts").alias("now"))
    peaks = risk.with_grade(past.join(nows, "file"), "water_level").filter("risk_level = 2").groupBy(
        F.col("station_id").alias("location_id"), "station_name", "risk_level", "now").agg(F.max("water_level").alias("max_predicted_water_level"))
    jobs.cancel(warnings.generate_flood_warnings(peaks, F.col("now")), run.path("cancels"), 0, CLOCK)

    def start():
        stream = spark.readStream.schema(levels.schema).parquet(run.path("in/*"))
        return jobs.live_warnings(stream, run.path("log"), run.path("cancels"), clock=CLOCK, merge_every=2, **run.options())

    feed(run, rows, 5, "parquet", start)
    log = jobs.warning_log(spark, run.path("log")).read()
    state = warnings.current_state(log, jobs.read_cancels(spark, run.path("cancels"), log))
    return state.select("id", "warning_type", "warning_level", "title", "content", "affected_location", "publish_time", "expire_time",
                        (F.col("status") == 1).alias("stands"))
