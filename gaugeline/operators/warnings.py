"""Warnings: create, generate from forecasts, fan out, cancel, list.

The log and the cancellations are append-only tables. The current state is
derived when read, so a cancellation may even arrive before its warning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import constants as C
from gaugeline.functions import (
    add_hours,
    as_moment,
    code_label,
    compact_time,
)
from gaugeline.sources import dims

REQUIRED = ("warning_type", "warning_level", "title", "content")
COLUMNS = ("id", "warning_type", "warning_level", "title", "content", "affected_location",
           "publish_time", "expire_time", "status")


def warning_id(publish: Column, expire: Column, kind: Column, level: Column, title: Column, content: Column,
               location: Column) -> Column:
    """``WARN-<time>-<hash>-<location>``; the same warning gets the same id on every run.

    The hash takes in everything a warning says, each part behind its length (``-`` for NULL) and times to the
    microsecond, so different warnings have different texts to hash.
    """
    parts = [F.unix_micros(publish), F.unix_micros(expire), kind, level, title, content, location]
    said = [F.concat(F.length(text).cast("string"), F.lit(":"), text) for text in (part.cast("string") for part in parts)]
    digest = F.md5(F.concat(*[F.coalesce(text, F.lit("-")) for text in said]))
    return F.concat_ws("-", F.lit("WARN"), compact_time(publish), digest, location)


def create_warnings(requests: DataFrame, as_of=None, hours: int = C.WARNING_HOURS,
                    unknown: str = "unknown area") -> DataFrame:
    """Warnings published at ``as_of`` (a moment or a column) that last ``hours``.

    ``requests`` has the required fields and ``affected_location``; an empty or
    missing location becomes ``unknown``.
    """
    publish = as_moment(as_of)
    place = F.coalesce(F.nullif(F.trim("affected_location"), F.lit("")), F.lit(unknown))
    return (requests.withColumn("affected_location", place).withColumn("publish_time", publish)
            .withColumns({"expire_time": add_hours(F.col("publish_time"), hours), "status": F.lit(1)})
            .withColumn("id", warning_id(*[F.col(c) for c in (
                "publish_time", "expire_time", "warning_type", "warning_level", "title", "content", "affected_location")]))
            .select(*COLUMNS))


def flood_requests(forecasts: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Title and text of each forecast whose given ``risk_level`` is above 0.

    ``forecasts`` has ``risk_level``, ``station_name``, ``max_predicted_water_level``
    and ``location_id``; a missing location falls back to the station name.
    """
    # The four texts of the package are a bounded side; a caller's own carry no hint.
    texts = F.broadcast(dims.flood_texts(forecasts.sparkSession)) if texts is None else texts
    other_title, other_text = C.FLOOD_TEXT_OTHER
    name = F.coalesce("station_name", F.lit("unknown station"))
    level = F.coalesce("max_predicted_water_level", F.lit(0.0)).cast("string")
    risky = forecasts.filter(F.col("risk_level") > 0).join(texts, "risk_level", "left")
    return risky.withColumns({
        "title": F.replace(F.coalesce("title_format", F.lit(other_title)), F.lit("%s"), name),
        "content": F.concat(*_filled(
            F.coalesce("content_format", F.lit(other_text)), name, level)),
        "warning_type": F.lit(1), "warning_level": F.col("risk_level"),
        "affected_location": F.coalesce("location_id", name)}).drop("title_format", "content_format")


def _filled(pattern: Column, name: Column, level: Column) -> list[Column]:
    """The parts of a two-slot pattern with the slots filled."""
    parts = F.split(pattern, "%s")
    return [parts[0], name, parts[1], level, parts[2]]


def generate_flood_warnings(forecasts: DataFrame, as_of=None, texts: DataFrame | None = None) -> DataFrame:
    return create_warnings(flood_requests(forecasts, texts), as_of)


def fan_out(warnings: DataFrame, channels: Sequence[str] = tuple(C.CHANNELS),
            success: Column | None = None) -> DataFrame:
    """One delivery row per warning and channel."""
    each = F.explode(F.array(*[F.lit(c) for c in channels]))
    done = F.lit(True) if success is None else success
    return (warnings.select(F.col("id").alias("warning_id"), "title", "warning_level",
                            "affected_location", each.alias("channel"))
            .withColumn("success", done))


def delivery_results(warnings: DataFrame, channels: Sequence[str] = tuple(C.CHANNELS),
                     success: Column | None = None) -> DataFrame:
    """Per warning, the list of channels and outcomes; built in place, without a shuffle."""
    done = F.lit(True) if success is None else success
    sent = F.array(*[F.struct(F.lit(c).alias("channel"), done.alias("success")) for c in channels])
    return warnings.select(F.col("id").alias("warning_id"), sent.alias("sent_results"))


def current_state(log: DataFrame, cancels: DataFrame) -> DataFrame:
    """The log with ``status`` 0 for cancelled warnings. ``cancels`` has ``id``."""
    gone = cancels.select("id").distinct().withColumn("_cancelled", F.lit(True))
    return (log.join(gone, "id", "left")
            .withColumn("status", F.when(F.col("_cancelled"), F.lit(0)).otherwise(F.col("status")))
            .select(*log.columns))


def cancel_outcomes(log: DataFrame, cancels: DataFrame) -> DataFrame:
    """Per cancellation, whether its warning exists (``found``)."""
    known = log.select("id").distinct().withColumn("_known", F.lit(True))
    return (cancels.join(known, "id", "left")
            .withColumn("found", F.coalesce("_known", F.lit(False))).drop("_known"))


def active_warnings(log: DataFrame, cancels: DataFrame, as_of=None) -> DataFrame:
    """Warnings in force: not cancelled and expiring strictly after ``as_of``.

    The expiry is tested on the log itself, so old partitions are skipped before
    the cancellations are joined; each cancelled id drops out in an anti join.
    """
    now = as_moment(as_of)
    return (log.filter((F.col("status") == 1) & (F.col("expire_time") > now))
            .join(cancels.select("id"), "id", "left_anti"))


def display_list(active: DataFrame) -> DataFrame:
    """Active warnings with the label of their level."""
    names = [(number, name) for number, name, _, _ in C.WARNING_THRESHOLDS]
    return active.withColumn("level_name", code_label(F.col("warning_level"), names, "unknown")).select(
        "id", "level_name", "title", "content", "affected_location", "publish_time", "expire_time")
