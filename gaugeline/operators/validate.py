"""Record rules: ranges, cross-field, time; issue lists and quality scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import constants as C
from gaugeline.functions import as_moment

#: Record fields whose range is checked; the other sensor ranges apply to long readings.
CHECKED_FIELDS = ("water_level", "rainfall", "temperature")


def out_of_range(value: Column, low, high) -> Column:
    return (value < low) | (value > high)


def check_ranges(readings: DataFrame, ranges: DataFrame) -> DataFrame:
    """Range check of typed values: adds ``issue`` (``UNKNOWN_TYPE``, ``RANGE`` or NULL) and ``in_range``.

    A NULL value was not measured, so its rule does not run.
    """
    bounds = ranges.select(F.col("data_type"), F.col("min").alias("_low"), F.col("max").alias("_high"),
                           F.lit(True).alias("_known"))
    joined = readings.join(bounds, "data_type", "left")
    issue = (F.when(F.col("_known").isNull(), "UNKNOWN_TYPE")
             .when(out_of_range(F.col("value"), F.col("_low"), F.col("_high")), "RANGE"))
    return (joined.withColumn("issue", issue).withColumn("in_range", F.col("issue").isNull())
            .select(*readings.columns, "issue", "in_range"))


def inconsistent(level: Column, rain: Column) -> Column:
    """Heavy rain with a low level; false when either was not measured."""
    return F.coalesce((rain > C.HEAVY_RAIN) & (level < C.LOW_LEVEL), F.lit(False))


def time_issue(moment: Column, as_of=None) -> Column:
    """``FUTURE``, ``EXPIRED`` or NULL."""
    now = as_moment(as_of)
    return (F.when(moment > now, "FUTURE")
            .when(moment <= now - F.expr(f"INTERVAL {C.EXPIRY}"), "EXPIRED"))


def validate(records: DataFrame, time_col: str = "timestamp", as_of=None) -> DataFrame:
    """Verdict per record: ``is_valid``, ``issues`` and ``quality_score``.

    Rules run for the fields the record has. Penalties add up in whole tenths.
    """
    def broken(name: str) -> Column:
        return F.coalesce(out_of_range(F.col(name), *C.RANGE_OF[name]), F.lit(False))

    def issue(code, field, value):
        return F.struct(F.lit(code).alias("code"), F.lit(field).alias("field"),
                        value.cast("string").alias("value"))

    rules = []
    for name in CHECKED_FIELDS:
        if name in records.columns:
            rules.append((broken(name), C.PENALTY_TENTHS[name], issue("RANGE", name, F.col(name))))
    if {"water_level", "rainfall"} <= set(records.columns):
        rules.append((inconsistent(F.col("water_level"), F.col("rainfall")), C.PENALTY_TENTHS["logical"],
                      issue("INCONSISTENT", "rainfall", F.col("rainfall"))))
    if time_col in records.columns:
        code = time_issue(F.col(time_col), as_of)
        rules.append((code.isNotNull(), C.PENALTY_TENTHS["timestamp"],
                      F.struct(code.alias("code"), F.lit(time_col).alias("field"),
                               F.col(time_col).cast("string").alias("value"))))
    if not rules:
        raise ValueError("no checked field among the columns")
    penalty = sum((F.when(hit, tenths).otherwise(0) for hit, tenths, _ in rules), F.lit(0))
    issues = F.array_compact(F.array(*[F.when(hit, entry) for hit, _, entry in rules]))
    return (records.withColumn("_penalty", penalty).withColumns({
        "is_valid": F.col("_penalty") == 0, "issues": issues,
        "quality_score": F.greatest(F.lit(0), 10 - F.col("_penalty")) / F.lit(10.0)})
        .drop("_penalty"))


def keep_valid(verdicts: DataFrame, min_score: float = C.MIN_QUALITY,
               require_valid: bool = True) -> DataFrame:
    """Records that pass, without the verdict columns."""
    passed = F.col("quality_score") >= min_score
    if require_valid:
        passed = passed & F.col("is_valid")
    return verdicts.filter(passed).drop("is_valid", "issues", "quality_score")


def validation_summary(verdicts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Total, valid and invalid records."""
    return verdicts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), F.count_if("is_valid").alias("valid"),
        F.count_if(~F.col("is_valid")).alias("invalid"))


def issues_by_code(verdicts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Number of issues per code and field."""
    return (verdicts.select(*keys, F.explode("issues").alias("i"))
            .groupBy(*keys, F.col("i.code").alias("code"), F.col("i.field").alias("field"))
            .agg(F.count(F.lit(1)).alias("n")))


def missing_fields(df: DataFrame, required: Sequence[str], not_empty: Sequence[str] = ()) -> DataFrame:
    """Adds ``missing``, the required fields that are NULL, or empty where that counts too."""
    def absent(name):
        gone = F.col(name).isNull()
        return gone | (F.col(name) == "") if name in not_empty else gone

    names = list(dict.fromkeys([*required, *not_empty]))
    return df.withColumn("missing", F.array_compact(
        F.array(*[F.when(absent(n), F.lit(n)) for n in names])))
