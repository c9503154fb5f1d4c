"""Rows by day and micro-batch, for state that outlives a batch."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.session import list_paths, remove_folder

BATCH = "batch_id"


class DayLog:
    """A table of rows with a ``day`` (DATE), written batch by batch.

    A batch that runs again replaces its own rows and can leave out those of itself and later ones, so it finds what it
    found the first time. Readers name the days they need, and no folder of another day is listed or opened. Days with
    many batches are merged; a merge is complete or not seen at all, and what it replaces stays for one more
    merge, as readers may have listed it.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        """``schema`` has the columns beside the day."""
        self.spark, self.path, self.columns = spark, path, schema
        self.schema = f"{schema}, day date, {BATCH} bigint"

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Rows without a day go to the first day there is."""
        day = F.coalesce(F.col("day").cast("date"), F.lit("0001-01-01").cast("date"))
        (rows.withColumns({"day": day, BATCH: F.lit(batch_id).cast("long")}).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("day", BATCH).parquet(f"{self.path}/batches"))

    def _folders(self, kind: str, days: Iterable[str] | None) -> list[tuple[str, int]]:
        number, last = (f"{BATCH}=*", "") if kind == "batches" else ("upto=*", "/_SUCCESS")
        patterns = [f"{self.path}/{kind}/day={d}/{number}{last}" for d in ("*",) if days is None] or [
            f"{self.path}/{kind}/day={d}/{number}{last}" for d in days]
        found = (re.search(r"/day=([^/]+)/[a-z_]+=(\d+)", p) for p in list_paths(self.spark, patterns))
        return [(m.group(1), int(m.group(2))) for m in found if m]

    def _sources(self, days: Iterable[str] | None, before: int | None) -> tuple[dict[str, int], list[tuple[str, int]]]:
        """Per day the last merge and the batches after it, those before batch ``before`` only."""
        days = None if days is None else sorted(set(days))
        merged: dict[str, int] = {}
        for day, upto in self._folders("merged", days):
            if before is None or upto < before:
                merged[day] = max(upto, merged.get(day, -1))
        batches = [(d, n) for d, n in self._folders("batches", days) if n > merged.get(d, -1) and (before is None or n < before)]
        return merged, batches

    def read(self, days: Iterable[str] | None = None, before: int | None = None) -> DataFrame:
        """Rows of the ``days`` (as text; all by default) that batches before ``before`` wrote."""
        merged, batches = self._sources(days, before)
        parts = []
        if merged:
            rows = self.spark.read.schema(f"{self.columns}, {BATCH} bigint, day date, upto bigint").option("basePath", f"{self.path}/merged")
            parts.append(rows.parquet(*[f"{self.path}/merged/day={d}/upto={n}" for d, n in merged.items()]).drop("upto"))
        if batches:
            rows = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/batches")
            parts.append(rows.parquet(*[f"{self.path}/batches/day={d}/{BATCH}={n}" for d, n in batches]))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def days_from(self, first: str) -> list[str]:
        """Days of the log that are not before ``first``."""
        found = list_paths(self.spark, [f"{self.path}/batches/day=*", f"{self.path}/merged/day=*"])
        return sorted({d for d in (p.rsplit("day=", 1)[1] for p in found) if d >= first})

    def merge(self, before: int, many: int, combine=None) -> None:
        """Merge each day with ``many`` batches before ``before`` or more since its last merge.

        ``combine`` may make fewer rows of a day's rows; it has to keep the columns.
        """
        merged, batches = self._sources(None, before)
        for day in sorted({d for d, _ in batches}):
            own = [n for d, n in batches if d == day]
            if len(own) < many:
                continue
            rows = self.read([day], max(own) + 1).drop("day")
            (rows if combine is None else combine(rows)).hint("rebalance").write.mode("overwrite").parquet(f"{self.path}/merged/day={day}/upto={max(own)}")
            for _, n in self._folders("batches", [day]):
                if n <= merged.get(day, -1):
                    remove_folder(self.spark, f"{self.path}/batches/day={day}/{BATCH}={n}")
            for _, n in self._folders("merged", [day]):
                if n < merged.get(day, -1):
                    remove_folder(self.spark, f"{self.path}/merged/day={day}/upto={n}")
