"""Tables that grow by batches, each of which may be written again.

``data/attempt=<name>`` holds what one attempt wrote, ``commits`` an empty file per attempt that got to its end, named by batch and number.
Only the last committed attempt of a batch is read. So a batch that is appended twice is there once, one that
broke off is not there at all, and readers never see a part of one. The commit is one creation of a file, which every store
does at once or not at all.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.session import create_file, list_paths, remove_folder

ATTEMPT = "attempt"
#: Between batch, number and attempt in the name of a commit; ``quote`` leaves no comma in a batch.
_CUT = ","


def _commits(spark: SparkSession, path: str) -> dict[str, tuple[int, str]]:
    """Number and attempt of the last commit of each batch."""
    last: dict[str, tuple[int, str]] = {}
    for found in list_paths(spark, [f"{path}/commits/*"]):
        parts = found.rsplit("/", 1)[1].split(_CUT)
        if len(parts) == 3:
            batch, entry = unquote(parts[0]), (int(parts[1]), parts[2])
            last[batch] = max(entry, last.get(batch, entry))
    return last


def is_committed(spark: SparkSession, path: str) -> bool:
    """Whether the table is one of batches, if only of some that broke off."""
    return bool(list_paths(spark, [f"{path}/commits", f"{path}/data/{ATTEMPT}=*"]))


def write_attempt(rows: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write rows that no reader sees before :func:`commit`; gives the attempt's name."""
    attempt = uuid.uuid4().hex
    rows.write.partitionBy(*partition_by).parquet(f"{path}/data/{ATTEMPT}={attempt}")
    return attempt


def commit(spark: SparkSession, path: str, batch: str, attempt: str) -> None:
    """Make an attempt the content of its batch."""
    number = _commits(spark, path).get(batch, (0, ""))[0] + 1
    create_file(spark, f"{path}/commits/{_CUT.join((quote(batch, safe=''), f'{number:09d}', attempt))}")


def append_batch(rows: DataFrame, path: str, batch: str, partition_by: Sequence[str] = ()) -> None:
    """Append ``rows`` as ``batch``; they replace what an earlier run of the same batch wrote."""
    commit(rows.sparkSession, path, batch, write_attempt(rows, path, partition_by))


def read_batches(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The rows of all committed batches. ``schema`` is needed only where there may be none yet."""
    attempts = sorted(a for _, a in _commits(spark, path).values())
    if not attempts:
        if schema is None:
            raise ValueError(f"{path} has no committed batch, and no schema is given")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    found = reader.option("basePath", f"{path}/data").parquet(*[f"{path}/data/{ATTEMPT}={a}" for a in attempts])
    return found.drop(ATTEMPT)


def clean(spark: SparkSession, path: str, running: Sequence[str] = ()) -> list[str]:
    """Remove attempts that no last commit names, but for those that are still ``running``; gives their names.

    For a time when no reader holds an older list of batches.
    """
    last = {a for _, a in _commits(spark, path).values()}
    old = [a for a in (p.rsplit("=", 1)[1] for p in list_paths(spark, [f"{path}/data/{ATTEMPT}=*"])) if a not in last and a not in running]
    for attempt in old:
        remove_folder(spark, f"{path}/data/{ATTEMPT}={attempt}")
    for found in list_paths(spark, [f"{path}/commits/*"]):
        if found.rsplit(_CUT, 1)[-1] in old:
            remove_folder(spark, found)
    return old


def with_day(rows: DataFrame, time_col: str) -> DataFrame:
    """The day that time tables are partitioned by."""
    return rows.withColumn("day", F.to_date(time_col))
