"""Reading and writing the raw event export and the tables made from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import daily_shards, store_table
from .schema import EVENTS


def read_export(
    spark: SparkSession,
    path: str,
    first_day: str | None = None,
    last_day: str | None = None,
) -> DataFrame:
    """The event export at ``path``: Parquet, in ``event_date=YYYYMMDD`` folders or plain.

    ``first_day`` and ``last_day`` (``YYYYMMDD``, both included) prune day folders before any file
    is opened; on a plain layout they are pushed into the scan.
    """
    events = spark.read.schema(EVENTS).parquet(path)
    if first_day is not None:
        events = events.filter(F.col("event_date") >= first_day)
    if last_day is not None:
        events = events.filter(F.col("event_date") <= last_day)
    return events.select(*EVENTS.names)


def write_export(events: DataFrame, path: str, tasks_per_day: int = 64) -> None:
    """Store an export in day folders. Days that ``events`` does not have stay as they are.

    Each day is written by ``tasks_per_day`` tasks, so that a big day is not one task: choose it so that
    a task writes a few hundred MB.
    """
    spread = F.pmod(F.hash("user_pseudo_id", "event_timestamp"), F.lit(tasks_per_day))
    events.repartition("event_date", spread).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("event_date").parquet(path)


def read_shards(
    spark: SparkSession,
    folder: str,
    first_day: str | None = None,
    last_day: str | None = None,
    prefix: str = "events_",
) -> DataFrame:
    """The event export in daily shards ``events_YYYYMMDD``, finished or intraday.

    Only shards of the days (``YYYYMMDD``, both included) are opened, whatever else the folder holds. An event
    without a date has that of its shard.
    """
    paths = daily_shards(spark, folder, prefix, first_day, last_day)
    if not paths:
        return spark.createDataFrame([], EVENTS)
    events = spark.read.schema(EVENTS).parquet(*paths)
    day = F.regexp_extract("_metadata.file_path", rf"/{prefix}(?:intraday_)?(\d{{8}})[^/]*(?:/[^/]*)?$", 1)
    return events.withColumn("event_date", F.coalesce("event_date", day)).select(*EVENTS.names)


def save_table(df: DataFrame, path: str, order: list[str] | None = None) -> DataFrame:
    """Full rebuild of a stored table; returns it as read back. See ``files.store_table``."""
    return store_table(df, path, order)
