"""Folders of daily files, and stored tables that are replaced as a whole.

All file names come from the session's own file systems, so any store that Spark reads will do.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Name of the file that tells which run of a table is the current one.
POINTER = "_current"


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _file_system(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what is directly in the folder."""
    listed = _file_system(spark, folder).listStatus(_path(spark, folder))
    return sorted(status.getPath().getName() for status in listed)


def daily_shards(
    spark: SparkSession, folder: str, prefix: str, first_day: str | None = None, last_day: str | None = None
) -> list[str]:
    """Paths of the shards ``<prefix>YYYYMMDD`` and ``<prefix>intraday_YYYYMMDD`` of the days, both included.

    Only names are looked at: a shard outside of the range is neither listed nor opened.
    """
    wanted = re.compile(rf"{re.escape(prefix)}(?:intraday_)?(\d{{8}})(?:\.parquet)?")
    chosen = []
    for name in names_in(spark, folder):
        found = wanted.fullmatch(name)
        if found and (first_day or "") <= found[1] <= (last_day or "99999999"):
            chosen.append(f"{folder.rstrip('/')}/{name}")
    return chosen


def _read_text(spark: SparkSession, name: str) -> str | None:
    files = _file_system(spark, name)
    if not files.exists(_path(spark, name)):
        return None
    stream = files.open(_path(spark, name))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _replace_text(spark: SparkSession, name: str, text: str) -> None:
    """Write a small file by one rename, so that a reader sees the old text or the new one."""
    fresh = f"{name}-{uuid.uuid4()}"
    stream = _file_system(spark, fresh).create(_path(spark, fresh), False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    target = _path(spark, name)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(_path(spark, fresh), target, overwrite)


def current_run(spark: SparkSession, path: str) -> str | None:
    """Folder of the table's current run, None if it was never stored."""
    run = _read_text(spark, f"{path.rstrip('/')}/{POINTER}")
    return f"{path.rstrip('/')}/{run}" if run else None


def load_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The current run of a stored table."""
    run = current_run(spark, path)
    if run is None:
        raise FileNotFoundError(f"no stored table at {path}")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(run)


def store_table(frame: DataFrame, path: str, order: list[str] | None = None) -> DataFrame:
    """Full rebuild of a stored table; returns it as read back.

    The rows go to a folder of a new run. The table changes when that is complete, by the rename of one small file:
    readers, and a rebuild that fails, leave it with the run before, which is kept. Runs older than that are
    deleted. With ``order`` rows are dealt out by ranges and sorted within their files, so that the files read one
    after the other, by name, are in that order, whatever the size.
    """
    spark, path = frame.sparkSession, path.rstrip("/")
    before = current_run(spark, path)
    run = f"run-{uuid.uuid4()}"
    rows = frame.repartitionByRange(*order).sortWithinPartitions(*order) if order else frame
    rows.write.parquet(f"{path}/{run}")
    _replace_text(spark, f"{path}/{POINTER}", run)
    for name in names_in(spark, path):
        if name.startswith("run-") and name != run and f"{path}/{name}" != before:
            try:
                _file_system(spark, path).delete(_path(spark, f"{path}/{name}"), True)
            except Py4JJavaError:  # another rebuild was faster
                pass
    return load_table(spark, path, frame.schema)
