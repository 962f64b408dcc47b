"""Session settings and stored intermediate tables for the text operators."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Rows per Arrow batch. A batch of long documents has to fit in a Python worker several times over.
ROWS_PER_BATCH = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Set what all text operators rely on, for the whole session: small Arrow batches, adaptive plans."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Only a session on one machine may go without that setting."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared folder and read it back, so that it is computed once and
    outlives lost executors. The folder's owner removes the tables after the job."""
    path = f"{shared_folder(frame.sparkSession)}/{name}-{uuid.uuid4()}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def with_plain_names(docs: DataFrame, own: tuple[str, ...], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on ``docs`` with all columns but its ``own`` renamed to c0, c1, ...; they get their names back. So
    other columns may have any names, with dots and quotes, or those that the work uses itself."""
    plain = [name if name in own else f"c{k}" for k, name in enumerate(docs.columns)]
    done = work(docs.toDF(*plain))
    names = dict(zip(plain, docs.columns))
    return done.toDF(*[names.get(c, c) for c in done.columns])
