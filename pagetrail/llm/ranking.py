"""Row numbers within large groups, without putting a group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(rows: DataFrame, group: list[str], bucket: Column, order: list[str], rank: str, size: str) -> DataFrame:
    """Add ``rank`` (from 0, in the order of ``bucket``, then ``order``) and ``size`` of each group.

    ``bucket`` cuts a group into many parts of similar size and does not fall as the order goes on. Parts are
    counted with map-side combine, running totals go over the counts, and rows are numbered within their
    part only. Null group values are a group.
    """
    keys = [*group, "__part"]
    rows = rows.withColumn("__part", bucket)
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        rows.groupBy(*keys)
        .agg(F.count("*").alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .withColumn(size, F.sum("__n").over(Window.partitionBy(*group)))
        .drop("__n")
    )
    counts = counts.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    equal = F.lit(True)
    for k in keys:
        equal = equal & F.col(k).eqNullSafe(F.col(f"__right_{k}"))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        rows.withColumn("__row", within)
        .join(counts, equal)
        .withColumn(rank, F.col("__before") + F.col("__row") - 1)
        .drop("__part", "__row", "__before", *[f"__right_{k}" for k in keys])
    )
