"""Join of points to the intervals that contain them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SECOND = 1_000_000


def _bin(position: str, level: str, width: int) -> str:
    """SQL: number of the bin that holds the position; bins of a level are twice as wide as those below."""
    size = f"shiftleft({width}L, {level})"
    return f"({position} - pmod({position}, {size})) div {size}"


def interval_bins(intervals: DataFrame, start: str, end: str, width: int = _SECOND) -> DataFrame:
    """Add ``_level`` and ``_bin``: each interval is listed once or twice.

    Its level is the first whose bins are longer than the interval, so that it touches one bin or two
    neighbours, however long it is. Intervals that end before they start contain nothing and are left out.
    """
    steps = f"({end} - {start}) div {width}"
    level = f"CASE WHEN {steps} = 0 THEN 0 ELSE length(bin({steps})) END"
    leveled = intervals.filter(F.col(start) <= F.col(end)).selectExpr("*", f"{level} AS _level")
    touched = f"array_distinct(array({_bin(start, '_level', width)}, {_bin(end, '_level', width)}))"
    return leveled.selectExpr("*", f"explode({touched}) AS _bin")


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    key: str,
    point: str,
    start: str,
    end: str,
    how: str = "inner",
    width: int = _SECOND,
) -> DataFrame:
    """Points joined to the intervals of the same key with ``start <= point <= end``.

    Both sides carry integer positions. An interval is listed under the one or two bins of its level (see
    ``interval_bins``), a point under its bin of each level that intervals have, some dozens at most. So the join is
    an equi-join on (key, level, bin): a point meets only intervals that are near it at their own scale, a key with
    very many points is spread over its bins, and a long interval costs no more than a short one. ``how`` is inner
    or left; a point finds an interval or not by its key and position alone, so points that are left over
    are found by these. A NULL key, point or bound matches nothing.
    """
    listed = interval_bins(intervals, start, end, width)
    levels = listed.agg(F.sort_array(F.collect_set("_level")).alias("levels")).scalar()
    left = points.filter(F.col(key).isNotNull() & F.col(point).isNotNull())
    left = left.withColumn("_level", F.explode(levels)).selectExpr("*", f"{_bin(point, '_level', width)} AS _bin")
    left, right = left.alias("p"), listed.alias("i")
    matched = left.join(
        right,
        (F.col(f"p.{key}") == F.col(f"i.{key}"))
        & (F.col("p._level") == F.col("i._level"))
        & (F.col("p._bin") == F.col("i._bin"))
        & F.col(f"p.{point}").between(F.col(f"i.{start}"), F.col(f"i.{end}")),
    )
    extra = [c for c in intervals.columns if c not in points.columns]
    found = matched.select(*[F.col(f"p.{c}") for c in points.columns], *[F.col(f"i.{c}") for c in extra])
    if how == "inner":
        return found
    if how != "left":
        raise ValueError(f"how is inner or left, not {how}")
    known = found.select(F.col(key).alias("_key"), F.col(point).alias("_point")).distinct()
    missing = points.join(known, (F.col(key) == F.col("_key")) & (F.col(point) == F.col("_point")), "left_anti")
    kinds = dict(intervals.dtypes)
    return found.unionAll(missing.select(*points.columns, *[F.lit(None).cast(kinds[c]).alias(c) for c in extra]))
