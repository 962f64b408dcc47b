"""First, last, most frequent per group, as aggregations that combine before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.params import quoted


def earliest(order: str, value: str, where: str = "true") -> str:
    """SQL aggregate: smallest ``(at, value)`` pair among the rows that qualify."""
    return f"min(CASE WHEN {where} THEN named_struct('at', {order}, 'value', {value}) END)"


def latest(order: str, value: str, where: str = "true") -> str:
    """SQL aggregate: largest ``(at, value)`` pair among the rows that qualify."""
    return f"max(CASE WHEN {where} THEN named_struct('at', {order}, 'value', {value}) END)"


def first_filled(order: str, value: str, where: str = "true") -> str:
    """SQL aggregate: the value that is not NULL and comes first."""
    return f"{earliest(order, value, f'{where} AND {value} IS NOT NULL')}.value"


def last_filled(order: str, value: str, where: str = "true") -> str:
    """SQL aggregate: the value that is not NULL and comes last."""
    return f"{latest(order, value, f'{where} AND {value} IS NOT NULL')}.value"


def top1(weight: str, value: str, where: str = "true") -> str:
    """SQL aggregate: value of the largest weight, ties to the smallest value, NULL value last."""
    ranked = f"named_struct('rank', -{weight}, 'empty', {value} IS NULL, 'value', {value})"
    return f"min(CASE WHEN {where} THEN {ranked} END).value"


def _packed(order: Sequence[str], cols: Sequence[str]) -> Column:
    return F.struct(F.struct(*order).alias("at"), F.struct(*cols).alias("value"))


def first_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """Columns of the first row of each group; ties go to the smallest values."""
    packed = df.groupBy(*group).agg(F.min(_packed(order, cols)).alias("_row"))
    return packed.select(*group, *[F.col(f"_row.value.{c}").alias(c) for c in cols])


def last_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """Columns of the last row of each group; ties go to the largest values."""
    packed = df.groupBy(*group).agg(F.max(_packed(order, cols)).alias("_row"))
    return packed.select(*group, *[F.col(f"_row.value.{c}").alias(c) for c in cols])


def first_non_null(
    df: DataFrame, group: Sequence[str], order: str, cols: Sequence[str]
) -> DataFrame:
    """Per group and column on its own: the first value that is not NULL."""
    return df.groupBy(*group).agg(*[F.expr(f"{first_filled(order, c)} AS {c}") for c in cols])


def top1_per_group(
    df: DataFrame, group: Sequence[str], weight: str, value: str, name: str
) -> DataFrame:
    """Value of the largest weight per group."""
    return df.groupBy(*group).agg(F.expr(f"{top1(weight, value)} AS {name}"))


def mode_per_group(df: DataFrame, group: Sequence[str], col: str, name: str) -> DataFrame:
    """Most frequent value per group; NULL counts as a value, ties to the smallest, NULL last."""
    counts = df.groupBy(*group, col).agg(F.count(F.lit(1)).alias("_n"))
    return top1_per_group(counts, group, "_n", col, name)


def funnel(
    df: DataFrame,
    steps: Sequence[tuple[str, str, int]],
    group: Sequence[str],
    event: str,
    ts: str,
) -> DataFrame:
    """First time of each step per group, one row per step that was reached.

    The funnel is open: a later step counts without the earlier ones. Steps are
    ``(step name, event name, step order)``; all first times come from one aggregation.
    """
    hit = df.filter(F.col(event).isin(*{name for _, name, _ in steps}))
    firsts = hit.groupBy(*group).agg(
        *[F.expr(f"min(CASE WHEN {event} = {quoted(name)} THEN {ts} END) AS _s{i}")
          for i, (_, name, _) in enumerate(steps)]
    )
    rows = ", ".join(f"{quoted(step)}, {order}L, _s{i}" for i, (step, _, order) in enumerate(steps))
    return firsts.selectExpr(
        *group, f"stack({len(steps)}, {rows}) AS (step_name, step_order, step_timestamp)"
    ).filter("step_timestamp IS NOT NULL")
