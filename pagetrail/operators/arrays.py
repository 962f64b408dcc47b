"""Nested arrays to rows, and parameters shared by events at one instant."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.params import param_text, quoted, value_text


def flatten_params(df: DataFrame, keep: Sequence[str], params: str = "event_params") -> DataFrame:
    """One row per event and parameter; events without parameters give none."""
    return df.select(*keep, F.explode(params).alias("_p")).select(
        *keep,
        F.col("_p.key").alias("param_name"),
        F.expr(value_text("_p.value")).alias("param_value"),
    )


def flatten_items(
    df: DataFrame, keep: Sequence[str], fields: Sequence[str], items: str = "items"
) -> DataFrame:
    """One row per event and item; events without items give none.

    The named fields are zipped as arrays of their own, so that a scan leaves out the others.
    """
    wanted = F.arrays_zip(*[F.col(f"{items}.{field}").alias(field) for field in fields])
    return df.select(*keep, F.explode(wanted).alias("_i")).select(
        *keep, *[F.col(f"_i.{field}").alias(field) for field in fields]
    )


def pivot_params(
    df: DataFrame,
    keys: Mapping[str, str],
    by: Sequence[str],
    params: str = "event_params",
    typed=param_text,
) -> DataFrame:
    """One row per ``by`` group with the largest value of each key: ``{column: key}``.

    Groups in which no event has any of the keys are left out. The arrays are read inside the row,
    so only the wanted values are shuffled, and they are combined before the shuffle.
    """
    wanted = ", ".join(map(quoted, keys.values()))
    carrying = df.filter(f"arrays_overlap({params}.key, array({wanted}))")
    read = carrying.selectExpr(*by, *[f"{typed(params, key)} AS {name}" for name, key in keys.items()])
    return read.groupBy(*by).agg(*[F.max(name).alias(name) for name in keys])
