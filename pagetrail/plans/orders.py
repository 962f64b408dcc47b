"""The general operators on plain tables: orders, their lines, and the export's events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import instant, parse_day
from ..operators.calendars import calendar_between
from ..operators.grouping import first_in_group, first_non_null, last_in_group, mode_per_group, top1_per_group
from ..operators.intervals import interval_join
from ..operators.slices import index_in_group, sessionize, transitions
from .core import KEY, SESSION, TRAFFIC, TS, USER, EventCore, user

DAY_MICROS = 86_400_000_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its position among the customer's orders, by date and key."""
    orders = _table(spark, sf_dir, "orders").selectExpr(
        "o_custkey", "o_orderkey", "unix_micros(cast(o_orderdate AS timestamp)) AS ordered_at"
    )
    return index_in_group(orders, ["o_custkey"], "ordered_at", ["o_orderkey"], "position", 365 * DAY_MICROS)


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's first and last order by date and key."""
    orders = _table(spark, sf_dir, "orders")
    order, value = ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice"]
    first = first_in_group(orders, ["o_custkey"], order, value).toDF("o_custkey", "first_order", "first_price")
    last = last_in_group(orders, ["o_custkey"], order, value).toDF("o_custkey", "last_order", "last_price")
    return first.join(last, "o_custkey")


def supplier_favourites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier's most frequent return flag and its part with the largest quantity, ties to the smallest."""
    lines = _table(spark, sf_dir, "lineitem")
    flags = mode_per_group(lines, ["l_suppkey"], "l_returnflag", "usual_flag")
    sold = lines.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("quantity"))
    return flags.join(top1_per_group(sold, ["l_suppkey"], "quantity", "l_partkey", "top_part"), "l_suppkey")


def priority_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often one order priority follows another in a customer's orders."""
    priorities = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    placed = order_positions(spark, sf_dir).join(priorities, "o_orderkey")
    pairs = transitions(placed, ["o_custkey"], "position", "o_orderpriority", "next_priority", 1000)
    counted = pairs.filter("next_priority IS NOT NULL").groupBy("o_orderpriority", "next_priority")
    return counted.agg(F.count(F.lit(1)).alias("times"))


def short_sessions(core: EventCore, gap_minutes: int = 10) -> DataFrame:
    """Events with the bounds of their session, for another gap."""
    return sessionize(core.bare, USER, TS, gap_minutes).selectExpr(
        USER, TS, "event_name", "event_date", "session_number", "session_start", "session_end"
    )


def events_in_intervals(core: EventCore) -> DataFrame:
    """All events, by an interval join with the sessions of their user."""
    spans = core.slices.select(*SESSION, "session_first", "session_last").distinct().select(user(), *SESSION[1:], "session_first", "session_last")
    points = core.bare.select(USER, TS, "event_name", "event_date")
    joined = interval_join(points, spans, USER, TS, "session_first", "session_last", "left")
    return joined.selectExpr(
        USER,
        TS,
        "event_name",
        "event_date",
        "session_number",
        f"{instant('session_first')} AS session_start",
        f"{instant('session_last')} AS session_end",
    )


def first_sources(core: EventCore) -> DataFrame:
    """Per user, each on its own: the first source, medium and campaign that was seen."""
    found = first_non_null(core.moments, [KEY], TS, TRAFFIC)
    return found.select(user(), *TRAFFIC)


def calendar_days(core: EventCore) -> DataFrame:
    """Every day from the export's first to its last one with its calendar attributes and its events."""
    per_day = core.bare.groupBy(F.expr(f"{parse_day('event_date')} AS its_date")).agg(F.count(F.lit(1)).alias("events"))
    bounds = per_day.agg(F.min("its_date").alias("first"), F.max("its_date").alias("last")).filter("first IS NOT NULL")
    days = calendar_between(bounds, F.col("first"), F.col("last"))
    counted = days.join(per_day, F.col("date") == F.col("its_date"), "left").drop("its_date")
    return counted.withColumn("events", F.coalesce("events", F.lit(0).cast("long")))
