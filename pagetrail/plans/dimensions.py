"""User, item, page and date dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.times import instant, parse_day, whole_seconds
from ..functions.urls import canonical_url, surrogate_key, url_host, url_path
from ..operators.arrays import flatten_items, pivot_params
from ..operators.calendars import calendar, calendar_between
from .core import KEY, SESSION, TS, USER, EventCore, user

ITEM_FIELDS = [
    "item_name",
    "item_brand",
    "item_category",
    "item_category2",
    "item_category3",
    "item_category4",
    "item_variant",
]


def dim_users(core: EventCore) -> DataFrame:
    """One row per user: first and last session and totals; one row for events without a user."""
    sessions = core.slices.select(*SESSION, "session_first", "session_last").distinct()
    users = sessions.groupBy(KEY).agg(
        F.min("session_number").alias("first_session_number"),
        F.expr(f"{instant('min(session_first)')} AS first_session_start"),
        F.max("session_number").alias("last_session_number"),
        F.expr(f"{instant('max(session_last)')} AS last_session_end"),
        F.count(F.lit(1)).alias("total_sessions"),
        F.expr(
            f"sum({whole_seconds('session_first', 'session_last')}) AS total_session_duration_seconds"
        ),
    )
    return users.select(user(), *users.columns[1:])


def dim_items(raw: DataFrame) -> DataFrame:
    """One row per item id; of several values the smallest one is kept."""
    items = flatten_items(raw, [], ["item_id", *ITEM_FIELDS, "price"])
    return (
        items.filter(F.col("item_id").isNotNull())
        .groupBy("item_id")
        .agg(*[F.min(c).alias(c) for c in ITEM_FIELDS], F.min("price").alias("default_price"))
        .select(
            surrogate_key(F.col("item_id")).alias("item_key"),
            "item_id",
            *ITEM_FIELDS,
            "default_price",
        )
    )


def dim_pages(raw: DataFrame) -> DataFrame:
    """One row per canonical URL; of several variants the smallest value per column is kept."""
    seen = pivot_params(
        raw,
        {
            "page_location": fixed.PAGE_LOCATION,
            "page_title": fixed.PAGE_TITLE,
            "page_referrer": fixed.PAGE_REFERRER,
        },
        [USER, TS],
    ).filter(F.col("page_location").isNotNull())
    location = F.col("page_location")
    pages = seen.select(
        surrogate_key(canonical_url(location)).alias("page_key"),
        "page_location",
        "page_title",
        "page_referrer",
        url_host(location).alias("hostname"),
        url_path(location).alias("page_path"),
    )
    return pages.groupBy("page_key").agg(*[F.min(c).alias(c) for c in pages.columns[1:]])


def dim_date(spark: SparkSession) -> DataFrame:
    """The standard calendar."""
    return calendar(spark)


def dim_date_covering(raw: DataFrame) -> DataFrame:
    """The standard calendar, widened to whole years where the export reaches beyond it."""
    day = parse_day("event_date")
    bounds = raw.agg(F.expr(f"min({day}) AS first"), F.expr(f"max({day}) AS last"))
    year_end = F.last_day(F.add_months(F.trunc("last", "year"), 11))
    start = F.least(F.lit(fixed.CALENDAR_START).cast("date"), F.trunc("first", "year"))
    end = F.greatest(F.lit(fixed.CALENDAR_END).cast("date"), year_end)
    return calendar_between(bounds, start, end)
