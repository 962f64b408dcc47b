"""Report jobs on top of the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.labels import page_type, source_label
from ..functions.params import quoted
from ..functions.urls import canonical_url
from ..operators.calendars import attributes
from ..operators.slices import NO_SLICE
from .core import KEY, KNOWN, MET, EventCore
from .dimensions import dim_pages
from .events import ordered_views, user_journey_paths
from .sessions import (
    daily_overview,
    funnels,
    landing_pages,
    traffic_sources,
    user_facts,
)

Rules = Sequence[tuple[str, str]]


def kpi_totals(core: EventCore) -> DataFrame:
    """One row: sessions, users, pageviews, revenue."""
    zero = F.lit(0).cast("long")
    per_user = core.slices.groupBy(KEY).agg(
        F.expr(f"max(sessions_per_user) + count_if(slice = {NO_SLICE}) AS sessions"),
        F.expr(f"sum(CASE WHEN {MET} THEN views ELSE 0L END) AS views"),
    )
    traffic = per_user.agg(
        F.sum("sessions").alias("total_sessions"),
        F.expr(f"count_if({KNOWN}) AS total_users"),
        F.sum("views").alias("total_pageviews"),
        F.lit(0.0).alias("total_revenue"),
    )
    money = core.facts.agg(
        zero.alias("total_sessions"),
        zero.alias("total_users"),
        zero.alias("total_pageviews"),
        F.sum("revenue").alias("total_revenue"),
    )
    both = traffic.unionByName(money)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


def daily_trend(core: EventCore, grain: str = "date") -> DataFrame:
    """Sessions and revenue over time; ``grain`` is a calendar column such as ``year_month``."""
    of_day = attributes("event_date")
    daily = daily_overview(core).filter(F.col("event_date").isNotNull())
    if grain == "date":
        return daily.selectExpr(
            "event_date AS date",
            f"{of_day['year_month']} AS year_month",
            f"{of_day['year_quarter']} AS year_quarter",
            "daily_sessions",
            "daily_revenue",
        )
    return daily.groupBy(F.expr(of_day[grain]).alias(grain)).agg(
        F.sum("daily_sessions").alias("sessions"), F.sum("daily_revenue").alias("revenue")
    )


def sessions_by_source(core: EventCore) -> DataFrame:
    """Sessions per displayed traffic source."""
    label = source_label(F.col("traffic_source")).alias("display_source")
    return traffic_sources(core).groupBy(label).agg(F.count(F.lit(1)).alias("sessions"))


def source_labels(core: EventCore) -> DataFrame:
    """Raw traffic sources beside their display label."""
    counted = traffic_sources(core).groupBy("traffic_source").agg(F.count(F.lit(1)).alias("sessions"))
    return counted.select(
        "traffic_source", source_label(F.col("traffic_source")).alias("display_source"), "sessions"
    )


def sessions_by_landing_page(core: EventCore, top: int | None = None) -> DataFrame:
    """Sessions per landing page, on request only the most frequent ones."""
    counted = landing_pages(core).groupBy("landing_page").agg(F.count(F.lit(1)).alias("sessions"))
    if top is None:
        return counted
    return counted.orderBy(F.desc("sessions"), F.asc_nulls_last("landing_page")).limit(top)


def purchase_funnel(
    core: EventCore, steps: Sequence[tuple[str, str, int]] = fixed.FUNNEL_STEPS
) -> DataFrame:
    """Sessions per funnel step, with the rate to the step before and to the first step. A step that no
    session reached has 0."""
    counts = funnels(core, steps).agg(
        *[F.expr(f"count_if(step_order = {order}) AS s{i}") for i, (_, _, order) in enumerate(steps)]
    )
    rows = ", ".join(
        f"{order}L, {quoted(step)}, s{i}, "
        + (f"try_divide(s{i}, s{i - 1})" if i else "CAST(NULL AS DOUBLE)")
        + f", try_divide(s{i}, s0)"
        for i, (step, _, order) in enumerate(steps)
    )
    columns = "step_order, step_name, sessions, step_rate, overall_rate"
    return counts.selectExpr(f"stack({len(steps)}, {rows}) AS ({columns})")


def page_types(
    core: EventCore, rules: Rules = fixed.PAGE_TYPE_RULES, pages: DataFrame | None = None
) -> DataFrame:
    """Pages with their type."""
    known_pages = dim_pages(core.raw) if pages is None else pages
    return known_pages.select(
        "page_key",
        "page_location",
        page_type(canonical_url(F.col("page_location")), rules).alias("page_type"),
    )


def page_type_transitions(core: EventCore, rules: Rules = fixed.PAGE_TYPE_RULES) -> DataFrame:
    """How often one page type follows another within a session."""
    paths = user_journey_paths(core).filter(
        F.col("from_page").isNotNull() & F.col("to_page").isNotNull()
    )
    # count distinct page pairs first: the rules then run once per pair
    pairs = paths.groupBy("from_page", "to_page").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(
        page_type(F.col("from_page"), rules).alias("from_page_type"),
        page_type(F.col("to_page"), rules).alias("to_page_type"),
    ).agg(F.sum("n").alias("transitions"))


def exit_rate_by_page_type(core: EventCore, rules: Rules = fixed.PAGE_TYPE_RULES) -> DataFrame:
    """Pageviews per page type and the share of them that ended their session."""
    views = ordered_views(core).select(
        canonical_url(F.col("page_location")).alias("page"),
        (F.col("pageview_index") == F.col("session_views")).alias("ends"),
    )
    per_page = views.groupBy("page").agg(
        F.count(F.lit(1)).alias("pageviews"), F.count_if("ends").alias("exits")
    )
    per_type = per_page.groupBy(page_type(F.col("page"), rules).alias("page_type")).agg(
        F.sum("pageviews").alias("pageviews"), F.sum("exits").alias("exits")
    )
    return per_type.withColumn("exit_rate", F.try_divide("exits", "pageviews"))


def purchaser_comparison(core: EventCore) -> DataFrame:
    """Engagement of users with a purchase against users without, one row per metric."""
    metrics = {
        "avg_sessions": "avg({}total_sessions{})",
        "avg_session_length_seconds": "avg({}avg_session_length_seconds{})",
        "avg_pageviews": "avg({}total_pageviews{})",
        "avg_unique_pages_viewed": "avg({}total_unique_pages_viewed{})",
    }
    bought = "CASE WHEN purchase_events > 0 THEN "
    other = "CASE WHEN purchase_events = 0 THEN "
    both = user_facts(core).filter(KNOWN).agg(
        F.expr("cast(count_if(purchase_events > 0) AS double) AS yes_users"),
        F.expr("cast(count_if(purchase_events = 0) AS double) AS no_users"),
        *[F.expr(f"{a.format(bought, ' END')} AS yes_{m}") for m, a in metrics.items()],
        *[F.expr(f"{a.format(other, ' END')} AS no_{m}") for m, a in metrics.items()],
    )
    shares = both.selectExpr(
        "*",
        "try_divide(yes_users, yes_users + no_users) AS yes_user_share",
        "try_divide(no_users, yes_users + no_users) AS no_user_share",
    )
    names = ["users", "user_share", *metrics]
    rows = ", ".join(f"'{m}', yes_{m}, no_{m}, try_divide(yes_{m}, no_{m})" for m in names)
    return shares.selectExpr(f"stack({len(names)}, {rows}) AS (metric, purchasers, non_purchasers, ratio)")
