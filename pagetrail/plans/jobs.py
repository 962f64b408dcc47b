"""All marts by name: as views over a lazy core, or as stored tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from ..sources.export import save_table
from ..sources.files import load_table
from . import dimensions, events, sessions, staging
from .core import EventCore, store_core

MARTS: dict[str, Callable[[EventCore], DataFrame]] = {
    "stg_events": lambda core: staging.stg_events(core.raw),
    "stg_event_params": lambda core: staging.stg_event_params(core.raw),
    "stg_items": lambda core: staging.stg_items(core.raw),
    "stg_sessions": staging.stg_sessions,
    "dim_date": lambda core: dimensions.dim_date(core.raw.sparkSession),
    "dim_items": lambda core: dimensions.dim_items(core.raw),
    "dim_pages": lambda core: dimensions.dim_pages(core.raw),
    "dim_users": dimensions.dim_users,
    "fct_sessions": sessions.sessions,
    "fct_events": events.events,
    "fct_pageviews": events.pageviews,
    "fct_user_journey": events.user_journey,
    "fct_funnels": sessions.funnels,
    "fct_landing_pages": sessions.landing_pages,
    "fct_exit_pages": sessions.exit_pages,
    "fct_traffic_sources": sessions.traffic_sources,
    "fct_engagement": sessions.engagement,
    "fct_scroll_depth": events.scroll_depth,
    "fct_item_performance": events.item_performance,
    "fct_content_performance": sessions.content_performance,
    "fct_daily_overview": sessions.daily_overview,
    "fct_user_journey_paths": events.user_journey_paths,
    "fct_session_summary": sessions.session_summary,
    "fct_user_summary": sessions.user_summary,
}
# marts that are stored by default; the others are views
STORED = ("dim_date", "dim_pages", "fct_user_journey_paths")

# row order of a mart where it is shown, by its columns
REPORT_ORDER = {
    "stg_sessions": ["user_pseudo_id", "event_timestamp"],
    "dim_date": ["date"],
    "dim_items": ["item_id"],
    "dim_pages": ["page_key"],
    "dim_users": ["user_pseudo_id"],
    "fct_events": ["user_pseudo_id", "session_number", "event_index"],
    "fct_pageviews": ["user_pseudo_id", "session_number", "pageview_index"],
    "fct_user_journey": ["user_pseudo_id", "session_number", "event_index"],
    "fct_user_journey_paths": ["user_pseudo_id", "session_number", "pageview_index"],
    "fct_funnels": ["user_pseudo_id", "session_number", "step_order"],
    "fct_scroll_depth": ["user_pseudo_id", "session_number", "event_timestamp"],
    "fct_content_performance": ["event_date", "page_location"],
    "fct_daily_overview": ["event_date"],
    "fct_user_summary": ["user_pseudo_id"],
    **dict.fromkeys(
        [
            "fct_sessions",
            "fct_landing_pages",
            "fct_exit_pages",
            "fct_traffic_sources",
            "fct_engagement",
            "fct_session_summary",
        ],
        ["user_pseudo_id", "session_number"],
    ),
}


def ordered(name: str, mart: DataFrame) -> DataFrame:
    """The mart in its report order; marts without one stay as they are."""
    order = REPORT_ORDER.get(name)
    return mart.orderBy(*order) if order else mart


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return folder.rstrip("/")


def register_views(core: EventCore, names: Iterable[str] = MARTS) -> None:
    """Make the marts available to ``spark.sql`` under their names."""
    for name in names:
        MARTS[name](core).createOrReplaceTempView(name)


def build(
    core: EventCore, folder: str | None = None, names: Iterable[str] = STORED, keep_core: bool = True
) -> dict[str, DataFrame]:
    """Fully rebuild the named marts as Parquet tables below the folder, each in its report order.

    A table changes when its new run is complete (see ``sources.files``); ``read_mart`` gives its current run.

    With ``keep_core`` the event core and the page dimension are written first and every mart
    reads them, so single events are shuffled once for the whole build, and a lost executor costs
    a mart no more than its own work.
    """
    names = list(names)
    folder = folder or f"{shared_folder(core.raw.sparkSession)}/pagetrail"
    source = store_core(core, f"{folder}/core") if keep_core else core
    tables: dict[str, DataFrame] = {}
    if keep_core or "dim_pages" in names:
        tables["dim_pages"] = save_table(MARTS["dim_pages"](source), f"{folder}/dim_pages", REPORT_ORDER["dim_pages"])
    for name in names:
        if name == "fct_pageviews":
            mart = events.pageviews(source, tables.get("dim_pages"))
        elif name in tables:
            continue
        else:
            mart = MARTS[name](source)
        tables[name] = save_table(mart, f"{folder}/{name}", REPORT_ORDER.get(name))
    return tables


def read_mart(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A mart that ``build`` stored below the folder."""
    return load_table(spark, f"{folder}/{name}")
