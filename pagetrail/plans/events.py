"""Event-grain and pageview-grain marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.numbers import safe_product
from ..functions.times import civil, instant, parse_day
from ..functions.urls import canonical_url, surrogate_key
from ..operators.arrays import flatten_items
from ..operators.slices import follow, user_of
from .core import KEY, SESSION, TS, UNIT, USER, VIEW, EventCore, keyed
from .dimensions import dim_pages

_ITEM = [
    "item_id",
    "item_name",
    "item_brand",
    "item_category",
    "item_category2",
    "item_category3",
    "item_category4",
    "item_variant",
    "price",
    "quantity",
]
_USER = f"{user_of(KEY)} AS {USER}"
_DATETIME = f"{civil(TS)} AS event_datetime"
_DATE = f"{parse_day('event_date')} AS event_date"
_START = f"{instant('session_first')} AS session_start"
_END = f"{instant('session_last')} AS session_end"


def _nothing(*kinds: str) -> list[str]:
    """Columns without a value, given as ``type name``."""
    return [f"CAST(NULL AS {kind}) AS {name}" for kind, name in (k.split() for k in kinds)]


def events(core: EventCore) -> DataFrame:
    """All events with page parameters, session and position. An event without a user or a timestamp
    has no session and no page."""
    pages = ["page_location", "page_title", "page_referrer"]
    in_sessions = core.moments.selectExpr(
        _USER, "session_number", "event_index", "event_name", TS, _DATETIME, _DATE, *pages, _START, _END
    )
    others = core.apart.selectExpr(
        _USER,
        *_nothing("bigint session_number"),
        "event_index",
        "event_name",
        TS,
        _DATETIME,
        _DATE,
        *_nothing(*[f"string {c}" for c in pages], "timestamp session_start", "timestamp session_end"),
    )
    return in_sessions.unionAll(others)


def user_journey(core: EventCore) -> DataFrame:
    """Events of sessions in their order."""
    return core.moments.selectExpr(
        _USER,
        "session_number",
        "event_index",
        "event_name",
        TS,
        _DATETIME,
        "event_date",
        "page_location",
        "page_title",
        _START,
        _END,
    )


def ordered_views(core: EventCore) -> DataFrame:
    """Pageviews of sessions with their position there, still keyed by unit."""
    return core.moments.filter(VIEW).withColumnRenamed("view_index", "pageview_index")


def pageviews(core: EventCore, pages: DataFrame | None = None) -> DataFrame:
    """Pageviews with the key of their page.

    Only the kept variant of a URL finds its page; other variants have no key. ``pages`` is a
    stored page dimension, by default it is made from the export. The lookup comes last, so a very
    popular address can be split by the skew-join rule.
    """
    keys = (dim_pages(core.raw) if pages is None else pages).select("page_location", "page_key")
    return ordered_views(core).join(keys, "page_location", "left").selectExpr(
        _USER,
        "session_number",
        "pageview_index",
        "page_location",
        "page_title",
        "page_referrer",
        "page_key",
        TS,
        _DATETIME,
        _DATE,
        _START,
        _END,
    )


def scroll_depth(core: EventCore) -> DataFrame:
    """Scroll events with the share of the page that was scrolled."""
    scrolled = F.col("event_name") == fixed.SCROLL
    in_sessions = core.moments.filter(scrolled).selectExpr(
        _USER, "session_number", TS, _DATETIME, "event_date", "page_location", "percent_scrolled"
    )
    others = core.apart.filter(scrolled).selectExpr(
        _USER,
        *_nothing("bigint session_number"),
        TS,
        _DATETIME,
        "event_date",
        *_nothing("string page_location", "double percent_scrolled"),
    )
    return in_sessions.unionAll(others)


def user_journey_paths(core: EventCore) -> DataFrame:
    """Each pageview's page and the next one of the session, as canonical URLs with keys."""
    views = ordered_views(core).select(
        *UNIT,
        "session_number",
        "pageview_index",
        canonical_url(F.col("page_location")).alias("from_page"),
    )
    paths = follow(views, UNIT, SESSION, "slice", "pageview_index", "from_page", "to_page")
    return paths.select(
        F.expr(_USER),
        "session_number",
        "pageview_index",
        "from_page",
        "to_page",
        surrogate_key(F.col("from_page")).alias("from_page_key"),
        surrogate_key(F.col("to_page")).alias("to_page_key"),
    )


def item_performance(core: EventCore) -> DataFrame:
    """Items with their value and, on purchases, revenue.

    An item belongs to every event name its user has at that instant, once per name. Only instants with
    items meet the items.
    """
    named = core.moments.filter("sells").select(*UNIT, TS, "event_name", "event_date", "page_location", "session_number")
    sold = keyed(core.raw, core.unit_width).filter(F.col(USER).isNotNull() & F.col(TS).isNotNull())
    items = flatten_items(sold, [*UNIT, TS], _ITEM)
    value = safe_product("price", "quantity")
    return items.join(named, [*UNIT, TS]).selectExpr(
        _USER,
        "session_number",
        TS,
        _DATETIME,
        "event_name",
        _DATE,
        "page_location",
        *_ITEM,
        f"{value} AS item_value",
        f"CASE WHEN event_name = '{fixed.PURCHASE}' THEN {value} ELSE 0D END AS item_revenue",
    )
