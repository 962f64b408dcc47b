"""Session-, user-, page- and day-grain marts.

A mart of sessions adds up facts: rows of (user, slice, date, page), made where the events of a slice are. They meet
the slices' sessions, and are merged per session with a combine before the shuffle. So one very active
user, page or day stays small, and no mart here joins or sorts single events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.times import civil, instant, parse_day, second_steps, utc_day, whole_seconds
from ..operators.grouping import earliest, first_filled, funnel, latest, top1
from ..operators.slices import user_of
from .core import KEY, KNOWN, MET, SESSION, TRAFFIC, TS, UNIT, USER, EventCore, keyed

BOUNDS = ["session_first", "session_last"]

_USER = f"{user_of(KEY)} AS {USER}"
_START = f"{instant('session_first')} AS session_start"
_END = f"{instant('session_last')} AS session_end"
_PLACE = "named_struct('location', page_location, 'title', {0}.value.title, 'referrer', {0}.value.referrer)"
_ON_PAGE = "page_location IS NOT NULL AND {0} IS NOT NULL"


def _counted(name: str) -> str:
    """Events of facts, or of a slice whose events meet no session and have no facts."""
    return f"sum(CASE WHEN {MET} THEN {name} ELSE slice_{name} END)"


# Session measures: SQL aggregates over the slices with their facts.
MEASURES = {
    "first_view": earliest("first_view.at", _PLACE.format("first_view"), "first_view IS NOT NULL"),
    "last_view": latest("last_view.at", _PLACE.format("last_view"), "last_view IS NOT NULL"),
    "first_page": f"{earliest('first_view.at', 'page_location', _ON_PAGE.format('first_view'))}.value",
    "last_page": f"{latest('last_view.at', 'page_location', _ON_PAGE.format('last_view'))}.value",
    **{c: f"min({c}).value" for c in TRAFFIC},
    "total_events": _counted("events"),
    "total_pageviews": _counted("views"),
    "unique_pages_viewed": "count(DISTINCT page_location)",
    "purchase_events": _counted("purchases"),
    "session_revenue": "sum(revenue)",
    "sessions_per_user": "max(sessions_per_user)",
    "events_per_user": "max(events_per_user)",
}
# looked up by (user, session): NULL for the sessions of events that meet none
_ENGAGEMENT = [
    "total_events",
    "total_pageviews",
    "unique_pages_viewed",
    "sessions_per_user",
    "events_per_user",
]


def _aggregates(names: Sequence[str]) -> list[Column]:
    return [F.expr(f"{MEASURES[name]} AS {name}") for name in names]


def with_facts(core: EventCore) -> DataFrame:
    """Slices with their facts: a row for each of them, or one without any where no event meets a session.

    Slices come to the facts, which stay where their events are: by (user, slice), never by user.
    """
    own = ["events", "views", "purchases"]
    slices = core.slices.withColumnsRenamed({c: f"slice_{c}" for c in own}).repartition(*UNIT)
    return slices.join(core.facts, UNIT, "left")


def session_facts(core: EventCore, *names: str) -> DataFrame:
    """One row per session with the named measures. Sessions of events without a user or a timestamp are
    rows, too; ``met`` is false for them."""
    facts = with_facts(core).groupBy(*SESSION, *BOUNDS).agg(F.expr(f"max({MET}) AS met"), *_aggregates(names))
    return facts.selectExpr(
        *SESSION,
        *BOUNDS,
        "met",
        *[f"CASE WHEN met THEN {n} END AS {n}" if n in _ENGAGEMENT else n for n in names],
    )


def _view_columns(view: str, page: str) -> list[str]:
    return [
        f"{view}.value.location AS {page}",
        f"{view}.value.title AS {page}_title",
        f"{view}.value.referrer AS {page}_referrer",
        f"{civil(f'{view}.at')} AS {page.replace('_page', '_datetime')}",
    ]


def sessions(core: EventCore) -> DataFrame:
    """One row per session, straight from the slices."""
    rolled = core.slices.groupBy(*SESSION, *BOUNDS).agg(
        F.expr("sum(events) AS event_count"),
        F.expr("sum(engaged) AS engaged_event_count"),
        F.expr("min(first_date) AS first_date"),
    )
    return rolled.selectExpr(
        _USER,
        "session_number",
        _START,
        _END,
        f"{whole_seconds('session_first', 'session_last')} AS session_duration_seconds",
        "event_count",
        "engaged_event_count",
        f"{parse_day('first_date')} AS session_date",
    )


def funnels(
    core: EventCore, steps: Sequence[tuple[str, str, int]] = fixed.FUNNEL_STEPS
) -> DataFrame:
    """First time of each funnel step per session."""
    hits = keyed(core.bare, core.width).filter(
        F.col("event_name").isin(*{name for _, name, _ in steps}) & F.expr(MET)
    )
    numbered = hits.join(core.slices.select(*UNIT, "session_number"), UNIT)
    return funnel(numbered, steps, SESSION, "event_name", TS).selectExpr(
        _USER,
        "session_number",
        "step_name",
        "step_order",
        "step_timestamp",
        f"{civil('step_timestamp')} AS step_datetime",
    )


def landing_pages(core: EventCore) -> DataFrame:
    """Sessions with their first pageview, if any."""
    return session_facts(core, "first_view").selectExpr(
        _USER, "session_number", _START, _END, *_view_columns("first_view", "landing_page")
    )


def exit_pages(core: EventCore) -> DataFrame:
    """Sessions with their last pageview, if any."""
    return session_facts(core, "last_view").selectExpr(
        _USER, "session_number", _START, _END, *_view_columns("last_view", "exit_page")
    )


def traffic_sources(core: EventCore) -> DataFrame:
    """Sessions with the first source, medium and campaign seen, each on its own."""
    return session_facts(core, *TRAFFIC, "first_view").selectExpr(
        _USER, "session_number", _START, _END, *TRAFFIC, "first_view.value.location AS landing_page"
    )


def engagement(core: EventCore) -> DataFrame:
    """Event, pageview and page counts per session. A user's events without a timestamp are one row without a
    session, and so are all events without a user."""
    per_session = (
        with_facts(core)
        .withColumn("session_number", F.expr(f"CASE WHEN {MET} THEN session_number END"))
        .groupBy(*SESSION)
        .agg(*_aggregates([*_ENGAGEMENT, "first_page", "last_page"]))
    )
    return per_session.selectExpr(
        _USER,
        "session_number",
        "total_events",
        "total_pageviews",
        "unique_pages_viewed",
        "first_page AS landing_page",
        "last_page AS exit_page",
        f"CASE WHEN {KNOWN} THEN sessions_per_user END AS sessions_per_user",
        f"CASE WHEN {KNOWN} THEN events_per_user END AS events_per_user",
    )


def session_summary(core: EventCore) -> DataFrame:
    """Wide session row: landing, exit, engagement, traffic and revenue from one grouping."""
    facts = session_facts(
        core, "first_view", "last_view", *_ENGAGEMENT, *TRAFFIC, "session_revenue"
    )
    return facts.selectExpr(
        _USER,
        "session_number",
        _START,
        _END,
        *_view_columns("first_view", "landing_page"),
        *_view_columns("last_view", "exit_page"),
        *_ENGAGEMENT,
        *TRAFFIC,
        "session_revenue",
    )


def user_facts(core: EventCore) -> DataFrame:
    """One row per user: totals, first touch, most common pages, number of purchases.

    Sessions are brought together by user once. Two sessions of a user are at least a gap apart,
    so their number is bounded by the covered time span.
    """
    facts = session_facts(
        core,
        "first_view",
        "last_view",
        "total_events",
        "total_pageviews",
        "unique_pages_viewed",
        *TRAFFIC,
        "session_revenue",
        "purchase_events",
    )
    by_user = facts.repartition(KEY).selectExpr(
        "*",
        "first_view.value.location AS landing_page",
        "last_view.value.location AS exit_page",
        f"{second_steps('session_first', 'session_last')} AS seconds",
        f"count(1) OVER (PARTITION BY {KEY}, first_view.value.location) AS landings",
        f"count(1) OVER (PARTITION BY {KEY}, last_view.value.location) AS exits",
    )
    first_touch = [*TRAFFIC, "landing_page"]
    return by_user.groupBy(KEY).agg(
        F.expr("count(1) AS total_sessions"),
        F.expr("avg(seconds) AS avg_session_length_seconds"),
        F.expr("sum(total_events) AS total_events"),
        F.expr("sum(total_pageviews) AS total_pageviews"),
        F.expr("sum(unique_pages_viewed) AS total_unique_pages_viewed"),
        F.expr("sum(session_revenue) AS total_revenue"),
        F.expr("avg(session_revenue) AS avg_revenue_per_session"),
        *[F.expr(f"{first_filled('session_number', c, KNOWN)} AS first_{c}") for c in first_touch],
        F.expr(f"{top1('landings', 'landing_page', KNOWN)} AS most_common_landing_page"),
        F.expr(f"{top1('exits', 'exit_page', KNOWN)} AS most_common_exit_page"),
        F.expr("sum(purchase_events) AS purchase_events"),
    )


def user_summary(core: EventCore) -> DataFrame:
    """Wide user row."""
    facts = user_facts(core).drop("purchase_events")
    return facts.selectExpr(_USER, *facts.columns[1:])


def content_performance(core: EventCore) -> DataFrame:
    """Page and day: views, users, sessions, events and revenue.

    ``sessions`` counts distinct session numbers, which restart with each user. Pageviews without
    an address form one row per day that has no event or revenue figures. Distinct users and sessions
    are counted by grouping twice, from rows that hold a user's session at a page and day.
    """
    figures = {"total_events": "events", "add_to_cart_events": "carts", "purchases": "purchases", "total_revenue": "revenue"}
    at_page = ["page_location", "event_date"]
    sums = [F.expr(f"sum({c}) AS {c}") for c in ("views", *figures.values())]
    visits = (
        core.facts.join(core.slices.select(*UNIT, "session_number").repartition(*UNIT), UNIT)
        .withColumn("event_date", F.expr(parse_day("event_date")))
        .groupBy(*at_page, *SESSION)
        .agg(*sums)
    )
    # a visit counts once under its user, with its figures, and once under its session number, without
    listed = visits.selectExpr(
        *at_page,
        "views",
        *figures.values(),
        f"explode(array(struct({KEY} AS user, NULL AS number), struct(NULL AS user, session_number AS number))) AS of",
    ).selectExpr(
        *at_page, "of.*", "views > 0 AS seen", *[f"CASE WHEN of.user IS NOT NULL THEN {c} END AS {c}" for c in ("views", *figures.values())]
    )
    each = listed.groupBy(*at_page, "user", "number").agg(F.expr("max(seen) AS seen"), *sums)
    pages = each.groupBy(*at_page).agg(
        F.expr("sum(views) AS pageviews"),
        F.expr("count_if(seen AND user IS NOT NULL) AS unique_users"),
        F.expr("count_if(seen AND number IS NOT NULL) AS sessions"),
        *[F.expr(f"sum({c}) AS {name}") for name, c in figures.items()],
    )
    return pages.filter("pageviews > 0").selectExpr(
        *at_page,
        "pageviews",
        "unique_users",
        "sessions",
        *[f"CASE WHEN page_location IS NOT NULL THEN {name} END AS {name}" for name in figures],
    )


def daily_overview(core: EventCore) -> DataFrame:
    """Day of session start: users, sessions, events, pageviews, revenue, top page and source.

    Events and revenue count only where their own date is the day the session started. Totals and
    both rankings come from one pass: a session is listed under the day's total, under its landing
    page and under its source. Sessions of events without a timestamp have no day and form a row of their own.
    """
    day = utc_day("session_first")
    same_day = f"{parse_day('event_date')} = {day}"
    per_session = with_facts(core).groupBy(*SESSION, "session_first").agg(
        F.expr(f"coalesce(sum(CASE WHEN {same_day} THEN events END), 0L) AS events"),
        F.expr(f"coalesce(sum(CASE WHEN {same_day} THEN views END), 0L) AS views"),
        F.expr(f"sum(CASE WHEN {same_day} THEN revenue END) AS revenue"),
        *_aggregates(["first_view", "traffic_source"]),
    )
    listed = per_session.selectExpr(
        KEY,
        "events",
        "views",
        "revenue",
        f"{day} AS event_date",
        """stack(3, 'total', CAST(NULL AS STRING), 'landing', first_view.value.location,
                 'source', traffic_source) AS (facet, value)""",
    ).filter("facet = 'total' OR value IS NOT NULL")
    counted = listed.groupBy("event_date", "facet", "value").agg(
        F.expr("count(1) AS n"),
        F.expr(f"count(DISTINCT CASE WHEN facet = 'total' AND {KNOWN} THEN {KEY} END) AS users"),
        F.expr(f"count_if({KNOWN}) AS sessions"),
        F.expr("sum(events) AS events"),
        F.expr("sum(views) AS views"),
        F.expr("sum(revenue) AS revenue"),
    )

    def of_day(name: str) -> str:
        return f"max(CASE WHEN facet = 'total' THEN {name} END)"

    top_page = top1("n", "value", "facet = 'landing'")
    top_source = top1("n", "value", "facet = 'source'")

    return counted.groupBy("event_date").agg(
        F.expr(f"{of_day('users')} AS daily_active_users"),
        F.expr(f"{of_day('sessions')} AS daily_sessions"),
        F.expr(f"{of_day('events')} AS daily_events"),
        F.expr(f"{of_day('views')} AS daily_pageviews"),
        F.expr(f"coalesce({of_day('revenue')}, 0D) AS daily_revenue"),
        F.expr(f"{top_page} AS top_landing_page"),
        F.expr(f"{top_source} AS top_traffic_source"),
    )
