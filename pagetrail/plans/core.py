"""The event core that all marts are made from.

``slices``   one row per (user, time slice) with its session: see ``operators.slices``.
``facts``    one row per (user, slice, date, page) with what happened there, as states that add up.
``moments``  one row per event of a session with the parameter values shared by all events of the user at
             that instant, its session and its position in the session.
``apart``    one row per event that meets no session, as it has no user or no timestamp, and its position.

Session, page and day marts add up facts, so no mart joins or sorts single events. Only marts of
single events read the moments. A core can be stored and read back, so that a full build makes it once.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.params import item_count, item_total, param_number, param_text, wanted_params
from ..functions.times import MICROS_PER_MINUTE, floor_to
from ..operators.grouping import earliest, latest
from ..operators.slices import (
    NO_SLICE,
    count_before,
    number_sessions,
    slice_start,
    slice_width,
    user_key,
    user_of,
)
from ..sources.export import save_table

USER = "user_pseudo_id"
TS = "event_timestamp"
KEY = "user_key"
UNIT = [KEY, "slice"]
SESSION = [KEY, "session_number"]

# conditions as SQL text
KNOWN = f"{KEY} <> 'n'"
#: Slices whose events meet a session: those of a known user at a known time.
MET = f"{KNOWN} AND slice <> {NO_SLICE}"
VIEW = f"event_name = '{fixed.PAGE_VIEW}'"
_IN_SESSION = f"{USER} IS NOT NULL AND {TS} IS NOT NULL"

_TEXTS = {
    "page_location": fixed.PAGE_LOCATION,
    "page_title": fixed.PAGE_TITLE,
    "page_referrer": fixed.PAGE_REFERRER,
    "traffic_source": fixed.SOURCE,
    "traffic_medium": fixed.MEDIUM,
    "traffic_campaign": fixed.CAMPAIGN,
}
_SHARED = [*_TEXTS, "percent_scrolled"]
TRAFFIC = ["traffic_source", "traffic_medium", "traffic_campaign"]
_PLACE = "named_struct('title', page_title, 'referrer', page_referrer)"

# Facts: SQL aggregates over events with shared values. Each can be merged over rows of facts.
FACTS = {
    "events": "count(1)",
    "views": f"count_if({VIEW})",
    "purchases": f"count_if(event_name = '{fixed.PURCHASE}')",
    "carts": f"count_if(event_name = '{fixed.ADD_TO_CART}')",
    "revenue": "sum(revenue)",
    "first_view": earliest(TS, _PLACE, VIEW),
    "last_view": latest(TS, _PLACE, VIEW),
    **{c: earliest(TS, c, f"{c} IS NOT NULL") for c in TRAFFIC},
}
#: Rows that one task makes from a count of equal events.
CHUNK = 100_000


class EventCore:
    """Lazy core over an export; its parts are planned on first use.

    Each mart computes only the columns it uses. ``bare`` is the export without its nested columns,
    for a source that gives that more cheaply than by column pruning. The parts can be given as stored
    tables.

    Slices are as wide as the session rule allows; ``slice_minutes`` makes them narrower. Single events are
    put in order within ``unit_minutes`` of one user, whatever the slices: a robot's events are
    many such units. Results depend on neither.
    """

    def __init__(
        self,
        raw: DataFrame,
        bare: DataFrame | None = None,
        slices: DataFrame | None = None,
        facts: DataFrame | None = None,
        moments: DataFrame | None = None,
        apart: DataFrame | None = None,
        gap_minutes: int = fixed.GAP_MINUTES,
        slice_minutes: int | None = None,
        unit_minutes: int = 1,
    ) -> None:
        self.raw = raw
        self.bare = raw if bare is None else bare
        self.gap_minutes = gap_minutes
        self.slice_minutes = slice_minutes
        self.unit_minutes = unit_minutes
        self.width = slice_width(gap_minutes, slice_minutes)
        self.unit_width = slice_width(gap_minutes, unit_minutes)
        self._slices = slices
        self._facts = facts
        self._moments = moments
        self._apart = apart

    @cached_property
    def slices(self) -> DataFrame:
        if self._slices is not None:
            return self._slices
        return build_slices(self.bare, self.gap_minutes, self.width)

    @cached_property
    def facts(self) -> DataFrame:
        return build_facts(self.raw, self.width) if self._facts is None else self._facts

    @cached_property
    def moments(self) -> DataFrame:
        if self._moments is not None:
            return self._moments
        units = build_slices(self.bare.filter(F.col(USER).isNotNull()), self.gap_minutes, self.unit_width)
        return build_moments(self.raw, units, self.unit_width)

    @cached_property
    def apart(self) -> DataFrame:
        return build_apart(self.bare) if self._apart is None else self._apart


def user() -> Column:
    return F.expr(f"{user_of(KEY)} AS {USER}")


def keyed(raw: DataFrame, width: int) -> DataFrame:
    """Add the non-NULL user key and the time slice."""
    return raw.selectExpr(
        "*", f"{user_key(USER)} AS {KEY}", f"{slice_start(TS, width)} AS slice"
    )


def build_slices(raw: DataFrame, gap_minutes: int, width: int) -> DataFrame:
    """(user, slice) rows with counts, session and what came before in the session.

    A user's events without a timestamp are a slice, too. Their session is counted with the slices,
    but no event meets it, so it is not one of ``sessions_per_user``.
    """
    counted = (
        keyed(raw, width)
        .groupBy(*UNIT)
        .agg(
            F.expr(f"min({TS}) AS first_ts"),
            F.expr(f"max({TS}) AS last_ts"),
            F.expr("count(1) AS events"),
            F.expr(f"count_if({VIEW}) AS views"),
            F.expr(f"count_if(event_name = '{fixed.USER_ENGAGEMENT}') AS engaged"),
            F.expr(f"count_if(event_name = '{fixed.PURCHASE}') AS purchases"),
            F.expr("min(event_date) AS first_date"),
        )
    )
    scope = f"{KEY}, session_number"
    return number_sessions(counted, KEY, gap_minutes=gap_minutes).selectExpr(
        "*",
        f"{count_before('events', scope, 'slice')} AS events_before",
        f"{count_before('views', scope, 'slice')} AS views_before",
        f"sum(views) OVER (PARTITION BY {scope}) AS session_views",
        f"""max(session_number) OVER (PARTITION BY {KEY})
            - sum(CASE WHEN slice = {NO_SLICE} THEN events ELSE 0L END) OVER (PARTITION BY {KEY}) AS sessions_per_user""",
        f"sum(events) OVER (PARTITION BY {KEY}) AS events_per_user",
    )


def _events(raw: DataFrame, width: int) -> DataFrame:
    """Events of known users at known times with their own values, dealt out by (user, slice).

    Parameters are read inside the row: only the values are shuffled.
    """
    wanted = wanted_params("event_params", [*_TEXTS.values(), fixed.PERCENT_SCROLLED])
    # items and the wanted parameters first, so that a scan reads no other item fields
    read = keyed(raw.filter(_IN_SESSION), width).selectExpr(
        *UNIT,
        TS,
        "event_date",
        "event_name",
        f"{wanted} AS params",
        f"{item_count('items')} AS item_rows",
        f"{item_total('items')} AS item_total",
    )
    values = {c: param_text("params", key) for c, key in _TEXTS.items()}
    values["percent_scrolled"] = param_number("params", fixed.PERCENT_SCROLLED)
    own = [c for c in read.columns if c != "params"]
    return read.selectExpr(*own, *[f"{value} AS {c}" for c, value in values.items()]).repartition(*UNIT)


def _with_shared(events: DataFrame) -> DataFrame:
    """Values of the instant in place of the event's own; ``sells``, if the row stands for its event name in
    the items at the instant, and ``revenue``.

    Items at an instant belong to each event name there once, on the name's earliest date.
    """
    own = [c for c in events.columns if c not in (*_SHARED, "item_rows", "item_total")]
    instant = f"OVER (PARTITION BY {KEY}, slice, {TS})"
    shared = events.selectExpr(
        *own,
        *[f"max({c}) {instant} AS {c}" for c in _SHARED],
        f"sum(item_rows) {instant} AS item_rows",
        f"sum(item_total) {instant} AS item_total",
    )
    per_name = f"PARTITION BY {KEY}, slice, {TS}, event_name ORDER BY event_date"
    sells = shared.selectExpr("*", f"item_rows > 0 AND row_number() OVER ({per_name}) = 1 AS sells")
    return sells.selectExpr(
        *own,
        *_SHARED,
        "sells",
        f"CASE WHEN sells THEN CASE WHEN event_name = '{fixed.PURCHASE}' THEN item_total ELSE 0D END END AS revenue",
    )


def build_facts(raw: DataFrame, width: int) -> DataFrame:
    """What happened in a (user, slice) on a date at a page. Grouping is local to the (user, slice)."""
    shared = _with_shared(_events(raw, width))
    return shared.groupBy(*UNIT, "event_date", "page_location").agg(
        *[F.expr(f"{aggregate} AS {name}") for name, aggregate in FACTS.items()]
    )


def build_moments(raw: DataFrame, units: DataFrame, width: int) -> DataFrame:
    """Events with session and positions. All work on them is local to a unit: the events of a user in
    a short slice of time. Positions go on with the counts of the units before.

    The units are never broadcast: Spark would guess their size from the compressed export, and the driver would
    hold one row for each minute of each user.
    """
    in_unit = f"PARTITION BY {KEY}, slice ORDER BY {TS}, event_date, event_name"
    # the row order serves the positions, and its prefix the instants: one sort for both
    placed = _events(raw, width).selectExpr(
        "*",
        f"row_number() OVER ({in_unit}) AS local_event",
        f"count_if({VIEW}) OVER ({in_unit} ROWS UNBOUNDED PRECEDING) AS local_view",
    )
    tags = ["session_number", "session_first", "session_last", "events_before", "views_before", "session_views"]
    tagged = _with_shared(placed).join(units.select(*UNIT, *tags).hint("merge"), UNIT)
    return tagged.selectExpr(
        *UNIT,
        TS,
        "event_date",
        "event_name",
        *_SHARED,
        "sells",
        "session_number",
        "session_first",
        "session_last",
        "local_event + events_before AS event_index",
        "local_view + views_before AS view_index",
        "session_views",
    )


def build_apart(raw: DataFrame) -> DataFrame:
    """Events without a user or without a timestamp, numbered per user.

    They share no values and meet no session, so equal ones need not be told apart: they are
    counted with map-side combine, and rows are made from the counts again. Positions come from counts
    per minute, then from counts within the minute. No window or task holds the events themselves, so
    all events may be of this kind.
    """
    rows = raw.filter(f"NOT ({_IN_SESSION})").selectExpr(
        f"{user_key(USER)} AS {KEY}", TS, f"{floor_to(TS, MICROS_PER_MINUTE)} AS minute", "event_date", "event_name"
    )
    same = [KEY, "minute", TS, "event_date", "event_name"]
    in_minute = f"OVER (PARTITION BY {KEY}, minute ORDER BY {TS}, event_date, event_name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    before = f"OVER (PARTITION BY {KEY} ORDER BY minute ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    counts = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n"))  # both of the next read its exchange
    counted = counts.selectExpr("*", f"coalesce(sum(n) {in_minute}, 0L) AS local")
    minutes = counts.groupBy(KEY, "minute").agg(F.sum("n").alias("n")).selectExpr(
        f"{KEY} AS its_key", "minute AS its_minute", f"coalesce(sum(n) {before}, 0L) AS earlier"
    )
    placed = counted.join(minutes, F.expr(f"{KEY} = its_key AND minute <=> its_minute"))
    chunks = placed.selectExpr(
        *same, "n", "local + earlier AS start", f"explode(sequence(0L, (n - 1) div {CHUNK})) AS chunk"
    ).repartition(*same, "chunk")
    size = f"least({CHUNK}L, n - chunk * {CHUNK})"
    return chunks.selectExpr(
        KEY, TS, "event_date", "event_name", "start", "chunk", f"explode(sequence(1L, {size})) AS place"
    ).selectExpr(KEY, TS, "event_date", "event_name", f"start + chunk * {CHUNK} + place AS event_index")


def store_core(core: EventCore, folder: str) -> EventCore:
    """Write the core below a shared folder and return it as read back."""
    slices = save_table(core.slices, f"{folder}/slices")
    facts = save_table(core.facts, f"{folder}/facts")
    moments = save_table(core.moments, f"{folder}/moments")
    apart = save_table(core.apart, f"{folder}/apart")
    return EventCore(
        core.raw, core.bare, slices, facts, moments, apart, core.gap_minutes, core.slice_minutes, core.unit_minutes
    )
