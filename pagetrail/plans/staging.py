"""Event-level tables close to the export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.params import param_int
from ..operators.arrays import flatten_items, flatten_params
from ..operators.membership import WORDS, split_by_keys
from ..sources.schema import ITEM
from .core import TS, UNIT, USER, EventCore, keyed

EVENT = ["event_date", TS, "event_name", USER]
EXPORTED_SESSION = {"session_id": fixed.SESSION_ID, "session_number": fixed.SESSION_NUMBER}
#: Events that share values with others at their instant.
_SHARES = f"{USER} IS NOT NULL AND {TS} IS NOT NULL"


def stg_event_params(raw: DataFrame) -> DataFrame:
    """One row per event and parameter, its value as text."""
    return flatten_params(raw, EVENT)


def stg_items(raw: DataFrame) -> DataFrame:
    """One row per event and item."""
    return flatten_items(raw, EVENT, ITEM.names)


def stg_events(raw: DataFrame, filter_words: int = WORDS) -> DataFrame:
    """Events with the exported session id and number, the largest of the user's events at that instant.

    An event reads its own values inside the row. Only instants whose events differ in them need a
    look-up; a filter of those instants, of bounded size, tells which events are shuffled for it. The
    others stay where they are, arrays and all. Results do not depend on ``filter_words``.
    Events without a user or a time share nothing and have no values.
    """
    names = list(EXPORTED_SESSION)
    values = {name: param_int("event_params", key) for name, key in EXPORTED_SESSION.items()}
    own = raw.selectExpr(
        *EVENT, "event_params", "items", *[f"CASE WHEN {_SHARES} THEN {v} END AS {name}" for name, v in values.items()]
    )
    differ = " OR ".join(f"(count({c}) BETWEEN 1 AND count(1) - 1) OR min({c}) < max({c})" for c in names)
    mixed = (
        own.filter(_SHARES)
        .groupBy(USER, TS)
        .agg(*[F.max(c).alias(f"shared_{c}") for c in names], F.expr(f"coalesce({differ}, false) AS differ"))
        .filter("differ")
        .drop("differ")
    )
    possible, single = split_by_keys(own, mixed.select(USER, TS), [USER, TS], filter_words)
    # an instant let through in vain finds nothing, and its events agree: their own values stand
    shared = possible.join(mixed, [USER, TS], "left").select(
        *EVENT, "event_params", "items", *[F.coalesce(f"shared_{c}", c).alias(c) for c in names]
    )
    return single.unionByName(shared)


def stg_sessions(core: EventCore) -> DataFrame:
    """Events with their session number; events without a user are numbered as one user."""
    numbers = core.slices.select(*UNIT, "session_number")
    return keyed(core.bare, core.width).join(numbers, UNIT).select(
        USER, TS, "event_name", "event_date", "session_number"
    )
