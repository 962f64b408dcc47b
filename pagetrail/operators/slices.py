"""Sessions and positions by time slices, so that no user has to fit into one task.

A session ends where the whole minutes to the next event exceed the gap limit, that is at a gap of
at least ``gap + 1`` minutes. A slice of time no wider than that can never contain such a gap:
all events of one user in one slice belong to one session. So sessions are decided on one row per
(user, slice). These rows come from an aggregation with map-side combine, and their number per user
is bounded by the covered time span, not by the number of events. Work on single events only ever
groups by (user, slice).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import GAP_MINUTES
from ..functions.times import MICROS_PER_MINUTE, floor_to

#: Slice of rows without a timestamp. It comes before all others, as NULL does in the order of time.
NO_SLICE = -(2**62)


def gap_micros(gap_minutes: int = GAP_MINUTES) -> int:
    """Smallest gap that opens a new session: ``gap_minutes`` whole minutes are exceeded."""
    return (gap_minutes + 1) * MICROS_PER_MINUTE


def slice_width(gap_minutes: int = GAP_MINUTES, slice_minutes: int | None = None) -> int:
    """Width of a slice in microseconds, by default that of the smallest gap between sessions.

    A wider slice could hold several sessions of a user, so it is an error.
    """
    widest = gap_micros(gap_minutes)
    if slice_minutes is None:
        return widest
    if not 1 <= slice_minutes <= gap_minutes + 1:
        raise ValueError(f"slice_minutes has to be between 1 and {gap_minutes + 1}")
    return slice_minutes * MICROS_PER_MINUTE


def slice_start(ts: str, width: int) -> str:
    """SQL: start of the slice that holds the instant. Rows without an instant share a slice before
    all others, so that a join on slices keeps them."""
    return f"coalesce({floor_to(ts, width)}, {NO_SLICE})"


def user_key(user: str) -> str:
    """SQL: non-NULL form of a user id, so that events without a user can be joined too."""
    return f"coalesce('u' || {user}, 'n')"


def user_of(key: str) -> str:
    """SQL: the user id behind a key, NULL for events without a user."""
    return f"CASE WHEN {key} <> 'n' THEN substring({key}, 2) END"


def number_sessions(
    slices: DataFrame,
    user: str = "user_key",
    first: str = "first_ts",
    last: str = "last_ts",
    gap_minutes: int = GAP_MINUTES,
    events: str = "events",
) -> DataFrame:
    """Add session number, first and last instant to rows of one (user, slice) each.

    Each of a user's ``events`` without a timestamp opens a session, as nothing is known to come before
    it, and all of them bear the number that is reached with the last one.
    """
    in_order = f"OVER (PARTITION BY {user} ORDER BY {first})"
    in_session = f"OVER (PARTITION BY {user}, session_number)"
    opened = slices.selectExpr(
        "*",
        f"""CASE WHEN {first} IS NULL THEN {events}
                 WHEN {first} - lag({last}) {in_order} < {gap_micros(gap_minutes)}L THEN 0L
                 ELSE 1L END AS _opens""",
    )
    numbered = opened.selectExpr(*slices.columns, f"sum(_opens) {in_order} AS session_number")
    return numbered.selectExpr(
        "*",
        f"min({first}) {in_session} AS session_first",
        f"max({last}) {in_session} AS session_last",
    )


def count_before(amount: str, group: str, order: str) -> str:
    """SQL: total of ``amount`` in the rows of the group that come before this one."""
    return f"""coalesce(sum({amount}) OVER (PARTITION BY {group} ORDER BY {order}
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)"""


def sessionize(df: DataFrame, user: str, ts: str, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Add ``session_number, session_start, session_end`` (microseconds) to events.

    Events without a user are numbered as one user of their own. Events without a timestamp come first and
    share the number that is reached by opening a session with each of them.
    """
    keyed = df.selectExpr(
        "*", f"{user_key(user)} AS _key", f"{slice_start(ts, gap_micros(gap_minutes))} AS _slice"
    )
    slices = keyed.groupBy("_key", "_slice").agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("events")
    )
    numbered = number_sessions(slices, "_key", gap_minutes=gap_minutes).selectExpr(
        "_key", "_slice", "session_number", "session_first AS session_start", "session_last AS session_end"
    )
    return keyed.join(numbered, ["_key", "_slice"]).drop("_key", "_slice")


def index_in_group(
    df: DataFrame,
    group: Sequence[str],
    ts: str,
    ties: Sequence[str] = (),
    name: str = "index",
    width: int | None = None,
) -> DataFrame:
    """1-based position of each row in its group, ordered by ``ts`` and the tie-breakers.

    A group of any size is numbered slice by slice: a position inside the slice plus the number of
    rows in earlier slices. NULL in a group column is a value like any other.
    """
    order = ", ".join([ts, *ties])
    sliced = df.selectExpr(
        "*", f"struct({', '.join(group)}) AS _group", f"{slice_start(ts, width or gap_micros())} AS _slice"
    )
    sizes = sliced.groupBy("_group", "_slice").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.selectExpr("_group", "_slice", f"{count_before('_size', '_group', '_slice')} AS _before")
    placed = sliced.selectExpr("*", f"row_number() OVER (PARTITION BY _group, _slice ORDER BY {order}) AS _local")
    return placed.join(offsets, ["_group", "_slice"]).selectExpr(*df.columns, f"_local + _before AS {name}")


def follow(
    df: DataFrame,
    unit: Sequence[str],
    group: Sequence[str],
    unit_order: str,
    order: str,
    value: str,
    name: str,
) -> DataFrame:
    """Value of the next row of the group, NULL on its last row.

    ``unit`` names bounded pieces, each inside one group. Inside a unit the next row is a window
    lookup; the last row of a unit takes the first value of the group's next unit, its head.

    Heads and lookups need the same columns of ``df``, so that they read the same exchange by unit: that of ``df``,
    if it is dealt out by unit already. Its source is read and shuffled once. No unit or group column is NULL.
    """
    whole = list(dict.fromkeys([*unit, *group]))
    dealt = df.select(*whole, *[c for c in df.columns if c not in whole]).repartition(*unit)
    inside = f"OVER (PARTITION BY {', '.join(whole)} ORDER BY {order})"
    across = f"OVER (PARTITION BY {', '.join(group)} ORDER BY {unit_order})"
    heads = dealt.groupBy(*whole).agg(F.min(F.struct(order, value)).alias("_first"))
    nexts = heads.selectExpr(*unit, f"lead(_first.{value}) {across} AS _next")
    looked = dealt.selectExpr(
        "*", f"lead({order}) {inside} IS NULL AS _ends", f"lead({value}) {inside} AS _inside"
    )
    return looked.join(nexts, list(unit), "left").selectExpr(
        *df.columns, f"CASE WHEN _ends THEN _next ELSE _inside END AS {name}"
    )


def transitions(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    value: str,
    name: str = "next_value",
    width: int = 100_000,
) -> DataFrame:
    """Add the value of the group's next row. ``order`` is a unique integer position per group.

    NULL in a group column is a value like any other.
    """
    chunk = df.selectExpr(
        "*", f"struct({', '.join(group)}) AS _group", f"{floor_to(order, width)} AS _chunk"
    )
    followed = follow(chunk, ["_group", "_chunk"], ["_group"], "_chunk", order, value, name)
    return followed.drop("_group", "_chunk")
