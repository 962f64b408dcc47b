"""Events without a timestamp or a user, rows with a NULL group, and keys that hold very many events."""

from __future__ import annotations

import random

import pytest
from conftest import MINUTE, SECOND, T0, item
from pyspark.sql import functions as F

from pagetrail.operators.slices import index_in_group, sessionize, slice_width, transitions
from pagetrail.plans import dimensions, events, reports, sessions, staging
from pagetrail.plans.core import EventCore


def rows(frame, *names):
    picked = frame.select(*names) if names else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture(scope="module")
def untimed(export):
    """User u: a pageview and a scroll without a timestamp, then a view at 1 s and a purchase 50 minutes later. User
    w: one event without a timestamp. One event has neither user nor time."""
    raw = export(
        ("u", -1, "page_view", {"page_location": "https://h/a"}, None, "20240102"),
        ("u", -1, "scroll", {"percent_scrolled": "90"}, [item("i", 1.0, 1)], "20240102"),
        ("u", SECOND, "page_view", {"page_location": "https://h/b", "source": "s"}, None, "20240102"),
        ("u", 50 * MINUTE, "purchase", None, [item("i", 3.0, 2)], "20240102"),
        ("w", -1, "purchase", {"page_location": "https://h/c"}, [item("i", 7.0, 1)], "20240102"),
        (None, -1, "page_view", {"page_location": "https://h/a"}, None, "20240102"),
        (None, 5, "page_view", {"page_location": "https://h/a"}, None, "20240102"),
    )
    return EventCore(raw.withColumn("event_timestamp", F.expr(f"if(event_timestamp < {T0}, NULL, event_timestamp)")))


def test_session_numbers_count_untimed_events(untimed):
    found = rows(staging.stg_sessions(untimed), "user_pseudo_id", "event_timestamp", "session_number")
    assert found == sorted(
        [
            ("u", None, 2),
            ("u", None, 2),
            ("u", T0 + SECOND, 3),
            ("u", T0 + 50 * MINUTE, 4),
            ("w", None, 1),
            (None, None, 1),
            (None, T0 + 5, 2),
        ],
        key=repr,
    )
    held = rows(sessions.sessions(untimed), "user_pseudo_id", "session_number", "event_count", "session_duration_seconds")
    assert held == sorted(
        [("u", 2, 2, None), ("u", 3, 1, 0), ("u", 4, 1, 0), ("w", 1, 1, None), (None, 1, 1, None), (None, 2, 1, 0)], key=repr
    )
    numbered = sessionize(untimed.raw, "user_pseudo_id", "event_timestamp")
    assert rows(numbered, "user_pseudo_id", "event_timestamp", "session_number") == found


def test_untimed_events_meet_no_session_and_no_page(untimed):
    found = rows(events.events(untimed), "user_pseudo_id", "event_name", "session_number", "event_index", "page_location", "session_start")
    untimed_rows = [r for r in found if r[2] is None]
    assert untimed_rows == sorted(
        [
            ("u", "page_view", None, 1, None, None),
            ("u", "scroll", None, 2, None, None),
            ("w", "purchase", None, 1, None, None),
            (None, "page_view", None, 1, None, None),
            (None, "page_view", None, 2, None, None),
        ],
        key=repr,
    )
    assert len(found) == 7
    assert rows(events.scroll_depth(untimed)) == [("u", None, None, None, "20240102", None, None)]
    assert rows(events.pageviews(untimed), "session_number", "page_location") == [(3, "https://h/b")]
    assert rows(events.user_journey(untimed), "session_number", "event_name") == [(3, "page_view"), (4, "purchase")]
    assert rows(sessions.funnels(untimed), "user_pseudo_id", "session_number") == [("u", 4)]
    assert rows(events.item_performance(untimed), "session_number", "item_value") == [(4, 6.0)]
    assert rows(staging.stg_events(untimed.raw), "user_pseudo_id").count(("u",)) == 4
    # the page dimension knows all parameters
    assert len(rows(dimensions.dim_pages(untimed.raw))) == 3


def test_marts_of_untimed_events(untimed):
    assert rows(sessions.engagement(untimed)) == sorted(
        [
            ("u", 3, 1, 1, 1, "https://h/b", "https://h/b", 2, 4),
            ("u", 4, 1, 0, 0, None, None, 2, 4),
            ("u", None, 2, 1, 0, None, None, 2, 4),
            ("w", None, 1, 0, 0, None, None, 0, 1),
            (None, None, 2, 2, 0, None, None, None, None),
        ],
        key=repr,
    )
    summary = rows(sessions.session_summary(untimed), "user_pseudo_id", "session_number", "total_events", "landing_page", "session_revenue")
    assert summary == sorted(
        [
            ("u", 2, None, None, None),
            ("u", 3, 1, "https://h/b", None),
            ("u", 4, 1, None, 6.0),
            ("w", 1, None, None, None),
            (None, 1, None, None, None),
            (None, 2, None, None, None),
        ],
        key=repr,
    )
    overview = rows(sessions.daily_overview(untimed), "event_date", "daily_active_users", "daily_sessions", "daily_events", "daily_revenue")
    assert [(str(d), *more) for d, *more in overview] == [("None", 2, 2, 0, 0.0), ("2024-01-02", 1, 2, 2, 6.0)]
    assert [str(d) for (d,) in rows(reports.daily_trend(untimed), "date")] == ["2024-01-02"]
    assert rows(reports.kpi_totals(untimed)) == [(6, 2, 1, 6.0)]
    users = rows(dimensions.dim_users(untimed), "user_pseudo_id", "first_session_number", "total_sessions", "total_session_duration_seconds")
    assert users == sorted([("u", 2, 3, 0), ("w", 1, 1, None), (None, 1, 2, 0)], key=repr)
    per_user = rows(sessions.user_summary(untimed), "user_pseudo_id", "total_sessions", "total_events", "first_landing_page")
    assert per_user == sorted([("u", 3, 2, "https://h/b"), ("w", 1, None, None), (None, 2, None, None)], key=repr)


def test_elapsed_seconds_count_boundaries(export):
    raw = export(("a", 900_000, "x"), ("a", 1_100_000, "x"))
    core = EventCore(raw)
    assert rows(sessions.sessions(core), "session_duration_seconds") == [(0,)]
    assert rows(sessions.user_summary(core), "avg_session_length_seconds") == [(1.0,)]


@pytest.fixture(scope="module")
def crowded(spark, export):
    """100,000 events without a user in one half hour, a tenth of them at one instant and a tenth without any, and
    20,000 of one user in ten minutes."""
    pick = random.Random(11)
    made = []
    for i in range(100_000):
        at = None if i % 10 == 0 else T0 if i % 10 == 1 else T0 + pick.randrange(30 * MINUTE)
        made.append(("20240102", at, pick.choice(["click", "page_view", "scroll"]), None))
    for _ in range(20_000):
        made.append(("20240102", T0 + pick.randrange(600) * SECOND, pick.choice(["click", "page_view"]), "robot"))
    raw = spark.createDataFrame(made, "event_date string, event_timestamp long, event_name string, user_pseudo_id string")
    empty = {c: F.lit(None).cast(export().schema[c].dataType) for c in ("event_params", "items")}
    return made, EventCore(raw.withColumns(empty).select(*export().columns))


def test_crowded_keys_are_numbered(crowded):
    made, core = crowded
    found = events.events(core).select("user_pseudo_id", "event_timestamp", "event_name", "event_index").collect()
    for user in (None, "robot"):
        own = sorted((at or 0, name) for _, at, name, u in made if u == user)
        expected = [(at, name, i) for i, (at, name) in enumerate(own, 1)]
        assert sorted((r[1] or 0, r[2], r[3]) for r in found if r[0] == user) == sorted(expected)
    views = events.pageviews(core).select("pageview_index").collect()
    assert sorted(r[0] for r in views) == list(range(1, len(views) + 1))


def test_null_groups_are_groups(spark):
    rows = spark.createDataFrame([("a", 1, "x"), (None, 1, "y"), (None, 2, "z")], "g string, t long, v string")
    indexed = index_in_group(rows, ["g"], "t").orderBy("v").collect()
    assert [r["index"] for r in indexed] == [1, 1, 2]
    followed = transitions(rows, ["g"], "t", "v", width=2).orderBy("v").collect()
    assert [r["next_value"] for r in followed] == [None, "z", None]


@pytest.mark.parametrize("minutes", [0, 32])
def test_slices_that_could_hold_two_sessions_are_refused(minutes):
    with pytest.raises(ValueError):
        slice_width(30, minutes)
