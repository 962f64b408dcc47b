"""Hand-written rows for each rule that is easy to get wrong."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import MINUTE, SECOND, T0, item, param

from pagetrail.plans import dimensions, events, reports, sessions, staging
from pagetrail.plans.core import EventCore


def rows(frame, *names):
    picked = frame.select(*names) if names else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def view(user, at, url=None, **params):
    given = {**({"page_location": url} if url else {}), **params}
    return (user, at, "page_view", given)


def test_gap_of_whole_minutes(export):
    second = 30 * MINUTE
    third = second + 31 * MINUTE - 1
    fourth = third + 31 * MINUTE
    raw = export(*[("a", at, "x") for at in (0, second, third, fourth)])
    numbers = rows(staging.stg_sessions(EventCore(raw)), "event_timestamp", "session_number")
    assert [n for _, n in numbers] == [1, 1, 1, 2]
    starts = rows(sessions.sessions(EventCore(raw)), "session_number", "event_count", "session_duration_seconds")
    assert starts == [(1, 3, 3659), (2, 1, 0)]


def test_other_gap_limit(export):
    raw = export(*[("a", at * MINUTE, "x") for at in (0, 10, 21, 32)])
    assert len(rows(sessions.sessions(EventCore(raw, gap_minutes=10)))) == 3
    assert len(rows(sessions.sessions(EventCore(raw, gap_minutes=5)))) == 4


def test_ties_share_a_session(export):
    raw = export(("a", 0, "x"), ("a", 40 * MINUTE, "x"), ("a", 40 * MINUTE, "y"))
    core = EventCore(raw)
    assert rows(staging.stg_sessions(core), "event_name", "session_number") == [("x", 1), ("x", 2), ("y", 2)]
    assert rows(events.events(core), "session_number", "event_index", "event_name") == [
        (1, 1, "x"),
        (2, 1, "x"),
        (2, 2, "y"),
    ]


def test_times_before_1970(export):
    raw = export(*[("a", -T0 + at, "x", None, None, "19700101") for at in (-MINUTE, MINUTE, -40 * MINUTE)])
    assert rows(staging.stg_sessions(EventCore(raw)), "event_timestamp", "session_number") == [
        (-40 * MINUTE, 1),
        (-MINUTE, 2),
        (MINUTE, 2),
    ]


def test_events_without_user(export):
    raw = export(
        view(None, 0, "https://h/a"),
        view(None, 50 * MINUTE, "https://h/b", source="s"),
        (None, 50 * MINUTE, "purchase", None, [item("i", 2.0, 1)]),
        view("a", 0, "https://h/a"),
    )
    core = EventCore(raw)
    assert rows(sessions.sessions(core), "user_pseudo_id", "session_number") == [("a", 1), (None, 1), (None, 2)]
    found = events.events(core).filter("user_pseudo_id IS NULL")
    assert rows(found, "event_index", "session_number", "page_location", "session_start") == [
        (1, None, None, None),
        (2, None, None, None),
        (3, None, None, None),
    ]
    assert rows(events.pageviews(core), "user_pseudo_id") == [("a",)]
    assert rows(events.user_journey(core), "user_pseudo_id") == [("a",)]
    assert rows(events.item_performance(core)) == []
    empty = sessions.session_summary(core).filter("user_pseudo_id IS NULL")
    assert rows(empty, "landing_page", "landing_datetime", "total_events", "traffic_source", "session_revenue") == [
        (None, None, None, None, None)
    ] * 2
    counted = sessions.engagement(core).filter("user_pseudo_id IS NULL")
    assert rows(counted) == [(None, None, 3, 2, 0, None, None, None, None)]
    assert rows(dimensions.dim_users(core), "user_pseudo_id", "total_sessions") == [("a", 1), (None, 2)]
    assert rows(sessions.user_summary(core), "user_pseudo_id", "total_sessions", "total_events") == [
        ("a", 1, 1),
        (None, 2, None),
    ]
    # pages seen without a user are part of the page dimension
    assert len(rows(dimensions.dim_pages(raw))) == 2


def test_missing_and_empty_parameters(export):
    raw = export(("a", 0, "x", None), ("a", 1, "x", []), ("a", 2, "x", {"page_location": "https://h/"}))
    assert rows(events.events(EventCore(raw)), "event_index", "page_location") == [
        (1, None),
        (2, None),
        (3, "https://h/"),
    ]
    assert rows(staging.stg_event_params(raw), "event_timestamp") == [(T0 + 2,)]


def test_parameter_precedence(export):
    raw = export(
        (
            "a",
            0,
            "x",
            [
                param("text", "t", 1),
                param("number", None, 1, None, 90.0),
                param("float", None, None, 90.0, 1.5),
                param("double", None, None, None, 12.5),
                param("none"),
            ],
        )
    )
    assert rows(staging.stg_event_params(raw), "param_name", "param_value") == [
        ("double", "12.5"),
        ("float", "90"),
        ("none", None),
        ("number", "1"),
        ("text", "t"),
    ]


def test_exported_session_is_shared_at_an_instant(export):
    raw = export(
        ("a", 0, "x", [param("ga_session_id", None, 7), param("ga_session_number", "9", None)]),
        ("a", 0, "y", [param("ga_session_id", None, 8), param("ga_session_number", None, 2)]),
        ("a", 1, "y", None),
        (None, 0, "y", [param("ga_session_id", None, 8)]),
    )
    assert rows(staging.stg_events(raw), "event_timestamp", "user_pseudo_id", "session_id", "session_number") == [
        (T0, "a", 8, 2),
        (T0, "a", 8, 2),
        (T0, None, None, None),
        (T0 + 1, "a", None, None),
    ]


def test_parameters_shared_at_an_instant(export):
    raw = export(view("a", 0, "https://h/a"), ("a", 0, "scroll", [param("percent_scrolled", None, 90)]))
    core = EventCore(raw)
    assert rows(events.events(core), "event_name", "page_location") == [
        ("page_view", "https://h/a"),
        ("scroll", "https://h/a"),
    ]
    assert rows(events.scroll_depth(core), "page_location", "percent_scrolled") == [("https://h/a", 90.0)]


def test_unreadable_scroll_depth(export):
    raw = export(("a", 0, "scroll", {"percent_scrolled": "n/a"}), ("a", 1, "scroll", {"percent_scrolled": "1d"}))
    assert rows(events.scroll_depth(EventCore(raw)), "percent_scrolled") == [(None,), (None,)]


def test_url_variants(export):
    urls = ["HTTPS://H/A?x=1", "https://h/a#f", "https://h/a"]
    raw = export(*[view("a", i, url) for i, url in enumerate(urls)])
    pages = rows(dimensions.dim_pages(raw), "page_location", "hostname", "page_path")
    assert pages == [("HTTPS://H/A?x=1", "h", "/a")]
    keys = dict(rows(events.pageviews(EventCore(raw)), "page_location", "page_key"))
    assert keys["HTTPS://H/A?x=1"] and keys["https://h/a"] is None and keys["https://h/a#f"] is None
    paths = rows(events.user_journey_paths(EventCore(raw)), "pageview_index", "from_page", "to_page", "to_page_key")
    key = keys["HTTPS://H/A?x=1"]
    assert paths == [
        (1, "https://h/a", "https://h/a", key),
        (2, "https://h/a", "https://h/a", key),
        (3, "https://h/a", None, None),
    ]


def test_urls_without_path_or_scheme(export):
    raw = export(view("a", 0, "https://h"), view("a", 1, "foo"), view("a", 2, "https://h/p?q=1\nx#y"))
    assert rows(dimensions.dim_pages(raw), "page_location", "hostname", "page_path") == [
        ("foo", None, None),
        ("https://h", "h", ""),
        ("https://h/p?q=1\nx#y", "h", "/p?q=1"),
    ]


def test_first_pageview_without_location(export):
    raw = export(view("a", 0), view("a", SECOND, "https://h/b"), view("a", 2 * SECOND))
    core = EventCore(raw)
    assert rows(sessions.landing_pages(core), "landing_page", "landing_datetime") == [
        (None, dt.datetime(2024, 1, 2))
    ]
    assert rows(sessions.exit_pages(core), "exit_page", "exit_datetime") == [(None, dt.datetime(2024, 1, 2, 0, 0, 2))]
    assert rows(sessions.engagement(core), "landing_page", "exit_page", "unique_pages_viewed") == [
        ("https://h/b", "https://h/b", 1)
    ]


def test_attribution_takes_each_first_value(export):
    raw = export(
        ("a", 0, "x", {"medium": "m1"}),
        ("a", 1, "x", {"source": "s2", "medium": "m2"}),
        ("a", 2, "x", {"source": "s3", "campaign": "c3"}),
        ("a", 60 * MINUTE, "x"),
    )
    assert rows(sessions.traffic_sources(EventCore(raw)), "traffic_source", "traffic_medium", "traffic_campaign") == [
        ("s2", "m1", "c3"),
        (None, None, None),
    ]


def test_items_belong_to_every_event_name_at_their_instant(export):
    raw = export(
        ("a", 0, "view_item", None, [item("i1", 10.0, 2)]),
        ("a", 0, "purchase", None, [item("i2", 5.0, 1)]),
        ("a", 1, "purchase", None, [item("i3", 1.0, 1)]),
        ("a", 1, "purchase", None, [item("i4", 2.0, 1)]),
    )
    core = EventCore(raw)
    assert rows(events.item_performance(core), "event_name", "item_id", "item_value", "item_revenue") == [
        ("purchase", "i1", 20.0, 20.0),
        ("purchase", "i2", 5.0, 5.0),
        ("purchase", "i3", 1.0, 1.0),
        ("purchase", "i4", 2.0, 2.0),
        ("view_item", "i1", 20.0, 0.0),
        ("view_item", "i2", 5.0, 0.0),
    ]
    assert rows(sessions.session_summary(core), "session_revenue") == [(28.0,)]
    assert rows(reports.kpi_totals(core), "total_revenue") == [(28.0,)]


def test_item_dates_at_an_instant(export):
    """An event name with two dates at one instant keeps its earliest one for items."""
    raw = export(
        ("a", 0, "purchase", {"page_location": "p"}, [item("i", 3.0, 1)], "20240103"),
        ("a", 0, "purchase", None, None, "20240102"),
        ("a", 0, "page_view", None, None, "20240103"),
    )
    core = EventCore(raw)
    day2, day3 = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    assert rows(events.item_performance(core), "event_name", "event_date") == [
        ("page_view", day3),
        ("purchase", day2),
    ]
    assert rows(
        sessions.content_performance(core), "event_date", "pageviews", "purchases", "total_events", "total_revenue"
    ) == [(day3, 1, 1, 2, 0.0)]
    # the session starts on the second day: what is dated the third is not counted
    assert rows(sessions.daily_overview(core), "event_date", "daily_events", "daily_revenue") == [(day2, 1, 3.0)]


@pytest.mark.parametrize("price, quantity", [(None, 1), (1e308, 100)])
def test_purchase_without_value(export, price, quantity):
    raw = export(("a", 0, "purchase", None, [item("i", price, quantity)]))
    core = EventCore(raw)
    assert rows(events.item_performance(core), "item_value", "item_revenue") == [(None, None)]
    assert rows(sessions.session_summary(core), "session_revenue") == [(None,)]
    assert rows(sessions.daily_overview(core), "daily_revenue") == [(0.0,)]


def test_sessions_without_items_have_no_revenue(export):
    raw = export(
        ("a", 0, "x"),
        ("a", 60 * MINUTE, "view_item", None, [item("i", 4.0, 1)]),
        ("a", 120 * MINUTE, "purchase", None, [item("i", 4.0, 1)]),
    )
    core = EventCore(raw)
    assert rows(sessions.session_summary(core), "session_number", "session_revenue") == [(1, None), (2, 0.0), (3, 4.0)]
    assert rows(sessions.user_summary(core), "total_revenue", "avg_revenue_per_session") == [(4.0, 2.0)]


def test_open_funnel(export):
    raw = export(("a", 0, "purchase"), ("b", 5, "view_item"), ("b", 9, "view_item"), ("b", 1, "purchase"))
    core = EventCore(raw)
    assert rows(sessions.funnels(core), "user_pseudo_id", "step_name", "step_order", "step_timestamp") == [
        ("a", "purchase", 4, T0),
        ("b", "purchase", 4, T0 + 1),
        ("b", "view_product", 1, T0 + 5),
    ]
    assert rows(reports.purchase_funnel(core)) == [
        (1, "view_product", 1, None, 1.0),
        (2, "add_to_cart", 0, 0.0, 0.0),
        (3, "begin_checkout", 0, None, 0.0),
        (4, "purchase", 2, None, 2.0),
    ]


def test_session_across_midnight(export):
    raw = export(view("a", -10 * MINUTE, "https://h/a"), view("a", 10 * MINUTE, "https://h/b"))
    overview = rows(sessions.daily_overview(EventCore(raw)))
    assert overview == [(dt.date(2024, 1, 1), 1, 1, 1, 1, 0.0, "https://h/a", None)]


def test_daily_rankings(export):
    raw = export(
        view("a", 0, "https://h/b", source="s2"),
        view("b", 0, "https://h/a", source="s1"),
        view("c", 0, "https://h/c", source="s2"),
        ("d", 0, "x"),
        (None, 0, "x"),
    )
    assert rows(sessions.daily_overview(EventCore(raw))) == [
        (dt.date(2024, 1, 2), 4, 4, 4, 3, 0.0, "https://h/a", "s2")
    ]


def test_content_counts_session_numbers(export):
    raw = export(view("a", 0, "https://h/a"), view("b", 0, "https://h/a"), ("c", 0, "scroll", {"page_location": "z"}))
    content = sessions.content_performance(EventCore(raw))
    assert rows(content, "page_location", "pageviews", "unique_users", "sessions", "total_events") == [
        ("https://h/a", 2, 2, 1, 2)
    ]


def test_content_without_location(export):
    raw = export(view("a", 0), ("a", 1, "purchase", None, [item("i", 1.0, 1)]))
    assert rows(sessions.content_performance(EventCore(raw))) == [
        (None, dt.date(2024, 1, 2), 1, 1, 1, None, None, None, None)
    ]


def test_most_common_page_may_be_missing(export):
    hour = 60 * MINUTE
    raw = export(view("a", 0), view("a", hour), view("a", 2 * hour, "https://h/a"), view("b", 0), view("b", hour, "u"))
    summary = sessions.user_summary(EventCore(raw))
    assert rows(summary, "user_pseudo_id", "most_common_landing_page", "first_landing_page") == [
        ("a", None, "https://h/a"),
        ("b", "u", "u"),
    ]


def test_repeated_identical_events(export):
    raw = export(*[view("a", 0, "https://h/a")] * 3, ("a", 0, "scroll"), ("a", 0, "scroll"))
    core = EventCore(raw)
    assert rows(events.pageviews(core), "pageview_index") == [(1,), (2,), (3,)]
    assert rows(events.events(core), "event_index") == [(1,), (2,), (3,), (4,), (5,)]
    assert len(rows(events.scroll_depth(core))) == 2


def test_long_session_is_numbered_through(export):
    """A session over many time slices: positions and next pages go on across them."""
    raw = export(*[view("a", i * 20 * MINUTE, f"https://h/{i:02d}") for i in range(30)])
    core = EventCore(raw)
    assert rows(sessions.sessions(core), "session_number", "event_count") == [(1, 30)]
    viewed = events.pageviews(core).select("pageview_index", "page_location").collect()
    assert sorted(map(tuple, viewed)) == [(i + 1, f"https://h/{i:02d}") for i in range(30)]
    paths = sorted(events.user_journey_paths(core).select("pageview_index", "from_page", "to_page").collect())
    expected = [
        (i + 1, f"https://h/{i:02d}", f"https://h/{i + 1:02d}" if i < 29 else None) for i in range(30)
    ]
    assert [tuple(p) for p in paths] == expected


def test_items_dimension(export):
    raw = export(
        ("a", 0, "x", None, [item("i", 2.0, 1, item_name="n"), item(None, 1.0, 1)]),
        ("a", 1, "x", None, [item("i", None, 1), item("i", 1.5, 1)]),
    )
    assert rows(dimensions.dim_items(raw), "item_id", "item_name", "item_brand", "default_price") == [
        ("i", "n", None, 1.5)
    ]
    assert len(rows(staging.stg_items(raw))) == 4


def test_calendar(spark, export):
    days = {r["date"]: r for r in dimensions.dim_date(spark).collect()}
    assert len(days) == 4018
    first, sunday, last = dt.date(2020, 1, 1), dt.date(2020, 1, 5), dt.date(2020, 12, 31)
    assert (days[first].week_of_year, days[sunday].week_of_year) == (0, 1)
    assert days[last].approx_year_end == dt.date(2020, 12, 30)
    assert (days[sunday].day_of_week, days[sunday].is_weekend, days[sunday].day_name) == (1, True, "Sunday")
    assert (days[last].year_quarter, days[last].quarter_end, days[last].month_end) == ("2020-Q4", last, last)
    # an export outside the standard range widens the calendar to whole years
    raw = export(("a", 0, "x", None, None, "20191231"), ("a", 1, "x", None, None, "20310101"))
    wide = [r["date"] for r in dimensions.dim_date_covering(raw).collect()]
    assert (min(wide), max(wide), len(wide)) == (dt.date(2019, 1, 1), dt.date(2031, 12, 31), 4018 + 365 + 365)


def test_purchasers_against_others(export):
    hour = 60 * MINUTE
    raw = export(
        view("a", 0, "p1"),
        view("a", hour, "p2"),
        ("a", hour + 10 * SECOND, "purchase"),
        view("b", 0, "p1"),
        ("c", 0, "x"),
    )
    compared = {r["metric"]: tuple(r)[1:] for r in reports.purchaser_comparison(EventCore(raw)).collect()}
    assert compared["users"] == (1.0, 2.0, 0.5)
    assert compared["user_share"][0] == pytest.approx(1 / 3)
    assert compared["avg_sessions"] == (2.0, 1.0, 2.0)
    assert compared["avg_session_length_seconds"] == (5.0, 0.0, None)
    assert compared["avg_pageviews"] == (2.0, 0.5, 4.0)
    assert compared["avg_unique_pages_viewed"] == (2.0, 0.5, 4.0)


def test_page_types_and_exits(export):
    urls = [
        "https://shop.example/",
        "https://shop.example/Apparel/Shirts?x=1",
        "https://shop.example/basket.html",
        "https://shop.example/yourinfo.html",
        "https://shop.example/wishlist",
        "https://shop.example/signin.html",
        "https://shop.example/asearch.html?q=1",
        "https://shop.example/privacy",
        "odd",
    ]
    raw = export(*[view("a", i * SECOND, url) for i, url in enumerate(urls)])
    core = EventCore(raw)
    typed = dict(rows(reports.page_types(core), "page_location", "page_type"))
    assert [typed[u] for u in urls] == [
        "Home",
        "Browse / Product",
        "Cart",
        "Checkout",
        "Wishlist",
        "Account",
        "Search",
        "Support / Policies",
        "Other",
    ]
    moves = rows(reports.page_type_transitions(core))
    assert ("Home", "Browse / Product", 1) in moves and len(moves) == 8
    exits = {t: (v, x, r) for t, v, x, r in rows(reports.exit_rate_by_page_type(core))}
    assert exits["Other"] == (1, 1, 1.0) and exits["Home"] == (1, 0, 0.0)


def test_source_labels(export):
    sources = ["(direct)", "<Other>", "(data deleted)", "", "google"]
    raw = export(*[(f"u{i}", 0, "x", {"source": s}) for i, s in enumerate(sources)], ("n", 0, "x"))
    core = EventCore(raw)
    assert rows(reports.source_labels(core), "traffic_source", "display_source") == [
        ("", "Unattributed"),
        ("(data deleted)", "Data deleted"),
        ("(direct)", "Direct"),
        ("<Other>", "Other"),
        ("google", "google"),
        (None, "Unattributed"),
    ]
    assert ("Unattributed", 2) in rows(reports.sessions_by_source(core))


def test_trend_by_month_and_top_pages(export):
    raw = export(
        view("a", 0, "https://h/a"),
        view("b", 0, "https://h/a"),
        view("c", 0, "https://h/b"),
        ("c", 1, "purchase", None, [item("i", 3.0, 2)]),
    )
    core = EventCore(raw)
    assert rows(reports.daily_trend(core, "year_quarter")) == [("2024-Q1", 3, 6.0)]
    assert rows(reports.sessions_by_landing_page(core, top=1)) == [("https://h/a", 2)]
