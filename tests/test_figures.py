"""Figures that were worked out independently for the smallest test tables."""

from __future__ import annotations

import pytest
from conftest import SF_DIR

from pagetrail.plans import dimensions, events, sessions, staging
from pagetrail.plans.core import EventCore
from pagetrail.sources.testsite import testsite_export as site_export


@pytest.fixture(scope="module")
def core(spark):
    return EventCore(site_export(spark, SF_DIR))


def test_session_figures(core):
    held = sessions.sessions(core).collect()
    assert len(held) == 269
    assert sum(r["event_count"] > 1 for r in held) == 195
    assert max(r["event_count"] for r in held) == 14
    assert sum(r["session_start"] is not None and r["session_start"].date() != r["session_end"].date() for r in held) == 66


def test_page_figures(core):
    views = events.pageviews(core).collect()
    assert len(views) == 277
    assert sum(r["page_location"] is not None and r["page_key"] is None for r in views) == 57
    firsts = [r for r in views if r["pageview_index"] == 1]
    assert (sum(r["page_location"] is None for r in firsts), len(firsts)) == (16, 159)
    assert dimensions.dim_pages(core.raw).count() <= 50


def test_item_figures(core):
    items = staging.stg_items(core.raw).collect()
    assert len(items) == 1019
    assert sum(r["item_id"] is None for r in items) == 36
    assert sum(r["price"] is None for r in items) == 100
    sold = events.item_performance(core).collect()
    assert len(sold) == 1022
    assert sum(r["item_revenue"] or 0 for r in sold) == pytest.approx(826_779.00)


def test_late_events_are_missing_from_the_day(core):
    counted = sum(r["daily_events"] for r in sessions.daily_overview(core).collect())
    assert counted == 753  # ten of 1,000 events have no timestamp


def test_funnel_figures(core):
    reached = sessions.funnels(core).groupBy("step_order").count().collect()
    assert {r["step_order"]: r["count"] for r in reached} == {1: 114, 2: 61, 3: 72, 4: 133}
