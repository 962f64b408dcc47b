"""Invariants, stored builds, sources and plans."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as registry
from pagetrail.plans import events, jobs, reports, sessions
from pagetrail.plans.core import EventCore, store_core
from pagetrail.sources.export import read_export, read_shards, save_table, write_export
from pagetrail.sources.files import current_run, load_table, names_in
from pagetrail.sources.testsite import TABLES
from pagetrail.sources.testsite import testsite_export as site_export


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """The test site as a stored export."""
    path = str(tmp_path_factory.mktemp("export"))
    write_export(site_export(spark, SF_DIR), path)
    return read_export(spark, path)


@pytest.fixture(scope="module")
def core(raw):
    return EventCore(raw)


@pytest.fixture(scope="module")
def stored(core, tmp_path_factory):
    return store_core(core, str(tmp_path_factory.mktemp("core")))


def bag(frame):
    rounded = [F.round(c, 6).alias(c) if t == "double" else c for c, t in frame.dtypes]
    return sorted(map(repr, frame.select(*rounded).collect()))


def test_export_round_trip_and_day_range(spark, raw, tmp_path):
    direct = site_export(spark, SF_DIR)
    assert bag(raw) == bag(direct)
    path = str(tmp_path / "export")
    write_export(direct, path)
    day = read_export(spark, path, "20240102", "20240103")
    assert {r[0] for r in day.select("event_date").distinct().collect()} == {"20240102", "20240103"}
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan)


def test_invariants(raw, stored):
    rows = events.events(stored)
    assert rows.count() == raw.count()
    assert rows.filter("(user_pseudo_id IS NULL OR event_timestamp IS NULL) <> (session_number IS NULL)").count() == 0
    held = sessions.sessions(stored)
    assert held.agg(F.sum("event_count")).first()[0] == raw.count()
    spans = sorted(
        (r["user_pseudo_id"], r["session_start"], r["session_end"])
        for r in held.filter("user_pseudo_id IS NOT NULL AND session_start IS NOT NULL").collect()
    )
    for before, after in zip(spans, spans[1:]):
        if before[0] == after[0]:
            assert (after[1] - before[2]).total_seconds() >= 31 * 60
    views = events.pageviews(stored).groupBy("user_pseudo_id", "session_number").agg(
        F.min("pageview_index").alias("low"), F.max("pageview_index").alias("high"), F.count("*").alias("n"),
        F.count_distinct("pageview_index").alias("d"),
    )
    assert views.filter("low <> 1 OR high <> n OR d <> n").count() == 0
    paths = events.user_journey_paths(stored)
    after = paths.selectExpr(
        "user_pseudo_id", "session_number", "pageview_index - 1 AS pageview_index", "from_page AS seen"
    )
    joined = paths.join(after, ["user_pseudo_id", "session_number", "pageview_index"], "left")
    assert joined.filter("NOT (to_page <=> seen)").count() == 0


@pytest.mark.parametrize("name", [n for n in jobs.MARTS if n != "dim_date"])
def test_stored_core_gives_the_same_marts(core, stored, name):
    assert bag(jobs.MARTS[name](stored)) == bag(jobs.MARTS[name](core))


@pytest.mark.parametrize("mart", [sessions.session_summary, events.user_journey_paths, reports.kpi_totals])
def test_result_does_not_depend_on_partitioning(spark, raw, mart):
    results = []
    for partitions in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        results.append(bag(mart(EventCore(raw.repartition(int(partitions))))))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


@pytest.mark.parametrize(
    "mart", [sessions.sessions, events.events, events.user_journey_paths, sessions.session_summary]
)
def test_result_does_not_depend_on_slice_width(raw, core, mart):
    assert bag(mart(EventCore(raw, slice_minutes=1, unit_minutes=31))) == bag(mart(core))


def test_build_and_views(spark, core, tmp_path):
    tables = jobs.build(core, str(tmp_path), ["fct_sessions", "fct_pageviews", *jobs.STORED])
    assert set(tables) == {"fct_sessions", "fct_pageviews", *jobs.STORED}
    assert bag(tables["fct_pageviews"]) == bag(events.pageviews(core))
    assert bag(jobs.read_mart(spark, str(tmp_path), "dim_pages")) == bag(tables["dim_pages"])
    jobs.register_views(core)
    counted = spark.sql("SELECT count(*) FROM fct_sessions JOIN dim_users USING (user_pseudo_id)").first()[0]
    assert counted == sessions.sessions(core).filter("user_pseudo_id IS NOT NULL").count()
    first = jobs.ordered("fct_sessions", sessions.sessions(core)).collect()
    assert first == sorted(first, key=lambda r: (r["user_pseudo_id"] or "", r["session_number"]))


def test_shards_outside_of_the_days_are_not_opened(spark, raw, tmp_path):
    events_of = {d: raw.filter(F.col("event_date") == d) for d in ("20240102", "20240103", "20240104")}
    events_of["20240102"].write.parquet(f"{tmp_path}/events_20240102")
    events_of["20240103"].write.parquet(f"{tmp_path}/events_intraday_20240103")
    events_of["20240104"].drop("event_date").write.parquet(f"{tmp_path}/events_20240104")
    for broken in ("events_20240101", "events_20240105", "pages_20240103", "events_2024010"):
        (tmp_path / broken).mkdir()
        (tmp_path / broken / "part-0.parquet").write_bytes(b"no parquet")
    found = read_shards(spark, str(tmp_path), "20240102", "20240104")
    expected = raw.filter("event_date BETWEEN '20240102' AND '20240104'")
    assert bag(found) == bag(expected) and found.count() > 0
    assert set(found.inputFiles()) and not any("0101" in f or "0105" in f for f in found.inputFiles())
    assert read_shards(spark, str(tmp_path), "20250101").count() == 0


def test_failed_rebuild_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        load_table(spark, path)
    first = save_table(spark.range(10), path)
    with pytest.raises(Exception):
        save_table(spark.range(10).selectExpr("raise_error('broken') AS id"), path)
    assert load_table(spark, path).count() == 10
    # a rebuild may read the table itself; its readers keep the run before
    second = save_table(load_table(spark, path).filter("id < 3"), path)
    assert (first.count(), second.count(), load_table(spark, path).count()) == (10, 3, 3)
    save_table(spark.range(5), path)
    assert len([n for n in names_in(spark, path) if n.startswith("run-")]) == 2
    assert load_table(spark, path).count() == 5 and second.count() == 3


def test_stored_marts_are_in_report_order(spark, core, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    jobs.build(core, str(tmp_path), ["fct_sessions"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    run = current_run(spark, f"{tmp_path}/fct_sessions")
    names = [n for n in names_in(spark, run) if n.endswith(".parquet")]
    rows = [(r["user_pseudo_id"] or "", r["session_number"]) for n in names for r in spark.read.parquet(f"{run}/{n}").collect()]
    assert len(names) > 1 and rows == sorted(rows) and len(rows) == sessions.sessions(core).count()


def test_shared_folder_comes_from_the_session(spark):
    class Session:
        def __init__(self, folder):
            self.conf = {"spark.checkpoint.dir": folder}

    assert jobs.shared_folder(Session("/shared/x/")) == "/shared/x"
    with pytest.raises(ValueError):
        jobs.shared_folder(Session(None))
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert jobs.shared_folder(spark) == named.rstrip("/")


def plan_of(spark, frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def bare_planning(spark):
    """Plans without broadcast joins and run-time changes, as for big tables."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_events_are_shuffled_once(spark, raw, bare_planning):
    """Beside the slices and the result only the (user, slice) exchange carries single events."""
    plan = plan_of(spark, sessions.landing_pages(EventCore(raw)))
    # events by (user, slice); slices: partial rows, by user, to the facts by (user, slice); sessions
    assert plan.count("Exchange hashpartitioning") == 5
    assert plan.count("REPARTITION_BY_COL") == 2
    assert len(re.findall(r"FileScan", plan)) == 2
    assert "event_params" in plan and "items" not in plan


def above(plan: str, marker: str) -> list[str]:
    """Operators of a plan that stand above the last one with the marker, on the way to the root."""
    lines = plan.splitlines()
    at = max(i for i, line in enumerate(lines) if marker in line)

    def depth(line):
        return len(re.match(r"[ :]*[+:]- |", line).group())

    found, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            level = depth(line)
            found.append(line)
    return found


@pytest.mark.parametrize(
    "mart",
    [
        sessions.session_summary,
        sessions.user_summary,
        sessions.daily_overview,
        sessions.landing_pages,
        sessions.engagement,
        sessions.traffic_sources,
    ],
)
def test_session_marts_join_facts_not_events(spark, raw, bare_planning, mart):
    """Between the exchange of single events and the first join they are grouped to facts."""
    path = above(plan_of(spark, mart(EventCore(raw))), "REPARTITION_BY_COL")
    joins = [i for i, line in enumerate(path) if "Join" in line]
    grouped = [i for i, line in enumerate(path) if "Aggregate(key=[user_key" in line and "page_location" in line]
    assert len(joins) == 1 and grouped and min(grouped) < joins[0]
    assert not any("Window" in line for line in path[min(grouped) : joins[0]])


def test_paths_shuffle_events_once(spark, raw):
    """Heads of units and the next page come from one exchange of single events and one of the units."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    paths = [events.user_journey_paths(EventCore(raw)), reports.page_type_transitions(EventCore(raw))]
    for frame in paths:
        frame.collect()
        final = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert len(re.findall("FileScan", final)) == 2  # events, and the units
        assert len(re.findall(r"Reused.*REPARTITION_BY_COL", final)) == 1
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_expand_and_no_whole_items(spark, raw, bare_planning):
    content = plan_of(spark, sessions.content_performance(EventCore(raw)))
    assert "Expand" not in content

    def item_fields(frame):
        found = re.findall(r"items:array<struct<([^>]*)>>", plan_of(spark, frame))
        return {len(fields.split(",")) for fields in found}

    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    assert item_fields(sessions.session_summary(EventCore(raw))) == {2}
    assert item_fields(jobs.MARTS["dim_items"](EventCore(raw))) == {9}
    assert item_fields(events.item_performance(EventCore(raw))) == {1, 10}  # how many there are, and those shown
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_events_without_session_are_counted_not_windowed(spark, raw, bare_planning):
    """Windows over events that meet no session hold counts; no window is over a (user, slice) of them."""
    plan = plan_of(spark, EventCore(raw).apart)
    windows = [line for line in plan.splitlines() if re.search(r"[+:]- .*Window \[", line)]
    assert len(windows) == 2 and all("sum(n" in line for line in windows)
    below = plan[plan.index(windows[0]) :]
    assert "partial_count(1)" in below


def test_slices_combine_before_the_shuffle(spark, raw, bare_planning):
    plan = plan_of(spark, EventCore(raw).slices.select("session_number", "session_first"))
    assert plan.count("Exchange") == 2
    assert "partial_min" in plan and "event_params" not in plan


def test_no_python_and_no_cross_join(spark, raw, bare_planning):
    for name, mart in jobs.MARTS.items():
        plan = plan_of(spark, mart(EventCore(raw)))
        for word in ("Python", "CartesianProduct", "BroadcastNestedLoop", "SinglePartition"):
            assert word not in plan, (name, word)


@pytest.fixture(scope="module")
def few(spark, tmp_path_factory):
    """Site tables of a few rows; one event, page and part have no id, one part is there twice."""
    at = datetime(2024, 1, 1)
    kinds = ["purchase", "view", "click", "signup", "error"]
    numbers = [None, *range(40)]
    rows = {
        "events": [(n, at + timedelta(minutes=i), i % 3, kinds[i % 5], 1.0, f'{{"k": {i}}}') for i, n in enumerate(numbers)],
        "pages": [(n, f"https://a.org/{n}") for n in (None, 0, 1, 2)],
        "part": [(n, f"n{n}", "b", "t", 1, 2.0) for n in (None, 0, 1, 2, 3, 3)],
    }
    folder = str(tmp_path_factory.mktemp("site"))
    for name, values in rows.items():
        spark.createDataFrame(values, TABLES[name].replace("timestamp_ntz", "timestamp")).selectExpr(
            *[f"cast({c} AS {kind}) AS {c}" for c, kind in (field.split() for field in TABLES[name].split(", "))]
        ).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_items_are_the_parts_of_the_event(spark, few):
    """Also with parts that are missing, repeated or without an id."""
    found = site_export(spark, few, params=False).filter("event_name = 'purchase'").select("items.item_name").collect()
    expected = [None]  # the event without an id
    for event in range(40):
        k, first = event + 1, event * 3 % 6
        if k % 5 == 0:
            parts = sorted((j, p) for p in (0, 1, 2, 3, 3) for j in range(3) if (p - j) % 6 == first)
            expected.append([f"n{p}" for _, p in parts[: 1 + k % 3]] or None)
    assert sorted(map(str, (r[0] for r in found))) == sorted(map(str, expected))


@pytest.mark.parametrize("name", ["content_performance", "daily_overview", "daily_trend", "dim_items", "item_performance"])
def test_grouped_parts_are_not_broadcast(spark, few, name):
    """However small the file of the parts is: the driver would hold all of them."""
    lines = plan_of(spark, registry.queries()[name](spark, few)).splitlines()
    grouped = [i for i, line in enumerate(lines) if " collect_list(" in line or "[collect_list(" in line]
    assert grouped
    for at in grouped:
        path = above("\n".join(lines[: at + 1]), "collect_list(")
        assert "SortMergeJoin" in next(line for line in path if "Join" in line)


@pytest.mark.parametrize("name", ["item_performance", "user_journey"])
def test_units_are_not_broadcast(spark, few, name):
    """However small the file of the events is: the driver would hold a row for each minute of each user."""
    lines = plan_of(spark, registry.queries()[name](spark, few)).splitlines()
    joins = [line for line in lines if re.search(r"Join \[user_key#\d+, slice#\d+L\]", line)]
    assert len(joins) == 1 and "SortMergeJoin" in joins[0]
