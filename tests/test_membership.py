"""Rows split by a filter of keys, and the look-ups that use it, against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from conftest import SF_DIR, param
from pyspark.sql import functions as F
from test_builds import above, plan_of

from pagetrail.operators.membership import split_by_keys
from pagetrail.plans import staging
from pagetrail.sources.testsite import testsite_export as site_export

NAMES = ["event_timestamp", "user_pseudo_id", "event_name", "session_id", "session_number"]


def counted(frame, *cols):
    return Counter(tuple(row) for row in frame.select(*cols).collect())


@pytest.mark.parametrize("words", [1, 3, 1 << 12])
def test_split_keeps_each_row_once(spark, words):
    rows = spark.range(4000).selectExpr("id % 1000 AS a", "CASE WHEN id % 7 > 0 THEN id % 7 END AS b", "id % 3 AS c")
    wanted = rows.filter("a < 20 OR b IS NULL AND a < 40").select("a", "b")
    first, second = split_by_keys(rows, wanted, ["a", "b"], words)
    assert counted(first, "a", "b", "c") + counted(second, "a", "b", "c") == counted(rows, "a", "b", "c")
    keys = set(counted(wanted, "a", "b"))
    assert not keys & set(counted(second, "a", "b"))
    if words > 1000:  # few others come along
        assert sum(n for key, n in counted(first, "a", "b").items() if key not in keys) < 40


def test_split_by_no_keys(spark):
    rows = spark.range(10)
    first, second = split_by_keys(rows, rows.limit(0), ["id"])
    assert first.count() == 0 and second.count() == 10
    first, second = split_by_keys(rows.limit(0), rows, ["id"])
    assert first.count() == 0 and second.count() == 0


@pytest.fixture(scope="module")
def random_events(export, spark):
    """Crowded instants, values that agree or differ, events without values, users, times or parameters."""
    dice = random.Random(5)
    events = []
    for n in range(600):
        user, at = dice.choice(["a", "b", "c", None]), dice.randrange(150)
        ids = [param("ga_session_id", None, dice.choice([at % 5, at % 5, 9]))] if dice.random() < 0.6 else []
        numbers = [param("ga_session_number", None, dice.choice([1, 1, None]))] if dice.random() < 0.5 else []
        events.append((user, at, f"e{n % 11}", dice.choice([None, [], ids + numbers, ids + numbers])))
    events += [("robot", 1, "x", [param("ga_session_id", None, n % 2)]) for n in range(300)]
    raw = export(*events)
    return raw.withColumn("event_timestamp", F.when(F.col("event_timestamp") % 13 != 0, F.col("event_timestamp")))


def by_hand(raw):
    own, best = [], {}
    for row in raw.collect():
        at = (row.user_pseudo_id, row.event_timestamp)
        for i, key in enumerate(("ga_session_id", "ga_session_number")):
            for given in row.event_params or []:
                if given.key == key and given.value.int_value is not None and None not in at:
                    best[at, i] = max(best.get((at, i), given.value.int_value), given.value.int_value)
        own.append((at, row.event_name))
    return Counter((at[1], at[0], name, best.get((at, 0)), best.get((at, 1))) for at, name in own)


@pytest.mark.parametrize("words", [1, 64, 1 << 19])
def test_exported_sessions_against_brute_force(random_events, words):
    staged = staging.stg_events(random_events, words)
    assert counted(staged, *NAMES) == by_hand(random_events)


def test_lone_events_are_not_shuffled(spark):
    """Only events of the filter's instants meet an exchange with their arrays."""
    raw = site_export(spark, SF_DIR, params=True, items=True)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(spark, staging.stg_events(raw))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    path = above(plan, "LeftAnti")
    assert path and not any("Exchange" in line or "Sort" in line for line in path)
    assert not re.search("LeftSemi.*SortMerge|SortMergeJoin.*Left(Semi|Anti)", plan)
