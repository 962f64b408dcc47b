"""Operators against brute force on small random data with one very active user."""

from __future__ import annotations

import random

import pytest
from conftest import MINUTE
from pyspark.sql import functions as F

from pagetrail.functions.numbers import double_text, safe_double
from pagetrail.operators import grouping, intervals, slices


@pytest.fixture(scope="module")
def visits():
    """(user, micros, name): a third of the rows belong to one user, a fifth to none."""
    pick = random.Random(7)
    found = []
    for _ in range(900):
        user = pick.choices(["hot", None, *"abcdefgh"], [33, 20, *[6] * 8])[0]
        at = pick.randrange(-5, 2000) * MINUTE + pick.choice([0, 0, 59_999_999, 1])
        found.append((user, at, pick.choice("xyz")))
    return found


def brute_sessions(visits, gap):
    numbers = {}
    for user in {u for u, _, _ in visits}:
        number, earlier = 0, None
        for at in sorted(t for u, t, _ in visits if u == user):
            if earlier is None or (at - earlier) // MINUTE > gap:
                number += 1
            numbers[user, at] = number
            earlier = at
    return numbers


@pytest.mark.parametrize("gap", [30, 5])
def test_sessionize(spark, visits, gap):
    frame = spark.createDataFrame(visits, "user string, at long, name string")
    expected = brute_sessions(visits, gap)
    found = slices.sessionize(frame, "user", "at", gap).collect()
    assert len(found) == len(visits)
    assert all(expected[r["user"], r["at"]] == r["session_number"] for r in found)
    spans = {}
    for (user, at), number in expected.items():
        low, high = spans.get((user, number), (at, at))
        spans[user, number] = (min(low, at), max(high, at))
    assert all(
        spans[r["user"], r["session_number"]] == (r["session_start"], r["session_end"]) for r in found
    )


def test_session_lookup_equals_interval_join(spark, visits):
    known = [v for v in visits if v[0]]
    frame = spark.createDataFrame(known, "user string, at long, name string")
    tagged = slices.sessionize(frame, "user", "at")
    spans = tagged.select("user", "session_number", "session_start", "session_end").distinct()
    joined = intervals.interval_join(frame, spans, "user", "at", "session_start", "session_end")
    columns = ["user", "at", "name", "session_number", "session_start", "session_end"]
    assert sorted(map(tuple, joined.select(columns).collect())) == sorted(
        map(tuple, tagged.select(columns).collect())
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join(spark, how):
    pick = random.Random(3)
    points = [(pick.choice(["hot", "hot", "a", "b", None]), pick.randrange(-300, 300)) for _ in range(200)]
    spans = []
    for i in range(60):
        start = pick.randrange(-300, 300)
        spans.append((pick.choice(["hot", "a", None]), i, start, start + pick.choice([-1, 0, 5, 90])))
    left = spark.createDataFrame(points, "k string, at long")
    right = spark.createDataFrame(spans, "k string, span int, low long, high long")
    found = intervals.interval_join(left, right, "k", "at", "low", "high", how, width=40)
    expected = []
    for key, at in points:
        hits = [s for s in spans if key is not None and s[0] == key and s[2] <= at <= s[3]]
        expected += [(key, at, *s[1:]) for s in hits]
        if how == "left" and not hits:
            expected.append((key, at, None, None, None))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_index_in_group(spark, visits):
    known = [v for v in visits if v[0]]
    frame = spark.createDataFrame(known, "user string, at long, name string")
    found = slices.index_in_group(frame, ["user"], "at", ["name"], "position", width=7 * MINUTE)
    expected = []
    for user in {u for u, _, _ in known}:
        mine = sorted((t, n) for u, t, n in known if u == user)
        expected += [(user, t, n, i) for i, (t, n) in enumerate(mine, 1)]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_transitions(spark):
    pick = random.Random(5)
    values = {g: [pick.choice(["p", "q", None]) for _ in range(n)] for g, n in [("hot", 50), ("a", 1), ("b", 7)]}
    rows = [(g, i, v) for g, vs in values.items() for i, v in enumerate(vs, 1)]
    frame = spark.createDataFrame(rows, "g string, i long, v string")
    found = slices.transitions(frame, ["g"], "i", "v", "after", width=4).collect()
    expected = [(g, i, v, values[g][i] if i < len(values[g]) else None) for g, i, v in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_first_last_and_mode(spark):
    rows = [
        ("a", 1, None, "n1"),
        ("a", 2, "x", "n2"),
        ("a", 3, "x", None),
        ("b", 1, None, "n4"),
        ("b", 2, None, "n5"),
        ("b", 3, "y", "n6"),
        ("c", 1, "z", "n7"),
        ("c", 2, "y", "n8"),
    ]
    frame = spark.createDataFrame(rows, "g string, i int, v string, n string")

    def got(result):
        return sorted(map(tuple, result.collect()))

    assert got(grouping.first_in_group(frame, ["g"], ["i"], ["v", "n"])) == [
        ("a", None, "n1"),
        ("b", None, "n4"),
        ("c", "z", "n7"),
    ]
    assert got(grouping.last_in_group(frame, ["g"], ["i"], ["n"])) == [("a", None), ("b", "n6"), ("c", "n8")]
    assert got(grouping.first_non_null(frame, ["g"], "i", ["v", "n"])) == [
        ("a", "x", "n1"),
        ("b", "y", "n4"),
        ("c", "z", "n7"),
    ]
    assert got(grouping.mode_per_group(frame, ["g"], "v", "m")) == [("a", "x"), ("b", None), ("c", "y")]
    assert got(grouping.top1_per_group(frame, ["g"], "i", "n", "t")) == [("a", None), ("b", "n6"), ("c", "n8")]


def test_number_text(spark):
    cases = {
        90.0: "90",
        12.5: "12.5",
        1e7: "10000000",
        123456789012345.0: "123456789012345",
        1e15: "1e+15",
        1234567890123456.0: "1234567890123456",
        1e20: "1e+20",
        1e100: "1e+100",
        0.0001: "0.0001",
        0.00015: "0.00015",
        1e-5: "1e-05",
        -2.5e-10: "-2.5e-10",
        0.0: "0",
        float("inf"): "inf",
        float("-inf"): "-inf",
    }
    frame = spark.createDataFrame([(x,) for x in cases], "x double")
    assert {r[0]: r[1] for r in frame.select("x", F.expr(double_text("x"))).collect()} == cases
    assert spark.range(1).select(F.expr(double_text("double('nan')"))).first()[0] == "nan"


def test_safe_double(spark):
    cases = {"90": 90.0, " 5 ": 5.0, "1e3": 1000.0, ".5": 0.5, "n/a": None, "1d": None, "0x1": None, "": None}
    frame = spark.createDataFrame([(x,) for x in cases], "x string")
    assert {r[0]: r[1] for r in frame.select("x", F.expr(safe_double("x"))).collect()} == cases
