"""The exact join of the near-duplicate operator against brute force over all pairs."""

from __future__ import annotations

import random

import pytest

from pagetrail.llm import neardup


@pytest.fixture(scope="module")
def families():
    """(doc, text): families with few and with many edits, short, long and unrelated texts."""
    dice = random.Random(11)

    def words(n):
        return [f"w{dice.randrange(3000)}" for _ in range(n)]

    docs = []
    for length in (9, 40, 40, 150, 1500):
        origin = words(length)
        for _ in range(25):
            text = list(origin)
            for _ in range(dice.randrange(1 + length // 20)):
                text[dice.randrange(length)] = f"x{dice.randrange(10_000)}"
            cut = dice.randrange(1 + length // 6)
            docs.append((len(docs), " ".join(text[cut:] + words(dice.randrange(3)))))
    docs += [(len(docs) + i, " ".join(words(30))) for i in range(10)]
    return docs


def shingles(text):
    parts = text.split()
    return {tuple(parts[i : i + 5]) for i in range(max(1, len(parts) - 4))}


@pytest.fixture(scope="module")
def links(families):
    sets = {doc: shingles(text) for doc, text in families}
    return {
        (a, b) for a in sets for b in sets
        if a < b and 100 * len(sets[a] & sets[b]) >= neardup.SIMILAR * len(sets[a] | sets[b])
    }


def test_join_misses_no_similar_pair(spark, families, links):
    docs = spark.createDataFrame([(d, t, d) for d, t in families], "doc long, text string, component long")
    found = neardup.pairs_across(docs).collect()
    sets = {doc: shingles(text) for doc, text in families}
    assert links <= {(p.a, p.b) for p in found} and len(found) < 1.5 * len(links)
    for p in found:  # the share is a lower bound
        assert p.share <= len(sets[p.a] ^ sets[p.b]) / (len(sets[p.a]) + len(sets[p.b])) + 1e-12


def test_pairs_are_formed_at_their_rarest_shingle(spark, families, monkeypatch):
    docs = spark.createDataFrame([(d, t, d) for d, t in families], "doc long, text string, component long")
    formed = {}
    for front in (0, neardup.FRONT, 10_000):  # the last is longer than any prefix
        monkeypatch.setattr(neardup, "FRONT", front)
        formed[front] = sorted(map(tuple, neardup.pairs_formed(docs).collect()))
    none, some, whole = formed.values()
    assert set(none) == set(some) == set(whole)
    assert len(whole) == len(set(whole)) < len(some) < len(none)


def test_components_against_all_pairs(spark, families, links):
    label = {doc: doc for doc, _ in families}
    for _ in families:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    docs = spark.createDataFrame(families, "doc_id long, text string")
    found = {row.doc_id: row.component_id for row in neardup.near_duplicates(docs).collect()}
    assert found == label


def test_closest_and_between(spark):
    pairs = spark.createDataFrame([(1, 2, 0.1), (1, 3, 0.05), (2, 3, 0.2), (4, 5, 0.0)], "a long, b long, share double")
    assert sorted(map(tuple, neardup.closest(pairs).collect())) == [(1, 2), (1, 3), (4, 5)]
    labels = spark.createDataFrame([(1, 1), (3, 1), (4, 2)], "node long, component long")
    assert sorted(map(tuple, neardup.between(pairs, labels).collect())) == [(1, 2), (2, 3), (4, 5)]
    assert neardup.closest(pairs.limit(0)).count() == 0 and neardup.between(pairs.limit(0), labels).count() == 0
