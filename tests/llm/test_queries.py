"""The text queries against SQL or brute force on the smallest tables, and their operators on edge cases."""

from __future__ import annotations

import hashlib
import itertools
import re
import time
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import xxhash
from conftest import SF_DIR
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pagetrail.llm import fingerprints, html, lines, neardup, packing, pieces, quality, rules, sharding, substrings
from pagetrail.llm.registry import ORACLES, QUERIES
from tools.check import connect

WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{SF_DIR}/documents.parquet").to_pandas().sort_values("doc_id", ignore_index=True)


def rows(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    cells = frame[columns].astype(object)
    return sorted((tuple(None if pd.isna(v) else v for v in r) for r in cells.values.tolist()), key=str)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    expected = connect(SF_DIR).sql(ORACLES[name]).df()
    assert rows(QUERIES[name](spark, SF_DIR).toPandas()) == rows(expected)


def test_classifier_on_held_out_labels(spark):
    scored = QUERIES["op1_quality_classifier"](spark, "/root/testdata/sf0.01").toPandas()
    labels = pq.read_table("/root/testdata/sf0.01/labels.parquet").to_pandas()
    held = scored.merge(labels, on="doc_id").query("held_out")
    assert (held.predicted == held.quality).mean() > 0.93
    assert held[held.quality == 1].predicted.mean() > 0.95
    assert scored.score.between(0, 1).all()


def test_classifier_learns_one_text_of_an_id(spark, monkeypatch):
    texts = [(i, f"{'fine words' if i % 2 else 'x # x'} number {i} " * 5) for i in range(40)]
    repeated = texts + [(1, f"copy {k} of the first text") for k in range(300)] + [(2, None)] * 300
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    docs = [spark.createDataFrame(rows, "doc_id long, text string") for rows in (repeated, repeated[::-1])]
    learned: list[int] = []
    calibrate, dictionary = quality._calibrate, quality._dictionary
    monkeypatch.setattr(quality, "_calibrate", lambda x, *more: (learned.append(len(x)), calibrate(x, *more))[1])
    monkeypatch.setattr(quality, "_dictionary", lambda t: (learned.append(len(t)), dictionary(t))[1])
    one, two = (quality.train(d, labels, 10) for d in docs)
    assert learned == [5, 5, 10] * 2  # ten texts of each class, half for dictionaries
    assert one == two


def test_packing_holds_every_id_once(spark, docs):
    packed = QUERIES["op2_best_fit_packing"](spark, SF_DIR).toPandas().sort_values(["sequence_id", "offset"])
    per = packed.groupby("sequence_id").length
    assert per.sum().max() <= 2048
    assert (packed.offset == per.cumsum() - packed.length).all()
    tokenizer = Tokenizer.from_file(WORD_MODEL)
    lengths = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for t in docs.text]
    assert packed.groupby("doc_id").length.sum().tolist() == lengths
    assert packed.sequence_id.nunique() <= 1.02 * sum(lengths) / 2048 + 1


def test_plan_uses_all_pieces():
    counts = np.zeros(21, np.int64)
    counts[[20, 11, 9, 7, 5, 1]] = 3, 40, 37, 25, 60, 11
    uses = packing.plan(counts, 20, 50)
    used = np.zeros(21, np.int64)
    for use in uses:
        assert sum(l * n for l, n in use.items) <= 20
        for l, n in use.items:
            used[l] += n * use.count
    assert used.tolist() == counts.tolist()


def test_plan_prices_every_length():
    random, counts = np.random.default_rng(0), np.zeros(2049, np.int64)
    for _ in range(400):  # three pieces that fill a sequence, 200 times
        a = int(random.integers(720, 1000))
        b = int(random.integers(500, 1598 - a))
        counts[[a]] += 200
        counts[[b]] += 200
        counts[[2048 - a - b]] += 200
    solution, bound = packing.configurations(counts)
    assert {l for items in solution for l, _ in items} == set(np.flatnonzero(counts).tolist())
    assert 79_000 < bound <= 80_000.001  # 80,000 full sequences hold everything
    assert sum(u.count for u in packing.plan(counts)) <= 1.005 * 80_000
    best_fit = sum(u.count for u in packing._rounded(counts, {}, 0.0, 2048))
    assert sum(u.count for u in packing.plan(counts, rounds=1)) <= best_fit


def test_sketches_of_edited_texts(spark, docs):
    found = QUERIES["op3_scaled_sketch"](spark, SF_DIR).toPandas().sort_values("doc_id", ignore_index=True)
    following = docs.text.tolist()[1:] + docs.text.tolist()[:1]
    edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(docs.text, following)]
    assert found.n_chars.tolist() == [len(t) for t in docs.text]
    assert found.edited_sha256.tolist() == [hashlib.sha256(t.encode()).hexdigest() for t in edited]
    by_text = dict(zip(docs.text, found.fingerprint))
    assert all(by_text[t] == f for t, f in zip(docs.text, found.fingerprint))
    assert found.near_edited.between(0, 1).all()


def sketch_of(text: str) -> list[int]:
    """The sorted retained shingle hashes, signed as Spark has them."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    if not words:
        return []
    hashes = set()
    for i in range(max(len(words) - 4, 1)):
        h = 42
        for word in words[i : i + 5]:
            h = xxhash.xxh64_intdigest(word.encode(), h)
        hashes.add(h)
    signed = [h - 2**64 if h >= 2**63 else h for h in hashes]
    return sorted(h for h in hashes if h < 2**62) or [min(signed)]


def test_sketches_against_brute_force(spark, docs):
    found = QUERIES["op3_scaled_sketch"](spark, SF_DIR).toPandas().sort_values("doc_id", ignore_index=True)
    following = docs.text.tolist()[1:] + docs.text.tolist()[:1]
    edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(docs.text, following)]
    own, changed = [sketch_of(t) for t in docs.text], [sketch_of(t) for t in edited]

    def digits(sketch):
        return "".join(f"{h % 2**64:016X}" for h in sketch)

    def contained(a, b):
        least = min(len(a), len(b))
        return len({*a} & {*b}) / least if least else float(not a and not b)

    assert found.doc_id.tolist() == docs.doc_id.tolist()
    assert found.fingerprint.tolist() == [digits(x) for x in own]
    assert found.edited_fingerprint.tolist() == [digits(x) for x in changed]
    assert found.near_edited.tolist() == pytest.approx([contained(a, b) for a, b in zip(own, changed)])
    assert found.near_next.tolist() == pytest.approx([contained(a, b) for a, b in zip(own, own[1:] + own[:1])])


def test_sampled_pieces_are_lossless_and_repeatable(spark, docs):
    given = spark.createDataFrame(
        [(1, "a▁b  \n\n é日本\x00 x"), (2, ""), (3, None), (None, "the"), (1, "a▁b  \n\n é日本\x00 x"), (5, "y" * 5000)],
        "doc_id long, text string",
    )
    ids = pieces.encode(given, PIECE_MODEL)
    back = pieces.decode(ids, PIECE_MODEL).toPandas()
    assert sorted(back.text) == sorted(["a▁b  \n\n é日本\x00 x"] * 2 + ["", "", "the", "y" * 5000])
    one, two = (sorted(map(str, ids.repartition(k).collect())) for k in (1, 3))
    assert one == two
    found = QUERIES["op4_sampled_pieces"](spark, SF_DIR).toPandas().sort_values("doc_id")
    assert found.text_sha256.tolist() == [hashlib.sha256(t.encode()).hexdigest() for t in docs.text]


def test_piece_lattice_against_all_segmentations():
    lattices = pieces.Lattices(PIECE_MODEL)

    def segmentations(text):
        if not text:
            yield (), 1.0
        for k in range(1, len(text) + 1):
            if text[:k] in lattices.piece:
                number, weight = lattices.piece[text[:k]]
                for rest, p in segmentations(text[k:]):
                    yield (number, *rest), weight * p

    exact = dict(segmentations(" then"))
    ids, edges = lattices.sample(["then"] * 8000, np.arange(8000, dtype=np.uint64))
    drawn = [tuple(ids[a:b].tolist()) for a, b in itertools.pairwise(edges)]
    for s, p in exact.items():
        assert abs(drawn.count(s) / 8000 - p / sum(exact.values())) < 0.03


def drawn_by_hand(lattices: pieces.Lattices, text: str, seed: int) -> list[int]:
    """One segmentation, place by place, with the random numbers that a text of this seed has."""

    def mixed(x: int) -> int:
        return int(pieces.mix(np.array([x % 2**64], np.uint64))[0])

    ids = []
    for nth, unit in enumerate(pieces._UNIT.findall(" " + text) if text else []):
        ways: list[list[tuple[float, int, list[int]]]] = [[]]
        reach = [1.0]
        for end in range(1, len(unit) + 1):
            arcs = []
            if unit[end - 1] not in lattices.piece:
                raw = unit[end - 1].encode()
                arcs.append((lattices.least ** len(raw) * reach[end - 1], 1, [lattices.byte[b] for b in raw]))
            for k in range(1, min(end, lattices.longest) + 1):
                if unit[end - k : end] in lattices.piece:
                    number, weight = lattices.piece[unit[end - k : end]]
                    arcs.append((weight * reach[end - k], k, [number]))
            ways.append(arcs)
            reach.append(sum(w for w, _, _ in arcs))
        unit_seed, place, step, parts = mixed(seed ^ mixed(nth + 1)), len(unit), 0, []
        while place:
            step += 1
            u = (mixed(unit_seed + step) >> 11) * 2.0**-53 * reach[place]
            for w, k, found in ways[place]:
                if u < w:
                    break
                u -= w
            parts.append(found)
            place -= k
        ids += [i for part in reversed(parts) for i in part]
    return ids


def test_sampled_pieces_against_brute_force(spark, docs):
    lattices = pieces.Lattices(PIECE_MODEL)
    texts = [t[:600] for t in docs.text[:40]] + ["日本語の文章です。" * 40, "a" * 700, "é\x00\r\n\n  ☃", "", " "]
    seeds = pieces.mix(np.arange(len(texts), dtype=np.uint64))
    expected = [drawn_by_hand(lattices, t, int(s)) for t, s in zip(texts, seeds)]
    for size in (len(texts), 7, 1):  # what is known from earlier texts changes nothing
        for a in range(0, len(texts), size):
            ids, edges = lattices.sample(texts[a : a + size], seeds[a : a + size])
            assert [ids[x:y].tolist() for x, y in itertools.pairwise(edges)] == expected[a : a + size]
    monkey = pieces.KEPT_ARCS
    pieces.KEPT_ARCS = 0
    again, _ = lattices.sample(texts, seeds)
    pieces.KEPT_ARCS = monkey
    assert again.tolist() == [i for one in expected for i in one]


def test_sampled_pieces_query_against_its_operator(spark, docs):
    found = QUERIES["op4_sampled_pieces"](spark, SF_DIR).toPandas().sort_values("doc_id")
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    lists = {r["id"]: r["ids"] for r in pieces.encode(given, PIECE_MODEL).collect()}
    assert found.n_ids.tolist() == [len(lists[d]) for d in found.doc_id]
    assert found.ids_crc32.tolist() == [zlib.crc32(np.array(lists[d], "<u4").tobytes()) for d in found.doc_id]
    assert pieces.digests(given.where("false"), PIECE_MODEL).collect() == []


def test_long_units_cost_as_much_as_others():
    lattices = pieces.Lattices(PIECE_MODEL)
    began = time.process_time()
    ids, _ = lattices.sample(["日本語の文章を長く続ける" * 8000], np.zeros(1, np.uint64))
    assert time.process_time() - began < 3 and lattices.decode(ids).decode() == "日本語の文章を長く続ける" * 8000


def test_every_piece_can_be_drawn(monkeypatch):
    lattices = pieces.Lattices(PIECE_MODEL)
    across = [".”", " ».", "”,", " (“", "².", " […]", ");\r", " }\r", "\r\r"]  # punctuation of both kinds, line ends
    for text in across:
        ids, edges = lattices.sample([text.removeprefix(" ") if text[0] == " " else f"x{text}"] * 2000, np.arange(2000, dtype=np.uint64))
        assert lattices.piece[text][0] in ids.tolist()
        assert all(lattices.decode(ids[a:b]).decode().endswith(text.lstrip(" ")) for a, b in itertools.pairwise(edges))
    monkeypatch.setattr(pieces, "_UNIT", pieces.re.compile(r"\n| *[^\W]+| *[^\w \n”]+| *[^ \n]| +"))
    with pytest.raises(ValueError, match="crosses units"):
        pieces.Lattices(PIECE_MODEL)


def test_page_text():
    page = (
        "<title>t</title><p>one<p>two <b>bo</b>ld &amp; x<ul><li>a<li>b<ol><li>x<li>y</ol></ul>"
        "<table><tr><th>k<th>value<tr><td>long<td>v</table><div hidden>no</div>end<br>next<script>no</script>"
    )
    expected = "one\n\ntwo bold & x\n\n- a\n- b\n  1. x\n  2. y\n\nk     value\nlong  v\n\nend\nnext"
    assert html.page_text(page) == expected
    for odd in ("", "<", "</p></div>", "<div>" * 5000 + "deep", "<table><td>a", "<!-- open", "<p style='display:none'>x"):
        html.page_text(odd)


@pytest.mark.parametrize(
    "page, expected",
    [
        ("a<table><form><tr><td>x<td>y</tr></form></table>b", "a\n\nx  y\n\nb"),
        ("<table><tr><form><td>x</td><td>y</td></form></tr></table>", "x  y"),
        ("<table><div>text</div><tr><td>1</table>", "text\n\n1"),
        ("<table><tr><b>text</b><td>c</table>", "text\n\nc"),
        ("<table><tr><b>open<td>c<td>d</table>", "open\n\nc  d"),
        ("<table><tr>bare<td>c</tr><tbody>more<tr><td>d</table>", "baremore\n\nc\nd"),
        ("<table><colgroup><col>x<td>c</table>", "x\n\nc"),
        ("<table><tr><td>a<table>in<tr><td>b</table></table>", "ain b"),
        ("<table><tr><table><tr><td>b</table>c", "b\n\nc"),
        ("<tr>no table<td>cell", "no tablecell"),
    ],
)
def test_page_text_keeps_what_strays_in_tables(page, expected):
    assert html.page_text(page) == expected


@pytest.mark.parametrize(
    "page, expected",
    [
        ("<p class=x'>one don't</p>two", "one don't\n\ntwo"),
        ("<p class=x\">one</p><a href = 'a>b' title=\"c>d\">two</a>", "one\n\ntwo"),
        ("a<!-->b<!-- x -->c<!--->d<!-- y --!>e", "abcde"),
        ("<head><title>t</title>hello <em>w</em></head><p>x", "hello w\n\nx"),
        ("<head><meta charset=utf-8><em>w</em><p>x", "w\n\nx"),
        ("<body>a<head>b</head>c", "abc"),
        ("<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math>", "x=1"),
        ("<svg><title>no</title><defs><text>no</text></defs><g><text>one</text><text>two</text></g></svg>", "one two"),
        ("<desc>seen</desc><input type=Submit value='Go &amp; on'><input value=no>", "seen Go & on"),
    ],
)
def test_page_text_of_malformed_and_unusual_pages(page, expected):
    assert html.page_text(page) == expected


@pytest.mark.parametrize("start", ["²", "5" * 5000, "-3", "", "07x", "٣"])
def test_odd_list_starts_begin_at_one(start):
    assert html.page_text(f"<ol start='{start}'><li>a</ol>") == "1. a"
    assert html.page_text("<ol start=41><li>a<li>b</ol>") == "41. a\n42. b"


def test_text_of_a_page_is_linear_in_the_page():
    wide = "<table><tr><td>" + "x" * 100_000 + "<td>b</tr>" + "<tr><td>a<td>b</tr>" * 2000 + "</table>"
    assert len(html.page_text(wide)) < 2 * len(wide)
    deep = "<blockquote>x" * 5000
    assert len(html.page_text(deep)) < 10 * len(deep)
    assert html.page_text("<cell>a</cell>b") == "ab"


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 20_000 + "end",
        "<div><ul><li>x" * 7000,
        "<span>" * 10_000 + "<p>y" * 10_000,
        "<div>" * 5000 + "<td>z" * 15_000,
        "<table><tr><td>" * 400 + "a",
        "<table>" + "<tr><td>c" * 10_000,
        "<blockquote>q" * 20_000,
        "</p>" * 20_000,
    ],
)
def test_deep_pages_take_no_longer_than_others(page):
    began = time.process_time()
    html.page_text(page)
    assert time.process_time() - began < 1


def test_pages_through_spark(spark):
    given = [(1, "<p>a", "x"), (2, None, None), (3, "", "z"), (None, "<table><td>b", ""), (1, "<p>a", "x")]
    pages = spark.createDataFrame(given, "page_id long, html string, url string")
    clashing = pages.selectExpr("*", "1 as __html", "'old' as text", "2 as kept", "3 as `a.b`", "4 as `c``d`")
    found = html.extract_text(clashing)
    assert found.columns == ["page_id", "url", "__html", "kept", "a.b", "c`d", "text"]
    expected = [(1, "x", 1, 2, 3, 4, "a"), (2, None, 1, 2, 3, 4, None), (3, "z", 1, 2, 3, 4, ""), (None, "", 1, 2, 3, 4, "b"), (1, "x", 1, 2, 3, 4, "a")]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert html.extract_text(clashing.where("false")).collect() == []
    assert sorted(str(r[0]) for r in html.extract_text(pages.select("html")).collect()) == ["", "None", "a", "a", "b"]


def test_page_query_keeps_every_page(spark):
    found = QUERIES["op5_html_text"](spark, SF_DIR).toPandas()
    assert len(found) == pq.read_table(f"{SF_DIR}/pages.parquet").num_rows
    assert not found.text.str.contains("<p>|<script", regex=True).any()


PASSAGE = " ".join(f"w{i}" for i in range(60))
EDGES = [
    (1, f"start {PASSAGE} end", "a", "en"),
    (2, f"other {PASSAGE} tail", "a", None),
    (2, f"other {PASSAGE} tail", "a", None),
    (3, None, None, "en"),
    (4, "", "b", "en"),
    (None, f"x {PASSAGE}", None, None),
    (None, "two words", None, None),
    (7, "two words", "b", "de"),
    (8, "z " * 30_000, "b", "de"),
]
SCHEMA = "doc_id long, text string, source string, lang string"


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA).selectExpr("*", "1 as score", "2 as n_lines", "3 as shard", "4 as n_words")


@pytest.mark.parametrize("empty", [False, True])
def test_operators_keep_rows_of_edge_cases(spark, edges, empty):
    given = edges.where("false") if empty else edges
    n = 0 if empty else len(EDGES)
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(given, labels)
    assert quality.score(given, model).count() == n
    assert lines.line_dedup(given).count() == n
    assert neardup.near_duplicates(given).count() == n
    assert substrings.substring_dedup(given).count() == n
    assert rules.quality_rules(given).count() == n
    assert sharding.stratified_shards(given).count() == n
    assert fingerprints.fingerprint_documents(given).count() == n
    assert packing.token_pieces(given, WORD_MODEL).select("doc_id", "piece").where("piece = 0").count() == n
    packed = packing.pack_documents(given, WORD_MODEL).toPandas()
    assert packed.duplicated(["sequence_id", "offset"]).sum() == 0


def test_other_columns_may_have_any_names(spark):
    line = "A line that is long enough to be counted as common."
    rows = [(i, f"{line}\n{PASSAGE}\nown {i}") for i in range(6)] + [(None, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    names = ["__text", "__key", "__doc", "__lines", "__version", "__spans", "a.b", "c`d", "c0", "doc", "n_dropped", "n_removed", "score"]
    odd = docs.select("*", *[F.col("doc_id").cast("string").alias(n) for n in names])
    kept = [n for n in names if n not in ("n_dropped", "n_removed", "score")]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    for work, new in (
        (lines.line_dedup, ["n_lines", "n_dropped"]),
        (substrings.substring_dedup, ["n_words", "n_removed"]),
        (lambda d: quality.score(d, model), ["score"]),
    ):
        plain, found = work(docs).collect(), work(odd).collect()
        own = ["doc_id", "text", *new]
        assert sorted(str([r[c] for c in own]) for r in found) == sorted(str([r[c] for c in own]) for r in plain)
        for r in found:
            assert {r[n] for n in kept} == {None if r["doc_id"] is None else str(r["doc_id"])}
    assert set(quality.score(odd, model, ["a.b"]).columns) == {"a.b", "score"}


def test_substrings_of_edge_cases(edges):
    found = substrings.substring_dedup(edges).toPandas()
    # the row without an id comes first: it keeps the passage, the others lose it
    assert sorted(found.text.dropna().str.len())[-1] == 60_000
    assert found[found.doc_id == 1].text.tolist() == ["start end"]
    assert found[found.doc_id == 2].text.tolist() == ["other tail"] * 2
    assert found[found.doc_id == 3].text.tolist() == [None]


def test_near_duplicates_of_edge_cases(edges):
    found = neardup.near_duplicates(edges).toPandas()
    assert found[found.doc_id.isna()].kept.all()
    assert found[found.doc_id == 2].component_id.tolist() == [1, 1]
    assert found[found.doc_id.isin([3, 4])].n_shingles.tolist() == [0, 0]


def test_line_dedup_against_brute_force(spark):
    line = "A line that is long enough to be counted as common."
    texts = [(i, f"{'  ' * i}{line.upper() if i % 2 else line}\nown {i}") for i in range(6)] + [(9, "short\nshort")]
    found = lines.line_dedup(spark.createDataFrame(texts, "doc_id long, text string")).orderBy("doc_id").toPandas()
    assert found.text.tolist() == lines.dedup_lines(*map(list, zip(*texts)))


def test_pipeline_columns_and_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:2]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
    packed = corpus_pipeline.run(spark, SF_DIR).toPandas()
    assert (packed.groupby("sequence_id").length.sum() <= 2048).all()


def without_repeats(docs: pd.DataFrame) -> list[str]:
    """Texts without the words of 50-word windows that a document with a smaller id has, too."""
    words = [re.findall(r"[^ \t\n\x0B\f\r]+", t) for t in docs.text]
    windows = [[tuple(w[i : i + 50]) for i in range(len(w) - 49)] for w in words]
    first: dict[tuple, int] = {}
    for doc, own in zip(docs.doc_id, windows):
        for w in own:
            first[w] = min(first.get(w, doc), doc)
    texts = []
    for doc, text, w, own in zip(docs.doc_id, docs.text, words, windows):
        gone = {i + k for i, x in enumerate(own) if first[x] < doc for k in range(50)}
        texts.append(" ".join(x for i, x in enumerate(w) if i not in gone) if gone else text)
    return texts


def test_pipeline_stages_against_brute_force(spark, docs, tmp_path):
    outputs = []
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = quality.train(given, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, given, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        given = spark.read.parquet(f"{tmp_path}/{name}")
        outputs.append(given.toPandas().sort_values("doc_id", ignore_index=True, kind="stable"))
    accepted, deduped, apart, cut, packed = outputs

    x = quality.features(model, [t.encode() for t in docs.text])
    passes = 1 / (1 + np.exp(-(x @ np.array(model.weights)))) >= quality.ACCEPT
    assert 0 < passes.sum() < len(docs)
    assert rows(accepted) == rows(docs[passes])

    expected = accepted.assign(text=lines.dedup_lines(accepted.doc_id.tolist(), accepted.text.tolist()))
    expected["n_chars"] = expected.text.str.len()
    assert rows(deduped) == rows(expected)

    con = duckdb.connect()
    con.register("documents", deduped)
    kept = con.sql(ORACLES["op10_minhash_near_dedup"]).df().query("kept").doc_id
    assert rows(apart) == rows(deduped[deduped.doc_id.isin(kept)])

    expected = apart.assign(text=without_repeats(apart))
    expected["n_chars"] = expected.text.str.len()
    assert rows(cut) == rows(expected)

    tokenizer, pieces_of = Tokenizer.from_file(WORD_MODEL), []
    for doc, text in zip(cut.doc_id, cut.text):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            pieces_of.append((doc, piece, start, len(part), zlib.crc32(part.tobytes())))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows(packed[columns]) == rows(pd.DataFrame(pieces_of, columns=columns))
    packed = packed.sort_values(["sequence_id", "offset"])
    assert (packed.offset == packed.groupby("sequence_id").length.cumsum() - packed.length).all()
