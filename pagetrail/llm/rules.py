"""Quality rules with thresholds that adapt to each language and source."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import prepare, stored
from .words import find_words, gram_hashes, groups, mix, range_hashes

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

#: Relative error of a quantile: values in (GAMMA**(b-1), GAMMA**b] share the bucket b of a sketch.
ACCURACY = 0.01
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
#: Bucket of the value 0.
ZERO = -100_000
#: Documents of its language that each group counts besides its own, in the language's proportions; a language counts
#: as many of the whole. So the fewer documents a group has, the more it is judged as those around it.
PRIOR = 200
#: A value is an outlier beyond a quartile by so many interquartile ranges.
REACH = 4.0


class Rule(NamedTuple):
    feature: str
    value: str
    spread: float  # the interquartile range counts as this much at least
    below: bool  # too small values fail, too


RULES = (
    Rule("word_length", "word_chars / n_words", 0.25, True),
    Rule("symbols", "n_symbols / n_words", 0.02, False),
    Rule("duplicate_lines", "n_dup_lines / n_words", 0.005, False),
    Rule("repeated_words", "n_repeat_words / n_words", 0.05, False),
)

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_LINE_VALUE = mix(np.arange(1001, 1257, dtype=np.uint64))


def _repeated_words(words) -> np.ndarray:
    """Words of each document in 3-word windows that the document has twice or more."""
    n = len(words.hashes)
    result = np.zeros(len(words.first) - 1, np.int64)
    if n < 3:
        return result
    doc = np.repeat(np.arange(len(result)), np.diff(words.first))
    grams = gram_hashes(words.hashes, 3)
    place = np.flatnonzero(doc[:-2] == doc[2:])
    keys = mix(grams[place] ^ mix(doc[place].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(place), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[place[twice] + k] = True
    return np.bincount(doc[covered], minlength=len(result))


def _duplicate_lines(words) -> np.ndarray:
    """Lines of each document that have a word and equal an earlier line."""
    data, edges = words.data, words.offsets
    n_docs = len(edges) - 1
    # each document ends with an added space, which ends its last line
    ends = np.union1d(np.flatnonzero(data == 10), edges[1:] - 1)
    starts = np.concatenate([[0], ends[:-1] + 1])
    filled = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[filled], ends[filled]
    doc = np.searchsorted(edges, starts, "right") - 1
    hashes = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):  # segments of whole lines
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + (1 << 20), "right")))
        low, high = starts[a], ends[b - 1]
        hashes[a:b] = range_hashes(_LINE_VALUE[data[low:high]], starts[a:b] - low, ends[a:b] - low)
        a = b
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    repeated = np.zeros(len(doc), bool)
    repeated[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    return np.bincount(doc[repeated], minlength=n_docs)


def text_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words`` of each text."""
    words = find_words(texts)
    sums = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum((words.data & 0xC0) != 0x80, out=sums[1:])
    per_word = np.concatenate([[0], np.cumsum(sums[words.ends] - sums[words.starts])])
    np.cumsum(_IS_SYMBOL[words.data], out=sums[1:])
    return {
        "n_words": np.diff(words.first),
        "word_chars": np.diff(per_word[words.first]),
        "n_symbols": np.diff(sums[words.offsets]),
        "n_dup_lines": _duplicate_lines(words),
        "n_repeat_words": _repeated_words(words),
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def count_texts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts of ``text_counts``, and ``base_failed``. Null text: no words."""
    prepare(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in groups(batch, "text"):
                found = text_counts(texts)
                rows = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(i) for i in range(3)] + [pa.array(found[c].astype(np.int64)) for c in COUNTS],
                    ["doc_id", "lang", "source", *COUNTS],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), "text")
    counted = rows.mapInArrow(count, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def sketches(counted: DataFrame) -> DataFrame:
    """Quantile sketches of all features: (level, lang, source, feature, bucket, n).

    A sketch is the number of values in each bucket of a geometric scale, so it is merged by adding:
    in map-side combine, and here from (language, source), level 0, to languages, 1, and the whole, 2.
    Its size depends on the range of the values, not on the number of documents.
    """
    features = F.array(*[F.struct(F.lit(r.feature).alias("feature"), F.expr(r.value).alias("v")) for r in RULES])
    value = F.col("f.v")
    bucket = F.when(value <= 0, ZERO).otherwise(F.ceil(F.log(value) / math.log(GAMMA))).cast("int")
    fine = (
        counted.where("not base_failed")
        .select("lang", "source", F.explode(features).alias("f"))
        .groupBy(F.lit(0).alias("level"), "lang", "source", F.col("f.feature").alias("feature"), bucket.alias("bucket"))
        .agg(F.count("*").alias("n"))
    )

    def merged(level: int, *keys: str) -> DataFrame:
        kept = [F.col(k) if k in keys else F.lit(None).cast("string").alias(k) for k in ("lang", "source")]
        return fine.groupBy(F.lit(level).alias("level"), *kept, "feature", "bucket").agg(F.sum("n").alias("n"))

    return fine.unionByName(merged(1, "lang")).unionByName(merged(2))


def blended(sketched: DataFrame) -> DataFrame:
    """(lang, source, feature, bucket, weight, total): each group's sketch with PRIOR documents of its language, whose
    sketch has PRIOR documents of the whole. Weights are whole numbers, as every share is multiplied by the totals."""
    whole_number = "decimal(38,0)"
    n = F.col("n").cast(whole_number)

    def level(k: int, *keys: str) -> DataFrame:
        rows = sketched.where(F.col("level") == k).select(*[F.col(c).alias(f"{c}{k}") for c in (*keys, "feature", "bucket")], n.alias(f"n{k}"))
        return rows

    own, of_lang, of_all = level(0, "lang", "source"), level(1, "lang"), level(2)
    total0 = own.groupBy("lang0", "source0", "feature0").agg(F.sum("n0").cast(whole_number).alias("t0"))
    total1 = of_lang.groupBy("lang1", "feature1").agg(F.sum("n1").cast(whole_number).alias("t1"))
    total2 = of_all.groupBy("feature2").agg(F.sum("n2").cast(whole_number).alias("t2"))
    same_lang = F.expr("lang0 <=> lang1 and feature0 = feature1")
    same_feature = F.expr("feature0 = feature2")
    groups_ = total0.join(total1, same_lang).drop("lang1", "feature1").join(total2, same_feature).drop("feature2")
    groups_ = stored(groups_.selectExpr("lang0", "source0", "feature0", "t0", "t1", "t2"), "groups")
    key = ["lang0", "source0", "feature0"]

    def product(*factors: str) -> Column:
        value = F.lit(1).cast(whole_number)
        for factor in factors:
            value = (value * F.expr(factor).cast(whole_number)).cast(whole_number)
        return value

    named = groups_.toDF("lang_of", "source_of", "feature_of", "t0", "t1", "t2")
    mine = own.join(named, F.expr("lang0 <=> lang_of and source0 <=> source_of and feature0 = feature_of"))
    parts = [
        mine.select(*key, F.col("bucket0").alias("bucket"), product("n0", f"t1 + {PRIOR}", "t2").alias("w")),
        groups_.join(of_lang, same_lang).select(*key, F.col("bucket1").alias("bucket"), product(str(PRIOR), "n1", "t2").alias("w")),
        groups_.join(of_all, same_feature).select(*key, F.col("bucket2").alias("bucket"), product(str(PRIOR * PRIOR), "n2").alias("w")),
    ]
    weights = parts[0].unionAll(parts[1]).unionAll(parts[2]).groupBy(*key, "bucket").agg(F.sum("w").cast(whole_number).alias("weight"))
    joined = weights.join(named, F.expr("lang0 <=> lang_of and source0 <=> source_of and feature0 = feature_of"))
    total = product(f"t0 + {PRIOR}", f"t1 + {PRIOR}", "t2")
    return joined.select(
        F.col("lang0").alias("lang"), F.col("source0").alias("source"), F.col("feature0").alias("feature"), "bucket", "weight", total.alias("total")
    )


def fences(sketched: DataFrame) -> DataFrame:
    """One row for each language and source with, for each rule, [low, high]."""
    group = ["lang", "source", "feature"]
    order = Window.partitionBy(*group).orderBy("bucket")
    rows = blended(sketched).withColumn("upto", F.sum("weight").over(order).cast("decimal(38,0)"))
    value = F.when(F.col("bucket") == ZERO, 0.0).otherwise(2 * F.pow(F.lit(GAMMA), F.col("bucket")) / (GAMMA + 1))

    def quartile(k: int):  # the smallest bucket that this part of the weight reaches
        return F.min(F.when(4 * F.col("upto") >= k * F.col("total"), value))

    quartiles = rows.groupBy(*group).agg(quartile(1).alias("q1"), quartile(3).alias("q3"))
    of = {r.feature: F.col("feature") == r.feature for r in RULES}
    columns = []
    for r in RULES:
        width = REACH * F.greatest(F.col("q3") - F.col("q1"), F.lit(r.spread))
        columns.append(F.max(F.when(of[r.feature], F.col("q3") + width)).alias(f"{r.feature}_high"))
        if r.below:
            columns.append(F.max(F.when(of[r.feature], F.col("q1") - width)).alias(f"{r.feature}_low"))
    return quartiles.groupBy("lang", "source").agg(*columns)


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts of each document (``count_texts``) and ``kept``: whether it passes.

    Documents that fail the base rules (fewer than 50 words, or over half of the words in repeated 3-word
    windows) fail. Of the others, a document fails whose word length, symbols, duplicate lines or repeated
    words are outliers for its language and source: more than REACH interquartile ranges beyond a
    quartile, by the quantile sketch of that group, blended with that of its language (see ``blended``).

    ``docs`` has ``doc_id, text, lang, source``; other columns are not used. A null language or
    source is a value of its own. Null and empty texts have no words and fail. Every row gives a row.
    """
    counted = stored(count_texts(docs), "counts")
    limits = fences(stored(sketches(counted), "sketches")).withColumnsRenamed({"lang": "lang_of", "source": "source_of"})
    # a small table, joined once with the documents
    table = stored(limits, "limits")
    joined = counted.join(table, F.expr("lang <=> lang_of and source <=> source_of"), "left")
    passes = ~F.col("base_failed")
    for r in RULES:
        passes = passes & (F.expr(r.value) <= F.col(f"{r.feature}_high"))
        if r.below:
            passes = passes & (F.expr(r.value) >= F.col(f"{r.feature}_low"))
    return joined.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(passes)).drop("lang_of", "source_of")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return quality_rules(docs).select("doc_id", *COUNTS, "base_failed", "kept")


def _sql() -> str:
    lows = [r for r in RULES if r.below]
    values = ", ".join(f"struct_pack(feature := '{r.feature}', v := ({r.value})::DOUBLE)" for r in RULES)
    spread = "CASE feature " + " ".join(f"WHEN '{r.feature}' THEN {r.spread}" for r in RULES) + " END"
    high = " AND ".join(f"({r.value})::DOUBLE <= max(hi) FILTER (WHERE feature = '{r.feature}')" for r in RULES)
    low = " AND ".join(f"({r.value})::DOUBLE >= max(lo) FILTER (WHERE feature = '{r.feature}')" for r in lows)
    return rf"""
WITH words AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w FROM documents
), grams AS (
  SELECT doc_id, i, md5(w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)
), twice AS (
  SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(3) r(k) GROUP BY doc_id
), lines AS (
  SELECT doc_id, line, count(*) - 1 AS extra
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^ \t\n\x0B\f\r]') GROUP BY doc_id, line
), dups AS (
  SELECT doc_id, sum(extra)::BIGINT AS n_dup_lines FROM lines GROUP BY doc_id
), counted AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words,
         length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM words LEFT JOIN dups USING (doc_id) LEFT JOIN covered USING (doc_id)
), based AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed FROM counted
), vals AS (
  SELECT lang, source, unnest([{values}], recursive := true) FROM based WHERE NOT base_failed
), buckets AS (
  SELECT lang, source, feature, CASE WHEN v <= 0 THEN {ZERO} ELSE ceil(ln(v) / {math.log(GAMMA)!r})::INT END AS b FROM vals
), leveled AS (
  SELECT 0 AS level, lang, source, feature, b FROM buckets
  UNION ALL SELECT 1, lang, NULL, feature, b FROM buckets
  UNION ALL SELECT 2, NULL, NULL, feature, b FROM buckets
), counts AS (
  SELECT level, lang, source, feature, b, count(*)::HUGEINT AS n FROM leveled GROUP BY ALL
), groups AS (
  SELECT g.lang, g.source, g.feature, g.t AS t0, l.t AS t1, w.t AS t2
  FROM (SELECT lang, source, feature, sum(n)::HUGEINT AS t FROM counts WHERE level = 0 GROUP BY ALL) g
  JOIN (SELECT lang, feature, sum(n)::HUGEINT AS t FROM counts WHERE level = 1 GROUP BY ALL) l
    ON l.lang IS NOT DISTINCT FROM g.lang AND l.feature = g.feature
  JOIN (SELECT feature, sum(n)::HUGEINT AS t FROM counts WHERE level = 2 GROUP BY ALL) w ON w.feature = g.feature
), weighted AS (
  SELECT g.lang, g.source, g.feature, c.b, g.t0, g.t1, g.t2,
         CASE c.level WHEN 0 THEN c.n * (g.t1 + {PRIOR}) * g.t2 WHEN 1 THEN {PRIOR} * c.n * g.t2 ELSE {PRIOR * PRIOR} * c.n END AS w
  FROM groups g JOIN counts c ON c.feature = g.feature
   AND (c.level = 2 OR (c.lang IS NOT DISTINCT FROM g.lang AND (c.level = 1 OR c.source IS NOT DISTINCT FROM g.source)))
), ranks AS (
  SELECT lang, source, feature, b, sum(w) OVER (PARTITION BY lang, source, feature ORDER BY b) AS upto,
         (t0 + {PRIOR}) * (t1 + {PRIOR}) * t2 AS total
  FROM (SELECT lang, source, feature, b, t0, t1, t2, sum(w)::HUGEINT AS w FROM weighted GROUP BY ALL)
), valued AS (
  SELECT *, CASE WHEN b = {ZERO} THEN 0.0::DOUBLE ELSE 2 * pow({GAMMA!r}::DOUBLE, b) / ({GAMMA!r}::DOUBLE + 1) END AS v FROM ranks
), quartiles AS (
  SELECT lang, source, feature, min(v) FILTER (WHERE 4 * upto >= total) AS q1, min(v) FILTER (WHERE 4 * upto >= 3 * total) AS q3
  FROM valued GROUP BY ALL
), fenced AS (
  SELECT *, q3 + {REACH} * greatest(q3 - q1, {spread}) AS hi, q1 - {REACH} * greatest(q3 - q1, {spread}) AS lo FROM quartiles
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce({high} AND {low}, false) AS kept
FROM based d LEFT JOIN fenced c ON c.lang IS NOT DISTINCT FROM d.lang AND c.source IS NOT DISTINCT FROM d.source
GROUP BY doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed
"""


SQL = _sql()
