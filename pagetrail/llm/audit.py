"""How filters of a cleaning pipeline interact, over every order in which they can be applied.

A document is known by its mask: the set of filters that it fails. In an order, the first filter of the
mask removes it. The orders that start with the same filters are neighbours in lexicographic order, so for a mask and a
step the orders in which that step removes it are a few intervals of ranks. Counts of masks are added at the
intervals' ends, and running sums over the ranks give what each step of each order removes.
"""

from __future__ import annotations

from itertools import groupby, permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import prepare, stored

#: Filters by letter; the bit of a letter in a mask is its place here.
LETTERS = "ABCDE"
SIZE = len(LETTERS)
ORDERS = factorial(SIZE)

MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
MARKS = "[#$%&*|]"

#: What is counted of documents, by their number, good label and toxic label.
COUNTS = ("n", "good", "toxic")


def lehmer_rank(order: str) -> int:
    """The place of an order of all letters among all orders, sorted. An order's beginning has the place of the
    first order that starts with it."""
    rank = 0
    for step, letter in enumerate(order):
        smaller = sum(other < letter for other in LETTERS if other not in order[:step])
        rank += smaller * factorial(SIZE - 1 - step)
    return rank


def removal_intervals() -> list[tuple[int, int, int, int]]:
    """(mask, step, low, high): the orders of rank low to high - 1 remove the mask in that step, from 0.

    Before the step come filters outside of the mask, in it one of the mask; whatever follows is free, so
    that a beginning covers a run of ranks. Runs that touch are one interval.
    """
    found = []
    for mask in range(1, 1 << SIZE):
        inside = [x for k, x in enumerate(LETTERS) if mask >> k & 1]
        outside = [x for x in LETTERS if x not in inside]
        for step in range(len(outside) + 1):
            free = factorial(SIZE - 1 - step)
            lows = sorted(lehmer_rank("".join([*head, x])) for head in permutations(outside, step) for x in inside)
            for _, run in groupby(enumerate(lows), lambda at: at[1] - at[0] * free):
                run = [low for _, low in run]
                found.append((mask, step, run[0], run[-1] + free))
    return found


def text_failures(text: Column) -> Column:
    """Bits 0 to 3 of the mask, for the filters that look at a text alone."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n_words, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = (
        n_words < MIN_WORDS,
        100 * distinct < MIN_DISTINCT_PERCENT * n_words,
        100 * capitals > MAX_CAPITAL_PERCENT * F.length(text),
        text.rlike(MARKS),
    )
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0)).cast("int")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part and mask, and those labelled good or toxic.

    Texts are read once and leave their task as a hash. Every table after that has a few dozen bytes a document, and
    all but two joins, on (text, id) and on id, are sums and minima that combine before the shuffle.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    seen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("text_key"),
        text_failures(text).alias("own"),
    )
    seen = stored(seen, "audit-seen")
    # rows that are equal in all that counts are one row from here on
    rows = seen.groupBy("doc_id", "part", "text_key", "own").agg(F.count("*").alias("n"))
    first = seen.groupBy("text_key").agg(F.min("doc_id").alias("first_id"))
    first = first.select("text_key", F.col("first_id").alias("doc_id"), F.lit(True).alias("is_first"))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("is_good"), F.max(F.col("toxic") == 1).alias("is_toxic")
    )
    marked = rows.join(first, ["text_key", "doc_id"], "left").join(known, "doc_id", "left")
    later = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    mask = F.col("own") + F.when(later, 1 << 4).otherwise(0)
    return marked.groupBy("part", mask.alias("mask")).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("is_good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("is_toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def order_totals(counts: DataFrame) -> DataFrame:
    """What each step of each order does, from the counts of masks: see ``audit``."""
    spark = counts.sparkSession
    counts = stored(counts, "audit-masks")
    intervals = spark.createDataFrame(removal_intervals(), "mask int, step int, low int, high int")
    ends = F.explode(F.array(*[F.struct(F.col(c).alias("rank"), F.lit(s).alias("sign")) for c, s in (("low", 1), ("high", -1))]))
    changes = intervals.select("mask", "step", ends.alias("end")).select("mask", "step", "end.*")
    added = (
        counts.join(changes, "mask")
        .groupBy("part", "step", "rank")
        .agg(*[F.sum(F.col("sign") * F.col(c)).alias(c) for c in COUNTS])
    )

    # one row for each part, rank and step, with the step's filter
    orders = sorted("".join(p) for p in permutations(LETTERS))
    grid = [(k, o, s, o[s]) for k, o in enumerate(orders) for s in range(SIZE)]
    grid = spark.createDataFrame(grid, "rank int, filter_order string, step int, letter string")
    bits = [F.when(F.col("mask").bitwiseAND(1 << k) != 0, F.col("n")).otherwise(0) for k in range(SIZE)]
    alone = [F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0) for k in range(SIZE)]
    parts = counts.groupBy("part").agg(
        F.sum("n").alias("total"),
        F.array(*[F.sum(b) for b in bits]).alias("failing"),
        F.array(*[F.sum(a) for a in alone]).alias("unique"),
    )
    # every part has rows for all ranks, so parts are made into rows, not joined with the grid
    cells = parts.select("*", F.explode(F.sequence(F.lit(0), F.lit(ORDERS * SIZE - 1))).alias("cell"))
    cells = cells.withColumns({"rank": F.expr(f"int(cell div {SIZE})"), "step": F.expr(f"cell % {SIZE}")})
    cells = cells.join(grid, ["rank", "step"])
    upto = Window.partitionBy("part", "step").orderBy("rank")
    filled = cells.join(added, ["part", "step", "rank"], "left").withColumns(
        {c: F.coalesce(F.sum(c).over(upto), F.lit(0)) for c in COUNTS}
    )
    so_far = Window.partitionBy("part", "rank").orderBy("step")
    by_filter = Window.partitionBy("part", "letter")
    of_letter = F.expr(f"instr('{LETTERS}', letter)")
    return filled.select(
        "part",
        "filter_order",
        (F.col("step") + 1).alias("step"),
        (F.col("total") - F.sum("n").over(so_far)).alias("kept"),
        F.col("n").alias("removed"),
        (F.element_at("failing", of_letter) - F.col("n")).alias("redundant"),
        F.element_at("unique", of_letter).alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(by_filter).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the five filters and step: ``part, filter_order, step, kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley``.

    ``docs`` has ``doc_id, text, lang``, ``labels`` has ``doc_id, quality, toxic``; other columns are not read. A
    null text is an empty one, a null language the part ''. A row without an id never fails E and is nobody's
    earlier copy; rows with one id are no copies of each other. An id with several labels is good, or toxic, if one
    of them says so. Empty tables give no rows.
    """
    prepare(docs.sparkSession)
    return order_totals(mask_counts(docs, labels))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return audit(docs, labels)


SQL = rf"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w FROM documents
), judged AS (
  SELECT doc_id, part, [
    len(w) < {MIN_WORDS},
    100 * len(list_distinct(w)) < {MIN_DISTINCT_PERCENT} * len(w),
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {MAX_CAPITAL_PERCENT} * length(text),
    regexp_matches(text, '{MARKS}'),
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails FROM words
), marked AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM judged LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id)
  GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), cells AS (
  SELECT o, s, strpos('ABCDE', o[s]) AS f, list_transform(range(1, s), lambda j: strpos('ABCDE', o[j])) AS earlier
  FROM orders, range(1, 6) r(s)
), met AS (
  SELECT part, o, s, f, n, good, toxic, fails[f] AS fails_it, len(list_filter(fails, lambda b: b)) = 1 AS only_one,
         len(list_filter(earlier, lambda j: fails[j])) = 0 AS alive
  FROM marked, cells
), summed AS (
  SELECT part, o, s, f, sum(CASE WHEN alive AND NOT fails_it THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN alive AND fails_it THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN NOT alive AND fails_it THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN only_one AND fails_it THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN alive AND fails_it THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN alive AND fails_it THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM met GROUP BY part, o, s, f
)
SELECT part, o AS filter_order, s::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM summed
"""
