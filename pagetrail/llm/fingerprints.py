"""Document fingerprints: threshold-scaled sketches of word shingles, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import prepare

SHINGLE = 5
#: One of so many shingle hashes is retained, by a fixed threshold.
SCALE = 4
#: Ranges of ids for each shuffle partition, in which documents are put in order.
RANGES_PER_PARTITION = 4


def with_sketch(rows: DataFrame, text: str, name: str, size: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """Add the sorted distinct shingle hashes of a text below 2**64 / ``scale`` (as unsigned numbers).

    What is retained does not depend on the document, so the sketch of a union is the union of the sketches, and
    a short text can be compared with a long one. A text of fewer than ``size`` words is one shingle; where no hash is
    below the threshold, the smallest is retained, so that only a text without words has an empty sketch.

    Every step is a column of its own that the next one uses more than once: Spark computes such a column
    once, where an expression inside of a lambda would be computed for each shingle.
    """
    bits = scale.bit_length() - 1
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = rows.withColumn("__words", words)
    starts = F.sequence(F.lit(1), F.greatest(F.size("__words") - (size - 1), F.lit(1)))
    rows = rows.withColumn("__hashes", F.transform(starts, lambda i: F.xxhash64(F.slice("__words", i, size))))
    below = F.filter("__hashes", lambda h: F.shiftrightunsigned(h, 64 - bits) == 0)
    rows = rows.withColumn("__below", F.array_sort(F.array_distinct(below)))
    none = F.array().cast("array<bigint>")
    chosen = F.when(F.size("__words") == 0, none).when(F.size("__below") > 0, F.col("__below"))
    return rows.withColumn(name, chosen.otherwise(F.array(F.array_min("__hashes")))).drop("__words", "__hashes", "__below")


def containment(a: Column, b: Column) -> Column:
    """Part of the smaller sketch that the other has, too: 0 to 1; 1 for two empty ones."""
    least = F.least(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b)) / least
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when(least == 0, 0.0).otherwise(both)


def merged(sketches: Column) -> Column:
    """The sketch of many documents together, from an aggregate: ``groupBy(...).agg(merged(col))``."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_set(sketches))))


def as_text(sketch_: Column) -> Column:
    """16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(sketch_, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def in_ranges(docs: DataFrame, key: str, ranges: int) -> tuple[DataFrame, int]:
    """Rows with ``__range``, so that ranges follow each other in the order of ``key``, and ``__copy``.

    The borders are sampled keys (``ranges`` numbers come to the driver). The row of a border is also sent
    to the range before as a copy (1), and the row of the smallest key to the last range as a copy (2), so that the next
    row of each row is in its own range.
    """
    # keys that occur, exactly; a table without rows has none
    parts = F.percentile_approx(key, [k / ranges for k in range(1, ranges)], 4 * ranges)
    found = docs.agg(F.min(key).alias("low"), parts.alias("borders")).first()
    low = found["low"]
    splits = sorted(set(found["borders"] or ()) - {low})
    if splits:
        limits = ", ".join(f"{s}L" for s in splits)
        own = F.expr(f"size(filter(array({limits}), s -> s <= {key}))")
    else:
        own = F.lit(0)
    none = F.struct(F.lit(None).cast("int").alias("to"), F.lit(None).cast("int").alias("copy"))
    copies = F.array(
        F.struct(own.alias("to"), F.lit(0).alias("copy")),
        F.when(F.col(key).isin(splits), F.struct((own - 1).alias("to"), F.lit(1).alias("copy"))).otherwise(none)
        if splits
        else none,
        F.when(F.col(key) == low, F.struct(F.lit(len(splits)).alias("to"), F.lit(2).alias("copy"))).otherwise(none),
    )
    rows = docs.withColumn("__to", F.explode(copies)).where("__to.to is not null")
    return rows.select(*docs.columns, F.col("__to.to").alias("__range"), F.col("__to.copy").alias("__copy")), len(splits)


def fingerprint_documents(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """``docs`` has ``doc_id`` and ``text`` (null: empty); other columns are not used. One row for each row:

    ``doc_id, n_chars, edited`` (the text whose last n_chars // 2 code points are replaced by the first as many of the
    next document in the order of ``doc_id``; after the last comes the first), ``sketch``,
    ``edited_sketch``, ``near_edited``, ``near_next`` (containment in the edited and in the next text).

    Texts are shuffled once, into ranges of ids; sketches are made after it, once for each text, and the
    next one's is taken over by a window within the range. Rows with equal ids follow each other in the
    order of their text. Rows without an id come before all others.
    """
    spark = prepare(docs.sparkSession)
    smallest = F.lit(-(2**63) + 1)  # stands for no id
    given = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), smallest).alias("key"), F.coalesce("text", F.lit("")).alias("text")
    )
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, _ = in_ranges(given, "key", ranges)
    # a copy for each of several rows with the border's id is one too many, but the first comes first
    rows = with_sketch(rows.repartition("__range"), "text", "sketch", scale=scale)
    # copies (1) have the largest key of their range, copies (2) come after them
    following = Window.partitionBy("__range").orderBy((F.col("__copy") == 2).cast("int"), "key", "text")
    rows = rows.withColumn("next_text", F.lead("text").over(following))
    rows = rows.withColumn("next_sketch", F.lead("sketch").over(following)).where("__copy = 0")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.expr("substr(text, 1, int(char_length(text) - floor(char_length(text) / 2)))"), F.substr("next_text", F.lit(1), half))
    rows = with_sketch(rows.withColumn("edited", edited), "edited", "edited_sketch", scale=scale)
    return rows.select(
        F.when(F.col("key") != smallest, F.col("key")).alias("doc_id"),
        n.cast("long").alias("n_chars"),
        "edited",
        "sketch",
        "edited_sketch",
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op3_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return fingerprint_documents(docs).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
