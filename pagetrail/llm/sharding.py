"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranking import ranked
from .storage import prepare

#: Parts into which a source, and the interleaved order, is cut for ranking. A part of the largest
#: source has to fit in a task: raise it with the corpus.
PARTS = 4096


def stratified_shards(
    rows: DataFrame, shards: int = 40, seed: int = 7, row_id: str = "doc_id", source: str = "source", parts: int = PARTS
) -> DataFrame:
    """Add ``shard`` and ``slot`` so that each shard is a picture of the whole mixture of sources.

    Rows are shuffled within their source by a seeded hash of their id and ranked. Sorted by fractional
    rank, (rank + 1/2) / rows of the source, the sources interleave in proportion; that order is cut into
    ``shards`` runs whose row counts differ by one at most. ``slot`` counts from 0 within a shard.

    No task sorts a whole source: ranks come from counts of small parts (see ``ranked``).
    A null source is a source of its own; null ids shuffle as an empty id. Repeated rows are ranked
    one after the other. Columns named ``shard`` and ``slot`` are replaced. Other columns stay; names that
    begin with two underscores are reserved. An empty table stays empty.
    """
    prepare(rows.sparkSession)
    digits = 8
    rows = rows.drop("shard", "slot")
    own_id = F.coalesce(F.col(row_id).cast("string"), F.lit(""))
    rows = rows.withColumn("__order", F.md5(F.concat(F.lit(f"{seed}-"), own_id).cast("binary")))
    # the first digits of the hash, scaled to parts: ordered as the hash
    head = F.conv(F.substring("__order", 1, digits), 16, 10).cast("long")
    part = F.floor(head * parts / (16**digits))
    rows = ranked(rows, [source], part, ["__order", row_id], "__rank", "__of")
    rows = rows.withColumn("__at", (2 * F.col("__rank") + 1).cast("double") / (2 * F.col("__of")).cast("double"))
    rows = rows.drop("__rank", "__of").withColumn("__all", F.lit(0))
    part = F.floor(F.col("__at") * parts)
    rows = ranked(rows, ["__all"], part, ["__at", source, "__order", row_id], "__place", "__of")
    shard = F.expr(f"int(__place * {shards} div __of)")
    start = F.expr(f"(shard * __of + {shards - 1}) div {shards}")
    return (
        rows.withColumn("shard", shard)
        .withColumn("slot", F.col("__place") - start)
        .drop("__order", "__at", "__all", "__place", "__of")
    )


def op8_stratified_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return stratified_shards(rows).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


SQL = r"""
WITH bits AS (
  SELECT i, 0 AS step, i::UBIGINT AS v FROM range(256) r(i)
), crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    WITH RECURSIVE f(i, step, v) AS (
      SELECT i, 0, v FROM bits
      UNION ALL
      SELECT i, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM f WHERE step < 8
    ) SELECT i, v FROM f WHERE step = 8)
), sized AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 16 AS size,
         hex(encode(coalesce(text, ''))) AS h, md5('7-' || coalesce(doc_id::VARCHAR, '')) AS o
  FROM documents
), summed AS (
  SELECT doc_id, source, size, o,
         xor(list_reduce(list_prepend(4294967295::UBIGINT,
               list_transform(range(1, length(h), 2), lambda i: ((strpos('0123456789ABCDEF', h[i]) - 1) * 16 + strpos('0123456789ABCDEF', h[i + 1]) - 1)::UBIGINT)),
             lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)::BIGINT])), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM sized, crc_table
), fractions AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY o, doc_id) - 1)::DOUBLE
            / (2 * count(*) OVER (PARTITION BY source))::DOUBLE AS f FROM summed
), placed AS (
  SELECT *, row_number() OVER (ORDER BY f, source NULLS FIRST, o, doc_id) - 1 AS place, count(*) OVER () AS n FROM fractions
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (place * 40 // n)::INT AS shard,
       place - ((place * 40 // n) * n + 39) // 40 AS slot, NULL::INT AS grown_shard
FROM placed
"""
