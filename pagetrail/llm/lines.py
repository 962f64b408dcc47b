"""Line dedup: lines that many documents hold stay in one document only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import prepare, stored, with_plain_names
from .words import SPACES

NO_ID = -(2**63)


def line_key(line: bytes) -> bytes:
    """The line without white space at both ends, A-Z lower-cased."""
    return line.strip(SPACES).lower()


def _long_lines(text: bytes, min_chars: int) -> list[tuple[int, bytes]]:
    """(position, hash) of the lines whose key is long enough."""
    found = []
    for place, line in enumerate(text.split(b"\n")):
        if len(line) >= min_chars and len(key := line_key(line)) >= min_chars:
            if key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars:
                found.append((place, xxhash.xxh3_128_digest(key)))
    return found


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [v.as_py() or b"" for v in batch.column(batch.schema.get_field_index("text")).cast(pa.binary())]


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Drop every line whose key (see ``line_key``) has at least ``min_chars`` code points and stands in
    at least ``min_docs`` documents, except in the largest ``doc_id`` that holds it.

    Lines are exploded into (hash, document) rows, one for each document; counts are combined before the
    shuffle, and a hash that stands in a third of all documents is joined with one row, which
    adaptive execution splits. Texts are shuffled once, by ``doc_id``, to be reassembled.

    ``docs`` has ``doc_id`` and ``text``; all its columns are returned, with the new text, ``n_lines`` and
    ``n_dropped`` (which replace columns of that name). A null or empty text is one empty line and
    comes back as it is. Rows with equal ids are one document; rows without an id are one document,
    below all others. Repeated rows stay, an empty table stays empty. Other columns may have any names.
    """
    docs = docs.drop("n_lines", "n_dropped")
    return with_plain_names(docs, ("doc_id", "text"), lambda plain: _line_dedup(plain, min_chars, min_docs))


def _line_dedup(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    prepare(docs.sparkSession)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lines = [], []
            for doc, text in zip(batch.column(0).to_pylist(), _texts(batch)):
                own = {h for _, h in _long_lines(text, min_chars)}
                ids += [doc] * len(own)
                lines += sorted(own)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lines, pa.binary())], ["doc", "line"])

    own_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    rows = docs.select(own_id.alias("doc"), "text").mapInArrow(explode, "doc long, line binary")
    rows = stored(rows, "lines")
    common = (
        rows.groupBy("line")
        .agg(F.count_distinct("doc").alias("n"), F.max("doc").alias("keeper"))
        .where(F.col("n") >= min_docs)
    )
    # a join of two tables: only then can adaptive execution split a line that a third of all rows hold
    common = stored(common, "common")
    drops = (
        rows.join(common, "line")
        .where("doc < keeper")
        .groupBy(F.col("doc").alias("__doc"))
        .agg(F.collect_set("line").alias("__lines"))
    )
    columns = docs.columns
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in docs.select(*columns).schema]
        + [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    )

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, dropped = [], [], []
            old = batch.column(columns.index("text"))
            for value, text, gone in zip(old, _texts(batch), batch.column(len(columns))):
                counts.append(text.count(b"\n") + 1)
                gone = set(gone.as_py() or ())
                out = {place for place, h in _long_lines(text, min_chars) if h in gone} if gone else ()
                if out:
                    text = b"\n".join(line for place, line in enumerate(text.split(b"\n")) if place not in out)
                dropped.append(len(out))
                texts.append(text if value.is_valid else None)
            arrays = [pa.array(texts, pa.binary()).cast(pa.string()) if c == "text" else batch.column(i) for i, c in enumerate(columns)]
            arrays += [pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "n_lines", "n_dropped"])

    keyed = docs.select(*columns).withColumn("__key", own_id)
    joined = keyed.join(drops, F.col("__key") == F.col("__doc"), "left").select(*columns, "__lines")
    return joined.mapInArrow(reassemble, schema)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return line_dedup(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def dedup_lines(doc_id: list[int], texts: list[str | None], min_chars: int = 40, min_docs: int = 5) -> list[str]:
    """The same on one machine, for tests."""
    keys = [[line_key(x.encode()).decode() for x in (t or "").split("\n")] for t in texts]
    holders: dict[str, set[int]] = {}
    for doc, own in zip(doc_id, keys):
        for key in own:
            holders.setdefault(key, set()).add(doc)
    return [
        "\n".join(
            line
            for line, key in zip((t or "").split("\n"), own)
            if len(key) < min_chars or len(holders[key]) < min_docs or doc == max(holders[key])
        )
        for doc, t, own in zip(doc_id, texts, keys)
    ]


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT keyed.*, keeper IS NOT NULL AND doc_id < keeper AS gone FROM keyed LEFT JOIN common USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
