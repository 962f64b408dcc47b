"""A Merkle manifest of a table: one hash for everything, and a proof for every row.

Each source is a tree whose leaves are its rows; the sources' roots are the leaves of one more tree. A
level is a table of nodes numbered within their tree. Runs of three nodes have one parent, so that the
siblings of a node are at most two rows away: fixed lags and leads over blocks of whole runs, masked by the node's
place in its run and by the run's length, give them, and the first child of each run hashes the parent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import prepare, stored

#: Nodes below one parent.
FAN = 3
#: Nodes in a window partition, a multiple of FAN.
BLOCK = 243


def field(value: Column) -> Column:
    """``-`` for null, else the value's bytes, ``:`` and the value."""
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_hash(text: Column) -> Column:
    doc_id, n_chars = (F.col(c).cast("long").cast("string") for c in ("doc_id", "n_chars"))
    source, lang = (F.col(c).cast("string") for c in ("source", "lang"))
    return digest(*[field(value) for value in (doc_id, source, lang, n_chars, text)])


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``i``, the place of a row in its ``tree`` by ``order``, and ``n``, the rows of the tree.

    Rows are dealt out by ranges of (tree, order) and sorted there, so a large tree is many ranges. A row's
    place follows from its range's counts and from its place in the range. ``order`` has to be unique in a tree.
    """
    in_range = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    dealt = stored(dealt.select("*", F.spark_partition_id().alias("part"), in_range.alias("row")), "manifest-order")
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("tree", "part").agg(F.count("*").alias("rows"), F.min("row").alias("low"))
    counts = counts.select(
        F.col("tree").alias("its_tree"),
        F.col("part").alias("its_part"),
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("low")).alias("shift"),
        F.sum("rows").over(Window.partitionBy("tree")).alias("n"),
    )
    placed = dealt.join(counts, F.col("tree").eqNullSafe(F.col("its_tree")) & (F.col("part") == F.col("its_part")))
    return placed.withColumn("i", F.col("row") + F.col("shift")).drop("its_tree", "its_part", "part", "row", "shift")


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Add ``left`` and ``right``: the hashes of a node's run before and after it, joined."""
    order = Window.partitionBy("tree", "block").orderBy("i")
    slot = F.col("i") % FAN
    run = F.least(F.lit(FAN), F.col("n") - F.col("i") + slot)
    empty = F.lit("")
    left = [F.when(slot >= k, F.lag("node", k).over(order)).otherwise(empty) for k in range(FAN - 1, 0, -1)]
    right = [F.when(slot + k < run, F.lead("node", k).over(order)).otherwise(empty) for k in range(1, FAN)]
    blocks = nodes.withColumn("block", F.expr(f"i div {BLOCK}"))
    return blocks.withColumns({"left": F.concat(*left), "right": F.concat(*right)}).drop("block")


def levels(leaves: DataFrame) -> list[DataFrame]:
    """Tables of nodes with their siblings, the leaves first: (tree, i, n, node, left, right) and what else
    the leaves have. ``n`` counts the nodes of the tree in that level; a tree ends at its level with n = 1."""
    tables = [stored(with_siblings(leaves), "manifest-level")]
    most = tables[0].agg(F.max("n")).first()[0] or 0
    while most > 1:
        first = tables[-1].where((F.col("n") > 1) & (F.col("i") % FAN == 0))
        parents = first.select(
            "tree",
            F.expr(f"i div {FAN}").alias("i"),
            F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"),
            digest(F.col("node"), F.col("right")).alias("node"),
        )
        tables.append(stored(with_siblings(parents), "manifest-level"))
        most = -(-most // FAN)
    return tables


def roots(tables: list[DataFrame]) -> DataFrame:
    """(tree, root) of every tree."""
    tops = [t.where("n = 1").select("tree", F.col("node").alias("root")) for t in tables]
    whole = tops[0]
    for top in tops[1:]:
        whole = whole.unionByName(top)
    return whole


def paths(tables: list[DataFrame]) -> DataFrame:
    """The leaves with ``path``: (left, right) of the leaf and of each node above it, but the root."""
    above: DataFrame | None = None
    kind = "array<struct<left:string,right:string>>"
    none = F.lit(None).cast(kind)
    for table in reversed(tables):
        own = F.array(F.struct("left", "right")).cast(kind)
        empty = F.array().cast(kind)
        rows = table if above is None else table.join(
            above, F.col("tree").eqNullSafe(F.col("up_tree")) & (F.expr(f"i div {FAN}") == F.col("up_i")) & (F.col("n") > 1), "left"
        )
        up = none if above is None else F.col("up_path")
        rows = rows.withColumn("path", F.when(F.col("n") > 1, F.concat(own, F.coalesce(up, empty))).otherwise(empty))
        if above is not None:
            rows = rows.drop("up_tree", "up_i", "up_path")
        above = rows.select(F.col("tree").alias("up_tree"), F.col("i").alias("up_i"), F.col("path").alias("up_path"))
    return rows


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of a path."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """One row per row: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``docs`` has ``doc_id, source, lang, n_chars, text``; other columns are not read. Rows of a source are in the
    order of (doc_id, leaf), without an id first; rows that are equal in both are interchangeable. A null source is
    a source. Where 2 divides crc32 of the id as text, the text is tampered with: its line ends go. A
    row without an id is not tampered with. An empty table gives no rows.

    No task and no window holds a whole source. Texts are read once and leave their task as hashes.
    """
    prepare(docs.sparkSession)
    text = F.col("text").cast("string")
    tampered = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 2 == 0
    leaf = leaf_hash(text)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("tree"),
        leaf.alias("node"),
        F.when(tampered & F.contains(text, F.lit("\n")), leaf_hash(F.replace(text, F.lit("\n"), F.lit("")))).alias("other"),
        F.monotonically_increasing_id().alias("tie"),  # equal rows can be dealt out to several ranges
    )
    rows = stored(rows, "manifest-leaves")
    tables = levels(numbered(rows, ["doc_id", "node", "tie"]))

    subroots = roots(tables).select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("root").alias("node"))
    top = levels(numbered(stored(subroots, "manifest-subroots"), ["source"]))
    root = roots(top).select("root")
    sources = paths(top).select(
        F.col("source").alias("its_source"), F.col("node").alias("subroot"), F.col("path").alias("top_path")
    )
    sources = stored(sources.withColumn("root", F.lit(root.first()["root"] if not root.isEmpty() else None).cast("string")), "manifest-sources")

    joined = paths(tables).join(sources, F.col("tree").eqNullSafe(F.col("its_source")))
    whole = joined.withColumn("whole", F.concat("path", "top_path"))
    siblings = F.array_join(F.flatten(F.transform("whole", lambda s: F.array(s["left"], s["right"]))), "")
    result = whole.select(
        "doc_id",
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded(F.coalesce("other", "node"), F.col("whole")).alias("folded_root"),
    )
    return result.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH RECURSIVE crc_rows AS (
  SELECT i, 0 AS step, i::UBIGINT AS v FROM range(256) r(i)
  UNION ALL
  SELECT i, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM crc_rows WHERE step < 8
), crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM crc_rows WHERE step = 8
), coded AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::UBIGINT)),
                lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)::BIGINT])), 4294967295::UBIGINT) % 2 = 0 AS tampered
  FROM documents, crc_table
), fields AS (
  SELECT doc_id, source,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         text, CASE WHEN tampered THEN replace(text, chr(10), '') ELSE text END AS other
  FROM coded
), leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(other) || ':' || other, '-')) AS changed,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
  FROM fields
), nodes AS (
  SELECT 0 AS l, source, i, n, leaf AS h FROM leaves
  UNION ALL
  SELECT l + 1, source, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY l, source, i // 3, n
), top AS (
  SELECT 0 AS l, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n, h FROM nodes WHERE n = 1
  UNION ALL
  SELECT l + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY l, i // 3, n
), climbed AS (
  SELECT doc_id, source, 0 AS l, i, n, changed AS f, '' AS p FROM leaves
  UNION ALL
  SELECT u.doc_id, u.source, u.l + 1, u.i // 3, (u.n + 2) // 3,
         sha256(string_agg(CASE WHEN v.i = u.i THEN u.f ELSE v.h END, '' ORDER BY v.i)),
         u.p || coalesce(string_agg(v.h, '' ORDER BY v.i) FILTER (WHERE v.i <> u.i), '')
  FROM climbed u JOIN nodes v ON v.source IS NOT DISTINCT FROM u.source AND v.l = u.l AND v.i // 3 = u.i // 3
  WHERE u.n > 1 GROUP BY u.doc_id, u.source, u.l, u.i, u.n, u.f, u.p
), crossed AS (
  SELECT doc_id, source, 0 AS l, r.i, r.n, f, p
  FROM climbed c JOIN (
    SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
  ) r USING (source) WHERE c.n = 1
  UNION ALL
  SELECT u.doc_id, u.source, u.l + 1, u.i // 3, (u.n + 2) // 3,
         sha256(string_agg(CASE WHEN v.i = u.i THEN u.f ELSE v.h END, '' ORDER BY v.i)),
         u.p || coalesce(string_agg(v.h, '' ORDER BY v.i) FILTER (WHERE v.i <> u.i), '')
  FROM crossed u JOIN top v ON v.l = u.l AND v.i // 3 = u.i // 3
  WHERE u.n > 1 GROUP BY u.doc_id, u.source, u.l, u.i, u.n, u.f, u.p
)
SELECT a.doc_id, a.leaf, s.h AS subroot, r.h AS root, sha256(c.p) AS proof_sha256, c.f AS folded_root, c.f = r.h AS verified
FROM leaves a
JOIN crossed c ON c.doc_id = a.doc_id AND c.n = 1
JOIN nodes s ON s.n = 1 AND s.source IS NOT DISTINCT FROM a.source
JOIN top r ON r.n = 1
"""
