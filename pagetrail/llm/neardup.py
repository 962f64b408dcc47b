"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .graphs import components
from .storage import prepare, stored
from .words import find_words, groups, mix, shingle_sets

SHINGLE = 5
#: Similarity from which documents are linked, in hundredths.
SIMILAR = 75
#: A signature has CHUNKS chunks of CHUNK symbols of 16 bits.
CHUNKS = 10
CHUNK = 4
#: Symbols of a chunk that may differ. Two signatures that differ in at most
#: CHUNKS * (CHUNK_ERRORS + 1) - 1 = 19 of their 40 symbols have, by the pigeonhole principle, a chunk with at
#: most that many errors, and so share a key. At a similarity of 0.75, 10 symbols differ on average; the
#: chance that no chunk has at most one error is 0.262 ** 10, or 2 in a million.
CHUNK_ERRORS = 1

#: Words of 64 bits in the parity sketch of a set.
PARITY = 16
#: Rarest shingles of a set that go along with each shingle of its prefix.
FRONT = 16

_SEEDS = mix(np.arange(1, CHUNKS * CHUNK + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = mix(_SEEDS + np.uint64(17)) | np.uint64(1)


def signatures(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """b-bit MinHash: for each set (none empty) and hash function, 16 bits of the smallest hash."""
    result = np.empty((len(edges) - 1, len(_SEEDS)), np.uint16)
    for k, (seed, factor) in enumerate(zip(_SEEDS, _FACTORS)):
        smallest = np.minimum.reduceat((values ^ seed) * factor, edges[:-1])
        result[:, k] = mix(smallest) >> np.uint64(48)
    return result


def chunk_keys(signature: np.ndarray) -> np.ndarray:
    """Keys of all chunks with each one symbol left out: equal for chunks with at most one error."""
    parts = signature.reshape(len(signature), CHUNKS, CHUNK).astype(np.uint64)
    keys = np.empty((len(signature), CHUNKS, CHUNK), np.uint64)
    for out in range(CHUNK):
        key = np.zeros((len(signature), CHUNKS), np.uint64)
        for k in range(CHUNK):
            if k != out:
                key = (key << np.uint64(16)) | parts[:, :, k]
        place = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(CHUNK) + np.uint64(out)
        keys[:, :, out] = mix(key ^ (place << np.uint64(48)))  # the symbols take 48 bits
    return keys.reshape(len(signature), -1)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def sketch(docs: DataFrame) -> DataFrame:
    """doc, n_shingles, set_a, set_b (128 bits of the whole set; equal sets are equal), signature."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in groups(batch, "text"):
                values, edges = shingle_sets(find_words(texts, lower=True), SHINGLE)
                filled = np.flatnonzero(np.diff(edges))
                set_a, set_b = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64)
                signature: list[bytes | None] = [None] * len(texts)
                if len(filled):
                    starts = edges[filled]
                    set_a[filled] = np.add.reduceat(mix(values ^ _SEEDS[0]), starts)
                    set_b[filled] = np.add.reduceat(mix(values ^ _SEEDS[1]), starts)
                    for i, s in zip(filled, signatures(values, np.append(starts, len(values)))):
                        signature[i] = s.tobytes()
                arrays = [batch.column(0).slice(first, len(texts)), pa.array(np.diff(edges).astype(np.int64))]
                arrays += [_signed(set_a), _signed(set_b), pa.array(signature, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc", "n_shingles", "set_a", "set_b", "signature"])

    return docs.mapInArrow(compute, "doc long, n_shingles long, set_a long, set_b long, signature binary")


def _keyed(sketches: DataFrame) -> DataFrame:
    """(key, doc, n) for every key of a document."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            signature = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
            keys = chunk_keys(signature)
            per_doc = keys.shape[1]
            doc, n = (np.repeat(batch.column(i).to_numpy(), per_doc) for i in range(2))
            yield pa.RecordBatch.from_arrays([_signed(keys.ravel()), pa.array(doc), pa.array(n)], ["key", "doc", "n"])

    return sketches.select("doc", "n_shingles", "signature").mapInArrow(compute, "key long, doc long, n long")


def similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity. ``texts`` has doc and text.

    The text of b goes to its pairs, then the text of a: where a is the hub of many pairs, adaptive
    execution splits them. Rows come sorted by a, whose set is made once for its run of pairs.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hub = None, None
        for batch in batches:
            a, hub_text = batch.column(0), batch.column(2)
            passed = []
            for first, texts_b in groups(batch, "text_b"):
                values, edges = shingle_sets(find_words(texts_b, lower=True), SHINGLE)
                for i in range(len(texts_b)):
                    text = hub_text[first + i].as_py()
                    if (a[first + i], text) != last:
                        last = (a[first + i], text)
                        hub, _ = shingle_sets(find_words([(text or "").encode()], lower=True), SHINGLE)
                    own = values[edges[i] : edges[i + 1]]
                    both = len(np.intersect1d(hub, own, assume_unique=True))
                    if both and 100 * both >= SIMILAR * (len(hub) + len(own) - both):
                        passed.append(first + i)
            yield batch.select([0, 1]).take(pa.array(passed, pa.int64()))

    with_b = pairs.join(texts.toDF("b", "text_b"), "b")
    with_a = with_b.join(texts.toDF("a", "text_a"), "a").select("a", "b", "text_a", "text_b")
    return with_a.sortWithinPartitions("a").mapInArrow(compute, "a long, b long")


def _shingle_rows(docs: DataFrame) -> DataFrame:
    """(doc, version, n, component, shingle) of (doc, text, component); ``version`` tells texts of an id apart."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in groups(batch, "text"):
                values, edges = shingle_sets(find_words(texts, lower=True), SHINGLE)
                n = np.diff(edges)
                at = pa.array(np.repeat(np.arange(len(texts)), n))
                doc, version, component = (batch.column(i).slice(first, len(texts)).take(at) for i in (0, 2, 3))
                arrays = [doc, version, pa.array(np.repeat(n, n)), component, _signed(values)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc", "version", "n", "component", "shingle"])

    rows = docs.select("doc", "text", F.xxhash64("text").alias("version"), "component")
    return rows.mapInArrow(compute, "doc long, version long, n long, component long, shingle long")


def _parity(word: int) -> Column:
    """SQL aggregate: one word of a set's parity sketch, in which each shingle turns one bit."""
    bit = "shiftleft(1L, cast(pmod(shiftright(shingle, 8), 64) AS int))"
    return F.expr(f"bit_xor(CASE WHEN pmod(shingle, {PARITY}) = {word} THEN {bit} ELSE 0L END)")


def pairs_formed(docs: DataFrame) -> DataFrame:
    """Pairs (a, b, share) of ``docs`` (doc, text, component) in different components that may be similar: a
    prefix join, which misses none. At least ``share`` of their shingles is in one of the two only. A pair may
    come more than once.

    Two sets that are similar share a shingle among the rarest quarter of each. Let each set be sorted by
    rareness, those that no other has first. At the rarest shingle that two sets share, what is left of either
    must hold all that they share; pairs are formed only where that suffices. So a document with many changes
    of its own does not meet the others of its family through their common, hot shingles. Of a
    hot shingle, only documents outside of its largest component are paired with the others.

    A pair needs to be formed once, at the rarest shingle that both sets have. Each row of the join carries the
    rarest ``FRONT`` shingles of its set: if two sets share one of them, they are paired there and nowhere else,
    as any shingle outside of a set's front comes later in the common order. Only pairs whose fronts are disjoint
    can be formed several times.

    Shingles that only one document has are in the difference of any two sets, and so are at least as many others as
    bits in which the parity sketches differ: a shingle in both turns the same bit twice. Pairs whose difference
    is too large by that bound do not leave the join. The bound holds for sets of any size; it is close where the
    difference is below some 500 shingles.
    """
    rows = stored(_shingle_rows(docs), "shingles")
    counts = stored(rows.groupBy("shingle").agg(F.count("*").alias("count")).where("count > 1"), "counts")
    shared = rows.join(counts, "shingle").groupBy("doc", "version", "n", "component")
    sketch_words = [f"odd_{i}" for i in range(PARITY)]
    shared = shared.agg(
        F.sort_array(F.collect_list(F.struct("count", "shingle"))).alias("list"),
        F.count("*").alias("s"),
        *[_parity(i).alias(word) for i, word in enumerate(sketch_words)],
    )
    needed = f"cast(({SIMILAR} * n + 99) div 100 as int)"
    shared = shared.where(f"s >= {needed}").withColumn("list", F.expr(f"slice(list, 1, int(s) - {needed} + 1)"))
    front = F.expr(f"slice(list.shingle, 1, {FRONT})").alias("front")
    prefix = shared.select("doc", "n", "s", "component", *sketch_words, front, F.posexplode("list").alias("at", "e"))
    # what is left of the document from here on, in the order of rareness
    alone, left = F.col("n") - F.col("s"), F.col("s") - F.col("at")
    prefix = prefix.select("doc", "n", alone.alias("alone"), left.alias("left"), "component", "e.shingle", "front", *sketch_words)
    prefix = stored(prefix, "prefix")
    sizes = prefix.groupBy("shingle", "component").agg(F.count("*").alias("size")).groupBy("shingle")
    largest = F.max(F.struct("size", "component"))["component"].alias("main")
    several = stored(sizes.agg(largest, F.count("*").alias("parts")).where("parts > 1").select("shingle", "main"), "main")
    prefix = stored(prefix.join(several, "shingle"), "prefix")
    left = prefix.where("component <> main").drop("main")
    right = prefix.toDF(*[c if c in ("shingle", "main") else f"{c}_2" for c in prefix.columns])
    both = f"{100 + SIMILAR} * least(left, left_2) >= {SIMILAR} * (n + n_2)"
    turned = " + ".join(f"bit_count({word} ^ {word}_2)" for word in sketch_words)
    differ = f"(alone + alone_2 + {turned})"
    near = f"{100 + SIMILAR} * {differ} <= {100 - SIMILAR} * (n + n_2)"
    rarest = "coalesce(get(array_intersect(front, front_2), 0), shingle) = shingle"
    pairs = left.join(right, "shingle").where(
        f"component <> component_2 and (component_2 = main or doc < doc_2) and {both} and {near} and {rarest}"
    )
    share = F.expr(f"{differ} / (n + n_2)").alias("share")
    return pairs.select(F.least("doc", "doc_2").alias("a"), F.greatest("doc", "doc_2").alias("b"), share)


def pairs_across(docs: DataFrame) -> DataFrame:
    """Each of ``pairs_formed`` once."""
    return pairs_formed(docs).groupBy("a", "b").agg(F.min("share").alias("share"))


def closest(pairs: DataFrame) -> DataFrame:
    """Of each document in ``pairs`` (a, b, share) the pair (a, b) with the smallest share of differing shingles."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("doc"), F.struct("share", "a", "b").alias("pair"))
    return ends.groupBy("doc").agg(F.min("pair").alias("pair")).select("pair.a", "pair.b").distinct()


def between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) of documents in different components; ``labels`` has node and component."""
    of_a, of_b = labels.toDF("a", "component_a"), labels.toDF("b", "component_b")
    placed = pairs.join(of_a, "a", "left").join(of_b, "b", "left")
    return placed.where("coalesce(component_a, a) <> coalesce(component_b, b)").select("a", "b")


def _close_sizes(a: str, b: str) -> str:
    return f"100 * least({a}, {b}) >= {SIMILAR} * greatest({a}, {b})"


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``, which has ``doc_id`` and ``text``.

    Documents are linked if their sets of distinct 5-word shingles (words of the text with A-Z lower-cased; a
    text of fewer words is one shingle) have a Jaccard similarity of 0.75 or more. ``component_id`` is the smallest
    id that can be reached by links; ``kept`` marks that document.

    1. Documents with the same set are one class, held by its smallest id. Counts and minima are combined before
       the shuffle, so a class may hold any part of all rows.
    2. Multi-index: each class gives 40 keys, one for each chunk of its signature and symbol left out.
    3. In each bucket of a key, every class is compared with the smallest one, on full sets: a star instead of
       all pairs. Components of these links follow.
    4. What a star can miss: classes in buckets that still hold several components go through an exact
       join for pairs of different components (``pairs_across``). Each document is compared with its closest
       partner first, then all pairs that are still apart are compared. With it, every similar pair that
       shares a key is linked or already connected.

    Texts of classes that share a bucket are stored once and joined to the pairs. A null or empty text, or one
    without words, has no shingle and is linked with nothing. Rows with the same id are one document. A row
    without an id is linked with nothing: its component is null, and it is kept.
    """
    prepare(docs.sparkSession)
    given = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    sketches = stored(sketch(given), "sketches")
    set_key = ["n_shingles", "set_a", "set_b"]
    linked = sketches.where("doc is not null and n_shingles > 0")
    classes = stored(linked.groupBy(*set_key).agg(F.min("doc").alias("first")), "classes")
    heads = linked.join(classes.select("first").distinct(), F.col("doc") == F.col("first"), "left_semi")

    keyed = _keyed(heads.select("doc", "n_shingles", "signature").distinct())
    buckets = (
        keyed.groupBy("key")
        .agg(F.min(F.struct("doc", "n")).alias("hub"), F.count("*").alias("size"))
        .where("size > 1")
        .select("key", F.col("hub.doc").alias("hub"), F.col("hub.n").alias("hub_n"), "size")
    )
    members = stored(keyed.join(stored(buckets, "buckets"), "key"), "members")
    involved = members.select("doc").distinct()
    texts = stored(given.join(involved, "doc", "left_semi").distinct(), "texts")

    stars = members.where("doc <> hub and " + _close_sizes("n", "hub_n"))
    stars = stars.select(F.col("hub").alias("a"), F.col("doc").alias("b")).distinct()
    links = stored(similar(stars, texts), "links")
    labels = stored(components(links), "labels")

    rest = members.where("size > 2").join(labels.toDF("doc", "component"), "doc", "left")
    rest = stored(rest.select("key", "doc", F.coalesce("component", "doc").alias("component")), "rest")
    open_keys = rest.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_keys = stored(open_keys.where("low <> high").select("key"), "open")
    rest = rest.join(open_keys, "key").select("doc", "component").distinct()
    across = stored(pairs_across(texts.join(rest, "doc")), "across")
    for choose in (closest, lambda pairs: between(pairs, labels)):
        more = stored(similar(choose(across), texts), "links")
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = stored(components(links), "labels")

    found = classes.join(labels, F.col("first") == F.col("node"), "left")
    found = stored(found.select(*set_key, F.coalesce("component", "first").alias("class_component")), "found")
    # sketches of documents that are linked with nothing meet no class
    joined = sketches.withColumn("a", F.when(F.col("doc").isNotNull() & (F.col("n_shingles") > 0), F.col("set_a")))
    right = found.toDF("n_of", "a_of", "b_of", "class_component")
    same = F.expr("n_shingles = n_of and a = a_of and set_b = b_of")
    component = F.coalesce("class_component", "doc")
    return joined.join(right, same, "left").select(
        F.col("doc").alias("doc_id"),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"),
    )


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ \t\n\x0B\f\r]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT p.a, p.b FROM (
    SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS common
    FROM shingles l JOIN shingles r ON l.s = r.s AND l.doc_id <> r.doc_id GROUP BY ALL) p
  JOIN sizes x ON x.doc_id = p.a JOIN sizes y ON y.doc_id = p.b
  WHERE 100 * common >= 75 * (x.n + y.n - common)
), reached(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), smallest AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN smallest USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""
