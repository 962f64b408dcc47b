"""Substring dedup: passages of 50 words or more that an earlier document holds, by suffix automata."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lines import NO_ID
from .storage import prepare, stored, with_plain_names
from .words import Words, find_words, gram_hashes, groups, mix

#: Words of a window.
WINDOW = 50
#: Words of an anchor. A window's anchor is the run of so many words in it with the smallest hash.
ANCHOR = 12
#: A reference shard of a document holds the anchors that begin in so many of its words.
BLOCK = 20_000


class SuffixAutomaton:
    """All runs of words of a few passages. It has at most twice as many states as the passages words."""

    def __init__(self, passages: Iterable[list[bytes]]) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for number, passage in enumerate(passages):
            for word in [*passage, number]:  # a number ends a passage: no word equals it
                last = self._extend(last, word)

    def _extend(self, last: int, word) -> int:
        step, link, length = self.next, self.link, self.length
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and word not in step[p]:
            step[p][word] = new
            p = link[p]
        if p >= 0:
            q = step[p][word]
            if length[q] != length[p] + 1:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(word) == q:
                    step[p][word] = copy
                    p = link[p]
                link[q] = copy
                q = copy
            link[new] = q
        return new

    def matches(self, words: list[bytes], least: int) -> list[tuple[int, int]]:
        """Maximal parts of ``words`` that every run of ``least`` words in them stands in a passage: matching
        statistics, the longest match that ends at each word, from one pass."""
        step, link, length = self.next, self.link, self.length
        found: list[tuple[int, int]] = []
        state = long = 0
        for i, word in enumerate(words):
            while state and word not in step[state]:
                state = link[state]
                long = length[state]
            if word in step[state]:
                state = step[state][word]
                long += 1
            if long >= least:
                if found and found[-1][1] == i:
                    found[-1] = (found[-1][0], i + 1)
                else:
                    found.append((i + 1 - least, i + 1))
        return found


def window_anchors(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of the documents: document, start (in its words), and anchor, a hash."""
    per_doc = np.maximum(np.diff(words.first) - WINDOW + 1, 0)
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    if not len(doc):
        return doc, start, np.zeros(0, np.uint64)
    least = gram_hashes(words.hashes, ANCHOR)
    width, wanted = 1, WINDOW - ANCHOR + 1
    while 2 * width <= wanted:  # the minimum of runs of 1, 2, 4 ... anchors
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = wanted - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    return doc, start, least[words.first[doc] + start]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text) to (anchor, doc, block), a row for each distinct anchor of a document."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for first, texts in groups(batch, "text"):
            doc, start, anchor = window_anchors(find_words(texts))
            new = np.ones(len(doc), bool)  # a window mostly has the anchor of the one before
            new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
            doc, start, anchor = doc[new], start[new], anchor[new]
            order = np.lexsort((start, anchor, doc))
            doc, start, anchor = doc[order], start[order], anchor[order]
            new = np.ones(len(doc), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
            blocks = (start[new] // BLOCK).astype(np.int32)
            arrays = [_signed(anchor[new]), pa.array(ids[first + doc[new]]), pa.array(blocks)]
            yield pa.RecordBatch.from_arrays(arrays, ["anchor", "doc", "block"])


def _runs(starts: np.ndarray) -> np.ndarray:
    """Sorted window starts as rows (first, last) of consecutive ones."""
    cut = np.flatnonzero(np.diff(starts) > 1) + 1
    return np.stack([starts[np.concatenate([[0], cut])], starts[np.concatenate([cut - 1, [len(starts) - 1]])]], 1)


def _spans(runs: np.ndarray) -> list[tuple[int, int]]:
    """Word spans that the windows of the runs cover, merged where they touch."""
    spans: list[tuple[int, int]] = []
    for first, last in runs.tolist():
        if spans and first <= spans[-1][1]:
            spans[-1] = (spans[-1][0], last + WINDOW)
        else:
            spans.append((first, last + WINDOW))
    return spans


PIECE = "ref_doc long, ref_block int, doc long, version long, is_ref boolean, runs binary, words binary"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, version, text, hits) to pieces: for each reference shard that a document may share windows
    with, the runs of these windows and the words they cover. Where the shard is the document's own,
    the piece is the reference, with each distinct window once."""
    schema = pa.schema(
        [("ref_doc", pa.int64()), ("ref_block", pa.int32()), ("doc", pa.int64()), ("version", pa.int64())]
        + [("is_ref", pa.bool_()), ("runs", pa.binary()), ("words", pa.binary())]
    )
    for batch in batches:
        rows = []
        for first, texts in groups(batch, "text"):
            words = find_words(texts)
            doc_of, start, anchor = window_anchors(words)
            edges = np.searchsorted(doc_of, np.arange(len(texts) + 1))
            for i in range(len(texts)):
                hits = batch.column(3)[first + i].values
                if hits is None or edges[i] == edges[i + 1]:
                    continue
                doc, version = batch.column(0)[first + i].as_py(), batch.column(1)[first + i].as_py()
                shared = hits.field("anchor").to_numpy().view(np.uint64)
                order = np.argsort(shared)
                shared = shared[order]
                refs = np.stack([hits.field("ref_doc").to_numpy()[order], hits.field("ref_block").to_numpy()[order]], 1)
                own = anchor[edges[i] : edges[i + 1]]
                at = np.minimum(np.searchsorted(shared, own), len(shared) - 1)
                starts = np.flatnonzero(shared[at] == own)
                if not len(starts):
                    continue
                shards, shard_of = np.unique(refs[at[starts]], axis=0, return_inverse=True)
                for k, (ref_doc, ref_block) in enumerate(shards.tolist()):
                    chosen = starts[shard_of.ravel() == k]
                    if ref_doc == doc:  # each distinct window once
                        grams = gram_hashes(words.hashes[words.of(i)], WINDOW)[chosen]
                        chosen = np.sort(chosen[np.unique(grams, return_index=True)[1]])
                    runs = _runs(chosen)
                    base = words.first[i]
                    covered = b"\n".join(
                        words.joined(np.arange(base + a, base + b), i) for a, b in _spans(runs)
                    )
                    rows.append((ref_doc, ref_block, doc, version, ref_doc == doc, runs.astype(np.int64).tobytes(), covered))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


FOUND = "doc long, version long, first long, last long, hash_a long, hash_b long"


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ref_doc, ref_block, ref_words, doc, version, runs, words), sorted by shard, to word spans that stand
    in the shard, and the remaining windows with their hashes."""
    names = [c.split()[0] for c in FOUND.split(", ")]
    last, automaton = None, None
    for batch in batches:
        out: list[tuple] = []
        for r in range(batch.num_rows):
            reference = batch.column(2)[r]
            key = (batch.column(0)[r].as_py(), batch.column(1)[r].as_py(), reference.as_py())
            if key != last:
                last = key
                automaton = SuffixAutomaton(p.split(b" ") for p in key[2].split(b"\n"))
            doc, version = batch.column(3)[r].as_py(), batch.column(4)[r].as_py()
            runs = np.frombuffer(batch.column(5)[r].as_py(), np.int64).reshape(-1, 2)
            passages = batch.column(6)[r].as_py().split(b"\n")
            spans = _spans(runs)
            matched = []
            for (start, _), passage in zip(spans, passages):
                for a, b in automaton.matches(passage.split(b" "), WINDOW):
                    matched.append((start + a, start + b))
                    out.append((doc, version, start + a, start + b, None, None))
            windows = np.concatenate([np.arange(a, b + 1) for a, b in runs.tolist()])
            if matched:
                a, b = np.array(matched).T
                at = np.searchsorted(a, windows, "right") - 1
                windows = windows[(at < 0) | (windows + WINDOW > b[np.maximum(at, 0)])]
            if len(windows):
                words = find_words([b" ".join(passages)])
                begin = np.array([a for a, _ in spans])
                shift = np.concatenate([[0], np.cumsum([b - a for a, b in spans])])
                span = np.searchsorted(begin, windows, "right") - 1
                place = windows - begin[span] + shift[span]
                one = gram_hashes(words.hashes, WINDOW)[place].view(np.int64).tolist()
                two = gram_hashes(mix(words.hashes ^ np.uint64(0x5851F42D4C957F2D)), WINDOW)[place].view(np.int64).tolist()
                out += [(doc, version, w, w + WINDOW, x, y) for w, x, y in zip(windows.tolist(), one, two)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Word spans of (doc, version, text) to remove: (doc, version, spans).

    1. Two equal windows have equal anchors. Anchors that only one document has are left out; of the
       others, the smallest document is the reference, and its windows with them are reference shards
       of bounded size.
    2. A document's windows with shared anchors go to the shards of these anchors, where a suffix automaton of
       the shard gives their matching statistics. Not every document meets every shard, so the work
       grows with the repeated text.
    3. A window that the smallest holder of its anchor does not have may still repeat one of another
       document. Of these few, equal ones are found by their hashes of 128 bits.
    """
    rows = stored(docs.select("doc", "text").mapInArrow(_anchor_rows, "anchor long, doc long, block int"), "anchors")
    first = rows.groupBy("anchor").agg(F.min(F.struct("doc", "block")).alias("ref"), F.max("doc").alias("last"))
    first = stored(first.where("ref.doc < last").select("anchor", "ref"), "shared")
    hit = F.struct("anchor", F.col("ref.doc").alias("ref_doc"), F.col("ref.block").alias("ref_block"))
    hits = rows.join(first, "anchor").groupBy("doc").agg(F.collect_list(hit).alias("hits"))
    pieces = docs.join(stored(hits, "hits"), "doc").select("doc", "version", "text", "hits")
    pieces = stored(pieces.mapInArrow(_pieces, PIECE), "pieces")
    shard = ["ref_doc", "ref_block"]
    shards = pieces.where("is_ref").select(*shard, F.col("words").alias("ref_words"))
    queries = pieces.where("not is_ref").select(*shard, "doc", "version", "runs", "words")
    met = queries.join(shards, shard).select(*shard, "ref_words", "doc", "version", "runs", "words")
    found = stored(met.sortWithinPartitions(*shard).mapInArrow(_match, FOUND), "found")
    rest = found.where("hash_a is not null")
    equal = rest.groupBy("hash_a", "hash_b").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    equal = stored(equal.where("low < high"), "equal")
    more = rest.join(equal, ["hash_a", "hash_b"]).where("doc > low")
    spans = found.where("hash_a is null").select("doc", "version", "first", "last")
    spans = spans.unionByName(more.select("doc", "version", "first", "last"))
    return spans.groupBy("doc", "version").agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """Remove every word that a window of 50 words covers which also starts in a document with a smaller
    ``doc_id``. Windows are compared on the input, so what is removed does not depend on an order of work.

    ``docs`` has ``doc_id`` and ``text``; all its columns are returned, with the new text (the kept words,
    joined by one space; a text that loses nothing stays as it is), ``n_words`` and ``n_removed`` (which replace
    columns of that name). Null and empty texts have no words and stay. Rows with equal ids are one
    document, rows without an id a document before all others. Repeated rows stay, an empty table stays empty.
    Other columns may have any names.
    """
    docs = docs.drop("n_words", "n_removed")
    return with_plain_names(docs, ("doc_id", "text"), _substring_dedup)


def _substring_dedup(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    columns = docs.columns
    own_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    version = F.xxhash64("text")
    spans = repeated_spans(docs.select(own_id.alias("doc"), version.alias("version"), "text"))
    spans = stored(spans, "spans").toDF("__span_doc", "__span_version", "__spans")
    keyed = docs.select(*columns).withColumn("__doc", own_id).withColumn("__version", version)
    same = F.expr("__doc = __span_doc and __version = __span_version")
    joined = keyed.join(spans, same, "left").select(*columns, "__spans")
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in docs.select(*columns).schema]
        + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    )
    place = columns.index("text")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in groups(batch, "text"):
                rows = batch.slice(first, len(texts))
                words = find_words(texts)
                n_words = np.diff(words.first)
                n_removed = np.zeros(len(texts), np.int64)
                old = rows.column(place)
                kept = old.to_pylist()
                for i in np.flatnonzero(rows.column(len(columns)).is_valid().to_numpy(zero_copy_only=False)).tolist():
                    spans = rows.column(len(columns))[i].values
                    edge = np.zeros(n_words[i] + 1, np.int64)
                    np.add.at(edge, spans.field("first").to_numpy(), 1)
                    np.add.at(edge, spans.field("last").to_numpy(), -1)
                    stays = np.cumsum(edge[:-1]) == 0
                    n_removed[i] = n_words[i] - stays.sum()
                    kept[i] = words.joined(words.first[i] + np.flatnonzero(stays), i).decode()
                arrays = [pa.array(kept, pa.string()) if c == "text" else rows.column(k) for k, c in enumerate(columns)]
                arrays += [pa.array(n_words.astype(np.int64)), pa.array(n_removed)]
                yield pa.RecordBatch.from_arrays(arrays, [*columns, "n_words", "n_removed"])

    return joined.mapInArrow(remove, schema)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    # kept words joined by one space, also of texts that lose nothing
    spaces = r"[\x20\x09-\x0D]+"
    text = F.btrim(F.regexp_replace(F.coalesce("text", F.lit("")), spaces, " "), F.lit(" "))
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2(text, 256).alias("kept_sha256"))


SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)
), seen AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) < doc_id AS repeated FROM windows
), gone AS (
  SELECT DISTINCT doc_id, i + k AS p FROM seen, range(50) r(k) WHERE repeated
), flat AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words
), marked AS (
  SELECT f.doc_id, f.word, f.p, g.p IS NOT NULL AS removed FROM flat f LEFT JOIN gone g ON g.doc_id = f.doc_id AND g.p = f.p
), summed AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE removed) AS n_removed,
         string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT removed) AS kept
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN summed USING (doc_id)
"""
