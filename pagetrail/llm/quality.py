"""Quality classifier by compression: which labelled texts does a text compress like?"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import prepare, with_plain_names
from .words import groups

#: Labelled documents of each class that the model learns from at most: half of them go into the class's
#: dictionary, half into the calibration. They are the first by a hash of their id.
SAMPLE = 2000
DICTIONARY_BYTES = 112_640
LEVEL = 3
#: Documents with a lower score are rejected.
ACCEPT = 0.3


class Model(NamedTuple):
    good: bytes | None  # zstandard dictionaries
    bad: bytes | None
    weights: tuple[float, ...]


def _dictionary(texts: list[bytes]) -> bytes | None:
    texts = [t for t in texts if t]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts, k=200, d=8).as_bytes()
    except zstandard.ZstdError:  # too few texts to choose from: they are the dictionary
        return b"\n".join(texts)[-DICTIONARY_BYTES:] or None


def _compressor(dictionary: bytes | None) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if data:
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_dict_id=False)
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)


def features(model: Model, texts: list[bytes]) -> np.ndarray:
    """A row for each text: 1, the difference of its compressed sizes as a part of their sum, the
    difference in hundreds of bytes (saturated), and how well it compresses at all (saturated)."""
    good, bad = _compressor(model.good), _compressor(model.bad)
    sizes = np.array([(len(good.compress(t)), len(bad.compress(t)), len(t)) for t in texts], float).reshape(-1, 3)
    g, b, n = sizes.T
    ratio = np.minimum(np.minimum(g, b) / np.maximum(n, 1), 0.3)
    return np.stack([np.ones(len(sizes)), 20 * (b - g) / (b + g), np.tanh((b - g) / 100), 10 * ratio], 1)


def _calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a slight ridge, by Newton's method."""
    ridge = np.diag([1e-3, *[1e-1] * (x.shape[1] - 1)])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        w = w + np.clip(np.linalg.solve(slope, x.T @ (weight * (y - p)) - ridge @ w), -5, 5)
    return w


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality) whose crc32(doc_id as text) mod 5
    is not 0, from at most ``sample`` rows of each class.

    Ids are chosen first; only one text of each chosen id comes to the driver, if its rows differ that with the smallest
    hash. The calibration weighs classes as they
    occur among all labels. With labels of one class only, every text gets the share of that class; a row that is
    labelled both ways counts in both.
    """
    prepare(docs.sparkSession)
    labels = labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label"))
    known = labels.where("label in (0, 1) and id is not null and crc32(cast(id as string)) % 5 <> 0").distinct()
    known = known.join(docs.select(F.col("doc_id").alias("id")).distinct(), "id")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("id")
    chosen = [known.where(F.col("label") == k).orderBy(order, "id").limit(sample) for k in (0, 1)]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 * sample rows at most
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.col("doc_id").alias("id"), text.alias("text")).join(chosen, "id")
    one = F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")  # combined before the shuffle
    rows = texts.groupBy("id", "label").agg(one).collect()
    by_class: dict[int, list[bytes]] = {0: [], 1: []}
    for r in sorted(rows, key=lambda r: (r["id"], r["text"])):
        by_class[r["label"]].append(r["text"].encode())
    pairs = [(texts[::2], texts[1::2]) for texts in (by_class[0], by_class[1])]
    model = Model(_dictionary(pairs[1][0]), _dictionary(pairs[0][0]), ())
    rest = [pairs[k][1] for k in (0, 1)]
    if not rest[0] or not rest[1]:
        share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
        return model._replace(weights=(float(np.log(share / (1 - share))), 0.0, 0.0, 0.0))
    y = np.repeat([0.0, 1.0], [len(rest[0]), len(rest[1])])
    weight = np.repeat([counts[k] / len(rest[k]) for k in (0, 1)], [len(rest[0]), len(rest[1])])
    weights = _calibrate(features(model, rest[0] + rest[1]), y, weight * len(y) / weight.sum())
    return model._replace(weights=tuple(float(w) for w in weights))


def score(docs: DataFrame, model: Model, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (by default all) and ``score``, the probability that the text's quality is 1.

    Only ``text`` decides, as a whole. A null text scores as an empty one. Every row gives a row, an empty table
    stays empty. A column named ``score`` is replaced; other columns may have any names.
    """
    docs = docs.drop("score")
    wanted = [docs.columns.index(c) for c in columns or docs.columns if c != "score"]
    return with_plain_names(docs, ("text",), lambda plain: _score(plain, model, [plain.columns[k] for k in wanted]))


def _score(docs: DataFrame, model: Model, kept: list[str]) -> DataFrame:
    fields = docs.select(*kept).schema.fields
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [T.StructField("score", T.DoubleType())])
    # the text comes last, once more, so that it need not be among the columns
    rows = docs.select(*kept, F.col("text").alias("__text"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in groups(batch, "__text"):
                x = features(model, texts)
                p = 1 / (1 + np.exp(-np.clip(x @ np.array(model.weights), -30, 30)))
                part = batch.slice(first, len(texts))
                arrays = [part.column(i) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(p)], [*kept, "score"])

    return rows.mapInArrow(compute, schema)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model, ["doc_id"]).select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )
