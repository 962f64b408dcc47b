"""Best-fit packing of token sequences by a configuration linear program."""

from __future__ import annotations

import logging
import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranking import ranked
from .storage import prepare, stored
from .tokens import word_tokenizer
from .words import groups, larger

logger = logging.getLogger(__name__)

CAPACITY = 2048
#: Rounds of multiplicative weights, each with one knapsack. There are more while a length is not covered.
ROUNDS = 300
#: Relative distance from the best that is good enough.
SLACK = 0.005
#: Parts of the fractional solution that are tried for rounding; best fit has the rest, with 0 everything.
SHARES = (1.0, 0.9, 0.7, 0.5, 0.0)
#: Parts into which the pieces of one length are cut for ranking.
PARTS = 256


class Use(NamedTuple):
    """``count`` sequences that hold the same lengths: (length, copies) pairs."""

    items: tuple[tuple[int, int], ...]
    count: int


def _knapsack(value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room up to ``capacity``: the highest value of lengths, with repetition, of at most that sum, and the
    longest length that it can begin with (0: as for a room less). value[l] is for length l."""
    best = np.zeros(capacity + 1)
    pick = np.zeros(capacity + 1, np.int64)
    turned = value[capacity:0:-1].copy()
    for room in range(1, capacity + 1):
        # value[l] + best[room - l] for l = room ... 1
        gains = turned[capacity - room :] + best[:room]
        k = int(gains.argmax())
        if gains[k] > best[room - 1]:
            best[room], pick[room] = gains[k], room - k
        else:
            best[room] = best[room - 1]
    return best, pick


def configurations(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> tuple[dict[tuple, float], float]:
    """A fractional solution, which covers every length: how often to use each configuration; and the program's lower bound.

    Multiplicative weights for the covering program min sum(x), sum(x_c copies_cl) >= counts_l: the price of a length falls
    exponentially as it is covered. A round has one knapsack and adds, for each length, the configuration of the highest
    price that holds it, if no other has a price higher by more than SLACK; it deals out a small part of each demand.
    Rounds end when the solution is within SLACK of the bound, or after ``rounds``, but not before every length is covered.
    """
    active = counts > 0
    if not active.any():
        return {}, 0.0
    length = np.arange(len(counts))
    lengths = np.flatnonzero(active)
    demand = np.where(active, counts, 1).astype(float)
    covered = np.zeros(len(counts))  # as parts of the demand
    eta = np.log(max(2, len(lengths)))
    step = max(0.02, 4.0 / rounds)
    solution: dict[tuple, float] = {}
    total, bound, done = 0.0, 0.0, 0
    while True:
        least = covered[lengths].min()
        if least > 0 and (done >= rounds or total / least <= (1 + SLACK) * bound):
            return {c: x / least for c, x in solution.items()}, bound
        done += 1
        price = np.where(active, np.exp(-eta * (covered - least)) * length, -1.0)
        best, pick = _knapsack(price, capacity)
        # by the program's dual: no sequence is worth more than best[capacity]
        bound = max(bound, float((price * counts)[lengths].sum() / best[capacity]))
        worth = price[lengths] + best[capacity - lengths]
        near = lengths[worth * (1 + SLACK) >= best[capacity]]
        left = (step * demand).tolist()
        for first in near[np.argsort(covered[near], kind="stable")].tolist():
            if left[first] <= 0:
                continue
            items, room = {first: 1}, capacity - first
            while room > 0:
                l = int(pick[room])
                if l:
                    items[l] = items.get(l, 0) + 1
                room -= l or 1
            x = min(left[l] / n for l, n in items.items())
            if x <= 0:
                continue
            key = tuple(sorted(items.items(), reverse=True))
            solution[key] = solution.get(key, 0.0) + x
            total += x
            for l, n in key:
                left[l] -= x * n
                covered[l] += x * n / demand[l]


def plan(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[Use]:
    """Pack counts[l] pieces of each length l. Works on the histogram only, whatever the number of pieces.

    The fractional solution is rounded down, the rest goes by best fit, longest first. Of several
    roundings, each after shrinking the solution by a factor of SHARES, the best is taken: never one worse than
    best fit alone. The number of sequences and the program's lower bound are logged.
    """
    small = counts.astype(np.int64).copy()
    whole = int(small[capacity])
    small[capacity] = 0
    solution, bound = configurations(small, capacity, rounds)
    plans = [_rounded(small, solution, share, capacity) for share in SHARES]
    best = min(plans, key=lambda uses: sum(u.count for u in uses))
    sequences = whole + sum(u.count for u in best)
    logger.info("%d sequences, at least %d are needed", sequences, whole + math.ceil(bound - 1e-6))
    return ([Use(((capacity, 1),), whole)] if whole else []) + best


def _rounded(counts: np.ndarray, solution: dict[tuple, float], share: float, capacity: int) -> list[Use]:
    left = counts.copy()
    uses: list[Use] = []
    for items, x in solution.items():
        count = min(int(share * x), *(int(left[l]) // n for l, n in items))
        if count:
            uses.append(Use(items, count))
            for l, n in items:
                left[l] -= n * count
    while left.any():
        room, items, top = capacity, [], capacity
        while room:
            fits = np.flatnonzero(left[: min(top, room) + 1])
            if not len(fits):
                break
            l = int(fits[-1])  # the longest that fits
            n = min(int(left[l]), room // l)
            items.append((l, n))
            room -= l * n
            top = l - 1
        count = min(int(left[l]) // n for l, n in items)
        uses.append(Use(tuple(items), count))
        for l, n in items:
            left[l] -= n * count
    return uses


def _places(uses: list[Use]) -> tuple[np.ndarray, ...]:
    """For ranges of ranks within a length: key (length, first rank), copies, first sequence, offset."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for use in uses:
        offset = 0
        for l, n in use.items:
            rows.append((l, taken.get(l, 0), n, sequence, offset))
            taken[l] = taken.get(l, 0) + n * use.count
            offset += l * n
        sequence += use.count
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return (table[:, 0] << 48) + table[:, 1], table[:, 1], table[:, 2], table[:, 3], table[:, 4]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each piece of a document's ids, which end with id 0."""
    prepare(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokenizer(tokenizer)
        for batch in larger(batches):
            for first, texts in groups(batch, "text"):
                ids, edges = encoder.encode(texts)
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                rows = []
                for i in range(len(texts)):
                    a, b = int(edges[i]), int(edges[i + 1])
                    for piece, start in enumerate(range(a, b, capacity)):
                        end = min(start + capacity, b)
                        rows.append((first + i, piece, start - a, end - start, zlib.crc32(raw[4 * start : 4 * end])))
                row, *rest = zip(*rows)
                doc = batch.column(0).take(pa.array(row))
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
                arrays = [doc, *(pa.array(c, k) for c, k in zip(rest, kinds))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"])

    given = docs.select(F.col("doc_id").cast("long"), "text")
    return given.mapInArrow(encode, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (doc_id, piece, length).

    The histogram of lengths, at most ``capacity`` rows, goes to the driver and is packed there (``plan``). Pieces
    are ranked within their length, without a task for a whole length, and a rank says where a
    piece goes: a look-up in a table of a few thousand ranges.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():
        counts[row["length"]] = row["n"]
    key, begin, copies, sequence, offset = _places(plan(counts, capacity, rounds))
    part = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(PARTS))
    rows = ranked(pieces, ["length"], part, ["doc_id", "piece"], "__rank", "__of").drop("__of")
    columns = pieces.columns
    kept = [rows.columns.index(c) for c in columns]
    place_length, place_rank = rows.columns.index("length"), rows.columns.index("__rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(place_length).to_numpy(), batch.column(place_rank).to_numpy()
            at = np.searchsorted(key, (length << 48) + rank, "right") - 1
            nth = rank - begin[at]
            arrays = [batch.column(i) for i in kept]
            arrays += [pa.array(sequence[at] + nth // copies[at]), pa.array(offset[at] + nth % copies[at] * length)]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return rows.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenize and pack ``docs`` (doc_id, text; other columns are not used) into sequences of at most
    ``capacity`` ids. A null or empty text is a piece of one id. Repeated rows and rows without an id
    are pieces of their own. ``tokenizer`` is a file as ``WordTokenizer`` takes it, found on every executor."""
    return pack(stored(token_pieces(docs, tokenizer, capacity), "pieces"), capacity)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
