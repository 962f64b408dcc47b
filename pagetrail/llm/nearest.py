"""Exact top-k search by inner product: ball trees of shards, searched by branch and bound.

Vectors are dealt out to shards of like vectors. A shard's ball tree bounds the inner product of a query with
everything below a node by ``query . centre + |query| * radius``. A query searches the shard with the best bound first; its
kth score goes along to every other shard whose bound is not below that score, and to no more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import prepare, stored

#: Components are multiplied by this and rounded down.
SCALE = 256
#: Distinct vectors in a shard and queries in a block, up to MAX_SHARDS shards; shards are larger beyond that.
SHARD_ROWS = 4096
BLOCK_ROWS = 4096
MAX_SHARDS = 4096
#: Vectors for each shard that the splits between shards are fitted on: at most MAX_SHARDS times as many in all.
SAMPLE = 32
LEAF = 64
#: Pairs of query and node whose bounds are held at a time.
PAIRS = 1 << 21


class Router:
    """Splits space into regions: each inner node sends a vector left or right of a plane.

    Fitted on a sample, so that every region has about as many vectors of it.
    """

    def __init__(self, sample: np.ndarray, regions: int) -> None:
        self.planes: dict[int, tuple[np.ndarray, float]] = {}
        self.regions = 0
        self.region: dict[int, int] = {}
        waiting = [(1, sample.astype(np.float64), regions)]
        while waiting:
            node, points, parts = waiting.pop()
            if parts > 1 and (split := halves(points, parts // 2 / parts)) is not None:
                direction, at, right = split
                self.planes[node] = direction, at
                waiting += [(2 * node, points[~right], parts // 2), (2 * node + 1, points[right], parts - parts // 2)]
            else:
                self.region[node] = self.regions
                self.regions += 1

    def __call__(self, vectors: np.ndarray) -> np.ndarray:
        found = np.zeros(len(vectors), np.int64)
        waiting = [(1, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            if node in self.region:
                found[rows] = self.region[node]
            elif len(rows):
                direction, at = self.planes[node]
                right = vectors[rows].astype(np.float64) @ direction >= at
                waiting += [(2 * node, rows[~right]), (2 * node + 1, rows[right])]
        return found


def halves(points: np.ndarray, part: float = 0.5) -> tuple[np.ndarray, float, np.ndarray] | None:
    """A direction between two far points, a threshold on it, and which points lie on its right. None if the
    points are all the same."""
    far = points[np.argmax(((points - points[0]) ** 2).sum(1))]
    direction = points[np.argmax(((points - far) ** 2).sum(1))] - far
    along = points @ direction
    at = np.sort(along)[min(len(along) - 1, max(1, round(len(along) * part)))]
    right = along >= at
    if right.all():  # many points on one side: cut above them
        right = along > at
        at = along[right].min() if right.any() else at
    return (direction, float(at), right) if right.any() and not right.all() else None


class Balls:
    """A ball tree: nodes in breadth-first order, each with centre, radius and a run of rows; small nodes are leaves."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF) -> None:
        points = vectors.astype(np.float64)
        order = np.arange(len(points))
        centres, radii, runs, children = [], [], [], []
        waiting = [(0, len(points))] if len(points) else []
        at = 0
        while at < len(waiting):
            low, high = waiting[at]
            at += 1
            own = points[order[low:high]]
            centre = own.mean(0)
            centres.append(centre)
            radii.append(np.sqrt(((own - centre) ** 2).sum(1).max()))
            runs.append((low, high))
            split = halves(own) if high - low > leaf else None
            if split is None:
                children.append(-1)
                continue
            right = split[2]
            order[low:high] = np.concatenate([order[low:high][~right], order[low:high][right]])
            middle = high - int(right.sum())
            children.append(len(waiting))
            waiting += [(low, middle), (middle, high)]
        self.order, self.runs, self.children = order, runs, np.array(children, np.int64)
        self.centres, self.radii = np.array(centres), np.array(radii)


def upper_bounds(queries: np.ndarray, lengths: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """No inner product of a query with a vector in the ball is above this: [query, ball]. Rounding is allowed for."""
    reach = np.outer(lengths, radii + np.sqrt((centres**2).sum(1)) * 1e-9)
    return (queries @ centres.T + reach) * (1 + 1e-12) + reach * 1e-9 + 1e-3


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors."""
    if not len(queries) or not len(vectors) or not queries.shape[1]:
        return np.zeros((len(queries), len(vectors)), np.int64)
    largest = [max(int(x.max()), -int(x.min())) for x in (queries, vectors)]
    most = largest[0] * largest[1] * queries.shape[1]
    if most < 1 << 53:  # sums of doubles are exact
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    if most >= 1 << 63:
        raise ValueError("inner products of these vectors do not fit in 64 bits")
    return queries @ vectors.T


def search(queries: np.ndarray, floors: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best rows of every query among vectors: (query, row, score), those below the query's floor left out.

    Ties go to the smaller id. A query keeps the nodes whose bound, and whose parents' bounds, reach its floor. It
    takes its leaves from the best bound on, and stops where the bound is below its kth score.
    """
    none = np.zeros(0, np.int64)
    if not len(queries) or not len(vectors):
        return none, none, none
    tree = Balls(vectors)
    step = max(1, PAIRS // len(tree.runs))
    found = []
    for at in range(0, len(queries), step):
        query, row, score = _search_some(queries[at : at + step], floors[at : at + step], tree, vectors, ids, k)
        found.append((query + at, row, score))
    return tuple(np.concatenate(x) for x in zip(*found))


def _search_some(
    queries: np.ndarray, floors: np.ndarray, tree: Balls, vectors: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, ...]:
    as_double = queries.astype(np.float64)
    kth = floors.astype(np.int64).copy()
    reached = upper_bounds(as_double, np.sqrt((as_double**2).sum(1)), tree.centres, tree.radii)
    alive = reached >= kth[:, None]
    for node, child in enumerate(tree.children):  # a node is met only below nodes that were
        if child >= 0:
            alive[:, child] &= alive[:, node]
            alive[:, child + 1] &= alive[:, node]
    leaves = np.flatnonzero(tree.children < 0)
    bound = np.where(alive[:, leaves], reached[:, leaves], -np.inf)
    turns = np.argsort(-bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, turns, axis=1)

    best_score = np.full((len(queries), k), -np.iinfo(np.int64).max)  # can be negated
    best_row = np.full((len(queries), k), -1)
    low_id = np.concatenate([ids, [np.iinfo(np.int64).max]])  # of no row
    for turn in range(len(leaves)):
        open_ = np.flatnonzero(bound[:, turn] >= kth)
        if not len(open_):
            break
        order = open_[np.argsort(turns[open_, turn], kind="stable")]
        for own in np.split(order, np.flatnonzero(np.diff(turns[order, turn])) + 1):
            low, high = tree.runs[leaves[turns[own[0], turn]]]
            rows = tree.order[low:high]
            scores = np.concatenate([best_score[own], products(queries[own], vectors[rows])], axis=1)
            both = np.concatenate([best_row[own], np.broadcast_to(rows, (len(own), len(rows)))], axis=1)
            first = np.lexsort((low_id[both], -scores), axis=1)[:, :k]
            best_score[own] = np.take_along_axis(scores, first, axis=1)
            best_row[own] = np.take_along_axis(both, first, axis=1)
            kth[own] = np.maximum(kth[own], best_score[own, -1])
    query, place = np.nonzero((best_row >= 0) & (best_score >= floors[:, None]))
    return query, best_row[query, place], best_score[query, place]


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dim) if dim else np.zeros((len(column), 0), np.int64)


def whole_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, key, vector) of the rows that take part, with whole components."""
    component = lambda x: F.floor(x.cast("double") * SCALE)
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    known = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", finite))
    whole = known.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", component).alias("vector"))
    return whole.select("vec_id", F.md5(F.array_join("vector", ",").cast("binary")).alias("key"), "vector")


def smallest_ids(rows: DataFrame, k: int) -> DataFrame:
    """(key, vec_id) of the k smallest ids of every key, repeated ids included: no more of equal vectors can be among
    the k best. Spark limits each key before the shuffle, too, so a vector may have any number of rows."""
    first = Window.partitionBy("key").orderBy("vec_id")
    placed = rows.select("key", "vec_id").withColumn("place", F.row_number().over(first))
    return placed.where(F.col("place") <= k).drop("place")


def _by_region(numbers: dict[int, int]) -> Column:
    """A column of the number for the row's region; 1 where none is given."""
    if not numbers:
        return F.lit(1)
    table = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    return F.coalesce(table[F.col("region")], F.lit(1))


def shards_of(vectors: DataFrame, shard_rows: int) -> DataFrame:
    """(region, part, dim, key, ids, vector) of distinct vectors: a shard is a part of a region.

    Regions come from planes fitted on a bounded sample, the vectors with the smallest keys. A region of more
    than twice the rows aimed at is cut by a hash of the key, so that a shard is bounded whatever the sample.
    """
    n = vectors.count()
    aim = max(shard_rows, -(-n // MAX_SHARDS))
    regions = max(1, -(-n // aim))
    rows = vectors.orderBy("key").limit(regions * SAMPLE).select("vector").toPandas()["vector"]
    by_dim: dict[int, list[np.ndarray]] = {}
    for v in rows:
        by_dim.setdefault(len(v), []).append(np.asarray(v))
    routers: dict[int, tuple[Router, int]] = {}
    used = 0
    for dim, points in sorted(by_dim.items()):
        if dim:
            routers[dim] = Router(np.array(points), max(1, round(regions * len(points) / len(rows)))), used
            used += routers[dim][0].regions

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            dims = lists.value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                some = batch.filter(pa.array(dims == dim))
                flat = some.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(some.num_rows, dim)
                if dim in routers:
                    router, first = routers[dim]
                    region = router(flat) + first
                else:  # not in the sample: a region of its own
                    region = np.full(some.num_rows, -1 - dim)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(region.astype(np.int32)),
                        pa.array(np.full(some.num_rows, dim, np.int32)),
                        some.column("key"),
                        some.column("ids"),
                        pa.array([v.tobytes() for v in flat], pa.binary()),
                    ],
                    ["region", "dim", "key", "ids", "vector"],
                )

    routed = vectors.select("key", "ids", "vector").mapInArrow(
        route, "region int, dim int, key string, ids array<bigint>, vector binary"
    )
    routed = stored(routed, "vectors-routed")
    large = routed.groupBy("region").count().where(F.col("count") > 2 * aim).collect()
    parts = _by_region({r["region"]: -(-r["count"] // aim) for r in large})
    return routed.withColumn("part", F.pmod(F.xxhash64("key"), parts).cast("int"))


def shard_balls(shards: DataFrame) -> list[tuple[int, int, int, np.ndarray, float]]:
    """(region, part, dim, centre, radius) of every shard: at most a few times MAX_SHARDS rows."""

    def ball(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        points = _matrix(table.column("vector"), dim).astype(np.float64)
        centre = points.mean(0)
        radius = np.sqrt(((points - centre) ** 2).sum(1).max())
        columns = [table.column(c)[:1] for c in ("region", "part", "dim")]
        return pa.table([*columns, pa.array([centre.tobytes()]), pa.array([radius])], names=["region", "part", "dim", "centre", "radius"])

    found = shards.groupBy("region", "part").applyInArrow(ball, "region int, part int, dim int, centre binary, radius double")
    return [(r["region"], r["part"], r["dim"], np.frombuffer(r["centre"]), r["radius"]) for r in found.collect()]


def _in_blocks(queries: DataFrame, shards: DataFrame, block_rows: int, k: int) -> DataFrame:
    """(key, vec_id, own_key, score): k best of every (query, shard) in the list, in blocks of queries.

    A block meets its shard in one task; a shard is copied for each block of queries that it has.
    """
    counts = queries.groupBy("region", "part").count().where(F.col("count") > block_rows).collect()
    blocks: dict[int, int] = {}
    for r in counts:  # regions with several parts take the largest number
        blocks[r["region"]] = max(blocks.get(r["region"], 1), -(-r["count"] // block_rows))
    of_region = _by_region(blocks)
    queries = queries.withColumn("block", F.pmod(F.xxhash64("key"), of_region).cast("int"))
    copies = F.sequence(F.lit(0), (of_region - 1).cast("int"))
    wanted = queries.select("region", "part", "block").distinct()
    copied = shards.withColumn("block", F.explode(copies)).join(wanted, ["region", "part", "block"], "left_semi")

    def best(asked: pa.Table, shard: pa.Table) -> pa.Table:
        if not asked.num_rows or not shard.num_rows:
            return pa.table([pa.array([], t) for t in (pa.string(), pa.int64(), pa.string(), pa.int64())], names=names)
        dim = shard.column("dim")[0].as_py()
        ids = shard.column("ids").to_pylist()
        query, row, score = search(
            _matrix(asked.column("vector"), dim),
            asked.column("floor").to_numpy(),
            _matrix(shard.column("vector"), dim),
            np.array([x[0] for x in ids]),
            k,
        )
        each = np.array([len(x) for x in ids])[row]
        return pa.table(
            [
                asked.column("key").take(np.repeat(query, each)),
                pa.array([i for r in row.tolist() for i in ids[r]], pa.int64()),
                shard.column("key").take(np.repeat(row, each)),
                pa.array(np.repeat(score, each)),
            ],
            names=names,
        )

    names = ["key", "vec_id", "own_key", "score"]
    keys = ("region", "part", "block")
    pairs = queries.groupBy(*keys).cogroup(copied.groupBy(*keys))
    return pairs.applyInArrow(best, "key string, vec_id long, own_key string, score long")


def top_k(rows: DataFrame, asked: Column, k: int = 5, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k other rows with the largest inner product with each row that is asked for.

    ``rows`` has ``vec_id`` and ``embedding``, ``asked`` is a condition on ``vec_id``; other columns are not
    read. Ties go to the smaller id. A row without an id, without a vector, or with a null or non-finite component takes
    no part. Vectors are compared with those of their length only. Rows that repeat an id are rows of their own:
    each is a candidate of the others, and each gives its answers if asked. Equal vectors are searched once. Scores
    have to fit in 64 bits, else the job ends with an error. Empty tables and queries without candidates give no rows.
    """
    prepare(rows.sparkSession)
    whole = stored(whole_vectors(rows), "vectors")
    # one more than k, as a query finds itself
    few = smallest_ids(whole, k + 1).groupBy("key").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    vectors = whole.groupBy("key").agg(F.min("vector").alias("vector")).join(few, "key")
    shards = stored(shards_of(stored(vectors, "vectors-distinct"), shard_rows), "vectors-shards")
    balls = shard_balls(shards)
    if not balls:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    by_dim = {d: [b for b in balls if b[2] == d] for d in {b[2] for b in balls}}
    centres = {d: np.array([b[3] for b in own]) for d, own in by_dim.items()}
    radii = {d: np.array([b[4] for b in own]) for d, own in by_dim.items()}
    names = {d: np.array([b[:2] for b in own], np.int32) for d, own in by_dim.items()}

    def shards_to_search(first: bool):
        """The shard with the best bound, or all others whose bound reaches the query's floor."""

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims = batch.column("dim").to_numpy()
                for dim in np.unique(dims).tolist():
                    some = batch.filter(pa.array(dims == dim))
                    vectors = _matrix(some.column("vector"), dim).astype(np.float64)
                    bound = upper_bounds(vectors, np.sqrt((vectors**2).sum(1)), centres[dim], radii[dim])
                    home = bound.argmax(1)
                    if first:
                        query, shard = np.arange(len(home)), home
                    else:
                        reached = bound >= some.column("floor").to_numpy()[:, None]
                        reached[np.arange(len(home)), home] = False
                        query, shard = np.nonzero(reached)
                    chosen = some.take(pa.array(query))
                    region, part = (pa.array(names[dim][shard, c]) for c in (0, 1))
                    yield pa.RecordBatch.from_arrays(
                        [region, part, chosen.column("key"), chosen.column("vector"), chosen.column("floor")],
                        ["region", "part", "key", "vector", "floor"],
                    )

        return pick

    target = "region int, part int, key string, vector binary, floor long"
    asked_rows = whole.where(asked).select(F.col("vec_id").alias("query_id"), "key")
    distinct = shards.join(asked_rows.select("key").distinct(), "key", "left_semi").select("key", "dim", "vector")
    lowest = F.lit(np.iinfo(np.int64).min).cast("long")
    # home shards first; the kth score found there is the floor for all others
    queries = stored(distinct.withColumn("floor", lowest), "vectors-asked")
    home = stored(queries.mapInArrow(shards_to_search(True), target), "vectors-home")
    found = stored(_in_blocks(home, shards, block_rows, k + 1), "vectors-found")
    best_first = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    kth = found.withColumn("place", F.row_number().over(best_first)).where(F.col("place") == k + 1).select("key", F.col("score").alias("kth"))
    queries = queries.join(kth, "key", "left").select("key", "dim", "vector", F.coalesce("kth", "floor").alias("floor"))
    others = stored(queries.mapInArrow(shards_to_search(False), target), "vectors-others")
    found = found.unionByName(_in_blocks(others, shards, block_rows, k + 1))
    found = found.withColumn("place", F.row_number().over(best_first)).where(F.col("place") <= k + 1)

    # every row that asked takes the answers of its vector without itself
    answers = asked_rows.withColumn("row", F.monotonically_increasing_id()).join(found, "key")
    itself = (F.col("own_key") == F.col("key")) & (F.col("vec_id") == F.col("query_id"))
    copy = Window.partitionBy("query_id", "row").orderBy("itself", "place")
    order = Window.partitionBy("query_id", "row").orderBy("place")
    answers = answers.withColumn("itself", itself).withColumn("nth", F.row_number().over(copy))
    last_copy = Window.partitionBy("query_id", "row")
    own = F.max(F.when(F.col("itself"), F.col("nth"))).over(last_copy)
    others_only = answers.withColumn("own", own).where(~F.col("itself") | (F.col("nth") < F.col("own")))
    ranked = others_only.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op13_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


SQL = r"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT q.vec_id AS query_id,
       row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id)::INT AS rank,
       c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
FROM whole q JOIN whole c ON c.vec_id <> q.vec_id
WHERE q.vec_id % 50 = 0
QUALIFY rank <= 5
"""
