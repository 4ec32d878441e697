"""Approximate nearest neighbours by inner product: an inverted file scanned with adaptive dimension sampling.

Vectors get one more component so that all have the same length; then the largest inner product is the smallest
distance. A fixed random rotation makes the first components of a difference a sample of the whole. Vectors are dealt to lists by
their nearest centroid, and a query probes its nearest lists. Inside a list, distances grow by blocks of
columns; after each block a hypothesis test abandons the candidates whose partial distance, scaled up, can hardly stay
below the bar, the distance of the best found so far. What is left is ranked by exact products of the original vectors.

Equal vectors are kept once with their smallest ids. Short lists share a shard, long ones are cut into
several, and queries are dealt over chunks, so a task holds a bounded number of both.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstream.llm.arrow import batch, importable, map_blocks
from shopstream.llm.graph import written

MAX_LISTS = 4096
SAMPLE = 20_000
SHARD_VECTORS = 4096
CHUNK_QUERIES = 2048
# Candidates that set the first bar of a shard.
FIRST = 256
COLUMNS = 16
# Standard deviations of a partial distance beyond which a candidate is dropped.
SURE = 3.0


class Fit(NamedTuple):
    """``longest``: the norm all vectors are brought to; ``centroids`` are in rotated space."""

    dim: int
    longest: float
    rotation: np.ndarray
    centroids: np.ndarray

    def rotated(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        short = np.maximum(self.longest**2 - (vectors**2).sum(1), 0)
        last = np.zeros(len(vectors)) if query else np.sqrt(short)
        return np.column_stack([vectors, last]) @ self.rotation

    def distances(self, rotated: np.ndarray) -> np.ndarray:
        """Squared distances to the centroids, up to a constant for each row."""
        return (self.centroids**2).sum(1) - 2 * rotated @ self.centroids.T


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec array<double>`` of the rows that take part: finite components, not all zero, of the most frequent length."""
    vec = vectors[f"`{vec_col}`"].cast("array<double>")
    rows = vectors.select(vectors[f"`{id_col}`"].cast("long").alias("id"), vec.alias("vec")).filter(
        "id IS NOT NULL AND size(vec) > 0 AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
        " AND exists(vec, x -> x <> 0)"
    )
    common = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vec") == (common["n"] if common else 0))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """``vid, vec, ids``: each vector once, with its ``keep`` smallest ids."""
    order = Window.partitionBy("vec").orderBy("id")
    firsts = rows.distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= keep)
    return firsts.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        F.monotonically_increasing_id().alias("vid"), "vec", "ids"
    )


def fit(vectors: DataFrame, dim: int, lists: int | None, sample: int, seed: int = 11) -> Fit:
    """Rotation and centroids. k-means runs on about ``sample`` vectors, chosen by a hash; at most that many reach the driver."""
    squares = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    n, longest = vectors.agg(F.count("*"), F.max(F.sqrt(squares))).first()
    random = np.random.default_rng(seed)
    rotation, _ = np.linalg.qr(random.standard_normal((dim + 1, dim + 1)))
    bare = Fit(dim, (longest or 0.0) * (1 + 1e-12), rotation, np.zeros((1, dim + 1)))
    share = math.ceil((1 << 20) * min(1.0, sample / max(n, 1)))
    some = vectors.filter(F.pmod(F.xxhash64("vec"), F.lit(1 << 20)) < share).select("vec").limit(2 * sample).toArrow()
    points = bare.rotated(matrix(some["vec"].combine_chunks(), dim), False) if some.num_rows else np.zeros((0, dim + 1))
    count = min(lists or math.ceil(4 * math.sqrt(n)), MAX_LISTS, len(points))
    if count < 1:
        return bare
    centroids = points[random.choice(len(points), count, replace=False)]
    for _ in range(10):
        near = bare._replace(centroids=centroids).distances(points).argmin(1)
        sizes = np.bincount(near, minlength=count)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, points)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    return bare._replace(centroids=centroids)


def survivors(queries: np.ndarray, blocks: list[np.ndarray], bar: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, squared distance) of the pairs of a list that no test abandons; ``queries`` and ``blocks`` are rotated."""
    total, seen = queries.shape[1], blocks[0].shape[1]
    head, x = queries[:, :seen], blocks[0]
    partial = (head**2).sum(1)[:, None] + (x**2).sum(1) - 2 * head @ x.T
    q, v = np.nonzero(partial * (total / seen) <= (bar * (1 + SURE / math.sqrt(seen)) ** 2)[:, None])
    partial = partial[q, v]
    for x in blocks[1:]:
        part = x[v] - queries[q, seen : seen + x.shape[1]]
        partial = partial + np.einsum("ij,ij->i", part, part)
        seen += x.shape[1]
        slack = 1 + SURE / math.sqrt(seen) if seen < total else 1
        stay = partial * (total / seen) <= bar[q] * slack**2
        q, v, partial = q[stay], v[stay], partial[stay]
    return q, v, partial


def scan(
    queries: np.ndarray, moved_queries: np.ndarray, probed: np.ndarray, vectors: np.ndarray, moved: np.ndarray,
    lists: np.ndarray, least: np.ndarray, keep: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, product) of the best ``keep`` vectors of a shard for each query, by product, then smallest id.

    ``probed[i, l]`` tells whether query ``i`` probes list ``l``. The vectors are in order of their lists.
    """
    n, m = len(vectors), len(queries)
    first = np.arange(n) if n <= FIRST else np.linspace(0, n - 1, FIRST).astype(int)
    square = (moved_queries**2).sum(1)[:, None] + (moved[first] ** 2).sum(1) - 2 * moved_queries @ moved[first].T
    # Equal products may give distances that differ by rounding.
    near = 1e-9 * ((moved_queries**2).sum(1) + (moved**2).sum(1).max())
    best = np.sort(square, 1)[:, :keep]
    if best.shape[1] < keep:
        best = np.pad(best, ((0, 0), (0, keep - best.shape[1])), constant_values=np.inf)
    q, v = np.nonzero(square <= (best[:, -1] + near)[:, None])
    found = [(q, first[v], square[q, v])]
    fresh = np.ones(n, bool)
    fresh[first] = False
    starts = np.flatnonzero(np.diff(lists, prepend=-1))
    for low, high in zip(starts, [*starts[1:], n]):
        at = low + np.flatnonzero(fresh[low:high])
        asking = np.flatnonzero(probed[:, lists[low]])
        if not len(at) or not len(asking):
            continue
        blocks = [moved[at, a : a + COLUMNS] for a in range(0, moved.shape[1], COLUMNS)]
        q, v, square = survivors(moved_queries[asking], blocks, best[asking, -1] + near[asking])
        if not len(q):
            continue
        found.append((asking[q], at[v], square))
        dense = np.full((len(asking), len(at)), np.inf)
        dense[q, v] = square
        best[asking] = np.sort(np.concatenate([best[asking], dense], 1), 1)[:, :keep]
    q, v, square = (np.concatenate(p) for p in zip(*found))
    stay = square <= best[q, -1] + near[q]
    q, v = q[stay], v[stay]
    product = np.einsum("ij,ij->i", queries[q], vectors[v])
    order = np.lexsort((least[v], -product, q))
    q, v, product = q[order], v[order], product[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank < keep], v[rank < keep], product[rank < keep]


def search(
    vectors: DataFrame,
    queries: str,
    k: int = 20,
    probe_share: float = 0.5,
    lists: int | None = None,
    sample: int = SAMPLE,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``queries`` (SQL over ``id``) selects, its ``k`` nearest other rows.

    Nearest is the largest inner product in double precision, then the smallest id; all rows if there are
    fewer. Vectors that are null, zero, hold a null or a component that is not finite, or have
    another than the most frequent length take no part, neither do null ids. Rows repeated with id and vector count once;
    one id with several vectors is several rows. Other columns are ignored; an empty table gives an empty result.
    A query probes the nearest ``probe_share`` of the ``lists`` lists (by default four times the square root of the number of vectors,
    ``MAX_LISTS`` at most), and further ones until they hold a multiple of ``k`` vectors. The share is large
    because neighbours of vectors without clusters are spread over many lists; clustered data need far less.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    kept = written(distinct_vectors(rows, k + 1), "vectors")
    first = kept.select(F.size("vec")).first()
    dim = first[0] if first else 1
    model = fit(kept, dim, lists, sample)
    shared = spark.sparkContext.broadcast(model)

    def assign(block: pa.RecordBatch) -> pa.RecordBatch:
        near = shared.value.distances(shared.value.rotated(matrix(block.column(1), dim), False)).argmin(1)
        return batch(["vid", "vec", "least", "list"], [*block.columns, pa.array(near.astype(np.int32))])

    located = map_blocks(
        kept.select("vid", "vec", F.col("ids")[0].alias("least")), assign, "vid bigint, vec array<double>, least bigint, list int"
    )
    located = written(located, "located")
    sizes = np.zeros(len(model.centroids), np.int64)
    for row in located.groupBy("list").count().collect():  # one row for each list, MAX_LISTS at most
        sizes[row["list"]] = row["count"]
    # Shards: short lists one after the other until a shard is full, long lists cut up.
    cuts = np.maximum(1, -(-sizes // SHARD_VECTORS))
    shard_of = np.zeros(len(sizes), np.int64)
    shard = filled = 0
    for number, (size, cut) in enumerate(zip(sizes.tolist(), cuts.tolist())):
        if filled and filled + size > SHARD_VECTORS:
            shard, filled = shard + 1, 0
        shard_of[number] = shard
        filled += size
        if cut > 1:
            shard, filled = shard + cut, 0

    asked = rows.filter(queries).select(F.col("id").alias("query_id"), "vec").distinct()
    asked = written(asked.join(kept.select("vid", "vec"), "vec").select("query_id", F.col("vid").alias("qvid")), "asked")
    asking = asked.select("qvid").distinct()
    chunks = max(1, -(-asking.count() // CHUNK_QUERIES))
    asking = asking.join(kept.select(F.col("vid").alias("qvid"), "vec"), "qvid")
    probes = max(1, math.ceil(probe_share * len(sizes)))

    def probe(block: pa.RecordBatch) -> pa.RecordBatch:
        order = shared.value.distances(shared.value.rotated(matrix(block.column(1), dim), True)).argsort(1, kind="stable")
        enough = (np.cumsum(sizes[order], 1) < 4 * (k + 1)).sum(1) + 1
        row, shards, inside = [], [], []
        for i, (o, e) in enumerate(zip(order, enough)):
            some = np.sort(o[: max(probes, e)])
            some = some[sizes[some] > 0]
            for s in np.unique(shard_of[some]).tolist():
                mine = some[shard_of[some] == s].astype(np.int32)
                for part in range(int(cuts[mine].max())):
                    row.append(i)
                    shards.append(s + part)
                    inside.append(mine[cuts[mine] > part])
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in inside])]).astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.int32), *inside])
        at = pa.array(row, pa.int64())
        return batch(
            ["node", "vec", "shard", "lists"],
            [block.column(0).take(at), block.column(1).take(at), pa.array(shards, pa.int64()), pa.ListArray.from_arrays(offsets, flat)],
        )

    columns = "node bigint, vec array<double>, shard bigint, lists array<int>"
    probing = map_blocks(asking, probe, columns, 1 << 18)
    place = spark.createDataFrame(
        [(i, int(s), int(c)) for i, (s, c) in enumerate(zip(shard_of, cuts))], "list int, first bigint, cuts bigint"
    )
    tile = F.struct("shard", "chunk").alias("tile")
    candidates = (
        located.join(place, "list")
        .withColumn("shard", F.col("first") + F.pmod(F.xxhash64("vid"), F.col("cuts")))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        .select(tile, F.lit(False).alias("query"), F.col("vid").alias("node"), "least", F.array("list").alias("lists"), "vec")
    )
    questions = probing.withColumn("chunk", F.pmod(F.xxhash64("node"), F.lit(chunks)).cast("int")).select(
        tile, F.lit(True).alias("query"), "node", F.lit(0).cast("long").alias("least"), "lists", "vec"
    )

    def compare(table: pa.Table) -> pa.Table:
        asks = table["query"].to_numpy()
        node, least = table["node"].to_numpy(), table["least"].to_numpy()
        every, lists_of = matrix(table["vec"].combine_chunks(), dim), table["lists"].combine_chunks()
        if asks.all() or not asks.any():
            return pa.table({"qvid": node[:0], "vid": node[:0], "least": node[:0], "score": np.zeros(0)})
        own = np.asarray(lists_of.filter(pa.array(~asks)).flatten())
        order = np.lexsort((least[~asks], own))
        vids, ids, x, own = node[~asks][order], least[~asks][order], every[~asks][order], own[order]
        some = lists_of.filter(pa.array(asks))
        probed = np.zeros((int(asks.sum()), len(sizes)), bool)
        probed[np.repeat(np.arange(len(some)), np.diff(np.asarray(some.offsets))), np.asarray(some.flatten())] = True
        q = every[asks]
        at, vector, product = scan(q, shared.value.rotated(q, True), probed, x, shared.value.rotated(x, False), own, ids, k + 1)
        return pa.table({"qvid": node[asks][at], "vid": vids[vector], "least": ids[vector], "score": product})

    importable(spark)
    hits = candidates.unionByName(questions).groupBy("tile").applyInArrow(compare, "qvid bigint, vid bigint, least bigint, score double")
    by_query = Window.partitionBy("qvid")
    best = hits.withColumn("n", F.row_number().over(by_query.orderBy(F.desc("score"), "least"))).filter(F.col("n") <= k + 1)
    expanded = best.join(kept.select("vid", "ids"), "vid").select("qvid", "score", F.explode("ids").alias("vec_id"))
    ranked = expanded.withColumn("n", F.row_number().over(by_query.orderBy(F.desc("score"), "vec_id"))).filter(F.col("n") <= k + 1)
    listed = ranked.groupBy("qvid").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (
        asked.join(listed, "qvid").select("query_id", F.posexplode(others).alias("place", "hit"))
        .select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
    )
