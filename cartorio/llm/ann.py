"""Nearest neighbours by inner product with adaptive dimension scans (operator 2).

Vectors are lengthened to a common norm, so that the largest inner product is the smallest distance,
dealt into lists by their nearest centroid, and rotated at random. A list's vectors lie in column
blocks of a few dimensions. A query scans the lists nearest to it, block of columns by block: after
each, the distance seen so far, scaled to all dimensions, is tested against the distance the query
still needs, and pairs that fail the test are abandoned. What is left is scored on the original
vectors in double precision.

The centroids, the number of lists to scan (so many that the sample's own neighbours are found to the
target recall) and each query's bound come from a sample of at most ``sample`` vectors (those of smallest
hash of the id); every vector is indexed. The bound is the ``k``-th distance to those of the sample that
lie in the scanned lists, so at least ``k`` are found. Of equal vectors only the ``k + 1`` smallest ids can
be an answer, each at most ``k`` times, so only those are indexed. Lists of more than ``block`` vectors are cut into blocks.

Defined results: vectors that are null, zero, or hold null or non-finite components, or whose length
isn't the most common one, take no part, neither as query nor as candidate; a null id neither; of a
repeated id every row is a vector of its own, but none is a candidate for a query of the same id; ties
go to the smaller id; an empty table gives an empty table. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartorio.llm.sampling import hash_sample
from cartorio.sources.scratch import fresh_folder


@dataclass(frozen=True)
class SearchSettings:
    """``slack`` widens the test on partial distances: larger is slower and misses less."""

    k: int = 20
    sample: int = 20_000
    lists: int = 1024
    recall: float = 0.97
    trials: int = 512
    columns: int = 16
    slack: float = 2.1
    block: int = 2048
    seed: int = 7


@dataclass(frozen=True)
class Index:
    """What every task needs; of bounded size."""

    norm: float
    rotation: np.ndarray
    centroids: np.ndarray
    sample_ids: np.ndarray
    sample: np.ndarray
    sample_lists: np.ndarray
    probes: int
    settings: SearchSettings

    def placed(self, vectors: np.ndarray) -> np.ndarray:
        """Candidates, lengthened to the common norm and rotated."""
        rest = np.sqrt(np.maximum(self.norm**2 - (vectors**2).sum(1), 0))
        return np.hstack([vectors, rest[:, None]]) @ self.rotation

    def asked(self, vectors: np.ndarray) -> np.ndarray:
        """Queries, lengthened by a zero and rotated."""
        return np.hstack([vectors, np.zeros((len(vectors), 1))]) @ self.rotation


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs of two small sets."""
    found = (queries**2).sum(1)[:, None] + (points**2).sum(1)[None, :] - 2 * queries @ points.T
    return np.maximum(found, 0)


def cluster(points: np.ndarray, n: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Centroids by Lloyd's rounds; an empty cluster moves to a point that lies far out."""
    centroids = points[rng.choice(len(points), n, replace=False)]
    for _ in range(rounds):
        near = np.concatenate([distances(part, centroids) for part in np.array_split(points, max(1, len(points) // 4096))])
        owner = near.argmin(1)
        counts = np.bincount(owner, minlength=n)
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, points)
        far = np.argsort(-near[np.arange(len(points)), owner], kind="stable")
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], 0)
        empty = np.flatnonzero(counts == 0)
        centroids[empty] = points[far[: len(empty)]]
    return centroids


def usable(vector: Column) -> Column:
    """Not null nor empty, without null or non-finite components, and not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def fit(vectors: DataFrame, settings: SearchSettings) -> Index | None:
    """The index of a table of ``id`` and ``vector`` (usable, of one length); None if it is empty."""
    facts = vectors.agg(
        F.max(F.aggregate("vector", F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x)).alias("norm"),
        F.count("*").alias("n"),
    ).first()
    if not facts.n:
        return None
    rows = hash_sample(vectors, settings.sample, "id", "vector").collect()
    sample = np.array([row.vector for row in rows], np.float64)
    rng = np.random.default_rng(settings.seed)
    size = sample.shape[1] + 1
    rotation, _ = np.linalg.qr(rng.normal(size=(size, size)))
    ids = np.array([row.id for row in rows], np.int64)
    bare = Index(
        float(np.sqrt(facts.norm)), rotation, np.zeros((0, size)), ids, sample, np.zeros(0, np.int64), 0, settings
    )
    placed = bare.placed(sample)
    lists = int(min(settings.lists, max(1, np.sqrt(facts.n)), len(sample)))
    centroids = cluster(placed, lists, rng)
    parts = np.array_split(placed, max(1, len(placed) // 4096))
    owner = np.concatenate([distances(part, centroids).argmin(1) for part in parts])
    probes = _probes(bare.asked(sample[: settings.trials]), placed, owner, centroids, settings)
    return replace(bare, centroids=centroids, sample=placed, sample_lists=owner, probes=probes)


def _probes(
    queries: np.ndarray, placed: np.ndarray, owner: np.ndarray, centroids: np.ndarray, settings: SearchSettings
) -> int:
    """How many of the nearest lists hold the target share of the neighbours within the sample."""
    near = distances(queries, placed)
    near[np.arange(len(queries)), np.arange(len(queries))] = np.inf
    k = min(settings.k, len(placed) - 1)
    if k < 1:
        return len(centroids)
    neighbours = np.argpartition(near, k - 1, axis=1)[:, :k]
    order = np.argsort(distances(queries, centroids), axis=1, kind="stable")
    turn = np.empty_like(order)
    np.put_along_axis(turn, order, np.arange(len(centroids))[None, :], axis=1)
    turns = np.sort(np.take_along_axis(turn, owner[neighbours], axis=1).ravel())
    return int(turns[min(len(turns) - 1, int(np.ceil(settings.recall * len(turns))))]) + 1


def _scan(
    index: Index, queries: np.ndarray, bounds: np.ndarray, points: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, point) that no test abandons, by column blocks of the points."""
    settings = index.settings
    size = points.shape[1]
    rows, places = (part.ravel() for part in np.indices((len(queries), len(points))))
    seen = np.zeros(len(rows))
    for begin in range(0, size, settings.columns):
        block = slice(begin, min(begin + settings.columns, size))
        if begin == 0:  # all pairs: as a product of two blocks
            seen = distances(queries[:, block], points[:, block]).ravel()
        else:
            seen += ((queries[rows, block] - points[places, block]) ** 2).sum(1)
        done = block.stop
        # The distance over some of the rotated dimensions estimates that over all of them.
        allowed = bounds if done == size else bounds * (1 + settings.slack / np.sqrt(done)) ** 2 * done / size
        fine = seen <= allowed[rows] * (1 + 1e-9) + 1e-12
        rows, places, seen = rows[fine], places[fine], seen[fine]
    return rows, places


def _scores(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added up in the order of the components."""
    total = np.zeros(len(one))
    for column in range(one.shape[1]):
        total += one[:, column] * other[:, column]
    return total


def nearest(
    table: DataFrame,
    settings: SearchSettings = SearchSettings(),
    is_query: Column | None = None,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, the found row's id under the name of ``key``, and ``score``."""
    spark = table.sparkSession
    folder = fresh_folder(spark, "ann")
    asks = F.lit(True) if is_query is None else is_query
    rows = table.select(
        F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector"),
        F.coalesce(asks, F.lit(False)).alias("asks"),
    ).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.filter(F.size("vector") == (common.n if common else 0))
    empty = f"query_id bigint, rank int, {key} bigint, score double"
    # Equal vectors answer alike, so the smallest ids among them are enough: one more than k, as a query
    # may be one of them, and k rows of each.
    alike, own = W.partitionBy("vector").orderBy("id"), W.partitionBy("vector", "id").orderBy("id")
    candidates = rows.select("id", "vector").withColumn("place", F.dense_rank().over(alike)).filter(
        F.col("place") <= settings.k + 1
    ).withColumn("copy", F.row_number().over(own)).filter(F.col("copy") <= settings.k).drop("place", "copy")
    index = fit(candidates, settings)
    if index is None:
        return spark.createDataFrame([], empty)
    shared = spark.sparkContext.broadcast(index)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            if batch.num_rows:
                near = distances(index.placed(_matrix(batch.column("vector"))), index.centroids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near.argmin(1), pa.int32()), batch.column("id"), batch.column("vector")],
                    names=["list", "id", "vector"],
                )

    kind = rows.schema["vector"].dataType.simpleString()
    candidates.mapInArrow(listed, f"list int, id bigint, vector {kind}").write.parquet(f"{folder}/lists")
    lists = spark.read.parquet(f"{folder}/lists")
    blocks = lists.groupBy("list").agg(
        F.ceil(F.count("*") / settings.block).cast("int").alias("blocks")
    )

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                ids = part.column("id").to_numpy()
                queries = index.asked(_matrix(part.column("vector")))
                near = np.argpartition(distances(queries, index.centroids), index.probes - 1, axis=1)
                near = near[:, : index.probes]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("vector"), pa.array(_bounds(index, ids, queries, near)),
                     pa.array(near.tolist(), pa.list_(pa.int32()))],
                    names=["id", "vector", "bound", "lists"],
                )

    queries = (
        rows.filter("asks").select("id", "vector").distinct()  # a repeated row asks once
        .mapInArrow(probed, f"id bigint, vector {kind}, bound double, lists array<int>")
        .select("id", "vector", "bound", F.explode("lists").alias("list"))
        .join(blocks, "list")
        .select("list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "bound", "id", "vector")
    )
    points = lists.join(blocks, "list").select(
        "list", F.pmod(F.xxhash64("id", "vector"), "blocks").cast("int").alias("block"),
        F.lit(None).cast("double").alias("bound"), "id", "vector",
    )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, k = shared.value, settings.k
        for ids, vectors, bounds, asked, point_ids, points, placed in _meetings(batches, index):
            found = _scan(index, index.asked(vectors), bounds, placed)
            ours = ids[found[0]] != point_ids[found[1]]
            query, point = found[0][ours], found[1][ours]
            scores = _scores(vectors[query], points[point])
            order = np.lexsort((point_ids[point], -scores, query))
            query, point, scores = query[order], point[order], scores[order]
            first = np.searchsorted(query, query)
            best = np.arange(len(query)) - first < k
            yield pa.RecordBatch.from_arrays(
                [pa.array(asked[query[best]]), pa.array(point_ids[point[best]]), pa.array(scores[best])],
                names=["query", "id", "score"],
            )

    together = points.withColumn("asks", F.lit(False)).unionByName(queries.withColumn("asks", F.lit(True)))
    # A query of a repeated id is known by its id and vector.
    together = together.withColumn("query", F.when(F.col("asks"), F.xxhash64("id", "vector")))
    found = (
        together.repartition("list", "block").sortWithinPartitions("list", "block", "asks")
        .mapInArrow(scanned, "query bigint, id bigint, score double")
    )
    best = W.partitionBy("query").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= settings.k)
    askers = rows.filter("asks").select(F.col("id").alias("query_id"), F.xxhash64("id", "vector").alias("query"))
    return ranked.join(askers, "query").select("query_id", "rank", F.col("id").alias(key), "score")


def _bounds(index: Index, ids: np.ndarray, queries: np.ndarray, lists: np.ndarray) -> np.ndarray:
    """The k-th smallest distance to the sample in the scanned lists: no answer needs to be farther."""
    k = index.settings.k
    if len(index.sample) <= k:
        return np.full(len(queries), np.inf)
    scanned = np.zeros((len(queries), len(index.centroids)), bool)
    np.put_along_axis(scanned, lists, True, axis=1)
    near = distances(queries, index.sample)
    near[~scanned[:, index.sample_lists] | (ids[:, None] == index.sample_ids[None, :])] = np.inf
    return np.partition(near, k - 1, axis=1)[:, k - 1] * (1 + 1e-6) + 1e-9


def _meetings(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[tuple[np.ndarray, ...]]:
    """The queries of each block of a list, some at a time, with the block's vectors.

    Rows come sorted by list and block, vectors before queries.
    """
    block, ids, points = None, [], []
    placed = point_ids = vectors = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("list", "block", "asks")])
        cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
        for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            part = batch.slice(begin, end - begin)
            if block != tuple(keys[begin, :2]):
                block, ids, points, placed = tuple(keys[begin, :2]), [], [], None
            if not keys[begin, 2]:
                ids.append(part.column("id").to_numpy())
                points.append(_matrix(part.column("vector")))
                placed = None
                continue
            if not points:
                continue
            if placed is None:
                point_ids, vectors = np.concatenate(ids), np.concatenate(points)
                placed = index.placed(vectors)
            step = max(1, (1 << 18) // len(placed))
            for at in range(0, part.num_rows, step):
                some = part.slice(at, step)
                yield (
                    some.column("id").to_numpy(), _matrix(some.column("vector")),
                    some.column("bound").to_numpy(), some.column("query").to_numpy(),
                    point_ids, vectors, placed,
                )
