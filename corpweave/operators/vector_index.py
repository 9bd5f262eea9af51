"""Vector search over a stored index: inverted lists around centroids, probed until nothing better can be left.

``build_vector_index`` fits centroids by rounds of k-means on a bounded sample chosen by hash, deals every vector to the
list of its nearest centroid and writes the lists as one table partitioned by list, beside a small table of centroids,
radii (the largest angle between a centroid and a vector of its list) and sizes.

``search_index`` first probes each query's nearest lists until these hold ``num_candidates`` vectors. Unless told to stop
there, it then probes every list that can hold a better hit than the last one found: a vector of a list is at least the
angle to the centroid less the radius away. The result is then exact, and only lists some query probes are read. Clustered
vectors leave most lists closed; vectors close to random leave hardly any closed, and ``search_knn_batch`` is the better
choice there.

Bounds: centroids are at most ``MAX_LISTS`` vectors, the sample ``SAMPLE`` vectors a list; queries are taken in passes of
about ``PASS``, whose vectors are broadcast. A hot list is cut into files and batches like any partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpweave.functions.vectors import norm
from corpweave.operators.search import _block_hits, _matrix, _unit_rows, ranked
from corpweave.session import stored

MAX_LISTS, SAMPLE, ROUNDS, PASS = 4096, 64, 8, 2048
#: Added to angles compared, beyond what rounding can change in them.
MARGIN = 1e-6


@dataclass(frozen=True)
class VectorIndex:
    """A stored index: the folder of the lists, and per list its centroid, radius and size."""

    vectors: DataFrame
    centroids: np.ndarray
    radii: np.ndarray
    sizes: np.ndarray


def usable_vectors(docs: DataFrame, name: str) -> DataFrame:
    """(hk, v) of the rows whose vector is neither null nor zero."""
    rows = docs.select("hk", F.col(name).cast("array<double>").alias("v"))
    return rows.filter(F.col("v").isNotNull() & (norm(F.col("v")) > 0))


def nearest_lists(units: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each unit vector (ties: the first) and its angle."""
    cosines = units @ centroids.T
    at = cosines.argmax(1)
    return at, np.arccos(np.clip(cosines[np.arange(len(at)), at], -1, 1))


def fit_centroids(rows: DataFrame, lists: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of a stored sample (hk, v), by rounds of assignments and means; empty lists keep their centroid."""
    first = rows.orderBy(F.xxhash64("hk", F.lit(1)), "hk").limit(lists).toArrow()
    centroids = _unit_rows(_matrix(first.column("v")))[0]
    schema = "list int, n bigint, total array<double>"
    fields = pa.schema([("list", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.float64()))])

    def means(centroids: np.ndarray):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
            for batch in batches:
                units, _ = _unit_rows(_matrix(batch.column("v")))
                at, _ = nearest_lists(units, centroids)
                np.add.at(totals, at, units)
                counts += np.bincount(at, minlength=len(centroids))
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array(counts[used]), pa.array(list(totals[used]), pa.list_(pa.float64()))], schema=fields
            )

        return add

    def unite(group: pa.Table) -> pa.Table:
        total = _matrix(group.column("total")).sum(0)
        return pa.table([[group.column("list")[0].as_py()], [pa.compute.sum(group.column("n")).as_py()], [total.tolist()]], schema=fields)

    for _ in range(rounds):
        found = rows.mapInArrow(means(centroids), schema).groupBy("list").applyInArrow(unite, schema).toArrow()
        moved = centroids.copy()
        lengths = np.linalg.norm(totals := _matrix(found.column("total")), axis=1)
        good = lengths > 0
        moved[found.column("list").to_numpy()[good]] = totals[good] / lengths[good, None]
        if np.abs(moved - centroids).max() < 1e-4:
            return moved
        centroids = moved
    return centroids


def build_vector_index(docs: DataFrame, name: str, path: str, lists: int | None = None, rounds: int = ROUNDS) -> VectorIndex | None:
    """Write the index of a vector column of ``docs`` (with keys ``hk``) and open it; nothing to index gives none.

    ``lists`` is the root of the number of vectors unless given, and never more than ``MAX_LISTS``.
    """
    rows = usable_vectors(docs, name)
    many = rows.count()
    if not many:
        return None
    lists = max(1, min(lists or isqrt(many), MAX_LISTS, many))
    share = min(1.0, SAMPLE * lists / many)
    sample = stored(rows.filter(F.pmod(F.xxhash64("hk"), F.lit(1_000_000)) < int(share * 1_000_000) + 1), "index-sample")
    if sample.limit(lists).count() < lists:
        sample = stored(rows, "index-sample")
    centroids = fit_centroids(sample, lists, rounds)
    schema = "list int, hk string, v array<double>, angle double"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, angle = nearest_lists(_unit_rows(_matrix(batch.column("v")))[0], centroids)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *batch.columns, pa.array(angle)], names=["list", "hk", "v", "angle"])

    dealt = rows.mapInArrow(deal, schema)
    # adaptive execution merges small lists' partitions and splits a hot list's
    dealt.hint("rebalance", "list").write.mode("overwrite").partitionBy("list").parquet(f"{path}/vectors")
    spark = docs.sparkSession
    facts = spark.read.parquet(f"{path}/vectors").groupBy("list").agg(F.max("angle").alias("radius"), F.count("*").alias("size"))
    facts = {r["list"]: r for r in facts.collect()}
    table = [(i, c.tolist(), facts[i]["radius"] if i in facts else 0.0, facts[i]["size"] if i in facts else 0) for i, c in enumerate(centroids)]
    spark.createDataFrame(table, "list int, centroid array<double>, radius double, size bigint").coalesce(1).write.mode("overwrite").parquet(f"{path}/lists")
    return open_vector_index(spark, path)


def open_vector_index(spark: SparkSession, path: str) -> VectorIndex:
    lists = spark.read.parquet(f"{path}/lists").orderBy("list").toArrow()
    vectors = spark.read.parquet(f"{path}/vectors")
    return VectorIndex(vectors, _matrix(lists.column("centroid")), lists.column("radius").to_numpy(), lists.column("size").to_numpy())


def first_probes(index: VectorIndex, angles: np.ndarray, num_candidates: int) -> np.ndarray:
    """Which lists (columns) each query (rows) probes first: the nearest ones that together hold enough vectors."""
    order = np.argsort(angles, axis=1, kind="stable")
    ahead = np.cumsum(index.sizes[order], axis=1) - index.sizes[order]
    probed = np.zeros(angles.shape, bool)
    np.put_along_axis(probed, order, ahead < num_candidates, axis=1)
    return probed & (index.sizes > 0)


def possible_lists(index: VectorIndex, angles: np.ndarray, kth: np.ndarray) -> np.ndarray:
    """Which lists can hold a vector that scores no less than each query's k-th score so far."""
    reach = np.arccos(np.clip(2 * kth - 1, -1, 1))
    return (angles - index.radii <= reach[:, None] + MARGIN) & (index.sizes > 0)


def score_probes(index: VectorIndex, ids: pa.Array, queries: np.ndarray, probed: np.ndarray, size: int, id_type: T.DataType) -> DataFrame:
    """(query_id, hk, score): the best of every batch for the queries that probe its lists; other lists are not read."""
    schema = T.StructType([T.StructField("query_id", id_type), T.StructField("hk", T.StringType()), T.StructField("score", T.DoubleType())])
    lists = np.flatnonzero(probed.any(0)).tolist()
    shared = index.vectors.sparkSession.sparkContext.broadcast((ids, queries, probed))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries, probed = shared.value
        for batch in batches:
            where = batch.column("list").to_numpy()
            for number in np.unique(where).tolist():
                asking = np.flatnonzero(probed[:, number])
                yield from _block_hits(batch.filter(pa.array(where == number)), ids.take(pa.array(asking)), queries[asking], size)

    return index.vectors.filter(F.col("list").isin(lists)).select("list", "hk", "v").mapInArrow(score, schema)


def search_index(
    index: VectorIndex | None, queries: DataFrame, size: int = 10, num_candidates: int = 100, exact: bool = True
) -> DataFrame:
    """Ranked hits for a frame of queries (query_id, vector).

    With ``exact`` the hits are those of ``search_knn_batch``; without, those among the ``num_candidates`` or more vectors
    of the nearest lists. Queries whose vector is null or zero find nothing.
    """
    usable = queries.filter(F.col("vector").isNotNull() & (norm(F.col("vector")) > 0)).select("query_id", F.col("vector").cast("array<double>").alias("vector"))
    usable = stored(usable, "index-queries")
    kind = queries.schema["query_id"].dataType
    passes = -(-usable.count() // PASS)
    hits: DataFrame | None = None
    for number in range(passes if index else 0):
        some = usable.filter(F.pmod(F.xxhash64("query_id"), F.lit(passes)) == number).toArrow()
        if not some.num_rows:
            continue
        ids = some.column("query_id").combine_chunks()
        units, _ = _unit_rows(_matrix(some.column("vector")))
        angles = np.arccos(np.clip(units @ index.centroids.T, -1, 1))
        probed = first_probes(index, angles, num_candidates)
        found = score_probes(index, ids, units, probed, size, kind)
        if exact:
            found = stored(found, "index-hits")
            more = possible_lists(index, angles, kth_scores(found, ids, size)) & ~probed
            if more.any():
                found = found.unionByName(score_probes(index, ids, units, more, size, kind))
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = queries.sparkSession.createDataFrame([], T.StructType([
            T.StructField("query_id", kind), T.StructField("hk", T.StringType()), T.StructField("score", T.DoubleType())]))
    return ranked(hits, size)


def kth_scores(found: DataFrame, ids: pa.Array, size: int) -> np.ndarray:
    """The last score of each query's ``size`` best so far, 0 (the least there is) where it has fewer. One pass' queries."""
    last = ranked(found, size).filter(F.col("rank") == size).select("query_id", "score")
    place = {i: n for n, i in enumerate(ids.to_pylist())}
    out = np.zeros(len(ids))
    for row in last.collect():
        # shown scores are rounded to fewer places than those compared
        out[place[row["query_id"]]] = max(0.0, row["score"] - 1e-6)
    return out
