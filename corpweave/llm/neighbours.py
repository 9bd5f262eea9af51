"""Nearest neighbours by inner product: NN-descent builds a neighbour graph, queries walk it greedily.

A node's code is its direction, as 32-bit floats, and its norm over the largest, in double precision. Distances are those
of the vectors with one more component that makes them as long as the longest, so that a short distance means a large
inner product. They are taken from norms and differences of norms directly, so vectors much shorter than the longest keep
their distances apart, and lists hold the logarithm of the distance, which has the same grain at every scale. Equal vectors
are one node.

1. Start: nodes are sorted by the signs of random projections, several times over, and compared inside blocks of
   ``BLOCK`` consecutive ones. Blocks are cut by position, so no region of the space fills a task. Sorts and signs grow
   with the logarithm of the number of nodes.
2. NN-descent rounds, as joins: a node's ``DEGREE`` neighbours come to it, and the ``REVERSE`` nearest nodes that have it as
   neighbour; whoever meets at a node is compared there (neighbours of neighbours), and what beats the worst neighbour
   a node has travels back to it. Hubs take no more than ``REVERSE`` of those that point at them, chosen by a rank that
   is limited before the shuffle, so no more than ``DEGREE + REVERSE`` meet at a node. Rounds go on until the lists gain less than ``ENOUGH``.
3. Greedy search: a query starts at its own node, if it is indexed, and at ``ENTRIES`` fixed and ``ENTRIES`` long nodes. Each
   round opens its ``OPEN`` best nodes not yet opened and measures their neighbours, block of nodes by block of nodes:
   a query is sent once to a block with the ids to measure, and those come back that are among its best so far. A block is
   copied once for every ``IDS_A_TASK`` ids asked of it, so copies follow what is measured, not queries times nodes. A query is
   done when all of its best nodes (``effort``, which grows with the root of the number of nodes) are open; then it is put
   aside, and later steps move the others only.
4. Measures are inner products of the original vectors in double precision, added component by component as Spark adds
   them, so what the search keeps is final: its pool never exceeds ``effort`` nodes, however many lie close together.

Every vector is in the graph; only what a node remembers is bounded, so recall is measured, not assumed (README).
Rounds and search steps that do not settle within ``MOST_ROUNDS`` and ``MOST_STEPS`` raise an error.
Bounds: a task holds one block of nodes (some 8 MB of vectors, 6 MB of links) and the ids asked of it (16 MB), or a share of the queries; the driver sees counts, norms and the entries' ids.

Cases: null ids and vectors that are null, empty, zero or hold null or non-finite components take no part; shorter
vectors count as padded with zeros; rows that repeat an id count once, with the smallest vector; ties go to the
smaller id; equal vectors rank by id; with fewer candidates than asked for, all are returned; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from functools import reduce
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpweave.llm.common import arrow_map, arrow_schema, meet, packed, stored

TOP = 20
DEGREE, REVERSE = 32, 16
BLOCK, REPEATS, PLANES = 1024, 8, 13
MOST_ROUNDS, ENOUGH, SENT = 60, 0.002, 12
OPEN, EFFORT, MOST_STEPS, ENTRIES = 128, 320, 1000, 64
NODES = 16_384
#: Ids that one task opens or measures, and pairs of query and node it measures in one go.
IDS_A_TASK, PAIRS = 2_000_000, 65_536
#: Nodes for which EFFORT was chosen.
USUAL = 50_000
log = logging.getLogger(__name__)
#: Below the logarithm of any distance, for lists that are not full.
ANY = -1e9
LIST = "id bigint, nbrs array<bigint>, sims array<float>"


def usable(vector: Column) -> Column:
    """Vectors that are not null, hold finite components only and are not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def distinct_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector) with one row per id, components as doubles."""
    v = rows[vector].cast("array<double>")
    some = rows.select(rows[key].cast("bigint").alias("id"), v.alias("vector")).where(F.col("id").isNotNull() & usable(F.col("vector")))
    return some.groupBy("id").agg(F.min("vector").alias("vector"))


def extent(rows: DataFrame, vector: str) -> int:
    """Bytes of the rows' vectors as doubles, and of a few columns beside."""
    found = rows.agg(F.count("*").alias("n"), F.sum(F.size(vector)).alias("components")).first()
    return 24 * found["n"] + 8 * max(found["components"] or 0, 0)


def as_matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows, padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def coded(nodes: DataFrame, width: int, longest: float) -> DataFrame:
    """(id, code): directions as 32-bit floats, followed by the norm over the longest as a double."""
    schema = arrow_schema("id:int64 code:binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = as_matrix(batch.column(1), width)
            largest = np.abs(x).max(1, initial=0, keepdims=True)
            x = x / largest
            norm = np.sqrt((x * x).sum(1, keepdims=True))
            code = np.column_stack([(x / norm).astype(np.float32).view(np.uint8), (largest / longest * norm).view(np.uint8)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.tobytes() for c in code], pa.binary())], schema=schema)

    return arrow_map(nodes.select("id", "vector"), run, "id:int64 code:binary")


def codes_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Directions, one row each, and norms of codes."""
    values = column.to_pylist()
    raw = np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)
    return raw[:, :-8].copy().view(np.float32).astype(float), raw[:, -8:].copy().view(float)[:, 0]


def squared_distances(x: np.ndarray, y: np.ndarray, norm_x: np.ndarray, norm_y: np.ndarray) -> np.ndarray:
    """Between the rows of x and of y, each over one axis more than the norms, with the completing component.

    The last component of a vector of norm r is sqrt(1 - r * r); differences of these are taken as quotients of differences.
    """
    a, b = (norm_x * norm_x)[..., :, None], (norm_y * norm_y)[..., None, :]
    high = np.sqrt(np.maximum(0, 1 - a)) + np.sqrt(np.maximum(0, 1 - b))
    last = np.divide(b - a, high, out=np.zeros(np.broadcast(a, b).shape), where=high > 0)
    plain = a + b - 2 * (x @ np.swapaxes(y, -1, -2))
    return np.maximum(plain, 0) + last * last


def nearness(squared: np.ndarray) -> np.ndarray:
    """Falls as the distance grows, with the same grain at every scale."""
    return (-np.log2(np.maximum(squared, 1e-300))).astype(np.float32)


def best_of(ids: np.ndarray, nbrs: np.ndarray, sims: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``most`` best distinct neighbours of every id, by id and falling similarity."""
    order = np.lexsort((-sims, nbrs, ids))
    ids, nbrs, sims = ids[order], nbrs[order], sims[order]
    fresh = np.r_[True, (ids[1:] != ids[:-1]) | (nbrs[1:] != nbrs[:-1])] & (ids != nbrs)
    ids, nbrs, sims = ids[fresh], nbrs[fresh], sims[fresh]
    order = np.lexsort((nbrs, -sims, ids))
    ids, nbrs, sims = ids[order], nbrs[order], sims[order]
    rank = np.arange(len(ids)) - np.searchsorted(ids, ids)
    good = rank < most
    return ids[good], nbrs[good], sims[good]


def lists(ids: np.ndarray, nbrs: np.ndarray, sims: np.ndarray) -> pa.RecordBatch:
    """Sorted triples as one row per id."""
    starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.empty(0, np.int64)
    offsets = pa.array(np.r_[starts, len(ids)].astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[starts]), pa.ListArray.from_arrays(offsets, pa.array(nbrs.astype(np.int64))),
         pa.ListArray.from_arrays(offsets, pa.array(sims.astype(np.float32)))], names=["id", "nbrs", "sims"],
    )


def by_run(function: Callable[[pa.Table], pa.RecordBatch], rows: int = 20_000) -> Callable:
    """A ``mapInArrow`` function over tables that never split rows of one value in the first, sorted column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < rows:
                continue
            table = pa.Table.from_batches(held)
            first = table.column(0).to_numpy()
            cut = int(np.searchsorted(first, first[-1]))
            held = table.slice(cut).to_batches()
            if cut:
                yield function(table.slice(0, cut))
        if sum(map(len, held)):
            yield function(pa.Table.from_batches(held))

    return run


def merged(rows: DataFrame, most: int) -> DataFrame:
    """The best distinct neighbours of every id over all its lists."""

    def merge(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        sizes = pa.compute.list_value_length(table.column(1)).to_numpy()
        ids = np.repeat(table.column(0).to_numpy(), sizes)
        flat = (pa.compute.list_flatten(table.column(i)).to_numpy() for i in (1, 2))
        return lists(*best_of(ids, *flat, most))

    return rows.repartition("id").sortWithinPartitions("id").mapInArrow(by_run(merge), LIST)


def sorts_and_signs(nodes: int) -> tuple[int, int]:
    """How often nodes are sorted, and by how many signs: more as the nodes grow in number."""
    size = log2(max(nodes, 2))
    return max(REPEATS, ceil(2 * size - 23)), max(PLANES, ceil(size) - 3)


def effort(nodes: int) -> int:
    """How many of its best nodes a query opens."""
    return ceil(EFFORT * max(1.0, nodes / USUAL) ** 0.5)


def start_graph(codes: DataFrame, width: int, nodes: int) -> DataFrame:
    """First lists, from blocks of nodes that several sorts by random projections bring together."""
    turns, signs_used = sorts_and_signs(nodes)
    planes = np.random.default_rng(7).standard_normal((turns, width, signs_used + 1))
    fields = "turn:int32 region:int64 along:double id:int64 code:binary"
    schema = arrow_schema(fields)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, _ = codes_of(batch.column(1))
            for turn in range(turns):
                p = x @ planes[turn]
                signs = (p[:, :signs_used] > 0) @ (1 << np.arange(signs_used))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), turn, np.int32)), pa.array(signs ^ (signs >> 1)),
                     pa.array(p[:, signs_used]), batch.column(0), batch.column(1)], schema=schema,
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            while sum(map(len, held)) >= 2 * BLOCK:
                table = pa.Table.from_batches(held)
                held = table.slice(BLOCK).to_batches()
                yield block(table.slice(0, BLOCK))
        if sum(map(len, held)):
            yield block(pa.Table.from_batches(held))

    def block(table: pa.Table) -> pa.RecordBatch:
        ids, (x, norm) = table.column(3).to_numpy(), codes_of(table.column(4))
        x *= norm[:, None]
        squared = squared_distances(x, x, norm, norm)
        np.fill_diagonal(squared, np.inf)
        most = min(DEGREE, len(ids) - 1)
        if most < 1:
            return lists(ids[:0], ids[:0], ids[:0])
        at = np.argpartition(squared, most - 1, axis=1)[:, :most]
        found = nearness(np.take_along_axis(squared, at, 1)).ravel()
        return lists(*best_of(np.repeat(ids, most), ids[at].ravel(), found, most))

    parts = max(1, -(-nodes * turns // (4 * BLOCK)))
    spread = arrow_map(codes, project, fields)
    ranged = spread.repartitionByRange(parts, "turn", "region", "along", "id").sortWithinPartitions("turn", "region", "along", "id")
    return merged(ranged.mapInArrow(compare, LIST), DEGREE)


def reversed_links(graph: DataFrame) -> DataFrame:
    """(id, nbr): for every node the nearest nodes that have it as neighbour."""
    links = graph.select(F.col("id").alias("nbr"), F.explode(F.arrays_zip("nbrs", "sims")).alias("x"))
    links = links.select(F.col("x.nbrs").alias("id"), "nbr", F.col("x.sims").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("sim"), "nbr"))
    return links.withColumn("rank", rank).where(F.col("rank") <= REVERSE).select("id", "nbr")


def meetings(graph: DataFrame) -> DataFrame:
    """(at, id): a node's own neighbours come to it, and the nearest of those that have it as neighbour."""
    own = graph.select(F.col("id").alias("at"), F.explode("nbrs").alias("id"))
    return own.unionAll(reversed_links(graph).select(F.col("id").alias("at"), F.col("nbr").alias("id")))


def descend(graph: DataFrame, codes: DataFrame) -> DataFrame:
    """One round: nodes meet at their neighbours, are compared there, and keep the best."""
    worst = F.when(F.size("sims") >= DEGREE, F.element_at("sims", -1)).otherwise(ANY).cast("float")
    own = graph.select("id", worst.alias("worst")).join(codes, "id")
    goes = meetings(graph).join(own, "id").select("at", "id", "worst", "code")
    goes = goes.repartition("at").sortWithinPartitions("at", "id")
    return merged(goes.mapInArrow(by_run(_met, 8_000), LIST).unionByName(graph), DEGREE)


def _met(table: pa.Table) -> pa.RecordBatch:
    at, ids, worst = (table.column(i).to_numpy() for i in range(3))
    x, norm = codes_of(table.column(3))
    x *= norm[:, None]
    fresh = np.r_[True, (at[1:] != at[:-1]) | (ids[1:] != ids[:-1])]
    at, ids, worst, x, norm = at[fresh], ids[fresh], worst[fresh], x[fresh], norm[fresh]
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    sizes = np.diff(np.r_[starts, len(at)])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for low in range(0, len(starts), 256):
        first, size = starts[low : low + 256], sizes[low : low + 256]
        most = int(size.max())
        rows = first[:, None] + np.arange(most)
        absent = np.arange(most) >= size[:, None]
        rows = np.where(absent, 0, rows)
        v = x[rows]
        squared = squared_distances(v, v, norm[rows], norm[rows])
        squared[np.broadcast_to(absent[:, None, :], squared.shape)] = np.inf
        squared[:, np.arange(most), np.arange(most)] = np.inf
        take = min(SENT, most)
        best = np.argpartition(squared, take - 1, axis=2)[:, :, :take]
        squared = np.take_along_axis(squared, best, 2)
        sims = nearness(squared)
        good = (sims > worst[rows][:, :, None]) & ~absent[:, :, None] & (squared < np.inf)
        group = np.broadcast_to(np.arange(len(first))[:, None, None], best.shape)
        to = np.broadcast_to(ids[rows][:, :, None], best.shape)
        found.append((to[good], ids[rows][group, best][good], sims[good]))
    to, nbrs, sims = (np.concatenate(c) for c in zip(*found, strict=True))
    return lists(*best_of(to, nbrs, sims, DEGREE))


def neighbour_graph(codes: DataFrame, width: int, nodes: int) -> DataFrame:
    """(id, nbrs, sims): up to DEGREE neighbours of every node, nearest first."""
    size = 12 * DEGREE * nodes
    graph = stored(packed(start_graph(codes, width, nodes), size), "graph")
    total, entries = _total(graph)
    for number in range(MOST_ROUNDS):
        graph = stored(packed(descend(graph, codes), size), "graph")
        (before, had), (total, entries) = (total, entries), _total(graph)
        log.info("round %d: lists gained %.4f an entry", number + 1, (total - before) / max(entries, 1))
        if entries == had and total - before <= ENOUGH * entries:
            return graph
    raise RuntimeError(f"neighbour lists still gain after {MOST_ROUNDS} rounds")


def _total(graph: DataFrame) -> tuple[float, int]:
    """Sum and number of the entries of all lists."""
    sums = F.sum(F.aggregate("sims", F.lit(0.0), lambda a, s: a + s))
    found = graph.agg(sums.alias("total"), F.sum(F.size("sims")).alias("entries")).first()
    return found["total"] or 0.0, found["entries"] or 0


def link_blocks(graph: DataFrame, nodes: DataFrame, blocks: int) -> DataFrame:
    """One row per block of nodes: ids, and the neighbours of each in both directions."""
    back = reversed_links(graph).groupBy("id").agg(F.collect_list("nbr").alias("back"))
    empty = F.array().cast("array<bigint>")
    rows = nodes.select("id").join(graph.select("id", "nbrs"), "id", "left").join(back, "id", "left")
    links = F.array_union(F.coalesce("nbrs", empty), F.coalesce("back", empty))

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        links = group.column("links").combine_chunks()
        ends = np.r_[0, np.cumsum(links.value_lengths().to_numpy())].astype(np.int64)
        row = [group.column("block")[0].as_py(), group.column("id").to_numpy().tobytes(), ends.tobytes(), links.flatten().to_numpy().tobytes()]
        return pa.table([[v] for v in row], schema=arrow_schema("block:int32 ids:binary ends:binary links:binary"))

    rows = with_block(rows.select("id", links.alias("links")), "id bigint, links array<bigint>", blocks)
    return rows.groupBy("block").applyInArrow(build, "block int, ids binary, ends binary, links binary")


def vector_blocks(nodes: DataFrame, width: int, blocks: int) -> DataFrame:
    """One row per block of nodes: ids, and their vectors component by component."""

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("id").combine_chunks()
        x = np.ascontiguousarray(as_matrix(group.column("vector"), width).T)
        row = [group.column("block")[0].as_py(), group.column("id").to_numpy().tobytes(), x.tobytes()]
        return pa.table([[v] for v in row], schema=arrow_schema("block:int32 ids:binary vectors:binary"))

    rows = with_block(nodes.select("id", "vector"), "id bigint, vector array<double>", blocks)
    return rows.groupBy("block").applyInArrow(build, "block int, ids binary, vectors binary")


def block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    """The block of each id, spread whatever ids have in common."""
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(blocks)).astype(np.int32)


def with_block(rows: DataFrame, schema: str, blocks: int) -> DataFrame:
    """``rows``, of an id and other columns, and the block of the id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = pa.array(block_of(batch.column(0).to_numpy(), blocks))
            yield pa.RecordBatch.from_arrays([*batch.columns, block], names=[*batch.schema.names, "block"])

    return rows.mapInArrow(run, f"{schema}, block int")


def by_block(ids: np.ndarray, blocks: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The blocks that hold some of the ids, and the ids each holds; one sort, however many blocks there are."""
    block = block_of(ids, blocks)
    order = np.argsort(block, kind="stable")
    used, first = np.unique(block[order], return_index=True)
    return used, np.split(ids[order], first[1:]) if len(ids) else []


def _places(ids: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of wanted ids in sorted ids, of those that are there."""
    at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
    return at[ids[at] == wanted]


def _opened(asked: pa.Table, index: pa.Table) -> pa.Table:
    """Neighbours of the nodes each query opens."""
    schema = arrow_schema("query:int64 found:longs")
    if not len(asked) or not len(index):
        return schema.empty_table()
    ids, ends, links = (np.frombuffer(index.column(c)[0].as_py(), np.int64) for c in ("ids", "ends", "links"))
    found = []
    for nodes in asked.column("nodes"):
        at = _places(ids, nodes.values.to_numpy())
        found.append(np.unique(np.concatenate([links[ends[a] : ends[a + 1]] for a in at])) if len(at) else at)
    return pa.table([asked.column("query"), pa.array(found, pa.list_(pa.int64()))], schema=schema)


def _measured(asked: pa.Table, index: pa.Table) -> pa.Table:
    """Inner products of the nodes each query asks for, of those that reach its bar."""
    schema = arrow_schema("query:int64 found:longs sims:doubles")
    if not len(asked) or not len(index):
        return schema.empty_table()
    ids = np.frombuffer(index.column("ids")[0].as_py(), np.int64)
    vectors = np.frombuffer(index.column("vectors")[0].as_py(), float).reshape(-1, len(ids))
    out, sizes = [], pa.compute.list_value_length(asked.column("nodes")).to_numpy()
    ends = np.cumsum(sizes)
    low = 0
    while low < len(asked):  # as many queries as ask for PAIRS ids, one at least
        high = max(low + 1, int(np.searchsorted(ends, ends[low] - sizes[low] + PAIRS, "right")))
        out.append(_products(asked.slice(low, high - low).combine_chunks(), ids, vectors, schema))
        low = high
    return pa.concat_tables(out)


def _products(asked: pa.Table, ids: np.ndarray, vectors: np.ndarray, schema: pa.Schema) -> pa.Table:
    """Of all pairs of these queries at once, added component by component; missing components count as zero."""
    wanted, given, bars = (asked.column(c).combine_chunks() for c in ("nodes", "vector", "bar"))
    queries = as_matrix(given, max(len(vectors), pa.compute.max(given.value_lengths()).as_py()))
    row = np.repeat(np.arange(len(asked)), wanted.value_lengths().to_numpy())
    nodes = wanted.flatten().to_numpy()
    at = np.minimum(np.searchsorted(ids, nodes), len(ids) - 1)
    here = ids[at] == nodes
    at, row = at[here], row[here]
    total = np.zeros(len(at))
    for component, values in zip(queries.T, vectors, strict=False):
        total += component[row] * values[at]
    good = total >= bars.to_numpy()[row]
    at, row, total = at[good], row[good], total[good]
    offsets = pa.array(np.searchsorted(row, np.arange(len(asked) + 1)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(values)) for values in (ids[at], total)]
    return pa.table([asked.column("query"), *lists], schema=schema)


def greedy_search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, many: int, width: int, long: list[int], top: int) -> DataFrame:
    """(query, node, score): the ``top + 1`` best nodes found for (query, start, vector) rows.

    start is the query's own node or null; searches also begin at the nodes ``long``.
    """
    blocks = max(1, -(-many // NODES))
    links = stored(link_blocks(graph, nodes, blocks), "links")
    vectors = stored(vector_blocks(nodes, width, blocks), "blocks")
    entries = [r["id"] for r in nodes.orderBy(F.xxhash64("id"), "id").select("id").limit(ENTRIES).collect()]
    entries = sorted({*entries, *long})
    own = F.array_compact(F.array("start"))
    state = queries.select(
        "query", "vector", F.array().cast("array<bigint>").alias("pool"), F.array().cast("array<double>").alias("sims"),
        F.array().cast("array<bigint>").alias("opened"), own.alias("next"),
        F.array_union(F.array(*map(F.lit, entries)).cast("array<bigint>"), own).alias("extra"),
    )
    held = max(effort(many), top + 1)
    left, each = queries.count(), 8 * width + 24 * held
    state = stored(packed(state, left * each), "search")
    first = F.arrays_zip(F.slice("pool", 1, top + 1).alias("node"), F.slice("sims", 1, top + 1).alias("score"))
    settled: list[DataFrame] = []
    for number in range(MOST_STEPS):
        # open nodes: the blocks that hold them return their neighbours
        sent = stored(packed(_sent(state, blocks), left * 8 * OPEN), "open")
        found = meet(sent, links, "block", _opened, "query bigint, found array<bigint>", IDS_A_TASK, F.size("nodes"), ["query"])
        bar = F.when(F.size("sims") >= held, F.element_at("sims", -1)).otherwise(float("-inf"))
        links_met = OPEN * DEGREE
        asked = stored(packed(_fresh(state, found, bar, blocks), left * 8 * (links_met + width * min(blocks, links_met))), "measure")
        # a query's vector weighs as well
        measured = meet(
            asked, vectors, "block", _measured, "query bigint, found array<bigint>, sims array<double>", IDS_A_TASK,
            F.size("nodes") + F.size("vector"), ["query"],
        )
        after = stored(packed(_next_state(state, measured, held), left * each), "search")
        settled.append(after.where(F.size("next") == 0).select("query", F.explode(first).alias("x")).select("query", "x.node", "x.score"))
        state = after.where(F.size("next") > 0)
        left = state.count()
        if not left:
            log.info("search settled after %d steps", number + 1)
            return reduce(DataFrame.unionAll, settled)
    raise RuntimeError(f"queries still find nodes to open after {MOST_STEPS} steps")


def _sent(state: DataFrame, blocks: int) -> DataFrame:
    """(block, query, nodes): the nodes each query opens next, dealt to the blocks that hold them."""
    fields = "block:int32 query:int64 nodes:longs"
    schema = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dealt = [by_block(nodes.values.to_numpy(), blocks) for nodes in batch.column(1)]
            query = np.repeat(batch.column(0).to_numpy(), [len(used) for used, _ in dealt])
            block = np.concatenate([np.empty(0, np.int32), *(used for used, _ in dealt)])
            nodes = [part for _, parts in dealt for part in parts]
            yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(query), pa.array(nodes, pa.list_(pa.int64()))], schema=schema)

    return arrow_map(state.select("query", "next"), run, fields)


def _fresh(state: DataFrame, found: DataFrame, bar: Column, blocks: int) -> DataFrame:
    """(query, vector, bar, block, nodes): what a query has found and does not hold, with its entries in the first round,
    dealt to the blocks that hold it."""
    told = found.groupBy("query").agg(F.flatten(F.collect_list("found")).alias("found"))
    none = F.array().cast("array<bigint>")
    rows = state.join(told, "query", "left").select("query", "vector", bar.alias("bar"), F.coalesce("found", none), "extra", "pool")
    fields = "query:int64 vector:doubles bar:double block:int32 nodes:longs"
    schema = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, block, nodes = [], [np.empty(0, np.int32)], []
            for row, lists in enumerate(zip(*(batch.column(i) for i in (3, 4, 5)), strict=True)):
                told, extra, pool = (x.values.to_numpy() for x in lists)
                used, parts = by_block(np.setdiff1d(np.r_[told, extra], pool), blocks)
                rows += [row] * len(used)
                block.append(used)
                nodes += parts
            given = batch.select([0, 1, 2]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*given.columns, pa.array(np.concatenate(block)), pa.array(nodes, pa.list_(pa.int64()))], schema=schema
            )

    return arrow_map(rows, run, fields)


def _next_state(state: DataFrame, measured: DataFrame, held: int) -> DataFrame:
    """The ``held`` best nodes of each query, which of these are open, and the best to open next."""
    told = measured.groupBy("query").agg(
        F.flatten(F.collect_list("found")).alias("found"), F.flatten(F.collect_list("sims")).alias("new")
    )
    rows = state.join(told, "query", "left").select(
        "query", "vector", "pool", "sims", F.array_union("opened", "next").alias("opened"),
        F.coalesce("found", F.array().cast("array<bigint>")).alias("found"), F.coalesce("new", F.array().cast("array<double>")).alias("new"),
    )
    fields = "query:int64 vector:doubles pool:longs sims:doubles opened:longs next:longs"
    schema = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for row in range(len(batch)):
                pool, sims, opened, found, new = (batch.column(i)[row].values.to_numpy() for i in (2, 3, 4, 5, 6))
                ids, first = np.unique(np.r_[pool, found], return_index=True)
                s = np.r_[sims, new][first]
                order = np.lexsort((ids, -s))[:held]
                pool, s = ids[order], s[order]
                is_open = np.isin(pool, opened)
                for column, value in zip(out, (pool, s, pool[is_open], pool[~is_open][:OPEN]), strict=True):
                    column.append(value)
            arrays = [pa.array(c, t.type) for c, t in zip(out, list(schema)[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], schema=schema)

    return arrow_map(rows, run, fields).withColumn("extra", F.array().cast("array<bigint>"))


def inner_product(a: Column, b: Column) -> Column:
    """In double precision, component by component; missing components count as zero."""
    products = F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0.0)))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def nearest(
    rows: DataFrame, queries: DataFrame, top: int = TOP, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, key, score): each query's best rows but its own, nearest first.

    ``queries`` has the columns of ``rows``; a query whose id is among the rows is never its own neighbour.
    """
    size, size_asked = extent(rows, vector), extent(queries, vector)
    vectors = stored(packed(distinct_vectors(rows, key, vector), size), "vectors")
    asked = stored(packed(distinct_vectors(queries, key, vector), size_asked), "asked")
    # equal vectors are one node, named by its smallest id; the smallest top + 1 ids of a node can be in a result
    named = vectors.groupBy("vector").agg(F.min("id").alias("id"))
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    scaled = F.transform("vector", lambda x: x / largest)
    norm = largest * F.sqrt(inner_product(scaled, scaled))
    nodes = stored(packed(named.select("id", "vector", norm.alias("norm")), size), "nodes")
    facts = nodes.agg(F.count("*").alias("n"), F.max("norm").alias("longest"), F.max(F.size("vector")).alias("width")).first()
    if not facts["n"]:
        return rows.sparkSession.createDataFrame([], f"query_id bigint, rank int, {key} bigint, score double")
    n, width, longest = facts["n"], facts["width"], facts["longest"]
    graph = neighbour_graph(stored(packed(coded(nodes, width, longest), size), "codes"), width, n)
    # queries of equal vectors are searched once
    distinct = asked.groupBy("vector").agg(F.min("id").alias("query"))
    distinct = distinct.join(nodes.select("vector", F.col("id").alias("start")), "vector", "left")
    distinct = stored(packed(distinct, size_asked), "queries")
    long = [r["id"] for r in nodes.orderBy(F.desc("norm"), "id").select("id").limit(ENTRIES).collect()]
    found = greedy_search(distinct, nodes, graph, n, width, long, top)
    scored = stored(packed(found, 24 * (top + 1) * distinct.count()), "scored")
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    member = vectors.withColumn("rank", rank).where(F.col("rank") <= top + 1).select("vector", "id")
    member = member.join(nodes.select("vector", F.col("id").alias("node")), "vector").select("node", F.col("id").alias(key))
    best = Window.partitionBy("query").orderBy(F.desc("score"), key)
    found = scored.join(member, "node").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top + 1)
    each = asked.join(distinct.select("vector", "query"), "vector").select(F.col("id").alias("query_id"), "query")
    named = each.join(found.select("query", key, "score"), "query").where(F.col("query_id") != F.col(key))
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    ranked = named.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= top)
    return packed(ranked.select("query_id", "rank", key, "score"), 28 * top * asked.count())
