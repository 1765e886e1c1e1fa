"""Approximate nearest neighbours by cosine: NN-descent graph, greedy search.

Graph.  Parallel vectors are one node.  Nodes start with the nearest of those
in their cells of a few random hyperplane partitions (a cell above ``CELL``
nodes is split by hash).  Then each round joins the neighbour table with
itself: every node collects its neighbours and those it is a neighbour of, all
pairs of them with a new member are compared there, and each node keeps the
``NEIGHBOURS`` nearest it has heard of.  Rounds end when few edges are new.

Search.  A query starts at its own node's neighbours and keeps a beam of the
``BEAM`` nearest nodes seen; each round expands those not yet expanded by a
join with the adjacency table, until a beam has none left.  A query whose
beam ends within the rounding error of its k-th best searches again with a
``WIDER`` times wider one.  All of the beam within that error of the k-th best
are scored on the original vectors in double precision.

Nodes travel as unit vectors in single precision and are compared by distance,
from products in double precision: the larger the cosine, the smaller it is,
and it is right to ``ERROR`` however close two vectors are, so that near copies
are told apart.  Rounds are written to the shared folder.  Per round the shuffles
are a constant number of rows per node or per query, but a query with very many
nodes that tie with its k-th best gathers all of them.  A node that is the
neighbour of very many hears of the ``NEIGHBOURS`` nearest of them.

Defined results: vectors that are null, zero, empty or hold a null or
non-finite component, and rows without an id, take no part; shorter vectors
count as continued with zeros; of parallel vectors the smaller ids come first;
fewer candidates than k give all that were found; no rows give no rows.
Different vectors whose 64-bit hashes agree share a node, but are scored each
on its own components.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstar.llm.common import finite, grouped, matrix, staged, table

NEIGHBOURS = 20
PARTITIONS, LEAF, CELL = 4, 200, 512
SETTLED = 0.1  # share of new edges at which the graph is settled
BEAM, EXPAND, WIDER = 512, 512, 4  # nodes kept and, per round, expanded per query; how much wider a search is repeated
NEAR = 4  # members in a row of the adjacency: its rows travel to Python in batches of a fixed number of rows
_NONE = -3.0  # below the similarity (distance with a minus) of any two unit vectors
ERROR = 2.0**-21  # of a distance: both vectors and the result are rounded to single precision


def first(frame: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key in this order."""
    at = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return frame.withColumn("_n", at).where(F.col("_n") <= n).drop("_n")


def similar(squares: np.ndarray, products: np.ndarray) -> np.ndarray:
    """Distances with a minus, from sums of both squared lengths and products (in double precision)."""
    return -np.sqrt(np.maximum(squares - 2 * products, 0)).astype(np.float32)


def _all_pairs(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    squares = np.einsum("ij,ij->i", rows, rows)
    sims = similar(squares[:, None] + squares[None, :], rows @ rows.T)
    np.fill_diagonal(sims, _NONE)
    return sims


def _codes(batch: pa.RecordBatch | pa.Table, width: int, code: str = "code") -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(code).to_pylist()), np.float32).reshape(-1, width)


def nodes_of(vectors: DataFrame, width: int) -> DataFrame:
    """``vectors(node, vec)``, each with a largest component of 1 or -1, to one row per node: node, code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = matrix(pa.chunked_array([batch.column("vec")]), width)
            codes = (rows / np.sqrt((rows * rows).sum(1, keepdims=True))).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([c.tobytes() for c in codes], pa.binary())], names=["node", "code"])

    return vectors.groupBy("node").agg(F.min("vec").alias("vec")).mapInArrow(run, "node long, code binary")


def _edges(src: np.ndarray, dst: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst), pa.array(sim.astype(np.float32))], names=["src", "dst", "sim"])


def _nearest(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest per src; an edge heard of again keeps its age."""
    once = edges.groupBy("src", "dst").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
    return first(once, ["src"], [F.desc("sim"), F.col("dst")], k)


def first_graph(nodes: DataFrame, count: int, width: int, k: int, seed: int) -> DataFrame:
    """Candidate edges (src, dst, sim) from the cells of random hyperplane partitions."""
    bits = max(0, math.ceil(math.log2(max(1, count / LEAF))))
    planes = np.random.default_rng(seed).normal(size=(PARTITIONS, width, bits)).astype(np.float32)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _codes(batch, width)
            for i in range(PARTITIONS):
                cell = ((rows @ planes[i] > 0) @ (1 << np.arange(bits))).astype(np.int64) if bits else np.zeros(len(rows), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), i, np.int32)), pa.array(cell), *(batch.column(c) for c in ("node", "code"))],
                    names=["part", "cell", "node", "code"],
                )

    cells = nodes.mapInArrow(cut, "part int, cell long, node long, code binary")
    sizes = cells.groupBy("part", "cell").count().where(F.col("count") > CELL)
    sizes = sizes.select("part", "cell", F.ceil(F.col("count") / CELL).alias("chunks"))
    chunk = F.pmod(F.xxhash64("node", "part"), F.coalesce("chunks", F.lit(1)))
    cells = cells.join(sizes, ["part", "cell"], "left").withColumn("chunk", chunk).drop("chunks")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in grouped(batches, ("part", "cell", "chunk")):
            if cell.num_rows < 2:
                continue
            rows, ids = _codes(cell, width), cell.column("node").to_numpy()
            sims = _all_pairs(rows)
            most = min(k, len(ids) - 1)
            best = np.argpartition(-sims, most - 1, axis=1)[:, :most]
            yield _edges(np.repeat(ids, most), ids[best].ravel(), np.take_along_axis(sims, best, 1).ravel())

    dealt = cells.repartition("part", "cell", "chunk").sortWithinPartitions("part", "cell", "chunk")
    return dealt.mapInArrow(near, "src long, dst long, sim float")


def around(graph: DataFrame, k: int) -> DataFrame:
    """center, member, new: neighbours and the nearest k that a node is a neighbour of; one of both kinds comes twice."""
    back = first(graph, ["dst"], [F.desc("sim"), F.col("src")], k)
    both = graph.select(F.col("src").alias("center"), F.col("dst").alias("member"), "new")
    return both.unionAll(back.select(F.col("dst").alias("center"), F.col("src").alias("member"), "new"))


def _members(group: pa.Table) -> pa.Table:
    """The rows of a center, each member once, in order; new if any of its rows is."""
    ids = group.column("member").to_numpy()
    different, at, which = np.unique(ids, return_index=True, return_inverse=True)
    new = np.bincount(which, group.column("new").to_numpy(), len(different)) > 0
    return group.take(pa.array(at)).drop_columns("new").append_column("new", pa.array(new))


def joined_neighbours(graph: DataFrame, nodes: DataFrame, width: int, k: int) -> DataFrame:
    """One round: pairs that meet at a common neighbour and improve on what either end has."""
    full = graph.groupBy("src").agg(F.count("*").alias("n"), F.min("sim").alias("worst"))
    worst = full.select(F.col("src").alias("node"), F.when(F.col("n") >= k, F.col("worst")).otherwise(_NONE).alias("worst"))
    known = nodes.join(worst, "node")
    itself = known.select(F.col("node").alias("center"), F.col("node").alias("member"), F.lit(True).alias("new"))
    members = around(graph, k).unionAll(itself).join(known, F.col("member") == F.col("node")).drop("node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in map(_members, grouped(batches, ("center",))):
            rows, ids = _codes(group, width), group.column("member").to_numpy()
            new, limit = group.column("new").to_numpy(), group.column("worst").to_numpy()
            sims = _all_pairs(rows)
            a, b = np.nonzero((sims > limit[:, None]) & (new[:, None] | new[None, :]))
            if len(a):
                yield _edges(ids[a], ids[b], sims[a, b])

    return members.repartition("center").sortWithinPartitions("center").mapInArrow(run, "src long, dst long, sim float")


def neighbour_graph(nodes: DataFrame, count: int, width: int, k: int = NEIGHBOURS, seed: int = 3) -> DataFrame:
    """NN-descent: src, dst, sim, new."""
    graph = staged(_nearest(first_graph(nodes, count, width, k, seed).withColumn("new", F.lit(True)), k), "neighbours")
    # each round joins it by node: dealt once, rebuilt from the written table if lost
    placed = nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "node").persist()
    while True:
        found = joined_neighbours(graph, placed, width, k).withColumn("new", F.lit(True))
        graph = staged(_nearest(graph.withColumn("new", F.lit(False)).unionAll(found), k), "neighbours")
        edges, new = graph.agg(F.count("*"), F.sum(F.col("new").cast("long"))).first()
        if (new or 0) <= SETTLED * edges:
            placed.unpersist()
            return graph


def _adjacency(graph: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """node, near (ids), codes (concatenated): the members of a node in rows of at most ``NEAR``."""
    both = around(graph, k).join(nodes, F.col("member") == F.col("node")).drop("node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in map(_members, grouped(batches, ("center",))):
            ids, codes, starts = group.column("member").to_pylist(), group.column("code").to_pylist(), range(0, group.num_rows, NEAR)
            node = pa.array(group.column("center").to_pylist()[: len(starts)], pa.int64())
            near = pa.array([ids[at : at + NEAR] for at in starts], pa.list_(pa.int64()))
            joined = pa.array([b"".join(codes[at : at + NEAR]) for at in starts], pa.binary())
            yield pa.RecordBatch.from_arrays([node, near, joined], names=["node", "near", "codes"])

    dealt = both.repartition("center").sortWithinPartitions("center")
    return dealt.mapInArrow(run, "node long, near array<long>, codes binary")


def beams(links: DataFrame, nodes: DataFrame, starts: DataFrame, width: int, size: int = BEAM) -> DataFrame:
    """Greedy search from each node of ``starts(query)``: query, node, sim for its final beam of at most ``size``."""
    asked = staged(starts.distinct().join(nodes, F.col("query") == F.col("node")).select("query", "code"), "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512)):
            near = batch.column("near")
            sizes = pa.compute.list_value_length(near).to_numpy()
            ids = near.flatten().to_numpy()
            there = _codes(batch, width, "codes").astype(np.float64)
            query = np.repeat(_codes(batch, width), sizes, axis=0).astype(np.float64)
            squares = np.einsum("ij,ij->i", there, there) + np.einsum("ij,ij->i", query, query)
            sims = similar(squares, np.einsum("ij,ij->i", there, query))
            fits = sims > np.repeat(batch.column("worst").to_numpy(), sizes)
            asker = np.repeat(batch.column("query").to_numpy(), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(asker[fits]), pa.array(ids[fits]), pa.array(sims[fits])], names=["query", "node", "sim"])

    def expand(frontier: DataFrame) -> DataFrame:
        rows = frontier.join(asked, "query").join(links, "node").select("query", "code", "worst", "near", "codes")
        return rows.mapInArrow(run, "query long, node long, sim float")

    by_query, by_done = Window.partitionBy("query"), Window.partitionBy("query", "done")
    nearest_first = [F.desc("sim"), F.col("node")]
    none = F.lit(_NONE).cast("float")

    def ranked(found: DataFrame) -> DataFrame:
        """The beam after a round, which of it the next one expands, and what that must beat; one shuffle serves all steps."""
        once = found.repartition("query").groupBy("query", "node").agg(F.max("sim").alias("sim"), F.max("done").alias("done"))
        kept = first(once, ["query"], nearest_first, size)
        go = ~F.col("done") & (F.row_number().over(by_done.orderBy(*nearest_first)) <= EXPAND * size // BEAM)
        worst = F.when(F.count("*").over(by_query) >= size, F.min("sim").over(by_query)).otherwise(none)
        return staged(kept.withColumn("go", go).withColumn("worst", worst), "beam")

    begin = asked.select("query", F.col("query").alias("node"), none.alias("worst"))
    beam = ranked(expand(begin).where("node <> query").withColumn("done", F.lit(False)))
    while not beam.where("go").isEmpty():  # a node that has left a full beam is below its worst and never comes back
        found = expand(beam.where("go").select("query", "node", "worst")).where("node <> query").withColumn("done", F.lit(False))
        beam = ranked(beam.select("query", "node", "sim", F.expr("done or go").alias("done")).unionAll(found))
    return beam.select("query", "node", "sim")


def candidates(graph: DataFrame, nodes: DataFrame, starts: DataFrame, width: int, k: int, size: int = BEAM) -> DataFrame:
    """query, node: all nodes found for each of ``starts(query)`` that may be among its k nearest."""
    partitions = int(graph.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # kept in this partitioning, so that a round only moves what is expanded; rebuilt from the written table if lost
    links = staged(_adjacency(graph, nodes, NEIGHBOURS), "adjacency").repartition(partitions, "node").persist()
    by_query = Window.partitionBy("query")
    margin = 2 * ERROR
    found = []
    while True:
        turn = F.row_number().over(by_query.orderBy(F.desc("sim"), "node"))
        beam = beams(links, nodes, starts, width, size).withColumn("turn", turn)
        beam = beam.withColumn("least", F.max(F.when(F.col("turn") == k, F.col("sim").cast("double"))).over(by_query) - margin)
        tied = (F.count("*").over(by_query) >= size) & (F.min("sim").over(by_query) >= F.col("least"))
        beam = staged(beam.withColumn("tied", tied).where("least is null or sim >= least").select("query", "node", "tied"), "found")
        found.append(beam.where("not tied").select("query", "node"))
        starts = beam.where("tied").select("query").distinct()
        if starts.isEmpty():
            break
        size *= WIDER
    links.unpersist()
    return functools.reduce(DataFrame.unionAll, found)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``vectors(vec_id, vec)``: query_id, rank, vec_id, score of the k nearest found for each row that is a query."""
    usable = finite(F.col("vec")) & F.exists("vec", lambda x: x != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & usable).select("vec_id", F.col("vec").cast("array<double>").alias("vec"))
    # parallel vectors become equal: the largest component is 1 or -1, no zeros at the end, no negative zeros
    last = F.array_max(F.transform("vec", lambda x, i: F.when(x != 0, i + 1).otherwise(0)))
    most = F.array_max(F.transform("vec", F.abs))
    rows = rows.withColumn("last", last).withColumn("most", most).select(
        "vec_id", F.transform(F.slice("vec", F.lit(1), F.col("last")), lambda x: x / F.col("most") + F.lit(0.0)).alias("vec")
    )
    rows = staged(rows.withColumn("node", F.xxhash64("vec")), "vectors")
    width = rows.agg(F.max(F.size("vec"))).first()[0] or 1
    nodes = staged(nodes_of(rows, width), "nodes")
    graph = neighbour_graph(nodes, nodes.count(), width)
    queries = rows.where(is_query).distinct()
    found = candidates(graph, nodes, queries.select(F.col("node").alias("query")), width, k)
    found = found.unionAll(queries.select(F.col("node").alias("query"), "node").distinct())
    # of parallel vectors only the k + 1 smallest ids can be among the k nearest
    members = first(rows, ["node"], [F.col("vec_id")], k + 1)
    pairs = found.join(members, "node").select("query", "vec_id", "vec")
    asked = queries.select(F.col("node").alias("query"), F.col("vec_id").alias("query_id"), F.col("vec").alias("query_vec"))
    pairs = pairs.join(asked, "query").where("vec_id <> query_id").select("query_id", "query_vec", "vec_id", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (matrix(pa.chunked_array([batch.column(c)]), width) for c in ("query_vec", "vec"))
            score = np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("vec_id"), pa.array(score)], names=["query_id", "vec_id", "score"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    scored = pairs.mapInArrow(run, f"query_id {kind}, vec_id {kind}, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_nearest_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    return nearest(vectors, F.col("vec_id") % 50 == 0)


QUERIES = {"op9_nearest_neighbours": op9_nearest_neighbours}
