"""Exact top-k by inner product with block-at-a-time pruning.

Vectors are documents whose terms are the dimensions, with integer weights of
either sign.  Queries and documents are cut into query blocks and document
blocks by hash of the id, and every pair of them is one cell of bounded size
(``DOCS`` plus ``ASKS`` rows).  Within a cell the documents are put in an
order that keeps like vectors together (halved at the median of the most
spread dimension, again and again) and cut into ranges of ``RANGE``.  A range
keeps the largest and smallest weight of each term; a query's bound for it is
the sum over terms of the query's weight times whichever is larger.  Ranges are
scored from the highest bound down, through the range's rows (its forward
index), until a bound falls below the k-th score so far.  A bound equal to the
k-th score is still scored, for ties go to the smaller id.  The best k of each
cell are merged per query.

Defined results: vectors that are null or hold a null or non-finite component,
and rows without an id, take no part; shorter vectors count as continued with
zeros; rows that repeat are candidates each, and a query is answered once per
id; fewer candidates than k give all of them; no rows give no rows.  Sums must
fit a 64-bit integer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstar.llm.common import finite, grouped, matrix, staged, table

DOCS, ASKS, RANGE = 1 << 13, 1 << 10, 32
_STEP = 4  # ranges scored at once


def like_order(rows: np.ndarray, size: int) -> np.ndarray:
    """An order of the rows in which ranges of ``size`` hold like rows."""
    todo, out = [np.arange(len(rows))], []
    while todo:
        part = todo.pop()
        if len(part) <= size:
            out.append(part)
            continue
        some = rows[part]
        by = some[:, int(some.var(0).argmax())]
        half = len(part) // (2 * size) * size or size
        cut = np.argpartition(by, half - 1 if half == len(part) else half)
        todo += [part[cut[half:]], part[cut[:half]]]
    return np.concatenate(out) if out else np.arange(0)


class Ranges:
    """Documents of a cell in ranges, with term maxima and minima."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = like_order(rows, RANGE)
        self.ids, self.rows = ids[order], rows[order]
        begins = np.arange(0, len(order), RANGE)
        self.most, self.least = np.maximum.reduceat(self.rows, begins, axis=0), np.minimum.reduceat(self.rows, begins, axis=0)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per query its number, the best ids and their scores; rows with the query's own id are left out."""
        bounds = np.maximum(queries, 0) @ self.most.T + np.minimum(queries, 0) @ self.least.T
        orders = np.argsort(-bounds, axis=1, kind="stable")
        n, inside = len(self.ids), np.arange(RANGE)
        for q, (query, order) in enumerate(zip(queries, orders)):
            ids, scores = self.ids[:0], queries[:0, 0]
            for at in range(0, len(order), _STEP):
                if len(ids) == k and bounds[q, order[at]] < scores[-1]:
                    break
                rows = (order[at : at + _STEP, None] * RANGE + inside).ravel()
                rows = rows[rows < n]
                got = self.rows[rows] @ query
                new = self.ids[rows]
                fits = new != own[q]
                if len(ids) == k:
                    fits &= got >= scores[-1]
                if not fits.any():
                    continue
                ids, scores = np.concatenate([ids, new[fits]]), np.concatenate([scores, got[fits]])
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
            yield q, ids, scores


def cells(docs: DataFrame, queries: DataFrame, doc_rows: int, query_rows: int) -> DataFrame:
    """Rows of every pair of a document block and a query block: db, qb, is_query, vec_id, vec."""
    n_docs, n_queries = (max(1, math.ceil(x.count() / size)) for x, size in ((docs, doc_rows), (queries, query_rows)))
    block = lambda n: F.pmod(F.xxhash64("vec_id", "vec"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = docs.select(block(n_docs).alias("db"), "vec_id", "vec", every(n_queries).alias("qb"), F.lit(False).alias("is_query"))
    right = queries.select(block(n_queries).alias("qb"), "vec_id", "vec", every(n_docs).alias("db"), F.lit(True).alias("is_query"))
    return left.unionByName(right).repartition("db", "qb").sortWithinPartitions("db", "qb")


def top_k(docs: DataFrame, queries: DataFrame, k: int = 5, doc_rows: int = DOCS, query_rows: int = ASKS) -> DataFrame:
    """``docs`` and ``queries`` (vec_id, vec array<long>) to query_id, rank, vec_id, score."""
    queries = queries.dropDuplicates(["vec_id", "vec"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in grouped(batches, ("db", "qb")):
            asks = cell.column("is_query").to_numpy().astype(bool)
            if asks.all() or not asks.any():
                continue
            rows, ids = matrix(cell.column("vec")), cell.column("vec_id").to_numpy()
            if rows.shape[1] == 0:
                rows = np.zeros((len(ids), 1), np.int64)
            largest = float(np.abs(rows.astype(np.float64)).max(initial=0))
            if largest * largest * rows.shape[1] < 2**53:  # exact in doubles
                rows = rows.astype(np.float64)
            own = ids[asks]
            for q, best, scores in Ranges(ids[~asks], rows[~asks]).search(rows[asks], own, k):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best), own[q])), pa.array(best), pa.array(scores.astype(np.int64))], names=["query_id", "vec_id", "score"]
                )

    found = cells(docs, queries, doc_rows, query_rows).mapInArrow(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_exact_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").where(F.col("vec_id").isNotNull() & finite(F.col("embedding")))
    # floor gives a long; doubles beyond it are not in a 64-bit contract
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    docs = staged(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vec")), "quantised")
    return top_k(docs, docs.where("vec_id % 50 = 0"))


ORACLES = {
    "op6_exact_top_k": """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, d.vec_id, list_inner_product(q.e, d.e)::bigint as score
  from v q join v d on q.vec_id % 50 = 0 and q.vec_id <> d.vec_id),
r as (select *, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5""",
}
QUERIES = {"op6_exact_top_k": op6_exact_top_k}
