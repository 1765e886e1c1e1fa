"""Neighbours found against brute force: recall, exact scores, ties and edge rows."""

import numpy as np

from conftest import SF_CHECK
from wardstar.llm import ann as A
from pyspark.sql import functions as F


def brute(rows, asked, k=5):
    """Ids and scores of the k nearest, ties to smaller ids."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    norms = np.sqrt((x * x).sum(1))
    out = {}
    for q, v in asked:
        s = x @ np.array(v, float) / (norms * np.sqrt(np.dot(v, v)))
        s[ids == q] = -9
        out[q] = [(int(ids[j]), float(s[j])) for j in np.lexsort((ids, -np.round(s, 12)))[:k] if ids[j] != q]
    return out


def by_query(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_registered_query_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").collect()]
    want, got = brute(rows, [r for r in rows if r[0] % 50 == 0]), by_query(A.op9_nearest_neighbours(spark, SF_CHECK))
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in want[q]} & {i for i, _ in got[q]}) / len(want[q]) for q in want]
    assert np.mean(hits) >= 0.95
    scores = {(q, i): s for q, x in want.items() for i, s in x}
    assert all(abs(s - scores[q, i]) < 1e-12 for q, x in got.items() for i, s in x if (q, i) in scores)


def test_recall_on_unclustered_vectors(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rnd.normal(size=(3000, 16)).astype(np.float32))]
    got = by_query(A.nearest(spark.createDataFrame(rows, "vec_id long, vec array<float>"), F.col("vec_id") % 50 == 0))
    want = brute(rows, [r for r in rows if r[0] % 50 == 0])
    assert np.mean([len({i for i, _ in want[q]} & {i for i, _ in got[q]}) / 5 for q in want]) >= 0.9


def test_recall_in_groups_of_near_copies_and_parallel_vectors(spark):
    rnd = np.random.default_rng(8)
    near = rnd.normal(size=64) + rnd.normal(size=(2000, 64)) * 0.001
    line = np.arange(-8.0, 24.0)
    rows = [(i, v.tolist()) for i, v in enumerate(near)] + [(i, (line * (1 + (i * 7) % 1201)).tolist()) for i in range(2000, 3200)]
    got = by_query(A.nearest(spark.createDataFrame(rows, "vec_id long, vec array<double>"), F.col("vec_id") % 100 == 0))
    want = brute([r for r in rows if r[0] < 2000], [r for r in rows if r[0] < 2000 and r[0] % 100 == 0])
    assert np.mean([len({i for i, _ in want[q]} & {i for i, _ in got[q]}) / 5 for q in want]) >= 0.9
    assert all([i for i, _ in got[q]] == [i for i in range(2000, 2006) if i != q][:5] for q in range(2000, 3200, 100))


def test_equal_vectors_and_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(40, 140)] + [(200, [1.0, 2.0, 0.6]), (201, [-1.0, 0.0, 0.0]), (202, [2.0, 4.0, 1.0])]
    bad = [(0, None), (300, [0.0, 0.0, 0.0]), (301, [nan, 1.0, 1.0]), (302, [None, 1.0, 1.0]), (350, [inf, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (303, [])]
    df = spark.createDataFrame(rows + bad + [(41, [1.0, 2.0, 0.5])], "vec_id long, vec array<double>")
    got = by_query(A.nearest(df, F.col("vec_id") % 50 == 0))
    assert got.keys() == {50, 100, 200}
    assert [i for i, _ in got[50]] == [40, 41, 41, 42, 43] and all(abs(s - 1) < 1e-12 for _, s in got[50])
    assert [i for i, _ in got[200]] == [40, 41, 41, 42, 43]
    assert A.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], df.schema)
    assert [i for i, _ in by_query(A.nearest(two, F.col("vec_id") % 50 == 0))[0]] == [1]
    one = spark.createDataFrame([(0, [1.0, 0.0])], df.schema)
    assert A.nearest(one, F.col("vec_id") % 50 == 0).count() == 0


def test_rows_of_the_adjacency_are_short(spark):
    rnd = np.random.default_rng(5)
    codes = [(i, bytes(v.tobytes())) for i, v in enumerate(rnd.normal(size=(30, 8)).astype(np.float32))]
    nodes = spark.createDataFrame(codes, "node long, code binary")
    edges = [(a, b, 0.0 - b, False) for a in range(30) for b in range(20) if a != b]
    graph = spark.createDataFrame(edges, "src long, dst long, sim float, new boolean")
    rows, around = A._adjacency(graph, nodes, 20).collect(), {}
    for r in A.around(graph, 20).collect():
        around.setdefault(r.center, set()).add(r.member)
    code = dict(codes)
    assert all(len(r.near) <= A.NEAR and bytes(r.codes) == b"".join(code[i] for i in r.near) for r in rows)
    assert {r.node: sorted(i for o in rows if o.node == r.node for i in o.near) for r in rows} == {n: sorted(x) for n, x in around.items()}
