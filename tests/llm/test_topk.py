"""Top-k against SQL and against all pairs, with pruning checked."""

import random

import numpy as np
import pytest

from compare import compare, duck
from conftest import SF_SMALL
from wardstar.llm import topk as K


def plain(rows, asked, k=5):
    out = []
    for qid in sorted({q for q, _ in asked}):
        every = []
        for q, v in {(q, tuple(v)) for q, v in asked if q == qid}:
            every += [(-sum(a * b for a, b in zip(v, w)), d) for d, w in rows if d != qid]
        out += [(qid, i + 1, d, -s) for i, (s, d) in enumerate(sorted(every)[:k])]
    return out


def test_matches_sql(spark):
    ok, msg = compare(K.op6_exact_top_k(spark, SF_SMALL), duck(SF_SMALL), K.ORACLES["op6_exact_top_k"])
    assert ok, msg


@pytest.mark.parametrize("doc_rows,query_rows", [(1 << 13, 1 << 10), (40, 3)])
def test_ties_repeats_and_blocks(spark, doc_rows, query_rows):
    rnd = random.Random(2)
    rows = [(i, [rnd.randrange(-3, 4) for _ in range(4)]) for i in range(300)] + [(7, [1, 1, 1, 1])] * 3 + [(900, [2]), (901, [])]
    rows += [(1000 + i, [3, 3, 3, 3]) for i in range(50)] + [(2000, [2**28, -(2**28), 5, 1])]
    docs = spark.createDataFrame(rows, "vec_id long, vec array<long>")
    asked = [r for r in rows if r[0] % 50 == 0]
    got = K.top_k(docs, docs.where("vec_id % 50 = 0"), 5, doc_rows, query_rows)
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain(rows, asked))


def test_edges(spark):
    schema = "vec_id long, vec array<long>"
    docs = spark.createDataFrame([(0, [1, 2]), (1, [3, 4]), (50, [0, -1])], schema)
    got = sorted(tuple(r) for r in K.top_k(docs, docs.where("vec_id % 50 = 0")).collect())
    assert got == [(0, 1, 1, 11), (0, 2, 50, -2), (50, 1, 0, -2), (50, 2, 1, -4)]
    assert K.top_k(docs.limit(0), docs.limit(0)).count() == 0
    alone = docs.where("vec_id = 0")
    assert K.top_k(alone, alone).count() == 0


def test_bad_vectors_take_no_part(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.001], "a"), (1, [0.25, 1.0], "b"), (2, None, "c"), (3, [nan, 1.0], "d"), (4, [None, 1.0], "e"), (None, [1.0, 1.0], "f"), (50, [inf, 0.0], None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert [tuple(r) for r in K.op6_exact_top_k(spark, str(tmp_path)).collect()] == [(0, 1, 1, 128 * 64 - 256)]


def test_ranges_beyond_the_bound_are_not_scored():
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(40, 8)) * 1000
    rows = np.round(centres[rnd.integers(0, 40, 4000)] + rnd.normal(size=(4000, 8)))
    ranges = K.Ranges(np.arange(4000), rows)
    read = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray):
                read.append(len(at))
            return super().__getitem__(at)

    ranges.rows = ranges.rows.view(Counted)
    for q, ids, scores in ranges.search(rows[:50], np.arange(50), 5):
        every = rows @ rows[q]
        every[q] = -np.inf
        assert sorted(scores) == sorted(np.sort(every)[-5:])
    assert sum(read) < 50 * 4000 / 4
