"""Systematic mixing: targets, copies and edge rows."""

import random

from compare import compare, duck
from conftest import SF_SMALL
from wardstar.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, size string"


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    """Water filling by repeated resharing."""
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(full.values())
        over = [s for s in free if w[s] * left / sum(w[x] for x in free) > cap * sizes[s]]
        if not over:
            return {s: full[s] if s in full else w[s] * left / sum(w[x] for x in free) for s in names}
        full.update({s: cap * sizes[s] for s in over})


def test_matches_sql(spark):
    ok, msg = compare(M.op1_mixing(spark, SF_SMALL), duck(SF_SMALL), M.ORACLES["op1_mixing"])
    assert ok, msg


def test_targets_copies_and_edges(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(["w"] * rnd.choice([0, 1, 5, 20, 20, 20])), rnd.choice(["a", "a", "a", "b", "é", None]), "x")
            for i in range(600)]
    rows += [(9000, "tiny source", "z", None), (9001, None, "z", None), (None, "x y", "b", None), (5, "w w", "a", None),
             (5, "w w", "a", None), (9002, "", "empty", None), (9003, "q " * 30000, "b", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = M.mix(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in got:
        assert r["size"] == len((r.text or "").split())
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    want, taken, longest = brute_targets(sizes), {}, {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        longest[r.source] = max(longest.get(r.source, 0), r["size"])
    for s, t in taken.items():
        assert abs(t - want[s]) <= longest[s] + 20
    assert sorted(map(repr, got)) == sorted(map(repr, M.mix(df.repartition(7)).collect()))
    mixed = M.emit(M.mix(df), ["doc_id", "text", "source"])
    assert mixed.count() == sum(r.copies for r in got)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert M.mix(df).count() == 0
    one = M.mix(spark.createDataFrame([(1, None, None, "k")], SCHEMA)).first()
    assert (one["size"], one.target, one.taken) == (0, 0.0, 0)


def test_native_plan(spark):
    plan = M.op1_mixing(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
