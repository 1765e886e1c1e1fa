"""Fingerprints against a plain version, links and components against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from conftest import SF_SMALL
from wardstar.llm import simhash as S
from wardstar.llm.components import components


def plain_fingerprint(text, n=4):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ")
             .replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute_components(fps, radius=4):
    parent = list(range(len(fps)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return [top(i) for i in range(len(fps))]


def expected(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    tops = brute_components(fps)
    least = {}
    for (d, _), t in zip(rows, tops):
        if d is not None:
            least[t] = min(d, least.get(t, d))
    return sorted((d if d is not None else -1, f"{f:016x}", least.get(t, -1)) for (d, _), f, t in zip(rows, fps, tops))


def got(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = S.near_duplicates(docs).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, f"{r.fp & (1 << 64) - 1:016x}",
                   -1 if r.component_id is None else r.component_id) for r in out)


def test_registered_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    out = S.op2_simhash_near_dedup(spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in out) == expected(rows)


def test_edges(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE  two"), (6, "one two"), (7, base),
            (8, base + " tail"), (9, base), (9, base), (None, base), (None, "alone here"), (11, "É é"), (12, "é é"),
            (13, "x " * 40000)]
    assert got(spark, rows) == expected(rows)
    assert got(spark, []) == []


@pytest.mark.parametrize("m", [2, 3, 64, 65, 300])
def test_bit_sliced_links_match_all_pairs(m):
    rnd = random.Random(m)
    base = [rnd.getrandbits(64) for _ in range(max(1, m // 6))]
    fps = []
    for _ in range(m):
        f = rnd.choice(base)
        for _ in range(rnd.randrange(7)):
            f ^= 1 << rnd.randrange(64)
        fps.append(f)
    fps = sorted(set(fps))
    u, v = S.cell_links(np.array(fps, np.uint64), 4)
    label = {f: f for f in fps}
    label.update(dict(zip(u.tolist(), v.tolist())))
    tops = brute_components(fps)
    assert [label[f] for f in fps] == [fps[t] for t in tops]


def test_cells_of_every_size_find_the_same_links(spark, monkeypatch):
    rnd = random.Random(5)
    fps = {0}
    for _ in range(40):
        f = rnd.getrandbits(64)
        for _ in range(12):
            fps.add(f)
            f ^= 1 << rnd.randrange(64) | 1 << rnd.randrange(64)
    fps = sorted(fps)
    want = brute_components(fps)
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    for cell, chunk in ((16384, 4096), (16384, 7), (0, 4096)):
        monkeypatch.setattr(S, "CELL", cell)
        monkeypatch.setattr(S, "CHUNK", chunk)
        masks = S.masks_for(len(fps), 4)
        if cell:
            assert len(masks) == 5
        else:
            monkeypatch.setattr(S, "masks_for", lambda n, r: [sum(c) for c in __import__("itertools").combinations(S.bit_ranges(7), 3)])
        roots = {r.node: r.root for r in components(S.links(frame, 4)).collect()}
        groups = {}
        for f, t in zip(fps, want):
            s = f - (1 << 64) if f >> 63 else f
            groups.setdefault(t, set()).add(roots.get(s, s))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 90), (95, 100), (7, 7), (None, 3)]
    out = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(out[i] == 0 for i in range(61)) and out[100] == out[95] == out[90] == 90 and len(out) == 64
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
