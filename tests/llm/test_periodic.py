"""Runs against a direct search for maximal repetitions; the registered query against it too."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from conftest import SF_SMALL
from wardstar.llm import periodic as P

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w, shortest=6):
    """For every period the maximal stretches of equal words that far apart; smallest periods only."""
    out, n = [], len(w)
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            lo = i - q
            while i < n and w[i] == w[i - q]:
                i += 1
            if i - lo >= max(shortest, 4 * q) and not any(
                all(w[k] == w[k - d] for k in range(lo + d, i)) for d in range(1, q) if q % d == 0
            ):
                out.append((lo, i - lo, q))
    return sorted(out)


def plain_row(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def random_words(rnd):
    letters = rnd.choice([1, 2, 3, 30])
    w = []
    while len(w) < rnd.randrange(1, 200):
        if rnd.random() < 0.4:
            unit = [rnd.randrange(letters) for _ in range(rnd.randrange(1, 12))]
            w += (unit * 9)[: rnd.randrange(1, 8 * len(unit))]
        else:
            w += [rnd.randrange(letters) for _ in range(rnd.randrange(1, 9))]
    return w


@pytest.mark.parametrize("seed", range(8))
def test_automaton_and_stretches_find_all_runs(seed):
    rnd = random.Random(seed)
    texts = [random_words(rnd) for _ in range(60)] + [[], [1] * 5, [1] * 6, [1, 2] * 4, [1, 2, 3, 4] * 4, [1, 1, 2, 2] * 5]
    for w in texts:
        assert P.automaton_runs(w) == plain_runs(w), w
    begins = np.concatenate([[0], np.cumsum([len(w) for w in texts])])
    codes = np.array([c for w in texts for c in w], np.int64)
    want = [(t, *r) for t, w in enumerate(texts) for r in plain_runs(w)]
    assert P.runs(codes, begins) == want


def test_long_texts_take_about_their_length():
    import time

    for w in ([7] * 30000, list(range(100)) * 300, [0, 1] * 15000):
        begin = time.time()
        assert P.automaton_runs(w) == [(0, len(w), len(set(w)))]
        assert time.time() - begin < 8


def test_registered_query_matches_plain_version(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    out = P.op13_periodic_runs(spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted(tuple(r) for r in out.collect())
    want = sorted(plain_row(r.doc_id, r.text) for r in rows)
    assert got == want and any(r[1] for r in got)


def test_edges(spark):
    rows = [(1, None, 5), (2, "", 5), (3, " \n\t ", 5), (None, "a a a a a a", 5), (None, "a a a a a a", 5),
            (4, " é x  b\x0bé x b é x b é x b tail", 5), (5, "k " * 50000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = sorted(((r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed) for r in P.collapse(docs).collect()), key=str)
    want = sorted([(1, [], ""), (2, [], ""), (3, [], ""), (0, [(0, 6, 1)], "a"), (0, [(0, 6, 1)], "a"),
                   (4, [(0, 8, 2)], "é x b tail"), (5, [(0, 50000, 1)], "k")], key=str)
    assert got == want
    assert P.collapse(docs.limit(0)).count() == 0
    assert P.plant(docs.select("doc_id", "text")).where("doc_id is null").count() == 2
