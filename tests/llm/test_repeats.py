"""Removed words against a plain version over all windows."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_SMALL
from wardstar.llm import repeats as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, window=13):
    first = {}
    key = lambda d: 1 << 63 if d is None else d
    cut = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in cut:
        for i in range(len(w) - window + 1):
            seq = tuple(w[i : i + window])
            first[seq] = min(key(d), first.get(seq, 1 << 63))
    out = []
    for d, w in cut:
        gone = {i + k for i in range(len(w) - window + 1) if first[tuple(w[i : i + window])] < key(d) for k in range(window)}
        out.append((d, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def got(docs, window=13):
    return sorted((tuple(r) for r in R.without_repeats(docs, window).collect()), key=str)


def test_registered_query_matches_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    out = R.op11_substring_dedup(spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    want = sorted(((d, n, r, hashlib.sha256(k.encode()).hexdigest()) for d, n, r, k in plain(rows)), key=str)
    assert sorted((tuple(r) for r in out.collect()), key=str) == want and any(r[2] for r in want)


@pytest.mark.parametrize("asked", [1 << 22, 5])
def test_small_blocks_copies_and_passages(spark, monkeypatch, asked):
    monkeypatch.setattr(R, "ASKED", asked)
    rnd = random.Random(2)
    phrases = [[rnd.choice("abcdefgh") * rnd.randrange(1, 3) for _ in range(rnd.randrange(3, 30))] for _ in range(12)]
    rows = []
    for i in range(120):
        w = []
        for _ in range(rnd.randrange(5)):
            w += rnd.choice(phrases)
            w += [f"w{rnd.randrange(10**6)}" for _ in range(rnd.randrange(4))]
        rows.append((rnd.choice([i, i, i, None, rnd.randrange(60)]), " ".join(w)))
    rows += rnd.sample(rows, 30) + [(500 + i, rows[3][1]) for i in range(20)]  # rows that repeat, copies
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for window in (4, 13):
        assert got(docs, window) == plain(rows, window)


def test_edges(spark):
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(7, None), (3, ""), (4, " \n\t"), (5, base), (6, "x\x0b" + base.replace(" ", "  ") + " y"), (None, base), (None, base),
            (5, base), (9, "é " * 30000), (10, "é " * 20), (11, "É " * 20), (12, base[:30]), (2, base + " tail")]
    docs = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id long, text string, block string")
    assert got(docs) == plain(rows)
    assert got(docs.limit(0)) == []
    assert R.op11_substring_dedup.__name__ in R.QUERIES


def test_automaton_matches_at_words_only():
    held = R.words(pa.array(["a b", "b a b", "ab"]))
    phrases = R.Phrases(held, held.begins[:-1], np.diff(held.begins), np.array([1, 2, 3]))
    w = R.words(pa.array(["a b a b ab", "zz b"]))
    text = phrases.spelled(w)
    assert sorted(phrases.found(text[:15])) == [(0, 2, 1), (1, 4, 2), (2, 4, 1), (4, 5, 3)]
    assert phrases.found(text[15:]) == []


def test_parts_of_a_passage_in_several_texts(spark):
    """Windows that stand together in the origin and apart in the texts that repeat them."""
    w = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(w)), (2, " ".join(w[:14] + ["x"] + w[1:20])), (3, " ".join(w[7:22] + ["y"] + w[20:])), (4, " ".join(w[::-1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4, "doc_id")
    assert got(docs) == plain(rows)
