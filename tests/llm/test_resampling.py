"""CRC states against zlib, the whole operator against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_SMALL
from wardstar.llm import resampling as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_buckets(text):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def plain(rows, target):
    docs = [(d, *plain_buckets(t)) for d, t in rows]
    s, t = Counter(b for _, _, bs in docs for b in bs), Counter(b for x in target for b in plain_buckets(x)[1])
    all_s, all_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    out = []
    for d, n, bs in docs:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in bs)
        out.append([d, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    enough = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    for k, r in enumerate(enough[: 5 * len(enough) // 100], 1):
        r[4] = k
    return sorted((tuple(r[:5]) for r in out), key=str)


def test_shifted_joins_crcs():
    rnd = random.Random(3)
    a = [rnd.randbytes(rnd.randrange(40)) for _ in range(200)]
    b = [rnd.randbytes(rnd.choice([0, 1, 7, 127, 128, 129, 700])) for _ in a]
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    got = R.shifted(crc(a), np.array([len(x) for x in b])) ^ crc(b)
    assert got.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b)]


@pytest.mark.parametrize("head", [([], []), (["a", "é"], ["a a", "a é", "x y"]), (["a", "b", "c9"], ["b a"])])
def test_buckets_whatever_the_head(head):
    texts = [None, "", "  ", "A a é a", "b A-b.c9 é", "a", "Zz " + "q" * 300 + " a", "a a", "__É_é"]
    w = R.feature_words(pa.array(texts, pa.string())[1:])
    found = R.buckets_of(w, R.Head(*head))
    for i, text in enumerate(texts[1:]):
        got = found[w.begins[i] : w.begins[i + 1]].reshape(-1)
        assert sorted(got[got != R._NONE].tolist()) == sorted(plain_buckets(text)[1])


def test_head_holds_the_frequent(spark):
    docs = spark.createDataFrame([(i, "the cat of " * 30 + f"rare{i}") for i in range(50)], "doc_id long, text string")
    names, pairs = R.head(docs, size=3)
    assert sorted(names) == ["cat", "of", "the"] and sorted(pairs) == ["cat of", "of the", "the cat"]


def test_registered_query_matches_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("text").collect()]
    out = R.op12_importance_resampling(spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == plain(rows, target) and sum(r[4] is not None for r in got) > 5


def test_edges(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice(["aa", "b", "C", "d1"]) for _ in range(rnd.randrange(60))), "x") for i in range(300)]
    rows += [(None, "a b " * 15, "x"), (900, None, "x"), (901, "", "x"), (902, "one", "x"), (903, "é " * 60000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, weight string")
    target = spark.createDataFrame([("aa b d1",), (None,), ("",)], "text string")
    want = plain([r[:2] for r in rows], ["aa b d1", None, ""])
    out = R.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted((tuple(r) for r in out.collect()), key=str) == want
    again = docs.unionAll(docs.where("doc_id = 5"))  # a row that repeats is one more document
    assert R.resample(again, target).where("doc_id = 5").count() == 2
    assert R.resample(docs.limit(0), target).count() == 0
    assert R.resample(docs, target.limit(0)).count() == len(rows)
