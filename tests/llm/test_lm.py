"""The trie against a plain PPM coder; baseline counts against a plain count; held-out gain."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from wardstar.llm import lm
from wardstar.llm.common import lower_words
from wardstar.llm.trie import Trie, normalised, packed, tagged


def plain_counts(texts, order):
    """Counts by context and symbol, contexts of 0 to order bytes, texts led by end bytes."""
    by = defaultdict(Counter)
    for t in texts:
        t = b"\n" * order + t
        for i in range(order, len(t)):
            for k in range(order + 1):
                by[t[i - k : i]][t[i]] += 1
    return by


def plain_score(by, text, order):
    out, t = 0.0, b"\n" * order + text
    for i in range(order, len(t)):
        excluded = set()
        for k in range(order, -1, -1):
            c = {s: n for s, n in by.get(t[i - k : i], {}).items() if s not in excluded}
            if not c:
                continue
            if t[i] in c:
                out += math.log10((2 * c[t[i]] - 1) / (2 * sum(c.values())))
                break
            out += math.log10(len(c) / (2 * sum(c.values())))
            excluded |= c.keys()
        else:
            out += math.log10(1 / (256 - len(excluded)))
    return out


def built(texts, order):
    by = plain_counts(texts, order)
    n = {c + bytes([s]): m for c, x in by.items() for s, m in x.items()}
    keys = np.array([tagged(np.uint64(int.from_bytes(g, "big")), len(g)) for g in n], np.uint64)
    return Trie(order, keys, np.array(list(n.values()))), by


@pytest.mark.parametrize("order", [1, 3, 5])
def test_trie_matches_plain_ppm(order):
    rnd = random.Random(order)
    texts = [normalised(bytes(rnd.choice(b"ab c") for _ in range(rnd.randrange(40)))) for _ in range(30)]
    trie, by = built(texts, order)
    new = [normalised(b"abc abd xyz \xc3\xa9"), b"\n", normalised(b"aaaa bbbb"), *texts[:5]]
    got = lm.score_texts(trie, new)
    assert np.allclose(got, [plain_score(by, t, order) for t in new])


def test_probabilities_sum_to_one():
    trie, _ = built([normalised(b"to be or not to be"), normalised(b"that is the question")], 4)
    keys, _ = packed([normalised(b"to see the bees in it")], 4)
    for key in keys:
        every = (key & ~np.uint64(255)) | np.arange(256, dtype=np.uint64)
        assert abs((10 ** trie.score(every)).sum() - 1) < 1e-6


def plain_rows(rows):
    held = [zlib.crc32(str(d).encode()) % 7 == 2 if d is not None else False for d, _ in rows]
    tokens = [[*lower_words(t), "\n"] for _, t in rows]
    c = Counter(w for x, h in zip(tokens, held) if not h for w in x)
    space = sum(c.values()) + len(c) + 1
    return sorted(((d if d is not None else -1), h, len(x), sum(w in c for w in x), sum(c.values()),
                   round(sum(math.log10((c[w] + 1) / space) for w in x), 4)) for (d, _), h, x in zip(rows, held, tokens))


def digest(df):
    return sorted(((r.doc_id if r.doc_id is not None else -1), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in df.collect())


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert digest(lm.op5_lm_scoring(spark, SF_SMALL)) == plain_rows(rows)


def test_longer_contexts_gain_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    totals = [lm.lm_scores(docs, held, order).where("held_out").agg(F.sum("score")).first()[0] for order in (1, 3, 5)]
    assert totals[0] < totals[1] < totals[2] < 0


@pytest.mark.parametrize("words,grams", [(1 << 18, 1 << 20), (3, 40)])
def test_edges_and_bounds(spark, words, grams):
    rows = [(1, None), (2, ""), (3, "A b a"), (3, "A b a"), (None, "b"), (4, "only here é"), (5, "x " * 30000), (9, "Σ ΣA")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = lm.lm_scores(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, words=words, grams=grams)
    assert digest(out) == plain_rows(rows)
    assert all(r.score < 0 for r in out.collect())
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lm.lm_scores(none, F.lit(False)).count() == 0
    untrained = lm.lm_scores(df, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in untrained)


@pytest.mark.parametrize("order,grams", [(5, 5), (5, 1 << 19), (3, 5), (1, 5)])
def test_scores_take_all_grams_whatever_the_tasks_get(spark, order, grams):
    rnd = random.Random(order)
    rows = [(i, " ".join("".join(rnd.choice("abcd") for _ in range(rnd.randrange(1, 9))) for _ in range(rnd.randrange(30)))) for i in range(60)]
    rows += [(60, "Another zone, never seen é"), (61, None), (0, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    by = plain_counts([normalised((t or "").encode()) for d, t in rows if d % 3], order)
    want = sorted(plain_score(by, normalised((t or "").encode()), order) for _, t in rows)
    got = sorted(r.score for r in lm.lm_scores(df, F.col("doc_id") % 3 == 0, order, grams).collect())
    assert np.allclose(got, want, rtol=1e-5)


def test_bound_on_grams():
    assert lm._least_power({0: 10, 1: 5, 3: 2}, 7) == 2 and lm._least_power({0: 10}, 10) == 1 and lm._least_power({2: 9}, 3) == 8
