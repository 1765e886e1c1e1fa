"""The field against all label sequences, vectorised features against plain ones, held-out accuracy and edge rows."""

import itertools
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from wardstar.llm import crf as C
from wardstar.llm import langid as L


def test_forward_backward_and_viterbi_match_enumeration():
    r = np.random.default_rng(0)
    lengths, k = np.array([3, 1, 4, 2]), 3
    e, moves, start = r.normal(size=(10, k)) * 3, r.normal(size=(k, k)), r.normal(size=k)
    p, expected, logs = C.marginals(e, lengths, moves, start)
    labels, at, counts = C.viterbi(e, lengths, moves, start), 0, np.zeros((k, k))
    for i, n in enumerate(lengths):
        scores = {y: start[y[0]] + sum(e[at + j, y[j]] for j in range(n)) + sum(moves[a, b] for a, b in itertools.pairwise(y)) for y in itertools.product(range(k), repeat=int(n))}
        total = sum(np.exp(s) for s in scores.values())
        for j, y0 in itertools.product(range(n), range(k)):
            assert np.isclose(p[at + j, y0], sum(np.exp(s) for y, s in scores.items() if y[j] == y0) / total)
        for y, s in scores.items():
            for a, b in itertools.pairwise(y):
                counts[a, b] += np.exp(s) / total
        assert np.isclose(logs[i], np.log(total)) and tuple(labels[at : at + n]) == max(scores, key=scores.get)
        at += n
    assert np.allclose(counts, expected)


def test_features_do_not_depend_on_the_batch():
    words = ["a", "ab", "übelst", "the", "the", "x" * 40, "日本"]
    weights = np.concatenate([np.random.default_rng(1).normal(size=(L.DIMS, 3)), np.zeros((1, 3))])
    every = L.WordFeatures(words)
    found, counts = every.ragged()
    ends = np.cumsum(counts)
    for i, w in enumerate(words):
        alone = L.WordFeatures([w])
        assert sorted(alone.ragged()[0].tolist()) == sorted(found[ends[i] - counts[i] : ends[i]].tolist())
        assert np.allclose(alone.emissions(weights), every.emissions(weights)[i])
        assert np.allclose(every.emissions(weights)[i], weights[found[ends[i] - counts[i] : ends[i]]].sum(0))


def test_words_of_a_switched_sentence():
    rnd = random.Random(1)
    vocab = {"aa": ["bak", "bal", "bam", "ban", "bar", "bas"], "zz": ["zok", "zol", "zom", "zon", "zor", "zos"]}
    texts = [(lang, " ".join(rnd.choice([*vocab[lang], "ok"]) for _ in range(60))) for lang in vocab for _ in range(20)]
    names, model = L.learn([t for _, t in texts], [x for x, _ in texts])
    probability = L.Labeller(names, model).words([["bak", "ok", "bam", "zok", "ok", "zon"]])
    assert [names[i] for i in probability.argmax(1)] == ["aa", "aa", "aa", "zz", "zz", "zz"]


def test_cache_does_not_change_results(monkeypatch):
    names, model = L.learn(["one two three"] * 5 + ["uno dos tres"] * 5, ["en"] * 5 + ["es"] * 5)
    texts = [f"one{i} dos{i % 7} three. Uno {i}" for i in range(50)]
    want = L.Labeller(names, model).texts(texts)
    monkeypatch.setattr(L, "_CACHE", 9)
    small = L.Labeller(names, model)
    got = [tuple(x[0] for x in small.texts([t])) for t in texts]
    assert [g[0] for g in got] == want[0] and np.allclose([g[1] for g in got], want[1])


def test_registered_query(spark):
    out = L.op10_language_id(spark, SF_SMALL).collect()
    ids = [r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id").collect()]
    assert sorted(r.doc_id for r in out) == sorted(ids)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in out)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "lang")
    out = L.op10_language_id(spark, SF_CHECK).where("held_out").join(docs, "doc_id")
    right, every = out.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / every > 0.95


def test_edges(spark):
    schema = "doc_id long, text string, lang string, score string"
    rows = [(1, None, "en", None), (2, "", "en", None), (3, "12 34 !!", None, None), (7, "½ ²", None, None), (None, "the house of the rising sun", None, None),
            (4, "the house of the rising sun", "en", "x"), (5, "das haus der kinder", "de", None), (5, "das haus der kinder", "de", None),
            (6, "das haus " * 50000, "de", None)]
    docs = spark.createDataFrame(rows, schema)
    names, model = L.train(docs)
    assert names == ["de", "en"]
    out = {(r.doc_id, r.text[:9] if r.text else r.text): r for r in L.identify(docs, names, model).collect()}
    assert all(out[k].lang_pred == "und" and out[k].score == 0 for k in ((1, None), (2, ""), (3, "12 34 !!"), (7, "½ ²")))
    assert out[(None, "the house")].lang_pred == "en" and out[(6, "das haus ")].lang_pred == "de"
    nothing = L.train(docs.where("lang is null"))
    assert nothing == ([], None) and {r.lang_pred for r in L.identify(docs, *nothing).collect()} == {"und"}
    assert L.identify(docs.limit(0), names, model).count() == 0
