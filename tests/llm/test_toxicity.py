"""The machine against a plain pair sum, planted pairs, held-out quality and edge rows."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from wardstar.llm import toxicity as T


def test_margin_is_the_pair_sum():
    rnd = np.random.default_rng(1)
    m = T.Machine(0.3, rnd.normal(size=T.DIMS), rnd.normal(size=(T.DIMS, 3)))
    docs = [np.array([], int), np.array([5]), np.array([1, 9, 70, 200])]
    want = [0.3 + m.weights[d].sum() + sum(m.factors[a] @ m.factors[b] for i, a in enumerate(d) for b in d[:i]) for d in docs]
    begins = np.cumsum([0, *map(len, docs)])
    assert np.allclose(m.margins(np.concatenate(docs).astype(int), begins), want)


def test_learns_a_pair_that_is_harmless_alone():
    rnd, terms = random.Random(2), T.Terms()
    filler = [f"{a}{b}x" for a in "bcdfgh" for b in "aeiou"]

    def doc(*extra):
        return " ".join(rnd.sample(filler, 12) + list(extra))

    rows = [(doc("zorg"), 0) for _ in range(300)] + [(doc("blip"), 0) for _ in range(300)] + [(doc("zorg", "blip"), 1) for _ in range(150)] + [(doc(), 0) for _ in range(300)]
    m = T.fit([terms(x) for x, _ in rows], np.array([y for _, y in rows], float), epochs=120)
    cases = [terms(doc("zorg", "blip")), terms(doc("zorg")), terms(doc("blip")), terms(doc())]
    scores = T.logistic(m.margins(np.concatenate(cases), np.cumsum([0, *map(len, cases)])))
    assert scores[0] > 0.5 and max(scores[1:]) < 0.3


def test_terms():
    t = T.Terms()
    assert len(t(None)) == len(t("")) == len(t("12 !!")) == 0
    assert set(t("Ab, ab AB!")) == {zlib.crc32(b"ab") % T.DIMS}
    assert set(t("Übelst*** ")) == {zlib.crc32(x.encode()) % T.DIMS for x in ("übelst", "übel*", "übels*", "übelst*")}


def test_registered_query(spark):
    out = T.op7_toxicity(spark, SF_SMALL).collect()
    ids = [r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id").collect()]
    assert sorted(r.doc_id for r in out) == sorted(ids)
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_held_out_documents(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("aeioulnrst") for _ in range(rnd.randrange(3, 9))) for _ in range(400)]
    rows = []
    for i in range(1500):
        toxic = rnd.random() < 0.15
        text = [rnd.choice(words) for _ in range(rnd.randrange(10, 80))]
        if toxic:
            text[3:3] = rnd.sample(["Idiot,", "SCUM", "trash!!"], 2)
        rows.append((i, " ".join(text), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    held = F.col("doc_id") % 4 == 2
    out = T.toxicity(docs, labels.where(~(F.col("doc_id") % 4 == 2)), held).where("held_out").collect()
    right = sum(r.predicted == rows[r.doc_id][2] for r in out)
    assert len(out) == 375 and right / len(out) > 0.98


def test_edges(spark):
    schema, labelled = "doc_id long, text string, score string, held string", "doc_id long, toxic int"
    rows = [(1, None, "a", None), (2, "", None, None), (None, "no id", None, None), (3, "same", None, None), (3, "same", None, None),
            (4, "x " * 100000, None, "b")]
    docs = spark.createDataFrame(rows, schema)
    none = spark.createDataFrame([], labelled)
    out = T.toxicity(docs, none, F.lit(None).cast("boolean")).collect()
    assert len(out) == 6 and all(r.score < 1e-9 and r.predicted == 0 for r in out)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (99, 0)], labelled)
    assert all(r.score > 0.99 for r in T.toxicity(docs, labels, F.lit(False)).collect())
    assert T.toxicity(docs.limit(0), labels, F.lit(False)).count() == 0
