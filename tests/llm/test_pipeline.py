"""Every stage against a brute-force version on a small fixture, and the whole on the smallest tables."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from conftest import SF_SMALL
from llm.test_simhash import brute_components, plain_fingerprint
from wardstar.llm import packing

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rnd = random.Random(8)
    vocab = {"aa": [f"b{x}k{y}" for x in "aeiou" for y in "aeiou"], "zz": [f"z{x}t{y}n" for x in "aeiou" for y in "aeiou"]}
    rows, labels = [], []
    for i in range(240):
        lang = "aa" if i % 3 else "zz"
        words = [rnd.choice(vocab[lang]) for _ in range(rnd.randrange(30, 120))]
        if toxic := i % 6 == 0:
            words[4:4] = ["idiot", "scum"]
        rows.append((i, " ".join(words), lang, rnd.choice(["a", "b", "c", None]), None))
        labels.append((i, 1, int(toxic)))
    rows += [(1000 + i, rows[7][1], "aa", "a", None) for i in range(5)] + [(rows[8][0], rows[8][1], "zz", "b", None)]
    rows += [(2000, None, "aa", "a", 0), (2001, "", None, None, 0), (2002, "12 34 !!", "aa", "a", 8), (None, rows[10][1] + " end", "aa", "a", None)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_stages_against_brute_force(spark, corpus):
    path, rows = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stages = dict(P.STAGES)

    kept = stages["language_id"](spark, docs, path)
    assert kept.columns == docs.columns
    assert ids(kept) == Counter(r[0] for r in rows if r[1] and any(c.isalpha() for c in r[1]))

    clean = stages["toxicity"](spark, kept, path)
    assert clean.columns == docs.columns
    assert ids(clean) == Counter(r.doc_id for r in kept.collect() if "idiot" not in r.text)

    one = stages["simhash_near_dedup"](spark, clean, path)
    there = [(r.doc_id, r.text) for r in clean.collect()]
    groups = {}
    for (d, t), g in zip(there, brute_components([plain_fingerprint(t) for _, t in there])):
        groups.setdefault(g, []).append((d is None, d or 0))
    assert one.columns == docs.columns
    assert ids(one) == Counter(None if min(g)[0] else min(g)[1] for g in groups.values())

    mix = stages["mixing"](spark, one, path)
    assert mix.columns == docs.columns
    taken, size = ids(mix), {r.doc_id: len(r.text.split()) for r in one.collect()}
    assert set(taken) <= set(size) and max(taken.values()) <= 3
    assert abs(sum(size[d] * n for d, n in taken.items()) / sum(size.values()) - 1) < 0.15

    pieces = stages["packing"](spark, mix, path).collect()
    tok = Tokenizer.from_file(packing.vocabulary_path())
    want = Counter()
    for r in mix.collect():
        found = [*tok.encode(r.text, add_special_tokens=False).ids, 1]
        want[(r.doc_id, len(found), zlib.crc32(np.array(found, "<u4").tobytes()))] += 1
    whole = Counter((p.doc_id, p.doc_tokens, p.ids_crc32) for p in pieces if p.length == p.doc_tokens)
    assert not whole - want and sum(p.length for p in pieces) == sum(n * k for (_, n, _), k in want.items())


def test_run(spark):
    out = P.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = out.collect()
    used = Counter()
    for r in rows:
        used[r.sequence_id] += r.length
    assert rows and max(used.values()) <= 2048


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_texts_without_any_known_language(spark, tmp_path):
    rows = [(1, "words é", None, None, 1), (2, "12", None, None, 2), (3, None, None, None, None)]
    docs = spark.createDataFrame(rows, COLUMNS)
    assert ids(P.language_id(spark, docs, str(tmp_path))) == Counter([1])


def test_columns_named_like_those_of_the_operators(spark, corpus):
    path, _ = corpus
    names = ["lang_pred", "Score", "size", "source_size", "target", "copies", "taken", "_key", "_hash", "_n", "_copy", "kept_0", "a.b"]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    mine = docs.selectExpr("*", *[f"concat('{n} of ', doc_id, ' ', crc32(text)) as `{n}`" for n in names])
    plain = docs
    for name, stage in P.STAGES[:-1]:
        mine, plain = stage(spark, mine, path), stage(spark, plain, path)
        assert mine.columns == [*docs.columns, *names]
        rows = mine.collect()
        assert Counter(r.doc_id for r in rows) == ids(plain)
        for r in rows:
            crc = None if r.text is None or r.doc_id is None else zlib.crc32(r.text.encode())
            assert [r[n] for n in names] == [None if crc is None else f"{n} of {r.doc_id} {crc}" for n in names]
        mine = spark.createDataFrame(rows, mine.schema)
        plain = spark.createDataFrame(plain.collect(), plain.schema)
    assert P.STAGES[-1][1](spark, mine, path).count()
