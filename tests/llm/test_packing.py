"""Packed pieces against the plain tokenizer; the subset-sum against all subsets."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from conftest import SF_SMALL
from wardstar.llm import packing as P


def check_pieces(rows, docs, window=2048, full=0.97):
    tok = Tokenizer.from_file(P.vocabulary_path())
    tok.encode_special_tokens = True
    want = Counter()
    for d, t in docs:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want[(d, len(ids), zlib.crc32(ids.tobytes()))] += 1
    by, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        assert 1 <= r.length <= window and zlib.crc32(r.ids) == zlib.crc32(bytes(r.ids)) and len(r.ids) == 4 * r.length
        by[(r.doc_id, r.doc_tokens)].append(r)
        windows[r.sequence_id].append(r)
    for w in windows.values():
        at = 0
        for r in sorted(w, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    got = Counter()
    for (d, n), ps in by.items():
        copies = sum(p.start == 0 for p in ps)
        if copies == 1:
            ps.sort(key=lambda p: p.start)
            assert [p.start for p in ps] == [sum(q.length for q in ps[:i]) for i in range(len(ps))]
            got[(d, n, zlib.crc32(b"".join(p.ids for p in ps)))] += 1
        else:  # rows that repeat
            assert sum(p.length for p in ps) == copies * n
            got.update({k: v for k, v in want.items() if k[:2] == (d, n)})
    assert got == want
    total = sum(r.length for r in rows)
    assert not rows or len(windows) <= total / window / full + 1


def test_registered_query_and_pieces(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    check_pieces(P.pack(frame).collect(), docs)
    out = P.op8_packing(spark, SF_SMALL)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() >= len(docs)


@pytest.mark.parametrize("group", [5, 1 << 14])
def test_edges(spark, group):
    docs = [(1, None), (2, ""), (None, "no id"), (3, "twice the same"), (3, "twice the same"), (4, "word " * 2047), (5, "word " * 2048),
            (6, "long " * 30000), (7, "a <|endoftext|> b"), (8, "NFC é ÅÅ ΣΑΣ İ x y\u0085z\x0b\x0c\x1c w"), (9, "it's don't we'll\n\nx1 2 3!? ...")]
    docs += [(100 + i, "x y z " * (i * 7 % 300)) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    check_pieces(P.pack(frame, group=group).collect(), docs, full=0.7)
    assert P.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_word_caches_do_not_change_ids(monkeypatch):
    tok = Tokenizer.from_file(P.vocabulary_path())
    tok.encode_special_tokens = True
    docs = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["text"]).column(0).to_pylist()
    docs += ["Don't you'll, (x) a* b** İstanbul. ΣΑΣ, ﬁn² 3rd e\u0301a \u212bx, |a|b| 日本語。", "a\x1cb \u00a0c\u2003d"]
    for cache in (1 << 18, 50):
        monkeypatch.setattr(P, "_CACHE", cache)
        encoder = P.Encoder(P.vocabulary_path())
        for text in docs:
            assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
        assert len(encoder) <= cache


def test_best_fill_is_closest():
    rnd = random.Random(3)
    for _ in range(200):
        items = [rnd.randrange(1, 30) for _ in range(rnd.randrange(1, 9))]
        space = rnd.randrange(1, 60)
        best = max(sum(c) for k in range(len(items) + 1) for c in itertools.combinations(items, k) if sum(c) <= space)
        taken = P.best_fill(Counter(items), space)
        assert sum(n * k for n, k in taken.items()) == best
        assert all(k <= items.count(n) for n, k in taken.items())


def test_rests_leave_one_loose_window():
    rnd = random.Random(4)
    for size in (1, 2, 17, 400):
        lengths = [rnd.randrange(1, 2048) for _ in range(size)]
        windows = P.pack_rests(lengths, 2048)
        used = [sum(n for *_, n in w) for w in windows]
        assert sum(used) == sum(lengths) and sum(u < 2048 for u in used) <= 1
        parts = defaultdict(list)
        for w in windows:
            for rest, start, n in w:
                parts[rest].append((start, n))
        for rest, ps in parts.items():
            at = 0
            for start, n in sorted(ps):
                assert start == at and n > 0
                at += n
            assert at == lengths[rest]
