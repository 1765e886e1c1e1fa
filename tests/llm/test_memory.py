"""What a task's Python holds at once: the batches it gets, the words labelled together, the models of earlier stages."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from wardstar.llm import common, langid, packing, simhash, toxicity
from wardstar.llm.crf import Crf

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def operators(docs):
    machine = toxicity.Machine(0.0, np.zeros(toxicity.DIMS, np.float32), np.zeros((toxicity.DIMS, 1), np.float32))
    return {
        "language": lambda: langid.identify(docs, [], None),
        "toxicity": lambda: toxicity.score(docs, machine),
        "simhash": lambda: simhash.fingerprints(docs),
        "packing": lambda: packing.encoded_pieces(docs, packing.vocabulary_path()),
    }


@pytest.mark.parametrize("name", ["language", "toxicity", "simhash", "packing"])
def test_python_gets_few_bytes_at_once(spark, name):
    before = spark.conf.get(BATCH)
    docs = spark.range(0, 1500, 1, 1).selectExpr("id as doc_id", "repeat('some words ', 1000) as text")
    try:
        operators(docs)[name]()

        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

        got = docs.mapInArrow(run, "n long, size long").collect()
    finally:
        spark.conf.set(BATCH, before)
    assert sum(r.n for r in got) == 1500
    assert max(r.size for r in got) <= common.BATCH_BYTES + 20_000


def test_few_words_are_labelled_at_once():
    model = Crf(np.zeros((langid.DIMS, 2)), np.zeros((2, 2)), np.zeros(2))
    labeller = langid.Labeller(["aa", "bb"], model)
    texts = [" ".join(f"w{chr(97 + i % 26)}{'abcdefghij'[j % 10]}" for j in range(600)) + "." for i in range(1024)]
    tracemalloc.start()
    langs, scores = labeller.texts(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert langs == ["aa"] * 1024 and scores == pytest.approx([0.5] * 1024)
    assert peak < 40e6


def test_a_worker_holds_one_model():
    made = []
    first = common.worker_held("a", lambda: made.append("a") or object())
    assert common.worker_held("a", object) is first
    second = common.worker_held("b", lambda: made.append("b") or object())
    assert common.worker_held("b", object) is second and list(common._HELD) == ["b"]
    assert common.worker_held("a", object) is not first and made == ["a", "b"]
