"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms: every distinct run of letters, lower-cased,
and the run's first four, five and six letters, hashed into ``DIMS`` slots.
The score is the logistic of a bias, a weight per term and, for each pair of
terms, the product of their factor vectors, so that two terms which are
harmless alone can weigh together.  The pair sum costs as much as the terms:
half of (sum of vectors squared minus sum of squared vectors), per factor.

The machine is fitted on the driver by Adam on a sample of labelled documents
bounded by ``SAMPLE`` (the documents with the least hash of their id); the
``TERMS`` terms with the largest chi-square against the label, ``CHI`` at least,
get weights.  Executors cut texts to terms, so
the driver only gets term numbers.  Every document is scored, whole.

Defined results: null and empty texts have no term and get the bias alone; a
null doc_id is never learned from and not held out; a document with several
labels counts as toxic if one says so, null labels are none; without labels of
both kinds the score is the share of toxic labels (none: 0); no rows give no
rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import different, fold, small_batches, table

DIMS = 1 << 18
SAMPLE = 12_000  # labelled documents fitted on, at most
TERMS = 1 << 13  # terms that get weights, at most
CHI = 12.0
FACTORS = 4
EPOCHS = 60
THRESHOLD = 0.3
_LETTERS = re.compile(r"[^\W\d_]+")
_CACHE = 1 << 17  # words whose terms a task keeps


class Terms:
    """Term numbers of texts, with a bounded cache of words."""

    def __init__(self):
        self.cache: dict[str, tuple[int, ...]] = {}

    def of_word(self, word: str) -> tuple[int, ...]:
        parts = [word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) >= n)]
        return tuple(zlib.crc32(p.encode()) % DIMS for p in parts)

    def __call__(self, text: str | None) -> np.ndarray:
        cache, found = self.cache, []
        for word in set(_LETTERS.findall(text.lower())) if text else ():
            terms = cache.get(word)
            if terms is None:
                if len(cache) >= _CACHE:
                    cache.clear()
                terms = cache[word] = self.of_word(word)
            found.extend(terms)
        return different(np.array(found, np.int32))


class Machine:
    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.factors = bias, weights, factors

    def margins(self, terms: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Scores before the logistic; ``begins`` of each document's terms, with the total at the end."""
        w, v = self.weights[terms], self.factors[terms]
        sums = lambda x: np.diff(np.concatenate([np.zeros((1, *x.shape[1:])), np.cumsum(x, 0, dtype=np.float64)])[begins], axis=0)
        return self.bias + sums(w) + 0.5 * (sums(v) ** 2 - sums(v * v)).sum(1)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def associated(docs: list[np.ndarray], labels: np.ndarray, most: int = TERMS) -> np.ndarray:
    """The terms whose presence goes most with the label, by chi-square, in order of number."""
    n, share = len(docs), labels.mean()
    there = np.bincount(np.concatenate(docs), minlength=DIMS)
    toxic = np.bincount(np.concatenate(docs), np.repeat(labels, [len(d) for d in docs]), DIMS)
    spread = share * (1 - share) * there * (n - there) / n
    chi = np.where(spread > 0, (toxic - there * share) ** 2 / np.maximum(spread, 1e-9), 0.0)
    best = np.argsort(-chi, kind="stable")[:most]
    return np.sort(best[chi[best] >= CHI])


def fit(docs: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, factors: int = FACTORS, seed: int = 7) -> Machine:
    """Logistic loss, Adam over mini-batches, shrinkage of weights and factors."""
    weights, vectors = np.zeros(DIMS, np.float32), np.zeros((DIMS, factors), np.float32)
    share = float(labels.mean()) if len(labels) else 0.0
    if not 0 < share < 1:
        return Machine(40.0 if share == 1 else -40.0, weights, vectors)
    kept = associated(docs, labels)
    place = np.full(DIMS, -1, np.int32)
    place[kept] = np.arange(len(kept))
    docs = [p[p >= 0] for p in (place[d] for d in docs)]
    rnd = np.random.default_rng(seed)
    bias = np.log(share / (1 - share))
    w, v = np.zeros(len(kept)), rnd.normal(0, 0.01, (len(kept), factors))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, v, np.zeros(1))]
    rates, decay, step = (0.05, 0.02, 0.05), (1e-4, 1e-3), 0

    def adam(x: np.ndarray, gradient: np.ndarray, which: int) -> None:
        m, s = moments[which]
        m += 0.1 * (gradient - m)
        s += 0.001 * (gradient * gradient - s)
        x -= rates[which] * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-4)

    b = np.array([bias])
    for _ in range(epochs):
        order = rnd.permutation(len(docs))
        for at in range(0, len(order), 256):
            some = order[at : at + 256]
            terms = np.concatenate([docs[i] for i in some])
            row = np.repeat(np.arange(len(some)), [len(docs[i]) for i in some])
            vt = v[terms]
            sums = np.stack([np.bincount(row, vt[:, f], len(some)) for f in range(factors)], 1)
            squares = np.bincount(row, (vt * vt).sum(1), len(some))
            margin = b[0] + np.bincount(row, w[terms], len(some)) + 0.5 * ((sums**2).sum(1) - squares)
            error = (logistic(margin) - labels[some]) / len(some)
            step += 1
            of_term = error[row]
            gw = np.bincount(terms, of_term, len(kept)) + decay[0] * np.sign(w)
            pull = of_term[:, None] * (sums[row] - vt)
            gv = np.stack([np.bincount(terms, pull[:, f], len(kept)) for f in range(factors)], 1) + decay[1] * v
            adam(w, gw, 0)
            adam(v, gv, 1)
            adam(b, np.array([error.sum()]), 2)
    weights[kept], vectors[kept] = w, v
    return Machine(float(b[0]), weights, vectors)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Fit on at most ``sample`` of the labelled documents (doc_id, text); labels: doc_id, toxic."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = small_batches(docs).select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            found = pa.array([terms(x) for x in batch.column("text").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("toxic").cast(pa.int32()), found], names=["doc_id", "toxic", "terms"])

    got = rows.mapInArrow(run, "doc_id long, toxic int, terms array<int>").toArrow().sort_by("doc_id")
    return fit([x.values.to_numpy() for x in got.column("terms")], got.column("toxic").to_numpy().astype(np.float64))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` with a column score, 0 to 1."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((machine.bias, machine.weights, machine.factors))
    keep = [c for c in docs.columns if c != "score"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, model = Terms(), Machine(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                found = [terms(x) for x in part.column("text").to_pylist()]
                begins = np.cumsum([0, *map(len, found)])
                scores = logistic(model.margins(np.concatenate(found), begins))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(scores)], names=[*keep, "score"])

    return small_batches(docs).select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, f"{schema}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, held_out) -> DataFrame:
    """``docs`` with held_out, score and predicted; learned from labelled rows that are not held out."""
    rows = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    machine = train(rows.where(~F.col("held_out")), labels)
    return score(rows, machine).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    labels = labels.where(~F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)))
    return toxicity(docs, labels, fold(F.col("doc_id"), 4) == 2).select("doc_id", "held_out", "score", "predicted")


QUERIES = {"op7_toxicity": op7_toxicity}
