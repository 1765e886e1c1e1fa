"""Importance resampling towards a target corpus, over hashed word runs with a head-tail vocabulary.

Features of a text are all runs of one to three consecutive words; a feature's
bucket is the CRC-32 of its bytes modulo ``buckets``.  A bucket's gain compares
its share in the target with its share in all documents; a document's weight
is the sum of its features' gains, and the documents of highest weight plus
Gumbel noise are drawn (sampling without replacement by importance).

The CRC-32 of a joined text follows from those of its parts and their lengths
(``shifted``), so features are never written out.  The head is broadcast: CRC
states of frequent words, and states and buckets of frequent pairs.  It is
bounded by ``HEAD`` entries each and only saves work; a word, pair or triple
outside it takes its CRC directly, which gives the same number, so that the
bucket totals are exact whatever the head holds.

Buckets of every feature are written once (two bytes each) and read for the
totals and again for the weights.  The only things brought to the driver are
the head, one count and one gain per bucket.

Defined results: null, empty and wordless texts have no features and weight 0;
a null doc_id draws its noise from the empty text and stands last among ties;
rows that repeat are documents of their own (which of them is drawn at the
last rank is open); without documents there are no rows, without a target all
buckets count as unseen there.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstar.functions.keys import dense_keys
from wardstar.llm.common import staged, table
from wardstar.llm.words import Words, pieces, words
from wardstar.session import checkpoint_dir

BUCKETS = 10000
SHARE = 5  # documents drawn, in a hundred
LEAST_WORDS = 20
SEED = 42
HEAD = 1 << 16  # frequent words, and frequent pairs, at most
OFTEN = 16  # times in a piece, for a word or pair to be counted for the head
_SLOTS = 1 << 20
_NONE = 0xFFFF  # no feature here

#: Bytes of a text as its words need them: A-Z in lower case, other ASCII but letters and digits a space.
_BYTES = np.array([
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
], np.uint8)


# ------------------------------------------------------------------ CRC of joined texts
def _shift_tables(most: int) -> np.ndarray:
    """For 0 to ``most`` bytes: what each byte of a CRC becomes when so many bytes follow."""
    out = np.zeros((most + 1, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> np.uint32(1)) ^ np.uint32(0xEDB88320), one >> np.uint32(1))
    for n in range(most):
        out[n + 1] = (out[n] >> np.uint32(8)) ^ one[out[n] & np.uint32(255)]
    return out


_LONGEST = 128
_TABLES = _shift_tables(_LONGEST).reshape(-1)


def shifted(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The share of ``crc`` in the CRC of a text that goes on for ``size`` bytes: CRC(a + b) = shifted(CRC(a), len(b)) ^ CRC(b)."""
    out = crc.copy()
    left = size
    while True:
        at = np.minimum(left, _LONGEST) * 1024
        out = (
            _TABLES[at + (out & 255)] ^ _TABLES[at + 256 + (out >> 8 & 255)]
            ^ _TABLES[at + 512 + (out >> 16 & 255)] ^ _TABLES[at + 768 + (out >> 24)]
        )
        left = np.maximum(left - _LONGEST, 0)
        if not left.any():
            return out


# ------------------------------------------------------------------ head
def feature_words(text: pa.Array) -> Words:
    """Words of the texts of a piece: runs of ASCII letters (in lower case), digits and non-ASCII characters."""
    text = pa.concat_arrays([text.cast(pa.string()).fill_null("")])
    _, offsets, data = text.buffers()
    ends = np.frombuffer(offsets, np.int32)[text.offset : text.offset + len(text) + 1]
    plain = _BYTES[np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]] if data is not None else np.zeros(0, np.uint8)
    return words(pa.StringArray.from_buffers(len(text), pa.py_buffer(ends - ends[0]), pa.py_buffer(plain)))


def _pair_keys(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Places of words that have a next one in their text, and codes of both as one number."""
    owner = w.owner
    at = np.flatnonzero(owner[1:] == owner[:-1])
    return at, w.codes[at] << 32 | w.codes[at + 1]


def head(docs: DataFrame, size: int = HEAD, often: int = OFTEN) -> tuple[list[str], list[str]]:
    """The most frequent words and pairs (joined by a space) among those that are frequent in some piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            w = feature_words(piece.column("text"))
            counts = np.bincount(w.codes, minlength=len(w.names))
            some = np.flatnonzero(counts >= often)
            keys, times = np.unique(_pair_keys(w)[1], return_counts=True)
            keys, times = keys[times >= often], times[times >= often]
            names = w.names.take(pa.array(some)).to_pylist()
            pairs = zip(w.names.take(pa.array(keys >> 32)).to_pylist(), w.names.take(pa.array(keys & 0xFFFFFFFF)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names + [f"{a} {b}" for a, b in pairs], pa.string()),
                    pa.array(np.concatenate([counts[some], times]).astype(np.int64)),
                ],
                names=["feature", "n"],
            )

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "feature string, n long")
    found = found.groupBy("feature").agg(F.sum("n").alias("n"))
    found = staged(found, "head")
    pair = F.col("feature").contains(" ")
    best = lambda df: [r.feature for r in df.orderBy(F.desc("n"), "feature").limit(size).collect()]
    return best(found.where(~pair)), best(found.where(pair))


class Head:
    """States of frequent words by name, of frequent pairs by the places of their words."""

    def __init__(self, names: list[str], pairs: list[str]):
        self.place = {n: i for i, n in enumerate(names)}
        self.states = word_states(names)
        split = [p.split(" ") for p in pairs]
        known = [(self.place[a], self.place[b], p) for (a, b), p in zip(split, pairs) if a in self.place and b in self.place]
        self.key = np.full(_SLOTS, -1, np.int64)
        self.crc = np.zeros(_SLOTS, np.uint32)
        for a, b, text in reversed(known):  # the most frequent one keeps a slot that two pairs fall into
            at = int(self.slot(np.array([a << 32 | b]))[0])
            self.key[at], self.crc[at] = a << 32 | b, zlib.crc32(text.encode())
        self.bucket = (self.crc % np.uint32(BUCKETS)).astype(np.uint16)

    @staticmethod
    def slot(keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - _SLOTS.bit_length() + 1)).astype(np.int64)


def word_states(names: list[str]) -> np.ndarray:
    """CRC of each word, CRC of it after a space, its bytes with that space."""
    out = np.zeros((3, len(names)), np.int64)
    crc = zlib.crc32
    for i, n in enumerate(names):
        b = n.encode()
        out[:, i] = crc(b), crc(b, 0xE96CCF45), len(b) + 1  # 0xE96CCF45: CRC-32 of one space
    return out


def buckets_of(w: Words, known: Head) -> np.ndarray:
    """Rows (word, pair, triple that begin here) for every word; ``_NONE`` where the text ends before."""
    names = w.names.to_pylist()
    places = np.fromiter((known.place.get(n, -1) for n in names), np.int64, len(names))
    states = np.zeros((3, len(names)), np.int64)
    states[:, places >= 0] = known.states[:, places[places >= 0]]
    tail = np.flatnonzero(places < 0)
    states[:, tail] = word_states([names[i] for i in tail.tolist()])

    crc, after, size = states[0].astype(np.uint32), states[1].astype(np.uint32), states[2]
    out = np.full((len(w.codes), 3), _NONE, np.uint16)
    out[:, 0] = (crc % np.uint32(BUCKETS)).astype(np.uint16)[w.codes]
    at, _ = _pair_keys(w)
    first, second = w.codes[at], w.codes[at + 1]
    keys = np.where((places[first] < 0) | (places[second] < 0), -2, places[first] << 32 | places[second])
    slot = known.slot(keys)
    frequent = known.key[slot] == keys
    rest = ~frequent
    pair_crc = known.crc[slot]
    pair_crc[rest] = shifted(crc[first[rest]], size[second[rest]]) ^ after[second[rest]]
    pair_bucket = known.bucket[slot]
    pair_bucket[rest] = pair_crc[rest] % np.uint32(BUCKETS)
    out[at, 1] = pair_bucket

    follows = np.flatnonzero(np.diff(at) == 1)  # pairs whose second word begins a pair too
    third = second[follows + 1]
    out[at[follows], 2] = (shifted(pair_crc[follows], size[third]) ^ after[third]) % np.uint32(BUCKETS)
    return out


# ------------------------------------------------------------------ operator
def features(docs: DataFrame, known: Head, id_type: str) -> DataFrame:
    """doc_id, n_words, n_features and the buckets of all features (two bytes each) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            w = feature_words(piece.column("text"))
            n = np.diff(w.begins)
            found = np.ascontiguousarray(buckets_of(w, known))
            packed = pa.Array.from_buffers(
                pa.binary(), len(n), [None, pa.py_buffer((w.begins * 6).astype(np.int32)), pa.py_buffer(found)]
            )
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(n), pa.array(n + np.maximum(n - 1, 0) + np.maximum(n - 2, 0)), packed],
                names=["doc_id", "n_words", "n_features", "buckets"],
            )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, n_words long, n_features long, buckets binary")


def _numbers(column: pa.Array) -> np.ndarray:
    flat = pa.concat_arrays([column])
    _, offsets, data = flat.buffers()
    ends = np.frombuffer(offsets, np.int32)[flat.offset : flat.offset + len(flat) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(np.uint16) if data is not None else np.zeros(0, np.uint16)


def totals(found: DataFrame) -> DataFrame:
    """(bucket, n) over all features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(_NONE + 1, np.int64)
        for batch in batches:
            sums += np.bincount(_numbers(batch.column("buckets")), minlength=_NONE + 1)
        some = np.flatnonzero(sums[:_NONE])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], names=["bucket", "n"])

    return found.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame) -> np.ndarray:
    """Gain of each bucket; ``source`` and ``target`` as ``totals`` gives them (one row per bucket at most)."""
    spark = source.sparkSession
    rows = (
        spark.range(BUCKETS).select(F.col("id").alias("bucket"))
        .join(source.select("bucket", F.col("n").alias("s")), "bucket", "left")
        .join(target.select("bucket", F.col("n").alias("t")), "bucket", "left")
        .select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t"))
    )
    of = rows.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    wide = lambda c, more: F.col(c).cast("double") + F.lit(float(more))
    share = (wide("t", 1) * wide("all_s", BUCKETS)) / (wide("s", 1) * wide("all_t", BUCKETS))
    rows = rows.join(F.broadcast(of)).select("bucket", F.floor(1000 * F.log(share)).cast("long").alias("gain"))  # of: one row
    out = np.zeros(_NONE + 1, np.int64)
    for r in rows.collect():
        out[r.bucket] = r.gain
    return out


def weights(found: DataFrame, gain: np.ndarray, id_type: str) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.concatenate([[0], np.cumsum(batch.column("n_words").to_numpy() * 3)])
            sums = np.concatenate([[0], np.cumsum(gain[_numbers(batch.column("buckets"))])])[ends]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "n_words", "n_features")] + [pa.array(np.diff(sums))],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return found.mapInArrow(run, f"doc_id {id_type}, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """1000 times a Gumbel number drawn by the id, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, least: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of ``docs(doc_id, text)``; the drawn ones have a rank.

    ``target(text)`` is the corpus to resemble; ``share`` of a hundred documents with ``least`` words are drawn.
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    known = Head(*head(docs))
    path = f"{checkpoint_dir(spark)}/features-{uuid.uuid4().hex}"
    found = features(docs, known, id_type)
    found.write.option("compression", "zstd").parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    of_target = features(target.select(F.lit(0).alias("doc_id"), "text"), known, "int")
    gain = gains(totals(found), totals(of_target))
    scored = weights(found, gain, id_type).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    # a number for each row keeps rows that repeat apart when they are dealt out by rank
    scored = staged(scored.withColumn("_row", F.monotonically_increasing_id()), "scores")
    enough = F.col("n_words") >= least
    drawn = share * scored.where(enough).count() // 100
    ranked = dense_keys(scored.where(enough), [F.desc("score"), F.asc_nulls_last("doc_id"), F.col("_row")], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))).drop("_row")


def op12_importance_resampling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    target = table(spark, sf_dir, "benchmark").select("text")
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {"op12_importance_resampling": op12_importance_resampling}
