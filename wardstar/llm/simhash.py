"""SimHash near-duplicates: fingerprints, exact radius links, components.

Fingerprints.  A text is lower-cased (A-Z) and cut into words; every run of
``shingle`` words, repeats included, is hashed with XXH64 (seed 42), and a bit
of the fingerprint is set if more than half of the hashes have it.  Fewer
words give one shingle of all of them, no word gives fingerprint zero.

Links.  Two fingerprints that differ in at most ``radius`` of 64 bits agree on
all of at least ``blocks - radius`` of any ``blocks`` bit ranges.  So the
distinct fingerprints meet in cells, one per choice of ranges and value there;
inside a cell all are compared bit-sliced: plane p holds bit p of 64
fingerprints per word, XOR with a query's bit gives 64 differences at once,
and carry-save counters add them up.  A row of the cell is abandoned as soon
as all its counters are beyond the radius.  ``blocks`` follows from the number
of distinct fingerprints and changes only how large cells get, never a link.

Skew.  Equal texts are one fingerprint before any comparison.  A cell above
``CHUNK`` fingerprints is split into chunks by hash, and every pair of chunks
is a cell of its own, so no task holds more than two chunks.  A cell returns a
star per group of linked fingerprints instead of its pairs.

Defined results: null and empty texts have fingerprint zero and are linked to
one another; rows that repeat get equal results; a component without any
non-null doc_id has a null component_id; no rows give no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstar.llm.common import different, grouped, small_batches, staged, table
from wardstar.llm.components import components

SEED = 42
CELL = 16384  # fingerprints expected in a cell, at most
CHUNK = 4096  # fingerprints of a cell compared at once, from either side


# ------------------------------------------------------------------ fingerprints
def shingle_hashes(text: bytes | None, shingle: int) -> list[int]:
    words = text.lower().split() if text else []  # bytes: ASCII letters and white space only
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    begins = (ends - lengths)[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(begins, ends[shingle - 1 :].tolist())]


def majority(hashes: list[int]) -> int:
    """Bits set in more than half of the hashes, in slices that bound memory."""
    counts = np.zeros(64, np.int64)
    values = np.array(hashes, np.uint64)
    for at in range(0, len(values), 1 << 16):
        piece = values[at : at + (1 << 16)]
        counts += np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(values), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, text_hash (XXH64 of the text, to tell rows of one id apart) and fp, the fingerprint as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [majority(shingle_hashes(x.as_py(), shingle)) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(np.array(values, np.uint64).view(np.int64))],
                names=["doc_id", "text_hash", "fp"],
            )

    rows = small_batches(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash long, fp long")


# ------------------------------------------------------------------ bit-sliced comparison
def _beyond(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is above the radius."""
    above, equal = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            above |= equal & counters[k]
            equal &= ~counters[k]
    return above


def linked(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``fps`` that have a partner within the radius, and their partners as bit rows."""
    m = len(fps)
    width = -(-m // 64)
    bits = np.unpackbits(fps.view(np.uint8).reshape(m, 8), axis=1, bitorder="little")
    ones = bits.sum(0, dtype=np.int64)
    padded = np.zeros((64, width * 64), np.uint8)
    padded[:, :m] = bits.T
    planes = np.packbits(padded, axis=1, bitorder="little").view(np.uint64)
    flips = np.where(bits, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0)).T.copy()
    differing = [p for p in range(64) if 0 < ones[p] < m]

    outside = np.zeros((m, width * 64), np.uint8)
    outside[:, m:] = 1
    outside[np.arange(m), np.arange(m)] = 1
    over = np.packbits(outside, axis=1, bitorder="little").view(np.uint64)
    rows = np.arange(m)
    counters = [np.zeros((m, width), np.uint64) for _ in range(max(1, radius.bit_length()))]
    for step in range(0, len(differing), 2):
        pair = differing[step : step + 2]
        first = planes[pair[0]][None, :] ^ flips[pair[0], rows][:, None]
        low = counters[0]
        if len(pair) == 2:  # a full adder takes two planes and the lowest counter
            second = planes[pair[1]][None, :] ^ flips[pair[1], rows][:, None]
            half = low ^ first
            carry = (low & first) | (second & half)
            counters[0] = half ^ second
        else:
            carry = low & first
            counters[0] = low ^ first
        for k in range(1, len(counters)):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if step >= radius and step % 8 == 6 or step + 2 >= len(differing):
            over |= _beyond(counters, radius)
            alive = (over != np.uint64(0xFFFFFFFFFFFFFFFF)).any(1)
            if not alive.any():
                return rows[:0], over[:0]
            if not alive.all():
                rows, over, counters = rows[alive], over[alive], [c[alive] for c in counters]
    return rows, ~over


def cell_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, least member) that connect what is within the radius in one cell."""
    fps = different(fps)
    empty = np.array([], np.uint64)
    if len(fps) < 2:
        return empty, empty
    rows, near = linked(fps, radius)
    if not len(rows):
        return empty, empty
    place = np.full(len(fps), -1)
    place[rows] = np.arange(len(rows))
    open_ = np.ones(len(rows), bool)
    members, roots = [], []
    for seed in range(len(rows)):
        if not open_[seed]:
            continue
        open_[seed] = False
        front = np.array([seed])
        while len(front):
            reach = np.bitwise_or.reduce(near[front], axis=0)
            found = place[np.flatnonzero(np.unpackbits(reach.view(np.uint8), bitorder="little")[: len(fps)])]
            front = found[open_[found]]
            open_[front] = False
            members.append(rows[front])
            roots.append(np.full(len(front), rows[seed]))
    return fps[np.concatenate(members)], fps[np.concatenate(roots)]


# ------------------------------------------------------------------ links over all fingerprints
def bit_ranges(blocks: int) -> list[int]:
    """Masks of ``blocks`` ranges of 64 bits, as even as can be."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(edges)]


def masks_for(distinct: int, radius: int) -> list[int]:
    """What fingerprints of a cell have in common: one mask per choice of ``blocks - radius`` ranges."""
    blocks = radius + 1
    while blocks < 64 and distinct >> (64 // blocks * (blocks - radius)) > CELL:
        blocks += 1
    ranges = bit_ranges(blocks)
    return [sum(c) for c in itertools.combinations(ranges, blocks - radius)]


def links(distinct_fps: DataFrame, radius: int = 4) -> DataFrame:
    """Links ``(u, v)`` that connect exactly the fingerprints (column fp, distinct) a chain of near pairs connects."""
    masks = masks_for(distinct_fps.count(), radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    cells = distinct_fps.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("mask", "value")
    )
    large = cells.groupBy("mask", "value").count().where(F.col("count") > CHUNK)
    large = large.select("mask", "value", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks"))
    chunks = F.coalesce("chunks", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    grid = cells.join(large, ["mask", "value"], "left").select(
        "mask", "value", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other")
    )
    grid = grid.select("mask", "value", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in grouped(batches, ("mask", "value", "a", "b")):
            u, v = cell_links(cell.column("fp").to_numpy().view(np.uint64), radius)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (u, v)], names=["u", "v"])

    dealt = grid.repartition("mask", "value", "a", "b").sortWithinPartitions("mask", "value", "a", "b")
    return dealt.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, text_hash, fp, root (least fingerprint of the component, as a long) and component_id, per row."""
    fps = staged(fingerprints(docs, shingle), "simhash")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct.select("fp"), radius))
    linked_fps = distinct.join(roots, distinct["fp"] == roots["node"]).select("fp", "root", "least")
    groups = linked_fps.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = linked_fps.join(groups, "root").select("fp", "root", "component_id")
    of_fp = distinct.join(of_fp, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id")
    )
    return fps.join(of_fp, "fp")


def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one row of each component: the least doc_id (null last), of its rows one with the least text hash."""
    near = near_duplicates(docs, shingle, radius)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("text_hash"))).alias("least")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_key")
    kept = near.groupBy("root").agg(least).select("least.*").select(key, F.col("text_hash").alias("_hash")).distinct()
    rows = docs.withColumns({"_key": key, "_hash": F.xxhash64("text")}).join(kept, ["_key", "_hash"], "left_semi")
    again = F.row_number().over(Window.partitionBy("_key", "_hash").orderBy("_hash"))  # rows that repeat
    return rows.withColumn("_n", again).where("_n = 1").drop("_key", "_hash", "_n")


def op2_simhash_near_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op2_simhash_near_dedup": op2_simhash_near_dedup}
