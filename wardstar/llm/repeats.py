"""Substring dedup: repeated-phrase automata over blocks of documents.

A window is ``window`` consecutive words of one document.  Every word covered
by a window whose word sequence also starts in a document with a smaller
doc_id is removed; windows are judged on the input.

1. Documents are packed into blocks of at most ``PIECE`` bytes (a longer text
   is a block of its own); equal texts of a block are one entry with all their
   ids.  Blocks are written once and are what is moved later.
2. Every block deals its distinct windows, as 64-bit hashes with the least
   doc_id, to ranges of hashes.  There each hash that several blocks hold gets
   an origin, the block with the least id, and the origin is told which other
   blocks hold it.
3. The origin turns the windows that one block asks for into passages (the
   longest stretches of consecutive ones) and sends it their words; windows
   that recur inside a block become passages for the block itself.
4. Each block compiles phrases, the parts of the passages it got that its texts
   can hold whole, into an Aho-Corasick automaton and streams all its texts
   through it.  Every occurrence is found and confirmed word by word there; the
   hashes only propose.  A text that is there under several ids is a passage,
   too, from the least of them.

So automata are sharded by the documents that need them: every document is
streamed once, an automaton holds no passage that its block lacks, and work
grows with the text.  Skew: equal windows meet once per block, not per
document; a block that very many others ask is copied, each copy answering
some of them (``ASKED`` requests each).  Two different windows with one hash
(one pair expected in 5 billion windows) can at most hide a repeat.

Defined results: ids are integers (cast to long); a null doc_id counts as
larger than every other, and documents without ids don't judge each other;
equal ids don't judge each other either; a null text has no words; rows that
repeat each give a row; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import grouped, staged, table
from wardstar.llm.words import Words, joined, pieces, words

WINDOW = 13
RANGE = 9 << 20  # bytes of text whose windows a range of hashes gets
ASKED = 1 << 22  # requests that one copy of a block answers
_NO_ID = (1 << 63) - 1  # stands for null among least ids


# ------------------------------------------------------------------ arrays as binary columns
def packed(values: np.ndarray) -> bytes:
    """64-bit numbers byte by byte (all lowest bytes first), compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(body: bytes, kind: type = np.uint64) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(body), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _frame(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _opened(body: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(body) as stream:
        return stream.read_next_batch()


# ------------------------------------------------------------------ 1: blocks
def blocks(docs: DataFrame) -> DataFrame:
    """block, bytes and body (entries text and ids, by their least id) of blocks that hold all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for piece in pieces(batches):
            texts = pc.fill_null(piece.column("text"), "").dictionary_encode()
            ids: list[list] = [[] for _ in range(len(texts.dictionary))]
            for place, doc_id in zip(texts.indices.to_pylist(), piece.column("doc_id").to_pylist()):
                ids[place].append(doc_id)
            for held in ids:
                held.sort(key=_order)
            order = sorted(range(len(ids)), key=lambda i: _order(ids[i][0]))
            body = pa.RecordBatch.from_arrays(
                [texts.dictionary.take(pa.array(order, pa.int64())), pa.array([ids[i] for i in order], pa.list_(pa.int64()))],
                names=["text", "ids"],
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([body.column("text").nbytes]), pa.array([_frame(body)], pa.binary())],
                names=["block", "bytes", "body"],
            )
            block += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "block long, bytes long, body binary")


def _order(doc_id: int | None) -> int:
    return 1 << 63 if doc_id is None else doc_id


def least_ids(entries: pa.RecordBatch) -> np.ndarray:
    """The least id of each entry; ``_NO_ID`` without any."""
    return pc.fill_null(pc.list_element(entries.column("ids"), 0), _NO_ID).to_numpy()


# ------------------------------------------------------------------ 2: windows
def window_hashes(w: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of words where a window begins, and the windows' hashes."""
    digest = xxhash.xxh64_intdigest
    of_name = np.fromiter((digest(n) for n in w.names.to_pylist()), np.uint64, len(w.names))
    last = np.repeat(w.begins[1:], np.diff(w.begins)) - window
    at = np.flatnonzero(np.arange(len(w.codes)) <= last)
    each = of_name[w.codes]
    total = np.zeros(max(0, len(each) - window + 1), np.uint64)
    factor = 1
    for k in range(window):
        factor = factor * 0x9E3779B97F4A7C15 + 0xBF58476D1CE4E5B9 | 1
        total += each[k : k + len(total)] * np.uint64(factor & (1 << 64) - 1)
    return at, total[at]


def firsts(w: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, the word where each first begins; all places by hash, and where each hash begins there."""
    at, hashes = window_hashes(w, window)
    order = np.argsort(hashes, kind="stable")
    hashes, at = hashes[order], at[order]
    new = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)])
    return hashes[new], at[new], at, new


def window_rows(held: DataFrame, ranges_log2: int, window: int) -> DataFrame:
    """bucket, block, hashes and the least id for each: distinct windows of each block, by ranges of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, body in zip(batch.column("block").to_pylist(), batch.column("body")):
                entries = _opened(body.as_buffer())
                w = words(entries.column("text"))
                hashes, at, _, _ = firsts(w, window)
                ids = least_ids(entries)[np.searchsorted(w.begins, at, "right") - 1]
                bucket = (hashes >> np.uint64(64 - ranges_log2)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
                parts = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
                if parts:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(bucket[cuts[:-1]]),
                            pa.array([block] * len(parts)),
                            pa.array([packed(hashes[a:b]) for a, b in parts], pa.binary()),
                            pa.array([packed(ids[a:b]) for a, b in parts], pa.binary()),
                        ],
                        names=["bucket", "block", "hashes", "ids"],
                    )

    return held.select("block", "body").mapInArrow(run, "bucket long, block long, hashes binary, ids binary")


def requests(found: DataFrame) -> DataFrame:
    """block (the origin), n, hashes and dests: the windows that other blocks hold, too, and which ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ("bucket",)):
            hashes = [unpacked(x.as_py()) for x in group.column("hashes")]
            ids = np.concatenate([unpacked(x.as_py(), np.int64) for x in group.column("ids")])
            owner = np.repeat(group.column("block").to_numpy(), [len(x) for x in hashes])
            hashes = np.concatenate(hashes)
            order = np.argsort(hashes, kind="stable")
            sorted_ = hashes[order]
            same = sorted_[1:] == sorted_[:-1]
            order = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]  # in several blocks
            order = order[np.lexsort((owner[order], ids[order], hashes[order]))]
            h, i, b = hashes[order], ids[order], owner[order]
            new = np.concatenate([[True], h[1:] != h[:-1]])[: len(h)]
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            later = np.flatnonzero(i > i[first])
            origin, h, dest = b[first[later]], h[later], b[later]
            by = np.argsort(origin, kind="stable")
            origin, h, dest = origin[by], h[by], dest[by]
            cuts = np.flatnonzero(np.diff(origin, prepend=-1, append=-1))
            parts = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(origin[cuts[:-1]]),
                        pa.array(np.diff(cuts)),
                        pa.array([packed(h[x:y]) for x, y in parts], pa.binary()),
                        pa.array([packed(dest[x:y]) for x, y in parts], pa.binary()),
                    ],
                    names=["block", "n", "hashes", "dests"],
                )

    dealt = found.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "block long, n long, hashes binary, dests binary")


# ------------------------------------------------------------------ 3: passages
def _split(asked: DataFrame) -> DataFrame:
    """Requests to blocks with several copies, dealt to the copies by who asks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                hashes, dests = unpacked(r["hashes"]), unpacked(r["dests"], np.int64)
                copy = (dests.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % r["copies"]
                for c in np.unique(copy).tolist():
                    mine = copy == c
                    yield pa.RecordBatch.from_pylist([
                        {"block": r["block"], "copy": c, "kind": 1, "a": packed(hashes[mine]), "b": packed(dests[mine])}
                    ], schema=_MOVED)

    return asked.mapInArrow(run, "block long, copy long, kind int, a binary, b binary")


_MOVED = pa.schema([("block", pa.int64()), ("copy", pa.int64()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])


def passages(held: DataFrame, asked: DataFrame, window: int) -> DataFrame:
    """block (that asked), kind 0 and body: passages (words joined by a space) and the ids they come from."""
    copies = asked.groupBy("block").agg(F.ceil(F.sum("n") / ASKED).alias("copies")).where("copies > 1")
    dealt = asked.join(copies, "block", "left")
    none = F.lit(None).cast("binary")
    one = dealt.where("copies is null").select(
        "block", F.lit(0).cast("long").alias("copy"), F.lit(1).alias("kind"), F.col("hashes").alias("a"), F.col("dests").alias("b"))
    many = _split(dealt.where("copies is not null").select("block", "copies", "hashes", "dests"))
    texts = held.join(copies, "block", "left").select(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("copies", F.lit(1)) - 1)).alias("copy"),
        F.lit(0).alias("kind"), F.col("body").alias("a"), none.alias("b"))
    moved = texts.unionByName(one).unionByName(many)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ("block", "copy")):
            block, copy = group.column("block")[0].as_py(), group.column("copy")[0].as_py()
            parts = list(zip(group.column("a"), group.column("b")))
            entries = _opened(parts[0][0].as_buffer())
            w = words(entries.column("text"))
            hashes, at, places, new = firsts(w, window)
            ids = least_ids(entries)
            want, dests = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for a, b in parts[1:]:
                want.append(at[np.searchsorted(hashes, unpacked(a.as_py()))])
                dests.append(unpacked(b.as_py(), np.int64))
            if copy == 0 and len(hashes):  # windows that recur in the block, under a larger id than first
                of = ids[np.searchsorted(w.begins, places, "right") - 1]
                again = at[np.maximum.reduceat(of, new) > of[new]]
                want.append(again)
                dests.append(np.full(len(again), block))
            yield from _passages(w, ids, np.concatenate(want), np.concatenate(dests), window)

    dealt = moved.repartition("block", "copy").sortWithinPartitions("block", "copy", "kind")
    return dealt.mapInArrow(run, "block long, kind int, body binary")


def _passages(w: Words, ids: np.ndarray, want: np.ndarray, dests: np.ndarray, window: int) -> Iterator[pa.RecordBatch]:
    if not len(want):
        return
    order = np.lexsort((want, dests))
    want, dests = want[order], dests[order]
    cut = np.concatenate([[True], (want[1:] != want[:-1] + 1) | (dests[1:] != dests[:-1])])
    begin = np.flatnonzero(cut)
    end = np.concatenate([begin[1:], [len(want)]]) - 1
    from_, size = want[begin], want[end] - want[begin] + window
    dest = dests[begin]
    origin = ids[np.searchsorted(w.begins, from_, "right") - 1]
    edges = np.flatnonzero(np.diff(dest, prepend=-1, append=-1))
    for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
        begins = np.concatenate([[0], np.cumsum(size[x:y])])
        codes = w.codes[np.repeat(from_[x:y] - begins[:-1], size[x:y]) + np.arange(begins[-1])]
        body = pa.RecordBatch.from_arrays([pa.array(origin[x:y]), joined(w.names, codes, begins)], names=["id", "text"])
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(dest[x])]), pa.array([0], pa.int32()), pa.array([_frame(body)], pa.binary())],
            names=["block", "kind", "body"],
        )


# ------------------------------------------------------------------ 4: automata
def _spelled(numbers: np.ndarray, base: int) -> str:
    """Each number as three characters, of another range for each place (so that words match at words only)."""
    digits = np.stack([numbers // (base * base), numbers // base % base, numbers % base], axis=1)
    return (digits + np.array([0x100, 0x600, 0xB00])).astype("<u4").tobytes().decode("utf-32-le")


class Phrases:
    """Aho-Corasick automaton over phrases; ``found`` gives (begin, end, origin id) in words of a text.

    Phrase i is ``w.codes[begins[i]:begins[i] + sizes[i]]`` and comes from ``ids[i]``.
    """

    def __init__(self, w: Words, begins: np.ndarray, sizes: np.ndarray, ids: np.ndarray):
        self.number = {n: i for i, n in enumerate(w.names.to_pylist(), 1)}
        self.base = 2
        while self.base**3 <= len(self.number):
            self.base += 1
        spelled = _spelled(w.codes + 1, self.base)
        least: dict[str, int] = {}
        for a, size, doc_id in zip(begins.tolist(), sizes.tolist(), ids.tolist()):
            text = spelled[3 * a : 3 * (a + size)]
            least[text] = min(doc_id, least.get(text, doc_id))
        self.phrases = [(len(text) // 3, doc_id) for text, doc_id in least.items()]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, text in enumerate(least):
            self.automaton.add_word(text, i)
        self.automaton.make_automaton()

    def spelled(self, w: Words) -> str:
        """All texts of a piece; words that are in no phrase are number 0."""
        numbers = np.fromiter((self.number.get(n, 0) for n in w.names.to_pylist()), np.int64, len(w.names))
        return _spelled(numbers[w.codes], self.base)

    def found(self, text: str) -> list[tuple[int, int, int]]:
        out = []
        for end, i in self.automaton.iter(text):
            size, doc_id = self.phrases[i]
            out.append((end // 3 + 1 - size, end // 3 + 1, doc_id))
        return out


def phrases_for(w: Words, largest: np.ndarray, sent: dict[str, int], window: int) -> Phrases | None:
    """The parts of the passages ``sent`` (with their origins) that texts of ``w`` can hold whole: by hash, as long as can be.

    ``largest`` is the largest id of each text; a passage counts for texts with a larger one only.
    """
    p = words(pa.array(list(sent), pa.string()))
    at, hashes = window_hashes(p, window)
    origin = np.array(list(sent.values()), np.int64)[np.searchsorted(p.begins, at, "right") - 1]
    order = np.lexsort((at, origin, hashes))
    at, hashes, origin = at[order], hashes[order], origin[order]
    new = np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)]
    at, hashes, origin = at[new], hashes[new], origin[new]
    here, own = window_hashes(w, window)
    if not len(hashes) or not len(own):
        return None
    place = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
    hit = hashes[place] == own
    hit &= origin[place] < largest[np.searchsorted(w.begins, here, "right") - 1]
    here, there, ids = here[hit], at[place[hit]], origin[place[hit]]
    if not len(here):
        return None
    cut = np.concatenate([[True], (here[1:] != here[:-1] + 1) | (there[1:] != there[:-1] + 1) | (ids[1:] != ids[:-1])])
    begin = np.flatnonzero(cut)
    size = np.diff(np.concatenate([begin, [len(here)]])) + window - 1
    _, once = np.unique(np.stack([there[begin], size]), axis=1, return_index=True)
    return Phrases(p, there[begin][once], size[once], ids[begin][once])


def cleaned(entries: pa.RecordBatch, sent: dict[str, int], window: int) -> Iterator[tuple[int | None, int, int, str]]:
    """doc_id, n_words, n_removed and kept text of every document of a block; ``sent``: passages and their origins."""
    w = words(entries.column("text"))
    whole = joined(w.names, w.codes, w.begins).to_pylist()
    ids = entries.column("ids").to_pylist()
    for text, held, n in zip(whole, ids, np.diff(w.begins).tolist()):
        if n >= window and held[0] is not None and held[-1] != held[0]:
            sent[text] = min(held[0], sent.get(text, held[0]))
    largest = np.array([min(_order(held[-1]), _NO_ID) for held in ids], np.int64)
    phrases = phrases_for(w, largest, sent, window) if sent else None
    spelled = phrases.spelled(w) if phrases else ""
    for text, held, a, b in zip(whole, ids, w.begins[:-1].tolist(), w.begins[1:].tolist()):
        hits = phrases.found(spelled[3 * a : 3 * b]) if phrases and b - a >= window else []
        origins = sorted({o for _, _, o in hits})
        last = None
        for doc_id in held:
            before = bisect_left(origins, _order(doc_id))  # origins with a smaller id
            if not before:
                yield doc_id, b - a, 0, text
                continue
            if last is None or last[0] != before:
                gone = np.zeros(b - a + 1, np.int64)
                some = [(x, y) for x, y, o in hits if o <= origins[before - 1]]
                np.add.at(gone, [x for x, _ in some], 1)
                np.add.at(gone, [y for _, y in some], -1)
                stays = np.cumsum(gone)[:-1] == 0
                codes = w.codes[a:b][stays]
                last = before, int((~stays).sum()), " ".join(w.names.take(pa.array(codes)).to_pylist())
            yield doc_id, b - a, last[1], last[2]


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept (words joined by one space) of every row of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    held = staged(blocks(docs), "blocks")
    size = held.agg(F.sum("bytes")).first()[0] or 0
    ranges = max(2, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // RANGE).bit_length()
    asked = staged(requests(window_rows(held, ranges, window)), "requests")
    got = passages(held.select("block", "body"), asked, window)
    moved = got.unionByName(held.select("block", F.lit(1).alias("kind"), "body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ("block",)):
            patterns: dict[str, int] = {}
            for body in group.column("body")[:-1] if len(group) > 1 else ():
                sent = _opened(body.as_buffer())
                for doc_id, text in zip(sent.column("id").to_pylist(), sent.column("text").to_pylist()):
                    patterns[text] = min(doc_id, patterns.get(text, doc_id))
            entries = _opened(group.column("body")[-1].as_buffer())
            columns = list(zip(*cleaned(entries, patterns, window)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "n_words", "n_removed", "kept"]
            )

    dealt = moved.repartition("block").sortWithinPartitions("block", "kind")
    return dealt.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def op11_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op11_substring_dedup": op11_substring_dedup}

ORACLES = {
    "op11_substring_dedup": r"""
with cut as (
  select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents),
wins as (
  select doc_id, i, array_to_string(w[i:i + 12], ' ') as seq
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from cut where len(w) >= 13)),
origins as (select seq, min(doc_id) as first_id from wins group by seq),
gone as (
  select distinct doc_id, i + k as at
  from wins join origins using (seq), unnest(range(0, 13)) as t(k) where first_id < doc_id),
each as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as at from cut),
kept as (
  select e.doc_id, string_agg(e.word, ' ' order by e.at) as kept, count(*) as n
  from each e anti join gone g on e.doc_id = g.doc_id and e.at = g.at group by e.doc_id)
select cut.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from cut left join kept on cut.doc_id = kept.doc_id
""",
}
