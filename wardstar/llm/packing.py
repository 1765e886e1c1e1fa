"""Packing token sequences into windows by minimum bin slack.

Every document becomes the ids of a public tokenizer and an end id.  It is cut
at multiples of the window: full pieces are windows of their own, the rest (1
to window - 1 ids) are to be combined.  Rests are dealt at random (hash of the
document) into groups of about ``GROUP`` rows, and each group is packed from
its table of lengths alone:

* a window starts with the longest length left;
* a bitset subset-sum DP over the lengths left (bit s of an integer: sum s can
  be reached) finds the reachable sum closest to the space, shortest
  combinations of long lengths first;
* walking back through the bitsets gives the multiset of lengths, and the same
  window is repeated as often as its counts allow.

Only the last windows of a group keep slack.  What those hold is cut anew:
rests may be cut freely, so the least filled windows of a group are emptied
into the others' slack, and what is left over is one window per group.

A word's ids do not depend on the words around it (the tokenizer splits at
white space), so a task keeps the ids of words in a bounded cache.  Strings of
special tokens in a text are ordinary text.

Defined results: null and empty texts are the end id alone; rows that repeat
are documents of their own; no rows give no rows.
"""

from __future__ import annotations

import math
import struct
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import grouped, small_batches, staged, table, worker_held

WINDOW = 2048
END_ID = 1
GROUP = 1 << 12  # rests packed together
_CACHE = 1 << 19  # words whose ids a worker keeps
_TAIL = b".,;:!?*#$%&|)"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder(dict):
    """Ids (little-endian) of words, filled in as they come up to a bound; also encodes texts.

    The tokenizer never joins across white space, nor a run of letters with the
    signs after it, so a word is its letters and its tail.  A run of letters
    that the normaliser would leave alone goes to the vocabulary's model
    directly; everything else through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__({b"": b""})
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        self.model._resize_cache(0)  # words come here once
        self.letters = _byte_letters()

    def __missing__(self, word: bytes) -> bytes:
        core = word.rstrip(_TAIL)
        if core.isalpha():  # ASCII letters
            lower = core.lower()
            ids = (self.get(lower) if lower != word else None) or self._of_letters(lower.decode("ascii"))
        else:
            text = core.decode("utf-8", "replace")
            if not text.isalpha() or text != text.lower() or not unicodedata.is_normalized("NFC", text):
                return self._kept(word, self._whole(word))
            ids = self._of_letters(core.decode("latin-1").translate(self.letters))
        if len(core) < len(word):
            tail = word[len(core) :]
            ids += self.get(tail) or self._kept(tail, self._whole(tail))
        return self._kept(word, ids)

    def _kept(self, word: bytes, ids: bytes) -> bytes:
        """The first words to come stay, which are the frequent ones."""
        if len(self) < _CACHE:
            self[word] = ids
        return ids

    def _of_letters(self, letters: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _whole(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: bytes) -> bytes:
        """Ids of a text; white space beyond ASCII stays inside words, where the tokenizer sees it."""
        return b"".join(map(self.__getitem__, text.split()))


def _encoder(path: str) -> Encoder:
    """One per Python worker, so that its words serve all tasks there."""
    return worker_held(f"encoder {path}", lambda: Encoder(path))


# ------------------------------------------------------------------ minimum bin slack on a table of lengths
def best_fill(counts: dict[int, int], space: int) -> dict[int, int]:
    """The multiset of lengths (at most counts[n] of n) whose sum comes closest to ``space`` from below."""
    mask = (1 << space + 1) - 1
    reach, steps = 1, []
    for n in sorted(counts, reverse=True):
        if n > space:
            continue
        left = min(counts[n], space // n)
        size = 1
        while left:  # counts in binary portions
            size = min(size, left)
            after = reach | reach << n * size & mask
            steps.append((n, size, reach))
            left -= size
            size *= 2
            reach = after
            if reach >> space & 1:
                break
        if reach >> space & 1:
            break
    total = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for n, size, before in reversed(steps):
        if not before >> total & 1:
            taken[n] = taken.get(n, 0) + size
            total -= n * size
    return taken


def fill_windows(counts: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """Windows (multiset of lengths, times) that use up all lengths; each length is below the window."""
    counts, out = dict(counts), []
    while counts:
        longest = max(counts)
        rest = dict(counts)
        rest[longest] -= 1
        if not rest[longest]:
            del rest[longest]
        chosen = best_fill(rest, window - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(counts[n] // k for n, k in chosen.items())
        out.append((chosen, times))
        for n, k in chosen.items():
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
    return out


def pack_rests(lengths: list[int], window: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (rest, start within it, length); windows short of ids are emptied into others, cutting rests."""
    waiting: dict[int, list[int]] = {}
    for i, n in enumerate(lengths):
        waiting.setdefault(n, []).append(i)
    windows = []
    for chosen, times in fill_windows({n: len(w) for n, w in waiting.items()}, window):
        for _ in range(times):
            windows.append([(waiting[n].pop(), 0, n) for n, k in sorted(chosen.items()) for _ in range(k)])
    free = [window - sum(n for *_, n in w) for w in windows]
    loose = sorted((i for i in range(len(windows)) if free[i]), key=lambda i: free[i])
    while len(loose) > 1:  # the emptiest window into the fullest ones
        last = loose[-1]
        to = loose[0]
        rest, start, n = windows[last].pop()
        put = min(n, free[to])
        windows[to].append((rest, start, put))
        if put < n:
            windows[last].append((rest, start + put, n - put))
        free[to] -= put
        free[last] += put
        if not free[to]:
            loose.pop(0)
        if not windows[last]:
            loose.pop()
    return [w for w in windows if w]


# ------------------------------------------------------------------ over all documents
def encoded_pieces(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """doc_id, doc_tokens, start, ids (little-endian unsigned 32-bit) per piece of at most one window."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        end, step = struct.pack("<I", end_id), 4 * window
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows, tokens, starts, ids = [], [], [], []
                for row, text in enumerate(part.column("text").to_pylist()):
                    found = encoder.encode(text or b"") + end
                    for start in range(0, len(found), step):
                        rows.append(row)
                        tokens.append(len(found) // 4)
                        starts.append(start // 4)
                        ids.append(found[start : start + step])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(rows, pa.int32())), pa.array(tokens, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "doc_tokens", "start", "ids"],
                )

    rows = small_batches(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, doc_tokens long, start long, ids binary")


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset: each id of each document in exactly one piece.

    A sequence is the pieces of one sequence_id in order of offset.
    """
    pieces = staged(encoded_pieces(docs, path or vocabulary_path(), window), "pieces")
    kind = docs.schema["doc_id"].dataType.simpleString()
    size = F.length("ids") / 4
    rests = pieces.where(size < window)
    groups = max(1, math.ceil(rests.count() / group))
    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, ("group",)):
            number = rows.column("group")[0].as_py()
            doc, ids, tokens, start = (rows.column(c).to_pylist() for c in ("doc_id", "ids", "doc_tokens", "start"))
            out = []
            for i, window_ in enumerate(pack_rests([len(x) // 4 for x in ids], window)):
                offset = 0
                for rest, begin, n in window_:
                    out.append((doc[rest], start[rest] + begin, n, ids[rest][4 * begin : 4 * (begin + n)], tokens[rest], number << 32 | i, offset))
                    offset += n
            fields = (rows.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), fields)], names=names)

    spread = F.xxhash64("doc_id", "doc_tokens", F.crc32("ids"))
    dealt = rests.withColumn("group", F.pmod(spread, F.lit(groups)).cast("long"))
    packed = dealt.repartition("group").sortWithinPartitions("group").mapInArrow(run, schema)
    full = pieces.where(size == window).select(
        "doc_id", "start", F.lit(window).cast("long").alias("length"), "ids", "doc_tokens",
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )  # of a written table: the same ids whenever a task runs again
    return full.unionAll(packed)


def op8_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


QUERIES = {"op8_packing": op8_packing}
