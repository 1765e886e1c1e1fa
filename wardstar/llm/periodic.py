"""Periodic runs of words: suffix automaton with link-cut access.

A run is a stretch of a document's words with smallest period q (words q
apart are identical) of at least ``max(shortest, 4 * q)`` words that no
neighbouring word extends.  All runs of a document are found, and the words of
each beyond its first period are dropped from the collapsed text.

The suffix automaton's link tree holds, on the path from the node of prefix i
to the root, all words ending at i by length.  ``access`` walks that path as a
link-cut tree does: it meets stretches of nodes whose words last ended at one
earlier place, then recolours the whole path with i.  A stretch up to length L
that last ended d words earlier is the longest common suffix of both prefixes,
so words i - d - L to i have period d, a square if L >= d; with L >= 3 d no
shorter period is possible and the left end is final.  The run's right end is
the last i at which it is met.

Only stretches that can hold a run are given to the automaton.  In a run of
period q every word after the first period stood at most q words earlier too;
so such words form a stretch of at least 3 q of them (5 for q = 1), and a
word whose last occurrence is further back than a third of its stretch
divides it.  This is necessary for a run, decides none, and is exact: what is
left includes every run whole.

One text is one task's work; arrays take about 60 bytes per word of such a
stretch.  Defined results: a null or empty text has no runs and an empty
collapsed text; every row is a document of its own, so null and repeated ids
need nothing special; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import WORD, table
from wardstar.llm.words import joined, pieces, words

SHORTEST = 6
_ROUNDS = 40  # of dividing; later rounds would only make the stretches smaller


# ------------------------------------------------------------------ automaton
def suffix_links(w: list[int]) -> tuple[array, array, array]:
    """Longest word and suffix link of every state (from 1; state 1 is the root, 0 none) and the states of the prefixes."""
    size = 2 * len(w) + 2
    longest, link = array("l", bytes(8 * size)), array("l", bytes(8 * size))
    letter, to = array("l", [-1]) * size, array("l", bytes(8 * size))  # first transition of a state
    more: dict[int, dict[int, int]] = {}  # its others
    ends = array("l", bytes(8 * len(w)))
    last, states = 1, 1
    for i, c in enumerate(w):
        states += 1
        cur = states
        longest[cur] = longest[last] + 1
        p, q = last, 0
        while p:
            if letter[p] == c:
                q = to[p]
                break
            if letter[p] < 0:
                letter[p], to[p] = c, cur
            else:
                others = more.setdefault(p, {})
                if c in others:
                    q = others[c]
                    break
                others[c] = cur
            p = link[p]
        if not p:
            link[cur] = 1
        elif longest[p] + 1 == longest[q]:
            link[cur] = q
        else:
            states += 1
            clone = states
            longest[clone], link[clone], letter[clone], to[clone] = longest[p] + 1, link[q], letter[q], to[q]
            if q in more:
                more[clone] = dict(more[q])
            while p:
                if letter[p] == c:
                    if to[p] != q:
                        break
                    to[p] = clone
                else:
                    others = more.get(p, {})
                    if others.get(c) != q:
                        break
                    others[c] = clone
                p = link[p]
            link[q] = link[cur] = clone
        last = ends[i] = cur
    return longest, link, ends


class Paths:
    """Preferred paths of a rooted tree, each a splay tree by depth with one colour (kept at its root)."""

    def __init__(self, parent: array):
        self.up = array("l", parent)
        self.left, self.right, self.colour = (array("l", bytes(8 * len(parent))) for _ in range(3))

    def _splay(self, x: int) -> None:
        up, left, right, colour = self.up, self.left, self.right, self.colour
        y = up[x]
        while y and (left[y] == x or right[y] == x):
            z = up[y]
            turns = (x,)
            if z and (left[z] == y or right[z] == y):
                turns = (y, x) if (left[z] == y) == (left[y] == x) else (x, x)
            for t in turns:  # t goes above its parent a
                a = up[t]
                b = up[a]
                if left[a] == t:
                    c = left[a] = right[t]
                    right[t] = a
                else:
                    c = right[a] = left[t]
                    left[t] = a
                if c:
                    up[c] = a
                if b and left[b] == a:
                    left[b] = t
                elif b and right[b] == a:
                    right[b] = t
                else:  # a was the root of its splay tree
                    colour[t] = colour[a]
                up[a], up[t] = t, b
            y = up[x]

    def access(self, x: int, colour: int) -> list[tuple[int, int]]:
        """Colours on the way from x to the root, each with its lowest node; then the way gets ``colour``."""
        met, below = [], 0
        up, right, colours = self.up, self.right, self.colour
        while x:
            self._splay(x)
            cut = right[x]
            if cut:
                colours[cut] = colours[x]
            right[x] = below
            if colours[x]:
                met.append((x, colours[x]))
            below, x = x, up[x]
        colours[below] = colour
        return met


def automaton_runs(w: list[int], shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of ``w``."""
    longest, link, ends = suffix_links(w)
    paths = Paths(link)
    found: dict[tuple[int, int], int] = {}
    for i, state in enumerate(ends, 1):
        for node, last in paths.access(state, i):
            d, same = i - last, longest[node]
            if same >= 3 * d and same + d >= shortest:
                found[i - d - same, d] = i
    return sorted((start, end - start, d) for (start, d), end in found.items())


# ------------------------------------------------------------------ stretches
def stretches(codes: np.ndarray, owner: np.ndarray, shortest: int = SHORTEST) -> Iterator[tuple[int, int, int]]:
    """(begin, from, to): runs have all words after their first period in ``from:to`` and none before ``begin``."""
    n = len(codes)
    if not n:
        return
    order = np.argsort(owner * (int(codes.max()) + 1) + codes, kind="stable")
    again = (codes[order][1:] == codes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    back = np.full(n, n + 1)
    back[order[1:][again]] = np.diff(order)[again]
    held = back <= n  # the first word of a text never is
    count = -1
    for _ in range(_ROUNDS):
        edges = np.flatnonzero(np.diff(held, prepend=False, append=False))
        lo, hi = edges[::2], edges[1::2]
        long = hi - lo >= shortest - 1
        lo, hi = lo[long], hi[long]
        if int((hi - lo).sum()) == count:
            break
        count = int((hi - lo).sum())
        size = hi - lo
        places = np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(count)
        held = np.zeros(n, bool)
        held[places] = back[places] <= np.repeat(size // 3, size)
    edges = np.flatnonzero(np.diff(held, prepend=False, append=False))
    first = np.searchsorted(owner, owner[edges[::2]]) if len(edges) else edges
    for lo, hi, begin in zip(edges[::2].tolist(), edges[1::2].tolist(), first.tolist()):
        if hi - lo >= shortest - 1:
            yield max(begin, lo - (hi - lo) // 3), lo, hi


def runs(codes: np.ndarray, begins: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of all runs of all texts of a piece, in this order; start within the text."""
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    out = []
    for begin, lo, hi in stretches(codes, owner, shortest):
        text = int(owner[lo])
        for start, length, period in automaton_runs(codes[begin:hi].tolist(), shortest):
            if begin + start + period >= lo:  # else it belongs to the stretch before
                out.append((text, begin + start - int(begins[text]), length, period))
    return sorted((t, s, n, q) for t, s, n, q in out)


# ------------------------------------------------------------------ operator
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def collapse(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, runs (by start, then period) and collapsed, the text without repeats of a period, of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    item = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            w = words(piece.column("text"))
            found = runs(w.codes, w.begins, shortest)
            kept = np.ones(len(w.codes), bool)
            sizes = np.zeros(piece.num_rows, np.int64)
            for text, start, length, period in found:
                at = int(w.begins[text]) + start
                kept[at + period : at + length] = False
                sizes[text] += 1
            left = np.concatenate([[0], np.cumsum(kept)])[w.begins]
            fields = [pa.array([f[k] for f in found], pa.int64()) for k in (1, 2, 3)]
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(fields, fields=list(item)))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), lists, joined(w.names, w.codes[kept], left)], names=["doc_id", "runs", "collapsed"]
            )

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, runs {RUNS}, collapsed string"
    )


def plant(docs: DataFrame) -> DataFrame:
    """The contract's documents: in a tenth of them, by CRC-32 of the id, the words from one on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    cut = docs.select(
        "doc_id", "text", F.floor(h / 10).alias("g"),
        F.when(chosen, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("w"),
    )
    cut = cut.withColumn("n", F.when(F.size("w") > 0, F.size("w")))
    cut = cut.withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    cut = cut.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    moved = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(
        F.get(F.col("w"), F.col("a") + (i - F.col("a")) % F.col("p"))))
    return cut.select("doc_id", F.when(F.col("n").isNotNull(), F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir):
    docs = plant(table(spark, sf_dir, "documents").select("doc_id", "text"))
    # greatest length / period first, compared exactly
    ahead = lambda x, y: F.when(x["length"] * y["period"] > y["length"] * x["period"], -1).when(
        x["length"] * y["period"] < y["length"] * x["period"], 1).when(x["start"] < y["start"], -1).when(
        x["start"] > y["start"], 1).when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0)
    best = F.get(F.array_sort("runs", ahead), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = collapse(docs).withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op13_periodic_runs": op13_periodic_runs}
