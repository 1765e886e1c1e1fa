"""Byte-context trie for prediction by partial matching, as flat arrays.

A node is a gram of 1 to ``order + 1`` bytes with its count: the last byte is a
symbol in the context of the bytes before it, and the gram itself is a context
for the symbols that follow.  A gram is packed into a 64-bit key (its bytes,
and its length in the top byte); nodes sit in an open-addressing table, so a
whole batch of positions is looked up at once.

Escapes follow method D: with n the count of a symbol, t the sum and q the
number of symbols of its context, a symbol has probability (2n - 1) / 2t and
the escape q / 2t.  After an escape the symbols of the longer context are
excluded: they also follow the shorter context, so t and q of the shorter one
lose a fixed amount per longer context, which is kept with that context.
Below order 0 the bytes never seen are equally likely.
"""

from __future__ import annotations

import numpy as np

from wardstar.llm.common import different

END = 10  # the byte that ends a text; no word has it
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tagged(grams: np.ndarray, length: int) -> np.ndarray:
    return grams | np.uint64(length << 56)


def normalised(text: bytes | None) -> bytes:
    """Lower-cased words joined by one space, with the end byte."""
    return b" ".join(text.lower().split()) + b"\n" if text else b"\n"


def packed(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of the texts its key of ``order`` bytes before and itself, and where each text begins.

    Before a text stand end bytes, so that no context reaches into another text.
    """
    lead = bytes([END]) * order
    data = b"".join([x for t in texts for x in (lead, t)]) + bytes(8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    windows = np.ndarray((len(data) - 8 - order,), ">u8", data, strides=(1,))  # the eight bytes from each place on
    keys = windows.astype(np.uint64)
    keys >>= np.uint64(8 * (7 - order))
    ends = np.cumsum(lengths + order) - order
    inside = np.ones(len(keys), bool)
    for back in range(order):  # the leading end bytes of all texts but the first are no symbols
        inside[ends[:-1] + back] = False
    return keys[inside], np.concatenate([[0], np.cumsum(lengths)[:-1]])


def shortened(grams: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Tagged keys and counts of the grams of the last ``length`` bytes of longer ones."""
    if not len(grams):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    cut = grams & np.uint64((1 << 8 * length) - 1)
    by = np.argsort(cut)
    cut, counts = cut[by], counts[by]
    first = np.flatnonzero(np.concatenate([[True], cut[1:] != cut[:-1]]))
    return tagged(cut[first], length), np.add.reduceat(counts, first)


class Slots:
    """An open-addressing table of tagged keys."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(8, int(len(keys) * 1.6).bit_length())
        self.place = self._build(keys)  # the slot of each key

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _build(self, keys: np.ndarray) -> np.ndarray:
        """Fill the table; the slot of each key."""
        size = 1 << self.bits
        self.keys, place = np.zeros(size, np.uint64), np.zeros(len(keys), np.int64)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[todo[free]]  # of several for a slot the last stays
            won = self.keys[slot] == keys[todo]
            place[todo[won]] = slot[won]
            todo, slot = todo[~won], (slot[~won] + 1) & (size - 1)
        return place

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 if there is none."""
        slot = self._slot(keys)
        there = self.keys[slot]
        other = np.flatnonzero(there != keys)
        out = slot
        if len(other):
            at, want, there = slot[other], keys[other], there[other]
            out[other] = -1
            while True:
                on = there != 0
                other, at, want = other[on], (at[on] + 1) & ((1 << self.bits) - 1), want[on]
                if not len(other):
                    break
                there = self.keys[at]
                hit = there == want
                out[other[hit]] = at[hit]
                other, at, want, there = other[~hit], at[~hit], want[~hit], there[~hit]
        return out


class Longest(Slots):
    """Some of the longest grams with their log10 probabilities."""

    def __init__(self, order: int, grams: np.ndarray, logs: np.ndarray):
        self.order = order
        super().__init__(tagged(grams, order + 1))
        self.logs = np.zeros(1 << self.bits, np.float32)
        self.logs[self.place] = logs

    def score(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each packed symbol that is there (else 0), and whether it is."""
        slot = self.find(tagged(keys, self.order + 1))
        known = slot >= 0
        return np.where(known, self.logs[slot], np.float32(0)).astype(np.float64), known


class Trie(Slots):
    """Scores packed keys; built from grams and counts (longer grams' counts are included in shorter ones).

    What a key's contexts need of the model is the symbols that follow each suffix of its context, with their counts:
    a trie of those alone scores the key as the whole model does.
    """

    def __init__(self, order: int, keys: np.ndarray, counts: np.ndarray):
        self.order = order
        for n in range(order + 1, 1, -1):  # contexts before a text's first byte are no symbols: nodes of count 0
            of = keys[keys >> np.uint64(56) == n] & np.uint64((1 << 56) - 1)
            contexts = different(tagged(of >> np.uint64(8), n - 1))
            more = contexts[~np.isin(contexts, keys, assume_unique=True, kind="sort")]
            keys, counts = np.concatenate([keys, more]), np.concatenate([counts, np.zeros(len(more), counts.dtype)])
        if not len(keys):  # an untrained trie has one node that nothing finds
            keys, counts = tagged(np.zeros(1, np.uint64), 255), np.zeros(1)
        by = np.argsort(keys)
        keys, counts = keys[by], counts[by].astype(np.float64)
        length = (keys >> np.uint64(56)).astype(np.int64)
        super().__init__(keys)
        place = self.place
        node = np.full(1 << self.bits, -1, np.int32)
        node[place] = np.arange(len(keys), dtype=np.int32)
        # the context of a node, and the same symbol in the context shorter by its first byte
        parent, shorter = np.full(len(keys), -1, np.int32), np.full(len(keys), -1, np.int32)
        for n in range(2, order + 2):
            of = np.flatnonzero(length == n)
            gram = keys[of] & np.uint64((1 << 56) - 1)
            parent[of] = node[self.find(tagged(gram >> np.uint64(8), n - 1))]
            shorter[of] = node[self.find(tagged(gram & np.uint64((1 << 8 * (n - 1)) - 1), n - 1))]
        del node
        seen = counts > 0  # contexts by index + 1, the empty context at 0
        size = len(keys) + 1
        total = np.bincount(parent + 1, counts, size)
        kinds = np.bincount(parent + 1, seen, size)
        deep = np.flatnonzero(seen & (length > 1))
        lost = np.bincount(parent[deep] + 1, counts[shorter[deep]], size)
        up = np.where(length > 1, shorter, -1) + 1  # the context below a node's own, as a context

        def by_slot(values: np.ndarray) -> np.ndarray:
            out = np.zeros(1 << self.bits, np.float32)
            out[place] = values
            return out

        with np.errstate(divide="ignore", invalid="ignore"):
            self.fresh = by_slot(np.log10((2 * counts - 1) / (2 * total[parent + 1])))
            self.symbol = by_slot(np.log10(2 * counts - 1))
            self.escape = by_slot(np.log10(kinds[1:] / (2 * total[1:])))
            left, left_kinds = total[up] - lost[1:], kinds[up] - kinds[1:]
            self.below = by_slot(np.log10(2 * left))
            self.below_escape = by_slot(np.where(left_kinds > 0, np.log10(left_kinds / (2 * left)), 0.0))
        self.seen, self.context = np.zeros(1 << self.bits, bool), np.zeros(1 << self.bits, bool)
        self.seen[place], self.context[place] = seen, kinds[1:] > 0
        self.root_escape = np.log10(kinds[0] / (2 * total[0])) if total[0] else 0.0
        self.unseen = -np.log10(max(1.0, 256 - kinds[0]))

    def score(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each packed symbol in its context."""
        top = self.find(tagged(keys, self.order + 1))
        done = (top >= 0) & self.seen[top]
        out = np.where(done, self.fresh[top], np.float32(0)).astype(np.float64)  # most symbols need no escape
        todo = np.flatnonzero(~done)
        left = keys[todo]
        above = np.full(len(todo), -1)  # the longer context just escaped from
        for n in range(self.order + 1, 0, -1):
            grams = left & np.uint64((1 << 8 * n) - 1)
            if n <= self.order:
                node = self.find(tagged(grams, n))
                hit = (node >= 0) & self.seen[node]
                at, of = node[hit], above[hit]
                out[todo[hit]] += np.where(of < 0, self.fresh[at], self.symbol[at] - self.below[of])
                todo, left, above, grams = todo[~hit], left[~hit], above[~hit], grams[~hit]
            if not len(todo):
                return out
            if n == 1:
                out[todo] += np.where(above < 0, self.root_escape, self.below_escape[above]) + self.unseen
                return out
            here = self.find(tagged(grams >> np.uint64(8), n - 1))
            known = (here >= 0) & self.context[here]
            cost = np.where(above < 0, self.escape[here], self.below_escape[above])
            out[todo] += np.where(known, cost, 0.0)
            above = np.where(known, here, -1)
        return out
