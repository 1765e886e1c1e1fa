"""Words of many texts at once: cut and numbered by Arrow, as arrays for numpy.

A piece is a slice of a batch with at most ``PIECE`` bytes of text (a longer
text is a piece of its own), so that the arrays made from it stay small
whatever the size of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 4 << 20


@dataclass
class Words:
    """Words of the texts of a piece, one after another: text i has ``codes[begins[i]:begins[i + 1]]``."""

    codes: np.ndarray  # int64, places in names
    begins: np.ndarray  # int64, one more than texts
    names: pa.StringArray  # distinct words

    @property
    def owner(self) -> np.ndarray:
        """The text that each word stands in."""
        return np.repeat(np.arange(len(self.begins) - 1), np.diff(self.begins))


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def words(text: pa.Array) -> Words:
    """Maximal runs of anything but ASCII white space (null: none)."""
    split = pc.ascii_split_whitespace(pc.fill_null(text, ""))
    flat, ends = split.flatten(), split.offsets.to_numpy()
    there = pc.greater(pc.binary_length(flat), 0)  # white space at an end of a text leaves an empty word
    before = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False), dtype=np.int64)])
    coded = flat.filter(there).dictionary_encode()
    return Words(coded.indices.to_numpy().astype(np.int64), before[ends - ends[0]], coded.dictionary)


def joined(names: pa.StringArray, codes: np.ndarray, begins: np.ndarray) -> pa.StringArray:
    """Texts of the words ``codes[begins[i]:begins[i + 1]]`` with one space between."""
    taken = names.take(pa.array(codes))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(begins, pa.int32()), taken), " ")
