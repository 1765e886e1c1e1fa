"""Helpers shared by the operators of this package."""

from __future__ import annotations

import itertools
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstar.session import checkpoint_dir

#: A word: a maximal run of anything but ASCII white space (fixed by the contracts).
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
#: Lower-casing of the contracts: A-Z only, whatever the locale.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(_UPPER, _LOWER)
BATCH_BYTES = 4 << 20  # of texts that a task passes to Python at once


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, read by Spark (the path may be in any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Unlike ``checkpoint()`` this evaluates ``df`` a single time; what is read
    later does not depend on any executor still being there.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(docs: DataFrame) -> DataFrame:
    """``docs``; from now on its session hands Python functions at most ``BATCH_BYTES`` of rows at once, or one row.

    Spark's own bound is 10,000 rows or 64 MB, which each task holds several
    times: while it fills the batch, while it sends it and in the function.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs


_HELD: dict[str, object] = {}


def worker_held(name: str, make: Callable[[], object]) -> object:
    """What ``make`` returns, kept for the later tasks of a Python worker until another name is asked for."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def fold(doc_id: Column, modulus: int) -> Column:
    """The contracts' fold of a document: CRC-32 of its id as text, modulo ``modulus`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def lower_words(text: str | None) -> list[str]:
    """Words of a text after lower-casing A-Z (null: none)."""
    return WORD_RE.findall(text.translate(ASCII_LOWER)) if text else []


def different(values: np.ndarray) -> np.ndarray:
    """Distinct values in order."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def grouped(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Groups of rows that stand together in sorted batches, one table each; only the current group is held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for lo, hi in itertools.pairwise([0, *cuts.tolist(), batch.num_rows]):
            now = tuple(c[lo] for c in columns)
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def matrix(vectors: pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Lists of numbers as rows; shorter ones are continued with zeros."""
    flat = vectors.combine_chunks()
    flat = flat if isinstance(flat, pa.Array) else pa.concat_arrays(flat.chunks)
    lengths = pa.compute.list_value_length(flat).to_numpy()
    values = flat.flatten().to_numpy()
    width = max(width or 0, int(lengths.max(initial=0)))
    if (lengths == width).all():
        return values.reshape(len(flat), width)
    out = np.zeros((len(flat), width), values.dtype)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def finite(vector: Column) -> Column:
    """Whether a vector column is there and all its components are numbers (none null, NaN or infinite)."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))
