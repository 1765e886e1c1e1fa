"""Dense surrogate keys (``AUTO_INCREMENT``) without a single-partition window.

``row_number() over (order by k)`` would pull every row into one task.
Instead the rows are range-partitioned and sorted on the natural key, each
row is tagged with its (partition, position) via
``monotonically_increasing_id``, the tagged frame is checkpointed to the
shared checkpoint folder (so a recomputation after executor loss cannot
re-draw partition bounds), and per-partition row counts — one row per
partition, a proven size bound — are prefix-summed and broadcast back.
The result equals ``start_after + row_number() over (order by k)``,
whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id: partition id in the upper 31 bits


def dense_keys(
    df: DataFrame,
    order_by: Sequence[str | Column],
    key_col: str,
    start_after: int | Callable[[], int] = 0,
) -> DataFrame:
    """Append ``key_col`` = ``start_after`` + 1-based rank in ``order_by`` order.

    ``order_by`` must be unique per row for the keys to be reproducible.
    ``start_after`` may be a callable (e.g. the current maximum key).
    """
    if callable(start_after):
        start_after = start_after()
    checkpoint_dir(df.sparkSession)
    tagged = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_ws_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    pid = F.shiftright("_ws_mid", _POS_BITS).alias("_ws_pid")
    counts = tagged.groupBy(pid).agg(F.count(F.lit(1)).alias("_ws_n"))
    before = Window.orderBy("_ws_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_ws_pid", F.coalesce(F.sum("_ws_n").over(before), F.lit(0)).alias("_ws_off"))
    pos = F.col("_ws_mid").bitwiseAND((1 << _POS_BITS) - 1)
    return (
        tagged.withColumn("_ws_pid", F.shiftright("_ws_mid", _POS_BITS))
        .join(F.broadcast(offsets), "_ws_pid")
        .withColumn(key_col, (F.lit(start_after) + F.col("_ws_off") + pos + 1).cast("long"))
        .drop("_ws_pid", "_ws_mid", "_ws_off")
    )


def max_key(df: DataFrame, key_col: str) -> int:
    """Largest key already issued (0 for an empty table) — a one-row scalar."""
    row = df.agg(F.max(key_col).alias("m")).first()
    return int(row["m"] or 0)
