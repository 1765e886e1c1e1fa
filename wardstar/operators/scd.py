"""Slowly changing dimensions without a MERGE-capable table format.

* ``type1_upsert`` (W18, ``INSERT … ON DUPLICATE KEY UPDATE``): matched rows
  take every attribute from the source (``VALUES(col)``, NULLs included)
  and keep their surrogate key; unmatched source rows get new keys after
  the current maximum.
* ``scd2`` (W17): new or changed rows become new current versions starting
  ``as_of``; the version they replace is closed on ``as_of - 1``.  A row
  that already started on ``as_of`` is corrected in place (a second change
  on one day), so intervals never invert and exactly one row per natural
  key stays current.
* ``stamp_changes`` (S12): the ``ON UPDATE CURRENT_TIMESTAMP`` change stamp,
  derived by comparing two snapshots of a table.
* ``evolve`` (S11): ``ALTER TABLE ADD COLUMN … DEFAULT``.

All are joins on the natural key against a change set; the target itself
is only scanned and re-emitted, never collected.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import OPEN_END_DATE, lit_date, lit_ts
from ..functions.keys import dense_keys, max_key
from ..session import staged


def attribute_changed(new: Sequence[Column], old: Sequence[Column], null_safe: bool = True) -> Column:
    """OR of per-attribute differences.  ``null_safe=False`` reproduces the
    reference's ``!=`` (a change to or from NULL is not seen)."""
    terms = [(~a.eqNullSafe(b)) if null_safe else (a != b) for a, b in zip(new, old)]
    out = terms[0]
    for t in terms[1:]:
        out = out | t
    return F.coalesce(out, F.lit(False))


def type1_upsert(
    target: DataFrame,
    source: DataFrame,
    natural_key: str,
    key_col: str,
    attrs: Sequence[str],
) -> DataFrame:
    """Upsert ``source`` (one row per natural key) into ``target``."""
    cols = [key_col, natural_key, *attrs]
    src = source.select(natural_key, *attrs, F.lit(True).alias("_ws_src"))
    t = target.select(*cols)
    merged = t.alias("t").join(src.alias("s"), natural_key, "left").select(
        F.col(f"t.{key_col}").alias(key_col),
        natural_key,
        *[
            F.when(F.col("s._ws_src"), F.col(f"s.{a}")).otherwise(F.col(f"t.{a}")).alias(a)
            for a in attrs
        ],
    )
    fresh = src.drop("_ws_src").join(t.select(natural_key), natural_key, "left_anti")
    keyed = dense_keys(fresh, [natural_key], key_col, start_after=lambda: max_key(t, key_col))
    return merged.unionByName(keyed.select(*cols))


def type1_changes(
    target: DataFrame,
    source: DataFrame,
    natural_key: str,
    key_col: str,
    attrs: Sequence[str],
    start_after: int | Callable[[], int] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``type1_upsert`` as (keys that leave, rows that come): matched rows with a changed attribute, and new ones."""
    cols = [key_col, natural_key, *attrs]
    old = target.select(natural_key, F.col(key_col).alias("_ws_key"), *[F.col(a).alias(f"_ws_old_{a}") for a in attrs])
    j = source.select(natural_key, *attrs).join(old, natural_key, "left")
    is_new = F.col("_ws_key").isNull()
    touched = j.where(is_new | attribute_changed([F.col(a) for a in attrs], [F.col(f"_ws_old_{a}") for a in attrs]))
    touched = _once(touched.select(natural_key, *attrs, "_ws_key"))
    updated = touched.where(~is_new).withColumnRenamed("_ws_key", key_col)
    start = (lambda: max_key(target, key_col)) if start_after is None else start_after
    fresh = dense_keys(touched.where(is_new).drop("_ws_key"), [natural_key], key_col, start_after=start)
    return updated.select(key_col), updated.select(*cols).unionByName(fresh.select(*cols))


def scd2(
    target: DataFrame,
    changes: DataFrame,
    natural_key: str,
    key_col: str,
    tracked: Sequence[str],
    as_of: str,
    derived: Mapping[str, Callable[[Column], Column]] | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Apply a Type 2 change set.

    ``target`` has ``key_col, natural_key, *tracked, *derived, start_date,
    end_date, is_current``; ``changes`` has ``natural_key, *tracked`` (one row
    per natural key, e.g. the source rows stamped after the watermark).
    ``derived`` maps a column to a function of ``as_of`` computed on new
    versions only (the age band).
    """
    replaced, rows = scd2_changes(target, changes, natural_key, key_col, tracked, as_of, derived, null_safe)
    return target.join(replaced, key_col, "left_anti").select(*target.columns).unionByName(rows)


def scd2_changes(
    target: DataFrame,
    changes: DataFrame,
    natural_key: str,
    key_col: str,
    tracked: Sequence[str],
    as_of: str,
    derived: Mapping[str, Callable[[Column], Column]] | None = None,
    null_safe: bool = True,
    stored: Callable[[DataFrame], DataFrame] | None = None,
    start_after: int | Callable[[], int] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``scd2`` as (keys that leave, rows that come): closed versions under their key, corrected and new versions.

    ``stored(keys)`` gives rows of the target that include those with ``keys``
    (default: all); ``start_after`` is the largest key issued."""
    derived = dict(derived or {})
    day = lit_date(as_of)
    cols = target.columns
    cur = target.where(F.col("is_current")).select(
        natural_key,
        F.col(key_col).alias("_ws_key"),
        F.col("start_date").alias("_ws_start"),
        *[F.col(a).alias(f"_ws_old_{a}") for a in tracked],
    )
    j = changes.select(natural_key, *tracked).join(cur, natural_key, "left")
    is_new = F.col("_ws_key").isNull()
    differs = attribute_changed([F.col(a) for a in tracked], [F.col(f"_ws_old_{a}") for a in tracked], null_safe)
    touched = _once(j.where(is_new | differs).select(natural_key, *tracked, "_ws_key", "_ws_start"))
    same_day = ~is_new & F.coalesce(F.col("_ws_start") == day, F.lit(False))

    def version(df: DataFrame) -> DataFrame:
        out = df.select(natural_key, *tracked, "_ws_key")
        for c, fn in derived.items():
            out = out.withColumn(c, fn(day))
        return out.withColumn("start_date", day).withColumn("end_date", lit_date(OPEN_END_DATE)).withColumn(
            "is_current", F.lit(True)
        )

    replaced = touched.where(~is_new).select(F.col("_ws_key").alias(key_col), same_day.alias("_ws_same_day"))
    closing = replaced.where(~F.col("_ws_same_day")).select(key_col)
    closed = (
        (target if stored is None else stored(closing))
        .join(closing, key_col, "left_semi")
        .withColumn("end_date", F.date_sub(day, 1))
        .withColumn("is_current", F.lit(False))
    )
    corrected = version(touched.where(same_day)).withColumnRenamed("_ws_key", key_col)
    fresh = version(touched.where(~same_day)).drop("_ws_key")
    start = (lambda: max_key(target, key_col)) if start_after is None else start_after
    fresh = dense_keys(fresh, [natural_key], key_col, start_after=start)
    rows = closed.select(*cols).unionByName(corrected.select(*cols)).unionByName(fresh.select(*cols))
    return replaced.select(key_col), rows


def _once(changes: DataFrame) -> DataFrame:
    """A change set is read several times; the join that found it runs once."""
    return staged(changes, "changes")


def stamp_changes(
    prev: DataFrame,
    curr: DataFrame,
    keys: Sequence[str],
    as_of: str | _dt.datetime,
    stamp_col: str = "last_updated",
) -> DataFrame:
    """Rows of ``curr`` with ``stamp_col``: the previous stamp where nothing
    changed, ``as_of`` for inserted or changed rows (null-safe compare)."""
    attrs = [c for c in curr.columns if c not in keys and c != stamp_col]
    p = prev.select(*keys, *[F.col(a).alias(f"_ws_p_{a}") for a in attrs], F.col(stamp_col).alias("_ws_p_stamp"))
    j = curr.select(*keys, *attrs).join(p, list(keys), "left")
    changed = F.col("_ws_p_stamp").isNull() | attribute_changed(
        [F.col(a) for a in attrs], [F.col(f"_ws_p_{a}") for a in attrs]
    )
    return j.select(
        *keys, *attrs, F.when(changed, lit_ts(as_of)).otherwise(F.col("_ws_p_stamp")).alias(stamp_col)
    )


def evolve(df: DataFrame, added: Mapping[str, tuple[str, object]]) -> DataFrame:
    """Add columns ``name -> (type, default)`` absent from ``df``."""
    for name, (dtype, default) in added.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(default).cast(dtype))
    return df
