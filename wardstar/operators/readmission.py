"""30-day readmission flag (W11) as a skew-safe range-existence operator.

An index stay is flagged when its patient has another qualifying stay that
begins on or after the discharge and at most the window later.

A plain equi-join on ``patient_id`` with a range residual compares every
pair of one patient's encounters, so a single hot patient holding a large
share of the rows turns into a quadratic task.  Here no pairs are formed:

1. Candidate readmissions are reduced to distinct (patient, timestamp)
   with a multiplicity, then to per (patient, W-day bucket) summaries —
   latest and second-latest time, earliest and second-earliest time, and
   the multiplicities at the extremes.  Both steps are partial
   aggregations, so a hot patient collapses map-side before any shuffle.
2. ``[d, d + W days]`` always covers the tail of bucket ``k = ⌊day(d)/W⌋``
   and the head of bucket ``k + 1``.  The tail holds a hit iff its latest
   time is ``>= d``; the head iff its earliest time is ``<= d + W``.
3. The index stay itself may be a candidate (same patient, inpatient).
   That matters only for a stay discharged no later than it began; for those
   the multiplicity at an extreme, or the second extreme, decides.

Each index encounter then needs one equi-join with a table holding at most
one row per (patient, bucket); AQE's skew-join split handles a hot join key
on the index side, because the summary side has a single row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import epoch_day

# Fixed values of the reference: look-ahead window and the qualifying type.
READMISSION_DAYS = 30
READMISSION_TYPE = "Inpatient"


def _bucket(ts: Column, days: int) -> Column:
    return F.floor(epoch_day(ts) / F.lit(days)).cast("long")


def bucket_summaries(
    encounters: DataFrame, match_cols: Sequence[str], days: int, readmit_type: str
) -> DataFrame:
    """One row per (match cols, bucket ``k``) with the statistics of bucket
    ``k`` (``m1, cm1, m2``: latest times) and of bucket ``k + 1`` (``n1, cn1,
    n2``: earliest times) side by side."""
    keys = list(match_cols)
    t = encounters.where(
        (F.col("encounter_type") == readmit_type) & F.col("encounter_date").isNotNull()
    ).select(*keys, F.col("encounter_date").alias("t"))
    t = t.withColumn("b", _bucket(F.col("t"), days))
    per_time = t.groupBy(*keys, "b", "t").agg(F.count(F.lit(1)).alias("c"))
    first = per_time.groupBy(*keys, "b").agg(
        F.max("t").alias("m1"),
        F.max_by("c", "t").alias("cm1"),
        F.min("t").alias("n1"),
        F.min_by("c", "t").alias("cn1"),
    )
    second = (
        per_time.join(first.select(*keys, "b", "m1", "n1"), [*keys, "b"])
        .groupBy(*keys, "b")
        .agg(
            F.max(F.when(F.col("t") < F.col("m1"), F.col("t"))).alias("m2"),
            F.min(F.when(F.col("t") > F.col("n1"), F.col("t"))).alias("n2"),
        )
    )
    stats = first.join(second, [*keys, "b"])
    # each bucket row serves as the tail of bucket b and the head of bucket
    # b + 1: emit both roles and fold them per (keys, k) — one aggregation
    # instead of a self join of the summary
    roles = stats.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col("b").alias("k"), F.lit(True).alias("tail")),
                F.struct((F.col("b") - 1).alias("k"), F.lit(False).alias("tail")),
            )
        ).alias("r"),
        "m1", "cm1", "m2", "n1", "cn1", "n2",
    ).select(*keys, "r.k", "r.tail", "m1", "cm1", "m2", "n1", "cn1", "n2")
    tail, head = F.col("tail"), ~F.col("tail")
    return roles.groupBy(*keys, "k").agg(
        F.max(F.when(tail, F.col("m1"))).alias("m1"),
        F.max(F.when(tail, F.col("cm1"))).alias("cm1"),
        F.max(F.when(tail, F.col("m2"))).alias("m2"),
        F.max(F.when(head, F.col("n1"))).alias("n1"),
        F.max(F.when(head, F.col("cn1"))).alias("cn1"),
        F.max(F.when(head, F.col("n2"))).alias("n2"),
    )


def bucket_extremes(
    encounters: DataFrame, match_cols: Sequence[str], days: int, readmit_type: str
) -> DataFrame:
    """One row per (match cols, bucket ``k``): the latest time of bucket ``k``
    (``m1``) and the earliest of bucket ``k + 1`` (``n1``), in one aggregation."""
    keys = list(match_cols)
    t = encounters.where(
        (F.col("encounter_type") == readmit_type) & F.col("encounter_date").isNotNull()
    ).select(*keys, F.col("encounter_date").alias("t"))
    b = _bucket(F.col("t"), days)
    roles = t.select(
        *keys,
        "t",
        F.explode(
            F.array(
                F.struct(b.alias("k"), F.lit(True).alias("tail")),
                F.struct((b - 1).alias("k"), F.lit(False).alias("tail")),
            )
        ).alias("r"),
    ).select(*keys, "t", "r.k", "r.tail")
    return roles.groupBy(*keys, "k").agg(
        F.max(F.when(F.col("tail"), F.col("t"))).alias("m1"),
        F.min(F.when(~F.col("tail"), F.col("t"))).alias("n1"),
    )


def readmission_flag(
    encounters: DataFrame,
    probes: DataFrame | None = None,
    days: int = READMISSION_DAYS,
    readmit_type: str = READMISSION_TYPE,
    match_cols: Sequence[str] = ("patient_id",),
    flag_col: str = "is_readmission",
    own_hits: bool = True,
) -> DataFrame:
    """Append ``flag_col`` to ``probes`` (default: every encounter).

    ``encounters`` supplies the candidate readmissions (all source
    encounters, as in the reference); ``probes`` the index stays and must
    carry ``encounter_id, encounter_type, encounter_date, discharge_date``
    and ``match_cols``.  ``match_cols=("patient_id", "specialty_id")`` gives
    the documented same-specialty variant.

    A stay can only be its own hit if its own time lies in its window, that
    is if it was discharged no later than admitted.  All other stays need the
    two extreme times of a bucket and nothing else; the odd ones take the
    exact path, over the candidates of their patients only.
    ``own_hits=False``: no probe is among the candidates.
    """
    keys = list(match_cols)
    probes = encounters if probes is None else probes
    d, t = F.col("discharge_date"), F.col("encounter_date")
    end = d + F.make_dt_interval(F.lit(days))
    odd = F.coalesce((F.col("encounter_type") == readmit_type) & t.between(d, end), F.lit(False))
    p = probes.withColumn("k", _bucket(d, days))

    plain = (p.where(~odd) if own_hits else p).join(bucket_extremes(encounters, keys, days, readmit_type), [*keys, "k"], "left")
    plain = plain.withColumn(flag_col, F.coalesce((F.col("m1") >= d) | (F.col("n1") <= end), F.lit(False)))

    plain = plain.drop("k", "m1", "n1")
    if not own_hits:
        return plain
    theirs = encounters.join(probes.where(odd).select(*keys).distinct(), keys, "left_semi")
    exact = p.where(odd).join(bucket_summaries(theirs, keys, days, readmit_type), [*keys, "k"], "left")
    tail_hit = ((F.col("m1") >= d) & ((F.col("m1") != t) | (F.col("cm1") >= 2))) | (F.col("m2") >= d)
    head_hit = ((F.col("n1") <= end) & ((F.col("n1") != t) | (F.col("cn1") >= 2))) | (F.col("n2") <= end)
    exact = exact.withColumn(flag_col, F.coalesce(tail_hit, F.lit(False)) | F.coalesce(head_hit, F.lit(False)))
    return plain.unionByName(exact.drop("k", "m1", "cm1", "m2", "n1", "cn1", "n2"))
