"""Warehouse extras (X7, X8): a monthly summary, maintained by incremental runs, and a billing-grain fact."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key


MEASURES = ("encounters", "readmissions", "diagnoses", "procedures", "timed", "duration_hours", "total_allowed", "claim_amount")
GROUP = ("year", "month", "specialty_key", "encounter_type_key")


def summary_state(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Additive measures per month, specialty key and type key (``timed``: encounters with a duration)."""
    dd = dim_date.select("date_key", "year", "month")
    return fact.join(dd, fact["encounter_date_key"] == dd["date_key"]).groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("encounters"),
        F.count_if(F.col("is_readmission")).alias("readmissions"),
        F.sum("diagnosis_count").alias("diagnoses"),
        F.sum("procedure_count").alias("procedures"),
        F.count("encounter_duration_hours").alias("timed"),
        F.coalesce(F.sum("encounter_duration_hours"), F.lit(0)).alias("duration_hours"),
        F.sum("total_allowed").alias("total_allowed"),
        F.sum("claim_amount").alias("claim_amount"),
    )


def maintained_state(state: DataFrame, removed: DataFrame, added: DataFrame) -> DataFrame:
    """``state`` less the contributions of ``removed`` plus those of ``added`` (states of the fact rows a run deletes
    and inserts).  Measures are integers and decimals, so the result equals a recomputed state."""
    minus = removed.select(*GROUP, *[(-F.col(m)).alias(m) for m in MEASURES])
    parts = state.unionByName(minus).unionByName(added)
    kinds = dict(state.dtypes)
    out = parts.groupBy(*GROUP).agg(*[F.sum(m).cast(kinds[m]).alias(m) for m in MEASURES])
    return out.where("encounters <> 0")


def named_summary(state: DataFrame, star: Mapping[str, DataFrame]) -> DataFrame:
    """The summary by names: those of the dimensions now, whatever they were when a measure was added."""
    ds = star["dim_specialty"].select("specialty_key", "specialty_name")
    det = star["dim_encounter_type"].select("encounter_type_key", F.col("type_name").alias("encounter_type"))
    j = state.join(ds, "specialty_key").join(det, "encounter_type_key")
    total = {m: F.sum(m) for m in MEASURES}
    total["duration_hours"] = F.when(F.sum("timed") > 0, F.sum("duration_hours"))
    out = j.groupBy("year", "month", "specialty_name", "encounter_type")
    return out.agg(*[total[m].alias(m) for m in MEASURES if m != "timed"])


def monthly_summary(star: Mapping[str, DataFrame]) -> DataFrame:
    """Additive monthly measures per specialty and encounter type, to be
    materialised next to the fact (distinct patients are not additive and
    are left to Q1)."""
    return named_summary(summary_state(star["fact_encounters"], star["dim_date"]), star)


def fact_billing(billing: DataFrame, star: Mapping[str, DataFrame], calendar: tuple[str, str] | None = None) -> DataFrame:
    """One row per bill with the encounter's keys (bills of encounters
    that have a fact row); the claim date is keyed against the calendar."""
    start, end = calendar or (None, None)
    keys = star["fact_encounters"].select(
        "encounter_id", "encounter_key", "patient_key", "provider_key", "specialty_key"
    )
    return billing.join(keys, "encounter_id").select(
        "billing_id",
        "encounter_key",
        "patient_key",
        "provider_key",
        "specialty_key",
        date_key(F.col("claim_date"), start, end).alias("claim_date_key"),
        "claim_amount",
        "allowed_amount",
        "claim_status",
    )
