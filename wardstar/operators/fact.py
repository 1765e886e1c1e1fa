"""Encounter-grain fact (W9-W12) with pre-aggregated measures.

Plan shape (per encounter stream): the readmission flag is computed on a
(patient, bucket) partitioning; the patient key join shuffles on
``patient_id`` (unless the dimension is under the broadcast threshold);
provider, department and type keys come from small dimensions that Spark
broadcasts by their measured size; the three
encounter-keyed measures (billing totals, diagnosis and procedure counts)
are each pre-aggregated on ``encounter_id`` before they are joined, and
all three joins share one ``encounter_id`` partitioning.  Calendar keys are
day numbers from a fixed epoch, equal to joining ``dim_date``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key, hours_between, lit_date
from ..functions.keys import dense_keys
from .readmission import readmission_flag

FACT_COLUMNS = (
    "encounter_key", "encounter_id", "patient_key", "provider_key", "specialty_key", "department_key",
    "encounter_type_key", "encounter_date_key", "discharge_date_key", "claim_date_key",
    "diagnosis_count", "procedure_count", "total_allowed", "claim_amount",
    "encounter_duration_hours", "is_readmission", "load_date",
)


def encounter_counts(encounter_diagnoses: DataFrame, encounter_procedures: DataFrame) -> DataFrame:
    """Diagnosis and procedure rows per encounter (0 when absent)."""
    dx = encounter_diagnoses.groupBy("encounter_id").agg(F.count(F.lit(1)).alias("diagnosis_count"))
    px = encounter_procedures.groupBy("encounter_id").agg(F.count(F.lit(1)).alias("procedure_count"))
    return dx.join(px, "encounter_id", "full").select(
        "encounter_id",
        F.coalesce("diagnosis_count", F.lit(0)).cast("int").alias("diagnosis_count"),
        F.coalesce("procedure_count", F.lit(0)).cast("int").alias("procedure_count"),
    )


def billing_totals(billing: DataFrame) -> DataFrame:
    """Bills summed per encounter, earliest claim date."""
    return billing.groupBy("encounter_id").agg(
        F.sum("allowed_amount").alias("total_allowed"),
        F.sum("claim_amount").alias("claim_amount"),
        F.min("claim_date").alias("claim_date"),
    )


def fact_rows(
    encounters: DataFrame,
    src: dict[str, DataFrame],
    dims: dict[str, DataFrame],
    calendar: tuple[str, str] | None,
    load_date: str | None,
    all_encounters: DataFrame | None = None,
    unknown_key: int | None = None,
) -> DataFrame:
    """Fact rows (without ``encounter_key``) for ``encounters``.

    ``all_encounters`` is the candidate set for the readmission look-ahead
    (default: ``encounters``).  Inner-join semantics of the reference drop
    encounters whose patient, provider, specialty, department, type,
    encounter date or discharge date does not resolve; with
    ``unknown_key`` set, every unresolved required reference (including a
    missing or out-of-calendar encounter/discharge date) gets that key
    instead and no encounter is dropped (SURVEY X3).  ``calendar=None``: the
    calendar covers every date.
    """
    start, end = calendar or (None, None)
    candidates = encounters if all_encounters is None else all_encounters
    e = readmission_flag(candidates, probes=encounters)

    def resolve(df: DataFrame, side: DataFrame, on: str, cols: list[str]) -> DataFrame:
        if unknown_key is None:
            return df.join(side, on, "inner")
        out = df.join(side, on, "left")
        for c in cols:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(unknown_key).cast("long")))
        return out

    patients = dims["dim_patient"].where("is_current").select("patient_id", "patient_key")
    providers = dims["dim_provider"].select("provider_id", "provider_key", "specialty_key")
    if unknown_key is None:
        providers = providers.where(F.col("specialty_key").isNotNull())
    departments = dims["dim_department"].select("department_id", "department_key")
    types = dims["dim_encounter_type"].select(F.col("type_name").alias("encounter_type"), "encounter_type_key")

    e = resolve(e, patients, "patient_id", ["patient_key"])
    e = resolve(e, providers, "provider_id", ["provider_key", "specialty_key"])
    e = resolve(e, departments, "department_id", ["department_key"])
    e = resolve(e, types, "encounter_type", ["encounter_type_key"])

    e = e.withColumn("encounter_date_key", date_key(F.col("encounter_date"), start, end)).withColumn(
        "discharge_date_key", date_key(F.col("discharge_date"), start, end)
    )
    if unknown_key is None:
        e = e.where(F.col("encounter_date_key").isNotNull() & F.col("discharge_date_key").isNotNull())
    else:
        for c in ("encounter_date_key", "discharge_date_key"):
            e = e.withColumn(c, F.coalesce(F.col(c), F.lit(unknown_key).cast("long")))

    counts = encounter_counts(src["encounter_diagnoses"], src["encounter_procedures"])
    bills = billing_totals(src["billing"])
    e = e.join(bills, "encounter_id", "left").join(counts, "encounter_id", "left")
    return e.select(
        "encounter_id", "patient_key", "provider_key", "specialty_key", "department_key",
        "encounter_type_key", "encounter_date_key", "discharge_date_key",
        date_key(F.col("claim_date"), start, end).alias("claim_date_key"),
        F.coalesce("diagnosis_count", F.lit(0)).cast("int").alias("diagnosis_count"),
        F.coalesce("procedure_count", F.lit(0)).cast("int").alias("procedure_count"),
        F.coalesce("total_allowed", F.lit(0)).cast("decimal(22,2)").alias("total_allowed"),
        F.coalesce("claim_amount", F.lit(0)).cast("decimal(22,2)").alias("claim_amount"),
        hours_between(F.col("encounter_date"), F.col("discharge_date")).alias("encounter_duration_hours"),
        "is_readmission",
        (lit_date(load_date) if load_date else F.lit(None).cast("date")).alias("load_date"),
    )


def fact_ids(
    encounters: DataFrame,
    dims: dict[str, DataFrame],
    calendar: tuple[str, str] | None = None,
    unknown_key: int | None = None,
) -> DataFrame:
    """``encounter_id`` of the encounters that get a fact row: what the inner joins of ``fact_rows`` keep, found by
    semi joins of a few narrow columns."""
    if unknown_key is not None:
        return encounters.select("encounter_id")
    start, end = calendar or (None, None)
    days = [date_key(F.col(c), start, end).isNotNull() for c in ("encounter_date", "discharge_date")]
    e = encounters.where(days[0] & days[1])
    types = dims["dim_encounter_type"].select(F.col("type_name").alias("encounter_type"))
    for side, on in (
        (dims["dim_patient"].where("is_current"), "patient_id"),
        (dims["dim_provider"].where(F.col("specialty_key").isNotNull()), "provider_id"),
        (dims["dim_department"], "department_id"),
        (types, "encounter_type"),
    ):
        e = e.join(side.select(on), on, "left_semi")
    return e.select("encounter_id")


def fact_encounters(
    src: dict[str, DataFrame],
    dims: dict[str, DataFrame],
    calendar: tuple[str, str] | None = None,
    load_date: str | None = None,
    unknown_key: int | None = None,
) -> DataFrame:
    """Full-load fact, one row per resolvable encounter, keyed densely by ``encounter_id`` (which is unique).

    Only the ids are numbered, so what is sorted, stored and read twice for
    numbering has one column; the map from id to key then joins the rows on the
    partitioning that their measures use anyway."""
    keys = dense_keys(fact_ids(src["encounters"], dims, calendar, unknown_key), ["encounter_id"], "encounter_key")
    rows = fact_rows(src["encounters"], src, dims, calendar, load_date, unknown_key=unknown_key)
    return rows.join(keys, "encounter_id").select(*FACT_COLUMNS)
