"""The four analytic questions, each over the OLTP source and over the star.

Shuffle notes (checked with ``explain("formatted")``): no broadcast
hints — Spark broadcasts the small dimensions itself, against
``spark.sql.autoBroadcastJoinThreshold``, from file statistics of stored
tables or (AQE) from measured shuffle sizes, so a dimension that outgrows
the threshold falls back to a sort-merge join.  Each star query then
shuffles only for its aggregation (partial → final ``HashAggregate``) and
its final sort; Q2 also for the encounter join of the two de-duplicated
code lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_label
from ..operators.fact import billing_totals
from ..operators.readmission import READMISSION_TYPE, readmission_flag

TOP_PAIRS = 10  # fixed value of the reference: LIMIT 10


def _provider_specialty(src: dict[str, DataFrame]) -> DataFrame:
    """provider_id → specialty_name (providers ⋈ specialties), small."""
    return (
        src["providers"]
        .select("provider_id", "specialty_id")
        .join(src["specialties"].select("specialty_id", "specialty_name"), "specialty_id")
        .select("provider_id", "specialty_name")
    )


def _padded_month(year: str = "year", month: str = "month"):
    return F.concat(F.col(year).cast("string"), F.lit("-"), F.lpad(F.col(month).cast("string"), 2, "0"))


# ---------------------------------------------------------------- Q1


def q1_monthly_encounters_oltp(src: dict[str, DataFrame]) -> DataFrame:
    """Encounters and distinct patients per month × specialty × type.

    Counted per patient first, then summed: both counts from one pair of plain
    aggregations (``encounter_id`` is the key, so rows are encounters)."""
    e = src["encounters"].join(_provider_specialty(src), "provider_id")
    group = ("month", "specialty_name", "encounter_type")
    per_patient = e.groupBy(
        month_label(F.col("encounter_date")).alias("month"), "specialty_name", "encounter_type", "patient_id"
    ).agg(F.count("encounter_id").alias("n"))
    return (
        per_patient.groupBy(*group)
        .agg(F.sum("n").alias("total_encounters"), F.count("patient_id").alias("unique_patients"))
        .orderBy(*group)
    )


def q1_monthly_encounters_star(star: dict[str, DataFrame]) -> DataFrame:
    """Same question on the fact.

    Facts bind to the patient version current when they were loaded, so Type 2
    history gives one patient several keys (SURVEY D15): facts are counted per
    group and ``patient_key``, keys mapped to ``patient_id``, then counted per
    patient and summed.  A key without a dimension row stands for itself."""
    dd = star["dim_date"].select("date_key", "year", "month")
    ds = star["dim_specialty"].select("specialty_key", "specialty_name")
    det = star["dim_encounter_type"].select("encounter_type_key", "type_name")
    keys = ("encounter_date_key", "specialty_key", "encounter_type_key")
    f = star["fact_encounters"]
    j = f.join(dd, f[keys[0]] == dd["date_key"]).join(ds, keys[1]).join(det, keys[2])
    group = ("year", "month", "specialty_name", "type_name")
    per_key = j.groupBy(*group, "patient_key").agg(F.count(F.lit(1)).alias("n"))
    patients = star["dim_patient"].select("patient_key", "patient_id")
    per_patient = (
        per_key.join(patients, "patient_key", "left")
        .groupBy(*group, F.coalesce("patient_id", "patient_key").alias("patient_id"))
        .agg(F.sum("n").alias("n"))
    )
    return (
        per_patient.groupBy(*group)
        .agg(F.sum("n").alias("total_encounters"), F.count("patient_id").alias("unique_patients"))
        .orderBy(*group)
        .select(
            _padded_month().alias("month"),
            "specialty_name",
            F.col("type_name").alias("encounter_type"),
            "total_encounters",
            "unique_patients",
        )
    )


# ---------------------------------------------------------------- Q2


def _top_pairs(dx: DataFrame, px: DataFrame, key: str) -> DataFrame:
    """Encounters per (icd10_code, cpt_code), top 10 with code tie-breaks.

    Each side is first reduced to distinct (encounter, code) — a partial
    aggregation before the shuffle — so the join yields each
    (encounter, icd, cpt) once and ``count`` equals ``COUNT(DISTINCT)``."""
    pairs = dx.distinct().join(px.distinct(), key)
    return (
        pairs.groupBy("icd10_code", "cpt_code")
        .agg(F.count(F.lit(1)).alias("encounter_count"))
        .orderBy(F.desc("encounter_count"), "icd10_code", "cpt_code")
        .limit(TOP_PAIRS)
    )


def q2_dx_px_pairs_oltp(src: dict[str, DataFrame]) -> DataFrame:
    """Top diagnosis–procedure code pairs by encounters (junction tables)."""
    dcodes = src["diagnoses"].select("diagnosis_id", "icd10_code")
    pcodes = src["procedures"].select("procedure_id", "cpt_code")
    dx = src["encounter_diagnoses"].join(dcodes, "diagnosis_id").select("encounter_id", "icd10_code")
    px = src["encounter_procedures"].join(pcodes, "procedure_id").select("encounter_id", "cpt_code")
    return _top_pairs(dx, px, "encounter_id")


def q2_dx_px_pairs_star(star: dict[str, DataFrame]) -> DataFrame:
    """Same through fact → bridges → code dimensions."""
    keys = star["fact_encounters"].select("encounter_key")
    dd = star["dim_diagnosis"].select("diagnosis_key", "icd10_code")
    dp = star["dim_procedure"].select("procedure_key", "cpt_code")
    dx = (
        star["bridge_encounter_diagnoses"].join(dd, "diagnosis_key").select("encounter_key", "icd10_code")
        .join(keys, "encounter_key", "left_semi")
    )
    px = star["bridge_encounter_procedures"].join(dp, "procedure_key").select("encounter_key", "cpt_code")
    return _top_pairs(dx, px, "encounter_key")


# ---------------------------------------------------------------- Q3


def q3_readmission_oltp(src: dict[str, DataFrame], days: int = 30) -> DataFrame:
    """Share of inpatient stays followed by an inpatient readmission of
    the same patient within ``days`` of discharge, per specialty."""
    e = src["encounters"]
    index_stays = e.where(F.col("encounter_type") == READMISSION_TYPE)
    flagged = readmission_flag(e, probes=index_stays, days=days, flag_col="readmitted")
    j = flagged.join(_provider_specialty(src), "provider_id")
    return (
        j.groupBy("specialty_name")
        .agg(F.avg(F.col("readmitted").cast("int")).alias("readmission_rate"))
        .orderBy(F.desc("readmission_rate"))
    )


def q3_readmission_star(star: dict[str, DataFrame]) -> DataFrame:
    """Same from the precomputed ``is_readmission`` flag."""
    ds = star["dim_specialty"].select("specialty_key", "specialty_name")
    det = star["dim_encounter_type"].where(F.col("type_name") == READMISSION_TYPE).select("encounter_type_key")
    j = star["fact_encounters"].join(det, "encounter_type_key").join(ds, "specialty_key")
    return (
        j.groupBy("specialty_name")
        .agg((F.sum(F.col("is_readmission").cast("int")) / F.count(F.lit(1))).alias("readmission_rate"))
        .orderBy(F.desc("readmission_rate"))
    )


# ---------------------------------------------------------------- Q4


def q4_revenue_oltp(src: dict[str, DataFrame]) -> DataFrame:
    """Allowed amount per encounter month × specialty (bills summed per
    encounter first, then per group)."""
    per_enc = billing_totals(src["billing"]).select("encounter_id", "total_allowed")
    j = per_enc.join(src["encounters"].select("encounter_id", "encounter_date", "provider_id"), "encounter_id").join(
        _provider_specialty(src), "provider_id"
    )
    return (
        j.groupBy(month_label(F.col("encounter_date")).alias("month"), "specialty_name")
        .agg(F.sum("total_allowed").alias("total_allowed"))
        .orderBy("month", F.desc("total_allowed"))
    )


def q4_revenue_star(star: dict[str, DataFrame]) -> DataFrame:
    """Same on the fact; month label unpadded as in the reference
    (``CONCAT(year, '-', month)``), ordered by year and month (SURVEY D6)."""
    dd = star["dim_date"].select("date_key", "year", "month")
    ds = star["dim_specialty"].select("specialty_key", "specialty_name")
    f = star["fact_encounters"]
    j = f.join(dd, f["encounter_date_key"] == dd["date_key"]).join(ds, "specialty_key")
    return (
        j.groupBy("year", "month", "specialty_name")
        .agg(F.sum("total_allowed").alias("total_allowed"))
        .orderBy("year", "month", F.desc("total_allowed"))
        .select(
            F.concat(F.col("year").cast("string"), F.lit("-"), F.col("month").cast("string")).alias("month"),
            "specialty_name",
            "total_allowed",
        )
    )


def q4_revenue_oltp_claim(src: dict[str, DataFrame]) -> DataFrame:
    """Allowed amount per **claim** month × specialty, bill by bill."""
    j = (
        src["billing"].select("encounter_id", "claim_date", "allowed_amount")
        .join(src["encounters"].select("encounter_id", "provider_id"), "encounter_id")
        .join(_provider_specialty(src), "provider_id")
    )
    return (
        j.groupBy(month_label(F.col("claim_date")).alias("month"), "specialty_name")
        .agg(F.sum("allowed_amount").alias("total_allowed"))
        .orderBy("month", F.desc("total_allowed"))
    )


def q4_revenue_star_claim(star: dict[str, DataFrame]) -> DataFrame:
    """Q4d: same on the fact by its claim date key (facts with a claim only)."""
    dd = star["dim_date"].select("date_key", "year", "month")
    ds = star["dim_specialty"].select("specialty_key", "specialty_name")
    f = star["fact_encounters"].where(F.col("claim_date_key").isNotNull())
    j = f.join(dd, f["claim_date_key"] == dd["date_key"]).join(ds, "specialty_key")
    return (
        j.groupBy("year", "month", "specialty_name")
        .agg(F.sum("total_allowed").alias("total_allowed"))
        .select(_padded_month().alias("month"), "specialty_name", "total_allowed")
        .orderBy("month", F.desc("total_allowed"))
    )
