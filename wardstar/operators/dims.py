"""Dimension builders (W1-W8): calendar, patient, provider and code dimensions.

Every dimension gets a dense surrogate key ordered by its natural key
(``functions.keys.dense_keys``), the distributed equivalent of the
reference's ``AUTO_INCREMENT`` over an ordered insert.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import (
    OPEN_END_DATE,
    REFERENCE_CALENDAR,
    age_group,
    date_key,
    lit_date,
    weekday_mon1,
)
from ..functions.keys import dense_keys

PATIENT_ATTRS = ("first_name", "last_name", "date_of_birth", "gender", "mrn")


def dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day of ``[start, end]`` (both inclusive).

    ``date_key`` is the day number from a fixed epoch (``functions.dates``), in
    calendar order.  Rows come from a distributed ``range``.
    """
    d0 = _dt.date.fromisoformat(start)
    n = (_dt.date.fromisoformat(end) - d0).days + 1
    day = F.date_add(lit_date(d0), F.col("id").cast("int"))
    return spark.range(0, n).select(
        date_key(day).alias("date_key"),
        day.alias("calendar_date"),
    ).select(
        "date_key",
        "calendar_date",
        F.year("calendar_date").alias("year"),
        F.month("calendar_date").alias("month"),
        F.quarter("calendar_date").alias("quarter"),
        weekday_mon1(F.col("calendar_date")).alias("day_of_week"),
        F.lit(False).alias("is_holiday"),
    )


def calendar_bounds(src: Mapping[str, DataFrame], cover: tuple[str, str] = REFERENCE_CALENDAR) -> tuple[str, str]:
    """Calendar covering ``cover`` (default: the reference's 2000-01-01 to
    2101-01-01) and every date in the sources (whole years), so no fact falls
    off the calendar.  One-row aggregate, read on the driver."""
    dates = None
    for table, cols in (
        ("encounters", ("encounter_date", "discharge_date")),
        ("encounter_procedures", ("procedure_date",)),
        ("billing", ("claim_date",)),
    ):
        days = F.array(*[F.col(c).cast("date") for c in cols])
        part = src[table].select(F.array_min(days).alias("lo"), F.array_max(days).alias("hi"))
        dates = part if dates is None else dates.unionByName(part)
    row = dates.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    start = _dt.date.fromisoformat(cover[0])
    end = _dt.date.fromisoformat(cover[1])
    if row["lo"] is not None:
        start = min(start, _dt.date(row["lo"].year, 1, 1))
    if row["hi"] is not None:
        end = max(end, _dt.date(row["hi"].year, 12, 31))
    return start.isoformat(), end.isoformat()


def build_dim(src: DataFrame, natural_key: str, attrs: Sequence[str], key_col: str) -> DataFrame:
    """Project the source row and number it by natural key."""
    keyed = dense_keys(src.select(natural_key, *attrs), [natural_key], key_col)
    return keyed.select(key_col, natural_key, *attrs)


def dim_specialty(specialties: DataFrame) -> DataFrame:
    return build_dim(specialties, "specialty_id", ["specialty_name", "specialty_code"], "specialty_key")


def dim_department(departments: DataFrame) -> DataFrame:
    return build_dim(departments, "department_id", ["department_name", "floor", "capacity"], "department_key")


def dim_diagnosis(diagnoses: DataFrame) -> DataFrame:
    return build_dim(diagnoses, "diagnosis_id", ["icd10_code", "icd10_description"], "diagnosis_key")


def dim_procedure(procedures: DataFrame) -> DataFrame:
    return build_dim(procedures, "procedure_id", ["cpt_code", "cpt_description"], "procedure_key")


def encounter_types(encounters: DataFrame) -> DataFrame:
    """Distinct non-null encounter types (``SELECT DISTINCT … IS NOT NULL``)."""
    return (
        encounters.where(F.col("encounter_type").isNotNull())
        .select(F.col("encounter_type").alias("type_name"))
        .distinct()
    )


def dim_encounter_type(encounters: DataFrame) -> DataFrame:
    """Keyed by type name (the natural key of this dimension)."""
    keyed = dense_keys(encounter_types(encounters), ["type_name"], "encounter_type_key")
    return keyed.select("encounter_type_key", "type_name")


def patient_rows(patients: DataFrame, as_of: Column) -> DataFrame:
    """Patient attributes plus the age band as of ``as_of``."""
    return patients.select(
        "patient_id",
        *PATIENT_ATTRS,
        age_group(F.col("date_of_birth"), as_of).alias("age_group"),
    )


def dim_patient(patients: DataFrame, as_of: str) -> DataFrame:
    """Full-load patient dimension.  Full-load rows are current, with an
    open start (NULL) and the open end date ``9999-12-31``."""
    rows = patient_rows(patients, lit_date(as_of)).select(
        "*",
        F.lit(None).cast("date").alias("start_date"),
        lit_date(OPEN_END_DATE).alias("end_date"),
        F.lit(True).alias("is_current"),
    )
    keyed = dense_keys(rows, ["patient_id"], "patient_key")
    return keyed.select(
        "patient_key", "patient_id", *PATIENT_ATTRS, "age_group", "start_date", "end_date", "is_current"
    )


def provider_rows(providers: DataFrame, dim_spec: DataFrame, dim_dept: DataFrame) -> DataFrame:
    """Provider attributes with specialty/department keys resolved (left
    joins, so a provider is kept even when a key cannot be resolved)."""
    spec = dim_spec.select("specialty_id", "specialty_key")
    dept = dim_dept.select("department_id", "department_key")
    return (
        providers.join(spec, "specialty_id", "left")
        .join(dept, "department_id", "left")
        .select("provider_id", "first_name", "last_name", "credential", "specialty_key", "department_key")
    )


def dim_provider(providers: DataFrame, dim_spec: DataFrame, dim_dept: DataFrame) -> DataFrame:
    """Provider dimension with resolved keys."""
    keyed = dense_keys(provider_rows(providers, dim_spec, dim_dept), ["provider_id"], "provider_key")
    return keyed.select(
        "provider_key", "provider_id", "first_name", "last_name", "credential", "specialty_key", "department_key"
    )
