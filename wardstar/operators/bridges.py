"""Many-to-many bridges.

The junction rows are reduced to one row per (encounter, code) *before*
the fact join — a partial aggregation that collapses duplicated rows
map-side — and only then joined to the fact's (encounter_id →
encounter_key) map.  Code dimensions are small; Spark broadcasts them when
their measured size is under the broadcast threshold.  Grouping by (encounter_id, code id) equals the reference's grouping
by (encounter_key, code key) because both maps are one-to-one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key


def bridge_dx(encounter_diagnoses: DataFrame, fact: DataFrame, dim_diagnosis: DataFrame) -> DataFrame:
    """Lowest diagnosis sequence per (encounter, diagnosis)."""
    per_pair = encounter_diagnoses.groupBy("encounter_id", "diagnosis_id").agg(
        F.min("diagnosis_sequence").alias("diagnosis_sequence")
    )
    keys = dim_diagnosis.select("diagnosis_id", "diagnosis_key")
    return (
        per_pair.join(fact.select("encounter_id", "encounter_key"), "encounter_id")
        .join(keys, "diagnosis_id")
        .select("encounter_key", "diagnosis_key", "diagnosis_sequence")
    )


def bridge_px(
    encounter_procedures: DataFrame, fact: DataFrame, dim_procedure: DataFrame, calendar: tuple[str, str] | None = None
) -> DataFrame:
    """Earliest procedure date key per (encounter, procedure); dates
    outside the calendar drop, as with the inner join to ``dim_date``."""
    start, end = calendar or (None, None)
    dated = encounter_procedures.select(
        "encounter_id", "procedure_id", date_key(F.col("procedure_date"), start, end).alias("procedure_date_key")
    ).where(F.col("procedure_date_key").isNotNull())
    per_pair = dated.groupBy("encounter_id", "procedure_id").agg(
        F.min("procedure_date_key").alias("procedure_date_key")
    )
    keys = dim_procedure.select("procedure_id", "procedure_key")
    return (
        per_pair.join(fact.select("encounter_id", "encounter_key"), "encounter_id")
        .join(keys, "procedure_id")
        .select("encounter_key", "procedure_key", "procedure_date_key")
    )
