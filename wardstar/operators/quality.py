"""Data-quality reports (S13-S15, X4, X6): the constraints the reference
declares in DDL, re-aimed as checks since Parquet enforces none.

Each report is one DataFrame built from per-table aggregations (one scan
per table for null counts; one grouped aggregation per unique key; one
anti join per foreign key), unioned — nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference DDL: unique keys, foreign keys, NOT NULL.
SOURCE_UNIQUE = (
    ("patients", ("patient_id",)),
    ("patients", ("mrn",)),
    ("specialties", ("specialty_id",)),
    ("departments", ("department_id",)),
    ("providers", ("provider_id",)),
    ("encounters", ("encounter_id",)),
    ("diagnoses", ("diagnosis_id",)),
    ("procedures", ("procedure_id",)),
    ("encounter_diagnoses", ("encounter_diagnosis_id",)),
    ("encounter_procedures", ("encounter_procedure_id",)),
    ("billing", ("billing_id",)),
)
STAR_UNIQUE = (
    ("dim_date", ("date_key",)),
    ("dim_patient", ("patient_key",)),
    # Type 2 history repeats patient_id and mrn: unique among current rows
    ("dim_patient", ("patient_id",), "is_current"),
    ("dim_patient", ("mrn",), "is_current"),
    ("dim_specialty", ("specialty_key",)),
    ("dim_specialty", ("specialty_id",)),
    ("dim_department", ("department_key",)),
    ("dim_department", ("department_id",)),
    ("dim_provider", ("provider_key",)),
    ("dim_provider", ("provider_id",)),
    ("dim_encounter_type", ("encounter_type_key",)),
    ("dim_encounter_type", ("type_name",)),
    ("dim_diagnosis", ("diagnosis_key",)),
    ("dim_diagnosis", ("diagnosis_id",)),
    ("dim_procedure", ("procedure_key",)),
    ("dim_procedure", ("procedure_id",)),
    ("fact_encounters", ("encounter_key",)),
    ("fact_encounters", ("encounter_id",)),
    ("bridge_encounter_diagnoses", ("encounter_key", "diagnosis_key")),
    ("bridge_encounter_procedures", ("encounter_key", "procedure_key")),
)
SOURCE_FOREIGN = (
    ("providers", "specialty_id", "specialties", "specialty_id"),
    ("providers", "department_id", "departments", "department_id"),
    ("encounters", "patient_id", "patients", "patient_id"),
    ("encounters", "provider_id", "providers", "provider_id"),
    ("encounters", "department_id", "departments", "department_id"),
    ("encounter_diagnoses", "encounter_id", "encounters", "encounter_id"),
    ("encounter_diagnoses", "diagnosis_id", "diagnoses", "diagnosis_id"),
    ("encounter_procedures", "encounter_id", "encounters", "encounter_id"),
    ("encounter_procedures", "procedure_id", "procedures", "procedure_id"),
    ("billing", "encounter_id", "encounters", "encounter_id"),
)
STAR_FOREIGN = (
    ("dim_provider", "specialty_key", "dim_specialty", "specialty_key"),
    ("dim_provider", "department_key", "dim_department", "department_key"),
    ("fact_encounters", "patient_key", "dim_patient", "patient_key"),
    ("fact_encounters", "provider_key", "dim_provider", "provider_key"),
    ("fact_encounters", "specialty_key", "dim_specialty", "specialty_key"),
    ("fact_encounters", "department_key", "dim_department", "department_key"),
    ("fact_encounters", "encounter_type_key", "dim_encounter_type", "encounter_type_key"),
    ("fact_encounters", "encounter_date_key", "dim_date", "date_key"),
    ("fact_encounters", "discharge_date_key", "dim_date", "date_key"),
    ("bridge_encounter_diagnoses", "encounter_key", "fact_encounters", "encounter_key"),
    ("bridge_encounter_diagnoses", "diagnosis_key", "dim_diagnosis", "diagnosis_key"),
    ("bridge_encounter_procedures", "encounter_key", "fact_encounters", "encounter_key"),
    ("bridge_encounter_procedures", "procedure_key", "dim_procedure", "procedure_key"),
    ("bridge_encounter_procedures", "procedure_date_key", "dim_date", "date_key"),
)
STAR_NOT_NULL = (
    ("dim_date", ("calendar_date",)),
    ("dim_patient", ("patient_id",)),
    ("dim_specialty", ("specialty_id",)),
    ("dim_department", ("department_id",)),
    ("dim_provider", ("provider_id",)),
    ("dim_diagnosis", ("diagnosis_id",)),
    ("dim_procedure", ("procedure_id",)),
    ("fact_encounters", ("encounter_id",)),
)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dq_unique(tables: Mapping[str, DataFrame], checks: Sequence[tuple]) -> DataFrame:
    """Per unique key ``(table, keys[, row filter])``, how many key
    values repeat and how many excess rows they carry (0/0 = constraint
    holds).  NULL keys are ignored, as a UNIQUE index allows several NULLs."""
    parts = []
    for table, keys, *where in checks:
        present = F.expr(where[0]) if where else F.lit(True)
        for k in keys:
            present = present & F.col(k).isNotNull()
        df = tables[table].where(present)
        dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        parts.append(
            dup.agg(
                F.count(F.lit(1)).alias("duplicate_keys"),
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess_rows"),
            ).select(
                F.lit(table).alias("table_name"),
                F.lit(",".join(keys) + (f" where {where[0]}" if where else "")).alias("key_columns"),
                "duplicate_keys",
                F.col("excess_rows").cast("long").alias("excess_rows"),
            )
        )
    return _union(parts)


def dq_orphans(tables: Mapping[str, DataFrame], checks: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Rows whose non-null foreign key has no parent row."""
    parts = []
    for child, fk, parent, pk in checks:
        keys = tables[parent].select(F.col(pk).alias(fk))
        orphans = tables[child].where(F.col(fk).isNotNull()).select(fk).join(keys, fk, "left_anti")
        parts.append(
            orphans.agg(F.count(F.lit(1)).alias("orphan_rows")).select(
                F.lit(child).alias("child_table"),
                F.lit(fk).alias("fk_column"),
                F.lit(parent).alias("parent_table"),
                "orphan_rows",
            )
        )
    return _union(parts)


def dq_nulls(tables: Mapping[str, DataFrame], checks: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """NULL count per declared NOT NULL column, one scan per table."""
    parts = []
    for table, cols in checks:
        agg = tables[table].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        for c in cols:
            parts.append(
                agg.select(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                           F.col(c).alias("null_rows"))
            )
    return _union(parts)


def dq_missing_discharge(encounters: DataFrame) -> DataFrame:
    """Encounters without a discharge date (the full load drops them)."""
    return encounters.where(F.col("discharge_date").isNull()).select(
        "encounter_id", "patient_id", "provider_id", "encounter_type", "encounter_date"
    )


def reconcile_counts(src: Mapping[str, DataFrame], star: Mapping[str, DataFrame]) -> DataFrame:
    """Source rows vs warehouse rows per entity."""

    def n(df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n"))

    pairs = [
        ("patients", src["patients"], star["dim_patient"].where(F.col("is_current"))),
        ("specialties", src["specialties"], star["dim_specialty"]),
        ("departments", src["departments"], star["dim_department"]),
        ("providers", src["providers"], star["dim_provider"]),
        ("diagnoses", src["diagnoses"], star["dim_diagnosis"]),
        ("procedures", src["procedures"], star["dim_procedure"]),
        ("encounter_types", src["encounters"].where(F.col("encounter_type").isNotNull())
         .select("encounter_type").distinct(), star["dim_encounter_type"]),
        ("encounters", src["encounters"], star["fact_encounters"]),
        ("billed_encounters", src["billing"].select("encounter_id").distinct(),
         star["fact_encounters"].where(F.col("claim_date_key").isNotNull())),
        ("encounter_diagnoses", src["encounter_diagnoses"].select("encounter_id", "diagnosis_id").distinct(),
         star["bridge_encounter_diagnoses"]),
        ("encounter_procedures", src["encounter_procedures"].select("encounter_id", "procedure_id").distinct(),
         star["bridge_encounter_procedures"]),
    ]
    parts = []
    for entity, s, t in pairs:
        parts.append(n(s).select(F.lit(entity).alias("entity"), F.lit("source").alias("side"), "n"))
        parts.append(n(t).select(F.lit(entity).alias("entity"), F.lit("target").alias("side"), "n"))
    counts = _union(parts).groupBy("entity").agg(
        F.sum(F.when(F.col("side") == "source", F.col("n"))).alias("source_rows"),
        F.sum(F.when(F.col("side") == "target", F.col("n"))).alias("target_rows"),
    )
    return counts.withColumn("difference", F.col("source_rows") - F.col("target_rows"))
