"""Schemas of the source tables and a check of what was read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_LONG, _TEXT, _DATE, _STAMP, _MONEY = T.LongType(), T.StringType(), T.DateType(), T.TimestampNTZType(), T.DecimalType(12, 2)

#: Fixed values of the reference's tables: columns and their types.
_COLUMNS = {
    "patients": {"patient_id": _LONG, "first_name": _TEXT, "last_name": _TEXT, "date_of_birth": _DATE, "gender": _TEXT, "mrn": _TEXT},
    "specialties": {"specialty_id": _LONG, "specialty_name": _TEXT, "specialty_code": _TEXT},
    "departments": {"department_id": _LONG, "department_name": _TEXT, "floor": _LONG, "capacity": _LONG},
    "providers": {"provider_id": _LONG, "first_name": _TEXT, "last_name": _TEXT, "credential": _TEXT, "specialty_id": _LONG, "department_id": _LONG},
    "encounters": {"encounter_id": _LONG, "patient_id": _LONG, "provider_id": _LONG, "encounter_type": _TEXT, "encounter_date": _STAMP,
                   "discharge_date": _STAMP, "department_id": _LONG},
    "diagnoses": {"diagnosis_id": _LONG, "icd10_code": _TEXT, "icd10_description": _TEXT},
    "encounter_diagnoses": {"encounter_diagnosis_id": _LONG, "encounter_id": _LONG, "diagnosis_id": _LONG, "diagnosis_sequence": _LONG},
    "procedures": {"procedure_id": _LONG, "cpt_code": _TEXT, "cpt_description": _TEXT},
    "encounter_procedures": {"encounter_procedure_id": _LONG, "encounter_id": _LONG, "procedure_id": _LONG, "procedure_date": _DATE},
    "billing": {"billing_id": _LONG, "encounter_id": _LONG, "claim_amount": _MONEY, "allowed_amount": _MONEY, "claim_date": _DATE, "claim_status": _TEXT},
}

SOURCE_SCHEMAS: dict[str, T.StructType] = {
    table: T.StructType([T.StructField(c, t) for c, t in {**columns, "last_updated": _STAMP}.items()])
    for table, columns in _COLUMNS.items()
}


def _fits(there: T.DataType, wanted: T.DataType) -> bool:
    """Same kind of value: any whole number, any timestamp, any decimal of the same scale."""
    if isinstance(wanted, T.LongType):
        return isinstance(there, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    if isinstance(wanted, T.TimestampNTZType):
        return isinstance(there, (T.TimestampType, T.TimestampNTZType))
    if isinstance(wanted, T.DecimalType):
        return isinstance(there, T.DecimalType) and there.scale == wanted.scale
    return there == wanted


def check_sources(src: Mapping[str, DataFrame]) -> None:
    """Raise with every missing table, missing column and column of another kind; extra columns are fine.

    Looks at schemas only, no job runs."""
    wrong = [f"{t}: no such table" for t in SOURCE_SCHEMAS if t not in src]
    for table, schema in SOURCE_SCHEMAS.items():
        if table not in src:
            continue
        there = {f.name: f.dataType for f in src[table].schema.fields}
        for f in schema.fields:
            if f.name not in there:
                wrong.append(f"{table}.{f.name}: no such column")
            elif not _fits(there[f.name], f.dataType):
                wrong.append(f"{table}.{f.name}: {there[f.name].simpleString()} instead of {f.dataType.simpleString()}")
    if wrong:
        raise ValueError("source tables do not fit: " + "; ".join(wrong))
