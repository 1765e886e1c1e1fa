"""Build the whole star schema from the source tables (no writes).

``full_refresh`` in ``plans.etl`` publishes the same tables to a snapshot;
this module only wires W1-W14 together so queries can also run against a
star built in-process.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from ..operators import bridges, dims, fact

STAR_TABLES = (
    "dim_date", "dim_patient", "dim_specialty", "dim_department", "dim_provider",
    "dim_encounter_type", "dim_diagnosis", "dim_procedure",
    "fact_encounters", "bridge_encounter_diagnoses", "bridge_encounter_procedures",
)


class LazyStar(Mapping[str, DataFrame]):
    """The star tables, each planned (and its keys assigned) on first use,
    so a query touching three tables does not build all eleven."""

    def __init__(self, src: dict[str, DataFrame], as_of: str, calendar: tuple[str, str] | None = None,
                 load_date: str | None = None, unknown_key: int | None = None):
        self.src, self.as_of, self.unknown_key = src, as_of, unknown_key
        self.load_date = load_date or as_of
        self._calendar = calendar
        self._built: dict[str, DataFrame] = {}

    @property
    def calendar(self) -> tuple[str, str]:
        if self._calendar is None:
            self._calendar = dims.calendar_bounds(self.src)
        return self._calendar

    def _build(self, name: str) -> DataFrame:
        src, spark = self.src, self.src["encounters"].sparkSession
        if name == "dim_date":
            return dims.dim_date(spark, *self.calendar)
        if name == "dim_patient":
            return dims.dim_patient(src["patients"], self.as_of)
        if name == "dim_specialty":
            return dims.dim_specialty(src["specialties"])
        if name == "dim_department":
            return dims.dim_department(src["departments"])
        if name == "dim_provider":
            # specialty and department first, so provider keys resolve
            return dims.dim_provider(src["providers"], self["dim_specialty"], self["dim_department"])
        if name == "dim_encounter_type":
            return dims.dim_encounter_type(src["encounters"])
        if name == "dim_diagnosis":
            return dims.dim_diagnosis(src["diagnoses"])
        if name == "dim_procedure":
            return dims.dim_procedure(src["procedures"])
        if name == "fact_encounters":
            # without a calendar given, the calendar covers every date of the sources
            return fact.fact_encounters(src, self.known, self._calendar, load_date=self.load_date, unknown_key=self.unknown_key)
        if name == "bridge_encounter_diagnoses":
            return bridges.bridge_dx(src["encounter_diagnoses"], self["fact_encounters"], self["dim_diagnosis"])
        if name == "bridge_encounter_procedures":
            return bridges.bridge_px(
                src["encounter_procedures"], self["fact_encounters"], self["dim_procedure"], self._calendar
            )
        raise KeyError(name)

    @property
    def known(self) -> "LazyStar":
        """The star without unknown members, which no source row refers to."""
        return self if self.unknown_key is None else LazyStar(self.src, self.as_of, self._calendar, self.load_date)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            df = self._build(name)
            if self.unknown_key is not None and name.startswith("dim_"):
                df = with_unknown_member(df, self.unknown_key)
            self._built[name] = df
        return self._built[name]

    def materialize(self, name: str, df: DataFrame) -> None:
        """Replace a table by its stored copy, so later tables read it back
        (each table is materialised before the next one reads it)."""
        self._built[name] = df

    def __iter__(self) -> Iterator[str]:
        return iter(STAR_TABLES)

    def __len__(self) -> int:
        return len(STAR_TABLES)


def with_unknown_member(dim: DataFrame, unknown_key: int) -> DataFrame:
    """The dimension with a row for what could not be resolved: its key is
    ``unknown_key``, its texts are 'Unknown', booleans false, all else NULL."""
    key = dim.columns[0]

    def value(f) -> Column:
        if f.name == key:
            v = F.lit(unknown_key)
        elif isinstance(f.dataType, StringType):
            v = F.lit("Unknown")
        elif isinstance(f.dataType, BooleanType):
            v = F.lit(False)
        else:
            v = F.lit(None)
        return v.cast(f.dataType).alias(f.name)

    row = dim.sparkSession.range(1).select(*[value(f) for f in dim.schema.fields])
    return dim.unionByName(row)


def build_star(
    src: dict[str, DataFrame],
    as_of: str,
    calendar: tuple[str, str] | None = None,
    load_date: str | None = None,
    unknown_key: int | None = None,
) -> LazyStar:
    """``unknown_key`` (e.g. -1) keeps facts with unresolved references and gives every dimension an unknown member."""
    return LazyStar(src, as_of, calendar, load_date, unknown_key)


def natural_fact(star: Mapping[str, DataFrame]) -> DataFrame:
    """The fact with every surrogate key replaced by its natural key (and
    calendar keys by dates): comparable across loads whose keys differ."""
    f = star["fact_encounters"]
    dd = star["dim_date"].select("date_key", "calendar_date")

    def day(col: str, alias: str) -> DataFrame:
        return dd.select(F.col("date_key").alias(col), F.col("calendar_date").alias(alias))

    return (
        f.join(star["dim_patient"].select("patient_key", "patient_id"), "patient_key", "left")
        .join(star["dim_provider"].select("provider_key", "provider_id"), "provider_key", "left")
        .join(star["dim_specialty"].select("specialty_key", "specialty_id"), "specialty_key", "left")
        .join(star["dim_department"].select("department_key", "department_id"), "department_key", "left")
        .join(star["dim_encounter_type"].select("encounter_type_key", F.col("type_name").alias("encounter_type")),
              "encounter_type_key", "left")
        .join(day("encounter_date_key", "encounter_day"), "encounter_date_key", "left")
        .join(day("discharge_date_key", "discharge_day"), "discharge_date_key", "left")
        .join(day("claim_date_key", "claim_day"), "claim_date_key", "left")
        .select(*NATURAL_FACT_COLUMNS)
    )


NATURAL_FACT_COLUMNS = (
    "encounter_id", "patient_id", "provider_id", "specialty_id", "department_id", "encounter_type",
    "encounter_day", "discharge_day", "claim_day", "diagnosis_count", "procedure_count",
    "total_allowed", "claim_amount", "encounter_duration_hours", "is_readmission",
)


def natural_bridge_dx(star: Mapping[str, DataFrame]) -> DataFrame:
    return (
        star["bridge_encounter_diagnoses"]
        .join(star["fact_encounters"].select("encounter_key", "encounter_id"), "encounter_key")
        .join(star["dim_diagnosis"].select("diagnosis_key", "diagnosis_id"), "diagnosis_key")
        .select("encounter_id", "diagnosis_id", "diagnosis_sequence")
    )


def natural_bridge_px(star: Mapping[str, DataFrame]) -> DataFrame:
    return (
        star["bridge_encounter_procedures"]
        .join(star["fact_encounters"].select("encounter_key", "encounter_id"), "encounter_key")
        .join(star["dim_procedure"].select("procedure_key", "procedure_id"), "procedure_key")
        .join(star["dim_date"].select(F.col("date_key").alias("procedure_date_key"),
                                      F.col("calendar_date").alias("procedure_date")), "procedure_date_key")
        .select("encounter_id", "procedure_id", "procedure_date")
    )
