"""

``entry(spark)`` runs the flagship query (30-day readmission rate by
specialty, computed through the star schema) on sf0.001; ``queries()``
``(spark, sf_dir) -> DataFrame``; ``oracle_sql()`` gives the DuckDB SQL
for the same result over the driver's parquet views.
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardstar.plans import analytics as A  # noqa: E402
from wardstar.plans.star import build_star  # noqa: E402
from wardstar.sources.fixtures import load_sources  # noqa: E402

AS_OF = "2001-08-02"  # fixed run date of the fixtures (FIXTURES.md)
SMOKE_DIR = "/root/testdata/sf0.001"


def _src(spark: SparkSession, sf_dir: str):
    return load_sources(spark, sf_dir)


def _star(spark: SparkSession, sf_dir: str):
    return build_star(_src(spark, sf_dir), AS_OF)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: Q3 through the star (dims → fact with readmission flag)."""
    return A.q3_readmission_star(_star(spark, SMOKE_DIR))


def _oltp(fn):
    return lambda spark, sf_dir: fn(_src(spark, sf_dir))


def _on_star(fn):
    return lambda spark, sf_dir: fn(_star(spark, sf_dir))


def _table(name: str):
    return lambda spark, sf_dir: _star(spark, sf_dir)[name]


def _readmission(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardstar.operators.readmission import readmission_flag

    e = _src(spark, sf_dir)["encounters"]
    return readmission_flag(e).select(
        "encounter_id", "patient_id", "encounter_type", "encounter_date", "discharge_date", "is_readmission"
    )


def _encounter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardstar.operators.fact import encounter_counts

    src = _src(spark, sf_dir)
    return encounter_counts(src["encounter_diagnoses"], src["encounter_procedures"])


# ---------------------------------------------------------------- incremental scenario
# Prior state = sources as of PRIOR_WATERMARK (FIXTURES.md §3), loaded by a
# full refresh on PRIOR_AS_OF; the new state = the full sources on AS_OF.


def _stored_src(spark: SparkSession, sf_dir: str):
    """The sources of a load, which reads each of them many times."""
    from wardstar.sources.fixtures import DERIVED_TABLES

    return load_sources(spark, sf_dir, stored=DERIVED_TABLES)


def _prior(spark: SparkSession, sf_dir: str, sources=_src):
    from wardstar.sources.fixtures import PRIOR_AS_OF, prior_sources

    src = sources(spark, sf_dir)
    return src, build_star(prior_sources(src), PRIOR_AS_OF)


def _prior_control(spark: SparkSession):
    import datetime as dt

    from wardstar.sources.fixtures import PRIOR_AS_OF, PRIOR_WATERMARK
    from wardstar.sources.snapshots import CONTROL_SCHEMA

    row = (1, "FULL", dt.datetime.fromisoformat(PRIOR_WATERMARK),
           dt.datetime.fromisoformat(PRIOR_AS_OF + " 00:00:00"), None, "SUCCESS", None)
    return spark.createDataFrame([row], CONTROL_SCHEMA)


def _cutoff(spark: SparkSession):
    from wardstar.operators import incremental as I

    return I.cutoff_for(I.read_watermark(_prior_control(spark)), AS_OF, 7)


def _affected_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardstar.operators import incremental as I

    return I.affected_set(_src(spark, sf_dir), _cutoff(spark))


def _affected_set_readmission(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardstar.operators import incremental as I

    src, prev = _prior(spark, sf_dir)
    aff = I.affected_set(src, _cutoff(spark))
    return I.widen_for_readmission(aff, src, prev["fact_encounters"], prev)


def _affected_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardstar.operators import incremental as I
    from wardstar.plans.star import natural_fact

    src, prev = _prior(spark, sf_dir)
    aff = I.affected_set(src, _cutoff(spark))
    view = dict(prev)
    view["fact_encounters"] = I.affected_delete(prev["fact_encounters"], aff)
    return natural_fact(view)


def _incremental_star(spark: SparkSession, sf_dir: str):
    from wardstar.plans.etl import incremental_tables
    from wardstar.plans.star import STAR_TABLES
    from wardstar.session import staged

    src, prev = _prior(spark, sf_dir, _stored_src)
    for name in STAR_TABLES:
        if not name.startswith("bridge_"):  # a bridge is read once
            prev.materialize(name, staged(prev[name], name))
    out, _ = incremental_tables(prev, _prior_control(spark), src, AS_OF)
    return out


def _fact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardstar.plans.star import natural_fact

    return natural_fact(_incremental_star(spark, sf_dir))


def _bridge_dx_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardstar.plans.star import natural_bridge_dx

    return natural_bridge_dx(_incremental_star(spark, sf_dir))


def _bridge_px_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardstar.plans.star import natural_bridge_px

    return natural_bridge_px(_incremental_star(spark, sf_dir))


def _scd2_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from wardstar.functions.dates import age_group, lit_ts
    from wardstar.operators.dims import PATIENT_ATTRS
    from wardstar.operators.scd import scd2
    from wardstar.sources.fixtures import PRIOR_WATERMARK

    src, prev = _prior(spark, sf_dir)
    changes = src["patients"].where(F.col("last_updated") > lit_ts(PRIOR_WATERMARK))
    return scd2(prev["dim_patient"], changes, "patient_id", "patient_key", PATIENT_ATTRS, AS_OF,
                derived={"age_group": lambda day: age_group(F.col("date_of_birth"), day)})


def _type1_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardstar.operators.dims import dim_diagnosis
    from wardstar.operators.scd import type1_upsert

    src = _src(spark, sf_dir)
    prior = dim_diagnosis(src["diagnoses_v1"])
    return type1_upsert(prior, src["diagnoses"], "diagnosis_id", "diagnosis_key",
                        ["icd10_code", "icd10_description"])


def _stamp_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from wardstar.operators.scd import stamp_changes
    from wardstar.sources.fixtures import PRIOR_WATERMARK

    src = _src(spark, sf_dir)
    prev = src["patients_v1"].withColumn("last_updated", F.lit(PRIOR_WATERMARK).cast("timestamp_ntz"))
    curr = src["patients"].drop("last_updated")
    return stamp_changes(prev, curr, ["patient_id"], AS_OF + " 00:00:00")


def _schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardstar.functions.dates import OPEN_END_DATE
    from wardstar.operators.scd import evolve

    v0 = _star(spark, sf_dir)["dim_patient"].drop("start_date", "end_date", "is_current")
    return evolve(v0, {"start_date": ("date", None), "end_date": ("date", OPEN_END_DATE),
                       "is_current": ("boolean", True)})


def _surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardstar.functions.keys import dense_keys

    ed = _src(spark, sf_dir)["encounter_diagnoses"].select("encounter_id", "diagnosis_sequence", "diagnosis_id")
    return dense_keys(ed, ["encounter_id", "diagnosis_sequence", "diagnosis_id"], "row_key")


def _warehouse(spark: SparkSession):
    import uuid

    from wardstar.session import checkpoint_dir
    from wardstar.sources.snapshots import Warehouse

    return Warehouse(spark, f"{checkpoint_dir(spark)}/wardstar-warehouse-{uuid.uuid4().hex}", create=True)


def _full_then_incremental(spark: SparkSession, sf_dir: str):
    import datetime as dt

    from wardstar.plans.etl import full_refresh, incremental_run
    from wardstar.sources.fixtures import PRIOR_AS_OF, PRIOR_WATERMARK, prior_sources

    src = _stored_src(spark, sf_dir)
    wh = _warehouse(spark)
    full_refresh(prior_sources(src), wh, PRIOR_AS_OF, dt.datetime.fromisoformat(PRIOR_WATERMARK))
    incremental_run(src, wh, AS_OF, dt.datetime.fromisoformat(AS_OF + " 00:00:00"))
    return wh


def _watermark_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W16 over a control table with one row per source table, stamped with the
    table's latest change: the encounters' row failed, the departments' has no
    watermark, the others succeeded."""
    from functools import reduce

    from pyspark.sql import functions as F

    from wardstar.operators.incremental import watermark_frame
    from wardstar.sources.fixtures import SOURCE_TABLES
    from wardstar.sources.snapshots import CONTROL_SCHEMA

    src = _src(spark, sf_dir)

    def row(number: int, name: str) -> DataFrame:
        stamp = F.max("last_updated") if name != "departments" else F.lit(None)
        made = src[name].agg(stamp.alias("last_watermark")).select(
            F.lit(number).alias("control_id"), F.lit("INCREMENTAL").alias("load_type"), "last_watermark",
            F.lit(None).alias("load_date"), F.lit(0).alias("records_processed"),
            F.lit("FAILURE" if name == "encounters" else "SUCCESS").alias("status"), F.lit(None).alias("error_message"),
        )
        return made.select(*[F.col(f.name).cast(f.dataType) for f in CONTROL_SCHEMA.fields])

    return watermark_frame(reduce(DataFrame.unionAll, [row(i, t) for i, t in enumerate(SOURCE_TABLES, 1)]))


def _etl_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_then_incremental(spark, sf_dir).control()


def _incremental_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardstar.plans.star import STAR_TABLES, natural_fact

    return natural_fact(_full_then_incremental(spark, sf_dir).tables(STAR_TABLES))


def _refreshed(spark: SparkSession, sf_dir: str):
    import datetime as dt

    from wardstar.plans.etl import full_refresh
    from wardstar.sources.fixtures import PRIOR_WATERMARK

    wh = _warehouse(spark)
    full_refresh(_src(spark, sf_dir), wh, AS_OF, dt.datetime.fromisoformat(PRIOR_WATERMARK))
    return wh


def _full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir).tables(("fact_encounters",))["fact_encounters"]


def _full_refresh_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every published table: its rows and the sum of its key column."""
    from functools import reduce

    from pyspark.sql import functions as F

    from wardstar.plans.star import STAR_TABLES

    tables = _refreshed(spark, sf_dir).tables(STAR_TABLES)
    return reduce(DataFrame.unionAll, [
        df.agg(F.count("*").alias("row_count"), F.sum(df.columns[0]).alias("key_sum"))
        .select(F.lit(name).alias("table_name"), "row_count", "key_sum")
        for name, df in tables.items()
    ])


# ---------------------------------------------------------------- quality and extras


def _dq(kind: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from wardstar.operators import quality as Q

        src = _src(spark, sf_dir)
        star = build_star(src, AS_OF)
        tables = {**src, **{t: star[t] for t in star}}
        if kind == "unique":
            return Q.dq_unique(tables, Q.SOURCE_UNIQUE + Q.STAR_UNIQUE)
        if kind == "orphans":
            return Q.dq_orphans(tables, Q.SOURCE_FOREIGN + Q.STAR_FOREIGN)
        return Q.dq_nulls(tables, Q.STAR_NOT_NULL)

    return run


def _dq_missing_discharge(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardstar.operators.quality import dq_missing_discharge

    return dq_missing_discharge(_src(spark, sf_dir)["encounters"])


def _reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardstar.operators.quality import reconcile_counts

    src = _src(spark, sf_dir)
    return reconcile_counts(src, build_star(src, AS_OF))


def _readmission_same_specialty(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardstar.operators.readmission import readmission_flag

    src = _src(spark, sf_dir)
    e = src["encounters"].join(src["providers"].select("provider_id", "specialty_id"), "provider_id")
    return readmission_flag(e, match_cols=("patient_id", "specialty_id")).select(
        "encounter_id", "patient_id", "specialty_id", "is_readmission"
    )


def _fact_unknown_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_star(_src(spark, sf_dir), AS_OF, unknown_key=-1)["fact_encounters"]


def _monthly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardstar.plans.summaries import monthly_summary

    return monthly_summary(_star(spark, sf_dir))


def _fact_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardstar.plans.summaries import fact_billing

    src = _src(spark, sf_dir)
    star = build_star(src, AS_OF)
    return fact_billing(src["billing"], star)


def _comparable(fn):
    """Money leaves as double and calendar dates as midnight timestamps
    (storage keeps decimal(12,2) and date), so the cross-engine comparison
    sees identical values whatever the result conversion."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from pyspark.sql import functions as F
        from pyspark.sql.types import DateType, DecimalType

        df = fn(spark, sf_dir)

        def out(f):
            if isinstance(f.dataType, DecimalType):
                return F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, DateType) and f.name != "end_date":
                # (the open end date 9999-12-31 stays a date: no pandas timestamp holds it)
                return F.col(f.name).cast("timestamp_ntz").alias(f.name)
            return F.col(f.name)

        return df.select(*[out(f) for f in df.schema.fields])

    return run


def _optional(module: str):
    """A module of the training-data subpackage, or None where it is not installed."""
    try:
        return importlib.import_module(module)
    except ModuleNotFoundError as missing:
        if missing.name not in ("wardstar.llm", module):
            raise
        return None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {k: _comparable(fn) for k, fn in _queries().items()}
    if llm := _optional("wardstar.llm.registry"):
        out.update(llm.queries())
    if pipeline := _optional("corpus_pipeline"):
        out["pipeline"] = pipeline.run
    return out


def _queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "q1_monthly_encounters_oltp": _oltp(A.q1_monthly_encounters_oltp),
        "q1_monthly_encounters_star": _on_star(A.q1_monthly_encounters_star),
        "q2_dx_px_pairs_oltp": _oltp(A.q2_dx_px_pairs_oltp),
        "q2_dx_px_pairs_star": _on_star(A.q2_dx_px_pairs_star),
        "q3_readmission_oltp": _oltp(A.q3_readmission_oltp),
        "q3_readmission_star": _on_star(A.q3_readmission_star),
        "q4_revenue_oltp": _oltp(A.q4_revenue_oltp),
        "q4_revenue_star": _on_star(A.q4_revenue_star),
        "q4_revenue_oltp_claim": _oltp(A.q4_revenue_oltp_claim),
        "q4_revenue_star_claim": _on_star(A.q4_revenue_star_claim),
    }
    for t in (
        "dim_date", "dim_patient", "dim_specialty", "dim_department", "dim_provider",
        "dim_encounter_type", "dim_diagnosis", "dim_procedure", "fact_encounters",
    ):
        q[t] = _table(t)
    q["bridge_dx"] = _table("bridge_encounter_diagnoses")
    q["bridge_px"] = _table("bridge_encounter_procedures")
    q["encounter_counts"] = _encounter_counts
    q["readmission_flag"] = _readmission
    q["surrogate_keys"] = _surrogate_keys
    q["schema_evolution"] = _schema_evolution
    q["stamp_changes"] = _stamp_changes
    q["type1_upsert"] = _type1_upsert
    q["scd2_patient"] = _scd2_patient
    q["affected_set"] = _affected_set
    q["affected_set_readmission"] = _affected_set_readmission
    q["affected_delete"] = _affected_delete
    q["fact_incremental"] = _fact_incremental
    q["bridge_dx_incremental"] = _bridge_dx_incremental
    q["bridge_px_incremental"] = _bridge_px_incremental
    q["watermark_read"] = _watermark_read
    q["full_refresh"] = _full_refresh
    q["full_refresh_tables"] = _full_refresh_tables
    q["incremental_run"] = _incremental_run
    q["etl_control"] = _etl_control
    q["dq_unique"] = _dq("unique")
    q["dq_orphans"] = _dq("orphans")
    q["dq_nulls"] = _dq("nulls")
    q["dq_missing_discharge"] = _dq_missing_discharge
    q["reconcile_counts"] = _reconcile_counts
    q["readmission_flag_same_specialty"] = _readmission_same_specialty
    q["fact_encounters_unknown_keys"] = _fact_unknown_keys
    q["monthly_summary"] = _monthly_summary
    q["fact_billing"] = _fact_billing
    return q


def oracle_sql() -> dict[str, str]:
    from oracle_sql import ORACLES

    out = {k: ORACLES[k] for k in _queries() if k in ORACLES}
    if llm := _optional("wardstar.llm.registry"):
        out.update(llm.oracles())
    pipeline = _optional("corpus_pipeline")
    if pipeline and pipeline.ORACLE_SQL:
        out["pipeline"] = pipeline.ORACLE_SQL
    return out
