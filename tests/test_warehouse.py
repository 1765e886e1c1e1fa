"""Incremental load properties on the sf0.001 fixtures: equivalence with a
full refresh, idempotence, lag beyond the look-back, invariants, no
orphans, failure audit."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from wardstar.operators import quality as Q
from wardstar.plans.etl import full_refresh, incremental_run
from wardstar.plans.star import STAR_TABLES, natural_bridge_dx, natural_bridge_px, natural_fact
from wardstar.session import checkpoint_dir
from wardstar.sources.fixtures import PRIOR_AS_OF, PRIOR_WATERMARK, prior_sources
from wardstar.sources.snapshots import Warehouse

AS_OF = "2001-08-02"
NEW_WM = dt.datetime(2001, 8, 2)


def _wh(spark):
    return Warehouse(spark, f"{checkpoint_dir(spark)}/test-wh-{uuid.uuid4().hex}", create=True)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def loaded(spark, src_small):
    wh = _wh(spark)
    full_refresh(prior_sources(src_small), wh, PRIOR_AS_OF, dt.datetime.fromisoformat(PRIOR_WATERMARK))
    before = {r.encounter_id: r.encounter_key for r in wh.read("fact_encounters", 1).collect()}
    incremental_run(src_small, wh, AS_OF, NEW_WM)
    ref = _wh(spark)
    full_refresh(src_small, ref, AS_OF, NEW_WM)
    return wh, ref, before


def test_incremental_equals_full_refresh(loaded):
    wh, ref, _ = loaded
    a, b = wh.tables(STAR_TABLES), ref.tables(STAR_TABLES)
    assert _rows(natural_fact(a)) == _rows(natural_fact(b))
    assert _rows(natural_bridge_dx(a)) == _rows(natural_bridge_dx(b))
    assert _rows(natural_bridge_px(a)) == _rows(natural_bridge_px(b))


def test_control_rows(loaded):
    wh, _, _ = loaded
    rows = wh.control().orderBy("control_id").collect()
    assert [(r.control_id, r.load_type, r.status) for r in rows] == [(1, "FULL", "SUCCESS"), (2, "INCREMENTAL", "SUCCESS")]
    assert rows[1].last_watermark == NEW_WM and rows[1].records_processed > 0


def test_invariants_and_orphans(loaded):
    wh, _, _ = loaded
    t = wh.tables(STAR_TABLES)
    uniq = Q.dq_unique(t, Q.STAR_UNIQUE).where("duplicate_keys > 0").collect()
    assert uniq == []
    orphans = Q.dq_orphans(t, Q.STAR_FOREIGN).where("orphan_rows > 0").collect()
    assert orphans == []
    hist = t["dim_patient"].where(~F.col("is_current"))
    assert hist.count() > 0  # Type 2 history exists
    assert hist.where(F.col("end_date") < F.coalesce("start_date", F.col("end_date"))).count() == 0


def test_keys_kept_for_reloaded_facts(spark, loaded, src_small):
    wh, _, before = loaded
    after = {r.encounter_id: r.encounter_key for r in wh.read("fact_encounters", 2).collect()}
    assert all(after[e] == k for e, k in before.items() if e in after)
    m1 = max(before.values())
    assert all(k > m1 for e, k in after.items() if e not in before)
    assert sorted(after.values()) == sorted(set(after.values()))


def test_idempotent_rerun(spark, loaded, src_small):
    wh, _, _ = loaded
    once = _rows(natural_fact(wh.tables(STAR_TABLES)))
    incremental_run(src_small, wh, AS_OF, NEW_WM)
    assert _rows(natural_fact(wh.tables(STAR_TABLES))) == once


def test_lag_beyond_lookback(spark, src_small):
    """A job that lags more than 7 days: the cutoff falls back to the
    watermark, so nothing is deleted without being re-inserted (D8)."""
    wh = _wh(spark)
    old_wm = "2001-07-10 00:00:00"
    full_refresh(prior_sources(src_small, old_wm), wh, "2001-07-10", dt.datetime.fromisoformat(old_wm))
    incremental_run(src_small, wh, AS_OF, NEW_WM)
    ref = _wh(spark)
    full_refresh(src_small, ref, AS_OF, NEW_WM)
    assert _rows(natural_fact(wh.tables(STAR_TABLES))) == _rows(natural_fact(ref.tables(STAR_TABLES)))


def test_failure_is_audited(spark, src_small):
    wh = _wh(spark)
    with pytest.raises(Exception):
        incremental_run(src_small, wh, AS_OF, NEW_WM)  # no previous load
    rows = wh.control().collect()
    assert len(rows) == 1 and rows[0].status == "FAILURE" and rows[0].error_message
    assert wh.latest_success() is None


def _files(wh, table, run):
    import glob

    return glob.glob(f"{wh.path(table, run).removeprefix('file:')}/key_block=*/*.parquet")


def test_incremental_writes_only_touched_blocks(spark, src_small):
    """With small key blocks the fact spans many of them; an incremental run
    writes the touched ones beside the old copies and equals a full refresh."""
    wh = Warehouse(spark, f"{checkpoint_dir(spark)}/test-wh-{uuid.uuid4().hex}", create=True, block_rows=4)
    full_refresh(prior_sources(src_small), wh, PRIOR_AS_OF, dt.datetime.fromisoformat(PRIOR_WATERMARK))
    first = _files(wh, "fact_encounters", 1)
    blocks = len(wh.manifest("fact_encounters", 1))
    assert len(first) <= 4 * blocks  # whatever the tasks
    incremental_run(src_small, wh, AS_OF, NEW_WM)
    assert sorted(_files(wh, "fact_encounters", 1)) == sorted(first)
    from_run = {b.run for b in wh.manifest("fact_encounters", 2)}
    assert from_run == {1, 2}
    ref = _wh(spark)
    full_refresh(src_small, ref, AS_OF, NEW_WM)
    assert _rows(natural_fact(wh.tables(STAR_TABLES))) == _rows(natural_fact(ref.tables(STAR_TABLES)))
    assert _rows(natural_bridge_dx(wh.tables(STAR_TABLES))) == _rows(natural_bridge_dx(ref.tables(STAR_TABLES)))


def test_emptied_block_is_gone(spark):
    wh = Warehouse(spark, f"{checkpoint_dir(spark)}/test-wh-{uuid.uuid4().hex}", create=True, block_rows=10)
    rows = spark.range(1, 31).selectExpr("id as encounter_key", "id * 2 as encounter_id")
    wh.write("fact_encounters", 1, rows)
    # block 1 (keys 10-19) loses every row, block 2 keeps a subset
    kept = spark.range(20, 25).selectExpr("id as encounter_key", "id * 2 as encounter_id")
    wh.write_blocks("fact_encounters", 2, kept, 1, {1, 2})
    assert sorted(r.encounter_key for r in wh.read("fact_encounters", 2).collect()) == [*range(1, 10), *range(20, 25), 30]
    assert wh.read("fact_encounters", 1).count() == 30  # the earlier run reads as it was


def test_failed_run_leaves_old_answers_and_is_repaired(spark, src_small, monkeypatch):
    """A run that dies after the fact was written: readers keep the earlier
    run; the next run, over more changes, equals a full refresh."""
    from wardstar.plans import etl

    wh = _wh(spark)
    full_refresh(prior_sources(src_small), wh, PRIOR_AS_OF, dt.datetime.fromisoformat(PRIOR_WATERMARK))
    old = _rows(natural_fact(wh.tables(STAR_TABLES)))
    part = dict(src_small)
    part["patients"] = src_small["patients"].where("patient_id % 100 <> 3")
    message = "no summary " + "x" * 6000
    monkeypatch.setattr(etl, "named_summary", lambda state, star: (_ for _ in ()).throw(RuntimeError(message)))
    with pytest.raises(RuntimeError):
        incremental_run(part, wh, AS_OF, NEW_WM)
    assert _rows(natural_fact(wh.tables(STAR_TABLES))) == old
    assert wh.control().where("status = 'FAILURE'").first().error_message == message
    monkeypatch.undo()
    incremental_run(src_small, wh, "2001-08-20", dt.datetime(2001, 8, 20))
    ref = _wh(spark)
    full_refresh(src_small, ref, AS_OF, NEW_WM)
    assert _rows(natural_fact(wh.tables(STAR_TABLES))) == _rows(natural_fact(ref.tables(STAR_TABLES)))
    uniq = Q.dq_unique(wh.tables(STAR_TABLES), Q.STAR_UNIQUE).where("duplicate_keys > 0").collect()
    assert uniq == []


def test_late_rows_are_in_the_fixtures(spark, src_small):
    """Rows the prior load could not resolve, so that the equality above covers them."""
    prior = prior_sources(src_small)
    late = {t: src_small[t].count() - prior[t].count() for t in ("specialties", "departments", "diagnoses", "procedures")}
    assert all(n > 0 for n in late.values())
    e = src_small["encounters"].agg(F.min("encounter_date"), F.max("encounter_date")).first()
    assert e[0].year == 1985 and e[1].year == 2102
    for table, key, code in (("encounter_diagnoses", "diagnosis_id", "diagnoses"), ("encounter_procedures", "procedure_id", "procedures")):
        assert prior[table].join(prior[code], key, "left_anti").count() > 0


def test_rename_reloads_no_fact(spark, src_small):
    from wardstar.operators.incremental import late_dimension_dependents
    from wardstar.plans.star import build_star

    prev = build_star(src_small, AS_OF)
    renamed = dict(src_small)
    renamed["specialties"] = src_small["specialties"].withColumn("specialty_name", F.lower("specialty_name"))
    now = build_star(renamed, AS_OF)
    assert late_dimension_dependents(renamed, prev, now).count() == 0


def test_watermark_default_without_success(spark, loaded):
    from wardstar.operators.incremental import read_watermark
    from wardstar.sources.snapshots import CONTROL_SCHEMA

    failed = spark.createDataFrame([(1, "FULL", NEW_WM, NEW_WM, 0, "FAILURE", "x"), (2, "FULL", None, NEW_WM, 0, "SUCCESS", None)], CONTROL_SCHEMA)
    assert read_watermark(failed) == dt.datetime(2000, 1, 1) == read_watermark(None)
    assert read_watermark(loaded[0].control()) == NEW_WM


def test_unknown_members_leave_no_orphans(spark, src_small):
    from wardstar.plans.analytics import q4_revenue_star
    from wardstar.plans.star import build_star

    star = build_star(src_small, AS_OF, unknown_key=-1)
    assert star["fact_encounters"].count() == src_small["encounters"].count()
    facts = [c for c in Q.STAR_FOREIGN if c[0] == "fact_encounters"]
    assert Q.dq_orphans(star, facts).where("orphan_rows > 0").collect() == []
    assert star["dim_provider"].where("provider_key = -1").count() == 1
    total = star["fact_encounters"].agg(F.sum("total_allowed")).first()[0]
    assert q4_revenue_star(star).agg(F.sum("total_allowed")).first()[0] == total


def test_monthly_summary_materialised(spark, loaded):
    from wardstar.plans.summaries import monthly_summary

    wh, _, _ = loaded
    run = wh.latest_success()
    stored = wh.read("monthly_summary", run)
    assert _rows(stored) == _rows(monthly_summary(wh.tables(STAR_TABLES)))


def test_q1_star_counts_patients_not_versions(loaded):
    from wardstar.plans.analytics import q1_monthly_encounters_star

    wh, ref, _ = loaded
    assert _rows(q1_monthly_encounters_star(wh.tables(STAR_TABLES))) == _rows(
        q1_monthly_encounters_star(ref.tables(STAR_TABLES)))
