"""Stored blocks: reads in proportion to what is asked, exclusive commits, retention, index, maintained summary."""

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from wardstar.operators import quality as Q
from wardstar.operators.scd import scd2_changes
from wardstar.plans import etl
from wardstar.plans.etl import StoredRun, full_refresh, incremental_run
from wardstar.plans.star import STAR_TABLES, natural_bridge_dx, natural_bridge_px, natural_fact
from wardstar.plans.summaries import maintained_state, monthly_summary, summary_state
from wardstar.session import checkpoint_dir
from wardstar.sources.fixtures import PRIOR_AS_OF, PRIOR_WATERMARK, prior_sources
from wardstar.sources.snapshots import BLOCKED, ConcurrentRun, Warehouse, dyadic

AS_OF = "2001-08-02"
NEW_WM = dt.datetime(2001, 8, 2)
PRIOR_WM = dt.datetime.fromisoformat(PRIOR_WATERMARK)


def _wh(spark, **kw):
    return Warehouse(spark, f"{checkpoint_dir(spark)}/test-store-{uuid.uuid4().hex}", create=True, **kw)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _facts(spark, lo, hi, version):
    return spark.range(lo, hi).selectExpr("id as encounter_key", "id * 3 as encounter_id", f"{version} as v")


def _scan(df):
    """Files and rows that the scans of an executed plan read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    files = rows = 0
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        metrics = leaves.apply(i).metrics()
        if metrics.contains("numFiles"):
            files += metrics.apply("numFiles").value()
            rows += metrics.apply("numOutputRows").value()
    return files, rows


def _runs(spark, blocks, runs, size=100):
    """A fact of ``blocks`` blocks, block 3 of which is rewritten by every later run."""
    wh = _wh(spark, block_rows=size)
    wh.write("fact_encounters", 1, _facts(spark, 0, blocks * size, 1))
    for run in range(2, runs + 1):
        wh.write_blocks("fact_encounters", run, _facts(spark, 3 * size, 4 * size, run), run - 1, {3})
    return wh


@pytest.mark.parametrize("runs", [1, 12])
def test_reads_scan_current_copies_only(spark, runs):
    wh = _runs(spark, 20, runs)
    files, rows = _scan(wh.read("fact_encounters", runs))
    assert rows == 2000 and files <= 4 * 20
    ids = spark.createDataFrame([(930,), (1100,), (5,)], "id long")  # 5 is in the range of block 0 and no id there
    blocks = wh.blocks_holding("fact_encounters", runs, ids)
    assert blocks == {0, 3}
    files, rows = _scan(wh.read("fact_encounters", runs, blocks))
    assert rows == 200 and files <= 4 * 2  # whatever the number of runs
    assert wh.read("fact_encounters", runs, {3}).agg(F.min("v"), F.max("v")).first() == (runs, runs)
    assert wh.read("fact_encounters", runs, set()).count() == 0
    assert wh.read("fact_encounters", 1).agg(F.max("v")).first()[0] == 1
    assert wh.max_key("fact_encounters", runs) == 1999


def test_dyadic_covers_a_range_once():
    rnd = random.Random(1)
    for _ in range(200):
        lo = rnd.randrange(-500, 500)
        hi = lo + rnd.randrange(300)
        cut = dyadic(lo, hi)
        for x in range(lo - 3, hi + 4):
            assert sum(x >> level == prefix for level, prefix in cut) == (lo <= x <= hi)


def test_blocks_holding_null_negative_and_distant_ids(spark):
    wh = _wh(spark, block_rows=10)
    rows = [(k, i) for k, i in enumerate([-(2**62), -7, 0, 5, 2**62, 2**62 + 1, 8, 9, 10, 11, 1, 2])]
    wh.write("fact_encounters", 1, spark.createDataFrame(rows, "encounter_key long, encounter_id long"))
    ask = lambda *ids: wh.blocks_holding("fact_encounters", 1, spark.createDataFrame([(i,) for i in ids], "id long"))
    assert ask(1) == {0, 1} and ask(2**62 + 1) == {0} and ask(None) == set() and ask(-(2**63)) == set()
    assert wh.blocks_of_keys("fact_encounters", spark.createDataFrame([(9,), (10,), (25,)], "encounter_key long")) == {0, 1, 2}


def test_two_runs_from_one_base(spark):
    """Interleaved runs: the one that commits second fails cleanly, and its files go with the next vacuum."""
    wh = _wh(spark, block_rows=100)
    seen = []

    def body(wait):
        def run(run_id, base):
            wh.write("fact_encounters", run_id, _facts(spark, 0, 300, run_id))
            if wait:  # a second run starts and commits meanwhile
                seen.append(etl._audited(wh, "FULL", AS_OF, body(False)))
            return NEW_WM, 300

        return run

    first = etl._audited(wh, "FULL", AS_OF, body(False))
    with pytest.raises(ConcurrentRun):
        etl._audited(wh, "FULL", AS_OF, body(True))
    rows = {r["control_id"]: r["status"] for r in wh.control_rows()}
    assert rows == {first: "SUCCESS", 2: "FAILURE", seen[0]: "SUCCESS"} and wh.latest_success() == seen[0] == 3
    assert wh.read("fact_encounters", 3).agg(F.min("v"), F.max("v")).first() == (3, 3)
    assert wh.claim_run() == 4 and wh.claim_run() == 5
    assert sorted(wh.vacuum(keep=2)) == ["fact_encounters/run=2"]
    assert wh.read("fact_encounters", 1).count() == wh.read("fact_encounters", 3).count() == 300


def test_create_does_not_take_over(spark):
    wh = _wh(spark, block_rows=7)
    with pytest.raises(FileExistsError):
        Warehouse(spark, wh.root, create=True)
    assert Warehouse(spark, wh.root).block_rows == 7


def test_vacuum_keeps_what_kept_runs_name(spark):
    wh = _runs(spark, 5, 6)
    for run in range(1, 7):
        assert wh.claim_run() == run
        if run != 4:
            wh.append_control(run, "INCREMENTAL", NEW_WM, NEW_WM, 0, "SUCCESS", base=max(0, run - 1 if run != 5 else 3))
        else:
            wh.append_control(run, "INCREMENTAL", None, NEW_WM, 0, "FAILURE", "x")
    wh.claim_run()  # still at work
    wh.write("fact_encounters", 7, _facts(spark, 0, 10, 7))
    before = {r: _rows(wh.read("fact_encounters", r)) for r in (5, 6)}
    gone = wh.vacuum(keep=2)
    assert sorted(gone) == ["fact_encounters/run=1/key_block=3", "fact_encounters/run=2", "fact_encounters/run=3", "fact_encounters/run=4"]
    assert {r: _rows(wh.read("fact_encounters", r)) for r in (5, 6)} == before
    assert wh.read("fact_encounters", 7).count() == 10
    assert wh.vacuum(keep=2) == [] and len(wh.control_rows()) == 6
    assert wh.store.names("block_manifest/fact_encounters") == ["5.json", "6.json", "7.json"]
    with pytest.raises(ValueError):
        wh.vacuum(keep=0)


@pytest.fixture(scope="module")
def small_blocks(spark, src_small):
    """A prior load and an incremental run over blocks of 64 keys."""
    wh = _wh(spark, block_rows=64)
    full_refresh(prior_sources(src_small), wh, PRIOR_AS_OF, PRIOR_WM)
    incremental_run(src_small, wh, AS_OF, NEW_WM)
    return wh


def test_incremental_run_over_small_blocks_equals_full(spark, src_small, small_blocks):
    ref = _wh(spark)
    full_refresh(src_small, ref, AS_OF, NEW_WM)
    a, b = small_blocks.tables(STAR_TABLES), ref.tables(STAR_TABLES)
    for natural in (natural_fact, natural_bridge_dx, natural_bridge_px):
        assert _rows(natural(a)) == _rows(natural(b))
    current = lambda t: _rows(t["dim_patient"].where("is_current").drop("patient_key", "start_date", "age_group"))
    assert current(a) == current(b)
    assert Q.dq_unique(a, Q.STAR_UNIQUE).where("duplicate_keys > 0").collect() == []
    assert Q.dq_orphans(a, Q.STAR_FOREIGN).where("orphan_rows > 0").collect() == []


def test_dimension_blocks_of_changed_keys_only(spark, small_blocks):
    """Type 2 rewrites the blocks of closed versions and those of new keys, no others."""
    before = {b.block for b in small_blocks.manifest("dim_patient", 1)}
    after = small_blocks.manifest("dim_patient", 2)
    rewritten = {b.block for b in after if b.run == 2}
    old = {r[0]: r[1:] for r in small_blocks.read("dim_patient", 1).collect()}
    new = {r[0]: r[1:] for r in small_blocks.read("dim_patient", 2).collect()}
    assert before <= {b.block for b in after}
    assert rewritten == {k // 64 for k, v in new.items() if old.get(k) != v}


def test_few_changes_rewrite_few_dimension_blocks(spark):
    """Type 2 over 640 stored rows: one closed version and one new key touch two of the eleven blocks."""
    wh = _wh(spark, block_rows=64)
    dim = spark.range(640).selectExpr(
        "id as patient_key", "id + 1000 as patient_id", "concat('n', id) as first_name", "date'2000-01-01' as start_date",
        "date'9999-12-31' as end_date", "true as is_current")
    wh.write("dim_patient", 1, dim)
    store = StoredRun(wh, 2, 1, {"dim_patient": wh.read("dim_patient", 1)})
    changes = spark.createDataFrame([(1100, "new"), (1200, "n200")], "patient_id long, first_name string")  # the second is no change
    out = store.replace("dim_patient", *scd2_changes(
        store.prev["dim_patient"], changes, "patient_id", "patient_key", ["first_name"], AS_OF,
        stored=lambda keys: store.with_keys("dim_patient", keys), start_after=store.last_key("dim_patient")))
    assert {b.block for b in wh.manifest("dim_patient", 2) if b.run == 2} == {1, 10}
    assert out.count() == 641 and out.where("is_current").count() == 640
    got = _rows(out.where("patient_id = 1100").select("patient_key", "first_name", F.col("end_date").cast("string"), "is_current"))
    assert got == [(100, "n100", "2001-08-01", False), (640, "new", "9999-12-31", True)]


def test_summary_reads_no_untouched_block(spark, src_small, monkeypatch):
    """A small change: every scan of the fact and the bridges during the run is of touched blocks."""
    wh = _wh(spark, block_rows=64)
    full_refresh(src_small, wh, AS_OF, NEW_WM)
    later = dt.datetime(2001, 8, 3)
    changed = dict(src_small)
    e = src_small["encounters"]
    some = e.agg(F.min("encounter_id")).first()[0]
    stamp = F.when(F.col("encounter_id") == some, F.lit(later).cast("timestamp_ntz")).otherwise(F.col("last_updated"))
    changed["encounters"] = e.withColumn("last_updated", stamp)
    reads = []
    read = Warehouse.read
    monkeypatch.setattr(Warehouse, "read", lambda self, t, r, blocks=None: reads.append((t, r, blocks)) or read(self, t, r, blocks))
    monkeypatch.setattr(etl, "LOOKBACK_DAYS", 0)
    incremental_run(changed, wh, "2001-08-02", later, lookback_days=0, widen=False)
    touched = {b.block for b in wh.manifest("fact_encounters", 2) if b.run == 2}
    scans = [blocks for t, r, blocks in reads if t == "fact_encounters" and r == 1 and blocks is not None]
    assert scans and set().union(*scans) <= touched and len(touched) < len(wh.manifest("fact_encounters", 1)) / 4
    monkeypatch.undo()
    assert _rows(wh.read("monthly_summary", 2)) == _rows(monthly_summary(wh.tables(STAR_TABLES)))


@pytest.mark.parametrize("seed", range(4))
def test_maintained_summary_equals_recomputed(spark, seed):
    rnd = random.Random(seed)
    days = spark.createDataFrame([(d, 2000 + d // 4, d % 4 + 1) for d in range(12)], "date_key long, year int, month int")
    schema = ("encounter_id long, encounter_date_key long, specialty_key long, encounter_type_key long, is_readmission boolean, "
              "diagnosis_count int, procedure_count int, encounter_duration_hours long, total_allowed decimal(22,2), claim_amount decimal(22,2)")

    def row(i):
        from decimal import Decimal

        cents = lambda: Decimal(rnd.randrange(10**6)) / 100
        return (i, rnd.randrange(14), rnd.randrange(3), rnd.randrange(2), rnd.choice([True, False, None]), rnd.randrange(4),
                rnd.randrange(3), rnd.choice([None, -3, 0, 50]), cents(), cents())

    old = {i: row(i) for i in range(40)}
    now = dict(old)
    hit = rnd.sample(range(50), 25)
    for i in hit:  # deleted, changed or new
        if rnd.random() < 0.4:
            now.pop(i, None)
        else:
            now[i] = row(i)
    frame = lambda rows: spark.createDataFrame(list(rows), schema)
    state = lambda rows: summary_state(frame(rows), days)
    got = maintained_state(state(old.values()), state(old[i] for i in hit if i in old), state(now[i] for i in hit if i in now))
    want = state(now.values())
    assert got.dtypes == want.dtypes and _rows(got) == _rows(want)


def test_fact_is_numbered_by_a_narrow_map(spark, src_small):
    """One column is checkpointed to number the fact, and its full width is shuffled for the blocks once."""
    from wardstar.plans.star import build_star

    star = build_star(src_small, AS_OF)
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = {f for f, _, _ in os.walk(folder)}
    plan = star["fact_encounters"]._jdf.queryExecution().optimizedPlan().toString()
    made = [f for f, _, _ in os.walk(folder) if f not in before]
    assert made and "LogicalRDD" in plan
    narrow = [line for line in plan.split("\n") if "LogicalRDD" in line]
    assert all(line.count("#") <= 12 for line in narrow)
    ids = star["fact_encounters"].select("encounter_id", "encounter_key").collect()
    assert [r.encounter_key for r in sorted(ids)] == list(range(1, len(ids) + 1))


def test_blocked_tables_are_known():
    assert set(BLOCKED) >= {t for t in STAR_TABLES if t.startswith(("fact_", "bridge_"))}
