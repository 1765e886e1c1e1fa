"""Full refresh (W15) and incremental run (W24) with an audit row.

Both publish into a ``Warehouse`` (``sources.snapshots``): each table is
stored and read back before the next table uses it (the lineage is cut
there, and stored tables carry real size statistics for the join planner);
the control row is appended last and commits the run, unless another run was
committed since this one started.  On failure a FAILURE row with the error
message is appended instead, as the reference's trigger script does, and the
exception propagates; nothing of an earlier run has been touched.

An incremental run reads and writes stored rows in proportion to its changes:
encounter ids lead to the blocks of the fact through the manifest's id ranges,
keys to the blocks of the bridges and large dimensions, and the monthly
summary is kept by adding and subtracting the contributions of those rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dims as D
from ..operators import incremental as I
from ..operators import scd
from ..operators.dims import PATIENT_ATTRS
from ..functions.dates import age_group, lit_ts
from ..session import staged
from ..sources.snapshots import Warehouse
from ..sources.schemas import check_sources
from .star import STAR_TABLES, build_star
from .summaries import maintained_state, named_summary, summary_state

LOOKBACK_DAYS = 7  # fixed value of the reference


def _run_ts(as_of: str) -> _dt.datetime:
    return _dt.datetime.combine(_dt.date.fromisoformat(as_of), _dt.time())


def _audited(wh: Warehouse, load_type: str, as_of: str, body):
    base = wh.latest_success()
    run_id = wh.claim_run()
    try:
        watermark, records = body(run_id, base)
        wh.append_control(run_id, load_type, watermark, _run_ts(as_of), records, "SUCCESS", base=base)
    except Exception as ex:  # the failure is recorded, then re-raised
        wh.append_control(run_id, load_type, None, _run_ts(as_of), 0, "FAILURE", str(ex))
        raise
    return run_id


def _write_summary(wh: Warehouse, run_id: int, state: DataFrame, star: Mapping[str, DataFrame]) -> None:
    wh.write("monthly_summary", run_id, named_summary(wh.write("summary_state", run_id, state), star))


def full_refresh(
    src: Mapping[str, DataFrame],
    wh: Warehouse,
    as_of: str,
    watermark: _dt.datetime,
    calendar: tuple[str, str] | None = None,
    summary: bool = True,
) -> int:
    """Rebuild every star table from the sources into a new run.
    ``watermark`` is the change stamp the sources are complete up to;
    ``summary`` also materialises the monthly summary (X7)."""

    def body(run_id: int, base: int | None):
        check_sources(src)
        star = build_star(dict(src), as_of, calendar)
        for name in STAR_TABLES:
            star.materialize(name, wh.write(name, run_id, star[name]))
        if summary:
            _write_summary(wh, run_id, summary_state(star["fact_encounters"], star["dim_date"]), star)
        return watermark, sum(b.rows for b in wh.manifest("fact_encounters", run_id))

    return _audited(wh, "FULL", as_of, body)


def incremental_tables(
    prev: Mapping[str, DataFrame],
    control: DataFrame | None,
    src: Mapping[str, DataFrame],
    as_of: str,
    lookback_days: int = LOOKBACK_DAYS,
    widen: bool = True,
    null_safe: bool = True,
    store: "Unstored | StoredRun | None" = None,
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Plan one incremental run over the previous star ``prev``.

    ``store`` says where stored rows come from and new ones go (default:
    ``prev`` itself, the fact and the bridges stay lazy).  Returns the new tables and, by
    ``removed`` and ``inserted``, the fact rows deleted and (re)inserted."""
    store = store or Unstored(prev)
    sink = store.write
    watermark = I.read_watermark(control)
    cutoff = I.cutoff_for(watermark, as_of, lookback_days)
    wm = lit_ts(watermark)

    def changed(t: str) -> DataFrame:
        return src[t].where(F.col("last_updated") > wm)

    # the calendar grows at both ends with the dates of the changed rows; keys count from a fixed epoch
    cal_row = prev["dim_date"].agg(F.min("calendar_date").alias("lo"), F.max("calendar_date").alias("hi")).first()
    calendar = D.calendar_bounds(
        {t: changed(t) for t in ("encounters", "encounter_procedures", "billing")},
        cover=(cal_row["lo"].isoformat(), cal_row["hi"].isoformat()),
    )

    out: dict[str, DataFrame] = {
        "dim_date": sink("dim_date", D.dim_date(src["encounters"].sparkSession, *calendar))
    }
    # specialty and department before provider so provider keys resolve
    out["dim_specialty"] = sink("dim_specialty", scd.type1_upsert(
        prev["dim_specialty"], changed("specialties"), "specialty_id", "specialty_key",
        ["specialty_name", "specialty_code"]))
    out["dim_department"] = sink("dim_department", scd.type1_upsert(
        prev["dim_department"], changed("departments"), "department_id", "department_key",
        ["department_name", "floor", "capacity"]))
    # a provider resolves anew when it changed or when its specialty or department did
    touched = src["providers"].select("provider_id", "specialty_id", "department_id")
    touched = (
        changed("providers").select("provider_id")
        .unionByName(touched.join(changed("specialties"), "specialty_id", "left_semi").select("provider_id"))
        .unionByName(touched.join(changed("departments"), "department_id", "left_semi").select("provider_id"))
    )
    providers = src["providers"].join(touched, "provider_id", "left_semi")
    out["dim_provider"] = store.replace("dim_provider", *scd.type1_changes(
        prev["dim_provider"], D.provider_rows(providers, out["dim_specialty"], out["dim_department"]),
        "provider_id", "provider_key", ["first_name", "last_name", "credential", "specialty_key", "department_key"],
        start_after=store.last_key("dim_provider")))
    out["dim_encounter_type"] = sink("dim_encounter_type", scd.type1_upsert(
        prev["dim_encounter_type"], D.encounter_types(changed("encounters")), "type_name", "encounter_type_key", []))
    out["dim_diagnosis"] = sink("dim_diagnosis", scd.type1_upsert(
        prev["dim_diagnosis"], changed("diagnoses"), "diagnosis_id", "diagnosis_key",
        ["icd10_code", "icd10_description"]))
    out["dim_procedure"] = sink("dim_procedure", scd.type1_upsert(
        prev["dim_procedure"], changed("procedures"), "procedure_id", "procedure_key",
        ["cpt_code", "cpt_description"]))
    out["dim_patient"] = store.replace("dim_patient", *scd.scd2_changes(
        prev["dim_patient"], changed("patients"), "patient_id", "patient_key", PATIENT_ATTRS, as_of,
        derived={"age_group": lambda day: age_group(F.col("date_of_birth"), day)}, null_safe=null_safe,
        stored=lambda keys: store.with_keys("dim_patient", keys), start_after=store.last_key("dim_patient")))

    affected = I.affected_set(src, cutoff).unionByName(I.late_dimension_dependents(src, prev, out)).distinct()
    if widen:
        affected = staged(affected, "affected")  # read several times below
        affected = I.widen_for_readmission(affected, src, store.with_ids("fact_encounters", affected), out)
    # one frozen encounter set for delete, re-insert and both bridges
    affected = staged(affected, "affected")

    prev_fact = store.with_ids("fact_encounters", affected)
    removed = prev_fact.join(affected, "encounter_id", "left_semi")
    _, inserted = I.fact_incremental(
        prev_fact, src, out, affected, as_of, last_key=store.last_key("fact_encounters")
    )
    reloaded = removed.select("encounter_key").unionByName(inserted.select("encounter_key")).distinct()
    reloaded = staged(reloaded, "reloaded")
    dx = I.bridge_dx_rebuild(inserted, src["encounter_diagnoses"], out["dim_diagnosis"], affected)
    px = I.bridge_px_rebuild(inserted, src["encounter_procedures"], out["dim_procedure"], affected)
    out["fact_encounters"] = store.replace("fact_encounters", reloaded, inserted)
    out["bridge_encounter_diagnoses"] = store.replace("bridge_encounter_diagnoses", reloaded, dx)
    out["bridge_encounter_procedures"] = store.replace("bridge_encounter_procedures", reloaded, px)
    return out, {"removed": removed, "inserted": inserted}


class Unstored:
    """Rows of the previous star's frames; new tables are frames, too.  Dimensions, which later tables read several
    times, are staged."""

    def __init__(self, prev: Mapping[str, DataFrame]):
        self.prev = prev

    def write(self, table: str, rows: DataFrame) -> DataFrame:
        """``rows`` as the whole new table."""
        return staged(rows, table)

    def with_keys(self, table: str, keys: DataFrame) -> DataFrame:
        """Rows of the table that include all with the keys."""
        return self.prev[table]

    def with_ids(self, table: str, ids: DataFrame) -> DataFrame:
        """Rows of the table that include all with the natural ids."""
        return self.prev[table]

    def last_key(self, table: str) -> Callable[[], int] | None:
        """The largest key issued, if known without a scan."""
        return None

    def replace(self, table: str, removed: DataFrame, added: DataFrame) -> DataFrame:
        """The table without the rows of keys ``removed``, with ``added``."""
        rows = I.replace_rows(self.prev[table], removed, added)
        return staged(rows, table) if table.startswith("dim_") else rows


class StoredRun(Unstored):
    """Blocks of the run ``base`` in a warehouse; ``run_id`` writes the blocks that change."""

    def __init__(self, wh: Warehouse, run_id: int, base: int, prev: Mapping[str, DataFrame]):
        super().__init__(prev)
        self.wh, self.run_id, self.base = wh, run_id, base
        self._touched: tuple[DataFrame, set[int]] | None = None  # of the keys asked for last

    def write(self, table: str, rows: DataFrame) -> DataFrame:
        return self.wh.write(table, self.run_id, rows)

    def with_keys(self, table: str, keys: DataFrame) -> DataFrame:
        return self.wh.read(table, self.base, self.wh.blocks_of_keys(table, keys))

    def with_ids(self, table: str, ids: DataFrame) -> DataFrame:
        return self.wh.read(table, self.base, self.wh.blocks_holding(table, self.base, ids))

    def last_key(self, table: str) -> Callable[[], int]:
        return lambda: self.wh.max_key(table, self.base)

    def replace(self, table: str, removed: DataFrame, added: DataFrame) -> DataFrame:
        key = removed.columns[0]
        if self._touched is None or self._touched[0] is not removed:  # the fact and its bridges have the same keys
            keys = removed if table.startswith("bridge_") else removed.unionByName(added.select(key))
            self._touched = removed, self.wh.blocks_of_keys(table, keys)
        touched = self._touched[1]
        rows = I.replace_rows(self.wh.read(table, self.base, touched), removed, added)
        return self.wh.write_blocks(table, self.run_id, rows, self.base, touched)


def incremental_run(
    src: Mapping[str, DataFrame],
    wh: Warehouse,
    as_of: str,
    new_watermark: _dt.datetime,
    lookback_days: int = LOOKBACK_DAYS,
    widen: bool = True,
    summary: bool = True,
) -> int:
    """Dims → fact → bridges → control row, over the latest good run."""

    def body(run_id: int, base: int | None):
        check_sources(src)
        if base is None:
            raise RuntimeError("incremental run needs a previous successful load")
        prev = wh.tables(STAR_TABLES, base)
        store = StoredRun(wh, run_id, base, prev)
        out, changes = incremental_tables(prev, wh.control(), src, as_of, lookback_days, widen, store=store)
        if summary:
            if wh.store.exists(f"summary_state/run={base}"):
                removed, added = (summary_state(changes[c], out["dim_date"]) for c in ("removed", "inserted"))
                state = maintained_state(wh.read("summary_state", base), removed, added)
            else:  # the run before kept no summary
                state = summary_state(out["fact_encounters"], out["dim_date"])
            _write_summary(wh, run_id, state, out)
        return new_watermark, int(changes["inserted"].count())

    return _audited(wh, "INCREMENTAL", as_of, body)
