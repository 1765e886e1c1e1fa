"""Warehouse storage: run-versioned Parquet with manifests and a commit log.

Layout below ``root`` (a shared folder, e.g. under ``spark.checkpoint.dir``)::

    runs/<id>                              claimed run ids
    etl_control/after-<base>.json          SUCCESS rows: the run that follows run <base>
    etl_control/failed-<id>.json           FAILURE rows
    <table>/run=<id>/...                   what a run wrote
    block_manifest/<table>/<id>.json       blocks that make up a blocked table as of a run

Every run writes only below its own ``run=<id>``; nothing that an earlier run
wrote is ever changed.  Small dimensions are whole tables per run.  The
encounter-grain tables and the large dimensions (``BLOCKED``) are cut into
blocks of ``block_rows`` surrogate keys; a run writes the blocks it touches,
and its manifest lists every block with the run whose copy is current and with
the block's rows, largest key and range of natural ids.  The manifest has one
line per block, so the driver resolves it into the very folders to read: a
read never lists or scans superseded copies, a read of some blocks scans only
those, and encounter ids lead to their blocks without scanning the fact.

Commits are exclusive.  A run starts from the latest success, its base, and
its SUCCESS row is the file ``after-<base>``, which only one run can create;
of two runs from one base the slower fails and leaves a FAILURE row.  Readers
go through the latest SUCCESS row, so what a failed run left is never read;
``vacuum`` removes it, and every copy that no kept run names.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import Store

CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("control_id", T.LongType(), False),
        T.StructField("load_type", T.StringType(), True),
        T.StructField("last_watermark", T.TimestampNTZType(), True),
        T.StructField("load_date", T.TimestampNTZType(), True),
        T.StructField("records_processed", T.LongType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("error_message", T.StringType(), True),
    ]
)

# Blocks have a bounded size whatever the key distribution, and an incremental
# run rewrites only the blocks its keys live in: table -> (key, natural id).
BLOCKED = {
    "fact_encounters": ("encounter_key", "encounter_id"),
    "bridge_encounter_diagnoses": ("encounter_key", None),
    "bridge_encounter_procedures": ("encounter_key", None),
    "dim_patient": ("patient_key", "patient_id"),
    "dim_provider": ("provider_key", "provider_id"),
}
BLOCK_ROWS = 1 << 20
BLOCK_COL = "key_block"
BLOCK_FILES = 4  # files of a block, at most


class ConcurrentRun(RuntimeError):
    """Another run was committed since this one started."""


@dataclass(frozen=True)
class Block:
    """A block of a table: the run whose copy is current, its rows, largest key and natural ids (None: no index)."""

    block: int
    run: int
    rows: int
    max_key: int
    min_id: int | None = None
    max_id: int | None = None


def key_block(block_rows: int = BLOCK_ROWS, key: str = "encounter_key"):
    return F.floor(F.col(key) / F.lit(block_rows)).cast("long")


def dyadic(lo: int, hi: int) -> list[tuple[int, int]]:
    """The range lo..hi as few (level, prefix): all ids whose value shifted right by level is prefix."""
    out, level = [], 0
    while lo <= hi:
        if lo & 1:
            out.append((level, lo))
            lo += 1
        if not hi & 1:
            out.append((level, hi))
            hi -= 1
        lo, hi, level = lo >> 1, hi >> 1, level + 1
    return list(dict.fromkeys(out))


class Warehouse:
    """``create=True`` initialises a new warehouse; opening an existing one reads its control log."""

    def __init__(self, spark: SparkSession, root: str, create: bool = False, block_rows: int = BLOCK_ROWS):
        self.spark, self.root, self.block_rows = spark, root.rstrip("/"), block_rows
        self.store = Store(spark, self.root)
        if create and not self.store.put_if_absent("warehouse.json", json.dumps({"block_rows": block_rows})):
            raise FileExistsError(f"there is a warehouse in {self.root}")
        self.block_rows = json.loads(self.store.read("warehouse.json"))["block_rows"]

    def path(self, table: str, run_id: int) -> str:
        return f"{self.root}/{table}/run={run_id}"

    # ---------------------------------------------------------------- control log
    def control_rows(self) -> list[dict]:
        """The control rows (S8, W23), one small file per run."""
        names = [n for n in self.store.names("etl_control") if n.endswith(".json") and not n.startswith(".")]
        rows = [json.loads(self.store.read(f"etl_control/{n}")) for n in names]
        return sorted(rows, key=lambda r: r["control_id"])

    def control(self) -> DataFrame:
        rows = []
        for r in self.control_rows():
            for c in ("last_watermark", "load_date"):
                r[c] = r[c] and _dt.datetime.fromisoformat(r[c])
            rows.append(tuple(r[f.name] for f in CONTROL_SCHEMA))
        return self.spark.createDataFrame(rows, CONTROL_SCHEMA)

    def latest_success(self) -> int | None:
        return max((r["control_id"] for r in self.control_rows() if r["status"] == "SUCCESS"), default=None)

    def claim_run(self) -> int:
        """A run id that no other run has or will have."""
        taken = [int(n) for n in self.store.names("runs") if n.isdigit()]
        run_id = max(taken, default=0) + 1
        while not self.store.put_if_absent(f"runs/{run_id}", ""):
            run_id += 1
        return run_id

    def append_control(
        self,
        control_id: int,
        load_type: str,
        last_watermark: _dt.datetime | None,
        load_date: _dt.datetime,
        records_processed: int | None,
        status: str,
        error_message: str | None = None,
        base: int | None = None,
    ) -> None:
        """The one-row control append.  For a SUCCESS it is the commit, after run ``base`` (None: the
        first one), and raises ``ConcurrentRun`` if another run was committed after the same base."""
        values = (control_id, load_type, last_watermark, load_date, records_processed, status, error_message)
        row = {f.name: v.isoformat() if isinstance(v, _dt.datetime) else v for f, v in zip(CONTROL_SCHEMA, values)}
        name = f"after-{base or 0}" if status == "SUCCESS" else f"failed-{control_id}"
        if not self.store.put_if_absent(f"etl_control/{name}.json", json.dumps(row)):
            raise ConcurrentRun(f"run {control_id}: another run was committed after run {base or 0}")

    # ---------------------------------------------------------------- writing
    def write(self, table: str, run_id: int, df: DataFrame) -> DataFrame:
        """Write ``df`` as the whole of ``table`` in ``run_id`` and return it read back."""
        if table in BLOCKED:
            return self.write_blocks(table, run_id, df)
        df.write.mode("errorifexists").parquet(self.path(table, run_id))
        return self.read(table, run_id)

    def write_blocks(
        self,
        table: str,
        run_id: int,
        rows: DataFrame,
        base_run: int | None = None,
        touched: Iterable[int] | None = None,
    ) -> DataFrame:
        """Write blocks of a blocked table and its manifest for ``run_id``.

        Without ``base_run`` the rows are all there is.  With it, ``rows`` are
        the new contents of the ``touched`` blocks (a block without rows is
        gone) and every other block stays with the run that wrote it.  Rows
        are dealt by block first, each to ``BLOCK_FILES`` tasks, so a block
        has that many files at most whatever partitioning the rows come with."""
        key, natural = BLOCKED[table]
        kept = []
        if base_run is not None:
            gone = set(touched)
            kept = [b for b in self.manifest(table, base_run) if b.block not in gone]
        if base_run is None or gone:
            path = self.path(table, run_id)
            blocked = rows.withColumn(BLOCK_COL, key_block(self.block_rows, key))
            part = F.pmod(F.xxhash64(key), F.lit(BLOCK_FILES))
            blocked.repartition(BLOCK_COL, part).write.partitionBy(BLOCK_COL).mode("errorifexists").parquet(path)
            # the schema is given: a run may have emptied all its blocks
            written = self.spark.read.schema(blocked.schema).parquet(path)
            stats = [F.count(F.lit(1)).alias("rows"), F.max(key).alias("max_key")]
            if natural:
                stats += [F.min(natural).alias("min_id"), F.max(natural).alias("max_id")]
            found = written.groupBy(BLOCK_COL).agg(*stats).collect()  # a row for each block written
            kept += [Block(r[BLOCK_COL], run_id, *r[1:]) for r in found]
        lines = [json.dumps([b.block, b.run, b.rows, b.max_key, b.min_id, b.max_id]) for b in sorted(kept, key=lambda b: b.block)]
        self.store.put_if_absent(f"block_manifest/{table}/{run_id}.json", "\n".join([rows.schema.json(), *lines]))
        return self.read(table, run_id)

    # ---------------------------------------------------------------- reading
    def _manifest_lines(self, table: str, run_id: int) -> list[str]:
        return self.store.read(f"block_manifest/{table}/{run_id}.json").split("\n")

    def manifest(self, table: str, run_id: int) -> list[Block]:
        return [Block(*json.loads(line)) for line in self._manifest_lines(table, run_id)[1:]]

    def read(self, table: str, run_id: int, blocks: Iterable[int] | None = None) -> DataFrame:
        """``table`` as of ``run_id``; of a blocked table only ``blocks``, if given.  The scan gets the folders of
        current copies and no others."""
        if table not in BLOCKED:
            return self.spark.read.parquet(self.path(table, run_id))
        first, *lines = self._manifest_lines(table, run_id)
        schema = T.StructType.fromJson(json.loads(first))
        current = [Block(*json.loads(line)) for line in lines]
        if blocks is not None:
            wanted = set(blocks)
            current = [b for b in current if b.block in wanted]
        if not current:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path(table, b.run)}/{BLOCK_COL}={b.block}" for b in current]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*paths).select(schema.names)

    def blocks_of_keys(self, table: str, keys: DataFrame) -> set[int]:
        """The blocks that keys (first column) belong to, stored or not: at most one value per block comes back."""
        key = keys.columns[0]
        found = keys.select(key_block(self.block_rows, key).alias(BLOCK_COL)).distinct().collect()
        return {r[0] for r in found}

    def blocks_holding(self, table: str, run_id: int, ids: DataFrame) -> set[int]:
        """The stored blocks whose range of natural ids has one of ``ids`` (first column).

        Ranges are cut into dyadic intervals, so that finding them is an equi
        join of ids, once per level in use, with a few rows per block.  Those
        are the driver's already and are broadcast, so that no id is shuffled."""
        current = [b for b in self.manifest(table, run_id) if b.min_id is not None]
        cut = [(b.block, level, prefix) for b in current for level, prefix in dyadic(b.min_id, b.max_id)]
        if not cut:
            return set()
        ranges = self.spark.createDataFrame(cut, f"{BLOCK_COL} long, level int, prefix long")
        levels = sorted({level for _, level, _ in cut})
        id_ = F.col(ids.columns[0])
        prefixes = ids.select(
            F.explode(F.array(*[F.struct(F.lit(n).alias("level"), F.shiftright(id_, n).cast("long").alias("prefix")) for n in levels])).alias("p")
        ).select("p.*")
        held = prefixes.join(F.broadcast(ranges), ["level", "prefix"]).select(BLOCK_COL)
        return {r[0] for r in held.distinct().collect()}

    def max_key(self, table: str, run_id: int) -> int:
        """Largest surrogate key of a blocked table (0: none)."""
        return max((b.max_key for b in self.manifest(table, run_id)), default=0)

    def tables(self, names: tuple[str, ...], run_id: int | None = None) -> dict[str, DataFrame]:
        run_id = self.latest_success() if run_id is None else run_id
        if run_id is None:
            raise RuntimeError(f"no successful run in {self.root}")
        return {n: self.read(n, run_id) for n in names}

    # ---------------------------------------------------------------- retention
    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete every copy that none of the last ``keep`` successful runs names; returns the deleted folders.

        Runs that started after the latest success and have no control row yet
        may still be at work and keep what they wrote; every other run without
        a commit can't commit any more.  Control rows stay."""
        if keep < 1:
            raise ValueError("keep at least the latest run")
        rows = self.control_rows()
        good = [r["control_id"] for r in rows if r["status"] == "SUCCESS"]
        if not good:
            return []
        kept = set(good[-keep:])
        ended = {r["control_id"] for r in rows}
        deleted = []
        tables = [n for n in self.store.names() if n not in ("runs", "etl_control", "block_manifest") and "." not in n]
        for table in tables:
            manifests = f"block_manifest/{table}"
            named = {(b.run, b.block) for r in kept if table in BLOCKED for b in self.manifest(table, r)}
            for folder in self.store.names(table):
                run = int(folder.removeprefix("run="))
                if run > good[-1] and run not in ended:
                    continue
                if table not in BLOCKED:
                    old = [] if run in kept else [f"{table}/{folder}"]
                elif not any(r == run for r, _ in named):
                    old = [f"{table}/{folder}"]
                else:
                    blocks = [n for n in self.store.names(f"{table}/{folder}") if n.startswith(f"{BLOCK_COL}=")]
                    old = [f"{table}/{folder}/{n}" for n in blocks if (run, int(n.removeprefix(f"{BLOCK_COL}="))) not in named]
                for name in old:
                    self.store.delete(name)
                deleted += old
            for name in self.store.names(manifests):
                run = int(name.removesuffix(".json")) if not name.startswith(".") else None
                if run is not None and run not in kept and (run <= good[-1] or run in ended):
                    self.store.delete(f"{manifests}/{name}")
        return deleted
