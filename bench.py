"""Benchmark: the four analytic questions on both schemas, plus the loads.

Setup (untimed, like loading the reference's MySQL): the source tables are
derived from ``$BENCH_SF_DIR`` and staged as Parquet and the prior-state
snapshot is loaded; then a full refresh builds the star (timed as
``etl_full_refresh``) and an incremental run over the prior-state load is
timed as ``etl_incremental``.  Each query
is run once to warm up and then timed ``$BENCH_REPEAT`` times (median, default 5).
Every timed run builds, plans and executes the query from scratch.

Prints one JSON line:
``{"metric": "analytic_queries_total", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import statistics
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardstar.plans import analytics as A  # noqa: E402
from wardstar.plans.etl import full_refresh, incremental_run  # noqa: E402
from wardstar.plans.star import STAR_TABLES  # noqa: E402
from wardstar.session import checkpoint_dir, local_session  # noqa: E402
from wardstar.sources.fixtures import (  # noqa: E402
    PRIOR_AS_OF,
    PRIOR_WATERMARK,
    SOURCE_TABLES,
    load_sources,
    prior_sources,
)
from wardstar.sources.snapshots import Warehouse  # noqa: E402

AS_OF = "2001-08-02"

OLTP = {
    "q1_monthly_encounters_oltp": A.q1_monthly_encounters_oltp,
    "q2_dx_px_pairs_oltp": A.q2_dx_px_pairs_oltp,
    "q3_readmission_oltp": A.q3_readmission_oltp,
    "q4_revenue_oltp": A.q4_revenue_oltp,
    "q4_revenue_oltp_claim": A.q4_revenue_oltp_claim,
}
STAR = {
    "q1_monthly_encounters_star": A.q1_monthly_encounters_star,
    "q2_dx_px_pairs_star": A.q2_dx_px_pairs_star,
    "q3_readmission_star": A.q3_readmission_star,
    "q4_revenue_star": A.q4_revenue_star,
    "q4_revenue_star_claim": A.q4_revenue_star_claim,
}


def _timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="wardstar-bench")
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wardstar-bench-ckpt-"))
    root = f"{checkpoint_dir(spark)}/bench-{uuid.uuid4().hex}"

    # stage the sources as Parquet (untimed); Spark splits large files into
    # parallel scan tasks itself (spark.sql.files.maxPartitionBytes)
    derived = load_sources(spark, sf_dir)
    src = {}
    for t in (*SOURCE_TABLES, "patients_v1"):
        derived[t].write.parquet(f"{root}/src/{t}")
        src[t] = spark.read.parquet(f"{root}/src/{t}")

    times: dict[str, float] = {}
    # prior-state load (untimed; also warms the JVM for both timed loads)
    wh_prior = Warehouse(spark, f"{root}/wh_inc", create=True)
    full_refresh(prior_sources(src), wh_prior, PRIOR_AS_OF, dt.datetime.fromisoformat(PRIOR_WATERMARK))
    wh = Warehouse(spark, f"{root}/wh_full", create=True)
    times["etl_full_refresh"] = _timed(
        lambda: full_refresh(src, wh, AS_OF, dt.datetime.fromisoformat(PRIOR_WATERMARK))
    )
    times["etl_incremental"] = _timed(
        lambda: incremental_run(src, wh_prior, AS_OF, dt.datetime.fromisoformat(AS_OF + " 00:00:00"))
    )
    star = wh.tables(STAR_TABLES)

    query_times: dict[str, float] = {}
    for name, fn in list(OLTP.items()) + list(STAR.items()):
        arg = src if name in OLTP else star
        fn(arg).collect()  # warm-up
        runs = [_timed(lambda: fn(arg).collect()) for _ in range(repeat)]
        query_times[name] = round(statistics.median(runs), 4)
    total = round(sum(query_times.values()), 4)
    out = {
        "metric": "analytic_queries_total",
        "value": total,
        "unit": "sec",
        "queries": {**query_times, **{k: round(v, 4) for k, v in times.items()}},
        "oltp_total": round(sum(query_times[k] for k in OLTP), 4),
        "star_total": round(sum(query_times[k] for k in STAR), 4),
        "sf": sf,
        "cpus": int(cpus),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
