"""The skew-safe readmission flag against a brute-force pairwise check."""

import datetime as dt
import random

from wardstar.operators.readmission import readmission_flag

SCHEMA = "encounter_id long, patient_id long, encounter_type string, encounter_date timestamp_ntz, discharge_date timestamp_ntz"


def brute(rows, days=30, probe_ids=None):
    out = {}
    for e in rows:
        eid, pid, _, _, dis = e
        if probe_ids is not None and eid not in probe_ids:
            continue
        hit = False
        if dis is not None:
            end = dis + dt.timedelta(days=days)
            for e2 in rows:
                if (e2[1] == pid and e2[2] == "Inpatient" and e2[3] is not None and dis <= e2[3] <= end
                        and e2[0] != eid):
                    hit = True
                    break
        out[eid] = hit
    return out


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["encounter_id"]: r["is_readmission"] for r in readmission_flag(df, **kw).collect()}
    assert got == brute(rows, days=kw.get("days", 30))


def test_boundaries_and_self(spark):
    t0 = dt.datetime(2001, 1, 1, 10, 0)
    rows = [
        # readmission exactly on the 30-day bound (inclusive)
        (1, 1, "Inpatient", t0, t0 + dt.timedelta(hours=5)),
        (2, 1, "Inpatient", t0 + dt.timedelta(hours=5, days=30), t0 + dt.timedelta(days=31)),
        # one microsecond past the bound
        (3, 2, "Inpatient", t0, t0 + dt.timedelta(hours=5)),
        (4, 2, "Inpatient", t0 + dt.timedelta(hours=5, days=30, microseconds=1), t0 + dt.timedelta(days=32)),
        # zero-length stay: its own admission is inside its window but is itself
        (5, 3, "Inpatient", t0, t0),
        # two inpatient stays at the same instant: each is the other's readmission
        (6, 4, "Inpatient", t0, t0),
        (7, 4, "Inpatient", t0, t0),
        # discharge before admission (bad data), self inside own window
        (8, 5, "Inpatient", t0 + dt.timedelta(days=2), t0),
        (9, 5, "Outpatient", t0 + dt.timedelta(days=1), t0 + dt.timedelta(days=1)),
        # null discharge never flags; outpatient follow-up does not count
        (10, 6, "Inpatient", t0, None),
        (11, 6, "Inpatient", t0 + dt.timedelta(days=1), t0 + dt.timedelta(days=2)),
        (12, 7, "ER", t0, t0 + dt.timedelta(hours=1)),
        (13, 7, "Outpatient", t0 + dt.timedelta(days=1), t0 + dt.timedelta(days=1, hours=1)),
    ]
    check(spark, rows)


def test_random_against_brute_force(spark):
    rnd = random.Random(11)
    rows = []
    base = dt.datetime(2000, 1, 1)
    for i in range(1500):
        pid = rnd.choice([1] * 40 + list(range(2, 60)))  # patient 1 is hot
        start = base + dt.timedelta(hours=rnd.randrange(0, 24 * 400))
        dur = dt.timedelta(hours=rnd.choice([0, 1, 5, 48, 72, -3]))
        typ = rnd.choice(["Inpatient", "Inpatient", "Outpatient", "ER", None])
        dis = None if rnd.random() < 0.03 else start + dur
        if rnd.random() < 0.05 and rows:  # exact duplicate timestamps
            start = rows[-1][3] or start
        rows.append((i, pid, typ, start, dis))
    check(spark, rows)
    check(spark, rows, days=7)
