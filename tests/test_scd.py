"""Type 1 / Type 2 edge cases: NULL to value, two changes on one day,
re-running a run, VALUES(col) semantics."""

import datetime as dt

from pyspark.sql import functions as F

from wardstar.functions.dates import age_group
from wardstar.operators.dims import PATIENT_ATTRS, dim_patient
from wardstar.operators.scd import scd2, stamp_changes, type1_upsert

P_SCHEMA = "patient_id long, first_name string, last_name string, date_of_birth date, gender string, mrn string"
DERIVED = {"age_group": lambda day: age_group(F.col("date_of_birth"), day)}


def _patients(spark, rows):
    return spark.createDataFrame(rows, P_SCHEMA)


def _apply(dim, changes, as_of, null_safe=True):
    return scd2(dim, changes, "patient_id", "patient_key", PATIENT_ATTRS, as_of, DERIVED, null_safe)


def test_scd2_null_to_value_and_same_day(spark):
    v0 = _patients(spark, [(1, "A", "X", None, "M", "MRN1"), (2, "B", "Y", dt.date(1990, 1, 1), "F", "MRN2")])
    dim = dim_patient(v0, "2001-08-01")
    # NULL -> value is a change when null-safe, invisible with the literal !=
    c1 = _patients(spark, [(1, "A", "X", dt.date(1950, 5, 5), "M", "MRN1"), (3, "C", "Z", None, "M", "MRN3")])
    literal = _apply(dim, c1, "2001-08-02", null_safe=False)
    assert literal.where("patient_id = 1").count() == 1
    d1 = _apply(dim, c1, "2001-08-02").cache()
    rows = {(r.patient_id, r.is_current): r for r in d1.collect()}
    assert rows[(1, False)].end_date == dt.date(2001, 8, 1)
    assert rows[(1, True)].start_date == dt.date(2001, 8, 2) and rows[(1, True)].age_group == "19-65"
    # new versions get keys after the maximum, in natural-key order
    assert (rows[(1, True)].patient_key, rows[(3, True)].patient_key) == (3, 4)
    # a second change the same day corrects the new version in place
    c2 = _patients(spark, [(1, "A2", "X", dt.date(1950, 5, 5), "M", "MRN1")])
    d2 = _apply(d1, c2, "2001-08-02").collect()
    p1 = sorted([r for r in d2 if r.patient_id == 1], key=lambda r: r.patient_key)
    assert len(p1) == 2 and [r.is_current for r in p1] == [False, True] and p1[1].first_name == "A2"
    assert p1[1].patient_key == rows[(1, True)].patient_key
    # invariants: one current row per patient, no inverted intervals
    cur = [r.patient_id for r in d2 if r.is_current]
    assert sorted(cur) == sorted(set(cur))
    assert all(r.start_date is None or r.end_date >= r.start_date for r in d2)
    # idempotent: the same change set again changes nothing
    again = _apply(spark.createDataFrame(d2, d1.schema), c2, "2001-08-02")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, d2))


def test_type1_upsert_values_semantics(spark):
    tgt = spark.createDataFrame([(1, 10, "a", "x"), (2, 20, "b", "y")], "k long, id long, c string, d string")
    src = spark.createDataFrame([(20, None, "y2"), (30, "c", "z")], "id long, c string, d string")
    out = {r.id: r for r in type1_upsert(tgt, src, "id", "k", ["c", "d"]).collect()}
    assert out[20].k == 2 and out[20].c is None and out[20].d == "y2"   # VALUES(col), NULL included
    assert out[10].c == "a" and out[30].k == 3


def test_stamp_changes(spark):
    prev = spark.createDataFrame([(1, "a", dt.datetime(2001, 1, 1)), (2, None, dt.datetime(2001, 1, 1))],
                                 "id long, v string, last_updated timestamp_ntz")
    curr = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string")
    out = {r.id: r.last_updated for r in stamp_changes(prev, curr, ["id"], "2001-08-02 00:00:00").collect()}
    assert out == {1: dt.datetime(2001, 1, 1), 2: dt.datetime(2001, 8, 2), 3: dt.datetime(2001, 8, 2)}
