"""Every registered query against its DuckDB oracle (the driver's gate),
plus the fixture regression constants of FIXTURES.md §4."""

import os

import pytest

import __spark_entry__ as E
from compare import compare, duck
from conftest import SF_CHECK, SF_SMALL

SF = os.environ.get("WARDSTAR_ORACLE_SF", SF_SMALL)
KEYS = sorted(E._queries())


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    ok, msg = compare(df, con, E.oracle_sql()[key])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["specialty_name", "readmission_rate"]
    assert df.count() > 0


def test_fixture_constants(spark, src_small):
    from pyspark.sql import functions as F

    s = src_small
    assert [s[t].count() for t in ("specialties", "departments", "providers", "patients", "encounters")] == [
        25, 5, 10, 150, 1500]
    assert s["encounter_diagnoses"].count() == 4032 and s["encounter_procedures"].count() == 1968
    assert s["billing"].count() == 1508
    inp = s["encounters"].where("encounter_type = 'Inpatient'")
    assert inp.count() == 493
    q3 = E.queries()["q2_dx_px_pairs_oltp"](spark, SF_SMALL).first()
    assert (q3.icd10_code, q3.cpt_code, q3.encounter_count) == ("D34", "C0024", 11)
    aff = E.queries()["affected_set"](spark, SF_SMALL).count()
    assert aff == 260
    assert s["encounters"].where(F.col("discharge_date").isNull()).count() == 3
