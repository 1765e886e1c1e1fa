"""Edge rows the fixtures do not cover (FIXTURES.md §4), as inline frames."""

import datetime as dt

from pyspark.sql import functions as F

from wardstar.functions.dates import age_group, completed_years, date_key, hours_between, weekday_mon1
from wardstar.functions.keys import dense_keys


def test_completed_years_feb29_and_bands(spark):
    rows = [
        (dt.date(2000, 2, 29), dt.date(2001, 2, 28), 0, "0-18"),
        (dt.date(2000, 2, 29), dt.date(2001, 3, 1), 1, "0-18"),
        (dt.date(1983, 8, 2), dt.date(2001, 8, 2), 18, "19-65"),   # exactly 18
        (dt.date(1983, 8, 3), dt.date(2001, 8, 2), 17, "0-18"),
        (dt.date(1936, 8, 2), dt.date(2001, 8, 2), 65, "65+"),     # exactly 65
        (dt.date(1936, 8, 3), dt.date(2001, 8, 2), 64, "19-65"),
        (None, dt.date(2001, 8, 2), None, "65+"),                  # NULL birth date
    ]
    df = spark.createDataFrame(rows, "dob date, as_of date, years int, band string")
    out = df.select(
        completed_years(F.col("dob"), F.col("as_of")).alias("y"), age_group(F.col("dob"), F.col("as_of")).alias("b"),
        "years", "band",
    ).collect()
    for r in out:
        assert r["y"] == r["years"] and r["b"] == r["band"], r


def test_weekday_monday_one(spark):
    df = spark.createDataFrame([(dt.date(2024, 6, 2),), (dt.date(2024, 6, 3),)], "d date")
    assert [r[0] for r in df.select(weekday_mon1(F.col("d"))).collect()] == [7, 1]


def test_hours_truncate_toward_zero(spark):
    a = dt.datetime(2020, 1, 1, 0, 0)
    df = spark.createDataFrame(
        [(a, a + dt.timedelta(minutes=90)), (a + dt.timedelta(minutes=90), a)], "s timestamp_ntz, e timestamp_ntz"
    )
    assert [r[0] for r in df.select(hours_between(F.col("s"), F.col("e"))).collect()] == [1, -1]


def test_date_key_outside_calendar_is_null(spark):
    df = spark.createDataFrame([(dt.date(1999, 12, 31),), (dt.date(2000, 1, 1),), (dt.date(2000, 1, 3),)], "d date")
    keys = [r[0] for r in df.select(date_key(F.col("d"), "2000-01-01", "2100-12-31")).collect()]
    assert keys[0] is None and keys[2] == keys[1] + 2
    assert [r[0] for r in df.select(date_key(F.col("d"))).collect()] == [keys[1] - 1, keys[1], keys[2]]


def test_dense_keys_equal_row_number(spark):
    import random

    rnd = random.Random(7)
    ids = rnd.sample(range(1, 10**6), 5000)
    df = spark.createDataFrame([(i, f"x{i}") for i in ids], "id long, v string").repartition(7)
    keyed = dense_keys(df, ["id"], "k", start_after=100)
    got = {r["id"]: r["k"] for r in keyed.collect()}
    want = {i: 101 + n for n, i in enumerate(sorted(ids))}
    assert got == want


def test_dense_keys_after_a_maximum_and_of_no_rows(spark):
    df = spark.range(0, 3000).selectExpr("(id * 7919) % 100003 as id").repartition(4)
    keys = sorted(r["k"] for r in dense_keys(df, ["id"], "k", start_after=lambda: 5).collect())
    assert keys == list(range(6, 3006))
    assert dense_keys(df.limit(0), ["id"], "k").collect() == []


def test_source_schemas_are_checked(spark, src_small):
    import pytest

    from wardstar.sources.schemas import check_sources

    check_sources(src_small)
    bad = {k: v for k, v in src_small.items() if k != "billing"}
    bad["patients"] = bad["patients"].drop("mrn").withColumn("patient_id", F.col("patient_id").cast("string"))
    with pytest.raises(ValueError, match="billing: no such table") as e:
        check_sources(bad)
    assert "patients.mrn: no such column" in str(e.value) and "patients.patient_id: string" in str(e.value)
