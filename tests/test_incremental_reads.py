"""What the loads read again and again is stored once: sources that are joins, the previous star's fact."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from wardstar.sources.fixtures import DERIVED_TABLES, load_sources


@pytest.mark.parametrize("query", ["fact_incremental", "bridge_dx_incremental", "bridge_px_incremental"])
def test_incremental_tables_do_not_derive_the_previous_fact_again(spark, query):
    read = {f.rsplit("/", 1)[1] for f in E.queries()[query](spark, SF_SMALL).inputFiles()}
    assert not read & {"orders.parquet", "customer.parquet", "supplier.parquet"}


def test_stored_sources_have_the_rows_of_the_derived_ones(spark):
    derived = {t: df for t, df in load_sources(spark, SF_SMALL).items()}
    want = {t: sorted(map(str, derived[t].collect())) for t in DERIVED_TABLES}
    stored = load_sources(spark, SF_SMALL, stored=DERIVED_TABLES)
    for t in DERIVED_TABLES:
        assert stored[t].dtypes == derived[t].dtypes
        assert sorted(map(str, stored[t].collect())) == want[t]
        assert not any(f.endswith("orders.parquet") for f in stored[t].inputFiles())


def test_the_control_query_loads_from_stored_sources(spark, monkeypatch):
    from wardstar.plans import etl

    seen = []
    monkeypatch.setattr(etl, "full_refresh", lambda src, *a: seen.append(src))
    monkeypatch.setattr(etl, "incremental_run", lambda src, *a: seen.append(src))
    E._full_then_incremental(spark, SF_SMALL)
    assert len(seen) == 2
    for src in seen:
        for t in DERIVED_TABLES:
            assert not any(f.endswith("orders.parquet") for f in src[t].inputFiles())
