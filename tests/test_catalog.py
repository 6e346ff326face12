import pytest

from runnel.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(name, matches):
    matches(catalog.QUERIES[name], catalog.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql_has_rows(name, spark, sf_dir):
    assert catalog.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and "balanced" in df.columns
    assert set(entry.oracle_sql()) <= set(entry.queries())
