"""Every registered query against its SQL on the same tables."""

import pytest

import __spark_entry__ as entry
from presslake.catalog.check import compare, connect
from presslake.catalog.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


# SQL has neither SimHash nor fitted models; tests/test_copies_and_quality.py holds these against all pairs and held-out rows.
WITHOUT_SQL = {"near_copies", "quality_model_auc"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, con, name):
    result = compare(spark, sf, name, con)
    assert result["checked"] or name in WITHOUT_SQL, name
    assert result["diff"] == []
    assert result["rows"] > 0


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert {r["continent"] for r in rows} >= {"Africa", "Americas", "Asia", "Europe", "Global", "Oceania"}
