"""Every registered query against its DuckDB SQL on the smallest tables (the driver does the same at sf0.01)."""

import pytest

import __spark_entry__ as entry
from docgeo.plans.queries import QUERIES
from sqlcheck.compare import compare, duck
from tests.conftest import SF001

FAST = ["language_proportions", "name_frequencies", "doc_coordinates", "confidence", "point_country",
        "whitelist_by_coords", "metadata_reference_patterns", "metadata_custom_patterns", "file_ids"]


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    out = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF001)
    assert out["columns_match"] and out["values_match"], out


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "location", "frequency", "lat", "lon", "class", "type", "importance", "country",
                          "continent", "confidence"]
