"""Every registered query against DuckDB on the driver tables."""

from __future__ import annotations

import os

import pytest
from oracle_compare import connect, differences

import __spark_entry__ as contract
from workloads.oracle import ORACLES
from workloads.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    if name == "table_hashes" and SF_DIR != "/root/testdata/sf0.01":
        pytest.skip("its SQL names the folder of this scale factor")
    assert differences(contract.queries()[name](spark, SF_DIR), con, contract.oracle_sql()[name]) == []


def test_only_the_manifest_has_no_sql(spark):
    assert set(QUERIES) - set(contract.oracle_sql()) == {"landing_manifest"}
    manifest = contract.queries()["landing_manifest"](spark, SF_DIR).collect()
    assert {len(r["sha256"]) for r in manifest} == {64}
    assert len({r["month"] for r in manifest}) == 80


def test_entry(spark):
    assert contract.entry(spark).columns == ["pickup_year_month", "trips", "avg_total_amount"]
