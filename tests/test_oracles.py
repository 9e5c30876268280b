"""Every query has an oracle; the quick ones are compared at the smallest scale.

`python -m checks.compare SF_DIR` compares all of them.
"""

import os

import pytest

from checks import compare
from checks.oracles import oracle_sql
from checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUICK = (
    "clean_customer", "clean_product", "clean_sales", "dedup_by_version", "dense_surrogate_key",
    "tolerant_cast", "scd2_merge", "scd2_merge_versions", "scd1_upsert", "ledger_append",
    "point_in_time_join", "kpi_net_margin", "kpi_store_traffic", "kpi_churn_heatmap",
    "kpi_product_quality", "audit_contract",
)


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
@pytest.mark.parametrize("name", QUICK)
def test_matches_oracle(spark, name):
    assert compare.difference(spark, compare.duck(SF_DIR), name, SF_DIR) is None
