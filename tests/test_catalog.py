import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from almsflow.plans import catalog

SF = "/root/testdata/sf0.001"
QUICK = ["zip5", "clean_name_docs", "clean_city_docs", "placeholder_filter", "pair_row", "pair_melt_join", "keep_latest",
         "keep_greatest_text", "left_chain", "survivor_semi", "compile_grants_flow", "unique_recipients", "pair_totals",
         "entity_ids", "negative_samples", "pair_scores", "top_k_candidates", "unknown_keys", "vector_profile",
         "compile_orgs_flow", "csv_roundtrip", "incremental_stream", "page_links"]


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql_twin(spark, name):
    assert compare(spark, connect(SF), name, queries()[name], oracle_sql()[name], SF) is None


def test_contract(spark):
    assert set(oracle_sql()) <= set(queries())
    assert set(catalog.QUERIES) - set(oracle_sql()) == {"train_blocks", "train_and_recommend"}
    assert entry(spark).columns == ["donor_ein", "receiver_ein", "grant_amt"]
