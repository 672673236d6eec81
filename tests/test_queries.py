"""Every registered query of the library at the smallest scale, next to its SQL."""

import pytest

import __spark_entry__ as entry
from linkloom.registry.oracles import oracle_queries
from linkloom.registry.queries import all_queries
from oracle_compare import connect, differences

SF = "/root/testdata/sf0.001"
SLOW = {"train_model", "train_and_evaluate", "train_link_head", "run_trials", "embedding_projection"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_registry_is_complete():
    assert set(oracle_queries()) == set(all_queries()) - SLOW
    assert set(all_queries()) <= set(entry.queries()) and set(oracle_queries()) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "probability" in df.columns


@pytest.mark.parametrize("name", sorted(set(all_queries()) - SLOW))
def test_query_equals_sql(spark, con, name):
    ours = all_queries()[name](spark, SF).toPandas()
    assert differences(ours, con.execute(oracle_queries()[name]).fetch_df()) is None


@pytest.mark.parametrize("name", sorted(SLOW))
def test_learning_query_gives_rows(spark, name):
    assert all_queries()[name](spark, SF).count() > 0
