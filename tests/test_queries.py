"""Every named query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check import compare, connect

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
# Whole grids take minutes; they are run by check.py.
SLOW = {"md_cv_rf", "md_cv_lr", "md_cv_gbt", "md_best", "md_tune", "ex_suite"}


@pytest.fixture(scope="module")
def database(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, database, name):
    assert compare(QUERIES[name](spark, sf), database, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_query_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_inventory_is_covered():
    inventory = """
    src_csv src_ndjson src_seed src_urls snk_ndjson snk_urls snk_model snk_model_pair src_model
    pg_links pg_absurl pg_gate pg_empty pg_cap pg_repeat pg_strip pg_shiplast pg_fields pg_attrs pg_variants pg_required
    pg_resume pg_done pg_stream cl_name cl_attrs cl_desc cl_shipping cl_smaller_desc
    ex_country ex_brand ex_stock ex_origin ex_cat1 ex_cat2 ex_cat3
    sh_name sh_tier sh_reviews sh_replypct sh_replytime sh_age sh_followers
    num_k num_field num_price num_cast num_fill num_label num_exp
    ft_token ft_hashtf ft_idf ft_tfidf ft_countvec ft_index ft_onehot ft_minmax ft_assemble ft_omit ft_build ft_prepare
    md_split md_rf md_lr md_gbt md_fit md_cv_rf md_cv_lr md_cv_gbt md_tune md_best md_predict
    ev_rmse ev_r2 ev_rmsle ex_suite
    """.split()
    assert set(inventory) <= set(QUERIES)


def test_onehot_queries_show_every_category(spark, sf):
    from bazaarlens.schemas import MODEL_CATEGORIES

    shown = {r.feature for name in ("ft_onehot", "ft_onehot_third") for r in QUERIES[name](spark, sf).select("feature").distinct().collect()}
    assert shown == set(MODEL_CATEGORIES)
