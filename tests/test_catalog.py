"""Registered queries against their SQL on the smallest data."""

import glob
import os

import duckdb
import pytest

from check import rows
from daybook.catalog import CHECKS, QUERIES

SF = "/root/testdata/sf0.001"
QUICK = ["prj3_postings", "prj8_commodities", "prj9_accounts", "prj16_bank_feed", "e2_external_id", "e6_strict_errors",
         "w1_collision_ids", "w2_kept_dup_ids", "w4_id_posting_in_row", "w4_id_posting_in_rows", "w5_assign_ids",
         "j3_split_new", "j4_star", "j8_verify_balances", "j9_value_positions", "j9_portfolio_value", "j10_linked",
         "a3_expenses_by_category", "a9_savings_rates", "a13_rollup_accounts", "a17_unbalanced_weights",
         "a20_state_fingerprint", "a22_load_report", "w6_running_balance", "dq4_numeric_violations", "snk6_preview"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(CHECKS[name])
    assert got == rows([c[0] for c in res.description], res.fetchall()) and got[0]
