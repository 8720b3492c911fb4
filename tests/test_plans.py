"""Physical plans: nothing runs in Python, no cross joins, no large single partition, filters reach the scan."""

import pytest

from daybook import adapter as A
from daybook.catalog import CHECKS, QUERIES
from daybook.operators import analytics as R
from daybook.operators import temporal
from daybook.operators.numbering import number_groups
from daybook.sources import store

SF = "/root/testdata/sf0.001"
# One-row aggregates, or sums over a bounded number of pre-aggregated rows.
ONE_PARTITION = ["w5_assign_ids", "src4_bulk_load", "j6_combine_totals"]
GROUPED = ["a1_account_balances", "a3_expenses_by_category", "a13_rollup_accounts", "a17_unbalanced_weights",
           "w6_running_balance", "j4_star", "j8_verify_balances", "j9_portfolio_value", "j10_linked", "flt5_in_year",
           "dq2_dup_violations", "dq3_orphans", "w1_collision_ids", "prj9_accounts", "prj8_commodities"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", GROUPED + ONE_PARTITION)
def test_plan_is_distributed(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for word in ["EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"]:
        assert word not in text
    if name in GROUPED:
        assert "SinglePartition" not in text


def test_in_row_builders_do_not_shuffle(spark):
    from daybook.operators import facts
    from daybook.operators.transactions import identified
    t = identified(A.directives(spark, SF).filter("kind = 'transaction'")).withColumnRenamed("content_hash", "external_id")
    for df in [facts.build_postings(t), facts.build_txn_meta(t), facts.build_txn_tags(t)]:
        assert "Exchange" not in plan(df)


def test_year_reaches_the_scan(spark, tmp_path):
    root = str(tmp_path / "led")
    led = {"postings": A.line_postings(spark, SF).selectExpr("*", "leg AS posting_idx")}
    store.write_ledger(spark, led, root)
    text = plan(R.total_expenses({"postings": store.read_table(spark, root, "postings")}, 1998))
    scan = text[text.index("FileScan"):]
    assert "year" in scan[scan.index("PartitionFilters"):scan.index("PushedFilters")]
    assert "GreaterThanOrEqual(date" in scan and "payee" not in scan
    assert "Join" not in text


def test_time_windows_see_one_row_per_day(spark):
    text = plan(temporal.running_balance({"postings": A.line_postings(spark, SF)}))
    assert text.index("Window") < text.index("HashAggregate")


def test_unique_keys_are_not_sorted(spark):
    df = spark.range(1000).selectExpr("CAST(id AS string) AS k", "id AS o")
    out = number_groups(df, "k", "o", least=2)
    assert out.count() == 0 and "_span" not in plan(out)


def test_every_check_has_a_query():
    assert set(CHECKS) == set(QUERIES)


def test_directives_and_others_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    """Each kind goes to its folder as it comes; a write of all kinds by kind would sort whole rows in every task."""
    from pyspark.sql import DataFrameWriter

    from daybook import adapter
    from daybook.plans import load as L

    sf, by, partition = "/root/testdata/sf0.001", [], DataFrameWriter.partitionBy
    monkeypatch.setattr(adapter, "_written", {})
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda self, *c: by.extend(c) or partition(self, *c))
    d = adapter.directives(spark, sf)
    L.prepare(d)
    assert "kind" not in by
    flat = lambda df: sorted(map(tuple, df.selectExpr("seq", "kind", "to_json(struct(*))").collect()))
    assert flat(d.select(*adapter.directive_rows(spark, sf).columns)) == flat(adapter.directive_rows(spark, sf))
