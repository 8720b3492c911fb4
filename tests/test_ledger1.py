import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import ledger1 as G
from daybook.operators import directives as D
from daybook.operators import quality, registries, state, temporal
from daybook.operators import transactions as tx
from daybook.operators.analytics import unbalanced
from daybook.plans import load as L
from daybook.sources import store
from daybook.sources.workspace import Workspace

EUR = "name string, metadata string"


@pytest.fixture(scope="module")
def d(spark):
    return G.frame(spark).cache()


@pytest.fixture(scope="module")
def led(spark, d):
    return {k: v.cache() for k, v in L.ledger_of(d).items()}


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_external_ids(d):
    got = {r.seq: r.external_id for r in tx.external_ids(D.of_kind(d, "transaction")).collect()}
    assert got == {10: G.H1, 11: G.H1 + "-2", 12: G.H3, 13: "BANK-1", 14: "BANK-1", 15: G.H6, 16: G.H7}


def test_content_hash_ignores_given_id(d):
    got = {r.seq: r.content_hash for r in tx.identified(d).collect()}
    assert got[13] == G.H4 and got[11] == G.H1 and got[17] is None


def test_source_account_matters(spark):
    data = [r for r in G.rows() if r["seq"] == 15]
    data[0]["meta"] = None
    assert tx.identified(G.frame(spark, data)).collect()[0].content_hash == G.H6B


def test_id_stats(d):
    generated = tx.identified(D.of_kind(d, "transaction")).filter("given_id IS NULL")
    assert tuple(tx.id_stats(generated, "content_hash").collect()[0]) == (5, 1, 2)


def test_registries(spark, d):
    existing = spark.createDataFrame([("EUR", None)], EUR)
    assert rows(registries.build_commodities(d, existing), "name", "metadata") == [
        ("CHF", None), ("USD", '{"name":"US Dollar"}')]
    accounts = {r.name: r for r in registries.build_accounts(d).collect()}
    checking = accounts["Assets:Checking"]
    assert (checking.type, checking.status, checking.open_date, checking.close_date) == (
        "Assets", "closed", dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    assert "Assets:Nowhere" not in accounts
    assert accounts["Assets"].status == "open" and accounts["Assets"].open_date is None
    assert {r.account for r in registries.ignored_closes(d).collect()} == {"Assets:Checking", "Assets:Nowhere"}


def test_existing_account_is_closed_but_not_changed(spark, d):
    existing = spark.createDataFrame([("Assets:Nowhere", "Assets", "open", dt.date(2020, 1, 1), None, "{}")],
                                     "name string, type string, status string, open_date date, close_date date, metadata string")
    got = {r.name: r for r in registries.build_accounts(d, existing).collect()}
    assert (got["Assets:Nowhere"].status, got["Assets:Nowhere"].open_date, got["Assets:Nowhere"].metadata) == (
        "closed", dt.date(2020, 1, 1), "{}")


def test_tables(led):
    assert led["transactions"].count() == 6
    assert rows(led["transaction_tags"], "external_id", "tag") == [(G.H1, "food"), (G.H1 + "-2", "food")]
    assert rows(led["transaction_links"], "external_id", "link") == [(G.H6, "pay-3")]
    assert rows(led["transaction_metadata"], "external_id", "key", "value") == [
        (G.H1, "note", "x"), (G.H1 + "-2", "note", "x"), (G.H6, "source_account", "Assets:Checking")]
    assert rows(led["posting_metadata"], "external_id", "posting_idx", "key", "value") == [(G.H6, 2, "slip", "7")]
    zero = led["postings"].filter(led["postings"].external_id == G.H7).collect()[0]
    assert (zero.amount, zero.currency, zero.price_amount, zero.price_currency) == (Decimal("0.0000"), "CHF", None, None)
    assert rows(led["ledger_events"], "name", "value") == [("location", "Paris")]
    assert rows(led["ledger_documents"], "account", "file_path") == [("Assets:Checking", "/docs/x.pdf")]
    assert rows(led["prices"], "commodity", "price_amount", "price_currency") == [("EUR", Decimal("1.1000"), "USD")]


def test_balances(led):
    got = {(str(r.date), r.account, r.asserted): (r.ok, r.diff) for r in temporal.verify_balances(led).collect()}
    assert got == {("2024-03-01", "Assets:Checking", Decimal("12.0000")): (True, Decimal("0.0000")),
                   ("2024-03-02", "Assets", Decimal("1012.0000")): (True, Decimal("0.0000")),
                   ("2024-03-02", "Assets:Checking", Decimal("600.0000")): (False, Decimal("12.0000"))}
    assert unbalanced(led).count() == 0


def test_state(spark, d):
    run = L.prepare(d)
    hashes = state.run_hashes(run.ids, run.later)
    assert tuple(state.state_hash(hashes).collect()[0]) == (G.STATE,)
    assert state.state_hash(hashes.repartition(3)).collect()[0][0] == state.state_fingerprint(hashes).collect()[0][0] == G.STATE
    assert tuple(state.state_hash(hashes.limit(0)).collect()[0]) == (G.EMPTY_STATE,)
    assert state.state_hash(hashes.union(hashes.limit(1))).collect()[0][0] != G.STATE


def test_state_spreads_hashes_that_begin_alike(spark):
    hashes = [f"fallback_{i}" for i in range(1000)] * 2
    df = spark.createDataFrame([(h,) for h in hashes], "content_hash string")
    assert state.state_hash(df).collect()[0][0] == G.fingerprint(hashes)
    leaves = df.select(F.substring(F.md5("content_hash"), 1, 6)).distinct().count()
    assert leaves > 990


def test_sync_without_stored_hash(spark, d):
    empty = store.state_row(L.source_state(d)).limit(0)
    assert state.check_sync(L.source_state(d), empty).collect()[0].in_sync is False


def test_rejects(spark):
    bad = G.frame(spark, G.bad_rows())
    assert rows(D.invalid_postings(bad), "position", "source_file", "source_line", "narration", "reason") == [
        (1, "/data/b.ledger", 230, "Broken", "amount has no number")]
    with pytest.raises(D.InvalidPostings, match="posting 1 of 'Broken' at /data/b.ledger:230"):
        D.valid_transactions(bad, strict=True)
    assert D.valid_transactions(bad, strict=False).count() == 0


def test_quality_report_of_a_sound_ledger(led):
    report = quality.quality_report({k: v for k, v in led.items() if k in ("transactions", "accounts", "commodities", "tags", "transaction_tags")})
    assert report.filter("violations > 0").count() == 0
    dims = {"accounts": led["accounts"].filter("name <> 'Assets'"), "balance_assertions": led["balance_assertions"]}
    assert rows(quality.quality_report(dims).filter("violations > 0"), "check", "table", "violations") == [
        ("reference", "balance_assertions", 1)]


def test_numeric_violations(spark):
    df = spark.createDataFrame([("1.5",), ("1.23456",), ("12345678901234567",), ("x",), ("1.50000000",), (None,)], "t string")
    assert rows(quality.numeric_violations(df, "t"), "t", "problem") == [
        ("1.23456", "scale loss"), ("12345678901234567", "overflow"), ("x", "not a number")]


def test_resolve_and_get_or_create(spark):
    dim = spark.createDataFrame([("A", 1)], "name string, id int")
    fact = spark.createDataFrame([("A", 5), ("B", 6)], "account string, v int")
    with pytest.raises(registries.UnknownName, match="account 'B'"):
        registries.resolve(fact, dim, "account")
    assert rows(registries.resolve(fact, dim, "account", strict=False), "account", "v", "account_id") == [("A", 5, 1), ("B", 6, None)]
    names = spark.createDataFrame([("A",), ("C",), ("C",)], "name string")
    assert rows(registries.get_or_create(dim, names), "name", "id") == [("A", 1), ("C", None)]


def test_keys_and_references_are_found_by_hash_first(spark):
    work = Workspace(spark, "test")
    long = "a" * 64
    parent = spark.createDataFrame([(long,), (long + "-2",), ("BANK-1",), (None,)], "external_id string")
    child = spark.createDataFrame([(long, 0), (long, 0), (long, 1), ("gone", 0), ("gone", 0), (None, 0), (None, 0), ("BANK-1", None),
                                   ("BANK-1", None), ("bank-1", 2)], "external_id string, posting_idx int")
    keys = {"transactions": ["external_id"], "postings": ["external_id", "posting_idx"]}
    frames = {"transactions": parent, "postings": child}
    found = quality.repeated_keys(frames, keys, work)
    for t, key in keys.items():
        assert rows(found[t], *key, "n") == rows(quality.dup_violations(frames[t], key), *key, "n"), t
    assert found["postings"].count() == 4 and found["transactions"].count() == 0
    lost = quality.rows_without_parent({"postings": child}, parent, "external_id", work)["postings"]
    assert sorted(r.external_id for r in lost.collect()) == ["bank-1", "gone", "gone"]
    blank = lambda df, *names: df.select("*", *[F.lit("x").alias(n) for n in names])
    report = quality.quality_report({"transactions": blank(parent, "date", "flag", "narration"),
                                     "postings": blank(child, "flag", "account", "amount", "currency")})
    got = {(r.check, r.table): r.violations for r in report.filter("check IN ('unique', 'reference')").collect()}
    assert got == {("unique", "transactions"): 0, ("unique", "postings"): 4, ("reference", "postings"): 3}
