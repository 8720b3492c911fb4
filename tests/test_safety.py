"""What must not happen: lost rows, half loads that surface, rows without keys, folders that stay, work that grows."""

import os
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

import ledger1 as G
from daybook.catalog import QUERIES
from daybook.functions.money import times
from daybook.operators import directives as D
from daybook.operators import temporal
from daybook.operators import transactions as tx
from daybook.operators.analytics import cost_basis, unbalanced
from daybook.plans import load as L
from daybook.sources import directives as S
from daybook.sources import store
from daybook.streaming.ingest import append_chunks, stream_ingest
from test_load import content, report


@pytest.fixture(scope="module")
def d(spark):
    return G.frame(spark).cache()


def test_positions_of_two_files(spark, d, tmp_path):
    """Both files count from 1: every row stays, and the result is that of the files in a row."""
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    first, second = d.filter("seq < 14"), d.filter("seq >= 14")
    first.coalesce(1).write.parquet(a)
    second.withColumn("seq", F.col("seq") - 13).coalesce(1).write.parquet(b)
    both = S.read_directives(spark, [a, b], "parquet", positions="file")
    L.load(spark, both, str(tmp_path / "both"))
    L.load(spark, d, str(tmp_path / "whole"))
    strip = lambda c: c | {"prices": [r[:-1] for r in c["prices"]]}  # noqa: E731  the position itself
    assert strip(content(spark, str(tmp_path / "both"))) == strip(content(spark, str(tmp_path / "whole")))
    with pytest.raises(D.BadPositions, match="positions='file'"):
        L.load(spark, S.read_directives(spark, [a, b], "parquet"), str(tmp_path / "wrong"))
    turned = S.read_directives(spark, [b, a], "parquet", positions="file").filter("source_line = 100").collect()[0]
    assert turned.seq == (1 << S.IN_FILE_BITS) + 10


def test_null_and_repeated_positions(spark, d, tmp_path):
    root = str(tmp_path / "led")
    for bad in (d.withColumn("seq", F.when(F.col("seq") != 12, F.col("seq"))), d.union(d.filter("seq = 12")),
                d.withColumn("seq", F.when(F.col("seq") == 20, 12).otherwise(F.col("seq")))):
        with pytest.raises(D.BadPositions):
            L.load(spark, bad, root)
    assert store.current_version(spark, root) == 0


def test_save_state_after_a_broken_load(spark, d, tmp_path, monkeypatch):
    """The batch number is taken again, and nothing of the broken attempt comes with it."""
    root = str(tmp_path / "led")
    L.load(spark, d.filter("seq <= 12"), root)
    before, write = content(spark, root), store.write_table

    def broken(df, table, path, batch=0):
        write(df, table, path, batch)
        if table == "import_state":
            raise RuntimeError("lost")

    for left in (False, True):  # also where the attempt could not clean up
        monkeypatch.setattr(store, "write_table", broken)
        if left:
            monkeypatch.setattr(store, "delete", lambda *a: None)
        with pytest.raises(RuntimeError):
            L.load(spark, d, root)
        monkeypatch.undo()
        store.save_state(spark, root, L.source_state(d.filter("seq <= 12")))
        assert content(spark, root) == before
    append_chunks(spark, d, root, 2)
    whole = str(tmp_path / "whole")
    L.load(spark, d, whole)
    assert content(spark, root) == content(spark, whole)


def test_broken_stream_goes_on(spark, d, tmp_path, monkeypatch):
    """A micro-batch that dies leaves nothing; the restart loads it, and a rollback works on what both left."""
    src, root, whole = (str(tmp_path / n) for n in ["src", "led", "whole"])
    d.filter("seq <= 12").coalesce(1).write.parquet(src)
    stream_ingest(spark, src, root, str(tmp_path / "cp"), max_files=1)
    before, write = content(spark, root), store.write_table
    d.filter("seq > 12").coalesce(1).write.mode("append").parquet(src)

    def broken(df, table, path, batch=0):
        write(df, table, path, batch)
        if table == "prices":
            raise RuntimeError("lost")
    monkeypatch.setattr(store, "write_table", broken)
    with pytest.raises(Exception, match="lost"):
        stream_ingest(spark, src, root, str(tmp_path / "cp"), max_files=1)
    monkeypatch.undo()
    assert content(spark, root) == before
    stream_ingest(spark, src, root, str(tmp_path / "cp"), max_files=1)
    L.load(spark, d, whole)
    assert content(spark, root) == content(spark, whole)
    L.rollback(spark, root, ["b.ledger"])
    L.rollback(spark, whole, ["b.ledger"])
    assert content(spark, root) == content(spark, whole)


def test_broken_rollback_changes_nothing(spark, d, tmp_path, monkeypatch):
    root = str(tmp_path / "led")
    L.load(spark, d, root)
    before, write = content(spark, root), store.write_table

    def broken(df, table, path, batch=0):
        if table == "transaction_tags":
            raise RuntimeError("lost")
        write(df, table, path, batch)
    monkeypatch.setattr(store, "write_table", broken)
    with pytest.raises(RuntimeError):
        L.rollback(spark, root, ["b.ledger"])
    monkeypatch.undo()
    assert content(spark, root) == before and store.current_version(spark, root) == 1


@pytest.mark.parametrize("change, what", [
    (lambda d: d.withColumn("date", F.when(F.col("seq") != 12, F.col("date"))), "transaction at /data/a.ledger:120 has no date"),
    (lambda d: d.withColumn("account", F.when(F.col("seq") != 18, F.col("account"))), "balance at /data/b.ledger:180 has no account"),
    (lambda d: d.withColumn("number", F.when(F.col("seq") != 20, F.col("number"))), "price at /data/b.ledger:200 has no number"),
    (lambda d: d.withColumn("postings", F.when(F.col("seq") != 15, F.col("postings")).otherwise(
        F.transform("postings", lambda p: p.withField("account", F.lit(None).cast("string"))))), "transaction at /data/b.ledger:150 has no account")])
def test_required_values(spark, d, tmp_path, change, what):
    bad, root = change(d), str(tmp_path / "led")
    with pytest.raises(D.MissingValues, match=what):
        L.load(spark, bad, root)
    assert report(L.load(spark, bad, root, strict=False))["rejected"] == 1
    once = content(spark, root)
    L.load(spark, bad, root, strict=False)
    assert content(spark, root) == once
    for table, columns in {"transactions": ["external_id", "date"], "postings": ["account", "date"], "balance_assertions": ["account"],
                           "prices": ["price_amount"]}.items():
        for c in columns:
            assert store.read_table(spark, root, table).filter(F.col(c).isNull()).isEmpty()


def test_created_at_survives_a_close(spark, d, tmp_path):
    root = str(tmp_path / "led")
    L.load(spark, d.filter("seq < 5"), root)
    made = {r.name: r.created_at for r in store.read_table(spark, root, "accounts").collect()}
    L.load(spark, d, root)
    now = {r.name: (r.status, r.created_at) for r in store.read_table(spark, root, "accounts").collect()}
    assert now["Assets:Checking"] == ("closed", made["Assets:Checking"]) and made["Assets:Checking"] is not None
    assert now["Assets:Savings"][1] > made["Assets:Checking"]
    for t in ("commodities", "postings", "transactions"):
        assert store.read_table(spark, root, t).filter("created_at IS NULL").isEmpty()


def folders(path):
    return {os.path.join(a, x) for a, ds, _ in os.walk(path) for x in ds}


def test_checks_stage_little_and_leave_nothing(spark, d, tmp_path, monkeypatch):
    root, shared = str(tmp_path / "led"), spark.conf.get("spark.checkpoint.dir")
    L.load(spark, d, root)
    before, staged = folders(shared), []
    stage = L.Workspace.stage
    monkeypatch.setattr(L.Workspace, "stage", lambda self, df, name, *by: staged.append(df.schema) or stage(self, df, name, *by))
    L.check(spark, d, root).collect()
    L.preview(d, store.read_ledger(spark, root)).collect()
    assert folders(shared) == before
    assert staged and all("array" not in s.simpleString() and "map" not in s.simpleString() for s in staged)


def test_rollback_leaves_other_folders(spark, d, tmp_path):
    root = str(tmp_path / "led")
    older = d.withColumn("date", F.date_sub("date", 730)).withColumn("seq", F.col("seq") + 100)
    L.load(spark, d.union(older.filter("seq between 115 and 116 or seq = 120").withColumn("source_file", F.lit("/data/old.ledger"))), root)
    before = {r.folder for r in store.marks(spark, root, 1).collect() if r["name"] in ("transactions", "postings", "prices")}
    L.rollback(spark, root, ["old.ledger"])
    after = {r.folder for r in store.marks(spark, root, 2).collect() if r["name"] in ("transactions", "postings", "prices")}
    kept = before & after
    assert kept and all("year=2022" not in f for f in kept) and {f for f in before if "year=2022" not in f} == kept
    plain = str(tmp_path / "plain")
    L.load(spark, d, plain)
    assert content(spark, root)["postings"] == content(spark, plain)["postings"]
    assert content(spark, root)["transaction_links"] == content(spark, plain)["transaction_links"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_side_is_pruned_by_year(spark, d, tmp_path):
    root = str(tmp_path / "led")
    L.load(spark, d, root)
    led = store.read_ledger(spark, root)
    generated = plan(tx.stored_ids(led["transactions"], [2024], given=False))
    prices = plan(L.fact_rows(d, led)["prices"])
    for text in (generated, prices):
        assert "PartitionFilters: [isnotnull(year" in text or "PartitionFilters: [year" in text
    assert "Aggregate" not in prices


def test_chunks_write_each_table_once(spark, d, tmp_path, monkeypatch):
    calls, write = [], store.write_table
    monkeypatch.setattr(store, "write_table", lambda df, table, *a: calls.append(table) or write(df, table, *a))
    for size in (1, 3):
        calls.clear()
        append_chunks(spark, d, str(tmp_path / f"led{size}"), size)
        assert calls.count("postings") == 3  # registries, chunks, facts
    assert content(spark, str(tmp_path / "led1")) == content(spark, str(tmp_path / "led3"))
    assert store.last_batch(spark, str(tmp_path / "led1"), 1) > store.last_batch(spark, str(tmp_path / "led3"), 1)


def test_products_are_exact(spark):
    values = ["999999999999999.9999", "-999999999999999.9999", "123456789012345.6789", "12345678901234.5678", "0.0001", "-0.0001", "0", "-1.5", "7"]
    rows = [(Decimal(a), Decimal(b)) for a in values for b in values if abs(Fraction(a) * Fraction(b)) < 10 ** 29]
    df = spark.createDataFrame(rows, "a decimal(19,4), b decimal(19,4)")
    for r in df.select("a", "b", times(F.col("a"), F.col("b")).alias("c")).collect():
        assert Fraction(r.c) == Fraction(r.a) * Fraction(r.b)
    with pytest.raises(ArithmeticException):
        spark.createDataFrame([(Decimal(values[0]), Decimal(values[0]))], df.schema).select(times(F.col("a"), F.col("b"))).collect()


def test_wide_costs(spark):
    cost = Decimal("123456789012345.1234")
    p = spark.createDataFrame([("t", "A", Decimal("2.5"), "X", cost, "USD", None, None), ("t", "B", Decimal("-2.5"), "X", cost, "USD", None, None)],
                              "external_id string, account string, amount decimal(19,4), currency string, cost_amount decimal(19,4), "
                              "cost_currency string, price_amount decimal(19,4), price_currency string")
    assert unbalanced({"postings": p}).count() == 0
    assert {r.account: r.cost for r in cost_basis({"postings": p}).collect()} == {"A": Decimal("308641972530862.80850000"), "B": Decimal("-308641972530862.80850000")}


def test_costs_wider_than_stored(spark):
    """Costs of 16 and 19 whole digits."""
    rows = [("A", Decimal("2.5"), Decimal("1502400000021979.3645")), ("B", Decimal("-0.0003"), Decimal("9999999999999999999.9999"))]
    p = spark.createDataFrame(rows, "account string, amount decimal(19,4), cost_amount decimal(23,4)").withColumns({"currency": F.lit("X"), "cost_currency": F.lit("USD")})
    assert {r.account: r.cost for r in cost_basis({"postings": p}).collect()} == {r[0]: r[1] * r[2] for r in rows}


def test_wide_query_with_large_part_keys(spark, tmp_path):
    """Part keys of 10,000 and more, as larger tables have."""
    spark.range(1).selectExpr("1L AS o_orderkey", "TIMESTAMP '1996-01-02' AS o_orderdate").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, 15024, 1, 1, 17.0, 21978.13, 0.04, "N", "O")], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string").withColumn("l_shipdate", F.lit("1996-02-01").cast("timestamp")).write.parquet(str(tmp_path / "lineitem.parquet"))
    cost, amount = Decimal(15024) * 10 ** 11 + Decimal("1.2345"), Decimal("21978.13")
    want = {(int(a * 10 ** 4), int(a * (cost + a) * 10 ** 8)) for a in (amount, -amount)}
    assert {(int(r.units_e4), int(r.cost_e8)) for r in QUERIES["a18_cost_basis_wide"](spark, str(tmp_path)).collect()} == want


def test_last_quote_of_a_day_follows_the_import(spark, d, tmp_path):
    quotes = [G.row(1, "price", "2024-01-10", currency="EUR", number="1.10", number_currency="USD", source_line=9, source_file="z"),
              G.row(2, "price", "2024-01-10", currency="EUR", number="2.00", number_currency="USD", source_line=9, source_file="a"),
              G.row(3, "price", "2024-01-10", currency="EUR", number="3.00", number_currency="USD", source_line=1, source_file="m")]
    asked = spark.createDataFrame([("EUR",)], "commodity string").withColumn("date", F.lit("2024-02-01").cast("date"))
    for i, order in enumerate([[0, 1, 2], [2, 1, 0]]):
        root = str(tmp_path / f"led{i}")
        L.load(spark, G.frame(spark, [quotes[k] for k in order]), root)
        got = temporal.prices_as_of(store.read_table(spark, root, "prices"), asked).collect()
        assert [r.price_amount for r in got] == [Decimal("3.0000")]


def test_a_load_joins_transactions_once(spark, d, tmp_path, monkeypatch):
    """Six tables come from one staged result: nothing is joined or moved again for each of them."""
    plans, write = {}, store.write_table
    monkeypatch.setattr(store, "write_table", lambda df, table, *a: plans.update({table: plan(df)}) or write(df, table, *a))
    L.load(spark, d, str(tmp_path / "led"))
    for table in ["transactions", *L.CHILDREN]:
        assert "Join" not in plans[table] and "Exchange" not in plans[table]
    files = [f for _, _, fs in os.walk(tmp_path / "led" / "data" / "postings") for f in fs if f.endswith(".parquet")]
    assert len(files) <= 2 and all("zstd" in f for f in files)      # one piece, its years


def test_many_chunks_share_commits(spark, d, tmp_path, monkeypatch):
    from daybook.streaming import ingest
    monkeypatch.setattr(ingest, "COMMITS", 3)
    append_chunks(spark, d, str(tmp_path / "cut"), 1)
    L.load(spark, d, str(tmp_path / "whole"))
    assert content(spark, str(tmp_path / "cut")) == content(spark, str(tmp_path / "whole"))
    chunked = [r.folder for r in store.marks(spark, str(tmp_path / "cut"), 1).filter("name = 'postings'").collect()]
    assert len({f.split("/")[2] for f in chunked}) in (2, 3)


def test_given_ids_that_look_generated(spark, d, tmp_path):
    """A given id equal to a generated one of the run still repeats it."""
    first = L.prepare(d).ids.filter("external_id = content_hash").orderBy("seq").limit(1).collect()[0]
    copy = d.filter("kind = 'transaction'").limit(1).withColumns(
        {"seq": F.lit(999).cast("bigint"), "meta": F.create_map(F.lit("transaction_id"), F.lit(first.external_id))})
    run = L.prepare(d.unionByName(copy))
    assert 999 in [r.seq for r in run.later.collect()]


def test_stored_ids_are_found_by_hash_or_not(spark, monkeypatch):
    new = spark.createDataFrame([(i, f"id{i % 40}") for i in range(60)] + [(99, None)], "seq long, external_id string")
    old = spark.createDataFrame([(f"id{i}",) for i in range(20, 90)] + [(None,)], "external_id string")
    split = lambda: [sorted(map(tuple, x.collect()), key=str) for x in tx.split_new(new, old)]
    few = split()
    monkeypatch.setattr(tx, "FEW", 0)
    assert few == split() and len(few[1]) == 20


def test_packed_hashes(spark):
    from daybook.functions.identity import packed, unpacked
    texts = ["ab" * 32, "AB" * 32, "fallback_12345678", "", "h" * 33, None, "cd" * 32 + "-12", "cd" * 33 + "é"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", packed("t"))
    assert [r[0] for r in df.select(unpacked("p")).collect()] == texts
    assert df.filter("p is not null").select("p").distinct().count() == 7
    assert [r[0] for r in df.select(F.length("p")).collect()] == [33, 65, 18, 1, 34, None, 36, 37]


def test_rollback_with_and_without_file_names_in_children(spark, d, tmp_path):
    """Children of a loaded ledger name their file; those written without are found by their transaction."""
    named, plain = str(tmp_path / "named"), str(tmp_path / "plain")
    L.load(spark, d, named)
    store.write_ledger(spark, L.ledger_of(d, whole=True), plain)
    held = lambda root, table: store.read_folders(spark, root, table, store._folders(store.marks(spark, root, 1), None)[table])
    for table in L.CHILDREN:
        assert held(named, table).filter("file_name IS NULL").isEmpty()
        assert held(plain, table).filter("file_name IS NOT NULL").isEmpty()
    deleted = [{r.table: r.deleted for r in L.rollback(spark, root, ["b.ledger"]).collect()} for root in (named, plain)]
    assert deleted[0] == deleted[1] and deleted[0]["postings"] > 0
    left = [{t: sorted(map(str, store.read_table(spark, root, t).drop("created_at", "updated_at", "year").collect())) for t in L.CHILDREN} for root in (named, plain)]
    assert left[0] == left[1]


def test_an_empty_ledger_is_not_searched(spark, d, tmp_path, monkeypatch):
    from daybook.operators import transactions
    monkeypatch.setattr(transactions, "split_new", lambda *a, **k: 1 / 0)
    L.load(spark, d, str(tmp_path / "ledger"))
    run = L.prepare(d, stage_ids=False)
    hashes = lambda of: sorted(r.content_hash for r in L.state.run_hashes(of, run.later).collect())
    assert hashes(run.hashes) == hashes(run.ids)
