import pytest
from pyspark.sql import functions as F

import ledger1 as G
from daybook.operators import transactions as tx
from daybook.plans import load as L
from daybook.schema import TABLES
from daybook.sources import directives as S
from daybook.sources import store
from daybook.streaming.ingest import append_chunks, run_ids_given, stream_ingest

AUDIT = ["created_at", "updated_at", "year"]


@pytest.fixture(scope="module")
def d(spark):
    return G.frame(spark).cache()


def content(spark, root):
    """Every table as sorted rows, without audit times."""
    out = {}
    for t, df in store.read_ledger(spark, root).items():
        out[t] = sorted((tuple(r) for r in df.drop(*AUDIT).collect()), key=str)
    return out


def report(df):
    return {r.action: r.n for r in df.collect()}


def test_load_twice_is_load_once(spark, d, tmp_path):
    root = str(tmp_path / "led")
    assert report(L.load(spark, d, root)) == {"processed": 6, "skipped": 1, "rejected": 0}
    once = content(spark, root)
    assert set(once) == set(TABLES) and once["import_state"] == [(1, G.STATE)]
    assert L.check(spark, d, root).collect()[0].in_sync
    assert report(L.load(spark, d, root)) == {"processed": 0, "skipped": 7, "rejected": 0}
    assert content(spark, root) == once
    assert not L.check(spark, d.filter("seq <> 12"), root).collect()[0].in_sync


def test_resume_completes_a_partial_load(spark, d, tmp_path):
    whole, part = str(tmp_path / "whole"), str(tmp_path / "part")
    L.load(spark, d, whole)
    L.load(spark, d.filter("seq <= 12"), part)
    with pytest.raises(tx.DuplicateIds):
        L.load(spark, d, part, on_duplicate="error")
    L.load(spark, d, part, on_duplicate="error", resume=True)
    assert content(spark, part) == content(spark, whole)
    with pytest.raises(ValueError):
        L.load(spark, d, part, on_duplicate="update")


def test_rollback_then_load_is_load(spark, d, tmp_path):
    root = str(tmp_path / "led")
    L.load(spark, d, root)
    before = content(spark, root)
    deleted = {r.table: r.deleted for r in L.rollback(spark, root, ["elsewhere/b.ledger"]).collect()}
    assert deleted["transactions"] == 2 and deleted["postings"] == 4 and deleted["balance_assertions"] == 3
    after = content(spark, root)
    assert len(after["transactions"]) == 4 and after["accounts"] == before["accounts"] and not after["prices"]
    L.load(spark, d, root)
    assert content(spark, root) == before


def test_rollback_without_transactions_still_clears_facts(spark, d, tmp_path):
    root = str(tmp_path / "led")
    L.load(spark, d.filter("kind <> 'transaction'"), root)
    deleted = {r.table: r.deleted for r in L.rollback(spark, root, ["b.ledger"]).collect()}
    assert deleted["transactions"] == 0 and deleted["prices"] == 1


def test_rebuild_replaces_everything(spark, d, tmp_path):
    root, other = str(tmp_path / "led"), str(tmp_path / "other")
    L.load(spark, d.filter("seq in (4, 10, 20)"), root)
    L.rebuild(spark, d, root)
    L.load(spark, d, other)
    assert content(spark, root) == content(spark, other)


def test_failed_load_leaves_nothing_visible(spark, d, tmp_path, monkeypatch):
    root = str(tmp_path / "led")
    L.load(spark, d.filter("seq <= 12"), root)
    before = content(spark, root)
    write = store.write_table
    for table in ["transactions", "postings", "accounts", "import_state"]:
        def broken(df, name, path, batch=0):
            if name == table:
                raise RuntimeError("lost")
            write(df, name, path, batch)

        monkeypatch.setattr(store, "write_table", broken)
        with pytest.raises(RuntimeError):
            L.load(spark, d, root)
        monkeypatch.undo()
        assert content(spark, root) == before
    whole = str(tmp_path / "whole")
    L.load(spark, d, whole)
    L.load(spark, d, root)
    assert content(spark, root) == content(spark, whole)


def test_preview_writes_nothing_and_foresees_the_load(spark, d, tmp_path):
    root = str(tmp_path / "led")
    L.load(spark, d.filter("seq <= 11"), root)
    before = content(spark, root)
    told = {(r.table, r.action): r.n for r in L.preview(d, store.read_ledger(spark, root)).collect()}
    assert content(spark, root) == before
    done = report(L.load(spark, d, root))
    after = content(spark, root)
    assert told["transactions", "skip"] == done["skipped"] and told["transactions", "create"] == done["processed"]
    for (table, action), n in told.items():
        if action == "create":
            assert len(after[table]) - len(before[table]) == n, table


def test_rejected_transactions(spark, tmp_path):
    both = G.frame(spark, G.rows() + G.bad_rows())
    with pytest.raises(ValueError, match="Broken"):
        L.load(spark, both, str(tmp_path / "strict"))
    assert report(L.load(spark, both, str(tmp_path / "lax"), strict=False)) == {"processed": 6, "skipped": 1, "rejected": 1}


def test_chunks_equal_one_load(spark, d, tmp_path):
    whole, cut = str(tmp_path / "whole"), str(tmp_path / "cut")
    L.load(spark, d, whole)
    append_chunks(spark, d, cut, 2)
    assert store.last_batch(spark, cut, 1) > 4
    a, b = content(spark, whole), content(spark, cut)
    assert a == b


def test_stream_equals_batch_and_resumes(spark, d, tmp_path):
    src, root, checkpoint, whole = (str(tmp_path / n) for n in ["src", "led", "cp", "whole"])
    L.load(spark, d, whole)
    rows = run_ids_given(d).unionByName(d.filter("kind <> 'transaction'")).sort("seq")
    rows.filter("seq <= 12").coalesce(1).write.parquet(src)
    stream_ingest(spark, src, root, checkpoint, max_files=1)
    partial = content(spark, root)
    assert len(partial["transactions"]) == 3
    rows.filter("seq > 12").repartition(3).write.mode("append").parquet(src)
    stream_ingest(spark, src, root, checkpoint, max_files=1)
    batches = store.last_batch(spark, root, 1)
    stream_ingest(spark, src, root, checkpoint, max_files=1)
    assert store.last_batch(spark, root, 1) == batches
    assert L.check(spark, d, root).collect()[0].in_sync
    a, b = content(spark, whole), content(spark, root)
    assert a == b


def test_repeated_micro_batch_is_passed_over(spark, d, tmp_path):
    root = str(tmp_path / "led")
    L.load_batch(spark, d, root, 1, 1, stream="s", epoch=0)
    assert store.has_epoch(spark, root, 1, "s", 0) and not store.has_epoch(spark, root, 1, "s", 1)
    assert not store.has_epoch(spark, root, 1, "other", 0)


def test_load_report(spark, d, tmp_path):
    root = str(tmp_path / "led")
    L.load(spark, d.filter("seq <= 10"), root)
    run = L.prepare(d, store.read_table(spark, root, "transactions"))
    got = {(r.chunk, r.processed, r.skipped) for r in L.load_report(run, 3).collect()}
    assert got == {(1, 2, 1), (2, 2, 1), (3, 1, 0), (None, 5, 2)}


def test_duplicate_report(spark, d, tmp_path):
    root = str(tmp_path / "led")
    L.load(spark, d.filter("seq <= 12"), root)
    t = tx.external_ids(d.filter("kind = 'transaction'"))
    got = tx.duplicate_report(t, store.read_table(spark, root, "transactions")).collect()
    assert {(r.external_id, r.source_line, r.stored_line) for r in got} == {
        (G.H1, 100, 100), (G.H1 + "-2", 110, 110), (G.H3, 120, 120)}


def test_json_source_and_parse_errors(spark, d, tmp_path):
    path = tmp_path / "in"
    d.coalesce(1).write.json(str(path))
    assert report(L.load(spark, S.read_directives(spark, [str(path)], "json"), str(tmp_path / "led"))) == {"processed": 6, "skipped": 1, "rejected": 0}
    assert content(spark, str(tmp_path / "led"))["import_state"] == [(1, G.STATE)]
    (path / "bad.json").write_text('{"seq": 1, "kind": \n')
    back = S.read_directives(spark, [str(path)], "json")
    errors = S.parse_errors(spark, str(path))
    assert back.count() == d.count() + 1 and errors.count() == 1 and "bad.json" in errors.collect()[0].source_file
    with pytest.raises(S.CriticalErrors, match="ParserError"):
        S.assert_no_critical(errors)
    before = content(spark, str(tmp_path / "led"))
    for refused in (lambda: L.load(spark, back, str(tmp_path / "led"), strict=False), lambda: L.rebuild(spark, back, str(tmp_path / "led")),
                    lambda: L.check(spark, back, str(tmp_path / "led")), lambda: L.preview(back, store.read_ledger(spark, str(tmp_path / "led")))):
        with pytest.raises(S.CriticalErrors, match="bad.json"):
            refused()
    assert content(spark, str(tmp_path / "led")) == before
    with pytest.raises(Exception, match="ParserError"):
        stream_ingest(spark, str(path), str(tmp_path / "stream"), str(tmp_path / "cp"), fmt="json")


def test_json_stream_is_the_batch(spark, d, tmp_path):
    src, root, whole = (str(tmp_path / n) for n in ["src", "led", "whole"])
    d.withColumn("source_file", F.when(F.col("kind") != "transaction", F.col("source_file"))).coalesce(1).write.json(src)
    stream_ingest(spark, src, root, str(tmp_path / "cp"), fmt="json")
    L.load(spark, S.read_directives(spark, src, "json"), whole)
    assert content(spark, root) == content(spark, whole)
    assert all(r.source_file.startswith("file:") for r in store.read_table(spark, root, "transactions").collect())


def test_reported_errors(spark, d, tmp_path):
    errors = spark.createDataFrame([("PadError", "m", "f", 1), ("ValidationError", "m", "f", 2)],
                                   "error_type string, message string, source_file string, source_line bigint")
    root = str(tmp_path / "led")
    with pytest.raises(S.CriticalErrors, match="f:2"):
        L.load(spark, d, root, errors=errors)
    assert report(L.load(spark, d, root, errors=errors.limit(1))) == {"processed": 6, "skipped": 1, "rejected": 0, "warnings": 1}


def test_triage(spark):
    errors = spark.createDataFrame([("PadError", "m", "f", 1), ("DeprecatedError", "m", None, None), ("ValidationError", "m", "f", 2)],
                                   "error_type string, message string, source_file string, source_line bigint")
    assert [(r.severity, r.place) for r in S.triage_errors(errors).collect()] == [
        ("warning", "f:1"), ("warning", None), ("critical", "f:2")]
    S.assert_no_critical(errors.limit(2))
    with pytest.raises(S.CriticalErrors, match="ValidationError at f:2"):
        S.assert_no_critical(errors)


def test_many_transactions_meet_their_numbers_where_they_lie(spark, d, tmp_path, monkeypatch):
    plain, dealt = str(tmp_path / "plain"), str(tmp_path / "dealt")
    tables = len(spark.catalog.listTables())
    L.load(spark, d, plain)
    monkeypatch.setattr(L, "MANY", 0)
    L.load(spark, d.filter("seq <= 12"), dealt)
    L.load(spark, d, dealt)                               # against stored ids, too
    assert content(spark, dealt) == content(spark, plain)
    assert len(spark.catalog.listTables()) == tables      # nothing of it stays
    run = L.prepare(d)
    plan = run.fresh._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1
    told = {(r.table, r.action): r.n for r in L.preview(d, store.read_ledger(spark, dealt)).collect()}
    assert told["transactions", "create"] == 0 and told["transactions", "skip"] == 7


def test_ledger_and_state_of_one_run(spark, d):
    led = L.ledger_of(d, whole=True, with_state=True)
    assert [tuple(r) for r in led["import_state"].collect()] == [(1, G.STATE)]


def test_children_that_carry_their_file_roll_back_without_a_join(spark, d):
    files = ["elsewhere/b.ledger"]
    plain, counts = L.rollback_files(L.ledger_of(d), files)
    left, deleted = L.rollback_files(L.ledger_of(d, files=True), files)
    assert sorted(map(tuple, deleted.collect())) == sorted(map(tuple, counts.collect()))
    for t, df in left.items():
        assert df.columns == plain[t].columns and sorted(map(str, df.collect())) == sorted(map(str, plain[t].collect())), t
    assert "LeftAnti" not in left["postings"]._jdf.queryExecution().optimizedPlan().toString()


def test_a_load_lists_only_tables_it_looks_up(spark, d, tmp_path, monkeypatch):
    root, listed, read = str(tmp_path / "led"), [], store.read_folders
    L.load(spark, d, root)
    monkeypatch.setattr(store, "read_folders", lambda spark, root, table, folders: listed.append(table) or read(spark, root, table, folders))
    assert {r.action: r.n for r in L.load(spark, d, root).collect()}["processed"] == 0
    assert set(listed) == set(L.LOOKED_UP)


def test_lines_are_parsed_once_and_files_are_ranked_without_moving_rows(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "0.json").write_text("")                    # no rows, no rank
    (folder / "1.json").write_text('{"seq": 3, "kind": "open"}\n\n{bad\n')
    (folder / "2.json").write_text('{"seq": 4, "kind": "close"}\n')
    (folder / "3.json").write_text('{"seq": 5, "kind": "open", "account": "%s"}\n' % ("x" * S.SHORT))
    back = S.read_directives(spark, str(folder), "json", positions="file")
    assert sorted((r.kind, r.seq) for r in back.filter("kind <> 'unreadable'").collect()) == [("close", 4 + (1 << 40)), ("open", 3), ("open", 5 + (2 << 40))]
    assert [r.description for r in back.filter("kind = 'unreadable'").collect()] == ["{bad"]
    text = back.filter("kind = 'open'")._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json(") == 1 and "BuildRight" in text
