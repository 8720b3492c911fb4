"""Loading a run of directives into a ledger."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.accounts import basename
from daybook.functions.identity import GENERATED
from daybook.functions.metadata import stored_meta
from daybook.operators import facts, registries, state
from daybook.operators import transactions as tx
from daybook.operators.directives import (assert_complete, assert_positions, assert_valid, has_invalid_posting,
                                          missing_values, of_kind)
from daybook.operators.numbering import later_repeats, number_runs
from daybook.schema import CHILDREN, DIRECTIVE, KINDS, REQUIRED, SOURCED
from daybook.sources import store
from daybook.sources.directives import assert_no_critical, unreadable
from daybook.sources.workspace import Workspace, workspace

POLICIES = ["skip", "error"]
FILE_ROWS = 2 ** 18      # transactions of one written file, over all years
MANY = 2 ** 20           # transactions that are staged in buckets, numbers that are not broadcast
POSTED = ["account", "number", "currency", "cost_number", "cost_currency", "price_number", "price_currency", "flag", "meta"]
STORED = ["date", "source_file", "source_line", "flag", "payee", "narration", "tags", "links", "meta", "postings"]
TRANSACTION_COLUMNS = ["seq", "date", "source_file", "source_line", "flag", "payee", "narration", "tags", "links",
                       "meta", "postings", "given_id", "content_hash", "invalid"]
# Tables that a load looks up; it adds to the others unseen.
LOOKED_UP = ["transactions", "commodities", "accounts", "tags", "links", *SOURCED]


@dataclass
class Run:
    """A run of directives with its ids worked out.

    `directives` is staged, transactions apart from other kinds and with their given_id,
    content_hash and invalid flag, so that the steps on ids read no nested column; of a narrow
    run it holds transactions only, with the sizes of their children in place of them.
    `ids` (seq, external_id, content_hash), staged where asked for, `later` (seq of repeated ids after their first) and
    `skipped` (seq, reason) are narrow tables; `hashes` (seq, content_hash, given) are what `ids` holds but their names, unnumbered, with
    given true where an id can repeat; `fresh` are the transactions to store, a lazy scan of the staged
    directives; `rejected` counts directives left out because something required is missing; `years` are those
    of the transactions; `accepted` and `changed` are what `fresh` joins: complete transactions, and (seq, n) of those with a
    suffix or (n = 0) skipped."""

    directives: DataFrame
    ids: DataFrame
    later: DataFrame
    skipped: DataFrame
    fresh: DataFrame
    rejected: int
    years: list[int]
    accepted: DataFrame
    changed: DataFrame
    hashes: DataFrame


def child_counts() -> dict[str, Column]:
    """Rows that a transaction adds to the tables of its children, from its arrays and maps."""
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    labels = lambda c: F.array_compact(F.array_distinct(c))
    post_meta = F.aggregate(F.transform("postings", lambda p: size(stored_meta(p["meta"]))), F.lit(0), lambda a, x: a + x)
    return {"postings": size("postings"), "transaction_metadata": size(stored_meta("meta")),
            "posting_metadata": F.coalesce(post_meta, F.lit(0)), "transaction_tags": size(labels("tags")),
            "transaction_links": size(labels("links"))}


def prepare(d: DataFrame, stored: DataFrame | None = None, work: Workspace | None = None, strict: bool = False,
            narrow: bool = False, stage_ids: bool = True) -> Run:
    """Read the input once, number its ids and find what a load skips: a 'repeat' of an earlier
    id of the run, or an id 'stored' already.

    Refuses unreadable lines, and null or repeated positions; strict also directives that lack something
    required. `stage_ids`: the caller reads ids; else they are only numbered where something has to be looked up.
    Every later step reads only the columns and kinds it needs. Rows that need a suffix or
    are skipped form a narrow table; all others are never shuffled before they are written."""
    work = workspace(d, work)
    all_marked = tx.identified(of_kind(d, "transaction")).withColumn("invalid", has_invalid_posting() | missing_values().isNotNull())
    # many transactions are dealt by seq as they are staged: they meet their numbers where they lie
    n = of_kind(d, "transaction").count()
    buckets = max(-(-n // FILE_ROWS), int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))) if n > MANY else 0
    staged_t = lambda df: work.stage_buckets(df, "transactions", "seq", buckets) if buckets else work.stage(df, "transactions")
    if narrow:
        columns = ["seq", "date", "given_id", "content_hash", "invalid", *[c.alias(f"n_{t}") for t, c in child_counts().items()]]
        all_t = staged_t(all_marked.select(*columns))
        staged, others = all_t.withColumn("kind", F.lit("transaction")), d.filter("kind <> 'transaction'")
    else:
        # two jobs side by side: nested transaction rows, and the flat rows of all other kinds
        with ThreadPoolExecutor(max_workers=2) as pool:
            jobs = [pool.submit(staged_t, all_marked.select(*TRANSACTION_COLUMNS)),
                    pool.submit(work.stage, d.filter("kind <> 'transaction'").drop("postings", "tags", "links"), "others")]
            all_t, others = [job.result() for job in jobs]
        all_t = all_t.withColumn("kind", F.lit("transaction"))
        staged = all_t.unionByName(others.filter(_complete(others)), allowMissingColumns=True)
    assert_no_critical(unreadable(others))
    assert_positions(all_t.select("seq").unionByName(of_kind(others, *KINDS).select("seq")))
    # what is to know of all transactions, at once
    usable = ~F.col("invalid")
    seen = all_t.agg(F.count_if("invalid").alias("invalid"), F.sort_array(F.collect_set(F.when(usable, F.year("date")))).alias("years"),
                     F.count_if(usable & F.col("given_id").isNotNull()).alias("given"),
                     F.count_if(usable & F.col("given_id").rlike(GENERATED)).alias("imitated")).collect()[0]
    if strict and seen.invalid:
        assert_valid(d)
        assert_complete(of_kind(d, "transaction"))
    if strict:
        assert_complete(others.withColumn("postings", F.lit(None).cast(DIRECTIVE["postings"].dataType)))
    rejected = 0 if strict else seen.invalid + of_kind(others, *KINDS).filter(~_complete(others)).count()
    t = all_t.filter("NOT invalid")
    years = seen.years
    repeats = _unsorted(work.stage(tx.repeat_numbers(t, work), "repeats"))
    # an id is worked out from its hash wherever it is read: a second hash in the file would double it
    # a generated id is its hash and a number of its own: only given ids can repeat, or ids that a given one imitates
    given_ids = t.filter("given_id IS NOT NULL").select("seq", F.col("given_id").alias("external_id"))
    imitated = seen.imitated > 0
    ids = tx.numbered(t.select("seq", "content_hash", "given_id"), repeats)
    ids = tx.named(work.stage(ids, "ids") if stage_ids or imitated or stored is not None else ids)
    ids = ids.select("seq", "external_id", "content_hash", F.col("given_id").isNotNull().alias("given"))
    keys = ids.select("seq", "external_id") if imitated else given_ids
    later = work.stage(later_repeats(keys, "external_id", "seq", work), "later")
    skipped = later.select("seq", F.lit("repeat").alias("reason"))
    if stored is not None:
        old = [tx.split_new(ids.filter(F.col("given") == given).select("seq", "external_id"), tx.stored_ids(stored, years, given), unique=not given)[1]
               for given in (False, True) if not given or seen.given]
        old = reduce(DataFrame.unionByName, old).select("seq", F.lit("stored").alias("reason"))
        skipped = work.stage(old.unionByName(skipped).groupBy("seq").agg(F.max("reason").alias("reason")), "skipped")
    changed = (repeats.unionByName(skipped.select("seq", F.lit(0).cast("bigint").alias("n")))
               .groupBy("seq").agg(F.min("n").alias("n")))
    # staged, so that Spark knows its size and moves no wide rows for a short list
    changed = _unsorted(work.stage(changed, "changed"))
    hashes = t.select("seq", "content_hash", F.lit(True).alias("given") if imitated else F.col("given_id").isNotNull().alias("given"))
    return Run(staged, ids.drop("given"), later, skipped, tx.numbered_ids(t, changed), rejected, years, t, changed, hashes)


def _unsorted(staged: DataFrame) -> DataFrame:
    """A staged list whose joins sort no rows: a short one is broadcast, of a long one each task looks up its bucket's rows."""
    return staged.hint("shuffle_hash") if staged.count() > MANY else staged


def staged_fresh(run: Run, work: Workspace) -> DataFrame:
    """The transactions to store with what their tables hold, staged: they meet their numbers once, not once for each table.
    They are read in pieces of some FILE_ROWS transactions, of which each writes a file per year."""
    labels = lambda c: F.array_compact(F.array_distinct(c))
    posting = lambda p: F.struct(*[(stored_meta(p["meta"]) if f == "meta" else p[f]).alias(f) for f in POSTED])
    # only what is stored moves
    kept = {"tags": labels("tags"), "links": labels("links"), "meta": stored_meta("meta"), "postings": F.transform("postings", posting)}
    narrow = run.accepted.select("seq", "content_hash", "given_id", *[kept.get(c, F.col(c)).alias(c) for c in STORED])
    fresh = tx.named(work.stage(tx.numbered(narrow, run.changed), "fresh"))
    return fresh.coalesce(max(1, -(-fresh.count() // FILE_ROWS)))


def _complete(others: DataFrame) -> Column:
    """True for directives other than transactions that have all that is required."""
    reason = F.lit(None).cast("string")
    for kind, columns in REQUIRED.items():
        for c in reversed(columns):
            if kind != "transaction":
                reason = F.when((F.col("kind") == kind) & F.col(c).isNull(), F.lit(c)).otherwise(reason)
    return reason.isNull()


def registry_rows(d: DataFrame, led: dict[str, DataFrame] | None) -> dict[str, DataFrame]:
    """New (for accounts also changed) registry rows."""
    old = lambda name: None if led is None else led[name]
    return {
        "commodities": registries.build_commodities(d, old("commodities")),
        "accounts": registries.build_accounts(d, old("accounts")),
        "tags": registries.build_tags(d, old("tags")),
        "links": registries.build_links(d, old("links")),
    }


def fact_rows(d: DataFrame, led: dict[str, DataFrame] | None) -> dict[str, DataFrame]:
    """New rows of the facts that belong to no transaction. Stored ones are looked up in the years of the new."""
    built = {
        "balance_assertions": facts.build_balances(d),
        "prices": facts.build_prices(d),
        "ledger_events": facts.build_events(d),
        "ledger_documents": facts.build_documents(d),
    }
    if led is None:
        return built
    dated = of_kind(d, "balance", "price", "event", "document").select("kind", F.year("date").alias("y")).distinct()
    years: dict[str, list[int]] = {}
    for r in dated.filter("y IS NOT NULL").collect():
        years.setdefault(r.kind, []).append(r.y)
    kinds = dict(zip(built, ("balance", "price", "event", "document")))
    return {t: facts.unseen_facts(df, led[t], years.get(kinds[t], [])) for t, df in built.items()}


def transaction_rows(t: DataFrame, *keep: str, files: bool = False) -> dict[str, DataFrame]:
    """Rows of the transaction tables; `t` carries external_id and content_hash, and what to keep beside.

    `files`: children carry their transaction's source_file too, so that a rollback finds them by it."""
    child = [*keep, *["source_file"] * files]
    return {
        "transactions": facts.build_transactions(t, *keep),
        "postings": facts.build_postings(t, *child),
        "transaction_metadata": facts.build_txn_meta(t, *child),
        "posting_metadata": facts.build_post_meta(t, *child),
        "transaction_tags": facts.build_txn_tags(t, *child),
        "transaction_links": facts.build_txn_links(t, *child),
    }


def new_rows(t: DataFrame, d: DataFrame, led: dict[str, DataFrame] | None, files: bool = False) -> dict[str, DataFrame]:
    """Everything a load adds: children of the new transactions `t`, registries and other facts of `d`."""
    return transaction_rows(t, files=files) | registry_rows(d, led) | fact_rows(d, led)


def ledger_of(d: DataFrame, work: Workspace | None = None, whole: bool = False, with_state: bool = False,
              files: bool = False) -> dict[str, DataFrame]:
    """All tables of a ledger that holds just this run. `whole`: most of them will be read, so their transactions are staged.

    `with_state`: the state row too, from the same run; `files`: see transaction_rows."""
    work = workspace(d, work)
    run = prepare(d, work=work, stage_ids=False)
    tables = new_rows(staged_fresh(run, work) if whole else run.fresh, run.directives, None, files)
    if with_state:
        tables["import_state"] = store.state_row(state.state_hash(state.run_hashes(run.hashes, run.later)))
    return tables


def load_batch(spark: SparkSession, d: DataFrame, root: str, version: int, batch: int, *, on_duplicate: str = "skip",
               resume: bool = False, strict: bool = True, with_state: bool = True, stream: str = "",
               epoch: int | None = None, errors: DataFrame | None = None) -> DataFrame:
    """Load one run as one batch and return its report (action, n).

    `errors` are problems that a parser reports with the run: critical ones refuse it, warnings are counted."""
    if on_duplicate not in POLICIES:
        raise ValueError(f"on_duplicate must be one of {POLICIES}")
    warned = None if errors is None else assert_no_critical(errors)
    led = store.read_ledger(spark, root, version, batch - 1, LOOKED_UP)
    with Workspace(spark, "load") as work:
        stored = led["transactions"]
        # nothing is looked up in an empty ledger
        run = prepare(d, None if stored.isEmpty() else stored, work, strict, stage_ids=False)
        if on_duplicate == "error" and not resume and not run.skipped.isEmpty():
            seq, reason = run.skipped.limit(1).collect()[0]
            raise tx.DuplicateIds(f"transaction {seq} repeats an id ({reason})")
        tables = new_rows(staged_fresh(run, work), run.directives, led, files=True)
        if with_state:
            tables["import_state"] = store.state_row(state.state_hash(state.run_hashes(run.hashes, run.later)))
        store.write_batch(spark, tables, root, version, batch, stream, epoch)
        total, dropped = run.accepted.count(), run.skipped.count()
    rows = [("processed", total - dropped), ("skipped", dropped), ("rejected", run.rejected)]
    return spark.createDataFrame(rows + [("warnings", warned)] * (warned is not None), "action string, n bigint")


def load(spark: SparkSession, d: DataFrame, root: str, *, on_duplicate: str = "skip", resume: bool = False,
         strict: bool = True, with_state: bool = True, errors: DataFrame | None = None) -> DataFrame:
    """Append a run to the ledger at `root`; loading the same run again adds nothing.

    `resume` skips stored transactions whatever the duplicate policy says; `errors`: see load_batch."""
    version = max(store.current_version(spark, root), 1)
    batch = store.last_batch(spark, root, version) + 1
    report = load_batch(spark, d, root, version, batch, on_duplicate=on_duplicate, resume=resume, strict=strict,
                        with_state=with_state, errors=errors)
    store.publish(spark, root, version)
    return report


def rebuild(spark: SparkSession, d: DataFrame, root: str, *, strict: bool = True, errors: DataFrame | None = None) -> DataFrame:
    """Replace everything: load into an empty new version and publish it when it is complete."""
    version = store.current_version(spark, root) + 1
    report = load_batch(spark, d, root, version, 1, strict=strict, errors=errors)
    store.publish(spark, root, version)
    return report


def doomed_transactions(led: dict[str, DataFrame], files: list[str]) -> DataFrame:
    """Transactions that came from the given files, compared by base name."""
    names = sorted({f.rsplit("/", 1)[-1] for f in files})
    return led["transactions"].filter(basename("source_file").isin(names)).select("external_id")


def rollback_files(led: dict[str, DataFrame], files: list[str]) -> tuple[dict[str, DataFrame], DataFrame]:
    """(ledger without everything from the files, deleted rows per table).

    Dimensions and the state row stay. Dated facts go even when no transaction does. Children that carry their transaction's
    source_file are found by it, others by their transaction; children come back without it."""
    names = sorted({f.rsplit("/", 1)[-1] for f in files})
    gone = doomed_transactions(led, files)
    from_files = F.coalesce(basename("source_file").isin(names), F.lit(False))
    kept, counts = dict(led), []
    count = lambda df, table: df.agg(F.count(F.lit(1)).alias("deleted")).select(F.lit(table).alias("table"), "deleted")
    for table in ["transactions"] + [s for s in SOURCED if s in led]:
        kept[table] = led[table].filter(~from_files)
        counts.append(count(led[table].filter(from_files), table))
    for table in [c for c in CHILDREN if c in led]:
        if "source_file" in led[table].columns:
            kept[table] = led[table].filter(~from_files).drop("source_file")
            counts.append(count(led[table].filter(from_files), table))
            continue
        kept[table] = led[table].join(gone, "external_id", "left_anti").select(*led[table].columns)
        counts.append(count(led[table].join(gone, "external_id", "left_semi"), table))
    return kept, reduce(DataFrame.unionByName, counts)


def rollback(spark: SparkSession, root: str, files: list[str]) -> DataFrame:
    """Delete everything that came from the files (compared by base name) and publish the rest as a new version.

    Years and batches that hold nothing from the files are not written again."""
    names = sorted({f.rsplit("/", 1)[-1] for f in files})
    deleted = store.without_files(spark, root, names)
    tables = ["transactions", *SOURCED, *CHILDREN]
    return spark.createDataFrame([(t, deleted.get(t, 0)) for t in tables], "table string, deleted bigint")


def preview(d: DataFrame, led: dict[str, DataFrame]) -> DataFrame:
    """What a load would do, without writing: (table, action, n). Stored duplicates count as skipped.

    Only ids, hashes and the numbers of children are staged, and nothing stays."""
    spark = d.sparkSession
    with Workspace(spark, "preview") as work:
        run = prepare(d, led["transactions"], work, narrow=True)
        t = run.directives.filter("NOT invalid")
        fresh = F.col("_skip").isNull()
        sizes = {("transactions", "create"): F.count_if(fresh), ("transactions", "skip"): F.count_if(~fresh)}
        sizes |= {(table, "create"): F.coalesce(F.sum(F.when(fresh, F.col(f"n_{table}"))), F.lit(0)) for table in child_counts()}
        marked = t.join(run.skipped.select("seq", F.lit(True).alias("_skip")), "seq", "left")
        row = marked.agg(*[c.cast("bigint").alias(f"c{i}") for i, c in enumerate(sizes.values())]).collect()[0]
        counted = [(table, action, n) for (table, action), n in zip(sizes, row)]
        others = d.filter(_complete(d))
        tables = registry_rows(others, led) | fact_rows(others, led)
        accounts = tables.pop("accounts")
        held = led["accounts"].select("name")
        parts = [_count(df, table, "create") for table, df in tables.items()]
        parts += [_count(accounts.join(held, "name", "left_anti"), "accounts", "create"),
                  _count(accounts.filter("status = 'closed'"), "accounts", "close")]
        counted += [tuple(r) for r in reduce(DataFrame.unionByName, parts).collect()]      # a row per table
    return spark.createDataFrame(counted, "table string, action string, n bigint")


def _count(df: DataFrame, table: str, action: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(table).alias("table"), F.lit(action).alias("action"), "n")


def load_report(run: Run, chunk_size: int = 500) -> DataFrame:
    """Processed and skipped transactions per chunk of the import order, and in total (chunk null)."""
    skipped = run.skipped.select("seq", F.lit(1).alias("skip"))
    numbered = number_runs(run.ids.select("seq"), [], "seq").join(skipped, "seq", "left")
    chunk = F.floor((F.col("n") - 1) / chunk_size).cast("bigint") + 1
    return (numbered.withColumn("chunk", chunk).rollup("chunk")
            .agg(F.count_if(F.col("skip").isNull()).alias("processed"), F.count_if(F.col("skip") == 1).alias("skipped")))


def source_state(d: DataFrame) -> DataFrame:
    """State hash of a run of directives. Only ids and hashes are staged, and nothing stays."""
    with Workspace(d.sparkSession, "state") as work:
        run = prepare(d, work=work, narrow=True, stage_ids=False)
        value = state.state_hash(state.run_hashes(run.hashes, run.later)).collect()[0][0]
    return d.sparkSession.createDataFrame([(value,)], "state_hash string")


def check(spark: SparkSession, d: DataFrame, root: str, errors: DataFrame | None = None) -> DataFrame:
    """Compare the source's state hash with the one stored by the last load."""
    if errors is not None:
        assert_no_critical(errors)
    return state.check_sync(source_state(d), store.read_table(spark, root, "import_state"))
