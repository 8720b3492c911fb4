"""Transaction identity: external ids, collision suffixes, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import identity as I
from daybook.operators.numbering import number_groups
from daybook.sources.workspace import Workspace, workspace


FEW = 2 ** 20      # ids whose 64-bit hashes are sent to every executor, some 32 MB


class DuplicateIds(ValueError):
    """Raised when duplicates are treated as errors."""


def identified(t: DataFrame) -> DataFrame:
    """Add given_id, the id found in the metadata, used unchanged, and content_hash, the hash of the
    transaction's identifying content, which ignores a given id and carries no suffix.

    Other directives get neither. A frame that has the columns already is returned as it is."""
    if "content_hash" in t.columns:
        return t
    is_transaction = F.col("kind") == "transaction"
    hashed = I.external_id_base("date", "payee", "narration", F.coalesce("_pick.amount_text", F.lit(I.NO_AMOUNT)),
                                "_account", F.concat_ws(":", "source_file", "source_line", "seq"))
    return (t.withColumn("_pick", F.when(is_transaction, I.id_posting("postings", F.col("meta")["source_account"])))
            .withColumn("_account", F.coalesce("_pick.account", F.lit(I.NO_ACCOUNT)))
            .withColumn("content_hash", F.when(is_transaction, hashed))
            .withColumn("given_id", F.when(is_transaction, F.col("meta")["transaction_id"]))
            .drop("_pick", "_account"))


def repeat_numbers(t: DataFrame, work: Workspace | None = None) -> DataFrame:
    """(seq, n) of generated ids that are the second or later of their hash, in import order."""
    generated = identified(t).filter("given_id IS NULL").select("seq", I.packed("content_hash").alias("content_hash"))
    return number_groups(generated, "content_hash", "seq", least=2, work=work).filter("n > 1").select("seq", "n")


def numbered_ids(t: DataFrame, changed: DataFrame) -> DataFrame:
    """Add external_id, given the rows of `changed` (seq, n): n >= 2 gets a suffix, n = 0 is dropped.

    All other rows carry their bare hash or given id and are not shuffled when the list is small."""
    return named(numbered(t, changed))


def numbered(t: DataFrame, changed: DataFrame) -> DataFrame:
    """Rows that stay, with their number n; hashes move as bytes."""
    rows = identified(t).withColumn("content_hash", I.packed("content_hash")).join(changed, "seq", "left")
    return rows.filter("coalesce(n, 1) > 0").withColumn("content_hash", I.unpacked("content_hash"))


def named(rows: DataFrame) -> DataFrame:
    """Numbered rows with external_id in place of n."""
    suffix = F.when(F.col("n") > 1, F.concat(F.lit("-"), F.col("n").cast("string"))).otherwise("")
    return rows.withColumn("external_id", F.coalesce("given_id", F.concat("content_hash", suffix))).drop("n")


def external_ids(t: DataFrame, work: Workspace | None = None) -> DataFrame:
    """Add external_id, given_id and content_hash to transactions.

    Hashes are computed inside the row; only rows that need a suffix are joined back."""
    work = workspace(t, work)
    base = t if "content_hash" in t.columns else work.stage(
        identified(t).select("seq", "content_hash", "given_id"), "base")
    return numbered_ids(t, work.stage(repeat_numbers(base, work), "repeats"))


def collision_ids(df: DataFrame, base: str, seq: str, name: str = "external_id",
                  work: Workspace | None = None) -> DataFrame:
    """First row of a base keeps the bare hash, the n-th gets hash-n."""
    later = number_groups(df, base, seq, least=2, work=work).filter("n > 1").select(seq, "n")
    return (df.join(later, seq, "left")
            .withColumn(name, F.when(F.col("n").isNull(), F.col(base))
                        .otherwise(F.concat_ws("-", F.col(base), F.col("n").cast("string"))))
            .select(*df.columns, name))


def kept_dup_ids(df: DataFrame, base: str, seq: str, kept: str, name: str = "external_id",
                 work: Workspace | None = None) -> DataFrame:
    """Kept duplicates get hash-dup-1, -dup-2, … apart from the ordinary numbering."""
    marked = df.filter(F.col(kept))
    later = number_groups(marked, base, seq, least=2, work=work).filter("n > 1").select(seq, "n")
    dups = (marked.join(later, seq, "left")
            .withColumn(name, F.concat(F.col(base), F.lit(I.KEPT_MARK), F.coalesce("n", F.lit(1)).cast("string")))
            .select(*df.columns, name))
    return collision_ids(df.filter(~F.col(kept)), base, seq, name, work).unionByName(dups)


def id_stats(df: DataFrame, base: str) -> DataFrame:
    """Generated ids, hashes that collided, highest suffix (0 if none)."""
    per = df.filter(F.col(base).isNotNull()).groupBy(base).agg(F.count(F.lit(1)).alias("c"))
    return per.agg(
        F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("total_ids"),
        F.count_if(F.col("c") > 1).alias("colliding_bases"),
        F.coalesce(F.max(F.when(F.col("c") > 1, F.col("c"))), F.lit(0)).cast("bigint").alias("max_suffix"))


def id_posting_of(postings: DataFrame, key: str, order: list[str], source: str | None = None) -> DataFrame:
    """The identifying posting of each transaction, from postings in separate rows.

    A map-side combined minimum over (rank, order, text); groups are never gathered."""
    rank = I.posting_rank("account", "amount", F.lit(None).cast("string") if source is None else source)
    best = F.min(F.struct(rank.alias("rank"), *order, "account",
                          I.amount_text("amount", "currency", "amount_text").alias("amount_text")))
    return (postings.filter(rank.isNotNull()).groupBy(key).agg(best.alias("b"))
            .select(key, F.col("b.account").alias("account"), F.col("b.amount_text").alias("amount_text")))


def stored_ids(stored: DataFrame, years: list[int], given: bool) -> DataFrame:
    """Stored ids that a run can meet. A generated id holds its date, so it can only be stored in a year of the run;
    only given ids may lie anywhere."""
    if given:
        return stored.select("external_id")
    return stored.filter((F.col("year") if "year" in stored.columns else F.year("date")).isin(years)).select("external_id")


def split_new(t: DataFrame, stored: DataFrame, unique: bool = False) -> tuple[DataFrame, DataFrame]:
    """(new, skipped) by external_id against the stored transactions; `unique`: no id comes often in `t`.

    The stored side is first reduced to the incoming ids, so a small load scans the id
    column of a large table without shuffling it."""
    # distinct first: an id that fills a third of the run is one row per task by then
    found, moved = stored.select("external_id"), t.withColumn("external_id", I.packed("external_id"))
    if t.count() <= FEW:
        # a run as small as a micro-batch: its ids' hashes go to the stored side, of which only what has such a hash is packed and moved
        short = t.select(F.xxhash64("external_id").alias("_h")).distinct()
        found = found.withColumn("_h", F.xxhash64("external_id")).join(F.broadcast(short), "_h", "left_semi").select("external_id")
    found = found.withColumn("external_id", I.packed("external_id"))
    hits = found if unique else found.join(moved.select("external_id").distinct(), "external_id", "left_semi")
    of = lambda how: moved.join(hits, "external_id", how).withColumn("external_id", I.unpacked("external_id")).select(*t.columns)
    return of("left_anti"), of("left_semi")


def duplicate_report(t: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming transactions whose id is stored already, with the place of both."""
    cols = ["external_id", "date", "narration", "source_file", "source_line"]
    old = stored.select("external_id", F.col("date").alias("stored_date"),
                        F.col("source_file").alias("stored_file"), F.col("source_line").alias("stored_line"))
    return t.select(*cols).join(old, "external_id")


def invalid_transactions(d: DataFrame) -> DataFrame:
    """Transactions that strict id generation refuses, with the reason and their place."""
    error = (F.when(F.col("_pick").isNull(), "no posting with an account")
             .otherwise(I.strict_errors(F.col("date").cast("string"), "payee", "narration",
                                        "_pick.amount_text", "_pick.account")))
    return (d.filter((F.col("kind") == "transaction") & F.col("meta")["transaction_id"].isNull())
            .withColumn("_pick", I.id_posting("postings", F.col("meta")["source_account"]))
            .withColumn("error", error).filter(F.col("error").isNotNull())
            .select("seq", "date", "narration", "source_file", "source_line", "error"))


def from_bank_feed(df: DataFrame) -> DataFrame:
    """Bank rows (seq, date_text, payee, narration, source_account, ofx_id, postings) to
    transactions with flag '*', no tags or links and id metadata. Rows that break a strict
    rule are left out; `bank_feed_errors` lists them."""
    ok = _feed(df).filter(F.col("_error").isNull())
    ids = collision_ids(ok, "_base", "seq")
    meta = F.create_map(
        F.lit("transaction_id"), F.col("external_id"),
        F.lit("source_account"), F.nullif(F.col("source_account"), F.lit("")),
        F.lit("ofx_id"), I.clean_ofx_id("ofx_id"))
    return ids.select(
        "seq", "external_id", F.try_to_date(I.strip("date_text"), "yyyy-M-d").alias("date"),
        F.lit("*").alias("flag"), "payee", "narration",
        F.array().cast("array<string>").alias("tags"), F.array().cast("array<string>").alias("links"),
        F.map_filter(meta, lambda k, v: v.isNotNull()).alias("meta"), "postings")


def bank_feed_errors(df: DataFrame) -> DataFrame:
    """Bank rows refused by strict validation."""
    return _feed(df).filter(F.col("_error").isNotNull()).select("seq", F.col("_error").alias("error"))


def _feed(df: DataFrame) -> DataFrame:
    return (df.withColumn("_pick", I.id_posting("postings", "source_account"))
            .withColumn("_error", F.when(F.col("_pick").isNull(), "no posting with an account")
                        .otherwise(I.strict_errors("date_text", "payee", "narration",
                                                   "_pick.amount_text", "_pick.account")))
            .withColumn("_base", I.external_id_base("date_text", "payee", "narration",
                                                    "_pick.amount_text", "_pick.account")))
