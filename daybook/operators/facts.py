"""Fact, bridge and metadata rows.

Each builder is an in-row projection or explode of directives: no shuffle. `t` is a
frame of transaction directives that already carries external_id and content_hash; the
columns named in `keep` are carried along."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.metadata import stored_meta
from daybook.operators.directives import of_kind


def build_transactions(t: DataFrame, *keep: str) -> DataFrame:
    """Transaction rows."""
    return t.select(*keep, "external_id", "date", "flag", "payee", "narration", "source_file", "source_line", "content_hash")


def _price(value: str) -> Column:
    # a price of zero counts as no price
    return F.when(F.col("p.price_number") != 0, F.col(value))


def build_postings(t: DataFrame, *keep: str) -> DataFrame:
    """Posting rows in order, with optional cost and price."""
    return (t.select(*keep, "external_id", "date", F.posexplode("postings").alias("posting_idx", "p"))
            .select(*keep, "external_id", "posting_idx", "date", F.col("p.flag").alias("flag"),
                    F.col("p.account").alias("account"), F.col("p.number").alias("amount"),
                    F.col("p.currency").alias("currency"),
                    F.col("p.cost_number").alias("cost_amount"), F.col("p.cost_currency").alias("cost_currency"),
                    _price("p.price_number").alias("price_amount"),
                    _price("p.price_currency").alias("price_currency")))


def build_txn_meta(t: DataFrame, *keep: str) -> DataFrame:
    """Transaction metadata as key/value rows without reserved keys."""
    return t.select(*keep, "external_id", F.explode(stored_meta("meta")).alias("key", "value"))


def build_post_meta(t: DataFrame, *keep: str) -> DataFrame:
    """Posting metadata as key/value rows, keyed by transaction and posting position."""
    return (t.select(*keep, "external_id", F.posexplode("postings").alias("posting_idx", "p"))
            .select(*keep, "external_id", "posting_idx", F.explode(stored_meta("p.meta")).alias("key", "value")))


def build_txn_tags(t: DataFrame, *keep: str) -> DataFrame:
    """Transaction-tag pairs, each once."""
    return t.select(*keep, "external_id", F.explode(F.array_compact(F.array_distinct("tags"))).alias("tag"))


def build_txn_links(t: DataFrame, *keep: str) -> DataFrame:
    """Transaction-link pairs, each once."""
    return t.select(*keep, "external_id", F.explode(F.array_compact(F.array_distinct("links"))).alias("link"))


def build_balances(d: DataFrame) -> DataFrame:
    """Balance assertion rows."""
    return of_kind(d, "balance").select("date", "account", F.col("number").alias("amount"),
                                        F.col("number_currency").alias("currency"), "source_file", "source_line")


def build_prices(d: DataFrame) -> DataFrame:
    """Price rows."""
    return of_kind(d, "price").select("date", F.col("currency").alias("commodity"),
                                      F.col("number").alias("price_amount"),
                                      F.col("number_currency").alias("price_currency"),
                                      "source_file", "source_line", "seq")


def build_events(d: DataFrame) -> DataFrame:
    """Ledger event rows: name and value."""
    return of_kind(d, "event").select("date", F.col("event_type").alias("name"),
                                      F.col("description").alias("value"), "source_file", "source_line")


def build_documents(d: DataFrame) -> DataFrame:
    """Document rows: account and file path."""
    return of_kind(d, "document").select("date", "account", F.col("filename").alias("file_path"),
                                         "source_file", "source_line")


def unseen_facts(facts: DataFrame, stored: DataFrame | None, years: list[int] | None = None) -> DataFrame:
    """Facts that are not stored yet with the same place and content, so that a repeated load adds nothing.

    The import position is neither. `years`: those of the facts, to which the stored side is cut."""
    if stored is None:
        return facts
    if years is not None:
        stored = stored.filter((F.col("year") if "year" in stored.columns else F.year("date")).isin(years))
    content = [c for c in facts.columns if c != "seq"]
    known = stored.select(*[F.col(c).alias("_" + c) for c in content])
    same = [facts[c].eqNullSafe(F.col("_" + c)) for c in content]
    return facts.join(known, same, "left_anti")


def bulk_load(stage_txn: DataFrame, stage_post: DataFrame, accounts: DataFrame, commodities: DataFrame) -> DataFrame:
    """Staged postings with names to posting rows with surrogate ids, all keys resolved in one pass.

    `accounts` and `commodities` hold (id, name). A posting whose transaction, account or
    currency is unknown is left out; cost and price currency are optional."""
    names = commodities.select("id", "name")
    currency = lambda p: names.select(F.col("id").alias(f"{p}currency_id"), F.col("name").alias(f"{p}currency"))
    return (stage_post.join(stage_txn.select("external_id"), "external_id")
            .join(accounts.select(F.col("id").alias("account_id"), F.col("name").alias("account")), "account")
            .join(currency(""), "currency")
            .join(currency("cost_"), "cost_currency", "left")
            .join(currency("price_"), "price_currency", "left")
            .select("external_id", "flag", "account_id", "amount", "currency_id", "cost_amount",
                    "cost_currency_id", "price_amount", "price_currency_id"))
