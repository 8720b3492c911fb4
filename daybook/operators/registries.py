"""Dimension registries: commodities, accounts, tags, links.

Names are collected by map-side combined aggregation, so a name used by a third of all
rows costs one row per task in the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.accounts import account_type
from daybook.functions.metadata import meta_json
from daybook.operators.directives import of_kind


class UnknownName(LookupError):
    """Raised when a fact uses a name its dimension does not hold."""


def _posting_names(d: DataFrame, *fields: str) -> DataFrame:
    # a field of an array of structs is an array: only these nested columns are read
    lists = [F.col(f"postings.{f}") for f in fields]
    return (of_kind(d, "transaction")
            .select(F.explode(F.array_distinct(F.concat(*lists))).alias("name")))


def used_commodities(d: DataFrame) -> DataFrame:
    """Distinct commodity names used in units, cost and price of postings."""
    return _posting_names(d, "currency", "cost_currency", "price_currency").filter("name IS NOT NULL").distinct()


def used_accounts(d: DataFrame) -> DataFrame:
    """Distinct account names used in postings, balances and documents."""
    others = of_kind(d, "balance", "document").select(F.col("account").alias("name"))
    return _posting_names(d, "account").unionByName(others).filter("name IS NOT NULL").distinct()


def unseen(names: DataFrame, dim: DataFrame) -> DataFrame:
    """Names the dimension does not hold."""
    return names.select("name").join(dim.select("name"), "name", "left_anti")


def get_or_create(dim: DataFrame, names: DataFrame) -> DataFrame:
    """The dimension with unseen names added; existing rows are untouched."""
    return dim.unionByName(unseen(names.select("name").distinct(), dim), allowMissingColumns=True)


def resolve(fact: DataFrame, dim: DataFrame, on: str, strict: bool = True) -> DataFrame:
    """Fact rows joined to their dimension row; strict mode raises on an unknown name."""
    columns = [F.col(c).alias(f"{on}_{c}") for c in dim.columns if c != "name"]
    if strict:
        used = fact.select(F.col(on).alias("name")).filter("name IS NOT NULL").distinct()
        missing = unseen(used, dim).limit(1).collect()
        if missing:
            raise UnknownName(f"{on} '{missing[0][0]}' is not registered")
    return fact.join(dim.select(F.col("name").alias(on), *columns), on, "left")


def build_commodities(d: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """New commodities. The first declaration gives the metadata; names only used keep null."""
    declared = of_kind(d, "commodity").select(F.col("currency").alias("name"), meta_json("meta").alias("metadata"), "seq")
    balances = of_kind(d, "balance").select(F.col("number_currency").alias("name"))
    prices = of_kind(d, "price").select(F.explode(F.array("currency", "number_currency")).alias("name"))
    used = (_posting_names(d, "currency", "cost_currency", "price_currency")
            .unionByName(balances).unionByName(prices).filter("name IS NOT NULL").distinct())
    rows = declared.unionByName(used, allowMissingColumns=True)
    new = rows.groupBy("name").agg(F.min_by("metadata", "seq").alias("metadata"))
    return new if existing is None else new.join(existing.select("name"), "name", "left_anti")


def build_accounts(d: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """New and changed accounts.

    The first open creates an account, the last close after it closes it, a second open
    changes nothing. A close reaches only accounts opened before it or held in `existing`;
    accounts merely used are created open, after all closes. A changed account keeps the
    time at which `existing` says it was created."""
    used = used_accounts(d).select("name")
    lifecycle = of_kind(d, "open", "close").select(F.col("account").alias("name"), "kind", "seq", "date", "meta")
    opens = F.when(F.col("kind") == "open", F.col("seq"))
    closes = F.when(F.col("kind") == "close", F.col("seq"))
    per = (lifecycle.unionByName(used, allowMissingColumns=True).groupBy("name").agg(
        F.min(opens).alias("opened_at"), F.max(closes).alias("closed_at"),
        F.min_by(F.struct("date", meta_json("meta").alias("metadata")), opens).alias("open"),
        F.max_by("date", closes).alias("last_close"),
        F.count_if(F.col("kind").isNull()).alias("uses")))
    if existing is None:
        known = per.withColumn("old", F.lit(None).cast("struct<status:string,open_date:date,metadata:string>"))
    else:
        old = existing.select("name", F.struct([c for c in existing.columns if c != "name"]).alias("old"))
        known = per.join(old, "name", "left")
    created = ([F.coalesce("old.created_at", F.current_timestamp()).alias("created_at")]
               if existing is not None and "created_at" in existing.columns else [])
    is_old = F.col("old").isNotNull()
    closed = F.col("closed_at").isNotNull() & (is_old | (F.col("closed_at") > F.col("opened_at")))
    closed = F.coalesce(closed, F.lit(False))
    exists = F.col("opened_at").isNotNull() | (F.col("uses") > 0)
    return (known.filter(F.when(is_old, closed).otherwise(exists))
            .select("name", account_type("name").alias("type"),
                    F.when(closed, "closed").otherwise("open").alias("status"),
                    F.when(is_old, F.col("old.open_date")).otherwise(F.col("open.date")).alias("open_date"),
                    F.when(closed, F.col("last_close")).alias("close_date"),
                    F.when(is_old, F.col("old.metadata")).otherwise(F.col("open.metadata")).alias("metadata"), *created))


def ignored_closes(d: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Close directives that met no account: a warning, not an error."""
    opened = (of_kind(d, "open").groupBy("account").agg(F.min("seq").alias("opened_at")))
    late = (of_kind(d, "close").select("seq", "date", "account", "source_file", "source_line")
            .join(opened, "account", "left")
            .filter(F.col("opened_at").isNull() | (F.col("seq") < F.col("opened_at"))).drop("opened_at"))
    if existing is not None:
        late = late.join(existing.select(F.col("name").alias("account")), "account", "left_anti")
    return late.select("seq", "date", "account", "source_file", "source_line")


def build_tags(d: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """New tag names."""
    return _label(d, "tags", existing)


def build_links(d: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """New link names."""
    return _label(d, "links", existing)


def _label(d, column, existing):
    names = (of_kind(d, "transaction").select(F.explode(column).alias("name"))
             .filter("name IS NOT NULL").distinct())
    return names if existing is None else unseen(names, existing)
