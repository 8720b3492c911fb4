"""Transactions that hang together: components of the graph of transactions and links.

A link is contracted to the smallest of its transactions first, with map-side minima, so a link that a third of all transactions carry
becomes as many rows, not pairs. On the pairs (transaction, smaller one) that leaves, stars alternate: each transaction hands its larger,
then its smaller partners to the smallest it knows. What a round joins to the pairs is one staged row for each transaction, so Spark
can split a transaction with many partners. Rounds grow with the logarithm of the longest chain.

A component bears its smallest external_id, in the order of strings. Rows without transaction or link connect nothing; repeated rows
count once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.schema import TOTAL
from daybook.sources.workspace import Workspace, workspace


def _larger_to_least(pairs: DataFrame, work: Workspace) -> DataFrame:
    """Every transaction's larger partners as pairs with the smallest of its partners and itself."""
    both = pairs.unionByName(pairs.select(F.col("small").alias("big"), F.col("big").alias("small"))).toDF("id", "partner")
    least = work.stage(both.groupBy("id").agg(F.min("partner").alias("least")), "least")
    return (both.where("partner > id").join(least, "id")
            .select(F.col("partner").alias("big"), F.least("id", "least").alias("small")).distinct())


def _smaller_to_least(pairs: DataFrame, work: Workspace) -> DataFrame:
    """Every transaction with the smallest of its smaller partners, and the others of them with that one."""
    least = work.stage(pairs.groupBy("big").agg(F.min("small").alias("least")), "least")
    others = pairs.join(least, "big").where("small <> least").select(F.col("small").alias("big"), F.col("least").alias("small"))
    return others.unionByName(least.select("big", F.col("least").alias("small"))).distinct()


def _are_stars(pairs: DataFrame) -> bool:
    """Whether every larger transaction has one partner, and no partner has a smaller one."""
    bigs = pairs.groupBy("big").agg(F.count(F.lit(1)).alias("n"))
    return bigs.where("n > 1").isEmpty() and pairs.join(bigs.select(F.col("big").alias("small")), "small", "left_semi").isEmpty()


def components(links: DataFrame, work: Workspace | None = None) -> DataFrame:
    """The component of each linked transaction: (external_id, component) of links (external_id, link)."""
    work = workspace(links, work)
    held = work.stage(links.where("external_id IS NOT NULL AND link IS NOT NULL").select("external_id", "link").distinct(), "links")
    least = work.stage(held.groupBy("link").agg(F.min("external_id").alias("small")), "least")
    pairs = held.join(least, "link").select(F.col("external_id").alias("big"), "small").where("big <> small").distinct()
    pairs = work.stage(pairs, "pairs")
    while not _are_stars(pairs):
        pairs = work.stage(_larger_to_least(pairs, work), "pairs")
        pairs = work.stage(_smaller_to_least(pairs, work), "pairs")
    found = pairs.select(F.col("big").alias("external_id"), F.col("small").alias("component"))
    return held.select("external_id").distinct().join(found, "external_id", "left").select(
        "external_id", F.coalesce("component", "external_id").alias("component"))


def component_totals(led: dict, work: Workspace | None = None) -> DataFrame:
    """Per component and currency: its transactions (size), those that post in the currency, and the debits they post."""
    work = workspace(led["transaction_links"], work)
    of = work.stage(components(led["transaction_links"], work), "components")
    debits = led["postings"].groupBy("external_id", "currency").agg(F.sum(F.when(F.col("amount") > 0, F.col("amount"))).alias("debit"))
    sizes = of.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    sums = debits.join(of, "external_id").groupBy("component", "currency").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("debit").cast(TOTAL).alias("debits"))
    return sums.join(sizes, "component").select("component", "size", "currency", "transactions", "debits")
