"""Prices through other currencies: what a commodity is worth in one currency that it may not be quoted in.

Quotes are edges of a dated graph, from the commodity to the currency of its price. As of a day an edge holds the latest quote
on or before that day; of several on one day the last imported one counts. The path with the fewest edges is taken; of equally
short ones the one whose first quote is the latest, then its second, and so on, then the first by name.

The search is breadth-first by joins, `depth` levels, over distinct (commodity, day) pairs. A level holds one row for each pair
and currency reached, the best by the rule above, so it is bounded by the number of currencies; as only equally long
paths are compared, place by place, a path that is not the best to its currency cannot be the best beyond it. Quotes as
of a day come from a window over one row per edge and day, and are joined back by equality: no range join. Levels are staged.

Rates are products of doubles in the order of the path: a reporting figure, not an amount to book. Quotes without an
amount, a commodity or a currency are no edges; an edge to itself is none."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.sources.workspace import Workspace

DEPTH = 3
EDGE = ["commodity", "price_currency"]


def daily_quotes(prices: DataFrame) -> DataFrame:
    """The quote of each edge and day: commodity, price_currency, date, amount."""
    known = prices.where("price_amount IS NOT NULL AND date IS NOT NULL AND commodity <> price_currency")
    return known.groupBy(*EDGE, "date").agg(F.max_by("price_amount", "seq").cast("double").alias("amount"))


def edges_as_of(quotes: DataFrame, edges: DataFrame, wanted: DataFrame) -> DataFrame:
    """Every edge that leaves a wanted (commodity, date), with its latest quote: also amount, quoted."""
    asked = wanted.select("commodity", "date").distinct().join(edges, "commodity").withColumn("asked", F.lit(True))
    timeline = (quotes.unionByName(asked, allowMissingColumns=True).groupBy(*EDGE, "date")
                .agg(F.max("amount").alias("amount"), F.max("asked").alias("asked")))
    w = Window.partitionBy(*EDGE).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("amount").isNotNull(), F.struct("amount", F.col("date").alias("quoted"))), True).over(w)
    return timeline.withColumn("last", last).where("asked AND last IS NOT NULL").select(*EDGE, "date", "last.*")


def rates(prices: DataFrame, wanted: DataFrame, target: str, depth: int = DEPTH) -> DataFrame:
    """commodity, date, hops, rate, path (currencies after the commodity) of each wanted pair from which the target is reached."""
    spark = prices.sparkSession
    work = Workspace(spark, "rates")
    quotes = work.stage(daily_quotes(prices), "quotes")
    edges = quotes.select(*EDGE).distinct()
    step = "array<struct<age:int,currency:string>>"     # ages: days before day 0, so a later quote sorts first
    level = wanted.select("commodity", "date").where("commodity IS NOT NULL AND date IS NOT NULL").distinct().select(
        "commodity", "date", F.col("commodity").alias("at"), F.lit(0).alias("hops"), F.lit(1.0).alias("rate"), F.array().cast(step).alias("steps"))
    for n in range(1, depth + 1):
        level = work.stage(level, f"level{n}")
        done = Window.partitionBy("commodity", "date")
        going = level.withColumn("done", F.max(F.col("at") == target).over(done)).where("NOT done").drop("done")
        out = edges_as_of(quotes, edges, going.select(F.col("at").alias("commodity"), "date")).withColumnsRenamed({"commodity": "at", "price_currency": "to"})
        further = going.join(out, ["at", "date"]).select(
            "commodity", "date", F.col("to").alias("at"), F.lit(n).alias("hops"), (F.col("rate") * F.col("amount")).alias("rate"),
            F.concat("steps", F.array(F.struct((-F.unix_date("quoted")).alias("age"), F.col("to").alias("currency")))).cast(step).alias("steps"))
        best = further.groupBy("commodity", "date", "at").agg(F.min_by(F.struct("hops", "rate", "steps"), "steps").alias("best")).select("commodity", "date", "at", "best.*")
        level = level.where(F.col("at") == target).unionByName(best)
    return level.where(F.col("at") == target).select("commodity", "date", "hops", "rate", F.col("steps.currency").alias("path"))


def value_in(positions: DataFrame, prices: DataFrame, target: str, depth: int = DEPTH) -> DataFrame:
    """Positions with hops, rate and value in the target currency as of their day; null where it is not reached."""
    found = rates(prices, positions, target, depth).drop("path")
    return positions.join(found, ["commodity", "date"], "left").withColumn("value", F.col("quantity").cast("double") * F.col("rate"))
