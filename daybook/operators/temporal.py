"""Running balances, balance verification and as-of valuation.

Time-ordered windows only ever see one row per key and day: facts are summed per day
first, lookups are reduced to their distinct days, and the answer is joined back by
equality. A window partition is therefore bounded by the calendar, not by the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.accounts import account_prefixes
from daybook.functions.money import times
from daybook.schema import TOTAL


def _by_day(*keys: str) -> Window:
    return Window.partitionBy(*keys).orderBy("date")


def daily_sums(postings: DataFrame) -> DataFrame:
    """Posted amount per account, currency and day."""
    return postings.groupBy("account", "currency", "date").agg(F.sum("amount").alias("day"))


def running_balance(led: dict) -> DataFrame:
    """Balance of each account and currency after each day with postings."""
    w = _by_day("account", "currency").rowsBetween(Window.unboundedPreceding, 0)
    return daily_sums(led["postings"]).select(
        "account", "currency", "date", F.col("day").cast(TOTAL).alias("change"),
        F.sum("day").over(w).cast(TOTAL).alias("balance"))


def opening_balances(postings: DataFrame, wanted: DataFrame) -> DataFrame:
    """Balance before each wanted (account, currency, date), subaccounts included."""
    asked = wanted.select("account", "currency", "date").distinct()
    daily = (daily_sums(postings)
             .select(F.explode(account_prefixes("account")).alias("account"), "currency", "date", "day"))
    names = asked.select("account").distinct()
    timeline = (daily.join(names, "account", "left_semi").withColumn("asked", F.lit(False))
                .unionByName(asked.withColumn("asked", F.lit(True)), allowMissingColumns=True)
                .groupBy("account", "currency", "date")
                .agg(F.sum("day").alias("day"), F.max("asked").alias("asked")))
    w = _by_day("account", "currency").rowsBetween(Window.unboundedPreceding, -1)
    return (timeline.withColumn("computed", F.coalesce(F.sum("day").over(w), F.lit(0)).cast(TOTAL))
            .filter("asked").select("account", "currency", "date", "computed"))


def verdicts(assertions: DataFrame, opening: DataFrame, tol: str) -> DataFrame:
    """Balance assertions with the opening balance of their day (computed), the difference and whether it is within tol."""
    return (assertions.join(opening, ["account", "currency", "date"])
            .withColumn("diff", (F.col("computed") - F.col("amount")).cast(TOTAL))
            .withColumn("ok", F.abs("diff") <= F.lit(tol).cast("decimal(19,4)"))
            .select("date", "account", "currency", F.col("amount").alias("asserted"), "computed", "diff", "ok",
                    "source_file", "source_line"))


def verify_balances(led: dict, tol: str = "0.005") -> DataFrame:
    """Each balance assertion with the opening balance of its day, the difference and a verdict."""
    a = led["balance_assertions"]
    return verdicts(a, opening_balances(led["postings"], a), tol)


def prices_as_of(prices: DataFrame, wanted: DataFrame) -> DataFrame:
    """Latest price on or before each wanted (commodity, date).

    `prices` holds one or more quotes per day, of which the last imported one (seq) counts."""
    order = "seq"
    quote = (prices.groupBy("commodity", "date")
             .agg(F.max_by(F.struct("price_amount", "price_currency"), order).alias("quote")))
    asked = wanted.select("commodity", "date").distinct().withColumn("asked", F.lit(True))
    timeline = (quote.unionByName(asked, allowMissingColumns=True).groupBy("commodity", "date")
                .agg(F.max("quote").alias("quote"), F.max("asked").alias("asked")))
    w = _by_day("commodity").rowsBetween(Window.unboundedPreceding, 0)
    return (timeline.withColumn("last", F.last("quote", True).over(w)).filter("asked")
            .select("commodity", "date", F.col("last.price_amount").alias("price_amount"),
                    F.col("last.price_currency").alias("price_currency")))


def value_positions(positions: DataFrame, prices: DataFrame) -> DataFrame:
    """Quantity x latest price on or before the position's date; null where no price is known."""
    on = ["commodity", "date"]
    return (positions.join(prices_as_of(prices, positions), on, "left")
            .withColumn("value", times(F.col("quantity"), F.col("price_amount"))))


def portfolio_value(positions: DataFrame, prices: DataFrame) -> DataFrame:
    """Value of the accumulated holdings per commodity on every day they change."""
    day = positions.groupBy("commodity", "date").agg(F.sum("quantity").alias("q"))
    w = _by_day("commodity").rowsBetween(Window.unboundedPreceding, 0)
    held = day.select("commodity", "date", F.sum("q").over(w).cast("decimal(19,4)").alias("quantity"))
    return value_positions(held, prices).select("commodity", "date", "quantity", "price_amount",
                                                "price_currency", "value")
