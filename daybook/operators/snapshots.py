"""Balances in two levels: sums per month, kept beside the ledger, and the days of one month.

A month's row holds what an account and currency changed in it. Rows add up, so a batch stores its own and nothing stored is read
again; a correction is a batch of negated rows. A balance as of a day is the prefix sum of the months before plus the postings
of the day's month: of postings partitioned by year only the years of the asked days are read. Window partitions hold the months of an
account and currency, or the days of one of its months. Postings without date, account or currency count for no balance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.functions.accounts import account_prefixes
from daybook.operators.temporal import daily_sums, verdicts
from daybook.schema import TOTAL

KEY = ["account", "currency"]


def month_of(day: Column) -> Column:
    """The first day of its month."""
    return F.trunc(day, "month")


def months(postings: DataFrame) -> DataFrame:
    """What each account and currency changed in each month: (account, currency, month, change)."""
    known = postings.where("date IS NOT NULL AND account IS NOT NULL AND currency IS NOT NULL")
    return known.groupBy(*KEY, month_of(F.col("date")).alias("month")).agg(F.sum("amount").cast(TOTAL).alias("change"))


def added(rows: DataFrame) -> DataFrame:
    """Rows of months() of several batches as one for each month."""
    return rows.groupBy(*KEY, "month").agg(F.sum("change").cast(TOTAL).alias("change"))


def add_batch(postings: DataFrame, folder: str, batch: int) -> None:
    """Store the months of a batch beside those of others; a batch that is written again replaces its own."""
    months(postings).write.mode("overwrite").parquet(f"{folder}/batch={batch}")


def stored_months(spark: SparkSession, folder: str) -> DataFrame:
    """The months of all stored batches."""
    return added(spark.read.parquet(folder))


def closing_balances(m: DataFrame) -> DataFrame:
    """Every month with its change and the balance at its end."""
    w = Window.partitionBy(*KEY).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return m.select(*KEY, "month", "change", F.sum("change").over(w).cast(TOTAL).alias("balance"))


def _in_years(postings: DataFrame, years: list[int]) -> DataFrame:
    """The postings of some years, by the partition column where there is one."""
    return postings.where((F.col("year") if "year" in postings.columns else F.year("date")).isin(years))


def balances_as_of(m: DataFrame, postings: DataFrame, day: dt.date) -> DataFrame:
    """Balance of each account and currency at the end of a day."""
    first = day.replace(day=1)
    late = _in_years(postings, [day.year]).where(F.col("date").between(first, day)).where("account IS NOT NULL AND currency IS NOT NULL")
    parts = m.where(F.col("month") < F.lit(first)).select(*KEY, "change").unionByName(
        late.groupBy(*KEY).agg(F.sum("amount").cast(TOTAL).alias("change")))
    return parts.groupBy(*KEY).agg(F.sum("change").cast(TOTAL).alias("balance"))


def opening_balances(m: DataFrame, postings: DataFrame, wanted: DataFrame) -> DataFrame:
    """Balance before each wanted (account, currency, date), subaccounts included."""
    asked = wanted.where("date IS NOT NULL").select(*KEY, "date").distinct().withColumn("month", month_of(F.col("date")))
    names, spans = asked.select("account").distinct(), asked.select(*KEY, "month").distinct()
    under = F.explode(account_prefixes("account")).alias("account")

    changes = m.select(under, "currency", "month", "change").join(names, "account", "left_semi").withColumn("asked", F.lit(False))
    line = (changes.unionByName(spans.withColumn("asked", F.lit(True)), allowMissingColumns=True).groupBy(*KEY, "month")
            .agg(F.sum("change").alias("change"), F.max("asked").alias("asked")))
    earlier = Window.partitionBy(*KEY).orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    before = line.withColumn("before", F.sum("change").over(earlier)).where("asked").select(*KEY, "month", "before")

    years = [r.year for r in asked.select(F.year("date").alias("year")).distinct().collect()]   # as many as the calendar has
    days = daily_sums(_in_years(postings, years)).select(under, "currency", "date", "day").withColumn("month", month_of(F.col("date")))
    days = days.join(spans, [*KEY, "month"], "left_semi").withColumn("asked", F.lit(False))
    line = (days.unionByName(asked.withColumn("asked", F.lit(True)), allowMissingColumns=True).groupBy(*KEY, "month", "date")
            .agg(F.sum("day").alias("day"), F.max("asked").alias("asked")))
    earlier = Window.partitionBy(*KEY, "month").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    line = line.withColumn("since", F.sum("day").over(earlier)).where("asked")
    zero = F.lit(0).cast(TOTAL)
    return line.join(before, [*KEY, "month"]).select(
        *KEY, "date", (F.coalesce(F.col("before").cast(TOTAL), zero) + F.coalesce(F.col("since").cast(TOTAL), zero)).cast(TOTAL).alias("computed"))


def verify_balances(led: dict, m: DataFrame, tol: str = "0.005") -> DataFrame:
    """Each balance assertion with the opening balance of its day, the difference and a verdict, from stored months."""
    a = led["balance_assertions"]
    return verdicts(a, opening_balances(m, led["postings"], a), tol)
