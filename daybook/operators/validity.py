"""When accounts may be used: intervals from open and close directives, and what stands outside of them.

An account is in use from the day of an open to the day of the close that ends it, both included; it may be opened again. Uses are
not joined to intervals by range: per account, the days of opens, closes and uses are swept in order, one row a day, so a
window is bounded by the calendar; the verdict on a day goes back to its uses by equality, and only bad days do."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators.directives import of_kind


def lifecycle(d: DataFrame) -> DataFrame:
    """(account, date, kind) of the open and close directives of a run."""
    return of_kind(d, "open", "close").select("account", "date", "kind").where("account IS NOT NULL AND date IS NOT NULL")


def _swept(events: DataFrame) -> DataFrame:
    """One row an account and day (opens, closes, used), with the state the days before have left: open, closed or null."""
    days = events.groupBy("account", "date").agg(F.count_if(F.col("kind") == "open").alias("opens"), F.count_if(F.col("kind") == "close").alias("closes"),
                                                 F.count_if(F.col("kind") == "use").alias("uses"))
    after = F.when(F.col("closes") > 0, "closed").when(F.col("opens") > 0, "open")  # a close ends its day
    before = Window.partitionBy("account").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    return days.withColumn("after", after).withColumn("state", F.last("after", True).over(before))


def account_intervals(life: DataFrame) -> DataFrame:
    """(account, n, open_date, close_date) of every interval; a close without an open before it, and an open of an open account,
    change nothing; an interval that is not closed has a null close_date."""
    w = Window.partitionBy("account").orderBy("date")
    days = _swept(life).withColumn("begins", (F.col("opens") > 0) & (F.coalesce("state", F.lit("closed")) == "closed"))
    ends = (F.col("closes") > 0) & (F.col("begins") | (F.col("state") == "open"))
    marks = days.withColumn("ends", F.coalesce(ends, F.lit(False))).where("begins OR ends")
    closing = F.when(F.col("ends"), F.col("date"))
    later = Window.partitionBy("account").orderBy(F.desc("date")).rowsBetween(Window.unboundedPreceding, -1)
    marks = marks.withColumn("close_date", F.when(F.col("ends"), F.col("date")).otherwise(F.last(closing, True).over(later)))
    return marks.where("begins").select("account", F.row_number().over(w).cast("bigint").alias("n"), F.col("date").alias("open_date"), "close_date")


def outside(life: DataFrame, uses: DataFrame) -> DataFrame:
    """The rows of uses (account, date, ...) on days when their account is not open, with the reason: `never opened`, `before open` or
    `after close`. Uses without account or date are left out."""
    events = life.unionByName(uses.select("account", "date", F.lit("use").alias("kind")).where("account IS NOT NULL AND date IS NOT NULL").distinct())
    days = _swept(events)
    ever = F.max(F.col("opens") > 0).over(Window.partitionBy("account"))
    reason = F.when(~F.col("ever"), "never opened").when(F.col("state") == "closed", "after close").otherwise("before open")
    # closes before the first open do not make an account closed
    opened = F.max(F.col("opens") > 0).over(Window.partitionBy("account").orderBy("date").rowsBetween(Window.unboundedPreceding, -1))
    days = days.withColumns({"ever": ever, "opened": F.coalesce(opened, F.lit(False))})
    days = days.withColumn("state", F.when(F.col("opened"), F.col("state")))
    bad = days.where((F.col("uses") > 0) & (F.col("opens") == 0) & (F.coalesce("state", F.lit("none")) != "open"))
    return uses.join(bad.select("account", "date", reason.alias("reason")), ["account", "date"])


def invalid_uses(led: dict[str, DataFrame], life: DataFrame) -> DataFrame:
    """Postings, balance assertions and documents outside of every interval of their account: use, account, date, external_id, posting_idx,
    reason, source_file, source_line. Transactions are read for the bad postings only."""
    postings = outside(life, led["postings"].select("account", "date", "external_id", "posting_idx"))
    placed = led["transactions"].select("external_id", "source_file", "source_line")
    found = postings.join(placed, "external_id").withColumn("use", F.lit("posting"))
    for use, table in (("balance", "balance_assertions"), ("document", "ledger_documents")):
        if table in led:
            found = found.unionByName(outside(life, led[table].select("account", "date", "source_file", "source_line")).withColumn("use", F.lit(use)), allowMissingColumns=True)
    return found.select("use", "account", "date", "external_id", "posting_idx", "reason", "source_file", "source_line")
