"""Financial reports over ledger tables.

`led` is a dict of table frames. Every measure is one scan of the postings with column
pruning and a date range that reaches the files; grouped sums combine map-side. Amounts
keep their accounting sign unless a function says otherwise."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.accounts import (account_match, account_match_any, account_prefixes, account_type,
                                        category, prefix_at, under)
from daybook.functions.money import times
from daybook.schema import TOTAL, VALUE

# Accounts of the income formulas (fixed values).
INCOME_ACCOUNTS = ["Income:Salary:Net", "Income:CreditCard:Rewards", "Income:Other", "Income:Interest:*",
                   "Income:Bonus", "Income:Reimbursements:*", "Income:Gifts"]
TAX_ACCOUNTS = ["Equity:Taxes:Federal", "Equity:Taxes:State"]
SALARY_ACCOUNT = "Income:Salary:Net"


# ---- filters -------------------------------------------------------------------------

def by_type(df: DataFrame, kind: str) -> DataFrame:
    """Postings or accounts of one root type."""
    name = "account" if "account" in df.columns else "name"
    return df.filter(account_type(name) == kind)


def in_dates(df: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Rows dated first..last; also prunes year partitions where the table has them."""
    out = df.filter(F.col("date").between(F.lit(first), F.lit(last)))
    return out.filter(F.col("year").between(first.year, last.year)) if "year" in df.columns else out


def in_year(df: DataFrame, year: int) -> DataFrame:
    """Rows of one year, as a date range that is pushed into the scan."""
    return in_dates(df, dt.date(year, 1, 1), dt.date(year, 12, 31))


def in_currency(df: DataFrame, currency: str) -> DataFrame:
    """Rows in one currency."""
    return df.filter(F.col("currency") == currency)


def subtree(df: DataFrame, prefix: str) -> DataFrame:
    """Rows of an account and its descendants."""
    return df.filter(under("account", prefix))


def trace(led: dict, external_id: str) -> DataFrame:
    """File and line of a transaction."""
    return led["transactions"].filter(F.col("external_id") == external_id).select(
        "external_id", "source_file", "source_line")


def from_file(led: dict, source_file: str) -> DataFrame:
    """Transactions of one source file."""
    return led["transactions"].filter(F.col("source_file") == source_file)


def by_meta(led: dict, key: str, value: str | None = None) -> DataFrame:
    """Transactions that carry a metadata key (with a value)."""
    hits = led["transaction_metadata"].filter(F.col("key") == key)
    if value is not None:
        hits = hits.filter(F.col("value") == value)
    return led["transactions"].join(hits.select("external_id"), "external_id", "left_semi")


def postings_by_meta(led: dict, key: str, value: str | None = None) -> DataFrame:
    """Postings that carry a metadata key (with a value)."""
    hits = led["posting_metadata"].filter(F.col("key") == key)
    if value is not None:
        hits = hits.filter(F.col("value") == value)
    on = ["external_id", "posting_idx"]
    return led["postings"].join(hits.select(*on), on, "left_semi")


def count_by_file(led: dict, files: list[str]) -> DataFrame:
    """Transactions per source file."""
    return (led["transactions"].filter(F.col("source_file").isin(files))
            .groupBy("source_file").agg(F.count(F.lit(1)).alias("n")))


# ---- joins ---------------------------------------------------------------------------

def star(led: dict) -> DataFrame:
    """Postings with their account and transaction; cost and price currency looked up where present.

    No join is hinted: Spark broadcasts a dimension only when its measured size allows and
    splits a skewed key of the large sides otherwise."""
    accounts = led["accounts"].select(F.col("name").alias("account"), "type", "status")
    t = led["transactions"].select("external_id", "flag", "payee", "narration", "source_file")
    return optional_currencies(led["postings"].drop("flag").join(accounts, "account").join(t, "external_id"), led["commodities"])


def optional_currencies(postings: DataFrame, commodities: DataFrame) -> DataFrame:
    """Postings with has_cost and has_price: whether they have a cost or price currency that is registered."""
    names = commodities.select("name")
    cost = names.select(F.col("name").alias("cost_currency"), F.lit(True).alias("has_cost"))
    price = names.select(F.col("name").alias("price_currency"), F.lit(True).alias("has_price"))
    return (postings.join(cost, "cost_currency", "left").join(price, "price_currency", "left")
            .withColumn("has_cost", F.coalesce("has_cost", F.lit(False)))
            .withColumn("has_price", F.coalesce("has_price", F.lit(False))))


def combine_totals(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two one-row totals side by side, by a union and one aggregate instead of a cross join."""
    both = a.unionByName(b, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def with_tags(led: dict) -> DataFrame:
    """Transactions with their tags, one row per pair."""
    return led["transactions"].join(led["transaction_tags"], "external_id")


def linked(led: dict, currency: str) -> DataFrame:
    """Per link: its transactions and the debits they post in one currency."""
    debits = (in_currency(led["postings"], currency).groupBy("external_id")
              .agg(_sum(F.when(F.col("amount") > 0, F.col("amount"))).alias("debit")))
    return (led["transaction_links"].join(debits, "external_id", "left").groupBy("link")
            .agg(F.count(F.lit(1)).alias("transactions"), _sum("debit").alias("debits")))


def sharing_links(led: dict) -> DataFrame:
    """Transactions whose link at least one other transaction carries, with the group's size."""
    sizes = (led["transaction_links"].groupBy("link").agg(F.count(F.lit(1)).alias("shared_by"))
             .filter("shared_by > 1"))
    return led["transaction_links"].join(sizes, "link").select("external_id", "link", "shared_by")


# ---- sums ----------------------------------------------------------------------------

def _sum(c, kind: str = TOTAL) -> Column:
    return F.sum(c).cast(kind)


def _sum_where(condition: Column, name: str) -> Column:
    return F.coalesce(_sum(F.when(condition, F.col("amount"))), F.lit(0).cast(TOTAL)).alias(name)


def account_balance(led: dict, account: str, currency: str) -> DataFrame:
    """Balance of one account in one currency."""
    return in_currency(led["postings"].filter(F.col("account") == account), currency).agg(
        _sum("amount").alias("balance"))


def account_balances(led: dict) -> DataFrame:
    """Balance of every account and currency."""
    return led["postings"].groupBy("account", "currency").agg(_sum("amount").alias("balance"))


def total_income(led: dict, year: int, currency: str) -> DataFrame:
    """Income of a year in one currency."""
    return by_type(in_currency(in_year(led["postings"], year), currency), "Income").agg(
        _sum("amount").alias("total_income"))


def expenses_by_category(led: dict, year: int) -> DataFrame:
    """Expenses of a year by category, largest first."""
    return (by_type(in_year(led["postings"], year), "Expenses")
            .groupBy(category("account").alias("category")).agg(_sum("amount").alias("total"))
            .orderBy(F.desc("total"), "category"))


def ranked_categories(led: dict, year: int) -> DataFrame:
    """Expenses by category with their place in the order; one row per category meets in the window."""
    place = F.row_number().over(Window.orderBy(F.desc("total"), "category")).cast("bigint")
    return expenses_by_category(led, year).withColumn("place", place)


def top_categories(led: dict, year: int, k: int) -> DataFrame:
    """The k largest expense categories of a year."""
    return expenses_by_category(led, year).limit(k)


def total_expenses(led: dict, year: int) -> DataFrame:
    """Expenses of a year."""
    return by_type(in_year(led["postings"], year), "Expenses").agg(_sum("amount").alias("total_expenses"))


def gross_income(led: dict, year: int) -> DataFrame:
    """All income plus all tax accounts of a year."""
    return (in_year(led["postings"], year)
            .filter((account_type("account") == "Income") | account_match("account", "Equity:Taxes:*"))
            .agg(_sum("amount").alias("gross_income")))


def net_income_sql(led: dict, year: int) -> DataFrame:
    """All income minus the two tax accounts, stored signs, as the documented SQL pattern has it.

    Income is stored negative, so this is not earnings; see net_income."""
    income = _sum(F.when(account_type("account") == "Income", F.col("amount")))
    taxes = _sum(F.when(F.col("account").isin(TAX_ACCOUNTS), F.col("amount")))
    return in_year(led["postings"], year).agg((income - taxes).cast(TOTAL).alias("net_income"))


def _measures(led: dict, year: int) -> DataFrame:
    """One row of natural-sign yearly measures from one scan."""
    p = in_year(led["postings"], year)
    kind = account_type("account")
    p = p.filter(kind.isin("Income", "Expenses") | F.col("account").isin(TAX_ACCOUNTS))
    one = p.agg(_sum_where(account_match_any("account", INCOME_ACCOUNTS), "_income"),
                _sum_where(F.col("account").isin(TAX_ACCOUNTS), "_taxes"),
                _sum_where(kind == "Expenses", "expenses"),
                _sum_where(F.col("account") == SALARY_ACCOUNT, "_salary"))
    one = one.select((-F.col("_income") - F.col("_taxes")).cast(TOTAL).alias("net_income"), "expenses",
                     (-F.col("_salary")).cast(TOTAL).alias("net_salary"))
    return one.withColumn("savings", (F.col("net_income") - F.col("expenses")).cast(TOTAL))


def net_income(led: dict, year: int) -> DataFrame:
    """Net income by the account formula, earnings positive."""
    return _measures(led, year).select("net_income")


def savings(led: dict, year: int) -> DataFrame:
    """Net income minus expenses."""
    return _measures(led, year).select("net_income", "expenses", "savings")


def savings_rates(led: dict, year: int) -> DataFrame:
    """Savings as percent of net income and of net salary; null over zero."""
    pct = lambda c: F.round(F.try_divide(F.col("savings").cast("double"), F.col(c).cast("double")) * 100, 6)
    return _measures(led, year).select("savings", pct("net_income").alias("vs_net_income"),
                                       pct("net_salary").alias("vs_net_salary"))


def wildcard_balance(led: dict, pattern: str) -> DataFrame:
    """Balance per currency over all accounts that match a wildcard."""
    return (led["postings"].filter(account_match("account", pattern))
            .groupBy("currency").agg(_sum("amount").alias("balance")))


def spend(led: dict, account: str, year: int) -> DataFrame:
    """Amount posted to one account in a year, per currency."""
    return (in_year(led["postings"], year).filter(F.col("account") == account)
            .groupBy("currency").agg(_sum("amount").alias("spent")))


def expenses_by_prefix(led: dict, depth: int) -> DataFrame:
    """Expenses grouped by the first `depth` account segments."""
    return (by_type(led["postings"], "Expenses").groupBy(prefix_at("account", depth).alias("prefix"))
            .agg(_sum("amount").alias("total")))


def rollup_accounts(led: dict) -> DataFrame:
    """Subtree total of every account and ancestor, per currency.

    Sums by account come first, so only one row per account is multiplied by its depth."""
    leaf = led["postings"].groupBy("account", "currency").agg(
        F.sum("amount").alias("s"), F.count(F.lit(1)).alias("c"))
    return (leaf.select(F.explode(account_prefixes("account")).alias("account"), "currency", "s", "c")
            .groupBy("account", "currency").agg(_sum("s").alias("total"), F.sum("c").alias("postings")))


def totals_by_currency(led: dict) -> DataFrame:
    """Sum per account type and currency."""
    return (led["postings"].groupBy(account_type("account").alias("type"), "currency")
            .agg(_sum("amount").alias("total")))


def monthly_expenses(led: dict, year: int) -> DataFrame:
    """Expenses per month and currency."""
    return (by_type(in_year(led["postings"], year), "Expenses")
            .groupBy(F.trunc("date", "MM").alias("month"), "currency").agg(_sum("amount").alias("total")))


def tag_counts(led: dict) -> DataFrame:
    """Transactions per tag."""
    return led["transaction_tags"].groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def top_tags(led: dict, k: int) -> DataFrame:
    """The k most used tags."""
    return tag_counts(led).orderBy(F.desc("n"), "tag").limit(k)


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First n rows in a stated order."""
    return df.orderBy(*order).limit(n)


def _weight() -> tuple[Column, Column]:
    """Balancing weight: units x cost, else units x price, else units; and its currency."""
    amount = (F.when(F.col("cost_amount").isNotNull(), times(F.col("amount"), F.col("cost_amount")))
              .when(F.col("price_amount").isNotNull(), times(F.col("amount"), F.col("price_amount")))
              .otherwise(F.col("amount").cast(VALUE)))
    currency = (F.when(F.col("cost_amount").isNotNull(), F.col("cost_currency"))
                .when(F.col("price_amount").isNotNull(), F.col("price_currency")).otherwise(F.col("currency")))
    return amount.cast(VALUE), currency


def unbalanced(led: dict, tol: str = "0.005", weighted: bool = True) -> DataFrame:
    """Transactions whose postings do not sum to zero in some currency."""
    amount, currency = _weight() if weighted else (F.col("amount").cast(VALUE), F.col("currency"))
    return (led["postings"].groupBy("external_id", currency.alias("weight_currency"))
            .agg(_sum(amount, VALUE).alias("residual"))
            .filter(F.abs("residual") > F.lit(tol).cast("decimal(19,4)")))


def cost_basis(led: dict) -> DataFrame:
    """Units and cost of holdings per account, commodity and cost currency."""
    return (led["postings"].filter(F.col("cost_amount").isNotNull())
            .groupBy("account", F.col("currency").alias("commodity"), "cost_currency")
            .agg(_sum("amount").alias("units"),
                 _sum(times(F.col("amount"), F.col("cost_amount")), VALUE).alias("cost")))
