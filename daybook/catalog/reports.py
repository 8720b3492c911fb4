"""Queries over the line item ledger: filters, joins, reports, time series."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook import adapter as A
from daybook.catalog.base import TOTAL, VALUE, query
from daybook.functions import accounts as AC
from daybook.operators import analytics as R
from daybook.operators import facts, registries, temporal
from daybook.operators.numbering import assign_ids

YEAR = 1998


def led(spark, sf):
    return A.flat_ledger(spark, sf)


def _total(name="s", column="amount"):
    return F.sum(column).cast("decimal(38,4)").alias(name)


# ---- projections and filters ---------------------------------------------------------

@query("prj1_account_type", f"SELECT type, account, CAST(sum(amount) AS {TOTAL}) AS s, count(*) AS n FROM p GROUP BY type, account", "p")
def prj1(spark, sf):
    return (led(spark, sf)["postings"].groupBy(AC.account_type("account").alias("type"), "account")
            .agg(_total(), F.count(F.lit(1)).alias("n")))


@query("flt2_by_type", "SELECT external_id, date, account, amount, currency FROM p WHERE type = 'Income'", "p")
def flt2(spark, sf):
    return R.by_type(led(spark, sf)["postings"], "Income").select("external_id", "date", "account", "amount", "currency")


@query("flt3_under", """SELECT account, count(*) AS n, 'subtree' AS form FROM p
    WHERE account = 'Expenses:Car' OR account LIKE 'Expenses:Car:%' GROUP BY account
  UNION ALL SELECT account, count(*), 'spelled' FROM p WHERE account LIKE 'Expenses:E%' GROUP BY account""", "p")
def flt3(spark, sf):
    p = led(spark, sf)["postings"]
    n = F.count(F.lit(1)).alias("n")
    return (R.subtree(p, "Expenses:Car").groupBy("account").agg(n).withColumn("form", F.lit("subtree"))
            .unionByName(p.filter(AC.spelled_like("account", "Expenses:E")).groupBy("account").agg(n)
                         .withColumn("form", F.lit("spelled"))))


@query("flt4_account_match", r"""SELECT account, count(*) AS n FROM p
    WHERE regexp_matches(account, '^Assets:[^:]+:Savings$') OR account LIKE 'Equity:Taxes:_%' GROUP BY account""", "p")
def flt4(spark, sf):
    return (led(spark, sf)["postings"].filter(AC.account_match_any("account", ["Assets:*:Savings", "Equity:Taxes:*"]))
            .groupBy("account").agg(F.count(F.lit(1)).alias("n")))


@query("flt5_in_year", f"SELECT external_id, date, flag, payee FROM txn WHERE year(date) = {YEAR}", "txn")
def flt5(spark, sf):
    return R.in_year(led(spark, sf)["transactions"], YEAR).select("external_id", "date", "flag", "payee")


@query("flt6_in_currency", "SELECT account, count(*) AS n FROM p WHERE currency = 'USD' GROUP BY account", "p")
def flt6(spark, sf):
    return R.in_currency(led(spark, sf)["postings"], "USD").groupBy("account").agg(F.count(F.lit(1)).alias("n"))


@query("flt7_trace", """SELECT external_id, source_file, source_line FROM txn WHERE external_id = '7'
    UNION ALL SELECT external_id, source_file, source_line FROM txn WHERE source_file = '/data/ledger_1996.dir'""", "txn")
def flt7(spark, sf):
    book = led(spark, sf)
    return R.trace(book, "7").unionByName(
        R.from_file(book, "/data/ledger_1996.dir").select("external_id", "source_file", "source_line"))


# ---- joins ---------------------------------------------------------------------------

@query("j1_resolve", "SELECT account, currency, amount, type AS account_type, 'open' AS account_status FROM p", "p")
def j1(spark, sf):
    book = led(spark, sf)
    return registries.resolve(book["postings"].select("account", "currency", "amount"), book["accounts"], "account")


@query("j4_star", """SELECT p.external_id, p.date, account, type, amount, currency, payee, narration, source_file
    FROM p JOIN txn ON txn.external_id = p.external_id""", "p txn")
def j4(spark, sf):
    return R.star(led(spark, sf)).select("external_id", "date", "account", "type", "amount", "currency", "payee",
                                         "narration", "source_file")


@query("j5_optional_currencies", f"""SELECT cost_currency, price_currency, cost_currency IS NOT NULL AS has_cost,
    price_currency IS NOT NULL AS has_price, count(*) AS n, CAST(sum(amount) AS {TOTAL}) AS s FROM p GROUP BY ALL""", "p")
def j5(spark, sf):
    book = led(spark, sf)
    return (R.optional_currencies(book["postings"], book["commodities"]).groupBy("cost_currency", "price_currency", "has_cost", "has_price")
            .agg(F.count(F.lit(1)).alias("n"), _total()))


@query("j6_combine_totals", f"""SELECT (SELECT CAST(sum(amount) AS {TOTAL}) FROM p WHERE type = 'Income' AND currency = 'USD' AND year(date) = {YEAR}) AS total_income,
    (SELECT CAST(sum(amount) AS {TOTAL}) FROM p WHERE type = 'Expenses' AND year(date) = {YEAR}) AS total_expenses""", "p")
def j6(spark, sf):
    book = led(spark, sf)
    return R.combine_totals(R.total_income(book, YEAR, "USD"), R.total_expenses(book, YEAR))


VERDICT = f"""SELECT b.date, b.account, b.currency, b.amount AS asserted, CAST(coalesce(sum(d.day), 0) AS {TOTAL}) AS computed,
      CAST(coalesce(sum(d.day), 0) - b.amount AS {TOTAL}) AS diff,
      abs(coalesce(sum(d.day), 0) - b.amount) <= {{tol}} AS ok, b.source_file, b.source_line
    FROM bal b LEFT JOIN (SELECT account, currency, date, sum(amount) AS day FROM p GROUP BY ALL) d
      ON (d.account = b.account OR starts_with(d.account, concat(b.account, ':'))) AND d.currency = b.currency AND d.date < b.date
    GROUP BY b.date, b.account, b.currency, b.amount, b.source_file, b.source_line"""


@query("j8_verify_balances", VERDICT.format(tol="0.005"), "p bal")
def j8(spark, sf):
    return temporal.verify_balances(led(spark, sf))


@query("j8_verify_balances_tolerance", f"SELECT ok, count(*) AS n, CAST(sum(diff) AS {TOTAL}) AS s FROM ({VERDICT.format(tol='1000000')}) GROUP BY ok", "p bal")
def j8_tol(spark, sf):
    v = temporal.verify_balances(led(spark, sf), "1000000")
    return v.groupBy("ok").agg(F.count(F.lit(1)).alias("n"), _total("s", "diff"))


PX_DAY = "SELECT commodity, date, arg_max(price_amount, source_line) AS price_amount, 'USD' AS price_currency FROM px GROUP BY commodity, date"


@query("j9_value_positions", f"""SELECT h.event_id, h.commodity, h.date, h.quantity, q.price_amount, q.price_currency,
      CAST(h.quantity * CAST(q.price_amount AS decimal(18,4)) AS {VALUE}) AS value
    FROM hold h ASOF LEFT JOIN ({PX_DAY}) q ON q.commodity = h.commodity AND q.date <= h.date""", "hold px")
def j9(spark, sf):
    prices = facts.build_prices(A.directives(spark, sf))
    return temporal.value_positions(A.holdings(spark, sf), prices).select(
        "event_id", "commodity", "date", "quantity", "price_amount", "price_currency", "value")


@query("j9_portfolio_value", f"""SELECT h.commodity, h.date, h.quantity, q.price_amount, q.price_currency,
      CAST(h.quantity * CAST(q.price_amount AS decimal(18,4)) AS {VALUE}) AS value
    FROM (SELECT commodity, date, CAST(sum(sum(quantity)) OVER (PARTITION BY commodity ORDER BY date) AS decimal(19,4)) AS quantity
          FROM hold GROUP BY commodity, date) h
    ASOF LEFT JOIN ({PX_DAY}) q ON q.commodity = h.commodity AND q.date <= h.date""", "hold px")
def j9_portfolio(spark, sf):
    prices = facts.build_prices(A.directives(spark, sf))
    return temporal.portfolio_value(A.holdings(spark, sf), prices)


@query("j10_with_tags", "SELECT t.external_id, tag, date, payee FROM txn t JOIN tag_row g ON g.external_id = t.external_id", "txn tag_row")
def j10(spark, sf):
    return R.with_tags(led(spark, sf)).select("external_id", "tag", "date", "payee")


@query("j10_linked", f"""SELECT link, count(*) AS transactions, CAST(sum(debit) AS {TOTAL}) AS debits FROM link_row l
    LEFT JOIN (SELECT external_id, CAST(sum(CASE WHEN amount > 0 THEN amount END) AS {TOTAL}) AS debit
               FROM p WHERE currency = 'USD' GROUP BY external_id) d ON d.external_id = l.external_id GROUP BY link""", "p link_row")
def j10_linked(spark, sf):
    return R.linked(led(spark, sf), "USD")


@query("j10_sharing_links", """SELECT external_id, l.link, shared_by FROM link_row l
    JOIN (SELECT link, count(*) AS shared_by FROM link_row GROUP BY link HAVING count(*) > 1) s ON s.link = l.link""", "link_row")
def j10_sharing(spark, sf):
    return R.sharing_links(led(spark, sf))


@query("src4_bulk_load", """SELECT p.external_id, CAST(NULL AS varchar) AS flag, a.id AS account_id, amount, c1.id AS currency_id,
      cost_amount, c2.id AS cost_currency_id, price_amount, c3.id AS price_currency_id
    FROM p JOIN txn ON txn.external_id = p.external_id
    JOIN (SELECT name, row_number() OVER (ORDER BY md5(name), name) AS id FROM (SELECT DISTINCT account AS name FROM p)) a ON a.name = p.account
    JOIN cid c1 ON c1.name = p.currency LEFT JOIN cid c2 ON c2.name = p.cost_currency
    LEFT JOIN cid c3 ON c3.name = p.price_currency""", "p txn cid")
def src4(spark, sf):
    book = led(spark, sf)
    return facts.bulk_load(book["transactions"], book["postings"], assign_ids(book["accounts"], "name"),
                           assign_ids(book["commodities"], "name"))


# ---- reports -------------------------------------------------------------------------

@query("a1_account_balance", f"SELECT CAST(sum(amount) AS {TOTAL}) AS balance FROM p WHERE account = 'Assets:BankA:Checking' AND currency = 'USD'", "p")
def a1(spark, sf):
    return R.account_balance(led(spark, sf), "Assets:BankA:Checking", "USD")


@query("a1_account_balances", f"SELECT account, currency, CAST(sum(amount) AS {TOTAL}) AS balance FROM p GROUP BY account, currency", "p")
def a1_all(spark, sf):
    return R.account_balances(led(spark, sf))


@query("a2_total_income", f"SELECT CAST(sum(amount) AS {TOTAL}) AS total_income FROM p WHERE type = 'Income' AND year(date) = {YEAR} AND currency = 'USD'", "p")
def a2(spark, sf):
    return R.total_income(led(spark, sf), YEAR, "USD")


# The documented category rule and income formula, restated for the checks.
CATEGORY = """CASE WHEN account LIKE 'Expenses:Car%' THEN 'Car'
      WHEN account LIKE 'Expenses:Food%' OR account IN ('Expenses:Groceries', 'Expenses:EatingOut') THEN 'Food'
      WHEN account = 'Expenses:HouseRent' THEN 'Housing' ELSE split_part(account, ':', 2) END"""
BY_CATEGORY = f"""SELECT {CATEGORY} AS category, CAST(sum(amount) AS {TOTAL}) AS total FROM p
    WHERE type = 'Expenses' AND year(date) = {YEAR} GROUP BY 1 ORDER BY total DESC, category"""


@query("a3_expenses_by_category", BY_CATEGORY, "p")
def a3(spark, sf):
    return R.expenses_by_category(led(spark, sf), YEAR)


@query("a4_total_expenses", f"SELECT CAST(sum(amount) AS {TOTAL}) AS total_expenses FROM p WHERE type = 'Expenses' AND year(date) = {YEAR}", "p")
def a4(spark, sf):
    return R.total_expenses(led(spark, sf), YEAR)


@query("a5_gross_income", f"""SELECT CAST(sum(amount) AS {TOTAL}) AS gross_income FROM p
    WHERE (type = 'Income' OR account LIKE 'Equity:Taxes:_%') AND year(date) = {YEAR}""", "p")
def a5(spark, sf):
    return R.gross_income(led(spark, sf), YEAR)


@query("a6_net_income_sql", f"""SELECT CAST(i.income - t.taxes AS {TOTAL}) AS net_income
    FROM (SELECT sum(amount) AS income FROM p WHERE type = 'Income' AND year(date) = {YEAR}) i,
         (SELECT sum(amount) AS taxes FROM p WHERE account IN ('Equity:Taxes:Federal', 'Equity:Taxes:State') AND year(date) = {YEAR}) t""", "p")
def a6(spark, sf):
    return R.net_income_sql(led(spark, sf), YEAR)


MEASURES = f"""SELECT CAST(-income - taxes AS {TOTAL}) AS net_income, expenses, CAST(-salary AS {TOTAL}) AS net_salary,
      CAST(-income - taxes - expenses AS {TOTAL}) AS savings FROM (
    SELECT CAST(coalesce(sum(amount) FILTER (WHERE account IN ('Income:Salary:Net', 'Income:CreditCard:Rewards', 'Income:Other',
             'Income:Bonus', 'Income:Gifts') OR account LIKE 'Income:Interest:_%' OR account LIKE 'Income:Reimbursements:_%'), 0) AS {TOTAL}) AS income,
      CAST(coalesce(sum(amount) FILTER (WHERE account IN ('Equity:Taxes:Federal', 'Equity:Taxes:State')), 0) AS {TOTAL}) AS taxes,
      CAST(coalesce(sum(amount) FILTER (WHERE type = 'Expenses'), 0) AS {TOTAL}) AS expenses,
      CAST(coalesce(sum(amount) FILTER (WHERE account = 'Income:Salary:Net'), 0) AS {TOTAL}) AS salary
    FROM p WHERE year(date) = {YEAR})"""


@query("a7_net_income", f"SELECT net_income FROM ({MEASURES})", "p")
def a7(spark, sf):
    return R.net_income(led(spark, sf), YEAR)


@query("a8_savings", f"SELECT net_income, expenses, savings FROM ({MEASURES})", "p")
def a8(spark, sf):
    return R.savings(led(spark, sf), YEAR)


@query("a9_savings_rates", f"""SELECT savings,
    round(CAST(savings AS double) / nullif(CAST(net_income AS double), 0) * 100, 6) AS vs_net_income,
    round(CAST(savings AS double) / nullif(CAST(net_salary AS double), 0) * 100, 6) AS vs_net_salary FROM ({MEASURES})""", "p")
def a9(spark, sf):
    return R.savings_rates(led(spark, sf), YEAR)


@query("a10_wildcard_balance", f"""SELECT currency, CAST(sum(amount) AS {TOTAL}) AS balance FROM p
    WHERE regexp_matches(account, '^Assets:[^:]+:Savings$') GROUP BY currency""", "p")
def a10(spark, sf):
    return R.wildcard_balance(led(spark, sf), "Assets:*:Savings")


@query("a11_spend", f"SELECT currency, CAST(sum(amount) AS {TOTAL}) AS spent FROM p WHERE account = 'Expenses:Groceries' AND year(date) = {YEAR} GROUP BY currency", "p")
def a11(spark, sf):
    return R.spend(led(spark, sf), "Expenses:Groceries", YEAR)


@query("a12_expenses_by_prefix", f"""SELECT array_to_string(string_split(account, ':')[1:2], ':') AS prefix, CAST(sum(amount) AS {TOTAL}) AS total
    FROM p WHERE type = 'Expenses' GROUP BY 1""", "p")
def a12(spark, sf):
    return R.expenses_by_prefix(led(spark, sf), 2)


@query("a13_rollup_accounts", f"""SELECT prefix AS account, currency, CAST(sum(amount) AS {TOTAL}) AS total, count(*) AS postings FROM (
      SELECT unnest([array_to_string(string_split(account, ':')[1:i], ':') FOR i IN generate_series(1, len(string_split(account, ':')))]) AS prefix,
        currency, amount FROM p) GROUP BY prefix, currency""", "p")
def a13(spark, sf):
    return R.rollup_accounts(led(spark, sf))


@query("a14_totals_by_currency", f"SELECT type, currency, CAST(sum(amount) AS {TOTAL}) AS total FROM p GROUP BY type, currency", "p")
def a14(spark, sf):
    return R.totals_by_currency(led(spark, sf))


@query("a15_monthly_expenses", f"""SELECT CAST(date_trunc('month', date) AS date) AS month, currency, CAST(sum(amount) AS {TOTAL}) AS total
    FROM p WHERE type = 'Expenses' AND year(date) = {YEAR} GROUP BY 1, 2""", "p")
def a15(spark, sf):
    return R.monthly_expenses(led(spark, sf), YEAR)


@query("a16_top_tags", "SELECT tag, count(*) AS n FROM tag_row GROUP BY tag ORDER BY n DESC, tag LIMIT 5", "tag_row")
def a16(spark, sf):
    return R.top_tags(led(spark, sf), 5)


@query("a16_tag_counts", "SELECT tag, count(*) AS n FROM tag_row GROUP BY tag", "tag_row")
def a16_all(spark, sf):
    return R.tag_counts(led(spark, sf))


@query("a17_unbalanced_units", f"""SELECT external_id, currency AS weight_currency, CAST(sum(amount) AS {VALUE}) AS residual FROM p
    WHERE account <> 'Liabilities:BankA:CreditCard' GROUP BY external_id, currency HAVING abs(sum(amount)) > 0.005""", "p")
def a17_units(spark, sf):
    # without the card's postings, whatever was paid by card does not balance
    kept = led(spark, sf)["postings"].filter("account <> 'Liabilities:BankA:CreditCard'")
    return R.unbalanced({"postings": kept}, weighted=False)


# 15-digit costs and prices: exact in units of 10**-8, by whole numbers
WIDE = """SELECT external_id, account, currency, CAST(amount * 10000 AS HUGEINT) AS a,
      CAST(100000000000 AS HUGEINT) * l_partkey * 10000 + 12345 + CAST(10000 * amount AS HUGEINT) AS c FROM p"""


@query("a18_cost_basis_wide", f"""SELECT account, currency AS commodity, 'USD' AS cost_currency, CAST(CAST(sum(a) AS varchar) AS DECIMAL(38,0)) AS units_e4,
      CAST(CAST(sum(a * c) AS varchar) AS DECIMAL(38,0)) AS cost_e8 FROM ({WIDE}) GROUP BY account, currency""", "p")
def a18_wide(spark, sf):
    cost = "CAST(CAST(l_partkey AS decimal(15,0)) * CAST(100000000000 AS decimal(12,0)) + CAST(1.2345 AS decimal(5,4)) + amount AS decimal(23,4))"   # wider than the stored type, as part keys grow
    postings = led(spark, sf)["postings"].withColumns({"cost_amount": F.expr(cost), "cost_currency": F.lit("USD")})
    basis = R.cost_basis({"postings": postings})
    whole = lambda c, places: F.replace(F.col(c).cast("string"), F.lit("."), F.lit("")).cast("decimal(38,0)").alias(f"{c}_e{places}")
    return basis.select("account", "commodity", "cost_currency", whole("units", 4), whole("cost", 8))


@query("a17_unbalanced_weights", f"""SELECT external_id, weight_currency, CAST(sum(w) AS {VALUE}) AS residual FROM (
      SELECT external_id, CASE WHEN cost_amount IS NOT NULL THEN cost_currency WHEN price_amount IS NOT NULL THEN price_currency ELSE currency END AS weight_currency,
        CAST(CASE WHEN cost_amount IS NOT NULL THEN amount * CAST(cost_amount AS decimal(18,4))
                  WHEN price_amount IS NOT NULL THEN amount * CAST(price_amount AS decimal(18,4)) ELSE amount END AS {VALUE}) AS w FROM p)
    GROUP BY external_id, weight_currency HAVING abs(sum(w)) > 0.005""", "p")
def a17_weights(spark, sf):
    return R.unbalanced(led(spark, sf))


@query("a18_cost_basis", f"""SELECT account, currency AS commodity, cost_currency, CAST(sum(amount) AS {TOTAL}) AS units,
      CAST(sum(amount * CAST(cost_amount AS decimal(18,4))) AS {VALUE}) AS cost
    FROM p WHERE cost_amount IS NOT NULL GROUP BY ALL""", "p")
def a18(spark, sf):
    return R.cost_basis(led(spark, sf))


FILES = ["/data/ledger_1996.dir", "/data/ledger_1998.dir"]


@query("a24_count_by_file", "SELECT source_file, count(*) AS n FROM txn WHERE source_file IN ('/data/ledger_1996.dir', '/data/ledger_1998.dir') GROUP BY source_file", "txn")
def a24(spark, sf):
    return R.count_by_file(led(spark, sf), FILES)


@query("w6_running_balance", f"""SELECT account, currency, date, CAST(sum(amount) AS {TOTAL}) AS change,
    CAST(sum(sum(amount)) OVER (PARTITION BY account, currency ORDER BY date) AS {TOTAL}) AS balance FROM p GROUP BY account, currency, date""", "p")
def w6(spark, sf):
    return temporal.running_balance(led(spark, sf))


@query("s1_ordered_categories", f"SELECT *, row_number() OVER (ORDER BY total DESC, category) AS place FROM ({BY_CATEGORY})", "p")
def s1(spark, sf):
    return R.ranked_categories(led(spark, sf), YEAR)


@query("s2_top_categories", f"SELECT * FROM ({BY_CATEGORY}) ORDER BY total DESC, category LIMIT 3", "p")
def s2(spark, sf):
    return R.top_categories(led(spark, sf), YEAR, 3)


@query("s3_head", "SELECT external_id, date, payee FROM txn ORDER BY date, seq LIMIT 10", "txn")
def s3(spark, sf):
    return R.head(led(spark, sf)["transactions"], 10, "date", "seq").select("external_id", "date", "payee")


# ---- scalar functions ----------------------------------------------------------------

@query("e8_category", f"SELECT account, {CATEGORY} AS category, count(*) AS n FROM p GROUP BY 1, 2", "p")
def e8(spark, sf):
    return (led(spark, sf)["postings"].groupBy("account", AC.category("account").alias("category"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("e9_year", "SELECT CAST(year(date) AS integer) AS year, count(*) AS n FROM txn GROUP BY 1", "txn")
def e9(spark, sf):
    return led(spark, sf)["transactions"].groupBy(F.year("date").alias("year")).agg(F.count(F.lit(1)).alias("n"))


@query("e10_display_amount", f"SELECT account, CAST(sum(abs(amount)) AS {TOTAL}) AS shown FROM p GROUP BY account", "p")
def e10(spark, sf):
    return (led(spark, sf)["postings"].withColumn("a", AC.display_amount("amount"))
            .groupBy("account").agg(_total("shown", "a")))


@query("e11_account_prefixes", """SELECT unnest([array_to_string(string_split(account, ':')[1:i], ':') FOR i IN generate_series(1, len(string_split(account, ':')))]) AS prefix,
    account FROM (SELECT DISTINCT account FROM p)""", "p")
def e11(spark, sf):
    return led(spark, sf)["accounts"].select(F.explode(AC.account_prefixes("name")).alias("prefix"), F.col("name").alias("account"))


@query("e12_basename", "SELECT split_part(source_file, '/', 3) AS file, count(*) AS n FROM txn GROUP BY 1", "txn")
def e12(spark, sf):
    return (led(spark, sf)["transactions"].groupBy(AC.basename("source_file").alias("file"))
            .agg(F.count(F.lit(1)).alias("n")))
