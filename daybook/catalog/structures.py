"""Queries over digest trees, lots, account intervals, prices through other currencies, balances in two levels and
connected transactions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from daybook import adapter as A
from daybook.catalog.base import TOTAL, VALUE, query, view
from daybook.catalog.reports import VERDICT
from daybook.operators import connected, conversion, drift, facts, lots, snapshots, validity
from daybook.sources.workspace import Workspace

# ---- digest tree ---------------------------------------------------------------------

view("said", "SELECT seq, source_file, date, concat(external_id, '|', flag, '|', narration) AS content_hash FROM txn", "txn")
# what a stored copy lacks of 1996, holds twice of 1997 and has changed of 1998
view("said_stored", """SELECT source_file, date, CASE WHEN year(date) = 1998 AND seq % 89 = 0 THEN concat(content_hash, '!') ELSE content_hash END AS content_hash FROM said
      WHERE NOT (year(date) = 1996 AND seq % 97 = 0)
    UNION ALL SELECT source_file, date, content_hash FROM said WHERE year(date) = 1997 AND seq % 101 = 0""", "said")
view("said_diff", """SELECT *, 1 AS s FROM (SELECT source_file, date, content_hash FROM said EXCEPT ALL SELECT source_file, date, content_hash FROM said_stored)
    UNION ALL SELECT *, 0 FROM (SELECT source_file, date, content_hash FROM said_stored EXCEPT ALL SELECT source_file, date, content_hash FROM said)""", "said said_stored")


def said(spark, sf):
    return A.order_transactions(spark, sf).select("external_id", "source_file", "date", F.concat_ws("|", "external_id", "flag", "narration").alias("content_hash"))


def said_stored(spark, sf):
    """As two batches."""
    rows, key = said(spark, sf), F.col("external_id").cast("bigint")
    other = lambda y, n: (F.year("date") == y) & (key % n == 0)
    first = rows.where(~other(1996, 97)).withColumn("content_hash", F.when(other(1998, 89), F.concat("content_hash", F.lit("!"))).otherwise(F.col("content_hash")))
    return first, rows.where(other(1997, 101))


@query("a20_digest_tree", f"""SELECT source_file, CAST(year(date) AS integer) AS year, CAST(CAST('0x' || substr(d, 61, 4) AS integer) % {drift.BUCKETS} AS integer) AS bucket,
      CAST(count(*) AS DECIMAL(38,0)) AS n, CAST(sum(CAST('0x' || substr(d, 1, 15) AS bigint)) AS DECIMAL(38,0)) AS a, CAST(sum(CAST('0x' || substr(d, 16, 15) AS bigint)) AS DECIMAL(38,0)) AS b
    FROM (SELECT *, sha256(content_hash) AS d FROM said_stored) GROUP BY ALL""", "said_stored")
def a20_tree(spark, sf):
    return drift.merged(*[drift.leaves(batch) for batch in said_stored(spark, sf)])


@query("a21_drift", """SELECT source_file, year, n_source, n_stored FROM (SELECT DISTINCT source_file, CAST(year(date) AS integer) AS year FROM said_diff)
    JOIN (SELECT source_file, CAST(year(date) AS integer) AS year, count(*) AS n_source FROM said GROUP BY ALL) USING (source_file, year)
    JOIN (SELECT source_file, CAST(year(date) AS integer) AS year, count(*) AS n_stored FROM said_stored GROUP BY ALL) USING (source_file, year)""", "said said_stored said_diff")
def a21_drift(spark, sf):
    stored = drift.merged(*[drift.leaves(batch) for batch in said_stored(spark, sf)])
    return drift.drift(drift.leaves(said(spark, sf)), stored, ["source_file", "year"])


@query("a21_drifted_rows", """SELECT source_file, CAST(year(date) AS integer) AS year, content_hash, count(*) FILTER (s = 1) AS n_source, count(*) FILTER (s = 0) AS n_stored
    FROM (SELECT source_file, date, content_hash, 1 AS s FROM said UNION ALL SELECT source_file, date, content_hash, 0 FROM said_stored)
    GROUP BY ALL HAVING count(*) FILTER (s = 1) <> count(*) FILTER (s = 0)""", "said said_stored")
def a21_rows(spark, sf):
    source, batches = said(spark, sf), said_stored(spark, sf)
    found = drift.drift(drift.leaves(source), drift.merged(*map(drift.leaves, batches)))
    return drift.drifted_rows(source, batches[0].unionByName(batches[1]), found)


# ---- lots ----------------------------------------------------------------------------

# every third line of an order sells what the others buy, three brokers
view("trade", """SELECT concat('Assets:Broker', CAST(l_suppkey % 3 AS varchar)) AS account, currency AS commodity, date, external_id,
      CAST(row_number() OVER (PARTITION BY external_id ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS integer) AS posting_idx,
      CASE WHEN l_linenumber % 3 = 0 THEN 'sell' ELSE 'buy' END AS side, CAST(l_quantity AS DECIMAL(38,4)) AS quantity,
      CAST(CASE WHEN l_linenumber % 3 = 0 THEN l_extendedprice + l_linenumber ELSE l_extendedprice END AS DECIMAL(19,4)) AS price
    FROM p WHERE leg = 1 AND l_quantity > 0""", "p")
view("stretch", """SELECT *, high - quantity AS low FROM (SELECT *, sum(quantity) OVER (PARTITION BY account, commodity, side ORDER BY date, external_id, posting_idx) AS high FROM trade)""", "trade")
view("match", """SELECT b.account, b.commodity, b.external_id AS buy_id, b.posting_idx AS buy_idx, s.external_id AS sell_id, s.posting_idx AS sell_idx, s.date AS sell_date,
      b.price AS cost, s.price AS price, least(b.high, s.high) - greatest(b.low, s.low) AS quantity
    FROM stretch b JOIN stretch s ON b.account = s.account AND b.commodity = s.commodity AND b.low < s.high AND s.low < b.high WHERE b.side = 'buy' AND s.side = 'sell'""", "stretch")


def broker_postings(spark, sf):
    p = A.line_postings(spark, sf)
    sells = F.col("l_linenumber") % 3 == 0
    quantity, paid = F.col("l_quantity").cast("decimal(19,4)"), F.col("l_extendedprice").cast("decimal(19,4)")
    return p.where("leg = 1 AND l_quantity > 0").select(
        F.concat(F.lit("Assets:Broker"), (F.col("l_suppkey") % 3).cast("string")).alias("account"), "currency", "date", "external_id",
        # by the order's key, by which its lines lie together after they met it; the id is its text
        F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*A.LINE_ORDER[:-1])).alias("posting_idx"), F.when(sells, -quantity).otherwise(quantity).alias("amount"), paid.alias("cost_amount"),
        F.when(sells, (paid + F.col("l_linenumber")).cast("decimal(19,4)")).alias("price_amount"))


@query("a18_lot_matches", f"SELECT * EXCLUDE quantity, CAST(quantity AS {TOTAL}) AS quantity FROM match", "match")
def a18_matches(spark, sf):
    return lots.matches(broker_postings(spark, sf))


@query("a18_open_lots", f"""SELECT account, commodity, external_id, posting_idx, date, CAST(units AS DECIMAL(19,4)) AS units, price AS cost, CAST(CAST(units AS DECIMAL(19,4)) * CAST(price AS DECIMAL(18,4)) AS {VALUE}) AS basis
    FROM (SELECT *, high - greatest(low, coalesce((SELECT max(s.high) FROM stretch s WHERE s.side = 'sell' AND s.account = b.account AND s.commodity = b.commodity), 0)) AS units
          FROM stretch b WHERE side = 'buy') WHERE units > 0""", "stretch")
def a18_open(spark, sf):
    return lots.open_lots(broker_postings(spark, sf))


@query("a18_realised_gains", f"""SELECT t.account, t.commodity, t.external_id, t.posting_idx, t.date, t.quantity, CAST(t.quantity - coalesce(covered, 0) AS {TOTAL}) AS uncovered,
      CAST(coalesce(cost, 0) AS {VALUE}) AS cost, CAST(coalesce(proceeds, 0) AS {VALUE}) AS proceeds, CAST(coalesce(proceeds, 0) - coalesce(cost, 0) AS {VALUE}) AS gain
    FROM trade t LEFT JOIN (SELECT account, commodity, sell_id, sell_idx, sum(quantity) AS covered, sum(CAST(quantity AS DECIMAL(19,4)) * CAST(cost AS DECIMAL(18,4))) AS cost,
        sum(CAST(quantity AS DECIMAL(19,4)) * CAST(price AS DECIMAL(18,4))) AS proceeds FROM match GROUP BY ALL) m
      ON m.account = t.account AND m.commodity = t.commodity AND sell_id = external_id AND sell_idx = posting_idx WHERE side = 'sell'""", "trade match")
def a18_gains(spark, sf):
    return lots.realised_gains(broker_postings(spark, sf))


# ---- account intervals ---------------------------------------------------------------

view("life", """SELECT account, date, max(CASE WHEN kind = 'open' THEN 1 ELSE 0 END) AS o, max(CASE WHEN kind = 'close' THEN 1 ELSE 0 END) AS c,
      lag(CASE WHEN max(CASE WHEN kind = 'close' THEN 1 ELSE 0 END) = 1 THEN 'closed' ELSE 'open' END) OVER (PARTITION BY account ORDER BY date) AS state FROM oc GROUP BY account, date""", "oc")


@query("w3_account_intervals", """SELECT account, row_number() OVER (PARTITION BY account ORDER BY date) AS n, date AS open_date,
      (SELECT min(e.date) FROM life e WHERE e.account = b.account AND e.c = 1 AND e.date >= b.date) AS close_date
    FROM life b WHERE o = 1 AND coalesce(state, 'closed') = 'closed'""", "life")
def w3_intervals(spark, sf):
    return validity.account_intervals(validity.lifecycle(A.lifecycle_directives(spark, sf)))


@query("w3_invalid_uses", """SELECT use, u.account, u.date, external_id, posting_idx, CASE WHEN first_open IS NULL THEN 'never opened' WHEN first_open < u.date THEN 'after close' ELSE 'before open' END AS reason,
      source_file, source_line
    FROM (SELECT 'posting' AS use, concat('Assets:Cust:C', CAST(o_custkey AS varchar)) AS account, txn.date, external_id, CAST(0 AS integer) AS posting_idx, source_file, source_line
            FROM orders JOIN txn ON seq = o_orderkey
          UNION ALL SELECT 'balance', account, date, NULL, NULL, source_file, source_line FROM bal
          UNION ALL SELECT 'document', account, date, NULL, NULL, source_file, source_line FROM doc) u
      ASOF LEFT JOIN (SELECT account, date, CASE WHEN c = 1 THEN 'closed' ELSE 'open' END AS after FROM life) s ON u.account = s.account AND u.date > s.date
      LEFT JOIN (SELECT account, date FROM life WHERE o = 1) t ON t.account = u.account AND t.date = u.date
      LEFT JOIN (SELECT account, min(date) AS first_open FROM life WHERE o = 1 GROUP BY account) f ON f.account = u.account
    WHERE t.date IS NULL AND coalesce(after, 'none') <> 'open'""", "life txn bal doc")
def w3_uses(spark, sf):
    led = A.flat_ledger(spark, sf)
    orders = A.table(spark, sf, "orders")
    postings = orders.select(F.concat(F.lit("Assets:Cust:C"), F.col("o_custkey").cast("string")).alias("account"), F.col("o_orderdate").cast("date").alias("date"),
                             F.col("o_orderkey").cast("string").alias("external_id"), F.lit(0).alias("posting_idx"))
    tables = {"postings": postings, "transactions": led["transactions"], "balance_assertions": led["balance_assertions"], "ledger_documents": facts.build_documents(A.other_directives(spark, sf))}
    return validity.invalid_uses(tables, validity.lifecycle(A.lifecycle_directives(spark, sf)))


# ---- prices through other currencies -------------------------------------------------

# C0 and C1 are quoted in dollars, C9 in gold only, the others in two commodities before them
view("cross_px", """SELECT event_id AS seq, CAST(ts AS date) AS date, concat('C', CAST(k AS varchar)) AS commodity, CAST(value AS decimal(19,4)) AS price_amount,
      CASE WHEN k < 2 THEN 'USD' WHEN k = 9 THEN 'XAU' WHEN event_id % 2 = 0 THEN concat('C', CAST(k - 1 AS varchar)) ELSE concat('C', CAST(k // 2 AS varchar)) END AS price_currency
    FROM (SELECT *, user_id % 10 AS k FROM events) WHERE event_type = 'view' AND value IS NOT NULL""")
view("cross_edge", """SELECT *, lead(date) OVER (PARTITION BY commodity, price_currency ORDER BY date) AS until
    FROM (SELECT commodity, price_currency, date, CAST(arg_max(price_amount, seq) AS double) AS amount FROM cross_px GROUP BY ALL)""", "cross_px")


def cross_prices(spark, sf):
    k = F.col("user_id") % 10
    named = lambda n: F.concat(F.lit("C"), n.cast("string"))
    other = F.when(F.col("event_id") % 2 == 0, named(k - 1)).otherwise(named(F.floor(k / 2)))
    return A.table(spark, sf, "events").where("event_type = 'view' AND value IS NOT NULL").select(
        F.col("event_id").alias("seq"), F.col("ts").cast("date").alias("date"), named(k).alias("commodity"), F.col("value").cast("decimal(19,4)").alias("price_amount"),
        F.when(k < 2, "USD").when(k == 9, "XAU").otherwise(other).alias("price_currency"))


@query("j9_value_in_dollars", f"""SELECT event_id, h.commodity, h.date, quantity, hops, rate, CAST(quantity AS double) * rate AS value FROM hold h LEFT JOIN (
      WITH RECURSIVE walk AS (
        SELECT DISTINCT commodity, date, commodity AS cur, CAST(0 AS integer) AS hops, CAST(1 AS double) AS rate, CAST([] AS STRUCT(age bigint, currency varchar)[]) AS steps FROM hold
        UNION ALL
        SELECT w.commodity, w.date, price_currency, CAST(hops + 1 AS integer), rate * amount, list_append(steps, {{'age': -date_diff('day', DATE '1970-01-01', e.date), 'currency': price_currency}})
        FROM walk w JOIN cross_edge e ON e.commodity = w.cur AND e.date <= w.date AND (until IS NULL OR w.date < until) WHERE hops < {conversion.DEPTH} AND w.cur <> 'USD')
      SELECT *, row_number() OVER (PARTITION BY commodity, date ORDER BY hops, steps) AS place FROM walk WHERE cur = 'USD') r
    ON r.commodity = h.commodity AND r.date = h.date AND place = 1""", "hold cross_edge")
def j9_in_dollars(spark, sf):
    return conversion.value_in(A.holdings(spark, sf), cross_prices(spark, sf), "USD").select(
        "event_id", "commodity", "date", "quantity", "hops", "rate", "value")


# ---- balances in two levels ----------------------------------------------------------

AS_OF = dt.date(1997, 5, 17)


def stored_months(spark, sf):
    """The months of two batches, stored one after the other."""
    p, folder = A.line_postings(spark, sf), Workspace(spark, "months").path
    early = F.col("external_id").cast("bigint") % 2 == 0
    for i, batch in enumerate((p.where(early), p.where(~early))):
        snapshots.add_batch(batch, folder, i)
    return snapshots.stored_months(spark, folder)


@query("w6_month_balances", f"""SELECT account, currency, month, CAST(change AS {TOTAL}) AS change, CAST(sum(change) OVER (PARTITION BY account, currency ORDER BY month) AS {TOTAL}) AS balance
    FROM (SELECT account, currency, CAST(date_trunc('month', date) AS date) AS month, sum(amount) AS change FROM p GROUP BY ALL)""", "p")
def w6_months(spark, sf):
    return snapshots.closing_balances(stored_months(spark, sf))


@query("a1_balances_as_of", f"SELECT account, currency, CAST(sum(amount) AS {TOTAL}) AS balance FROM p WHERE date <= DATE '{AS_OF}' GROUP BY account, currency", "p")
def a1_as_of(spark, sf):
    return snapshots.balances_as_of(stored_months(spark, sf), A.line_postings(spark, sf), AS_OF)


@query("j8_verify_by_months", VERDICT.format(tol="0.005"), "p bal")
def j8_months(spark, sf):
    return snapshots.verify_balances(A.flat_ledger(spark, sf), stored_months(spark, sf))


# ---- connected transactions ----------------------------------------------------------

# a third of all customers pay into one collective invoice; others share a customer's month or the first part's quarter
view("tie", """SELECT CAST(o_orderkey AS varchar) AS external_id,
      CASE WHEN o_custkey % 3 = 0 THEN 'collective' ELSE concat('cust-', CAST(o_custkey AS varchar), '-', strftime(CAST(o_orderdate AS date), '%Y%m')) END AS link FROM orders
    UNION SELECT CAST(o_orderkey AS varchar), concat('lot-', CAST(l_partkey AS varchar), '-', CAST(year(CAST(o_orderdate AS date)) AS varchar), '-', CAST(quarter(CAST(o_orderdate AS date)) AS varchar))
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber = 1""")
# labels go round until nothing can change: a path has fewer steps than the rounds
view("tied", """SELECT id AS external_id, label AS component, count(*) OVER (PARTITION BY label) AS size FROM (
      WITH RECURSIVE walk AS (
        SELECT DISTINCT external_id AS id, external_id AS label, 0 AS step FROM tie
        UNION ALL
        SELECT t.external_id, min(m.label), any_value(m.step) + 1
        FROM tie t JOIN (SELECT link, min(label) AS label, any_value(step) AS step FROM walk JOIN tie ON external_id = id WHERE step < 60 GROUP BY link) m ON m.link = t.link
        GROUP BY t.external_id)
      SELECT id, label FROM walk WHERE step = 60)""", "tie")


def tie_pairs(spark, sf):
    orders = A.table(spark, sf, "orders").withColumn("date", F.col("o_orderdate").cast("date"))
    own = F.col("o_orderkey").cast("string").alias("external_id")
    paid = F.when(F.col("o_custkey") % 3 == 0, "collective").otherwise(F.concat_ws("-", F.lit("cust"), "o_custkey", F.date_format("date", "yyyyMM")))
    first = A.table(spark, sf, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    lot = F.concat_ws("-", F.lit("lot"), "l_partkey", F.year("date"), F.quarter("date"))
    return orders.select(own, paid.alias("link")).unionByName(orders.join(first, "o_orderkey").select(own, lot.alias("link")))


@query("j10_components", "SELECT * FROM tied", "tied")
def j10_components(spark, sf):
    found = connected.components(tie_pairs(spark, sf))
    return found.join(found.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "component").select("external_id", "component", "size")


@query("j10_component_totals", f"""SELECT component, size, currency, count(*) AS transactions, CAST(sum(debit) AS {TOTAL}) AS debits
    FROM tied JOIN (SELECT external_id, currency, sum(amount) FILTER (amount > 0) AS debit FROM p GROUP BY ALL) USING (external_id) GROUP BY ALL""", "p tied")
def j10_totals(spark, sf):
    return connected.component_totals({"transaction_links": tie_pairs(spark, sf), "postings": A.line_postings(spark, sf)})
