"""Query registry and the SQL views the checks share.

The SQL restates the adapter on the given tables; each check then states its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybook.adapter import FUNDING, SEQ_BASE, SEQ_STEP, SPENDING

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

_VIEWS: dict[str, tuple[list[str], str]] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a query and, where SQL can say it, its check over the named views."""
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            CHECKS[name] = with_views(views.split(), sql)
        return f
    return add


def view(name: str, sql: str, uses: str = "") -> None:
    """Define a shared SQL view."""
    _VIEWS[name] = (uses.split(), sql)


def with_views(names: list[str], sql: str) -> str:
    """Prefix a statement with the views it needs, in order."""
    order: list[str] = []

    def need(n: str) -> None:
        if n not in order:
            for u in _VIEWS[n][0]:
                need(u)
            order.append(n)

    for n in names:
        need(n)
    if not order:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({_VIEWS[n][1]})" for n in order) + "\n" + sql


def seq(kind: str, key: str) -> str:
    """Import position in SQL."""
    return f"{SEQ_BASE[kind] * SEQ_STEP} + {key}"


FILE = "concat('/data/ledger_', CAST(year(o_orderdate) AS varchar), '.dir')"
FEED = "concat('/data/feed_', CAST(CAST(ts AS date) AS varchar), '.dir')"

# ---- line item ledger ----------------------------------------------------------------

view("txn", f"""SELECT o_orderkey AS seq, CAST(o_orderkey AS varchar) AS external_id, CAST(o_orderdate AS date) AS date,
    CASE o_orderstatus WHEN 'F' THEN '*' ELSE '!' END AS flag,
    concat('Customer', CAST(o_custkey % 100 AS varchar)) AS payee, o_orderpriority AS narration,
    {FILE} AS source_file, o_orderkey AS source_line FROM orders""")

view("line", """SELECT l.*, CAST(o_orderdate AS date) AS date, CAST(l_orderkey AS varchar) AS external_id,
    CASE l_linestatus WHEN 'F' THEN 'USD' ELSE 'INR' END AS currency,
    CAST(CASE WHEN l_partkey % 8 = 7 THEN -l_extendedprice ELSE l_extendedprice END AS decimal(19,2)) AS amt
    FROM lineitem l JOIN orders ON l_orderkey = o_orderkey""")

view("p", f"""SELECT *, CASE WHEN cost_amount IS NOT NULL THEN 'USD' END AS cost_currency,
    CASE WHEN price_amount IS NOT NULL THEN 'EUR' END AS price_currency, split_part(account, ':', 1) AS type
  FROM (
    SELECT external_id, date, 1 AS leg, {SPENDING.format(key='l_partkey')} AS account, CAST(amt AS decimal(19,4)) AS amount,
      CAST(amt AS varchar) AS amount_text, currency,
      CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS decimal(19,4)) END AS cost_amount,
      CASE WHEN l_returnflag = 'A' AND l_discount <> 0 THEN CAST(l_discount AS decimal(19,4)) END AS price_amount,
      l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate FROM line
    UNION ALL
    SELECT external_id, date, 2, {FUNDING.format(key='l_suppkey')}, CAST(-amt AS decimal(19,4)), CAST(-amt AS varchar), currency,
      NULL, NULL, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate FROM line)""", "line")

view("tag_row", """SELECT CAST(o_orderkey AS varchar) AS external_id, lower(c_mktsegment) AS tag
      FROM orders JOIN customer ON c_custkey = o_custkey
    UNION SELECT CAST(o_orderkey AS varchar), concat('prio', substr(o_orderpriority, 1, 1)) FROM orders""")

view("link_row", """SELECT CAST(o_orderkey AS varchar) AS external_id, concat('inv-', CAST(o_custkey % 50 AS varchar)) AS link
    FROM orders WHERE o_orderstatus <> 'P'""")

view("bal", f"""SELECT {seq('balance', 'o_orderkey')} AS seq, CAST(o_orderdate AS date) AS date,
    CASE o_custkey % 3 WHEN 0 THEN 'Assets:BankA' WHEN 1 THEN 'Assets' ELSE 'Assets:BankB:Savings' END AS account,
    CAST(o_totalprice AS decimal(19,4)) AS amount, 'USD' AS currency, {FILE} AS source_file, o_orderkey AS source_line
    FROM orders WHERE o_orderstatus = 'P'""")

view("px", f"""SELECT {seq('price', 'event_id')} AS seq, CAST(ts AS date) AS date,
    concat('C', CAST(user_id % 10 AS varchar)) AS commodity, CAST(value AS decimal(19,4)) AS price_amount,
    'USD' AS price_currency, {FEED} AS source_file, event_id AS source_line FROM events WHERE event_type = 'view'""")

view("ev", f"""SELECT {seq('event', 'event_id')} AS seq, CAST(ts AS date) AS date, 'signup' AS name,
    concat('user-', CAST(user_id AS varchar)) AS value, {FEED} AS source_file, event_id AS source_line
    FROM events WHERE event_type = 'signup'""")

view("doc", f"""SELECT {seq('document', 'page_id')} AS seq, DATE '2024-01-01' + CAST(page_id % 365 AS integer) AS date,
    concat('Assets:Cust:C', CAST(page_id AS varchar)) AS account, url AS file_path, '/data/documents.dir' AS source_file,
    page_id AS source_line FROM pages""")

view("hold", """SELECT event_id, concat('C', CAST(user_id % 10 AS varchar)) AS commodity, CAST(ts AS date) AS date,
    CAST(value AS decimal(19,4)) AS quantity FROM events WHERE event_type = 'purchase'""")

view("hashed", """SELECT event_id, event_type, sha256(concat(CAST(CAST(ts AS date) AS varchar), '|user-', CAST(user_id AS varchar),
    '|', event_type, '|1 CNT|Assets:Cash')) AS base FROM events""")

# ---- directive ledger ----------------------------------------------------------------

view("dt", f"""SELECT *, CAST(total - fee AS decimal(19,2)) AS rest FROM (
  SELECT *, CAST(total * CAST(0.25 AS decimal(3,2)) AS decimal(19,2)) AS fee FROM (
    SELECT {seq('transaction', 'o_orderkey')} AS seq, CAST(o_orderdate AS date) AS date, o_orderkey AS okey, o_custkey AS cust,
      o_orderstatus AS status, o_orderpriority AS priority,
      CASE o_orderstatus WHEN 'F' THEN '*' ELSE '!' END AS flag,
      CASE WHEN o_orderstatus <> 'P' THEN concat('Customer', CAST(o_custkey % 100 AS varchar)) END AS payee,
      CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END AS narration,
      {FILE} AS source_file, o_orderkey AS source_line,
      CASE WHEN o_orderpriority = '1-URGENT' THEN concat('BANK-', CAST(o_custkey AS varchar)) END AS given_id,
      CASE WHEN o_orderstatus = 'F' THEN 'Liabilities:BankA:CreditCard' END AS source_account,
      CASE o_custkey % 2 WHEN 0 THEN 'USD' ELSE 'INR' END AS cur,
      CAST(CASE WHEN o_custkey % 8 = 7 THEN -o_totalprice ELSE o_totalprice END AS decimal(19,2)) AS total
    FROM orders))""")

view("dp", f"""SELECT seq, 0 AS posting_idx, {SPENDING.format(key='cust')} AS account, CAST(total AS decimal(19,4)) AS amount,
    CAST(total AS varchar) AS number_text, cur AS currency,
    CASE WHEN status = 'F' THEN CAST(1 + cust % 5 AS decimal(19,4)) END AS cost_amount,
    CASE WHEN status = 'F' THEN 'USD' END AS cost_currency,
    CASE WHEN status = 'O' THEN CAST(cust % 4 AS decimal(19,4)) END AS price_number,
    CASE WHEN status = 'O' THEN 'EUR' END AS price_unit, CAST(cust AS varchar) AS customer
    FROM dt WHERE status <> 'P'
  UNION ALL SELECT seq, 1, {FUNDING.format(key='okey')}, CAST(-rest AS decimal(19,4)), CAST(-rest AS varchar), cur,
    NULL, NULL, NULL, NULL, NULL FROM dt WHERE status <> 'P'
  UNION ALL SELECT seq, 2, 'Liabilities:BankA:CreditCard', CAST(-fee AS decimal(19,4)), CAST(-fee AS varchar), cur,
    NULL, NULL, NULL, NULL, NULL FROM dt WHERE status <> 'P'
  UNION ALL SELECT seq, 0, 'Assets:Pending', CAST(0 AS decimal(19,4)), '0.00', 'CHF',
    NULL, NULL, CAST(0 AS decimal(19,4)), 'EUR', NULL FROM dt WHERE status = 'P' AND priority <> '5-LOW'""", "dt")

view("pick", """SELECT * FROM (
    SELECT dp.seq, dp.account, CASE WHEN amount = 0 THEN '0 USD' ELSE concat(number_text, ' ', currency) END AS amount_text,
      row_number() OVER (PARTITION BY dp.seq ORDER BY
        CASE WHEN account = source_account AND amount <> 0 THEN 0
             WHEN account LIKE 'Assets:%' OR account LIKE 'Liabilities:%' THEN 1
             WHEN account LIKE 'Income:%' THEN 2 ELSE 3 END, posting_idx) AS r
    FROM dp JOIN dt ON dt.seq = dp.seq) WHERE r = 1""", "dt dp")

view("hash_in", """SELECT dt.*, pick.account IS NULL AS unknown, coalesce(pick.account, 'Unknown') AS id_account,
      coalesce(pick.amount_text, '0 USD') AS id_amount,
      concat(CAST(date AS varchar), '|', coalesce(payee, ''), '|', coalesce(narration, ''), '|',
             coalesce(pick.amount_text, '0 USD'), '|', coalesce(pick.account, 'Unknown')) AS hash_input
    FROM dt LEFT JOIN pick ON pick.seq = dt.seq""", "dt pick")

view("ids", """SELECT *, coalesce(given_id, CASE WHEN n > 1 THEN concat(content_hash, '-', CAST(n AS varchar)) ELSE content_hash END) AS external_id
    FROM (SELECT *, sha256(hash_input) AS content_hash,
            row_number() OVER (PARTITION BY given_id IS NULL, sha256(hash_input) ORDER BY seq) AS n FROM hash_in)""", "hash_in")

# what a load into an empty ledger keeps
view("kept", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY external_id ORDER BY seq) AS nth FROM ids) WHERE nth = 1", "ids")

# what is left when a load of the cleared transactions came first
view("kept_cleared_first", """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY external_id ORDER BY CASE flag WHEN '*' THEN 0 ELSE 1 END, seq) AS nth
    FROM ids) WHERE nth = 1""", "ids")
# what a load adds when the cleared transactions are stored
view("fresh", "SELECT * FROM kept WHERE flag <> '*'", "kept")

view("oc", f"""SELECT concat('Assets:Cust:C', CAST(o_custkey AS varchar)) AS account, CAST(o_orderdate AS date) AS date,
    {seq('open', 'o_orderkey')} AS seq, CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'close' END AS kind,
    o_orderpriority AS branch, {FILE} AS source_file, o_orderkey AS source_line
    FROM orders WHERE o_orderstatus IN ('O', 'F')""")

view("acct", """SELECT coalesce(o.account, u.account) AS name,
      CASE WHEN c.close_seq > o.open_seq THEN 'closed' ELSE 'open' END AS status, o.open_date,
      CASE WHEN c.close_seq > o.open_seq THEN c.close_date END AS close_date, o.branch
    FROM (SELECT account, min(seq) AS open_seq, arg_min(date, seq) AS open_date, arg_min(branch, seq) AS branch
          FROM oc WHERE kind = 'open' GROUP BY account) o
    FULL JOIN (SELECT account FROM dp UNION SELECT account FROM bal UNION SELECT account FROM doc) u ON u.account = o.account
    LEFT JOIN (SELECT account, max(seq) AS close_seq, arg_max(date, seq) AS close_date
               FROM oc WHERE kind = 'close' GROUP BY account) c ON c.account = o.account""", "oc dp bal doc")

view("commodity", """SELECT name, arg_min(metadata, seq) FILTER (WHERE seq IS NOT NULL) AS metadata FROM (
      SELECT p_brand AS name, concat('{"name":"', p_name, '","type":"', p_type, '"}') AS metadata, p_partkey AS seq FROM part
      UNION ALL SELECT currency, NULL, NULL FROM dp UNION ALL SELECT cost_currency, NULL, NULL FROM dp
      UNION ALL SELECT price_unit, NULL, NULL FROM dp UNION ALL SELECT currency, NULL, NULL FROM bal
      UNION ALL SELECT commodity, NULL, NULL FROM px UNION ALL SELECT price_currency, NULL, NULL FROM px)
    WHERE name IS NOT NULL GROUP BY name""", "dp bal px")

view("cid", """SELECT name, row_number() OVER (ORDER BY md5(name), name) AS id FROM (
    SELECT currency AS name FROM p UNION SELECT cost_currency FROM p UNION SELECT price_currency FROM p) WHERE name IS NOT NULL""", "p")

TOTAL = "DECIMAL(38,4)"
VALUE = "DECIMAL(38,8)"
