"""The given tables read as a ledger.

`directives` turns every row into at most one directive with its postings in the row:
no join, no grouping. `flat_ledger` is a second, larger ledger: two postings per line
item, dated by their order."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.accounts import account_type
from daybook.schema import DIRECTIVE
from daybook.sources.directives import read_directives
from daybook.sources.workspace import PACKED, Workspace, new_folder

# Directives of one kind share a range of import positions (fixed values).
SEQ_BASE = {"commodity": 0, "open": 1, "close": 1, "transaction": 2, "balance": 3, "price": 4, "event": 5,
            "document": 6, "note": 7}
SEQ_STEP = 10 ** 15
WRITERS = 6

SPENDING = """CASE {key} % 8 WHEN 0 THEN 'Expenses:Car:Lease' WHEN 1 THEN 'Expenses:Car:Fuel'
  WHEN 2 THEN 'Expenses:Groceries' WHEN 3 THEN 'Expenses:EatingOut' WHEN 4 THEN 'Expenses:HouseRent'
  WHEN 5 THEN 'Expenses:Travel:Air' WHEN 6 THEN 'Equity:Taxes:Federal' ELSE 'Income:Salary:Net' END"""
FUNDING = """CASE {key} % 3 WHEN 0 THEN 'Assets:BankA:Checking' WHEN 1 THEN 'Assets:BankB:Savings'
  ELSE 'Liabilities:BankA:CreditCard' END"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One given table."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _directives(df: DataFrame, **fields: str) -> DataFrame:
    """Project rows to the directive schema; unnamed fields are null."""
    return df.select(*[F.expr(fields.get(f.name, "NULL")).cast(f.dataType).alias(f.name) for f in DIRECTIVE.fields])


def _seq(kind: str, key: str) -> str:
    return f"{SEQ_BASE[kind] * SEQ_STEP} + {key}"


_FILE = "concat('/data/ledger_', CAST(year(o_orderdate) AS string), '.dir')"
_FEED = "concat('/data/feed_', CAST(CAST(ts AS date) AS string), '.dir')"


def _leg(account, number, currency, cost="NULL", price="NULL", meta="NULL") -> str:
    return f"""named_struct('account', {account}, 'number', CAST({number} AS decimal(19,4)),
      'number_text', CAST({number} AS string), 'currency', {currency},
      'cost_number', CAST({cost} AS decimal(19,4)), 'cost_currency', IF({cost} IS NULL, NULL, 'USD'),
      'price_number', CAST({price} AS decimal(19,4)), 'price_currency', IF({price} IS NULL, NULL, 'EUR'),
      'flag', CAST(NULL AS string), 'meta', CAST({meta} AS map<string,string>))"""


def transaction_directives(spark: SparkSession, sf: str) -> DataFrame:
    """One transaction per order. Pending orders post a single zero amount, those of low priority nothing."""
    orders = (table(spark, sf, "orders")
              .withColumn("total", F.expr("CAST(CASE WHEN o_custkey % 8 = 7 THEN -o_totalprice ELSE o_totalprice END AS decimal(19,2))"))
              .withColumn("fee", F.expr("CAST(total * CAST(0.25 AS decimal(3,2)) AS decimal(19,2))"))
              .withColumn("rest", F.expr("CAST(total - fee AS decimal(19,2))"))
              .withColumn("cur", F.expr("CASE o_custkey % 2 WHEN 0 THEN 'USD' ELSE 'INR' END")))
    first = _leg(SPENDING.format(key="o_custkey"), "total", "cur",
                 cost="CASE WHEN o_orderstatus = 'F' THEN 1 + o_custkey % 5 END",
                 price="CASE WHEN o_orderstatus = 'O' THEN o_custkey % 4 END",
                 meta="map('customer', CAST(o_custkey AS string), 'lineno', '1')")
    legs = [first, _leg(FUNDING.format(key="o_orderkey"), "CAST(-rest AS decimal(19,2))", "cur"),
            _leg("'Liabilities:BankA:CreditCard'", "CAST(-fee AS decimal(19,2))", "cur")]
    zero = _leg("'Assets:Pending'", "CAST(0 AS decimal(19,2))", "'CHF'", price="0")
    return _directives(
        orders, seq=_seq("transaction", "o_orderkey"), kind="'transaction'", date="CAST(o_orderdate AS date)",
        source_file=_FILE, source_line="o_orderkey",
        flag="CASE o_orderstatus WHEN 'F' THEN '*' ELSE '!' END",
        payee="CASE WHEN o_orderstatus <> 'P' THEN concat('Customer', CAST(o_custkey % 100 AS string)) END",
        narration="CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END",
        tags="array(concat('prio', substr(o_orderpriority, 1, 1)), concat('group', CAST(o_custkey % 20 AS string)), "
             "concat('prio', substr(o_orderpriority, 1, 1)))",
        links="CASE WHEN o_orderstatus <> 'P' THEN array(concat('inv-', CAST(o_custkey % 50 AS string))) END",
        meta=f"""map_filter(map('filename', {_FILE}, 'lineno', CAST(o_orderkey AS string), 'status', o_orderstatus,
          'transaction_id', CASE WHEN o_orderpriority = '1-URGENT' THEN concat('BANK-', CAST(o_custkey AS string)) END,
          'source_account', CASE WHEN o_orderstatus = 'F' THEN 'Liabilities:BankA:CreditCard' END),
          (k, v) -> v IS NOT NULL)""",
        postings=f"""CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN slice(array({zero}), 1, 0)
          WHEN o_orderstatus = 'P' THEN array({zero}) ELSE array({', '.join(legs)}) END""")


def lifecycle_directives(spark: SparkSession, sf: str) -> DataFrame:
    """Open and close of an account per customer, from open and finished orders."""
    orders = table(spark, sf, "orders").filter("o_orderstatus IN ('O', 'F')")
    return _directives(
        orders, seq=_seq("open", "o_orderkey"), kind="CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'close' END",
        date="CAST(o_orderdate AS date)", source_file=_FILE, source_line="o_orderkey",
        account="concat('Assets:Cust:C', CAST(o_custkey AS string))",
        meta="map('branch', o_orderpriority, 'lineno', '0')")


def balance_directives(spark: SparkSession, sf: str) -> DataFrame:
    """A balance assertion per pending order."""
    orders = table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    return _directives(
        orders, seq=_seq("balance", "o_orderkey"), kind="'balance'", date="CAST(o_orderdate AS date)",
        source_file=_FILE, source_line="o_orderkey",
        account="CASE o_custkey % 3 WHEN 0 THEN 'Assets:BankA' WHEN 1 THEN 'Assets' ELSE 'Assets:BankB:Savings' END",
        number="CAST(o_totalprice AS decimal(19,4))", number_currency="'USD'")


def feed_directives(spark: SparkSession, sf: str) -> DataFrame:
    """Prices from views, ledger events from signups, ignored notes from errors."""
    events = table(spark, sf, "events").filter("event_type IN ('view', 'signup', 'error')")
    seqs = " ".join(f"WHEN '{e}' THEN {SEQ_BASE[k] * SEQ_STEP}" for e, k in
                    [("view", "price"), ("signup", "event"), ("error", "note")])
    price, event = "event_type = 'view'", "event_type = 'signup'"
    return _directives(
        events, seq=f"CASE event_type {seqs} END + event_id",
        kind="CASE event_type WHEN 'view' THEN 'price' WHEN 'signup' THEN 'event' ELSE 'note' END",
        date="CAST(ts AS date)", source_file=_FEED, source_line="event_id",
        currency=f"CASE WHEN {price} THEN concat('C', CAST(user_id % 10 AS string)) END",
        number=f"CASE WHEN {price} THEN CAST(value AS decimal(19,4)) END",
        number_currency=f"CASE WHEN {price} THEN 'USD' END",
        event_type=f"CASE WHEN {event} THEN 'signup' END",
        description=f"CASE WHEN {event} THEN concat('user-', CAST(user_id AS string)) END")


def other_directives(spark: SparkSession, sf: str) -> DataFrame:
    """Commodities from part brands and documents from pages."""
    parts = _directives(
        table(spark, sf, "part"), seq=_seq("commodity", "p_partkey"), kind="'commodity'", date="DATE '1995-01-01'",
        source_file="'/data/commodities.dir'", source_line="p_partkey", currency="p_brand",
        meta="map('type', p_type, 'name', p_name, 'filename', 'x')")
    pages = _directives(
        table(spark, sf, "pages"), seq=_seq("document", "page_id"), kind="'document'",
        date="date_add(DATE '2024-01-01', CAST(page_id % 365 AS int))", source_file="'/data/documents.dir'",
        source_line="page_id", account="concat('Assets:Cust:C', CAST(page_id AS string))", filename="url")
    return parts.unionByName(pages)


PARTS = {transaction_directives: ["transaction"], lifecycle_directives: ["open", "close"], balance_directives: ["balance"],
         feed_directives: ["price", "event", "note"], other_directives: ["commodity", "document"]}


def directive_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All directives together, straight from the given tables."""
    return reduce(DataFrame.unionByName, [p(spark, sf) for p in PARTS])


_written: dict[tuple[str, str], str] = {}


def directives(spark: SparkSession, sf: str) -> DataFrame:
    """All directives, read from the directive files a session writes once per data folder.

    The ledger's input are files; this is the step that makes them, with a folder per kind. Each is written by itself as
    the rows come: one write of all kinds would sort whole nested rows by their kind in every task."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _written:
        path = new_folder(spark, "directives")
        kinds = {k: part(spark, sf) for part, names in PARTS.items() for k in names}
        with ThreadPoolExecutor(max_workers=WRITERS) as pool:
            jobs = [pool.submit(df.filter(F.col("kind") == k).drop("kind").write.options(**PACKED).parquet, f"{path}/kind={k}") for k, df in kinds.items()]
            for job in jobs:
                job.result()
        _written[key] = path
    return read_directives(spark, _written[key], "parquet")


def order_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """One transaction per order, with the order's key as id."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS seq", "CAST(o_orderkey AS string) AS external_id", "CAST(o_orderdate AS date) AS date",
        "CASE o_orderstatus WHEN 'F' THEN '*' ELSE '!' END AS flag",
        "concat('Customer', CAST(o_custkey % 100 AS string)) AS payee", "o_orderpriority AS narration",
        f"{_FILE} AS source_file", "o_orderkey AS source_line")


def _legs(lines: DataFrame) -> DataFrame:
    """Line items with their two legs as p."""
    leg = lambda i, account, sign, cost, price: f"""named_struct('leg', {i}, 'account', {account},
      'amt', CAST(CASE WHEN l_partkey % 8 = 7 THEN {'-' if sign > 0 else ''}l_extendedprice
                  ELSE {'' if sign > 0 else '-'}l_extendedprice END AS decimal(19,2)),
      'cost_amount', CAST({cost} AS decimal(19,4)), 'price_amount', CAST({price} AS decimal(19,4)))"""
    legs = [leg(1, SPENDING.format(key="l_partkey"), 1, "CASE WHEN l_returnflag = 'R' THEN l_quantity END",
                "CASE WHEN l_returnflag = 'A' AND l_discount <> 0 THEN l_discount END"),
            leg(2, FUNDING.format(key="l_suppkey"), -1, "NULL", "NULL")]
    return lines.withColumn("p", F.explode(F.expr(f"array({', '.join(legs)})")))


def line_names(spark: SparkSession, sf: str) -> DataFrame:
    """Account and currencies of every posting; no join is needed for names."""
    return _legs(table(spark, sf, "lineitem")).selectExpr(
        "p.account", "CASE l_linestatus WHEN 'F' THEN 'USD' ELSE 'INR' END AS currency",
        "CASE WHEN p.cost_amount IS NOT NULL THEN 'USD' END AS cost_currency",
        "CASE WHEN p.price_amount IS NOT NULL THEN 'EUR' END AS price_currency")


def line_postings(spark: SparkSession, sf: str) -> DataFrame:
    """Two postings per line item, dated by the order; orders and line items meet in one join."""
    dates = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    return (_legs(table(spark, sf, "lineitem").join(dates, F.col("l_orderkey") == F.col("o_orderkey")))
            .selectExpr("CAST(l_orderkey AS string) AS external_id", "date", "CAST(NULL AS string) AS flag", "p.account",
                        "CAST(p.amt AS decimal(19,4)) AS amount", "CAST(p.amt AS string) AS amount_text",
                        "CASE l_linestatus WHEN 'F' THEN 'USD' ELSE 'INR' END AS currency", "p.cost_amount",
                        "CASE WHEN p.cost_amount IS NOT NULL THEN 'USD' END AS cost_currency", "p.price_amount",
                        "CASE WHEN p.price_amount IS NOT NULL THEN 'EUR' END AS price_currency",
                        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "p.leg"))


# What orders the postings of one order.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "leg"]


def tag_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Market segment and priority of each order as tags."""
    orders = table(spark, sf, "orders")
    customers = table(spark, sf, "customer").select("c_custkey", F.lower("c_mktsegment").alias("segment"))
    both = F.array("segment", F.concat(F.lit("prio"), F.substring("o_orderpriority", 1, 1)))
    return (orders.join(customers, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select(F.col("o_orderkey").cast("string").alias("external_id"),
                    F.explode(F.array_compact(F.array_distinct(both))).alias("tag")))


def link_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Invoice group of each order that is not pending as a link."""
    return table(spark, sf, "orders").filter("o_orderstatus <> 'P'").selectExpr(
        "CAST(o_orderkey AS string) AS external_id", "concat('inv-', CAST(o_custkey % 50 AS string)) AS link")


class _OnDemand(dict):
    """Table frames that are planned when first asked for."""

    def __init__(self, makers):
        super().__init__()
        self._makers = makers

    def __missing__(self, table):
        self[table] = self._makers[table]()
        return self[table]


def flat_ledger(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The line item ledger as table frames."""
    work = Workspace(spark, "registries")       # each registry is worked out once, however often it is joined
    return _OnDemand({
        "transactions": lambda: order_transactions(spark, sf),
        "postings": lambda: line_postings(spark, sf),
        "accounts": lambda: work.stage(line_names(spark, sf).select("account").distinct().select(
            F.col("account").alias("name"), account_type("account").alias("type"), F.lit("open").alias("status")), "accounts"),
        "commodities": lambda: work.stage(line_names(spark, sf).select(
            F.explode(F.array("currency", "cost_currency", "price_currency")).alias("name"))
            .filter("name IS NOT NULL").distinct(), "commodities"),
        "transaction_tags": lambda: tag_pairs(spark, sf),
        "transaction_links": lambda: link_pairs(spark, sf),
        "balance_assertions": lambda: balance_directives(spark, sf).selectExpr(
            "date", "account", "number AS amount", "number_currency AS currency", "source_file", "source_line"),
    })


def holdings(spark: SparkSession, sf: str) -> DataFrame:
    """Bought quantities per commodity, from purchases."""
    return table(spark, sf, "events").filter("event_type = 'purchase'").selectExpr(
        "event_id", "concat('C', CAST(user_id % 10 AS string)) AS commodity", "CAST(ts AS date) AS date",
        "CAST(value AS decimal(19,4)) AS quantity")


def hashed_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as cash transactions of one unit: many equal ones, for collision numbering."""
    from daybook.functions.identity import external_id_base
    return (table(spark, sf, "events")
            .withColumn("payee", F.concat(F.lit("user-"), F.col("user_id").cast("string")))
            .select("event_id", "event_type",
                    external_id_base(F.col("ts").cast("date"), "payee", "event_type", F.lit("1 CNT"),
                                     F.lit("Assets:Cash")).alias("base")))


def bank_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Events as bank rows; some carry blank ids, bad dates or bad amounts."""
    k = "CAST(get_json_object(props, '$.k') AS int) % 10"
    iso = "CAST(CAST(ts AS date) AS string)"
    value = "CAST(CAST(value AS decimal(19,2)) AS string)"
    leg = lambda account, sign: f"""named_struct('account', {account},
      'number', CAST({sign}value AS decimal(19,4)),
      'number_text', concat(CASE WHEN '{sign}' = '-' THEN '-' ELSE '' END, {value}), 'currency', 'USD')"""
    return table(spark, sf, "events").selectExpr(
        "event_id AS seq",
        f"CASE {k} WHEN 0 THEN '  ' WHEN 1 THEN concat(substr({iso}, 1, 5), '13', substr({iso}, 8)) ELSE {iso} END AS date_text",
        f"CASE {k} WHEN 2 THEN ' ' ELSE concat('user-', CAST(user_id AS string)) END AS payee",
        f"CASE {k} WHEN 2 THEN '' ELSE event_type END AS narration",
        f"CASE {k} WHEN 3 THEN '' WHEN 4 THEN 'n/a USD' WHEN 5 THEN '1_000.5e3 USD' ELSE concat({value}, ' USD') END AS amount",
        f"CASE {k} WHEN 6 THEN ' \\t' ELSE 'Assets:Cash' END AS account",
        "'Assets:Cash' AS source_account",
        f"CASE {k} WHEN 7 THEN ' \\n ' WHEN 8 THEN NULL ELSE concat('  ', CAST(event_id AS string), '\\t') END AS ofx_id",
        f"array({leg(chr(39) + 'Expenses:Misc' + chr(39), '')}, {leg(chr(39) + 'Assets:Cash' + chr(39), '-')}) AS postings")
