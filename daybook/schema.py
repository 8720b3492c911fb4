"""Fixed schemas: the directive input and the fifteen ledger tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(19, 4)
TOTAL = "decimal(38,4)"      # type of every summed amount
VALUE = "decimal(38,8)"      # type of every summed amount x unit price

# Directive kinds the ledger knows; any other kind is ignored (fixed values).
KINDS = ["commodity", "open", "close", "transaction", "balance", "price", "event", "document"]

# Metadata keys that are never stored as metadata (fixed values).
RESERVED_META = ["filename", "lineno", "transaction_id"]

_META = T.MapType(T.StringType(), T.StringType())

POSTING = T.StructType([
    T.StructField("account", T.StringType()),
    T.StructField("number", MONEY),
    T.StructField("number_text", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("cost_number", MONEY),
    T.StructField("cost_currency", T.StringType()),
    T.StructField("price_number", MONEY),
    T.StructField("price_currency", T.StringType()),
    T.StructField("flag", T.StringType()),
    T.StructField("meta", _META),
])

DIRECTIVE = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("source_line", T.LongType()),
    T.StructField("account", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("number", MONEY),
    T.StructField("number_currency", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("flag", T.StringType()),
    T.StructField("payee", T.StringType()),
    T.StructField("narration", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("links", T.ArrayType(T.StringType())),
    T.StructField("meta", _META),
    T.StructField("postings", T.ArrayType(POSTING)),
])

# Column lists of the ledger tables. `postings.date` repeats the transaction's
# date so that every dated fact is partitioned by year and period queries prune
# partitions instead of joining the two largest tables.
TABLES = {
    "commodities": "name string, metadata string, created_at timestamp",
    "accounts": "name string, type string, status string, open_date date, close_date date, metadata string, "
                "created_at timestamp",
    "transactions": "external_id string, date date, flag string, payee string, narration string, "
                    "source_file string, source_line bigint, content_hash string, "
                    "created_at timestamp, updated_at timestamp",
    "postings": "external_id string, posting_idx int, date date, flag string, account string, "
                "amount decimal(19,4), currency string, cost_amount decimal(19,4), cost_currency string, "
                "price_amount decimal(19,4), price_currency string, created_at timestamp",
    "posting_metadata": "external_id string, posting_idx int, key string, value string",
    "transaction_metadata": "external_id string, key string, value string",
    "tags": "name string",
    "links": "name string",
    "transaction_tags": "external_id string, tag string",
    "transaction_links": "external_id string, link string",
    "balance_assertions": "date date, account string, amount decimal(19,4), currency string, "
                          "source_file string, source_line bigint",
    # seq: the import position, which orders the quotes of a day
    "prices": "date date, commodity string, price_amount decimal(19,4), price_currency string, "
              "source_file string, source_line bigint, seq bigint",
    "ledger_events": "date date, name string, value string, source_file string, source_line bigint",
    "ledger_documents": "date date, account string, file_path string, source_file string, source_line bigint",
    "import_state": "id int, last_successful_hash string, updated_at timestamp",
}

# Facts partitioned by year(date).
DATED = ["transactions", "postings", "balance_assertions", "prices", "ledger_events", "ledger_documents"]

# Facts that carry file and line of their directive and no id of their own.
SOURCED = ["balance_assertions", "prices", "ledger_events", "ledger_documents"]

# Tables whose rows belong to a transaction.
CHILDREN = ["postings", "posting_metadata", "transaction_metadata", "transaction_tags", "transaction_links"]

# What a directive of each kind must have to be stored (fixed values, after NOT_NULL below).
REQUIRED = {
    "commodity": ["currency"],
    "open": ["date", "account"],
    "close": ["date", "account"],
    "transaction": ["date"],
    "balance": ["date", "account", "number", "number_currency"],
    "price": ["date", "currency", "number", "number_currency"],
    "event": ["date", "event_type", "description"],
    "document": ["date", "account", "filename"],
}

# Required columns, unique keys and references, checked by the quality operators (fixed values).
NOT_NULL = {
    "commodities": ["name"],
    "accounts": ["name", "type", "status"],
    "transactions": ["external_id", "date", "flag", "narration"],
    "postings": ["external_id", "account", "amount", "currency"],
    "posting_metadata": ["external_id", "posting_idx", "key", "value"],
    "transaction_metadata": ["external_id", "key", "value"],
    "tags": ["name"],
    "links": ["name"],
    "transaction_tags": ["external_id", "tag"],
    "transaction_links": ["external_id", "link"],
    "balance_assertions": ["date", "account", "amount", "currency"],
    "prices": ["date", "commodity", "price_amount", "price_currency"],
    "ledger_events": ["date", "name", "value"],
    "ledger_documents": ["date", "account", "file_path"],
    "import_state": ["id", "last_successful_hash"],
}
# Longest allowed text per table and column (fixed values).
MAX_LENGTH = {
    "commodities": {"name": 50},
    "accounts": {"type": 50, "status": 20},
    "transactions": {"flag": 20},
    "postings": {"flag": 20},
}
UNIQUE = {
    "commodities": ["name"],
    "accounts": ["name"],
    "transactions": ["external_id"],
    "postings": ["external_id", "posting_idx"],
    "posting_metadata": ["external_id", "posting_idx", "key"],
    "transaction_metadata": ["external_id", "key"],
    "tags": ["name"],
    "links": ["name"],
    "transaction_tags": ["external_id", "tag"],
    "transaction_links": ["external_id", "link"],
    "import_state": ["id"],
}
# child table, child column, parent table, parent column
FOREIGN = [
    ("postings", "external_id", "transactions", "external_id"),
    ("postings", "account", "accounts", "name"),
    ("postings", "currency", "commodities", "name"),
    ("postings", "cost_currency", "commodities", "name"),
    ("postings", "price_currency", "commodities", "name"),
    ("posting_metadata", "external_id", "transactions", "external_id"),
    ("transaction_metadata", "external_id", "transactions", "external_id"),
    ("transaction_tags", "external_id", "transactions", "external_id"),
    ("transaction_tags", "tag", "tags", "name"),
    ("transaction_links", "external_id", "transactions", "external_id"),
    ("transaction_links", "link", "links", "name"),
    ("balance_assertions", "account", "accounts", "name"),
    ("balance_assertions", "currency", "commodities", "name"),
    ("prices", "commodity", "commodities", "name"),
    ("prices", "price_currency", "commodities", "name"),
    ("ledger_documents", "account", "accounts", "name"),
]
