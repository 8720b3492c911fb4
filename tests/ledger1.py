"""A tiny ledger with hand-computed results."""

import datetime as dt
import hashlib
from collections import Counter, defaultdict
from decimal import Decimal

from daybook.schema import DIRECTIVE

H1 = "34d8c3cf7c3e8ba847b5cf850dd8fa169bb62cd5ade9b04310e214ac37e68a59"
H3 = "55053837742746822edb9fe9ab3c3ad23e77f12d8e11e7a095d273f25a96e884"
H4 = "e16ea628274cba11773ceacdda118ed75be0c5f748c4ff43a0b345dc32bf37ff"
H6 = "b737a687d07588c4cd0c5cab339615275c303f978858fa2bb70fa1026c4fef00"
H6B = "7bbc4a51e7acfd25cd7ce63dfce8cd0ce602b2bf0057fdd538216c6c6ef439b7"
H7 = "1776f1bad397d423045497b4f4d681a0bc46c90a16d16113ab6b1c6bd8381c32"
EMPTY_STATE = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def fingerprint(hashes):
    """The state of a multiset of hashes, in plain Python."""
    sha, groups, tops = lambda t: hashlib.sha256(t.encode()).hexdigest(), defaultdict(list), defaultdict(list)
    for h, n in Counter(hashes).items():
        groups[hashlib.md5(h.encode()).hexdigest()[:6]].append(f"{h}:{n}")
    for k, hs in groups.items():
        tops[k[:3]].append(f"{k}:{sha(''.join(sorted(hs)))}")
    return sha("".join(sorted(f"{k}:{sha(''.join(sorted(gs)))}" for k, gs in tops.items())))


STATE = fingerprint([H1, H1, H3, H4, H6, H7])


def day(text):
    return dt.date.fromisoformat(text)


def posting(account, number, currency, price=None, meta=None):
    return {"account": account, "number": None if number is None else Decimal(number), "number_text": number,
            "currency": currency, "price_number": None if price is None else Decimal(price[0]),
            "price_currency": None if price is None else price[1], "meta": meta}


def row(seq, kind, date, **fields):
    out = {f.name: None for f in DIRECTIVE.fields}
    out |= {"seq": seq, "kind": kind, "date": day(date),
            "source_file": "/data/a.ledger" if seq < 14 else "/data/b.ledger", "source_line": seq * 10}
    for k, v in fields.items():
        out[k] = Decimal(v) if k == "number" and v is not None else v
    if out["postings"]:
        blank = {f.name: None for f in DIRECTIVE["postings"].dataType.elementType.fields}
        out["postings"] = [blank | p for p in out["postings"]]
    return out


GROCERIES = [posting("Expenses:Groceries", "85.50", "USD"), posting("Liabilities:CreditCard", "-85.50", "USD")]
REFUND = [posting("Assets:Checking", "12.00", "USD"), posting("Income:Other", "-12.00", "USD")]
SALARY = [posting("Income:Salary:Net", "-1000.00", "USD"), posting("Assets:Savings", "400.00", "USD"),
          posting("Assets:Checking", "600.00", "USD", meta={"slip": "7", "lineno": "3"})]


def rows():
    t1 = dict(flag="*", payee="GROCERY STORE", narration="Weekly shopping", postings=GROCERIES, tags=["food", "food"],
              meta={"filename": "/data/a.ledger", "note": "x"})
    t4 = dict(flag="*", payee="ACME", narration="Refund", postings=REFUND, meta={"transaction_id": "BANK-1"})
    return [
        row(1, "commodity", "2023-01-01", currency="USD", meta={"filename": "f", "lineno": "1", "name": "US Dollar"}),
        row(2, "commodity", "2023-01-01", currency="EUR", meta={"name": "Euro"}),
        row(3, "close", "2023-12-31", account="Assets:Checking"),
        row(4, "open", "2024-01-01", account="Assets:Checking"),
        row(5, "close", "2024-12-31", account="Assets:Checking"),
        row(6, "open", "2025-01-01", account="Assets:Checking"),
        row(7, "close", "2024-12-31", account="Assets:Nowhere"),
        row(10, "transaction", "2024-01-15", **t1),
        row(11, "transaction", "2024-01-15", **t1),
        row(12, "transaction", "2024-02-01", flag="*", narration="", postings=[]),
        row(13, "transaction", "2024-02-10", **t4),
        row(14, "transaction", "2024-02-10", **t4),
        row(15, "transaction", "2024-03-01", flag="*", payee="ACME", narration="Salary", postings=SALARY,
            links=["pay-3", "pay-3"], meta={"source_account": "Assets:Checking"}),
        row(16, "transaction", "2024-03-02", flag="!", narration="Fee waiver",
            postings=[posting("Assets:Checking", "0.00", "CHF", ("0", "EUR"))]),
        row(17, "balance", "2024-03-01", account="Assets:Checking", number="12.00", number_currency="USD"),
        row(18, "balance", "2024-03-02", account="Assets", number="1012.00", number_currency="USD"),
        row(19, "balance", "2024-03-02", account="Assets:Checking", number="600.00", number_currency="USD"),
        row(20, "price", "2024-01-10", currency="EUR", number="1.10", number_currency="USD"),
        row(21, "event", "2024-04-01", event_type="location", description="Paris"),
        row(22, "document", "2024-04-02", account="Assets:Checking", filename="/docs/x.pdf"),
    ]


def bad_rows():
    return [row(23, "transaction", "2024-05-01", flag="*", narration="Broken",
                postings=[posting("Assets:Checking", None, "USD"), posting("Income:Other", "1.00", "USD")])]


def frame(spark, data=None):
    data = rows() if data is None else data
    return spark.createDataFrame([tuple(r[f.name] if f.name != "postings" or r["postings"] is None else
                                        [tuple(p.values()) for p in r["postings"]] for f in DIRECTIVE.fields)
                                  for r in data], DIRECTIVE)
