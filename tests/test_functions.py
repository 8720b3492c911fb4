import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.functions import accounts as AC
from daybook.functions import identity as I
from daybook.functions.metadata import meta_json, stored_meta


def values(spark, schema, data, column):
    return [r[0] for r in spark.createDataFrame(data, schema).select(column).collect()]


def test_clean_ofx_id(spark):
    got = values(spark, "x string", [("  20240115001234567890  ",), ("",), (" \t\n",), (None,), (" a b ",)],
                 I.clean_ofx_id("x"))
    assert got == ["20240115001234567890", None, None, None, "a b"]


def test_account_type_and_segments(spark):
    df = spark.createDataFrame([("Expenses:Food:Groceries",), ("Assets",)], "a string")
    assert [tuple(r) for r in df.select(AC.account_type("a"), AC.segment("a", 2)).collect()] == [
        ("Expenses", "Food"), ("Assets", "")]


def test_account_prefixes(spark):
    got = values(spark, "a string", [("Expenses:Car:Lease",)], AC.account_prefixes("a"))
    assert got == [["Expenses", "Expenses:Car", "Expenses:Car:Lease"]]


@pytest.mark.parametrize("name,pattern,hit", [
    ("Assets:BankA:Savings", "Assets:*:Savings", True), ("Assets:Savings", "Assets:*:Savings", False),
    ("Assets:A:B:Savings", "Assets:*:Savings", False), ("Income:Interest:BankA", "Income:Interest:*", True),
    ("Income:Interest:BankA:CD", "Income:Interest:*", True), ("Income:Interest", "Income:Interest:*", False),
    ("Income.Other", "Income:Other", False)])
def test_account_match(spark, name, pattern, hit):
    assert values(spark, "a string", [(name,)], AC.account_match("a", pattern)) == [hit]


def test_subtree_is_segment_safe(spark):
    df = [("Expenses:Car",), ("Expenses:Car:Lease",), ("Expenses:CarWash",)]
    assert values(spark, "a string", df, AC.under("a", "Expenses:Car")) == [True, True, False]
    assert values(spark, "a string", df, AC.spelled_like("a", "Expenses:Car")) == [True, True, True]
    assert values(spark, "a string", df, AC.category("a")) == ["Car", "Car", "Car"]


def test_category_and_basename(spark):
    df = [("Expenses:Food:Out",), ("Expenses:EatingOut",), ("Expenses:HouseRent",), ("Expenses:Pets:Cat",)]
    assert values(spark, "a string", df, AC.category("a")) == ["Food", "Food", "Housing", "Pets"]
    assert values(spark, "a string", [("/x/y.dir",), ("y.dir",)], AC.basename("a")) == ["y.dir", "y.dir"]


@pytest.mark.parametrize("date,payee,narration,amount,account,error", [
    ("2024-13-01", "p", "", "1", "A", "date is not a real YYYY-MM-DD date"),
    ("2024-02-30", "p", "", "1", "A", "date is not a real YYYY-MM-DD date"),
    ("24-02-03", "p", "", "1", "A", "date is not a real YYYY-MM-DD date"),
    ("2024-1-5", "p", "", "1", "A", None),
    (" ", "p", "", "1", "A", "date is blank"),
    ("2024-01-05", " ", None, "1", "A", "payee and narration are blank"),
    ("2024-01-05", None, "n", "-11.75 USD", "A", None),
    ("2024-01-05", "p", "", "abc USD", "A", "amount is not a number"),
    ("2024-01-05", "p", "", "1e5 USD", "A", None),
    ("2024-01-05", "p", "", ".5", "A", None),
    ("2024-01-05", "p", "", "-Infinity", "A", None),
    ("2024-01-05", "p", "", "\t5 USD", "A", None),
    ("2024-01-05", "p", "", "5\tUSD", "A", None),
    ("2024-01-05", "p", "", None, "A", "amount is blank"),
    ("2024-01-05", "p", "", "1", " \t", "account is blank")])
def test_strict_errors(spark, date, payee, narration, amount, account, error):
    df = spark.createDataFrame([(date, payee, narration, amount, account)], "d string, p string, n string, m string, a string")
    assert df.select(I.strict_errors("d", "p", "n", "m", "a")).collect()[0][0] == error


def test_hash_of_missing_fields_and_fallback(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 1), None, None, "", " A ", "r1"), (dt.date(2024, 2, 1), "p", "", "1", " ", "r2")],
                               "d date, p string, n string, m string, a string, r string")
    got = df.select(I.hash_input("d", "p", "n", "m", "a"), I.external_id_base("d", "p", "n", "m", "a", F.col("r"))).collect()
    assert got[0][0] == "2024-02-01|||0|A" and len(got[0][1]) == 64
    assert got[1][1].startswith("fallback_") and len(got[1][1]) == 17


def test_metadata(spark):
    df = spark.createDataFrame([({"filename": "f", "b": "1", "a": None},), ({"lineno": "1"},), (None,)], "m map<string,string>")
    assert [r[0] for r in df.select(meta_json("m")).collect()] == ['{"a":null,"b":"1"}', None, None]
    assert df.select(stored_meta("m")).collect()[0][0] == {"b": "1", "a": "None"}
