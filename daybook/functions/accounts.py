"""Column helpers for colon-separated account names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category rules of the expense report (fixed values).
CAR_PREFIX = "Expenses:Car"
FOOD_PREFIX = "Expenses:Food"
FOOD_ACCOUNTS = ["Expenses:Groceries", "Expenses:EatingOut"]
HOUSING_ACCOUNT = "Expenses:HouseRent"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def account_type(name) -> Column:
    """Root segment of the account; the whole name if there is no colon."""
    return F.substring_index(_col(name), ":", 1)


def segment(name, i: int) -> Column:
    """i-th segment counted from 1, '' past the end."""
    return F.split_part(_col(name), F.lit(":"), F.lit(i))


def under(name, prefix: str) -> Column:
    """The account itself or any descendant; never a sibling that shares the spelling."""
    return (_col(name) == prefix) | _col(name).startswith(prefix + ":")


def spelled_like(name, prefix: str) -> Column:
    """Literal LIKE 'prefix%': also matches siblings such as prefix + 'Wash'."""
    return _col(name).startswith(prefix)


def account_match(name, pattern: str) -> Column:
    """Wildcard match: an inner `*` stands for one segment, a final `*` for one or more."""
    parts = pattern.split(":")
    rx = [("[^:]+(:[^:]+)*" if i == len(parts) - 1 else "[^:]+") if p == "*" else re.escape(p)
          for i, p in enumerate(parts)]
    if "*" not in parts:
        return _col(name) == pattern
    return _col(name).rlike("^" + ":".join(rx) + "$")


def account_match_any(name, patterns: list[str]) -> Column:
    """True where any of the patterns matches."""
    out = F.lit(False)
    for p in patterns:
        out = out | account_match(name, p)
    return out


def account_prefixes(name) -> Column:
    """Array of all ancestors and the account itself, shortest first."""
    parts = F.split(_col(name), ":")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.array_join(F.slice(parts, F.lit(1), i), ":"))


def prefix_at(name, depth: int) -> Column:
    """First `depth` segments of the account."""
    return F.substring_index(_col(name), ":", depth)


def category(name) -> Column:
    """Expense category: Car, Food, Housing, else the second segment."""
    c = _col(name)
    return (F.when(spelled_like(c, CAR_PREFIX), "Car")
            .when(spelled_like(c, FOOD_PREFIX) | c.isin(FOOD_ACCOUNTS), "Food")
            .when(c == HOUSING_ACCOUNT, "Housing")
            .otherwise(segment(c, 2)))


def display_amount(amount) -> Column:
    """Amount without its accounting sign."""
    return F.abs(_col(amount))


def basename(path) -> Column:
    """Last component of a path."""
    return F.substring_index(_col(path), "/", -1)
