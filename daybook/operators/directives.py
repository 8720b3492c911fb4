"""Directive streams: demultiplexing by kind and posting checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.schema import KINDS, REQUIRED


class InvalidPostings(ValueError):
    """Raised in strict mode when a posting has no usable amount."""


def of_kind(d: DataFrame, *kinds: str) -> DataFrame:
    """Directives of the given kinds."""
    return d.filter(F.col("kind").isin(*kinds))


def split_directives(d: DataFrame) -> dict[str, DataFrame]:
    """One frame per known kind; other kinds are ignored."""
    return {k: of_kind(d, k) for k in KINDS}


def directive_counts(d: DataFrame) -> DataFrame:
    """Rows per known kind."""
    return of_kind(d, *KINDS).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def has_invalid_posting() -> Column:
    """True where any posting of the row lacks its number or currency."""
    bad = F.exists("postings", lambda p: p["number"].isNull() | p["currency"].isNull())
    return F.coalesce(bad, F.lit(False))


class MissingValues(ValueError):
    """Raised in strict mode when a directive lacks what the ledger requires."""


class BadPositions(ValueError):
    """Raised when the import positions of a run are null or repeat."""


def missing_values() -> Column:
    """The first required column that a directive of a known kind lacks, else null."""
    reason = F.lit(None).cast("string")
    for kind, columns in REQUIRED.items():
        for c in reversed(columns):
            reason = F.when((F.col("kind") == kind) & F.col(c).isNull(), F.lit(c)).otherwise(reason)
    unnamed = F.coalesce(F.exists("postings", lambda p: p["account"].isNull()), F.lit(False))
    return F.when((F.col("kind") == "transaction") & unnamed, F.lit("account")).otherwise(reason)


def assert_complete(d: DataFrame) -> None:
    """Raise on the first directive that lacks a required column."""
    bad = d.withColumn("_missing", missing_values()).filter("_missing IS NOT NULL").limit(1).collect()
    if bad:
        b = bad[0]
        raise MissingValues(f"{b.kind} at {b.source_file}:{b.source_line} has no {b['_missing']}")


def assert_positions(d: DataFrame) -> None:
    """Raise if positions (seq) are null or repeat; everything that orders or joins directives rests on them."""
    bad = d.groupBy("seq").agg(F.count(F.lit(1)).alias("n")).filter("seq IS NULL OR n > 1").limit(1).collect()
    if bad:
        raise BadPositions("a directive has no import position" if bad[0].seq is None else f"import position {bad[0].seq} repeats; "
                           "if it counts inside each file, read with positions='file'")


def invalid_postings(d: DataFrame) -> DataFrame:
    """Rejected postings with position (from 1), file, line, narration and reason."""
    return (of_kind(d, "transaction").filter(has_invalid_posting())
            .select("seq", "source_file", "source_line", "narration", F.posexplode("postings").alias("_i", "p"))
            .filter(F.col("p.number").isNull() | F.col("p.currency").isNull())
            .select("seq", (F.col("_i") + 1).alias("position"), "source_file", "source_line", "narration",
                    F.col("p.account").alias("account"),
                    F.when(F.col("p.number").isNotNull(), "amount without currency")
                    .when(F.col("p.currency").isNull(), "posting has no amount")
                    .otherwise("amount has no number").alias("reason")))


def assert_valid(d: DataFrame) -> None:
    """Raise on the first rejected posting."""
    bad = invalid_postings(d).limit(1).collect()
    if bad:
        b = bad[0]
        raise InvalidPostings(f"posting {b.position} of '{b.narration}' at "
                              f"{b.source_file}:{b.source_line}, account {b.account}: {b.reason}")


def valid_transactions(d: DataFrame, strict: bool = True) -> DataFrame:
    """Transactions whose postings all have amounts. Strict mode raises if others exist."""
    if strict:
        assert_valid(d)
    return of_kind(d, "transaction").filter(~has_invalid_posting())


def affected(d: DataFrame, names: list[str]) -> DataFrame:
    """Transactions that post to any of the named accounts, with the names they use."""
    used = F.array_intersect(F.col("postings.account"), F.array(*[F.lit(n) for n in names]))
    return (of_kind(d, "transaction").withColumn("accounts", F.array_sort(used))
            .filter(F.size("accounts") > 0)
            .select("seq", "source_file", "source_line", "narration", "accounts"))
