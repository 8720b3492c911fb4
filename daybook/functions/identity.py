"""Column helpers that derive a transaction's content identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of generated ids.
SEPARATOR = "|"
NO_AMOUNT = "0 USD"
NO_ACCOUNT = "Unknown"
FALLBACK_PREFIX = "fallback_"
KEPT_MARK = "-dup-"
# What a generated id looks like, with any suffix.
GENERATED = f"^([0-9a-f]{{64}}|{FALLBACK_PREFIX}[0-9a-f]{{8}})(-|$)"

# What counts as whitespace around a value (fixed values).
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
              "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def packed(c) -> Column:
    """A hash, with what follows it, as bytes, half as long; other texts keep theirs. The first byte tells them apart."""
    c = _col(c)
    hashed = F.concat(F.lit(b"h"), F.unhex(F.substring(c, 1, 64)), F.substring(c, 65, 2 ** 31 - 1).cast("binary"))
    return F.when(c.rlike("^[0-9a-f]{64}"), hashed).otherwise(F.concat(F.lit(b"t"), c.cast("binary")))


def unpacked(c) -> Column:
    """The text that was packed."""
    c = _col(c)
    text = lambda start: F.substring(c, start, 2 ** 31 - 1).cast("string")
    hashed = F.concat(F.lower(F.hex(F.substring(c, 2, 32))), text(34))
    return F.when(F.substring(c, 1, 1) == F.lit(b"h"), hashed).otherwise(text(2))


def strip(c) -> Column:
    """Trim all whitespace, not only spaces."""
    return F.trim(_col(c), F.lit(WHITESPACE))


def is_blank(c) -> Column:
    """Null, empty or whitespace only."""
    return F.coalesce(strip(c), F.lit("")) == ""


def amount_text(number, currency, text=None) -> Column:
    """Amount as hashed: the number as written and its currency; a zero or missing amount is '0 USD'."""
    number, currency = _col(number), _col(currency)
    written = number.cast("string") if text is None else F.coalesce(_col(text), number.cast("string"))
    return (F.when(number.isNull() | (number == 0), NO_AMOUNT)
            .otherwise(F.concat(written, F.lit(" "), currency)))


def hash_input(date, payee, narration, amount, account) -> Column:
    """Text that is hashed. Missing payee and narration count as empty, a missing amount as 0."""
    date = _col(date)
    amount = _col(amount)
    return F.concat(
        date.cast("string"), F.lit(SEPARATOR),
        F.coalesce(_col(payee), F.lit("")), F.lit(SEPARATOR),
        F.coalesce(_col(narration), F.lit("")), F.lit(SEPARATOR),
        F.coalesce(F.nullif(amount, F.lit("")), F.lit("0")), F.lit(SEPARATOR),
        strip(account))


def hash_components(date, payee, narration, amount, account) -> Column:
    """Struct (hash_input, hash) for audits."""
    text = hash_input(date, payee, narration, amount, account)
    return F.struct(text.alias("hash_input"), F.sha2(text, 256).alias("hash"))


def external_id_base(date, payee, narration, amount, account, row_identity=None) -> Column:
    """Content hash. A blank account gives a fallback id drawn from the row's identity, so
    that a retried task repeats it."""
    hashed = F.sha2(hash_input(date, payee, narration, amount, account), 256)
    if row_identity is None:
        row_identity = F.concat_ws(SEPARATOR, _col(date).cast("string"), _col(payee), _col(narration), _col(amount))
    fallback = F.concat(F.lit(FALLBACK_PREFIX), F.substring(F.sha2(_col(row_identity), 256), 1, 8))
    return F.when(is_blank(account), fallback).otherwise(hashed)


def posting_rank(account, number, source_account) -> Column:
    """Preference of a posting as the identifying one; null if it cannot be used."""
    account, number, source = _col(account), _col(number), _col(source_account)
    return (F.when((source != "") & (account == source) & (number != 0), 0)
            .when(account.startswith("Assets:") | account.startswith("Liabilities:"), 1)
            .when(account.startswith("Income:"), 2)
            .when(account != "", 3))


def id_posting(postings, source_account) -> Column:
    """Struct (rank, idx, account, amount_text) of the identifying posting, null when there is none.

    One pass over the row's own array: no explode, no shuffle. Keep it in a column of its
    own before using its fields, so that Spark evaluates it once per row."""
    source = _col(source_account)

    def candidate(p, i):
        rank = posting_rank(p["account"], p["number"], source)
        return F.when(rank.isNotNull(), F.struct(
            rank.alias("rank"), i.alias("idx"), p["account"].alias("account"),
            amount_text(p["number"], p["currency"], p["number_text"]).alias("amount_text")))

    return F.array_min(F.transform(_col(postings), candidate))


def clean_ofx_id(c) -> Column:
    """Bank id without surrounding whitespace; blank becomes null."""
    return F.nullif(strip(c), F.lit(""))


# A decimal number, an infinity or a NaN, after removing underscores.
_NUMBER = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?|s?nan\d*)$"
_DATE = r"^\d{4}-(1[0-2]|0?[1-9])-(3[01]|[12]\d|0?[1-9])$"


def strict_errors(date, payee, narration, amount, account) -> Column:
    """Name of the first rule the input breaks, null if it may be hashed strictly."""
    day = strip(date)
    spaced = F.translate(strip(amount), WHITESPACE, " " * len(WHITESPACE))
    first_token = F.replace(F.substring_index(spaced, " ", 1), F.lit("_"), F.lit(""))
    real_day = day.rlike(_DATE) & ~day.startswith("0000") & F.try_to_date(day, "yyyy-M-d").isNotNull()
    return (F.when(is_blank(date), "date is blank")
            .when(~real_day, "date is not a real YYYY-MM-DD date")
            .when(is_blank(payee) & is_blank(narration), "payee and narration are blank")
            .when(is_blank(amount), "amount is blank")
            .when(~first_token.rlike(_NUMBER), "amount is not a number")
            .when(is_blank(account), "account is blank"))
