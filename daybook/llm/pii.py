"""Format-preserving pseudonyms for personal data.

Values are found by pattern and validated (check digits, calendar, ranges), read as one integer of their format's
value set, moved by a keyed Feistel permutation of that set and written back in the same format. The permutation
depends on key and kind only, so equal values get equal pseudonyms in every document, however they are separated,
and different values stay different. A move that leaves the valid values is repeated until it comes back (cycle
walking), so a valid card, date or number becomes another valid one.

Kinds: card (Luhn), iban (mod 97), ssn, phone, ipv4, date (1900 to 2099), email, secret (access keys, and values
named password, token, secret or api key).

A card or IBAN that fails validation may have taken what follows it (a security code, an expiry date, a word): the
shorter ends at its separators are tried as well, an IBAN's country length first. Cards in the usual groups go before
others.

Defined results: null text stays null, empty text empty; numbers that fail validation at every end stay; repeated rows are
treated alike; the text column is replaced and all other columns are kept; an existing column `spans` is replaced.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
LONG = 128                   # characters of a value that are read as one integer
DAY0, DAYS = dt.date(1900, 1, 1).toordinal(), dt.date(2100, 1, 1).toordinal() - dt.date(1900, 1, 1).toordinal()
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

TRIGGER = re.compile(r"[0-9@]|(?i:passw|pwd|token|secret|api.?key)")
FIND = re.compile(r"""
    (?<![\w.+%-])(?:(?:[._+-][A-Za-z0-9._+-]*+)?%)*+(?P<email>[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}\b)
  | (?P<named>(?i:\b(?:password|passwd|pwd|token|secret|api[_-]?key))["']?\s*[=:]\s*["']?(?P<secret>[^\s"',;]{6,}))
  | (?P<access>\b(?:AKIA|ASIA)[A-Z0-9]{16}\b)
  | (?P<iban>\b[A-Z]{2}[0-9]{2}(?:\ ?[A-Z0-9]{4}){2,7}(?:\ ?[A-Z0-9]{1,3})?\b)
  | (?P<date>(?<![\w/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[/.][0-9]{2}[/.][0-9]{4})(?![\w/-]|\.[0-9]))
  | (?P<ipv4>(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9]))
  | (?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))
  | (?P<phone>(?<![\w+])\+[0-9](?:[ ().-]{0,2}[0-9]){7,14}(?!\w)|(?<![\w(])\(?[2-9][0-9]{2}\)?[ .-][2-9][0-9]{2}[ .-][0-9]{4}(?!\w))
  | (?P<card>(?<![\w-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-]))
""", re.VERBOSE | re.ASCII)


class Permuter:
    """Keyed permutations of 0 .. n-1."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _step(self, kind: str, n: int, half: int, value: int) -> int:
        left, right = value >> half, value & ((1 << half) - 1)
        for r in range(ROUNDS):
            mixed = hashlib.blake2b(f"{kind} {n} {r} {right}".encode(), key=self.key, digest_size=half // 8 + 1).digest()
            left, right = right, left ^ (int.from_bytes(mixed, "big") & ((1 << half) - 1))
        return left << half | right

    def move(self, kind: str, n: int, value: int, valid: Callable[[int], bool] = lambda v: True) -> int:
        """Where the permutation of the valid values below n takes a valid value."""
        half = max(1, ((n - 1).bit_length() + 1) // 2)
        while True:
            value = self._step(kind, n, half, value)
            if value < n and valid(value):
                return value

    def letters(self, kind: str, text: str, valid: Callable[[str], bool] = lambda t: True, known=(DIGITS, LOWER, UPPER)) -> str:
        """Digits, small and large letters stay what they are and where they are; other characters stay as they are. Of more
        than LONG characters, blocks are moved one after the other, each by a permutation that the blocks before it choose,
        from the left and then from the right."""
        if len(text) <= LONG:
            return self._letters(kind, text, valid, known)
        blocks = [text[at:at + LONG] for at in range(0, len(text), LONG)]
        for way in ("right", "left"):
            chain, out = hashlib.blake2b(f"{way} {len(text)}".encode(), key=self.key, digest_size=16), []
            for block in blocks if way == "right" else reversed(blocks):
                out.append(self._letters(f"{kind} {chain.hexdigest()}", block, lambda t: True, known))
                chain.update(out[-1].encode())
            blocks = out if way == "right" else out[::-1]
        return "".join(blocks)

    def _letters(self, kind: str, text: str, valid: Callable[[str], bool], known) -> str:
        sets = [next((s for s in known if c in s), None) for c in text]
        value, n = 0, 1
        for c, s in zip(text, sets):
            if s:
                value, n = value * len(s) + s.index(c), n * len(s)

        def write(v: int) -> str:
            out = []
            for c, s in zip(reversed(text), reversed(sets)):
                if s:
                    v, at = divmod(v, len(s))
                    c = s[at]
                out.append(c)
            return "".join(reversed(out))
        shape = "".join(s[0] if s else c for c, s in zip(text, sets))
        return write(self.move(f"{kind} {shape}", n, value, lambda v: valid(write(v)))) if n > 1 else text


def luhn(digits: str) -> int:
    """The sum that valid numbers have at 0 modulo 10."""
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def spread(plain: str, like: str) -> str:
    """The characters of plain in the places of like's letters and digits."""
    rest = iter(plain)
    return "".join(next(rest) if c.isalnum() else c for c in like)


def card(p: Permuter, text: str) -> str | None:
    digits = re.sub(r"\D", "", text)
    if luhn(digits) or len(set(digits)) == 1:
        return None
    head = p.letters("card", digits[:-1])
    return spread(head + str(-luhn(head + "0") % 10), text)


def iban(p: Permuter, text: str) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or mod97(plain) != 1:
        return None
    body = p.letters("iban " + plain[:2], plain[4:])
    return spread(f"{plain[:2]}{98 - mod97(plain[:2] + '00' + body):02d}{body}", text)


def country_end(text: str) -> int | None:
    """Where an IBAN of its country's length ends in the text, at a separator or the text's end."""
    length, n = IBAN_LENGTHS.get(text[:2]), 0
    for i, c in enumerate(text):
        n += c != " "
        if n == length:
            return i + 1 if text[i + 1:i + 2] in ("", " ") else None
    return None


def usual(text: str) -> bool:
    """Whether a card number stands in one piece or in groups that cards are printed in."""
    return tuple(len(x) for x in re.split("[ -]", text)) in CARD_GROUPS or text.isdigit()


def passes(text: str) -> bool:
    digits = re.sub(r"\D", "", text)
    return 13 <= len(digits) <= 19 and luhn(digits) == 0 and len(set(digits)) > 1


def card_ends(text: str) -> Iterator[int]:
    """The ends at which a card may stop in a match: usual groups first, then the whole, then what else passes. None
    where a card in usual groups begins later in the match, or one that begins later ends with it."""
    places = [i for i, c in enumerate(text) if c.isdigit()]
    # sums of the check digits, with every second digit doubled: from the even places and from the odd ones
    sums = ([0], [0])
    for i, at in enumerate(places):
        d = int(text[at])
        twice = 2 * d - 9 * (d > 4)
        sums[0].append(sums[0][-1] + (d if i % 2 else twice))
        sums[1].append(sums[1][-1] + (twice if i % 2 else d))
    last = [i for i, at in enumerate(places) if i + 1 == len(places) or places[i + 1] > at + 1]  # digits before a separator or the end

    def passing(first: int) -> list[int]:
        """Ends of what passes from that digit on."""
        return [places[j] + 1 for j in last if 12 <= j - first <= 18 and not (sums[1 - j % 2][j + 1] - sums[1 - j % 2][first]) % 10
                and passes(text[places[first]:places[j] + 1])]
    whole = len(text)
    found = passing(0)
    short = [e for e in reversed(found) if e < whole]
    if usual(text):
        yield whole
    yield from (e for e in short if usual(text[:e]))
    later = [(text[places[i + 1]:e], e) for i in last[:-1] if text[places[i] + 1] == " " for e in passing(i + 1)]
    if not any(usual(t) for t, _ in later):
        if whole in found:
            yield whole
        if not any(e == whole for _, e in later):
            yield from short


def ssn(p: Permuter, text: str) -> str | None:
    def valid(t: str) -> bool:
        return t[:3] not in ("000", "666") and t[0] != "9" and t[4:6] != "00" and t[7:] != "0000"
    return p.letters("ssn", text, valid) if valid(text) else None


def phone(p: Permuter, text: str) -> str | None:
    digits = re.sub(r"\D", "", text)
    american = not text.startswith("+") or digits[0] == "1" and len(digits) == 11
    if american:
        own = digits[-10:]

        def assigned(t: str) -> bool:
            return t[0] not in "01" and t[3] not in "01"
        return spread(digits[:-10] + p.letters("phone", own, lambda t: assigned(t) == assigned(own)), text)
    return spread(digits[:2] + p.letters("phone " + digits[:2], digits[2:]), text) if 8 <= len(digits) <= 15 else None


def ipv4(p: Permuter, text: str) -> str | None:
    parts = text.split(".")
    spans = [(0, 10), (10, 90), (100, 156)]
    if any(int(x) > 255 or len(x) > 1 and x[0] == "0" for x in parts):
        return None
    value, n = 0, 1
    for x in parts:
        low, size = spans[len(x) - 1]
        value, n = value * size + int(x) - low, n * size
    value, out = p.move("ipv4 " + " ".join(str(len(x)) for x in parts), n, value), []
    for x in reversed(parts):
        low, size = spans[len(x) - 1]
        value, at = divmod(value, size)
        out.append(str(low + at))
    return ".".join(reversed(out))


def date(p: Permuter, text: str) -> str | None:
    a, b, c = map(int, re.split(r"[/.-]", text))
    forms = [(a, b, c)] if text[4] == "-" else [(c, b, a), (c, a, b)]  # day first; month first where that is no date
    for i, form in enumerate(forms):
        try:
            day = dt.date(*form).toordinal() - DAY0
        except ValueError:
            continue
        if not 0 <= day < DAYS:
            return None
        # where the month stands first, only dates that cannot be read the other way
        new = dt.date.fromordinal(DAY0 + p.move("date" + "m" * i, DAYS, day, (lambda v: dt.date.fromordinal(DAY0 + v).day > 12) if i else (lambda v: True)))
        y, m, d = f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}"
        return spread(y + m + d if text[4] == "-" else m + d + y if i else d + m + y, text)
    return None


def email(p: Permuter, text: str) -> str:
    own, _, domain = text.partition("@")
    labels, _, top = domain.rpartition(".")
    return f"{p.letters('mailbox', own)}@{p.letters('domain', labels)}.{top}"


def access(p: Permuter, text: str) -> str:
    return text[:4] + p.letters("access", text[4:])


def secret(p: Permuter, text: str) -> str:
    return p.letters("secret hex", text, known=(DIGITS, LOWER[:6])) if re.fullmatch("[0-9a-f]+", text) else p.letters("secret", text)


CARD_GROUPS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3)}
IBAN_LENGTHS = {c: int(n) for n, some in (x.split(":") for x in (
    "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA "
    "23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM "
    "28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU").split())
    for c in some.split(",")}
KINDS = {"email": email, "access": access, "iban": iban, "date": date, "ipv4": ipv4, "ssn": ssn, "phone": phone, "card": card,
         "secret": secret}


def ends(kind: str, value: str) -> Iterator[int]:
    """The ends at which a found value is tried."""
    if kind == "card":
        yield from card_ends(value)
        return
    if kind == "iban" and (own := country_end(value)):
        yield own
    yield len(value)
    if kind == "iban" and value[:2] not in IBAN_LENGTHS:
        yield from reversed([i for i, c in enumerate(value) if c == " "])


def pseudonymised(p: Permuter, text: str) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, length) of each. Formats keep their lengths, so starts hold in both."""
    if not TRIGGER.search(text):
        return text, []
    out, spans, done, at = [], [], 0, 0
    while m := FIND.search(text, at):
        kind = m.lastgroup if m.lastgroup != "named" else "secret"
        begin, end = m.span(kind)
        value, new = m.group(kind), None
        for last in ends(kind, value):
            if new := KINDS[kind](p, value[:last]):
                end = begin + last
                break
        if new is None:  # its digits may be part of another number
            at = begin + 1
            continue
        at = end
        out += [text[done:begin], new]
        spans.append(("secret" if kind == "access" else kind, begin, end - begin))
        done = end
    return "".join(out) + text[done:], spans


@lru_cache(maxsize=4)
def permuter(key: str) -> Permuter:
    return Permuter(key.encode())


def pseudonymise(docs: DataFrame, key: str, text: str = "text", spans: str = "spans") -> DataFrame:
    """docs with pseudonyms in the text and their places in `spans`."""
    place = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())])
    kind = pa.struct([("text", pa.string()), ("spans", pa.list_(place))])

    @F.arrow_udf("struct<text:string,spans:array<struct<kind:string,start:int,length:int>>>")
    def private(texts: pa.Array) -> pa.Array:
        p, rows = permuter(key), []
        for t in texts:
            t = t.as_py()
            new, found = (None, []) if t is None else pseudonymised(p, t)
            rows.append({"text": new, "spans": [dict(zip(("kind", "start", "length"), x)) for x in found]})
        return pa.array(rows, kind)
    moved = docs.withColumn(spans, private(F.col(text)))
    return moved.withColumns({text: F.col(spans + ".text"), spans: F.col(spans + ".spans")})
