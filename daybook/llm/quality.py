"""Line-first cleaning: every line is judged by itself, failing lines go, and a document that loses too much goes.

Lines fail that
  - carry no sentence mark of any script at their end or before a space (headings, lists, fragments),
  - are navigation (three or more separators, at least one to three words),
  - are littered with symbols (three or more, at least one to four words) or doubled exclamation marks
    (three or more, at least one to two words),
  - are short and name boilerplate (rights, terms, cookies, sign-up).
Lines without a word neither fail nor count. A document is kept if the base figures pass and its failing lines
hold at most LOST per cent of its word characters.

Words are runs of anything but space and the control characters 9 to 13. Three-word windows are compared by a
64-bit hash within their document.

Only DataFrame functions; no shuffle: everything happens inside the row.

Defined results: null text has no words, fails the base figures and stays null; so does an empty text; repeated
rows are judged alike; columns of the outputs' names are replaced, columns that begin with `_q_` are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOST = 50
WORD = r"[^\x20\x09-\x0D]+"
SENTENCE = r"[.!?\x{2026}\x{3002}\x{FF01}\x{FF1F}][\"'\x{2019}\x{201D}\x{00BB})\]]*([\x20\x09-\x0D]|$)"
# Unicode's Sentence_Terminal from U+0589 on; looked for only where the marks above are not found
MARKS = ("589 61D-61F 6D4 700-702 7F9 837 839 83D-83E 964-965 104A-104B 1362 1367-1368 166E 1735-1736 17D4-17D5 1803 1809 1944-1945 "
         "1AA8-1AAB 1B4E-1B4F 1B5A-1B5B 1B5E-1B5F 1B7D-1B7F 1C3B-1C3C 1C7E-1C7F 2024 203C-203D 2047-2049 2CF9-2CFB 2E2E 2E3C 2E53-2E54 "
         "3002 A4FF A60E-A60F A6F3 A6F7 A876-A877 A8CE-A8CF A92F A9C8-A9C9 AA5D-AA5F AAF0-AAF1 ABEB FE12 FE15-FE16 FE52 FE56-FE57 FF01 "
         "FF0E FF1F FF61 10A56-10A57 10F55-10F59 10F86-10F89 11047-11048 110BE-110C1 11141-11143 111C5-111C6 111CD 111DE-111DF "
         "11238-11239 1123B-1123C 112A9 113D4-113D5 1144B-1144C 115C2-115C3 115C9-115D7 11641-11642 1173C-1173E 11944 11946 11A42-11A43 "
         "11A9B-11A9C 11C41-11C42 11EF7-11EF8 11F43-11F44 16A6E-16A6F 16AF5 16B37-16B38 16B44 16D6E-16D6F 16E98 1BC9F 1DA88")
OTHER_MARK = "[" + "".join("-".join(rf"\x{{{c}}}" for c in x.split("-")) for x in MARKS.split()) + "]"
CLOSING = r"\p{Pe}\p{Pf}\x{201C}\x{FF02}\x{FF07}"
OTHER_SENTENCE = rf"(?=[\x{{0589}}-\x{{1DA88}}]){OTHER_MARK}[\"'{CLOSING}]*([\x20\x09-\x0D]|$)"
BOILERPLATE = ("(?i)(all rights reserved|copyright|terms of (use|service)|privacy policy|cookie (policy|settings)"
               "|accept (all )?cookies|enable javascript|subscribe to our|sign up|log ?in|click here|lorem ipsum)")
SHORT = 200  # characters up to which a line can be boilerplate


def _count(line: Column, keep: str) -> Column:
    return F.char_length(F.regexp_replace(line, f"[^{keep}]+", ""))


def line_fails(line: Column) -> Column:
    """Whether a line that has a word fails one of the rules."""
    words = F.regexp_count(line, F.lit(WORD))
    bars, symbols, bangs = _count(line, r"|\x{00BB}\x{203A}\x{2022}"), _count(line, r"#*$%&<>{}\[\]=~\^"), F.regexp_count(line, F.lit("!!"))
    return (~(line.rlike(SENTENCE) | line.rlike(OTHER_SENTENCE))
            | ((bars >= 3) & (bars * 3 >= words))
            | ((symbols >= 3) & (symbols * 4 >= words))
            | ((bangs >= 3) & (bangs * 2 >= words))
            | ((F.char_length(line) <= SHORT) & line.rlike(BOILERPLATE)))


def _letters(lines: Column) -> Column:
    """Characters in words of a list of lines."""
    return F.char_length(F.regexp_replace(F.array_join(lines, "\n"), r"[\x20\x09-\x0D]+", "")).cast("long")


def clean(docs: DataFrame, text: str = "text", lost: int = LOST) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept_chars, kept, and the
    cleaned text."""
    known = F.coalesce(F.col(text), F.lit(""))
    docs = docs.withColumns({"_q_words": F.filter(F.split(known, r"[\x20\x09-\x0D]+"), lambda w: w != ""),
                             "_q_lines": F.filter(F.split(known, "\n"), lambda x: x.rlike(WORD))})
    docs = docs.withColumns({
        "n_words": F.size("_q_words").cast("long"),
        "_q_windows": F.when(F.size("_q_words") >= 3, F.transform(F.sequence(F.lit(1), F.size("_q_words") - 2), lambda i: F.xxhash64(
            F.element_at("_q_words", i), F.element_at("_q_words", i + 1), F.element_at("_q_words", i + 2))))
        .otherwise(F.array().cast("array<bigint>")),
        "_q_good": F.filter("_q_lines", lambda x: ~line_fails(x))})
    docs = docs.withColumns({
        "_q_sorted": F.when(F.size(F.array_distinct("_q_windows")) < F.size("_q_windows"), F.array_sort(
            F.transform("_q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
        "word_chars": _letters(F.col("_q_lines")), "kept_chars": _letters(F.col("_q_good"))})
    twice = F.filter("_q_sorted", lambda x, k: (x["h"] == F.get("_q_sorted", k - 1)["h"]) | (x["h"] == F.get("_q_sorted", k + 1)["h"]))
    covered = F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    docs = docs.withColumns({
        "n_symbols": _count(known, "#*$%&|<>").cast("long"),
        "n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
        "n_repeat_words": F.when(F.col("_q_sorted").isNull(), 0).otherwise(F.size(F.array_distinct(covered))).cast("long")})
    docs = docs.withColumn("base_failed", (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))
    docs = docs.withColumns({
        "kept": ~F.col("base_failed") & ((F.col("word_chars") - F.col("kept_chars")) * 100 <= F.col("word_chars") * lost),
        text: F.when(F.size("_q_good") == F.size("_q_lines"), F.col(text)).otherwise(F.array_join(
            F.filter(F.split(known, "\n"), lambda x: ~x.rlike(WORD) | ~line_fails(x)), "\n"))})
    return docs.drop(*[c for c in docs.columns if c.startswith("_q_")])



def keep(docs: DataFrame, text: str = "text") -> DataFrame:
    """The kept documents, with the columns of clean(). A plain filter would be pushed below the steps of clean(), with
    their expressions written out into it again and again; the generator drops the rows where they are judged."""
    judged = clean(docs, text)
    return judged.select("*", F.explode(F.when(F.col("kept"), F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))).alias("_q_kept")).drop("_q_kept")


END = r"([\x20\x09-\x0D]|[\x{85}\x{2028}\x{2029}]?$)"     # what Java's $ means
CHECK_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
a AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
b AS (SELECT *, len(w) AS n, list_transform(range(1, greatest(len(w) - 1, 1)),
             lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS g FROM a),
win AS (SELECT row_number() OVER () AS r, * FROM b),
e AS (SELECT r, unnest(g) AS g, unnest(range(len(g))) AS i FROM win),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM e) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT p) AS k FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
j AS (SELECT r, unnest(ls) AS x FROM win),
f AS (SELECT r, x, length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) AS c, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS nw,
             length(regexp_replace(x, '[^|\x{{BB}}\x{{203A}}\x{{2022}}]+', '', 'g')) AS bars,
             length(regexp_replace(x, '[^#*$%&<>{{}}\[\]=~\^]+', '', 'g')) AS symbols, len(regexp_extract_all(x, '!!')) AS bangs FROM j),
s AS (SELECT r, sum(CASE WHEN NOT (regexp_matches(x, '[.!?\x{{2026}}\x{{3002}}\x{{FF01}}\x{{FF1F}}]["''\x{{2019}}\x{{201D}}\x{{BB}})\]]*{END}')
                               OR regexp_matches(x, '{OTHER_MARK}["''{CLOSING}]*{END}'))
             OR bars >= 3 AND bars * 3 >= nw OR symbols >= 3 AND symbols * 4 >= nw OR bangs >= 3 AND bangs * 2 >= nw
             OR length(x) <= {SHORT} AND regexp_matches(x, '{BOILERPLATE}') THEN c ELSE 0 END) AS lost FROM f GROUP BY r),
z AS (SELECT doc_id, n AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             coalesce(k, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
      FROM win LEFT JOIN rep USING (r) LEFT JOIN s USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost * 100 <= word_chars * {LOST} AS kept
FROM z
"""
