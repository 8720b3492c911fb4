"""Removal of repeated lines over all documents, equal but for one character.

A line (what `\\n` splits) that has a word goes if an earlier line equals it, or is within one inserted, deleted or
replaced character of it when both have LEAST characters or more. Earlier: smaller id, then hash of the text, then
line number. The first of equal lines stands for all of them.

Deletion neighbourhoods: two lines are within one edit if one is the other with a character deleted, or if deleting
the same place of both leaves the same. So every line emits its variants as hashed keys, equal variants meet, and
the earliest line of a key is verified by edit distance. Nothing else is compared and no pair of a group is
emitted: a key's lines look at its earliest line only.

Most lines have no near line, and emitting a variant for each of their characters would cost their length squared.
The one edit lies in one place, so lines must first agree on a beginning or an end of half their size, then on all
but one of SEGMENTS segments; only the segments where two lines agree on the rest emit variants. These are necessary
conditions, so no near line is lost. Lines of different length meet by emitting their keys for both lengths.

Only DataFrame functions. Shuffled: hashes of lines and half keys (narrow), the text of lines that share a half key,
and the documents once, to cut their lines. Shared half keys reach the lines as a broadcast bitmap of fixed size; where
it fills up, more lines are compared and the result is the same.

Defined results: null texts stay null, empty ones empty; lines without a word stay; a document that loses all its
lines keeps an empty text; rows that repeat id and text count as one document and stay alike; null ids sort first;
other columns are kept; columns that begin with `_l_` are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stage import staged

LEAST = 20       # characters from which near lines count
SEGMENTS = 8
BITS = 1 << 26   # of the filter for lines that may have a near one
WORD = r"[^\x20\x09-\x0D]"


def _half(length: Column) -> Column:
    """Half the power of two at or below a length: two lengths that differ by one share it, or the longer is a power."""
    return F.call_function("shiftleft", F.lit(1), F.char_length(F.bin(length)) - 2)


def _half_keys(line: Column) -> Column:
    """Hashes of the beginnings and ends of which near lines share one."""
    n = F.char_length(line)

    def keys(size: Column) -> list[Column]:
        return [F.xxhash64(F.lit("begin"), size, F.substring(line, F.lit(1), size)),
                F.xxhash64(F.lit("end"), size, F.substring(line, n - size + 1, size))]
    size = _half(n)
    own = F.array(*keys(size))
    return F.when(n < LEAST, F.array().cast("array<bigint>")).when(n == size * 2, F.concat(own, F.array(*keys(_half(n - 1))))).otherwise(own)


def _segment_keys(line: Column) -> Column:
    """For the length of the line and one less: (key of all but a segment, begin and end of the segment in the line)."""
    n = F.char_length(line)

    def keys(short: Column) -> list[Column]:
        out = []
        for j in range(SEGMENTS):
            begin, rest = F.floor(short * j / SEGMENTS).cast("int"), short - F.floor(short * (j + 1) / SEGMENTS).cast("int")
            key = F.xxhash64(F.lit(j), short, F.substring(line, F.lit(1), begin), F.substring(line, n - rest + 1, rest))
            out.append(F.struct(key.alias("key"), (begin + 1).alias("begin"), (n - rest).alias("end")))
        return out
    return F.array(*keys(n), *keys(n - 1))


def _variants(line: Column, begin: Column, end: Column) -> Column:
    """(place, key) of the line itself, at place 0, and with each character from begin to end deleted."""
    return F.transform(F.sequence(F.lit(0), F.greatest(end - begin + 1, F.lit(0))), lambda i: F.struct(
        F.when(i == 0, 0).otherwise(begin + i - 1).alias("place"),
        F.when(i == 0, F.xxhash64(line)).otherwise(F.xxhash64(F.concat(
            F.substring(line, F.lit(1), begin + i - 2), F.substring(line, begin + i, F.char_length(line))))).alias("variant")))


def _bits(keys: DataFrame) -> DataFrame:
    """A set of keys as bitmaps (bucket, bits) of BITS bits altogether, however many keys there are."""
    slot = F.pmod("key", F.lit(BITS))
    return keys.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))


def _in_bits(rows: DataFrame, bits: DataFrame) -> DataFrame:
    """The rows whose key may be in the set; the bitmaps are at most BITS / 8 bytes and are broadcast."""
    at = F.bitmap_bit_position(F.pmod("key", F.lit(BITS)))
    byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = rows.withColumn("bucket", F.bitmap_bucket_number(F.pmod("key", F.lit(BITS)))).join(F.broadcast(bits), "bucket")
    return held.where(F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1).drop("bucket", "bits")


def _lines(docs: DataFrame) -> DataFrame:
    """Every line that has a word: place (_l_id, _l_hash, _l_at), text and hashes."""
    lines = docs.select("_l_id", "_l_hash", F.posexplode(F.split("_l_text", "\n")).alias("_l_at", "line")).where(F.col("line").rlike(WORD))
    return lines.withColumns({"h": F.xxhash64("line"), "g": F.xxhash64(F.lit("second"), "line")})


PLACE = ("_l_id", "_l_hash", "_l_at")


def _near(docs: DataFrame) -> DataFrame:
    """(h, g) of the distinct lines with an earlier line within one edit."""
    halves = _lines(docs).select("*", F.explode(_half_keys(F.col("line"))).alias("key"))
    shared = halves.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b")
    lines = _in_bits(halves, _bits(shared)).groupBy("h", "g").agg(F.min(F.struct(*PLACE)).alias("first"), F.first("line").alias("line"))
    lines = staged(lines)

    segments = lines.select("h", "g", F.explode(_segment_keys(F.col("line"))).alias("s")).select("h", "g", "s.*")
    meeting = segments.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    ranges = segments.join(meeting, "key", "left_semi").groupBy("h", "g", "begin", "end").agg(F.lit(1).alias("one")).drop("one")
    variants = (lines.join(ranges, ["h", "g"]).select("h", "g", "first", F.explode(_variants(F.col("line"), F.col("begin"), F.col("end"))).alias("v"))
                .select("h", "g", "first", F.col("v.place").alias("place"), F.col("v.variant").alias("variant")).distinct())
    me = F.struct("first", "h", "g")
    whole, same = Window.partitionBy("variant"), Window.partitionBy("variant", "place")
    seen = variants.withColumns({
        "replaced": F.when(F.col("place") > 0, F.min(me).over(same)),
        "deleted": F.when(F.col("place") > 0, F.min(F.when(F.col("place") == 0, me)).over(whole)),
        "longer": F.when(F.col("place") == 0, F.min(F.when(F.col("place") > 0, me)).over(whole))})
    found = seen.select("h", "g", "first", F.explode(F.array("replaced", "deleted", "longer")).alias("other"))
    found = found.where(F.col("other.first") < F.col("first")).groupBy("h", "g").agg(F.min("other").alias("other"))
    other = lines.select(F.col("h").alias("oh"), F.col("g").alias("og"), F.col("line").alias("earlier"))
    return (found.join(other, (F.col("other.h") == F.col("oh")) & (F.col("other.g") == F.col("og"))).join(lines, ["h", "g"])
            .where(F.levenshtein("line", "earlier", 1).between(0, 1)).select("h", "g"))


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """_l_id, _l_hash and the numbers of the lines that go, from 0, for each document that loses any."""
    docs = docs.select(F.col(key).alias("_l_id"), F.xxhash64(F.col(text)).alias("_l_hash"), F.col(text).alias("_l_text"))
    near = _near(docs).withColumn("near", F.lit(True))
    lines = _lines(docs).select(*PLACE, "h", "g")
    firsts = lines.groupBy("h", "g").agg(F.min(F.struct(*PLACE)).alias("first"), F.count("*").alias("n"))
    # staged, so that the join below has two plain shuffles as its sides and Spark can split a line that fills many rows
    going = staged(firsts.join(near, ["h", "g"], "left").where("n > 1 OR near").drop("n"))
    hit = lines.join(going, ["h", "g"])
    return hit.where(F.col("near") | (F.struct(*PLACE) > F.col("first"))).groupBy("_l_id", "_l_hash").agg(F.collect_set("_l_at").alias("_l_gone"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the repeated lines; n_removed_lines says how many went."""
    gone = removed_lines(docs, key, text)
    marked = docs.withColumns({"_l_row_id": F.col(key), "_l_row_hash": F.xxhash64(F.col(text))})
    on = marked["_l_row_id"].eqNullSafe(gone["_l_id"]) & (marked["_l_row_hash"] == gone["_l_hash"])
    kept = F.array_join(F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains("_l_gone", i)), "\n")
    joined = marked.join(gone, on, "left")
    joined = joined.withColumns({"n_removed_lines": F.coalesce(F.size("_l_gone"), F.lit(0)),
                                 text: F.when(F.col("_l_gone").isNull(), F.col(text)).otherwise(kept)})
    return joined.drop(*[c for c in joined.columns if c.startswith("_l_")])


# For unique document ids; the order of texts of one id is not restated.
CHECK_SQL = r"""
WITH l AS (SELECT doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM (
    SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
w AS (SELECT *, row_number() OVER (ORDER BY doc_id, pos) AS o FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
d AS (SELECT line, length(line) AS n, min(o) AS o FROM w GROUP BY line),
-- one edit leaves the first ten or the last ten of twenty characters as they are
pair AS (SELECT a.line AS a, b.line AS b FROM d a JOIN d b ON substr(a.line, 1, 10) = substr(b.line, 1, 10)
           WHERE b.o < a.o AND least(a.n, b.n) >= 20 AND abs(a.n - b.n) <= 1 AND levenshtein(a.line, b.line) <= 4
         UNION SELECT a.line, b.line FROM d a JOIN d b ON substr(a.line, a.n - 9) = substr(b.line, b.n - 9)
           WHERE b.o < a.o AND least(a.n, b.n) >= 20 AND abs(a.n - b.n) <= 1 AND levenshtein(a.line, b.line) <= 4),
-- of characters, where levenshtein counts bytes
near AS (SELECT DISTINCT a FROM (SELECT a, CASE WHEN length(a) < length(b) THEN b ELSE a END AS s, CASE WHEN length(a) < length(b) THEN a ELSE b END AS t FROM pair)
         WHERE len(list_filter(range(1, length(s) + 1), lambda i: substr(s, 1, i - 1) = substr(t, 1, i - 1)
               AND substr(s, i + 1) = substr(t, CASE WHEN length(s) = length(t) THEN i + 1 ELSE i END))) > 0),
gone AS (SELECT w.doc_id, w.pos FROM w JOIN d USING (line) WHERE w.o <> d.o OR line IN (SELECT a FROM near))
SELECT doc_id, CASE WHEN any_value(text) IS NULL THEN NULL ELSE coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT hit), '') END AS text,
       count(*) FILTER (WHERE hit) AS n_removed_lines
FROM (SELECT documents.doc_id, documents.text, l.pos, line, gone.pos IS NOT NULL AS hit FROM documents LEFT JOIN l USING (doc_id)
      LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.pos = l.pos) GROUP BY doc_id
"""
