"""Repair of the structure of conversations by Hirschberg's divide and conquer.

The turns of a conversation are edited so that the initials of their roles read `(s?(ua)+)?`. Edits, with costs: Keep 0,
Rerole to user or assistant 3, Delete 4 (what blank and repeated turns need), Insert an empty turn 3; a truncated turn
that stays costs 3 more. Of the cheapest audits (the edits' initials in order) the least one in ASCII is made.

Four states say what has been read: nothing, the system turn, a user turn, an assistant turn. A forward vector of costs
(and of the order of the least audits so far) and a backward vector meet in the middle; the audit-least of the cheapest
states is where the path crosses, and both halves are solved alike. No table of choices is held: memory is a byte for
each turn and eight numbers.

Turns lie in ranges over tasks (turns.ordered). A conversation inside one task is solved there. Of one that spans
tasks, each task gives the matrix of costs from state to state over its part; parts are crossed in the same way as turns, and
each is then solved between the states found, in its own task again. So no task holds more than its range, and what
meets for one conversation are as many matrices as tasks share it.

Defined results: a turn is blank without `[^\\x20\\x09-\\x0D]`, else a duplicate if role and text stood earlier in its conversation,
else truncated if its last such character is none of `.!?`; null roles and texts count as one space, null turns come first, turns
of one number go by role and text; roles count by their first character, others than s, u and a are never kept; repeated
rows are turns of their own; a null conversation id is an id; other columns are dropped; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from .stage import staged
from .trie import CRC_SQL
from .turns import BLANKS, damaged, ordered, part_of

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
FAR = 1 << 60                                       # no way
STATES = range(4)                                   # nothing, system, user, assistant
NEXT, ENDS = (2, 2, 3, 2), (0, 3)                   # where the wanted role (user, or assistant after user) leads; where audits end
SYSTEM, USER, ASSISTANT, OTHER = range(4)           # of a turn's code; 4 more if it must go, 8 more if it is truncated
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


def _after_inserts(state: int) -> list[tuple[int, int, str]]:
    """(state, cost, audit) of up to three inserted turns."""
    out, audit = [], ""
    for _ in range(4):
        out.append((state, len(audit) * INSERT, audit))
        state, audit = NEXT[state], audit + "I"
    return out


@lru_cache(maxsize=None)
def steps(code: int) -> list[list[tuple[int, str] | None]]:
    """For a turn's code, from each state to each state: the least (cost, audit) of inserts and the turn's own edit."""
    initial, out = code & 3, [[None] * 4 for _ in STATES]
    kept = TRUNCATED if code & 8 else 0
    for begin in STATES:
        for state, cost, audit in _after_inserts(begin):
            ways = [(state, DELETE, "D")]
            if not code & 4:
                ways.append((NEXT[state], REROLE + kept, "R"))
                if initial == SYSTEM and state == 0:
                    ways.append((1, KEEP + kept, "K"))
                elif initial == (ASSISTANT if state == 2 else USER):
                    ways.append((NEXT[state], KEEP + kept, "K"))
            for end, more, edit in ways:
                new = (cost + more, audit + edit)
                if out[begin][end] is None or new < out[begin][end]:
                    out[begin][end] = new
    return out


TAIL = [min((cost, audit) for state, cost, audit in _after_inserts(s) if state in ENDS) for s in STATES]


def ranked(found: list[tuple | None]) -> tuple[list[int], list[int]]:
    """Costs, and the order of the audits, of the best (cost, order, more) for each state."""
    costs = [FAR if x is None else x[0] for x in found]
    order = sorted((x[1:], s) for s, x in enumerate(found) if x is not None)
    ranks = [0] * 4
    for i, (_, s) in enumerate(order):
        ranks[s] = i
    return costs, ranks


def start(state: int) -> tuple[list[int], list[int]]:
    return [0 if s == state else FAR for s in STATES], [0] * 4


def forward(codes: bytes, state: int) -> tuple[list[int], list[int]]:
    """Least costs from `state` to each state, and the order of their least audits. No audit here begins another one of
    the same turns, for each ends with a turn's edit; so the order of beginnings decides."""
    costs, ranks = start(state)
    for code in codes:
        best = [None] * 4
        for s, ways in enumerate(steps(code)):
            if costs[s] < FAR:
                for t, way in enumerate(ways):
                    if way and (best[t] is None or (new := (costs[s] + way[0], ranks[s], way[1])) < best[t]):
                        best[t] = (costs[s] + way[0], ranks[s], way[1])
        costs, ranks = ranked(best)
    return costs, ranks


def backward(codes: bytes, end: list[int]) -> list[int]:
    """Least costs from each state to the end, whose costs are given."""
    for code in reversed(codes):
        end = [min([way[0] + end[t] for t, way in enumerate(ways) if way], default=FAR) for ways in steps(code)]
    return end


def ending(state: int | None) -> list[int]:
    """Costs of ending in each state: in this one, or (None) wherever the grammar and last inserts let it."""
    return [cost for cost, _ in TAIL] if state is None else [0 if s == state else FAR for s in STATES]


def crossing(costs: list[int], ranks: list[int], rest: list[int]) -> int:
    """The state of the audit-least cheapest path where both vectors meet."""
    return min(STATES, key=lambda s: (min(costs[s] + rest[s], FAR), ranks[s]) if costs[s] < FAR else (FAR, 9))


@lru_cache(maxsize=1 << 16)
def _short(codes: bytes, begin: int, end: int | None) -> tuple[int, str]:
    return _solved(codes, begin, end)


def solved(codes: bytes, begin: int = 0, end: int | None = None) -> tuple[int, str]:
    """(cost, audit) of the cheapest, audit-least edits of turns from a state to a state; None: to a legal end."""
    return (_short if len(codes) <= 64 else _solved)(codes, begin, end)


def _solved(codes: bytes, begin: int, end: int | None) -> tuple[int, str]:
    if not codes:
        return TAIL[begin] if end is None else (0, "")
    if len(codes) == 1 and end is not None:
        return steps(codes[0])[begin][end]
    half = (len(codes) + 1) // 2
    costs, ranks = forward(codes[:half], begin)
    middle = crossing(costs, ranks, backward(codes[half:], ending(end)))
    left, right = solved(codes[:half], begin, middle), solved(codes[half:], middle, end)
    return left[0] + right[0], left[1] + right[1]


def matrix(codes: bytes) -> list[int]:
    """16 costs and 16 orders, from each state to each state."""
    both = [forward(codes, s) for s in STATES]
    return [c for costs, _ in both for c in costs] + [r for _, ranks in both for r in ranks]


def over(costs: list[int], ranks: list[int], m: list[int]) -> tuple[list[int], list[int]]:
    """A forward vector carried over a part, by its matrix."""
    best = [None] * 4
    for s in STATES:
        for t in STATES:
            if costs[s] < FAR and m[4 * s + t] < FAR:
                new = (costs[s] + m[4 * s + t], ranks[s], m[16 + 4 * s + t])
                if best[t] is None or new < best[t]:
                    best[t] = new
    return ranked(best)


def crossings(parts: list[list[int]], begin: int = 0, end: int | None = None) -> list[int]:
    """The states between the parts of one conversation, by the same divide and conquer over their matrices."""
    if len(parts) < 2:
        return []
    half = len(parts) // 2
    vector, rest = start(begin), ending(end)
    for m in parts[:half]:
        vector = over(*vector, m)
    for m in reversed(parts[half:]):
        rest = [min(min(m[4 * s + t] + rest[t], FAR) for t in STATES) for s in STATES]
    middle = crossing(*vector, rest)
    return crossings(parts[:half], begin, middle) + [middle] + crossings(parts[half:], middle, end)


def coded(rows: DataFrame) -> DataFrame:
    """rows (conv, role, text, seq) with code, blank, duplicate, truncated. Only hashes are shuffled."""
    said = F.rtrim("text", F.lit(BLANKS))
    narrow = rows.select(
        "conv", "turn", "seq", F.xxhash64("role", "text").alias("h"), F.xxhash64(F.lit("second"), "role", "text").alias("g"),
        (~F.col("text").rlike("[^\\x20\\x09-\\x0D]")).alias("blank"), (~F.substring(said, -1, 1).isin(".", "!", "?")).alias("open"),
        F.coalesce(F.array_position(F.array(F.lit("s"), F.lit("u"), F.lit("a")), F.substring("role", 1, 1)), F.lit(0)).alias("initial"))
    firsts = narrow.groupBy("conv", "h", "g").agg(F.min("seq").alias("seq")).select("seq", F.lit(True).alias("first"))
    marked = narrow.join(firsts, "seq", "left").withColumn("duplicate", ~F.col("blank") & F.col("first").isNull())
    marked = marked.withColumn("truncated", F.col("open") & ~F.col("blank") & ~F.col("duplicate"))
    initial = F.when(F.col("initial") == 0, OTHER).otherwise(F.col("initial") - 1)
    code = initial + 4 * (F.col("blank") | F.col("duplicate")).cast("int") + 8 * F.col("truncated").cast("int")
    return marked.select("conv", "turn", "seq", "blank", "duplicate", "truncated", code.cast("int").alias("code"))


def parts(codes: DataFrame) -> DataFrame:
    """A row for each conversation and task that holds some of it: part, codes (turns in order), n (such rows of the conversation)."""
    turns = F.transform(F.array_sort(F.collect_list(F.struct("seq", "code"))), lambda x: x["code"])
    held = codes.groupBy("conv", part_of(F.col("seq")).alias("part")).agg(turns.alias("codes"), F.min("seq").alias("seq"))
    many = held.groupBy("conv").agg(F.count("*").alias("n"))
    return held.join(many, held["conv"].eqNullSafe(many["conv"])).drop(many["conv"])


def illegal(codes: bytes) -> int:
    return sum((a & 3, b & 3) not in LEGAL for a, b in zip(codes, codes[1:]))


@F.arrow_udf(StructType().add("cost", "long").add("audit", "string").add("illegal", "long"))
def solve(codes: pa.Array, begin: pa.Array, end: pa.Array) -> pa.Array:
    out = []
    for c, b, e in zip(codes, begin.to_pylist(), end.to_pylist()):
        c = bytes(c.values.to_pylist())
        cost, audit = solved(c, b, None if e < 0 else e)
        out.append({"cost": cost, "audit": audit, "illegal": illegal(c)})
    return pa.array(out, pa.struct([("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64())]))


@F.arrow_udf(ArrayType(LongType()))
def matrices(codes: pa.Array) -> pa.Array:
    """Matrix, first and last code."""
    each = (bytes(c.values.to_pylist()) for c in codes)
    return pa.array([[*matrix(c), c[0], c[-1]] for c in each], pa.list_(pa.int64()))


def crossed(pdf: pd.DataFrame) -> pd.DataFrame:
    """The states in which each part of one conversation begins and ends (-1: a legal end), and whether the pair of turns
    before the part is illegal."""
    pdf = pdf.sort_values("part")
    found = [list(m) for m in pdf["matrix"]]
    between = crossings(found)
    pairs = [0] + [int((a[-1] & 3, b[-2] & 3) not in LEGAL) for a, b in zip(found, found[1:])]
    return pd.DataFrame({"part": pdf["part"], "seq": pdf["seq"], "begin": [0, *between], "end": [*between, -1], "illegal": pairs})


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """turns (conv, turn, role, text) as three frames: `rows` (conv, seq, turn, role, text; staged), `marks` of each row (conv, seq,
    turn, blank, duplicate, truncated) and `audits`, a row for each conversation and task (conv, part, cost, audit, illegal)."""
    rows = ordered(turns.select("conv", "turn", "role", "text"))
    codes = staged(coded(rows))
    held = staged(parts(codes))
    begin, end = F.lit(0), F.lit(-1)
    whole = held.where("n = 1").select("conv", "part", solve("codes", begin, end).alias("x"), F.lit(0).alias("before"))
    spread = held.where("n > 1")
    if not spread.isEmpty():  # at most as many conversations as tasks
        ways = spread.select("conv", "part", "seq", matrices("codes").alias("matrix")).groupBy("conv").applyInPandas(
            crossed, "part long, seq long, begin int, end int, illegal int")
        ways = ways.select("seq", "begin", "end", F.col("illegal").alias("before"))
        whole = whole.union(spread.join(ways, "seq").select("conv", "part", solve("codes", "begin", "end"), "before"))
    audits = whole.select("conv", "part", "x.cost", "x.audit", (F.col("x.illegal") + F.col("before")).alias("illegal"))
    return rows, codes.drop("code"), staged(audits)


def edited(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired turns in order: conv, seq and place (what follows one another), edit, turn (null: inserted), role, text. Rows
    meet their edits by number; a task's rows and its audits are read side by side, as streams."""
    first = rows.groupBy("conv", part_of(F.col("seq")).alias("part")).agg(F.min("seq").alias("first"))
    of = audits.join(first, audits["conv"].eqNullSafe(first["conv"]) & (audits["part"] == first["part"])).select(
        audits["conv"], "first", "audit")
    # an audit is cut after each turn's edit: piece i belongs to the part's turn i, the rest is inserted at the end
    cut = F.regexp_extract_all("audit", F.lit("I*[KRD]|I+$"), F.lit(0))
    edits = of.select("conv", "first", F.posexplode(cut).alias("at", "edits")).select(
        F.col("conv").alias("c"), (F.col("first") + F.col("at")).alias("s"), "edits")
    tail = F.col("edits").rlike("^I+$")
    own = rows.join(edits.where(~tail), F.col("seq") == F.col("s")).select("conv", "seq", "turn", "role", "text", "edits")
    last = edits.where(tail).select(F.col("c").alias("conv"), (F.col("s") - 1).alias("seq"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
                                    F.lit("").alias("role"), F.lit("").alias("text"), F.regexp_replace("edits", "I", "J").alias("edits"))
    return own.union(last)


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired turns: conv, place, role, text, edit (K, R or I); streams of each conversation's turns in order."""
    def made(batches):
        conv, state, place, columns = None, 0, 0, [[], [], [], [], []]
        roles = {2: "user", 3: "assistant"}
        for b in batches:
            for c, role, text, edits in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if c != conv or not place:
                    conv, state, place = c, 0, 1
                for e in edits:
                    if e == "D":
                        continue
                    state = 1 if e == "K" and state == 0 and role.startswith("s") else NEXT[state]
                    new = (c, place, role if e == "K" else roles[state], "" if e in "IJ" else text, "I" if e == "J" else e)
                    for column, x in zip(columns, new):
                        column.append(x)
                    place += 1
            kind = pa.schema([(b.schema.field(0)), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, kind)], names=["conv", "place", "role", "text", "edit"])
            columns = [[], [], [], [], []]
    turns = edited(rows, audits).select("conv", "seq", "role", "text", "edits")
    kind = rows.schema["conv"].dataType.simpleString()
    # trailing inserts (J) come after the last turn of the same number
    return turns.repartition("conv").sortWithinPartitions("conv", "seq", F.col("edits").startswith("J")).mapInArrow(
        made, f"conv {kind}, place long, role string, text string, edit string")


def digests(turns: DataFrame) -> DataFrame:
    """(conv, sha256) of the turns `role:text`, joined by newlines; each conversation is hashed as a stream."""
    def hashed(batches):
        conv, h, last, kind = None, None, 0, None
        for b in batches:
            kind, convs, out = b.schema.field(0).type, [], []
            for c, place, role, text in zip(*(b.column(i).to_pylist() for i in range(4))):
                if h is None or place <= last or c != conv:
                    if h is not None:
                        convs.append(conv)
                        out.append(h.hexdigest())
                    conv, h = c, hashlib.sha256(f"{role}:{text}".encode())
                else:
                    h.update(f"\n{role}:{text}".encode())
                last = place
            yield pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(out, pa.string())], names=["conv", "sha256"])
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([h.hexdigest()], pa.string())], names=["conv", "sha256"])
    kind = turns.schema["conv"].dataType.simpleString()
    return turns.select("conv", "place", "role", "text").mapInArrow(hashed, f"conv {kind}, sha256 string")


def report(conversations: DataFrame, conv: str = "conv_id", **names: str) -> DataFrame:
    """Of every conversation, damaged and repaired: the faults counted, the cost, the audit and the digest of the repaired turns."""
    rows, marks, audits = repair(damaged(conversations, conv, **names))
    turns = marks.groupBy("conv", "turn").agg(*[F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")])
    counts = turns.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"),
                                       *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    made = audits.groupBy("conv").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"),
                                      F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    every = conversations.select(F.col(conv).alias("conv")).distinct()
    for other in (counts, made, digests(repaired(rows, audits))):
        other = other.withColumnRenamed("conv", "_r_conv")
        every = every.join(other, every["conv"].eqNullSafe(other["_r_conv"]), "left").drop("_r_conv")
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select(F.col("conv").alias(conv), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


#: op13 over the table conversations: costs, audits and repaired turns of every state, turn by turn.
CHECK_SQL = f"""
WITH RECURSIVE given AS (SELECT conv_id AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
       {CRC_SQL.format("coalesce(CAST(conv_id AS varchar), ' ') || ':' || coalesce(CAST(turn AS varchar), ' ')")} % 20 AS fault FROM conversations),
made AS (SELECT c, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role, CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
       unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy FROM given WHERE fault > 0),
x AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i FROM made),
seen AS (SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again,
       right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?') AS open,
       left(role, 1) AS f, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS e FROM x),
turns AS (SELECT *, again AND NOT blank AS duplicate, open AND NOT again AND NOT blank AS truncated FROM seen),
counts AS (SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(CAST(blank AS int)) AS blank, sum(CAST(duplicate AS int)) AS duplicate,
       sum(CAST(truncated AS int)) AS truncated, sum(CASE WHEN i > 1 AND e || f NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END) AS illegal FROM turns GROUP BY c),
ins(b, s, cost, audit, rows) AS (VALUES (0, 0, 0, '', CAST([] AS varchar[])), (0, 2, 3, 'I', ['user:']), (0, 3, 6, 'II', ['user:', 'assistant:']),
       (1, 1, 0, '', []), (1, 2, 3, 'I', ['user:']), (1, 3, 6, 'II', ['user:', 'assistant:']), (2, 2, 0, '', []), (2, 3, 3, 'I', ['assistant:']),
       (3, 3, 0, '', []), (3, 2, 3, 'I', ['user:']), (3, 3, 6, 'II', ['user:', 'assistant:'])),
edit(b, s, k, f, cost) AS (VALUES (0, 0, 'D', '', 4), (1, 1, 'D', '', 4), (2, 2, 'D', '', 4), (3, 3, 'D', '', 4), (0, 2, 'R', '', 3), (1, 2, 'R', '', 3), (2, 3, 'R', '', 3),
       (3, 2, 'R', '', 3), (0, 1, 'K', 's', 0), (0, 2, 'K', 'u', 0), (1, 2, 'K', 'u', 0), (3, 2, 'K', 'u', 0), (2, 3, 'K', 'a', 0)),
way AS (SELECT c, 0 AS i, 0 AS s, {{'cost': 0, 'audit': '', 'rows': CAST([] AS varchar[])}} AS w FROM counts
  UNION ALL
  SELECT way.c, way.i + 1, edit.s, min({{'cost': w.cost + ins.cost + edit.cost + CASE WHEN truncated AND k <> 'D' THEN 3 ELSE 0 END, 'audit': w.audit || ins.audit || k,
         'rows': w.rows || ins.rows || CASE k WHEN 'D' THEN CAST([] AS varchar[]) WHEN 'K' THEN [role || ':' || text] ELSE [CASE edit.s WHEN 3 THEN 'assistant:' ELSE 'user:' END || text] END}})
  FROM way JOIN ins ON ins.b = way.s JOIN turns ON turns.c IS NOT DISTINCT FROM way.c AND turns.i = way.i + 1
       JOIN edit ON edit.b = ins.s AND (k = 'D' OR NOT (blank OR duplicate) AND (k = 'R' OR edit.f = turns.f)) GROUP BY way.c, way.i, edit.s),
best AS (SELECT way.c, min({{'cost': w.cost + ins.cost, 'audit': w.audit || ins.audit, 'rows': w.rows || ins.rows}}) AS w
       FROM way JOIN counts ON counts.c IS NOT DISTINCT FROM way.c AND i = n JOIN ins ON ins.b = way.s AND ins.s IN (0, 3) GROUP BY way.c)
SELECT g.c AS conv_id, CAST(coalesce(gaps, 0) AS bigint) AS gaps, CAST(coalesce(blank, 0) AS bigint) AS blank, CAST(coalesce(duplicate, 0) AS bigint) AS duplicate,
       CAST(coalesce(truncated, 0) AS bigint) AS truncated, CAST(coalesce(illegal, 0) AS bigint) AS illegal, CAST(coalesce(w.cost, 0) AS bigint) AS cost,
       coalesce(w.audit, '') AS audit, sha256(coalesce(array_to_string(w.rows, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT c FROM given) g LEFT JOIN counts ON counts.c IS NOT DISTINCT FROM g.c LEFT JOIN best ON best.c IS NOT DISTINCT FROM g.c
"""
