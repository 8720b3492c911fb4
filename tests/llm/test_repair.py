"""Repair of conversations against a search over all edits."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from daybook.llm import repair
from daybook.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, conv string"


def brute(rows):
    """(cost, audit, repaired) by a search in order of cost and audit."""
    seen, marks = set(), []
    for role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        mark = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
        marks.append(mark)
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, roles, out = heapq.heappop(heap)
        tail = (i, roles[-1:] or "-")
        if (tail, audit) in done or not re.fullmatch(r"(s?(ua)*u?)?", roles):
            continue
        done.add((tail, audit))
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", roles):
            return marks, cost, audit, "\n".join(out)
        if audit[-3:] != "III":
            for role in ("user", "assistant"):
                heapq.heappush(heap, (cost + 3, audit + "I", i, roles + role[0], out + (role + ":",)))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, roles, out))
            if marks[i] not in ("blank", "duplicate"):
                more = 3 * (marks[i] == "truncated")
                if role[:1] in tuple("sua"):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, roles + role[:1], out + (f"{role}:{text}",)))
                for new in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, roles + new[0], out + (f"{new}:{text}",)))


def expected(rows):
    """rows: (conv, turn, role, text) as given."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = []
        for c, turn, role, text in (r[:4] for r in rows if r[0] == conv):
            role, text = (" " if x is None else x for x in (role, text))
            fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            turns += [(turn is not None, turn or 0, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
        turns.sort()
        marks, cost, audit, made = brute([t[2:] for t in turns])
        numbers = [t[1] for t in turns if t[0]]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        bad = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        out[conv] = (gaps, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), bad, cost, audit, hashlib.sha256(made.encode()).hexdigest())
    return out


def random_rows(r, convs, most):
    texts = ["Yes.", "No!", "and then", "", "  \t", "What? ", "same ", None, "x" * 3000 + "."]
    return [(c, r.choice([t, t, t, t, r.randrange(4), None]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", "s", "", None]),
             r.choice(texts), "k") for c in convs for t in range(r.randrange(most))]


def test_codes_against_all_edits():
    r = random.Random(5)
    for n in range(300):
        codes = bytes(r.choice([0, 1, 2, 3, 5, 9, 10, 8]) for _ in range(r.randrange(7)))
        rows = [(("system", "user", "assistant", "tool")[c & 3], f"{i}" + ("" if c & 8 else ".") if not c & 4 else "") for i, c in enumerate(codes)]
        _, cost, audit, _ = brute(rows)
        assert repair._solved(codes, 0, None) == (cost, audit) == repair.solved(codes)
        # parts joined by their matrices give the same path
        for at in itertools.combinations(range(1, len(codes)), 2):
            pieces = [codes[:at[0]], codes[at[0]:at[1]], codes[at[1]:]]
            between = repair.crossings([repair.matrix(p) for p in pieces])
            got = [repair.solved(p, b, e) for p, b, e in zip(pieces, [0, *between], [*between, None])]
            assert (sum(g[0] for g in got), "".join(g[1] for g in got)) == (cost, audit)


def test_report_equals_brute_force(spark):
    r = random.Random(11)
    rows = random_rows(r, [*range(60), None, 7_000_000_001], 7)
    rows += rows[:3]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {x.conv_id: tuple(x)[1:] for x in repair.report(df).collect()}
    assert got == expected(rows)


@pytest.fixture
def many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_conversation_over_many_tasks(spark, many_tasks):
    r = random.Random(2)
    rows = [(3, t, r.choice(["user", "assistant"]), r.choice(["A.", "B", "C!", f"{t}."]), "k") for t in range(3000)] + random_rows(r, [1, 2, 4, 5], 5)
    turns = repair.damaged(spark.createDataFrame(rows, SCHEMA))
    found, marks, audits = repair.repair(turns)
    spread = audits.where("conv = 3").orderBy("part").collect()
    assert len(spread) > 1
    codes = bytes(x.code for x in repair.coded(found).where("conv = 3").orderBy("seq").collect())
    assert (sum(x.cost for x in spread), "".join(x.audit for x in spread)) == repair.solved(codes)
    assert sum(x.illegal for x in spread) == repair.illegal(codes)
    made = repair.repaired(found, audits).where("conv = 3").orderBy("place").collect()
    assert re.fullmatch("(s?(ua)+)?", "".join(x.role[0] for x in made)) and [x.place for x in made] == list(range(1, len(made) + 1))
    small = [x for x in rows if x[0] != 3]
    got = {x.conv_id: tuple(x)[1:] for x in repair.report(spark.createDataFrame(rows, SCHEMA)).where("conv_id <> 3").collect()}
    assert got == expected(small)


def test_empty_and_dropped(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.report(none).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = repair.report(spark.createDataFrame([(gone, 0, "user", "Hi.", "k")], SCHEMA)).collect()
    assert [tuple(x) for x in row] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_equals_brute_force(spark, sf):
    rows = [tuple(x) for x in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {x.conv_id: tuple(x)[1:] for x in QUERIES["op13_structure_repair"](spark, sf).collect()}
    assert got == expected(rows)
