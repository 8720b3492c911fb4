"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import re
import zlib

import pytest

from daybook.llm import trie
from daybook.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, depth string, conv string"


def expected(rows):
    given = {}
    for c, turn, role, text in (r[:4] for r in rows if r[0] is not None):
        given.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    given = {c: [x[2:] for x in sorted(v)] for c, v in given.items()}
    nodes = {}
    for c, own in given.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = given.get(c - c % 20, [])[:h] + own[h:]
        for d in range(len(whole) + 1):
            nodes.setdefault(tuple(whole[:d]), []).append((c, d == len(whole)))
    out = {}
    children, leaves, saved = {}, {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = leaves.get(p, 0) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p] = saved.get(p, 0) + (len(nodes[p]) - 1) * words
        if p:
            for of, x in ((children, 1), (leaves, leaves[p]), (saved, saved[p])):
                of[p[:-1]] = of.get(p[:-1], 0) + x
    for p, members in nodes.items():
        ends = ",".join(str(c) for c, end in sorted(members) if end)
        row = (min(members)[0], len(p), min(nodes[p[:-1]])[0] if p else None, len(members), children.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest())
        out[row[:2]] = row
    return out


def random_rows(r, convs, most):
    texts = ["Yes.", "No!", "and then  so", "", " \t", None, "a b c d e", "x " * 900]
    return [(c, r.choice([t, t, t, r.randrange(4), None]), r.choice(["user", "assistant", "", None]), r.choice(texts), "k", "l")
            for c in convs for t in range(r.randrange(most))]


def nodes(df):
    got = [tuple(x) for x in df.collect()]
    assert len(got) == len({x[:2] for x in got})
    return {x[:2]: x for x in got}


@pytest.fixture
def many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_queue_spills_in_order():
    r = random.Random(1)
    q, plain, got = trie.SpillingQueue(7), [], []
    for i in range(3000):
        if r.random() < 0.6:
            x = (r.randrange(50), i)
            q.push(x)
            plain.append(x)
        elif plain:
            assert q.least() == min(plain)
            got.append(q.pop())
            plain.remove(got[-1])
    while q.least() is not None:
        got.append(q.pop())
        plain.remove(got[-1])
    assert not plain and q.runs == []


def test_query_equals_plain_trie(spark):
    rows = [tuple(x) for x in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert nodes(QUERIES["op11_prefix_trie"](spark, "/root/testdata/sf0.001")) == expected(rows)


@pytest.mark.parametrize("limit, band, queue", [(1 << 16, 1 << 12, 1 << 18), (9, 64, 3), (3, 2, 2)])
def test_random_tries(spark, many_tasks, limit, band, queue):
    """Light shards only; heavy nodes in one band; heavy nodes in many bands, with queues that spill."""
    r = random.Random(limit)
    rows = random_rows(r, [*range(50), *range(100, 120), None, 7_000_000_001], 8)
    rows += [x for x in rows if x[0] == 3] + [(c, t, "user", f"{t % 3}", "k", "l") for c in (200, 201, 202, 230) for t in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert nodes(trie.trie(*trie.rebuilt(df), limit, band, queue)) == expected(rows)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert trie.trie(*trie.rebuilt(none)).count() == 0
    bare = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 0)
    rows = [(bare, None, None, None, "k", "l")]  # its only turn falls away
    assert nodes(trie.trie(*trie.rebuilt(spark.createDataFrame(rows, SCHEMA)))) == expected(rows)
