"""Repeated passages against a plain count of all windows."""

import random
import re

import duckdb
import numpy as np

from check import rows
from conftest import ODD
from daybook.llm import passages
from daybook.llm.queries import CHECKS, QUERIES

SF = "/root/testdata/sf0.001"


def brute(docs):
    """docs: (id, text) in order of rows. The kept words and their number, by row."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0, i))
    seen, out = set(), {}
    for i in order:
        w = re.findall(r"[^\x20\x09-\x0D]+", docs[i][1] or "")
        gone = set()
        for s in range(len(w) - passages.WINDOW + 1):
            window = tuple(w[s:s + passages.WINDOW])
            if window in seen:
                gone |= set(range(s, s + passages.WINDOW))
            seen.add(window)
        out[i] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return out


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = QUERIES["op12_substring_dedup"](spark, SF)
    res = con.execute(CHECKS["op12_substring_dedup"])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows([c[0] for c in res.description], res.fetchall())


def test_random_texts_against_all_windows(spark):
    r = random.Random(4)
    shared = [[f"s{i}w{j}" for j in range(r.randrange(18, 60))] for i in range(6)]
    docs = []
    for i in range(120):
        words = []
        for _ in range(r.randrange(6)):
            words += r.choice(shared) if r.random() < 0.5 else [r.choice("abc") for _ in range(r.randrange(40))]
            words += [f"u{r.randrange(10**9)}"] * r.choice([0, 1, 25, 50])
        docs.append((i % 100 if r.random() < 0.95 else None, "".join(w + r.choice([" ", "\n", "\t ", "\x0b"]) for w in words), i))
    df = spark.createDataFrame(docs, "id long, text string, n_words long").repartitionByRange(3, "n_words")
    got = {(x.id, x.text): x for x in passages.without_repeats(df.withColumnRenamed("n_words", "place"), "id").collect()}
    place = {x.place: (x.n_words, x.n_removed, x.kept) for x in passages.without_repeats(df.withColumnRenamed("n_words", "place"), "id").collect()}
    want = brute([d[:2] for d in docs])
    # rows of one id, or none, go by their order in the table
    assert {i: v for i, v in place.items()} == want and len(got) <= len(docs)
    assert {x.n_words for x in passages.without_repeats(df, "id").collect()} == {v[0] for v in want.values()}


def test_periodic_text_and_pieces(spark, monkeypatch):
    text = " ".join(["tick tock"] * 60 + [f"x{i}" for i in range(90)] + ["tick tock"] * 40)
    hash_of = passages.words(text.encode())
    monkeypatch.setattr(passages, "PIECE", 64)
    assert np.array_equal(passages.words(text.encode()), hash_of)
    found = {int(at): (int(a), int(b)) for _, first, second, begin in passages.windows(text.encode()) for at, (a, b) in enumerate(zip(first, second), begin)}
    monkeypatch.undo()
    _, first, second, _ = next(passages.windows(text.encode()))
    assert found == {i: (int(a), int(b)) for i, (a, b) in enumerate(zip(first, second))}
    df = spark.createDataFrame([(1, text), (2, text[4:]), (2, text), (3, None)], "doc_id long, text string").coalesce(1)
    got = sorted((x.n_words, x.n_removed, x.kept) for x in passages.without_repeats(df).collect())
    assert got == sorted(brute([(1, text), (2, text[4:]), (2, text), (3, None)]).values())


def test_odd_rows(spark, odd, none):
    got = passages.without_repeats(odd).collect()
    assert len(got) == len(ODD) and sorted(str(x.h) for x in got) == sorted(str(h) for *_, h in ODD)
    assert sorted((x.n_words, x.n_removed) for x in got) == sorted(v[:2] for v in brute([o[:2] for o in ODD]).values())
    assert passages.without_repeats(none).count() == 0 and passages.without_repeats(none).columns[-3:] == ["n_words", "n_removed", "kept"]
