"""Near-duplicates, neighbours and the pipeline."""

import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from conftest import ODD
from daybook.llm import neardup, neighbours
from daybook.llm.packing import TIERS
from daybook.llm.queries import QUERIES
from pyspark.sql import functions as F


def common_in_order(a, b):
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
    return d[-1][-1]


def test_alignment_is_brute_force():
    r = random.Random(3)
    for _ in range(800):
        a = [r.randrange(8) for _ in range(r.randrange(1, 50))]
        b = list(a)
        for _ in range(r.randrange(8)):
            i, kind = r.randrange(len(b) + 1), r.randrange(3)
            b[i:i + (kind != 1)] = [] if kind == 2 else [r.randrange(8)]
        m = common_in_order(a, b)
        assert neardup.matched(a, b, max(len(a), len(b), 1)) == m
        got, want = neardup.similarity(np.array(a, np.uint64), np.array(b, np.uint64)), m / (len(a) + len(b) - m)
        assert (got >= 0.8) == (want >= 0.8 and bool(b)) and (got < 0.8 or abs(got - want) < 1e-9)


def test_long_alignments_are_brute_force(monkeypatch):
    """The same results where few or no bitmaps are held, also with frequent elements."""
    monkeypatch.setattr(neardup, "NARROW", 10)
    r = random.Random(8)
    for frequent in (2, 5, 40):
        monkeypatch.setattr(neardup, "FREQUENT", frequent)
        for _ in range(150):
            a = [r.choice([0, 0, 0, r.randrange(9), r.randrange(200)]) for _ in range(r.randrange(11, 90))]
            b = [x for x in a if r.random() < 0.95] + [r.randrange(9)]
            m = common_in_order(a, b)
            assert neardup.matched(a, b, max(len(a), len(b))) == m
            got, want = neardup.similarity(np.array(a, np.uint64), np.array(b, np.uint64)), m / (len(a) + len(b) - m)
            assert (got >= 0.8) == (want >= 0.8) and (got < 0.8 or abs(got - want) < 1e-9)


def test_very_long_texts_align_in_bounded_memory():
    n = 300_000
    a = np.random.default_rng(1).integers(0, 1 << 62, n, dtype=np.uint64)
    b = a.copy()
    b[[0, n // 2, n - 1]] = [1, 2, 3]
    tracemalloc.start()
    assert neardup.similarity(a, b) == (n - 3) / (n + 3)
    assert neardup.similarity(a, a[::-1] ^ np.uint64(1)) == 0.0
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20


def test_sketch_sees_order():
    words = [f"w{i}" for i in range(300)]
    r = random.Random(1)
    hit = turned = 0
    for _ in range(200):
        other = list(words)
        for i in r.sample(range(300), 6):
            other[i] = f"q{r.randrange(10**6)}"
        keys = set(neardup.sketch(neardup.shingles(" ".join(words))))
        hit += bool(keys & set(neardup.sketch(neardup.shingles(" ".join(other)))))
        blocks = [words[i:i + 10] for i in range(0, 300, 10)]
        blocks.reverse()
        turned += len(keys & set(neardup.sketch(neardup.shingles(" ".join(sum(blocks, []))))))
    assert hit >= 199 and turned < 200 * neardup.BANDS * 0.2


def classes(rows):
    """Brute force: all pairs of texts, linked by the alignment of their shingles."""
    by = defaultdict(list)
    for i, t, *_ in rows:
        if t is not None:
            by[t].append(i)
    texts = list(by)
    seqs, top = [neardup.shingles(t) for t in texts], list(range(len(texts)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x
    for i in range(len(texts)):
        for j in range(i):
            if neardup.similarity(seqs[i], seqs[j]) >= neardup.SIMILARITY:
                top[root(i)] = root(j)
    ids = defaultdict(list)
    for k, t in enumerate(texts):
        ids[root(k)] += by[t]
    return {t: min((i for i in ids[root(k)] if i is not None), default=None) for k, t in enumerate(texts)}


def test_large_keys_keep_every_link(spark):
    """Groups (more than a block) around cores, far from them, and rearranged: linked texts of different components meet
    in a new key, and near copies that link nothing make few keys."""
    r = random.Random(8)
    core = [f"c{i}" for i in range(80)]

    def edited(words, n):
        words = list(words)
        for _ in range(n):
            words[r.randrange(len(words))] = f"x{r.randrange(10 ** 9)}"
        return words
    other = edited(core, 4)
    texts = [edited(core, 3) for _ in range(60)] + [edited(other, r.randrange(3)) for _ in range(25)] + [core[40:] + core[:40], edited(core[40:] + core[:40], 1)]
    lone = [f"f{i}" for i in range(90)]
    texts += [core[:25] + edited(lone, r.choice([1, 90])) for _ in range(20)]
    seqs = [neardup.shingles(" ".join(t)) for t in texts]
    rows = [(n, n, 0) for n in range(len(texts))]
    members = spark.createDataFrame(rows, "node long, component long, hub long")
    got = neardup.token_groups(members, spark.createDataFrame([(n, " ".join(t)) for n, t in enumerate(texts)], "node long, text string"), 0.8).collect()
    keys = {}
    for x in got:
        keys.setdefault(x.node, set()).add(x.key)
    linked = [(i, j) for i in range(len(texts)) for j in range(i) if neardup.similarity(seqs[i], seqs[j]) >= 0.8]
    assert len(linked) > 100 and all(keys.get(i, set()) & keys.get(j, set()) for i, j in linked)
    lonely = [i for i in range(60) if not any(i in x for x in linked)]
    assert len(lonely) > 10 and sum(len(keys.get(i, ())) for i in lonely) < 3 * len(lonely)


@pytest.mark.parametrize("block", [neardup.BLOCK, 4])
def test_near_duplicates_are_brute_force(spark, odd, block, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", block)
    r = random.Random(9)
    word = lambda: f"w{r.randrange(4000)}"
    rows = list(ODD)
    shared = [word() for _ in range(90)]
    for i in range(100, 160):  # one passage in many documents: same keys, different classes
        rows.append((i, " ".join(shared + [word() for _ in range(r.choice([5, 12, 40]))]), "p"))
    for g in range(12):       # copies, near copies, and chains of near copies
        text = [word() for _ in range(r.choice([3, 40, 200]))]
        for k in range(r.choice([1, 4, 12])):
            rows.append((1000 + 50 * g + k, " ".join(text), "c"))
            if r.random() < 0.8:
                text = list(text)
                for _ in range(max(1, len(text) // 90)):
                    text[r.randrange(len(text))] = word()
    df = spark.createDataFrame(rows, "doc_id long, text string, h string").repartition(3)
    want = classes(rows)
    got = neardup.near_duplicates(df).collect()
    assert len(got) == len(rows) and sorted(x.h or "" for x in got) == sorted(h or "" for *_, h in rows)
    for x in got:
        assert x.class_id == (x.doc_id if x.text is None else want[x.text]), (x.doc_id, x.class_id)
    stay = [x for x in got if x.kept and x.text is not None]
    assert {want[x.text] for x in stay} == set(want.values())
    assert len({(x.doc_id, x.text) for x in stay}) == len(set(want.values())) + 1  # two classes bear the id 9


def test_op6_is_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = classes(rows)
    got = {r.doc_id: r for r in QUERIES["op6_near_duplicates"](spark, "/root/testdata/sf0.001").collect()}
    assert {i: got[i].class_id for i, _ in rows} == {i: want[t] for i, t in rows}
    assert all(r.kept == (r.doc_id == r.class_id) for r in got.values()) and len(set(want.values())) < len(rows)


def test_one_row_of_a_class_stays(spark):
    """Rows that repeat id and text, equal texts without ids, and near copies of repeated rows."""
    long = " ".join(f"w{i}" for i in range(300))
    rows = [(1, long)] * 40 + [(2, long + " more")] * 3 + [(None, long)] * 5 + [(None, "No id here, but a text.")] * 7 + [(3, "")] * 4 + [(None, None)] * 2
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert len(got) == len(rows)
    assert sorted((x.class_id or 0, x.doc_id or 0, x.text or "") for x in got if x.kept) == sorted(
        [(1, 1, long), (0, 0, "No id here, but a text."), (3, 3, ""), (0, 0, ""), (0, 0, "")])


def test_near_duplicates_of_nothing(none, spark):
    assert neardup.near_duplicates(none).count() == 0
    nulls = spark.createDataFrame([(1, None), (1, None), (None, None)], "doc_id long, text string")
    assert sorted(str(tuple(r)) for r in neardup.near_duplicates(nulls).collect()) == sorted(["(1, None, 1, True)"] * 2 + ["(None, None, None, True)"])


def test_components(spark):
    r = random.Random(2)
    chain = [(i, i + 1) for i in range(40)]
    pairs = chain + [(r.randrange(100, 300), r.randrange(100, 300)) for _ in range(150)] + [(500, 500), (600 + 7, 600), (600, 607)]
    top = {x: x for p in pairs for x in p}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x
    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        top[y] = x
    got = {x.node: x.component for x in neardup.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {x: root(x) for x in top if any(x in p and p[0] != p[1] for p in pairs)}
    assert neardup.components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute(ids, v, k):
    out = {}
    for i, q in zip(ids, v):
        if i % 20 == 0:
            total = np.zeros(len(v))
            for c in range(v.shape[1]):
                total += v[:, c] * q[c]
            order = np.lexsort((ids, -total))
            out[int(i)] = [(int(ids[j]), float(total[j])) for j in order if ids[j] != i][:k]
    return out


def test_neighbours_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    want = brute(table["vec_id"].to_numpy(), np.array(table["embedding"].tolist(), dtype=np.float64), 20)
    got = defaultdict(dict)
    for r in QUERIES["op4_neighbours"](spark, "/root/testdata/sf0.1").collect():
        got[r.query_id][r.rank] = (r.vec_id, r.score)
    assert set(got) == set(want) and all(sorted(x) == list(range(1, 21)) for x in got.values())
    hits = sum(len({v for v, _ in got[q].values()} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    true = {(q, v): s for q, x in want.items() for v, s in x}
    assert all(true[q, v] == s for q, x in got.items() for v, s in x.values() if (q, v) in true)
    assert all([x[i] for i in range(1, 21)] == sorted(x.values(), key=lambda p: (-p[1], p[0])) for x in got.values())


def test_neighbours_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "a"), (20, [0.0, 2.0], "b"), (1, [1.0, 1.0], "c"), (2, [1.0, 1.0], "c"), (3, None, "d"), (4, [], "d"), (5, [0.0, 0.0], "d"),
            (6, [nan, 1.0], "d"), (7, [inf, 1.0], "d"), (8, [None, 1.0], "d"), (9, [1.0, 1.0, 1.0], "d"), (None, [1.0, 1.0], "d"), (40, [0.0, 0.0], "d"),
            (1, [1.0, 1.0], "c"), (2, [2.0, 1.0], "z")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = sorted(tuple(r) for r in neighbours.search(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.0), (20, 1, 1, 2.0), (20, 2, 2, 2.0), (20, 3, 0, 0.0)]
    assert neighbours.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    with pytest.raises(TypeError):
        neighbours.search(df.withColumn("vec_id", F.col("vec_id").cast("string")), F.lit(True))


def test_neighbours_with_many_equal_vectors(spark, monkeypatch):
    """A leaf larger than a cell is dealt out, groups of queries are, and ties go to the smaller id."""
    monkeypatch.setattr(neighbours, "CELL", 100)
    monkeypatch.setattr(neighbours, "GROUP", 5)
    r = np.random.default_rng(4)
    v = r.normal(size=(900, 8))
    v[200:700] = v[200]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(3)
    want = brute(np.arange(900), v, 20)
    got = defaultdict(list)
    for x in sorted(neighbours.search(df, F.col("vec_id") % 20 == 0).collect()):
        got[x.query_id].append((x.vec_id, x.score))
    assert set(got) == set(want) and {len(x) for x in got.values()} == {20}
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 20 * len(want)
    assert got[200] == want[200]


def test_a_hot_vector_in_bounded_memory():
    """A full cell of one vector, and as many equal queries as a third of a group."""
    r = np.random.default_rng(5)
    v = np.repeat(r.normal(size=(1, 64)), neighbours.CELL, axis=0)
    v[::100] = r.normal(size=(len(v[::100]), 64))
    v[7] = -v[7]
    there = pd.DataFrame({"vec_id": np.arange(len(v)), "v": list(v), "leaf": 3}).sample(frac=1, random_state=1)
    ids = np.arange(1, 681)
    asked = pd.DataFrame({"query_id": ids, "v": list(v[ids]), "leaves": [[3]] * len(ids)})
    tracemalloc.start()
    got = neighbours.meet(asked, there, 20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 250 << 20 and len(got) == 20 * len(ids)
    by = dict(list(got.groupby("query_id")))
    for i in (1, 7, 15, 100, 680):
        score = sum(v[:, c] * v[i, c] for c in range(64))
        want = [j for j in np.lexsort((np.arange(len(v)), -score)) if j != i][:20]
        assert by[i]["vec_id"].tolist() == want and by[i]["score"].tolist() == score[want].tolist()


def test_cells():
    counts = np.array([5, 5, 250, 3, 3, 99, 1])
    first, parts = neighbours.cells_of(counts, 100)
    assert parts.tolist() == [1, 1, 3, 1, 1, 1, 1] and first.tolist() == [0, 0, 1, 4, 4, 5, 5]


def test_pipeline(spark, docs, odd):
    extra = docs.withColumn("kept", F.lit("mine")).withColumn("spans", F.col("doc_id"))
    rows = extra
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, rows = rows, stage(spark, rows, "").cache()
        assert rows.columns == extra.columns and {r.kept for r in rows.collect()} == {"mine"} and rows.count() <= before.count()
        assert all(r.spans == r.doc_id and r.n_chars == len(r.text) for r in rows.collect())
    final = {r.doc_id for r in rows.collect()}
    packed = corpus_pipeline.packed(spark, rows, "").collect()
    assert {r.doc_id for r in packed} == final and max(r.tier for r in packed) == max(TIERS)
    whole = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in whole} == final and sum(r.length for r in whole) == sum(r.length for r in packed)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, extra.limit(0), "").count() == 0
        stage(spark, odd.withColumn("n_chars", F.lit(1)), "").collect()
