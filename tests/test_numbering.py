import random
from collections import defaultdict

from pyspark.sql import functions as F

from daybook.operators.numbering import assign_ids, first_by_key, number_groups, number_runs
from daybook.operators.transactions import collision_ids, id_stats, kept_dup_ids


def sample(seed, n=400):
    """Keys of which one holds a third of all rows; order values with gaps of any size."""
    r = random.Random(seed)
    orders = r.sample(range(0, 5000), n // 2) + [r.randrange(2 ** 40, 2 ** 62) for _ in range(n - n // 2)]
    return [("hot" if r.random() < 0.34 else f"k{r.randrange(60)}", o) for o in dict.fromkeys(orders)]


def expected(rows, least=1):
    groups = defaultdict(list)
    for k, o in rows:
        groups[k].append(o)
    return {(k, o, i) for k, os in groups.items() if len(os) >= least for i, o in enumerate(sorted(os), 1)}


def test_number_groups_splits_hot_groups(spark):
    for seed in range(3):
        rows = sample(seed)
        df = spark.createDataFrame(rows, "k string, o bigint").repartition(5)
        for bits in (3, 20):
            got = {tuple(r) for r in number_groups(df, "k", "o", run_bits=bits).collect()}
            assert got == expected(rows)
        got = {tuple(r) for r in number_groups(df, "k", "o", least=2, run_bits=3).collect()}
        assert got == expected(rows, 2)


def test_number_runs_without_keys(spark):
    rows = sample(7)
    df = spark.createDataFrame(rows, "k string, o bigint")
    got = {(r.o, r.n) for r in number_runs(df, [], "o", run_bits=4).collect()}
    assert got == {(o, i) for i, o in enumerate(sorted(o for _, o in rows), 1)}


def test_null_keys_take_no_part(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, o bigint")
    assert [tuple(r) for r in number_groups(df, "k", "o").collect()] == [("a", 3, 1)]


def test_first_by_key(spark):
    rows = sample(3)
    df = spark.createDataFrame(rows, "k string, o bigint")
    got = {tuple(r) for r in first_by_key(df, "k", "o").collect()}
    assert got == {(k, o) for k, o, n in expected(rows) if n == 1}


def test_assign_ids_is_dense_and_repeatable(spark):
    df = spark.createDataFrame([(f"name{i}",) for i in range(500)], "name string")
    a = {r.name: r.id for r in assign_ids(df.repartition(7), "name", 10).collect()}
    b = {r.name: r.id for r in assign_ids(df.repartition(2), "name", 10).collect()}
    assert a == b and sorted(a.values()) == list(range(11, 511))


def test_kept_duplicates_are_numbered_apart(spark):
    df = spark.createDataFrame([("h", 1, True), ("h", 2, False), ("h", 3, True), ("h", 4, False), ("g", 5, True)],
                               "base string, seq bigint, kept boolean")
    got = {r.seq: r.external_id for r in kept_dup_ids(df, "base", "seq", "kept").collect()}
    assert got == {1: "h-dup-1", 2: "h", 3: "h-dup-2", 4: "h-2", 5: "g-dup-1"}


def test_collisions_and_stats(spark):
    df = spark.createDataFrame([("h", 9), ("h", 2), ("g", 5), ("h", 7)], "base string, seq bigint")
    assert {r.seq: r.external_id for r in collision_ids(df, "base", "seq").collect()} == {2: "h", 7: "h-2", 9: "h-3", 5: "g"}
    assert tuple(id_stats(df, "base").collect()[0]) == (4, 1, 3)
    assert tuple(id_stats(df.limit(0), "base").collect()[0]) == (0, 0, 0)
    assert df.filter(F.lit(False)).count() == 0
