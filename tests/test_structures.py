"""Digest trees, lots, account intervals, rates, two-level balances and connected transactions against plain Python."""

import datetime as dt
import random
import re
from collections import Counter, defaultdict
from decimal import Decimal

import pytest

from daybook.operators import connected, conversion, drift, lots, snapshots, temporal, validity
from daybook.sources.workspace import Workspace

DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def test_drift_equals_full_comparison(spark, tmp_path):
    r = random.Random(3)
    files = ["/a.dir", "/b.dir", "/c.dir", None]
    source = [(r.choice(files), r.choice([day(r.randrange(1100)), day(1), None]), f"h{r.randrange(300)}") for _ in range(900)]
    stored = [x for x in source if r.random() > 0.02] + [(f, d, "late") for f, d, _ in source[:4]] + source[7:9]
    frame = lambda rows: spark.createDataFrame(rows, "source_file string, date date, content_hash string")
    # stored in three batches, one of them written again after an attempt that held something else
    for i in range(3):
        drift.add_batch(frame(stored[:5]), str(tmp_path / "tree"), i)
        drift.add_batch(frame(stored[i::3]), str(tmp_path / "tree"), i)
    tree = drift.stored_tree(spark, str(tmp_path / "tree"))
    assert sorted(map(str, tree.collect())) == sorted(map(str, drift.leaves(frame(stored)).collect()))
    year = lambda d: d and d.year
    a, b = (Counter((f, year(d), h) for f, d, h in rows) for rows in (source, stored))
    off = {k: (a[k], b[k]) for k in a | b if a[k] != b[k]}
    per = lambda c, f, y: sum(n for (g, z, _), n in c.items() if (g, z) == (f, y))
    got = {(x.source_file, x.year): (x.n_source, x.n_stored) for x in drift.drift(drift.leaves(frame(source)), tree, ["source_file", "year"]).collect()}
    assert got == {(f, y): (per(a, f, y), per(b, f, y)) for f, y, _ in off}
    nodes = drift.drift(drift.leaves(frame(source)), tree)
    rows = {(x.source_file, x.year, x.content_hash): (x.n_source, x.n_stored) for x in drift.drifted_rows(frame(source), frame(stored), nodes).collect()}
    assert rows == off
    assert drift.drift(tree, tree).isEmpty() and drift.drifted_rows(frame(source), frame(stored), nodes.limit(0)).isEmpty()
    assert drift.drift(tree, tree.limit(0), ["source_file"]).count() == len(files)


def test_drift_reads_only_years_that_differ(spark, tmp_path):
    rows = spark.createDataFrame([("/a.dir", day(366 * i), f"h{i}") for i in range(6)], "source_file string, date date, content_hash string")
    rows.selectExpr("*", "year(date) AS year").write.partitionBy("year").parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    source = rows.where("content_hash <> 'h2'")
    nodes = drift.drift(drift.leaves(source), drift.leaves(stored))
    assert drift.years_of(nodes) == [2026]
    found = drift.drifted_rows(source, stored, nodes)
    assert [tuple(x) for x in found.collect()] == [("/a.dir", 2026, "h2", 0, 1)]


def fifo(rows):
    """Matches, open lots and gains by a plain loop over (account, commodity, date, id, idx, amount, cost, price)."""
    matches, left, gains = [], [], {}
    keys = {r[:2] for r in rows}
    for key in keys:
        own = sorted((r for r in rows if r[:2] == key and r[5] and r[6] is not None), key=lambda r: (r[2], r[3], r[4]))
        buys = [[r, r[5]] for r in own if r[5] > 0]
        for s in (r for r in own if r[5] < 0):
            want, price, cost, proceeds = -s[5], s[7] if s[7] is not None else s[6], Decimal(0), Decimal(0)
            for b in buys:
                q = min(want, b[1])
                if q > 0:
                    matches.append((*key, b[0][3], b[0][4], s[3], s[4], q))
                    b[1], want, cost, proceeds = b[1] - q, want - q, cost + q * b[0][6], proceeds + q * price
            gains[(*key, s[3], s[4])] = (-s[5], want, cost, proceeds, proceeds - cost)
        left += [(*key, b[0][3], b[0][4], q, q * b[0][6]) for b, q in ((b, b[1]) for b in buys) if q > 0]
    return matches, left, gains


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_lots_equal_a_plain_loop(spark, block):
    r = random.Random(block)
    rows = []
    for i in range(400):
        hot = r.random() < 0.6
        account, commodity = ("A:Hot", "X") if hot else (r.choice(["A:B", "A:C", "A:D"]), r.choice("XYZ"))
        amount = Decimal(r.choice([1, 2, 3, 10, 250, Decimal("0.0001"), Decimal("7.5")])) * r.choice([1, 1, -1])
        rows.append((account, commodity, day(r.randrange(5 if hot else 40)), f"t{i:04d}", r.randrange(3), r.choice([amount] * 9 + [Decimal(0)]),
                     r.choice([Decimal("12.5"), Decimal("0.0003"), Decimal(99), None]), r.choice([None, Decimal("13.25")])))
    schema = ("account string, currency string, date date, external_id string, posting_idx int, amount decimal(19,4), cost_amount decimal(19,4), "
              "price_amount decimal(19,4)")
    df = spark.createDataFrame(rows, schema).repartition(3)
    matches, left, gains = fifo(rows)
    got = lots.matches(df, block).select("account", "commodity", "buy_id", "buy_idx", "sell_id", "sell_idx", "quantity").collect()
    assert sorted(map(tuple, got)) == sorted(matches) and len(got) > 50
    got = lots.open_lots(df).select("account", "commodity", "external_id", "posting_idx", "units", "basis").collect()
    assert sorted(map(tuple, got)) == sorted(left)
    got = {(x.account, x.commodity, x.external_id, x.posting_idx): (x.quantity, x.uncovered, x.cost, x.proceeds, x.gain) for x in lots.realised_gains(df, block).collect()}
    assert got == gains
    assert lots.matches(df.limit(0)).isEmpty() and lots.open_lots(df.where("amount < 0")).isEmpty()


def test_intervals_and_uses_outside(spark):
    r = random.Random(6)
    accounts = [f"A:{i}" for i in range(25)]
    life = [(r.choice(accounts[:20]), day(r.randrange(60)), r.choice(["open", "open", "close"])) for _ in range(110)]
    uses = [(r.choice(accounts), day(r.randrange(60)), i) for i in range(400)] + [(None, day(1), 900), ("A:1", None, 901)]
    intervals, bad = defaultdict(list), {}
    for account in accounts:
        state, opened = "none", False
        for n in range(60):
            kinds = [k for a, d, k in life if (a, d) == (account, day(n))]
            here = state == "open" or "open" in kinds
            if "open" in kinds and state != "open":
                intervals[account].append([day(n), None])
            for i in (i for a, d, i in uses if (a, d) == (account, day(n)) and not here):
                bad[i] = "never opened" if not any(a == account and k == "open" for a, _, k in life) else "after close" if opened else "before open"
            opened = opened or "open" in kinds
            if "close" in kinds:
                if here:
                    intervals[account][-1][1] = day(n)
                state = "closed"
            elif "open" in kinds:
                state = "open"
    given = spark.createDataFrame(life, "account string, date date, kind string")
    got = defaultdict(list)
    for x in validity.account_intervals(given).orderBy("account", "n").collect():
        assert x.n == len(got[x.account]) + 1
        got[x.account].append([x.open_date, x.close_date])
    assert got == {a: v for a, v in intervals.items() if v}
    rows = validity.outside(given, spark.createDataFrame(uses, "account string, date date, place int")).collect()
    assert {x.place: x.reason for x in rows} == bad and len(rows) == len(bad) and len(set(bad.values())) == 3
    assert validity.outside(given.limit(0), spark.createDataFrame(uses, "account string, date date, place int")).count() == 400


def test_no_range_join_or_wide_window(spark):
    """Lots and verdicts are found by equality, sorting and windows."""
    df = spark.createDataFrame([("A", "X", DAY, "t", 0, Decimal(1), Decimal(1), None)],
                               "account string, currency string, date date, external_id string, posting_idx int, amount decimal(19,4), cost_amount decimal(19,4), price_amount decimal(19,4)")
    life = spark.createDataFrame([("A", DAY, "open")], "account string, date date, kind string")
    for plan in (lots.matches(df), validity.outside(life, df.select("account", "date"))):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_lots_of_a_hot_key_are_spread(spark):
    """No join or shuffle of trades by their key alone, which would bring a key's trades together in one task."""
    df = spark.createDataFrame([("A", "X", day(i % 3), f"t{i:03d}", 0, Decimal(1 if i % 2 else -1), Decimal(1), None) for i in range(200)],
                               "account string, currency string, date date, external_id string, posting_idx int, amount decimal(19,4), cost_amount decimal(19,4), price_amount decimal(19,4)")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")    # as with many keys
        for out in (lots.matches(df, 4), lots.open_lots(df), lots.realised_gains(df, 4)):
            text = out._jdf.queryExecution().executedPlan().toString()
            assert not re.search(r"Join \[account#\d+, (commodity|currency)#\d+\],", text)
        assert re.search(r"hashpartitioning\(account#\d+, \w+#\d+, block#\d+L", text)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_rates_equal_all_paths(spark):
    """Every path of at most three quotes, as of every day, by a plain recursion."""
    r = random.Random(8)
    names = ["A", "B", "C", "D", "E", "USD"]
    quotes = [(r.choice(names), r.choice(names[1:]), day(r.randrange(12)), r.choice([None, Decimal(r.randrange(1, 90)) / 8]), i) for i in range(60)]
    quotes += [("X", "Y", day(0), Decimal(2), 90), ("Y", "X", day(0), Decimal(3), 91), (None, "USD", day(0), Decimal(1), 92), ("Z", None, day(0), Decimal(1), 93)]
    prices = spark.createDataFrame(quotes, "commodity string, price_currency string, date date, price_amount decimal(19,4), seq long")
    held = [(c, day(n), Decimal(n + 1)) for c in [*names, "X", "Z", None] for n in range(0, 14, 3)] + [("A", day(3), Decimal(4)), ("A", None, Decimal(1))]

    def edges(at, on):
        last = {}
        for c, to, d, x, seq in sorted(quotes, key=lambda q: (q[2], q[4])):
            if c == at and to not in (None, c) and x is not None and d <= on:
                last[to] = (d, float(x))
        return last

    def paths(at, on, steps, rate):
        if at == "USD":
            yield len(steps), steps, rate
        elif len(steps) < conversion.DEPTH:
            for to, (d, x) in edges(at, on).items():
                yield from paths(to, on, [*steps, (-d.toordinal(), to)], rate * x)

    want = []
    for c, d, q in held:
        hops, _, rate = min(paths(c, d, [], 1.0), default=(None, None, None)) if c and d else (None, None, None)
        want.append((c, d, q, hops, rate, rate and float(q) * rate))
    frame = spark.createDataFrame(held, "commodity string, date date, quantity decimal(19,4)")
    got = [tuple(x) for x in conversion.value_in(frame, prices, "USD").select("commodity", "date", "quantity", "hops", "rate", "value").collect()]
    assert sorted(map(str, got)) == sorted(str((c, d, q.quantize(Decimal("0.0001")), *x)) for c, d, q, *x in want)
    assert {x[3] for x in want} >= {None, 0, 1, 2} and conversion.value_in(frame.limit(0), prices, "USD").isEmpty()
    assert {x.hops for x in conversion.value_in(frame, prices.limit(0), "USD").collect()} == {None, 0}


POSTED = "account string, currency string, date date, amount decimal(19,4)"


def test_month_balances_are_plain_sums(spark, tmp_path):
    r = random.Random(12)
    accounts = ["Assets", "Assets:Bank", "Assets:Bank:Checking", "Assets:Bank2", "Income:Job", None]
    rows = [(r.choice(accounts), r.choice(["USD", "EUR", None]), r.choice([day(r.randrange(-500, 500)), day(0), None]), Decimal(r.randrange(-9999, 9999)) / 100)
            for _ in range(700)]
    frame = lambda some: spark.createDataFrame(some, POSTED)
    folder = str(tmp_path / "months")
    # three batches, one written again after an attempt that held something else, and one without rows
    snapshots.add_batch(frame(rows[:9]), folder, 1)
    for i in range(3):
        snapshots.add_batch(frame(rows[i::3]), folder, i)
    snapshots.add_batch(frame([]), folder, 3)
    m = snapshots.stored_months(spark, folder)
    known = [x for x in rows if None not in x]
    posted = frame(rows)

    own = {(x.account, x.currency, x.month): (x.change, x.balance) for x in snapshots.closing_balances(m).collect()}
    first = {(a, c, d.replace(day=1)) for a, c, d, _ in known}
    total = lambda keep: sum((x[3] for x in known if keep(*x[:3])), Decimal(0))
    assert own == {(a, c, f): (total(lambda b, e, d: (b, e, d.replace(day=1)) == (a, c, f)), total(lambda b, e, d: (b, e) == (a, c) and d.replace(day=1) <= f))
                   for a, c, f in first}

    for at in (day(0), day(-1), day(30), day(-900), day(900)):
        got = {(x.account, x.currency): x.balance for x in snapshots.balances_as_of(m, posted, at).collect()}
        assert got == {(a, c): total(lambda b, e, d: (b, e) == (a, c) and d <= at) for a, c in {x[:2] for x in known if x[2] <= at}}

    wanted = [(r.choice(accounts + ["Nowhere"]), r.choice(["USD", "EUR", None]), r.choice([day(r.randrange(-520, 520)), day(0), day(0).replace(month=2), None])) for _ in range(120)]
    wanted += wanted[:10]
    asked = spark.createDataFrame(wanted, "account string, currency string, date date")
    got = [tuple(x) for x in snapshots.opening_balances(m, posted, asked).collect()]
    below = lambda name, top: name == top or name.startswith(top + ":")
    assert sorted(got) == sorted((a, c, at, total(lambda b, e, d: below(b, a) and e == c and d < at)) for a, c, at in {w for w in wanted if None not in w})
    dated = posted.where("date IS NOT NULL")
    assert sorted(got) == sorted(tuple(x) for x in temporal.opening_balances(dated, asked.dropna()).collect())

    none = frame([])
    assert snapshots.closing_balances(m.limit(0)).isEmpty() and snapshots.balances_as_of(m.limit(0), none, day(0)).isEmpty()
    assert snapshots.opening_balances(m, posted, asked.limit(0)).isEmpty()
    assert {x.computed for x in snapshots.opening_balances(m.limit(0), none, asked).collect()} == {Decimal(0)}


def test_a_correction_is_a_batch_of_negated_rows(spark, tmp_path):
    rows = [("Assets:Bank", "USD", day(i), Decimal(i + 1)) for i in range(40)]
    folder = str(tmp_path / "months")
    snapshots.add_batch(spark.createDataFrame(rows, POSTED), folder, 0)
    snapshots.add_batch(spark.createDataFrame([(a, c, d, -x) for a, c, d, x in rows[:5]], POSTED), folder, 1)
    m = snapshots.closing_balances(snapshots.stored_months(spark, folder))
    assert [x.balance for x in m.orderBy("month").collect()] == [sum(range(6, 32)), sum(range(6, 41))]


def test_balances_read_the_years_asked_for(spark, tmp_path):
    rows = spark.createDataFrame([("Assets:Bank", "USD", day(200 * i), Decimal(i)) for i in range(12)], POSTED)
    rows.selectExpr("*", "year(date) AS year").write.partitionBy("year").parquet(str(tmp_path / "p"))
    stored, m = spark.read.parquet(str(tmp_path / "p")), snapshots.months(rows)
    asked = spark.createDataFrame([("Assets", "USD", day(800))], "account string, currency string, date date")
    for found, answer in ((snapshots.opening_balances(m, stored, asked), 0 + 1 + 2 + 3), (snapshots.balances_as_of(m, stored, day(800)), 0 + 1 + 2 + 3 + 4)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        scan = plan[plan.index("PartitionFilters"):]
        assert "year#" in scan[:scan.index("PushedFilters")] and "2026" in scan[:scan.index("PushedFilters")]
        assert [x[-1] for x in found.collect()] == [answer]


def joined(rows):
    """Components by union and find."""
    top = {}

    def root(x):
        while top.setdefault(x, x) != x:
            top[x] = x = top[top[x]]
        return x
    for t, link in rows:
        if t is not None and link is not None:
            a, b = root(("t", t)), root(("l", link))
            top[a] = b
    members = defaultdict(list)
    for t in {t for t, link in rows if t is not None and link is not None}:
        members[root(("t", t))].append(t)
    return {t: min(m) for m in members.values() for t in m}


TIES = "external_id string, link string"


def test_components_equal_union_and_find(spark):
    r = random.Random(21)
    ids = [f"{r.randrange(10 ** 6)}" for _ in range(700)] + ["", "a" * 3000]
    for width in (300, 900):     # dense and sparse
        rows = [(r.choice(ids), f"l{r.randrange(width)}") for _ in range(700)]
        rows += rows[:20] + [(None, "l1"), (None, "l2"), ("lonely", None), ("alone", "own"), ("", "l3")]
        rows += [(f"hot{i}", "everyone") for i in range(400)] + [("hot7", "l5")]
        names = [f"c{r.randrange(10 ** 6):06}" for _ in range(90)]        # a long chain in no order
        rows += [(n, f"step{i + j}") for i, n in enumerate(names) for j in (0, 1)]
        got = connected.components(spark.createDataFrame(rows, TIES)).collect()
        want = joined(rows)
        assert {x.external_id: x.component for x in got} == want and len(got) == len(want)
    assert connected.components(spark.createDataFrame([], TIES)).isEmpty()
    assert connected.components(spark.createDataFrame([(None, "a"), ("b", None)], TIES)).isEmpty()


def test_component_totals(spark):
    ties = spark.createDataFrame([("1", "a"), ("2", "a"), ("2", "b"), ("3", "b"), ("4", "c"), ("5", "c")], TIES)
    posted = spark.createDataFrame([("1", "USD", Decimal(5)), ("1", "USD", Decimal(-5)), ("3", "USD", Decimal(2)), ("2", "EUR", Decimal(-1)),
                                    ("4", "USD", Decimal(1)), ("9", "USD", Decimal(8))], "external_id string, currency string, amount decimal(19,4)")
    got = connected.component_totals({"transaction_links": ties, "postings": posted}).collect()
    assert sorted(map(tuple, got)) == [("1", 3, "EUR", 1, None), ("1", 3, "USD", 2, Decimal(7)), ("4", 2, "USD", 1, Decimal(1))]


def test_a_link_makes_rows_not_pairs(spark, tmp_path):
    """What is staged grows with the rows of a hot link, not with their square."""
    work = Workspace(spark, "ties")
    sizes, stage = [], work.stage
    work.stage = lambda df, name, *by: (lambda out: sizes.append(out.count()) or out)(stage(df, name, *by))
    n = 3000
    rows = spark.range(n).selectExpr("CAST(id AS string) AS external_id", "'all' AS link")
    assert connected.components(rows, work).select("component").distinct().count() == 1
    assert max(sizes) <= n


def test_gains_move_no_pairs_and_keep_odd_sales(spark):
    """Sales of one id share what covers them; without account or id nothing does, and equal ones stay apart."""
    day = lambda n: None if n is None else dt.date(2024, 1, n)
    rows = [("A", "C", 2, "b1", 0, 11, 2, None), ("A", "C", 1, None, 0, -1, 9, 9), ("A", "C", 3, "s1", 0, -4, 9, 3), ("A", "C", 4, "s1", 0, -3, 9, 4),
            ("A", "C", 5, "s2", 0, -5, 9, 5), (None, "C", 3, "x", 0, -6, 9, 7), (None, "C", 3, "x", 0, -6, 9, 7)]
    p = spark.createDataFrame([(a, c, day(n), *r) for a, c, n, *r in rows], "account string, currency string, date date, external_id string, posting_idx int, amount int, "
                              "cost_amount int, price_amount int")
    p = p.selectExpr("account", "currency", "date", "external_id", "posting_idx", *[f"CAST({c} AS decimal(19,4)) AS {c}" for c in ("amount", "cost_amount", "price_amount")])
    want = sorted(map(str, [(None, 1, 1, 0, 0, 0), ("s1", 4, -3, 14, 24, 10), ("s1", 3, -4, 14, 24, 10), ("s2", 5, 2, 6, 15, 9), ("x", 6, 6, 0, 0, 0), ("x", 6, 6, 0, 0, 0)]))
    for block in (1, 2, lots.BLOCK):
        gains = lots.realised_gains(p, block)
        found = gains.select("external_id", *[gains[c].cast("int") for c in ("quantity", "uncovered", "cost", "proceeds", "gain")]).collect()
        assert sorted(str(tuple(r)) for r in found) == want
    text = gains._jdf.queryExecution().executedPlan().toString()
    assert text.count("Join") == 1 and "buy_id" not in text
