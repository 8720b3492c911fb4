"""Prefix trie of conversations; totals of subtrees by time-forward processing.

A node is a distinct sequence of first turns. Sequences are told apart by polynomial hashes (two, modulo 2^61 - 1) that
can be carried on from any place: turns lie in ranges over tasks, a task hashes its own part of a conversation, and the few
conversations that span tasks get what came before from a table with a row for each of their tasks.

Totals go from children to parents. Nodes are sorted in reverse level order (Spark's sort, which spills); each node takes the
messages that are due to it from a priority queue, adds its own, and puts one for its parent there, which comes later. The
queue spills sorted runs. It is done in three steps:
- shards: a subtree of which the members' turns number at most LIMIT is a light one; light subtrees are spread over
  tasks, and each task sweeps its own with a queue of its own;
- the roots of light subtrees send their totals to the heavy nodes above, added up per parent before they move;
- heavy nodes (few: each holds more than LIMIT turns) are sharded by bands of levels. One band is one sweep. With more, each
  shard's own total goes up a trie of shard roots, and the shards are swept again with the totals of those below.

Defined results: null roles and texts are empty; null turns come first; turns of one number go by role and text; rows without
a conversation id take no part; repeated rows are turns of their own; other columns are dropped; no rows give no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stage import staged
from .turns import crc, ordered, positions

P = (1 << 61) - 1
BASES = (0x1B873593CC9E2D51 % P, 0x0F3779B97F4A7C15 % P)
LIMIT = 1 << 16          # turns of a light subtree's members
BAND = 1 << 12           # levels of heavy nodes that are swept together
QUEUE = 1 << 18          # messages held in memory before a run is spilled
RUN = 1 << 10            # messages of a run read at a time


class SpillingQueue:
    """A priority queue of tuples. Beyond `limit` entries all are sorted and written as a run to a file of the task's
    own, which has no name and goes with the task; runs are merged when they are read."""

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.runs = limit, [], []

    def push(self, entry: tuple) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        self.heap.sort()
        run = tempfile.TemporaryFile()
        for at in range(0, len(self.heap), RUN):
            pickle.dump(self.heap[at:at + RUN], run, pickle.HIGHEST_PROTOCOL)
        run.seek(0)
        self.heap = []
        entries = self._read(run)
        heapq.heappush(self.runs, (next(entries), len(self.runs), entries))

    @staticmethod
    def _read(run) -> Iterator[tuple]:
        with run:
            while True:
                try:
                    yield from pickle.load(run)
                except EOFError:
                    return

    def least(self) -> tuple | None:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            return self.runs[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            first, number, entries = self.runs[0]
            following = next(entries, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, number, entries))
            return first
        return heapq.heappop(self.heap)


def rebuilt(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings: c begins with the first h turns of conversation c - c % 20, its own first h
    turns fall away; h is the CRC-32 of c modulo 4. Gives turns (conv, depth, t1, t2, words, length) and all conversations
    (conv, length). Texts are read once, for hashes and words, and not shuffled."""
    rows = conversations.select(F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                                F.coalesce(F.col(text), F.lit("")).alias("text")).where("conv IS NOT NULL")
    rows = rows.withColumns({"t1": F.xxhash64("role", "text"), "t2": F.xxhash64(F.lit("second"), "role", "text"),
                             "words": F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")})
    rows = staged(positions(ordered(rows, "conv", "t1", "t2", "words")))
    counts = rows.groupBy("conv").agg(F.max("n").alias("n"))
    convs = counts.select("conv", "n", (crc(F.col("conv").cast("string")) % 4).alias("h"), (F.col("conv") - F.col("conv") % 20).alias("base"))
    of = counts.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(of, "base", "left").withColumn("shared", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = staged(convs.withColumn("length", F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).select("conv", "base", "h", "shared", "length"))
    own = rows.join(convs, "conv").where("pos > h").withColumn("depth", F.col("pos") - F.col("h") + F.col("shared"))
    first = rows.where("pos <= 3").withColumnRenamed("conv", "base").join(convs, "base").where("pos <= h").withColumn("depth", F.col("pos"))
    names = ["conv", "depth", "t1", "t2", "words", "length"]
    return own.select(*names).union(first.select(*names)), convs.select("conv", "length")


def chained(rows: DataFrame) -> DataFrame:
    """rows (conv, depth, t1, t2, ...), sorted over ranges, with the hashes `a` of the conversation's turns in this task up
    to the row, `b` up to the row before, and k, their number."""
    def hashed(batches):
        conv, a, k = None, (0, 0), 0
        for batch in batches:
            out = [[], [], [], [], []]
            for c, t1, t2 in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if c != conv:
                    conv, a, k = c, (0, 0), 0
                b, a, k = a, ((a[0] * BASES[0] + t1 % (P - 1) + 1) % P, (a[1] * BASES[1] + t2 % (P - 1) + 1) % P), k + 1
                for column, x in zip(out, (*a, *b, k)):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(x, pa.int64()) for x in out]],
                                             names=[*batch.schema.names, "a1", "a2", "b1", "b2", "k"])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(hashed, f"{kinds}, a1 long, a2 long, b1 long, b2 long, k long")


def carried(pdf: pd.DataFrame) -> pd.DataFrame:
    """What came before each task's part of one conversation."""
    pdf, s, out = pdf.sort_values("part"), (0, 0), []
    for a1, a2, k in zip(pdf["a1"], pdf["a2"], pdf["k"]):
        out.append(s)
        s = tuple((s[i] * pow(BASES[i], int(k), P) + int(a)) % P for i, a in enumerate((a1, a2)))
    return pd.DataFrame({"conv": pdf["conv"], "part": pdf["part"], "s1": [x[0] for x in out], "s2": [x[1] for x in out]})


def prefixes(turns: DataFrame) -> DataFrame:
    """turns (conv, depth, t1, t2, words, length) with the hashes of their prefix (p1, p2) and of the prefix before (q1, q2)."""
    rows = turns.select("conv", "depth", "t1", "t2", "words", "length").repartitionByRange("conv", "depth").sortWithinPartitions("conv", "depth")
    rows = staged(chained(rows).withColumn("part", F.spark_partition_id()))
    ends = rows.groupBy("conv", "part").agg(F.max("k").alias("k"), F.max_by("a1", "k").alias("a1"), F.max_by("a2", "k").alias("a2"))
    ends = ends.withColumn("n", F.count("*").over(Window.partitionBy("conv"))).where("n > 1")  # as many rows as tasks
    before = ends.groupBy("conv").applyInPandas(carried, "conv long, part int, s1 long, s2 long")

    def moved(base: int):
        @F.arrow_udf("long")
        def move(s: pa.Array, a: pa.Array, k: pa.Array) -> pa.Array:
            if s.null_count == len(s):
                return a
            return pa.array([y if x is None else (x * pow(base, n, P) + y) % P for x, y, n in zip(s.to_pylist(), a.to_pylist(), k.to_pylist())], pa.int64())
        return move
    full = rows.join(before, ["conv", "part"], "left")
    both = list(enumerate(map(moved, BASES), 1))
    return full.select("conv", "depth", "length", "words", *[f(f"s{i}", f"a{i}", "k").alias(f"p{i}") for i, f in both],
                       *[f(f"s{i}", f"b{i}", F.col("k") - 1).alias(f"q{i}") for i, f in both])


NODE = ["depth", "p1", "p2", "q1", "q2", "conv", "n_convs", "top", "leaf", "children", "leaves", "saved"]
SWEPT = ("depth long, p1 long, p2 long, q1 long, q2 long, conv long, n_convs long, top boolean, n_children long, n_leaves long, saved_tokens long")


def sweep(nodes: DataFrame, shard: list[Column], queue: int = QUEUE) -> DataFrame:
    """Time-forward processing of nodes (NODE): totals over their subtrees. A node that is no `top` has its parent in the
    same shard; children, leaves and saved hold what the node itself and other shards add. leaf: null where the messages tell."""
    def swept(batches):
        q = SpillingQueue(queue)
        for batch in batches:
            out = [[], [], []]
            for depth, p1, p2, q1, q2, top, leaf, children, leaves, saved in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3, 4, 7, 8, 9, 10, 11))):
                key = (-depth, p1, p2)
                while (least := q.least()) is not None and least[:3] == key:
                    *_, more, kept = q.pop()
                    children, leaves, saved = children + 1, leaves + more, saved + kept
                leaves += not children if leaf is None else leaf
                if not top:
                    q.push((1 - depth, q1, q2, leaves, saved))
                for column, x in zip(out, (children, leaves, saved)):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([*batch.columns[:8], *[pa.array(x, pa.int64()) for x in out]],
                                             names=[*NODE[:8], "n_children", "n_leaves", "saved_tokens"])
    placed = nodes.select(*NODE, F.xxhash64(*shard).alias("shard")).repartition("shard")
    return placed.sortWithinPartitions(F.desc("depth"), "p1", "p2").select(*NODE).mapInArrow(swept, SWEPT)


def messages(tops: DataFrame) -> DataFrame:
    """What nodes at the top of their shards send to their parents, added up."""
    return tops.groupBy(F.col("q1").alias("m1"), F.col("q2").alias("m2"), (F.col("depth") - 1).alias("m_depth")).agg(
        F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))


def delivered(nodes: DataFrame, sent: DataFrame, *names: str) -> DataFrame:
    """The messages added to the nodes' own children (unless left out), leaves and saved tokens."""
    got = nodes.join(sent, (nodes["p1"] == sent["m1"]) & (nodes["p2"] == sent["m2"]) & (nodes["depth"] == sent["m_depth"]), "left")
    added = {x: F.col(x) + F.coalesce(F.col(y), F.lit(0)) for x, y in (("children", "c"), ("leaves", "l"), ("saved", "s")) if x in names}
    return got.withColumns(added).drop("m1", "m2", "m_depth", "c", "l", "s")


def heavy_totals(heavy: DataFrame, rows: DataFrame, band: int) -> DataFrame:
    """Totals of heavy nodes, which hold the messages of the light subtrees below them."""
    own = heavy.groupBy(F.col("q1").alias("m1"), F.col("q2").alias("m2"), (F.col("depth") - 1).alias("m_depth")).agg(
        F.count("*").alias("c"), F.lit(0).alias("l"), F.lit(0).alias("s"))
    heavy = delivered(heavy, own, "children").withColumn("leaf", (F.col("children") == 0).cast("int"))
    level = F.floor((F.col("depth") - 1) / band)
    # a node's shard is its ancestor at the top of its band, through which its smallest member goes as well
    tops = rows.where((F.col("depth") - 1) % band == 0).select(F.col("conv").alias("s_conv"), level.alias("s_level"), F.col("p1").alias("s1"), F.col("p2").alias("s2"))
    heavy = heavy.withColumns({"level": level, "top": (F.col("depth") - 1) % band == 0})
    heavy = staged(heavy.join(tops, (heavy["conv"] == tops["s_conv"]) & (heavy["level"] == tops["s_level"])).drop("s_conv", "s_level"))
    shard = [F.col("level"), F.col("s1"), F.col("s2")]
    alone = staged(sweep(heavy.withColumn("children", F.lit(0)), shard))
    if not alone.where(F.col("top") & (F.col("depth") > 1)).isEmpty():
        # the trie of shards, each with what it has alone: a node for each top, below the top of the shard its parent is in
        of = heavy.select(F.col("p1").alias("o1"), F.col("p2").alias("o2"), F.col("depth").alias("o_depth"), F.col("s1").alias("n1"), F.col("s2").alias("n2"))
        up = alone.where("top")
        up = up.join(of, (up["q1"] == of["o1"]) & (up["q2"] == of["o2"]) & (up["depth"] - 1 == of["o_depth"]), "left")
        shards = up.select((F.floor((F.col("depth") - 1) / band) + 1).alias("depth"), "p1", "p2", F.col("n1").alias("q1"), F.col("n2").alias("q2"), "conv", "n_convs",
                           F.col("n1").isNull().alias("top"), F.lit(0).alias("leaf"), F.lit(0).cast("long").alias("children"),
                           F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
        whole = sweep(shards, [F.lit(0)]).select(F.col("p1").alias("w1"), F.col("p2").alias("w2"), (F.col("depth") - 1).alias("w_level"), F.col("n_leaves").alias("w_l"), F.col("saved_tokens").alias("w_s"))
        tops = heavy.where("top")
        sent = tops.join(whole, (tops["p1"] == whole["w1"]) & (tops["p2"] == whole["w2"]) & (tops["level"] == whole["w_level"])).select(
            "q1", "q2", "depth", F.col("w_l").alias("n_leaves"), F.col("w_s").alias("saved_tokens"))
        alone = sweep(delivered(heavy.withColumn("children", F.lit(0)), messages(sent), "leaves", "saved"), shard)
    # the sweep counts messages inside a shard only; children are known
    known = heavy.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.col("depth").alias("k_depth"), F.col("children").alias("n"))
    alone = alone.join(known, (alone["p1"] == known["k1"]) & (alone["p2"] == known["k2"]) & (alone["depth"] == known["k_depth"]))
    return alone.withColumn("n_children", F.col("n")).drop("k1", "k2", "k_depth", "n")


def digests(ends: DataFrame) -> DataFrame:
    """ends (depth, p1, p2, conv) as the digest of each node's conversations, ascending, joined by commas; hashed as streams."""
    def hashed(batches):
        node, h = None, None
        for b in batches:
            out = [[], [], [], []]

            def ended():
                for column, x in zip(out, (*node, h.hexdigest())):
                    column.append(x)
            for *new, c in zip(*(b.column(i).to_pylist() for i in range(4))):
                if new != node:
                    if node is not None:
                        ended()
                    node, h = new, hashlib.sha256(str(c).encode())
                else:
                    h.update(f",{c}".encode())
            yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in out[:3]], pa.array(out[3], pa.string())], names=["depth", "p1", "p2", "sha"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([*[pa.array([x], pa.int64()) for x in node], pa.array([h.hexdigest()], pa.string())], names=["depth", "p1", "p2", "sha"])
    dealt = ends.select("depth", "p1", "p2", "conv").repartition("p1", "p2", "depth").sortWithinPartitions("p1", "p2", "depth", "conv")
    return dealt.mapInArrow(hashed, "depth long, p1 long, p2 long, sha string")


def trie(turns: DataFrame, convs: DataFrame, limit: int = LIMIT, band: int = BAND, queue: int = QUEUE) -> DataFrame:
    """The nodes of turns (conv, depth from 1, t1, t2: two hashes of the turn, words, length of the conversation) and convs (conv,
    length: all conversations): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = staged(prefixes(turns))
    zero = F.lit(0).cast("long")
    nodes = rows.groupBy("depth", "p1", "p2").agg(
        F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.min("conv").alias("conv"), F.count("*").alias("n_convs"),
        F.max("words").alias("words"), F.sum(F.col("length") - F.col("depth") + 1).alias("mass"))
    nodes = staged(nodes.withColumns({"saved": (F.col("n_convs") - 1) * F.col("words"), "children": zero, "leaves": zero, "leaf": F.lit(None).cast("int")}))
    heavy = nodes.where(F.col("mass") > limit)
    deepest = rows.select("conv", "depth", "p1", "p2").join(heavy.select("depth", "p1", "p2"), ["depth", "p1", "p2"], "left_semi")
    cut = deepest.groupBy("conv").agg(F.max("depth").alias("cut"))  # a conversation's last heavy node
    crown = rows.join(cut, "conv", "left").where(F.col("depth") == F.coalesce("cut", zero) + 1)
    crown = crown.select(F.col("conv").alias("s_conv"), F.col("depth").alias("s_depth"), F.col("p1").alias("s1"), F.col("p2").alias("s2"))
    light = nodes.where(F.col("mass") <= limit)
    light = light.join(crown, light["conv"] == crown["s_conv"]).withColumn("top", F.col("depth") == F.col("s_depth"))
    totals = staged(sweep(light, [F.col("s1"), F.col("s2")], queue))
    sent = messages(totals.where("top"))
    if not heavy.isEmpty():
        totals = totals.union(staged(heavy_totals(delivered(heavy, sent, "children", "leaves", "saved").withColumn("top", F.lit(False)), rows, band)))
    # the root: all conversations, and the messages of the first level
    above = convs.select("conv", F.lit(1).alias("n"), zero.alias("c"), zero.alias("l"), zero.alias("s")).union(
        totals.where("depth = 1").select(F.lit(None).cast("long"), zero, F.lit(1), "n_leaves", "saved_tokens"))
    above = above.agg(F.min("conv").alias("conv"), *[F.sum(x).alias(x) for x in "ncls"]).where("n > 0")
    none = F.lit(None).cast("long")
    root = above.select(zero, zero, zero, none, none, "conv", "n", F.lit(True), "c", F.greatest("l", F.lit(1)), "s")
    every = staged(totals.union(root))
    parents = every.select(F.col("p1").alias("x1"), F.col("p2").alias("x2"), F.col("depth").alias("x_depth"), F.col("conv").alias("parent_conv_id"))
    done = every.join(parents, (every["q1"] == parents["x1"]) & (every["q2"] == parents["x2"]) & (every["depth"] - 1 == parents["x_depth"]), "left")
    ends = rows.where("depth = length").select("depth", "p1", "p2", "conv").union(convs.where("length = 0").select(zero, zero, zero, "conv"))
    ends = digests(ends).toDF("e_depth", "e1", "e2", "sha")
    done = done.join(ends, (done["p1"] == ends["e1"]) & (done["p2"] == ends["e2"]) & (done["depth"] == ends["e_depth"]), "left")
    return done.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                       F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


#: The CRC-32 of the ASCII string {0}, in DuckDB.
CRC_SQL = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS bigint), list_transform(string_split({0}, ''), lambda x: CAST(ascii(x) AS bigint))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS bigint[])),
        lambda x, y: xor(x >> 1, CASE WHEN (x & 1) = 1 THEN 3988292384 ELSE 0 END))))"""

#: op11 over the table conversations: every node adds itself to all its prefixes.
CHECK_SQL = f"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
           coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, {CRC_SQL.format("CAST(c AS varchar)")} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
r AS (SELECT h.c, 0 AS own, pos, role, text FROM h JOIN t ON t.c = h.c - h.c % 20 AND pos <= h
      UNION ALL SELECT c, 1, pos, role, text FROM h JOIN t USING (c) WHERE pos > h),
p AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS depth, string_agg(md5(role || chr(1) || text), '') OVER (PARTITION BY c ORDER BY own, pos) AS p,
             len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM r
      UNION ALL SELECT c, 0, '', 0 FROM h),
n AS (SELECT p, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words, left(p, 32 * (depth - 1)) AS q FROM p GROUP BY p, depth),
kids AS (SELECT q, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY q),
up AS (SELECT left(p, 32 * unnest(range(0, depth + 1))) AS p, (n_convs - 1) * words AS saved, CASE WHEN p IN (SELECT q FROM kids) THEN 0 ELSE 1 END AS leaf FROM n),
total AS (SELECT p, sum(saved) AS saved, sum(leaf) AS leaves FROM up GROUP BY p),
ends AS (SELECT p, string_agg(CAST(c AS varchar), ',' ORDER BY c) AS ends FROM (SELECT c, arg_max(p, depth) AS p FROM p GROUP BY c) GROUP BY p)
SELECT n.conv_id, CAST(n.depth AS bigint) AS depth, CASE WHEN n.depth > 0 THEN o.conv_id END AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       CAST(leaves AS bigint) AS n_leaves, CAST(saved AS bigint) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM n JOIN n o ON o.p = CASE WHEN n.depth > 0 THEN n.q ELSE '' END JOIN total ON total.p = n.p LEFT JOIN kids ON kids.q = n.p LEFT JOIN ends ON ends.p = n.p
"""
