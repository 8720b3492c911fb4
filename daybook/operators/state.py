"""State hashes: does the stored ledger still match its source?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.identity import packed, unpacked


def run_hashes(ids: DataFrame, later: DataFrame) -> DataFrame:
    """content_hash of every transaction that a load would not skip: each id counts once.

    `ids` holds seq and content_hash, `later` the seq of repeated ids after their first; where ids say in a column `given`
    whether they can repeat, the others are not looked up."""
    found = ids.filter("given") if "given" in ids.columns else ids
    rows = found.select("seq", packed("content_hash").alias("_hash")).join(later, "seq", "left_anti").select("_hash")
    if "given" in ids.columns:
        rows = rows.unionByName(ids.filter("NOT given").select(packed("content_hash").alias("_hash")))
    return rows.select(unpacked("_hash").alias("content_hash"))


def state_fingerprint(hashes: DataFrame, name: str = "fingerprint") -> DataFrame:
    """One digest of a multiset of hashes, in three levels of 4,096-fold fan-in.

    Equal hashes are counted first, so copies never meet in one group; the rest spread by
    their own digest, whatever they begin with, over 16.7 million leaves."""
    counted = hashes.groupBy(packed("content_hash").alias("_hash")).agg(F.count(F.lit(1)).alias("c"))
    counted = counted.select(unpacked("_hash").alias("content_hash"), "c")
    leaf = (counted.select(F.substring(F.md5("content_hash"), 1, 6).alias("k"),
                           F.concat_ws(":", "content_hash", F.col("c").cast("string")).alias("h")))
    digest = lambda: F.sha2(F.concat_ws("", F.array_sort(F.collect_list("h"))), 256)
    level1 = leaf.groupBy("k").agg(digest().alias("g")).select(
        F.substring("k", 1, 3).alias("k"), F.concat_ws(":", "k", "g").alias("h"))
    level2 = level1.groupBy("k").agg(digest().alias("g")).select(F.concat_ws(":", "k", "g").alias("h"))
    return level2.agg(digest().alias(name))          # at most 4,096 rows


def state_hash(hashes: DataFrame) -> DataFrame:
    """One row (state_hash): the fingerprint, at every size."""
    return state_fingerprint(hashes, "state_hash")


def check_sync(current: DataFrame, state: DataFrame) -> DataFrame:
    """Current hash beside the stored one; no stored hash means out of sync."""
    both = current.select("state_hash").unionByName(
        state.select(F.col("last_successful_hash").alias("stored_hash")), allowMissingColumns=True)
    return (both.agg(F.max("state_hash").alias("current_hash"), F.max("stored_hash").alias("stored_hash"))
            .withColumn("in_sync", F.coalesce(F.col("current_hash") == F.col("stored_hash"), F.lit(False))))
