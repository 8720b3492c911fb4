"""Which files and years of a ledger differ from their source, by a tree of mergeable digests.

A leaf stands for the transactions of one source file, year and bucket (of their content hash): their number, and two sums of 60 bits
each of a digest of every row. Sums of rows are digests of multisets: leaves add up to years, years to files, files to the root,
and the leaves of a new batch are added to the stored ones, so nothing stored is read again. Two trees are compared level by
level: a level is looked at only below what differs above, and only rows of buckets that differ are read in the end."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
LEAF = ["source_file", "year", "bucket"]
SUMS = ["n", "a", "b"]
WIDE = "decimal(38,0)"


def _lane(digest: Column, at: int) -> Column:
    """60 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, at, 15), 16, 10).cast(WIDE)


def bucket_of(digest: Column, buckets: int = BUCKETS) -> Column:
    return (F.conv(F.substring(digest, 61, 4), 16, 10).cast("int") % buckets).cast("int")


def hashed(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """rows (source_file, date, content_hash) with year, digest and bucket. A null file, date or hash counts as such."""
    digest = F.sha2(F.coalesce(F.col("content_hash").cast("string"), F.lit("")), 256)
    return rows.withColumns({"year": F.year("date"), "digest": digest}).withColumn("bucket", bucket_of(F.col("digest"), buckets))


def leaves(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The leaves (source_file, year, bucket, n, a, b) of rows (source_file, date, content_hash)."""
    return hashed(rows, buckets).groupBy(*LEAF).agg(F.count(F.lit(1)).cast(WIDE).alias("n"), F.sum(_lane(F.col("digest"), 1)).cast(WIDE).alias("a"),
                                                    F.sum(_lane(F.col("digest"), 16)).cast(WIDE).alias("b"))


def level(tree: DataFrame, *keys: str) -> DataFrame:
    """The tree's nodes by some of its keys: none is the root, `source_file` the files, and so on."""
    return tree.groupBy(*keys).agg(*[F.sum(c).cast(WIDE).alias(c) for c in SUMS])


def merged(*trees: DataFrame) -> DataFrame:
    """One tree of the rows of all."""
    return level(reduce(DataFrame.unionByName, trees), *LEAF)


def add_batch(rows: DataFrame, folder: str, batch: int, buckets: int = BUCKETS) -> None:
    """Store the leaves of a batch beside those of others; a batch that is written again replaces its own."""
    leaves(rows, buckets).write.mode("overwrite").parquet(f"{folder}/batch={batch}")


def stored_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The tree of all stored batches."""
    return level(spark.read.parquet(folder), *LEAF)


def differing(source: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Nodes (keys, n_source, n_stored) that differ, also those one side lacks."""
    sides = [F.struct(*[F.sum(F.when(F.col("side") == i, F.col(c))).alias(c) for c in SUMS]).alias(f"s{i}") for i in (0, 1)]
    both = source.select(*keys, *SUMS, F.lit(0).alias("side")).unionByName(stored.select(*keys, *SUMS, F.lit(1).alias("side")))
    count = lambda i: F.coalesce(F.col(f"s{i}.n"), F.lit(0)).cast("bigint")
    return both.groupBy(*keys).agg(*sides).where(~F.col("s0").eqNullSafe(F.col("s1"))).select(*keys, count(0).alias("n_source"), count(1).alias("n_stored"))


def below(tree: DataFrame, nodes: DataFrame, keys: list[str]) -> DataFrame:
    """The part of a tree, or of hashed rows, under some nodes."""
    found = nodes.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    return tree.join(found, reduce(Column.__and__, [tree[k].eqNullSafe(found[f"_{k}"]) for k in keys]), "left_semi")


def drift(source: DataFrame, stored: DataFrame, keys: list[str] = LEAF) -> DataFrame:
    """The nodes of a level that differ between two trees (source_file, year, bucket or fewer), looked for from the files down."""
    for i in range(1, len(keys) + 1):
        own = keys[:i]
        found = differing(level(source, *own), level(stored, *own), own)
        if i < len(keys):
            source, stored = below(source, found, own), below(stored, found, own)
    return found


def years_of(nodes: DataFrame) -> list[int | None]:
    """The years in which something differs: few, so that a table partitioned by year is read in part."""
    return [r.year for r in nodes.select("year").distinct().collect()]


def drifted_rows(source: DataFrame, stored: DataFrame, nodes: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Content hashes (source_file, year, content_hash, n_source, n_stored) that differ in number. Only buckets in `nodes` (of drift()) are
    compared, and of tables partitioned by date only the years that hold them are read."""
    years = years_of(nodes)
    dated = F.year("date").isin([y for y in years if y is not None])
    if None in years:
        dated = dated | F.col("date").isNull()
    sides = [below(hashed(rows.where(dated), buckets), nodes, LEAF).select("source_file", "year", "content_hash", F.lit(i).alias("side"))
             for i, rows in enumerate((source, stored))]
    count = lambda i: F.count_if(F.col("side") == i)
    return (sides[0].unionByName(sides[1]).groupBy("source_file", "year", "content_hash").agg(count(0).alias("n_source"), count(1).alias("n_stored"))
            .where("n_source <> n_stored"))
