"""Row numbers over groups of any size.

A plain row_number() puts a whole group into one task. Here repeated keys are found first,
by a map-side combined count that is staged. Their rows are numbered by an ordinary window
as long as no group exceeds 2**20 rows. Larger groups are cut into runs of 2**20 values of
their BIGINT order column, which must be unique inside the group; rows are numbered inside
a run and the runs' counts are summed in front of them. No window partition then holds more
than 2**24 rows whatever the data, every run is a shuffle key of its own, and nothing
depends on how Spark happened to partition the input."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.sources.workspace import Workspace, workspace

RUN_BITS = 20


def _ahead(over: list[str], by: str) -> Window:
    return Window.partitionBy(*over).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)


def number_runs(df: DataFrame, keys: list[str], order: str, name: str = "n", run_bits: int = RUN_BITS) -> DataFrame:
    """Add `name` = 1, 2, 3 … inside each `keys` group, by runs; no keys numbers the whole frame."""
    runs = (df.withColumn("_run", F.shiftright(F.col(order), run_bits))
            .withColumn("_span", F.shiftright(F.col(order), 2 * run_bits)))
    counts = runs.groupBy(*keys, "_span", "_run").agg(F.count(F.lit(1)).alias("_rows"))
    in_span = counts.withColumn("_in_span", F.coalesce(F.sum("_rows").over(_ahead(keys + ["_span"], "_run")), F.lit(0)))
    spans = (counts.groupBy(*keys, "_span").agg(F.sum("_rows").alias("_span_rows"))
             .withColumn("_before", F.coalesce(F.sum("_span_rows").over(_ahead(keys, "_span")), F.lit(0)))
             .drop("_span_rows"))
    offsets = (in_span.join(spans, keys + ["_span"])
               .select(*keys, "_span", "_run", (F.col("_in_span") + F.col("_before")).alias("_offset"))
               .filter("_offset > 0"))
    in_run = F.row_number().over(Window.partitionBy(*keys, "_span", "_run").orderBy(order))
    return (runs.withColumn("_in_run", in_run)
            .join(offsets, keys + ["_span", "_run"], "left")
            .withColumn(name, F.col("_in_run") + F.coalesce("_offset", F.lit(0)))
            .select(*df.columns, name))


def number_groups(df: DataFrame, key: str, order: str, name: str = "n", least: int = 1,
                  work: Workspace | None = None, run_bits: int = RUN_BITS) -> DataFrame:
    """(key, order, n): rows numbered inside their key's group, groups below `least` rows left out.

    Null keys take no part. With least=2 only the rows of repeated keys move: the staged
    list of those keys has a known size, so Spark broadcasts it where it is small."""
    rows = df.select(key, order).filter(F.col(key).isNotNull())
    repeated = workspace(df, work).stage(
        rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1"), "repeated")
    in_group = F.row_number().over(Window.partitionBy(key).orderBy(order)).cast("bigint").alias(name)
    big = F.col("_rows") > 2 ** run_bits
    if repeated.filter(big).isEmpty():
        out = rows.join(repeated.select(key), key, "left_semi").select(key, order, in_group)
    else:
        # their rows leave the cold branch first; Spark plans the joins by the staged list's size
        hot = repeated.filter(big).select(key)
        cold = rows.join(hot, key, "left_anti").join(repeated.select(key), key, "left_semi")
        out = cold.select(key, order, in_group).unionByName(
            number_runs(rows.join(hot, key, "left_semi"), [key], order, name, run_bits))
    if least > 1:
        return out
    single = rows.join(repeated, key, "left_anti").select(key, order, F.lit(1).cast("bigint").alias(name))
    return out.unionByName(single)


def later_repeats(rows: DataFrame, key: str, order: str, work: Workspace | None = None) -> DataFrame:
    """`order` values of rows whose key occurred before, in a narrow frame (key, order)."""
    firsts = workspace(rows, work).stage(
        rows.groupBy(key).agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .filter("_rows > 1").drop("_rows"), "firsts")
    return rows.join(firsts, key).filter(F.col(order) > F.col("_first")).select(order)


def first_by_key(df: DataFrame, key: str, order: str, work: Workspace | None = None) -> DataFrame:
    """Keep the first row of each key by `order`, which must be unique.

    Only (key, order) is shuffled; the wide rows lose the later ones by an anti join
    on the evenly spread order column."""
    later = later_repeats(df.select(key, order), key, order, work)
    return df.join(later, order, "left_anti").select(*df.columns)


def assign_ids(df: DataFrame, key: str, start: int = 0, name: str = "id") -> DataFrame:
    """Dense surrogate ids start+1 … start+n for a unique key, in the order of (md5(key), key).

    Ids carry no meaning, so the digest's order is as good as any and spreads every key
    set evenly over 65,536 buckets; only the buckets' counts are summed in one place."""
    hashed = (df.withColumn("_digest", F.md5(F.col(key).cast("string")))
              .withColumn("_bucket", F.substring("_digest", 1, 4)))
    counts = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    ahead = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_offset"))
    in_bucket = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", key))
    # at most 65,536 rows, whatever the data: safe to broadcast
    return (hashed.withColumn("_in_bucket", in_bucket)
            .join(F.broadcast(offsets), "_bucket")
            .withColumn(name, F.lit(start).cast("bigint") + F.col("_offset") + F.col("_in_bucket"))
            .select(*df.columns, name))
