"""Constraints a database would enforce, as reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.schema import FOREIGN, MAX_LENGTH, NOT_NULL, UNIQUE
from daybook.sources.workspace import Workspace, workspace


def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls per required column, from one pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return one.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, violations)")


def length_violations(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Texts longer than their column allows, counted per column in one pass."""
    one = df.agg(*[F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()])
    pairs = ", ".join(f"'{c}', `{c}`" for c in limits)
    return one.selectExpr(f"stack({len(limits)}, {pairs}) AS (column_name, violations)")


def dup_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphans(child: DataFrame, parent: DataFrame, column: str, parent_column: str) -> DataFrame:
    """Referenced names or ids the parent lacks, with the number of child rows that use them.

    Child keys are counted before the join: a hot key is one row by then."""
    keys = (child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("missing"))
            .agg(F.count(F.lit(1)).alias("child_rows")))
    return keys.join(parent.select(F.col(parent_column).alias("missing")), "missing", "left_anti")


def numeric_violations(df: DataFrame, column: str) -> DataFrame:
    """Texts that do not fit NUMERIC(19,4): not a number, too large, or losing decimals."""
    wide = F.col(column).try_cast("decimal(38,10)")
    fit = F.col(column).try_cast("decimal(19,4)")
    problem = (F.when(wide.isNull(), "not a number").when(fit.isNull(), "overflow")
               .when(fit.cast("decimal(38,10)") != wide, "scale loss"))
    return (df.filter(F.col(column).isNotNull()).withColumn("problem", problem)
            .filter(F.col("problem").isNotNull()))


def repeated_keys(frames: dict[str, DataFrame], keys: dict[str, list[str]], work: Workspace) -> dict[str, DataFrame]:
    """Per table the keys that occur more than once. First 64 bits of hash are counted for all tables together;
    only rows whose hash repeats are grouped by the key itself."""
    mark = lambda t: F.xxhash64(*keys[t]).alias("_h")
    hashes = [frames[t].select(F.lit(t).alias("_table"), mark(t)) for t in keys]
    seen = reduce(DataFrame.unionByName, hashes).groupBy("_table", "_h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    seen = work.stage(seen.drop("n"), "repeated")
    return {t: dup_violations(frames[t].select("*", mark(t)).join(seen.filter(F.col("_table") == t).drop("_table"), "_h", "left_semi"), key)
            for t, key in keys.items()}


def rows_without_parent(children: dict[str, DataFrame], parent: DataFrame, column: str, work: Workspace) -> dict[str, DataFrame]:
    """Per child table its rows whose `column` the parent lacks; nulls refer to nothing. All tables meet once, by 128 bits of hash."""
    mark = F.unhex(F.md5(F.col(column).cast("binary"))).alias("_h")
    held = [parent.select(mark, F.lit(True).alias("_held"))] + [df.select(mark, F.lit(False).alias("_held")) for df in children.values()]
    lost = reduce(DataFrame.unionByName, held).filter("_h IS NOT NULL").groupBy("_h").agg(F.bool_or("_held").alias("_held"))
    lost = work.stage(lost.filter("NOT _held").drop("_held"), "lost")
    return {t: df.select("*", mark).join(lost, "_h", "left_semi") for t, df in children.items()}


def quality_report(led: dict[str, DataFrame], work: Workspace | None = None) -> DataFrame:
    """Violations of every required column, length limit, unique key and reference: (check, table, detail, violations)."""
    parts, work = [], workspace(next(iter(led.values())), work)
    for table, columns in NOT_NULL.items():
        if table in led:
            parts.append(null_violations(led[table], columns).select(
                F.lit("not_null").alias("check"), F.lit(table).alias("table"),
                F.col("column_name").alias("detail"), "violations"))
    for table, limits in MAX_LENGTH.items():
        if table in led:
            parts.append(length_violations(led[table], limits).select(
                F.lit("length").alias("check"), F.lit(table).alias("table"),
                F.col("column_name").alias("detail"), "violations"))
    repeated = repeated_keys(led, {t: key for t, key in UNIQUE.items() if t in led}, work)
    for table, df in repeated.items():
        parts.append(df.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit("unique").alias("check"), F.lit(table).alias("table"),
            F.lit(",".join(UNIQUE[table])).alias("detail"), "violations"))
    by_id = [child for child, _, parent, _ in FOREIGN if parent == "transactions" and child in led and parent in led]
    lost = rows_without_parent({c: led[c] for c in by_id}, led["transactions"], "external_id", work) if by_id else {}
    for child, column, parent, parent_column in FOREIGN:
        if child in led and parent in led:
            if parent == "transactions":
                missing = lost[child].agg(F.count(F.lit(1)).alias("violations"))
            else:
                missing = orphans(led[child], led[parent], column, parent_column).agg(F.coalesce(F.sum("child_rows"), F.lit(0)).alias("violations"))
            parts.append(missing.select(
                F.lit("reference").alias("check"), F.lit(child).alias("table"),
                F.lit(f"{column} -> {parent}").alias("detail"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
