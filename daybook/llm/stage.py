"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from daybook.sources.workspace import Workspace


@lru_cache(maxsize=None)
def _workspace(application: str, spark: SparkSession) -> Workspace:
    return Workspace(spark, "llm")


def staged(df: DataFrame) -> DataFrame:
    """df, computed once, written as Parquet below spark.checkpoint.dir and read back. The tables of an application are
    deleted when its driver ends; a cluster without that setting is refused, a local session gets a folder of its own."""
    spark = df.sparkSession
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])  # files know no two names that differ in case only
    return _workspace(spark.sparkContext.applicationId, spark).stage(plain, "stage").toDF(*df.columns)


def repeatable(df: DataFrame) -> DataFrame:
    """df if it is read from files and only projected and filtered, so that its rows come alike whenever it is computed
    again; else df staged."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().apply(0)
    return df if plan.nodeName().startswith(("Relation", "LogicalRelation")) else staged(df)
