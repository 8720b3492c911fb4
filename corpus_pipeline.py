"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
Between stages run() keeps the rows in the folder that spark.checkpoint.dir names.

Defined results: quality rules drop null, empty and short texts and cut failing lines; a document whose lines all
stand earlier keeps an empty text until near-duplicates go, where empty texts are one group; n_chars follows the
text; other columns, whatever their names, pass through unchanged; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import lines, neardup, packing, pii, quality
from daybook.llm.queries import BYTE_BPE, PII_KEY
from daybook.llm.ship import ship
from daybook.llm.stage import staged


def beside(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The stage over doc_id and text, with the other columns carried under names that cannot clash."""
    names = {c: c if c in ("doc_id", "text") else f"column_{i}" for i, c in enumerate(docs.columns)}
    done = stage(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]))
    done = done.select(*[F.col(n).alias(c) for c, n in names.items()])
    return done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else done


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return beside(docs, quality.keep)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return beside(docs, lines.dedup_lines)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return beside(docs, lambda d: neardup.near_duplicates(d).where("kept"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return beside(docs, lambda d: pii.pseudonymise(d, PII_KEY))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(docs, BYTE_BPE)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("near dedup", near_dedup), ("pii", private), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs)
    return docs
