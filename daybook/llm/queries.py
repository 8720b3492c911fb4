"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, counts, langid, lines, neardup, neighbours, packing, passages, pii, quality, repair, trie, urls
from .ship import ship

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PII_KEY = "daybook"  # a deployment passes its own secret
QUERIES, CHECKS = {}, {}


def query(f):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)
    QUERIES[f.__name__] = run
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256_of_ids(ids):
    return F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256)


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), BYTE_BPE)
    return docs.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), sha256_of_ids(F.col("ids")).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = counts.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), BYTE_BPE)
    return docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
                       (F.col("n_tokens") > 1024).alias("over_limit"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
                         "tier", "step")


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = quality.clean(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


CHECKS["op8_quality"] = quality.CHECK_SQL


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "text", "n_removed_lines")


CHECKS["op9_line_dedup"] = lines.CHECK_SQL


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = langid.learn(docs.where(~held_out))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


@query
def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, labels, RULES).select("page_id", "host", "path", "rule", "verdict", "confidence")


CHECKS["op2_urls"] = urls.check_sql(RULES)


@query
def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


@query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "class_id", "kept")


@query
def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


@query
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = passages.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


CHECKS["op12_substring_dedup"] = passages.CHECK_SQL


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(*trie.rebuilt(table(spark, sf_dir, "conversations")))


CHECKS["op11_prefix_trie"], CHECKS["op13_structure_repair"] = trie.CHECK_SQL, repair.CHECK_SQL
