"""Turns of conversations in order, dealt to tasks by ranges, so that one long conversation spans many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stage import staged

TIE = 64                     # characters of a text that order turns of one number and role
BLANKS = " \t\n\x0b\x0c\r"


def ordered(rows: DataFrame, *keep: str) -> DataFrame:
    """rows (conv, turn, role, text, ...) staged with `seq`, ascending in (conv, turn); null turns first; rows of one turn
    by role, the text's first TIE characters, its hash. A task's rows share the upper bits of `seq`: part_of(). keep: the
    columns that go on (all, if none is named)."""
    keys = {"_t_role": F.col("role"), "_t_head": F.substring("text", 1, TIE), "_t_hash": F.xxhash64("text"), "_t_row": F.monotonically_increasing_id()}
    order = ["conv", "turn", *keys]  # the last key parts equal rows
    dealt = rows.withColumns(keys).select(*dict.fromkeys([*(keep or rows.columns), *order])).repartitionByRange(*order)
    return staged(dealt.sortWithinPartitions(*order).select(*(keep or rows.columns), F.monotonically_increasing_id().alias("seq")))


def positions(rows: DataFrame) -> DataFrame:
    """ordered rows (conv, seq, ...) with `pos`, the row's number in its conversation from 1, and `n`, the conversation's rows."""
    held = rows.groupBy("conv", part_of(F.col("seq")).alias("_t_part")).agg(F.min("seq").alias("_t_first"), F.count("*").alias("_t_n"))
    own = Window.partitionBy("conv")  # as many rows as tasks share the conversation
    held = held.withColumns({"n": F.sum("_t_n").over(own), "_t_before": F.sum("_t_n").over(own.orderBy("_t_part")) - F.col("_t_n")})
    numbered = rows.withColumn("_t_part", part_of(F.col("seq"))).join(held, ["conv", "_t_part"])
    return numbered.withColumn("pos", F.col("seq") - F.col("_t_first") + F.col("_t_before") + 1).drop("_t_part", "_t_first", "_t_n", "_t_before")


def part_of(seq: Column) -> Column:
    """The task that numbered the row."""
    return F.shiftright(seq, 33)


def crc(text: Column) -> Column:
    """The unsigned CRC-32 of a string."""
    return F.crc32(text.cast("binary"))


def damaged(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) with faults drawn from the CRC-32 of `conv:turn` modulo 20: 0 drops a row, 1 empties its
    text, 2 takes its sentence marks, 3 repeats it, 4 makes its role `user`. Null values count as one space."""
    space = F.lit(" ")
    rows = conversations.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), space).alias("role"),
                                F.coalesce(F.col(text), space).alias("text"))
    name = F.concat(F.coalesce(F.col("conv").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("_t_fault", crc(name) % 20).where("_t_fault <> 0").withColumns({
        "role": F.when(F.col("_t_fault") == 4, "user").otherwise(F.col("role")),
        "text": F.when(F.col("_t_fault") == 1, "").when(F.col("_t_fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))})
    copies = F.explode(F.when(F.col("_t_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.withColumn("_t_copy", copies).drop("_t_copy", "_t_fault")
