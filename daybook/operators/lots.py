"""First in, first out: which bought lots a sale sells.

Of each account and commodity, buys laid end to end cover the quantities 0 to all bought, sales those from 0 to all sold;
a sale sells the lots whose stretch it overlaps. Stretches are running sums, taken per day first and inside each day then, so no
window holds more than the days of a key or the rows of one of its days. Overlaps are found without a range join: stretches are
cut at the borders of blocks of quantity (some BLOCK rows to a block, so a hot commodity is spread over many), and in
each block the ends of buys and sales are sorted into one line, on which every piece has the next end of either kind.

What is sold before it is bought is covered by the buys that follow; what no buy covers is reported as uncovered."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.money import times
from daybook.schema import TOTAL, VALUE

KEY = ["account", "commodity"]
ORDER = ["external_id", "posting_idx"]      # of the trades of a day
BLOCK = 4096


def trades(postings: DataFrame) -> DataFrame:
    """Postings held at cost as trades (account, commodity, date, external_id, posting_idx, side, quantity, price): buys at their
    cost, sales at their price or, without one, at the cost they name. Zero amounts are none."""
    held = postings.where("cost_amount IS NOT NULL AND amount <> 0")
    price = F.when(F.col("amount") > 0, F.col("cost_amount")).otherwise(F.coalesce("price_amount", "cost_amount"))
    return held.select("account", F.col("currency").alias("commodity"), "date", *ORDER, F.when(F.col("amount") > 0, "buy").otherwise("sell").alias("side"),
                       F.abs("amount").cast(TOTAL).alias("quantity"), price.alias("price"))


def stretches(t: DataFrame, how: str = "inner") -> DataFrame:
    """Trades with the stretch (low, high) of quantity that each covers among those of its side, and of their key all that is
    sold (null if nothing is), the longest stretch (total) and the number of trades (rows). Trades without account, commodity or date have
    no stretch; how='left' keeps them."""
    days = t.groupBy(*KEY, "side", "date").agg(F.sum("quantity").alias("day"), F.count(F.lit(1)).alias("trades"))
    earlier = Window.partitionBy(*KEY, "side").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumn("before", F.coalesce(F.sum("day").over(earlier), F.lit(0)).cast(TOTAL)).where("date IS NOT NULL")
    # of the key from its days, not from its trades: a join by the key alone would bring them together in one task
    key, until = Window.partitionBy(*KEY), (F.col("before") + F.col("day")).cast(TOTAL)
    days = days.select(*KEY, "side", "date", "before", F.max(F.when(F.col("side") == "sell", until)).over(key).alias("sold"),
                       F.max(until).over(key).alias("total"), F.sum("trades").over(key).alias("rows"))
    own = Window.partitionBy(*KEY, "side", "date").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    high = (F.col("before") + F.col("so_far")).cast(TOTAL)
    return (t.withColumn("so_far", F.sum("quantity").over(own)).join(days, [*KEY, "side", "date"], how)
            .withColumn("high", high).withColumn("low", (F.col("high") - F.col("quantity")).cast(TOTAL)).drop("so_far", "before"))


def _cut(s: DataFrame, block: int) -> DataFrame:
    """Stretches cut at the borders of their key's blocks of quantity, each block in one partition. What has no stretch stays as it is, with block
    null and its quantity as the end."""
    width = F.greatest(F.ceil(F.col("total") / F.ceil(F.col("rows") / block)), F.lit(1)).cast("bigint")
    wide = s.withColumn("width", width).drop("sold", "total", "rows")
    number = lambda c: F.floor(F.col(c) / F.col("width")).cast("bigint")
    last = F.greatest(F.ceil(F.col("high") / F.col("width")).cast("bigint") - 1, number("low"))
    wide = wide.withColumn("block", F.explode_outer(F.when(F.col("high").isNotNull(), F.sequence(number("low"), last))))
    end = F.least("high", (F.col("block") * F.col("width") + F.col("width")).cast(TOTAL))
    return wide.withColumn("to", F.when(F.col("block").isNull(), F.col("quantity")).otherwise(end)).repartition(*KEY, "block")


def _pieces(ends: DataFrame, *carried: str) -> DataFrame:
    """The line of each block: account, commodity, block, quantity, and the buy and the sale that hold each piece (either may be null),
    as structs with what is carried. What has no stretch is a piece of its own."""
    alone = F.col("block").isNull()
    of = lambda side: F.when(F.col("side") == side, F.struct("external_id", "posting_idx", "date", "price", *carried))
    start = (F.col("block") * F.col("width")).cast(TOTAL)
    # backwards, as the other way would look at all rows to come for each; where a buy and a sale end at one place, both see both and one piece is empty
    w = Window.partitionBy(*KEY, "block").orderBy(F.desc("to"))
    back = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    held = lambda side: F.when(alone, of(side)).otherwise(F.last(of(side), True).over(back))
    quantity = F.when(alone, F.col("to")).otherwise(F.col("to") - F.coalesce(F.lead("to").over(w), start))
    return ends.select(*KEY, "block", quantity.cast(TOTAL).alias("quantity"), held("buy").alias("buy"), held("sell").alias("sell")).where("quantity > 0")


def matches(postings: DataFrame, block: int = BLOCK) -> DataFrame:
    """What each sale sells of each lot: account, commodity, buy_id, buy_idx, sell_id, sell_idx, sell_date, quantity, cost, price (of a unit)."""
    line = _pieces(_cut(stretches(trades(postings)), block))
    return line.where("buy IS NOT NULL AND sell IS NOT NULL").select(
        *KEY, F.col("buy.external_id").alias("buy_id"), F.col("buy.posting_idx").alias("buy_idx"), F.col("sell.external_id").alias("sell_id"),
        F.col("sell.posting_idx").alias("sell_idx"), F.col("sell.date").alias("sell_date"), "quantity", F.col("buy.price").alias("cost"), F.col("sell.price").alias("price")
    ).groupBy(*KEY, "buy_id", "buy_idx", "sell_id", "sell_idx", "sell_date", "cost", "price").agg(F.sum("quantity").cast(TOTAL).alias("quantity"))  # a pair may span blocks


def open_lots(postings: DataFrame) -> DataFrame:
    """What is left of each lot: account, commodity, external_id, posting_idx, date, units, cost (of a unit), basis."""
    s = stretches(trades(postings))
    left = F.col("high") - F.greatest(F.col("low"), F.coalesce("sold", F.lit(0).cast(TOTAL)))
    return (s.where("side = 'buy'").withColumn("units", left.cast("decimal(19,4)")).where("units > 0")
            .select(*KEY, *ORDER, "date", "units", F.col("price").alias("cost"), times(F.col("units"), F.col("price")).cast(VALUE).alias("basis")))


def realised_gains(postings: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every sale with its quantity, what of it no lot covers, cost of the lots sold, proceeds of what is covered, and gain.

    A sale is the sum of its pieces, covered or not, added up in each block first: neither the pairs of buys and sales are moved nor the
    trades once more. Sales of one id share what covers them."""
    ends = _cut(stretches(trades(postings), "left"), block).where("block IS NOT NULL OR side = 'sell'")
    covered = F.when(F.col("buy").isNotNull(), F.col("quantity"))
    q, cost, price = covered.cast("decimal(19,4)"), F.col("buy.price"), F.col("sell.price")
    line = _pieces(ends, "quantity", "high").where("sell IS NOT NULL").select(
        *KEY, "block", *[F.col(f"sell.{c}").alias(c) for c in [*ORDER, "date", "quantity", "high"]],
        covered.alias("covered"), times(q, cost).cast(VALUE).alias("cost"), times(q, price).cast(VALUE).alias("proceeds"),
        # not from the two sums: their difference would lose its last place
        times(q, (price - cost).cast("decimal(19,4)")).cast(VALUE).alias("gain"), F.lit(1).cast("bigint").alias("n"))
    sale, sums = [*KEY, *ORDER, "date", "quantity", "high"], {"covered": TOTAL, "cost": VALUE, "proceeds": VALUE, "gain": VALUE, "n": "bigint"}
    added = [F.sum(c).cast(kind).alias(c) for c, kind in sums.items()]
    per = line.groupBy(*sale, "block").agg(*added).repartition(*KEY, *ORDER).groupBy(*sale).agg(*added)
    # equal sales without a stretch were added up as one
    per = per.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.when(F.col("high").isNull(), F.col("n")).otherwise(F.lit(1)))))
    named = F.lit(True)
    for c in [*KEY, *ORDER]:
        named = named & F.col(c).isNotNull()
    of_id = lambda c: F.coalesce(F.when(named, F.sum(c).over(Window.partitionBy(*KEY, *ORDER))), F.lit(0).cast("decimal(1,0)"))
    return per.select(*KEY, *ORDER, "date", "quantity", (F.col("quantity") - of_id("covered")).cast(TOTAL).alias("uncovered"),
                      *[of_id(c).cast(VALUE).alias(c) for c in ["cost", "proceeds", "gain"]])
