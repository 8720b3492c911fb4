"""URL filtering by rules and by mined token combinations.

Rules (host, path) fit a host and its subdomains if the url's path starts with theirs; the longest fitting rule
decides. For all other urls association rules decide: frequent-pattern growth mines the token combinations of
labelled urls, and those that imply the label `block` with enough support and confidence are kept. Tokens that always
occur together are mined as one. Rules are applied through an inverted index: each is listed under its rarest token
class, meets the urls that hold it, and is checked against all classes of the url.

Tokens: scheme, host, registered name and each label, path segments (numbers as one token), extension, query keys.

Only DataFrame functions and Spark's pattern miner. Labels are of ids; an id with any bad label is bad.

Defined results: null urls, and urls without `://`, have empty host and path and no token: no rule, allowed;
repeated rows are judged alike; without labels nothing is mined and only the rules block; extra columns are kept,
columns of the outputs' names are replaced and columns that begin with `_u_` are dropped.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stage import staged

SUPPORT, ROWS, CONFIDENCE = 0.001, 30, 0.8   # share and number of labelled urls, and their share of bad ones
WIDTH = 12                                   # token classes of a labelled url whose combinations are all listed
BLOCK, ALLOW = "!block", "!allow"


def host(url: Column) -> Column:
    """What follows the first `://`, up to `/`, `?` or `#`, with A-Z lowered."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host, up to `?` or `#`."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest of the rules (host/path -> verdict) that fits; else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def tokens(url: Column) -> Column:
    """The distinct tokens of a url."""
    h, p = host(url), path(url)
    labels = F.filter(F.split(h, r"\."), lambda x: x != "")
    segments = F.filter(F.split(p, "/"), lambda x: x != "")
    plain = F.transform(segments, lambda x: F.regexp_replace(x, "[0-9]+", "0"))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^([^=]*)", 1)), lambda x: x != "")
    scheme = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(.*?)://", 1))
    own = F.array(F.concat(F.lit("s:"), scheme), F.concat(F.lit("h:"), h),
                  F.concat(F.lit("r:"), F.substring_index(h, ".", -2)))
    every = F.array_distinct(F.concat(own, F.transform(labels, lambda x: F.concat(F.lit("l:"), x)),
                                      F.transform(plain, lambda x: F.concat(F.lit("p:"), x)),
                                      F.transform(keys, lambda x: F.concat(F.lit("q:"), x))))
    return F.when(F.coalesce(url, F.lit("")).contains("://"), every).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, support: float = SUPPORT, rows: int = ROWS, confidence: float = CONFIDENCE, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """Rules (rare, antecedent, confidence, support) over classes of tokens, from labelled urls (url, bad), and the classes
    (token, class) they use; rare: the rarest class.

    Tokens of the same labelled urls are one class (a host, its labels and its registered name, say): whichever of them a
    rule holds, it counts alike, so a url has the class if it has any of its tokens. All combinations count: where no labelled url
    has more than `width` frequent classes Spark's miner lists them, else patterns are grown without those no verdict can need."""
    spark, schema = labelled.sparkSession, "rare string, antecedent array<string>, confidence double, support double"
    known = staged(labelled.where("url LIKE '%://%'").select(F.monotonically_increasing_id().alias("row"), tokens(F.col("url")).alias("tokens"), "bad"))
    n = known.count()
    if n < rows:
        return spark.createDataFrame([], schema), spark.createDataFrame([], "token string, class string")
    least = max(rows, math.ceil(support * n))
    each = known.select("row", "bad", F.explode("tokens").alias("token"))
    held = each.groupBy("token").agg(F.count("*").alias("freq"), F.sum(F.col("bad").cast("int")).alias("bads"),
                                     F.bit_xor(F.xxhash64("row")).alias("a"), F.bit_xor(F.xxhash64(F.lit("second"), "row")).alias("b"))
    held = staged(held.where(F.col("freq") >= least))
    classes = staged(held.groupBy("freq", "bads", "a", "b").agg(F.min("token").alias("class")).join(held, ["freq", "bads", "a", "b"]).select("token", "class", "freq", "bads"))
    some = each.join(classes, "token").select("row", "class").distinct().groupBy("row").agg(F.collect_list("class").alias("classes"))
    if some.where(F.size("classes") > width).isEmpty():
        rules = patterns(known, some, least, n, confidence)
    else:
        rules = grown(known.select("row", "bad"), each.join(classes, "token").select("row", "class", "freq", "bads").distinct(), least, n, confidence)
    single = classes.select("class", "freq").distinct()
    rare = (rules.select("*", F.explode("antecedent").alias("class")).join(single, "class").groupBy("antecedent", "confidence", "support")
            .agg(F.min(F.struct("freq", "class"))["class"].alias("rare")))
    mined = staged(rare.select("rare", "antecedent", "confidence", "support"))
    used = mined.select(F.explode("antecedent").alias("class")).distinct()
    return mined, staged(classes.select("token", "class").join(used, "class"))


def patterns(known: DataFrame, some: DataFrame, least: int, n: int, confidence: float) -> DataFrame:
    """Rules (antecedent, confidence, support) of all combinations of the classes of a row, by Spark's miner."""
    items = staged(known.select("row", "bad").join(some, "row", "left").select(
        F.concat(F.coalesce("classes", F.array().cast("array<string>")), F.array(F.when(F.col("bad"), BLOCK).otherwise(ALLOW))).alias("items")))
    # half a row less, so that the share gives back this number of rows whatever its rounding
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=confidence).fit(items)
    rules = model.associationRules.where(F.col("consequent")[0] == BLOCK).where(F.size("antecedent") > 0)
    return rules.select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support")


def grown(rows: DataFrame, held: DataFrame, least: int, n: int, confidence: float) -> DataFrame:
    """The same rules without those that change no verdict and no confidence, for urls of many classes: patterns grow by a class
    a round, each over the rows that hold it. rows: (row, bad); held: (row, class, freq, bads).

    Left out are extensions that no rule can need: of a pattern of bad urls only, by a class that all its rows hold or that makes it one of
    bad urls only by itself, and all of a pattern whose rows include too many good ones that hold every class it could grow by."""
    # what a class does alone decides for every pattern with it
    classes = staged(held.select("class", "freq", "bads").distinct().where(F.col("bads") >= least))
    rule = lambda of: of.where(F.col("bads") / F.col("freq") >= confidence)
    say = lambda of: rule(of).select(F.array_sort("pattern").alias("antecedent"), (F.col("bads") / F.col("freq")).alias("confidence"), (F.col("bads") / n).alias("support"))
    out = [say(classes.select(F.array("class").alias("pattern"), "freq", "bads"))]
    none = F.array().cast("array<string>")
    held = held.join(classes.select("class"), "class", "left_semi")
    # rarest class first; rows alike are one, with the number of bad and of all
    each = held.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("freq", "class"))), lambda x: x["class"]).alias("tail")).join(rows, "row")
    alike = lambda of: of.groupBy("pattern", "tail").agg(F.sum("bads").alias("bads"), F.sum("freq").alias("freq"))
    at = staged(alike(each.select(none.alias("pattern"), "tail", F.col("bad").cast("bigint").alias("bads"), F.lit(1).cast("bigint").alias("freq"))))
    total = rows.agg(F.sum(F.col("bad").cast("bigint")).alias("bads"), F.count("*").alias("freq"))
    known = total.select(none.alias("pattern"), "bads", "freq")
    while not at.isEmpty():
        by = at.select("pattern", F.explode("tail").alias("class"), "bads", "freq").groupBy("pattern", "class").agg(F.sum("bads").alias("bads"), F.sum("freq").alias("freq"))
        by = staged(by.where(F.col("bads") >= least))
        longer = by.select(F.concat("pattern", F.array("class")).alias("pattern"), "bads", "freq")
        out.append(say(longer.where(F.size("pattern") > 1)))
        above = known.select("pattern", F.col("bads").alias("_bads"), F.col("freq").alias("_freq"))
        use = by.join(above, "pattern").where((F.col("freq") > F.col("bads")) & (F.col("freq") < F.col("_freq")))
        use = use.groupBy("pattern").agg(F.collect_list("class").alias("use"), F.max("bads").alias("most"))
        cut = at.join(use, "pattern").select("pattern", F.array_intersect("tail", "use").alias("tail"), "use", "most", "bads", "freq")
        full = F.sum(F.when(F.size("tail") == F.size("use"), F.col("freq") - F.col("bads")).otherwise(0))
        hopeful = cut.groupBy("pattern").agg(full.alias("good"), F.max("most").alias("most")).where(F.col("most") / (F.col("most") + F.col("good")) >= confidence)
        next_ = cut.join(hopeful.select("pattern"), "pattern", "left_semi").select("pattern", F.posexplode("tail").alias("i", "class"), "tail", "bads", "freq")
        next_ = next_.select(F.concat("pattern", F.array("class")).alias("pattern"), F.slice("tail", F.col("i") + 2, F.greatest(F.size("tail"), F.lit(1))).alias("tail"), "bads", "freq")
        at = staged(alike(next_.where(F.size("tail") > 0)))
        known = longer
    return staged(reduce(DataFrame.unionByName, out))


def blocked_urls(urls: DataFrame, mined: DataFrame, classes: DataFrame) -> DataFrame:
    """The distinct urls that a mined rule blocks, with the confidence of the surest. Only urls with a class of some rule
    are looked up, each rule under its rarest class."""
    held = urls.select("url").where("url IS NOT NULL").distinct().select("url", F.explode(tokens(F.col("url"))).alias("token"))
    held = held.join(classes, "token").groupBy("url").agg(F.collect_set("class").alias("classes"))
    meeting = held.select("url", "classes", F.explode("classes").alias("rare")).join(mined, "rare")
    fitting = meeting.where(F.size(F.array_except("antecedent", "classes")) == 0)
    return fitting.groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, labels: DataFrame, rules: dict[str, str], key: str = "page_id", url: str = "url") -> DataFrame:
    """pages with host, path, rule, verdict and the confidence of the mined rule that blocks. labels: (id, bad)."""
    per = labels.select(F.col("id").alias("_u_id"), "bad").groupBy("_u_id").agg(F.max("bad").alias("bad"))
    labelled = pages.select(F.col(key).alias("_u_id"), F.col(url).alias("url")).join(per, "_u_id").where("bad IS NOT NULL")
    mined, classes = mine(labelled.select("url", "bad"))
    blocked = blocked_urls(pages.select(F.col(url).alias("url")), mined, classes).select(F.col("url").alias("_u_url"), F.col("confidence").alias("_u_conf"))
    judged = pages.withColumns({"_u_host": host(F.col(url)), "_u_path": path(F.col(url))})
    judged = judged.withColumn("_u_rule", rule_of(F.col("_u_host"), F.col("_u_path"), rules))
    judged = judged.join(blocked, judged[url] == blocked["_u_url"], "left")
    verdicts = F.create_map(*[F.lit(x) for kv in rules.items() for x in kv]) if rules else None
    mined_verdict = F.when(F.col("_u_conf").isNotNull(), "block").otherwise("allow")
    judged = judged.withColumns({
        "host": F.col("_u_host"), "path": F.col("_u_path"), "rule": F.col("_u_rule"), "confidence": F.col("_u_conf"),
        "verdict": F.coalesce(verdicts[F.col("_u_rule")], mined_verdict) if rules else mined_verdict})
    return judged.drop(*[c for c in judged.columns if c.startswith("_u_")])


def check_sql(rules: dict[str, str]) -> str:
    """judge() over the tables pages and labels: every token combination of every labelled url is counted."""
    listed = ", ".join(f"('{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{v}')" for r, v in rules.items())
    return rf"""
WITH u AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
h AS (SELECT page_id, u, contains(u, '://') AS real, translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, lower(regexp_extract(u, '(?s)^(.*?)://', 1)) AS scheme,
             regexp_extract(u, '(?s)^.*?://[^?#]*\?([^#]*)', 1) AS query FROM u),
t AS (SELECT *, CASE WHEN real THEN list_sort(list_distinct(['s:' || scheme, 'h:' || host, 'r:' || array_to_string(string_split(host, '.')[-2:], '.')]
        || list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'l:' || x)
        || list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: 'p:' || regexp_replace(x, '[0-9]+', '0', 'g'))
        || list_transform(list_filter(list_transform(string_split(query, '&'), lambda x: regexp_extract(x, '^([^=]*)', 1)), lambda x: x <> ''), lambda x: 'q:' || x)))
      ELSE [] END AS tokens FROM h),
lab AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY doc_id),
seen AS (SELECT tokens, bad FROM t JOIN lab ON doc_id = page_id WHERE real),
least AS (SELECT CASE WHEN count(*) < {ROWS} THEN NULL ELSE greatest({ROWS}, ceil({SUPPORT} * count(*))) END AS least FROM seen),
sets AS (SELECT list_filter(tokens, lambda x, i: (m >> (i - 1)) & 1 = 1) AS items, bad FROM (SELECT tokens, bad, unnest(range(1, 1 << len(tokens))) AS m FROM seen)),
mined AS (SELECT items, sum(bad) / CAST(count(*) AS double) AS confidence FROM sets GROUP BY items
          HAVING sum(bad) >= (SELECT least FROM least) AND sum(bad) / CAST(count(*) AS double) >= {CONFIDENCE}),
sure AS (SELECT tokens, max(confidence) AS confidence FROM (SELECT DISTINCT tokens FROM t) JOIN mined ON list_has_all(tokens, items) GROUP BY tokens),
given(rule, name, start, says) AS (VALUES {listed}),
fit AS (SELECT DISTINCT host, path, arg_max(rule, (length(rule), rule)) AS rule, arg_max(says, (length(rule), rule)) AS says
        FROM (SELECT DISTINCT host, path FROM t) JOIN given ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start) GROUP BY host, path)
SELECT page_id, t.host, t.path, rule, coalesce(says, CASE WHEN confidence IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, confidence
FROM t LEFT JOIN sure ON sure.tokens = t.tokens LEFT JOIN fit ON fit.host = t.host AND fit.path = t.path
"""
