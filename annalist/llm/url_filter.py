"""URL filter: explicit host and path rules, then mined association rules.

URLs that a rule decides are the labelled transactions. FP-growth mines their
token combinations together with the label, combinations are pruned by support
and confidence, and the rest of the URLs are decided by the mined rules, found
by an inverted index on each rule's rarest token. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .workspace import materialise

#: (verdict, host, path): a rule fits its host and all subdomains where the path starts with the rule's.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
SUPPORT, CONFIDENCE, DEFAULT = 0.005, 0.8, "allow"
#: Most labelled transactions mined, and most classes of tokens of one of them; matching takes all tokens.
SAMPLE_ROWS, TOKENS = 200_000, 24
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ://, up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule (then the longest host, then block), or null."""
    best = None
    for verdict, own_host, own_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block")):
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(own_path)
        found = F.struct(F.lit(own_host + own_path).alias("rule"), F.lit(verdict).alias("verdict"))
        best = F.when(fits, found) if best is None else best.when(fits, found)
    return best if best is not None else F.lit(None).cast("struct<rule: string, verdict: string>")


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL: all host suffixes, first label, path words (digits as #), file type, query keys, scheme."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: F.concat(F.lit("host:"), F.array_join(F.slice(labels, F.greatest(n - k + 1, F.lit(1)), k), ".")))
    words = F.transform(F.filter(F.split(F.translate(path, UPPER, LOWER), r"[/._-]+"), lambda x: x != ""), lambda x: F.concat(F.lit("path:"), F.regexp_replace(x, r"[0-9]+", "#")))
    place = F.transform(F.slice(F.filter(F.split(F.translate(path, UPPER, LOWER), "/"), lambda x: x != ""), 1, 1), lambda x: F.concat(F.lit("top:"), F.regexp_replace(x, r"[0-9]+", "#")))
    keys = F.transform(F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#]+)="), 1), lambda x: F.concat(F.lit("query:"), x))
    first = F.when(n > 2, F.array(F.concat(F.lit("label:"), F.element_at(labels, 1)))).otherwise(F.array().cast("array<string>"))
    scheme = F.array(F.concat(F.lit("scheme:"), F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1), UPPER, LOWER)))
    return F.array_distinct(F.concat(suffixes, place, first, words, keys, scheme))


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, rows: int = SAMPLE_ROWS) -> tuple[DataFrame, DataFrame]:
    """Rules (ante array<string>, verdict, confidence, support, seed) from rows (id, tokens, verdict), and classes (token, class).

    A rule is a frequent token combination with one verdict, of at least this
    support and confidence, that no shorter combination within it already gives
    with as much confidence. Tokens of just the same transactions are one class
    and mined as one: a combination with two of them is no better than with one,
    so a rule names classes, and a URL has a class by any token of it. seed is a
    rule's rarest class. Tokens that are too rare for a rule are left out, which
    changes no rule; of a transaction that still has more than TOKENS classes,
    those nearest the root of host and path are mined.
    """
    n = labelled.count()
    rate = min(1.0, rows / max(1, n))
    sample = labelled.where(F.pmod(F.xxhash64("id", F.lit("url")), F.lit(1 << 20)) < int(rate * (1 << 20)))
    drawn = materialise(sample.select("tokens", "verdict", F.monotonically_increasing_id().alias("row")), "drawn")
    said = drawn.select("row", "verdict", F.posexplode("tokens").alias("pos", "token"))
    mark = F.xxhash64("row")
    held = said.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor(mark).alias("x"), F.sum(mark.bitwiseAND(F.lit((1 << 31) - 1))).alias("s")).where(F.col("n") >= support * drawn.count())
    held = materialise(held, "held")
    classes = materialise(held.join(held.groupBy("n", "x", "s").agg(F.min("token").alias("class")), ["n", "x", "s"]).select("token", "class"), "classes")
    own = said.join(classes, "token").groupBy("row", "verdict", "class").agg(F.min("pos").alias("pos")).groupBy("row", "verdict").agg(F.array_sort(F.collect_list(F.struct("pos", "class"))).alias("c"))
    own = drawn.select("row", "verdict").join(own, ["row", "verdict"], "left")
    items = F.slice(F.transform(F.coalesce("c", F.array().cast("array<struct<pos: int, class: string>>")), lambda x: x["class"]), 1, TOKENS)
    baskets = materialise(own.select(F.concat(items, F.array(F.concat(F.lit("verdict:"), F.col("verdict")))).alias("items")), "baskets")
    partitions = max(1, int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    frequent = materialise(FPGrowth(itemsCol="items", minSupport=support, numPartitions=partitions).fit(baskets).freqItemsets, "itemsets")
    total = baskets.count()
    isv = lambda x: x.startswith("verdict:")
    split = frequent.withColumn("v", F.filter("items", isv)).withColumn("ante", F.array_sort(F.filter("items", lambda x: ~isv(x))))
    with_verdict = split.where((F.size("v") == 1) & (F.size("ante") > 0)).select("ante", F.substring(F.element_at("v", 1), 9, 100).alias("verdict"), "freq")
    whole = split.where(F.size("v") == 0).select("ante", F.col("freq").alias("base"))
    rules = with_verdict.join(whole, "ante").select("ante", "verdict", (F.col("freq") / F.col("base")).alias("confidence"), (F.col("freq") / F.lit(float(max(1, total)))).alias("support")).where(F.col("confidence") >= confidence)
    rules = materialise(rules, "rules")
    # a rule is redundant when it holds a shorter rule's tokens, with one token less, at no less confidence
    less = rules.select("ante", "verdict", "confidence", F.explode("ante").alias("gone")).select(F.array_remove(F.col("ante"), F.col("gone")).alias("inner"), "verdict", "ante", "confidence")
    covered = less.join(rules.select(F.col("ante").alias("inner"), "verdict", F.col("confidence").alias("had")), ["inner", "verdict"]).where("had >= confidence").select("ante", "verdict").distinct()
    kept = rules.join(covered, ["ante", "verdict"], "left_anti")
    single = whole.where(F.size("ante") == 1).select(F.element_at("ante", 1).alias("token"), "base")
    rarest = kept.select("ante", "verdict", F.explode("ante").alias("token")).join(single, "token").groupBy("ante", "verdict").agg(F.min(F.struct("base", "token")).alias("r"))
    return materialise(kept.join(rarest, ["ante", "verdict"]).select("ante", "verdict", "confidence", "support", F.col("r.token").alias("seed")), "mined"), classes


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, support: float = SUPPORT, confidence: float = CONFIDENCE, default: str = DEFAULT) -> DataFrame:
    """pages' id, url, host, path, rule, verdict, reason and score.

    reason is `rule`, `mined` or `default`; score is a mined rule's confidence
    (1 for a rule, null by default). Of several mined rules that fit, the most
    confident decides, then the longer, then the better supported, then block. A
    null URL or one without :// has empty host and path. Repeated ids and rows
    are judged each, equal URLs alike; all tokens of a very long URL count.
    Without a URL that a rule decides, the default decides the rest.
    """
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    parsed = parsed.withColumn("r", fitting_rule(F.col("host"), F.col("path"), rules)).withColumn("tokens", tokens_of(F.col("url"), F.col("host"), F.col("path")))
    labelled = parsed.where("r is not null").select(F.col("page_id").alias("id"), "tokens", F.col("r.verdict").alias("verdict"))
    mined, classes = mine(labelled, support, confidence)
    # URLs with the same tokens are judged once, by the classes of their tokens
    patterns = parsed.where("r is null").select("tokens").distinct()
    known = patterns.select("tokens", F.explode("tokens").alias("token")).join(classes, "token").groupBy("tokens").agg(F.collect_set("class").alias("have"))
    hits = (
        known.withColumn("seed", F.explode("have"))
        .join(mined, "seed")
        .where(F.size(F.array_except("ante", "have")) == 0)
        .groupBy("tokens")
        .agg(F.max(F.struct("confidence", F.size("ante").alias("n"), "support", (F.col("verdict") == "block").alias("blocks"))).alias("m"))
    )
    # read back from a table, a token set that many URLs share can be split by the join, or the table broadcast where it is small
    hits = materialise(hits, "hits")
    ruled = parsed.where("r is not null").withColumn("m", F.lit(None).cast(hits.schema["m"].dataType))
    decided = parsed.where("r is null").join(hits, "tokens", "left").unionByName(ruled)
    by_mined = F.when(F.col("m.blocks"), "block").when(F.col("m").isNotNull(), "allow")
    return decided.select(
        "page_id",
        "url",
        "host",
        "path",
        F.col("r.rule").alias("rule"),
        F.when(F.col("r").isNotNull(), F.col("r.verdict")).otherwise(F.coalesce(by_mined, F.lit(default))).alias("verdict"),
        F.when(F.col("r").isNotNull(), "rule").when(F.col("m").isNotNull(), "mined").otherwise("default").alias("reason"),
        F.when(F.col("r").isNotNull(), F.lit(1.0)).otherwise(F.col("m.confidence")).alias("score"),
    )
