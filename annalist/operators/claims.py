"""Claims against their sources: relational division, verdict precedence, verification and first-seen states."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import patterns

#: Automaton blocks for which texts are scanned; more items are joined by their words.
SCANS = 4
#: Pairs of excerpts and texts for each of them, up to which a group of one digest is compared outright.
PAIRS = 64
#: Characters of the pieces by which larger groups are compared.
PIECE = 8


def supported(claims: DataFrame, blocks: DataFrame) -> DataFrame:
    """(rule, source, supported): whether one source has every claim of a rule.

    claims: rule, source (allowed), digest, excerpt; blocks: source, digest,
    text. A claim holds where a block of its digest contains the excerpt: the
    digest makes the substring test an equi-join.
    """
    own = claims.select("rule", "source", "digest", "excerpt").distinct()
    hit = occurring_excerpts(own, blocks).withColumn("hit", F.lit(True))
    joined = own.join(hit.hint("merge"), ["source", "digest", "excerpt"], "left")
    return joined.groupBy("rule", "source").agg(F.bool_and(F.coalesce("hit", F.lit(False))).alias("supported"))


def _pieces(c: Column, n: Column) -> Column:
    """The distinct runs of n characters (one at least) of a text."""
    return F.array_distinct(F.regexp_extract_all(c, F.concat(F.lit("(?s)(?=(.{"), n, F.lit("})).")), 1))


def occurring_excerpts(claims: DataFrame, blocks: DataFrame) -> DataFrame:
    """(source, digest, excerpt), distinct: excerpts that a block of their source and digest contains.

    Where a source has many excerpts and many blocks under one digest, an excerpt
    meets only the blocks that have the rarest of its pieces of PIECE characters
    (a shorter excerpt is a piece itself), and is then compared; no group is
    compared with itself pair by pair.
    """
    group = ["source", "digest"]
    wanted = claims.select(*group, "excerpt").where("excerpt is not null").distinct()
    texts = blocks.select(*group, "text").where("text is not null").distinct()
    size = F.least(F.length("excerpt"), F.lit(PIECE))
    ours = wanted.groupBy(*group).agg(F.count("*").alias("a"), F.array_sort(F.collect_set(size)).alias("sizes"))
    both = ours.join(texts.groupBy(*group).agg(F.count("*").alias("b")), group)
    groups = both.select(*group, "sizes", (F.col("a") * F.col("b") > PAIRS * (F.col("a") + F.col("b"))).alias("many"))
    wanted, texts = wanted.join(groups.drop("sizes"), group), texts.join(groups, group)
    holds = F.col("text").contains(F.col("excerpt"))
    few = wanted.where("NOT many").join(texts.where("NOT many").select(*group, "text").hint("merge"), group).where(holds).select(*group, "excerpt")
    many = wanted.where("many").select(*group, "excerpt", size.alias("n"))
    own = many.where("n > 0").select(*group, "excerpt", F.explode(_pieces(F.col("excerpt"), F.col("n"))).alias("piece"))
    cut = texts.where("many").select(*group, "text", F.explode(F.filter("sizes", lambda n: n > 0)).alias("n")).select(*group, "text", F.explode(_pieces(F.col("text"), F.col("n"))).alias("piece"))
    counts = cut.groupBy(*group, "piece").agg(F.count("*").alias("n"))
    met = own.join(counts.hint("merge"), [*group, "piece"], "left")
    rarest = met.groupBy(*group, "excerpt").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("r")).where("r.n > 0").select(*group, "excerpt", F.col("r.piece").alias("piece"))
    whole = rarest.where("excerpt = piece").select(*group, "excerpt")
    longer = rarest.where("excerpt <> piece").join(cut.hint("merge"), [*group, "piece"]).where(holds).select(*group, "excerpt")
    empty = many.where("n = 0").select(*group, "excerpt")
    return few.unionByName(whole).unionByName(longer).unionByName(empty).distinct()


def contained(items: DataFrame, texts: DataFrame, words: int = 3) -> DataFrame:
    """(item, source): items (item, item_text) that a text (source, text) contains literally.

    Both sides are normalised to single spaces and lower case. Items of a few
    automaton blocks are looked for in one scan of the texts for each block. Of
    more, an item of at least `words` words is met through its first words as an
    equi-join key and then compared; shorter items match whole words runs the same
    way, with their own length as key, so no item is compared with every text.
    """
    if patterns.pattern_blocks(items, "item_text") <= SCANS:
        met = patterns.occurring(texts, ["source"], F.col("text"), items, "item_text")
        named = items.select("item", patterns.spaced(F.col("item_text")).alias("pattern"))
        return met.join(named, "pattern").select("item", "source").distinct()
    norm = lambda c: F.lower(F.btrim(F.regexp_replace(c, r"\s+", " ")))
    i = items.select("item", norm(F.col("item_text")).alias("t")).where("t <> ''").withColumn("w", F.split("t", " "))
    i = i.withColumn("n", F.least(F.size("w"), F.lit(words))).withColumn("key", F.array_join(F.slice("w", 1, F.col("n")), " "))
    sizes = [r.n for r in i.select("n").distinct().orderBy("n").collect()]  # `words` numbers at most
    d = texts.select("source", norm(F.col("text")).alias("text"))
    split = d.select("source", F.split("text", " ").alias("w"))

    def runs(n: int) -> Column:
        """The distinct runs of n words of w."""
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("w") - (n - 1)), lambda p: F.array_join(F.slice("w", p, n), " ")))

    grams = [split.where(F.size("w") >= n).select("source", F.lit(n).alias("n"), F.explode(runs(n)).alias("key")) for n in sizes]
    if not grams:
        return i.select("item").join(d.select("source").limit(0), F.lit(True)).select("item", "source")
    met = reduce(DataFrame.unionByName, grams).join(i.select("item", "t", "n", "key"), ["key", "n"])
    return met.join(d.select("source", "text"), "source").where(F.concat(F.lit(" "), "text", F.lit(" ")).contains(F.concat(F.lit(" "), F.col("t"), F.lit(" ")))).select("item", "source").distinct()


def verdict(rows: DataFrame, rule: str, supported_col: Column, uncertain_col: Column) -> DataFrame:
    """(rule, recommended): any support and nothing rejected or unreviewed; any uncertain row blocks."""
    return rows.groupBy(rule).agg((F.coalesce(F.bool_or(supported_col), F.lit(False)) & ~F.coalesce(F.bool_or(uncertain_col), F.lit(False))).alias("recommended"))


def reviewed(contexts: DataFrame, registry: DataFrame) -> DataFrame:
    """contexts (rule, source, context_sha256, sha256, url) with verdict: the registry's where context, raw hash and URL agree, else unreviewed."""
    r = registry.select("rule", "source", "context_sha256", F.col("sha256").alias("r_sha"), F.col("url").alias("r_url"), F.col("verdict").alias("r_verdict"))
    agrees = (F.col("sha256") == F.col("r_sha")) & (F.col("url") == F.col("r_url"))
    return contexts.join(r.hint("merge"), ["rule", "source", "context_sha256"], "left").withColumn("verdict", F.when(agrees, F.col("r_verdict")).otherwise("unreviewed")).drop("r_sha", "r_url", "r_verdict")


def verified(value: Column, passages: Column, text: Column, provenance: Column, limit: int = 240) -> Column:
    """`verified` where a value has passages, each within limit and found in the text, and a provenance; else `unknown`."""
    ok = value.isNotNull() & (F.size(passages) > 0) & provenance.isNotNull() & F.forall(passages, lambda p: (F.length(p) <= limit) & text.contains(p))
    return F.when(F.coalesce(ok, F.lit(False)), "verified").otherwise("unknown")


def with_last_known(facts: DataFrame, previous: DataFrame, key: str | list[str]) -> DataFrame:
    """facts (key, status, value) with last_known of those unknown now: the value verified before, or what was last known then."""
    keys = [key] if isinstance(key, str) else key
    before = F.col("last_known") if "last_known" in previous.columns else F.lit(None)
    p = previous.select(*keys, F.when(F.col("status") == "verified", F.col("value")).otherwise(before).alias("__v"))
    return facts.join(p, keys, "left").withColumn("last_known", F.when(F.col("status") == "unknown", F.col("__v"))).drop("__v")


def first_seen(current: DataFrame, previous: DataFrame, key: str, state: str, today: Column, baseline: Column) -> DataFrame:
    """current with first_seen, first_seen_basis, last_verified and last_changed.

    A key that is new was first observed today (before any baseline: by the
    baseline); verification moves last_verified, a changed state last_changed.
    """
    p = previous.select(key, F.col(state).alias("p_state"), *[F.col(c).alias(f"p_{c}") for c in ("first_seen", "first_seen_basis", "last_verified", "last_changed")], F.lit(True).alias("p_known"))
    known = F.coalesce("p_known", F.lit(False))
    ok = F.col("status") == "recommended"
    moved = ~F.col(state).eqNullSafe(F.col("p_state"))
    return current.join(p, key, "left").select(
        *current.columns,
        F.when(known, F.coalesce("p_first_seen", today)).otherwise(today).alias("first_seen"),
        F.when(known, F.col("p_first_seen_basis")).otherwise(F.when(baseline, "baseline").otherwise("observed")).alias("first_seen_basis"),
        F.when(ok, today).otherwise(F.col("p_last_verified")).alias("last_verified"),
        F.when(known & ~moved, F.col("p_last_changed")).when(known, today).alias("last_changed"),
    )


def practices(rules: DataFrame, claims: DataFrame, sources: DataFrame, blocks: DataFrame, registry: DataFrame, previous: DataFrame, today: Column, limit: int = 420) -> DataFrame:
    """The state of every practice: (id, category, summary, status, first_seen, first_seen_basis, last_verified, last_changed, evidence).

    rules: id, category, summary, source (one row for each source a rule may
    rest on); claims: id, digest, excerpt; sources: source, url, sha256,
    context_sha256; blocks: source, digest, text; registry: as in reviewed();
    previous: the state before, with its evidence. A rule is recommended when
    a source that was reviewed as supporting has all its claims, none longer than
    limit, and no source is unreviewed, rejected or without its claims; a source
    that is missing, or reviewed as not conflicting, says nothing. Tables that grow
    with the rules are merged: what is small when compressed need not fit the
    driver as a broadcast.
    """
    contexts = rules.select(F.col("id").alias("rule"), "source").join(sources.select("source", "url", "sha256", "context_sha256"), "source")
    judged = reviewed(contexts, registry)
    wanted = judged.where("verdict = 'supported'").select("rule", "source").join(claims.withColumnRenamed("id", "rule").hint("merge"), "rule")
    fits = wanted.groupBy("rule", "source").agg(F.max(F.length("excerpt")).alias("longest"))
    held = supported(wanted, blocks).join(fits.hint("merge"), ["rule", "source"]).select("rule", "source", (F.col("supported") & (F.col("longest") <= limit)).alias("held"))
    rows = judged.join(held.hint("merge"), ["rule", "source"], "left")
    good, bad = F.col("held") & (F.col("verdict") == "supported"), (F.col("verdict") != "non_conflicting") & ~F.coalesce("held", F.lit(False))
    kept = verdict(rows, "rule", good, bad)
    refs = rows.where("held").select("rule", "source", "url", "sha256", "context_sha256").join(claims.withColumnRenamed("id", "rule").hint("merge"), "rule")
    listed = refs.groupBy("rule").agg(F.array_sort(F.collect_set(F.struct("source", "url", "sha256", "context_sha256", "excerpt"))).alias("evidence"))
    own = rules.select("id", "category", "summary").distinct().join(kept.withColumnRenamed("rule", "id").hint("merge"), "id", "left").join(listed.withColumnRenamed("rule", "id").hint("merge"), "id", "left")
    ok = F.coalesce("recommended", F.lit(False))
    now = own.select("id", "category", "summary", F.when(ok, "recommended").otherwise("unknown").alias("status"), F.when(ok, F.col("evidence")).otherwise(F.array().cast(listed.schema["evidence"].dataType)).alias("evidence"))
    p = previous.select("id", F.struct(*[c for c in previous.columns if c != "id"]).alias("p"))
    both = now.join(p.hint("merge"), "id", "left")
    known, old = F.col("p").isNotNull(), lambda c: F.col(f"p.{c}")
    basis = F.when(known, F.coalesce(old("first_seen_basis"), F.when(old("first_seen").isNotNull(), "observed").otherwise("unknown_legacy"))).otherwise("not_yet_supported")
    begins = (F.col("status") == "recommended") & (basis == "not_yet_supported")
    same = known & old("evidence").eqNullSafe(F.col("evidence")) & old("summary").eqNullSafe(F.col("summary"))
    still = known & F.lit(True)
    for c in ("category", "status", "summary"):
        still &= old(c).eqNullSafe(F.col(c))
    return both.select(
        "id",
        "category",
        "summary",
        "status",
        F.when(begins, today).otherwise(old("first_seen")).alias("first_seen"),
        F.when(begins, "observed").otherwise(basis).alias("first_seen_basis"),
        F.when((F.col("status") == "recommended") & ~same, today).when(old("summary").eqNullSafe(F.col("summary")), old("last_verified")).alias("last_verified"),
        F.when(still, old("last_changed")).otherwise(today).alias("last_changed"),
        "evidence",
    )


def interpreted(sections: DataFrame, registry: DataFrame, model: str) -> DataFrame:
    """sections (id, model, section, text_sha256, complete_sha256) with summary and summary_kind of a reviewed interpretation.

    registry: section, text_sha256, complete_sha256, summary. The hash of the
    whole section decides where the section has one, else that of its text; only
    sections of one model are interpreted, all others are unknown.
    """
    r = registry.select("section", F.col("text_sha256").alias("__t"), F.col("complete_sha256").alias("__c"), F.col("summary").alias("__s"))
    agrees = F.when(F.col("complete_sha256").isNotNull(), F.col("complete_sha256") == F.col("__c")).otherwise(F.col("text_sha256") == F.col("__t"))
    ok = F.coalesce((F.col("model") == model) & agrees & F.col("__s").isNotNull(), F.lit(False))
    out = sections.join(F.broadcast(r), "section", "left")
    return out.withColumn("summary", F.when(ok, F.col("__s"))).withColumn("summary_kind", F.when(ok, "repository-interpretation").otherwise("unknown")).drop("__t", "__c", "__s")
