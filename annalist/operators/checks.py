"""Integrity constraints: each gives the rows that break it, and a run of them the first diagnostic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hashing, text


def _rows(df: DataFrame, rule: str, key: str) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"))


def unresolved(citations: DataFrame, sources: DataFrame, key: str = "source_id", state: str = "sha256", rule: str = "citation") -> DataFrame:
    """Citations whose source is missing or has another hash."""
    return _rows(citations.join(sources.select(key, state), [key, state], "left_anti"), rule, key)


def unreferenced(rows: DataFrame, column: str, target: DataFrame, target_column: str, rule: str) -> DataFrame:
    """Rows whose reference is not null and has no target."""
    return _rows(rows.where(F.col(column).isNotNull()).join(target.select(F.col(target_column).alias(column)), column, "left_anti"), rule, column)


def repeated(rows: DataFrame, keys: list[str], rule: str) -> DataFrame:
    return rows.groupBy(*keys).count().where("count > 1").select(F.lit(rule).alias("rule"), F.concat_ws("|", *keys).alias("key"))


def failing(rows: DataFrame, key: str, ok: Column, rule: str) -> DataFrame:
    """Rows for which a predicate is not true (null included)."""
    return _rows(rows.where(~F.coalesce(ok, F.lit(False))), rule, key)


def practice_violations(practices: DataFrame, limit: int = 420) -> DataFrame:
    """A recommended practice has evidence, whose fields are complete and whose excerpts fit."""
    whole = (F.col("status") != "recommended") | (
        (F.size("evidence") > 0) & F.forall("evidence", lambda e: text.nonblank(e["source_id"]) & text.nonblank(e["url"]) & text.nonblank(e["sha256"]) & (F.length(e["excerpt"]) <= limit))
    )
    return failing(practices, "id", whole, "practice-evidence")


def fact_violations(facts: DataFrame) -> DataFrame:
    """An unknown fact has no value; a verified one has a value and evidence."""
    ok = F.when(F.col("status") == "unknown", F.col("value").isNull()).when(F.col("status") == "verified", F.col("value").isNotNull() & (F.size("evidence") > 0)).otherwise(True)
    return failing(facts, "claim", ok, "fact")


def evidence_violations(facts: DataFrame, values: DataFrame, sources: DataFrame, by: list[str]) -> DataFrame:
    """(rule, key): a state whose value is not its property's, an unknown property with a value, a verified one without evidence, evidence without excerpt or of another content than its source has.

    facts: by..., claim, status, value, evidence (source_id, sha256, excerpt);
    values: by..., claim, value; sources: source_id, sha256. Evidence of a source
    that is not listed is of other content.
    """
    key = F.concat_ws("|", *by, "claim")
    told = facts.select(*by, "claim", "status", "value", "evidence").join(values.select(*by, "claim", F.col("value").alias("stated")), [*by, "claim"], "full_outer")
    differ = told.where("NOT (value <=> stated)").select(F.lit("value-disagrees").alias("rule"), key.alias("key"))
    known = told.where("status = 'unknown' AND value IS NOT NULL").select(F.lit("unknown-with-value").alias("rule"), key.alias("key"))
    bare = told.where("status IS NOT NULL AND status <> 'unknown' AND (status <> 'verified' OR coalesce(size(evidence), 0) = 0)").select(F.lit("not-verified").alias("rule"), key.alias("key"))
    cited = facts.where("status = 'verified'").select(key.alias("key"), F.explode("evidence").alias("e")).select("key", "e.source_id", "e.sha256", "e.excerpt")
    stale = cited.join(sources.select("source_id", F.col("sha256").alias("now")), "source_id", "left").where("coalesce(excerpt, '') = '' OR NOT (sha256 <=> now)")
    return differ.unionByName(known).unionByName(bare).unionByName(stale.select(F.lit("evidence-not-current").alias("rule"), "key").distinct())


def fingerprint_violations(states: DataFrame, fields: list[str], key: str) -> DataFrame:
    """Rows whose fingerprint is not the hash of their canonical fields."""
    return failing(states, key, F.col("fingerprint") == hashing.fingerprint(**{c: F.col(c) for c in fields}), "fingerprint")


def set_differences(a: DataFrame, b: DataFrame, keys: list[str], attributes: list[str], rule: str) -> DataFrame:
    """Keys of either side only, or whose attributes differ."""
    mark = lambda df, n: df.select(*keys, F.xxhash64(F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(c) for c in attributes]))).alias(n))
    both = mark(a, "x").join(mark(b, "y"), keys, "full_outer").where("not (x <=> y)")
    return both.select(F.lit(rule).alias("rule"), F.concat_ws("|", *keys).alias("key"))


def trusted_location(source_type: Column, source_id: Column, url: Column, commit: Column, tag: Column, shapes: list[tuple[str, str, str]]) -> Column:
    """Whether a record's URL is one its type allows.

    shapes: (source type, identity pattern, URL template); a template's {commit}
    and {tag} stand for the record's own (a commit of 40 lower-case hex digits).
    """
    out = F.lit(False)
    for kind, identity, template in shapes:
        want = F.lit(template)
        for name, value in (("{commit}", commit), ("{tag}", tag)):
            if name in template:
                want = F.replace(want, F.lit(name), value)
        ok = (source_type == kind) & source_id.rlike(f"^(?:{identity})\\z") & (url == want)
        if "{commit}" in template:
            ok &= commit.rlike(r"^[0-9a-f]{40}\z")
        out |= F.coalesce(ok, F.lit(False))
    return out


def binding_violations(bindings: DataFrame, catalog: DataFrame, keys: list[str]) -> DataFrame:
    """Retained tag bindings (keys, commit) that the catalog binds otherwise or not at all."""
    c = catalog.select(*keys, F.col("commit").alias("now"))
    return bindings.join(c, keys, "left").where("not (commit <=> now)").select(F.lit("tag-binding").alias("rule"), F.concat_ws("|", *keys).alias("key"))


def missing_outputs(present: DataFrame, required: list[str], pending: DataFrame) -> DataFrame:
    """Required names that present (name) lacks, and every batch of pending (name) that was begun and not finished."""
    spark = present.sparkSession
    names = spark.createDataFrame([(x,) for x in required], "name string")
    lost = _rows(names.join(present.select("name"), "name", "left_anti"), "missing-output", "name")
    return lost.unionByName(_rows(pending, "pending-batch", "name"))


def item_violations(items: DataFrame, sources: DataFrame) -> DataFrame:
    """Structured items (layer, id, status, provenance) whose id repeats, whose provenance is missing or incomplete, or cites another state of a source.

    Items that are unknown may cite sources that have moved on.
    """
    twice = repeated(items, ["layer", "id"], "repeated-item")
    none = failing(items, "id", F.size("provenance") > 0, "item-without-provenance")
    cited = items.select("id", "status", F.explode("provenance").alias("s")).select("id", "status", "s.*")
    whole = text.nonblank(F.col("source_id")) & text.nonblank(F.col("url")) & text.nonblank(F.col("sha256"))
    partial = failing(cited, "id", whole, "incomplete-provenance")
    moved = cited.where("coalesce(status, '') <> 'unknown'").where(whole).join(sources.select("source_id", "sha256"), ["source_id", "sha256"], "left_anti")
    return twice.unionByName(none).unionByName(partial).unionByName(_rows(moved, "stale-provenance", "id").distinct())


def identity_violations(limitations: DataFrame, capabilities: DataFrame) -> DataFrame:
    """Limitations whose id does not begin with their model; capabilities of which a source's URL is not that of their commit."""
    named = failing(limitations, "id", F.col("id").startswith(F.concat("model", F.lit(":"))), "limitation-identity")
    pinned = failing(capabilities, "id", F.forall("provenance", lambda s: s["url"].contains(F.col("source_commit"))), "capability-provenance")
    return named.unionByName(pinned)


def review_violations(practices: DataFrame, rules: DataFrame, reviews: DataFrame, registry: DataFrame, sources: DataFrame) -> DataFrame:
    """Where the reviews of practices disagree with the rules, the registry of reviews or the sources.

    practices: id, category, summary, status; rules: id, category, summary,
    source; reviews: id, source, verdict, context_sha256, sha256, url; registry:
    as in claims.reviewed; sources: source, sha256, url.
    """
    from .claims import reviewed

    inventory = set_differences(practices, rules.select("id", "category", "summary").distinct(), ["id"], ["category", "summary"], "practice-inventory")
    twice = repeated(reviews, ["id", "source"], "repeated-review")
    pairs = set_differences(reviews.select("id", "source").distinct(), rules.select("id", "source").distinct(), ["id", "source"], ["source"], "configured-reviews")
    now = reviews.join(sources.select("source", F.col("sha256").alias("now_sha"), F.col("url").alias("now_url")), "source", "left")
    absent = failing(now.where("now_sha is null"), "id", (F.col("verdict") == "unavailable") & F.col("context_sha256").isNull() & F.col("sha256").isNull(), "review-of-absent-source")
    here = now.where("now_sha is not null")
    identity = failing(here, "id", F.col("context_sha256").rlike(r"^[0-9a-f]{64}\z"), "context-identity")
    given = here.select("id", "source", F.col("verdict").alias("given"), F.col("context_sha256"), "sha256", "url", "now_sha", "now_url")
    same = F.col("sha256").eqNullSafe(F.col("now_sha")) & F.col("url").eqNullSafe(F.col("now_url"))  # before the join, which then sorts less
    wanted = reviewed(given.select(F.col("id").alias("rule"), "source", "context_sha256", F.col("now_sha").alias("sha256"), F.col("now_url").alias("url"), "given", same.alias("same")), registry)
    agrees = (F.col("given") == F.col("verdict")) & F.col("same")
    verdicts = failing(wanted, "rule", agrees, "review-verdict")
    status = reviews.groupBy("id").agg((F.bool_or(F.col("verdict") == "supported") & ~F.bool_or(F.col("verdict").isin("unreviewed", "rejected"))).alias("good"))
    wrong = failing(practices.join(status, "id", "left"), "id", (F.col("status") == "recommended") == F.coalesce("good", F.lit(False)), "practice-status")
    return inventory.unionByName(twice).unionByName(pairs).unionByName(absent).unionByName(identity).unionByName(verdicts).unionByName(wrong)


def historical_violations(citations: DataFrame, trusted: DataFrame, current: DataFrame, identity: list[str]) -> DataFrame:
    """Historical citations (id, identity columns) that are not just those of the trusted tree which are no longer current."""
    from .snapshot import historical

    want = historical(trusted.select("id", *identity, F.lit(0).alias("__p")), current.select("id", *identity), ["id", *identity], "__p").select("id", *identity)
    got = citations.select("id", *identity).distinct()
    gone, more = (a.exceptAll(b) for a, b in ((want, got), (got, want)))  # nulls are equal here
    return gone.unionByName(more).select(F.lit("historical-citation").alias("rule"), F.concat_ws("|", "id", *identity).alias("key"))


def event_file_violations(events: DataFrame, reports: DataFrame, strict: bool = True) -> DataFrame:
    """Event rows (file, date, id): ids that repeat in a file, and if strict those in two files, dates unlike their file's name, days without a report and reports (day) without a file."""
    found = repeated(events, ["file", "id"], "repeated-event")
    if not strict:
        return found
    across = events.groupBy("id").agg(F.min("file").alias("a"), F.max("file").alias("b")).where("a <> b").select(F.lit("event-in-two-files").alias("rule"), F.col("id").alias("key"))
    stem = F.regexp_replace("file", r"\.json$", "")
    days = events.select(stem.alias("day"), "date").distinct()
    names = _rows(days.where("day <> 'baseline' and not (day <=> date)"), "event-file-date", "day")
    dated = days.where("day <> 'baseline'").select("day").distinct()
    unreported = _rows(dated.join(reports.select("day"), "day", "left_anti"), "day-without-report", "day")
    orphans = _rows(reports.select("day").join(dated, "day", "left_anti"), "orphan-report", "day")
    return found.unionByName(across).unionByName(names).unionByName(unreported).unionByName(orphans)


def reports_differ(stored: DataFrame, rendered: DataFrame, key: str) -> DataFrame:
    """Days whose stored report is not the rendering of their events, or which have one of them only."""
    both = stored.select(key, F.col("report").alias("a")).join(rendered.select(key, F.col("report").alias("b")), key, "full_outer")
    return _rows(both.where("not (a <=> b)"), "report", key)


def ranked(*violations: DataFrame) -> DataFrame:
    """All violations with ord, the place of their constraint in the order of diagnosis."""
    return reduce(DataFrame.unionByName, [v.withColumn("ord", F.lit(i)) for i, v in enumerate(violations)])


def first_diagnostic(violations: DataFrame) -> DataFrame:
    """One row at most: the violation of least ord, then rule and key."""
    return violations.agg(F.min(F.struct("ord", "rule", "key")).alias("v")).where("v is not null").select("v.ord", "v.rule", "v.key")


def require(violations: DataFrame, message: str = "invalid history") -> None:
    """Raise where there is any violation."""
    found = first_diagnostic(violations).first()
    if found:
        raise ValueError(f"{message}: {found.rule}: {found.key}")
