"""Reconciliation of independently observed versions, and clocks of discrepancies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from . import patterns

#: Codes of disagreement between a registry and Git, and of a release's own configuration.
UNRESOLVED, NO_TAG, NO_RELEASE = "registry_version_unresolved", "registry_version_missing_git_tag", "registry_version_missing_github_release"
GIT_AHEAD, REGISTRY_AHEAD, MALFORMED = "git_source_ahead_of_registry", "registry_ahead_of_git_source", "malformed_release_metadata"
CONFIG_MISSING, CONFIG_MALFORMED, CONFIG_VERSION = "release_config_missing", "release_config_malformed", "release_config_version_mismatch"
CONFIG_NO_NAME, CONFIG_NAME = "release_config_name_missing", "release_config_name_mismatch"

def tag_bindings(tags: DataFrame) -> DataFrame:
    """(package, tag, commit, conflicted): what each tag points at; a tag seen at two commits resolves to neither."""
    found = tags.groupBy("package", "tag").agg(F.min("commit").alias("lo"), F.max("commit").alias("hi"))
    return found.select("package", "tag", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("commit"), (F.col("lo") != F.col("hi")).alias("conflicted"))


def release_states(releases: DataFrame) -> DataFrame:
    """(package, tag, stable, malformed, published_at): a release's flags; a tag whose rows disagree is malformed, drafts and pre-releases are not stable."""
    off = F.coalesce("draft", F.lit(False)) | F.coalesce("prerelease", F.lit(False))
    kind = F.concat_ws(",", F.coalesce("draft", F.lit(False)).cast("string"), F.coalesce("prerelease", F.lit(False)).cast("string"))
    found = releases.groupBy("package", "tag").agg(F.bool_or(off).alias("off"), (F.min(kind) != F.max(kind)).alias("malformed"), F.max("published_at").alias("published_at"))
    return found.select("package", "tag", (~F.col("off") & ~F.col("malformed")).alias("stable"), "malformed", "published_at")


def reconciled(registry: DataFrame, tags: DataFrame, releases: DataFrame) -> DataFrame:
    """registry (package, version) against tags (package, tag, commit) and releases: package, version, source_tag, source_commit, discrepancies.

    The newest of Git is the greatest version among stable releases and tags
    that no unstable release excludes.
    """
    bound, states = tag_bindings(tags), release_states(releases)
    marked = bound.join(states, ["package", "tag"], "left")
    git = marked.where(F.coalesce("stable", F.lit(True))).select("package", "tag").unionByName(states.where("stable").select("package", "tag"))
    newest = git.groupBy("package").agg(F.max(text.version_of(F.col("tag"))).alias("newest"))
    malformed = states.groupBy("package").agg(F.bool_or("malformed").alias("malformed"))
    own = registry.withColumn("v", text.version_of(F.col("version"))).withColumn("tag", F.concat(F.lit("v"), "version"))
    joined = (
        own.join(bound.withColumn("tagged", F.lit(True)), ["package", "tag"], "left")
        .join(states.where("stable").select("package", "tag", F.lit(True).alias("released")), ["package", "tag"], "left")
        .join(newest, "package", "left")
        .join(malformed, "package", "left")
    )
    known = F.col("v").isNotNull()
    codes = F.array(
        F.when(~known, UNRESOLVED),
        F.when(known & F.col("commit").isNull(), NO_TAG),
        F.when(known & F.col("released").isNull(), NO_RELEASE),
        F.when(known & (F.col("newest") > F.col("v")), GIT_AHEAD),
        F.when(known & (F.col("newest").isNull() | (F.col("newest") < F.col("v"))), REGISTRY_AHEAD),
        F.when(F.col("malformed"), MALFORMED),
    )
    return joined.select("package", "version", F.when(F.col("commit").isNotNull(), F.col("tag")).alias("source_tag"), F.col("commit").alias("source_commit"), F.array_sort(F.array_compact(codes)).alias("discrepancies"))


def config_codes(config: DataFrame) -> DataFrame:
    """(package, discrepancies) of what a release's own configuration says: rows (package, kind, version, present, parsed, name, found_version)."""
    expected = F.when(F.col("kind") == "python", text.package_key(F.col("package"), "python")).otherwise(F.col("package"))
    name = F.when(F.col("kind") == "python", text.package_key(F.col("name"), "python")).otherwise(F.col("name"))
    codes = F.when(~F.col("present"), F.array(F.lit(CONFIG_MISSING))).when(~F.col("parsed"), F.array(F.lit(CONFIG_MALFORMED))).otherwise(
        F.array_compact(
            F.array(
                F.when(~F.col("found_version").eqNullSafe(F.col("version")), CONFIG_VERSION),
                F.when(F.col("name").isNull(), CONFIG_NO_NAME),
                F.when(name != expected, CONFIG_NAME),
            )
        )
    )
    return config.select("package", F.array_sort(codes).alias("discrepancies"))


def resolved(snapshot: DataFrame, config: DataFrame) -> DataFrame:
    """snapshot with its configuration's codes added; any of them leaves the source tag and commit unknown."""
    c = config_codes(config).withColumnRenamed("discrepancies", "extra")
    bad = F.size(F.coalesce("extra", F.array().cast("array<string>"))) > 0
    joined = snapshot.join(c, "package", "left")
    return joined.select(
        "package",
        "version",
        *[F.when(~bad, F.col(x)).alias(x) for x in ("source_tag", "source_commit")],
        F.array_sort(F.array_distinct(F.concat("discrepancies", F.coalesce("extra", F.array().cast("array<string>"))))).alias("discrepancies"),
    )


def discrepancy_since(current: DataFrame, previous: DataFrame, key: str, now: Column) -> DataFrame:
    """current (key, discrepancies) with status and discrepancy_first_observed, kept while the status stays `discrepancy` (else `up_to_date`).

    previous: key, status, discrepancy_first_observed, observed_at; a legacy row
    without the first time stands for its snapshot's time.
    """
    p = previous.select(key, F.col("status").alias("p_status"), F.col("discrepancy_first_observed").alias("p_first"), F.col("observed_at").alias("p_at"))
    bad = F.size("discrepancies") > 0
    first = F.when(F.col("p_status") == "discrepancy", F.coalesce("p_first", "p_at", now)).otherwise(now)
    rest = [c for c in current.columns if c != key]
    return current.join(p, key, "left").select(key, *rest, F.when(bad, "discrepancy").otherwise("up_to_date").alias("status"), F.when(bad, first).alias("discrepancy_first_observed"))


def actionable(freshness: DataFrame, now: Column, days: int = 3) -> DataFrame:
    """Rows whose discrepancy has lasted the grace period; an unknown beginning is never actionable."""
    since = text.utc(F.col("discrepancy_first_observed"))
    return freshness.where((F.col("status") == "discrepancy") & (now - since >= F.make_dt_interval(F.lit(days))))


def documented(releases: DataFrame, notes: DataFrame) -> DataFrame:
    """releases (package, version, ...) with the first note (by position) of their version."""
    first = notes.groupBy("package", "version").agg(F.min_by("changes", "position").alias("documented_changes"))
    return releases.join(first, ["package", "version"], "left")


def introduced(notes: DataFrame, rules: list[tuple[str, str]] | DataFrame) -> DataFrame:
    """(package, capability, version, note): the earliest release whose note matches a rule.

    rules is a table (capability, phrase) of any size, whose phrases are looked for
    as whole words by one automaton, or a short list (capability, pattern) of
    regular expressions fixed by code.
    """
    rows = notes.withColumn("v", text.version_of(F.col("version"))).where("v is not null").select("package", "version", "v", "note")
    if isinstance(rules, DataFrame):
        met = patterns.occurring(rows, ["package", "version", "v", "note"], F.col("note"), rules, "phrase")
        hits = met.join(rules.select("capability", patterns.spaced(F.col("phrase")).alias("pattern")).distinct(), "pattern")
    else:
        hits = rows.withColumn("capability", F.explode(F.array_compact(F.array(*[F.when(F.col("note").rlike(p), F.lit(name)) for name, p in rules]))))
    return hits.groupBy("package", "capability").agg(F.min_by(F.struct("version", "note"), F.struct("v", "note")).alias("r")).select("package", "capability", "r.*")


def retained_citations(citations: DataFrame, current: DataFrame, previous: DataFrame) -> DataFrame:
    """Citations (source_id, sha256) whose source has moved on, renamed retained:<id>:<hash> where the previous sources have that hash."""
    c = current.select("source_id", F.col("sha256").alias("now"))
    p = previous.select("source_id", F.col("sha256").alias("was"))
    moved = ~F.col("sha256").eqNullSafe(F.col("now")) & (F.col("was") == F.col("sha256"))
    rest = [x for x in citations.columns if x != "source_id"]
    return citations.join(c, "source_id", "left").join(p, "source_id", "left").select(F.when(moved, F.concat_ws(":", F.lit("retained"), "source_id", "sha256")).otherwise(F.col("source_id")).alias("source_id"), *rest)


def sdk_stream(source_id: Column, streams: dict[str, str]) -> Column:
    """The stream whose prefix a source identity has (first of streams), else null."""
    found = F.lit(None).cast("string")
    for prefix, name in reversed(list(streams.items())):
        found = F.when(source_id.startswith(prefix), name).otherwise(found)
    return found


def published_order(releases: DataFrame, keys: list[str]) -> DataFrame:
    """keys and tags: tags of releases by publication, then by name; one without a time or tag as if these were empty."""
    rows = F.array_sort(F.collect_list(F.struct(F.coalesce("published_at", F.lit("")).alias("p"), F.coalesce("tag", F.lit("")).alias("t"))))
    return releases.groupBy(*keys).agg(F.transform(rows, lambda x: x["t"]).alias("tags"))


def pinned(commits: DataFrame, base: str, path: str) -> DataFrame:
    """commits (repository, commit, position; the newest first) -> (repository, commit, url): a file at its latest commit, by an address that cannot move."""
    latest = commits.where(text.is_commit(F.col("commit"))).groupBy("repository").agg(F.min_by("commit", "position").alias("commit"))
    return latest.select("repository", "commit", F.concat_ws("/", F.lit(base.rstrip("/")), "repository", "commit", F.lit(path)).alias("url"))


def tool_snapshot(releases: DataFrame, tags: DataFrame, files: DataFrame, purpose: str, compatibility: str, providers: dict[str, str]) -> DataFrame:
    """(package, version, source_tag, source_commit, purpose, compatibility, provider_families, missing) of packages known by their stable releases.

    releases: package, tag, draft, prerelease, published_at; tags: package, tag,
    commit; files: package, commit, readme (plain text), config_version. The
    greatest stable version counts; purpose and compatibility are excerpts around
    patterns, providers maps a word of the readme to a family. missing lists what
    keeps a snapshot from being published: release, tag, config, purpose, compatibility.
    """
    stable = release_states(releases).where("stable").withColumn("v", text.version_of(F.col("tag"))).where("v is not null")
    newest = stable.groupBy("package").agg(F.max_by("tag", F.struct("v", "tag")).alias("tag"))
    every = releases.select("package").distinct().join(newest, "package", "left").join(tag_bindings(tags).select("package", "tag", "commit"), ["package", "tag"], "left")
    found = every.join(files.select("package", "commit", "readme", "config_version"), ["package", "commit"], "left")
    version = F.regexp_replace("tag", "^v", "")
    families = F.array_compact(F.array(*[F.when(F.contains("readme", F.lit(word)), F.lit(name)) for word, name in providers.items()]))
    rows = found.select("package", version.alias("version"), F.when(F.col("commit").isNotNull(), F.col("tag")).alias("source_tag"), F.col("commit").alias("source_commit"), text.excerpt(F.col("readme"), purpose).alias("purpose"), text.excerpt(F.col("readme"), compatibility).alias("compatibility"), F.coalesce(families, F.array().cast("array<string>")).alias("provider_families"), "config_version")
    lacks = [(F.col("version").isNull(), "release"), (F.col("source_commit").isNull(), "tag"), (~F.col("config_version").eqNullSafe(F.col("version")), "config"), (F.col("purpose").isNull(), "purpose"), (F.col("compatibility").isNull(), "compatibility")]
    return rows.withColumn("missing", F.array_compact(F.array(*[F.when(c, name) for c, name in lacks]))).drop("config_version")


def package_snapshot(registry: DataFrame, tags: DataFrame, releases: DataFrame, config: DataFrame, notes: DataFrame) -> DataFrame:
    """One row for each package: version, source_tag, source_commit and discrepancies from all that is known, and its release history.

    registry: package, version; tags: package, tag, commit; releases: package,
    tag, draft, prerelease, published_at; config: as in config_codes(), of the
    release that the registry names; notes: package, version, position, changes.
    release_history is in order of publication: struct(tag, version,
    source_commit, published_at, documented_changes) of the stable releases.
    """
    found = resolved(reconciled(registry, tags, releases), config)
    stable = release_states(releases).where("stable").join(tag_bindings(tags).select("package", "tag", "commit"), ["package", "tag"], "left")
    rows = documented(stable.withColumn("version", F.regexp_replace("tag", "^v", "")), notes)
    entry = F.struct(F.coalesce("published_at", F.lit("")).alias("p"), F.coalesce("tag", F.lit("")).alias("t"), F.struct("tag", "version", F.col("commit").alias("source_commit"), "published_at", "documented_changes").alias("r"))
    history = rows.groupBy("package").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["r"]).alias("release_history"))
    return found.join(history, "package", "left")
