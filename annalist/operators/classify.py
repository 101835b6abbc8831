"""Classification of changes: what a difference of two snapshots says about the world, and what only about its tracking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hashing
from .snapshot import CODE_DEFINED, ITEMS, WHOLE_BASELINE
from .streamed import ordered_hash

#: Evidence policies whose first adoption is a correction of tracking.
RELEASE_POLICY, PRACTICE_POLICY = "tag-verified-v1", "source-reviewed-v1"
#: What a row of a snapshot may say besides layer, id and state; absent columns count as null.
FIELDS = {
    "status": "string",
    "summary": "string",
    "package": "string",
    "version": "string",
    "policy": "string",
    "identity": "string",
    "kind": "string",
    "evidence": "string",
    "complete": "string",
    "cited": "array<string>",
    "reviews": "string",
    "review_urls": "string",
    "observed": "map<string, string>",
    "prior": "map<string, string>",
    "claims": "map<string, struct<status: string, value: string, last: string>>",
    "sources": "array<struct<source_id: string, url: string, sha256: string>>",
}


def projected(rows: DataFrame, keep: Sequence[str] = (), without: Sequence[str] = (), nested: dict[str, Sequence[str]] | None = None) -> Column:
    """Canonical JSON of the columns that make a semantic change: only `keep` (null: all), not `without`, and elements of
    the arrays of `nested` without the fields named there."""
    names = sorted(c for c in rows.columns if (not keep or c in keep) and c not in without)
    nested = nested or {}
    slim = lambda c: F.transform(F.col(c), lambda x: x.dropFields(*nested[c])).alias(c)
    return hashing.canonical_json(F.struct(*[slim(c) if c in nested else F.col(c) for c in names]))


def _whole(rows: DataFrame) -> DataFrame:
    """rows with every column of FIELDS."""
    own = [F.col(c).cast(t).alias(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in FIELDS.items()]
    return rows.select("layer", "id", F.col("state").cast("string").alias("state"), *own)


def _all(sources: Column, test) -> Column:
    """Whether there are sources and all pass a test that counts null as false."""
    return F.coalesce(F.size(sources) > 0, F.lit(False)) & F.coalesce(F.forall(sources, lambda s: F.coalesce(test(s), F.lit(False))), F.lit(False))


def _claims_moved(old: Column, new: Column) -> tuple[Column, Column]:
    """Whether any claim's status differs; whether the value last verified and the one verified now differ for any claim."""
    names = F.array_union(F.map_keys(old), F.map_keys(new))
    status = F.exists(names, lambda k: ~F.try_element_at(old, k)["status"].eqNullSafe(F.try_element_at(new, k)["status"]))

    def differs(k):
        a, b = F.try_element_at(old, k), F.try_element_at(new, k)
        last = F.when(a["status"] == "verified", a["value"]).otherwise(a["last"])
        return F.coalesce((b["status"] == "verified") & last.isNotNull() & (last != b["value"]), F.lit(False))

    return status, F.exists(names, differs)


def change_events(old: DataFrame, new: DataFrame, rules: DataFrame, practice_policy: str = PRACTICE_POLICY, release_policy: str = RELEASE_POLICY, code_defined: Sequence[str] = CODE_DEFINED, whole: Sequence[str] = WHOLE_BASELINE, namespace: str = hashing.NAMESPACE) -> DataFrame:
    """(layer, id, change, note, summary, before, after, event_id, sources) of every item that changed between two snapshots.

    old and new: layer, id, state (the JSON that counts, see projected) and the
    columns of FIELDS; rules: id, sources (array) of the practices. One shuffle
    on (layer, id) brings the two sides together. In this order, later ones win:

    * a layer of `whole` that had no rows begins with one baseline of all of them;
    * equal states are no event, but for the first adoption of the release policy
      with version, tag, commit, codes and history (`identity`) unchanged: baseline;
    * items that code defines arrive as baseline and leave as untracked;
    * a limitation that gains its kind or the hash of its whole section is a
      baseline where its evidence is the same, else modified;
    * a practice first judged under the practice policy, all of its rule's sources
      unchanged, is a baseline; one whose context reviews alone changed is
      verification_changed, and its hashes take in the reviews;
    * claims whose status moved without a verified value changing are verification_changed;
    * claims seen for the first time are a baseline, without any verified one verification_changed.

    note names the rule that applied (null: none). The summary is the note's text,
    else the change of a practice's status, else the item's own, else a generated one.
    """
    absent = [F.lit(None).cast("string").alias(c) for c in ("id", "before")]
    began = new.where(F.col("layer").isin(*whole)).join(old.select("layer").distinct(), "layer", "left_anti")
    text = F.to_json(F.array("state"))
    hashes = ordered_hash(_whole(began), ["layer"], ["id", "state"], F.substr(text, F.lit(2), F.length(text) - 2), *ITEMS)
    cited = _whole(began).select("layer", F.explode_outer("sources").alias("s")).groupBy("layer").agg(F.collect_set("s").alias("sources"))
    once = hashes.withColumnRenamed("sha256", "after").join(cited, "layer")
    first = once.select("layer", *absent, "after", F.lit("baseline").alias("change"), F.lit("layer_began").alias("note"), F.concat(F.lit("Tracking of "), "layer", F.lit(" began with "), "n", F.lit(" entries; nothing is said about what was there before.")).alias("summary"), F.array_sort("sources").alias("sources"))

    fields = F.struct("state", *FIELDS)
    side = lambda df, is_new: _whole(df).select("layer", "id", F.lit(is_new).alias("is_new"), fields.alias("row"))
    # the one row of each side, whatever its columns are (maps cannot be compared)
    pick = lambda is_new: F.first(F.when(F.col("is_new") == is_new, F.col("row")), ignorenulls=True)
    both = side(old, False).unionByName(side(new, True)).groupBy("layer", "id").agg(pick(False).alias("o"), pick(True).alias("n"))
    both = both.join(F.broadcast(began.select("layer").distinct()), "layer", "left_anti").join(rules.select("id", F.col("sources").alias("rule")), "id", "left")
    o, n, rule = (lambda c: F.col(f"o.{c}")), (lambda c: F.col(f"n.{c}")), F.col("rule")
    layer, had, has = F.col("layer"), F.col("o").isNotNull(), F.col("n").isNotNull()
    kept = had & has
    unset = lambda c: F.coalesce(c, F.lit("")) == ""
    yes = lambda c: F.coalesce(c, F.lit(False))

    practice = (layer == "practices") & kept
    same_observed = _all(rule, lambda s: F.try_element_at(o("observed"), s).eqNullSafe(F.try_element_at(n("observed"), s)))
    reviewed = yes(practice & (o("policy") == practice_policy) & (n("policy") == practice_policy) & ~unset(o("reviews")) & o("summary").eqNullSafe(n("summary")) & ~o("reviews").eqNullSafe(n("reviews")) & o("review_urls").eqNullSafe(n("review_urls"))) & same_observed
    digest = lambda c: F.when(reviewed, hashing.content_sha256(F.concat_ws("\n", c("state"), c("reviews")))).otherwise(hashing.content_sha256(F.coalesce(c("state"), F.lit("null"))))
    both = both.withColumn("reviewed", reviewed).withColumn("before", F.when(had, digest(o))).withColumn("after", F.when(has, digest(n)))
    released = yes(layer.startswith("sdk-") & kept & unset(o("policy")) & (n("policy") == release_policy) & o("identity").eqNullSafe(n("identity")))
    rows = both.where(~F.col("before").eqNullSafe(F.col("after")) | released)

    plain = F.when(~had, "added").when(~has, "removed").otherwise("modified")
    defined = layer.isin(*code_defined) & ~kept
    gained = (layer == "model-limitations") & kept & ((o("kind").isNull() & n("kind").isNotNull()) | (o("complete").isNull() & n("complete").isNotNull()))
    cited = F.coalesce(F.size(o("cited")) > 0, F.lit(False)) & o("cited").eqNullSafe(n("cited"))
    same_evidence = o("evidence").eqNullSafe(n("evidence")) & F.when(o("complete").isNotNull(), o("complete").eqNullSafe(n("complete"))).when(n("complete").isNotNull(), cited).otherwise(True)
    adopted = yes(practice & unset(o("policy")) & (n("policy") == practice_policy) & (F.size(o("sources")) > 0)) & _all(rule, lambda s: ~unset(F.try_element_at(o("prior"), s)) & (F.try_element_at(n("observed"), s) == F.try_element_at(o("prior"), s)))
    api, claims, sources = layer == "api", F.coalesce(n("claims"), o("claims")), F.when(has, n("sources")).otherwise(o("sources"))
    claims = F.when(has, n("claims")).otherwise(o("claims"))
    status_moved, value_moved = _claims_moved(o("claims"), claims)
    compared = api & o("claims").isNotNull() & claims.isNotNull()
    appeared = api & claims.isNotNull() & o("claims").isNull()
    some_verified = yes((F.size(sources) > 0) & F.exists(F.map_values(claims), lambda f: f["status"] == "verified"))
    cases = [  # (condition, change, note), the last that holds decides
        (released, "baseline", "release_policy_adopted"),
        (defined & ~had, "baseline", "rule_added"),
        (defined & had, "untracked", "rule_removed"),
        (F.col("reviewed"), "verification_changed", "context_reviewed"),
        (adopted, "baseline", "practice_policy_adopted"),
        (gained & same_evidence, "baseline", "limitation_reread"),
        (gained & ~same_evidence, "modified", "limitation_reread_and_changed"),
        (compared & yes(status_moved) & ~yes(value_moved), "verification_changed", "claims_reverified"),
        (compared & yes(value_moved), None, "claims_differ"),
        (appeared & some_verified, "baseline", "claims_began"),
        (appeared & ~some_verified, "verification_changed", "claims_unverified"),
    ]
    change, note = plain, F.lit(None).cast("string")
    for holds, kind, name in cases:
        change = F.when(holds, kind).otherwise(change) if kind else change
        note = F.when(holds, name).otherwise(note)
    noted = rows.select("*", change.alias("change"), note.alias("note"))
    moved = F.concat(F.lit("Practice "), "id", F.lit(": "), F.coalesce(o("status"), F.lit("unknown")), F.lit(" -> "), F.coalesce(n("status"), F.lit("unknown")))
    version = F.concat(F.coalesce(n("package"), o("package")), F.lit(" "), F.coalesce(o("version"), F.lit("unknown")), F.lit(" -> "), F.coalesce(n("version"), F.lit("unknown")))
    summary = F.coalesce(
        F.when(F.col("note").isNotNull(), F.concat_ws(" ", layer, "id", F.lit("tracking:"), F.replace("note", F.lit("_"), F.lit(" ")))),
        F.when((layer == "practices") & (F.col("change") == "modified") & ~o("status").eqNullSafe(n("status")), moved),
        F.when(has, n("summary")).otherwise(o("summary")),
        F.when(layer.startswith("sdk-"), version),
        F.concat_ws(" ", layer, "id", F.lit("changed")),
    )
    later = noted.select("layer", "id", "before", "after", "change", "note", summary.alias("summary"), sources.alias("sources"))
    events = later.unionByName(first)
    entity = F.concat_ws(":", "layer", "id")
    return events.select("layer", "id", "change", "note", "summary", "before", "after", hashing.event_id(entity, F.col("change"), F.col("before"), F.col("after"), namespace).alias("event_id"), "sources")


def role_sources(before: DataFrame, after: DataFrame, attributes: Sequence[str] = ("context_sha256", "excerpt", "verdict")) -> DataFrame:
    """(entity, role, source_id, url, sha256, attributes): sources of both sides with their role, each once.

    before and after: entity, position, source_id, url, sha256 and the
    attributes; rows without one of the first three of a source are left out, and
    of an attribute the last value that is not null counts.
    """
    both = before.withColumn("role", F.lit("historical")).unionByName(after.withColumn("role", F.lit("current")))
    whole = both.where(" and ".join(f"coalesce({c}, '') <> ''" for c in ("source_id", "url", "sha256")))
    last = [F.max(F.when(F.col(c).isNotNull(), F.struct("position", c)))[c].alias(c) for c in attributes]
    return whole.groupBy("entity", "role", "source_id", "sha256", "url").agg(*last)
