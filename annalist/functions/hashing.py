"""Content hashes, canonical JSON and stable event identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefix of event identities; an engine that continues another history passes that history's own.
NAMESPACE = "annalist-event-1"
ID_DIGITS = 24


def content_sha256(c: Column) -> Column:
    """Lower-case hex SHA-256 of the bytes (of a string: its UTF-8 bytes); null stays null."""
    return F.sha2(c.cast("binary"), 256)


def canonical_json(c: Column) -> Column:
    """JSON with nulls kept and no layout, of a struct whose fields are in alphabetical order."""
    return F.to_json(c, {"ignoreNullFields": "false"})


def canonical_map(c: Column) -> Column:
    """The map with its keys in order, so that equal maps have equal JSON."""
    return F.map_from_entries(F.array_sort(F.map_entries(c)))


def variant_json(c: Column) -> Column:
    """JSON text with object keys sorted and numbers in least form; null where it is no valid JSON."""
    return F.to_json(F.try_parse_json(c))


def fingerprint(**fields: Column) -> Column:
    """Hash of the canonical JSON of the named fields, in whatever order they are given."""
    return content_sha256(canonical_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)])))


def event_id(entity: Column, change: Column, before: Column, after: Column, namespace: str = NAMESPACE) -> Column:
    """First digits of the hash of namespace, entity, change, before and after, a null counting as empty."""
    parts = [F.lit(namespace), entity, change, *[F.coalesce(x, F.lit("")) for x in (before, after)]]
    return F.substring(content_sha256(F.concat_ws("|", *parts)), 1, ID_DIGITS)


def chained_id(base: Column, previous: Column, namespace: str = NAMESPACE) -> Column:
    """Identity of an event that follows another; the first of a chain keeps its base identity."""
    linked = F.substring(content_sha256(F.concat_ws("|", F.lit(f"{namespace}-chain"), base, previous)), 1, ID_DIGITS)
    return F.when(previous.isNull(), base).otherwise(linked)
