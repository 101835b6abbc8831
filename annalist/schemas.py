"""Row types of the engine's tables."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, MapType, StringType, StructField, StructType


def _struct(spec: str, **other) -> StructType:
    """Columns in order; a trailing ! marks one that is never null. Strings unless other names a type."""
    return StructType([StructField(c.rstrip("!"), other.get(c.rstrip("!"), StringType()), not c.endswith("!")) for c in spec.split()])


RESPONSE = _struct("url! body headers status!", body=BinaryType(), headers=MapType(StringType(), StringType()), status=LongType())
ARTIFACT = _struct("source_id! source_type! url! content discovered_via upstream_last_modified upstream_commit source_tag", content=BinaryType())
MANIFEST = _struct("source_id! source_type! canonical_url! fetch_url discovered_via upstream_last_modified upstream_commit source_tag sha256! bytes title description observed_at", bytes=LongType())
CITATION = _struct("source_id url sha256 role context_sha256 excerpt review_verdict")
EVENT = _struct("id! previous_event_id schema_version observed_at category! entity! change! summary before_sha256 after_sha256 sources", schema_version=LongType(), sources=ArrayType(CITATION))
EVENT_FILE = StructType([StructField("date", StringType()), StructField("schema_version", LongType()), StructField("events", ArrayType(EVENT))])
PAGE = _struct("source_id canonical_url title status sha256")
RELEASE = _struct("tag_name published_at name html_url draft prerelease", draft=BooleanType(), prerelease=BooleanType())
TAG = StructType([StructField("name", StringType()), StructField("commit", StructType([StructField("sha", StringType())]))])
REGISTRY_PYTHON = "struct<info: struct<name: string, version: string>, releases: map<string, array<struct<filename: string>>>>"
REGISTRY_NPM = "struct<name: string, `dist-tags`: struct<latest: string>>"
