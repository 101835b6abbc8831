"""File scans with fixed schemas, through Spark's own readers (any file system Spark knows)."""

from __future__ import annotations

import json

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing, text
from ..schemas import EVENT_FILE, MANIFEST


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) is not None and len(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)) > 0


def json_documents(spark: SparkSession, path: str, schema=None, default: DataFrame | None = None) -> DataFrame:
    """One row for each JSON file; default where there is no file. A file that does not fit the schema is an error."""
    if default is not None and not exists(spark, path):
        return default
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    return reader.schema(schema).json(path) if schema is not None else reader.option("singleVariantColumn", "v").json(path)


def history(spark: SparkSession, path: str) -> DataFrame:
    """Events of all day files: date, file, position (in order of file name, then within a file) and the event's columns; rows without id are left out."""
    files = spark.read.option("multiLine", True).option("mode", "FAILFAST").schema(EVENT_FILE).json(path)
    named = files.select("date", F.col("_metadata.file_name").alias("file"), F.posexplode("events").alias("n", "e"))
    return named.select("date", "file", F.concat("file", F.lit(":"), F.lpad(F.col("n").cast("string"), 9, "0")).alias("position"), "e.*").where("id is not null")


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """Source records of manifest files ({"sources": [...]}), with the file they come from."""
    from pyspark.sql.types import ArrayType, LongType, StructField, StructType

    shape = StructType([StructField("schema_version", LongType()), StructField("sources", ArrayType(MANIFEST))])
    files = spark.read.option("multiLine", True).option("mode", "FAILFAST").schema(shape).json(path)
    return files.select(F.col("_metadata.file_name").alias("file"), F.explode("sources").alias("s")).select("file", "s.*")


def texts(spark: SparkSession, path: str) -> DataFrame:
    """path, content of whole text files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def binaries(spark: SparkSession, path: str) -> DataFrame:
    """path, content, sha256, bytes: hashed once, when read."""
    return spark.read.format("binaryFile").load(path).select("path", "content", hashing.content_sha256(F.col("content")).alias("sha256"), F.col("length").alias("bytes"))


def registry(responses: DataFrame, kind: str, package: str | Column) -> DataFrame:
    """package, version, published of registry response bodies (python or npm); one of another shape, or of another name than its package's, is an error."""
    from ..schemas import REGISTRY_NPM, REGISTRY_PYTHON

    body = F.from_json(F.col("body").cast("string"), REGISTRY_PYTHON if kind == "python" else REGISTRY_NPM, {"mode": "PERMISSIVE"})
    rows = responses.select((F.lit(package) if isinstance(package, str) else package).alias("p"), body.alias("b"), F.from_json(F.col("body").cast("string"), "struct<name: string>").getField("name").alias("n"))
    name = F.col("b.info.name") if kind == "python" else F.col("b.name")
    version = F.col("b.info.version") if kind == "python" else F.col("b").getField("dist-tags").getField("latest")
    published = F.array_sort(F.map_keys("b.releases")) if kind == "python" else F.lit(None).cast("array<string>")
    ok = text.nonblank(name) & text.nonblank(version) & text.package_key(name, kind).eqNullSafe(text.package_key(F.col("p"), kind))
    if kind == "python":
        ok &= F.coalesce(F.map_contains_key("b.releases", version), F.lit(False))
    checked = F.when(ok, version).otherwise(F.raise_error(F.concat(F.lit("registry response for "), F.col("p"), F.lit(": unexpected shape"))))
    return rows.select(F.col("p").alias("package"), checked.alias("version"), published.alias("published"))


def listed(responses: DataFrame, schema: str, required: dict[str, str]) -> DataFrame:
    """Rows of list responses (body: a JSON array), checked: every required column (name -> predicate) holds, or an error."""
    rows = responses.select(F.explode(F.from_json(F.col("body").cast("string"), f"array<{schema}>", {"mode": "FAILFAST"})).alias("r")).select("r.*")
    for name, predicate in required.items():
        rows = rows.withColumn(name, F.when(F.coalesce(F.expr(predicate), F.lit(False)), F.col(name)).otherwise(F.raise_error(F.lit(f"unexpected {name}"))))
    return rows


def stable_evidence(rows: DataFrame, keep: list[str], defaults: dict[str, object] | None = None) -> DataFrame:
    """The columns that count as evidence, absent flags filled in, repeated rows once, in canonical order by their JSON."""
    for name, value in (defaults or {}).items():
        rows = rows.withColumn(name, F.coalesce(name, F.lit(value)))
    return rows.select(*keep).distinct().orderBy(F.to_json(F.struct(*sorted(keep))))


def pages_of_list(responses: DataFrame, schema: str, required: dict[str, str], keep: list[str], defaults: dict[str, object] | None = None) -> DataFrame:
    """A paginated list (rows of the HTTP source with `list`): its pages joined, checked, reduced to evidence, repeated rows once, in canonical order."""
    return stable_evidence(listed(responses, schema, required), keep, defaults)


def laid_out(c: Column) -> Column:
    """JSON text for people: keys sorted, two spaces a level, a line feed at the end; null where it is no JSON."""

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else json.dumps(json.loads(text), ensure_ascii=False, indent=2, sort_keys=True) + "\n"
        except ValueError:
            return None

    return F.arrow_udf(lambda texts: pa.array([one(t) for t in texts.to_pylist()], pa.string()), "string")(c)


def write_documents(rows: DataFrame, root: str) -> DataFrame:
    """Write rows (name, json) as ROOT/name, laid out, each under a name of the task attempt first; (name, bytes, sha256) of what was written.

    root is a URI that pyarrow opens and the executors share. A name that leaves
    root or text that is no JSON is an error.
    """
    out = rows.select("name", laid_out(F.col("json")).alias("text"))

    def run(batches):
        import hashlib

        fs, base = pyarrow.fs.FileSystem.from_uri(root)
        task = TaskContext.get()
        attempt = task.taskAttemptId() if task else 0
        for batch in batches:
            done = []
            for name, body in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist(), strict=True):
                parts = (name or "").split("/")
                if body is None or any(p in ("", ".", "..") for p in parts):
                    raise ValueError(f"not a document: {name}")
                fs.create_dir("/".join([base, *parts[:-1]]), recursive=True)
                data, at = body.encode(), "/".join([base, *parts[:-1], f".{parts[-1]}.{attempt}"])
                with fs.open_output_stream(at) as f:
                    f.write(data)
                fs.move(at, f"{base}/{name}")
                done.append((name, len(data), hashlib.sha256(data).hexdigest()))
            cols = list(zip(*done, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string()), strict=True)], ["name", "bytes", "sha256"])

    return out.mapInArrow(run, "name string, bytes long, sha256 string")


def manifest_violations(records: DataFrame) -> DataFrame:
    """Records of manifests() without an identity, a hash of 64 hex digits or a URL, and identities that a file has twice."""
    from ..operators.checks import failing, repeated

    whole = text.nonblank(F.col("source_id")) & F.col("sha256").rlike(r"^[0-9a-f]{64}\z") & text.nonblank(F.col("fetch_url"))
    return failing(records, "source_id", whole, "incomplete-record").unionByName(repeated(records, ["file", "source_id"], "repeated-record"))
