"""Hashes of ordered rows of any number, without a row that holds them all."""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of neighbouring parts that are joined and compressed before the running hash reads them.
CHUNK = 1 << 20


def _runs(batch: pa.RecordBatch, keys: list[str]):
    """(key, begin, end) of the runs of equal keys in a batch."""
    rows = list(zip(*[batch.column(k).to_pylist() for k in keys], strict=True)) if keys else [()] * batch.num_rows
    begin = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or rows[i] != rows[begin]:
            yield rows[begin], begin, i
            begin = i


def ordered_hash(rows: DataFrame, keys: list[str], order: list[str], part: Column, prefix: str = "", separator: str = "", suffix: str = "") -> DataFrame:
    """(keys..., sha256, n): the hash of prefix, the parts of a key in order with separators between, and suffix; n parts.

    Rows are sorted by range, so that a key with all rows is sorted in many tasks,
    and joined to chunks there, which travel compressed; the chunks of a key then
    pass, in order, through a running hash that holds one at a time (a hash has no
    parts that could be joined later). A null part is empty; rows of one key that order does not tell apart
    should have equal parts. Keys may be null, and none; a table without rows gives
    none.
    """
    own = rows.select(*keys, *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], F.coalesce(part.cast("string"), F.lit("")).cast("binary").alias("__t"))
    by = [*keys, *[f"__o{i}" for i in range(len(order))]]
    dealt = own.repartitionByRange(*by).sortWithinPartitions(*by).select(*keys, F.spark_partition_id().alias("__p"), "__t")
    glue = separator.encode()

    def join(batches):
        seq, now, held, size, first = 0, None, [], 0, None

        def chunk():
            nonlocal seq, held, size
            seq += 1
            out = pa.RecordBatch.from_arrays([*first, pa.array([seq], pa.int64()), pa.array([len(held)], pa.int64()), pa.array([zlib.compress(glue.join(held), 1)], pa.binary())], [*keys, "__p", "seq", "n", "text"])
            held, size = [], 0
            return out

        for batch in batches:
            texts = batch.column("__t")
            for key, a, b in _runs(batch, keys):
                if held and key != now:
                    yield chunk()
                now, first = key, [batch.column(c).slice(a, 1) for c in [*keys, "__p"]]
                for t in texts.slice(a, b - a):
                    held.append(t.as_py())
                    size += len(held[-1])
                    if size >= CHUNK:
                        yield chunk()
        if held:
            yield chunk()

    shape = "".join(f"`{k}` {own.schema[k].dataType.simpleString()}, " for k in keys)
    chunks = dealt.mapInArrow(join, f"{shape}__p int, seq long, n long, text binary")

    def run(batches):
        now, first, state, n = None, None, None, 0

        def result():
            state.update(suffix.encode())
            return pa.RecordBatch.from_arrays([*first, pa.array([state.hexdigest()], pa.string()), pa.array([n], pa.int64())], [*keys, "sha256", "n"])

        for batch in batches:
            for key, a, b in _runs(batch, keys):
                if state is None or key != now:
                    if state is not None:
                        yield result()
                    now, first, state, n = key, [batch.column(k).slice(a, 1) for k in keys], hashlib.sha256(prefix.encode()), 0
                for text, count in zip(batch.column("text").slice(a, b - a), batch.column("n").slice(a, b - a), strict=True):
                    if n:
                        state.update(glue)
                    state.update(zlib.decompress(text.as_py()))
                    n += count.as_py()
        if state is not None:
            yield result()

    met = chunks.repartition(*keys) if keys else chunks.repartition(1)  # chunks, one for every CHUNK bytes
    return met.sortWithinPartitions(*keys, "__p", "seq").select(*keys, "n", "text").mapInArrow(run, f"{shape}sha256 string, n long")
