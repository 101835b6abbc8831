"""Line deduplication over all documents.

Normalised lines are exploded and hashed (128 bits), the distinct documents of
each hash are counted with a combinable minimum and maximum of the document
id (two documents hold a line exactly when they differ), and each document is
put together again from the lines it keeps, in their order.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import LOWER_BYTES, SPACES
from .workspace import NULL_ID, materialise


def _keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """The hash of each line's key; None for a key shorter than min_chars code points."""
    out = []
    for line in text.translate(LOWER_BYTES).split(b"\n"):
        key = line.strip(SPACES)
        long = len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)
        out.append(xxhash.xxh3_128_digest(key) if long else None)
    return out


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """(h, keeper): the hash of every line key that at least two documents hold, and the least of them."""
    doc = F.struct("k", "th")
    return _lines(docs, id_col, text_col, min_chars).groupBy("h").agg(F.min(doc).alias("keeper"), F.max(doc).alias("last")).where("keeper <> last").drop("last")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> list:
    """Columns k and th that name a document: its id, or without one the hash of its text (so such rows are spread)."""
    k = F.col(id_col).cast("long")
    return [F.coalesce(k, F.lit(NULL_ID)).alias("k"), F.when(k.isNull(), F.xxhash64(F.col(text_col))).otherwise(F.lit(0)).cast("long").alias("th")]


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    def explode(batches):
        for batch in batches:
            ids, keys = [], []
            for row, text in enumerate(batch.column("t")):
                own = {h for h in _keys(text.as_py() or b"", min_chars) if h}
                ids += [row] * len(own)
                keys += own
            at = pa.array(ids, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("k").take(at), batch.column("th").take(at), pa.array(keys, pa.binary())], ["k", "th", "h"])

    return docs.select(*_keyed(docs, id_col, text_col), F.col(text_col).cast("binary").alias("t")).mapInArrow(explode, "k long, th long, h binary")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """docs with its text replaced by the lines it keeps, and n_lines, n_dropped.

    A line key is the line stripped of ASCII whitespace with A-Z lower-cased.
    Keys of at least min_chars code points held by two or more documents stay
    only in the document of least id, there every time. A null or empty text is
    one empty line. Rows that share an id are one document; rows without an id
    are documents by their text, equal texts one, and sort after all others. All
    other columns pass through, whatever their names; n_lines and n_dropped
    replace columns of those names. Texts are taken whole, one at a time.
    """
    # read back from a table, a line that very many documents hold can be split by the join
    repeated = materialise(repeated_lines(docs, id_col, text_col, min_chars), "repeated-lines")
    gone = (
        _lines(docs, id_col, text_col, min_chars)
        .join(repeated, "h")
        .where(F.struct("k", "th") != F.col("keeper"))
        .groupBy("k", "th")
        .agg(F.collect_set("h").alias("gone"))
    )

    @F.arrow_udf("struct<kept: string, lines: long, dropped: long>")
    def rebuild(text: pa.Array, gone: pa.Array) -> pa.Array:
        kept, lines, dropped = [], [], []
        for t, g in zip(text, gone, strict=True):
            t, g = t.as_py() or b"", g.as_py()
            parts = t.split(b"\n")
            keep = parts
            if g:
                g = set(g)
                keep = [p for p, h in zip(parts, _keys(t, min_chars), strict=True) if h not in g]
            kept.append(b"\n".join(keep).decode())
            lines.append(len(parts))
            dropped.append(len(parts) - len(keep))
        return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], ["kept", "lines", "dropped"])

    rest = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    keyed = docs.select(F.struct(*rest).alias("row"), F.col(text_col).cast("binary").alias("t"), *_keyed(docs, id_col, text_col))
    out = keyed.join(gone, ["k", "th"], "left").select("row", rebuild(F.col("t"), F.col("gone")).alias("new"))
    return out.select("row.*", F.col("new.kept").alias(text_col), F.col("new.lines").alias("n_lines"), F.col("new.dropped").alias("n_dropped"))
