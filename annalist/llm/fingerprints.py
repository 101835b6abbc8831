"""Lempel-Ziv phrase fingerprints.

A text is parsed into dictionary phrases (each the longest known phrase and
one more byte); the set of phrase hashes is summarised by a one-permutation
minimum-hash signature, so two fingerprints estimate how much of their phrase
sets the texts share, as a shared dictionary would help to compress them.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from .kernels import U64, distinct, mix

#: Bins of a signature and hex digits of each.
BINS, DIGITS = 128, 4
#: Phrases of a dictionary (a full one is begun anew, as compressors do), and bytes of text in a bucket, about.
PHRASES, BUCKET_BYTES = 1 << 17, 32 << 20
_BITS = U64(16 * (DIGITS // 4))
_BASE = U64(0x9E3779B97F4A7C15)


class Parse:
    """An LZ78 parse that can be continued: dictionary of (phrase, byte) of at most PHRASES, phrase ends so far (8 bytes each)."""

    __slots__ = ("known", "state", "ends", "size")

    def __init__(self):
        self.known: dict[int, int] = {}
        self.state, self.size = 0, 0
        self.ends = array("q")

    def fork(self) -> Parse:
        other = Parse()
        other.known, other.state, other.size, other.ends = self.known.copy(), self.state, self.size, self.ends[:]
        return other

    def feed(self, data: bytes) -> Parse:
        known, state, ends, at, new = self.known, self.state, self.ends, self.size, len(self.known) + 1
        look = known.get
        for byte in data:
            at += 1
            key = state << 8 | byte
            state = look(key)
            if state is None:
                known[key] = new
                new += 1
                ends.append(at)
                state = 0
                if new > PHRASES:
                    known.clear()
                    new = 1
        self.state, self.size = state, at
        return self


def phrase_hashes(data: bytes, parse: Parse) -> np.ndarray:
    """Distinct hashes of the phrases of data; the unfinished last phrase counts."""
    ends = np.array(parse.ends, np.int64) if parse.state == 0 else np.append(np.array(parse.ends, np.int64), len(data))
    if not len(ends):
        return np.zeros(0, U64)
    starts = np.concatenate([[0], ends[:-1]])
    raw = np.frombuffer(data, np.uint8)
    longest = int((ends - starts).max())
    h = np.zeros(len(ends), U64)
    for k in range(longest):
        open_ = starts + k < ends
        if k and not open_.all():
            live = np.flatnonzero(open_)
            h[live] = h[live] * _BASE + raw[starts[live] + k].astype(U64) + U64(1)
        else:
            h = np.where(open_, h * _BASE + raw[np.minimum(starts + k, len(raw) - 1)].astype(U64) + U64(1), h)
    return distinct(mix(h))


def signature(h: np.ndarray) -> np.ndarray | None:
    """Least hash of each of BINS bins; an empty bin takes the next full one's value, shifted by the distance."""
    if not len(h):
        return None
    bins = np.full(BINS, np.iinfo(np.uint64).max, U64)
    which = (h >> U64(57)).astype(np.int64)
    first = np.flatnonzero(np.diff(which, prepend=-1))
    bins[which[first]] = h[first]  # h ascends, so the first of a bin is its least
    full = np.zeros(BINS, bool)
    full[which[first]] = True
    at = np.arange(BINS)
    twice = np.flatnonzero(np.concatenate([full, full]))
    source = twice[np.searchsorted(twice, at)]
    value = mix(bins[source % BINS] + (source - at).astype(U64) * _BASE)
    return (value & ((U64(1) << _BITS) - U64(1))).astype(np.uint16)


def as_text(s: np.ndarray | None) -> str:
    """Hex of a signature; a text without bytes has the fingerprint of no digits."""
    return "" if s is None else s.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Share of equal bins, corrected for chance; 1 for two empty texts, 0 for one."""
    if a is None or b is None:
        return float(a is None and b is None)
    chance = 2.0 ** -float(_BITS)
    return float(min(1.0, max(0.0, (np.mean(a == b) - chance) / (1 - chance))))


def fingerprint(text: str | None) -> str:
    data = (text or "").encode()
    return as_text(signature(phrase_hashes(data, Parse().feed(data))))


def fingerprinted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document of a document is the one after it by descending id (after
    the last, the first); rows that share an id follow each other by text, and
    rows without an id come last, by a hash of their text. The edited text keeps all but the last
    floor(n_chars / 2) code points and goes on with the first as many (or all) of
    the next document's text. A null text is empty. A single row is its own next.
    Rows that are equal are alike. A task holds two texts and their parses at a
    time; a parse keeps at most PHRASES phrases to match, whatever the text's length.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # rows without an id are spread by their hash, over buckets of their own
    base = base.withColumn("k", F.coalesce("doc_id", F.xxhash64("text")))
    sizes = base.agg(*[F.sum(F.when(c, F.octet_length("text"))).alias(n) for n, c in (("own", F.col("doc_id").isNotNull()), ("none", F.col("doc_id").isNull()))]).first()
    parts, more = (buckets or max(1, -(-(s or 0) // BUCKET_BYTES)) for s in (sizes.own, sizes.none))
    ided = base.where("doc_id is not null")
    cuts = ided.agg(F.percentile_approx("k", [i / parts for i in range(1, parts)] or [0.5], max(10_000, 4 * parts)).alias("c")).first().c or []
    cuts = sorted({int(c) for c in cuts})
    edges = np.array(cuts, np.int64)

    @F.arrow_udf(IntegerType())
    def bucket(doc_id: pa.Array, k: pa.Array) -> pa.Array:
        # bucket 0 has the largest ids
        k, none = np.asarray(k), np.asarray(doc_id.is_null())
        hashed = (((np.iinfo(np.int64).max - k).view(np.uint64) >> U64(32)) * U64(more) >> U64(32)).astype(np.int64)
        return pa.array(np.where(none, len(edges) + 1 + hashed, len(edges) - np.searchsorted(edges, k, "right")).astype(np.int32))

    keyed = base.withColumn("bucket", bucket("doc_id", "k"))
    tops = sorted((r.bucket, r.k) for r in keyed.groupBy("bucket").agg(F.max("k").alias("k")).collect())
    if not tops:
        return keyed.select("doc_id", F.lit(0).cast("long").alias("n_chars"), F.col("text").alias("edited_text"), *[F.lit("").alias(c) for c in ("fingerprint", "edited_fingerprint")], *[F.lit(0.0).alias(c) for c in ("near_edited", "near_next")]).limit(0)
    # the first document of each bucket also closes the bucket before it
    closes = [(b, k, tops[i - 1][0]) for i, (b, k) in enumerate(tops)]
    heads = spark.createDataFrame(closes, "bucket int, k long, before int")
    firsts = keyed.join(F.broadcast(heads), ["bucket", "k"]).groupBy("k", "before").agg(F.min("text").alias("text")).select(F.lit(None).cast("long").alias("doc_id"), "text", "k", F.col("before").alias("bucket"), F.lit(True).alias("closing"))
    rows = keyed.withColumn("closing", F.lit(False)).unionByName(firsts)
    dealt = rows.repartitionById(len(cuts) + 1 + more, F.col("bucket")).sortWithinPartitions("bucket", "closing", F.desc("k"), "text")

    def run(batches):
        held = None
        for batch in batches:
            out = []
            for i, text, b, closing in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "bucket", "closing")), strict=True):
                data = text.encode()
                half = len(text) // 2
                stay = text[: len(text) - half].encode()
                parse = Parse().feed(stay)
                fork = parse.fork()
                own = signature(phrase_hashes(data, parse.feed(data[len(stay) :])))
                if held is not None:
                    assert held[0] == b
                    out.append(_row(*held[1:], text, own))
                held = None if closing else (b, i, text, half, stay, fork, own)
            cols = list(zip(*out, strict=True)) or [[]] * len(OUT)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, OUT.values(), strict=True)], list(OUT))

    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


OUT = {"doc_id": pa.int64(), "n_chars": pa.int64(), "edited_text": pa.string(), "fingerprint": pa.string(), "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64()}


def _row(i, text: str, half: int, stay: bytes, fork: Parse, own, following: str, its) -> tuple:
    more = following[:half].encode()
    edited = stay + more
    changed = signature(phrase_hashes(edited, fork.feed(more)))
    return i, len(text), edited.decode(), as_text(own), as_text(changed), likeness(own, changed), likeness(own, its)
