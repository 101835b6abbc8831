"""Training-order materialisation of token ids.

Texts are tokenised once, in pieces. Their order in one stream and so the place
of every piece is found from the pieces' lengths alone; the stream is cut into
sequences of fixed length, a keyed Feistel permutation with cycle-walking maps
every sequence's number to a global slot, and range partitions of the slots
write shards of fixed stride: slot s is at byte (s mod shard_rows) * stride of
shard s div shard_rows, so a reader goes on from any slot with one seek.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .workspace import NULL_ID, discard, materialise, scratch_path

#: Vocabulary file (tiktoken ranks), its end-of-text id, and the split pattern it was made for.
VOCABULARY = os.environ.get("ANNALIST_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
END = 50_256
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LENGTH, SHARD_ROWS, ROUNDS = 2048, 4096, 4
#: Bytes of ids that a Python worker hands over at once; how hard ids are compressed on the way, and in the table of pieces.
SENT, LEVEL, TABLE_LEVEL = 1 << 20, 6, 9
#: Longest piece of a text that is encoded at once, in characters.
PIECE = 1 << 16
#: Ids in a bucket of the stream, about; shards that one task writes.
BUCKET, TASK_SHARDS = 1 << 26, 4


@lru_cache(maxsize=2)
def encoder(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(text: str, path: str = VOCABULARY) -> Iterator[np.ndarray]:
    """The ids of a text and its end token, piece by piece; a text longer than PIECE is cut after a line or a word."""
    coder, at = encoder(path), 0
    while True:
        end = min(len(text), at + PIECE)
        if end < len(text):
            cut = max(text.rfind("\n", at, end), text.rfind(" ", at, end))
            end = cut if cut > at else end
        own = coder.encode_ordinary(text[at:end])
        if end == len(text):
            yield np.array([*own, END], "<u2")
            return
        yield np.array(own, "<u2")
        at = end


def round_keys(key: str, rounds: int = ROUNDS) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{key}:{r}".encode()).digest()[:8], "little") for r in range(rounds)]


def permute(index: np.ndarray, size: int, key: str) -> np.ndarray:
    """The slot of each index in [0, size): a balanced Feistel network over the least even-bit domain, walked until it falls below size."""
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(k) for k in round_keys(key)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            f = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & mask)
        return left << np.uint64(half) | right

    out = once(index.astype(np.uint64))
    while len(far := np.flatnonzero(out >= size)):
        out[far] = once(out[far])
    return out.astype(np.int64)


def tokenised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(part, row, doc_id, digest, first, n, ids): the ids of every text and its end token, in pieces of bounded length.

    part and row number the pieces as they are written, first marks a text's
    first piece, digest is a hash of the text; ids are little-endian uint16.
    """
    names = ["part", "row", "doc_id", "digest", "first", "n", "ids"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]

    def run(batches):
        task = TaskContext.get()
        part, row, rows, size = task.partitionId() if task else 0, 0, [], 0
        for batch in batches:
            for i, text in zip(*batch.columns, strict=True):
                i, text = i.as_py(), text.as_py() or ""
                digest = xxhash.xxh3_64_intdigest(text) - (1 << 63)
                for k, ids in enumerate(encoded(text, vocabulary)):
                    rows.append((part, row, i, digest, k == 0, len(ids), ids.tobytes()))
                    row, size = row + 1, size + 2 * len(ids)
                    if size >= SENT:
                        yield _batch(rows, names, types)
                        rows, size = [], 0
            del batch
            pa.default_memory_pool().release_unused()
        yield _batch(rows, names, types)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "part long, row long, doc_id long, digest long, first boolean, n long, ids binary")


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [[]] * len(names), types, strict=True)], names)


def placed(pieces: DataFrame) -> DataFrame:
    """(part, row, at): the place of each piece's first id in the stream of the whole corpus.

    Texts stand in the stream by a hash of id and text in buckets whose number
    depends on the corpus only, within a bucket by id and text; equal rows are
    alike. So the stream does not depend on how the input was split.
    """
    total = pieces.agg(F.sum("n")).first()[0] or 0
    key = F.coalesce("doc_id", F.lit(NULL_ID))
    slim = pieces.select("part", "row", "n", "digest", key.alias("k"), F.pmod(F.xxhash64(key, "digest"), F.lit(max(1, -(-total // BUCKET)))).alias("bucket"))
    sums = slim.groupBy("bucket").agg(F.sum("n").alias("sum"))
    starts = sums.select("bucket", (F.sum("sum").over(Window.orderBy("bucket")) - F.col("sum")).alias("start"))
    within = F.sum("n").over(Window.partitionBy("bucket").orderBy("k", "digest", "part", "row")) - F.col("n")
    return slim.withColumn("within", within).join(starts, "bucket").select("part", "row", (F.col("start") + F.col("within")).alias("at"))


def _open(path: str):
    """The file system and the path in it of a URI, or of a path as Hadoop writes it."""
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^(?:file:)?/+", "file:///", path))


def _write_places(places: DataFrame, path: str) -> int:
    """The places of each part's pieces as PATH/part-NNNNNN (int64, by row), which the task that reads the part loads; the number of ids.

    A file has one number for each piece of one input split, so its size is bounded.
    """

    def run(batches):
        fs, base = _open(path)
        fs.create_dir(base, recursive=True)
        task = TaskContext.get()
        attempt = task.taskAttemptId() if task else 0
        part, held, done = None, [], []

        def close():
            with fs.open_output_stream(f"{base}/.part-{part:06d}.{attempt}") as f:
                f.write(np.concatenate(held).astype("<i8").tobytes())
            fs.move(f"{base}/.part-{part:06d}.{attempt}", f"{base}/part-{part:06d}")
            done.append(part)

        for batch in batches:
            parts, at = np.asarray(batch.column("part")), np.asarray(batch.column("at"))
            cut = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if a == b:
                    continue
                if part is not None and parts[a] != part:
                    close()
                    held = []
                part = int(parts[a])
                held.append(at[a:b])
        if part is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], ["part"])

    return places.repartition("part").sortWithinPartitions("part", "row").select("part", "at").mapInArrow(run, "part long").count()


def write_shards(docs: DataFrame, path: str, key: str = "order", id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, shard_rows: int = SHARD_ROWS, vocabulary: str = VOCABULARY) -> DataFrame:
    """Write the corpus in training order; one row for each shard: (shard, first_slot, rows, bytes, sha256).

    The stream of all texts' ids is cut in sequences of length ids; sequence q
    gets slot permute(q). PATH/shard-NNNNNN.bin has the sequences of shard_rows
    slots at a fixed stride (length little-endian uint16), shard-NNNNNN.idx three
    int64 for each: the id of the document it begins in (a null id as 2^63 - 1),
    how many texts it has ids of, and how many ids (only the last sequence is
    filled up with end tokens). path is any file system that pyarrow names by URI
    and the executors share. Shards are written under a name of the task attempt
    and renamed when complete, so a task that is run again leaves whole files
    only, and the bytes depend on documents, key and parameters alone: not on
    splits, the number of executors or retries. Null texts are empty and count as
    an end token, repeated rows are texts of their own, long texts are taken in
    pieces, other columns do not matter. No documents give no rows and no shards.
    """
    spark = docs.sparkSession
    pieces = materialise(tokenised(docs, id_col, text_col, vocabulary), "pieces", TABLE_LEVEL)
    total = pieces.agg(F.sum("n")).first()[0] or 0
    size = -(-total // length)
    shards = max(1, -(-size // shard_rows))
    places = scratch_path(spark, "places")
    _write_places(placed(pieces), places)
    names = ["slot", "offset", "doc_id", "begins", "ids"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]

    def cut(batches):
        fs, base = _open(places)
        squeeze = zstandard.ZstdCompressor(level=LEVEL)
        part = at = None
        rows, sequences, held = [], [], 0

        def emit():
            slots = permute(np.array(sequences, np.int64), size, key).tolist()
            return _batch([(s, *r) for s, r in zip(slots, rows, strict=True)], names, types)

        for batch in batches:
            for p, row, doc, first, ids in zip(*(batch.column(c).to_pylist() for c in ("part", "row", "doc_id", "first", "ids")), strict=True):
                if p != part:
                    part = p
                    with fs.open_input_file(f"{base}/part-{p:06d}") as f:
                        at = np.frombuffer(f.read(), "<i8")
                q, offset = divmod(int(at[row]), length)
                a = 0
                while a < len(ids):
                    own = ids[a : a + 2 * (length - offset)]
                    sequences.append(q)
                    rows.append((offset, doc, offset == 0 or (first and a == 0), squeeze.compress(own)))
                    held += len(own)
                    a, q, offset = a + len(own), q + 1, 0
                if held >= SENT:
                    yield emit()
                    rows, sequences, held = [], [], 0
        if rows:
            yield emit()

    def write(batches):
        fs, base = _open(path)
        fs.create_dir(base, recursive=True)
        task = TaskContext.get()
        attempt = task.taskAttemptId() if task else 0
        loose = zstandard.ZstdDecompressor()
        out, index, sequence, owner, texts = None, [], bytearray(), None, 0
        done, shard, digest = [], None, None

        def finish():
            """Write the sequence that is held."""
            nonlocal sequence, texts
            n = len(sequence) // 2
            data = bytes(sequence) + np.full(length - n, END, "<u2").tobytes()
            out.write(data)
            digest.update(data)
            index.append((NULL_ID if owner is None else owner, texts, n))
            sequence, texts = bytearray(), 0

        def close():
            if out is None:
                return
            finish()
            out.close()
            with fs.open_output_stream(f"{base}/.shard-{shard:06d}.idx.{attempt}") as f:
                f.write(np.array(index, "<i8").tobytes())
            for kind in ("idx", "bin"):
                fs.move(f"{base}/.shard-{shard:06d}.{kind}.{attempt}", f"{base}/shard-{shard:06d}.{kind}")
            done.append((shard, shard * shard_rows, len(index), len(index) * 2 * length, digest.hexdigest()))

        slot = None
        for batch in batches:
            for s, offset, doc, begins, ids in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if s // shard_rows != shard:
                    close()
                    shard, index, digest = s // shard_rows, [], hashlib.sha256()
                    out = fs.open_output_stream(f"{base}/.shard-{shard:06d}.bin.{attempt}")
                elif s != slot:
                    finish()
                slot = s
                if offset == 0:
                    owner = doc
                texts += begins
                sequence += loose.decompress(ids)
            del batch
        close()
        yield _batch(done, ["shard", "first_slot", "rows", "bytes", "sha256"], [*[pa.int64()] * 4, pa.string()])

    fragments = pieces.select("part", "row", "doc_id", "first", "ids").mapInArrow(cut, "slot long, offset long, doc_id long, begins boolean, ids binary")
    tasks = -(-shards // TASK_SHARDS)
    dealt = fragments.repartitionById(tasks, F.floor(F.col("slot") / (shard_rows * TASK_SHARDS)).cast("int")).sortWithinPartitions("slot", "offset")
    written = materialise(dealt.mapInArrow(write, "shard long, first_slot long, rows long, bytes long, sha256 string"), "shards")
    discard(pieces)
    return written


def read_shards(written: DataFrame, path: str, length: int = LENGTH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(slot, shard, byte_offset, first_doc, docs, n_tokens, tokens) of the shards that write_shards() names, each read from its start to its end."""
    names = ["slot", "shard", "byte_offset", "first_doc", "docs", "n_tokens", "tokens"]

    def run(batches):
        fs, base = _open(path)
        stride = 2 * length
        step = max(1, SENT // stride)
        for batch in batches:
            for shard, rows in zip(batch.column("shard").to_pylist(), batch.column("rows").to_pylist(), strict=True):
                with fs.open_input_file(f"{base}/shard-{shard:06d}.bin") as f, fs.open_input_file(f"{base}/shard-{shard:06d}.idx") as g:
                    for a in range(0, rows, step):
                        n = min(step, rows - a)
                        data, about = f.read(n * stride), np.frombuffer(g.read(24 * n), "<i8").reshape(n, 3)
                        if len(data) < n * stride:
                            raise OSError(f"shard {shard} is short")
                        row = np.arange(a, a + n)
                        ends = pa.py_buffer((np.arange(n + 1) * stride).astype(np.int32).tobytes())
                        tokens = pa.Array.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(data)])
                        first = pa.array(about[:, 0], pa.int64(), mask=about[:, 0] == NULL_ID)
                        yield pa.RecordBatch.from_arrays([pa.array(shard * shard_rows + row), pa.array(np.full(n, shard)), pa.array(row * stride), first, pa.array(about[:, 1]), pa.array(about[:, 2]), tokens], names)

    columns = ", ".join(f"{c} {'binary' if c == 'tokens' else 'long'}" for c in names)
    tasks = max(1, -(-written.count() // TASK_SHARDS))
    return written.select("shard", "rows").repartitionById(tasks, F.floor(F.col("shard") / TASK_SHARDS).cast("int")).sortWithinPartitions("shard").mapInArrow(run, columns)


def training_order(docs: DataFrame, key: str = "order", id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, shard_rows: int = SHARD_ROWS, vocabulary: str = VOCABULARY) -> DataFrame:
    """The corpus in training order, written to shards in the shared folder and read back (see write_shards, read_shards).

    One row for each sequence: (slot, shard, byte_offset, first_doc, docs,
    n_tokens, tokens); slots are a keyed permutation of 0 .. n - 1 and order the rows of a shard.
    """
    path = scratch_path(docs.sparkSession, "training-order")
    return read_shards(write_shards(docs, path, key, id_col, text_col, length, shard_rows, vocabulary), path, length, shard_rows)


def read_slots(path: str, start: int, count: int, length: int = LENGTH, shard_rows: int = SHARD_ROWS) -> np.ndarray:
    """count sequences from slot start on, read in order with one seek for each shard."""
    fs, base = _open(path)
    stride, parts = 2 * length, []
    while count > 0:
        shard, row = divmod(start, shard_rows)
        take = min(count, shard_rows - row)
        with fs.open_input_file(f"{base}/shard-{shard:06d}.bin") as f:
            f.seek(row * stride)
            data = f.read(take * stride)
        parts.append(np.frombuffer(data, "<u2").reshape(-1, length))
        if len(data) < take * stride:
            break
        start, count = start + take, count - take
    return np.concatenate(parts) if parts else np.zeros((0, length), "<u2")
