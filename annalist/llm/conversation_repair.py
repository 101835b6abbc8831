"""Conversation structure repair: the cheapest edits that make every conversation a well-formed dialogue.

A well-formed conversation is empty, or has at most one system turn, first, and
then one or more pairs of a user and an assistant turn. A turn may be kept (0),
given the role user or assistant (2) or deleted (3); an empty turn may be inserted
anywhere (2). A blank or repeated turn must be deleted; a truncated one that stays
costs 1. The audit has the initials of the edits in order; of equally cheap ones
the least in ASCII order is taken.

Turns are numbered in their conversation without a window: the rows are sorted by
range, numbered within a partition, and the partitions' sizes give the offset.
Runs of WIDTH turns are then repaired each by itself, from every state the grammar
can be in, by a recursive DuckDB query inside hash-partitioned batches: each
recursion advances one turn for all conversations of the batch and keeps the least
cost and audit for each state. The same query then joins WIDTH neighbouring runs,
until a conversation is one. So a conversation with a third of all turns is shared
out as well. (Audits of equal cost after the same turns are never prefixes of each
other, for an insertion costs something; so the least of a run stays the least.)
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .workspace import discard, materialise

#: Turns (or runs) that one run joins, and rows of one batch, about.
WIDTH = 256
BATCH_ROWS = 1 << 16
SPACES = " \t\n\x0b\f\r"
OK, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an inserted or re-roled turn, which then has the only role that fits.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: Insertions that make a conversation whole when it ends in a state.
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
KEEPS = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
SCHEMA = "c long, seg long, origin int, state int, cost long, audit string"

WALK = """
WITH RECURSIVE walk(c, seg, origin, state, step, cost, audit) USING KEY (c, seg, origin, state) AS (
    SELECT DISTINCT c, seg, o, o, 0, CAST(0 AS BIGINT), '' FROM part, range(4) r(o) WHERE seg > 0 OR o = 0
    UNION
    SELECT c, seg, origin, state, step, best[1], best[2] FROM (
        SELECT w.c, w.seg, w.origin, p.state, w.step + 1 AS step, min((w.cost + p.cost, w.audit || p.audit)) AS best
        FROM walk w JOIN part p ON p.c = w.c AND p.seg = w.seg AND p.n = w.step AND p.origin = w.state
        GROUP BY ALL))
SELECT c, seg, CAST(origin AS INT) AS origin, CAST(state AS INT) AS state, CAST(cost AS BIGINT) AS cost, audit FROM walk"""


def _moves() -> pa.Table:
    """(kind, origin, state, cost, audit): what may be done with a turn of a kind. A kind is an initial and whether it must go or is truncated."""
    rows = []
    for kind, (initial, fault) in enumerate((i, f) for i in ("s", "u", "a", "") for f in ("", "truncated", "gone")):
        for origin in range(4):
            rows.append((kind, origin, origin, 3, "D"))
            if fault == "gone":
                continue
            extra = 1 if fault else 0
            for state, before, cost in ((origin, "", 0), (NEXT[origin], "I", 2)):
                rows.append((kind, origin, NEXT[state], cost + 2 + extra, before + "R"))
                if (initial, state) in KEEPS:
                    rows.append((kind, origin, KEEPS[initial, state], cost + extra, before + "K"))
    return pa.table(dict(zip(("kind", "origin", "state", "cost", "audit"), map(list, zip(*rows, strict=True)), strict=True)))


def _walked(part_sql: str):
    """A batch function: the rows of one hash partition through the recursive query."""

    def walk(batches):
        import duckdb

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "512MB", "temp_directory": tempfile.gettempdir()})
        try:
            db.register("turn", pa.Table.from_batches(held))
            db.register("move", _moves())
            db.execute(f"CREATE TABLE part AS {part_sql}")
            found = db.sql(WALK).to_arrow_table()
        finally:
            db.close()
        names = ["c", "seg", "origin", "state", "cost", "audit"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string()]
        for b in found.select(names).cast(pa.schema(list(zip(names, types, strict=True)))).combine_chunks().to_batches(max_chunksize=1 << 14):
            yield b

    return walk


def _initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def _numbered(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Table of all turns: k (names the conversation), conv_id, turn, role, text, fault, g (dense number in the order of conversations and turns)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    key = F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("null"))
    rows = turns.select(key.alias("k"), F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    # equal rows are counted before they meet, and told apart by number
    alike = rows.groupBy("k", "conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")).withColumn("h", F.md5("text"))
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn"), F.lit(0)).alias("turn"))
    alike = materialise(alike.withColumn("at", when), "turns", 3)
    repeated = alike.groupBy("k", "role", "h").agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first <> last").drop("last")
    each = alike.join(repeated, ["k", "role", "h"], "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    stripped = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (
        F.when(F.length(stripped) == 0, BLANK)
        .when((F.col("copy") > 1) | (F.col("at") != F.coalesce("first", "at")), DUPLICATE)
        .when(~F.substring(stripped, -1, 1).isin(".", "!", "?"), TRUNCATED)
        .otherwise(OK)
    )
    order = ["k", "at", "role", "h", "copy"]
    sorted_ = each.withColumn("fault", fault).repartitionByRange(*order).sortWithinPartitions(*order)
    held = materialise(sorted_.select("k", "conv_id", "turn", "role", "text", "fault", F.monotonically_increasing_id().alias("o")), "ordered-turns", 3)
    discard(alike)
    # the number of a row is its number in its partition and the size of all partitions before
    part = F.shiftright(F.col("o"), 33)
    sizes = {r.part: r.size for r in held.groupBy(part.alias("part")).agg(F.count("*").alias("size")).collect()}
    offsets, total = [], 0
    for p in sorted(sizes):
        offsets.append((p, total - (p << 33)))
        total += sizes[p]
    base = held.sparkSession.createDataFrame(offsets, "part long, base long")  # one row for each partition
    return held.join(F.broadcast(base), part == F.col("part")).withColumn("g", F.col("o") + F.col("base")).drop("o", "part", "base")


def _placed(turns: DataFrame) -> DataFrame:
    """turns with c (the number of the conversation's first row), n (place in the run) and seg (the run)."""
    first = turns.groupBy("k").agg(F.min("g").alias("c"))
    at = F.col("g") - F.col("c")
    return turns.join(first, "k").withColumn("n", at % WIDTH).withColumn("seg", F.floor(at / WIDTH))


def _batched(parts: DataFrame, rows: int, part_sql: str) -> DataFrame:
    batches = max(parts.sparkSession.sparkContext.defaultParallelism, -(-rows // BATCH_ROWS))
    return parts.repartition(batches, "c", "seg").mapInArrow(_walked(part_sql), SCHEMA)


def _cheapest(turns: DataFrame, rows: int) -> DataFrame:
    """Table (c, cost, audit) of the cheapest repair of every conversation."""
    gone = F.col("fault").isin(BLANK, DUPLICATE)
    group = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for i, r in enumerate("sua") for x in (r, 3 * i)]), _initial(F.col("role"))), F.lit(9))
    kind = group + F.when(gone, 2).when(F.col("fault") == TRUNCATED, 1).otherwise(0)
    runs = _batched(turns.select("c", "seg", "n", kind.alias("kind")), rows, "SELECT c, seg, n, origin, state, cost, audit FROM turn JOIN move USING (kind)")
    runs = materialise(runs, "runs", 3)
    whole, size, used = [], runs.select(F.max("seg")).first()[0], [runs]
    while size:
        several = runs.groupBy("c").agg(F.max("seg").alias("last")).where("last > 0").select("c")
        whole.append(runs.join(several, "c", "left_anti"))
        more = runs.join(several, "c").withColumn("n", F.col("seg") % WIDTH).withColumn("seg", F.floor(F.col("seg") / WIDTH))
        runs = materialise(_batched(more, more.count(), "SELECT c, seg, n, origin, state, cost, audit FROM turn"), "runs", 3)
        used.append(runs)
        size //= WIDTH
    whole.append(runs)
    ends = whole[0]
    for more in whole[1:]:
        ends = ends.unionByName(more)
    closing = F.element_at(F.create_map(*[F.lit(x) for s, n in CLOSING.items() for x in (s, n)]), F.col("state"))
    closed = ends.where("origin = 0").select("c", F.struct((F.col("cost") + 2 * closing).alias("cost"), F.concat("audit", F.repeat(F.lit("I"), closing)).alias("audit")).alias("best"))
    out = materialise(closed.groupBy("c").agg(F.min("best").alias("best")).select("c", "best.cost", "best.audit"), "repairs", 3)
    discard(*used)
    return out


def _edits(repairs: DataFrame) -> DataFrame:
    """(c, at, e, edit, role) of every turn that stays or is inserted: its place among the turns (null if inserted), in the result, and its role if new."""

    def explode(batches):
        for batch in batches:
            for c, audit in zip(batch.column("c").to_pylist(), batch.column("audit"), strict=True):
                edit = np.frombuffer(audit.as_py().encode(), np.uint8)
                stays, own = edit != ord("D"), edit != ord("I")
                turn = np.cumsum(own) - 1
                odd = int(stays.sum()) % 2  # a system turn makes the number odd
                e = 0
                for at in range(0, len(edit), 1 << 16):
                    pick = np.flatnonzero(stays[at : at + (1 << 16)]) + at
                    place = np.arange(e, e + len(pick))
                    e += len(pick)
                    role = pa.array(np.where((place - odd) % 2 == 0, "user", "assistant").tolist(), pa.string(), mask=edit[pick] == ord("K")) if len(pick) else pa.array([], pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(pick), c), pa.int64()), pa.array(turn[pick], pa.int64(), mask=~own[pick]), pa.array(place, pa.int64()), pa.array([chr(x) for x in edit[pick].tolist()], pa.string()), role],
                        ["c", "at", "e", "edit", "new_role"],
                    )

    return repairs.select("c", "audit").mapInArrow(explode, "c long, at long, e long, edit string, new_role string")


class Repair:
    """The cheapest repair of every conversation of turns.

    A null role or text counts as one space; a null conversation id names one
    conversation. Turns are taken by number, null first; rows of one number by role
    and the MD5 hash of their text, so that equal rows stand together (each but the
    first repeats it). Other columns are not read. Texts are never cut. A table
    without rows gives none. Tables stay in the scratch folder until `discard`.
    """

    def __init__(self, turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"):
        numbered = _numbered(turns, conv_col, turn_col, role_col, text_col)
        self._turns = materialise(_placed(numbered), "placed-turns", 3)
        self._repairs = _cheapest(self._turns, self._turns.count())

    def conversations(self) -> DataFrame:
        """(c, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), one row for each conversation; c names it."""
        t = self._turns
        run_end = t.where(F.col("n") == WIDTH - 1).select("c", (F.col("seg") + 1).alias("seg"), _initial(F.col("role")).alias("before_run"))
        lag = F.lag(_initial(F.col("role"))).over(_run_order())
        pairs = t.join(run_end, ["c", "seg"], "left").withColumn("before", F.coalesce(lag, F.col("before_run")))
        bad = F.col("before").isNotNull() & ~F.concat("before", _initial(F.col("role"))).isin("su", "ua", "au")
        illegal = pairs.groupBy("c").agg(F.count_if(bad).alias("illegal"))
        counts = t.groupBy("c").agg(
            F.first("conv_id").alias("conv_id"),
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
            *[F.count_if(F.col("fault") == code).alias(name) for code, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated"))],
        )
        return counts.join(illegal, "c").join(self._repairs, "c")

    def turns(self) -> DataFrame:
        """(c, e, edit, role, text): the repaired turns, numbered by e in their conversation; an inserted one has an empty text."""
        own = self._turns.select("c", (F.col("g") - F.col("c")).alias("at"), "role", "text")
        out = _edits(self._repairs).join(own, ["c", "at"], "left")
        return out.select("c", "e", "edit", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def discard(self) -> None:
        discard(self._turns, self._repairs)


def _run_order():
    from pyspark.sql import Window

    return Window.partitionBy("c", "seg").orderBy("n")


def joined_hash(lines: DataFrame) -> DataFrame:
    """(c, sha256) of lines (c, e, line) joined by newlines in the order of e.

    WIDTH neighbouring lines are joined first; their texts then pass, sorted, by a
    running hash of constant memory, for a hash of a sequence has no parts.
    """
    own = F.transform(F.array_sort(F.collect_list(F.struct("e", "line"))), lambda x: x["line"])
    blocks = lines.withColumn("block", F.floor(F.col("e") / WIDTH)).groupBy("c", "block").agg(F.array_join(own, "\n").cast("binary").alias("text"))

    def run(batches):
        now, state = None, None
        done: list[tuple[int, str]] = []
        for batch in batches:
            for c, text in zip(batch.column("c").to_pylist(), batch.column("text"), strict=True):
                if c != now:
                    if now is not None:
                        done.append((now, state.hexdigest()))
                    now, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(text.as_py())
            if done:
                yield pa.RecordBatch.from_pylist([{"c": c, "sha256": h} for c, h in done])
                done = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([{"c": now, "sha256": state.hexdigest()}])

    return blocks.repartition("c").sortWithinPartitions("c", "block").select("c", "text").mapInArrow(run, "c long, sha256 string")
