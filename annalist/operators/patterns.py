"""Many literal patterns at once: an automaton of them, in bounded blocks, run over the texts' Arrow batches."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of the patterns of one automaton; more patterns are dealt into blocks by their hash, each a scan of the texts.
BLOCK = 1 << 20
#: The automaton of the block last used, kept between the tasks of a worker.
_held: dict[tuple, object] = {}


def folded(c: Column) -> Column:
    """Lower case; white space is folded by the automaton's side."""
    return F.lower(c.cast("string"))


def _spaced(text: str) -> str:
    """Words between single spaces, one at each end, so that a pattern can only match whole words."""
    return " " + b" ".join(text.encode().split()).decode() + " "


def _automaton(words: tuple[str, ...]):
    import ahocorasick

    if words not in _held:
        _held.clear()
        made = ahocorasick.Automaton()
        for word in words:
            made.add_word(word, word)
        made.make_automaton()
        _held[words] = made
    return _held[words]


def _found(texts: DataFrame, keys: list[str], words: tuple[str, ...]) -> DataFrame:
    def run(batches):
        machine = _automaton(words)
        for batch in batches:
            at, out = [], []
            for i, text in enumerate(batch.column("t").to_pylist()):
                if text:
                    hits = {word for _, word in machine.iter(_spaced(text))}
                    at += [i] * len(hits)
                    out += [word[1:-1] for word in hits]
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(rows) for k in keys], pa.array(out, pa.string())], [*keys, "pattern"])

    shape = ", ".join(f"`{k}` {texts.schema[k].dataType.simpleString()}" for k in keys)
    return texts.mapInArrow(run, f"{shape}, pattern string")


def pattern_blocks(patterns: DataFrame, column: str, block: int = BLOCK) -> int:
    """How many blocks the distinct patterns make."""
    size = patterns.select(spaced(F.col(column)).alias("p")).distinct().agg(F.sum(F.length("p"))).first()[0]
    return -(-(size or 0) // block)


def occurring(texts: DataFrame, keys: list[str], text: Column, patterns: DataFrame, column: str, block: int = BLOCK) -> DataFrame:
    """(keys..., pattern) of the patterns that a row's text has as whole words, case and white space aside.

    patterns is a table; its distinct values, folded, come to the driver block by
    block, each of bounded size, and go to the tasks with the automaton's code. Every
    row is scanned once for each block, whatever the number of patterns; overlapping
    occurrences count. pattern is the folded text. A null or blank text or pattern
    is in no result; rows that share keys are not merged.
    """
    blocks = pattern_blocks(patterns, column, block)
    distinct = patterns.select(spaced(F.col(column)).alias("p")).distinct()
    own = texts.select(*keys, folded(text).alias("t"))
    parts = []
    for n in range(blocks):
        rows = distinct.where(F.pmod(F.xxhash64("p"), F.lit(blocks)) == n).collect()  # of bounded size
        words = tuple(sorted({w for r in rows if r.p is not None and (w := _spaced(r.p)).strip()}))
        if words:
            parts.append(_found(own, keys, words))
    if not parts:
        return texts.select(*keys, F.lit(None).cast("string").alias("pattern")).limit(0)
    return reduce(DataFrame.unionByName, parts)


def spaced(c: Column) -> Column:
    """The folded text that `occurring` gives as pattern."""
    return F.btrim(F.regexp_replace(folded(c), r"\s+", " "))
