"""Language identification by compression.

Each language has a raw-content zstandard dictionary of training text. A text
is compressed in pieces against every dictionary; the language whose
dictionary gives the fewest bytes is chosen, and the choice is rejected when
the runner-up is too close.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bounds of what a model is fitted on: texts of a language, characters of each, bytes of a dictionary.
SAMPLE_TEXTS, SAMPLE_CHARS, DICTIONARY_BYTES = 256, 4096, 1 << 18
PIECE, LEVEL = 8192, 3
#: Least relative saving over the runner-up for a choice to be accepted.
MARGIN = 0.002
UNKNOWN = "und"
FOLDED = re.compile(r"[\W\d_]+")


def fold(text: str) -> bytes:
    """Only words carry language: lower case, each run of other characters as one space."""
    return FOLDED.sub(" ", text.lower()).strip().encode()


def coder(dictionary: bytes) -> zstandard.ZstdCompressor:
    """A compressor primed with a dictionary; matches of four bytes count, for words are short."""
    own = zstandard.ZstdCompressionParameters.from_level(LEVEL, dict_size=len(dictionary), source_size=PIECE, min_match=4, write_content_size=0, write_dict_id=0)
    d = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=own)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=own)


def fit(docs: DataFrame, label_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", texts: int = SAMPLE_TEXTS) -> list[tuple[str, bytes]]:
    """(language, dictionary) by language, from at most `texts` rows of each non-null label.

    The rows of a language are dealt into `texts` cells by a hash of their id and
    the least hash of each cell is taken, so the sample needs one small
    aggregation, does not depend on the order of rows and has no hot task. Of rows
    that repeat an id under one label the least text with a letter counts; rows
    without an id or with a null or letterless text teach nothing.
    """
    h = F.xxhash64(F.col(id_col), F.lit("language"))
    picked = (
        docs.where(F.col(label_col).isNotNull())
        .select(F.col(label_col).alias("lang"), F.col(id_col).alias("id"), h.alias("h"))
        .groupBy("lang", F.pmod("h", F.lit(texts)).alias("cell"))
        .agg(F.min(F.struct("h", "id")).alias("least"))
        .select("lang", F.col("least.id").alias("id"))
    )
    letters = docs.where(F.col(text_col).rlike(r"\p{L}")).select(F.col(label_col).alias("lang"), F.col(id_col).alias("id"), F.substring(text_col, 1, SAMPLE_CHARS).alias("t"))
    rows = letters.join(F.broadcast(picked), ["lang", "id"]).groupBy("lang", "id").agg(F.min("t").alias("t")).collect()
    by: dict[str, set[str]] = {}
    for r in rows:
        by.setdefault(r.lang, set()).add(r.t)
    model = []
    for lang in sorted(by):
        own = sorted(by[lang], key=lambda t: (len(t), t))
        share = max(64, DICTIONARY_BYTES // len(own))
        model.append((lang, b" ".join(fold(t)[:share] for t in own)[-DICTIONARY_BYTES:]))
    return model


def classifier(model: list[tuple[str, bytes]], margin: float = MARGIN):
    """Arrow UDF: text -> struct(lang, score, accepted)."""
    state: list = []  # one coder for each language, made once in each Python worker

    def load():
        if not state:
            state.extend(coder(content) for _, content in model)
        return state

    langs = [x for x, _ in model]

    @F.arrow_udf("struct<lang: string, score: double, accepted: boolean>")
    def classify(texts: pa.Array) -> pa.Array:
        coders = load()
        found, scores, accepted = [], [], []
        for value in texts.to_pylist():
            if value is None or not coders:
                found.append(UNKNOWN)
                scores.append(0.0)
                accepted.append(False)
                continue
            data = fold(value)
            sizes = np.zeros(len(coders))
            for at in range(0, len(data), PIECE):
                piece = data[at : at + PIECE]
                sizes += [len(c.compress(piece)) for c in coders]
            best = int(sizes.argmin())
            second = np.delete(sizes, best).min() if len(sizes) > 1 else 2 * sizes[best]
            gain = 1 - sizes[best] / second if second else 0.0
            found.append(langs[best])
            scores.append(float(gain))
            accepted.append(bool(gain >= margin))
        return pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())], ["lang", "score", "accepted"])

    return classify


def accepted(docs: DataFrame, model: list[tuple[str, bytes]], text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """The rows of docs whose language is told by a sufficient margin, all columns as they are, whatever their names.

    Rows are judged as `identify` does: a null, empty or letterless text goes, equal
    sizes go, repeated rows stay or go alike, a very long text is judged whole, and
    no rows or an empty model give no rows.
    """
    letters = F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col))
    return docs.select(F.struct("*").alias("row"), classifier(model, margin)(letters).alias("found")).where("found.accepted").select("row.*")


def identify(docs: DataFrame, model: list[tuple[str, bytes]], text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """docs with lang_pred, score and accepted (replacing columns of those names).

    score is the share of bytes saved over the runner-up, 0 to 1. A null text or
    one without a letter is `und` with score 0 and not accepted; so is every text
    when the model is empty. With a single language every other text is accepted.
    Equal sizes go to the first language in code point order, not accepted.
    Repeated rows are judged each, alike; a very long text is compressed whole,
    in pieces, so memory does not grow with their number.
    """
    letters: Column = F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col))
    rest = [c for c in docs.columns if c not in ("lang_pred", "score", "accepted")]
    out = docs.select(F.struct(*rest).alias("row"), classifier(model, margin)(letters).alias("found"))
    return out.select("row.*", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"), F.col("found.accepted").alias("accepted"))
