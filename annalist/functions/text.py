"""Text, version and HTTP-header expressions on JVM columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Java needs (?U) for \s to mean Unicode white space.
SPACE = r"(?U)\s+"
#: Fixed values that results depend on: what becomes of Markdown on its way to prose, in order; where blocks and
#: sentences part; a block's marker; a release version.
EMPHASIS = r"(?U)(?<!\w)\*([^*\s][^*]*?[^*\s]|[^*\s])\*(?!\w)"
TO_PROSE = (
    (r"(?s)<!--.*?-->", ""),
    (r"</?(?:p|div|details|summary|section)\b[^>]*>", "\n\n"),
    (r"(?m)^(\s*)\* ", "$1- "),
    (r"</?(?:Note|Tip|Info|Warning|Accordion|AccordionGroup|Card|CardGroup|Steps|Step|Tabs|Tab|div|span|p|strong|em|a|br|code)\b[^>]*>", " "),
    (r"\[([^\]]+)\]\([^)]+\)", "$1"),
    (r"\*\*([^*]+)\*\*", "$1"),
    (EMPHASIS, "$1"),
    ("`", ""),
)
BLOCK_END, SENTENCE_END, MARKER = r"\n\s*\n|\n(?=\s*[-*] )", r"(?<=[.!?])\s+(?=[A-Z`\"'])", r"^\s*(?:[-*>]|#+)\s+"
VERSION = r"^v?(0|[1-9][0-9]*)\.(0|[1-9][0-9]*)\.(0|[1-9][0-9]*)(?:\+[0-9A-Za-z.-]+)?\z"

def fold_space(c: Column) -> Column:
    """Every run of white space as one space, none at the ends."""
    return F.btrim(F.regexp_replace(c, SPACE, " "))


def nonblank(c: Column) -> Column:
    """Neither null nor only white space."""
    return F.coalesce(F.length(fold_space(c)) > 0, F.lit(False))


def slug(c: Column) -> Column:
    """Lower case, every run of characters but a-z and 0-9 as one -, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-"))


def is_commit(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^[0-9a-fA-F]{40}\z"), F.lit(False))


def package_key(c: Column, kind: str) -> Column:
    """What package names are compared by: Python names fold case and runs of - _ ., others are exact."""
    return F.lower(F.regexp_replace(c, "[-_.]+", "-")) if kind == "python" else c


def version_of(c: Column) -> Column:
    """[major, minor, patch] of a release version with an optional v and build part; null for anything else, pre-releases too."""
    return F.when(c.rlike(VERSION), F.array(*[F.regexp_extract(c, VERSION, i).cast("int") for i in (1, 2, 3)]))


def context(c: Column) -> Column:
    """Text in the form that is reviewed: LF ends, no trailing blanks, no outer empty lines, at most one empty line in a row."""
    lines = F.regexp_replace(F.regexp_replace(c, "\r\n?", "\n"), r"(?m)[ \t\x0b\f]+$", "")
    return F.regexp_replace(F.regexp_replace(lines, r"\A\n+|\n+\z", ""), "\n{3,}", "\n\n")


def title(c: Column, fallback: Column) -> Column:
    """The first level-one heading without * and `, else the fallback."""
    found = F.regexp_extract(c, r"(?m)^#\s+(.+?)\s*$", 1)
    return F.when(found == "", fallback).otherwise(F.btrim(F.regexp_replace(found, "[*`]", "")))


def plain(c: Column, emphasis: bool = True) -> Column:
    """Markup as prose: comments and presentation tags out, links and emphasis as their text; entities stay for unescape().

    Without emphasis single asterisks stay, as in a page that is no Markdown.
    """
    for pattern, put in TO_PROSE:
        if emphasis or pattern != EMPHASIS:
            c = F.regexp_replace(c, pattern, put)
    return c


def blocks(c: Column) -> Column:
    """Paragraphs and list items of plain text, markers off, white space folded, empty ones left out."""
    parts = F.split(c, BLOCK_END)
    return F.filter(F.transform(parts, lambda b: fold_space(F.regexp_replace(b, MARKER, ""))), lambda b: b != "")


def excerpt(c: Column, pattern: str, limit: int = 420) -> Column:
    """From plain text, of the blocks that match: the first that fits in limit or has a matching sentence decides.

    It gives the block, else that sentence, else the sentence cut after a word
    with an ellipsis if the match survives, else null.
    """
    hit = lambda x: x.rlike(f"(?i){pattern}")

    def judged(block: Column) -> Column:
        sentence = F.get(F.filter(F.split(block, SENTENCE_END), hit), F.lit(0))
        clipped = F.rtrim(F.regexp_replace(F.substring(sentence, 1, limit - 2), r" [^ ]*$", ""))
        value = F.when(F.length(block) <= limit, block).when(F.length(sentence) <= limit, sentence).when(hit(clipped), F.concat(clipped, F.lit(" …")))
        return F.struct(((F.length(block) <= limit) | sentence.isNotNull()).alias("decides"), value.alias("value"))

    found = F.filter(F.transform(F.filter(blocks(c), hit), judged), lambda x: x["decides"])
    return F.when(c.rlike(f"(?im){pattern}"), F.get(found, F.lit(0))["value"])


def bracket_depth(c: Column) -> Column:
    """Deepest nesting of [ and { in JSON text, brackets within strings left out."""
    bare = F.regexp_replace(c, r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"?', "")
    marks = F.regexp_extract_all(bare, F.lit(r"([\[\]{}])"), 1)
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("top"))

    def step(acc, x):
        now = acc["now"] + F.when(x.isin("[", "{"), 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(acc["top"], now).alias("top"))

    return F.aggregate(marks, start, step)["top"]


def json_encoding(c: Column) -> Column:
    """The encoding of JSON bytes, told by a byte order mark or, JSON beginning with ASCII, by where its first bytes are zero."""
    h = F.hex(F.substring(c, 1, 4))
    byte = lambda i: F.substring(h, 2 * i - 1, 2)
    zero = lambda i: byte(i) == "00"
    four, two = F.octet_length(c) >= 4, F.octet_length(c) == 2
    return (
        F.when(c.isNull(), F.lit(None))
        .when(h == "0000FEFF", "UTF-32BE")
        .when(h == "FFFE0000", "UTF-32LE")
        .when(h.startswith("FEFF"), "UTF-16BE")
        .when(h.startswith("FFFE"), "UTF-16LE")
        .when(h.startswith("EFBBBF"), "UTF-8")
        .when(four & zero(1) & zero(2), "UTF-32BE")
        .when(four & zero(1), "UTF-16BE")
        .when(four & zero(2) & zero(3) & zero(4), "UTF-32LE")
        .when(four & zero(2), "UTF-16LE")
        .when(two & zero(1), "UTF-16BE")
        .when(two & zero(2), "UTF-16LE")
        .otherwise("UTF-8")
    )


def json_text(c: Column) -> Column:
    """The text of JSON bytes in UTF-8, UTF-16 or UTF-32, with or without a mark; null where they are not well-formed.

    Wide encodings are put into big-endian order and checked (whole units, paired
    surrogates, code points up to 10FFFF) as hexadecimal digits before they are decoded.
    """
    kind, h = json_encoding(c), F.hex(c)
    wide16 = F.when(kind == "UTF-16LE", F.regexp_replace(h, "(..)(..)", "$2$1")).otherwise(h)
    wide32 = F.when(kind == "UTF-32LE", F.regexp_replace(h, "(..)(..)(..)(..)", "$4$3$2$1")).otherwise(h)
    bare16, bare32 = F.regexp_replace(wide16, "^FEFF", ""), F.regexp_replace(wide32, "^0000FEFF", "")
    sound16 = bare16.rlike(r"\A(?:(?:[0-9A-CEF]...|D[0-7]..)|D[89AB]..D[C-F]..)*+\z")
    sound32 = bare32.rlike(r"\A(?:000[1-9A-F]....|0010....|0000(?:[0-9A-CEF]...|D[0-7]..))*+\z")
    bare8 = F.when(F.hex(F.substring(c, 1, 3)) == "EFBBBF", F.substring(c, 4, 2**31 - 1)).otherwise(c)
    return (
        F.when(kind == "UTF-8", F.try_validate_utf8(bare8.cast("string")))
        .when(kind.startswith("UTF-16") & sound16, F.decode(F.unhex(F.when(sound16, bare16)), "UTF-16BE"))
        .when(kind.startswith("UTF-32") & sound32, F.decode(F.unhex(F.when(sound32, bare32)), "UTF-32"))
    )


def bounded_json(c: Column, deepest: int = 64) -> Column:
    """JSON as VARIANT, null where it is invalid or nested deeper than `deepest`; depth is judged before it is parsed."""
    return F.when(bracket_depth(c) <= deepest, F.try_parse_json(c))


def retry_after(c: Column, now: Column) -> Column:
    """Seconds of a Retry-After header, a number or an HTTP date, kept within 0 and 60; null for anything else."""
    seconds = F.when(c.rlike(r"^\s*[0-9]+(\.[0-9]+)?\s*\z"), F.btrim(c).cast("double"))
    # the weekday is not checked
    date = F.nullif(F.regexp_extract(c, r"^\s*[A-Z][a-z]{2}, ([0-9]{2} [A-Z][a-z]{2} [0-9]{4} [0-9:]{8}) GMT\s*\z", 1), F.lit(""))
    stamp = F.try_to_timestamp(date, F.lit("dd MMM yyyy HH:mm:ss"))
    wait = F.coalesce(seconds, (stamp.cast("double") - now.cast("double")))
    return F.when(wait.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(60.0), wait)))


def retried(status: Column, retry_header: Column, remaining: Column, limited: Column) -> Column:
    """Whether a response is asked for again: 5xx and 429 always, 403 only from an API that limits rates (limited), with evidence that it did."""
    evidence = retry_header.isNotNull() | F.coalesce(remaining == "0", F.lit(False))
    return (status >= 500) | (status == 429) | ((status == 403) & limited & evidence)


def utc(c: Column) -> Column:
    """Timestamp of an ISO text with Z or an offset; null for anything else."""
    return F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ].*(Z|[+-][0-9]{2}:?[0-9]{2})\z"), F.try_to_timestamp(c))


def day(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")
