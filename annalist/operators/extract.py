"""Extraction: links, sitemaps, tables, sections, release notes and inventories, as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls

#: A link line of an index, an HTML anchor.
LINK = r"-\s*\[([^\]]+)\]\(([^)]+)\)(?::[^\S\n]*([^\n]*))?"
ANCHOR = r'(?s)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'


def matches(df: DataFrame, keys: list[str], column: str, pattern: str, names: list[str]) -> DataFrame:
    """keys, pos and the groups of every match of pattern, one row for each match in order."""
    groups = [F.regexp_extract_all(F.col(column), F.lit(pattern), i + 1) for i in range(len(names))]
    zipped = F.arrays_zip(*[g.alias(n) for g, n in zip(groups, names, strict=True)])
    return df.select(*keys, F.posexplode(zipped).alias("pos", "m")).select(*keys, "pos", *[F.col("m")[n].alias(n) for n in names])


def index_links(indexes: DataFrame, keys: list[str], column: str, base: str, index: str) -> DataFrame:
    """keys, url, title, description, pos: links of Markdown indexes to pages of base, the first of each URL, the index itself left out."""
    found = matches(indexes, keys, column, LINK, ["title", "raw", "description"]).withColumn("url", urls.canonical(F.col("raw"), base))
    pages = found.where(urls.same_origin(F.col("url"), base) & (F.col("url") != F.lit(index)))
    first = pages.groupBy(*keys, "url").agg(F.min(F.struct("pos", F.btrim("title").alias("title"), F.btrim("description").alias("description"))).alias("r"))
    return first.select(*keys, "url", "r.title", "r.description", "r.pos")


def excluded_links(indexes: DataFrame, keys: list[str], column: str, base: str, index: str) -> DataFrame:
    """keys, url, title, reason: links that are no pages of base, the last title of each URL."""
    found = matches(indexes, keys, column, LINK, ["title", "raw", "description"]).withColumn("url", urls.normalize(F.col("raw"), base))
    out = found.withColumn("reason", urls.exclusion_reason(F.col("url"), base, index)).where("reason is not null")
    return out.groupBy(*keys, "url").agg(F.max_by(F.struct(F.btrim("title").alias("title"), "reason"), F.col("pos")).alias("r")).select(*keys, "url", "r.title", "r.reason")


def anchors(pages: DataFrame, key: str, column: str, last: bool = False) -> DataFrame:
    """key, href, label, pos of the anchors of HTML pages: of each href the first in order, or the last."""
    found = matches(pages, [key], column, ANCHOR, ["href", "label"])
    pick = F.max(F.struct("pos", "label")) if last else F.min(F.struct("pos", "label"))
    return found.groupBy(key, "href").agg(pick.alias("r")).select(key, "href", "r.label", "r.pos")


def sitemap(files: DataFrame, keys: list[str], column: str, base: str) -> DataFrame:
    """keys, url, lastmod of sitemap XML: pages of base, the last entry of each, no lastmod as empty text.

    url elements are parsed whole, so a missing lastmod cannot shift the others;
    prefixes of names do not matter.
    """
    bare = F.regexp_replace(F.col(column), r"<(/?)[A-Za-z0-9_.-]+:", "<$1")
    rows = files.select(*keys, F.posexplode(F.from_xml(bare, "url array<struct<loc: string, lastmod: string>>").getField("url")).alias("pos", "u"))
    page = rows.select(*keys, "pos", urls.canonical(F.btrim("u.loc"), base).alias("url"), F.btrim(F.coalesce("u.lastmod", F.lit(""))).alias("lastmod"))
    return page.where(urls.same_origin(F.col("url"), base)).groupBy(*keys, "url").agg(F.max_by("lastmod", "pos").alias("lastmod"))


def lines(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """keys, n (from 0) and line of every line."""
    return df.select(*keys, F.posexplode(F.split(F.col(column), "\n")).alias("n", "line"))


def islands(rows: DataFrame, keys: list[str], order: str, inside: Column) -> DataFrame:
    """Rows where inside holds, with island: the number (from 1) of their unbroken run under its keys."""
    w = Window.partitionBy(*keys).orderBy(order)
    marked = rows.withColumn("__in", F.coalesce(inside, F.lit(False)))
    starts = F.col("__in") & ~F.coalesce(F.lag("__in").over(w), F.lit(False))
    return marked.withColumn("island", F.sum(starts.cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("__in").drop("__in")


def tables(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """keys, island (table), n, cells: rows of Markdown pipe tables without their separator rows."""
    found = islands(lines(df, keys, column), keys, "n", F.col("line").rlike(r"^\s*\|"))
    inner = F.regexp_replace(F.btrim("line"), r"^\|+|\|+$", "")
    cells = F.transform(F.split(inner, r"\|"), lambda c: F.btrim(c))
    return found.select(*keys, "island", "n", cells.alias("cells")).where(~F.forall("cells", lambda c: c.rlike(r"^:?-+:?\z")))


def code_cell(cell: Column) -> Column:
    """The code of a cell that is one `code` span, else null."""
    return F.when(cell.rlike(r"^`[^`]+`\z"), F.regexp_replace(cell, "`", ""))


def filled(rows: DataFrame, keys: list[str], order: str, value: Column, name: str) -> DataFrame:
    """rows with name: the latest value that is not null, up to and with each row."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(w))


def bounded(rows: DataFrame, keys: list[str], order: str, heading: Column) -> DataFrame:
    """Headings with start and until: where the next heading under the keys begins (null for the last)."""
    w = Window.partitionBy(*keys).orderBy(order)
    return rows.where(heading).withColumn("start", F.col(order)).withColumn("until", F.lead(order).over(w))


def levelled_sections(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """keys, start, level, title, until: Markdown headings, each ending at the next of its level or above (null: the end)."""
    heads = lines(df, keys, column).where(F.col("line").rlike(r"^#{1,6}\s+\S")).withColumn("level", F.length(F.regexp_extract("line", "^(#+)", 1)))
    heads = heads.select(*keys, F.col("n").alias("start"), "level", F.btrim(F.regexp_replace("line", r"^#+\s+", "")).alias("title"))
    # from the last heading back, so that each frame is the one before it and one row more
    after = Window.partitionBy(*keys).orderBy(F.col("start").desc()).rowsBetween(Window.unboundedPreceding, -1)
    # for each level the first heading of it or above that follows
    nexts = [F.min(F.when(F.col("level") <= k, F.col("start"))).over(after) for k in range(1, 7)]
    rows = heads.select("*", F.array(*nexts).alias("nexts"))
    return rows.withColumn("until", F.element_at("nexts", F.col("level").cast("int"))).drop("nexts")


def release_notes(df: DataFrame, keys: list[str], column: str, most: int = 12) -> DataFrame:
    """keys, version, date, changes: sections headed by a release version, with at most `most` of their own bullets."""
    source = df.withColumn("__t", F.regexp_replace(F.col(column), r"(?is)<h2[^>]*>(.*?)</h2>", "\n## $1\n"))
    heads = levelled_sections(source, keys, "__t")
    pattern = r"^\[?v?((?:0|[1-9][0-9]*)(?:\.(?:0|[1-9][0-9]*)){2})\]?(?:\s*[-(–]?\s*([0-9]{4}-[0-9]{2}-[0-9]{2})\)?)?\s*\z"
    found = heads.where(F.col("title").rlike(pattern)).select(*keys, "start", "until", F.regexp_extract("title", pattern, 1).alias("version"), F.nullif(F.regexp_extract("title", pattern, 2), F.lit("")).alias("date"))
    # every bullet with those that follow it, `most` in all; a heading takes those of the first bullet after it
    said = lines(source, keys, "__t").where(F.col("line").rlike(r"^\s*[-*]\s+\S")).select(*keys, "n", F.struct("n", F.btrim(F.regexp_replace("line", r"^\s*[-*]\s+", "")).alias("text")).alias("b"))
    following = Window.partitionBy(*keys).orderBy("n").rowsBetween(0, most - 1)
    marked = said.select(*keys, "n", F.collect_list("b").over(following).alias("nexts")).unionByName(found.withColumnRenamed("start", "n"), allowMissingColumns=True)
    back = Window.partitionBy(*keys).orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rows = marked.withColumn("nexts", F.last("nexts", ignorenulls=True).over(back)).where("version is not null")
    own = F.filter("nexts", lambda x: F.col("until").isNull() | (x["n"] < F.col("until")))
    return rows.select(*keys, "version", "date", F.coalesce(F.transform(own, lambda x: x["text"]), F.array().cast("array<string>")).alias("changes"))


def model_rows(df: DataFrame, keys: list[str], column: str, family: str = "") -> DataFrame:
    """keys, id, kind, label, target, of the three layouts of model tables; the last row of an identity counts.

    A row `label | code` whose label begins with the family's name and a row
    "model id" with a code under every label of the table's first row are
    versioned models, a row `code | code` is an alias. A "model id" row that
    names fewer models than there are labels, or more, or has a cell that is no
    code, gives a row of kind `unrecognized` without id: models must not get lost
    because a table was not understood.
    """
    rows = tables(df, keys, column)
    head = rows.groupBy(*keys, "island").agg(F.min_by("cells", "n").alias("head"))
    rows = rows.join(head, [*keys, "island"]).where(F.size("cells") >= 2)
    cells, labels = F.col("cells"), F.expr("slice(head, 2, size(head))")
    ids = F.transform(F.expr("slice(cells, 2, size(cells))"), code_cell)
    named = F.lower(cells[0]) == "model id"
    whole = (F.size(labels) == F.size(ids)) & F.forall(labels, lambda x: x != "") & F.forall(ids, lambda x: x.isNotNull())
    entry = lambda kind, i, label, target: F.struct(F.lit(kind).alias("kind"), i.alias("id"), label.alias("label"), target.alias("target"))
    none = F.lit(None).cast("string")
    across = F.zip_with(ids, labels, lambda i, label: entry("versioned", i, label, none))
    first, second = code_cell(cells[0]), code_cell(cells[1])
    found = (
        F.when(named & whole, across)
        .when(named, F.array(entry("unrecognized", none, none, none)))
        .when(F.lower(cells[0]).startswith(family.lower()) & first.isNull() & second.isNotNull(), F.array(entry("versioned", second, cells[0], none)))
        .when(first.isNotNull() & second.isNotNull(), F.array(entry("alias", first, none, second)))
    )
    every = rows.select(*keys, "n", F.posexplode(found).alias("k", "m")).select(*keys, "n", "k", "m.*")
    return every.groupBy(*keys, "kind", "id").agg(F.max_by(F.struct("label", "target"), F.struct("n", "k")).alias("r")).select(*keys, "id", "kind", "r.label", "r.target")


def limitation_sections(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """keys, id, title, text_sha256, complete_sha256, reviewed, model: second- and third-level sections with two hashes of their text."""
    from ..functions.hashing import content_sha256

    heads = lines(df, keys, column).where(F.col("line").rlike(r"^#{2,3}\s+\S"))
    w = Window.partitionBy(*keys).orderBy("n")
    heads = heads.select(*keys, F.col("n").alias("start"), F.lead("n").over(w).alias("until"), F.btrim(F.regexp_replace("line", r"^#+\s+", "")).alias("title"))
    whole = df.select(*keys, F.split(F.col(column), "\n").alias("ls"), F.nullif(F.regexp_extract(F.col(column), r"(?m)Applies to\s+`?([A-Za-z0-9._-]+)`?", 1), F.lit("")).alias("model"), F.nullif(F.regexp_extract(F.col(column), r"(?m)Last reviewed:?\s+([0-9]{4}-[0-9]{2}-[0-9]{2})", 1), F.lit("")).alias("reviewed"))
    body = F.array_join(F.slice("ls", F.col("start") + 2, F.greatest(F.coalesce("until", F.size("ls")) - F.col("start") - 1, F.lit(0))), "\n")
    folded = T.fold_space(body)
    return heads.join(whole, keys).select(
        *keys,
        F.concat_ws(":", "model", T.slug(F.col("title"))).alias("id"),
        "title",
        "model",
        "reviewed",
        content_sha256(F.regexp_extract(folded, r"^(.*?[.!?])(?:\s|$)", 1)).alias("text_sha256"),
        content_sha256(folded).alias("complete_sha256"),
    )


def recipe_rows(df: DataFrame, keys: list[str], column: str, base: str) -> DataFrame:
    """keys, category, title, url, level, summary: three-column rows of an index, each under the latest ## heading above it."""
    every = filled(lines(df, keys, column), keys, "n", F.when(F.col("line").rlike(r"^## \S"), F.btrim(F.substring("line", 4, 10_000))), "category")
    cells = F.transform(F.split(F.regexp_replace(F.btrim("line"), r"^\||\|$", ""), r"\|"), lambda c: F.btrim(c))
    rows = every.where(F.col("line").rlike(r"^\s*\|")).withColumn("c", cells).where((F.size("c") == 3) & F.col("c")[0].rlike(r"^\[[^\]]+\]\([^)]+\)"))
    link = F.col("c")[0]
    return rows.select(*keys, "category", F.regexp_extract(link, r"^\[([^\]]+)\]", 1).alias("title"), urls.canonical(F.regexp_extract(link, r"\(([^)]+)\)", 1), base).alias("url"), F.col("c")[1].alias("level"), F.col("c")[2].alias("summary"))


def allowed(values: Column, expected: list[str]) -> Column:
    """Whether an array has exactly the expected members, order and repeats apart."""
    want = F.array(*[F.lit(x) for x in expected])
    return (F.size(F.array_except(values, want)) == 0) & (F.size(F.array_except(want, values)) == 0)
