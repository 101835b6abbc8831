"""Deterministic reports: ordered text aggregated within bounded groups (a day, a category)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def joined_lines(rows: DataFrame, keys: list[str], order: list[str], line: Column, name: str = "report") -> DataFrame:
    """keys and name: the lines of a group in order, one under another."""
    parts = F.array_sort(F.collect_list(F.struct(*order, line.alias("__line"))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda x: x["__line"]), "\n").alias(name))


def daily_report(events: DataFrame, day: str = "date") -> DataFrame:
    """(day, report): a heading and one line for each event by id: category, entity, change and summary."""
    line = F.concat(F.lit("- **"), "category", F.lit("** `"), "entity", F.lit("` "), "change", F.lit(": "), F.coalesce("summary", F.lit("")))
    body = joined_lines(events, [day], ["id"], line, "body")
    return body.select(day, F.concat(F.lit("# Changes on "), F.col(day), F.lit("\n\n"), "body", F.lit("\n")).alias("report"))


def practices_report(practices: DataFrame) -> DataFrame:
    """One row, report: practices under their categories, both in order, with the latest verification on top."""
    line = F.concat(F.lit("- `"), "id", F.lit("` ("), "status", F.lit("): "), "summary")
    sections = joined_lines(practices, ["category"], ["id"], line, "body")
    latest = practices.agg(F.coalesce(F.max("last_verified"), F.lit("unknown")).alias("latest"))
    ordered = F.array_sort(F.collect_list(F.struct("category", F.concat(F.lit("## "), "category", F.lit("\n\n"), "body").alias("t"))))
    return sections.agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "\n\n").alias("t")).join(latest).select(F.concat(F.lit("Last verified: "), "latest", F.lit("\n\n"), F.coalesce("t", F.lit("")), F.lit("\n")).alias("report"))


def limitations_report(items: DataFrame) -> DataFrame:
    """(model, report) of limitations, those unknown marked so."""
    line = F.concat(F.lit("- "), "title", F.when(F.col("status") == "unknown", " (not found any more)").otherwise(""), F.lit(": "), F.coalesce("summary", F.lit("no reviewed summary")))
    return joined_lines(items, ["model"], ["id"], line)


def models_line(models: DataFrame) -> DataFrame:
    """One row, summary: versioned models by id, then aliases with their targets."""
    name = F.when(F.col("kind") == "alias", F.concat("id", F.lit(" -> "), "target")).otherwise(F.col("id"))
    parts = F.array_sort(F.collect_list(F.struct(F.col("kind") == "alias", "id", name.alias("t"))))
    return models.agg(F.array_join(F.transform(parts, lambda x: x["t"]), ", ").alias("summary"))


def category_counts(events: DataFrame, by: str = "category") -> DataFrame:
    return events.groupBy(by).agg(F.count("*").alias("events"))
