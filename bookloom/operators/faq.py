"""Multilingual question trees as rows: (path, row, question, answer lines) by language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def align(base: DataFrame, other: DataFrame, key: list[str], names: tuple[str, str]) -> DataFrame:
    """Two languages side by side by their place in the tree; what one lacks is null."""
    a = base.select(*key, F.col("text").alias(names[0]))
    b = other.select(*key, F.col("text").alias(names[1]))
    return a.join(b, key, "full")


def violations(aligned: DataFrame, key: list[str], names: tuple[str, ...]) -> DataFrame:
    """key, problem: missing or empty texts, and answers whose numbers of lines differ."""
    missing = F.exists(F.array(*[F.coalesce(F.trim(n), F.lit("")) for n in names]), lambda x: x == "")
    lines = F.array_distinct(F.array(*[F.size(F.split(F.coalesce(n, F.lit("")), "\n")) for n in names]))
    problem = F.when(missing, "missing").when(F.size(lines) > 1, "lines differ")
    return aligned.select(*key, problem.alias("problem")).where("problem is not null")


def render(question: Column, answer: Column, macros: dict[str, str], rules: list[tuple[str, str]], template: str = "<h2>#QUESTION#</h2>%1") -> Column:
    """An entry as HTML: macros, then the ordered tag rules, then the template."""
    for name, value in macros.items():
        answer = F.replace(answer, F.lit(name), F.lit(value))
    for pattern, replacement in rules:
        answer = F.regexp_replace(answer, pattern, replacement)
    return F.replace(F.replace(F.lit(template), F.lit("#QUESTION#"), question), F.lit("%1"), answer)


def renumbered(rows: DataFrame, parent: str, order: list[str]) -> DataFrame:
    """Siblings numbered from 0 in the order given, as after inserting, moving or removing rows."""
    from pyspark.sql import Window

    return rows.withColumn("row", F.row_number().over(Window.partitionBy(parent).orderBy(*order)) - 1)
