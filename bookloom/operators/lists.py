"""Lists for people: Czech order with numbers by value, a heading where the author changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Digits to which numbers are filled up, so that they sort by value.
DIGITS = 12


def czech_key(text: Column) -> Column:
    """A text that sorts as Czech readers expect: marks and case count last, numbers by value."""
    parts = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\d+|\D+"), F.lit(0))
    padded = F.transform(parts, lambda p: F.when(p.rlike(r"^\d") & (F.length(p) < DIGITS), F.lpad(p, DIGITS, "0")).otherwise(p))
    return F.collate(F.array_join(padded, ""), "cs_CI_AI")


def book_list(rows: DataFrame) -> DataFrame:
    """(corpus, place, line): of each corpus its books by author and title in lines, an author's name before the first of each.

    ``rows``: corpus, id, author, title, reason; a reason stands behind the title
    in brackets.
    """
    order = [czech_key(F.col("author")), czech_key(F.col("title")), F.col("id")]
    by = Window.partitionBy("corpus").orderBy(*order)
    title = F.concat(F.lit("  - "), F.coalesce("title", F.lit("")), F.when(F.coalesce("reason", F.lit("")) != "", F.concat(F.lit(" ["), "reason", F.lit("]"))).otherwise(""))
    author = F.coalesce("author", F.lit(""))
    placed = rows.withColumns({"_n": F.row_number().over(by), "_new": ~author.eqNullSafe(F.lag(author).over(by))})
    lines = placed.select("corpus", "_n", F.explode(F.when(F.col("_new"), F.array(F.struct(F.lit(0).alias("k"), author.alias("line")), F.struct(F.lit(1).alias("k"), title.alias("line")))).otherwise(F.array(F.struct(F.lit(1).alias("k"), title.alias("line"))))).alias("l"))
    return lines.select("corpus", (F.col("_n") * 2 + F.col("l.k")).alias("place"), "l.line")


def written_list(lines: DataFrame) -> DataFrame:
    """(corpus, text): the lines of :func:`book_list` as one text for each corpus, a blank line before each author but the first."""
    listed = F.array_sort(F.collect_list(F.struct("place", "line")))
    spaced = F.transform(listed, lambda x: F.when((x["place"] % 2 == 0) & (x["place"] > 2), F.concat(F.lit("\n"), x["line"])).otherwise(x["line"]))
    return lines.groupBy("corpus").agg(F.concat(F.array_join(spaced, "\n"), F.lit("\n")).alias("text"))


def read_list(lists: DataFrame) -> DataFrame:
    """(corpus, author, title): the books of lists (corpus, text) as :func:`written_list` writes them, each once.

    A title belongs to the last author before it; reasons in brackets are dropped.
    """
    rows = lists.select("corpus", F.posexplode(F.split("text", r"\r?\n")).alias("n", "line"))
    title = F.regexp_extract("line", r"^  - (.+?)(?: \[[^\]]+\])?$", 1)
    head = F.when((F.col("line") != "") & ~F.col("line").rlike(r"^\s"), F.trim("line"))
    # one list is a text of one row, so its lines are one task's work
    before = Window.partitionBy("corpus").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    named = rows.withColumns({"author": F.last(head, ignorenulls=True).over(before), "title": title})
    return named.where("title <> '' AND author IS NOT NULL").select("corpus", "author", "title").distinct()
