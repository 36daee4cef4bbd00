"""Boilerplate lines, found by how many pages of their host have them.

A line counts once a page, however often it stands there. Its pages, divided by all pages of the
host, are its frequency; lines above the ratio go from all pages of that host. Lines are compared
without surrounding spaces; lines of spaces only are neither counted nor dropped.

Plan: pages give two 64-bit hashes for each different line, which are counted by host with partial
aggregates, so neither a hot host nor a line that all pages have meets in one task. A host has at
most `lines of a page on average / ratio` lines above the ratio, so they fit in one array a host.
These arrays, a row for each host with such lines, are written first; Spark then knows their size
when it plans the join with the pages. It broadcasts them while they are small, so that no text is
shuffled, and else shuffles and splits hot hosts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabvitals.llm.common import fresh, written

RATIO = 0.1
#: A host with two pages that share a line says nothing about its frequency.
MIN_PAGES = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _hash(line: Column) -> Column:
    return F.struct(
        F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line, F.lit(1)).alias("b")
    )


def _host(host: Column) -> Column:
    """A key that is never null: pages without a host are those of one host."""
    return F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit(""))


def boilerplate(
    pages: DataFrame, host: str, text: str, ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """For each host with such lines: host_key, bad (array of line hashes)."""
    keyed = pages.select(_host(F.col(f"`{host}`")).alias("host_key"), F.col(f"`{text}`").alias("t"))
    trimmed = F.array_distinct(F.transform(_lines(F.col("t")), F.trim))
    hashes = F.transform(F.filter(trimmed, lambda x: x != ""), _hash)
    counted = (
        keyed.select("host_key", F.explode(hashes).alias("line"))
        .groupBy("host_key", "line")
        .agg(F.count("*").alias("n_pages"))
        .filter(F.col("n_pages") >= min_pages)
    )
    totals = keyed.groupBy("host_key").agg(F.count("*").alias("n_host"))
    frequent = counted.join(totals, "host_key").filter(
        F.col("n_pages") > F.lit(float(ratio)) * F.col("n_host")
    )
    return frequent.groupBy("host_key").agg(F.collect_list("line").alias("bad"))


def _cut(
    pages: DataFrame, host: str, text: str, ratio: float, min_pages: int
) -> tuple[DataFrame, str]:
    """The pages with the lines that are left (null for a null text), and that column's name."""
    key, bad = fresh(pages, "host_key"), fresh(pages, "bad")
    lists = written(boilerplate(pages, host, text, ratio, min_pages), "boilerplate")
    lists = lists.select(F.col("host_key").alias(key), F.col("bad").alias(bad))
    joined = pages.withColumn(key, _host(F.col(f"`{host}`"))).join(lists, key, "left")
    lines = _lines(F.col(f"`{text}`"))
    left = fresh(joined, "left_lines")
    rest = F.filter(
        lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col(bad), _hash(F.trim(x)))
    )
    return joined.withColumn(left, F.when(F.col(bad).isNull(), lines).otherwise(rest)), left


def without_boilerplate(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    counts: bool = True,
) -> DataFrame:
    """The pages with the text that is left and, if wanted, the columns n_lines and n_dropped.

    A page keeps its row even if all its lines go; its text is then empty. A null text stays null
    and has no lines; an empty one has one blank line. Pages without a host are taken as those of
    one host, and repeated rows as pages of their own. A host with less than `min_pages` pages
    keeps all its lines. Other columns stay; counts take the place of columns of their names.
    """
    added = ["n_lines", "n_dropped"] if counts else []
    kept = [c for c in pages.columns if c.lower() not in added]
    cut, left = _cut(pages, host, text, ratio, min_pages)
    columns = [
        F.array_join(F.col(left), "\n").alias(c) if c == text else F.col(f"`{c}`") for c in kept
    ]
    n = F.when(F.col(left).isNull(), 0).otherwise(F.size(_lines(F.col(f"`{text}`"))))
    dropped = F.when(F.col(left).isNull(), 0).otherwise(n - F.size(F.col(left)))
    numbers = [n.cast("long").alias("n_lines"), dropped.cast("long").alias("n_dropped")]
    return cut.select(*columns, *(numbers if counts else []))
