"""Link catalogue: which files the pages offer for each category and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions import html


def page_links(pages: DataFrame, keys: list[str], markup: str = "html") -> DataFrame:
    """One row per anchor with an ``href``: the page's keys, pos (document order), href, text."""
    found = pages.select(*keys, F.posexplode(html.anchors(F.col(markup))).alias("pos", "anchor"))
    return found.filter(html.has_href(F.col("anchor"))).select(
        *keys,
        F.col("pos").cast("bigint").alias("pos"),
        html.href(F.col("anchor")).alias("href"),
        html.anchor_text(F.col("anchor")).alias("text"),
    )


def _names(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def category_links(links: DataFrame, categories: list[str], periods: list[str], exact: bool = False) -> DataFrame:
    """Links whose text names a category and whose href contains a period.

    A text matches ignoring case if it contains the category, so a short category also matches
    inside a longer one; ``exact`` asks for the whole text instead. Both lists are configuration:
    each link is expanded by its own matches, without a join.
    """

    text = F.col("lower_text")

    def named(category: Column) -> Column:
        return text == F.lower(category) if exact else F.contains(text, F.lower(category))

    dated = links.withColumn("period", F.explode(F.filter(_names(periods), lambda p: F.contains(F.col("href"), p))))
    lowered = dated.withColumn("lower_text", F.lower("text"))
    return lowered.withColumn("category", F.explode(F.filter(_names(categories), named))).drop("lower_text")


def first_links(matched: DataFrame, keys: list[str]) -> DataFrame:
    """First link in document order per page, category and period."""
    return matched.groupBy(*keys, "category", "period").agg(F.min_by("href", "pos").alias("href"))


def missing_links(pages: DataFrame, first: DataFrame, keys: list[str], categories: list[str], periods: list[str]) -> DataFrame:
    """Categories and periods for which a page has no link: what a run cannot load.

    The expected rows are generated within each page's row.
    """
    expected = pages.select(*keys, F.explode(_names(categories)).alias("category"))
    expected = expected.withColumn("period", F.explode(_names(periods)))
    return expected.join(first.select(*keys, "category", "period"), [*keys, "category", "period"], "left_anti")


def missing_categories(pages: DataFrame, categories: list[str], markup: str = "html") -> DataFrame:
    """Categories that no page names.

    The pages are reduced to the names found in them, so the anti-join compares two lists no longer
    than the configuration.
    """
    wanted = pages.sparkSession.createDataFrame([(c,) for c in categories], "category string")
    text = pages.select(F.lower(html.text_pieces(F.col(markup))).alias("text"))
    found = text.select(
        F.explode(F.filter(_names(categories), lambda c: F.contains(F.col("text"), F.lower(c)))).alias("category")
    ).distinct()
    return wanted.join(found, "category", "left_anti")


def missing_by_page(pages: DataFrame, keys: list[str], categories: list[str], markup: str = "html") -> DataFrame:
    """Categories that a page does not name, page by page; needs no shuffle."""
    text = pages.select(*keys, F.lower(html.text_pieces(F.col(markup))).alias("text"))
    return text.select(
        *keys, F.explode(F.filter(_names(categories), lambda c: ~F.contains(F.col("text"), F.lower(c)))).alias("category")
    )
