"""Pages (url, html) -> parsed rows, link edges and link counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import html as H
from linkloom.functions import urls as U


def _pieces(pages: DataFrame, keep: list[str], *tags: str, text: bool = False) -> DataFrame:
    return pages.select(*keep, H.pieces(F.col("html"), *tags, text=text).alias("_pieces"))


def parse(pages: DataFrame, keep: list[str], base: bool = False) -> DataFrame:
    """The full parsed-page row; a NULL or empty html gives an empty page. With ``base`` also the
    target of its base tag, against which its links are to be resolved."""
    tags = ("a", "meta", "base") if base else ("a", "meta")
    found = _pieces(pages, keep, *tags, text=True).withColumn("_body", H.body_span(F.col("_pieces")))
    p = F.col("_pieces")
    pieces = found.select(
        *keep,
        H.hrefs(p).alias("links"),
        H.metas(p).alias("_metas"),
        H.body_text(p, F.col("_body")).alias("body_text"),
        *([H.base_href(p).alias("base")] if base else []),
    )
    m = F.col("_metas")
    return pieces.select(
        *keep,
        H.meta_content(m, "title").alias("title"),
        H.meta_content(m, "author").alias("author"),
        "links",
        H.meta_charset(m).alias("charset"),
        H.meta_keywords(m).alias("keywords"),
        H.meta_content(m, "description").alias("description"),
        "body_text",
        *(["base"] if base else []),
    )


def with_links(pages: DataFrame, keep: list[str]) -> DataFrame:
    """Only the links of each page, as an array."""
    return _pieces(pages, keep, "a").select(*keep, H.hrefs(F.col("_pieces")).alias("links"))


def absolute_links(pages: DataFrame, keep: list[str], rule: str | None = None) -> DataFrame:
    """One row per link (keep..., pos, dst), resolved against the page's base tag and ``url``, which
    has to be one of ``keep``; with a pruning rule only those that satisfy it then."""
    found = _pieces(pages, keep, "a", "base").select(
        *keep, H.hrefs(F.col("_pieces")).alias("_links"), U.base_of(F.col("url"), H.base_href(F.col("_pieces"))).alias("_base")
    )
    absolute = found.select(*keep, U.resolve_all(F.col("_links"), F.col("_base")).alias("_links"))
    kept = F.col("_links") if rule is None else U.prune(F.col("_links"), rule)
    return _exploded(absolute, keep, kept, "dst")


def links(pages: DataFrame, keep: list[str], rule: str | None = None) -> DataFrame:
    """One row per link (keep..., pos, href) in document order.

    With a pruning rule, ``pos`` counts the links that are kept.
    """
    found = with_links(pages, keep)
    kept = F.col("links") if rule is None else U.prune(F.col("links"), rule)
    return _exploded(found, keep, kept, "href")


def keywords(pages: DataFrame, keep: list[str]) -> DataFrame:
    """One row per keyword (keep..., pos, keyword)."""
    tagged = _pieces(pages, keep, "meta").select(*keep, H.metas(F.col("_pieces")).alias("_metas"))
    return _exploded(tagged, keep, H.meta_keywords(F.col("_metas")), "keyword")


def _exploded(rows: DataFrame, keep: list[str], items: Column, name: str) -> DataFrame:
    """One row per array element.

    An inner explode makes the optimizer test the array for emptiness first, which
    would run the regular expressions of ``items`` a second time; the outer form
    does not, and its rows for empty arrays are dropped.
    """
    return rows.select(*keep, F.posexplode_outer(items).alias("pos", name)).where("pos is not null")


def link_counts(pages: DataFrame, keep: list[str], rule: str = "http") -> DataFrame:
    """Anchors, anchors with and without target, and links left after pruning."""
    counted = _pieces(pages, keep, "a").select(
        *keep,
        H.anchor_count(F.col("_pieces")).cast("long").alias("n_anchors"),
        H.hrefs(F.col("_pieces")).alias("_links"),
    )
    n_links = F.size("_links").cast("long")
    return counted.select(
        *keep,
        "n_anchors",
        n_links.alias("n_links"),
        (F.col("n_anchors") - n_links).alias("n_without_href"),
        F.size(U.prune(F.col("_links"), rule)).cast("long").alias("n_pruned"),
    )


def link_total(links_mode: str = "raw") -> Column:
    """Which link count feeds the statistics: ``raw`` or ``pruned`` links."""
    return F.col({"raw": "n_links", "pruned": "n_pruned"}[links_mode])
