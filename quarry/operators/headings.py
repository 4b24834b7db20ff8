"""Links of a page under the headings that they stand below. Row-local expressions: one pass over each page's tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"


def visible_text(html: Column) -> Column:
    """The text between tags, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, "<[^>]*>", ""), r"\s+", " "))


def _section(section: Column, heading: str) -> Column:
    """What follows one opening heading tag: its category, and the parts that begin behind each link's <a."""
    parts = F.split(section, r"(?i)<a(?=\s)")
    category = visible_text(F.regexp_extract(section, rf"(?is)^(.*?)</{heading}\s*>", 1))
    return F.struct(category.alias("category"), F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))).alias("parts"))


def _slug(part: Column, prefix: str) -> Column:
    """The last part of a link's address; null if it is elsewhere or has no text."""
    href = F.regexp_extract(F.regexp_extract(part, "^([^>]*)>", 1), r"""(?i)(?:^|\s)href\s*=\s*["']([^"']*)["']""", 1)
    said = visible_text(F.regexp_extract(part, r"(?is)^[^>]*>(.*?)(?:</a\s*>|\z)", 1))
    return F.when(F.startswith(href, F.lit(prefix)) & (said != ""), F.regexp_extract(href, "([^/]*)/*$", 1))


def headed_links(pages: DataFrame, id_col: str, html_col: str, heading: str = "h2", prefix: str = "/tasks/") -> DataFrame:
    """(id, category, slug, position): links below a heading, each slug once in a page, where it is first seen.

    The category is the text of the last heading above; a link without heading, slug or text, or below a heading without
    text or end, is left out. The slug is the last part of the address. Position counts the links that qualify, from 1.
    Comments, scripts and styles are not read. Entities stay as they are written. A page that is null or empty has no
    rows; equal pages give equal rows; other columns are dropped. No shuffle and no Python: each page is cut at its
    headings and their links, sorted by slug and position, and compared with its neighbours, so long pages cost
    no more than their sort.
    """
    seen = F.split(F.regexp_replace(F.col(html_col), _HIDDEN, " "), rf"(?i)<{heading}(?=[\s>])[^>]*>")
    sections = F.slice(seen, F.lit(2), F.greatest(F.size(seen) - 1, F.lit(0)))
    # a section's category is read once, before its links are gone over
    headed = F.filter(F.transform(sections, lambda s: _section(s, heading)), lambda h: h["category"] != "")
    linked = F.transform(headed, lambda h: F.transform(h["parts"], lambda part: F.struct(_slug(part, prefix).alias("slug"), h["category"].alias("category"))))
    found = F.filter(F.flatten(linked), lambda x: x["slug"] != "")
    placed = F.array_sort(F.transform(found, lambda x, i: F.struct(x["slug"].alias("slug"), (i + 1).alias("position"), x["category"].alias("category"))))
    rows = pages.filter(F.col(html_col).isNotNull()).select(F.col(id_col).alias("id"), placed.alias("links")).filter(F.size("links") > 0)
    before = F.concat(F.array(F.lit(None).cast("string")), F.col("links.slug"))
    marked = F.zip_with("links", F.slice(before, F.lit(1), F.size("links")), lambda x, b: F.struct(x.alias("link"), (~x["slug"].eqNullSafe(b)).alias("first")))
    link = F.explode(F.filter(marked, lambda m: m["first"])["link"])
    return rows.select("id", link.alias("link")).select("id", "link.category", "link.slug", "link.position")


def first_seen(links: DataFrame) -> DataFrame:
    """(task, category): every slug of all pages with the category where it is first seen, by page and position.

    Only the least place of each slug goes from a task into the shuffle, so a slug on every page is no hot group.
    """
    least = links.groupBy("slug").agg(F.min(F.struct("id", "position", "category")).alias("at"))
    return least.select(F.replace("slug", F.lit("-"), F.lit(" ")).alias("task"), "at.category")
