"""Page fields over a table of pages (H1-H9) and the join of hits to them.

The reference fetched one store page per call and walked a parse tree; here
a table of pages is turned into field columns in one scan, one row at a
time, with no per-page round trip.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import html as H
from quarry.plans import sizing


@dataclass(frozen=True)
class Selectors:
    """Where each field lives on a page (parameters, defaults are the
    reference's store-page selectors — fixed values)."""
    meta_attr: str = "property"
    meta_value: str | None = "og:description"
    meta_take: str = "content"
    image_class: str | None = "highlight_screenshot_link"
    price_class: str = "game_purchase_price price"
    discount_class: str = "discount_final_price"
    review_class: str = "game_review_summary positive"
    tag_class: str = "glance_tags popular_tags"
    tag_browse_class: str | None = "tag_browse_tag"
    tag_browse_tag: str | None = None


def page_fields(pages: DataFrame, sel: Selectors = Selectors(), seed_col: str = "page_id") -> DataFrame:
    """(page_id, url, description, links, image, base_price, discount_price,
    review, tags)."""
    h = F.col("html")
    links = H.links_by_class(h, sel.image_class)
    base = H.text_by_class(h, sel.price_class, H.NO_PRICE)
    disc_found = H.text_by_class(h, sel.discount_class, "")
    disc = H.discount_price(base, F.nullif(disc_found, F.lit("")))
    return pages.select(
        "page_id", "url",
        H.meta_content(h, sel.meta_attr, sel.meta_value, sel.meta_take).alias("description"),
        links.alias("links"),
        H.pick_link(links, F.col(seed_col)).alias("image"),
        base.alias("base_price"),
        disc.alias("discount_price"),
        H.text_by_class(h, sel.review_class, H.NO_REVIEW, strip=False).alias("review"),
        H.page_tags(h, sel.tag_class).alias("tags"),
    )


def tag_catalogue(pages: DataFrame, sel: Selectors = Selectors()) -> DataFrame:
    """H9: (tag, n_pages) over all pages — explode, then a partial+final count."""
    tags = pages.select("page_id", F.explode(
        H.texts_by_class(F.col("html"), sel.tag_browse_class, sel.tag_browse_tag)).alias("tag"))
    return tags.groupBy("tag").agg(F.count(F.lit(1)).cast("long").alias("n"))


def enrich_hits(hits: DataFrame, fields: DataFrame, on_hits: str, on_fields: str) -> DataFrame:
    """Left join hits to page fields; a hit without a page keeps its row
    with the missing-value defaults.  The hits are counted: within the broadcast bound
    only the pages that a hit asks for reach the field extraction, and no page is shuffled."""
    found = sizing.measure(hits)
    hits, f = found.df, fields.withColumnRenamed(on_fields, "__fkey")
    if found.broadcast:
        f = f.join(F.broadcast(hits.select(F.col(on_hits).alias("__fkey")).distinct()), "__fkey", "left_semi")
    out = hits.join(f, hits[on_hits] == f["__fkey"], "left").drop("__fkey")
    return out.select(
        *hits.columns,
        F.coalesce("description", F.lit(H.NO_DESCRIPTION)).alias("description"),
        F.coalesce("image", F.lit(H.NO_IMAGE)).alias("image"),
        F.coalesce("base_price", F.lit(H.NO_PRICE)).alias("base_price"),
        F.coalesce("discount_price", F.lit(H.NO_DISCOUNT)).alias("discount_price"),
        F.coalesce("review", F.lit(H.NO_REVIEW)).alias("review"))
