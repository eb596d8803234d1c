"""Page field extraction on hand-made pages."""

from pyspark.sql import functions as F

from quarry.operators.pages import enrich_hits, page_fields, tag_catalogue

PAGE_FULL = (
    '<html><head><meta property="og:description" content="A fine game."></head><body>'
    '<a class="highlight_screenshot_link" href="img1.jpg">x</a>'
    '<a class="highlight_screenshot_link" href="img2.jpg">y</a>'
    '<div class="game_purchase_price price">\n\t\t$59.99\t</div>'
    '<div class="discount_final_price">$29.99</div>'
    '<span class="game_review_summary positive">Very Positive</span>'
    '<div class="glance_tags popular_tags">\t\tAction\t\t+\t</div>'
    '<div class="glance_tags popular_tags">\tRPG\t</div>'
    '<a class="tag_browse_tag">Indie</a><a class="tag_browse_tag">Action</a>'
    '</body></html>')
PAGE_FREE = (
    '<html><body><div class="game_purchase_price price">Free to Play</div>'
    '<div class="discount_final_price">$1.00</div></body></html>')
PAGE_EMPTY = "<html><body><p>nothing</p></body></html>"


def pages(spark):
    return spark.createDataFrame([(1, "u1", PAGE_FULL), (2, "u2", PAGE_FREE), (3, "u3", PAGE_EMPTY)],
                                 "page_id long, url string, html string")


def test_page_fields(spark):
    f = {r.page_id: r for r in page_fields(pages(spark)).collect()}
    assert f[1].description == "A fine game."
    assert f[1].links == ["img1.jpg", "img2.jpg"] and f[1].image in ("img1.jpg", "img2.jpg")
    assert f[1].base_price == "$59.99" and f[1].discount_price == "$29.99"
    assert f[1].review == "Very Positive"
    assert f[2].base_price == "Free to Play" and f[2].discount_price == "No Discount"
    assert f[3].description == "No description found" and f[3].image == "No image found"
    assert f[3].base_price == "Not found" and f[3].review == "not found" and f[3].links == []


def test_tags_split_on_tab(spark):
    f = {r.page_id: r.tags for r in page_fields(pages(spark)).collect()}
    # stripped texts "Action\t\t+" and "RPG" are concatenated to
    # "Action\t\t+RPG", split on TAB, and "" dropped
    assert f[1] == ["Action", "+RPG"]
    assert f[3] == []


def test_tag_catalogue(spark):
    got = {r.tag: r.n for r in tag_catalogue(pages(spark)).collect()}
    assert got == {"Indie": 1, "Action": 1}


def test_enrich_hits_keeps_missing(spark):
    hits = spark.createDataFrame([(1, 1, 10, 0.5, "u1"), (1, 2, 11, 0.4, "nope")],
                                 "query_id long, rank long, doc_id long, score double, url string")
    out = {r.rank: r for r in enrich_hits(hits, page_fields(pages(spark)), "url", "url").collect()}
    assert out[1].description == "A fine game."
    assert out[2].description == "No description found" and out[2].base_price == "Not found"


# Store markup as found in the wild: nested elements, tabs, several classes, attributes in any order.
PAGE_STORE = (
    '<head><meta content="Fish &amp; chips" property=\'og:description\'></head>'
    '<a href="s1.jpg" class="highlight_screenshot_link big">1</a><a class=\'highlight_screenshot_link\' href=s2.jpg>2</a>'
    '<div class="game_purchase_price price"><span>$59.99</span></div>'
    '<div class="discount_final_price your_price"><div class="label">Now</div> $9.99</div>'
    '<span class="game_review_summary positive"><b>Very</b> Positive</span>'
    '<div class="glance_tags popular_tags"><a class="app_tag">\t\tIndie\t\t</a><a class="app_tag">\t\tR&#38;B\t\t</a>'
    '<div>+</div></div><div class="glance_tags">no</div>'
    '<a class="tag_browse_tag x">Indie <i>games</i></a>')


def test_store_markup(spark):
    rows = spark.createDataFrame([(1, "u", PAGE_STORE), (2, "u", None), (3, "u", ""), (4, "u", '<meta property="og:description" content="">')],
                                 "page_id long, url string, html string")
    f = {r.page_id: r for r in page_fields(rows).collect()}
    assert f[1].description == "Fish & chips" and f[1].links == ["s1.jpg", "s2.jpg"]
    assert f[1].base_price == "$59.99" and f[1].discount_price == "Now $9.99" and f[1].review == "Very Positive"
    # stripped text "Indie\t\t\t\tR&B\t\t+" split on TAB, junk dropped
    assert f[1].tags == ["Indie", "R&B"]
    assert f[2].base_price == "Not found" and f[3].tags == [] and f[4].description == ""
    assert [tuple(r) for r in tag_catalogue(rows).collect()] == [("Indie games", 1)]


def test_nested_same_name(spark):
    """An element ends at its own end tag; a void element has no text; what is left open ends with the page."""
    from quarry.functions import html as H
    page = '<div class="a">x<div>y</div>z</div>t<img class="a" src="i"><p class="a">open &lt;b&gt; &#x20AC;&#8364;'
    row = spark.createDataFrame([(page,)], "html string").select(H.texts_by_class(F.col("html"), "a").alias("t")).first()
    assert row.t == ["xyz", "", "open <b> €€"]
