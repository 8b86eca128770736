"""Items and options on nested pages of both sites, and whole records for each variant."""

from __future__ import annotations

from bazaarlens.constants import SITE_A_CLASSES as A
from bazaarlens.constants import SITE_B_CLASSES as B
from bazaarlens.functions import markup
from bazaarlens.operators import pages

PAGES = "category string, page_no int, url string, html string"


def items(css, *targets):
    """Items with markup in and around them; one without a link for each None."""
    cards = [f'<div><span><img src="x"></span><p>{"" if t is None else f"<b><a class=k href={chr(34)}{t}{chr(34)}><i>go</i></a></b>"}</p></div>' for t in targets]
    return "<html><ul><a href='/menu'>menu</a>" + "".join(f'<li class="z {css["item"]} y"><div>{c}</div></li>' for c in cards) + "</ul></html>"


def test_items_are_found_by_class_whatever_they_hold(spark):
    html = items(A, "/a?x=1&amp;y=2", None, "/b") + f'<!-- <li class="{A["item"]}"> --><script>"<li class={A["item"]}>"</script>'
    frame = spark.createDataFrame([("c", 1, "u", html), ("c", 2, "v", None), ("c", 3, "w", "<p>")], PAGES)
    assert [r.targets for r in pages.item_rows(frame, "a").orderBy("page_no").collect()] == [["/a?x=1&y=2", None, "/b"], [], []]


def test_site_a_skips_incomplete_pages_and_stops_at_a_repeated_one(spark):
    rows = [("c", 1, "u1", items(A, "/a", "/b")), ("c", 2, "u2", items(A, "/c", None)), ("c", 3, "u3", items(A, "/d")), ("c", 4, "u3", items(A, "/e")), ("c", 5, "u5", items(A, "/f"))]
    frame = spark.createDataFrame(rows, PAGES)
    found = [tuple(r) for r in pages.listing_urls_by_class(frame, "a").orderBy("page_no", "pos").collect()]
    assert found == [("c", 1, 0, "https://shopee.vn/a"), ("c", 1, 1, "https://shopee.vn/b"), ("c", 3, 0, "https://shopee.vn/d")]
    assert pages.listing_urls_by_class(frame, "a", page_count=1).count() == 2
    plan = pages.listing_urls_by_class(frame, "a")._jdf.queryExecution().toString()
    # Only what was found is shuffled.
    assert "html" not in plan


def test_site_b_stops_at_a_page_without_items(spark):
    rows = [("c", 1, "u1", items(B, "//x.vn/a", "//x.vn/b")), ("c", 2, "u2", "<p>nothing</p>"), ("c", 3, "u3", items(B, "//x.vn/c")), ("d", 9, "u4", items(B, "//x.vn/d"))]
    found = [tuple(r) for r in pages.listing_urls_by_class(spark.createDataFrame(rows, PAGES), "b").orderBy("category", "pos").collect()]
    assert found == [("c", 1, 0, "https://x.vn/a"), ("c", 1, 1, "https://x.vn/b"), ("d", 9, 0, "https://x.vn/d")]


def test_children():
    assert markup.children("a<b class='x y'>1<i>2</i></b>t<br><p>open<em>x</p><!-- <u> --><div>end<div>in</div>") == [
        ("b", "x y", "1<i>2</i>"), ("br", "", ""), ("p", "", "open<em>x"), ("div", "", "end<div>in</div>"),
    ]
    assert markup.children("") == [] and markup.children("</b>text") == []


def listing_a(strip=True, block=True):
    def group(name, *options, css=A["option_group"]):
        buttons = "".join(f'<button class="{A["option_value"]}{" " + A["option_selected"] if chosen else ""}">{text}</button>' for text, chosen in options)
        return f'<div class="{css}"><label class="{A["option_name"]}">{name}</label><div>{buttons}</div></div>'

    inside = "".join([
        group("M&agrave;u", ("&#272;en", False), ("Đỏ &amp; Xanh", False)), group("Size", ("M", True)), group("Cỡ", ("1", False), ("2", False)),
        group("Khác", ("x", False), ("y", False), css=A["option_group"] + " other"),
    ])
    return (
        group("Elsewhere", ("no", False), ("none", False))
        + f'<div class="{A["product_name"]}">&Aacute;o</div><div class="{A["price"]}">&#8363;9.000</div>'
        + (f'<div class="{A["rating_strip"]}"><div>4.9</div><div>1</div><div>x</div><div>3k</div><div>y</div><div>?</div></div>' if strip else "")
        + (f'<div class="{A["option_block"]}"><div>{inside}</div></div>' if block else "")
        + f'<div class="{A["product_desc"]}"><p>d</p></div>'
    )


def test_variants_of_site_a_are_whole_records(spark):
    rows = [("u1", listing_a()), ("u2", listing_a(strip=False)), ("u3", listing_a(block=False)), ("u4", None)]
    found = pages.site_a_variants(spark.createDataFrame(rows, "url string, html string")).orderBy("url", "variant_no").collect()
    assert [(r.url, r.variant_no) for r in found] == [("u1", 0), ("u1", 1), ("u1", 2), ("u1", 3), ("u3", 0)]
    chosen = [r.attrs for r in found]
    assert chosen == [
        {"Màu": "Đen", "Size": "M", "Cỡ": "1"}, {"Màu": "Đen", "Size": "M", "Cỡ": "2"}, {"Màu": "Đỏ & Xanh", "Size": "M", "Cỡ": "1"},
        {"Màu": "Đỏ & Xanh", "Size": "M", "Cỡ": "2"}, {},
    ]
    assert {(r.product_name, r.price, r.num_sold, r.product_desc) for r in found} == {("Áo", "₫9.000", "3k", "<p>d</p>")}


def test_variants_of_site_b_are_whole_records(spark):
    def group(name, body, options):
        return f'<div class="{B["option_group"]}"><h6>{name}</h6>{body}<div class="{B["option_values"]}">{options}</div></div>'

    html = (
        f'<h1 class="{B["product_name"]}">Giày</h1><a class="{B["brand_name"]}">B&amp;B</a><a class="{B["num_review"]}">12</a><b class="{B["price"]}">₫5</b>'
        + group("Màu", f'<i class="{B["option_value"]}">Đen</i>', "<span><img><em>Đen</em> <b>bóng</b></span><span>Trắng</span>")
        + group("Cỡ", f'<i class="{B["size_tab"]}">Int</i><i class="{B["size_value"]}">42</i>', "<p>42</p><p>43</p>")
    )
    found = pages.site_b_variants(spark.createDataFrame([("c", "u", html)], "category string, url string, html string")).orderBy("variant_no").collect()
    assert [r.attrs for r in found] == [{"Màu": m, "Cỡ": c} for m in ("Đen bóng", "Trắng") for c in ("42", "43")]
    assert {(r.product_name, r.brand_name, r.category, r.url) for r in found} == {("Giày", "B&B", "c", "u")}


def test_option_blocks_leave_the_batch_page_by_page(spark):
    """The scan takes Arrow values, not a column of all pages of a batch as Python strings; a missing page has no block."""
    from pyspark.util import PythonEvalType

    from bazaarlens.functions import markup

    made = [("<div class='b'><div><div class='g'>x</div></div></div>",), ("<p class='t'>y</p>",), (None,)]
    rows = spark.createDataFrame(made, "html string")
    cut = rows.select(markup.option_blocks(rows["html"], {"t": "t"}, "b", "g").alias("n"))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert f", {PythonEvalType.SQL_SCALAR_ARROW_UDF}" in plan
    assert [(r.n.t, r.n.groups) for r in cut.collect()] == [([], ["x"]), (["y"], None), ([], None)]
