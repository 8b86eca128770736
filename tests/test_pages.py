"""Landed pages: links, stopping rules, variants, records, progress."""

from __future__ import annotations

import random
import time
from itertools import product

import pytest
from pyspark.sql import functions as F

from bazaarlens.constants import SITE_A_CLASSES, SITE_B_CLASSES
from bazaarlens.functions import markup
from bazaarlens.operators import pages, progress

ITEM = r"(?s)<li[^>]*>.*?</li>"
LINK = r'<li[^>]*><a href="'


def page(*hrefs):
    return "<ul>" + "".join(f'<li><a href="{h}">x</a></li>' if h else "<li>x</li>" for h in hrefs) + "</ul>"


def table(spark, rows):
    return spark.createDataFrame(rows, "category string, page_no long, url string, html string")


def test_links_keep_repeats_and_show_items_without_one(spark):
    rows = table(spark, [("c", 1, "u", page("/a", None, "/a"))])
    assert [(r.pos, r.href) for r in pages.links(rows, ITEM).orderBy("pos").collect()] == [(0, "/a"), (1, None), (2, "/a")]


def test_incomplete_pages_give_no_urls(spark):
    rows = table(spark, [("c", 1, "u1", page("/a", "/b")), ("c", 2, "u2", page("/c", None))])
    found = pages.listing_urls(rows, "a", ITEM, LINK).collect()
    assert [r.url for r in found] == ["https://shopee.vn/a", "https://shopee.vn/b"]


def test_site_b_stops_at_an_empty_page(spark):
    rows = table(
        spark, [("c", 1, "u1", page("//h/a")), ("c", 2, "u2", "<p></p>"), ("c", 3, "u3", page("//h/b")), ("d", 9, "u", page("//h/c"))]
    )
    assert {r.url for r in pages.listing_urls(rows, "b", ITEM).collect()} == {"https://h/a", "https://h/c"}


def test_unknown_site(spark):
    with pytest.raises(ValueError, match="unknown site"):
        pages.listing_urls(table(spark, [("c", 1, "u", "")]), "z", ITEM)


def _walk(rows, count, block=None):
    """What a visitor going page by page would keep."""
    kept = {}
    for category in {r[0] for r in rows}:
        previous, mine = None, sorted(r for r in rows if r[0] == category)
        for n, row in enumerate(mine):
            if row[2] == previous or n == count:
                break
            previous = row[2]
            kept.setdefault(category, []).append(row[1])
    return kept


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_repeats_are_found_across_blocks(spark, block):
    rng = random.Random(block)
    rows = []
    for category, share in (("big", 300), ("mid", 40), ("one", 1)):
        numbers = sorted(rng.sample(range(1000), share))
        url = "start"
        for n in numbers:
            url = url if rng.random() < 0.01 and url != "start" else f"{category}{n}"
            rows.append((category, n, url, ""))
    found = pages.before_repeat(table(spark, rows), block)
    kept = {}
    for r in found.orderBy("page_no").collect():
        kept.setdefault(r.category, []).append(r.page_no)
    assert kept == _walk(rows, 10**6)


def test_stop_points_need_no_window(spark):
    rows = table(spark, [("c", i, f"u{i}", page("/a")) for i in range(3)]).hint("merge")
    plan = pages.before_empty(rows, ITEM)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("rule", [pages.first_pages, pages.before_repeat, lambda rows: pages.before_empty(rows, ITEM)])
def test_page_content_is_never_shuffled(spark, rule):
    """Not even where estimates are too large for a broadcast, as they are on large tables."""
    rows = [("big", i, f"u{i}", page("/a")) for i in range(300)] + [("small", 1, "u", page("/a"))]
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rule(table(spark, rows))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "BroadcastHashJoin" in plan and "Sort" not in plan and "Exchange hashpartitioning" not in plan


def test_pages_without_a_number_come_first(spark):
    rows = table(spark, [("c", None, "u0", page("/0")), ("c", 1, "u1", page("/1")), ("c", 2, "u1", ""), ("c", 3, "u3", page("/3")), (None, None, "n", page("/n"))])
    numbers = lambda df: sorted(((r.category, r.page_no) for r in df.collect()), key=str)
    expected = [("c", 1), ("c", None), (None, None)]
    assert numbers(pages.before_repeat(rows)) == numbers(pages.before_empty(rows, ITEM)) == expected
    for block in (1, 2, 1000):
        assert numbers(pages.first_pages(rows, 2, block)) == expected


def test_large_caps_agree_with_small_ones(spark):
    rng = random.Random(5)
    rows = table(spark, [(c, n, "u", "") for c in "ab" for n in rng.sample(range(9000), 3000)])
    for count in (1500, 2999, 5000):
        found = pages.first_pages(rows, count, block=700)
        expected = {
            (c, n)
            for c in "ab"
            for n in sorted(r.page_no for r in rows.where(F.col("category") == c).collect())[:count]
        }
        assert {(r.category, r.page_no) for r in found.collect()} == expected


GROUPS = "url string, groups array<struct<name:string,options:array<string>>>"


def test_variants_in_visiting_order(spark):
    rows = spark.createDataFrame(
        [
            ("two", [("màu", ["đen", "trắng"]), ("size", ["S", "M"])]),
            ("none", []),
            ("null", None),
            ("empty", [("màu", []), ("size", ["S"])]),
        ],
        GROUPS,
    )
    def shown(skip):
        found = pages.variants(rows, skip_empty_groups=skip).orderBy("url", "variant_no").collect()
        return [(r.url, r.attrs) for r in found]

    two = [("two", {"màu": m, "size": s}) for m, s in product(["đen", "trắng"], ["S", "M"])]
    assert shown(False) == [("none", {}), ("null", {}), *two]
    assert shown(True) == [("empty", {"size": "S"}), ("none", {}), ("null", {}), *two]


def test_variant_count_is_the_product_of_group_sizes(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        groups = [(f"g{g}", [f"o{o}" for o in range(rng.randint(0, 4))]) for g in range(rng.randint(0, 4))]
        rows.append((str(i), groups))
    found = pages.variants(spark.createDataFrame(rows, GROUPS)).collect()
    for url, groups in rows:
        expected = [dict(zip([g for g, _ in groups], choice)) for choice in product(*[o for _, o in groups])]
        mine = sorted((r.variant_no, r.attrs) for r in found if r.url == url)
        assert [attrs for _, attrs in mine] == expected


def test_variants_beyond_one_stretch(spark):
    groups = [(f"g{g}", [f"o{o}" for o in range(30)]) for g in range(3)]
    found = pages.variants(spark.createDataFrame([("u", groups)], GROUPS))
    assert found.select("variant_no").distinct().count() == found.select("attrs.g0", "attrs.g1", "attrs.g2").distinct().count() == 27_000


def test_last_of_equal_option_names_counts(spark):
    entries = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(v).alias("value")) for n, v in (("a", "1"), ("b", "2"), ("a", "3"))])
    assert spark.range(1).select(markup.attr_map(entries).alias("m")).first().m == {"a": "3", "b": "2"}


def test_rating_strip(spark):
    strips = ["4.9\n1,2k\nĐánh Giá\n3,4k\nĐã Bán\nx", "a\nb\nc\n7", "one", None]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(strips)], "i int, s string")
    found = rows.select("i", markup.rating_strip(F.col("s")).alias("r")).select("i", "r.*").orderBy("i").collect()
    assert [tuple(r)[1:] for r in found] == [("4.9", "1,2k", "3,4k"), (None, None, "7"), (None,) * 3, (None,) * 3]


def test_nodes_nest_and_survive_bad_markup():
    cut = markup.cut_nodes
    wanted = {"x": frozenset({"x"}), "xy": frozenset({"x", "y"})}
    assert cut('<div class="x">a<div class="y x">b</div>c</div>', wanted) == {
        "x": ['a<div class="y x">b</div>c', "b"], "xy": ["b"],
    }
    assert cut('<div class="x"><p>open<br>line</div><i class=x>end', wanted)["x"] == ["<p>open<br>line", "end"]
    assert cut("<!-- <b class='x'> --><script>'<b class=\"x\">'</script><b class='x' title='>'>ok</b>", wanted)["x"] == ["ok"]
    assert cut("", wanted) == {"x": [], "xy": []}


@pytest.mark.parametrize(
    "hostile",
    [
        "<!-- " * 200_000,
        "<script>" * 100_000,
        "<b>" * 100_000 + "</i>" * 100_000,
        "<a" * 300_000,
        "<a " * 300_000,
        "<a '\"" * 200_000,
        "<a" + "b" * 500_000,
        "</script" + " " * 500_000,
    ],
    ids=["comments", "scripts", "stray-ends", "names", "tags", "quotes", "long-name", "spaces"],
)
def test_scanner_takes_a_hostile_page_in_one_pass(hostile):
    """Work that grew with the square of these pages would take minutes."""
    start = time.process_time()
    found = markup.cut_nodes('<p class="x">ok</p>' + hostile, {"x": frozenset({"x"})})
    assert found["x"] == ["ok"]
    assert time.process_time() - start < 20


def test_visible_text(spark):
    html = "<div> a\n b <b>c</b></div><div>d &amp;lt; e</div><br>f"
    assert spark.createDataFrame([(html,)], "h string").select(markup.node_text(F.col("h"))).first()[0] == "a b c\nd &lt; e\nf"


def _site_a_page(name="Áo", price="₫9.000", options=True):
    css = SITE_A_CLASSES
    group = (
        f'<div class="{css["option_group"]}"><label class="{css["option_name"]}">Màu</label><div>'
        f'<button class="{css["option_value"]}">Đỏ</button>'
        f'<button class="{css["option_value"]} {css["option_selected"]}">Đen</button></div></div>'
        f'<div class="{css["option_group"]}"><label class="{css["option_name"]}">Size</label><div>'
        f'<button class="{css["option_value"]}">S</button></div></div>'
    )
    return (
        f'<main><div class="{css["product_name"]}"><div>Yêu Thích</div><span>{name}</span></div>'
        + (f'<div class="{css["price"]}">{price}</div>' if price else "")
        + f'<div class="{css["rating_strip"]}"><div>4.9</div><div>1,2k</div><div>Đánh Giá</div><div>3k</div><div>Đã Bán</div><div>?</div></div>'
        + f'<div class="{css["shipping_block"]}"><div>Vận Chuyển</div><div>₫15.000</div></div>'
        + (f'<div class="{css["option_block"]}"><div>{group}</div></div>' if options else "")
        + f'<div class="{css["product_desc"]}"><div>chi <b>tiết</b></div></div></main>'
    )


def test_site_a_records(spark):
    rows = [("u1", _site_a_page()), ("u2", _site_a_page(price=None)), ("u3", _site_a_page(options=False)), ("u4", None)]
    found = {r.url: r for r in pages.site_a_records(spark.createDataFrame(rows, "url string, html string")).collect()}
    assert set(found) == {"u1", "u3"}
    first = found["u1"]
    assert (first.product_name, first.price, first.shipping) == ("Yêu Thích\nÁo", "₫9.000", "₫15.000")
    assert (first.avg_rating, first.num_review, first.num_sold, first.shop_info) == ("4.9", "1,2k", "3k", None)
    assert first.attrs == {"Màu": "Đen", "Size": None}
    assert first.product_desc == "<div>chi <b>tiết</b></div>"
    assert found["u3"].attrs == {}


def test_site_b_records(spark):
    css = SITE_B_CLASSES

    def group(heading, body):
        return f'<div class="{css["option_group"]}"><h6 class="t">{heading}</h6>{body}</div>'

    tab = '<span class="{}"> {} </span><span class="{}">{}</span>'
    html = (
        f'<h1 class="{css["product_name"]}">Giày</h1><a class="x {css["brand_name"]}">Biti</a>'
        f'<a class="{css["num_review"]}">12</a><span class="{css["price"]}">₫5.000</span>'
        + group("Màu", f'<span class="{css["option_value"]}">Đen</span>')
        + group("Cỡ", tab.format(css["size_tab"], "Int", css["size_value"], "42"))
        + group("Cỡ EU", tab.format(css["size_tab"], "EU", css["size_value"], "43"))
        + f'<div class="{css["product_desc"]}"><p>x</p></div>'
    )
    rows = [("c", "u1", html), ("c", "u2", html.replace(css["brand_name"], "gone"))]
    (record,) = pages.site_b_records(spark.createDataFrame(rows, "category string, url string, html string")).collect()
    assert (record.product_name, record.brand_name, record.num_review, record.price) == ("Giày", "Biti", "12", "₫5.000")
    assert record.attrs == {"Màu": "Đen", "Cỡ": "42", "Cỡ EU": None}
    assert record.product_desc == f'<div class="{css["product_desc"]}"><p>x</p></div>'
    assert record.avg_rating is None and record.shop_info is None


def test_options_of_both_sites(spark):
    found = pages.site_a_options(spark.createDataFrame([("u", _site_a_page())], "url string, html string")).first()
    assert [(g.name, g.options) for g in found.groups] == [("Màu", ["Đỏ"]), ("Size", ["S"])]
    css = SITE_B_CLASSES
    html = (
        f'<div class="{css["option_group"]}"><h6>Màu</h6><div class="{css["option_values"]}">'
        '<span class="a"><i> Đen </i></span><span>Trắng</span><span></span></div></div>'
        f'<div class="{css["option_group"]}"><h6>Cỡ</h6><div class="{css["option_values"]}"></div></div>'
    )
    found = pages.site_b_options(spark.createDataFrame([("u", html)], "url string, html string")).first()
    assert [(g.name, g.options) for g in found.groups] == [("Màu", ["Đen", "Trắng"]), ("Cỡ", [])]


def test_pages_are_cut_once_even_when_filtered(spark):
    records = pages.site_a_records(spark.createDataFrame([("u", "")], "url string, html string"))
    plan = records.where(F.col("price").isNotNull())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_required_fields(spark):
    rows = spark.createDataFrame([("n", "p", "d"), ("n", None, "d")], "product_name string, price string, product_desc string")
    assert pages.required_only(rows, "a").count() == 1


URLS = [("a", i, f"a{i}") for i in range(6)] + [("b", i, f"b{i}") for i in range(3)]


def test_resume_redoes_the_url_at_the_cursor(spark):
    urls = spark.createDataFrame(URLS, "category string, pos int, url string")
    done = urls.where("category = 'a' AND pos <= 3")
    left = lambda df: sorted((r.category, r.pos) for r in df.collect())
    rest = [("a", 4), ("a", 5), ("b", 0), ("b", 1), ("b", 2)]
    assert left(progress.resume(urls, done)) == [("a", 3), *rest]
    assert left(progress.resume(urls, done, redo_last=False)) == rest
    assert left(progress.unseen(urls, done)) == rest
    assert left(progress.unfinished(urls, done)) == [("b", 0), ("b", 1), ("b", 2)]


def test_redone_records_are_told_by_url_and_options(spark):
    rows = [("u", {"a": "1"}), ("u", {"a": "1"}), ("u", {"a": None}), ("v", {"a": "1"})]
    records = spark.createDataFrame(rows, "url string, attrs map<string,string>")
    distinct = progress.distinct_records(records)
    assert distinct.count() == 3
    # Copies meet within their own task first, so a record copied very often does not gather in one.
    plan = distinct.select("url")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate(keys=[url") == 2


def test_variants_keep_chosen_groups_of_site_a(spark):
    html = _site_a_page()
    options = pages.site_a_options(spark.createDataFrame([("u", html)], "url string, html string"))
    assert options.first().chosen == {"Màu": "Đen", "Size": None}
    only = f'class="{SITE_A_CLASSES["option_value"]}">Đỏ'
    assert only in html
    options = pages.site_a_options(spark.createDataFrame([("u", html.replace(only, 'class="gone">Đỏ'))], "url string, html string"))
    (row,) = pages.variants(options, skip_empty_groups=True, chosen="chosen").collect()
    assert row.attrs == {"Màu": "Đen", "Size": "S"}


def test_site_b_values_stay_in_their_group(spark):
    css = SITE_B_CLASSES

    def group(heading, shown, values):
        listed = "" if values is None else f'<div class="{css["option_values"]}">{values}</div>'
        return f'<div class="{css["option_group"]}"><h6>{heading}</h6>{shown}{listed}</div>'

    name = f'<span class="{css["option_value"]}">'
    html = (
        group("Hãng", f"{name}Biti</span>", None)
        + group("Màu", f"{name}Đen</span>", "<i>Đen</i><i>Trắng</i>")
        + group("Cỡ", f'<b class="{css["size_tab"]}">EU</b>', "<i>42</i><i>43</i>")
    )
    options = pages.site_b_options(spark.createDataFrame([("u", html)], "url string, html string"))
    assert [(g.name, g.options) for g in options.first().groups] == [("Màu", ["Đen", "Trắng"]), ("Cỡ", [None, None])]
    found = pages.variants(options, chosen="chosen").orderBy("variant_no").collect()
    assert [r.attrs for r in found] == [{"Hãng": "Biti", "Màu": m, "Cỡ": None} for m in ("Đen", "Đen", "Trắng", "Trắng")]
