"""Golden rows of names, numbers, descriptions and shop panels."""

from __future__ import annotations

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bazaarlens.constants import VIETNAMESE_LETTERS
from bazaarlens.functions import numbers, shop, text
from bazaarlens.operators import cleaning


def apply(spark, values, *expressions):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    found = rows.select("i", *[e(F.col("v")).alias(f"e{n}") for n, e in enumerate(expressions)]).orderBy("i").collect()
    return [row[1] if len(expressions) == 1 else tuple(row[1:]) for row in found]


def test_product_name(spark):
    cases = {
        "Yêu Thích+\n[SALE 50%] Áo Thun NAM!!! 100% cotton": "áo thun nam 100 cotton",
        "Yêu Thích\nGiày_da (đen)": "giày_da đen",
        "[A] x [B] y": "x y",
        "a [b": "a b",
        "": "",
        None: None,
    }
    assert apply(spark, cases, text.product_name) == list(cases.values())


def test_every_vietnamese_letter_is_kept(spark):
    import unicodedata

    vowels = "aăâeêioôơuưy"
    tones = ["", "̀", "́", "̃", "̉", "̣"]
    composed = {unicodedata.normalize("NFC", v + t) for v in vowels for t in tones} | {"đ"}
    assert set(VIETNAMESE_LETTERS) == {c for c in composed if not c.isascii()}
    both = VIETNAMESE_LETTERS + VIETNAMESE_LETTERS.upper()
    assert apply(spark, [both, "naïve"], text.blank_special) == [both, "na ve"]
    assert apply(spark, ["naïve"], lambda c: text.blank_special(c, "ï")) == ["naïve"]


def test_counts(spark):
    cases = {
        "3,2k": 3200, "3k": 3000, "12": 12, "1,5": 15, "3,25k": 32500, "3.2k": 3, " 7 ": 7,
        "": None, "1tr": None, "2K": None, "99999999999": None, None: None,
    }
    assert apply(spark, cases, numbers.k_int) == list(cases.values())
    strict = {"3,25k": 3250, "3,2k": 3200, "3k": 3000, "12": 12, "": None, None: None}
    assert apply(spark, strict, lambda c: numbers.k_int(c, strict=True)) == list(strict.values())


def test_int_drops_decimals_whatever_their_length(spark):
    cases = {"3.99999999": 3, "-4.5": -4, "+5": 5, "1e3": None, "5.": 5, "1 2": None}
    assert apply(spark, cases, numbers.to_int) == list(cases.values())


def test_price(spark):
    cases = {
        "₫100.000": "100000",
        "₫1.200.000": "1200000",
        "₫100.000 - ₫200.000": "200000",
        "100.000 ₫": "",
        None: None,
    }
    assert apply(spark, cases, numbers.price_text) == list(cases.values())


def test_shipping(spark):
    cases = {
        "₫15.000": "15000",
        "₫15.000 - ₫30.000": "15000",
        "₫0": "0",
        "Miễn phí vận chuyển": "",
        None: None,
    }
    assert apply(spark, cases, text.shipping_fee) == list(cases.values())


def test_label_and_its_inverse(spark):
    rows = spark.createDataFrame([(100.0,), (0.0,), (-1.0,), (None,)], "p double")
    label = numbers.log_price(F.col("p"))
    found = rows.select(label.alias("l"), numbers.price_from_log(label).alias("p")).collect()
    assert [tuple(r) for r in found] == [(2.0, 100.0), (None, None), (None, None), (None, None)]


PANELS = {
    "Yêu Thích+\nCoolmate Official\nOnline 5 phút trước\nĐánh Giá\n12,3k\nTỉ Lệ Phản Hồi\n95%\nTham Gia\n3 năm trước\n"
    "Sản Phẩm\n120\nThời Gian Phản Hồi\ntrong vài giờ\nNgười Theo Dõi\n456,7k": (
        "Coolmate Official", 2, 12300, 0.95, "trong vài giờ", 36, 456700,
    ),
    "Yêu Thích\nABC\nTham Gia\n8 tháng trước\nNgười Theo Dõi\n37": ("ABC", 1, None, None, "", 8, 37),
    "Shop B\nĐánh Giá\n5\nTham Gia\n20 ngày trước\n": ("Shop B", 0, 5, None, "", 0, None),
    "": ("", 0, None, None, "", 0, None),
    None: (None, 0, None, None, None, 0, None),
}


def test_shop_panel(spark):
    found = apply(
        spark,
        PANELS,
        shop.shop_name,
        shop.like_tier,
        shop.review_count,
        shop.reply_rate,
        shop.reply_time,
        shop.age_months,
        shop.follower_count,
    )
    for row, expected in zip(found, PANELS.values(), strict=True):
        assert row[:3] + row[4:] == expected[:3] + expected[4:]
        assert row[3] == (None if expected[3] is None else pytest.approx(expected[3], abs=1e-8))


def test_age_without_number_is_unknown(spark):
    assert apply(spark, ["X\nTham Gia\nvài tháng trước\n"], shop.age_months) == [None]


def test_reply_rate_keeps_the_digits_of_a_float(spark):
    (rate,) = apply(spark, ["X\nTỉ Lệ Phản Hồi\n33.3%\n"], shop.reply_rate)
    assert rate == pytest.approx(0.33299999237, abs=1e-11) and rate != 0.333


def test_attrs_from_map_and_from_text(spark):
    rows = spark.createDataFrame(
        [({"Màu Sắc": "Đen", "Size": None},), ({},)], "attrs map<string,string>"
    )
    assert [r.attrs for r in cleaning.clean_attrs(rows).select("attrs").collect()] == ["màu sắc đen size null", ""]
    as_text = spark.createDataFrame([('{"Màu Sắc": "Đen", "Size": null}',)], "attrs string")
    assert cleaning.clean_attrs(as_text).first().attrs == "màu sắc   đen   size  null"


MARKUP = (
    '<div class="p"><div class="r"><label class="l">Danh Mục</label><div class="f"><a class="k" href="/x">Shopee</a>'
    '<svg class="i"><path d="M1"/></svg><a class="k" href="/y">Thời Trang Nam</a><a class="k" href="/z">Áo</a></div></div>'
    '<div class="r"><label class="l">Thương Hiệu</label><a class="k" href="/b">Coolmate</a></div>'
    '<div class="r"><label class="l">Xuất Xứ</label><div>Việt Nam</div></div>'
    '<div class="r"><label class="l">Kho hàng</label><div>1,2k</div></div>'
    '<div class="r"><label class="l">Gửi từ</label><div>Hà Nội</div></div>'
    '<div class="t">Mô Tả Sản Phẩm</div><div><p class="d">Áo đẹp, 100% cotton</p></div></div>'
)
FLAT = (
    "danh mục: shopee-thời trang nam-áo-//thương hiệu: coolmate-/xuất xứ: việt nam//kho hàng: 1,2k//"
    "gửi từ: hà nội//mô tả sản phẩm/áo đẹp, 100% cotton///"
)


def test_markup_flattens(spark):
    assert apply(spark, [MARKUP, "", None], text.flatten_markup) == [FLAT, "", None]


def test_markup_of_any_kind_flattens_as_the_plain_alternatives_do(spark):
    import random

    rng = random.Random(11)
    parts = ["<svg x>", "</svg>", "<div>", "<div ", "div", "class=", '"', "<label a>", "<flex>", " href=/", "</div>", ">",
             "<", "/", " ", "  ", "a", "Đ", "</a>", "</label>", "<a ", "<p ", " &amp;", "\n", "-"]
    values = ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(3000)]
    steps = [
        (" &amp;", ","), ('<svg.*?</svg>|<div>|div|class=|"|<label.*?>|<flex.*?>| href=/', ""), ("</a>", "-"),
        ("</label>", ": "), ("< ", "<"), ("/.*?>", "/>"), ("<a ", "<"), ("<p ", "<"), (" +", " "), ("</>", "/"),
        ("<.*?>", ""),
    ]

    def plain(value):
        value = value.lower()
        for pattern, replacement in steps:
            value = re.sub(pattern, replacement, value)
        return value

    assert apply(spark, values, text.flatten_markup) == [plain(v) for v in values]


def test_extracted_attributes(spark):
    flat = spark.createDataFrame([(FLAT,), (None,), ("không có gì",)], "product_desc string")
    for step in (
        cleaning.extract_country,
        cleaning.extract_brand,
        cleaning.extract_origin,
        cleaning.extract_stock,
        cleaning.extract_first_category,
        cleaning.extract_second_category,
        cleaning.extract_third_category,
        cleaning.extract_smaller_desc,
    ):
        flat = step(flat)
    found, missing, unmatched = flat.drop("product_desc").collect()
    assert tuple(found) == (
        "việt nam", "coolmate", "hà nội", "1 2k", "thời trang nam", "thời trang nam / áo", "no", " áo đẹp  100  cotton ",
    )
    assert tuple(missing) == (None, None, None, None, None, "no", "no", None)
    assert tuple(unmatched) == ("", "", "", "", "", "no", "no", "")


def test_marker_only_cuts_its_own_line(spark):
    flat = "xuất xứ: a/mô tả sản phẩm/x gửi từ: b/\ngửi từ: c/"
    assert apply(spark, [flat], lambda c: text.origin(text.before_marker(c))) == ["c"]


def test_slash_in_a_category_cuts_the_breadcrumb_unless_fixed(spark):
    crumb = (
        '<div class="f"><a class="k" href="/x">Shopee</a><a class="k" href="/y">Thời Trang Nam</a>'
        '<a class="k" href="/z">Vớ/ Tất</a></div></div>'
    )
    level = lambda fixed: lambda c: text.category_path(text.flatten_markup(c, fixed), 2)
    assert apply(spark, [crumb], level(False)) == ["no"]
    assert apply(spark, [crumb], level(True)) == ["thời trang nam / vớ, tất"]


def test_single_steps_agree_with_the_full_clean(spark, sf):
    from bazaarlens.plans import bridge

    raw = bridge.raw_listings(spark, sf).cache()
    whole = cleaning.clean_listings(raw)
    flat = cleaning.clean_desc(raw)
    for step in (
        cleaning.clean_product_name, cleaning.clean_price, cleaning.clean_shipping, cleaning.clean_attrs,
        cleaning.extract_country, cleaning.extract_brand, cleaning.extract_stock, cleaning.extract_origin,
        cleaning.extract_first_category, cleaning.extract_second_category, cleaning.extract_third_category,
        cleaning.extract_smaller_desc, cleaning.extract_shop_name, cleaning.extract_shop_like_tier,
        cleaning.extract_shop_num_review, cleaning.extract_shop_reply_percentage, cleaning.extract_shop_reply_time,
        cleaning.extract_shop_creation_time, cleaning.extract_shop_num_follower,
        lambda df: cleaning.clean_numeric_field(df, "num_review"),
        lambda df: cleaning.clean_numeric_field(df, "num_sold"),
    ):
        flat = step(flat)
    columns = whole.columns
    assert flat.select(columns).exceptAll(whole).count() == 0
    assert whole.exceptAll(flat.select(columns)).count() == 0
    raw.unpersist()


def test_full_clean_flattens_once_and_needs_no_shuffle(spark):
    columns = "product_name string, shipping string, shop_info string, price string, product_desc string, " \
        "avg_rating string, num_review string, num_sold string, attrs map<string,string>, url string"
    raw = spark.createDataFrame([], columns)
    plan = cleaning.clean_listings(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("svg.*?</svg>") == 1
    assert "Exchange" not in cleaning.clean_listings(raw)._jdf.queryExecution().executedPlan().toString()


def test_site_b_keeps_its_own_category_and_brand(spark):
    from bazaarlens.schemas import LISTING_B

    row = ("Áo [Hot] Mới", None, "₫99.000", "No-Brand", "1,2k", {"Màu": "Đỏ"}, None, "4.5", "áo nam", "https://x/1")
    cleaned = cleaning.clean_listings(spark.createDataFrame([row], LISTING_B))
    found = cleaned.first()
    assert (found.product_name, found.price, found.brand, found.category, found.num_review) == (
        "áo mới", "99000", "no brand", "áo nam", 1200,
    )
    model = cleaning.model_table(cleaned).first()
    assert model.first_category == "áo nam" and model.num_sold is None and model.price == 99000.0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=30), min_size=20, max_size=60))
def test_names_do_not_change_when_cleaned_twice(spark, values):
    values = [v for v in values if "\x00" not in v and not any(0xD800 <= ord(c) < 0xE000 for c in v)]
    once = apply(spark, values, text.product_name) if values else []
    assert (apply(spark, once, text.product_name) if once else []) == once
    assert all(name == name.strip(" ") and "  " not in name for name in once)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 999_999), min_size=1, max_size=80))
def test_short_counts_come_back(spark, values):
    from bazaarlens.plans.bridge import short_count

    rows = spark.createDataFrame([(v,) for v in values], "n long")
    found = rows.select("n", numbers.k_int(short_count(F.col("n"))).alias("k")).collect()
    assert all(r.k == (r.n if r.n < 1000 else r.n // 100 * 100) for r in found)


def test_fast_patterns_match_as_the_plain_ones(spark):
    """Every character, and markup cut in all odd ways, against the patterns as they read."""
    from bazaarlens.constants import VIETNAMESE_LETTERS
    from bazaarlens.functions import text

    for extra in ("", "éß中"):
        letters = set(VIETNAMESE_LETTERS + VIETNAMESE_LETTERS.upper() + extra)
        plain = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_ ")
        points = [n for n in range(1, 0x1F700) if not 0xD800 <= n < 0xE000]
        rows = spark.createDataFrame([(n, chr(n)) for n in points], "n int, c string")
        blanked = rows.select("n", text.blank_special(F.concat(F.lit("a"), "c", "c", F.lit("b")), extra).alias("r")).collect()
        kept = letters | plain
        assert all(r.r == (f"a{chr(r.n) * 2}b" if chr(r.n) in kept else "a b") for r in blanked)

    steps = {
        0: '<svg.*?</svg>|<div>|div|class=|"|<label.*?>|<flex.*?>| href=/', 1: r"/.*?>", 2: " +", 3: r"<.*?>",
    }
    fast = [what for kind, what, _ in text.MARKUP_STEPS if kind == "pattern"]
    rng = random.Random(4)
    parts = ["<svg", "</svg>", "<div>", "div", "class=", '"', "<label", "<flex", " href=/", ">", "<", "/", " ", "  ", "\n", "\r",
             "\u0085", "\u2028", "\u2029", "x", "\t", "ơ", "😀"]
    texts = spark.createDataFrame([("".join(rng.choices(parts, k=30)),) for _ in range(3000)], "t string")
    replacements = ("", "/>", " ", "")
    differ = [
        F.count_if(F.regexp_replace("t", steps[i], replacements[i]) != F.regexp_replace("t", fast[i], replacements[i])) for i in steps
    ]
    assert list(texts.agg(*differ).first()) == [0, 0, 0, 0]


def test_more_parts_are_more_tasks(spark, sf, monkeypatch):
    from bazaarlens.plans import bridge, model_queries

    monkeypatch.setattr(bridge, "TASK_PARTS", 10, raising=False)
    tasks = -(-bridge.table(spark, sf, "part").count() // 10)
    assert tasks > spark.sparkContext.defaultParallelism
    assert bridge.listing_pages_b(spark, sf).rdd.getNumPartitions() == tasks
    assert bridge.raw_listings(spark, sf).rdd.getNumPartitions() == tasks
    train, _ = model_queries._split_rows(spark, sf, "augmented_description")
    assert "augmented_description" not in train.columns
