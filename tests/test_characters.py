"""Composed letters against Unicode's own composition, and character references against the standard library's reader."""

from __future__ import annotations

import html
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from bazaarlens.constants import VIETNAMESE_LETTERS
from bazaarlens.functions import characters, markup
from bazaarlens.operators import cleaning

LETTERS = VIETNAMESE_LETTERS + VIETNAMESE_LETTERS.upper() + "ÀÿçñŠžǘḗẅ"


def applied(spark, function, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3)
    return [r.t for r in frame.select("i", function(F.col("t")).alias("t")).orderBy("i").collect()]


def test_every_letter_is_composed_whatever_the_order_of_its_marks(spark):
    texts = [unicodedata.normalize("NFD", c) for c in LETTERS] + list(LETTERS)
    texts += ["ệ", "ệ", "ệ", "ệ", "ớ", "ớ", "ớ", "x́y", "q̣́", "é́́", "́", "й", "中́", "", None]
    expected = [None if t is None else unicodedata.normalize("NFC", t) for t in texts]
    assert applied(spark, characters.composed, texts) == expected


@pytest.mark.parametrize("seed", range(3))
def test_texts_are_composed(spark, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(LETTERS + "abc \n,1<>&") for _ in range(rng.randrange(80))) for _ in range(100)]
    assert applied(spark, characters.composed, [unicodedata.normalize("NFD", t) for t in texts]) == texts


def test_cleaners_give_the_same_for_both_forms(spark):
    row = ("Yêu Thích\n[SALE] Áo Thun Nữ!!", '<div><label class="l">Thương Hiệu</label><a class="k" href="/c">Việt Tiến</a></div>', "Yêu Thích\nCửa Hàng Số\nĐánh Giá\n1,2k\n")
    rows = [row, tuple(unicodedata.normalize("NFD", t) for t in row)]
    frame = cleaning.compose_text(spark.createDataFrame(rows, "product_name string, product_desc string, shop_info string"))
    steps = (cleaning.clean_product_name, cleaning.clean_desc, cleaning.extract_brand, cleaning.extract_shop_name, cleaning.extract_shop_num_review)
    for step in steps:
        frame = frame.transform(step)
    one, other = frame.select("product_name", "brand", "shop_name", "shop_num_review").collect()
    assert one == other and one.product_name == "áo thun nữ" and one.brand == "việt tiến" and one.shop_name == "Cửa Hàng Số"


REFERENCES = [
    "&#8363;15.000", "&eacute;", "&amp;lt;", "&amp;amp;", "&lt;b&gt;", "&copy2024", "&copy;", "&notit;", "&notin;", "&amp", "&ampere", "a & b", "&", "&;", "&#;",
    "&#x20AB;", "&#X20ab", "&#x;", "&#0;", "&#128;", "&#x80;", "&#129;", "&#55296;", "&#1114112;", "&#99999999999;", "&#000065;", "&unknown;", "&NotEqualTilde;",
    "&#128512;", "x&nbsp;y", "&&amp;&", "&ouml&uuml;", "&AMP;", "&Lt;", "&CounterClockwiseContourIntegral;", "no reference", "", "&#xZ;", "&frac12;&frac", "&lt&gt",
]


def test_references_equal_those_of_the_standard_reader(spark):
    assert applied(spark, characters.decoded, REFERENCES) == [html.unescape(t) for t in REFERENCES]
    assert applied(spark, characters.decoded, [None]) == [None]


def test_all_names(spark):
    texts = [f"a&{name}b" for name in html.entities.html5]
    assert applied(spark, characters.decoded, texts) == [html.unescape(t) for t in texts]


@pytest.mark.parametrize("seed", range(3))
def test_random_references(spark, seed):
    rng = random.Random(seed)
    parts = ["&", "amp", ";", "#", "x", "38", "lt", "é", " ", "notin", "sup1", "A", "&#60;", "&amp;", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(300)]
    assert applied(spark, characters.decoded, texts) == [html.unescape(t) for t in texts]


def test_references_in_fields_and_options(spark):
    page = '<div class="f">Caf&eacute; &amp;lt; &#8363;5&nbsp;k<br>x</div><b class="o">S&amp;M</b><h6>M&agrave;u</h6>'
    frame = spark.createDataFrame([(page,)], "h string").select(
        markup.node_text(F.regexp_extract("h", r'<div class="f">(.*?)</div>', 1)).alias("text"),
        markup.leaf_texts(F.col("h"), "o").alias("options"),
        markup.heading(F.col("h")).alias("heading"),
    )
    assert tuple(frame.first()) == ("Café &lt; ₫5 k\nx", ["S&M"], "Màu")
