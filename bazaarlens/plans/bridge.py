"""Raw listings, listing pages and category pages worded from the relational test tables.

The cleaners get text in the form the marketplaces show it, while the value each cleaner must recover stays known from the
source columns. Everything is joins and expressions over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.constants import PRICE_SIGN, SITE_A_CLASSES, SITE_A_HOST, SITE_B_CLASSES, TIER_BASIC, TIER_PLUS
from bazaarlens.operators.cleaning import clean_listings, model_table
from bazaarlens.sources.readers import spread

# Parts in a task: a part row is small but grows a hundredfold into listing text.
TASK_PARTS = 4_000

# Items and links on the test pages.
ITEM = r"(?s)<li[^>]*>.*?</li>"
ITEM_LINK = r'<li[^>]*><a href="'
FIELDS = {
    "title": r"(?s)<title>(.*?)</title>",
    "heading": r"(?s)<h1>(.*?)</h1>",
    "article": r"(?s)<article>(.*?)</article>",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of long texts, which take far more time to work through than to move."""
    return spread(table(spark, sf_dir, name))


def _by_part(rows: DataFrame, parts: int) -> DataFrame:
    """Rows dealt by part over all cores, and over more tasks than that where there are many parts."""
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-parts // TASK_PARTS)), "p_partkey")


# Room for a supplier's key, one up, behind an order's: two keys as one decimal of 38 digits.
_KEYS = 10**19


def _first_supplier() -> tuple[Column, Callable[[Column], Column]]:
    """Order and supplier of a line as one number, which a hash aggregate keeps in place, and the supplier back from it."""
    order, supplier = (F.coalesce(F.col(name).cast("bigint"), F.lit(-1)) for name in ("l_orderkey", "l_suppkey"))
    room = F.lit(Decimal(_KEYS)).cast("decimal(20,0)")
    packed = (order.cast("decimal(19,0)") * room + (supplier.cast("decimal(20,0)") + 1)).cast("decimal(38,0)")
    return packed, lambda least: F.nullif((F.pmod(least, room) - 1).cast("bigint"), F.lit(-1).cast("bigint"))


def sold_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One narrow row per part: what it sold, and a supplier with its nation. Parts may lack any of these."""
    packed, supplier = _first_supplier()
    sales = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(
            F.sum("l_quantity").cast("bigint").alias("sold"),
            F.count("*").alias("sales"),
            # Supplier of the part's first order.
            F.min(packed).alias("first"),
        )
        .select("p_partkey", "sold", "sales", supplier(F.col("first")).alias("s_suppkey"))
    )
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    suppliers = table(spark, sf_dir, "supplier").join(nations, "s_nationkey", "left")
    parts = table(spark, sf_dir, "part")
    return parts.join(sales, "p_partkey", "left").join(suppliers, "s_suppkey", "left")


def base(spark: SparkSession, sf_dir: str, sold: DataFrame | None = None) -> DataFrame:
    """One row per part: what it sold, a supplier with its nation, and a text. Parts may lack any of these. ``sold`` takes
    written ``sold_parts`` that several readers share."""
    sold = sold_parts(spark, sf_dir) if sold is None else sold
    descriptions = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("p_partkey"), "text")
    # Long texts come last, and rows are spread before they grow, not after.
    return _by_part(sold, table(spark, sf_dir, "part").count()).join(descriptions, "p_partkey", "left")


def short_count(n: Column) -> Column:
    """1234 -> ``1,2k``, 3000 -> ``3k``, 12 -> ``12``."""
    hundreds = F.floor(n % 1000 / 100)
    shortened = F.concat(
        F.floor(n / 1000), F.when(hundreds > 0, F.concat(F.lit(","), hundreds)).otherwise(""), F.lit("k")
    )
    return F.when(n < 1000, n.cast("string")).otherwise(shortened)


def dotted(n: Column) -> Column:
    return F.concat(F.lit(PRICE_SIGN), F.replace(F.format_number(n, 0), F.lit(","), F.lit(".")))


def amount() -> Column:
    """Price before it is written out: larger sizes cost more."""
    return F.round(F.col("p_retailprice") * 100).cast("bigint") * (F.col("p_size") + 10)


def tier_line(key: Column) -> Column:
    return F.when(key % 3 == 2, TIER_PLUS + "\n").when(key % 3 == 1, TIER_BASIC + "\n").otherwise("")


def shop_panel() -> Column:
    key = F.col("s_suppkey")
    joined = (
        F.when(key % 5 == 0, F.concat(key % 9 + 1, F.lit(" năm trước")))
        .when(key % 5 == 1, F.concat(key % 11 + 1, F.lit(" tháng trước")))
        .when(key % 5 == 2, F.concat(key % 29 + 1, F.lit(" ngày trước")))
        .when(key % 5 == 3, F.lit("vài tháng trước"))
    )
    wealth = F.floor(F.abs(F.col("s_acctbal")))
    return F.concat(
        tier_line(key),
        F.col("s_name"),
        F.lit("\nĐánh Giá\n"),
        short_count(wealth),
        F.lit("\nTỉ Lệ Phản Hồi\n"),
        key % 101,
        F.lit("%"),
        F.coalesce(F.concat(F.lit("\nTham Gia\n"), joined), F.lit("")),
        F.lit("\nThời Gian Phản Hồi\ntrong "),
        key % 7,
        F.lit(" giờ\nNgười Theo Dõi\n"),
        short_count(wealth * 7),
    )


def _escape(text: Column) -> Column:
    for character, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(character), F.lit(entity))
    return text


def description() -> Column:
    def link(text: Column) -> Column:
        return F.concat(F.lit('<a class="k" href="/c">'), text, F.lit("</a>"))

    def row(label: str, value: Column) -> Column:
        return F.concat(F.lit(f'<div class="r"><label class="l">{label}</label>'), value, F.lit("</div>"))

    def boxed(value: Column) -> Column:
        return F.concat(F.lit("<div>"), value, F.lit("</div>"))

    even = F.col("p_partkey") % 2 == 0
    third = F.when(even, link(F.concat(F.lit("Cỡ "), F.floor(F.col("p_size") / 10)))).otherwise("")
    path = F.concat(link(F.lit("Shopee")), link(F.col("p_type")), link(F.substring_index("p_name", " ", -1)), third)
    nation_rows = F.concat(
        row("Xuất Xứ", boxed(F.col("n_name"))), row("Gửi từ", boxed(F.concat(F.lit("Kho "), F.col("n_name"))))
    )
    # A description is read up to its first line end, so a text's lines stand in one.
    one_line = _escape(F.replace("text", F.lit("\n"), F.lit(" ")))
    text = F.concat(F.lit('<div class="t">Mô Tả Sản Phẩm</div><div><p class="d">'), one_line, F.lit("</p></div>"))
    return F.concat(
        F.lit("<div>"),
        row("Danh Mục", boxed(path)),
        row("Thương Hiệu", link(F.col("p_brand"))),
        row("Kho hàng", boxed(short_count(F.col("p_size") * 97))),
        F.coalesce(nation_rows, F.lit("")),
        F.coalesce(text, F.lit("")),
        F.lit("</div>"),
    )


def listing_columns() -> dict[str, Column]:
    key = F.col("p_partkey")
    fee = dotted(F.col("p_size") * 1000)
    return {
        "product_name": F.concat(
            tier_line(key),
            F.lit("[SALE "), F.col("p_size"), F.lit("%] "), F.upper("p_name"), F.lit("!!! "), F.col("p_type"),
        ),
        "shipping": F.when(key % 4 == 0, "Miễn phí vận chuyển")
        .when(key % 4 == 1, fee)
        .when(key % 4 == 2, F.concat(fee, F.lit(" - "), dotted(F.col("p_size") * 2000))),
        "shop_info": shop_panel(),
        "price": F.when(
            key % 5 == 0, F.concat(dotted(F.floor(amount() / 2)), F.lit(" - "), dotted(amount()))
        ).otherwise(dotted(amount())),
        "product_desc": description(),
        "avg_rating": F.when(key % 11 != 0, F.concat(F.col("p_size") % 5, F.lit("."), key % 10)),
        "num_review": short_count(F.col("sales") * 37),
        "num_sold": short_count(F.col("sold")),
        "attrs": F.create_map(
            F.lit("Màu Sắc"), F.substring_index("p_name", " ", 1), F.lit("Size"), F.col("p_size").cast("string")
        ),
        "url": F.concat(F.lit(SITE_A_HOST + "/i."), key),
    }


def raw_listings(spark: SparkSession, sf_dir: str, *keep: str, sold: DataFrame | None = None) -> DataFrame:
    """Raw site A listings, with the source columns named in ``keep`` in front."""
    return base(spark, sf_dir, sold).select(*keep, *[value.alias(name) for name, value in listing_columns().items()])


def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_table(clean_listings(raw_listings(spark, sf_dir)))


def option_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option groups per part: the words of its name, and up to three sizes, which may be none."""
    sizes = F.col("p_size") % 4
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.array(
            F.struct(F.lit("màu").alias("name"), F.split("p_name", " ").alias("options")),
            F.struct(
                F.lit("size").alias("name"),
                F.when(sizes > 0, F.transform(F.sequence(F.lit(1), sizes), lambda i: F.concat(F.lit("S"), i)))
                .otherwise(F.array().cast("array<string>"))
                .alias("options"),
            ),
        ).alias("groups"),
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site A listing pages as HTML, one per part."""
    css = SITE_A_CLASSES

    def node(name: str, inner: Column, tag: str = "div") -> Column:
        return F.concat(F.lit(f'<{tag} class="{css[name]}">'), inner, F.lit(f"</{tag}>"))

    def lines(text: Column) -> Column:
        return F.concat(F.lit("<div>"), F.replace(_escape(text), F.lit("\n"), F.lit("</div><div>")), F.lit("</div>"))

    def button(value: Column, chosen: Column) -> Column:
        return F.concat(
            F.lit(f'<button class="{css["option_value"]}'),
            F.when(chosen, " " + css["option_selected"]).otherwise(""),
            F.lit('">'), value, F.lit("</button>"),
        )

    def option_group(name: str, *buttons: Column) -> Column:
        label = F.lit(f'<label class="{css["option_name"]}">{name}</label><div>')
        return node("option_group", F.concat(label, *buttons, F.lit("</div>")))

    listing = raw_listings(spark, sf_dir, "p_partkey", "p_name", "p_size")
    key = F.col("p_partkey")
    strip = F.when(
        F.col("avg_rating").isNotNull() & F.col("num_review").isNotNull(),
        F.concat_ws("\n", "avg_rating", "num_review", F.lit("Đánh Giá"), "num_sold", F.lit("Đã Bán"), F.lit("?")),
    ).otherwise(F.concat_ws("\n", F.lit("Chưa Có"), F.lit("Đánh Giá"), F.lit("0"), F.coalesce("num_sold", F.lit("0"))))
    options = F.concat(
        option_group(
            "Màu Sắc",
            button(F.substring_index("p_name", " ", 1), key % 3 > 0),
            button(F.substring_index("p_name", " ", -1), F.lit(False)),
        ),
        option_group("Size", button(F.col("p_size").cast("string"), F.lit(True))),
    )
    body = F.concat(
        node("product_name", lines(F.col("product_name"))),
        node("rating_strip", lines(strip)),
        node("price", _escape(F.col("price"))),
        F.coalesce(node("shipping_block", lines(F.concat(F.lit("Vận Chuyển\n"), F.col("shipping")))), F.lit("")),
        node("option_block", F.concat(F.lit("<div>"), options, F.lit("</div>"))),
        F.coalesce(node("shop_info", lines(F.col("shop_info"))), F.lit("")),
        node("product_desc", F.col("product_desc")),
    )
    return listing.select("p_partkey", "url", F.concat(F.lit("<html><body>"), body, F.lit("</body></html>")).alias("html"))


def category_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as search results: language as category, now and then a page without items, with the URL before it, or
    with an item that lost its link."""
    n = F.col("page_id")
    category = F.regexp_extract("url", "/([a-z][a-z])/", 1)
    return texts(spark, sf_dir, "pages").select(
        category.alias("category"),
        n.alias("page_no"),
        F.concat(category, F.lit("?page="), F.when(n % 17 == 16, n - 1).otherwise(n)).alias("url"),
        F.when(n % 41 == 40, F.replace("html", F.lit("<li>"), F.lit("<i>")))
        .when(n % 13 == 12, F.replace("html", F.lit('<a href="/t'), F.lit('<a data="/t')))
        .otherwise(F.col("html"))
        .alias("html"),
    )


def url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs by host as ``(category, pos, url)``."""
    return table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "://([^/]+)", 1).alias("category"), F.col("page_id").alias("pos"), "url"
    )


def listing_pages_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site B listing pages as HTML, one per part: a group without a list, colours of the name's words, and sizes, of which
    some parts have none and some show them on a local tab."""
    css = SITE_B_CLASSES

    def group(name: str, shown: Column, options: Column | None) -> Column:
        values = F.lit("")
        if options is not None:
            spans = F.array_join(F.transform(options, lambda o: F.concat(F.lit("<span>"), _escape(o), F.lit("</span>"))), "")
            values = F.concat(F.lit(f'<div class="{css["option_values"]}">'), spans, F.lit("</div>"))
        return F.concat(F.lit(f'<div class="{css["option_group"]}"><h6>{name}</h6>'), shown, values, F.lit("</div>"))

    def span(name: str, text: Column) -> Column:
        return F.concat(F.lit(f'<span class="{css[name]}">'), _escape(text), F.lit("</span>"))

    parts = table(spark, sf_dir, "part")
    parts = _by_part(parts, parts.count())
    words, count = F.split("p_name", " "), (F.col("p_size") % 4).cast("int")
    tab = F.when(F.col("p_partkey") % 5 == 0, "EU").otherwise("Int")
    sizes = F.transform(F.filter(F.array(*map(F.lit, (1, 2, 3))), lambda n: n <= count), lambda n: F.concat(F.lit("S"), n.cast("string")))
    html = F.concat(
        group("Hãng", span("option_value", F.col("p_brand")), None),
        group("Màu", span("option_value", words[0]), words),
        group("Cỡ", F.concat(span("size_tab", tab), span("size_value", F.col("p_size").cast("string"))), sizes),
    )
    return parts.select(F.concat(F.lit("https://lazada.vn/i."), "p_partkey").alias("url"), html.alias("html"))
