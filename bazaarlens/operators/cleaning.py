"""Cleaning steps as DataFrame -> DataFrame functions, one per output column, and the whole of it in three projections.

Every step is a projection: no shuffle, no Python worker. Chain single steps with ``df.transform``; for a full clean use
``clean_listings``, which flattens the description and strips its free text once for all the columns read from them.
Write the cleaned table before filtering on its columns: a filter pushed below the projection would run the patterns twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.functions import numbers, shop, text
from bazaarlens.functions.characters import composed

Step = Callable[[DataFrame], DataFrame]


def _step(output: str, source: str, expression: Callable[[Column], Column]) -> Step:
    def step(df: DataFrame) -> DataFrame:
        return df.withColumn(output, expression(F.col(source)))

    step.__name__ = step.__qualname__ = f"{source}_to_{output}"
    return step


def _from_head(expression: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda flat: expression(text.before_marker(flat))


clean_product_name = _step("product_name", "product_name", text.product_name)
clean_price = _step("price", "price", numbers.price_text)
clean_shipping = _step("shipping", "shipping", text.shipping_fee)

# These read the description that ``clean_desc`` has flattened.
extract_country = _step("country", "product_desc", _from_head(text.country))
extract_brand = _step("brand", "product_desc", _from_head(text.brand))
extract_stock = _step("stock", "product_desc", _from_head(text.stock))
extract_origin = _step("origin", "product_desc", _from_head(text.origin))
extract_first_category = _step("category", "product_desc", text.first_category)
extract_second_category = _step("second_category", "product_desc", lambda c: text.category_path(c, 2))
extract_third_category = _step("third_category", "product_desc", lambda c: text.category_path(c, 3))
extract_smaller_desc = _step("description", "product_desc", text.free_text)

# These read the panel as collected, before any lower-casing.
extract_shop_name = _step("shop_name", "shop_info", shop.shop_name)
extract_shop_like_tier = _step("shop_like_tier", "shop_info", shop.like_tier)
extract_shop_num_review = _step("shop_num_review", "shop_info", shop.review_count)
extract_shop_reply_percentage = _step("shop_reply_percentage", "shop_info", shop.reply_rate)
extract_shop_reply_time = _step("shop_reply_time", "shop_info", shop.reply_time)
extract_shop_creation_time = _step("shop_creation_time", "shop_info", shop.age_months)
extract_shop_num_follower = _step("shop_num_follower", "shop_info", shop.follower_count)


def compose_text(df: DataFrame, *columns: str) -> DataFrame:
    """Letters with separate marks as single characters, in the named columns (all text columns if none are named): the form
    that every other step takes. Put it first where texts may come in either form."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: composed(F.col(name)) for name in names})


def clean_desc(df: DataFrame, fix_slash_categories: bool = False) -> DataFrame:
    return df.withColumn("product_desc", text.flatten_markup(F.col("product_desc"), fix_slash_categories))


def clean_attrs(df: DataFrame) -> DataFrame:
    """Option map or JSON text to lower-case words."""
    return df.withColumn("attrs", text.option_text(_as_text(df, "attrs")))


def clean_numeric_field(df: DataFrame, col_name: str, strict: bool = False) -> DataFrame:
    return df.withColumn(col_name, numbers.k_int(F.col(col_name), strict))


def _as_text(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name)
    return F.to_json(name, {"ignoreNullFields": "false"})


def clean_listings(
    df: DataFrame,
    fix_slash_categories: bool = False,
    strict_counts: bool = False,
    extra_letters: str = "",
    compose: bool = False,
) -> DataFrame:
    """All cleaning steps over listings of either site, keeping any other columns as they are. With ``compose``, text may come
    with separate marks.

    Listings that carry no description breadcrumb but a category and brand of their own (site B) keep those.
    """
    flat, head = "product_desc", "__head"
    df = df.withColumn("attrs", _as_text(df, "attrs"))
    if compose:
        df = compose_text(df)
    flattened = df.withColumn(flat, text.flatten_markup(F.col(flat), fix_slash_categories)).withColumn(head, text.before_marker(F.col(flat)))

    panel = F.col("shop_info")
    cleaned = {
        "product_name": text.product_name(F.col("product_name"), extra_letters),
        "price": numbers.price_text(F.col("price")),
        "attrs": text.option_text(F.col("attrs"), extra_letters),
        "country": text.country(F.col(head)),
        "stock": text.stock(F.col(head)),
        "origin": text.origin(F.col(head)),
        "description": text.free_text(F.col(flat), extra_letters),
        "shop_name": shop.shop_name(panel),
        "shop_like_tier": shop.like_tier(panel),
        "shop_num_review": shop.review_count(panel),
        "shop_reply_percentage": shop.reply_rate(panel),
        "shop_reply_time": shop.reply_time(panel),
        "shop_creation_time": shop.age_months(panel),
        "shop_num_follower": shop.follower_count(panel),
    }
    if "shipping" in df.columns:
        cleaned["shipping"] = text.shipping_fee(F.col("shipping"))
    for count in ("num_review", "num_sold"):
        if count in df.columns:
            cleaned[count] = numbers.k_int(F.col(count), strict_counts)
    if "brand_name" in df.columns:
        cleaned["brand"] = text.blank_special(F.lower("brand_name"), extra_letters)
    else:
        cleaned["brand"] = text.brand(F.col(head))
    if "category" not in df.columns:
        cleaned["category"] = text.first_category(F.col(flat))
    cleaned["second_category"] = text.category_path(F.col(flat), 2)
    cleaned["third_category"] = text.category_path(F.col(flat), 3)
    return flattened.withColumns(cleaned).drop(head)


def model_table(cleaned: DataFrame, augmented_with: tuple[str, ...] = ("brand", "country", "origin", "attrs")) -> DataFrame:
    """Cleaned listings to the columns the models read. Site B listings get their missing counts as null."""
    have = set(cleaned.columns)

    def column(name: str, kind: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast(kind)

    return cleaned.select(
        *[F.col(key) for key in ("url",) if key in have],
        F.concat_ws(" ", "product_name", "description").alias("name_description"),
        F.concat_ws(" ", "product_name", "description", *[c for c in augmented_with if c in have]).alias(
            "augmented_description"
        ),
        F.col("category").alias("first_category"),
        "second_category",
        "third_category",
        F.col("shop_like_tier").cast("string").alias("shop_like_tier"),
        numbers.to_double(F.col("avg_rating")).alias("avg_rating"),
        column("num_review", "int").cast("double").alias("num_review"),
        column("num_sold", "int").cast("double").alias("num_sold"),
        F.col("shop_num_review").cast("double").alias("shop_num_review"),
        "shop_reply_percentage",
        F.col("shop_creation_time").cast("double").alias("shop_creation_time"),
        F.col("shop_num_follower").cast("double").alias("shop_num_follower"),
        numbers.to_double(F.col("price")).alias("price"),
    )
