"""Queries for cleaning, attribute extraction, shop panels and numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.functions import numbers, text
from bazaarlens.operators import cleaning, features
from bazaarlens.plans import bridge
from bazaarlens.plans import oracle_parts as o
from bazaarlens.plans.registry import query


def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.raw_listings(spark, sf_dir)


def _from_listing(expression: str, name: str) -> str:
    return f"{o.LISTING} SELECT url, {expression} AS {name} FROM listing"


# --- text ------------------------------------------------------------------------------------------------------------


@query("cl_name", _from_listing(o.NAME, "product_name"))
def cl_name(spark, sf_dir):
    return cleaning.clean_product_name(_listings(spark, sf_dir)).select("url", "product_name")


@query(
    "cl_name_documents",
    f"""SELECT doc_id, trim(regexp_replace({o.blanked(
        "regexp_replace(regexp_replace(lower(text), 'yêu thích\\n|yêu thích\\+\\n', ' ', 'g'), '\\[.*?\\]', ' ', 'g')"
    )}, ' +', ' ', 'g')) AS product_name FROM documents""",
)
def cl_name_documents(spark, sf_dir):
    documents = bridge.texts(spark, sf_dir, "documents")
    return documents.select("doc_id", text.product_name(F.col("text")).alias("product_name"))


@query("cl_attrs", _from_listing("'màu sắc ' || split_part(p_name, ' ', 1) || ' size ' || p_size", "attrs"))
def cl_attrs(spark, sf_dir):
    return cleaning.clean_attrs(_listings(spark, sf_dir)).select("url", "attrs")


@query("cl_desc", f"SELECT page_id, {o.flattened('html')} AS product_desc FROM pages")
def cl_desc(spark, sf_dir):
    pages = bridge.texts(spark, sf_dir, "pages").withColumnRenamed("html", "product_desc")
    return cleaning.clean_desc(pages).select("page_id", "product_desc")


@query(
    "cl_shipping",
    _from_listing(
        "CASE p_partkey % 4 WHEN 0 THEN '' WHEN 3 THEN NULL ELSE CAST(p_size * 1000 AS VARCHAR) END", "shipping"
    ),
)
def cl_shipping(spark, sf_dir):
    return cleaning.clean_shipping(_listings(spark, sf_dir)).select("url", "shipping")


@query("cl_smaller_desc", _from_listing(o.DESCRIPTION, "description"))
def cl_smaller_desc(spark, sf_dir):
    flat = cleaning.clean_desc(_listings(spark, sf_dir))
    return cleaning.extract_smaller_desc(flat).select("url", "description")


# --- attributes from the description ---------------------------------------------------------------------------------

_EXTRACTED = {
    "ex_country": (cleaning.extract_country, "country", "coalesce(lower(n_name), '')"),
    "ex_brand": (cleaning.extract_brand, "brand", "replace(lower(p_brand), '#', ' ')"),
    "ex_stock": (cleaning.extract_stock, "stock", f"replace({o.shortened('(p_size * 97)')}, ',', ' ')"),
    "ex_origin": (cleaning.extract_origin, "origin", "coalesce('kho ' || lower(n_name), '')"),
    "ex_cat1": (cleaning.extract_first_category, "category", "lower(p_type)"),
    "ex_cat2": (cleaning.extract_second_category, "second_category", o.CATEGORY_2),
    "ex_cat3": (cleaning.extract_third_category, "third_category", o.CATEGORY_3),
}


def _register_extracted(name: str) -> None:
    step, column, expected = _EXTRACTED[name]

    @query(name, _from_listing(expected, column))
    def extracted(spark, sf_dir):
        return step(cleaning.clean_desc(_listings(spark, sf_dir))).select("url", column)


for _name in _EXTRACTED:
    _register_extracted(_name)

# --- shop panel ------------------------------------------------------------------------------------------------------

_SHOP = {
    "sh_name": (cleaning.extract_shop_name, "shop_name", "s_name"),
    "sh_tier": (cleaning.extract_shop_like_tier, "shop_like_tier", o.TIER),
    "sh_reviews": (cleaning.extract_shop_num_review, "shop_num_review", f"CAST({o.rounded('wealth')} AS INTEGER)"),
    "sh_replypct": (cleaning.extract_shop_reply_percentage, "shop_reply_percentage", o.REPLY),
    "sh_replytime": (cleaning.extract_shop_reply_time, "shop_reply_time", "'trong ' || (s_suppkey % 7) || ' giờ'"),
    "sh_age": (
        cleaning.extract_shop_creation_time,
        "shop_creation_time",
        f"CASE WHEN s_suppkey IS NULL THEN 0 ELSE {o.MONTHS} END",
    ),
    "sh_followers": (
        cleaning.extract_shop_num_follower,
        "shop_num_follower",
        f"CAST({o.rounded('(wealth * 7)')} AS INTEGER)",
    ),
}


def _register_shop(name: str) -> None:
    step, column, expected = _SHOP[name]

    @query(name, _from_listing(expected, column))
    def shop_column(spark, sf_dir):
        return step(_listings(spark, sf_dir)).select("url", column)


for _name in _SHOP:
    _register_shop(_name)

# --- numbers ---------------------------------------------------------------------------------------------------------


@query("num_k", _from_listing(f"CAST({o.rounded('sold')} AS VARCHAR)", "num_sold"))
def num_k(spark, sf_dir):
    return _listings(spark, sf_dir).select("url", numbers.k_number(F.col("num_sold")).alias("num_sold"))


@query(
    "num_field",
    f"""{o.LISTING} SELECT url, CAST({o.rounded('(sales * 37)')} AS INTEGER) AS num_review,
        CAST({o.rounded('sold')} AS INTEGER) AS num_sold FROM listing""",
)
def num_field(spark, sf_dir):
    listings = _listings(spark, sf_dir)
    counted = cleaning.clean_numeric_field(cleaning.clean_numeric_field(listings, "num_review"), "num_sold")
    return counted.select("url", "num_review", "num_sold")


@query("num_price", _from_listing("CAST(amount AS VARCHAR)", "price"))
def num_price(spark, sf_dir):
    return cleaning.clean_price(_listings(spark, sf_dir)).select("url", "price")


@query("num_cast", _from_listing(f"CAST(amount AS DOUBLE) AS price, CAST({o.RATING} AS DOUBLE)", "avg_rating"))
def num_cast(spark, sf_dir):
    priced = cleaning.clean_price(_listings(spark, sf_dir))
    return priced.select(
        "url",
        numbers.to_double(F.col("price")).alias("price"),
        numbers.to_double(F.col("avg_rating")).alias("avg_rating"),
    )


def _prepared_columns(*names: str) -> str:
    return f"{o.MODEL} SELECT url, {', '.join(names)} FROM model"


@query("num_fill", _prepared_columns(*o.NUMERICS))
def num_fill(spark, sf_dir):
    return features.prepare(bridge.model_rows(spark, sf_dir)).select("url", *o.NUMERICS)


def _six(value: Column) -> Column:
    return F.round(value, 6)


@query(
    "num_label",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              CASE WHEN l_extendedprice - 30000 > 0 THEN round(log10(l_extendedprice - 30000), 6) END AS log_price
       FROM lineitem""",
)
def num_label(spark, sf_dir):
    lines = bridge.table(spark, sf_dir, "lineitem")
    label = _six(numbers.log_price(F.col("l_extendedprice") - 30000))
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", label.alias("log_price"))


@query(
    "num_exp",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              round(pow(10.0::DOUBLE, l_quantity / 10), 4) AS prediction FROM lineitem""",
)
def num_exp(spark, sf_dir):
    lines = bridge.table(spark, sf_dir, "lineitem")
    price = F.round(numbers.price_from_log(F.col("l_quantity") / 10), 4)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", price.alias("prediction"))


# --- everything together ---------------------------------------------------------------------------------------------

CLEANED = f"""SELECT url, {o.NAME} AS product_name, CAST(amount AS VARCHAR) AS price,
  CASE p_partkey % 4 WHEN 0 THEN '' WHEN 3 THEN NULL ELSE CAST(p_size * 1000 AS VARCHAR) END AS shipping,
  'màu sắc ' || split_part(p_name, ' ', 1) || ' size ' || p_size AS attrs,
  CAST({o.rounded('(sales * 37)')} AS INTEGER) AS num_review, CAST({o.rounded('sold')} AS INTEGER) AS num_sold,
  coalesce(lower(n_name), '') AS country, replace(lower(p_brand), '#', ' ') AS brand,
  replace({o.shortened('(p_size * 97)')}, ',', ' ') AS stock, coalesce('kho ' || lower(n_name), '') AS origin,
  lower(p_type) AS category, {o.CATEGORY_2} AS second_category, {o.CATEGORY_3} AS third_category,
  {o.DESCRIPTION} AS description, s_name AS shop_name, {o.TIER} AS shop_like_tier,
  CAST({o.rounded('wealth')} AS INTEGER) AS shop_num_review, {o.REPLY} AS shop_reply_percentage,
  'trong ' || (s_suppkey % 7) || ' giờ' AS shop_reply_time,
  CASE WHEN s_suppkey IS NULL THEN 0 ELSE {o.MONTHS} END AS shop_creation_time,
  CAST({o.rounded('(wealth * 7)')} AS INTEGER) AS shop_num_follower
  FROM listing"""
CLEANED_COLUMNS = (
    "url", "product_name", "price", "shipping", "attrs", "num_review", "num_sold", "country", "brand", "stock",
    "origin", "category", "second_category", "third_category", "description", "shop_name", "shop_like_tier",
    "shop_num_review", "shop_reply_percentage", "shop_reply_time", "shop_creation_time", "shop_num_follower",
)


@query("clean_all", f"{o.LISTING} {CLEANED}")
def clean_all(spark, sf_dir):
    return cleaning.clean_listings(_listings(spark, sf_dir)).select(*CLEANED_COLUMNS)


@query("ft_prepare", _prepared_columns("name_description", *o.NUMERICS, "price", "round(log10(price), 6) AS log_price"))
def ft_prepare(spark, sf_dir):
    prepared = features.prepare(bridge.model_rows(spark, sf_dir))
    return prepared.select("url", "name_description", *o.NUMERICS, "price", _six(F.col("log_price")).alias("log_price"))
