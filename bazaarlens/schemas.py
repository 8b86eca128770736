"""Schemas of every table the library reads or writes. Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


SEED = T.StructType(_strings("category", "url"))

URL_LIST = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("url", T.StringType()),
    ]
)

# Option name -> chosen option. Keys differ per listing, so this must stay a map.
ATTRS = T.MapType(T.StringType(), T.StringType(), True)

LISTING_A = T.StructType(
    _strings("product_name", "shipping", "shop_info", "price", "product_desc", "avg_rating", "num_review", "num_sold")
    + [T.StructField("attrs", ATTRS)]
    + _strings("url")
)

LISTING_B = T.StructType(
    _strings("product_name", "shop_info", "price", "brand_name", "num_review")
    + [T.StructField("attrs", ATTRS)]
    + _strings("product_desc", "avg_rating", "category", "url")
)

LISTINGS = {"a": LISTING_A, "b": LISTING_B}

# Columns a record cannot be written without.
REQUIRED = {
    "a": ("product_name", "price", "product_desc"),
    "b": ("product_name", "brand_name", "num_review", "price"),
}

# Nodes a landed page must have besides.
REQUIRED_NODES = {"a": ("rating_strip",), "b": ()}

OPTION_GROUPS = T.ArrayType(
    T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("options", T.ArrayType(T.StringType())),
        ]
    )
)

# The model table as it is read from CSV: text only, typed by ``operators.features.prepare``.
MODEL_TEXTS = ("name_description", "augmented_description")
MODEL_CATEGORIES = ("first_category", "second_category", "third_category", "shop_like_tier")
MODEL_NUMERICS = (
    "avg_rating",
    "num_review",
    "num_sold",
    "shop_num_review",
    "shop_reply_percentage",
    "shop_creation_time",
    "shop_num_follower",
)
MODEL_CSV = T.StructType(_strings(*MODEL_TEXTS, *MODEL_CATEGORIES, *MODEL_NUMERICS, "price"))
