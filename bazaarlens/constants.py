"""Fixed values that listing data is written in: letters, labels, class names and defaults.

Everything in this module must equal what the marketplaces show, so none of it is derived from data.
"""

from __future__ import annotations

# --- Fixed values: letters -------------------------------------------------------------------------------------------
# Lower-case Vietnamese letters outside a-z, in alphabet order.
VIETNAMESE_LETTERS = (
    "àáảãạ" "ăằắẳẵặ" "âầấẩẫậ" "đ" "èéẻẽẹ" "êềếểễệ" "ìíỉĩị" "òóỏõọ" "ôồốổỗộ" "ơờớởỡợ" "ùúủũụ" "ưừứửữự" "ỳýỷỹỵ"
)

# --- Fixed values: labels in listing text ----------------------------------------------------------------------------
PRICE_SIGN = "₫"
TIER_PLUS = "Yêu Thích+"
TIER_BASIC = "Yêu Thích"
DESCRIPTION_MARKER = "mô tả sản phẩm"
BREADCRUMB_ROOT = "shopee"

LABEL_COUNTRY = "xuất xứ"
LABEL_BRAND = "thương hiệu"
LABEL_STOCK = "kho hàng"
LABEL_ORIGIN = "gửi từ"

PANEL_REVIEWS = "Đánh Giá"
PANEL_REPLY_RATE = "Tỉ Lệ Phản Hồi"
PANEL_REPLY_TIME = "Thời Gian Phản Hồi"
PANEL_JOINED = "Tham Gia"
PANEL_FOLLOWERS = "Người Theo Dõi"

UNIT_YEAR = "năm"
UNIT_MONTH = "tháng"

# Category names written with a slash, and how they read without one.
SLASHED_CATEGORIES = (
    ("Vớ/ Tất", "Vớ, Tất"),
    ("Vớ/Tất", "Vớ, Tất"),
    ("Quần Dài/Quần Âu", "Quần Dài, Quần Âu"),
    ("Quần Dài/ Quần Âu", "Quần Dài, Quần Âu"),
)

# --- Fixed values: markup of the two sites ---------------------------------------------------------------------------
SITE_A_HOST = "https://shopee.vn"

# Class names of the nodes that hold each field on a landed page.
SITE_A_CLASSES = {
    "item": "shopee-search-item-result__item",
    "product_name": "_44qnta",
    "price": "pqTWkA",
    "rating_strip": "flex X5u-5c",
    "shipping_block": "WZTmVh",
    "option_block": "flex rY0UiC j9be9C",
    "option_group": "flex items-center",
    "option_name": "oN9nMU",
    "option_value": "product-variation",
    "option_selected": "product-variation--selected",
    "product_desc": "product-detail page-product__detail",
    "shop_info": "NLeTwo page-product__shop",
}
SITE_B_CLASSES = {
    "item": "Bm3ON",
    "product_name": "pdp-mod-product-badge-title",
    "brand_name": "pdp-product-brand__brand-link",
    "num_review": "pdp-review-summary__link",
    "price": "pdp-price pdp-price_type_normal pdp-price_color_orange pdp-price_size_xl",
    "avg_rating": "score-average",
    "option_group": "sku-prop-selection",
    "option_values": "sku-prop-content",
    "option_value": "sku-name",
    "size_tab": "sku-tabpath-single",
    "size_value": "sku-variable-size-selected",
    "product_desc": "pdp-product-desc height-limit",
    "shop_info": "seller-container",
}
SIZE_TAB_WITH_VALUE = "Int"

# --- Fixed values: defaults ------------------------------------------------------------------------------------------
PAGES_PER_CATEGORY = 10
SPLIT_WEIGHTS = (0.7, 0.3)
SPLIT_SEED = 1000
