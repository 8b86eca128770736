"""SQL fragments the checking queries share, in DuckDB's dialect. Written from the source columns, not from the cleaners."""

from __future__ import annotations

from bazaarlens.constants import VIETNAMESE_LETTERS

# What counts as a special character, letter by letter.
SPECIAL = f"[^a-z0-9A-Z_ {VIETNAMESE_LETTERS}{VIETNAMESE_LETTERS.upper()}]+"

# One row per part with its sales, supplier, nation and text.
LISTING = """
WITH sales AS (
  SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS sold, count(*) AS sales,
         first(l_suppkey ORDER BY l_orderkey, l_suppkey) AS suppkey
  FROM lineitem GROUP BY l_partkey
),
listing AS (
  SELECT p.*, 'https://shopee.vn/i.' || p_partkey AS url, sold, sales, s_suppkey, s_name, n_name, text,
         CAST(round(p_retailprice * 100) AS BIGINT) * (p_size + 10) AS amount,
         CAST(floor(abs(s_acctbal)) AS BIGINT) AS wealth
  FROM part p
  LEFT JOIN sales ON l_partkey = p_partkey
  LEFT JOIN supplier ON s_suppkey = suppkey
  LEFT JOIN nation ON n_nationkey = s_nationkey
  LEFT JOIN documents ON doc_id = p_partkey
)
"""


def rounded(n: str) -> str:
    """A count as it reads once shortened to thousands with one decimal."""
    return f"(CASE WHEN {n} < 1000 THEN {n} ELSE {n} - {n} % 100 END)"


def shortened(n: str) -> str:
    return (
        f"(CASE WHEN {n} < 1000 THEN CAST({n} AS VARCHAR) ELSE ({n} // 1000) || "
        f"(CASE WHEN ({n} % 1000) // 100 > 0 THEN ',' || (({n} % 1000) // 100) ELSE '' END) || 'k' END)"
    )


def blanked(text: str) -> str:
    return f"regexp_replace({text}, '{SPECIAL}', ' ', 'g')"


def flattened(html: str) -> str:
    """Description markup to label/value text, step by step."""
    # The steps of the cleaning, in order.
    steps = (
        (" &amp;", ","),
        ('<svg.*?</svg>|<div>|div|class=|"|<label.*?>|<flex.*?>| href=/', ""),
        ("</a>", "-"),
        ("</label>", ": "),
        ("< ", "<"),
        ("/.*?>", "/>"),
        ("<a ", "<"),
        ("<p ", "<"),
        (" +", " "),
        ("</>", "/"),
        ("<.*?>", ""),
    )
    out = f"lower({html})"
    for pattern, replacement in steps:
        out = f"regexp_replace({out}, '{pattern}', '{replacement}', 'g')"
    return out


# A part's text as it reads inside the flattened description: in one line, escaped, flattened.
DESCRIPTION = blanked(
    "CASE WHEN text IS NULL THEN '' ELSE '/' || regexp_extract("
    + flattened("replace(replace(replace(replace(text, chr(10), ' '), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p></div></div>'")
    + ", '^(.*)', 1) END"
)

# Cleaned columns of a listing, from the source columns.
TIER = "CAST(CASE WHEN s_suppkey % 3 = 2 THEN 2 WHEN s_suppkey % 3 = 1 THEN 1 ELSE 0 END AS INTEGER)"
MONTHS = """CAST(CASE WHEN s_suppkey % 5 = 0 THEN (s_suppkey % 9 + 1) * 12
                      WHEN s_suppkey % 5 = 1 THEN s_suppkey % 11 + 1
                      WHEN s_suppkey % 5 = 3 THEN NULL ELSE 0 END AS INTEGER)"""
REPLY = "CAST(CAST(s_suppkey % 101 AS FLOAT) AS DOUBLE) / 100"
RATING = "CASE WHEN p_partkey % 11 <> 0 THEN (p_size % 5) || '.' || (p_partkey % 10) END"
CATEGORY_2 = "lower(p_type) || ' / ' || lower(split_part(p_name, ' ', 2))"
CATEGORY_3 = f"CASE WHEN p_partkey % 2 = 0 THEN {CATEGORY_2} || ' / cỡ ' || (p_size // 10) ELSE 'no' END"
NAME = "lower(p_name) || ' ' || lower(p_type)"

# The model table.
MODEL = (
    LISTING
    + f""", model AS (
  SELECT url, p_partkey, {NAME} || ' ' || {DESCRIPTION} AS name_description,
         lower(p_type) AS first_category, {CATEGORY_2} AS second_category, {CATEGORY_3} AS third_category,
         CAST({TIER} AS VARCHAR) AS shop_like_tier,
         coalesce(CAST({RATING} AS DOUBLE), 0) AS avg_rating,
         coalesce(CAST({rounded('(sales * 37)')} AS DOUBLE), 0) AS num_review,
         coalesce(CAST({rounded('sold')} AS DOUBLE), 0) AS num_sold,
         coalesce(CAST({rounded('wealth')} AS DOUBLE), 0) AS shop_num_review,
         coalesce({REPLY}, 0) AS shop_reply_percentage,
         coalesce(CAST({MONTHS} AS DOUBLE), 0) AS shop_creation_time,
         coalesce(CAST({rounded('(wealth * 7)')} AS DOUBLE), 0) AS shop_num_follower,
         CAST(amount AS DOUBLE) AS price
  FROM listing
)
"""
)
NUMERICS = (
    "avg_rating", "num_review", "num_sold", "shop_num_review", "shop_reply_percentage", "shop_creation_time",
    "shop_num_follower",
)

# Pages as search results.
PAGES = """
WITH found AS (
  SELECT regexp_extract(url, '/([a-z][a-z])/', 1) AS category, page_id AS page_no,
         CASE WHEN page_id % 17 = 16 THEN page_id - 1 ELSE page_id END AS shown,
         CASE WHEN page_id % 41 = 40 THEN replace(html, '<li>', '<i>')
              WHEN page_id % 13 = 12 THEN replace(html, '<a href="/t', '<a data="/t') ELSE html END AS html
  FROM pages
),
cat_pages AS (
  SELECT category, page_no, category || '?page=' || shown AS url, html,
         len(regexp_extract_all(html, '(?s)<li[^>]*>.*?</li>')) AS items,
         len(regexp_extract_all(html, '<li[^>]*><a href="')) AS links
  FROM found
)
"""


def links(source: str) -> str:
    """Links of pages with their place; null where an item has none."""
    return f"""SELECT category, page_no, CAST(pos - 1 AS INTEGER) AS pos,
      nullif(regexp_extract(blocks[pos], '<a\\s[^>]*?href="([^"]*)"', 1), '') AS href
    FROM (SELECT category, page_no, blocks, unnest(range(1, len(blocks) + 1)) AS pos
          FROM (SELECT *, regexp_extract_all(html, '(?s)<li[^>]*>.*?</li>') AS blocks FROM {source}))"""


# Pages before the first repeated or empty page of their category.
STOPS = """,
lagged AS (SELECT *, lag(url) OVER (PARTITION BY category ORDER BY page_no) AS previous_url FROM cat_pages),
before_repeat AS (
  SELECT p.* FROM cat_pages p LEFT JOIN
    (SELECT category, min(page_no) AS stop FROM lagged WHERE url = previous_url GROUP BY category) s USING (category)
  WHERE stop IS NULL OR page_no < stop
),
before_empty AS (
  SELECT p.* FROM cat_pages p LEFT JOIN
    (SELECT category, min(page_no) AS stop FROM cat_pages WHERE items = 0 GROUP BY category) s USING (category)
  WHERE stop IS NULL OR page_no < stop
)
"""


def first_pages(source: str, count: int = 10) -> str:
    return (
        f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY page_no) AS nth FROM {source}) "
        f"WHERE nth <= {count})"
    )


def _times(a: str, b: int) -> str:
    return f"(({a}) * {b}::UBIGINT) % 4294967296::UBIGINT"


def _turned(a: str, bits: int) -> str:
    return f"(((({a}) << {bits}) % 4294967296::UBIGINT) | (({a}) >> {32 - bits}))"


def hashed_places(words: str, width: int = 500) -> str:
    """CTEs up to ``places (term, pos)``: the place of each distinct ``term`` of a CTE in a hashed vector.

    The hash is the public 32-bit Murmur3 of the word's UTF-8 bytes, seed 42, read as a signed number.
    """
    # The constants of the hash.
    c1, c2, add, f1, f2 = 3432918353, 461845907, 3864292196, 2246822507, 3266489909

    def scrambled(k: str) -> str:
        return _times(_turned(_times(k, c1), 15), c2)

    block = "('0x' || substr(h, 8 * i + 7, 2) || substr(h, 8 * i + 5, 2) || substr(h, 8 * i + 3, 2) || substr(h, 8 * i + 1, 2))::UBIGINT"
    tail = "('0x' || substr(h, 8 * (n // 4) + 5, 2) || substr(h, 8 * (n // 4) + 3, 2) || substr(h, 8 * (n // 4) + 1, 2))::UBIGINT"
    step = f"(5 * {_turned('xor(a, ' + scrambled('k') + ')', 13)} + {add}) % 4294967296::UBIGINT"
    return f"""spelled AS (SELECT term, hex(encode(term)) AS h, length(hex(encode(term))) // 2 AS n FROM (SELECT DISTINCT term FROM {words})),
      blocks AS (SELECT term, h, n, list_reduce(list_prepend(42::UBIGINT, list_transform(range(0, n // 4), lambda i: {block})), lambda a, k: {step}) AS a FROM spelled),
      ends AS (SELECT term, xor(CASE n % 4 WHEN 0 THEN a ELSE xor(a, {scrambled(tail)}) END, n::UBIGINT) AS a FROM blocks),
      once AS (SELECT term, {_times('xor(a, a >> 16)', f1)} AS a FROM ends),
      twice AS (SELECT term, {_times('xor(a, a >> 13)', f2)} AS a FROM once),
      places AS (SELECT term, ((((xor(a, a >> 16)::BIGINT + 2147483648) % 4294967296 - 2147483648) % {width} + {width}) % {width})::INTEGER AS pos FROM twice)"""


def tf_idf(key: str, words: str) -> str:
    """CTEs from ``words (key, term)``, a row for each word, to ``weighted (key, pos, n, value)``."""
    return f"""{hashed_places(words)},
      counts AS (SELECT {key}, pos, count(*)::DOUBLE AS n FROM {words} JOIN places USING (term) GROUP BY {key}, pos),
      seen AS (SELECT pos, count(*) AS df FROM counts GROUP BY pos),
      rows_in AS (SELECT count(DISTINCT {key}) AS m FROM {words}),
      weighted AS (SELECT {key}, pos, n, CASE WHEN df < 2 THEN 0.0::DOUBLE ELSE n * ln((m + 1.0::DOUBLE) / (df + 1.0::DOUBLE)) END AS value
                   FROM counts JOIN seen USING (pos), rows_in)"""
