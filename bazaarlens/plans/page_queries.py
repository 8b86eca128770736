"""Queries for landed pages, progress, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.constants import SITE_A_CLASSES, SITE_B_CLASSES
from bazaarlens.functions import markup
from bazaarlens.functions.numbers import to_double
from bazaarlens.operators import pages, progress
from bazaarlens.operators.cleaning import clean_listings, model_table
from bazaarlens.plans import bridge
from bazaarlens.plans import oracle_parts as o
from bazaarlens.plans.cleaning_queries import CLEANED, CLEANED_COLUMNS
from bazaarlens.plans.registry import query
from bazaarlens.schemas import LISTINGS
from bazaarlens.session import scratch_path, shuffles_dropped, written
from bazaarlens.sources import readers, runs, writers
from bazaarlens.streaming import cursors
from bazaarlens.streaming.ingest import ingest

PAGE_KEYS = ("category", "page_no", "url")

# --- links and page rules --------------------------------------------------------------------------------------------


@query("pg_links", f"{o.PAGES} {o.links('cat_pages')}")
def pg_links(spark, sf_dir):
    found = pages.links(bridge.category_pages(spark, sf_dir), bridge.ITEM)
    return found.select("category", "page_no", "pos", "href")


@query(
    "pg_absurl",
    f"""{o.PAGES} SELECT category, page_no, pos, 'https://shopee.vn' || href AS url_a,
        'https://' || substr(href, 3) AS url_b FROM ({o.links('cat_pages')})""",
)
def pg_absurl(spark, sf_dir):
    href = F.col("href")
    return pg_links(spark, sf_dir).select(
        "category",
        "page_no",
        "pos",
        markup.absolute_from_root(href).alias("url_a"),
        markup.absolute_from_scheme(href).alias("url_b"),
    )


@query("pg_gate", f"{o.PAGES} SELECT category, page_no, url FROM cat_pages WHERE items = links")
def pg_gate(spark, sf_dir):
    found = bridge.category_pages(spark, sf_dir)
    return pages.complete_pages(found, bridge.ITEM, bridge.ITEM_LINK).select(*PAGE_KEYS)


@query("pg_empty", f"{o.PAGES}{o.STOPS} SELECT category, page_no, url FROM before_empty")
def pg_empty(spark, sf_dir):
    return pages.before_empty(bridge.category_pages(spark, sf_dir), bridge.ITEM).select(*PAGE_KEYS)


@query("pg_cap", f"{o.PAGES} SELECT category, page_no, url FROM {o.first_pages('cat_pages')}")
def pg_cap(spark, sf_dir):
    return pages.first_pages(bridge.category_pages(spark, sf_dir).select(*PAGE_KEYS))


@query("pg_repeat", f"{o.PAGES}{o.STOPS} SELECT category, page_no, url FROM before_repeat")
def pg_repeat(spark, sf_dir):
    return pages.before_repeat(bridge.category_pages(spark, sf_dir)).select(*PAGE_KEYS)


@query(
    "pg_urls_a",
    f"""{o.PAGES}{o.STOPS}, visited AS (SELECT * FROM before_repeat WHERE items = links)
        SELECT category, page_no, pos, 'https://shopee.vn' || href AS url FROM ({o.links('visited')})""",
)
def pg_urls_a(spark, sf_dir):
    return pages.listing_urls(bridge.category_pages(spark, sf_dir), "a", bridge.ITEM, bridge.ITEM_LINK)


@query(
    "pg_urls_b",
    f"""{o.PAGES}{o.STOPS}, visited AS (SELECT * FROM before_empty)
        SELECT category, page_no, pos, 'https://' || substr(href, 3) AS url FROM ({o.links('visited')})""",
)
def pg_urls_b(spark, sf_dir):
    return pages.listing_urls(bridge.category_pages(spark, sf_dir), "b", bridge.ITEM)


# --- fields of a listing page ----------------------------------------------------------------------------------------

_SHIPPING = """CASE p_partkey % 4 WHEN 0 THEN 'Miễn phí vận chuyển'
  WHEN 1 THEN '₫' || p_size || '.000' WHEN 2 THEN '₫' || p_size || '.000 - ₫' || (p_size * 2) || '.000' END"""
_RATED = f"(({o.RATING}) IS NOT NULL AND sales IS NOT NULL)"


@query(
    "pg_strip",
    f"""{o.LISTING} SELECT url, CASE WHEN {_RATED} THEN {o.RATING} END AS avg_rating,
        CASE WHEN {_RATED} THEN {o.shortened('(sales * 37)')} END AS num_review,
        CASE WHEN {_RATED} OR p_partkey % 2 = 0 THEN coalesce({o.shortened('sold')}, '0') END AS num_sold FROM listing""",
)
def pg_strip(spark, sf_dir):
    rated = F.col("avg_rating").isNotNull() & F.col("num_review").isNotNull()
    sold = F.coalesce("num_sold", F.lit("0"))
    strip = (
        F.when(rated, F.concat_ws("\n", "avg_rating", "num_review", F.lit("Đánh Giá"), sold, F.lit("Đã Bán"), F.lit("?")))
        .when(F.col("p_partkey") % 2 == 0, F.concat_ws("\n", F.lit("Chưa Có"), F.lit("Đánh Giá"), F.lit("0"), sold))
        .otherwise(F.concat_ws("\n", F.lit("Chưa Có"), sold))
    )
    listings = bridge.raw_listings(spark, sf_dir, "p_partkey")
    return listings.select("url", markup.rating_strip(strip).alias("strip")).select("url", "strip.*")


@query("pg_shiplast", f"{o.LISTING} SELECT url, {_SHIPPING} AS shipping FROM listing")
def pg_shiplast(spark, sf_dir):
    block = F.concat(F.lit("Vận Chuyển\nPhí Vận Chuyển\n"), F.col("shipping"))
    return bridge.raw_listings(spark, sf_dir).select("url", markup.last_line(block).alias("shipping"))


@query(
    "pg_fields",
    "SELECT page_id, "
    + ", ".join(
        f"CASE WHEN regexp_matches(html, '{p}') THEN regexp_extract(html, '{p}', 1) END AS {name}"
        for name, p in bridge.FIELDS.items()
    )
    + " FROM pages",
)
def pg_fields(spark, sf_dir):
    found = bridge.texts(spark, sf_dir, "pages")
    columns = markup.fields(F.col("html"), bridge.FIELDS)
    return found.select("page_id", *[column.alias(name) for name, column in columns.items()])


@query(
    "pg_fields_by_class",
    f"""{o.LISTING} SELECT url, {o.NAME} AS product_name, CAST(amount AS VARCHAR) AS price,
        {_SHIPPING} AS shipping, CASE WHEN {_RATED} THEN {o.RATING} END AS avg_rating,
        CASE WHEN {_RATED} THEN {o.shortened('(sales * 37)')} END AS num_review,
        coalesce({o.shortened('sold')}, '0') AS num_sold, s_name AS shop_name,
        CAST({o.rounded('(wealth * 7)')} AS INTEGER) AS shop_num_follower, {o.CATEGORY_3} AS third_category FROM listing""",
)
def pg_fields_by_class(spark, sf_dir):
    records = pages.site_a_records(bridge.listing_pages(spark, sf_dir))
    kept = ("shipping", "avg_rating", "num_review", "num_sold")
    cleaned = clean_listings(records.withColumns({f"raw_{name}": F.col(name) for name in kept}))
    return cleaned.select(
        "url",
        "product_name",
        "price",
        *[F.col(f"raw_{name}").alias(name) for name in kept],
        "shop_name",
        "shop_num_follower",
        "third_category",
    )


@query(
    "pg_attrs",
    """SELECT 'https://shopee.vn/i.' || p_partkey AS url,
              CASE WHEN p_partkey % 3 > 0 THEN split_part(p_name, ' ', 1) END AS color,
              CAST(p_size AS VARCHAR) AS size, 2 AS options FROM part""",
)
def pg_attrs(spark, sf_dir):
    records = pages.site_a_records(bridge.listing_pages(spark, sf_dir))
    attrs = F.col("attrs")
    return records.select(
        "url", attrs["Màu Sắc"].alias("color"), attrs["Size"].alias("size"), F.size(attrs).alias("options")
    )


@query(
    "pg_variants",
    """SELECT p_partkey, CAST((i - 1) * (p_size % 4) + j - 1 AS BIGINT) AS variant_no,
              words[i] AS color, 'S' || j AS size
       FROM (SELECT *, string_split(p_name, ' ') AS words FROM part)
       CROSS JOIN UNNEST(range(1, len(words) + 1)) AS a(i)
       CROSS JOIN UNNEST(range(1, p_size % 4 + 1)) AS b(j)""",
)
def pg_variants(spark, sf_dir):
    expanded = pages.variants(bridge.option_groups(spark, sf_dir))
    attrs = F.col("attrs")
    return expanded.select("p_partkey", "variant_no", attrs["màu"].alias("color"), attrs["size"].alias("size"))


@query(
    "pg_page_variants",
    """SELECT 'https://shopee.vn/i.' || p_partkey AS url, CAST(i - 1 AS BIGINT) AS variant_no, colors[i] AS color
       FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN string_split(p_name, ' ')[2:2]
                                    ELSE string_split(p_name, ' ') END AS colors FROM part)
       CROSS JOIN UNNEST(range(1, len(colors) + 1)) AS a(i)""",
)
def pg_page_variants(spark, sf_dir):
    """Variants of whole listing pages. The only size is chosen already, so its group offers nothing and keeps its value."""
    return pg_page_variants_attrs(spark, sf_dir).select("url", "variant_no", "color")


@query(
    "pg_page_variants_attrs",
    """SELECT 'https://shopee.vn/i.' || p_partkey AS url, CAST(i - 1 AS BIGINT) AS variant_no, colors[i] AS color,
              CAST(p_size AS VARCHAR) AS size, 2 AS options
       FROM (SELECT p_partkey, p_size, CASE WHEN p_partkey % 3 > 0 THEN [split_part(p_name, ' ', -1)]
                    ELSE [split_part(p_name, ' ', 1), split_part(p_name, ' ', -1)] END AS colors FROM part)
       CROSS JOIN UNNEST(range(1, len(colors) + 1)) AS a(i)""",
)
def pg_page_variants_attrs(spark, sf_dir):
    """All attributes of the same variants."""
    options = pages.site_a_options(bridge.listing_pages(spark, sf_dir))
    expanded = pages.variants(options, skip_empty_groups=True, chosen="chosen")
    attrs = F.col("attrs")
    return expanded.select(
        "url", "variant_no", attrs["Màu Sắc"].alias("color"), attrs["Size"].alias("size"), F.size(attrs).alias("options")
    )


@query(
    "pg_page_variants_b",
    """SELECT 'https://lazada.vn/i.' || p_partkey AS url, CAST((i - 1) * (p_size % 4) + j - 1 AS BIGINT) AS variant_no,
              p_brand AS maker, words[i] AS color, CASE WHEN p_partkey % 5 > 0 THEN 'S' || j END AS size, 3 AS options
       FROM (SELECT *, string_split(p_name, ' ') AS words FROM part)
       CROSS JOIN UNNEST(range(1, len(words) + 1)) AS a(i)
       CROSS JOIN UNNEST(range(1, p_size % 4 + 1)) AS b(j)""",
)
def pg_page_variants_b(spark, sf_dir):
    """Variants of site B. The maker's group has no list to choose from; a list without a size gives no variant."""
    expanded = pages.variants(pages.site_b_options(bridge.listing_pages_b(spark, sf_dir)), chosen="chosen")
    attrs = F.col("attrs")
    return expanded.select(
        "url", "variant_no", attrs["Hãng"].alias("maker"), attrs["Màu"].alias("color"), attrs["Cỡ"].alias("size"),
        F.size(attrs).alias("options"),
    )


@query(
    "pg_variant_records",
    f"""{o.LISTING}, paged AS (
         SELECT *, CASE WHEN p_partkey % 3 > 0 THEN [split_part(p_name, ' ', -1)]
                        ELSE [split_part(p_name, ' ', 1), split_part(p_name, ' ', -1)] END AS colors FROM listing)
       SELECT url, CAST(i - 1 AS BIGINT) AS variant_no, colors[i] AS color, CAST(p_size AS VARCHAR) AS size, 2 AS options,
              CAST(CAST(amount AS BIGINT) AS VARCHAR) AS price, upper(p_name) AS name, {_SHIPPING} AS shipping
       FROM paged CROSS JOIN UNNEST(range(1, len(colors) + 1)) AS a(i)""",
)
def pg_variant_records(spark, sf_dir):
    """Whole records of site A, one for each variant, from one scan of the page."""
    records = pages.site_a_variants(bridge.listing_pages(spark, sf_dir))
    attrs = F.col("attrs")
    # Of a range of prices the upper one, without separators.
    price = F.regexp_replace(F.element_at(F.split("price", " - "), -1), "[^0-9]", "")
    return records.select(
        "url", "variant_no", attrs["Màu Sắc"].alias("color"), attrs["Size"].alias("size"), F.size(attrs).alias("options"),
        price.alias("price"), F.regexp_extract("product_name", r"% ?\] ?(.*)!!!", 1).alias("name"), "shipping",
    )


def _with_items(spark: SparkSession, sf_dir: str, site: str) -> DataFrame:
    """Category pages whose items carry their site's class name."""
    css = {"a": SITE_A_CLASSES, "b": SITE_B_CLASSES}[site]
    item = F.replace("html", F.lit("<li>"), F.lit(f'<li class="x {css["item"]}">'))
    return bridge.category_pages(spark, sf_dir).withColumn("html", item)


@query(
    "pg_urls_a_by_class",
    f"""{o.PAGES}{o.STOPS}, visited AS (SELECT * FROM before_repeat WHERE items = links)
        SELECT category, page_no, pos, 'https://shopee.vn' || href AS url FROM ({o.links('visited')})""",
)
def pg_urls_a_by_class(spark, sf_dir):
    return pages.listing_urls_by_class(_with_items(spark, sf_dir, "a"), "a")


@query(
    "pg_urls_b_by_class",
    f"""{o.PAGES}{o.STOPS}, visited AS (SELECT * FROM before_empty)
        SELECT category, page_no, pos, 'https://' || substr(href, 3) AS url FROM ({o.links('visited')})""",
)
def pg_urls_b_by_class(spark, sf_dir):
    return pages.listing_urls_by_class(_with_items(spark, sf_dir, "b"), "b")


@query(
    "pg_required",
    f"""{o.LISTING} SELECT url, p_brand AS brand_name, {o.RATING} AS num_review FROM listing
        WHERE ({o.RATING}) IS NOT NULL AND s_name IS NOT NULL""",
)
def pg_required(spark, sf_dir):
    listings = bridge.raw_listings(spark, sf_dir, "p_brand", "s_name")
    records = listings.select(
        "url",
        F.col("s_name").alias("product_name"),
        F.col("p_brand").alias("brand_name"),
        F.col("avg_rating").alias("num_review"),
        "price",
    )
    return pages.required_only(records, "b").select("url", "brand_name", "num_review")


# --- progress --------------------------------------------------------------------------------------------------------

_URLS = "(SELECT regexp_extract(url, '://([^/]+)', 1) AS category, page_id AS pos, url FROM pages)"


@query(
    "pg_resume",
    f"""SELECT category, pos, url FROM {_URLS} LEFT JOIN
        (SELECT category, max(pos) AS cursor FROM {_URLS} WHERE url LIKE '%#top' GROUP BY 1)
        USING (category) WHERE pos >= coalesce(cursor, 0)""",
)
def pg_resume(spark, sf_dir):
    urls = bridge.url_list(spark, sf_dir)
    return progress.resume(urls, urls.where(F.endswith("url", F.lit("#top"))))


@query("pg_done", f"SELECT category, pos, url FROM {_URLS} WHERE category NOT LIKE 'm.%'")
def pg_done(spark, sf_dir):
    urls = bridge.url_list(spark, sf_dir)
    finished = urls.where(F.startswith("category", F.lit("m."))).select("category").distinct()
    return progress.unfinished(urls, finished)


@query("pg_stream", f"{o.LISTING} {CLEANED}")
def pg_stream(spark, sf_dir):
    """Lands the listings in two loads with a run of the stream after each; the second run takes only new files."""
    folder = scratch_path(spark, "stream")
    landing, output, checkpoint = (f"{folder}/{name}" for name in ("landing", "cleaned", "checkpoint"))
    # Both loads read what the parts sold, which is worked out once.
    sold = written(bridge.sold_parts(spark, sf_dir), "sold-parts")
    listings = bridge.raw_listings(spark, sf_dir, "p_size", sold=sold)
    for first in (True, False):
        # A part without a size is in the second load.
        load = listings.where(F.coalesce(F.col("p_size") <= 25, F.lit(False)) == first).drop("p_size")
        writers.append_listings(load, landing)
        ingest(spark, landing, output, checkpoint).awaitTermination()
    return spark.read.parquet(output).select(*CLEANED_COLUMNS)


@query("pg_stream_distinct", f"{o.LISTING} {CLEANED}")
def pg_stream_distinct(spark, sf_dir):
    """The second load holds all listings again, and the stream is restarted for it: each listing comes out once."""
    folder = scratch_path(spark, "stream")
    landing, output, checkpoint = (f"{folder}/{name}" for name in ("landing", "cleaned", "checkpoint"))
    # What lands stays, so it is compressed; what a load or a run shuffles is of no more use behind it.
    with shuffles_dropped(spark):
        sold = written(bridge.sold_parts(spark, sf_dir), "sold-parts")
        listings = bridge.raw_listings(spark, sf_dir, "p_size", sold=sold)
        for load in (listings.where(F.coalesce(F.col("p_size") <= 25, F.lit(False))), listings):
            writers.append_listings(load.drop("p_size"), landing, "gzip")
            ingest(spark, landing, output, checkpoint, distinct=True).awaitTermination()
    return spark.read.parquet(output).select(*CLEANED_COLUMNS)


@query(
    "pg_resume_stream",
    f"""SELECT category, pos, url FROM {_URLS} LEFT JOIN
        (SELECT category, max(pos) AS cursor FROM {_URLS} WHERE url LIKE '%#top' GROUP BY 1)
        USING (category) WHERE pos >= coalesce(cursor, 0)""",
)
def pg_resume_stream(spark, sf_dir):
    """The rows of pg_resume, from cursors that a stream keeps over two loads of progress, the later positions first."""
    folder = scratch_path(spark, "cursors")
    landing, output, checkpoint = (f"{folder}/{name}" for name in ("landing", "cursors", "checkpoint"))
    urls = bridge.url_list(spark, sf_dir)
    begun = urls.where(F.endswith("url", F.lit("#top")))
    for odd in (1, 0):
        begun.where(F.col("pos") % 2 == odd).write.mode("append").json(landing)
        cursors.track(spark, landing, output, checkpoint).awaitTermination()
    return progress.resume_at(urls, cursors.latest(spark, output))


# --- sources and sinks -----------------------------------------------------------------------------------------------


@query(
    "src_csv",
    f"""{o.MODEL} SELECT name_description, first_category, second_category, third_category, shop_like_tier,
        price, num_sold FROM model""",
)
def src_csv(spark, sf_dir):
    path = scratch_path(spark, "model-csv")
    rows = model_table(clean_listings(bridge.raw_listings(spark, sf_dir)))
    columns = [f.name for f in readers.MODEL_CSV.fields]
    text = rows.fillna(0.0).select([F.col(name).cast("string") for name in columns])
    writer = text.write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_model_csv(spark, path).select(
        "name_description",
        "first_category",
        "second_category",
        "third_category",
        "shop_like_tier",
        to_double(F.col("price")).alias("price"),
        to_double(F.col("num_sold")).alias("num_sold"),
    )


@query("src_ndjson", f"{o.LISTING} {CLEANED}")
def src_ndjson(spark, sf_dir):
    path = scratch_path(spark, "listings")
    writers.append_listings(bridge.raw_listings(spark, sf_dir), path)
    return clean_listings(readers.read_listings(spark, path, "a")).select(*CLEANED_COLUMNS)


@query(
    "snk_ndjson",
    f"""{o.LISTING} SELECT lower(p_type) AS category, url, {o.RATING} AS avg_rating, {_SHIPPING} AS shipping,
        CAST(p_size AS VARCHAR) AS size FROM listing""",
)
def snk_ndjson(spark, sf_dir):
    path = scratch_path(spark, "listings")
    listings = bridge.raw_listings(spark, sf_dir, "p_type").withColumn("category", F.lower("p_type")).drop("p_type")
    writers.append_listings(listings, path)
    read = readers.read_listings(spark, path, "a", partitioned=True)
    return read.select("category", "url", "avg_rating", "shipping", F.col("attrs")["Size"].alias("size"))


@query("src_seed", f"SELECT DISTINCT category, 'https://' || category || '/' AS url FROM {_URLS}")
def src_seed(spark, sf_dir):
    path = scratch_path(spark, "seeds")
    category = F.col("category")
    seeds = bridge.url_list(spark, sf_dir).select("category").distinct()
    levels = seeds.select(
        F.regexp_extract(category, "([a-z]+)$", 1).alias("cat_1"),
        F.replace(category, F.lit("."), F.lit("-")).alias("cat_2"),
        "category",
        F.concat(F.lit("https://"), category, F.lit("/")).alias("url"),
    )
    levels.hint("rebalance", "cat_1", "cat_2").write.partitionBy("cat_1", "cat_2").json(path)
    return readers.read_seeds(spark, path, 2, "*.json").select("category", "url")


@query(
    "src_urls",
    f"""SELECT 'category=' || category AS category, url,
        CAST(row_number() OVER (PARTITION BY category ORDER BY pos) - 1 AS INTEGER) AS pos FROM {_URLS}""",
)
def src_urls(spark, sf_dir):
    path = scratch_path(spark, "url-lists")
    urls = bridge.url_list(spark, sf_dir)
    # By range, so that the lists keep their order over the files and a large one is spread over several.
    in_order = urls.repartitionByRange("category", "pos").sortWithinPartitions("category", "pos").select("category", "url")
    in_order.write.partitionBy("category").text(path)
    return readers.read_urls(spark, f"{path}/*/*.txt")


@query("snk_ndjson_runs", f"{o.LISTING} SELECT url, {o.RATING} AS avg_rating, CAST(p_size AS VARCHAR) AS size FROM listing")
def snk_ndjson_runs(spark, sf_dir):
    """Two runs of which the second is repeated, and a third that is killed before its end: each listing is there once."""
    path = scratch_path(spark, "runs")
    listings = bridge.raw_listings(spark, sf_dir, "p_size")
    small = F.coalesce(F.col("p_size") <= 25, F.lit(False))
    for run, rows in (("1", small), ("2", ~small), ("2", ~small)):
        runs.append_run(listings.where(rows).drop("p_size"), path, run)
    writers.append_listings(listings.drop("p_size"), f"{path}/{runs.DATA}/attempt=3-killed")
    read = runs.read_runs(spark, path, LISTINGS["a"])
    return read.select("url", "avg_rating", F.col("attrs")["Size"].alias("size"))


@query("snk_urls", f"SELECT category, url FROM {_URLS}")
def snk_urls(spark, sf_dir):
    path = scratch_path(spark, "urls")
    urls = bridge.url_list(spark, sf_dir)
    secure = F.startswith("url", F.lit("https:"))
    writers.append_urls(urls.where(secure), path)
    writers.append_urls(urls.where(~secure), path)
    return readers.read_url_table(spark, path)
