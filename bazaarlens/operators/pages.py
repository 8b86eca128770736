"""Landed pages to listing URLs, records and variants.

Input pages are rows of ``(category, page_no, url, html)``. A category may hold a large share of all pages, so nothing here
sorts or collects a whole category: stop points are aggregates, and the previous page is found within blocks of pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.constants import PAGES_PER_CATEGORY, SITE_A_CLASSES, SITE_B_CLASSES, SIZE_TAB_WITH_VALUE
from bazaarlens.functions import markup
from bazaarlens.schemas import REQUIRED, REQUIRED_NODES
from bazaarlens.session import written

# Page numbers that may share a task: some megabytes of keys and URLs, and a short table of blocks even for a huge category.
BLOCK = 100_000
# Categories whose stop points go to every task: some megabytes.
MOST_CATEGORIES = 100_000
# Variant numbers made at once.
STRETCH = 10_000

# --- which pages count -----------------------------------------------------------------------------------------------


def complete_pages(pages: DataFrame, item_pattern: str, link_pattern: str) -> DataFrame:
    """Pages on which there are as many links as items; others yield no URLs at all."""
    return pages.where(
        F.regexp_count("html", F.lit(item_pattern)) == F.regexp_count("html", F.lit(link_pattern))
    )


def _small(per_category: DataFrame, name: str) -> DataFrame:
    """A table of one narrow row per category, written down and marked for broadcast if it is small enough; pages then meet
    it where they are read. With more categories it is a plain join side."""
    rows = written(per_category, name)
    return F.broadcast(rows) if rows.count() <= MOST_CATEGORIES else rows


def _before(pages: DataFrame, stops: DataFrame) -> DataFrame:
    """Pages ahead of their category's stop. A page without a number comes first of all, and is never a stop."""
    stops = _small(stops.groupBy(F.col("category").alias("__category")).agg(F.min("page_no").alias("__stop")), "stops")
    kept = pages.join(stops, F.col("category").eqNullSafe(F.col("__category")), "left")
    ahead = F.col("__stop").isNull() | F.col("page_no").isNull() | (F.col("page_no") < F.col("__stop"))
    return kept.where(ahead).drop("__category", "__stop")


def before_stop(pages: DataFrame, stop: Column) -> DataFrame:
    """Pages of each category before its first page for which ``stop`` holds.

    The stop page is one ``min`` per category, combined before the shuffle, so a large category costs no more than others,
    and page content is never shuffled.
    """
    return _before(pages, pages.where(stop).select("category", "page_no"))


def before_empty(pages: DataFrame, item_pattern: str) -> DataFrame:
    """A page without items ends its category."""
    return before_stop(pages, F.regexp_count("html", F.lit(item_pattern)) == 0)


def with_previous_url(pages: DataFrame, block: int = BLOCK) -> DataFrame:
    """Adds ``previous_url``: the URL of the page before in the same category.

    Pages are grouped by category and block of page numbers, so no task holds more than one block. The first page of a
    block looks up the last page of the block before it, from a table of one narrow row per block.
    """
    numbered = pages.withColumn("__block", F.floor(F.col("page_no") / block))
    within = Window.partitionBy("category", "__block").orderBy("page_no")
    across = Window.partitionBy("category").orderBy("__block")
    last_of_block = (
        pages.select("category", "page_no", "url")
        .groupBy("category", F.floor(F.col("page_no") / block).alias("__block"))
        .agg(F.max_by("url", "page_no").alias("__last"))
        .select(
            F.col("category").alias("__category"),
            F.col("__block").alias("__this"),
            F.lag("__last").over(across).alias("__before"),
        )
    )
    same = F.col("category").eqNullSafe(F.col("__category")) & (F.col("__block") == F.col("__this"))
    return (
        numbered.withColumn("__lag", F.lag("url").over(within))
        .join(last_of_block, same, "left")
        .withColumn("previous_url", F.coalesce("__lag", "__before"))
        .drop("__block", "__lag", "__category", "__this", "__before")
    )


def before_repeat(pages: DataFrame, block: int = BLOCK) -> DataFrame:
    """A page with the URL of the page before it ends its category.

    The repeats are found on the keys alone; page content only meets the stop points.
    """
    keys = with_previous_url(pages.select("category", "page_no", "url"), block)
    return _before(pages, keys.where(F.col("url") == F.col("previous_url")).select("category", "page_no"))


def first_pages(pages: DataFrame, count: int = PAGES_PER_CATEGORY, block: int = BLOCK) -> DataFrame:
    """The first ``count`` pages of each category; pages landed more than once under one number count once, and all stay.

    Numbers are ranked apart from the pages: within blocks, moved up by the numbers ahead of the block. Pages meet the
    last number kept. A page without a number comes first.
    """
    numbers = pages.select("category", "page_no").distinct().withColumn("__block", F.floor(F.col("page_no") / block))
    sizes = numbers.groupBy("category", "__block").agg(F.count("*").alias("__rows"))
    ahead = Window.partitionBy("category").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("category").alias("__category"),
        F.col("__block").alias("__this"),
        F.coalesce(F.sum("__rows").over(ahead), F.lit(0)).alias("__ahead"),
    ).where(F.col("__ahead") < count)
    same = F.col("category").eqNullSafe(F.col("__category")) & F.col("__block").eqNullSafe(F.col("__this"))
    ranked = numbers.join(offsets, same).withColumn(
        "__rank", F.row_number().over(Window.partitionBy("__category", "__this").orderBy("page_no")) + F.col("__ahead")
    )
    last = ranked.where(F.col("__rank") <= count).groupBy("__category").agg(F.max("page_no").alias("__last"))
    kept = pages.join(_small(last, "last-pages"), F.col("category").eqNullSafe(F.col("__category")))
    return kept.where(F.col("page_no").isNull() | (F.col("page_no") <= F.col("__last"))).drop("__category", "__last")


# --- URLs ------------------------------------------------------------------------------------------------------------


def links(pages: DataFrame, item_pattern: str, blocks: Column | None = None) -> DataFrame:
    """One row per item with the target of its first anchor and its place on the page; repeats are kept."""
    items = markup.item_blocks(F.col("html"), item_pattern) if blocks is None else blocks
    keys = [c for c in pages.columns if c != "html"]
    return pages.select(*keys, F.posexplode(items).alias("pos", "__item")).select(
        *keys, "pos", markup.first_href(F.col("__item")).alias("href")
    )


def listing_urls(
    pages: DataFrame,
    site: str,
    item_pattern: str,
    link_pattern: str = markup.HREF,
    page_count: int | None = None,
) -> DataFrame:
    """Category pages to ``(category, page_no, pos, url)`` under the rules of a site.

    Site A stops at a repeated page and skips incomplete pages; site B stops at an empty page. ``page_count`` keeps only so
    many pages of each category.
    """

    def capped(visited: DataFrame) -> DataFrame:
        return visited if page_count is None else first_pages(visited, page_count)

    if site == "a":
        visited = capped(before_repeat(pages))
        found = links(complete_pages(visited, item_pattern, link_pattern), item_pattern)
        url = markup.absolute_from_root(F.col("href"))
    elif site == "b":
        found = links(capped(before_empty(pages, item_pattern)), item_pattern)
        url = markup.absolute_from_scheme(F.col("href"))
    else:
        raise ValueError(f"unknown site {site!r}")
    return found.select("category", "page_no", "pos", url.alias("url"))


def item_rows(pages: DataFrame, site: str) -> DataFrame:
    """Narrow rows ``(category, page_no, url, targets)`` of category pages: the target of the first link of each item, null for
    an item without one. Items are known by their site's class name, and may hold any markup."""
    css = {"a": SITE_A_CLASSES, "b": SITE_B_CLASSES}[site]
    return pages.select("category", "page_no", "url", markup.item_links(F.col("html"), css["item"]).alias("targets"))


def listing_urls_by_class(pages: DataFrame, site: str, page_count: int | None = None) -> DataFrame:
    """``listing_urls`` with items by class name: pages are scanned once, and the rules of the site work on what was found.

    The narrow rows are written down, as several rules read them; no markup is shuffled or read again.
    """
    found = written(item_rows(pages, site), "page-items")

    def capped(visited: DataFrame) -> DataFrame:
        return visited if page_count is None else first_pages(visited, page_count)

    if site == "a":
        visited = capped(before_repeat(found))
        visited, url = visited.where(F.forall("targets", lambda t: t.isNotNull())), markup.absolute_from_root(F.col("href"))
    else:
        visited = capped(before_stop(found, F.size("targets") == 0))
        url = markup.absolute_from_scheme(F.col("href"))
    rows = visited.select("category", "page_no", F.posexplode("targets").alias("pos", "href"))
    return rows.select("category", "page_no", "pos", url.alias("url"))


# --- records ---------------------------------------------------------------------------------------------------------


def variants(
    listings: DataFrame,
    groups: str = "groups",
    skip_empty_groups: bool = False,
    output: str = "attrs",
    chosen: str | None = None,
) -> DataFrame:
    """One row per combination of options, the last group changing fastest, numbered by ``variant_no``.

    A listing without groups gives one row. A group without options gives none, or is left out with
    ``skip_empty_groups``. Each row works its options out from its number, so no list
    of combinations is ever built. ``chosen`` names a map of what the page shows as chosen: each variant starts from it,
    so groups that offer nothing keep their value.
    """
    used = F.col(groups)
    if skip_empty_groups:
        used = F.filter(used, lambda g: F.size(g["options"]) > 0)
    used = F.coalesce(used, F.expr("cast(array() as array<struct<name:string, options:array<string>>>)"))
    sized = listings.withColumn("__groups", used).withColumn(
        "__total", F.aggregate("__groups", F.lit(1).cast("bigint"), lambda n, g: n * F.size(g["options"]))
    )
    # Numbers come in stretches, so that no row holds all of them.
    stretched = sized.where(F.col("__total") > 0).withColumn(
        "__from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__total") - 1, F.lit(STRETCH).cast("bigint")))
    )
    until = F.least(F.col("__from") + STRETCH, F.col("__total")) - 1
    numbered = stretched.withColumn("variant_no", F.explode(F.sequence("__from", until))).drop("__from")

    def option(group: Column, index: Column) -> Column:
        behind = F.slice(F.col("__groups"), index + 2, F.size("__groups"))
        stride = F.aggregate(behind, F.lit(1).cast("bigint"), lambda n, g: n * F.size(g["options"]))
        count = F.size(group["options"])
        place = (F.floor(F.col("variant_no") / stride) % count).cast("int")
        return F.struct(group["name"].alias("name"), F.get(group["options"], place).alias("value"))

    taken = F.transform("__groups", option)
    if chosen is not None:
        shown = F.coalesce(F.map_entries(chosen), F.expr("cast(array() as array<struct<key:string, value:string>>)"))
        named = F.transform(shown, lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value")))
        taken = F.concat(named, taken)
    return numbered.withColumn(output, markup.attr_map(taken)).drop("__groups", "__total")


def site_a_options(pages: DataFrame) -> DataFrame:
    """Landed listing pages of site A to ``(url, groups, chosen)``, the input of ``variants``.

    Option groups are those inside the option block. Options to choose are those whose button has no state of its own: the
    chosen one and sold-out ones do not count. ``chosen`` is the map of all groups as the page shows them.
    """
    css = SITE_A_CLASSES
    nodes = markup.option_blocks(F.col("html"), {}, css["option_block"], css["option_group"])
    return pages.select("url", nodes.alias("node")).select(
        "url", _groups_a().alias("groups"), _chosen_a(F.col("node")["groups"]).alias("chosen")
    )


def _groups_a() -> Column:
    css = SITE_A_CLASSES
    groups = F.transform(
        F.col("node")["groups"],
        lambda group: F.struct(
            F.get(markup.leaf_texts(group, css["option_name"]), F.lit(0)).alias("name"),
            markup.texts_of_class_only(group, css["option_value"]).alias("options"),
        ),
    )
    return _named(groups)


def site_b_options(pages: DataFrame) -> DataFrame:
    """Landed listing pages of site B to ``(url, groups, chosen)``: every direct child of the list of an option group is an
    option, whatever nodes it holds, if it shows any text.

    Lists are cut inside their own group; a group without one offers no choice and is only in ``chosen``. Sizes on
    another tab than the international one have no value, as in records, but still count as options.
    """
    css = SITE_B_CLASSES
    nested = markup.nested_children(F.col("html"), css["option_group"], css["option_values"])
    return pages.select("url", nested.alias("options")).select(
        "url", _groups_b().alias("groups"), _chosen_b(F.transform("options", lambda group: group["node"])).alias("chosen")
    )


def _groups_b() -> Column:
    css = SITE_B_CLASSES

    def listed(group: Column) -> Column:
        tab = F.get(markup.leaf_texts(group["node"], css["size_tab"]), F.lit(0))
        hidden = tab.isNotNull() & (F.btrim(tab, F.lit(" \n\t")) != SIZE_TAB_WITH_VALUE)
        name = markup.heading(group["node"])

        def offered(options: Column) -> Column:
            shown = F.filter(F.transform(options, markup.node_text), lambda text: text != "")
            return F.transform(shown, lambda text: F.when(~hidden, text))

        return F.transform(group["lists"], lambda options: F.struct(name.alias("name"), offered(options).alias("options")))

    return _named(F.flatten(F.transform("options", listed)))


def required_only(records: DataFrame, site: str) -> DataFrame:
    """Drops records that lack a field their site's records cannot be without."""
    return records.dropna(subset=list(REQUIRED[site]))


def _cut(pages: DataFrame, keys: tuple[str, ...], css: dict[str, str], names: tuple[str, ...], site: str) -> DataFrame:
    """The wanted nodes of each page that has all nodes its site's records cannot be without."""
    nodes = markup.nodes_by_class(F.col("html"), {name: css[name] for name in names})
    cut = pages.select(*keys, nodes.alias("node"))
    return _complete(cut, site)


def _complete(cut: DataFrame, site: str) -> DataFrame:
    for name in REQUIRED[site] + REQUIRED_NODES[site]:
        cut = cut.where(F.coalesce(F.size(F.col("node")[name]), F.lit(0)) > 0)
    return cut


def _first(name: str) -> Column:
    return F.get(F.col("node")[name], F.lit(0))


def _text(name: str) -> Column:
    return markup.node_text(_first(name))


def _named(options: Column) -> Column:
    return F.filter(options, lambda option: option["name"].isNotNull())


def _chosen_a(groups: Column) -> Column:
    css = SITE_A_CLASSES
    groups = F.coalesce(groups, F.array().cast("array<string>"))
    options = F.transform(groups, lambda group: markup.chosen_option(group, css["option_name"], css["option_selected"]))
    return markup.attr_map(_named(options))


def _chosen_b(groups: Column) -> Column:
    css = SITE_B_CLASSES
    options = F.transform(
        groups, lambda group: markup.chosen_sized_option(group, css["size_tab"], css["size_value"], css["option_value"])
    )
    return markup.attr_map(_named(options))


def _records_a(cut: DataFrame, *more: Column) -> DataFrame:
    return cut.withColumn("strip", _text("rating_strip")).select(
        _text("product_name").alias("product_name"),
        markup.last_line(_text("shipping_block")).alias("shipping"),
        _text("shop_info").alias("shop_info"),
        _text("price").alias("price"),
        _first("product_desc").alias("product_desc"),
        *[markup.rating_strip(F.col("strip"))[n].alias(n) for n in ("avg_rating", "num_review", "num_sold")],
        _chosen_a(F.col("node")["groups"]).alias("attrs"),
        "url",
        *more,
    )


def _cut_a(pages: DataFrame) -> DataFrame:
    """The nodes of whole listing pages of site A, from one scan of each page."""
    css = SITE_A_CLASSES
    names = ("product_name", "price", "rating_strip", "shipping_block", "product_desc", "shop_info")
    nodes = markup.option_blocks(F.col("html"), {name: css[name] for name in names}, css["option_block"], css["option_group"])
    return _complete(pages.select("url", nodes.alias("node")), "a")


def site_a_records(pages: DataFrame) -> DataFrame:
    """Landed listing pages ``(url, html)`` of site A to raw listings. Pages without a required field or a rating strip give
    none; those without an option block give a record without options."""
    return _records_a(_cut_a(pages))


def site_a_variants(pages: DataFrame) -> DataFrame:
    """Landed listing pages of site A to raw listings, one for each variant, numbered by ``variant_no``: the whole record with
    the options of the variant. From one scan of each page."""
    records = _records_a(_cut_a(pages), _groups_a().alias("groups"))
    return variants(records.withColumnRenamed("attrs", "chosen"), skip_empty_groups=True, chosen="chosen").drop("groups", "chosen")


def _records_b(pages: DataFrame, *more: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    css = SITE_B_CLASSES
    names = (
        "product_name", "brand_name", "num_review", "price", "avg_rating", "option_group", "product_desc", "shop_info",
    )
    description = F.concat(F.lit(f'<div class="{css["product_desc"]}">'), _first("product_desc"), F.lit("</div>"))
    return _cut(pages, ("category", "url", *keep), css, names, "b").select(
        *[_text(name).alias(name) for name in ("product_name", "shop_info", "price", "brand_name", "num_review")],
        _chosen_b(F.col("node")["option_group"]).alias("attrs"),
        description.alias("product_desc"),
        _text("avg_rating").alias("avg_rating"),
        "category",
        "url",
        *more,
    )


def site_b_records(pages: DataFrame) -> DataFrame:
    """Landed listing pages ``(category, url, html)`` of site B to raw listings, likewise."""
    return _records_b(pages)


def site_b_variants(pages: DataFrame) -> DataFrame:
    """Landed listing pages of site B to raw listings, one for each variant; see ``site_a_variants``. A group that offers nothing
    gives no variant."""
    css = SITE_B_CLASSES
    nested = markup.nested_children(F.col("html"), css["option_group"], css["option_values"])
    scanned = pages.withColumn("options", nested)
    records = _records_b(scanned, _groups_b().alias("groups"), keep=("options",))
    return variants(records.withColumnRenamed("attrs", "chosen"), chosen="chosen").drop("groups", "chosen")
