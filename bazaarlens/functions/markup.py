"""Column functions over landed HTML.

Flat nodes are read with patterns, which stay in the JVM. Only nodes that nest need ``nodes_by_class``: a small
tag scanner over Arrow batches that cuts out the inner HTML of each wanted node; the rest is column expressions again.
"""

from __future__ import annotations

import html as html_text
import re
import sys
from collections import Counter
from collections.abc import Mapping
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.constants import SITE_A_HOST, SIZE_TAB_WITH_VALUE
from bazaarlens.functions.characters import decoded

# Workers get the scanner below along with the query and need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HREF = r'<a\s[^>]*?href="([^"]*)"'

# --- links -----------------------------------------------------------------------------------------------------------


def item_blocks(html: Column, item_pattern: str) -> Column:
    """Markup of every item on a page."""
    return F.regexp_extract_all(html, F.lit(item_pattern), F.lit(0))


def first_href(block: Column) -> Column:
    """Target of the first anchor, null without one."""
    return F.nullif(F.regexp_extract(block, HREF, 1), F.lit(""))


def absolute_from_root(href: Column, host: str = SITE_A_HOST) -> Column:
    """``/path`` on a known host."""
    return F.concat(F.lit(host), href)


def absolute_from_scheme(href: Column) -> Column:
    """``//host/path`` without its scheme."""
    return F.concat(F.lit("https://"), F.substring(href, 3, 2**31 - 1))


# --- text of a node --------------------------------------------------------------------------------------------------

_LINE_TAGS = r"(?i)<br[^>]*>|</?(?:div|p|ul|ol|li|h[1-6]|section|article|header|footer|table|tr|form)(?:\s[^>]*)?>"


def node_text(inner_html: Column) -> Column:
    """Visible text: one line per block node, single-spaced, character references read, fixed spaces as plain ones."""
    text = F.regexp_replace(inner_html, r"\s+", " ")
    text = F.regexp_replace(text, _LINE_TAGS, "\n")
    text = F.regexp_replace(text, "<[^>]*>", "")
    text = F.btrim(F.regexp_replace(text, r"\s*\n\s*", "\n"), F.lit(" \n"))
    return F.translate(decoded(text), "\xa0", " ")


def last_line(text: Column) -> Column:
    return F.element_at(F.split(text, "\n"), -1)


def rating_strip(text: Column) -> Column:
    """Rating, review count and sold count from the strip below the name; a strip of another length tells nothing."""
    lines = F.split(text, "\n")
    full, unrated = F.size(lines) == 6, F.size(lines) == 4
    return F.struct(
        F.when(full, F.get(lines, F.lit(0))).alias("avg_rating"),
        F.when(full, F.get(lines, F.lit(1))).alias("num_review"),
        F.when(full | unrated, F.get(lines, F.lit(3))).alias("num_sold"),
    )


# --- fields and options ----------------------------------------------------------------------------------------------


def fields(html: Column, patterns: Mapping[str, str]) -> dict[str, Column]:
    """One column per named pattern (group 1), null where a page has no match."""
    return {
        name: F.when(F.rlike(html, F.lit(pattern)), F.regexp_extract(html, pattern, 1))
        for name, pattern in patterns.items()
    }


def leaf_pattern(css_class: str) -> str:
    """Pattern for the text of a node that holds no other node, found by all of its class names in order."""
    names = r"(?:\s[^\"]*)?\s".join(css_class.split())
    return rf'<[a-z0-9]+[^>]*\sclass="(?:[^"]*\s)?{names}(?:\s[^"]*)?"[^>]*>([^<]*)<'


def leaf_texts(html: Column, css_class: str) -> Column:
    """Texts of the leaf nodes with all these class names, character references read."""
    return F.transform(F.regexp_extract_all(html, F.lit(leaf_pattern(css_class)), F.lit(1)), decoded)


def texts_of_class_only(html: Column, css_class: str) -> Column:
    """Texts of the leaf nodes that carry this class name and no other."""
    found = F.regexp_extract_all(html, F.lit(rf'<[a-z0-9]+[^>]*\sclass="{css_class}"[^>]*>([^<]*)<'), F.lit(1))
    return F.transform(found, decoded)


def all_leaf_texts(html: Column) -> Column:
    """Texts of all nodes that hold text and no other node."""
    return F.transform(F.regexp_extract_all(html, F.lit(r"<[a-z0-9]+(?:\s[^>]*)?>\s*([^<>]*[^<>\s])\s*</"), F.lit(1)), decoded)


def heading(html: Column) -> Column:
    """Text of the first small heading, null without one."""
    return decoded(F.nullif(F.regexp_extract(html, r"<h6[^>]*>([^<]*)<", 1), F.lit("")))


def attr_map(entries: Column) -> Column:
    """Array of (name, value) to a map; the last of several equal names counts, as when filling a dictionary."""
    return F.aggregate(
        entries,
        F.expr("cast(map() as map<string,string>)"),
        lambda filled, e: F.map_concat(
            F.map_filter(filled, lambda name, _: name != e["name"]), F.create_map(e["name"], e["value"])
        ),
    )


def chosen_option(group: Column, name_class: str, selected_class: str) -> Column:
    """(name, value) of an option group; null value when nothing is selected."""
    return F.struct(
        F.get(leaf_texts(group, name_class), F.lit(0)).alias("name"),
        F.get(leaf_texts(group, selected_class), F.lit(0)).alias("value"),
    )


def chosen_sized_option(group: Column, tab_class: str, size_class: str, value_class: str) -> Column:
    """(name, value) where size groups show their value only on the international tab."""
    tab = F.get(leaf_texts(group, tab_class), F.lit(0))
    value = F.when(tab.isNull(), F.get(leaf_texts(group, value_class), F.lit(0))).when(
        F.btrim(tab, F.lit(" \n\t")) == SIZE_TAB_WITH_VALUE, F.get(leaf_texts(group, size_class), F.lit(0))
    )
    return F.struct(heading(group).alias("name"), value.alias("value"))


# --- nested nodes ----------------------------------------------------------------------------------------------------

# HTML elements that never have an end tag.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

# Possessive throughout: an attempt that fails ends at the next "<" outside quotes and is never tried in another way.
_TAG = re.compile(
    r"""<!--|<(?P<end>/?)(?P<name>[a-z][^\s/<>]*+)(?P<rest>(?:"[^"]*+"|'[^']*+'|[^'"<>])*+)>""", re.IGNORECASE
)
# Ends of what holds no markup.
_OPAQUE = {
    "!--": re.compile("-->"),
    "script": re.compile(r"</script\s*+>", re.IGNORECASE),
    "style": re.compile(r"</style\s*+>", re.IGNORECASE),
}
_ANCHOR = re.compile(r"""<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_CLASS = re.compile(r"""\sclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)


def cut_nodes(page: str, wanted: Mapping[str, frozenset[str]]) -> dict[str, list[str]]:
    """Inner HTML of every node that carries all class names of an entry, in page order.

    An end tag closes whatever was left open inside its node; nodes never closed run to the end of the page. One forward
    pass, so that the work grows with the page and with what is returned, whatever the markup.
    """
    found: dict[str, list[tuple[int, str]]] = {name: [] for name in wanted}
    open_nodes: list[tuple[str, int, list[str]]] = []
    open_count: Counter[str] = Counter()
    endless: set[str] = set()
    at = 0

    def close(stop: int) -> str:
        element, start, names = open_nodes.pop()
        open_count[element] -= 1
        for name in names:
            found[name].append((start, page[start:stop]))
        return element

    while tag := _TAG.search(page, at):
        at = tag.end()
        element = "!--" if tag["name"] is None else tag["name"].lower()
        if element in _OPAQUE and not tag["end"] and element not in endless:
            if end := _OPAQUE[element].search(page, at):
                at = end.end()
                continue
            endless.add(element)
        if element == "!--":
            continue
        if tag["end"]:
            if open_count[element]:
                while close(tag.start()) != element:
                    pass
            continue
        attribute = _CLASS.search(tag["rest"])
        classes = set("".join(filter(None, attribute.groups())).split()) if attribute else set()
        names = [name for name, needed in wanted.items() if needed <= classes] if classes else []
        if element not in _VOID:
            open_nodes.append((element, at, names))
            open_count[element] += 1
        else:
            for name in names:
                found[name].append((at, ""))
    while open_nodes:
        close(len(page))
    return {name: [inner for _, inner in sorted(nodes, key=itemgetter(0))] for name, nodes in found.items()}


def nodes_by_class(html: Column, classes: Mapping[str, str]) -> Column:
    """Struct with, for each name, the inner HTML of all nodes that carry the given class names, in page order.

    Marked as not deterministic so that a filter on its result never makes Spark cut the page a second time.
    """
    wanted = {name: frozenset(names.split()) for name, names in classes.items()}
    result = T.StructType([T.StructField(name, T.ArrayType(T.StringType())) for name in wanted])

    @F.pandas_udf(result)
    def cut(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([cut_nodes(page or "", wanted) for page in pages], columns=list(wanted))

    return cut.asNondeterministic()(html)


def nested_nodes(html: Column, outer: str, inner: str) -> Column:
    """For all nodes that carry the class names of ``outer``, in page order: ``node``, the inner HTML, and ``inner``, that
    of the nodes inside it which carry the class names of ``inner``. Not deterministic, as ``nodes_by_class``."""
    around, within = {"node": frozenset(outer.split())}, {"inner": frozenset(inner.split())}

    @F.pandas_udf("array<struct<node:string, inner:array<string>>>")
    def cut(pages: pd.Series) -> pd.Series:
        def nested(page: str | None) -> list[dict]:
            return [{"node": node, **cut_nodes(node, within)} for node in cut_nodes(page or "", around)["node"]]

        return pages.map(nested)

    return cut.asNondeterministic()(html)


def item_links(html: Column, item: str) -> Column:
    """The target of the first link in each node that carries the class names of ``item``, in page order and with character
    references read; null for an item without one. Nodes inside others count as well. A page's items and links are all the
    rules of a category look at, so no markup needs to go any further. Not deterministic, as ``nodes_by_class``."""
    wanted = {"item": frozenset(item.split())}

    def target(node: str) -> str | None:
        found = _ANCHOR.search(node)
        return html_text.unescape(next(filter(None, found.groups()), "")) or None if found else None

    @F.pandas_udf("array<string>")
    def scan(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: [target(node) for node in cut_nodes(page or "", wanted)["item"]])

    return scan.asNondeterministic()(html)


def option_blocks(html: Column, classes: Mapping[str, str], block: str, group: str) -> Column:
    """``nodes_by_class`` with one more field, ``groups``: the nodes with just the class names of ``group`` that are children
    of a child of the first node with the class names of ``block``; null without such a block. One scan of the page."""
    wanted = {name: frozenset(names.split()) for name, names in {**classes, "__block": block}.items()}
    exactly = group.split()
    fields = [*classes, "groups"]
    result = T.StructType([T.StructField(name, T.ArrayType(T.StringType())) for name in fields])

    def groups(blocks: list[str]) -> list[str] | None:
        if not blocks:
            return None
        inside = [inner for tag, _, inner in children(blocks[0]) if tag == "div"]
        return [node for inner in inside for tag, names, node in children(inner) if tag == "div" and names.split() == exactly]

    # Pages leave the Arrow batch one by one: what a worker holds beside it is one page and what was cut.
    @F.arrow_udf(result)
    def cut(pages: pa.Array) -> pa.Array:
        rows = []
        for page in pages:
            nodes = cut_nodes(page.as_py() or "", wanted)
            rows.append({**{name: nodes[name] for name in classes}, "groups": groups(nodes["__block"])})
        return pa.array(rows, pa.struct([(name, pa.list_(pa.string())) for name in fields]))

    return cut.asNondeterministic()(html)


def children(inner: str) -> list[tuple[str, str, str]]:
    """``(element, class, inner HTML)`` of the direct children of a node, in order."""
    found, depth, start, at = [], [], 0, 0
    first: tuple[str, str] = ("", "")
    while tag := _TAG.search(inner, at):
        at = tag.end()
        name = "!--" if tag["name"] is None else tag["name"].lower()
        if name in _OPAQUE and not tag["end"] and (end := _OPAQUE[name].search(inner, at)):
            at = end.end()
            continue
        if name == "!--":
            continue
        if tag["end"]:
            # An end tag closes whatever was left open inside its node.
            if name in depth:
                while depth.pop() != name:
                    pass
                if not depth:
                    found.append((*first, inner[start : tag.start()]))
            continue
        if not depth:
            attribute = _CLASS.search(tag["rest"])
            first = (name, next(filter(None, attribute.groups()), "") if attribute else "")
            start = at
        if name not in _VOID:
            depth.append(name)
        elif not depth:
            found.append((*first, ""))
    if depth:
        found.append((*first, inner[start:]))
    return found


def nested_children(html: Column, outer: str, inner: str) -> Column:
    """For all nodes with the class names of ``outer``: ``node``, the inner HTML, and ``lists``, for each node inside it with
    those of ``inner`` the inner HTML of its direct children, whatever they hold. Not deterministic, as ``nodes_by_class``."""
    around, within = {"node": frozenset(outer.split())}, {"inner": frozenset(inner.split())}

    @F.pandas_udf("array<struct<node:string, lists:array<array<string>>>>")
    def cut(pages: pd.Series) -> pd.Series:
        def nested(page: str | None) -> list[dict]:
            nodes = cut_nodes(page or "", around)["node"]
            return [{"node": n, "lists": [[c for _, _, c in children(x)] for x in cut_nodes(n, within)["inner"]]} for n in nodes]

        return pages.map(nested)

    return cut.asNondeterministic()(html)
