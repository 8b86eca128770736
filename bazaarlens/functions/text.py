"""Column functions over listing text: names, option text, shipping, and the description block.

Plain substitutions use ``replace``, which works on the bytes of the string; patterns are kept for what needs them.
Text is expected in composed Unicode form (NFC); ``characters.composed`` brings it there.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarlens.constants import (
    BREADCRUMB_ROOT,
    DESCRIPTION_MARKER,
    LABEL_BRAND,
    LABEL_COUNTRY,
    LABEL_ORIGIN,
    LABEL_STOCK,
    SLASHED_CATEGORIES,
    TIER_BASIC,
    VIETNAMESE_LETTERS,
)


def _char_class(letters: str) -> str:
    """Body of a character class, with neighbouring code points as ranges: a class of a few ranges is tested much faster
    than one of over a hundred single letters."""
    points = sorted({ord(letter) for letter in letters})
    runs: list[list[int]] = []
    for point in points:
        if runs and point == runs[-1][1] + 1:
            runs[-1][1] = point
        else:
            runs.append([point, point])
    return "".join(re.escape(chr(low)) if low == high else f"{chr(low)}-{chr(high)}" for low, high in runs)


def special_pattern(extra_letters: str = "") -> str:
    """Pattern for a run of characters that are no letter, digit, underscore or space.

    A class of many ranges is tested range by range. Looking ahead with a short class spares plain letters that.
    """
    letters = VIETNAMESE_LETTERS + VIETNAMESE_LETTERS.upper() + extra_letters
    return f"(?=[^\\w ])[^a-zA-Z0-9_ {_char_class(letters)}]+"


SPECIAL = special_pattern()

# How description markup is flattened. Order matters, since each step feeds the next.
# (kind, what, replacement); "literal" is plain text, "pattern" a regular expression. Patterns look at the first character
# before they try alternatives, and take what lies before a sign in one go.
_TO_BRACKET = r"[^>\n\r\x{85}\x{2028}\x{2029}]*+>"
MARKUP_STEPS = (
    ("literal", " &amp;", ","),
    ("pattern", f'(?=[<dc" ])(?:<svg.*?</svg>|<div>|div|class=|"|<label{_TO_BRACKET}|<flex{_TO_BRACKET}| href=/)', ""),
    ("literal", "</a>", "-"),
    ("literal", "</label>", ": "),
    ("literal", "< ", "<"),
    ("pattern", f"/{_TO_BRACKET}", "/>"),
    ("literal", "<a ", "<"),
    ("literal", "<p ", "<"),
    ("pattern", " {2,}", " "),
    ("literal", "</>", "/"),
    ("pattern", f"<{_TO_BRACKET}", ""),
)


def blank_special(text: Column, extra_letters: str = "") -> Column:
    return F.regexp_replace(text, special_pattern(extra_letters), " ")


def product_name(text: Column, extra_letters: str = "") -> Column:
    """Lower-case name without tier line, bracketed promotion or special characters, single-spaced."""
    tier = TIER_BASIC.lower()
    untagged = F.regexp_replace(F.lower(text), rf"{tier}\n|{tier}\+\n", " ")
    unbracketed = F.regexp_replace(untagged, r"\[.*?\]", " ")
    return F.trim(F.regexp_replace(blank_special(unbracketed, extra_letters), " {2,}", " "))


def option_text(text: Column, extra_letters: str = "") -> Column:
    """Lower-case option text; runs of spaces inside are left as they are."""
    return F.trim(blank_special(F.lower(text), extra_letters))


def shipping_fee(text: Column) -> Column:
    """First amount of a shipping line, as text; empty when it names none."""
    return F.regexp_extract(F.regexp_replace(F.lower(text), SPECIAL, ""), r"\d+", 0)


def flatten_markup(html: Column, fix_slash_categories: bool = False) -> Column:
    """Description markup to one line of ``label: value/`` pairs.

    ``fix_slash_categories`` also rewrites category names that hold a slash, which otherwise cuts the breadcrumb short.
    """
    steps = list(MARKUP_STEPS)
    if fix_slash_categories:
        steps = [("literal", old.lower(), new.lower()) for old, new in SLASHED_CATEGORIES] + steps

    def apply(text: Column, step: tuple[str, str, str]) -> Column:
        kind, what, replacement = step
        if kind == "literal":
            return F.replace(text, F.lit(what), F.lit(replacement))
        return F.regexp_replace(text, what, replacement)

    return reduce(apply, steps, F.lower(html))


def before_marker(flat: Column) -> Column:
    """Flattened description without the free text that follows the marker on its line."""
    return F.regexp_replace(flat, f"{DESCRIPTION_MARKER}(.*)", "")


def _value(head: Column, label: str, end: str) -> Column:
    return F.regexp_extract(head, f"{label}: (.+?){end}", 1)


# The four below read the output of ``before_marker``.
def country(head: Column) -> Column:
    return blank_special(_value(head, LABEL_COUNTRY, "/"))


def brand(head: Column) -> Column:
    return blank_special(_value(head, LABEL_BRAND, "-/"))


def stock(head: Column) -> Column:
    return blank_special(_value(head, LABEL_STOCK, "/"))


def origin(head: Column) -> Column:
    return _value(head, LABEL_ORIGIN, "/")


def first_category(flat: Column) -> Column:
    return F.regexp_extract(flat, f"{BREADCRUMB_ROOT}-(.+?)-", 1)


def category_path(flat: Column, depth: int) -> Column:
    """The first ``depth`` levels of the breadcrumb, or ``no`` when it is not that deep."""
    levels = F.split(F.regexp_extract(flat, f"{BREADCRUMB_ROOT}-(.+)-//", 1), "-")
    return F.when(F.size(levels) >= depth, F.concat_ws(" / ", F.slice(levels, 1, depth))).otherwise("no")


def free_text(flat: Column, extra_letters: str = "") -> Column:
    """What follows the marker on its line."""
    return blank_special(F.regexp_extract(flat, f"{DESCRIPTION_MARKER}(.*)", 1), extra_letters)
