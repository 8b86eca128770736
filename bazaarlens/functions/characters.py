"""Characters written in other ways: letters with separate marks, and character references of HTML.

Both cut a text at what they look for, look each piece up in a table once, and put the text together again. Texts with
nothing to look for are passed on after one test.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache
from html.entities import html5
from itertools import permutations

from pyspark.sql import Column
from pyspark.sql import functions as F

MARKS = r"\x{300}-\x{36F}"
# Blocks of Latin letters that are made of a base letter and marks, Vietnamese ones among them.
LATIN = (range(0xC0, 0x250), range(0x1E00, 0x1F00))

NUMBER, NAME = r"#(?:[xX][0-9a-fA-F]+|[0-9]+)", r"[A-Za-z][A-Za-z0-9]*"
UNKNOWN = "�"


def _table(entries: dict[str, str]) -> Column:
    """A map as one value: Spark reads it once, when it plans."""
    return F.from_json(F.lit(json.dumps(entries)), "map<string,string>")


def _exchanged(text: Column, pattern: str, exchange: Callable[[Column], Column]) -> Column:
    """The text with every match of a pattern exchanged, in one pass: what comes in is not looked at again."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), exchange)
    woven = F.zip_with(F.split(text, pattern, -1), found, lambda part, new: F.concat(part, F.coalesce(new, F.lit(""))))
    return F.when(F.rlike(text, F.lit(pattern)), F.array_join(woven, "")).otherwise(text)


# --- letters and marks -----------------------------------------------------------------------------------------------


def _spellings(letter: str) -> Iterable[str]:
    """All ways to write a letter as another letter and marks, in any order of the marks that means the same."""
    base, *marks = unicodedata.normalize("NFD", letter)
    for order in permutations(marks):
        for n in range(len(marks)):
            start = unicodedata.normalize("NFC", base + "".join(order[:n]))
            spelling = start + "".join(order[n:])
            if len(start) == 1 and unicodedata.normalize("NFC", spelling) == letter:
                yield spelling


@lru_cache(maxsize=1)
def compositions() -> dict[str, str]:
    letters = (chr(point) for block in LATIN for point in block)
    return {spelling: letter for letter in letters if unicodedata.decomposition(letter) for spelling in _spellings(letter)}


def composed(text: Column) -> Column:
    """Latin letters with separate marks as single characters (NFC). Letters that have no such character keep their marks."""
    table = _table(compositions())

    def single(cluster: Column) -> Column:
        # The longest part of a cluster that is a letter; further marks stay behind it.
        lengths = range(4, 1, -1)
        tried = [F.concat(F.try_element_at(table, F.substring(cluster, 1, n)), F.substring(cluster, n + 1, 1_000)) for n in lengths]
        return F.coalesce(*tried, cluster)

    return _exchanged(text, rf"[\p{{IsLatin}}][{MARKS}]+", single)


# --- character references --------------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def reference_names() -> tuple[dict[str, str], tuple[str, ...]]:
    """Characters by name, and the names that count without a semicolon too, long ones first."""
    named = {name.removesuffix(";"): characters for name, characters in html5.items()}
    bare = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
    return named, tuple(bare)


@lru_cache(maxsize=1)
def _odd_numbers() -> dict[str, str]:
    """Numbers that stand for another character: those of the Windows code page, and zero."""
    odd = {"0": UNKNOWN}
    for number in range(0x80, 0xA0):
        odd[str(number)] = bytes([number]).decode("cp1252", "ignore") or chr(number)
    return odd


def decoded(text: Column) -> Column:
    """Character references of HTML read, by name or number, in one pass: ``&amp;lt;`` gives ``&lt;``.

    The longest name counts. A few old names count without a semicolon, so ``&copy2`` has a name and a digit. Numbers that are
    no character give a replacement sign; other ampersands stay.
    """
    names, bare = reference_names()
    table, odd = _table(names), _table(_odd_numbers())
    old_name = "^(" + "|".join(bare) + ")(.*)$"

    def by_number(reference: Column) -> Column:
        is_hex = F.rlike(reference, F.lit("^&#[xX]"))
        digits = F.regexp_replace(reference, r"^&#[xX]?0*|;$", "")
        # More digits than this are beyond all characters.
        short = F.when(F.length(digits) <= 7, F.concat(F.lit("0"), digits))
        number = F.when(is_hex, F.conv(short, 16, 10)).otherwise(F.conv(short, 10, 10)).cast("int")
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        character = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        return F.coalesce(F.try_element_at(odd, number.cast("string")), F.when(valid, character), F.lit(UNKNOWN))

    def by_name(reference: Column) -> Column:
        name = F.regexp_replace(reference, "^&|;$", "")
        whole = F.when(F.endswith(reference, F.lit(";")), F.try_element_at(table, name))
        rest = F.substring(reference, 2, 1_000)
        start = F.nullif(F.regexp_extract(rest, old_name, 1), F.lit(""))
        partly = F.concat(F.try_element_at(table, start), F.regexp_extract(rest, old_name, 2))
        return F.coalesce(whole, partly, reference)

    def read(reference: Column) -> Column:
        return F.when(F.startswith(reference, F.lit("&#")), by_number(reference)).otherwise(by_name(reference))

    return _exchanged(text, f"&(?:{NUMBER}|{NAME});?", read)
