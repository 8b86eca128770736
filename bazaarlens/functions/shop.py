"""Column functions over the shop panel: a label line followed by a value line, in the site's own casing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarlens.constants import (
    PANEL_FOLLOWERS,
    PANEL_JOINED,
    PANEL_REPLY_RATE,
    PANEL_REPLY_TIME,
    PANEL_REVIEWS,
    TIER_BASIC,
    TIER_PLUS,
    UNIT_MONTH,
    UNIT_YEAR,
)
from bazaarlens.functions.numbers import k_int


def _line_after(panel: Column, label: str, closed: bool = True) -> Column:
    """The line below a label; ``closed`` asks for a line break behind it."""
    return F.regexp_extract(panel, f"{label}\n(.+)" + ("\n" if closed else ""), 1)


def shop_name(panel: Column) -> Column:
    untagged = F.regexp_replace(panel, rf"{TIER_BASIC}\n|{TIER_BASIC}\+\n", "")
    return F.regexp_extract(untagged, "(.+?)\n", 1)


def like_tier(panel: Column) -> Column:
    """2 and 1 for the two like tiers, 0 without one (also for a missing panel)."""
    return (
        F.when(F.startswith(panel, F.lit(TIER_PLUS + "\n")), 2)
        .when(F.startswith(panel, F.lit(TIER_BASIC + "\n")), 1)
        .otherwise(0)
    )


def review_count(panel: Column) -> Column:
    return k_int(_line_after(panel, PANEL_REVIEWS))


def reply_rate(panel: Column) -> Column:
    """Share of messages answered. Goes through float, so 33.3% keeps the float's digits."""
    percent = F.replace(_line_after(panel, PANEL_REPLY_RATE), F.lit("%"), F.lit(""))
    return percent.try_cast("float") / 100


def reply_time(panel: Column) -> Column:
    return _line_after(panel, PANEL_REPLY_TIME)


def age_months(panel: Column) -> Column:
    """Whole months since joining; 0 for days or no such line, null for a unit without a number."""
    joined = _line_after(panel, PANEL_JOINED)
    amount = F.regexp_extract(joined, r"\d+", 0).try_cast("int")
    return (
        F.when(F.contains(joined, F.lit(UNIT_YEAR)), F.try_multiply(amount, F.lit(12)))
        .when(F.contains(joined, F.lit(UNIT_MONTH)), amount)
        .otherwise(0)
    )


def follower_count(panel: Column) -> Column:
    return k_int(_line_after(panel, PANEL_FOLLOWERS, closed=False))
