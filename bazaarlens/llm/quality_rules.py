"""Quality rules as a ledger of measurements and failure bits, with policies applied to the bits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.base import SPACES, WORD, text_of

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A rule fails where the SQL condition over the measurements holds. Its place in ``RULES`` is its bit; rules are only
    ever added at the end, so that stored ledgers keep their meaning."""

    name: str
    fails: str


RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("odd_word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("long_words", "longest_word > 1000"),
)
BASE = ("few_words", "repeated_words")

# Versions of the policy: the rules a document has to pass.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "many_symbols"),
    "v2": (*BASE, "many_symbols", "repeated_lines", "odd_word_length", "long_words"),
}
CURRENT = "v2"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "longest_word")

# Each step takes an array of the one array before: words, window hashes, hashes with places, repeated places, their cover.
_WINDOWS = (
    "transform(array(__words), w -> if(size(w) < 4, cast(array() AS array<bigint>),"
    " transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))))"
)
# Most texts repeat no window: only the others are sorted.
_SORTED = (
    f"transform({_WINDOWS}, h -> if(size(array_distinct(h)) = size(h), cast(array() AS array<struct<h:bigint,i:int>>),"
    " array_sort(transform(h, (x, i) -> struct(x AS h, i AS i)))))"
)
_PLACES = (
    f"transform({_SORTED}, s -> array_sort(transform(filter(s, (e, i) ->"
    " (i > 0 AND get(s, i - 1).h = e.h) OR coalesce(get(s, i + 1).h = e.h, false)), e -> e.i)))"
)
REPEAT_WORDS = (
    f"transform({_PLACES}, p -> aggregate(transform(p, (x, i) ->"
    " least(3, coalesce(get(p, i + 1) - x, 3))), 0L, (a, b) -> a + b))[0]"
)


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with all ``MEASURES``, each worked out once, inside the row.

    For repeated words, the hashes of all three-word windows are sorted with their places; a place counts if the hash
    before or after is the same, and covers its three words or as many as lie before the next such place.

    Steps of that are bound by lambdas rather than columns. A filter on a measurement or on bits is moved below the
    projections and takes their expressions along; a step that is a column would then be worked out again for every element
    of the next one.
    """
    value = text_of(text)
    added = docs.drop(*MEASURES).withColumn("__words", F.regexp_extract_all(value, F.lit(WORD), F.lit(0)))
    added = added.withColumn("__lines", F.filter(F.split(value, "\n"), lambda line: _without(line, SPACES) != ""))
    return added.withColumns(
        {
            "n_words": F.size("__words").cast("bigint"),
            "word_chars": F.length(_without(value, SPACES)).cast("bigint"),
            "n_symbols": (F.length(value) - F.length(_without(value, SYMBOLS))).cast("bigint"),
            "n_lines": F.size("__lines").cast("bigint"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
            "n_repeat_words": F.expr(REPEAT_WORDS),
            "longest_word": F.coalesce(F.array_max(F.transform("__words", F.length)), F.lit(0)).cast("bigint"),
        }
    ).drop("__words", "__lines")


def ledger(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with their measurements and ``fail_bits``, bit i for the i-th rule. Store it without the text: policies and
    ablations need nothing else.

    A null text counts as empty; an empty text has no words, lines or symbols and fails ``few_words``. Columns named like a
    measurement are replaced; all others pass through. Repeated rows are measured each.
    """
    measured = measure(docs.drop("fail_bits"), text)
    bits = [F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, rule in enumerate(rules)]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured.withColumn("fail_bits", total)


def mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    places = {rule.name: 1 << i for i, rule in enumerate(rules)}
    return sum(places[name] for name in set(names))


def fails(policy: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a ledger row fails any rule of a policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy, rules))) != 0


def ablation(rows: DataFrame, policies: dict[str, tuple[str, ...]] = POLICIES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each policy and rule of it: documents that fail the rule, and those that would be kept without it.

    Ledger rows are counted by their bits first, so what is compared with the policies is a row for each set of failures,
    however many documents there are.
    """
    counted = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    entries = [
        F.struct(F.lit(name).alias("policy"), F.lit(rule).alias("rule"), F.lit(mask((rule,), rules)).cast("bigint").alias("bit"),
                 F.lit(mask(policy, rules)).cast("bigint").alias("mask"))
        for name, policy in policies.items()
        for rule in policy
    ]
    each = counted.select("fail_bits", "n", F.explode(F.array(*entries)).alias("e")).select("fail_bits", "n", "e.*")
    failed = F.col("fail_bits").bitwiseAND(F.col("bit")) != 0
    alone = F.col("fail_bits").bitwiseAND(F.col("mask")) == F.col("bit")
    return each.groupBy("policy", "rule").agg(
        F.sum(F.when(failed, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("failed_alone"),
        F.sum("n").alias("documents"),
    )
