"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one long with
bit i set where rule i fails; policies are versioned masks over those bits, so a new policy, or
the effect of leaving a rule out, costs bit operations on the ledger and no pass over the texts.

Null and empty texts measure zero everywhere and fail `few_words`. Repeated rows are judged each
on their own; an empty table gives an empty ledger. A document is one row, so nothing is shuffled.
Input columns named like an output are replaced; all others are kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import BREAKS, count_characters, let, words

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """A condition on the measurements under which a document fails. It may be null, which is no failure."""

    name: str
    fails: Column


@dataclass(frozen=True)
class Policy:
    """Documents failing more than `tolerance` of the named rules are rejected."""

    name: str
    version: int
    rules: tuple[str, ...]
    tolerance: int = 0


def standard_rules() -> list[Rule]:
    """The production rules. The order gives the bits, so new rules go to the end."""
    n_words, n_lines = F.col("n_words"), F.col("n_lines")
    return [
        Rule("few_words", n_words < 50),
        Rule("repeated_windows", 100 * F.col("n_repeat_words") > 50 * n_words),
        Rule("many_symbols", 100 * F.col("n_symbols") > 20 * n_words),
        Rule("repeated_lines", 100 * F.col("n_dup_lines") > 30 * n_lines),
        Rule("short_words", F.col("word_chars") < 2 * n_words),
        Rule("long_words", F.col("word_chars") > 15 * n_words),
        Rule("huge", n_words > 200_000),
    ]


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STANDARD = Policy("standard", 2, ("few_words", "repeated_windows", "many_symbols", "repeated_lines", "short_words", "long_words"))


def repeated_window_words(tokens: Column, width: int = 3) -> Column:
    """Words that lie in a window of `width` words found twice or more in the text, the first place included.

    Windows are compared by a 64-bit hash: a false match inside one text of n windows has the
    probability n^2 / 2^65. Sorting (hash, place) puts equal windows side by side.
    """

    def covered(repeated: Column) -> Column:
        steps = F.zip_with(repeated, F.slice(repeated, 2, F.greatest(F.size(repeated) - 1, F.lit(0))), lambda a, b: F.least(F.coalesce(b - a, F.lit(width)), F.lit(width)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    def places(windows: Column) -> Column:
        twice = F.filter(windows, lambda x, j: (x.h == F.get(windows, j - 1).h) | (x.h == F.get(windows, j + 1).h))
        return F.array_sort(F.transform(twice, lambda x: x.i))

    def windows(tokens: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(tokens) - width)
        return F.array_sort(F.transform(at, lambda i: F.struct(F.xxhash64(*(F.get(tokens, i + k) for k in range(width))).alias("h"), i.alias("i"))))

    counted = let(tokens, lambda t: let(let(windows(t), places), covered))
    return F.when(F.size(tokens) > width, counted).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the measurements of their whole texts added, as longs."""
    body = F.coalesce(F.col(text), F.lit(""))
    return (
        docs.withColumn("__words", words(body))
        .withColumn("__lines", F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(BREAKS)) != ""))
        .withColumns({
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.length(body).cast("long") - count_characters(body, BREAKS),
            "n_symbols": count_characters(body, "#*$%&|<>"),
            "n_lines": F.size("__lines").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": repeated_window_words(F.col("__words")),
        })
        .drop("__words", "__lines")
    )


def ledger(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`keep`, the measurements and `failed_bits`: bit i is set where rule i fails."""
    rules = standard_rules() if rules is None else list(rules)
    if len(rules) > 63:
        raise ValueError("a ledger holds 63 rules at most")
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(rule.fails, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measure(docs, text).withColumn("failed_bits", bits).select(*keep, *MEASURES, "failed_bits")


def mask(policy: Policy, rules: Sequence[Rule] | None = None) -> int:
    names = [rule.name for rule in (standard_rules() if rules is None else rules)]
    return sum(1 << names.index(name) for name in set(policy.rules))


def passes(policy: Policy, rules: Sequence[Rule] | None = None, bits: str = "failed_bits") -> Column:
    """Whether a ledger row passes a policy."""
    return F.bit_count(F.col(bits).bitwiseAND(F.lit(mask(policy, rules)).cast("long"))) <= policy.tolerance


def ablations(rows: DataFrame, policies: Sequence[Policy], rules: Sequence[Rule] | None = None) -> DataFrame:
    """What each rule does in each policy, from one pass over the ledger.

    Per policy and rule: documents that fail the rule, those the policy keeps, those it would keep
    without the rule, and the union of the other failures of the documents that fail the rule.
    """
    rules = standard_rules() if rules is None else list(rules)
    names = [rule.name for rule in rules]
    out = []
    for p, policy in enumerate(policies):
        whole = mask(policy, rules)
        for name in sorted(set(policy.rules), key=names.index):
            bit = 1 << names.index(name)
            fails = F.col("failed_bits").bitwiseAND(F.lit(bit).cast("long")) != 0
            rest = F.bit_count(F.col("failed_bits").bitwiseAND(F.lit(whole & ~bit).cast("long")))
            out.append(F.struct(
                F.lit(policy.name).alias("policy"), F.lit(policy.version).alias("version"), F.lit(name).alias("rule"),
                F.count_if(fails).alias("n_failing"), F.count_if(passes(policy, rules)).alias("n_kept"),
                F.count_if(rest <= policy.tolerance).alias("n_kept_without"),
                F.coalesce(F.bit_or(F.when(fails, F.col("failed_bits").bitwiseAND(F.lit(~bit)))), F.lit(0).cast("long")).alias("met_with_bits"),
            ).alias(f"r{p}_{name}"))
    one = rows.agg(*out)
    return one.select(F.inline(F.array(*one.columns)))
