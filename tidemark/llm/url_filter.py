"""URL filters: longest-match rules, and exact list membership by a Bloom filter cascade.

A cascade is built against the complete key universe of the corpus. Level 0 encodes the listed
keys; level 1 those other keys that level 0 takes for listed; level 2 the listed keys that level 1
takes for those, and so on, until a level has no false positives. The first level that does not
hold a key decides, so membership is exact for every key of the universe, and a row is judged by
bit tests in its own expression: no join, no shuffle of the pages.

The filters are literals of the plan. Their size is set by the counts of keys before they are made:
if all levels together could exceed `most_bytes`, the universe is cut by a hash into parts with a
cascade each, and each part of the rows is judged in a pass of its own.

A null URL, or one without `://`, has an empty host and path; the empty host is a key like any
other. Repeated rows and keys change nothing; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


@dataclass(frozen=True)
class UrlRule:
    """`text` is a host and a path, like `example.org/en/`; it fits the host and its subdomains where the path starts alike."""

    verdict: str
    text: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.text.partition("/")
        return F.endswith(F.concat(F.lit("."), host), F.lit("." + name)) & F.startswith(path, F.lit(slash + rest))


RULES = [
    UrlRule("allow", "org/"), UrlRule("block", "example.org/es/"), UrlRule("block", "example.org/en/1"),
    UrlRule("allow", "com/fr/"), UrlRule("block", "com/de/"),
]


def longest_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """Struct of `text` and `verdict` of the longest rule that fits (of equally long ones the first), or null."""
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(reversed(rules), key=lambda rule: len(rule.text)):
        found = F.when(rule.fits(host, path), F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


@dataclass(frozen=True)
class Level:
    """A Bloom filter: `words` longs of bits, tested at `hashes` places of a key's hash."""

    number: int
    words: tuple[int, ...]
    hashes: int

    def holds(self, key: Column) -> Column:
        # The literal is folded into one array when the plan is optimized.
        bits = F.from_json(F.lit("[" + ",".join(map(str, self.words)) + "]"), "array<bigint>")
        found = F.lit(True)
        for place in _places(key, self.number, self.hashes, 64 * len(self.words)):
            found = found & (F.call_function("shiftright", F.get(bits, F.floor(place / 64).cast("int")), F.pmod(place, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1)
        return found


def _places(key: Column, number: int, hashes: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(number), F.lit(i)), F.lit(bits)) for i in range(hashes)]


def _level(keys: DataFrame, number: int, bits_per_key: int, hashes: int) -> Level:
    size = max(1, -(-keys.count() * bits_per_key // 64))
    places = keys.select(F.explode(F.array(*_places(F.col("key"), number, hashes, 64 * size))).alias("place"))
    bit = F.expr("shiftleft(1L, CAST(pmod(place, 64) AS INT))")
    rows = places.groupBy(F.floor(F.col("place") / 64).alias("word")).agg(F.bit_or(bit).alias("bits")).collect()  # at most `size` longs
    words = [0] * size
    for row in rows:
        words[row.word] = row.bits
    return Level(number, tuple(words), hashes)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def listed(self, key: Column) -> Column:
        """Whether a key of the universe is listed: the first level without the key decides."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = F.when(level.holds(key), answer).otherwise(F.lit(level.number % 2 == 1))
        return answer


def _cascade(universe: DataFrame, bits_per_key: int, hashes: int, most_levels: int = 64) -> Cascade:
    ours, others, levels = universe.where("listed").select("key"), universe.where("NOT listed").select("key"), []
    while len(levels) < most_levels:
        levels.append(_level(ours, len(levels), bits_per_key, hashes))
        ours, others = others.where(levels[-1].holds(F.col("key"))), ours
        if ours.isEmpty():
            return Cascade(tuple(levels))
    raise RuntimeError("the cascade does not end")


@dataclass(frozen=True)
class Membership:
    """Cascades for the parts of a key universe."""

    cascades: tuple[Cascade, ...]

    def mark(self, rows: DataFrame, key: Column, name: str = "listed") -> DataFrame:
        """The rows with a column that tells if their key is listed. Keys outside the universe may be taken for listed."""
        if len(self.cascades) == 1:
            return rows.withColumn(name, self.cascades[0].listed(key))
        part = F.pmod(F.xxhash64(key, F.lit("part")), F.lit(len(self.cascades)))
        each = [rows.where(part == i).withColumn(name, cascade.listed(key)) for i, cascade in enumerate(self.cascades)]
        out = each[0]
        for more in each[1:]:
            out = out.unionByName(more)
        return out


def membership(universe: DataFrame, bits_per_key: int = 8, hashes: int = 4, most_bytes: int = 1 << 22) -> Membership:
    """Cascades over `universe`, one row per key: key, listed (a boolean). A null key is treated as empty text."""
    universe = settle(universe.groupBy(F.coalesce("key", F.lit("")).alias("key")).agg(F.bool_or("listed").alias("listed")))
    n_listed, n_other = universe.agg(F.count_if("listed"), F.count_if(~F.col("listed"))).first()
    # A level of the standard settings passes a tenth at most of the keys it was not made of: the first guess.
    parts = max(1, -(-int(bits_per_key * (n_listed + 0.2 * (n_listed + n_other)) / 8) // most_bytes))
    while True:
        part = F.pmod(F.xxhash64("key", F.lit("part")), F.lit(parts))
        made = Membership(tuple(_cascade(universe.where(part == i) if parts > 1 else universe, bits_per_key, hashes) for i in range(parts)))
        if parts > n_listed + n_other or all(8 * sum(len(level.words) for level in c.levels) <= most_bytes for c in made.cascades):
            return made
        parts *= 2


#: Parts of host names, between dots and hyphens, that put a host on the list.
LISTED_TOKENS = ("ads", "adult", "bets", "casino", "pills", "spam")


def host_listing(hosts: DataFrame, tokens: Sequence[str] = LISTED_TOKENS) -> DataFrame:
    """The key universe of a table with a `host` column: every distinct host, and whether a listed token is in it."""
    named = F.exists(F.split("host", "[.-]"), lambda part: part.isin(*tokens))
    return hosts.select("host").distinct().select(F.col("host").alias("key"), named.alias("listed"))


def judge(pages: DataFrame, listing: DataFrame | None = None, rules: Sequence[UrlRule] = RULES, url: str = "url", **options) -> DataFrame:
    """The pages with host, path, rule, listed and verdict: the rule's, or else block for a listed host."""
    found = pages.withColumns({"host": host(F.col(url)), "path": path(F.col(url))})
    members = membership(host_listing(found) if listing is None else listing, **options)
    found = members.mark(found, F.col("host")).withColumn("__rule", longest_rule(F.col("host"), F.col("path"), rules))
    plain = F.when(F.col("listed"), "block").otherwise("allow")
    return found.withColumns({"rule": F.col("__rule.text"), "verdict": F.coalesce(F.col("__rule.verdict"), plain)}).drop("__rule")
