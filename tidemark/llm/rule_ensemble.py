"""Quality classifier: a sparse ensemble of rules.

Statistics of whole texts are Spark columns. A small random forest is grown on labelled rows, each
path of its trees becomes a conjunctive rule over the statistics, and a lasso logistic regression
weighs the rules; those it leaves at zero are dropped. The kept rules are compiled into one column
expression, so scoring a corpus is a single projection, without a shuffle, a join or Python.

The fit uses a bounded sample of the labelled rows: the `most_rows` with the smallest hash of their
id. Only those rows, a few dozen bytes each, are sent to the executors to pick their texts.

Null and empty texts have zero statistics and are scored by them. Labels that are null, or whose
document is missing, are left out; a document labelled twice counts twice. With no labels, or of one
kind only, every score is the same, (ones + 1) / (labels + 2). Repeated documents get equal scores;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import BREAKS, count_characters, set_aside, words
from tidemark.session import settle

UPPER, DIGITS, SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&<>"
STATISTICS = ["n_words", "word_length", "distinct_words", "repeated_lines", "upper", "digits", "symbols", "bangs", "bars", "stops", "repeated_pairs"]


WORKING = {"statistics", "__words", "__lines", "__n", "__chars", "__score"}


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with a column `statistics`, an array of doubles in the order of STATISTICS."""
    body = F.coalesce(F.col(text), F.lit(""))
    counted = docs.withColumn("__words", words(body)).withColumns({
        "__lines": F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(BREAKS)) != ""),
        "__n": F.greatest(F.size("__words"), F.lit(1)).cast("double"),
        "__chars": F.greatest(F.length(body), F.lit(1)).cast("double"),
    })
    literal = lambda mark: F.length(body) - F.length(F.replace(body, F.lit(mark), F.lit("")))
    same = F.size(F.filter(F.col("__words"), lambda word, i: word == F.get(F.col("__words"), i - 1)))
    columns = [
        F.size("__words"), (F.length(body) - count_characters(body, BREAKS)) / F.col("__n"), F.size(F.array_distinct("__words")) / F.col("__n"),
        1 - F.size(F.array_distinct("__lines")) / F.greatest(F.size("__lines"), F.lit(1)),
        count_characters(body, UPPER) / F.col("__chars"), count_characters(body, DIGITS) / F.col("__chars"), count_characters(body, SYMBOLS) / F.col("__n"),
        literal("!") / F.col("__n"), literal("|") / F.col("__n"), literal(".") / F.col("__n"), same / F.col("__n"),
    ]
    return counted.withColumn("statistics", F.array(*(c.cast("double") for c in columns))).drop("__words", "__lines", "__n", "__chars")


@dataclass(frozen=True)
class Condition:
    statistic: int
    above: bool
    threshold: float

    def holds(self) -> Column:
        value = F.get(F.col("statistics"), F.lit(self.statistic))
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{STATISTICS[self.statistic]} {'>' if self.above else '<='} {self.threshold:g}"


Path = tuple[Condition, ...]


def indicator(path: Path) -> Column:
    held = path[0].holds()
    for condition in path[1:]:
        held = held & condition.holds()
    return F.when(held, 1.0).otherwise(0.0)


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules; the score is the logistic function of `intercept` and the weights of the rules that hold."""

    intercept: float
    rules: tuple[tuple[Path, float], ...]

    def score(self) -> Column:
        """The score of a row with `statistics`."""
        total = F.lit(self.intercept)
        for path, weight in self.rules:
            total = total + F.lit(weight) * indicator(path)
        return 1 / (1 + F.exp(-total))

    def describe(self) -> list[str]:
        return [f"{weight:+.3f}  {' and '.join(map(str, path))}" for path, weight in sorted(self.rules, key=lambda rule: -abs(rule[1]))]


def _paths(node, above: Path = ()) -> list[Path]:
    """The paths to all nodes below a tree node of the fitted forest."""
    if not hasattr(node, "leftChild") or node.getClass().getSimpleName() == "LeafNode":
        return []
    split = node.split()
    out: list[Path] = []
    for child, right in ((node.leftChild(), False), (node.rightChild(), True)):
        path = (*above, Condition(split.featureIndex(), right, split.threshold()))
        out += [path, *_paths(child, path)]
    return out


def _simplified(path: Path) -> Path:
    """Per statistic and direction only the tightest bound, in a fixed order."""
    best: dict[tuple[int, bool], float] = {}
    for c in path:
        key = (c.statistic, c.above)
        best[key] = c.threshold if key not in best else (max if c.above else min)(best[key], c.threshold)
    return tuple(Condition(s, a, t) for (s, a), t in sorted(best.items()))


def sample(labels: DataFrame, label: str, most_rows: int) -> DataFrame:
    """At most `most_rows` labelled ids, those with the smallest hash: doc_id, label."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).select("doc_id", F.col(label).cast("double").alias("label"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most_rows)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = 20_000, trees: int = 16, depth: int = 3, lasso: float = 0.0005, seed: int = 7) -> RuleEnsemble:
    """Fit on documents (doc_id, text) and labels (doc_id and a 0/1 column), both already cut down to what may be learned from."""
    picked = F.broadcast(sample(labels, label, most_rows))  # most_rows rows of two numbers
    rows = statistics(docs.select("doc_id", "text").join(picked, "doc_id")).select("label", "statistics")
    rows = settle(rows.repartition(4).select("label", "statistics", array_to_vector("statistics").alias("features")))
    ones, n = rows.agg(F.coalesce(F.sum("label"), F.lit(0.0)), F.count(F.lit(1))).first()
    if ones in (0, n):
        rate = (ones + 1) / (n + 2)
        return RuleEnsemble(_log_odds(rate), ())
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", minInstancesPerNode=3, seed=seed).fit(rows)
    rules = sorted({_simplified(path) for tree in forest.trees for path in _paths(tree._java_obj.rootNode())}, key=repr)
    if not rules:
        return RuleEnsemble(_log_odds(ones / n), ())
    held = settle(rows.select("label", array_to_vector(F.array(*map(indicator, rules))).alias("features")))
    lasso_fit = LogisticRegression(elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=60, tol=1e-5).fit(held)
    weights = lasso_fit.coefficients.toArray().tolist()
    return RuleEnsemble(float(lasso_fit.intercept), tuple((rule, weight) for rule, weight in zip(rules, weights, strict=True) if weight))


def _log_odds(rate: float) -> float:
    return math.log(rate / (1 - rate))


def scored(docs: DataFrame, model: RuleEnsemble, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """The documents (or their columns `keep`) with `score`, which takes the place of an input column of that name."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != "score"]
    names = docs.columns
    docs, back = set_aside(docs, WORKING)
    own = dict(zip(names, back, strict=True))
    return statistics(docs, text).withColumn("score", model.score()).select(*(own[c] for c in keep), "score")


def accepted(docs: DataFrame, model: RuleEnsemble, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The documents that score `threshold` or more. A generator picks them, since a filter would be
    moved below the statistics and work them out anew for each rule that names them."""
    passing = F.filter(F.array(model.score()), lambda score: score >= threshold)
    docs, back = set_aside(docs, WORKING)
    return statistics(docs, text).select(*docs.columns, F.explode(passing).alias("__score")).select(*back)


def held_out(doc_id: Column) -> Column:
    """One fifth of the ids, by checksum; never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
