"""Language identification, words first.

Known words score by their log frequency in each language. An unseen word falls back to its longest
character n-grams that are known to any language, then to shorter ones, down to single characters,
with the mean of their log frequencies. A text gets the language with the largest sum; its
score is that language's share of the likelihoods. Over many words that share nears one in any text, foreign
ones too; the share of words known to the language does not (`known_share`).

The model is bounded by parameters: at most about `most_texts` texts of a language are learned from
(chosen by a hash of the id), and the `most_words` words and `most_grams` n-grams of each order and language
with the largest counts are kept. It is shipped to the executors once; texts are scored
where they lie, without a shuffle.

Words are runs of letters, lower-cased. A text that is null or has no letter is `und` with score
zero, as is every text when nothing could be learned. Letters no language knows give the
most frequent language, with an equal share. Repeated rows are scored alike; an empty table gives
an empty result. Columns of the input are kept; those named like an output are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settle

LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
MEMORY = 50_000


@dataclass
class LanguageModel:
    """Languages, most frequent first; `words` and `grams[n]` map to a row of log frequencies per language."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[int, dict[str, int]]
    table: np.ndarray
    memory: dict[str, np.ndarray] = field(default_factory=dict, repr=False)

    @cached_property
    def unseen(self) -> np.ndarray:
        """The log frequency, per language, of a word that its texts did not hold (and a little more)."""
        rows = self.table[list(self.words.values())]
        return rows.min(axis=0, initial=0.0) + 0.1

    def __getstate__(self):
        return self.__dict__ | {"memory": {}}

    def backed_off(self, word: str) -> np.ndarray:
        """Mean log frequencies of the word's n-grams of the longest order with a known one."""
        known = self.memory.get(word)
        if known is None:
            known, marked = np.zeros(len(self.languages)), f" {word} "
            for n in sorted(self.grams, reverse=True):
                places = [at for i in range(len(marked) - n + 1) if (at := self.grams[n].get(marked[i : i + n])) is not None]
                if places:
                    known = self.table[places].mean(axis=0)
                    break
            if len(self.memory) >= MEMORY:
                self.memory.clear()
            self.memory[word] = known
        return known

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score, and the share of the words that the language's own texts held."""
        found = LETTERS.findall(text.lower()) if text else []
        if not self.languages or not any(c.isalpha() for word in found for c in word):
            return UNKNOWN, 0.0, 0.0
        total, places, times = np.zeros(len(self.languages)), [], []
        for word, n in Counter(found).items():
            at = self.words.get(word)
            if at is None:
                total += n * self.backed_off(word)
            else:
                places.append(at)
                times.append(n)
        if places:
            total += np.array(times, np.float64) @ self.table[places]
        best = int(total.argmax())
        known = sum(n for at, n in zip(places, times, strict=True) if self.table[at, best] > self.unseen[best])
        return self.languages[best], float(1 / np.exp(total - total[best]).sum()), known / len(found)


def _log_frequencies(counts: dict[str, dict[str, int]], languages: list[str]) -> tuple[list[str], np.ndarray]:
    """Keys and their smoothed log relative frequencies, from counts by language."""
    keys = sorted({key for by_key in counts.values() for key in by_key})
    place = {key: i for i, key in enumerate(keys)}
    table = np.full((len(keys), len(languages)), 0.5)
    for column, language in enumerate(languages):
        for key, n in counts.get(language, {}).items():
            table[place[key], column] += n
    return keys, np.log(table / table.sum(axis=0))


def learn(docs: DataFrame, most_texts: int = 2000, most_words: int = 40_000, most_grams: int = 5000, orders: tuple[int, ...] = (5, 4, 3, 2, 1)) -> LanguageModel:
    """A model of the rows with a language, from doc_id, text and lang."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    seen = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()  # one row a language
    languages = [row.lang for row in seen]
    if not languages:
        return LanguageModel([], {}, {}, np.zeros((0, 0)))
    parts = 1 << 20
    share = F.create_map(*(x for row in seen for x in (F.lit(row.lang), F.lit(math.ceil(parts * min(1.0, most_texts / row["count"]))))))
    picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < F.element_at(share, F.col("lang")))
    found = F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")
    words = settle(picked.select("lang", found).where("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    marked = F.concat(F.lit(" "), F.col("word"), F.lit(" "))

    def pieces(n: int) -> Column:
        cut = F.transform(F.sequence(F.lit(1), F.length(marked) - n + 1), lambda i: F.substring(marked, i, F.lit(n)))
        return F.when(F.length(marked) >= n, cut).otherwise(F.array().cast("array<string>"))

    grams = words.select("lang", "n", F.explode(F.flatten(F.array(*map(pieces, orders)))).alias("key")).where("trim(key) <> ''")
    grams = grams.groupBy(F.length("key").alias("size"), "lang", "key").agg(F.sum("n").alias("n"))
    counted = words.select(F.lit(0).alias("size"), "lang", F.col("word").alias("key"), "n").unionByName(grams)
    largest = Window.partitionBy("size", "lang").orderBy(F.desc("n"), "key")
    kept = counted.withColumn("place", F.row_number().over(largest)).where(F.col("place") <= F.when(F.col("size") == 0, most_words).otherwise(most_grams))
    counts: dict[int, dict[str, dict[str, int]]] = {n: {} for n in (0, *orders)}
    rows = kept.where(f"place <= {max(most_words, most_grams)}").select("size", "lang", "key", "n").toArrow()  # bounded by the parameters
    for batch in rows.to_batches(max_chunksize=4096):
        for size, language, key, times in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            counts[size].setdefault(language, {})[key] = times
    del rows
    tables, maps, at = [], {}, 0
    for n in (0, *orders):
        found = counts.pop(n)
        keys, table = _log_frequencies(found, languages)
        maps[n] = {key: at + i for i, key in enumerate(keys)}
        tables.append(table)
        at += len(keys)
    return LanguageModel(languages, maps.pop(0), maps, np.concatenate(tables))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None, known_share: bool = False) -> DataFrame:
    """The columns `keep` (all, if not given) with lang_pred, score and, if asked for, known_share: the share of known words."""
    says = ["lang_pred", "score", "known_share"][: 3 if known_share else 2]
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in says]
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    # A text that is kept anyway is not sent twice.
    rows = docs.select(*keep) if text in keep else docs.select(*keep, text)
    at, width = rows.columns.index(text), len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [shipped.value.predict(x.as_py()) for x in batch.column(at)]
            found = [pa.array([x[k] for x in said], kind) for k, kind in zip(range(len(says)), kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *found], names=[*keep, *says])

    schema, kinds = docs.select(*keep).schema, (pa.string(), pa.float64(), pa.float64())
    for name in says:
        schema = schema.add(name, "string" if name == "lang_pred" else "double")
    return rows.mapInArrow(run, schema)
