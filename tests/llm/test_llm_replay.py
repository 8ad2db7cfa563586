"""Classifier, language model and packing, each worked out again in plain Python from whole texts."""

import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pandas as pd
import pytest
import regex

from tidemark.llm import language_id, packing, queries, rule_ensemble

FOLDER = "/root/testdata/sf0.01"
BREAKS = " \t\n\x0b\x0c\r"
WORD = regex.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.execute(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())


def apart(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def statistics(text):
    body = text or ""
    found, lines = WORD.findall(body), [line for line in body.split("\n") if line.strip(BREAKS)]
    n, chars = max(1, len(found)), max(1, len(body))
    count = lambda marks: sum(c in marks for c in body)
    return [
        len(found), sum(map(len, found)) / n, len(set(found)) / n, 1 - len(set(lines)) / max(1, len(lines)),
        count("ABCDEFGHIJKLMNOPQRSTUVWXYZ") / chars, count("0123456789") / chars, count("#*$%&<>") / n,
        count("!") / n, count("|") / n, count(".") / n, sum(a == b for a, b in zip(found, found[1:], strict=False)) / n,
    ]


def test_rules_scored_again(spark, texts):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = rule_ensemble.fit(docs, labels.where(~rule_ensemble.held_out(labels.doc_id)))
    assert len(model.rules) > 3
    rows = rule_ensemble.scored(docs, model, keep=["doc_id"]).collect()
    assert len(rows) == len(texts)
    for r in rows:
        values = statistics(texts[r.doc_id])
        total = model.intercept
        for path, weight in model.rules:
            if all(values[c.statistic] > c.threshold if c.above else values[c.statistic] <= c.threshold for c in path):
                total += weight
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9), r.doc_id


def log_frequencies(counts, languages, most):
    """Smoothed log relative frequencies of the keys that are among the `most` largest of a language."""
    kept = {lang: dict(sorted(counts[lang].items(), key=lambda item: (-item[1], item[0]))[:most]) for lang in languages}
    keys = set().union(*kept.values())
    totals = {lang: sum(kept[lang].get(key, 0) + 0.5 for key in keys) for lang in languages}
    return {key: {lang: math.log((kept[lang].get(key, 0) + 0.5) / totals[lang]) for lang in languages} for key in keys}


def test_languages_told_again(spark, texts):
    langs = dict(duckdb.execute(f"SELECT doc_id, lang FROM '{FOLDER}/documents.parquet'").fetchall())
    counted, grams, seen = defaultdict(Counter), {n: defaultdict(Counter) for n in range(1, 6)}, Counter()
    for doc, lang in langs.items():
        if lang is not None and texts[doc] is not None and not apart(doc):
            seen[lang] += 1
            counted[lang].update(regex.findall(r"\p{L}+", texts[doc].lower()))
    languages = sorted(seen, key=lambda lang: (-seen[lang], lang))
    assert max(seen.values()) < 2000  # all texts are learned from
    for lang, found in counted.items():
        for word, times in found.items():
            marked = f" {word} "
            for n, by in grams.items():
                for i in range(len(marked) - n + 1):
                    if marked[i : i + n].strip(" "):
                        by[lang][marked[i : i + n]] += times
    words = log_frequencies(counted, languages, 40_000)
    pieces = {n: log_frequencies(by, languages, 5000) for n, by in grams.items()}

    def value(word, lang):
        if word in words:
            return words[word][lang]
        marked = f" {word} "
        for n in (5, 4, 3, 2, 1):
            known = [pieces[n][g][lang] for i in range(len(marked) - n + 1) if (g := marked[i : i + n]) in pieces[n]]
            if known:
                return sum(known) / len(known)
        return 0.0

    rows = queries.op6_language_id(spark, FOLDER).collect()
    assert len(rows) == len(texts) and len(languages) > 2
    strange = 0
    for r in rows:
        found = Counter(language_id.LETTERS.findall((texts[r.doc_id] or "").lower()))
        if not found:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        strange += sum(word not in words for word in found)
        sums = {lang: sum(n * value(word, lang) for word, n in found.items()) for lang in languages}
        best = max(sums.values())
        assert sums[r.lang_pred] == pytest.approx(best, abs=1e-6)
        assert r.score == pytest.approx(1 / sum(math.exp(v - best) for v in sums.values()), abs=1e-6)
    assert strange > 20


def plain_best_fit(pieces, capacity, per_source):
    """Every piece looks at every bin: the tightest compatible one, of equals the one longest unchanged."""
    bins, out, now = [], {}, 0
    for doc, piece, size, source, cluster in sorted(pieces, key=lambda p: (-p[2], p[4], p[0], p[1])):
        now += 1
        fits = [b for b in bins if capacity - b["used"] >= size and b["sources"][source] < per_source and cluster not in b["clusters"]]
        if not fits:
            bins.append({"number": len(bins), "used": 0, "sources": Counter(), "clusters": set(), "changed": now})
        chosen = min(fits, key=lambda b: (capacity - b["used"], b["changed"])) if fits else bins[-1]
        out[doc, piece] = (chosen["number"], chosen["used"])
        chosen["used"] += size
        chosen["sources"][source] += 1
        chosen["clusters"].add(cluster)
        chosen["changed"] = now
    return out


@pytest.mark.parametrize("seed, n, sources, capacity, per_source", [(1, 600, 5, 2048, 2), (2, 500, 1, 300, 2), (3, 700, 40, 100, 1), (4, 400, 3, 64, 3), (5, 1, 1, 8, 1)])
def test_a_shard_packed_again(seed, n, sources, capacity, per_source):
    rng = random.Random(seed)
    rows = []
    for doc in range(n):
        source = "+s0" if rng.random() < 0.4 else f"+s{rng.randrange(sources)}"
        cluster = rng.randrange(20) if rng.random() < 0.3 else 1000 + doc
        rows.append((doc, rng.randrange(3), rng.choice([1, capacity, rng.randint(1, capacity), rng.randint(1, max(1, capacity // 8))]), source, cluster))
    frame = pd.DataFrame(rows, columns=["doc_id", "piece", "n_words", "source", "cluster"]).assign(first_word=0)
    got = packing.pack_shard(frame, capacity, per_source)
    assert {(r.doc_id, r.piece): (r.bin, r.bin_offset) for r in got.itertuples()} == plain_best_fit(rows, capacity, per_source)
