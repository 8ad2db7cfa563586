"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat_format, components, language_id, license_scan, mixing, packing, quality_rules, rule_ensemble, simhash, threshold_search, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_words string, bucket string, score string"


def documents(spark, rows):
    return spark.createDataFrame([(*row, "own", "own", "own") for row in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(3)
    long_text = " ".join(f"w{rng.randrange(500)}" for _ in range(30_000))
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n\x0b\x0c\r", None, None), (4, long_text, "en", "b"), (5, long_text, "en", "b"), (5, long_text, "en", "b"),
        (6, "a b c a b c a b", "en", None), (None, "one two three", "de", "c"), (None, None, None, None), (7, "A " * 5000, "de", ""), (8, "é\u2003ü\u00a0x", "fr", "\U0001f600"),
        (9, "single", None, "a"), (10, "1 2 3 !!! ||| ###", "en", "c"),
    ]
    return documents(spark, rows)


def test_rules(spark, odd):
    rows = quality_rules.ledger(odd).collect()
    by = {r.doc_id: r for r in rows if r.doc_id}
    assert len(rows) == 13 and by[1].n_words == by[2].n_words == by[3].n_words == 0 and by[1].failed_bits == 1
    assert (by[6].n_repeat_words, by[6].word_chars, by[7].n_repeat_words, by[8].n_words, by[9].n_repeat_words) == (8, 8, 5000, 1, 0)
    assert by[4].n_words == 30_000 and by[10].n_symbols == 6
    assert quality_rules.ledger(odd.limit(0)).collect() == []
    report = {r.rule: r for r in quality_rules.ablations(quality_rules.ledger(odd), [quality_rules.STANDARD]).collect()}
    kept = sum(r.failed_bits & 63 == 0 for r in rows)
    assert report["few_words"].n_failing == sum(r.failed_bits & 1 for r in rows)
    assert all(r.n_kept == kept <= r.n_kept_without for r in report.values())
    assert report["repeated_windows"].n_kept_without == sum(r.failed_bits & 61 == 0 for r in rows)
    assert quality_rules.ablations(quality_rules.ledger(odd.limit(0)), [quality_rules.BASE]).collect()[0].n_kept == 0


def brute_repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)})


def test_repeated_windows_against_brute_force(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcd") for _ in range(n)) for n in range(40) for _ in range(3)]
    rows = quality_rules.ledger(documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])).collect()
    assert {r.doc_id: r.n_repeat_words for r in rows} == {i: brute_repeats(t.split()) for i, t in enumerate(texts)}


URLS = [
    (1, None), (2, ""), (3, "no scheme/a"), (4, "http://"), (5, "http://EXAMPLE.org/es/x?y"), (6, "x://a.example.org/en/12#z"), (7, "http://notexample.org/es/"),
    (8, "http://example.com/de/1"), (9, "http://example.com/fr?x"), (10, "http://casino.example.net/a"), (10, "http://casino.example.net/a"), (11, "a://b://c/d"), (12, "http://org/x"),
]


def test_urls(spark):
    pages = spark.createDataFrame([(*row, "own", "own") for row in URLS], "page_id long, url string, host string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages).collect()}
    assert got[1] == got[2] == got[3] == got[4] == ("", "", None, "allow")
    assert got[5] == ("example.org", "/es/x", "example.org/es/", "block") and got[6] == ("a.example.org", "/en/12", "example.org/en/1", "block")
    assert got[7] == ("notexample.org", "/es/", "org/", "allow") and got[8] == ("example.com", "/de/1", "com/de/", "block")
    assert got[9] == ("example.com", "/fr", None, "allow") and got[10] == ("casino.example.net", "/a", None, "block")
    assert got[11] == ("b:", "//c/d", None, "allow") and got[12] == ("org", "/x", "org/", "allow")
    assert url_filter.judge(pages).count() == 13 and url_filter.judge(pages.limit(0)).collect() == []


@pytest.mark.parametrize("most_bytes", [1 << 22, 300])
def test_cascade_is_exact(spark, most_bytes):
    keys = spark.range(3000).select(F.concat(F.lit("k"), F.col("id")).alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    members = url_filter.membership(keys.union(keys.limit(10)), bits_per_key=4, hashes=2, most_bytes=most_bytes)
    assert (len(members.cascades) > 1) == (most_bytes < 1000) and all(len(c.levels) > 1 for c in members.cascades)
    marked = members.mark(keys.withColumnRenamed("listed", "truth"), F.col("key"))
    assert marked.count() == 3000 and marked.where("listed <> truth").count() == 0


def test_chat(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "<\\|x", "<\\\\|y<", "", None, "a\nb", "%0A"]
    rows = [(1, i, role, text) for i, (role, text) in enumerate(zip(["user", "assistant", "system", "assistant", "assistant", "user", "a%0A\n<|b"], nasty, strict=True))]
    rows += [(2, None, None, "x"), (2, 1, "assistant", "y"), (2, 1, "assistant", "y"), (None, 1, "user", "z")]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, example int")
    made = chat_format.examples(turns)
    for r in made.where("is_last").select("conv_id", chat_format.read_turns(F.col("formatted")).alias("said")).collect():
        want = sorted(((turn is not None, turn or 0, role or "", text or "") for conv, turn, role, text in rows if conv == r.conv_id))
        assert [(s.role, s.text) for s in r.said] == [w[2:] for w in want]
    loss = made.select("conv_id", "example", "loss_length", chat_format.trained_text(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("t")).collect()
    assert {(r.conv_id, r.example): r.t for r in loss} == {(1, 0): nasty[1], (1, 1): "", (1, 2): "", (1, 3): "", (2, 0): "y", (2, 1): "y", (None, 0): ""}
    digest = {r.conv_id: r for r in chat_format.digest(made).collect()}
    assert digest[1].n_turns == 7 and digest[1].loss_chars == len(nasty[1]) and digest[2].loss_chars == 2 and digest[None].n_turns == 1
    assert chat_format.digest(chat_format.examples(turns.limit(0))).collect() == []


def test_search(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(0, 0.3, 6).tolist()) for i in range(200)] + [(500 + i, [0.5] * 6) for i in range(5)]
    rows += [(300, None), (301, [1.0, None, 0.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (None, [1.0] * 6), (0, rows[0][1]), (0, rows[7][1]), (305, []), (306, [0.9])]
    rows += [(304, [7e14] + [0.0] * 5), (320, [0.1, -3e7, 0.0, 3e7, 0.0, 1e-9]), (321, [0.1, -3e7, 0.0, 3e7, 0.0, 1e-9])]  # products beyond what doubles hold exactly
    table = spark.createDataFrame([(*r, 9) for r in rows], "vec_id long, embedding array<double>, score int")
    got = {}
    for r in threshold_search.search(table, F.col("vec_id") % 20 == 0, k=7, shard_rows=40, block_rows=4).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    kept = [(i, [math.floor(64 * x) for x in v] + [0] * (6 - len(v))) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = {}
    for n, (q, asked) in enumerate(kept):
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(asked, v)), i) for m, (i, v) in enumerate(kept) if m != n)[:7]
            want.setdefault(q, []).extend((rank + 1, i, -s) for rank, (s, i) in enumerate(best))
    assert {q: sorted(v) for q, v in got.items()} == {q: sorted(v) for q, v in want.items()} and len(got[0]) == 21
    beyond = spark.createDataFrame([(0, [1e30]), (1, [1e30])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large|too big|Overflow"):
        threshold_search.search(beyond, F.col("vec_id") == 0).collect()
    assert threshold_search.search(table.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_walk_of_a_block():
    """Queries of a block are scored together: the k best as by brute force, with no more products for 512 queries than for a few."""
    rng = np.random.default_rng(5)
    vectors, ids = np.floor(rng.normal(0, 8, (4096, 64))), rng.permutation(4096) // 2
    products = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            products.append(self.shape)
            return np.asarray(self) @ np.asarray(other)

    def walked(asks):
        products.clear()
        return threshold_search.walk(np.arange(4096), ids, vectors.view(Counted), asks, vectors[asks].view(Counted), 20)

    walked(np.arange(0, 4096, 512))
    few, asks = len(products), np.arange(0, 4096, 8)
    query, found, score = walked(asks)
    assert len(products) <= 2 * few
    scores = vectors[asks] @ vectors.T
    scores[np.arange(len(asks)), asks] = -np.inf
    for k in range(len(asks)):
        want = sorted(zip((-scores[k]).tolist(), ids.tolist(), strict=True))[:20]
        assert list(zip((-score[query == k]).tolist(), found[query == k].tolist(), strict=True)) == want


def test_walk_stops():
    """A vector that no list has brought up when all queries have stopped is not scored."""
    vectors = np.zeros((5000, 3))
    vectors[:50] = np.arange(50, 0, -1)[:, None] * 10.0
    vectors[50:, 0] = np.arange(4950) % 7
    read = []

    class Ids(np.ndarray):
        def __getitem__(self, key):
            read.extend(range(*key.indices(len(self))) if isinstance(key, slice) else [])
            return super().__getitem__(key)

    query, found, score = threshold_search.walk(np.arange(5000), np.arange(5000).view(Ids), vectors, np.array([9999]), np.array([[1.0, 2.0, 1.0]]), 5)
    assert np.asarray(found).tolist() == [0, 1, 2, 3, 4] and score.tolist() == [2000, 1960, 1920, 1880, 1840]
    assert 0 < len(read) < 500


def test_classifier(spark, odd):
    labels = spark.createDataFrame([(4, 1), (5, 1), (7, 0), (2, 0), (99, 1), (None, 1), (6, None)], "doc_id long, quality int")
    model = rule_ensemble.fit(odd, labels)
    rows = rule_ensemble.scored(odd, model, keep=["doc_id"]).collect()
    assert len(rows) == 13 and all(0 <= r.score <= 1 for r in rows)
    assert rule_ensemble.accepted(odd, model, threshold=0.0).count() == 13 and rule_ensemble.accepted(odd, model, threshold=1.1).count() == 0
    one_kind = rule_ensemble.fit(odd, labels.where("quality = 1 OR quality IS NULL"))
    none = rule_ensemble.fit(odd, labels.limit(0))
    assert not one_kind.rules and {round(r.score, 3) for r in rule_ensemble.scored(odd, none, keep=["doc_id"]).collect()} == {0.5}
    assert rule_ensemble.scored(odd.limit(0), model, keep=["doc_id"]).collect() == []


def test_languages(spark, odd):
    learned = documents(spark, [(i, "the cat and the dog " * 5, "en", None) for i in range(5)] + [(i, "der hund und die katze " * 5, "de", None) for i in range(5, 8)] + [(9, None, "fr", None), (10, "x", None, None)])
    model = language_id.learn(learned)
    assert model.languages == ["en", "de"]
    said = [model.predict(t)[0] for t in ("The Dog", "die Hunde", "", None, "123 _ ½", "漢字", "cats")]
    assert said == ["en", "de", "und", "und", "und", "en", "en"] and model.predict("漢字")[1] == 0.5
    rows = language_id.identify(odd, model).collect()
    assert len(rows) == 13 and {r.lang_pred for r in rows if r.text is None} == {"und"} and rows[0].bucket == "own"
    nothing = language_id.learn(learned.limit(0))
    assert {r.lang_pred for r in language_id.identify(odd, nothing).collect()} == {"und"}
    assert language_id.identify(odd.limit(0), model).collect() == []


def test_simhash(spark, odd):
    rows = simhash.near_duplicates(odd).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert len(rows) == 13 and by[1] == by[2] == by[3] == {("0" * 16, 1)} and {c for _, c in by[4] | by[5]} == {4}
    assert {c for _, c in by[None]} == {None}
    kept = [r.doc_id for r in simhash.deduplicate(odd).collect()]
    assert sorted(k for k in kept if k is not None) == [1, 4, 6, 7, 8, 9, 10] and kept.count(None) == 2
    assert simhash.near_duplicates(odd.limit(0)).collect() == [] and simhash.deduplicate(odd.limit(0)).collect() == []


@pytest.mark.parametrize(("leaf_mean", "leaf_rows"), [(4, 8192), (2000, 60)])
def test_links_connect_all_near_pairs(spark, leaf_mean, leaf_rows):
    """Deep trees, and tiles of large leaves, with a chain and a dense group of near copies."""
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(150)}
    seed = rng.getrandbits(64)
    for _ in range(150):
        prints.add(seed ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    for _ in range(40):
        seed ^= sum(1 << b for b in rng.sample(range(64), 4))
        prints.add(seed)
    prints = sorted(prints)
    nodes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)], "fp long, id long")
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 4:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    edges = simhash.links(nodes, leaf_mean=leaf_mean, leaf_rows=leaf_rows)
    got = {r.id: r.component for r in components.components(edges).collect()}
    assert [got.get(i, i) for i in range(len(prints))] == [find(i) for i in range(len(prints))]


def test_mixing(spark, odd):
    rows = mixing.taken_words(mixing.plan(odd)).collect()
    assert len(rows) == 13 and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert {r.size for r in rows if r.doc_id in (1, 2, 3)} == {0}
    again = mixing.taken_words(mixing.plan(odd.repartition(7))).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    assert mixing.taken_words(mixing.plan(odd.limit(0))).collect() == []
    total, taken = sum(r.size for r in rows), sum(r.taken for r in rows)
    assert abs(taken - 1.5 * total) < 0.01 * total
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns and sum(len(r.text.split()) for r in mixed.where("doc_id = 4 OR doc_id = 5").collect()) == sum(r.taken for r in rows if r.doc_id in (4, 5))


def test_schedule_spreads_sources(spark):
    """Any stretch of slots holds the sources in nearly their shares."""
    sources = spark.createDataFrame([(1, 600.0), (2, 300.0), (3, 100.0)], "no int, target double")
    slots = [r.no for r in mixing.schedule(sources, 10_000).orderBy("slot").collect()]
    for low in range(0, 10_000, 1000):
        part = Counter(slots[low : low + 1000])
        assert all(abs(part[no] - share) <= 6 for no, share in ((1, 600), (2, 300), (3, 100)))
    ranks = mixing.schedule(sources, 10_000).where("no = 3").orderBy("slot").collect()
    assert [r["rank"] for r in ranks] == list(range(len(ranks)))


def test_targets_are_capped_and_shared(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 100), (None, 50)], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got["a"] == 20 and got["c"] == 200 and got[None] == 100 and abs(sum(got.values()) - 1740) < 1e-6


def test_licenses(spark, odd):
    mit = license_scan.TEMPLATES["MIT"]
    changed = mit.replace("free of charge", "at no cost").replace("merge, ", "")
    texts = [(20, f"Some words first. {changed} And after.", None, None), (21, "Released under the MIT License. x Released under the MIT License.", None, None), (22, "licensed under nothing", None, None)]
    rows = license_scan.scan(odd.union(documents(spark, texts))).orderBy("doc_id", "span_start").collect()
    assert [r.doc_id for r in rows] == [20, 21, 21]
    assert rows[0].template == "MIT" and rows[0].coverage > 0.93 and texts[0][1][rows[0].span_start : rows[0].span_end].startswith("Permission") and rows[1].coverage == 1
    assert license_scan.scan(odd.limit(0)).collect() == []


def test_packing(spark, odd):
    rows = packing.pack(odd, capacity=100, per_source=1).collect()
    room = Counter()
    for r in rows:
        room[r.bin] += r.n_words
    assert max(n for b, n in room.items() if b is not None) <= 100 and sum(r.bin is None for r in rows) == 4
    assert sum(r.n_words for r in rows) == sum(len((r.text or "").split(" ")) if r.doc_id not in (1, 2, 3, 7, None) else 0 for r in odd.collect()) + 5000 + 3
    assert packing.pack(odd.limit(0)).collect() == []
    copies = documents(spark, [(i, "same words here", None, f"s{i}") for i in range(30)])
    assert len({r.bin for r in packing.pack(copies).collect()}) == 30


def test_successor_search_takes_the_tightest_compatible_bin():
    bins = packing.Bins(10, 1)
    assert [bins.put(7, 0, 0)[0], bins.put(6, 1, 1)[0], bins.put(5, 2, 0)[0]] == [0, 1, 2]
    assert bins.put(3, 0, 0) == (1, 6)  # bin 0 is tighter but has the source
    assert bins.put(3, 3, 1) == (0, 7)
    assert bins.put(5, 4, 1) == (2, 5)
    assert bins.put(1, 0, 0)[0] == 3
