"""Near-copies against brute force, spread shards, targets met to the word, edited notices."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_llm_queries import full_matches

import corpus_pipeline
from tidemark.llm import components, license_scan, mixing, near_copies, packing, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingle_set(text):
    found = (text or "").lower().split()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def test_near_duplicate_stage_against_brute_force_jaccard(spark):
    """Edited copies on both sides of 0.8, a chain, a dense group, clashing and null ids.

    Every similar pair must be linked, with cells, identities and tiles of the usual size and of a very small one.
    """
    rng = random.Random(11)
    texts = []
    for n in (6, 12, 40, 90, 200, 400):
        for _ in range(4):
            words = [f"w{rng.randrange(300)}" for _ in range(n)]
            texts.append(" ".join(words))
            for share in (0.01, 0.02, 0.03, 0.06):
                edited = list(words)
                for at in rng.sample(range(n), max(1, int(n * share))):
                    edited[at] = f"x{rng.randrange(10**6)}"
                texts.append(" ".join(edited))
    chain = [f"c{i}" for i in range(100)]
    for i in range(12):
        chain[8 * i] = f"d{i}"
        texts.append(" ".join(chain))
    dense = [f"e{i}" for i in range(150)]
    texts += [" ".join([*dense[:i], f"f{i}", *dense[i + 1 :]]) for i in range(60)]
    texts += ["", None, texts[0].upper()]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(0, "an unlike text under an id that is taken already"), (5, texts[10]), (3, texts[3]), (None, texts[2]), (None, texts[2])]
    frame = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [shingle_set(t) for _, t in rows]
    near = 0
    for i, a in enumerate(sets):
        for j in range(i):
            if None not in (rows[i][0], rows[j][0]) and len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                near += a != sets[j]
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    groups = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            groups[find(i)].append(i)
    small = near_copies.deduplicate(frame, cells=64, id_bits=8, tile_rows=8)
    for found in (corpus_pipeline.near_duplicates(spark, frame, ""), small):
        got = Counter((r.doc_id, r.text) for r in found.collect())
        assert near > 60 and got.pop((None, texts[2])) == 2
        left = list(got.elements())
        assert len(left) == len(groups)
        for held in groups.values():
            least = min(rows[i][0] for i in held)
            assert sum(got[row] for row in {rows[i] for i in held if rows[i][0] == least}) == 1


def test_plans_of_the_near_duplicate_stage_stay_small(spark, monkeypatch):
    """The driver's memory follows the plans: none that is written between has over six exchanges (ten before each search and contraction was written)."""
    rng = random.Random(3)
    copied = [f"w{rng.randrange(400)}" for _ in range(60)]
    rows = [(i, " ".join(copied[:at] + ["x"] + copied[at + 1 :]) if i % 2 else " ".join(f"v{rng.randrange(400)}" for _ in range(60))) for i, at in enumerate(rng.choices(range(60), k=80))]
    found, exchanges = near_copies.settle, []

    def counted(frame):
        exchanges.append(frame._jdf.queryExecution().executedPlan().toString().count("Exchange"))
        return found(frame)

    for module in (near_copies, components, simhash):
        monkeypatch.setattr(module, "settle", counted)
    kept = near_copies.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == [0, 1, *range(2, 80, 2)]
    assert max(exchanges) <= 6


def test_plans_of_the_mixture_stage_stay_small(spark, monkeypatch):
    """None that is written or returned has over eight exchanges (the whole mix was one plan of 23 before)."""
    rows = [(i, f"w{i} " * (1 + i % 7), "en", f"s{i % 3}", 1) for i in range(60)]
    found, exchanges = mixing.settle, []

    def counted(frame):
        exchanges.append(frame._jdf.queryExecution().executedPlan().toString().count("Exchange "))
        return found(frame)

    monkeypatch.setattr(mixing, "settle", counted)
    mixed = corpus_pipeline.mixture(spark, spark.createDataFrame(rows, DOCS), "")
    exchanges.append(mixed._jdf.queryExecution().executedPlan().toString().count("Exchange "))
    assert {r.doc_id for r in mixed.collect()} <= set(range(60))
    assert max(exchanges) <= 8


def test_stars_are_not_contracted_again(spark, monkeypatch):
    """Edges that are stars are written once (three times before, to see that nothing changes); chains are contracted to the end."""
    found, written = components.settle, []
    monkeypatch.setattr(components, "settle", lambda frame: written.append(1) or found(frame))

    def named(edges):
        return {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}

    assert named([(3, 1), (1, 4), (4, 1), (9, 7), (5, 5), (None, 2)]) == {1: 1, 3: 1, 4: 1, 7: 7, 9: 7}
    assert len(written) == 1
    assert named([(i, i + 1) for i in range(40)]) == dict.fromkeys(range(41), 0)
    assert named([(3, 1), (3, 2), (9, 5)]) == {1: 1, 2: 1, 3: 1, 5: 5, 9: 5}
    assert named([]) == {}


def test_near_duplicate_stage_with_odd_tables(spark):
    """Very long texts, clashing columns, repeated rows, an empty table."""
    rng = random.Random(12)
    long_text = [f"w{rng.randrange(5000)}" for _ in range(120_000)]
    other = list(long_text)
    for at in range(0, 120_000, 60):
        other[at] = "changed"
    third = [w if i % 12 else "gone" for i, w in enumerate(long_text)]
    rows = [(4, " ".join(other)), (2, " ".join(long_text)), (3, " ".join(third)), (9, None), (8, ""), (8, ""), (7, " \n"), (6, "One two"), (5, "one  two"), (1, "one")]
    frame = spark.createDataFrame([(*r, "own", "own", "own") for r in rows], "doc_id long, text string, __key string, node string, __r1 string")
    kept = corpus_pipeline.near_duplicates(spark, frame, "")
    assert kept.columns == frame.columns
    assert sorted(tuple(r)[0] for r in kept.collect()) == [1, 2, 3, 5, 7]
    assert corpus_pipeline.near_duplicates(spark, frame.limit(0), "").collect() == []


def test_shards_of_null_and_repeated_rows_are_bounded(spark):
    texts = [f"own words {i}" for i in range(1200)]
    rows = [(None, t, "en", f"s{i % 5}", 1) for i, t in enumerate(texts)] + [(7, "the same row", "en", "a", 1)] * 600 + [(None, "the same text", "en", "b", 1)] * 600
    frame = spark.createDataFrame(rows, DOCS)
    for cluster in (None, frame["doc_id"]):
        packed = packing.pack(frame, cluster=cluster, shard_pieces=100).collect()
        assert len(packed) == 2400 and sum(r.n_words for r in packed) == sum(len(r[1].split()) for r in rows)
        shards = Counter(r.bin >> 24 for r in packed)
        assert len(shards) == 24 and max(shards.values()) < 160
        assert max(Counter(r.bin for r in packed if r.doc_id == 7).values()) == 1


def test_rows_without_a_cluster_may_share_a_bin(spark):
    frame = spark.createDataFrame([(None, f"text {i}", "en", f"s{i}", 1) for i in range(30)], DOCS)
    assert len({r.bin for r in packing.pack(frame, cluster=frame["doc_id"]).collect()}) == 1


def test_every_source_of_the_pipeline_mix_ends_at_its_target(spark):
    """Many sources of less than a block or a few, and a large one."""
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 60)), "en", f"t{i % 200:03}", 1) for i in range(400)]
    rows += [(1000 + i, "v " * 2000, "en", "z", 1) for i in range(100)]
    frame = spark.createDataFrame(rows, DOCS)
    options = {"block_words": 64, "least_blocks": 1}
    mix = mixing.plan(frame, exact=True, **options)
    targets = {r.source: int(r.target) for r in mix.sources.collect()}
    got = Counter()
    for r in mixing.mixed_documents(frame, exact=True, **options).collect():
        got[r.source] += len(r.text.split())
    assert dict(got) == targets and len(targets) == 201
    assert sum(r.taken for r in mixing.taken_words(mix).collect()) == sum(targets.values())
    slots = mix.slots.collect()
    assert len({r.slot for r in slots}) == len(slots) == len({(r.no, r["rank"]) for r in slots})


@pytest.mark.parametrize(("text", "template"), [
    ("Released under MIT License", "MIT notice"), ("Released under an MIT License", "MIT notice"), ("Released under our own MIT License", "MIT notice"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0 notice"), ("Licensed under CC BY 4.0.", "CC BY 4.0 notice"),
])
def test_edited_notices_and_siblings(text, template):
    found = license_scan.Scanner(license_scan.TEMPLATES).scan(f"Some words before. {text} Some words after.")
    assert [m.template for m, _, _ in found] == [template]


def test_edited_notices_in_whole_texts_against_full_alignment():
    """Every template by itself, so that none hides another; edits after nearly every word, in texts of hundreds of words."""
    rng = random.Random(9)
    templates = {k: v for k, v in license_scan.TEMPLATES.items() if len(v) < 400}
    pool = [w for v in templates.values() for w in license_scan.tokens(v)]
    alone = {name: license_scan.Scanner({name: v}) for name, v in templates.items()}
    n = 0
    for name, scanner in alone.items():
        for keep in (0.55, 0.65, 0.85):
            words = [w for w in license_scan.tokens(templates[name]) if rng.random() < keep for w in ([w, rng.choice(["aa", "bb"])] if rng.random() < 0.3 else [w])]
            filler = lambda: [rng.choice(pool) if rng.random() < 0.3 else f"w{rng.randrange(99)}" for _ in range(100)]
            text = " ".join(filler() + words + filler())
            want = full_matches(text, scanner)
            assert want <= {m.template for m, _, _ in scanner.scan(text)}
            n += len(want)
    assert n > 30


def full_alignment(words, found, low, high):
    """Best local alignment with the words [low, high) by the whole matrix: matched words, first and last place."""
    above, best = [(0, 0, 0)] * (len(words) + 1), (0, 0, 0, 0)
    for j in range(low, high):
        row = [(0, 0, 0)]
        for i, wanted in enumerate(words):
            score, matched, first = above[i]
            same = wanted == found[j]
            step = (score + 2, matched + 1, first if matched else -j) if same else (score - 1, matched, first)
            cell = max(step, (above[i + 1][0] - 1, *above[i + 1][1:]), (row[i][0] - 1, *row[i][1:]))
            row.append(cell if cell[0] >= 0 and cell[1] else (0, 0, 0))
            if same and step[:2] > best[:2]:
                best = (*step, j)
        above = row
    return best[1], -best[2], best[3]


def all_alignments(words, found, least):
    """Matched words and places of every alignment that covers enough, none overlapping, by whole matrices."""
    out, open_, needs = [], [(0, len(found))], max(1, math.ceil(least * len(words)))
    while open_:
        low, high = open_.pop()
        if sum((Counter(words) & Counter(found[low:high])).values()) >= needs:
            matched, first, last = full_alignment(words, found, low, high)
            out += [(matched, first, last)] * (matched >= needs)
            open_ += [(low, first), (last + 1, high)] if matched else []
    return sorted(out)


@pytest.mark.parametrize("name", ["MIT whole", "BSD-3-Clause whole", "ISC whole", "GPL-2.0 header", "Apache-2.0 header", "CC BY 4.0 long notice", "MIT notice", "CC BY 4.0 notice"])
def test_whole_licenses_have_the_coverage_and_span_of_a_full_alignment(name):
    rng = random.Random(name)
    template = license_scan.TEMPLATES[name]
    words = license_scan.tokens(template)
    scanner, n = license_scan.Scanner({name: template}), 0
    for lost, put in ((0, 0), (0.05, 0), (0.1, 0.1), (0.2, 0.2), (0.3, 0.05), (0.36, 0), (0.5, 0.2)):
        said = []
        for _ in range(2):
            said += [rng.choice(words) if rng.random() < 0.3 else f"w{rng.randrange(99)}" for _ in range(60)]
            for word in words:
                said += [word] if rng.random() >= lost else rng.choice([[], ["other"]])
                said += ["more"] if rng.random() < put else []
        want = all_alignments(words, said, scanner.least)
        got = sorted((m.matched, m.first, m.last) for m in scanner.matches(said))
        assert got == want, (lost, put)
        text = "İ " + ", ".join(said)  # longer in lower case
        spans = [text[a:b] for _, a, b in scanner.scan(text)]
        for (_, first, last), span in zip(sorted(want, key=lambda m: m[1]), spans, strict=True):
            assert span == ", ".join(said[first : last + 1])
        n += len(want)
    assert n >= 8


def test_fingerprints_are_fewer_than_words_and_shared_by_every_pair_of_neighbours():
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    long = [t for t, paired in enumerate(scanner.paired) if paired]
    assert len(scanner.at_template) < 0.8 * sum(len(scanner.places[t]) for t in long)
    for t in long:
        places = scanner.places[t]
        for i in range(len(places) - 1):
            of, position, where = scanner.hits(np.array([0, *places[i : i + 2], 0]))
            assert any(a == t and p - i == w - 1 for a, p, w in zip(of, position, where, strict=True))
