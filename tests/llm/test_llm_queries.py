"""Every corpus query: against its SQL where it has one, else against plain Python."""

import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from oracle import compare, connect

import corpus_pipeline
from tidemark.llm import license_scan, queries

FOLDER = "/root/testdata/sf0.001"
SQL = queries.oracle_sql()
WORD = re.compile("[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs():
    return duckdb.execute(f"SELECT doc_id, text, lang, source FROM '{FOLDER}/documents.parquet' ORDER BY 1").fetchall()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    problem, rows = compare(spark, connect(FOLDER), name, queries.queries()[name], SQL[name], FOLDER)
    assert problem == "" and rows


def plain_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    counts = Counter(bit for s in shingles for bit in range(64) if xxhash.xxh64_intdigest(s.encode(), 42) >> bit & 1)
    return sum(1 << bit for bit, n in counts.items() if 2 * n > len(shingles))


def test_simhash_against_all_pairs(spark, docs):
    prints = {doc: plain_fingerprint(text) for doc, text, _, _ in docs}
    root = {doc: doc for doc in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op7_simhash(spark, FOLDER).collect()}
    assert got == {doc: (f"{prints[doc]:016x}", find(doc)) for doc in ids}


def test_quality_on_held_out_labels(spark):
    labels = dict(duckdb.execute("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall())
    rows = [r for r in queries.op5_rule_ensemble(spark, "/root/testdata/sf0.01").collect()]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows) and len(rows) == 1000
    known = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in known) / len(known) > 0.95


def test_language_on_held_out_documents(spark):
    langs = dict(duckdb.execute("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").fetchall())
    rows = queries.op6_language_id(spark, "/root/testdata/sf0.01").collect()
    apart = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == langs[r.doc_id] for r in apart) / len(apart) > 0.98


def full_matches(text, scanner):
    """Templates that an alignment with no index and no band finds in a text."""
    found = license_scan.tokens(text or "")
    out = set()
    for t, words in enumerate(scanner.words):
        score = np.zeros((len(words) + 1, len(found) + 1), int)
        matched = np.zeros_like(score)
        for i in range(1, len(words) + 1):
            for j in range(1, len(found) + 1):
                same = words[i - 1] == found[j - 1]
                score[i, j], matched[i, j] = max(
                    (score[i - 1, j - 1] + (2 if same else -1), matched[i - 1, j - 1] + same),
                    (score[i - 1, j] - 1, matched[i - 1, j]), (score[i, j - 1] - 1, matched[i, j - 1]), (0, 0),
                )
        if len(found) and matched.flat[score.argmax()] >= scanner.least * len(words):
            out.add(scanner.names[t])
    return out


def test_license_scan_against_full_alignment(spark, docs):
    notices = {k: v for k, v in license_scan.TEMPLATES.items() if len(v) < 110}
    scanner = license_scan.Scanner(notices)
    some = [(d, t) for d, t, _, _ in docs if len(t or "") < 600 or re.search("(?i)licen", t)][:60]
    short = [(d, t if len(t) < 1500 else t[-1500:]) for d, t in some]
    want = {d: names for d, t in short if (names := full_matches(t, scanner))}
    frame = spark.createDataFrame(short, "doc_id long, text string")
    got = defaultdict(set)
    for r in license_scan.scan(frame, notices).collect():
        got[r.doc_id].add(r.template)
    assert set(got) == set(want) and len(want) > 2
    assert all(got[d] <= want[d] for d in want)


def check_bins(rows, capacity=2048):
    room = Counter()
    for r in rows:
        if r.bin is not None:
            room[r.bin] += r.n_words
    assert max(room.values()) <= capacity
    return room


def test_packing_places_every_word_once(spark, docs):
    rows = queries.op10_packing(spark, FOLDER).collect()
    room = check_bins(rows)
    sizes = {d: len(WORD.findall(t or "")) for d, t, _, _ in docs}
    spans = defaultdict(list)
    for r in rows:
        spans[r.doc_id].append((r.first_word, r.first_word + r.n_words))
    for doc, size in sizes.items():
        ends = sorted(spans[doc])
        assert ends[0][0] == 0 and ends[-1][1] == size and all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))
    text = {d: tuple(WORD.findall((t or "").lower())) for d, t, _, _ in docs}
    source = {d: s for d, _, _, s in docs}
    inside = defaultdict(list)
    for r in rows:
        inside[r.bin].append(r.doc_id)
    for held in inside.values():
        assert max(Counter(text[d] for d in held).values()) == 1 and max(Counter(source[d] for d in held).values()) <= 2
    assert len(room) <= 1.3 * math.ceil(sum(sizes.values()) / 2048) + 4


def shingle_set(text):
    found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def test_pipeline_stages(spark, docs):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, sizes = frame.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in frame.collect()}
        frame = stage(spark, frame, FOLDER)
        assert frame.columns == columns, name
        after = frame.collect()
        assert {r.doc_id for r in after} <= set(before)
        sizes.append(len(after))
        if name == "near_duplicates":
            sets = {r.doc_id: shingle_set(r.text) for r in after}
            ids = sorted(sets)
            assert all(len(sets[a] & sets[b]) < 0.8 * len(sets[a] | sets[b]) for i, a in enumerate(ids) for b in ids[i + 1 :])
        if name == "mixture":
            copies = Counter(r.doc_id for r in after)
            assert max(copies.values()) <= 2
            taken, whole = Counter(), {d: len(WORD.findall(r.text or "")) for d, r in before.items()}
            for r in after:
                taken[r.source] += len(WORD.findall(r.text))
                assert r.n_chars == len(r.text) and len(WORD.findall(r.text)) <= whole[r.doc_id]
            assert abs(sum(taken.values()) / (1.5 * sum(whole.values())) - 1) < 0.01
    assert sizes[0] >= sizes[1] >= sizes[2] > 100
    rows = corpus_pipeline.packed(spark, frame, FOLDER).collect()
    check_bins(rows)
    assert max(Counter((r.bin, r.doc_id) for r in rows).values()) == 1
    assert sum(r.n_words for r in rows) == sum(len(WORD.findall(r.text)) for r in after)
