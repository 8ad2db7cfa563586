"""Ball codes, line dedup and importance resampling against plain Python, with odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import ball_codes, importance, line_dedup

# --- ball codes -------------------------------------------------------------------------------


def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Full searches in Python integers: {row: (codes, error)} and the codebooks."""
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v in kept), default=0) // parts))
    ints = [(i, [math.floor(scale * x) for x in v] + [0] * (parts * width - len(v))) for i, v in kept]
    first = [v for _, v in sorted(ints, key=lambda r: (r[0] is None, r[0], r[1]))][:entries]
    books = [[v[p * width : (p + 1) * width] for v in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def search():
        return [[min((far(v[p * width : (p + 1) * width], e), j) for j, e in enumerate(books[p])) for p in range(parts)] for _, v in ints]

    for _ in range(rounds):
        found = search()
        for p in range(parts):
            for j in range(len(books[p])):
                held = [v[p * width : (p + 1) * width] for (_, v), code in zip(ints, found, strict=True) if code[p][1] == j]
                if held:
                    books[p][j] = [sum(c) // len(held) for c in zip(*held, strict=True)]
    return sorted(((i, [j for _, j in code], sum(d for d, _ in code)) for (i, _), code in zip(ints, search(), strict=True)), key=repr), books


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, i % 3 if i is not None and i % 4 else None, "own", "own") for i, v in rows], "vec_id long, embedding array<double>, label int, codes string, error string").repartition(3)


def same_codes(spark, rows):
    coded, books = ball_codes.encode(vectors(spark, rows))
    wanted, book = brute_codes(rows)
    found = sorted(((r.vec_id, list(r.codes), r.error) for r in coded.collect()), key=repr)
    assert [x[:2] for x in found] == [x[:2] for x in wanted]
    assert [x[2] for x in found] == [x[2] if x[2] < 1 << 63 else None for x in wanted]
    assert books.book == book
    return coded, books, wanted


@pytest.mark.parametrize("seed", [1, 2])
def test_codes_with_ties_and_clusters(spark, seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)]) for i in range(300)]
    rows += [(300 + i, [rng.randrange(3) / 4096 for _ in range(16)]) for i in range(200)]  # many equal distances
    rows += [(i, rows[7][1]) for i in range(500, 560)]
    same_codes(spark, rows)


def test_codes_of_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(rng.choice((0, 5, 13, 17)))]) for i in range(60)]
    rows += [(100, None), (101, [1.0, None]), (102, [math.nan] * 17), (103, [math.inf, 0.0]), (104, [-math.inf]), (None, [0.5] * 8), (None, [0.25] * 8), (5, rows[5][1]), (5, [9.0])]
    coded, books, wanted = same_codes(spark, rows)
    digest = ball_codes.digest(coded, books).collect()
    assert len(digest) == len(wanted) == 64 and len({r.codebooks_sha256 for r in digest}) == 1
    assert all(len(r.code) == 16 and r.label_error >= r.error for r in digest)
    small, _, _ = same_codes(spark, rows[:5])
    assert small.count() == 5
    empty, none = ball_codes.encode(vectors(spark, rows).limit(0))
    assert none is None and ball_codes.digest(empty, none).collect() == []


def test_codes_of_huge_components(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.choice((-3, 2, 9, 30)) for _ in range(8)]) for i in range(80)]
    coded, books, _ = same_codes(spark, rows)
    by = {r.vec_id: r for r in ball_codes.digest(coded, books).collect()}
    assert any(r.error is None and r.label_error is None for r in by.values())


def test_balls_find_what_a_full_search_finds():
    rng = np.random.default_rng(5)
    for _ in range(200):
        before = rng.integers(-4, 5, (6, 2))
        book, moved = before.copy(), rng.random(6) < 0.5
        book[moved] += rng.integers(-2, 3, (int(moved.sum()), 2))
        x = rng.integers(-6, 7, (80, 2))
        start = ball_codes.nearest(x, before)
        moved = (book != before).any(axis=1)
        assert (ball_codes.by_balls(x, start, book, moved) == ball_codes.nearest(x, book)).all()


# --- lines ------------------------------------------------------------------------------------

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_lines(rows, least_length=40, least_docs=5):
    key = lambda line: line.strip(WHITE).translate(LOWER)
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_length:
                holders.setdefault(key(line), set()).update({doc_id} - {None})
    common = {k: max(v) for k, v in holders.items() if len(v) >= least_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if common.get(key(x), doc_id) == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), text if len(kept) == len(lines) else "\n".join(kept)))
    return sorted(out, key=repr)


def test_lines_against_plain_python(spark):
    rng = random.Random(6)
    shared = ["x" * 39 + "é", "y" * 39, "  Ünder " + "z" * 40 + "\t", "  ünder " + "z" * 40, "ABC " * 12, "\tabc " * 12, " " + "q" * 45, "q" * 45, "İ" * 40]
    rows = [(i, "\n".join(rng.choice([*shared, f"own line {i} of {rng.random()}", "", "short"]) for _ in range(rng.randrange(12)))) for i in range(60)]
    long_text = "\n".join(f"line {i % 7000} of a very long text, longer than forty" for i in range(20_000))
    rows += [(100 + i, long_text) for i in range(6)] + [(105, long_text), (200, None), (201, ""), (None, long_text), (None, shared[0]), (None, None), (3, shared[0]), (3, shared[0])]
    docs = spark.createDataFrame([(*r, "own", "own", "own") for r in rows], "doc_id long, text string, at string, h1 string, __lost string").repartition(3)
    wanted = brute_lines(rows)
    found = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_dedup.report(docs).collect()), key=repr)
    assert found == wanted and sum(r[2] for r in wanted) > 100_000
    whole = line_dedup.deduplicate(docs)
    assert whole.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in whole.collect()), key=repr) == sorted(((r[0], r[3]) for r in wanted), key=repr)
    assert whole.where("at <> 'own' OR h1 <> 'own' OR __lost <> 'own'").count() == 0
    assert line_dedup.deduplicate(docs.limit(0)).collect() == []


# --- importance resampling --------------------------------------------------------------------


def brute_draw(docs, target, order, percent=10, least_words=20, buckets=10_000, seed="2024"):
    find = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    def features(text):
        found = find(text)
        return [zlib.crc32(" ".join(found[i : i + n]).encode()) % buckets for n in range(1, order + 1) for i in range(len(found) - n + 1)]

    s, t = Counter(b for _, x in docs for b in features(x)), Counter(b for x in target for b in features(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        found = features(text)
        weight = sum(gain[b] for b in found)
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, len(find(text))])
    may = sorted((r for r in rows if r[3] is not None and r[5] >= least_words), key=lambda r: (-r[3], r[0]))
    for place, row in enumerate(may[: percent * len(may) // 100], 1):
        row[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=repr)


@pytest.mark.parametrize("order", [1, 3])
def test_draw_against_plain_python(spark, order):
    rng = random.Random(7)
    known = ["Café", "naïve", "ÉTÉ", "one", "Two", "x1", "2024", "日本語", " ", "a\x00b", "don't", "İx", "K"]
    text = lambda n: "".join(rng.choice(known) + rng.choice([" ", "\n", "--", "\t"]) for _ in range(n))
    docs = [(i, text(rng.randrange(60))) for i in range(250)]
    docs += [(300, None), (301, ""), (302, "... !!!"), (None, text(50)), (None, None), (303, text(200_000)), (7, docs[7][1]), (7, docs[7][1])]
    target = [text(30).upper() for _ in range(9)] + [None, ""]
    frame = spark.createDataFrame([(*d, "own", "own") for d in docs], "doc_id long, text string, weight string, salt string").repartition(3)
    aims = spark.createDataFrame([(x,) for x in target], "text string")
    found = importance.resample(frame, aims, percent=40, order=order)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_draw(docs, target, order, percent=40)


def test_draw_from_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c " * 10)], "doc_id long, text string")
    assert importance.resample(docs.limit(0), docs.select("text")).collect() == []
    only = importance.resample(docs, docs.select("text").limit(0), percent=100).collect()
    assert [(r.doc_id, r.n_features, r["rank"]) for r in only] == [(1, 30, 1)]


def test_ranks_go_on_over_ranges(spark):
    rows = spark.range(5000).selectExpr("id AS doc_id", "id % 7 AS score", "rand(3) AS salt").repartition(8).persist()
    ranked = importance.numbered(rows, 4000).orderBy("rank").where("rank IS NOT NULL").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 4001))
    assert [(-r.score, r.doc_id) for r in ranked] == sorted((-r.score, r.doc_id) for r in rows.collect())[:4000]
