"""Repeated windows, token alignment and hard negatives against plain versions."""

import hashlib
import math
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from plumelake.llm import alignment, hard_negatives as hn, repeated_windows as rw, topk, vectors

LAST = 2 ** 63 - 1


# --- repeated windows ---------------------------------------------------------------

def without_windows(rows, length=20):
    """rows: (id, text), one row after the other."""
    order = lambda d: LAST if d is None else d      # noqa: E731
    lowest = {}
    for doc, text in rows:
        w = brute.words(text)
        for i in range(len(w) - length + 1):
            g = tuple(w[i:i + length])
            lowest[g] = min(lowest.get(g, LAST), order(doc))
    out = []
    for doc, text in rows:
        w, gone, seen = brute.words(text), set(), set()
        for i in range(len(w) - length + 1):
            g = tuple(w[i:i + length])
            if lowest[g] < order(doc) or g in seen:
                gone |= set(range(i, i + length))
            seen.add(g)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def sorted_rows(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("part_bytes", [1 << 21, 500])
def test_windows_equal_plain_version(crowded, corpus, part_bytes):
    got = rw.remove_windows(crowded, with_text=True, part_bytes=part_bytes)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
    assert sorted_rows(got.collect()) == sorted_rows(without_windows([r[:2] for r in corpus]))


def test_windows_of_other_lengths(docs, corpus):
    got = rw.remove_windows(docs, length=12, base=3).collect()
    assert sorted_rows(got) == sorted_rows(r[:4] for r in without_windows([r[:2] for r in corpus], 12))
    with pytest.raises(ValueError):
        rw.remove_windows(docs, length=12, base=5)


def test_windows_at_the_edges(spark):
    """Exactly the length, one less, runs over the border of documents, overlapping and
    periodic windows, words that differ in blanks only, and equal ids."""
    w = [f"w{i}" for i in range(60)]
    rows = [(5, " ".join(w[:20])), (3, "x " + "\t".join(w[:20]) + " y"), (9, " ".join(w[:19])),
            (1, " ".join(w[40:50])), (2, " ".join(w[50:60])), (4, " ".join(w[40:60])), (6, "a b " * 40),
            (7, "a b " * 11), (8, " ".join(w[:40])), (8, " ".join(w[20:60])), (8, " ".join(w[:40])), (10, None),
            (11, "\x1c".join(w)), (12, " ".join(w).replace(" ", " ")), (None, " ".join(w[:30])),
            (None, " ".join(w[10:40])), (-4, " ".join(w[5:27]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = rw.remove_windows(docs, with_text=True, part_bytes=64)
    assert sorted_rows(got.collect()) == sorted_rows(without_windows(rows))


def test_windows_leave_little_to_later_levels(spark, monkeypatch):
    """Only text under repeats goes beyond the first level; no stored table stays."""
    import random
    rng = random.Random(1)
    shared = " ".join(str(rng.random()) for _ in range(60))
    rows = [(n, " ".join(str(rng.random()) for _ in range(300)) + (" " + shared if n % 10 == 0 else ""))
            for n in range(100)]
    seen = {}
    written = rw.Workspace.written

    def spy(self, df, name):
        table = written(self, df, name)
        seen[name] = table.where(F.col("slice") == -1).agg(F.sum(F.length("payload"))).first()[0]
        return table
    monkeypatch.setattr(rw.Workspace, "written", spy)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gone = rw.remove_windows(docs, part_bytes=4000).agg(F.sum("n_removed")).first()[0]
    assert gone == 9 * 60
    assert list(seen) == ["parts", "level-10", "level-20"] and seen["level-10"] < 0.2 * seen["parts"]


def test_windows_of_nothing(no_docs):
    assert rw.remove_windows(no_docs).collect() == []


def test_levels():
    assert rw.levels(20, 5) == [5, 10, 20]
    codes = np.arange(100, dtype=np.uint64) % np.uint64(7)
    for n in (5, 10, 20):
        assert len(set(rw._windows(codes, n).tolist())) == 7
        assert len(rw._windows(codes[:n - 1], n)) == 0


# --- alignment ----------------------------------------------------------------------

@pytest.fixture(scope="module")
def coders():
    return alignment.Coders(*alignment.default_paths())


def plain_alignment(coders, rows):
    """Whole texts at once, and every pair of tokens compared that can overlap."""
    found, counts = [], Counter()
    for doc, text in rows:
        whole = " " + (text or "")
        a = coders.whole.encode(whole, add_special_tokens=False).ids if text else []
        b = coders.b.encode(text) if text else []
        parts_a, parts_b = [coders.bytes_a[i] for i in a], [coders.bytes_b[i] for i in b]
        if not b"".join(parts_a) == b"".join(parts_b) == whole.encode():
            a = b = parts_a = parts_b = []
        ends_a, ends_b = np.cumsum([len(p) for p in parts_a]), np.cumsum([len(p) for p in parts_b])
        links, j = [], 0
        for i, end in enumerate(ends_a):
            begin = end - len(parts_a[i])
            while j and ends_b[j - 1] > begin:
                j -= 1
            while j < len(b) and ends_b[j] - len(parts_b[j]) < end:
                if ends_b[j] > begin:
                    links.append((a[i], b[j]))
                j += 1
        both = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        groups, x, y = [], 0, 0
        for end in both:
            i, j2 = int(np.searchsorted(ends_a, end)) + 1, int(np.searchsorted(ends_b, end)) + 1
            groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j2])))
            x, y = i, j2
        counts.update(links)
        found.append((doc, len(a), len(b), groups, links))
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return [(doc, n_a, n_b, len(groups), len(links), sum(counts[p] == top[p[1]] for p in links),
             sum(counts[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
            for doc, n_a, n_b, groups, links in found], counts


ODD = ["a▁b", "a b   c", "🙂 x 🙂🙂", "x\u0085 y", " \n x", "a\n\n  b", "x ", " ", "  ", "　 y", "ﬁ ①",
       "<|endoftext|> <s> </s> <unk>", "\0 a\0b", "it's don't 'll ", "12 345 6,7", "中文 字符 テスト 한국어", "\tq\r\n z",
       "é é ​ x", "a" * 3000, "ab " * 2000 + "end", "﻿x   y", "न म स्ते दुनिया", "x\x1c y\x1f z", "."]


@pytest.mark.parametrize("part_bytes", [4 << 20, 300])
def test_alignment_equals_plain_version(spark, coders, corpus, part_bytes):
    rows = [r[:2] for r in corpus if len(r[1] or "") < 5000] + [(100 + n, t) for n, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("n_a", F.lit("clash"))
    aligned, pairs = alignment.align(docs, part_bytes=part_bytes)
    want, counts = plain_alignment(coders, rows)
    assert sorted_rows(aligned.collect()) == sorted_rows(want)
    assert {(r.a, r.b): r.n for r in pairs.collect()} == counts
    assert {r.b: r.top for r in pairs.collect()} == {b: max(n for (_, c), n in counts.items() if c == b)
                                                   for _, b in counts}


def test_chunks_are_encoded_like_whole_texts(coders, corpus):
    for text in [r[1] for r in corpus if r[1]] + ODD:
        own = alignment.chunks(text)
        assert "".join(" " + c for c in own) == " " + text
        (a, b), (per_a, per_b), ok, sizes = coders.encode(own)
        assert sizes.tolist() == [len(c.encode()) + 1 for c in own]
        if ok.all():
            assert a.tolist() == coders.whole.encode(" " + text, add_special_tokens=False).ids
            assert b.tolist() == coders.b.encode(text)
            assert per_a.sum() == len(a) and per_b.sum() == len(b)
        else:
            assert "▁" in text


def test_alignment_of_nothing(no_docs):
    aligned, pairs = alignment.align(no_docs)
    assert aligned.collect() == [] and pairs.collect() == []


# --- hard negatives -----------------------------------------------------------------

def plain_negatives(rows, every):
    """rows: (id, vector, label)."""
    known = [(d, [math.floor(256 * x) for x in v], lab) for d, v, lab in rows
             if d is not None and v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, (anchor, q, label) in enumerate(known):
        if anchor % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(q, v)), d, lab) for j, (d, v, lab) in enumerate(known)
                         if j != i and len(v) == len(q)), key=lambda s: s[:2])
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            inside = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:10]
            out += [(anchor, positive, n + 1, d, -p, -s) for n, (s, d, _) in enumerate(inside)]
    return out


@pytest.fixture(scope="module")
def labelled(spark):
    """Ties, copies of one vector for a third of the rows, repeated rows and ids, vectors
    of other lengths, nulls and numbers that are not finite."""
    rng = np.random.default_rng(3)
    rows = [(n, rng.normal(0.05, 0.2, 6).round(1).tolist(), int(rng.integers(0, 3))) for n in range(300)]
    rows = [(n, rows[0][1] if n % 3 == 0 else v, lab) for n, v, lab in rows]
    rows += [rows[0], rows[0], (20, rows[7][1], 1), (-40, rows[11][1], 2), (400, [0.1, 0.2], 1), (420, [0.1, 0.3], 2),
             (421, [0.2, 0.3], 1), (440, [], 1), (441, [], 2), (None, rows[1][1], 1), (460, None, 1),
             (480, rows[1][1], None), (500, [0.1, float("nan"), 0.0, 0.0, 0.0, 0.0], 1), (520, [0.1, None, 0.0, 0.0, 0.0, 0.0], 1),
             (540, [float("inf")] * 6, 1), (560, [0.0] * 6, 0)]
    return rows


@pytest.mark.parametrize("block,anchor_block", [(2048, 256), (7, 2)])
def test_negatives_equal_plain_version(spark, labelled, block, anchor_block):
    df = spark.createDataFrame(labelled, "vec_id long, embedding array<double>, label int").repartition(4)
    df = df.withColumns({"score": F.lit("clash"), "rank": F.lit("clash"), "dim": F.lit("clash")})
    got = hn.hard_negatives(df, 20, block=block, anchor_block=anchor_block)
    assert sorted_rows(got.collect()) == sorted_rows(plain_negatives(labelled, 20))


def test_negatives_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hn.hard_negatives(none).collect() == []
    alone = spark.createDataFrame([(100, [0.5], 1), (3, [0.5], 1)], "vec_id long, embedding array<float>, label int")
    assert hn.hard_negatives(alone).collect() == []


def test_highest_keeps_ties():
    scores = np.array([[5, 3, 3, 3, 1], [9, 8, 7, 6, 5]])
    allowed = np.array([[True] * 5, [False, True, False, False, False]])
    r, c = vectors.highest(scores, allowed, 2)
    assert sorted(zip(r.tolist(), c.tolist())) == [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1)]


# --- top-k ---------------------------------------------------------------------------

def test_top_k_completes_few_scores(spark):
    """By the threshold only a few of all scores are put together, and all the best are."""
    rng = np.random.default_rng(5)
    rows = [(n, rng.normal(0, 0.2, 32).tolist()) for n in range(2000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got, sent = topk._search(df, 5, F.col("vec_id") % 50 == 0, topk.SEGMENTS, 300, 16)
    assert sent < 0.2 * 40 * 2000
    assert sorted(map(tuple, got.collect())) == sorted(brute.top_k(rows, 5, 50))


def test_copies_of_one_vector_and_of_a_query(spark):
    """Two thirds are one vector; query rows that repeat have results each, with each other."""
    one = [0.5, -0.25, 0.125]
    rows = [(n, one if n % 3 else [0.01 * n, 0.0, -0.01 * n]) for n in range(120)] + [(50, one), (50, one), (60, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    got = sorted(map(tuple, topk.top_k(df, 4, F.col("vec_id") % 10 == 0, block=16, query_block=4).collect()))
    assert got == brute.top_k(rows, 4, 10)


@pytest.mark.parametrize("size", [100, 40_000, 2 ** 29])
def test_products_that_reach_a_limit(size):
    """As floats, doubles and longs: all of them, exactly, from the low to the high limit of a row."""
    rng = np.random.default_rng(size)
    a, b = rng.integers(-size, size, (37, 9)), rng.integers(-size, size, (530, 9))
    a, b = (vectors.Rows(vectors.matrix(vectors.body(x), 9, len(x))) for x in (a, b))
    assert vectors.kind(a, b) is {100: np.float32, 40_000: np.float64, 2 ** 29: np.int64}[size]
    exact = a.values.astype(np.int64).astype(object) @ b.values.astype(np.int64).astype(object).T
    ordered = np.sort(exact.astype(np.float64), axis=1)
    low, high = (ordered[:, [300, 500]].T + ordered[:, [301, 501]].T) / 2
    got = [set(zip(*(x.tolist() for x in piece))) for piece in vectors.reaching(a, b, low, high)]
    want = {(r, c, s) for r, row in enumerate(exact) for c, s in enumerate(row) if low[r] <= s <= high[r]}
    assert set().union(*got) == want and sum(map(len, got)) == len(want)
    best = {(r, c) for r, row in enumerate(exact) for c, s in enumerate(row) if s >= sorted(row)[-3]}
    most = [x for r, c, _ in vectors.reaching(a, b, np.full(37, -np.inf), most=3) for x in zip(r.tolist(), c.tolist())]
    assert best <= set(most) and len(most) < 37 * 10


def test_best_by_one_number_is_best_by_three():
    rng = np.random.default_rng(2)
    for wide in (1, 2 ** 60):       # the second has no one number for group and score
        groups, scores, ids = rng.integers(0, 9, 400), wide * rng.integers(-3, 4, 400), rng.permutation(400)
        ranked = sorted(range(400), key=lambda i: (groups[i], -int(scores[i]), ids[i]))
        want = [i for n, i in enumerate(ranked) if n < 4 or groups[ranked[n - 4]] != groups[i]]
        assert vectors.best(groups, ids, scores, 4).tolist() == want


def test_blocks_meet_without_pairs_of_them(spark):
    """A task gets a block and an asked block once, however many it meets, and the asked ones first."""
    blocks = spark.createDataFrame([(3, 10 + n, b"c") for n in range(12)], "dim int, block long, data binary")
    asked = spark.createDataFrame([(3, n, b"q") for n in range(8)], "dim int, q int, data binary")
    tasks = vectors.meet(asked, blocks, 80, 3, 40).rdd.glom().collect()
    assert len(tasks) == 6 and sum(map(len, tasks)) == 8 * 3 + 12 * 2
    pairs = [(r.q_q, c.c_block) for rows in tasks for r in rows if r.turn == 0 for c in rows if c.turn == 1]
    assert sorted(pairs) == [(q, 10 + n) for q in range(8) for n in range(12)]
    assert all([r.turn for r in rows] == sorted(r.turn for r in rows) for rows in tasks)


@pytest.fixture
def small_tasks(monkeypatch):
    """Tasks that hold a few rows of either side, so that there are many."""
    monkeypatch.setattr(vectors, "SPAN", 30)
    monkeypatch.setattr(topk, "HELD", 6)
    monkeypatch.setattr(hn, "HELD", 6)


def test_top_k_in_many_tasks(spark, small_tasks):
    rng = np.random.default_rng(8)
    rows = [(n, rng.normal(0, 0.2, 8).round(1).tolist()) for n in range(300)] + [(1000 + n, [0.1 * n] * 5) for n in range(40)]
    rows = [(n, rows[0][1] if n % 4 == 0 and n < 300 else v) for n, v in rows] + [rows[10], rows[20], rows[20]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(map(tuple, topk.top_k(df, 4, F.col("vec_id") % 10 == 0, block=9, query_block=3).collect()))
    assert got == brute.top_k(rows, 4, 10)


def test_negatives_in_many_tasks(spark, labelled, small_tasks):
    df = spark.createDataFrame(labelled, "vec_id long, embedding array<double>, label int").repartition(3)
    got = hn.hard_negatives(df, 20, block=9, anchor_block=3)
    assert sorted_rows(got.collect()) == sorted_rows(plain_negatives(labelled, 20))


def test_held_entries_stay_few():
    """Entries that come after the best leave again, so a task holds a bounded number of them."""
    held, rng, most = vectors.Best(50, 10), np.random.default_rng(4), 0
    for _ in range(60):
        held.add(rng.integers(0, 50, 3000), rng.integers(0, 10 ** 6, 3000), rng.integers(0, 10 ** 9, 3000))
        most = max(most, sum(len(p[0]) for p in held.parts))
    groups, _, scores = held.trim()
    assert len(groups) == 500 and most < 15_000
    assert (held.low == [scores[groups == g].min() for g in range(50)]).all()
    few = vectors.Best(2, 10)
    few.add(np.array([1, 0, 1]), np.array([5, 6, 4]), np.array([7, 9, 7]))
    assert [c.tolist() for c in few.trim()] == [[0, 1, 1], [6, 4, 5], [9, 7, 7]] and (few.low == -np.inf).all()
