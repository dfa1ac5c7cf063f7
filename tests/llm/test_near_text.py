"""Near-duplicate texts against brute-force Jaccard, on planted copies, hot groups and odd tables."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from panelforge.llm import near_text

SCHEMA = "doc_id long, text string, node string, root string, p int, lo int, w0 long, h long"


def words(rng, n):
    return [f"{rng.choice('bcdfghklmnprst')}{rng.randrange(4000)}" for _ in range(n)]


def planted(rng, groups, copies, size):
    """Texts and near copies of them: some words replaced, so that similarities lie on both sides of 0.8."""
    out = []
    for _ in range(groups):
        base = words(rng, rng.randrange(*size))
        out.append(base)
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(1, max(2, len(text) // 45))):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10**9)}"
            out.append(text)
    return [" ".join(t) for t in out]


def brute(texts):
    """Pairs of similarity 0.8 or more, and the groups that they make."""
    sets = [frozenset(near_text.shingles(t or "").tolist()) for t in texts]
    by_shingle, shared = defaultdict(list), Counter()
    for i, s in enumerate(sets):
        for x in s:
            by_shingle[x].append(i)
    for held in by_shingle.values():
        shared.update((a, b) for n, a in enumerate(held) for b in held[n + 1 :])
    pairs = [(a, b) for (a, b), n in shared.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)]
    return pairs + [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if not sets[a] and not sets[b]]


def grouped(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    return {r["doc_id"]: r["root"] for r in near_text.near_text_groups(df, "doc_id").collect()}


def test_planted_copies_are_found_and_others_left(spark):
    rng = random.Random(3)
    texts = planted(rng, 250, 3, (60, 400)) + [" ".join(words(rng, 80)) for _ in range(800)]
    pairs = brute(texts)
    root = grouped(spark, texts)
    found = sum(root[a] == root[b] for a, b in pairs)
    assert len(pairs) > 700 and found >= 0.97 * len(pairs)
    joined = list(range(len(texts)))

    def find(i):
        while joined[i] != i:
            i = joined[i]
        return i

    for a, b in pairs:
        joined[max(find(a), find(b))] = min(find(a), find(b))
    of = defaultdict(set)
    for i, r in root.items():
        of[r].add(find(i))
    assert all(len(v) == 1 for v in of.values())  # nothing is grouped that the exact rule keeps apart


def test_one_hot_group_of_near_copies(spark, monkeypatch):
    """A third of all rows are variants of one text: parts meet in pairs, the answer stays."""
    rng = random.Random(4)
    base = words(rng, 300)
    hot = []
    for i in range(300):
        text = list(base)
        text[rng.randrange(300)] = f"only{i}"
        hot.append(" ".join(text))
    texts = hot + hot[:100] + [" ".join(words(rng, 60)) for _ in range(600)]
    for part in (near_text.PART, 64):
        monkeypatch.setattr(near_text, "PART", part)
        monkeypatch.setattr(near_text, "SET_PART", part)
        root = grouped(spark, texts)
        assert len({root[i] for i in range(400)}) == 1 and len(set(root.values())) == 601


def test_bit_sliced_distances():
    rng = np.random.default_rng(5)
    table = rng.integers(0, 1 << 63, (300, 2), dtype=np.int64).astype(np.uint64) << np.uint64(1)
    table[:60] = table[0] ^ (np.uint64(1) << rng.integers(0, 64, (60, 2)).astype(np.uint64)) * (rng.random((60, 2)) < 0.9)
    for i in range(60, 140):  # distances around the radius
        flips = rng.permutation(128)[: 25 + i % 14]
        for b in flips:
            table[i, b // 64] ^= np.uint64(1 << int(b % 64))
        table[i] ^= table[0] ^ (table[i] & np.uint64(0)) if i % 2 else np.uint64(0)
    want = {(i, j) for i in range(300) for j in range(300) if sum(int(a ^ b).bit_count() for a, b in zip(table[i], table[j])) <= near_text.RADIUS}
    got = {(i, j) for i, lanes in near_text.within(table, table, slab=70) for j in lanes.tolist()}
    assert got == want and len(want) > 300


def test_table_plan_grows_with_the_table():
    plans = [near_text.table_plan(10**e) for e in range(2, 11)]
    assert plans == sorted(plans) and plans[0][0] >= 1
    for bits, tables in plans:
        assert (1 - near_text.AGREE**bits) ** tables <= 1.01 * near_text.MISS


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"w{i}" for i in range(20000))
    texts = [None, "", " \n ", "one", "One", "one two", long, long + " end", "x" * 9000, "a b c d e f", "A B C D E F"]
    rows = [(i, t, "n", "r", 0, 0, 1, 2) for i, t in enumerate(texts)]
    rows += [(3, "one", "n", "r", 0, 0, 1, 2)] * 2 + [(3, "other text under this id", *[None] * 6), (None, "no id here", *[None] * 6), (None, "second without id", *[None] * 6), (None, "one", *[None] * 6)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_odd_tables(spark, odd):
    out = near_text.near_duplicate_free(odd)
    assert out.columns == odd.columns
    kept = sorted(((r["doc_id"], (r["text"] or "")[:24]) for r in out.collect()), key=repr)
    want = [(0, ""), (3, "one"), (5, "one two"), (6, "w0 w1 w2 w3 w4 w5 w6 w7 "), (8, "x" * 24), (9, "a b c d e f"), (3, "other text under this id"), (None, "no id here"), (None, "second without id")]
    assert kept == sorted(want, key=repr)
    assert near_text.near_duplicate_free(spark.createDataFrame([], SCHEMA)).collect() == []


def test_pipeline_on_empty_and_odd_tables(spark, tmp_path, odd):
    base = "doc_id long, text string, lang string, source string, n_chars long"
    labels = spark.createDataFrame([(3, 1, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")
    rng = random.Random(6)
    good = [(i + 50, " ".join(words(rng, 40)), "en", "s", 0) for i in range(30)]
    odd_rows = [(r["doc_id"], r["text"], None, None, None) for r in odd.collect()]
    for name, rows in (("empty", []), ("odd", odd_rows + good + good[:3])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(rows, base).write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        out = corpus_pipeline.run(spark, folder).collect()
        ids = [r["doc_id"] for r in out if r["start"] == 0]
        assert len(ids) == len(set(ids)) and (not rows or set(range(50, 80)) <= set(ids))
