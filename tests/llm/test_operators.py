"""The corpus operators against brute force, and on what tables may hold: nulls, empty and long texts, ties, repeated rows, no rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from panelforge.llm import (
    common, embed_dedup, mixing_lm, near_text, packing, quality_rules, quality_sampling, queries, simhash, token_files, toxicity, url_rules, word_blocks, word_bpe,
)

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start long, node string, kept boolean, rank int, _label int"
ODD = [
    None, "", "   \n\t", "one", "It's <|endoftext|> A b<|ENDOFTEXT|>c don't", "a\x1cb\x85c d", "Σίσυφος ΑΣ é é İstanbul", "12ab..!!?x²µª \x00z",
    "word " * 3000, "x" * 5000, "same line of words here\n" * 40, " ".join(f"w{i}" for i in range(9000)), "日本語 テスト 語",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", "s", 0, i, "n", True, i, 1) for i, t in enumerate(ODD)]
    rows += [(3, "one", "en", "s", 0, 9, "n", True, 1, 0), (3, "one", "en", "s", 0, 9, "n", True, 1, 0), (None, "no id here", None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_registered(spark):
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "packing"]


@pytest.mark.parametrize("which", ["given", "odd"])
def test_token_files(spark, odd, docs, which):
    frame = odd if which == "odd" else spark.read.parquet(f"{SF}/documents.parquet")
    tokenizer = Tokenizer.from_file(queries.WORD_BPE)
    signed = lambda t: (h := xxhash.xxh64_intdigest(t.encode(), 42)) - (h >> 63 << 64)
    rows = sorted(texts(frame) if which == "odd" else docs, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1])))
    expected, start = [], 0
    for key, text in rows:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        expected.append((key, start, len(ids), crc(ids)))
        start += len(ids)
    got = [tuple(r) for r in token_files.token_files(frame, queries.WORD_BPE, 1).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_token_files_split_a_hot_key(spark):
    """2,000 rows without an id, 500 of them equal, and a real −1: no part holds most of them, and −1 stays −1."""
    rows = [(None, "equal")] * 500 + [(None, f"row {i}") for i in range(1500)] + [(-1, "minus one")] + [(i, "x") for i in range(49)]
    frame = common.stored(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "hot")
    manifest = common.stored(token_files.write_token_files(frame, common.scratch_path(spark, "hot"), queries.WORD_BPE, 1), "m")
    counts = [r["documents"] for r in manifest.collect()]
    assert sum(counts) == len(rows) and max(counts) < 1000
    ids = Counter(r["doc_id"] for r in token_files.read_token_files(manifest).collect())
    assert ids[None] == 2000 and ids[-1] == 1
    with pytest.raises(Exception, match="stands for rows without an id"):
        token_files.token_files(spark.createDataFrame([(-(1 << 63), "x")], "doc_id long, text string"), queries.WORD_BPE).collect()


def test_token_files_give_ids_back(spark, docs):
    frame = spark.createDataFrame(docs[:20], "doc_id long, text string")
    folder = common.scratch_path(spark, "t")
    rows = token_files.read_ids(token_files.write_token_files(frame, folder, queries.WORD_BPE, 1)).collect()
    tokenizer = Tokenizer.from_file(queries.WORD_BPE)
    of = dict(docs)
    assert all(r["ids"] == tokenizer.encode(of[r["doc_id"]], add_special_tokens=False).ids + [1] for r in rows) and len(rows) == 20


def test_bin_filling_is_closest():
    rng = np.random.default_rng(3)
    for _ in range(60):
        sizes = rng.integers(1, 40, 7).tolist()
        room = int(rng.integers(20, 120))
        counts = Counter(sizes)
        found = packing.fill(room, counts, sorted(counts, reverse=True))
        sums = {0}
        for s in sizes:
            sums |= {x + s for x in sums if x + s <= room}
        assert sum(s * n for s, n in found) == max(sums) and all(n <= counts[s] for s, n in found)


@pytest.mark.parametrize("which", ["given", "odd"])
def test_packing(spark, odd, docs, which):
    frame = odd if which == "odd" else spark.read.parquet(f"{SF}/documents.parquet")
    tokenizer = Tokenizer.from_file(queries.WORD_BPE)
    rows = packing.pack(packing.token_pieces(frame, queries.WORD_BPE)).collect()
    ids = defaultdict(list)
    for key, text in texts(frame) if which == "odd" else docs:
        ids[key].append(tokenizer.encode(text, add_special_tokens=False).ids + [2])
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["copy"]].append(r)
    assert len(pieces) == sum(map(len, ids.values()))
    for parts in pieces.values():
        parts.sort(key=lambda r: r["start"])
        whole = ids[parts[0]["doc_id"]][0]
        assert [r["start"] for r in parts] == list(np.cumsum([0, *[r["length"] for r in parts]])[:-1]) and sum(r["length"] for r in parts) == len(whole)
        assert all(r["ids_crc32"] == crc(whole[r["start"] : r["start"] + r["length"]]) and r["doc_tokens"] == len(whole) for r in parts)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(bins) == list(range(len(bins)))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0, *[n for _, n in parts]])[:-1]) and sum(n for _, n in parts) <= 4096
    total = sum(len(i) for v in ids.values() for i in v)
    # Remainders over half a sequence that nothing complements stay alone.
    assert len(bins) * 4096 - total < (2 if which == "odd" else 1) * 4096 + 0.01 * total


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i : i + 8])].append(i)
    repeat = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(repeat) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat), failed


def test_quality_rules(odd, docs):
    for _, text in [*texts(odd), *docs]:
        m = quality_rules.judge(text)
        assert (m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["n_repeat_words"], m["base_failed"]) == measures(text)
        words = text.encode().split()
        for n, limit in quality_rules.DUPLICATE_SHARE.items():
            seen, covered = set(), set()
            for i in range(len(words) - n + 1):
                gram = tuple(words[i : i + n])
                if gram in seen:
                    covered.update(range(i, i + n))
                seen.add(gram)
            if words and sum(len(words[i].decode()) for i in covered) > limit * m["word_chars"]:
                assert "ngrams" in m["failed"]
    rows = quality_rules.quality_rules(odd).collect()
    assert len(rows) == len(ODD) + 3 and not any(r["kept"] for r in rows if r["base_failed"])
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r["kept"] for r in rows) > 0


def print_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) > 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(values, near):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if a < b and near(a, b) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def test_simhash_groups(odd, docs, spark):
    for frame, rows in ((odd, texts(odd)), (spark.createDataFrame(docs, "doc_id long, text string"), docs)):
        prints = [(k, print_of(t)) for k, t in rows]
        roots = roots_of(sorted({p for _, p in prints}), lambda a, b: (a ^ b).bit_count() <= 4)
        first = defaultdict(list)
        for k, p in prints:
            if k is not None:
                first[roots[p]].append(k)
        expected = Counter((k, f"{p:016x}", min(first[roots[p]], default=None)) for k, p in prints)
        assert Counter(tuple(r) for r in simhash.simhash_groups(frame).collect()) == expected
    left = simhash.near_duplicate_free(odd)
    assert left.columns == odd.columns and left.filter("doc_id = 3").count() <= 1


def test_near_duplicate_stage_loses_no_text(spark):
    long = " ".join(f"w{i}" for i in range(200))
    rows = [(1, long), (1, "another text under the same id"), (2, long), (None, "a text without an id"), (None, long), (None, "one more text without an id"), (3, "said twice"), (3, "said twice")]
    left = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert Counter(map(tuple, left.collect())) == Counter([rows[0], rows[1], rows[3], rows[5], rows[6]])


@pytest.mark.parametrize("part", [2048, 20])
def test_bit_sliced_links_miss_nothing(spark, part):
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(0, 1 << 63, 6)]
    values = set(base)
    for _ in range(300):  # near copies of few bases: their keys are shared by many
        v = base[int(rng.integers(6))]
        for b in rng.integers(0, 64, int(rng.integers(1, 7))):
            v ^= 1 << int(b)
        values.add(v)
    values = sorted(values)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.fingerprint_links(spark.createDataFrame(signed, "fp long"), 4, part)
    got = {r["node"] % (1 << 64): r["root"] for r in common.components(links).collect()}
    expected = roots_of(values, lambda a, b: (a ^ b).bit_count() <= 4)
    by_root, by_expected = defaultdict(set), defaultdict(set)
    for v in values:
        by_root[got.get(v, v)].add(v)
        by_expected[expected[v]].add(v)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_expected.values()))


def test_word_bpe(odd, docs, spark):
    tokenizer = Tokenizer.from_file(queries.BYTE_BPE)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for frame, rows in ((odd, texts(odd)), (spark.createDataFrame(docs, "doc_id long, text string"), docs)):
        expected = Counter()
        for k, t in rows:
            ids = tokenizer.encode(t, add_special_tokens=False).ids
            expected[k, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(tokenizer.decode(ids, skip_special_tokens=False).encode())] += 1
        assert Counter(tuple(r) for r in word_bpe.round_trip(frame, queries.BYTE_BPE).collect()) == expected
    back = word_bpe.decode(word_bpe.encode(odd, queries.BYTE_BPE), queries.BYTE_BPE)
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter(texts(odd))


def test_near_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((30, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, (base[i % 3] + 0.05 * rng.standard_normal(16)).tolist()) for i in range(90)]
    rows += [(300 + i, base[7].tolist()) for i in range(5)] + [(320, (3 * base[8]).tolist()), (5, base[5].tolist())]
    rows += [(400, None), (401, []), (402, [0.0] * 16), (403, [float("nan")] + [1.0] * 15), (404, [None] + [1.0] * 15), (405, base[1].tolist()[:8])]
    got = embed_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    good = [(k, np.array(v, float)) for k, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    cos = lambda a, b: len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95
    near = [[cos(a, b) for _, b in good] for _, a in good]
    roots = roots_of(list(range(len(good))), lambda i, j: near[i][j])
    least = {r: min(good[i][0] for i in range(len(good)) if roots[i] == r) for r in set(roots.values())}
    expected = Counter((k, sum(near[i]) - 1, least[roots[i]]) for i, (k, _) in enumerate(good))
    expected.update((k, 0, k) for k in (400, 401, 402, 403, 404))
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == expected
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_language_model(spark, docs):
    rows = queries.op7_mixing_lm(spark, SF).collect()
    tokens = {k: [*(t or "").encode().lower().split(), b""] for k, t in docs}
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k in tokens}
    count = Counter(w for k, ws in tokens.items() if not held[k] for w in ws)
    number, floor = sum(count.values()), sum(count.values()) + 0.5 * (len(count) + 1)
    for r in rows:
        words = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(words), sum(count[w] > 0 for w in words), number)
        assert abs(r["base_score"] - sum(np.log10((count[w] + 0.5) / floor) for w in words)) < 1e-6 * abs(r["base_score"]) and r["score"] < 0
    assert len(rows) == len(docs)


def test_spelling_is_a_distribution():
    words = [b"the", b"then", b"other", b"on", b"onthe"] * 3
    tables = {k: np.zeros(2 << bits, np.uint32) for k, bits in mixing_lm.ORDERS.items()}
    for k in tables:
        mixing_lm.count_order(words, k, tables[k])
    mixer = mixing_lm.Mixer()
    mixing_lm.learn_words(words, tables, mixer, np.random.default_rng(0))
    # A word of one byte has the probability of that byte first and the close second; all first bytes together have probability 1.
    first = mixing_lm.spelled([b""], tables, mixer)
    matrix = np.arange(256, dtype=np.uint8)[:, None]
    total = np.zeros(256)
    context = mixing_lm.contexts(matrix)
    for i, bit, salt, node in mixing_lm.decisions(matrix):
        x, seen = mixing_lm.inputs(tables, context, bit, salt, node, 0)
        p = mixer.probability(x, seen, mixing_lm.place_gates(bit.shape, i).ravel())
        total += np.log2(np.where(bit.ravel(), p, 1 - p))
    assert abs(np.exp2(total).sum() - 1) < 1e-9 and abs(total[32] - first[0]) < 1e-9
    assert mixing_lm.spelled([b"then"], tables, mixer)[0] > mixing_lm.spelled([b"zqxv"], tables, mixer)[0]


def test_a_single_byte_predicts_the_next():
    """After q comes u: only the last byte tells, as no longer context of the asked word was seen."""
    rng = np.random.default_rng(0)
    letters = np.frombuffer(b"bcdfghjklm", np.uint8)
    words = [bytes(rng.choice(letters, 5)) + b"qu" for _ in range(3000)]
    tables = {k: np.zeros(2 << bits, np.uint32) for k, bits in mixing_lm.ORDERS.items()}
    for k in tables:
        mixing_lm.count_order(words, k, tables[k])
    mixer = mixing_lm.Mixer()
    mixing_lm.learn_words(words, tables, mixer, np.random.default_rng(0))
    known, other = mixing_lm.spelled([b"zzzzzqu", b"zzzzzqb"], tables, mixer)
    assert 1 in mixing_lm.ORDERS and known > other + 4


def test_a_half_byte_is_hashed_once(monkeypatch):
    words = [b"the", b"then", b"other", b"on", b"a"]
    rng = np.random.default_rng(0)
    tables = {k: rng.integers(0, 9, 2 << bits).astype(np.uint32) for k, bits in mixing_lm.ORDERS.items()}
    mixer, expected = mixing_lm.Mixer(), np.zeros(len(words))
    for rows, matrix in mixing_lm.by_length(words):
        for i, bit, salt, node in mixing_lm.decisions(matrix):
            x, seen = mixing_lm.inputs(tables, mixing_lm.contexts(matrix), bit, salt, node, 0)
            p = mixer.probability(x, seen, mixing_lm.place_gates(bit.shape, i).ravel())
            expected[rows] += np.log2(np.where(bit.ravel(), p, 1 - p)).reshape(bit.shape).sum(axis=1)
    calls, lines = [], mixing_lm.lines
    monkeypatch.setattr(mixing_lm, "lines", lambda *a: calls.append(1) or lines(*a))
    assert (mixing_lm.spelled(words, tables, mixer) == expected).all()
    lengths = len({len(w) for w in words})
    assert len(calls) == 2 * lengths * len(mixing_lm.ORDERS)


def test_matches_look_back_within_a_text():
    rng = np.random.default_rng(0)
    parts = [rng.integers(0, 4, n).tolist() for n in (1, 5, 30, 2, 40)]
    expected = []
    for words in parts:
        run = 0
        for t, w in enumerate(words):
            before = [j for j in range(t - 1) if words[j] == words[t - 1]] if t else []
            hit = bool(before) and words[before[-1] + 1] == w
            expected.append((bool(before), hit, min(run, len(mixing_lm.MATCH) - 1)))
            run = run + 1 if hit else 0
    got = mixing_lm.matches(np.array(sum(parts, []), np.int32), np.r_[0, np.cumsum([len(p) for p in parts])])
    assert list(zip(*(x.tolist() for x in got))) == expected


def word_level(texts):
    """(numbers of words, positions, words, counts, tables as read) of texts of words, all of them in training."""
    index, codes, ends = {}, [], [0]
    for t in texts:
        codes += [index.setdefault(w, len(index)) for w in [*t, b""]]
        ends.append(len(codes))
    codes, ends = np.array(codes, np.int32), np.array(ends)
    total = np.bincount(codes)
    level = mixing_lm.levels(total)
    sizes, uses = np.bincount(level, minlength=mixing_lm.LEVELS), np.bincount(level, total, mixing_lm.LEVELS).astype(int)
    paths = mixing_lm.Paths({0: sizes}, uses, int((total == 1).sum()))
    rows = np.stack([total, paths.of(0, total), np.zeros(len(total), "<i8"), total])
    words = mixing_lm.BlockWords(rows, [len(codes)], len(codes) + 0.5 * len(total))
    at = mixing_lm.Positions(codes, ends, words)
    counts = {order: np.zeros(2 << bits, np.uint32) for order, bits in {**mixing_lm.WORD_ORDERS, mixing_lm.MATCHED: mixing_lm.MATCHED_BITS}.items()}
    mixing_lm.count_words(at, np.arange(len(codes)), counts)
    mixing_lm.count_uses(words.path, total[None, :], counts)
    return index, at, words, counts, {order: mixing_lm.as_read(c.reshape(-1, 2)) for order, c in counts.items()}


def test_every_token_of_a_text_is_counted():
    """Each use of a word adds its decisions in every context, not each distinct word once."""
    rng = np.random.default_rng(0)
    texts = [[b"w%d" % min(w, 40) for w in rng.zipf(1.4, n)] for n in (300, 1, 0, 500)]
    index, at, words, counts, _ = word_level(texts)
    use = Counter(w for t in texts for w in [*t, b""])
    path = {w: bin(words.path[i])[3:] for w, i in index.items()}
    decisions = sum(len(path[w]) * n for w, n in use.items())
    assert all(counts[order].sum() == decisions for order in mixing_lm.WORD_ORDERS) and decisions > 5 * len(use)
    assert len({path[w] for w, n in use.items() if n > 1}) == sum(n > 1 for n in use.values())
    assert len({path[w] for w, n in use.items() if n == 1}) <= 1
    # By hand: after one word, how often each decision at the start of a path went which way.
    before, first = [], []
    for t in texts:
        for a, b in zip(t, [*t[1:], b""]):
            if a == b"w1":
                first.append(int(path[b][0]))
    line = mixing_lm.lines(np.array([words.path[index[b"w1"]]]).astype(np.uint64) * mixing_lm._MULTIPLY, np.ones(1, np.uint64), mixing_lm.WORD_ORDERS[1])[0] | 1
    assert counts[1][2 * line : 2 * line + 2].tolist() == [first.count(0), first.count(1)]


def test_words_after_a_text_are_a_distribution():
    """After the same words, the chances of all words with a path of their own and of the escape add up to one."""
    rng = np.random.default_rng(1)
    # Four words used 64 times, eight used 8 times, sixteen used 2 times: no number on a path is left over.
    pool = [b"a%d" % i for i in range(4)] * 64 + [b"b%d" % i for i in range(8)] * 8 + [b"c%d" % i for i in range(16)] * 2 + [b"once"]
    rng.shuffle(pool)
    texts = [pool[i : i + 40] for i in range(0, len(pool), 40)]
    texts += [[]] * (16 - len(texts))  # the end of a text is the only word used 16 to 31 times
    index, at, words, _, tables = word_level(texts)
    mixer = mixing_lm.WordMixer()
    mixing_lm.learn_texts(at, np.arange(len(at.path)), tables, mixer, rng)
    start = [index[w] for w in texts[0][:12]]
    total = 0.0
    for path in sorted(set(words.path.tolist())):
        word = int(np.flatnonzero(words.path == path)[0])
        asked = mixing_lm.Positions(np.array([*start, word], np.int32), np.array([0, 13]), words)
        total += 10 ** mixing_lm.predicted(asked, words, tables, mixer)[-1]
    kraft = sum(2.0 ** -(int(p).bit_length() - 1) for p in set(words.path.tolist()))
    assert abs(kraft - 1) < 1e-9 and abs(total - 1) < 1e-4


def test_texts_are_taken_some_at_a_time(spark, odd, monkeypatch):
    blocks = word_blocks.write_blocks(odd, lambda: mixing_lm.tokens, group=mixing_lm.F.lit(0), groups=1)
    names = [r["block"] for r in blocks.words.select("block").distinct().collect()]
    monkeypatch.setattr(mixing_lm, "HELD", 50)
    for block in names:
        whole = [(k, c[a:b].tolist(), g, n) for keys, e, c, gs, ns in word_blocks.texts_with_groups(blocks.folder, block) for k, a, b, g, n in zip(keys.to_pylist(), e, e[1:], gs, ns)]
        parts = list(mixing_lm.pieces(blocks.folder, block))
        assert [(k, c[a:b].tolist(), g, n) for keys, e, c, gs, ns in parts for k, a, b, g, n in zip(keys.to_pylist(), e, e[1:], gs, ns)] == whole
        assert all(len(c) <= 50 or len(keys) == 1 for keys, _, c, _, _ in parts)


def test_known_words_are_predicted_from_the_words_before(spark):
    """All words of the asked texts stand in training texts, equally often: only what stood before them tells them apart."""
    rng = np.random.default_rng(2)
    pairs = [(f"left{i}", f"right{i}") for i in range(40)]
    said = lambda: " ".join(" ".join(pairs[i]) for i in rng.permutation(40)[:20])
    rows = [(i, said(), True) for i in range(300)]
    whole = rng.permutation(40)
    rows.append((1000, " ".join(" ".join(pairs[i]) for i in whole), False))
    rows.append((1001, " ".join(f"{pairs[i][0]} {pairs[j][1]}" for i, j in zip(whole, np.roll(whole, 1))), False))
    rows += [(1002, "", False), (1003, None, False)]
    df = spark.createDataFrame(rows, "doc_id long, text string, learns boolean")
    got = {r["doc_id"]: r for r in mixing_lm.score_texts(df, df["learns"]).collect()}
    assert got[1000]["n_known"] == got[1001]["n_known"] == 81 and abs(got[1000]["base_score"] - got[1001]["base_score"]) < 1e-9
    assert got[1000]["score"] > got[1001]["score"] + 40 and got[1000]["score"] > got[1000]["base_score"] + 30
    size = {i: len(t.encode()) if t else 0 for i, t, _ in rows}
    for i, r in got.items():
        assert (r["bits_per_byte"] is None) if not size[i] else abs(r["bits_per_byte"] + r["score"] * np.log2(10) / size[i]) < 1e-9
    assert len(got) == len(rows)


def test_quality_rules_equal_their_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    columns = "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept"
    expected = con.execute(f"SELECT {columns} FROM ({queries.ORACLES['op3_quality_rules']})").fetchall()
    got = queries.op3_quality_rules(spark, SF).select(*columns.split(", ")).collect()
    assert Counter(map(tuple, got)) == Counter(expected)


def test_quality_sampling(spark):
    sf = "/root/testdata/sf0.01"
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op8_quality_sampling(spark, sf).collect()
    good = [r["kept"] for r in rows if label.get(r["doc_id"]) == 1]
    bad = [r["kept"] for r in rows if label.get(r["doc_id"]) == 0]
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.1
    kept, left = ([r["gumbel_key"] for r in rows if r["kept"] == k] for k in (True, False))
    assert min(kept) > max(left)  # exactly the largest


def test_kth_largest(spark):
    values = [-5, -5, 0, 7, 1 << 40, -(1 << 62), 3, 3, 3]
    frame = spark.createDataFrame([(v,) for v in values], "rank long")
    assert [quality_sampling.kth_largest(frame, k) for k in (1, 4, 9)] == [sorted(values, reverse=True)[k - 1] for k in (1, 4, 9)]
    x = np.array([-np.inf, -2.5, -0.0, 0.0, 1e-300, 3.0, np.inf])
    assert (np.diff(quality_sampling.ordered_bits(x)) >= 0).all()


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    label = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op9_toxicity(spark, sf).collect() if r["held_out"] and r["doc_id"] in label]
    clean = [r["predicted"] for r in rows if label[r["doc_id"]] == 0]
    toxic = [r["predicted"] for r in rows if label[r["doc_id"]] == 1]
    assert np.mean(clean) <= 0.005 and np.mean(toxic) >= 0.45 and all(0 <= r["score"] <= 1 for r in rows)


def test_toxicity_dictionaries_read_whole_texts(monkeypatch):
    offered, train = [], toxicity.trained
    monkeypatch.setattr(toxicity, "trained", lambda samples, size: offered.append(samples) or train(samples, size))
    rng = np.random.default_rng(0)
    word = lambda n: "".join(rng.choice(list("bcdfghjklmnpqrstvwxz"), n))
    late = [word(12) for _ in range(4)]
    ordinary = [" ".join([f"{word(3)}" for _ in range(320)] + late * 20) for _ in range(150)]
    insults = [word(14) for _ in range(700)]
    toxic = [" ".join(rng.choice(insults, 60)) for _ in range(400)]
    content, plain = toxicity.dictionaries(toxic, ordinary)
    assert b" ".join(offered[1]).split() == " ".join(ordinary).encode().split()
    assert len(content) > 2 * toxicity.TOXIC_BYTES and all(w.encode() in content for w in insults)
    scorer = toxicity.Scorer(content, plain)
    assert min(scorer.saved(w.encode()) for w in insults) > 0  # the compressor reaches all of it


def test_url_targets_are_resolved(spark):
    base = "http://a.org/x/y/page.html?q=1#f"
    named = {
        "next.html": "http://a.org/x/y/next.html", "?id=5&amp;n=2": "http://a.org/x/y/page.html?id=5&n=2", "../z": "http://a.org/x/z", "../../../z/.": "http://a.org/z/",
        "/k/../m?a=/../b": "http://a.org/m?a=/../b", "//b.org/./c": "http://b.org/c", "https://c.org/a&#x26;b&#38;c": "https://c.org/a&b&c", "mailto:a@b.org": None,
        "go?to=http://d.org": "http://a.org/x/y/go?to=http://d.org", "/p?a=1&copy=2&lt;&bogus;&#0;": "http://a.org/p?a=1&copy=2<&bogus;&#0;", "/&eacute;&#128512;": "http://a.org/é\U0001F600",
    }
    pages = [(i, base, f'<link rel="canonical" href="{t}">') for i, t in enumerate(named)] + [(99, "http://e.net", "<meta http-equiv=refresh content='0;url=b'>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {(r["a"], r["b"]) for r in url_rules.page_links(frame).collect()}
    assert got == {(base, b) for b in named.values() if b} | {("http://e.net", "http://e.net/b")}
    judged = url_rules.judge_urls(spark.createDataFrame([(1, "http://f.org/a/b", "<link rel=canonical href=../c>"), (2, "http://f.org/c", "")], "page_id long, url string, html string"), url_rules.rule_table(spark, [("block", "f.org/c")]))
    assert {(r["page_id"], r["verdict"]) for r in judged.collect()} == {(1, "block"), (2, "block")}


def test_url_rules(spark):
    canonical = lambda u: f"<link href='{u}' rel=canonical>"
    pages = [
        (1, "https://Blog.A.example.NET/en/1?x", None), (2, "http://b.net/x", ""), (3, "http://b.net", ""), (4, "nothing", ""), (5, None, None),
        (6, "http://c.org/alias#top", canonical("http://bad.net/1")), (7, "http://d.org/far", "<META http-equiv=Refresh content='0; URL=http://c.org/alias'>"),
        (8, "http://e.org/x", canonical("http://example.net/en/2")), (9, "http://example.net/de/x", canonical("/en/2")), (10, "http://example.net.org/fr/", ""), (1, "http://b.net/x", ""),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("rule", common.F.lit(1)).withColumn("node", common.F.lit(1))
    rules = url_rules.rule_table(spark, queries.RULES)
    got = Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge_urls(frame, rules).collect())
    assert got == Counter([
        (1, "blog.a.example.net", "/en/1", "net/", "block"), (2, "b.net", "/x", "net/", "block"), (1, "b.net", "/x", "net/", "block"), (3, "b.net", "", None, "allow"),
        (4, "", "", None, "allow"), (5, "", "", None, "allow"), (6, "c.org", "/alias", None, "block"), (7, "d.org", "/far", None, "block"),
        (8, "e.org", "/x", None, "allow"), (9, "example.net", "/de/x", "net/", "block"), (10, "example.net.org", "/fr/", "org/fr/", "allow"),
    ]) - Counter([(1, "blog.a.example.net", "/en/1", "net/", "block")]) + Counter([(1, "blog.a.example.net", "/en/1", "example.net/en/", "allow")])


def test_url_rules_equal_their_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    columns = "page_id, host, path, rule, verdict"
    expected = con.execute(f"SELECT {columns} FROM ({queries.ORACLES['op10_url_rules']})").fetchall()
    got = queries.op10_url_rules(spark, SF).selectExpr(*columns.split(", ")).collect()
    assert Counter(map(tuple, got)) == Counter(expected)


def test_tables_without_rows(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    learns = common.F.lit(True)
    frames = [
        token_files.token_files(none, queries.WORD_BPE), packing.pack(packing.token_pieces(none, queries.WORD_BPE)), quality_rules.quality_rules(none),
        simhash.simhash_groups(none), word_bpe.round_trip(none, queries.BYTE_BPE), mixing_lm.score_texts(none, learns), quality_sampling.keep_sampled(none, labels),
        toxicity.toxicity(none, labels, learns), embed_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")),
        url_rules.judge_urls(spark.createDataFrame([], "page_id long, url string, html string"), url_rules.rule_table(spark, queries.RULES)),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)


def test_odd_tables_are_scored_whole(spark, odd):
    labels = spark.createDataFrame([(3, 1, 1), (3, 1, None), (None, None, 1), (8, 0, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    n = len(ODD) + 3
    assert mixing_lm.score_texts(odd, common.F.col("doc_id") > 5, common.F.col("lang")).filter("score < 0").count() == n
    assert quality_sampling.resample(odd, labels).count() == n
    kept = quality_sampling.keep_sampled(odd, labels)
    assert kept.columns == odd.columns
    scored = toxicity.toxicity(odd, labels, common.F.lit(True))
    assert scored.filter("score between 0 and 1").count() == n


def test_pipeline_stage_by_stage(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    given = {r["doc_id"]: r["text"] for r in docs.collect()}
    names, sets = docs.columns, [set(given)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf), name)
        assert docs.columns == names
        sets.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    assert sets[1] == {k for k, t in given.items() if quality_rules.judge(t)["kept"]}
    assert sets[2] <= sets[1] and len(sets[2]) >= 0.99 * len(sets[1]) and all(label.get(k) != 1 for k in sets[1] - sets[2])
    shingles = {k: frozenset(near_text.shingles(given[k] or "").tolist()) for k in sets[2]}
    first = {}
    for k, root in roots_of(sorted(sets[2]), lambda a, b: len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])).items():
        first[root] = min(first.get(root, k), k)
    assert sets[3] == set(first.values())
    out = corpus_pipeline.run(spark, sf)
    assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == sets[3]
