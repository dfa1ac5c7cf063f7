"""Fill-in-middle, hash-tree shards and whitening against plain versions, and on what tables may hold."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from panelforge.llm import bidiagonal, fill_middle, hash_tree, queries, whitening
from workload.check import rows_of

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, shard int, slot long, n int, form string, output string, restored string, part string, v string"
ODD = [
    None, "", "  \n\t ", "one", " one", "one ", "a\x1cb\x85c d", "日本語 テスト 語 ", "holds <P> already", "<S", "almost <S <M <P > x", "word " * 4000,
    "x" * 6000, " ".join(f"w{i}" for i in range(9000)), "é è ê\n\n ë", "tail\n",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, 1, 1, 1, "f", "o", "r", "p", "v") for i, t in enumerate(ODD)] + [(i + 100, f"a {i} <\tb c\n" * (i % 7), *[None] * 8) for i in range(150)]
    rows += [(3, "one", *[None] * 8)] * 3 + [(3, "two", *[None] * 8), (-1, "negative", *[None] * 8), (None, "no id here", *[None] * 8), (None, None, *[None] * 8)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_fim(key, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n, digest = len(units), hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        form, out, sizes = "plain", text, (None, None)
    elif h[3] % 100 < 80:
        form, out, sizes = "spm", f"<S>{s}<P>{p}<M>{m}", (len(p), len(m))
    else:
        form, out, sizes = "psm", f"<P>{p}<S>{s}<M>{m}", (len(p), len(m))
    return (key, n, form, *sizes, out, text)


def test_fill_middle_equals_plain_version(odd):
    made = fill_middle.fill_in_middle(odd)
    rows = [(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in made.collect()]
    expected = [plain_fim(r["doc_id"], r["text"]) for r in odd.collect()]
    assert Counter(rows) == Counter(e[:6] for e in expected)
    assert {r[2] for r in rows} == {"plain", "psm", "spm"}
    back = [(r["doc_id"], r["restored"], r["output_sha256"], r["restored_sha256"]) for r in fill_middle.restore(made).collect()]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert Counter(back) == Counter((e[0], e[6], sha(e[5]), sha(e[6])) for e in expected)


def test_fill_middle_pieces_spell_the_output(odd):
    texts = {}
    for r in odd.collect():
        texts.setdefault(r["doc_id"], []).append((r["text"] or "").encode())

    def spelled(text, pieces):
        return b"".join((text, fill_middle.SENTINELS)[p["buffer"]][p["start"] : p["start"] + p["length"]] for p in pieces)

    for r in fill_middle.fill_in_middle(odd).collect():
        assert r["output"].encode() in [spelled(t, r["pieces"]) for t in texts[r["doc_id"]]]


def test_fill_middle_rates(odd):
    forms = Counter(r["form"] for r in fill_middle.fill_in_middle(odd.filter("doc_id >= 100 AND length(text) > 0"), rate=100, spm=0).collect())
    assert set(forms) == {"psm"}


def test_piece_table_cuts_and_wrong_outputs():
    table = fill_middle.PieceTable.whole(b"abcdef").cut(0, 2, 2, 6)
    assert [bytes(v) for v in table.views()] == [b"", b"ab", b"", b"cdef", b""] and table.bytes() == b"abcdef"
    assert [bytes(v) for v in table.cut(1, 4).views()] == [b"", b"a", b"b", b"", b"cd", b"ef", b""]
    with pytest.raises(ValueError):
        fill_middle.recovered(b"no sentinel", "psm")


# ---------------------------------------------------------------- shards


def plain_shard(key, tree):
    shown, path, leaves = "" if key is None else str(key), (), list(tree.leaves)
    for level in range(3):
        weights = {}
        for x in leaves:
            name = (x.region, x.rack, x.shard)[level]
            weights[name] = weights.get(name, 0.0) + x.weight
        draw = lambda name: (np.log((int(hashlib.md5(f"{shown}/{'.'.join(map(str, (*path, name)))}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52) / weights[name], name)
        won = max(weights, key=draw)
        leaves = [x for x in leaves if (x.region, x.rack, x.shard)[level] == won]
        path = (*path, won)
    return path[2]


def test_shards_equal_plain_version(odd):
    tree = queries.TREE
    rows = hash_tree.shards(odd, tree).collect()
    expected = []
    for r in odd.collect():
        data = (r["text"] or "").encode()
        expected.append((r["doc_id"], len(data) + 1, zlib.crc32(data), plain_shard(r["doc_id"], tree), plain_shard(r["doc_id"], tree.grown())))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in rows) == Counter(expected)
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append((r["slot"], r["doc_id"]))
        assert r["grown_shard"] in (16, r["shard"]) and r["law"] == "key"
    for held in by_shard.values():
        held.sort()
        assert [s for s, _ in held] == list(range(len(held)))
        ids = [k for _, k in held]
        assert ids == sorted(ids, key=lambda k: (k is not None, k or 0))


def test_shards_keep_texts_and_split_equal_rows(spark):
    rows = [(7, "same row")] * 4000 + [(i, f"text {i}") for i in range(2000)] + [(5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    from panelforge.llm.common import scratch_path, stored

    docs, folder = stored(docs, "docs"), scratch_path(spark, "shards")
    manifest = stored(hash_tree.write_shards(docs, queries.TREE, folder), "manifest")
    back = hash_tree.read_shards(manifest, folder).collect()
    assert Counter((r["doc_id"], r["text"]) for r in back) == Counter(rows)
    hot = plain_shard(7, queries.TREE)
    parts = [r["rows"] for r in manifest.collect() if r["shard"] == hot]
    assert len(parts) > 1 and max(parts) < 4000
    assert sorted(r["slot"] for r in back if r["shard"] == hot) == list(range(sum(parts)))


def moved(spark, before, after, n=20000):
    keys = spark.range(n).withColumnRenamed("id", "doc_id")
    rows = hash_tree.descend(hash_tree.descend(keys, "doc_id", before, "a"), "doc_id", after, "b").groupBy("a", "b").count().collect()
    return {(r["a"], r["b"]): r["count"] for r in rows}


def test_movement_stays_in_the_changed_subtree(spark):
    tree = queries.TREE
    place = {x.shard: (x.region, x.rack) for x in tree.leaves}
    for weight in (3.0, 0.25):
        for (a, b), _ in moved(spark, tree, tree.with_weight(6, weight)).items():
            if a != b:  # shard 6 is rack 1 of region 1: rows cross regions, racks or shards only towards it or away from it
                inner, outer = (b, a) if weight > 1 else (a, b)
                assert place[inner][0] == 1
                if place[outer][0] == 1:
                    assert place[inner][1] == 1
                    if place[outer][1] == 1:
                        assert inner == 6


def test_weights_set_the_shares(spark):
    tree = hash_tree.Tree((hash_tree.Leaf(0, 0, 0, 1.0), hash_tree.Leaf(0, 1, 1, 2.0), hash_tree.Leaf(1, 0, 2, 5.0)))
    n = Counter()
    for (a, _), c in moved(spark, tree, tree).items():
        n[a] += c
    assert all(abs(n[s] / 20000 - w / 8) < 0.015 for s, w in ((0, 1), (1, 2), (2, 5)))
    with pytest.raises(ValueError):
        hash_tree.Tree((hash_tree.Leaf(0, 0, 0, 0.0),))


# ---------------------------------------------------------------- whitening


def matrices():
    rng = np.random.default_rng(5)
    yield "one", rng.standard_normal((1, 1))
    for n in (2, 3, 17, 64, 120):
        yield f"gauss {n}", np.linalg.qr(rng.standard_normal((3 * n, n)), mode="r")
    yield "identity", np.eye(40)
    yield "groups", np.diag(np.repeat([4.0, 2.0, 1.0, 0.5], 9))
    yield "cluster", np.diag(1 + 1e-13 * rng.random(48)) @ np.linalg.qr(rng.standard_normal((48, 48)))[0]
    yield "graded", np.linalg.qr(rng.standard_normal((200, 30)) @ np.diag(10.0 ** -np.arange(0, 6, 0.2)), mode="r")
    wilkinson = np.diag(np.abs(np.arange(-10, 11)) + 0.01) + np.diag(np.ones(20), 1)
    yield "close pairs", np.linalg.cholesky(wilkinson @ wilkinson.T + np.eye(21)).T
    twice = rng.standard_normal((100, 20))
    yield "half rank", np.linalg.qr(np.hstack([twice, twice]), mode="r")
    yield "zero rows", np.vstack([rng.standard_normal((3, 9)), np.zeros((6, 9))])


@pytest.mark.parametrize("name,matrix", list(matrices()), ids=lambda x: x if isinstance(x, str) else "")
def test_qd_solver(name, matrix):
    count = min(32, len(matrix))
    values, vectors = bidiagonal.decompose(matrix, count)
    exact = np.linalg.svd(matrix, compute_uv=False) ** 2
    real = exact > 1e-18 * exact[0]
    assert np.all(np.abs(values - exact)[real] <= 1e-13 * exact[real]) and np.all(values[~real] <= 1e-18 * exact[0])
    known = int(real[:count].sum())  # directions without variance are no components
    vectors = vectors[:, :known]
    assert np.abs(vectors.T @ vectors - np.eye(known)).max() < 1e-10
    assert np.abs(matrix.T @ (matrix @ vectors) - vectors * values[:known]).max() < 1e-12 * exact[0]


def test_small_values_keep_their_digits():
    # The product of the squared singular values is the squared determinant, however graded the matrix is.
    a, b = np.array([1.0, 1e-3, 1e-6, 1e-9]), np.array([1.0, 1.0, 1e-5])
    values = bidiagonal.dqds(a * a, b * b)
    assert abs(np.log(values).sum() - np.log(a * a).sum()) < 1e-13


def exact_whitening(rows, count=32):
    dim = Counter(len(v) for _, v in rows).most_common(1)[0][0] if rows else 0
    x = np.array([np.floor(64 * np.array(v, float)) + 1_000_000 for _, v in rows]).reshape(len(rows), dim)
    n, sums = len(x), [sum(int(c) for c in x[:, j]) for j in range(dim)]
    deviation = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    apart = x - np.array(sums) / n
    e, v = np.linalg.eigh(apart.T @ apart / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(count, dim, int((e > 1e-12 * e[0]).sum()))
    return n, deviation, apart @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


@pytest.mark.parametrize("which", ["given", "odd"])
def test_whitening_equals_eigenvectors(spark, which):
    if which == "given":
        frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    else:
        rng = np.random.default_rng(2)
        base = rng.standard_normal((9000, 6)) @ np.diag([9.0, 5.0, 3.0, 1.0, 0.5, 0.25]) @ rng.standard_normal((6, 6))
        rows = [(i, [*map(float, v), float(v[0])], 1, 1.0) for i, v in enumerate(base)]
        bad = [None, [], [1.0], [1.0, None, 1.0, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 7, [float("inf")] + [0.0] * 6]
        rows += [(-5 - i, v, 1, 1.0) for i, v in enumerate(bad)] + [(None, [0.0] * 7, 1, 1.0), (3, rows[3][1], 1, 1.0), (3, [1.5] * 7, None, None)] + [rows[8]] * 2000
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, whitened double").repartition(5)
    got = whitening.whiten(frame).toPandas()
    usable = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    usable = [(k, v) for k, v in usable if v and len(v) in (7, 64) and all(c is not None and np.isfinite(c) for c in v)]
    n, deviation, whitened, explained = exact_whitening(usable)
    k = whitened.shape[1]
    assert len(got) == n * k and set(got.n) == {n} and set(got.component) == set(range(1, k + 1))
    assert k == (6 if which == "odd" else 32)
    first = got[got.component == 1]
    missing = -(10**9)
    assert Counter(zip(first.vec_id.fillna(missing).astype(int), first.deviation)) == Counter((missing if i is None else i, d) for (i, _), d in zip(usable, deviation))
    for c in range(k):
        # Equal ids may hold different vectors: compare the sorted values of all rows, with either sign.
        mine, theirs = np.sort(got[got.component == c + 1].whitened.to_numpy()), np.sort(whitened[:, c])
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs[::-1]).max()) < 1e-8
    assert np.abs(got.drop_duplicates("component").sort_values("component").explained.to_numpy() - explained).max() < 1e-10
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).collect() == []
    line = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0])], schema)).collect()
    assert sorted((r["vec_id"], round(abs(r["whitened"]), 9)) for r in line) == [(1, 1.0), (2, 1.0)]
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e200]), (2, [1.0])], schema)).collect()


# ---------------------------------------------------------------- registration


def test_empty_tables(none):
    assert fill_middle.restore(fill_middle.fill_in_middle(none)).collect() == []
    assert hash_tree.shards(none, queries.TREE).collect() == []


@pytest.mark.parametrize("name", ["op11_fill_middle", "op12_hash_tree"])
def test_query_equals_its_sql(spark, name, tmp_path, odd):
    folder = str(tmp_path)
    odd.write.parquet(f"{folder}/documents.parquet")
    for sf, path in ((SF, f"{SF}/documents.parquet"), (folder, f"{folder}/documents.parquet/*.parquet")):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT doc_id, text FROM '{path}'")
        result = con.execute(entry.oracle_sql()[name])
        df = entry.queries()[name](spark, sf)
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in result.description], result.fetchall())
