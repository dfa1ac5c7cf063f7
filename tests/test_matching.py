"""Duplicates, event groups and clusters against brute force."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from panelforge.operators import cluster as cl, dedup as dd, event_groups as eg, news as nw
from panelforge.operators.set_join import rarest_first, similar_sets


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def variants(rng, n):
    words = "tai nan cau giay duong lang un tac keo dai xe tai va cham ngap sau mua lon".split()
    bases = [" ".join(rng.choices(words, k=rng.randint(3, 9))) for _ in range(12)]
    out = []
    for _ in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.randint(0, 5)):
            i = rng.randrange(len(text))
            text[i : i + rng.randint(0, 1)] = rng.choice(["", "x", " q"])
        out.append("".join(text))
    return out


def test_similar_titles_are_complete(spark):
    rng = random.Random(11)
    titles = sorted(set(variants(rng, 160))) + ["", "a", "ab"]
    rows = [(f"k{i:03d}", "b1" if i % 2 else "b2", t) for i, t in enumerate(titles)]
    df = spark.createDataFrame(rows, "k string, b string, t string")
    for ratio in (0.82, 0.68):
        both = {(r["a"], r["b"]) for r in eg.similar_titles(df, df, ["b"], "k", "t", ratio).collect()}
        assert {(b, a) for a, b in both} == both
        got = {(a, b) for a, b in both if a < b}
        want = set()
        for i, (k1, b1, t1) in enumerate(rows):
            for k2, b2, t2 in rows[i + 1 :]:
                longest = max(len(t1), len(t2))
                if b1 == b2 and (longest == 0 or 1 - lev(t1, t2) / longest >= ratio - 1e-9):
                    want.add((k1, k2))
        assert got == want
        left, right = df.filter("k < 'k060'"), df.filter("k >= 'k060'")
        assert {(r["a"], r["b"]) for r in eg.similar_titles(left, right, ["b"], "k", "t", ratio).collect()} == {(a, b) for a, b in want if a < "k060" <= b}


def test_event_groups_match_the_sequential_rule(spark):
    rng = random.Random(2)
    start = datetime(2024, 5, 1)
    rows = []
    for i, title in enumerate(variants(rng, 120)):
        at = start + timedelta(minutes=rng.randint(0, 5 * 1440))
        rows.append((i, title, rng.choice(["hanoi", None]), "accident", rng.choice(["p1", None, "p2"]), at))
    df = spark.createDataFrame(rows, "record_id long, title string, city string, event_category string, location_text string, event_time_start timestamp_ntz")
    got = {r["record_id"]: r["leader"] for r in eg.event_groups(df).collect()}
    norm = {r["record_id"]: r["n"] for r in df.select("record_id", nw.tx.comparable_title(F.col("title")).alias("n")).collect()}
    leaders, want = [], {}
    for row in sorted(rows, key=lambda r: (r[5], r[0])):
        for other in leaders:
            a, b = norm[row[0]], norm[other[0]]
            longest = max(len(a), len(b))
            ratio = 1.0 if longest == 0 else 1 - lev(a, b) / longest
            same = row[4] is not None and row[4] == other[4]
            if row[2] == other[2] and row[5] - other[5] <= timedelta(hours=24) and ratio >= (0.68 if same else 0.82) - 1e-9:
                want[row[0]] = other[0]
                break
        else:
            leaders.append(row)
            want[row[0]] = row[0]
    assert got == want


def numbers_layer(rows):
    """Numbers match within 3; ``rows`` has (vid, v)."""

    def near(left, right):
        other = (left if right is None else right).select(F.col("vid").alias("b"), F.col("v").alias("w"))
        both = left.select(F.col("vid").alias("a"), "v").join(other, F.abs(F.col("v") - F.col("w")) <= 3)
        return both.filter("a < b" if right is None else "a <> b").select("a", "b")

    return dd.Layer(rows.select("vid", "v").distinct(), near)


@pytest.mark.parametrize("first_batch,tail", [(None, 0), (16, 40)])
def test_election_with_one_hot_group(spark, monkeypatch, first_batch, tail):
    """A third of the records are copies; matching is closeness of a number. Small batches and rounds give the same answer."""
    monkeypatch.setattr(dd, "TAIL", tail)
    rng = random.Random(4)
    values = [rng.randint(0, 400) for _ in range(240)] + [7] * 120 + [rng.randint(0, 30) for _ in range(60)]
    df = spark.createDataFrame([(i, v, str(v)) for i, v in enumerate(values)], "id long, v int, vid string")
    got = {r["id"]: r["original"] for r in dd.first_come(df, "id", ["vid"], [numbers_layer(df)], first_batch).collect()}
    leaders, want = [], {}
    for i, v in enumerate(values):
        want[i] = next((j for j in leaders if abs(values[j] - v) <= 3), None)
        if want[i] is None:
            leaders.append(i)
    assert got == want


@pytest.mark.parametrize("first_batch,tail", [(None, 0), (40, 200_000)])
def test_layered_election_equals_the_sequential_rule(spark, monkeypatch, first_batch, tail):
    monkeypatch.setattr(dd, "TAIL", tail)
    rng = random.Random(5)
    rows = [(i, rng.choice([None, *"abcdefghij"]), rng.choice([None, *range(0, 90, 2)])) for i in range(150)]
    df = spark.createDataFrame([(i, u, v, None if v is None else str(v)) for i, u, v in rows], "id long, u string, v int, vid string")
    layers = [dd.Layer(df), numbers_layer(df.filter("v is not null"))]
    got = {r["id"]: (r["original"], r["layer"]) for r in dd.first_come(df, "id", ["u", "vid"], layers, first_batch).collect()}
    leaders, want = [], {}
    for i, u, v in rows:
        hits = [(0, j) for j, w, _ in leaders if u is not None and u == w] + [(1, j) for j, _, w in leaders if v is not None and w is not None and abs(v - w) <= 3]
        want[i] = min(hits)[::-1] if hits else (None, None)
        if not hits:
            leaders.append((i, u, v))
    assert got == want


def test_dense_batches_are_taken_in_steps(spark, monkeypatch):
    """All records after the first batch match each other: they are settled against one of them, not linked pair by pair."""
    rows = spark.range(400).select("id", F.when(F.col("id") < 8, F.col("id") * 100).otherwise(F.lit(100_000) + F.col("id") % 3).cast("int").alias("v"), F.col("id").cast("string").alias("vid"))
    monkeypatch.setattr(dd, "DENSE", 4)
    linked, plain = [], numbers_layer(rows)

    def counted(left, right):
        if right is None:
            linked.append(left.count())
        return plain.near(left, right)

    got = {r["id"]: r["original"] for r in dd.first_come(rows, "id", ["vid"], [dd.Layer(plain.values, counted)], 8).collect()}
    assert got == {i: None if i <= 8 else 8 for i in range(400)}
    assert max(linked) <= 64


def test_title_join_loses_no_pair(spark):
    rng = random.Random(6)
    words = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(4000)]
    sets = [sorted(set(rng.choices(words, k=rng.randint(1, 14)))) for _ in range(2400)]
    for s in sets[:700]:  # near copies of every kind: one token more, fewer or other
        t = set(s)
        for _ in range(rng.randint(0, 2)):
            t ^= {rng.choice(words)}
        sets.append(sorted(t or {"x"}))
    sets += [sorted({f"n{i}", "on", "the", "road", "near", "km", "long", "bridge", "of", "town"}) for i in range(60)]
    distinct = sorted({tuple(s) for s in sets})
    assert len(distinct) >= 2000
    df = spark.createDataFrame([(f"{i:05d}", list(s)) for i, s in enumerate(distinct)], "vid string, tokens array<string>")
    ordered = rarest_first(df, "vid", "tokens").cache()
    numbered = [frozenset(s) for s in distinct]
    for threshold in (0.8, 0.6, 1.0):
        want = set()
        for i, a in enumerate(numbered):
            for j in range(i + 1, len(numbered)):
                shared = len(a & numbered[j])
                if shared and shared / (len(a) + len(numbered[j]) - shared) >= threshold:
                    want.add((f"{i:05d}", f"{j:05d}"))
        got = {(r["a"], r["b"]) for r in similar_sets(ordered, None, threshold).collect()}
        assert got == want and (want or threshold == 1.0)
        left, right = ordered.filter("vid < '01000'"), ordered.filter("vid >= '01000'")
        assert {(r["a"], r["b"]) for r in similar_sets(left, right, threshold).collect()} == {(a, b) for a, b in want if a < "01000" <= b}


def test_hot_bucket_takes_no_more_rounds(spark, monkeypatch):
    """Titles that share most tokens but do not match: 2,000 of them settle in as many rounds as 200."""
    rounds = []
    real = dd.cut_lineage
    monkeypatch.setattr(dd, "TAIL", 0)
    monkeypatch.setattr(dd, "cut_lineage", lambda df: rounds.append(1) or real(df))
    for n in (200, 2000):
        rounds.clear()
        rows = spark.range(n).select("id", F.concat(F.lit("accident near bridge road "), F.col("id").cast("string"), F.lit("x "), (F.col("id") * 7 + 100000).cast("string"), F.lit("y")).alias("title"))
        assert dd.title_originals(rows, "id", "title").filter("is_duplicate").count() == 0
        if n == 200:
            few = len(rounds)
    assert len(rounds) == few


def test_layers(spark):
    rows = [
        (1, "https://x.vn/a", "Tai nạn nghiêm trọng trên cầu", "một hai ba bốn năm sáu"),
        (2, "https://x.vn/a?utm_source=f", "Khác hẳn", "không liên quan gì"),
        (3, "https://y.vn/b", "Tai nạn nghiêm trọng trên cầu", "chín mười"),
        (4, "https://z.vn/c", "Giá vàng tăng mạnh", "một hai ba bốn năm sáu"),
        (5, "https://z.vn/d", "Thời tiết đẹp", "nắng ấm cả ngày tại miền bắc"),
    ]
    df = spark.createDataFrame(rows, "id long, url string, title string, text string")
    got = {r["id"]: (r["is_duplicate"], r["layer"], r["original"]) for r in dd.layered_originals(df, "id", "url", "title", "text").collect()}
    assert got == {1: (False, None, None), 2: (True, "url", None), 3: (True, "title", 1), 4: (True, "content", 1), 5: (False, None, None)}


def test_simhash_buckets_find_every_pair_within_four_bits(spark):
    rng = random.Random(9)
    pairs = []
    for _ in range(300):
        word = rng.getrandbits(64)
        other = word
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            other ^= 1 << bit
        signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
        pairs.append((signed(word), signed(other)))
    df = spark.createDataFrame(pairs, "a long, b long")
    shared = F.size(F.array_intersect(dd.simhash_buckets(F.col("a")), dd.simhash_buckets(F.col("b"))))
    assert df.filter((shared == 0) | (dd.hamming(F.col("a"), F.col("b")) > 4)).count() == 0


def test_dbscan_matches_brute_force(spark):
    rng = random.Random(8)
    points = [(rng.gauss(cx, 0.6), rng.gauss(cy, 0.6)) for cx, cy in ((0, 0), (4, 0), (0, 5)) for _ in range(60)]
    points += [(rng.uniform(-6, 10), rng.uniform(-6, 10)) for _ in range(60)] + [(0.1, 0.1)] * 40
    eps, need = 0.7, 5
    df = spark.createDataFrame([(i, "g", x, y) for i, (x, y) in enumerate(points)], "id long, g string, x double, y double")
    got = {r["id"]: (r["is_core"], r["cluster"]) for r in cl.dbscan(df, "id", "x", "y", "g", {"g": (eps, need)}).collect()}
    near = [[j for j, q in enumerate(points) if (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= eps**2] for p in points]
    core = [len(n) >= need for n in near]
    label = {}
    for i in range(len(points)):
        if core[i] and i not in label:
            stack = [i]
            while stack:
                k = stack.pop()
                if k not in label:
                    label[k] = i
                    stack += [j for j in near[k] if core[j]]
    for i in range(len(points)):
        want = label[i] if core[i] else min((label[j] for j in near[i] if core[j]), default=None)
        assert got[i] == (core[i], want)


def test_mirrors_are_listed_once(spark):
    df = spark.createDataFrame([("g", "tuoitre"), ("g", "vnexpress"), ("g", "tuoitre")], "g string, source string")
    assert nw.mirror_sources(df, "g").collect()[0]["mirrored_sources"] == ["tuoitre", "vnexpress"]


def test_alert_of_a_city_with_the_separator(spark):
    from panelforge.plans import dashboards

    rows = [("can_tho", "S1", 5.0), ("can", "tho_S1", 1.0)]
    panel = spark.createDataFrame(rows, "city string, segment_id string, jamFactor double").withColumns({
        "time_bucket": F.lit("2024-01-01").cast("timestamp_ntz"), "timestamp": F.lit("2024-01-01").cast("timestamp_ntz"), "currentSpeed": F.lit(10.0), "freeFlowSpeed": F.lit(50.0),
    })
    assert [(r["city"], r["segment_id"]) for r in dashboards.alert_by_id(panel, "alert_can_tho_S1").collect()] == [("can_tho", "S1")]
    assert dashboards.alert_by_id(panel, "plain").count() == 0


def test_upserted_takes_one_row_per_key(spark):
    from panelforge.sources import sinks

    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    updates = spark.createDataFrame([(2, "x"), (2, "y"), (3, "z")], "k int, v string")
    assert sorted(tuple(r) for r in sinks.upserted(target, updates, ["k"]).collect()) == [(1, "a"), (2, "y"), (3, "z")]


def test_repeated_news_lines_have_ids_of_their_own(spark, tmp_path):
    from panelforge.sources import readers

    (tmp_path / "a.jsonl").write_text('{"title": "x", "tags": ["p", "q"]}\n' * 2)
    rows = readers.read_news(spark, str(tmp_path)).collect()
    assert len({r["record_id"] for r in rows}) == 2 and all(r["tags"] == '["p","q"]' for r in rows)


def test_all_scenarios_and_segments_are_kept(spark):
    from panelforge.operators import graph
    from panelforge.plans import dashboards

    latest = spark.range(300).select(
        F.lit("hanoi").alias("city"), F.format_string("S%03d", "id").alias("segment_id"), (F.col("id") % 7).cast("double").alias("jamFactor"),
        F.lit(20.0).alias("currentSpeed"), F.lit(50.0).alias("freeFlowSpeed"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("timestamp"), F.lit("2024-01-01").cast("timestamp_ntz").alias("time_bucket"),
    )
    scenarios = spark.range(1100).select(F.col("id").cast("string").alias("name"), F.lit(1.0).alias("rain_1h_mm"), F.lit("none").alias("event_type"), F.lit(False).alias("is_peak_hour"))
    assert dashboards.scenario_impact(latest.limit(2), scenarios).count() == 2200
    assert dashboards.geojson_features(latest).count() == 300
    pairs = {(r["upstream"], r["downstream"]) for r in graph.upstream_edges(latest).collect()}
    order = [r["segment_id"] for r in latest.orderBy(F.desc("jamFactor"), "segment_id").collect()]
    assert pairs == set(zip(order, order[1:]))


def test_dbscan_cells_at_the_edge_of_eps(spark, monkeypatch):
    """Two crowded strips whose closest points lie just within, or just beyond, eps: decided without comparing all their points."""
    compared = []
    real = cl.cut_lineage
    monkeypatch.setattr(cl, "cut_lineage", lambda df: compared.append((r := real(df)).count()) or r)
    n = 4000
    side = 1.0 / 2**0.5
    for gap, joined in ((0.9999, True), (1.0001, False)):
        compared.clear()
        # Both strips are narrow columns of points; facing columns are ``gap`` apart.
        y = (F.col("id") % n) * (side / n)
        rows = spark.range(2 * n).select("id", F.lit("g").alias("g"), F.when(F.col("id") < n, F.lit(side * 0.999) - F.col("id") % 7 * 1e-3).otherwise(F.lit(side * 0.999 + gap) + F.col("id") % 5 * 1e-3).alias("x"), y.alias("y"))
        got = cl.dbscan(rows, "id", "x", "y", "g", {"g": (1.0, 5)}).filter("is_core").select("cluster").distinct().count()
        assert got == (1 if joined else 2)
        assert max(compared) <= 40 * n


def test_event_groups_of_titles_that_differ_in_a_number(spark, monkeypatch):
    """5,000 titles of one city, category and day match each other: they meet leaders only."""
    seen = []
    real = eg.similar_titles
    monkeypatch.setattr(eg, "similar_titles", lambda *a: seen.append(d := real(*a).cache()) or d)
    rows = spark.range(5000).select(
        F.col("id").alias("record_id"), F.concat(F.lit("collision of two lorries at kilometre "), F.lpad(F.col("id").cast("string"), 4, "0")).alias("title"),
        F.lit("hanoi").alias("city"), F.lit("accident").alias("event_category"), F.lit(None).cast("string").alias("location_text"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 10).alias("event_time_start"),
    )
    got = eg.event_groups(rows).groupBy("leader").count().collect()
    assert [(r["leader"], r["count"]) for r in got] == [(0, 5000)]
    assert sum(d.count() for d in seen) < 1_500_000


@pytest.mark.parametrize("heads", [1, 3])
def test_event_groups_with_few_heads_a_round(spark, monkeypatch, heads):
    monkeypatch.setattr(eg, "HEADS", heads)
    monkeypatch.setattr(eg, "GROWTH", 2)
    test_event_groups_match_the_sequential_rule(spark)


def test_plans_of_event_group_rounds_do_not_grow(spark, monkeypatch):
    """Six unlike titles of one block, one head a round: what a round links is read from a stored table."""
    monkeypatch.setattr(eg, "HEADS", 1)
    monkeypatch.setattr(eg, "GROWTH", 1)
    sizes = []
    real = eg.similar_titles
    monkeypatch.setattr(eg, "similar_titles", lambda *a: sizes.append(len(a[0]._jdf.queryExecution().analyzed().toString())) or real(*a))
    rows = [(i, w * 9, "hanoi", "accident", None, datetime(2024, 5, 1, i)) for i, w in enumerate(["ab ", "cd ", "ef ", "gh ", "ij ", "kl "])]
    df = spark.createDataFrame(rows, "record_id long, title string, city string, event_category string, location_text string, event_time_start timestamp_ntz")
    assert {r["record_id"]: r["leader"] for r in eg.event_groups(df).collect()} == {i: i for i in range(6)}
    assert len(sizes) == 6 and max(sizes) < 1.5 * sizes[0]


def test_crowded_blocks_use_the_index(spark, monkeypatch):
    monkeypatch.setattr(eg, "PAIRED", 0)
    test_similar_titles_are_complete(spark)
    test_event_groups_match_the_sequential_rule(spark)


def test_blocks_with_few_titles_compare_pairs(spark, monkeypatch):
    """Parts of the other side too; no rows of an index."""
    monkeypatch.setattr(eg, "PART", 7)
    monkeypatch.setattr(eg, "_segments", None)
    test_similar_titles_are_complete(spark)


def test_rarest_first_carries_places_not_tokens(spark):
    """Places of tokens, rarest first; as many bytes however long the tokens are."""
    df = spark.createDataFrame([("p", ["a" * 300, "b", "c"]), ("q", ["b", "c"]), ("r", ["c"])], "vid string, tokens array<string>")
    got = {r["vid"]: (r["tokens"], r["n"]) for r in rarest_first(df, "vid", "tokens").collect()}
    assert got == {"p": ([0, 1, 2], 3), "q": ([1, 2], 2), "r": ([2], 1)}


def test_collapsing_groups_sorts_only_the_columns_that_are_used(spark):
    nan = float("nan")
    rows = [(1, "a", 0.5, 1), (2, "a", 0.9, 1), (3, "a", 0.9, 3), (4, "a", 0.9, 3), (5, "b", 0.9, 1), (6, "b", None, 1), (7, "c", nan, 5), (8, "c", 0.1, 1), (9, None, 0.2, 1), (10, None, 0.3, 1)]
    events = spark.createDataFrame(rows, "record_id long, dedup_group_id string, traffic_relevance_score double, severity_score int")
    events = events.withColumn("body", F.repeat(F.col("record_id").cast("string"), 50))
    best = nw.collapse_groups(events)
    assert best.columns == events.columns
    assert {r["record_id"] for r in best.collect()} == {3, 6, 8, 10}
    assert "repeat" not in best.select("record_id")._jdf.queryExecution().optimizedPlan().toString()


def test_event_report_stores_no_texts(spark, monkeypatch, tmp_path):
    from panelforge.plans import builds
    from workload import build_queries as bq

    pages = [(i, f"<title>Tin {i % 3} abc</title><p>{'x ' * 40}{i}</p>", f"https://a.vn/{i}") for i in range(12)]
    spark.createDataFrame(pages, "page_id long, html string, url string").write.parquet(str(tmp_path / "pages.parquet"))
    stored = []
    cut = builds.cut_lineage
    for module in (builds, bq):
        monkeypatch.setattr(module, "cut_lineage", lambda df: stored.append(df.columns) or cut(df))
    value = {r["metric"]: r["value"] for r in bq.event_quality_report(spark, str(tmp_path)).collect()}
    assert value["raw_records"] == "12"
    assert int(value["events_after_semantic_dedup"]) + int(value["events_removed_by_semantic_dedup"]) == 12
    assert sum("summary_text" in columns for columns in stored) == 1


def test_events_build_stores_groups_and_leaves_texts_out_of_the_best_rows(spark, monkeypatch):
    from panelforge.plans import builds

    text = "string"
    names = ["external_id", "source", "provider", "title", "summary", "source_url", "published_at", "city_hint", "ingestion_time"]
    row = lambda i: (i, f"x{i}", "s", "rss", f"Tin {i % 2} abc", "y " * 30, f"https://a.vn/{i}", f"2024-01-01T0{i}:00:00Z", "Hà Nội", None)
    raw = spark.createDataFrame([row(i) for i in range(6)], "record_id long, " + ", ".join(f"{n} {text}" for n in names))
    stored = []
    cut = builds.cut_lineage
    monkeypatch.setattr(builds, "cut_lineage", lambda df: stored.append(df.columns) or cut(df))
    grouped, best = builds.events_build(raw, F.lit("2024-03-01").cast("timestamp"))
    assert ["record_id", "dedup_group_id"] in stored
    assert grouped.count() == 6 and "summary_text" in best.columns
    plan = best.select("city", "event_time_start")._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "summary_text" in line and "LogicalRDD" not in line]


def test_event_groups_plan_no_broadcasts(spark):
    rows = [(i, "hanoi", "flood", f"nước ngập đường số {i % 3}", f"p{i % 2}", f"2024-01-0{1 + i % 3} 08:00:00") for i in range(12)]
    events = spark.createDataFrame(rows, "record_id long, city string, event_category string, title string, location_text string, at string").withColumn("event_time_start", F.col("at").cast("timestamp"))
    grouped = eg.event_groups(events)
    titles = events.select("city", "record_id", "title")
    pairs = eg.similar_titles(titles, titles, ["city"], "record_id", "title", 0.8)
    for frame in (grouped, pairs):
        # The adaptive plan is final once the rows were collected.
        assert frame.collect() and "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()
