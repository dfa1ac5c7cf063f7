"""Density clusters on a grid, cluster statistics and snapping to the nearest segment."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from panelforge.functions import geo
from panelforge.session import cut_lineage


def standardize(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Zero mean and unit (population) deviation per group as ``<name>_z``; constant columns become 0."""
    moments = df.groupBy(*by).agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    joined = df.join(moments, by)
    scaled = {c: (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(1.0) for c in columns}
    return joined.withColumns({f"{c}_z": v for c, v in scaled.items()}).drop(*[f"_{n}_{c}" for c in columns for n in "ms"])


def _around(df: DataFrame) -> DataFrame:
    """Copy rows to the 21 cells that can hold a point within reach (5 × 5 without its corners)."""
    offsets = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if abs(i) + abs(j) < 4]
    moves = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in offsets])
    return df.withColumn("_mv", F.explode(moves)).withColumns({"nx": F.col("cx") + F.col("_mv.i"), "ny": F.col("cy") + F.col("_mv.j")}).drop("_mv")


def _gap(lo_a: str, hi_a: str, lo_b: str, hi_b: str) -> Column:
    return F.greatest(F.lit(0.0), F.col(lo_b) - F.col(hi_a), F.col(lo_a) - F.col(hi_b))


def _reach(lo_a: str, hi_a: str, lo_b: str, hi_b: str) -> Column:
    return F.greatest(F.col(hi_b) - F.col(lo_a), F.col(hi_a) - F.col(lo_b))


def _boxes(points: DataFrame, keys: list[str]) -> DataFrame:
    return points.groupBy(*keys).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))


def _renamed(df: DataFrame, keys: list[str], prefix: str, by: str) -> DataFrame:
    return df.select(by, *[F.col(c).alias(prefix + c) for c in df.columns if c != by])


def dbscan(df: DataFrame, key: str, x: str, y: str, by: str, params: dict[str, tuple[float, int]], fine: int = 8) -> DataFrame:
    """(key, by, is_core, cluster): cluster is the smallest core id of the cluster, null for noise.

    ``params`` gives (eps, min samples) per group of ``by``; eps has the unit of x and y. Exact.
    Equal coordinates collapse first. Cells have a diagonal of eps, so all points of a cell are
    neighbours: a crowded cell is core without looking at a single pair. Only points of sparse cells
    (fewer than min samples) compare distances; two crowded cells are linked through the boxes of
    their points, refined where a box cannot decide. Components run on cells, not on points.
    """
    eps, need = F.lit(None).cast("double"), F.lit(None).cast("int")
    for name, (e, m) in params.items():
        eps, need = F.when(F.col(by) == name, float(e)).otherwise(eps), F.when(F.col(by) == name, m).otherwise(need)
    side = F.col("eps") / math.sqrt(2)
    points = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(by), F.col(x).alias("x"), F.col(y).alias("y"))
    points = points.agg(F.count(F.lit(1)).alias("w"), F.min(key).alias("first")).withColumns({"eps": eps, "need": need})
    points = points.filter(F.col("eps").isNotNull()).withColumns({"cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side)})
    points = cut_lineage(points)
    weight = points.groupBy(by, "cx", "cy").agg(F.sum("w").alias("cell_w"))
    placed = cut_lineage(points.join(weight, [by, "cx", "cy"]).withColumn("crowded", F.col("cell_w") >= F.col("need")))

    near = lambda a, b: (F.col(f"{a}x") - F.col(f"{b}x")) ** 2 + (F.col(f"{a}y") - F.col(f"{b}y")) ** 2 <= F.col("eps") ** 2
    lonely = placed.filter(~F.col("crowded"))
    probe = _around(lonely.select(by, "x", "y", "eps", "need", "cx", "cy"))
    others = placed.select(by, F.col("cx").alias("nx"), F.col("cy").alias("ny"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("w").alias("ow"))
    counts = (
        probe.join(others, [by, "nx", "ny"]).filter(near("", "o")).groupBy(by, "x", "y", "need").agg(F.sum("ow").alias("n"))
    )
    dense_lonely = counts.filter(F.col("n") >= F.col("need")).select(by, "x", "y", F.lit(True).alias("_hit"))
    scored = placed.join(dense_lonely, [by, "x", "y"], "left").withColumn("is_core", F.col("crowded") | F.coalesce("_hit", F.lit(False))).drop("_hit")
    scored = cut_lineage(scored)
    core = scored.filter("is_core")

    # Links that involve a sparse cell: its few core points against their surroundings.
    cell = lambda p: F.struct(F.col(f"{p}x").alias("x"), F.col(f"{p}y").alias("y"))
    few = _around(core.filter(~F.col("crowded")).select(by, "x", "y", "eps", "cx", "cy"))
    core_others = core.select(by, F.col("cx").alias("nx"), F.col("cy").alias("ny"), F.col("x").alias("ox"), F.col("y").alias("oy"))
    sparse_links = few.join(core_others, [by, "nx", "ny"]).filter(near("", "o")).select(by, cell("c").alias("a"), cell("n").alias("b")).distinct()

    # Links between crowded cells: boxes first, finer boxes where undecided, points last.
    full = core.filter("crowded")
    apart, across, limit = _apart(), _across(), F.col("eps") ** 2
    boxes = _boxes(full, [by, "eps", "cx", "cy"])
    left = _around(boxes).select(by, "eps", F.col("cx").alias("acx"), F.col("cy").alias("acy"), F.col("nx").alias("bcx"), F.col("ny").alias("bcy"),
                                 *[F.col(c).alias("a" + c) for c in ("x0", "x1", "y0", "y1")])
    right = _renamed(boxes.drop("eps"), [], "b", by)
    forward = (F.col("acx") < F.col("bcx")) | ((F.col("acx") == F.col("bcx")) & (F.col("acy") < F.col("bcy")))
    pairs = left.join(right, [by, "bcx", "bcy"]).filter(forward & (apart <= limit)).withColumn("sure", across <= limit)
    pairs = cut_lineage(pairs.select(by, "eps", "acx", "acy", "bcx", "bcy", "sure"))
    open_pairs = pairs.filter(~F.col("sure")).drop("sure")
    ids = [by, "acx", "acy", "bcx", "bcy"]
    joined_tiles, rest = _closest_tiles(open_pairs.select(*ids, "eps"), full, by, side, fine)
    decided = pairs.filter("sure").select(*ids).unionByName(joined_tiles).unionByName(rest)
    crowded_links = decided.select(by, cell("ac").alias("a"), cell("bc").alias("b"))
    links = cut_lineage(sparse_links.unionByName(crowded_links).filter(F.col("a") != F.col("b")).distinct())
    cells = core.select(by, cell("c").alias("cell")).distinct()
    label = components(cells, links, by)

    core_label = core.join(label, [core[by] == label[by], cell("c") == label["cell"]]).select(core[by], "x", "y", "cx", "cy", "first", "root")
    names = core_label.groupBy(by, "root").agg(F.min("first").alias("cluster"))
    core_label = cut_lineage(core_label.join(names, [by, "root"]))
    # Border points: sparse, not core, within reach of a core point; the smallest cluster wins.
    edge = _around(scored.filter(~F.col("is_core")).select(by, "x", "y", "eps", "cx", "cy"))
    target = core_label.select(by, F.col("cx").alias("nx"), F.col("cy").alias("ny"), F.col("x").alias("ox"), F.col("y").alias("oy"), "cluster")
    border = edge.join(target, [by, "nx", "ny"]).filter(near("", "o")).groupBy(by, "x", "y").agg(F.min("cluster").alias("cluster"))
    named = core_label.select(by, "x", "y", "cluster", F.lit(True).alias("is_core")).unionByName(border.withColumn("is_core", F.lit(False)))
    source = df.select(key, by, F.col(x).alias("x"), F.col(y).alias("y"))
    out = source.join(named, [by, "x", "y"], "left")
    return out.select(key, by, F.coalesce("is_core", F.lit(False)).alias("is_core"), "cluster")


def _apart() -> Column:
    return _gap("ax0", "ax1", "bx0", "bx1") ** 2 + _gap("ay0", "ay1", "by0", "by1") ** 2


def _across() -> Column:
    return _reach("ax0", "ax1", "bx0", "bx1") ** 2 + _reach("ay0", "ay1", "by0", "by1") ** 2


#: Points of a pair of tiles (product of both sides) that are compared one by one, and how finely a tile is split each time.
FEW_PAIRS, SPLIT = 64, 4
_FINEST = 1 << 40


def _closest_tiles(cell_pairs: DataFrame, points: DataFrame, by: str, side: Column, fine: int) -> tuple[DataFrame, DataFrame]:
    """The cell pairs that hold two points within eps of each other: (by boxes, by points).

    A dual-tree search, one level of tiles at a time: of a pair of tiles only the boxes of their points count. Boxes further apart than
    eps drop out, boxes wholly within eps decide for their cells, all others are split - the smaller the tiles, the fewer pairs lie across the
    edge of eps. Pairs of tiles with few points compare these.
    """
    ids = [by, "acx", "acy", "bcx", "bcy"]
    tile = lambda size: {f"f{c}": F.floor((F.col(c) / side - F.col(f"c{c}")) * size) for c in "xy"}
    near = (F.col("ax") - F.col("bx")) ** 2 + (F.col("ay") - F.col("by")) ** 2 <= F.col("eps") ** 2
    sides = lambda t, p: t.select(by, *[F.col(c).alias(p + c) for c in t.columns if c != by])
    open_, size, found, rest, parents = cell_pairs, fine, None, None, False
    while True:
        cells = open_.select(by, F.col("acx").alias("cx"), F.col("acy").alias("cy")).unionByName(open_.select(by, F.col("bcx").alias("cx"), F.col("bcy").alias("cy"))).distinct()
        held = points.join(cells, [by, "cx", "cy"], "left_semi").withColumns(tile(size))
        boxes = held.groupBy(by, "cx", "cy", "fx", "fy").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.count(F.lit(1)).alias("n"))
        if parents:  # a tile of the level before holds SPLIT × SPLIT of this one
            boxes = boxes.withColumns({"_ux": F.floor(F.col("fx") / SPLIT), "_uy": F.floor(F.col("fy") / SPLIT)})
        up = ["_ux", "_uy"] if parents else []
        both = open_.join(sides(boxes, "a"), [by, *["a" + c for c in ("cx", "cy", *up)]]).join(sides(boxes, "b"), [by, *["b" + c for c in ("cx", "cy", *up)]])
        kept = both.filter(_apart() <= F.col("eps") ** 2).withColumn("sure", _across() <= F.col("eps") ** 2)
        tiles = cut_lineage(kept.select(*ids, "eps", *[p + c for p in "ab" for c in ("fx", "fy", "n")], "sure"))
        sure = tiles.filter("sure").select(*ids).distinct()
        found = sure if found is None else found.unionByName(sure)
        unsure = tiles.filter("NOT sure").join(sure, ids, "left_anti").drop("sure")
        few = (F.col("an") * F.col("bn") <= FEW_PAIRS) | F.lit(size >= _FINEST)
        spots = held.select(by, "cx", "cy", "fx", "fy", "x", "y")
        hit = unsure.filter(few).join(sides(spots, "a"), [by, "acx", "acy", "afx", "afy"]).join(sides(spots, "b"), [by, "bcx", "bcy", "bfx", "bfy"]).filter(near).select(*ids).distinct()
        hit = cut_lineage(hit)
        rest = hit if rest is None else rest.unionByName(hit)
        many = unsure.filter(~few).join(hit, ids, "left_anti").select(*ids, "eps", *[F.col(f"{p}f{c}").alias(f"{p}_u{c}") for p in "ab" for c in "xy"])
        open_ = cut_lineage(many)
        if open_.isEmpty():
            return found, rest
        parents, size = True, size * SPLIT


def components(nodes: DataFrame, links: DataFrame, by: str, name: str = "cell") -> DataFrame:
    """Connected components: smallest label of the neighbourhood, then jump to the label's own label,
    until nothing changes. The rounds grow with the logarithm of the longest path."""
    both = links.unionByName(links.select(by, F.col("b").alias("a"), F.col("a").alias("b")))
    label = cut_lineage(nodes.select(by, name, F.col(name).alias("root")))
    while True:
        offered = both.join(label.select(by, F.col(name).alias("b"), "root"), [by, "b"]).groupBy(by, F.col("a").alias(name)).agg(F.min("root").alias("_r"))
        lower = label.join(offered, [by, name], "left").select(by, name, F.col("root").alias("_old"), F.least("root", "_r").alias("root"))
        parent = lower.select(by, F.col(name).alias("root"), F.col("root").alias("_jump"))
        moved = lower.join(parent, [by, "root"], "left").select(by, name, "_old", F.coalesce("_jump", "root").alias("root"))
        moved = cut_lineage(moved)
        label = moved.select(by, name, "root")
        if moved.filter(F.col("root") != F.col("_old")).isEmpty():
            return label


def cluster_stats(members: DataFrame, by: str) -> DataFrame:
    """Centre, counts, speeds, congestion, jam, severity and radius per cluster (noise dropped)."""
    kept = members.filter(F.col("cluster").isNotNull())
    stats = kept.groupBy(by, "cluster").agg(
        F.avg("lat").alias("center_lat"), F.avg("lon").alias("center_lon"), F.count(F.lit(1)).alias("num_segments"),
        F.avg("currentSpeed").alias("avg_speed"), F.min("currentSpeed").alias("min_speed"), F.max("currentSpeed").alias("max_speed"),
        F.avg("congestion_ratio").alias("avg_congestion"), F.avg("jamFactor").alias("avg_jam_factor"),
    )
    spread = kept.select(by, "cluster", "lat", "lon").distinct().join(stats, [by, "cluster"]).groupBy(by, "cluster").agg(
        (F.max(F.sqrt((F.col("lat") - F.col("center_lat")) ** 2 + (F.col("lon") - F.col("center_lon")) ** 2)) * 111).alias("radius_km")
    )
    congestion = F.col("avg_congestion")
    severity = F.when(congestion.between(0, 0.3), "low").when(congestion <= 0.6, "medium").when(congestion <= 1.0, "high")
    return stats.join(spread, [by, "cluster"]).withColumn("severity", severity)


def nearest_segment(points: DataFrame, segments: DataFrame, key: str, cell_degrees: float = 0.01, max_m: float = 500.0) -> DataFrame:
    """(key, snapped_segment_id, snap_distance_m) of the closest segment within ``max_m``.

    Segments go to the 3 × 3 cells around theirs; points stay in one cell, so the larger side is never
    copied. Distinct coordinates are snapped once.
    """
    # One degree of longitude shrinks with latitude; cells must still be wider than the search radius.
    if max_m > cell_degrees * 111_000 * math.cos(math.radians(60)):
        raise ValueError("search radius exceeds one cell")
    cell = lambda c: F.floor(F.col(c) / cell_degrees)
    spots = points.select("lat", "lon").dropna().distinct().withColumns({"_cx": cell("lon"), "_cy": cell("lat")})
    moves = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    spread = segments.select("segment_id", F.col("lat").alias("_slat"), F.col("lon").alias("_slon"), F.explode(moves).alias("_m"))
    spread = spread.withColumns(
        {"_cx": F.floor(F.col("_slon") / cell_degrees) + F.col("_m.i"), "_cy": F.floor(F.col("_slat") / cell_degrees) + F.col("_m.j")}
    )
    metres = geo.haversine_km(F.col("lat"), F.col("lon"), F.col("_slat"), F.col("_slon")) * 1000
    found = spots.join(spread, ["_cx", "_cy"]).withColumn("_d", metres).filter(F.col("_d") <= max_m)
    best = found.groupBy("lat", "lon").agg(F.min(F.struct("_d", "segment_id")).alias("_b"))
    out = points.join(best, ["lat", "lon"], "left")
    return out.select(key, F.col("_b.segment_id").alias("snapped_segment_id"), F.col("_b._d").alias("snap_distance_m"))
