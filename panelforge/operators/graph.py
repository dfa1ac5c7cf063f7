"""Road graph: export frames, upstream edges, propagation walk, priority interleave."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelforge.functions import geo, text as tx
from panelforge.operators.ordering import with_next


def _end(points: Column, lat: Column, lon: Column, last: bool) -> Column:
    """First or last vertex; a short diagonal through the coordinate when there is no line."""
    shift = 0.003 if last else -0.003
    fallback = F.struct((lon + shift).alias("lon"), (lat + shift).alias("lat"))
    return F.coalesce(F.try_element_at(points, F.lit(-1 if last else 1)), fallback)


def graph_export(latest: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of segments, their end points and districts; ``limit`` keeps the worst segments."""
    ranked = latest.orderBy(F.desc("jamFactor"), "city", "segment_id").limit(limit) if limit else latest
    lat, lon = F.coalesce("lat", F.lit(0.0)), F.coalesce("lon", F.lit(0.0))
    points = geo.line_points(F.col("geometry")) if "geometry" in latest.columns else F.lit(None).cast(f"array<{geo.POINT}>")
    text = lambda n, default: F.coalesce(tx.present(F.col(n)), F.lit(default)) if n in latest.columns else F.lit(default)
    rows = ranked.select(
        F.col("segment_id"), text("city", "unknown").alias("city"), text("district", "unknown").alias("district"),
        F.coalesce(text("segment_name", None), F.col("segment_id")).alias("name"),
        _end(points, lat, lon, False).alias("a"), _end(points, lat, lon, True).alias("b"),
        F.coalesce("jamFactor", F.lit(0.0)).alias("jam"),
    )
    node = lambda kind, key, name, lat, lon, risk: F.struct(
        F.lit(kind).alias("kind"), key.alias("node_id"), F.col("city").alias("city"), name.alias("name"),
        lat.cast("double").alias("lat"), lon.cast("double").alias("lon"), risk.cast("double").alias("risk_score"),
    )
    none = F.lit(None)
    start, end = F.concat("segment_id", F.lit(":start")), F.concat("segment_id", F.lit(":end"))
    district = F.concat_ws(":", F.lit("district"), "city", "district")
    risk = F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.col("jam") * 10.0))
    nodes = rows.select(
        F.inline(
            F.array(
                node("RoadSegment", F.col("segment_id"), F.col("name"), none, none, risk),
                node("Intersection", start, none.cast("string"), F.col("a.lat"), F.col("a.lon"), none),
                node("Intersection", end, none.cast("string"), F.col("b.lat"), F.col("b.lon"), none),
                node("District", district, F.col("district"), none, none, none),
            )
        )
    ).dropDuplicates(["kind", "node_id"])
    edge = lambda kind, target: F.struct(F.lit(kind).alias("kind"), F.col("segment_id").alias("from_id"), target.alias("to_id"))
    edges = rows.select(F.inline(F.array(edge("LOCATED_IN", district), edge("STARTS_AT", start), edge("ENDS_AT", end))))
    return nodes, edges.distinct()


def upstream_edges(latest: DataFrame, limit: int | None = None) -> DataFrame:
    """Consecutive pairs by jam inside a city, of all segments or of the ``limit`` worst; segments without a jam value come last.

    The order is cut into range partitions, so neither a big city nor one jam value that many segments share is sorted in one task.
    """
    worst = latest.orderBy(F.desc("jamFactor"), "city", "segment_id").limit(limit) if limit else latest
    rows = worst.select("city", F.col("segment_id").alias("upstream"), (-F.col("jamFactor")).alias("_calm"))
    paired = with_next(rows, F.col("_calm").asc_nulls_last(), "upstream", by=["city"], value="upstream", into="downstream")
    return paired.select("city", "upstream", "downstream").filter("downstream is not null")


def upstream_walk(edges: DataFrame, start: str, depth: int) -> DataFrame:
    """Segments reached against the flow, with their hop count; one equi join per hop, depth ≤ 5."""
    if not 1 <= depth <= 5:
        raise ValueError("depth must be 1 to 5")
    reached = edges.sparkSession.createDataFrame([(start, 0)], "segment_id string, hop int")
    frontier = reached
    for hop in range(1, depth + 1):
        frontier = (
            frontier.join(edges, frontier["segment_id"] == edges["downstream"])
            .select(F.col("upstream").alias("segment_id"), F.lit(hop).alias("hop"))
            .distinct()
        )
        reached = reached.unionByName(frontier)
    return reached.groupBy("segment_id").agg(F.min("hop").alias("hop"))


def ranked_chain(latest: DataFrame, size: int, spacing_m: int = 500, first: int = 0) -> DataFrame:
    """Worst ``size`` segments with a synthetic distance by rank."""
    worst = latest.orderBy(F.desc("jamFactor"), "city", "segment_id").limit(size)
    rank = F.row_number().over(Window.orderBy(F.desc("jamFactor"), "city", "segment_id"))
    return worst.withColumn("distance_m", (rank - 1 + first) * spacing_m)


def interleave(df: DataFrame, priority: str, order: list[str], cycle: tuple[int, ...], limit: int) -> DataFrame:
    """First ``limit`` rows of a weighted round robin over priority classes.

    The n-th row of a class takes the n-th slot of that class in the repeating cycle; a class that
    runs dry simply leaves its slots empty. Spark limits every class to ``limit`` rows before the
    shuffle, so the window never sees a whole class.
    """
    rank = F.row_number().over(Window.partitionBy(priority).orderBy(*order))
    ranked = df.withColumn("_rank", rank).filter(F.col("_rank") <= limit)
    slot = F.lit(None).cast("long")
    for name in sorted(set(cycle)):
        places = [i for i, c in enumerate(cycle) if c == name]
        turn = F.floor((F.col("_rank") - 1) / len(places))
        place = F.element_at(F.array(*[F.lit(p) for p in places]), ((F.col("_rank") - 1) % len(places) + 1).cast("int"))
        slot = F.when(F.col(priority) == name, turn * len(cycle) + place).otherwise(slot)
    best = ranked.withColumn("_slot", slot).filter(F.col("_slot").isNotNull()).orderBy("_slot").limit(limit)
    position = F.row_number().over(Window.orderBy("_slot"))
    return best.withColumn("position", position).drop("_rank", "_slot")
