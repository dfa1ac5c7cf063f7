"""Places in a global order without a window over all rows: range partitions, row counts per partition, prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelforge.session import cut_lineage

_PLACE_BITS = 33  # of ``monotonically_increasing_id``: the lower bits count the rows of a partition


def placed(df: DataFrame, *order: str | Column, partitions: int | None = None) -> DataFrame:
    """Adds ``_part`` and ``_place``: rows ordered by (_part, _place) are in the given order. The result is a stored table.

    Rows that tie in the whole order are told apart by their place in the input, so a value that many rows share is
    split over partitions like any other. Where such rows occur, ``df`` must give its rows in the same order when a task
    runs again, as scans and stored tables do.
    """
    keys = [*[F.col(c) if isinstance(c, str) else c for c in order], F.col("_tie")]
    tagged = df.withColumn("_tie", F.monotonically_increasing_id())
    width = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = tagged.repartitionByRange(width, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    rows = ranged.select(
        *df.columns, F.shiftright("_at", _PLACE_BITS).cast("int").alias("_part"), F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1).alias("_place")
    )
    return cut_lineage(rows)


def numbered(df: DataFrame, *order: str | Column, by: list[str] | None = None, into: str = "position", partitions: int | None = None) -> DataFrame:
    """Adds ``into``: 0-based place of every row in the order, or in the order inside its ``by`` group (null is a group).

    The order starts with ``by``. A group of any size is spread over as many partitions as its share of the rows.
    """
    by = by or []
    rows = placed(df, *by, *order, partitions=partitions)
    counts = rows.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    # Per group one row for each partition that it touches.
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(*by, "_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_base"))
    joined = rows.alias("l").join(bases.alias("r"), _same("l", "r", [*by, "_part"]))
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], (F.col("l._place") + F.col("r._base")).alias(into))


def with_next(df: DataFrame, *order: str | Column, by: list[str] | None = None, value: str, into: str, partitions: int | None = None) -> DataFrame:
    """Adds ``into``: ``value`` of the following row of the same ``by`` group; null for the group's last row.

    Rows look ahead inside their partition; the last one takes the first row of the group's next partition.
    """
    by = by or []
    rows = placed(df, *by, *order, partitions=partitions)
    inside = Window.partitionBy(*by, "_part").orderBy("_place")
    heads = rows.groupBy(*by, "_part").agg(F.min_by(F.struct(F.col(value).alias("v")), "_place").alias("_head"))
    following = heads.select(*by, "_part", F.lead("_head").over(Window.partitionBy(*by).orderBy("_part")).alias("_follows"))
    ahead = rows.withColumn("_next", F.lead(F.struct(F.col(value).alias("v"))).over(inside))
    joined = ahead.alias("l").join(following.alias("r"), _same("l", "r", [*by, "_part"]))
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], F.coalesce(F.col("l._next"), F.col("r._follows"))["v"].alias(into))


def _same(left: str, right: str, names: list[str]) -> Column:
    on = F.lit(True)
    for n in names:
        on = on & F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}"))
    return on
