"""As-of, interval and lookup joins rewritten as equi joins over reduced keys.

Matching depends only on (key, instant), never on the single fact row. So the work is done once per
distinct (key, instant) - bounded by calendar time per key - and joined back to the facts. A city
that holds a third of the facts costs one extra row per bucket here, not a third of the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelforge.functions import times as tm
from panelforge.operators.halo import chunk_window, chunked, only_home

AT = "_at"


def one_per_instant(right: DataFrame, by: list[str], on: str, columns: list[str], prefer: str) -> DataFrame:
    """Reduce the right side to one row per (key, instant); the larger ``prefer`` wins."""
    return right.groupBy(*by, on).agg(F.max_by(F.struct(*columns), F.col(prefer)).alias("_v")).select(*by, on, "_v.*")


def _timeline(left: DataFrame, right: DataFrame, by: list[str], on: str, columns: list[str], right_on: str, reach: int,
              ahead: bool) -> DataFrame:
    """Distinct left instants and right rows of each key on one chunked axis."""
    wanted = left.select(*by, on).dropna().distinct()
    facts = right.select(
        *by,
        F.col(right_on).alias(on),
        F.struct(F.col(right_on).alias("_right_time"), *[F.col(c) for c in columns]).alias("_v"),
        F.lit(0).alias("_side"),
    )
    empty = F.lit(None).cast(facts.schema["_v"].dataType)
    union = facts.unionByName(wanted.select("*", empty.alias("_v"), F.lit(1).alias("_side")))
    placed = union.withColumn(AT, tm.epoch_micros(F.col(on)))
    micros = reach * 1_000_000
    return chunked(placed, F.col(AT), max(4 * micros, 86_400_000_000), before=micros, after=micros if ahead else 0)


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    on: str,
    columns: list[str],
    tolerance_seconds: int,
    right_on: str | None = None,
) -> DataFrame:
    """Left join with the newest right row at or before the left instant, at most the tolerance old.

    ``right`` must hold one row per (key, instant); see ``one_per_instant``.
    """
    matched = backward_matches(left, right, by, on, columns, tolerance_seconds, right_on)
    return left.join(matched, [*by, on], "left")


def backward_matches(left, right, by, on, columns, tolerance_seconds, right_on=None) -> DataFrame:
    """(key, instant) → matched right columns, only where there is a match."""
    right_on = right_on or on
    line = _timeline(left, right, by, on, columns, right_on, tolerance_seconds, ahead=False)
    window = Window.partitionBy(*by, "_chunk").orderBy(AT, "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = only_home(line.withColumn("_v", F.last("_v", ignorenulls=True).over(window))).filter(F.col("_side") == 1)
    age = F.col(AT) - tm.epoch_micros(F.col("_v._right_time"))
    found = found.filter(age <= tolerance_seconds * 1_000_000)
    return found.select(*by, on, *[F.col(f"_v.{c}").alias(c) for c in columns])


def asof_nearest(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    on: str,
    columns: list[str],
    tolerance_seconds: int,
    right_on: str | None = None,
) -> DataFrame:
    """Inner join with the right row nearest in time (either side) within the tolerance.

    Equal distances go to the earlier right row. Adds ``time_diff_minutes``.
    """
    right_on = right_on or on
    line = _timeline(left, right, by, on, columns, right_on, tolerance_seconds, ahead=True)
    base = Window.partitionBy(*by, "_chunk").orderBy(AT, "_side")
    back = base.rowsBetween(Window.unboundedPreceding, 0)
    ahead = base.rowsBetween(0, Window.unboundedFollowing)
    found = line.withColumns(
        {"_b": F.last("_v", ignorenulls=True).over(back), "_f": F.first("_v", ignorenulls=True).over(ahead)}
    )
    found = only_home(found).filter(F.col("_side") == 1)
    gap_back = F.col(AT) - tm.epoch_micros(F.col("_b._right_time"))
    gap_ahead = tm.epoch_micros(F.col("_f._right_time")) - F.col(AT)
    use_back = gap_back.isNotNull() & (gap_ahead.isNull() | (gap_back <= gap_ahead))
    found = found.withColumns(
        {"_v": F.when(use_back, F.col("_b")).otherwise(F.col("_f")), "_gap": F.when(use_back, gap_back).otherwise(gap_ahead)}
    ).filter(F.col("_gap") <= tolerance_seconds * 1_000_000)
    matched = found.select(
        *by, on, *[F.col(f"_v.{c}").alias(c) for c in columns], (F.col("_gap") / 60_000_000).alias("time_diff_minutes")
    )
    return left.join(matched, [*by, on], "inner")


def asof_with_fallback(
    left: DataFrame,
    right: DataFrame,
    group: str,
    cell: str,
    on: str,
    columns: list[str],
    tolerance_seconds: int,
) -> DataFrame:
    """Backward as-of inside the cell; a cell without any right row at all uses its whole group.

    The choice is per cell, not per row: a known cell with nothing recent stays null. In the pooled
    group the larger cell id wins at equal instants.
    """
    known = right.select(group, cell).distinct().withColumn("_known", F.lit(True))
    own = backward_matches(left, right, [group, cell], on, columns, tolerance_seconds)
    pooled = one_per_instant(right, [group], on, columns, cell)
    shared = backward_matches(left, pooled, [group], on, columns, tolerance_seconds)
    own = own.select(group, cell, on, F.struct(*columns).alias("_own"))
    shared = shared.select(group, on, F.struct(*columns).alias("_shared"))
    out = left.join(known, [group, cell], "left").join(own, [group, cell, on], "left").join(shared, [group, on], "left")
    picked = F.when(F.col("_known"), F.col("_own")).otherwise(F.col("_shared"))
    out = out.withColumn("_pick", picked)
    return out.select(*[F.col(c) for c in left.columns], *[F.col(f"_pick.{c}").alias(c) for c in columns])


def latest_join(left: DataFrame, right: DataFrame, by: str, ts: str, columns: list[str], tie: str) -> DataFrame:
    """Newest right row per key onto every left row (it may lie in the left row's future)."""
    newest = right.groupBy(by).agg(F.max_by(F.struct(*columns), F.struct(F.col(ts), F.col(tie))).alias("_v"))
    return left.join(newest.select(by, "_v.*"), by, "left")


def window_aggregates(
    grid: DataFrame,
    events: DataFrame,
    by: list[str],
    grid_ts: str,
    event_ts: str,
    bucket_seconds: int,
    sums: dict[str, tuple[Column, int, int]],
    maxes: dict[str, tuple[Column, int, int]] | None = None,
) -> DataFrame:
    """Aggregates of the events around each grid instant; inclusive bounds in seconds, sums default 0.

    Every spec is (expression, seconds back, seconds ahead); bounds must be whole buckets and the grid
    instants must lie on the bucket grid. Events collapse first to half-bucket slots - even slots are
    grid instants, odd slots the open gaps between them - which keeps the bounds exact and leaves at
    most two rows per bucket and key for the frames, however many events there are.
    """
    maxes = maxes or {}
    bounds = [(b, a) for _, b, a in [*sums.values(), *maxes.values()]]
    if any(b % bucket_seconds or a % bucket_seconds for b, a in bounds):
        raise ValueError("window bounds must be whole buckets")
    step = lambda seconds: 2 * (seconds // bucket_seconds)
    back, ahead = max(step(b) for b, _ in bounds), max(step(a) for _, a in bounds)
    size = bucket_seconds * 1_000_000
    micros = tm.epoch_micros(F.col(event_ts))
    slot = 2 * F.floor(micros / size).cast("long") + F.when(micros % size == 0, 0).otherwise(1)
    slotted = events.withColumn(AT, slot).groupBy(*by, AT).agg(
        *[F.sum(e).alias(n) for n, (e, _, _) in sums.items()], *[F.max(e).alias(n) for n, (e, _, _) in maxes.items()]
    )
    instants = grid.select(*by, grid_ts).dropna().distinct()
    at = tm.epoch_micros(F.col(grid_ts))
    off = F.raise_error(F.concat(F.lit("instant off the bucket grid: "), F.col(grid_ts).cast("string"))).cast("long")
    instants = instants.withColumn(AT, F.when(at % size == 0, 2 * F.floor(at / size).cast("long")).otherwise(off))
    line = slotted.unionByName(instants, allowMissingColumns=True)
    window = chunk_window(by, AT)
    spread = chunked(line, F.col(AT), max(4 * (back + ahead), 2048), before=back, after=ahead)
    frame = lambda b, a: window.rangeBetween(-step(b), step(a))
    new = {n: F.coalesce(F.sum(n).over(frame(b, a)), F.lit(0)) for n, (_, b, a) in sums.items()}
    new.update({n: F.max(n).over(frame(b, a)) for n, (_, b, a) in maxes.items()})
    kept = only_home(spread.withColumns(new)).filter(F.col(grid_ts).isNotNull())
    return kept.select(*by, grid_ts, *sums, *maxes)


def lookup(left: DataFrame, right: DataFrame, keys: list[str], defaults: dict[str, object]) -> DataFrame:
    """Left equi join with a default for every column a miss leaves null. AQE broadcasts or splits skew."""
    joined = left.join(right.select(*keys, *defaults), keys, "left")
    return joined.withColumns({n: F.coalesce(F.col(n), F.lit(v)) for n, v in defaults.items()})


def not_yet_known(candidates: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose id is not in the other table."""
    return candidates.join(existing.select(key), key, "left_anti")


def best_in_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Row that sorts last by ``order`` in each group (one partial-aggregated ``max_by``)."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_row")).select("_row.*")
