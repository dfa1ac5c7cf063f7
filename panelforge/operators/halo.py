"""Windows over bounded pieces of a series.

A frame that reaches at most H seconds back (or ahead) does not need the whole series in one task.
The time axis is cut into chunks; rows within reach of a chunk are copied into it, the window runs
inside (series, chunk), and only the chunk's own rows are kept. Partition size is then bounded by
chunk + halo, whatever the length of the series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

CHUNK, HOME = "_chunk", "_home"


def chunked(df: DataFrame, position: Column, chunk: int, before: int = 0, after: int = 0) -> DataFrame:
    """Copy each row into every chunk whose frames may look at it (``before`` back, ``after`` ahead)."""
    first = F.floor((position - after) / chunk).cast("long")
    last = F.floor((position + before) / chunk).cast("long")
    own = F.floor(position / chunk).cast("long")
    return df.withColumn(CHUNK, F.explode(F.sequence(first, last))).withColumn(HOME, F.col(CHUNK) == own)


def chunk_window(keys: list[str], order: Column | str) -> WindowSpec:
    return Window.partitionBy(*keys, CHUNK).orderBy(order)


def only_home(df: DataFrame) -> DataFrame:
    return df.filter(F.col(HOME)).drop(CHUNK, HOME)
