"""Exact set-similarity join: all pairs of token sets whose Jaccard similarity reaches a threshold.

Tokens stand in one global order, rarest first. Two similar sets must share one of their first tokens, so only prefixes are
indexed: of the longer set the probing prefix, of the shorter one the still shorter indexing prefix. Lengths and the
places of the shared token then bound the overlap that is still possible; what passes is compared in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelforge.operators import ordering

_SLACK = 1e-9  # keeps a bound that is a whole number from being rounded up


def rarest_first(sets: DataFrame, key: str, tokens: str) -> DataFrame:
    """(key, tokens, n): tokens become their places in the order by how many sets hold them, then by name, and each set is in that order.

    A place says as much as the token and takes fewer bytes where sets are shuffled with every token of their prefix.
    """
    token = sets.select(key, F.explode(tokens).alias("_t"))
    counts = token.groupBy("_t").agg(F.count(F.lit(1)).alias("_c"))
    places = ordering.numbered(counts, "_c", "_t", into="_o").select("_t", "_o")
    ordered = token.join(places, "_t").groupBy(key).agg(F.sort_array(F.collect_list("_o")).alias(tokens))
    return ordered.withColumn("n", F.size(tokens))


def _up(x: Column) -> Column:
    return F.ceil(x - _SLACK).cast("int")


def _prefix(sets: DataFrame, key: str, tokens: str, tag: str, share: float) -> DataFrame:
    """One row for each token of a prefix that leaves out all but one of ``share`` of the set."""
    length = F.col("n") - _up(F.col("n") * share) + 1
    rows = sets.select(F.col(key).alias(f"_k{tag}"), F.col(tokens).alias(f"_t{tag}"), F.col("n").alias(f"_n{tag}"), F.posexplode(F.slice(tokens, F.lit(1), length)).alias(f"_p{tag}", "_token"))
    return rows


def similar_sets(left: DataFrame, right: DataFrame | None, threshold: float, key: str = "vid", tokens: str = "tokens") -> DataFrame:
    """(a, b) of all similar pairs: a from ``left``, b from ``right``; with ``right`` None each pair inside ``left`` once, a < b.

    Inputs come from ``rarest_first`` over one common set of sets, with unique keys; empty sets match nothing.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold lies in (0, 1]")
    own = 2 * threshold / (1 + threshold)

    def matched(longer: DataFrame, shorter: DataFrame, order: Column) -> DataFrame:
        both = _prefix(longer, key, tokens, "x", threshold).join(_prefix(shorter, key, tokens, "y", own), "_token")
        need = _up((F.col("_nx") + F.col("_ny")) * (threshold / (1 + threshold)))
        # Some row of the pair is about its first shared token: from there on no more than the shorter rest can be shared.
        possible = F.least(F.col("_nx") - F.col("_px"), F.col("_ny") - F.col("_py"))
        near = both.filter(order & (F.col("_ny") >= F.col("_nx") * threshold - _SLACK) & (possible >= need))
        shared = F.size(F.array_intersect("_tx", "_ty"))
        return near.filter(shared / (F.col("_nx") + F.col("_ny") - shared) >= threshold).select("_kx", "_ky")

    if right is None:
        first = (F.col("_ny") < F.col("_nx")) | ((F.col("_ny") == F.col("_nx")) & (F.col("_ky") < F.col("_kx")))
        return matched(left, left, first).select(F.least("_kx", "_ky").alias("a"), F.greatest("_kx", "_ky").alias("b")).distinct()
    forth = matched(left, right, F.col("_ny") <= F.col("_nx")).select(F.col("_kx").alias("a"), F.col("_ky").alias("b"))
    back = matched(right, left, F.col("_ny") < F.col("_nx")).select(F.col("_ky").alias("a"), F.col("_kx").alias("b"))
    return forth.unionByName(back).distinct()
