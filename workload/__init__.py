"""Queries over the given tables, one per operator, with their SQL."""

from workload.registry import ORACLES, QUERIES  # noqa: F401
from workload import build_queries, cluster_queries, decision_queries, learning_queries, panel_queries, series_queries, store_queries, text_queries  # noqa: F401,E402
