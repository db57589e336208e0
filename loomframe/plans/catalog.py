"""All registered queries and their SQL."""

from __future__ import annotations

from importlib import import_module

from loomframe.plans.registry import ORACLES, QUERIES

for _module in ("frame_queries", "stat_queries", "mask_queries", "join_queries", "source_queries", "linear_queries", "run_queries", "graph_queries", "stream_queries"):
    import_module(f"loomframe.plans.{_module}")

__all__ = ["ORACLES", "QUERIES"]
