"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from importlib import import_module

MODULES = ["topk", "pii", "url_filter", "sharding", "near_dedup", "suffix_dedup", "packing", "quality", "secret_scan", "bpe", "whitening", "warc", "conversations"]

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _name in MODULES:
    _module = import_module(f"loomframe.llm.{_name}")
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
