"""Composed jobs and the registry of named queries."""

from __future__ import annotations

from importlib import import_module

_FAMILIES = ["action_queries", "recommend_queries", "notify_queries", "trace_queries", "metric_queries",
             "table_queries", "stream_queries"]


def _load():
    from shoplens.plans import registry

    for family in _FAMILIES:
        import_module(f"shoplens.plans.{family}")
    return registry


def all_queries():
    return dict(_load().QUERIES)


def all_oracles():
    return dict(_load().ORACLES)
