"""Registered queries over the driver's test tables (see :mod:`bidbox.plans.bindings`)."""

from __future__ import annotations

import importlib

from .registry import ORACLE, QUERIES, Tables, register, table  # noqa: F401

_MODULES = [
    "q_report",
    "q_relational",
    "q_joins",
    "q_scalar",
    "q_handrec",
    "q_filters_schema",
    "q_sources",
    "q_sql",
    "q_rating",
    "q_stream",
    "q_ml",
]


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(f"{__name__}.{m}")
