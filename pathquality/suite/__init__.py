"""The registered queries: the library's operators over the given tables, each with the
SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module
from typing import NamedTuple

from .registry import ORACLES, QUERIES, Query

MODULES = ("flows", "service", "estate")


class Registered(NamedTuple):
    queries: dict[str, Query]
    oracles: dict[str, str]


def all_queries() -> Registered:
    for module in MODULES:
        import_module(f"{__name__}.{module}")
    return Registered(QUERIES, ORACLES)
