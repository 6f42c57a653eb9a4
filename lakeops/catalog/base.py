"""The registry of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from lakeops.tables import Tables


@dataclass
class Entry:
    build: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register a function from tables to a frame, with its SQL where SQL can say it."""
    def keep(build):
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Entry(build, sql)
        return build
    return keep
