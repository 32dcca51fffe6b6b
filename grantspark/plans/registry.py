"""Registered queries and the DuckDB SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import materialize
from .derived import ctes, derive

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Frames:
    """Attribute access to given and derived frames of one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return derive(self.spark, self.folder, name)

    def stored(self, name: str, build: Callable[[], DataFrame] | None = None) -> DataFrame:
        """A stage's output written once and read by every later step of the query, as the pipeline stores it."""
        kept = self.__dict__.setdefault("_stored", {})
        if name not in kept:
            kept[name] = materialize(build() if build else derive(self.spark, self.folder, name), name)
        return kept[name]


def query(name: str, uses: str = "", sql: str | None = None, recursive: bool = False):
    """Register ``fn(frames)``; ``sql`` is the oracle's tail after the CTEs of the frames in ``uses``."""

    def wrap(fn: Callable[[Frames], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Frames(spark, folder))
        if sql is not None:
            head = ctes(*uses.split())
            body = sql.strip()
            if body.upper().startswith("WITH "):
                body = body[5:]
                ORACLES[name] = f"WITH {'RECURSIVE ' if recursive else ''}{head + ',' if head else ''}\n{body}"
            else:
                ORACLES[name] = f"WITH {head}\n{body}" if head else body
        return fn

    return wrap
