"""Collects registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from checks.derive import read_parquet, table, with_tables
from partledger.session import shared_folder


CONTROL_TABLES = {"listing", "state", "headers", "cache", "stored", "objects", "documents_text"}


class Inputs:
    """The tables of one run, given or derived, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in CONTROL_TABLES:
            return table(self.spark, self.sf_dir, name)
        # Control tables are stored, as in an archive; rows are derived where they are read.
        path = self.once(name, lambda to: table(self.spark, self.sf_dir, name).write.parquet(to))
        return read_parquet(self.spark, path)

    def once(self, purpose: str, build: Callable[[str], None]) -> str:
        """A folder that ``build`` fills the first time an application asks for it."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, purpose)
        if key not in _FOLDERS:
            path = shared_folder(self.spark, purpose)
            build(path)
            _FOLDERS[key] = path
        return _FOLDERS[key]

    def folder(self, purpose: str) -> str:
        return shared_folder(self.spark, purpose)


_FOLDERS: dict[tuple, str] = {}


@dataclass(frozen=True)
class Query:
    run: Callable[[Inputs], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, needs: str = "", sql: str | None = None, extra: dict[str, str] | None = None):
    """Registers a query; ``sql`` is its check over the derived tables ``needs``."""

    def wrap(run: Callable[[Inputs], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"registered twice: {name}")
        full = None
        if sql is not None:
            used = needs.split()
            full = f"{with_tables(used, extra)} {sql}" if used or extra else sql
        REGISTRY[name] = Query(run, full)
        return run

    return wrap


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def call(q: Query):
        return lambda spark, sf_dir: q.run(Inputs(spark, sf_dir))

    return {name: call(q) for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}
