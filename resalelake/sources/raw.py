"""The set of raw tables a build reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from resalelake.sources.contracts import RAW_DDL, scan


class RawTables:
    """Raw tables by name, resolved when first asked for."""

    def __init__(self, load: Callable[[str], DataFrame]):
        self._load = load
        self._seen: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in RAW_DDL:
            raise AttributeError(name)
        if name not in self._seen:
            self._seen[name] = self._load(name)
        return self._seen[name]

    @classmethod
    def landed(cls, spark: SparkSession, root: str) -> RawTables:
        """Raw tables written as Parquet folders below one root."""
        return cls(lambda name: scan(spark, name, f"{root.rstrip('/')}/{name}"))
