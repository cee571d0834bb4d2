"""Removal of versions that nobody can be reading any more.

Facts, change logs and replaced tables only ever add versions. A version is in use while its table's log names it, and for a grace
period after the log stopped naming it, since a reader that asked the log before may still be reading. A version that no log entry ever
named belongs to a write that failed, or is still running: it goes when the grace period has passed since it was begun.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping
from datetime import timedelta

from pyspark.sql import SparkSession

from resalelake.plans.warehouse import LOG as FACT_LOG
from resalelake.sources.sinks import _empty
from resalelake.streaming.changes import LOG as CHANGE_LOG
from resalelake.streaming.changes import VERSION

GRACE = timedelta(days=2)


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()) if fs.exists(target) else []


def _begun(version: str) -> int:
    """Versions begin with the time they were begun, in nanoseconds."""
    return int(version.split("-")[0])


def _sweep(spark: SparkSession, parts: Mapping[str, str], replaced: Mapping[str, int | None], grace: timedelta, now: int | None) -> list[str]:
    """Remove versions from folders (path -> how a version's folder begins). ``replaced`` says when the log stopped naming a
    version, None where it still does."""
    limit, gone = (now or time.time_ns()) - int(grace.total_seconds() * 1e9), set()
    for path, prefix in parts.items():
        for folder in _folders(spark, path):
            version = folder.removeprefix(prefix)
            if not folder.startswith(prefix) or not version[:20].isdigit():
                continue
            since = replaced.get(version, _begun(version)) if version in replaced else _begun(version)
            if since is not None and since < limit:
                _empty(spark, f"{path}/{folder}")
                gone.add(version)
    return sorted(gone)


def sweep_fact(spark: SparkSession, root: str, name: str, grace: timedelta = GRACE, now: int | None = None) -> list[str]:
    """Versions of a published fact that no month is read from any more."""
    target = f"{root.rstrip('/')}/{name}"
    by_month: dict = {}
    for row in spark.read.schema(FACT_LOG).parquet(f"{target}/log").select("month", "version").distinct().collect():  # a row per part and publication
        by_month.setdefault(row.month, []).append(row.version)
    replaced: dict[str, int | None] = {}
    for versions in by_month.values():
        ordered = sorted(versions)
        for version, following in zip(ordered, [*ordered[1:], None]):
            since = None if following is None else _begun(following)
            known = replaced.get(version, 0)
            replaced[version] = None if since is None or known is None else max(known, since)
    return _sweep(spark, {f"{target}/data": ""}, replaced, grace, now)


def sweep_facts(spark: SparkSession, root: str, names: Iterable[str], grace: timedelta = GRACE, now: int | None = None) -> dict[str, list[str]]:
    return {name: sweep_fact(spark, root, name, grace, now) for name in names}


def sweep_changes(spark: SparkSession, root: str, parts: Iterable[str], grace: timedelta = GRACE, now: int | None = None) -> list[str]:
    """Versions of an append-only table that were compacted into a later base."""
    rows = spark.read.schema(CHANGE_LOG).parquet(f"{root.rstrip('/')}/log").orderBy("version").collect()  # a row per batch
    bases = [k for k, r in enumerate(rows) if r.base]
    replaced: dict[str, int | None] = {}
    for k, row in enumerate(rows):
        after = [b for b in bases if b > k]
        # The first base after it replaced it.
        replaced[row.version] = _begun(rows[after[0]].version) if after else None
    return _sweep(spark, {f"{root.rstrip('/')}/{part}": f"{VERSION}=" for part in parts}, replaced, grace, now)
