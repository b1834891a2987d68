"""Several result tables that appear together.

A run writes its tables under an id of its own. When all are written, one manifest that names the run is
renamed into place; readers follow the newest manifest. A run that fails leaves the earlier results as they
were, and its own files to be deleted by the next run that succeeds.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from skyledger.sinks import manifests

#: Published runs that are kept, so that a reader of the one before can finish.
KEEP_RUNS = 2


def _runs(root: str) -> str:
    return f"{root}/_runs"


def _manifests(root: str) -> str:
    return f"{root}/_published"


def published_root(spark: SparkSession, root: str) -> str | None:
    """The folder of the newest published run, or None before the first one."""
    known = manifests.newest(spark, _manifests(root))
    return f"{_runs(root)}/{known[1]['run']}" if known else None


def publish(spark: SparkSession, root: str, write: Callable[[str], dict[str, str]]) -> dict[str, str]:
    """Call ``write`` with the folder of a new run, and publish the tables it returns (name to path) together."""
    run = uuid.uuid4().hex
    tables = write(f"{_runs(root)}/{run}")
    known = manifests.versions(spark, _manifests(root))
    manifests.put(spark, _manifests(root), known[-1] + 1 if known else 0, {"run": run, "tables": sorted(tables)})
    manifests.keep_newest(spark, _manifests(root), KEEP_RUNS)
    kept = {manifests.get(spark, _manifests(root), v)["run"] for v in manifests.versions(spark, _manifests(root))}
    for name in manifests.names(spark, f"{_runs(root)}/*"):
        if name not in kept:
            manifests.delete(spark, f"{_runs(root)}/{name}")
    return tables
