"""Numbered small files that say which parts of a table count.

A manifest is written beside its place and renamed into it, so a reader finds all of it or an earlier one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """A path and the file system it is on."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    folder, files = file_system(spark, path)
    files.delete(folder, True)


def names(spark: SparkSession, pattern: str) -> list[str]:
    """The last parts of the paths that match a pattern."""
    glob, files = file_system(spark, pattern)
    return sorted(f.getPath().getName() for f in files.globStatus(glob) or [])


def versions(spark: SparkSession, folder: str) -> list[int]:
    return [int(name.removesuffix(".json")) for name in names(spark, f"{folder}/*.json")]


def _path(folder: str, version: int) -> str:
    return f"{folder}/{version:012d}.json"


def put(spark: SparkSession, folder: str, version: int, content: dict) -> None:
    """Store ``content`` as ``version``; one that is there already is replaced."""
    target, files = file_system(spark, _path(folder, version))
    draft, _ = file_system(spark, f"{folder}/_{uuid.uuid4().hex}")
    out = files.create(draft)
    out.write(json.dumps(content).encode())
    out.close()
    if files.exists(target):
        files.delete(target, False)
    if not files.rename(draft, target):
        raise OSError(f"cannot rename {draft} to {target}")


def get(spark: SparkSession, folder: str, version: int) -> dict:
    return json.loads(spark.read.text(_path(folder, version), wholetext=True).first()["value"])


def newest(spark: SparkSession, folder: str) -> tuple[int, dict] | None:
    """The highest version and its content."""
    known = versions(spark, folder)
    return (known[-1], get(spark, folder, known[-1])) if known else None


def keep_newest(spark: SparkSession, folder: str, count: int) -> None:
    for version in versions(spark, folder)[:-count]:
        delete(spark, _path(folder, version))
