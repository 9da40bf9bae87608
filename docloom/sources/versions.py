"""Versions of a stored table: one small file each that says what the version is made of, published by one rename."""

from __future__ import annotations

import json
import re
import uuid
from typing import Any

from pyspark.sql import SparkSession

from docloom.sources.tables import hadoop_path

_VERSION = re.compile(r"(\d{8})\.json")


class VersionExists(RuntimeError):
    """Someone else has published this version meanwhile."""


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions, ascending."""
    path, fs = hadoop_path(spark, _folder(root))
    if not fs.exists(path):
        return []
    names = [_VERSION.fullmatch(status.getPath().getName()) for status in fs.listStatus(path)]
    return sorted(int(name.group(1)) for name in names if name)


def read_version(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, dict[str, Any]]:
    """Number and contents of a version, by default of the newest one."""
    found = versions(spark, root)
    if not found or (version is not None and version not in found):
        raise FileNotFoundError(f"no version {version or ''} under {root}")
    version = found[-1] if version is None else version
    path, fs = hadoop_path(spark, f"{_folder(root)}/{version:08d}.json")
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return version, json.loads(text)


def publish(spark: SparkSession, root: str, version: int, contents: dict[str, Any]) -> int:
    """Publish ``contents`` as ``version``; raises :class:`VersionExists` if that number is taken.

    The file is written under another name and renamed, so a reader sees the whole version or none of it, and of two
    writers that started from the same version the second fails.
    """
    made, fs = hadoop_path(spark, f"{_folder(root)}/.{uuid.uuid4().hex}")
    stream = fs.create(made, False)
    try:
        stream.write(json.dumps(contents).encode())
    finally:
        stream.close()
    target, _ = hadoop_path(spark, f"{_folder(root)}/{version:08d}.json")
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        made.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    no_overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(made), fs.makeQualified(target), no_overwrite)
    except Exception as failed:
        fs.delete(made, False)
        if version in versions(spark, root):
            raise VersionExists(f"version {version} under {root} has been published by someone else") from failed
        raise
    return version


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/versions"
