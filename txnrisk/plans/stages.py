"""Memoised stage outputs per (session, input files).

The registered queries share upstream stages (the feature table feeds about
forty of them). Each stage is materialised once per session into the shared
checkpoint folder and reused, the way a production job would read the stage
table written by the previous job. The key holds names, sizes and times of the
files in the input folder, so a rewritten input is read anew.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession

T = TypeVar("T")
_MEMO: dict[tuple, object] = {}


def input_version(spark: SparkSession, sf_dir: str) -> tuple:
    """(name, size, time) of the folder's files, one level of folders deep, as
    the cluster's file system lists them."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for s in fs.listStatus(root):
        own = fs.listStatus(s.getPath()) if s.isDirectory() else [s]
        found += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in own]
    return tuple(sorted(found))


def memo(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], T]) -> T:
    key = (spark.sparkContext.applicationId, input_version(spark, sf_dir.rstrip("/")), name)
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def clear() -> None:
    _MEMO.clear()
