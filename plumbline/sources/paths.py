"""Path helpers that go through the Hadoop file system, so any store works."""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path, or any file of the glob, exists."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(target)
    return found is not None and len(found) > 0


def require_path(spark: SparkSession, path: str) -> str:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no such file: {path}")
    return path


def suffix_of(path: str) -> str:
    return posixpath.splitext(path.rstrip("/"))[1].lower()


def stem_of(path: str) -> str:
    """The dataset name of a file."""
    return posixpath.splitext(posixpath.basename(path.rstrip("/")))[0]


def path_stem(path: Column) -> Column:
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")


def path_suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1))
