"""Versions of a table behind a log of commits.

A version is a folder written whole before its commit: a numbered file that is
created only if it is not there. The last whole commit says what counts, so a
reader sees the old table or the new one, whatever fails in between; folders
without a commit, and commits cut off while written, are not there. Nothing is
deleted on the way. Two writers cannot both get a number: the later one fails
if it said which version it worked from, else takes the next.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

LOG = "_commits"


class Conflict(RuntimeError):
    """Another writer committed first."""


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    where, fs = _place(spark, f"{path}/{LOG}")
    names = [x.getPath().getName() for x in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(int(n[:-5]) for n in names if re.fullmatch(r"\d{20}\.json", n))


def history(spark: SparkSession, path: str) -> dict[int, dict]:
    """Whole commits by number, oldest first."""
    out = {}
    for n in _numbers(spark, path):
        where, fs = _place(spark, f"{path}/{LOG}/{n:020d}.json")
        stream = fs.open(where)
        try:
            out[n] = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except ValueError:
            continue
        finally:
            stream.close()
    return out


def commit(spark: SparkSession, path: str, entry: dict, after: int | None = None) -> int:
    """Write the next commit; with `after`, only if that is still the last one. Returns its number."""
    while True:
        n = max(_numbers(spark, path), default=0) + 1
        if after is not None and n != after + 1:
            raise Conflict(f"{path} is at version {n - 1}, not {after}")
        where, fs = _place(spark, f"{path}/{LOG}/{n:020d}.json")
        try:
            stream = fs.create(where, False)
        except Exception:
            if not fs.exists(where):
                raise
            continue  # another writer has this number
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        return n


def version(spark: SparkSession, path: str) -> int:
    """Number of the last commit, whole or not; 0 without any."""
    return max(_numbers(spark, path), default=0)


def publish(df: DataFrame, path: str, after: int | None = None) -> int:
    """Make df the table at path, from which it may be read itself; files that lie there already stay as version 0."""
    spark, name = df.sparkSession, uuid.uuid4().hex
    df.write.parquet(f"{path}/_versions/{name}")
    return commit(spark, path, {"folder": name, "schema": df.schema.json()}, after)


def read_table(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table at path as its last whole commit has it, or as commit `number` has it (0: the files from before any)."""
    from pyspark.sql.types import StructType

    past = history(spark, path)
    number = max(past, default=0) if number is None else number
    if number == 0:
        return spark.read.parquet(path)
    if number not in past:
        raise AnalysisException(f"{path} has no version {number}")
    return spark.read.schema(StructType.fromJson(json.loads(past[number]["schema"]))).parquet(f"{path}/_versions/{past[number]['folder']}")
