"""Sinks: partitioned overwrite, append logs, backups, text files."""

from __future__ import annotations

import uuid
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .commits import publish
from .copies import open_path


def write_runs(df: DataFrame, path: str, run: str = "run_id") -> None:
    """Parquet by run; only the runs that df holds are overwritten."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run).parquet(path)


def write_json(df: DataFrame, path: str, single: bool = False) -> None:
    (df.coalesce(1) if single else df).write.mode("overwrite").json(path)


def append_log(df: DataFrame, path: str) -> None:
    """Events as JSON lines, stamped."""
    df.withColumn("created_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")).write.mode("append").json(path)


def write_texts(df: DataFrame, path: str, run: str = "run_id", column: str = "html") -> None:
    """A folder of text a run."""
    df.select(run, F.col(column).alias("value")).write.mode("overwrite").partitionBy(run).option("lineSep", "\n").text(path)


def write_joined(df: DataFrame, path: str, column: str, order: list[str], sep: str = ",", run: str = "run_id") -> None:
    """A folder of one text file a run: the column of its rows in order, joined by sep, and a line feed; nulls are left out, as are rows without a run.

    Spark sorts the rows and tasks write them batch by batch, so no run is held whole. A repeated task makes the same file again.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))

    def write(batches):
        there, folder = open_path(path)
        now = out = part = None
        empty, runs, mark = True, 0, sep.encode()

        def close():
            out.write(b"\n")
            out.close()
            there.move(part, f"{folder}/{run}={quote(now, safe='')}/part-0.txt")

        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key != now:
                    if out:
                        close()
                    now, empty, runs = key, True, runs + 1
                    there.create_dir(f"{folder}/{run}={quote(key, safe='')}", recursive=True)
                    part = f"{folder}/{run}={quote(key, safe='')}/.part-{uuid.uuid4().hex}"
                    out = there.open_output_stream(part, buffer_size=1 << 20)
                if value is not None:
                    out.write(value.encode() if empty else mark + value.encode())
                    empty = False
        if out:
            close()
        yield pa.RecordBatch.from_pydict({"runs": [runs]})

    rows = df.where(F.col(run).isNotNull()).repartition(n, run).sortWithinPartitions(run, *order)
    rows.select(F.col(run).cast("string"), F.col(column).cast("string")).mapInArrow(write, "runs long").write.format("noop").mode("overwrite").save()


def write_back(df: DataFrame, path: str, after: int | None = None) -> int:
    """Overwrite a table that df may have been read from, as a new version of it; returns the version's number.

    commits.read_table reads the last version; the files from before the first
    write-back stay where they are, as its backup (version 0). `after` is the
    version df was read from: if another came meanwhile, this one fails.
    """
    return publish(df, path, after)


def manifest_counts(items: DataFrame) -> DataFrame:
    return items.agg(
        F.count("*").alias("total"), F.count_if(F.size("errors") == 0).alias("ready"), F.count_if(F.size("errors") > 0).alias("with_errors"), F.count_if(F.size("warnings") > 0).alias("with_warnings")
    )
