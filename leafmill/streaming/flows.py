"""Structured Streaming: windows with watermarks, deduplication, usage and stateful admission.

The window functions take batch tables too, which is how their queries run.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.budget import Limiter
from ..sources.readers import holds_rows


def _late(df: DataFrame, ts: str, delay: str) -> DataFrame:
    return df.withWatermark(ts, delay) if df.isStreaming else df


def windowed(df: DataFrame, ts: str, keys, length: str, slide: str | None = None, delay: str = "10 minutes", value: str = "value") -> DataFrame:
    """(window_start, keys, n, total): tumbling windows, or sliding with a slide; rows later than delay go."""
    w = F.window(ts, length, slide) if slide else F.window(ts, length)
    out = _late(df, ts, delay).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), *keys, "n", "total")


def sessions(df: DataFrame, ts: str, keys, gap: str, delay: str = "10 minutes") -> DataFrame:
    """(keys, session_start, session_end, n): events of a key closer than gap."""
    out = _late(df, ts, delay).groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count("*").alias("n"))
    return out.select(*keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def deduplicated(df: DataFrame, keys, ts: str, delay: str = "10 minutes") -> DataFrame:
    """First row of each key; in a stream the keys of the last `delay` are remembered."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys)) if df.isStreaming else df.dropDuplicates(list(keys))


def usage(df: DataFrame, bucket: str = "bucket", ts: str = "ts", tokens: str = "tokens") -> DataFrame:
    """Tokens of each bucket in sliding minutes."""
    return windowed(df, ts, [bucket], "60 seconds", "10 seconds", "60 seconds", tokens)


def admitted(df: DataFrame, limit: int, bucket: str = "bucket", ts: str = "ts", tokens: str = "tokens", ident: str = "ident", shared: bool = False) -> DataFrame:
    """A stream of requests to (bucket, ident, arrived, admitted, waited, reserved); state: a bucket's clock and reservations."""
    rows = df.select(F.col(bucket).cast("string").alias("bucket"), F.col(ident).cast("long").alias("ident"), (F.unix_micros(F.col(ts)) / 1e6).alias("arrived"), F.col(tokens).cast("long").alias("tokens"))

    def step(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        clock, times, sizes = state.get if state.exists else (0.0, [], [])
        gate = Limiter(limit, shared, zip(times, sizes, strict=True))
        out = []
        for i, t, n in pd.concat(batches).sort_values(["arrived", "ident"])[["ident", "arrived", "tokens"]].itertuples(index=False):
            clock, _, got = gate.acquire(max(clock, t), n)
            out.append((key[0], i, t, clock, round(clock - t, 6), got))
        state.update((clock, [t for t, _ in gate.held], [n for _, n in gate.held]))
        yield pd.DataFrame(out, columns=["bucket", "ident", "arrived", "admitted", "waited", "reserved"])

    return rows.groupBy("bucket").applyInPandasWithState(
        step, "bucket string, ident long, arrived double, admitted double, waited double, reserved long", "clock double, times array<double>, sizes array<long>", "append", "NoTimeout"
    )


def exactly_once(df: DataFrame, path: str, key: str):
    """A foreachBatch writer that appends only keys the table at path has not."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates([key])
        if holds_rows(spark, path):
            new = new.join(spark.read.parquet(path).select(key), key, "left_anti")
        new.write.mode("append").parquet(path)

    return df.writeStream.foreachBatch(write)


def bucketed_time(ts: Column, seconds: int) -> Column:
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / seconds) * seconds)
