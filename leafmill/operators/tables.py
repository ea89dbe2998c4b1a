"""Keyed-table operators: explicit first and last wins, merges, change capture, checks, assignment."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """A row a key, the first by order; partial aggregation keeps hot keys small before the shuffle."""
    return _extreme(df, keys, order, F.min_by)


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """A row a key, the last by order."""
    return _extreme(df, keys, order, F.max_by)


def _extreme(df: DataFrame, keys, order, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    rank = F.struct(*order)
    return df.groupBy(*keys).agg(pick(F.struct(*rest), rank).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each key with their 1-based rank; Spark prunes each task's rows to k before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def merge_where(base: DataFrame, fixed: DataFrame, key: str, fields: Sequence[str], accepted: Column) -> DataFrame:
    """base with the fields of accepted rows of fixed (unique by key); a column `merged` says which."""
    side = fixed.where(accepted).select(F.col(key).alias("_key"), *(F.col(f).alias(f"_{f}") for f in fields))
    joined = base.join(side, base[key] == side["_key"], "left")
    hit = F.col("_key").isNotNull()
    keep = [F.when(hit, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in base.columns]
    return joined.select(*keep, hit.alias("merged"))


def changed_fields(old: DataFrame, new: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Keys of old with the names of the fields that differ in new, null-safe; keys missing in new change nothing."""
    side = new.select(F.col(key).alias("_key"), *(F.col(f).alias(f"_{f}") for f in fields))
    diffs = F.array_compact(F.array(*(F.when(~F.col(f).eqNullSafe(F.col(f"_{f}")), F.lit(f)) for f in fields)))
    both = old.join(side, old[key] == side["_key"], "left")
    return both.select(key, F.when(F.col("_key").isNotNull(), diffs).otherwise(F.array().cast("array<string>")).alias("changed"))


def union_complete(parts: Sequence[DataFrame], expected: DataFrame, key: str) -> DataFrame:
    """A row a key that is not exactly once among the parts and once expected: key, found, wanted, problem."""
    found = None
    for p in parts:
        p = p.select(key)
        found = p if found is None else found.unionByName(p)
    a = found.groupBy(key).agg(F.count("*").alias("found"))
    b = expected.groupBy(key).agg(F.count("*").alias("wanted"))
    both = a.join(b, key, "full").na.fill(0, ["found", "wanted"])
    problem = F.when(F.col("found") > F.col("wanted"), F.when(F.col("wanted") == 0, "unexpected").otherwise("duplicate")).when(F.col("found") < F.col("wanted"), "missing")
    return both.withColumn("problem", problem).where("problem is not null")


def same_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of either side that the other lacks, copies counted; empty if equal."""
    x, y = a.select(key), b.select(key)
    return x.exceptAll(y).withColumn("side", F.lit("left")).unionByName(y.exceptAll(x).withColumn("side", F.lit("right")))


def reject_reasons(status: Column, findings: Column, unchanged: Column) -> Column:
    """Why a fix is not accepted; empty if it is."""
    return F.array_compact(
        F.array(
            F.when(~F.coalesce(F.startswith(status, F.lit("fixed")), F.lit(False)), F.lit("not_fixed")),
            F.when(F.coalesce(findings, F.lit(1)) != 0, F.lit("findings_left")),
            F.when(~F.coalesce(unchanged, F.lit(False)), F.lit("content_changed")),
        )
    )


def group_counts(df: DataFrame, columns: Sequence[str], value: str = "value") -> DataFrame:
    """Counts by each column on its own, unpivoted to (field, value, n): a row a column before the map-side sums, one shuffle."""
    names = df.select(*(F.col(c).cast("string").alias(c) for c in columns))
    long = names.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias(value)) for c in columns))).alias("e")).select("e.*")
    return long.groupBy("field", value).agg(F.count("*").alias("n"))


def dense_counts(df: DataFrame, keys: Sequence[str], column: str, categories: Sequence[str], other: str | None = None) -> DataFrame:
    """A column of counts a category, zeros included."""
    counts = [F.count_if(F.col(column) == c).alias(c) for c in categories]
    if other:
        counts.append(F.count_if(~F.coalesce(F.col(column).isin(*categories), F.lit(False))).alias(other))
    return df.groupBy(*keys).agg(*counts)


def unpivot(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(keys, field, index, value), index 1-based in the order of fields; null values go."""
    cells = F.array(*(F.struct(F.lit(f).alias("field"), F.lit(i).alias("index"), F.col(f).cast("string").alias("value")) for i, f in enumerate(fields, 1)))
    return df.select(*keys, F.inline(cells)).where("value is not null")


def round_robin(df: DataFrame, order: Sequence[Column], bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """bin = position mod bins, positions by order within keys."""
    return df.withColumn("bin", F.pmod(F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1, F.lit(bins)))


def distribute(total: Column, bins: int) -> Column:
    """Workers a bin: the total shared evenly, at least one each, the first bins taking what is over."""
    base, over = F.greatest(F.lit(1), F.floor(total / bins)).cast("int"), F.when(total >= bins, total % bins).otherwise(0)
    return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: base + F.when(i < over, 1).otherwise(0))


def longest_first(df: DataFrame, keys: Sequence[str], item: str, weight: str, bins: int) -> DataFrame:
    """(keys, item, weight, bin): heaviest item first to the least loaded bin, ties by items held, then by bin.

    Each choice needs the loads so far, so a group is folded in order by one
    task; a group is one run's work list.
    """
    import heapq

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([weight, item], ascending=[False, True], kind="stable")
        heap = [(0, 0, b) for b in range(bins)]
        chosen = []
        for w in pdf[weight].tolist():
            load, n, b = heapq.heappop(heap)
            chosen.append(b)
            heapq.heappush(heap, (load + w, n + 1, b))
        return pdf.assign(bin=chosen)

    part = df.select(*keys, item, weight)
    return part.groupBy(*keys).applyInPandas(fold, types.StructType([*part.schema.fields, types.StructField("bin", types.IntegerType())]))


def pending(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Work whose result is not stored yet."""
    return work.join(done.select(key).distinct(), key, "left_anti")


def select_known(df: DataFrame, key: str, wanted: Sequence[str]) -> DataFrame:
    """Rows of the wanted keys; a wanted key without a row is an error when the rows are read."""
    asked = df.sparkSession.createDataFrame([(w,) for w in wanted], f"_wanted {df.schema[key].dataType.simpleString()}")
    j = asked.join(df, asked["_wanted"] == df[key], "left")
    lost = F.raise_error(F.concat(F.lit("unknown key: "), F.col("_wanted").cast("string"))).cast(df.schema[key].dataType)
    return j.withColumn(key, F.when(F.col(key).isNull(), lost).otherwise(F.col(key))).drop("_wanted")
