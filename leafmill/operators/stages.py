"""Stages that run again only where their input changed.

A stage is a function of the rows of some runs to rows of the same runs. What
it made is kept by run, with a fingerprint of the rows it was made from. On the
next call a run whose fingerprint and stage version are known is not read: its
partitions are pruned. Output and manifest are folders that count only once a
commit names them, so a failure leaves the stage as it was before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..sources import commits

#: As many changed runs are named in a filter, which prunes partitions while planning; more are joined.
NAMED_RUNS = 1000


def fingerprints(df: DataFrame, run: str = "run_id") -> DataFrame:
    """(run, fingerprint): of the rows of each run, in any order, repeated rows counted; combined on the map side."""
    rest = [F.to_json(c) if df.schema[c].dataType.typeName() == "map" else F.col(c) for c in df.columns if c != run]
    one, two = F.xxhash64(*rest, F.lit(1)), F.xxhash64(F.lit(2), *rest)
    made = F.concat_ws(":", F.count("*"), F.hex(F.bit_xor(one)), F.sum(two.cast("decimal(20,0)")))
    return df.groupBy(run).agg(made.alias("fingerprint"))


def manifest(df: DataFrame, path: str, run: str = "run_id") -> DataFrame | None:
    """(run, fingerprint, version, part) as last committed, a row a run; None before any commit. df lends session and type of run."""
    spark = df.sparkSession
    past = commits.history(spark, path)
    if not past:
        return None
    schema = StructType([df.schema[run], *(StructField(c, StringType()) for c in ("fingerprint", "version", "part"))])
    order = F.create_map(*(x for n, e in past.items() for x in (F.lit(e["part"]), F.lit(n))))
    rows = spark.read.schema(schema).parquet(*(f"{path}/manifests/{e['part']}" for e in past.values()))
    last = rows.groupBy(run).agg(F.max_by(F.struct("fingerprint", "version", "part"), order[F.col("part")]).alias("m"))
    return last.select(run, "m.*")


def only_runs(df: DataFrame, runs: DataFrame, run: str = "run_id") -> DataFrame:
    """Rows of the given runs (distinct): by a filter that prunes partitions while they are few, else by a join."""
    few = [r[0] for r in runs.select(run).limit(NAMED_RUNS + 1).collect()]
    if len(few) <= NAMED_RUNS:
        named = F.col(run).isin([r for r in few if r is not None])
        return df.where(named | F.col(run).isNull() if None in few else named)
    other = runs.select(F.col(run).alias("_run"))
    return df.join(other, df[run].eqNullSafe(other["_run"]), "left_semi")


def run_stage(inputs: DataFrame, path: str, stage: Callable[[DataFrame], DataFrame], run: str = "run_id", version: str = "1", wanted: DataFrame | None = None) -> DataFrame:
    """The stage's rows for all runs of inputs; computed for new and changed runs, read for the others.

    `wanted` (run, fingerprint) saves reading the inputs to tell what changed,
    where the stage before has its own manifest. Runs that inputs no longer
    have are left out; another `version` computes every run again.
    """
    spark = inputs.sparkSession
    wanted = (fingerprints(inputs, run) if wanted is None else wanted.select(run, "fingerprint")).distinct()
    base, known, part = commits.version(spark, path), manifest(inputs, path, run), uuid.uuid4().hex
    todo = wanted
    if known is not None:
        same = known.where(F.col("version") == version).select(F.col(run).alias("_run"), F.col("fingerprint").alias("_print"))
        todo = wanted.join(same, _same(wanted[run], same["_run"]) & (wanted["fingerprint"] == same["_print"]), "left_anti")
    # Written before it is used, so what is read, computed and committed is one set of runs.
    todo.withColumns({"version": F.lit(version), "part": F.lit(part)}).write.parquet(f"{path}/manifests/{part}")
    todo = spark.read.schema(StructType([wanted.schema[run], wanted.schema["fingerprint"]])).parquet(f"{path}/manifests/{part}")
    if todo.limit(1).count() or known is None:
        out = stage(only_runs(inputs, todo, run))
        out.withColumn("_run", F.col(run).cast("string")).write.partitionBy("_run").parquet(f"{path}/parts/_part={part}")
        commits.commit(spark, path, {"part": part, "schema": out.schema.json()}, base)
    return read_stage(inputs, path, run, wanted)


def read_stage(inputs: DataFrame, path: str, run: str = "run_id", wanted: DataFrame | None = None) -> DataFrame:
    """What the stage at path last made of each run; of the wanted runs only, where they are given."""
    spark = inputs.sparkSession
    past, current = commits.history(spark, path), manifest(inputs, path, run)
    if current is None:
        raise ValueError(f"no stage was committed at {path}")
    if wanted is not None:
        other = wanted.select(F.col(run).alias("_wanted"))
        current = current.join(other, _same(current[run], other["_wanted"]), "left_semi")
    schema = StructType.fromJson(json.loads(past[max(past)]["schema"]))
    whole = StructType([*schema, StructField("_part", StringType()), StructField("_run", StringType())])
    data = spark.read.schema(whole).option("basePath", f"{path}/parts").parquet(*(f"{path}/parts/_part={e['part']}" for e in past.values()))
    at = current.select(F.col(run).cast("string").alias("_at"), F.col("part").alias("_of"))
    return data.join(at, _same(data["_run"], at["_at"]) & (data["_part"] == at["_of"]), "left_semi").drop("_part", "_run")


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)
