"""Mixing sources to target weights, with DataFrame operations only.

Each document gets a hash-random key. Within a source the key's leading bits
name a block, so blocks are ranges of the key in order and equal in size, and
a hot source has as many blocks as it needs. Totals of blocks, and of runs of
RUN blocks, give each block's offset, so no window spans more than RUN blocks
or the runs of a source; a window over one block gives the rest of the prefix
sum. A source is cut where its prefix sum reaches its budget; what passes its
size goes on into the next epoch, at most `max_epochs` in all.

Targets: sources by code point, null last, weigh WEIGHTS in turn and share
`share` times all words; a target stops at max_epochs times its source and
what is over is shared again by weight (water-filling, in closed form).

Texts ride along with their rows, so the corpus is cut in the same pass and no
row is looked up again: repeated rows stay as many as they are, each with what
the mix takes of it, even where a budget cuts between them.

Defined results: a null or blank text has no words; null sources are one
source, null ids are an id like any other; rows that share an id are mixed each
by its own size, in an order that the text's hash settles (equal rows tie, and
it does not matter which of them a cut falls on); a very long text counts
whole; an empty table gives no rows; other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kit

#: Weights of the sources in turn, and the share of all words.
WEIGHTS, SHARE, MAX_EPOCHS = (3, 1, 2), 1.5, 2
WORD = r"[^\x20\x09-\x0D]+"
BLOCK_ROWS = 1_000
#: Blocks of a run.
RUN = 4_096


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, with_text: bool = False) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("key"),
        F.xxhash64(text_col).alias("tie"),
        *((F.col(text_col).alias("text"),) if with_text else ()),
    )


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target), a row a source."""
    # Rows here are sources, not documents: few, so their windows may stand unpartitioned.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    filled = Window.orderBy("fill", "rank").rowsBetween(Window.unboundedPreceding, -1)
    turn = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("rank", F.row_number().over(by_name))
    s = s.withColumn("weight", turn.cast("long")).withColumn("cap", F.col("source_size") * max_epochs)
    s = s.withColumn("fill", F.col("cap") / F.col("weight"))
    s = s.withColumn("cap_before", F.coalesce(F.sum("cap").over(filled), F.lit(0)))
    s = s.withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filled), F.lit(0)))
    total = F.sum("source_size").over(everything)
    s = s.withColumn("level", (total * F.lit(share) - F.col("cap_before")) / F.col("weight_left"))
    s = s.withColumn("open_level", F.min(F.when(F.col("fill") > F.col("level"), F.struct("fill", "level"))).over(everything)["level"])
    grown = F.coalesce(F.col("open_level") * F.col("weight"), F.col("cap").cast("double"))
    return s.select("source", "source_size", F.least(F.col("cap").cast("double"), grown).alias("target"))


def _mix(docs, id_col, text_col, source_col, weights, share, max_epochs, block_rows, with_text) -> DataFrame:
    sizes = kit.save(sized(docs, id_col, text_col, source_col), "sizes")
    blocks = max(1, sizes.count() // block_rows)
    lead = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    place = lambda df: df.withColumn("block", F.shiftright(lead * blocks, 32))
    aim = kit.save(targets(sizes, weights, share, max_epochs).withColumnRenamed("source", "a_source"), "targets")
    upto = lambda keys, by: Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c, keys, by: F.coalesce(F.sum(c).over(upto(keys, by)), F.lit(0))
    totals = place(sizes).groupBy("source", "block").agg(F.sum("size").alias("block_size")).withColumn("run", F.floor(F.col("block") / RUN))
    runs = totals.groupBy("source", "run").agg(F.sum("block_size").alias("run_size")).withColumn("run_start", before("run_size", ["source"], "run"))
    runs = runs.withColumnsRenamed({"source": "r_source", "run": "r_run"})
    starts = totals.withColumn("inner", before("block_size", ["source", "run"], "block"))
    starts = starts.join(runs, F.col("source").eqNullSafe(F.col("r_source")) & (F.col("run") == F.col("r_run")))
    starts = starts.select(F.col("source").alias("b_source"), F.col("block").alias("b_block"), (F.col("inner") + F.col("run_start")).alias("start"))
    plan = starts.join(aim, F.col("b_source").eqNullSafe(F.col("a_source")))
    # One name for source and block, null source too: window and join deal rows alike, so texts are shuffled once.
    named = lambda block, source: F.concat(F.col(block).cast("string"), F.lit("/"), F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")))
    plan = plan.select(named("b_block", "b_source").alias("at"), "start", "source_size", "target")
    rows = place(sized(docs, id_col, text_col, source_col, True) if with_text else sizes).withColumn("at", named("block", "source"))
    inside = Window.partitionBy("at").orderBy("key", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    out = local.join(plan, "at")
    left = F.floor("target").cast("long") - F.col("start") - F.col("local")
    taken = sum((F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("source_size") * e)) for e in range(max_epochs)), F.lit(0))
    return out.select("doc_id", "source", *(("text",) if with_text else ()), "size", "source_size", "target", taken.cast("long").alias("taken"))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """doc_id, size, source_size, target, taken: words the mix takes of each document, repeats counted."""
    return _mix(docs, id_col, text_col, source_col, weights, share, max_epochs, block_rows, False).drop("source")


def mixed_corpus(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The mix itself: source and text of every row that it takes, with size, source_size, target and taken."""
    return _mix(docs, id_col, text_col, source_col, weights, share, max_epochs, block_rows, True).where("taken > 0")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank
  FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][((rank - 1) % 3 + 1)::INT]::BIGINT AS weight, 2 * source_size AS cap FROM s),
f AS (
  SELECT *, cap::DOUBLE / weight AS fill FROM w),
l AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5
      - coalesce(sum(cap) OVER (ORDER BY fill, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY fill, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
  FROM f),
a AS (
  SELECT source, source_size,
         least(cap::DOUBLE, coalesce((SELECT arg_min(level, fill) FROM l WHERE fill > level) * weight, cap::DOUBLE)) AS target
  FROM l),
p AS (
  SELECT d.doc_id, d.size, a.source_size, a.target, floor(a.target)::BIGINT
      - coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS open
  FROM d JOIN a ON d.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, open)) + greatest(0, least(size, open - source_size)))::BIGINT AS taken
FROM p
"""
