"""Filter interaction audit: what each filter removes in every order of application, by matrix product.

Each document gets a mask with a bit for each filter that it fails. Counts of
masks, and of masks of good and toxic documents, are one histogram row each
for a part. Whether a mask is kept, removed, or was removed earlier at a step
of an order does not depend on data: these incidences are integer matrices
with a row a mask and a column an (order, step), 32 by 600 for five filters.
Stacked histogram rows times these matrices give every count at once, so the
120 orders cost nothing a document.

Masks and digests are one pass of built-in functions over the texts. The
duplicate filter takes the smallest id of each text digest (SHA-256), combined
on the map side, and marks firsts by an equi-join on digest and id together,
so a text that a third of all documents share is one row there. A part has at most as
many histogram rows as there are masks, whatever its documents; parts are
multiplied in batches of PARTS_AT_ONCE, so memory does not follow their number.

Defined results: a null text counts as empty; a null part as the empty string,
one part with it; rows that share an id are counted each; a null id is larger
than every id, so of equal texts with null ids only, none fails the duplicate
filter; rows of one text that share the smallest id do not fail it either; a
document is good or toxic if any label row of its id says 1; labels of null
ids count for nothing; a very long text is read whole; an empty table gives no
rows; columns besides id, text, part and labels are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kit

WORD = r"[^\x20\x09-\x0D]+"
#: Filters of a text and its words, by letter: true where the text fails.
TEXT_FILTERS: Mapping[str, Callable[[Column, Column], Column]] = {
    "A": lambda text, words: F.size(words) < 50,
    "B": lambda text, words: 100 * F.size(F.array_distinct(words)).cast("long") < 65 * F.size(words).cast("long"),
    "C": lambda text, words: 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 5 * F.length(text).cast("long"),
    "D": lambda text, words: text.rlike("[#$%&*|]"),
}
#: The letter of the duplicate filter.
DUPLICATE = "E"
PARTS_AT_ONCE = 32
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def incidence(filters: int) -> tuple[list[tuple[int, ...]], dict[str, np.ndarray]]:
    """The orders, and a matrix of masks by (order, step) for each outcome of a mask at a step.

    Kept: it fails nothing so far. Removed: the step's filter is the first that
    it fails. Redundant: it fails this filter and an earlier one. Unique: it
    fails this filter alone. Shapley: what the step's filter removes, over all
    orders and steps together.
    """
    orders = list(permutations(range(filters)))
    mask = np.arange(1 << filters)[:, None]
    own = np.array([1 << f for order in orders for f in order])
    before = np.array([sum(1 << f for f in order[:step]) for order in orders for step in range(filters)])
    fails, gone = (mask & own) > 0, (mask & before) > 0
    out = {"kept": ~fails & ~gone, "removed": fails & ~gone, "redundant": fails & gone, "unique_fails": mask == own}
    out = {k: v.astype(np.int64) for k, v in out.items()}
    out["shapley"] = np.stack([out["removed"][:, own == x].sum(1) for x in own], axis=1)
    return orders, out


def filter_masks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", filters=TEXT_FILTERS, duplicate: str | None = DUPLICATE
) -> DataFrame:
    """doc_id, part, mask: a bit for each filter, in the order of the letters, that the document fails."""
    letters = sorted([*filters, *([duplicate] if duplicate else [])])
    text, words = F.col("f_text"), F.col("f_words")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("f_text"))
    slim = slim.withColumn("f_words", F.regexp_extract_all("f_text", F.lit(WORD), F.lit(0)))
    bits = [F.when(fails(text, words), F.lit(1 << letters.index(x))).otherwise(F.lit(0)) for x, fails in filters.items()]
    mask = sum(bits, F.lit(0))
    if not duplicate:
        return slim.select("doc_id", "part", mask.alias("mask"))
    rows = kit.save(slim.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest")), "masks")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id")).withColumnRenamed("digest", "first_digest")
    on = (F.col("digest") == F.col("first_digest")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    again = F.when(F.col("first_digest").isNull(), F.lit(1 << letters.index(duplicate))).otherwise(F.lit(0))
    return rows.join(first, on, "left").select("doc_id", "part", (F.col("mask") + again).alias("mask"))


def histograms(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id", good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """part, mask, n, good, toxic: documents of each mask in each part."""
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False))).cast("int")
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("l_id")).agg(one(good_col).alias("good"), one(toxic_col).alias("toxic"))
    known = masks.where("doc_id IS NOT NULL").join(marks, F.col("doc_id") == F.col("l_id"), "left").select("part", "mask", "good", "toxic")
    known = known.unionAll(masks.where("doc_id IS NULL").select("part", "mask", F.lit(None).cast("int"), F.lit(None).cast("int")))
    total = lambda c: F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c)
    return known.groupBy("part", "mask").agg(F.count("*").alias("n"), total("good"), total("toxic"))


def outcomes(counts: DataFrame, letters: str) -> DataFrame:
    """part, filter_order, step and COUNTS from histograms: stacked rows times the incidence matrices."""
    size = len(letters)
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)

    def multiply(batches):
        orders, made = incidence(size)
        names = pa.array(["".join(letters[f] for f in order) for order in orders for _ in order])
        steps = np.tile(np.arange(1, size + 1, dtype=np.int32), len(orders))
        for batch in batches:
            for at in range(0, batch.num_rows, PARTS_AT_ONCE):
                part = batch.column("part").slice(at, PARTS_AT_ONCE)
                cells = batch.column("cells").slice(at, PARTS_AT_ONCE)
                flat, row = cells.flatten(), np.repeat(np.arange(len(part)), cells.value_lengths().to_numpy())
                # Rows by documents, good and toxic ones; columns by mask.
                stack = np.zeros((3, len(part), 1 << size), np.int64)
                for k, c in enumerate(("n", "good", "toxic")):
                    np.add.at(stack[k], (row, flat.field("mask").to_numpy()), flat.field(c).to_numpy())
                all_, lost = stack[0], stack @ made["removed"]
                out = {c: all_ @ made[c] for c in ("kept", "redundant", "unique_fails", "shapley")} | {"removed": lost[0], "good_lost": lost[1], "toxic_lost": lost[2]}
                n = len(steps)
                yield pa.RecordBatch.from_arrays(
                    [part.take(pa.array(np.repeat(np.arange(len(part)), n))), names.take(pa.array(np.tile(np.arange(n), len(part)))), pa.array(np.tile(steps, len(part))), *(pa.array(out[c].ravel()) for c in COUNTS)],
                    ["part", "filter_order", "step", *COUNTS],
                )

    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return cells.mapInArrow(kit.lean(multiply), schema)


def audit_filters(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
    good_col: str = "quality", toxic_col: str = "toxic", filters=TEXT_FILTERS, duplicate: str | None = DUPLICATE,
) -> DataFrame:
    """For each part, order of the filters and step: what is kept, removed, redundant, unique and lost there."""
    letters = "".join(sorted([*filters, *([duplicate] if duplicate else [])]))
    masks = filter_masks(docs, id_col, text_col, part_col, filters, duplicate)
    return outcomes(histograms(masks, labels, id_col, good_col, toxic_col), letters)


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (
  SELECT t.doc_id, part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
         list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: CASE x
           WHEN 'A' THEN len(w) < 50
           WHEN 'B' THEN 100 * len(list_distinct(w)) < 65 * len(w)
           WHEN 'C' THEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text)
           WHEN 'D' THEN regexp_matches(text, '[#$%&*|]')
           ELSE t.doc_id > first_id END) AS fails
  FROM (SELECT *, min(doc_id) OVER (PARTITION BY text) AS first_id FROM t) t LEFT JOIN labels USING (doc_id)),
h AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS f, string_split(substr(filter_order, 1, step - 1), '') AS earlier FROM o, range(1, 6) r(step)),
c AS (
  SELECT part, filter_order, s.step::INT AS step, f,
         sum(n) FILTER (NOT list_contains(fails, f) AND NOT list_has_any(fails, earlier)) AS kept,
         sum(n) FILTER (list_contains(fails, f) AND NOT list_has_any(fails, earlier)) AS removed,
         sum(n) FILTER (list_contains(fails, f) AND list_has_any(fails, earlier)) AS redundant,
         sum(n) FILTER (fails = [f]) AS unique_fails,
         sum(good) FILTER (list_contains(fails, f) AND NOT list_has_any(fails, earlier)) AS good_lost,
         sum(toxic) FILTER (list_contains(fails, f) AND NOT list_has_any(fails, earlier)) AS toxic_lost
  FROM h, s GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
FROM c
"""
