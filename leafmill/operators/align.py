"""Joins by position and by key: ranges, nearest intervals, question and answer alignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import geometry as G
from ..functions import text as T
from ..llm.kit import small
from .nearest import nearest_groups
from .tables import last_wins


def range_join(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, width: float, keys: Sequence[str] = ()) -> DataFrame:
    """Points inside closed ranges, as an equi-join on buckets of `width`.

    A range takes part in each bucket it touches, a point in its own, so no
    pair is tested outside a shared bucket and a row meets a range once.
    """
    p = points.withColumn("_bucket", F.floor(F.col(point) / width))
    r = ranges.where(F.col(high) >= F.col(low)).withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    return p.join(r, ["_bucket", *keys]).where(F.col(point).between(F.col(low), F.col(high))).drop("_bucket")


def labels_in_ranges(ranges: DataFrame, blocks: DataFrame, run: str = "run_id", shared_start: bool = False) -> DataFrame:
    """(run, question_no, labels): the labels from start_label to end_label, in order, with the visual labels.

    shared_start puts the block before in front where its text has this
    question's mark. Unknown ends and reversed ranges give no label.
    """
    order = Window.partitionBy(run).orderBy("ordinal")
    b = blocks.select(run, "label", "ordinal", F.lag("label").over(order).alias("_before"), F.lag("text").over(order).alias("_text"))
    start = b.select(run, F.col("label").alias("start_label"), F.col("ordinal").alias("_s"), "_before", "_text")
    end = b.select(run, F.col("label").alias("end_label"), F.col("ordinal").alias("_e"))
    ends = ranges.join(start, [run, "start_label"], "left").join(end, [run, "end_label"], "left")
    inside = range_join(b.select(run, "ordinal", F.col("label").alias("_label")), ends.select(run, "question_no", "_s", "_e").where("_s is not null and _e is not null"), "ordinal", "_s", "_e", 64, [run])
    listed = inside.groupBy(run, "question_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "_label"))), lambda x: x["_label"]).alias("_inside"))
    out = ends.join(listed, [run, "question_no"], "left")
    labels = F.coalesce("_inside", F.array().cast("array<string>"))
    if shared_start:
        lead = F.when((F.size(labels) > 0) & F.col("_before").isNotNull() & T.has_marker(F.coalesce("_text", F.lit("")), F.col("question_no")), F.array("_before"))
        labels = F.concat(F.coalesce(lead, F.array().cast("array<string>")), labels)
    return out.select(run, "question_no", A.union_labels(labels, F.coalesce("visual_labels", F.array().cast("array<string>"))).alias("labels"))


def surface(labels: Column) -> Column:
    """Of (label, is_marker) entries the labels before the first solution marker, which never is the first."""
    return F.transform(A.take_until(labels, lambda x: x["is_marker"]), lambda x: x["label"])


def nearest_intervals(points: DataFrame, intervals: DataFrame, keys: Sequence[str], point: str, low: str, high: str, ident: str, k: int = 6) -> DataFrame:
    """Points with the k nearest intervals of their keys: distance 0 inside, else to the nearer end; ranked by distance and ident.

    ident names an interval within its keys; points of one value are looked up once.
    """
    values = points.select(*keys, F.col(point).alias("_point")).distinct()
    near = nearest_groups(values.withColumn("_at", F.col("_point")), intervals, keys, "_at", ("_point", "_point"), ident, (low, high), k)
    near = near.withColumnRenamed("_at", point)
    return points.join(near, [*keys, point]).join(intervals, [*keys, ident])


def align(questions: DataFrame, answers: DataFrame, run: str = "run_id") -> DataFrame:
    """Questions with their answers' labels: (run, question_no, question_labels, answer_labels, answer_status); the last valid answer range wins."""
    a = last_wins(answers.where("valid"), [run, "question_no"], ["ordinal"]).select(run, "question_no", F.col("labels").alias("answer_labels"))
    labels = F.coalesce("answer_labels", F.array().cast("array<string>"))
    q = questions.select(run, "question_no", F.col("labels").alias("question_labels")).join(a, [run, "question_no"], "left")
    return q.select(run, "question_no", "question_labels", labels.alias("answer_labels"), F.when(F.size(labels) > 0, "found").otherwise("missing").alias("answer_status"))


def align_mixed(questions: DataFrame, answers: DataFrame, blocks: DataFrame, run: str = "run_id") -> DataFrame:
    """Mixed papers: answer labels are question labels of the same paper; only known ones stay."""
    known = blocks.select(run, "label")
    moved = answers.where("valid").select(run, "question_no", "valid", "ordinal", F.posexplode("labels").alias("_i", "label")).withColumn("label", T.relabel(F.col("label"), "Q"))
    kept = moved.join(known, [run, "label"], "left_semi").groupBy(run, "question_no", "valid", "ordinal")
    return align(questions, kept.agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "label"))), lambda x: x["label"]).alias("labels")), run)


def missing(questions: DataFrame, answers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of questions without an answer."""
    return questions.select(*keys).distinct().join(answers.select(*keys), list(keys), "left_anti")


def first_found(candidates: DataFrame, listing: DataFrame, keys: Sequence[str], path: str = "path", pos: str = "pos") -> DataFrame:
    """The first candidate path that exists, else the first candidate."""
    have = listing.select(F.col(path).alias("_path")).distinct()
    j = candidates.join(have, candidates[path] == have["_path"], "left")
    best = F.min(F.struct(F.col("_path").isNull().alias("absent"), pos, path))
    return j.groupBy(*keys).agg(best.alias("b")).select(*keys, F.col(f"b.{path}").alias(path), (~F.col("b.absent")).alias("found"))


def candidate_sets(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """(key, candidates): sorted distinct values of both sources."""
    both = a.select(key, value).unionByName(b.select(key, value)).where(F.col(value).isNotNull()).distinct()
    return both.groupBy(key).agg(F.array_sort(F.collect_list(value)).alias("candidates"))


RANGES = "struct<question_ranges:array<struct<question_no:string,start_label:string,end_label:string,visual_labels:array<string>,confidence:string,reason:string>>,noise_blocks:array<string>,risks:array<string>>"


def parse_ranges(responses: DataFrame, blocks: DataFrame, run: str = "run_id", column: str = "response") -> DataFrame:
    """Question ranges of model responses: (run, question_no, start_label, end_label, visual_labels, confidence, reason, valid, ordinal).

    Numbers that are none go; visual labels are kept where they are known;
    a range is valid when both its ends are; order is by start page and label.
    """
    raw = responses.select(run, F.posexplode(F.from_json(column, RANGES)["question_ranges"]).alias("_i", "x")).select(run, "_i", "x.*")
    raw = raw.withColumn("question_no", F.col("question_no").try_cast("int")).where("question_no is not null")
    known = blocks.select(run, "label").distinct()
    seen = raw.select(run, "_i", F.posexplode("visual_labels").alias("_j", "label")).join(known, [run, "label"], "left_semi").groupBy(run, "_i")
    seen = seen.agg(F.transform(F.array_sort(F.collect_list(F.struct("_j", "label"))), lambda x: x["label"]).alias("_seen"))
    out = raw.join(seen, [run, "_i"], "left")
    for end in ("start_label", "end_label"):
        k = known.select(run, F.col("label").alias(end), F.lit(True).alias(f"_{end}"))
        out = out.join(k, [run, end], "left")
    page = F.regexp_extract("start_label", r"-V(\d+)", 1).try_cast("int")
    return out.select(
        run, "question_no", "start_label", "end_label", F.coalesce("_seen", F.array().cast("array<string>")).alias("visual_labels"), G.confidence(F.col("confidence")).alias("confidence"), "reason",
        (F.col("_start_label").isNotNull() & F.col("_end_label").isNotNull()).alias("valid"), (F.row_number().over(Window.partitionBy(run).orderBy(page.asc_nulls_last(), "start_label", "_i")) - 1).alias("ordinal"),
    )


def label_forms(rows: DataFrame, key: str = "label") -> DataFrame:
    """Rows once under their label, its question form and its answer form, so that either side finds them."""
    forms = F.array_distinct(F.array(F.col(key), T.relabel(F.col(key), "Q"), T.relabel(F.col(key), "A")))
    return rows.withColumn("form", F.explode(forms))


def require(rows: DataFrame, found: str, keys: Sequence[str], what: str) -> DataFrame:
    """Rows as they are; a row whose `found` is null or empty is an error when the rows are read."""
    none = F.col(found).isNull()
    if rows.schema[found].dataType.typeName() == "array":
        none = none | (F.size(found) == 0)
    name = F.concat_ws(" ", F.lit(f"no {what} for"), *(F.col(k).cast("string") for k in keys))
    return rows.withColumn(found, F.when(none, F.raise_error(name).cast(rows.schema[found].dataType)).otherwise(F.col(found)))


def groups_of_stream(groups: DataFrame, answers: DataFrame, stream: str, run: str = "run_id") -> DataFrame:
    """(run, question_no, labels) of a stream: the question's own labels, or for answers the distinct labels of its answer rows in order."""
    if stream != "answer":
        return groups.select(run, "question_no", "labels")
    named = answers.select(run, "question_no", "ordinal", F.posexplode("labels").alias("_i", "label")).groupBy(run, "question_no")
    listed = F.array_sort(F.collect_list(F.struct("ordinal", "_i", "label")))
    return named.agg(A.ordered_distinct(F.transform(listed, lambda x: x["label"])).alias("labels"))


def nearest_questions(assets: DataFrame, blocks: DataFrame, span: tuple[str, str] = ("top", "bottom"), run: str = "run_id", k: int = 6) -> DataFrame:
    """(run, asset, question_no, distance, rank): for each asset the k nearest questions by their nearest block in reading order.

    Spans are places in the run's reading coordinate (page offsets and y).
    """
    return nearest_groups(assets, blocks, [run], "asset", span, "question_no", span, k)


def key_pairs(left: DataFrame, right: DataFrame, key: str, block: int = 1024) -> DataFrame:
    """Every row of left beside every row of right with its key: the columns of right, then those of left.

    The result grows with the product, so a key must not be one task's: both sides are held in arrays, of left about `block` rows and of
    right a few (equal rows stay in one array), and right's are dealt over all shuffle partitions. Left's are broadcast where they are
    few, so that only right is shuffled; else each partition gets a copy. A pair of arrays is walked at a time, each in the order of its
    columns: values come again soon, and the result takes less room where it is kept. Names must differ but for the key.
    """
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))

    def held(rows: DataFrame, size: int, least: int, name: str) -> DataFrame:
        names = [c for c in rows.columns if c != key]
        most = rows.groupBy(key).count().agg(F.max("count")).first()[0] or 0
        blocks = F.lit(max(least, -(-most // max(1, size))))
        dealt = rows.withColumn("_block", F.pmod(F.xxhash64(*names), blocks).cast("int")).repartition(n, key, "_block")
        return dealt.groupBy(key, "_block").agg(F.array_sort(F.collect_list(F.struct(*names))).alias(name))

    own, others = held(left, block, 1, "_rows").select(key, "_rows"), held(right, block // 256, n, "_others")
    near = small(own)
    if near is own:
        copies = own.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).repartition(n, key, "_part")
        others = others.withColumn("_part", F.pmod("_block", F.lit(n))).repartition(n, key, "_part")
        joined = others.join(copies.hint("shuffle_hash"), [key, "_part"])
    else:
        joined = others.join(near, key)
    return joined.select(key, "_rows", F.inline("_others")).select(*right.columns, F.inline("_rows"))
