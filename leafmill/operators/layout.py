"""Page layout: flattening, reading order, labels, packets, offsets, split lines, page roles."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types

from ..functions import geometry as G
from ..functions import text as T


def flatten_lines(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """(keys, pos, line): the non-blank lines of a text, pos their 0-based place among all lines."""
    return df.select(*keys, F.posexplode(F.split(F.coalesce(F.col(column), F.lit("")), "\n")).alias("pos", "line")).where(T.strip(F.col("line")) != "")


def flatten_packets(packets: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Blocks of packets (keys, page, blocks) with packet_page and packet_order; blocks without a label go."""
    rows = packets.select(*keys, F.col("page").alias("packet_page"), F.posexplode("blocks").alias("packet_order", "b"))
    return rows.select(*keys, "packet_page", "packet_order", "b.*").where(T.strip(F.coalesce("label", F.lit(""))) != "")


#: Lines that one Arrow batch of a walk holds.
LEAVES_AT_ONCE = 10_000
LEAF = "page int, path array<int>, type string, spans array<struct<type:string,content:string,html:string>>"


def _leaves(tree: str | None, skip: frozenset[str]) -> Iterator[tuple[int, list[int], str | None, list[dict]]]:
    """Page, path, block type and spans of each line, depth first; a tree that is no JSON array has none."""
    try:
        pages = json.loads(tree or "[]")
    except ValueError:
        return
    listed = lambda x, key: x[key] if isinstance(x, dict) and isinstance(x.get(key), list) else []
    as_text = lambda v: v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False)
    for page, p in enumerate(pages if isinstance(pages, list) else []):
        # A stack of its own, so the depth of a tree meets no limit of the language.
        todo = [([i], b) for i, b in enumerate(listed(p, "preproc_blocks"))][::-1]
        while todo:
            path, block = todo.pop()
            if not isinstance(block, dict) or block.get("type") in skip:
                continue
            for j, line in enumerate(listed(block, "lines")):
                yield page, [*path, j], as_text(block.get("type")), [{k: as_text(x.get(k)) for k in ("type", "content", "html")} for x in listed(line, "spans") if isinstance(x, dict)]
            todo += [([*path, k], c) for k, c in enumerate(listed(block, "blocks"))][::-1]


def flatten_tree(docs: DataFrame, keys: Sequence[str], tree: str = "tree", skip=("image_body", "chart_body"), prefix: str = "") -> DataFrame:
    """Leaf lines of a layout tree held as JSON: (keys, page, path, type, text), a row a line that has text.

    The tree is a JSON array of pages with preproc_blocks; a block has lines with
    spans, blocks of its own to any depth, or both. Paths in page order are the
    reading order. Recursion of unknown depth is what built-in functions
    cannot say, so one map pass walks each tree; memory is a tree's, and no row
    is shuffled. `prefix` goes before the four names where keys have them.
    """
    names = [prefix + c for c in ("page", "path", "type", "text")]
    if set(names) & set(keys):
        raise ValueError(f"keys {sorted(set(names) & set(keys))} clash with result columns; give a prefix")
    picked = docs.select(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), F.col(tree).cast("string").alias("tree"))
    fields = picked.drop("tree").schema
    held, hidden = types._parse_datatype_string(LEAF), frozenset(skip)
    arrow = pa.schema([("page", pa.int32()), ("path", pa.list_(pa.int32())), ("type", pa.string()), ("spans", pa.list_(pa.struct([(c, pa.string()) for c in ("type", "content", "html")])))])

    def walk(batches):
        for batch in batches:
            rows, of = [], []
            for i in range(batch.num_rows):
                for leaf in _leaves(batch.column("tree")[i].as_py(), hidden):
                    rows.append(dict(zip(arrow.names, leaf, strict=True)))
                    of.append(i)
                    if len(rows) == LEAVES_AT_ONCE:
                        yield _joined(batch, rows, of, arrow)
                        rows, of = [], []
            yield _joined(batch, rows, of, arrow)

    leaves = picked.mapInArrow(walk, types.StructType([*fields, *held]))
    words = F.array_join(F.transform("spans", lambda s: F.coalesce(T.span_content(s["type"], s["content"], s["html"]), F.lit(""))), " ")
    out = leaves.withColumn("words", T.collapse(words)).where("words <> ''")
    return out.select(*(F.col(f"k{i}").alias(k) for i, k in enumerate(keys)), *(F.col(c).alias(n) for c, n in zip(("page", "path", "type", "words"), names, strict=True)))


def _joined(batch: pa.RecordBatch, rows: list[dict], of: list[int], arrow: pa.Schema) -> pa.RecordBatch:
    """Leaves behind the key columns of the row each came from."""
    keys = [c for c in batch.schema.names if c != "tree"]
    leaves = pa.RecordBatch.from_pylist(rows, arrow)
    return pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(of, pa.int32())) for c in keys), *leaves.columns], [*keys, *arrow.names])


def reading_order(*candidates: Column) -> Column:
    """The first candidate that is a number."""
    return F.coalesce(*(c.cast("string").try_cast("double") for c in candidates))


def block_order(page: Column, order: Column, box: Column, block_id: Column) -> list[Column]:
    """Sort keys: page, those with an order first, by order, then top, left and id."""
    y, x = (F.coalesce(F.try_element_at(box, F.lit(i)), F.lit(0.0)) for i in (2, 1))
    return [page.asc(), order.isNull().asc(), order.asc(), y.asc(), x.asc(), block_id.asc()]


def label_order(page: Column, order: Column, label: Column) -> list[Column]:
    """Sort keys in which 0 counts as missing and goes to the end: so does the first block of a page."""
    big = F.lit(1_000_000)
    return [F.coalesce(F.nullif(page, F.lit(0)), big).asc(), F.coalesce(F.nullif(order, F.lit(0)), big).asc(), label.asc()]


def label_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[Column], figure: Column, name: Column) -> DataFrame:
    """label name-Pnn for figures and name-Bnn for others, each kind numbered in order within keys."""
    w = Window.partitionBy(*keys, "_fig").orderBy(*order)
    numbered = df.withColumn("_fig", F.coalesce(figure, F.lit(False))).withColumn("_n", F.row_number().over(w))
    return numbered.withColumn("label", F.concat(name, F.when(F.col("_fig"), "-P").otherwise("-B"), F.format_string("%02d", "_n"))).drop("_fig", "_n")


def ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "ordinal") -> DataFrame:
    """0-based position within keys."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def packets(blocks: DataFrame, keys: Sequence[str], order: str, limit: int = 260) -> DataFrame:
    """A packet a key: its blocks nested in order, texts excerpted, prefixes and options flagged."""
    flagged = blocks.withColumns(
        {"detected_question_prefix": T.question_number(F.col("text")), "looks_like_option": T.is_option(F.col("text")), "text": T.excerpt(F.col("text"), limit)}
    )
    rest = [c for c in flagged.columns if c not in keys and c != order]
    return flagged.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, *rest))).alias("blocks"))


def offsets(extents: DataFrame, keys: Sequence[str], order: Sequence[Column], extent: str, gap: float) -> DataFrame:
    """offset: the extents and gaps of all pages before, within keys."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return extents.withColumn("offset", F.coalesce(F.sum(F.col(extent) + gap).over(w), F.lit(0.0)))


def split_lines(df: DataFrame, keys: Sequence[str], line: str, weight: str, top: str, bottom: str, least: float = 32.0) -> DataFrame:
    """y1, y2 of each line: the block's height shared by weight where it has several lines and is higher than least."""
    every = Window.partitionBy(*keys)
    before = every.orderBy(line).rowsBetween(Window.unboundedPreceding, -1)
    total, done, n = F.sum(weight).over(every), F.coalesce(F.sum(weight).over(before), F.lit(0)), F.count("*").over(every)
    height = F.col(bottom) - F.col(top)
    shared = (n > 1) & (height > least)
    return df.withColumns(
        {
            "y1": F.when(shared, F.col(top) + height * done / total).otherwise(F.col(top)),
            "y2": F.when(shared, F.col(top) + height * (done + F.col(weight)) / total).otherwise(F.col(bottom)),
        }
    )


def page_roles(pages: DataFrame, doc: str = "run_id") -> DataFrame:
    """(doc, page, role, mode, first_answer_page) of pages (doc, page, text)."""
    w = Window.partitionBy(doc)
    sheet, remark = T.has_any(F.col("text"), T.ANSWER_SHEET_KEYWORDS), T.has_any(F.col("text"), T.COMMENTARY_KEYWORDS)
    answer = T.has_any(F.col("text"), T.ANSWER_KEYWORDS) & ~sheet
    d = pages.withColumn("first_answer_page", F.min(F.when(answer, F.col("page"))).over(w)).withColumn("_rank", F.dense_rank().over(w.orderBy("page")))
    d = d.withColumn("_first", F.min("page").over(w))
    early = F.col("_rank") <= 2
    heads = F.sum(F.when(early, F.regexp_count("text", F.lit(r"(?mU)^\s*\d{1,2}\s*[.．、]")))).over(w)
    marks = F.sum(F.when(early, T.occurrences(F.col("text"), T.INTERLEAVED_KEYWORDS))).over(w)
    mixed = (F.col("first_answer_page") == F.col("_first")) & (heads >= 2) & (marks >= 2)
    d = d.withColumn("_mixed", F.coalesce(mixed, F.lit(False)))
    role = F.when(sheet, "answer_sheet").when(remark, "commentary").when(F.col("_mixed"), "interleaved_solution")
    role = role.when(F.col("page") >= F.col("first_answer_page"), "answer").otherwise("question")
    d = d.withColumn("role", role)
    answers = F.sum(F.when(F.col("role") == "answer", 1).otherwise(0)).over(w)
    mode = F.when(F.col("_mixed"), "interleaved_solution").when(answers > 0, "paper_then_answers").otherwise("paper_only")
    return d.withColumn("mode", mode).select(doc, "page", "role", "mode", "first_answer_page")


def pipeline_mode(forced: Column, has_answers: Column, interleaved: Column) -> Column:
    chosen = F.when(has_answers, "paper_plus_answer_file").when(interleaved, "mixed").otherwise("pure_paper")
    return F.when((forced != "auto") & forced.isNotNull(), forced).otherwise(chosen)


def crop_boxes(labels: DataFrame, blocks: DataFrame, run: str = "run_id", margin: int = 8, width: int = 1000, height: int = 1000) -> DataFrame:
    """(run, question_no, stream, page, image, x1, y1, x2, y2): the box around a question's labels on each page; empty boxes go."""
    found = labels.join(blocks.select(run, "label", "stream", "page", "image", "bbox"), [run, "label"])
    box = G.union_box(*(F.col("bbox")[i] for i in range(4)), margin, width, height)
    return found.groupBy(run, "question_no", "stream", "page", "image").agg(box.alias("b")).where("b is not null").select(run, "question_no", "stream", "page", "image", "b.*")


def required_crops(labels: DataFrame, blocks: DataFrame, run: str = "run_id", **options) -> DataFrame:
    """crop_boxes, but a label without a block, or a question without a box, is an error when the rows are read."""
    known = blocks.select(run, "label").distinct().withColumn("_known", F.lit(True))
    name = F.concat(F.lit("no block for "), F.col("label"))
    checked = labels.join(known, [run, "label"], "left").withColumn("label", F.when(F.col("_known"), F.col("label")).otherwise(F.raise_error(name).cast("string"))).drop("_known")
    boxes = crop_boxes(checked, blocks, run, **options)
    asked = checked.groupBy(run, "question_no").agg(F.count("label").alias("_asked"))
    j = asked.join(boxes, [run, "question_no"], "left")
    lost = F.raise_error(F.concat(F.lit("no box for question "), F.col("question_no").cast("string"))).cast("long")
    return j.withColumn("x1", F.when(F.col("x1").isNull(), lost).otherwise(F.col("x1"))).drop("_asked")


def reading_distance(a_page: Column, a_top: Column, a_bottom: Column, b_page: Column, b_top: Column, b_bottom: Column, page_height: float = 1000.0) -> Column:
    """(distance, side) from block a to block b along the reading path: before, after or overlap; a page between counts its height."""
    start_a, end_a = (a_page * page_height + y for y in (a_top, a_bottom))
    start_b, end_b = (b_page * page_height + y for y in (b_top, b_bottom))
    side = F.when(end_b <= start_a, "before").when(start_b >= end_a, "after").otherwise("overlap")
    gap = F.greatest(start_a - end_b, start_b - end_a, F.lit(0.0))
    return F.struct(gap.alias("distance"), side.alias("side"))


def page_extents(blocks: DataFrame, keys: Sequence[str], bottom: Column, gap: float = 80.0, least: float = 1000.0) -> DataFrame:
    """(keys, extent): the lowest edge of a page and a gap, at least a page's height."""
    return blocks.groupBy(*keys).agg(F.greatest(F.lit(least), F.max(bottom) + gap).alias("extent"))
