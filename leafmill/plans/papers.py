"""Queries of the exam-paper operators over the driver's tables, each with its SQL.

The tables hold no exam papers, so lines of documents get an exam's marks by
rule (EXAM, one expression for both engines) and rows of the other tables
stand for blocks, figures, questions and model answers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import geometry as G
from ..functions import mathtext as M
from ..functions import text as T
from ..operators import align, assets, budget, layout, markup, models, records, tables
from ..sources import readers
from .catalogue import LINES, query, table

#: A line of a document with the marks of an exam; the same text in Spark SQL and in DuckDB.
EXAM = """CASE (doc_id + pos) % 8 WHEN 0 THEN concat(cast(doc_id % 20 + 1 AS STRING), '. ', line) WHEN 1 THEN concat('（A）', line) WHEN 2 THEN concat('解：', line)
  WHEN 3 THEN concat('【解析】', line) WHEN 4 THEN concat('参考答案 ', line) WHEN 5 THEN concat('12、', line) ELSE line END"""
EXAM_SQL = f"{LINES}, exam AS (SELECT doc_id, pos::INT AS pos, pos // 6 + 1 AS page, {EXAM} AS text FROM lines)"
KINDS = "CASE p_partkey % 7 WHEN 0 THEN 'table_body' WHEN 1 THEN 'image' WHEN 2 THEN 'chart' WHEN 3 THEN 'image_caption' WHEN 4 THEN '' ELSE 'text' END"
KIND_SQL = """CASE WHEN contains(t, 'caption') THEN NULL WHEN contains(t, 'table') THEN 'table' WHEN contains(t, 'chart') THEN 'chart'
  WHEN contains(t, 'image') OR f <> '' OR starts_with(split_part(label, '-', 3), 'P') THEN 'image' END"""


def exam(spark, d) -> DataFrame:
    rows = layout.flatten_lines(table(spark, d, "documents"), ["doc_id"], "text")
    return rows.select("doc_id", "pos", (F.floor(F.col("pos") / 6) + 1).cast("int").alias("page"), F.expr(EXAM).alias("text"))


def _blocks(spark, d) -> DataFrame:
    """Parts as blocks: label Q-Vnn-Bnn or -Pnn, type, figure_id."""
    return table(spark, d, "part").select(
        "p_partkey", "p_brand", F.expr(KINDS).alias("type"), F.expr("CASE WHEN p_partkey % 11 = 0 THEN 'fig' ELSE '' END").alias("figure_id"),
        F.format_string("Q-V%02d-%s%02d", F.col("p_size") % 100, F.expr("CASE WHEN p_partkey % 5 = 0 THEN 'P' ELSE 'B' END"), F.col("p_partkey") % 100).alias("label"), "p_size", "p_retailprice", "p_name",
    )


BLOCKS_SQL = f"""blocks AS (SELECT p_partkey, p_brand, {KINDS} AS t, CASE WHEN p_partkey % 11 = 0 THEN 'fig' ELSE '' END AS f,
  'Q-V' || printf('%02d', p_size % 100) || '-' || CASE WHEN p_partkey % 5 = 0 THEN 'P' ELSE 'B' END || printf('%02d', p_partkey % 100) AS label, p_size, p_retailprice, p_name FROM part)"""


# ---------------------------------------------------------------- marks, roles, predicates


@query(f"""WITH {EXAM_SQL} SELECT doc_id, pos, regexp_matches(text, '^\\s*(【(思路分析|解析|解答|答案|归纳总结|评析|点评)】|(思路分析|解析|解答|答案|归纳总结|评析|点评)\\s*[:：]|(解|证明|证|答)\\s*[:：])') AS solution,
  regexp_matches(regexp_replace(text, '\\s+', '', 'g'), '1[、.．]') AS marked, try_cast(nullif(regexp_extract(text, '^\\s*(\\d{{1,2}})\\s*[.．、]', 1), '') AS INT) AS number,
  regexp_matches(text, '^\\s*[(（][A-D][)）]') AS is_option FROM exam""")
def exam_marks(spark, d):
    t = F.col("text")
    return exam(spark, d).select("doc_id", "pos", T.is_solution_marker(t).alias("solution"), T.has_marker(t, F.lit(1)).alias("marked"), T.question_number(t).alias("number"), T.is_option(t).alias("is_option"))


_PAGE_TEXT = "CASE WHEN doc_id % 9 = 0 AND page = 3 THEN '贴条形码区' WHEN doc_id % 7 = 0 AND page = 1 THEN '专家点评' WHEN doc_id % 5 = 0 AND page = 1 THEN '参考答案与试题解析【解析' ELSE '' END"


@query(f"""WITH {EXAM_SQL},
p AS (SELECT doc_id, page, {_PAGE_TEXT} || chr(10) || string_agg(CASE WHEN doc_id % 2 = 0 THEN text ELSE line END, chr(10) ORDER BY pos) AS text FROM (SELECT exam.*, lines.line FROM exam JOIN lines USING (doc_id, pos)) GROUP BY doc_id, page),
f AS (SELECT *, regexp_matches(text, '贴条形码|请在各题目的答题区内作答|超出黑色矩形边框|选择题涂写区') AS sheet, regexp_matches(text, '专家点评|立学科之基|试题守正出新') AS remark,
  regexp_matches(text, '答案要点|参考答案|答案与解析|评分标准') AS ans, len(regexp_extract_all(text, '(?m)^\\s*\\d{{1,2}}\\s*[.．、]')) AS heads,
  (length(text) - length(replace(text, '参考答案与试题解析', ''))) / 9 + (length(text) - length(replace(text, '试题解析', ''))) / 4 + (length(text) - length(replace(text, '【思路分析', ''))) / 5
  + (length(text) - length(replace(text, '【解析', ''))) / 3 + (length(text) - length(replace(text, '【归纳总结', ''))) / 5 AS marks FROM p),
w AS (SELECT *, min(page) FILTER (ans AND NOT sheet) OVER (PARTITION BY doc_id) AS first_answer_page, min(page) OVER (PARTITION BY doc_id) AS first_page, dense_rank() OVER (PARTITION BY doc_id ORDER BY page) AS r FROM f),
m AS (SELECT *, coalesce(first_answer_page = first_page AND sum(heads) FILTER (r <= 2) OVER (PARTITION BY doc_id) >= 2 AND sum(marks) FILTER (r <= 2) OVER (PARTITION BY doc_id) >= 2, false) AS mixed FROM w),
x AS (SELECT *, CASE WHEN sheet THEN 'answer_sheet' WHEN remark THEN 'commentary' WHEN mixed THEN 'interleaved_solution' WHEN page >= first_answer_page THEN 'answer' ELSE 'question' END AS role FROM m)
SELECT doc_id AS run_id, page::INT AS page, role, CASE WHEN mixed THEN 'interleaved_solution' WHEN bool_or(role = 'answer') OVER (PARTITION BY doc_id) THEN 'paper_then_answers' ELSE 'paper_only' END AS mode, first_answer_page::INT AS first_answer_page FROM x""")
def page_roles(spark, d):
    """Pages of six lines, every second document with an exam's marks."""
    rows = layout.flatten_lines(table(spark, d, "documents"), ["doc_id"], "text").withColumn("page", (F.floor(F.col("pos") / 6) + 1).cast("int"))
    shown = F.when(F.col("doc_id") % 2 == 0, F.expr(EXAM)).otherwise(F.col("line"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", shown.alias("t")))), lambda x: x["t"]), "\n")
    pages = rows.groupBy("doc_id", "page").agg(joined.alias("body")).select(F.col("doc_id").alias("run_id"), "page", F.concat(F.expr(_PAGE_TEXT), F.lit("\n"), "body").alias("text"))
    return layout.page_roles(pages)


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'mixed' WHEN o_custkey % 2 = 0 THEN 'paper_plus_answer_file' WHEN o_custkey % 3 = 0 THEN 'mixed' ELSE 'pure_paper' END AS mode FROM orders""")
def pipeline_modes(spark, d):
    forced = F.when(F.col("o_orderstatus") == "P", "mixed").when(F.col("o_orderstatus") == "O", "auto")
    return table(spark, d, "orders").select("o_orderkey", layout.pipeline_mode(forced, F.col("o_custkey") % 2 == 0, F.col("o_custkey") % 3 == 0).alias("mode"))


@query("""SELECT event_id, s = 429 OR regexp_matches(lower(b), '429|rate limit|rate_limit|too many requests|tpm|tokens per minute|throttl') AS rate_limited, s IN (500, 502, 503, 504) AS transient
FROM (SELECT event_id, (CASE event_id % 6 WHEN 0 THEN 429 WHEN 1 THEN 500 WHEN 2 THEN 503 WHEN 3 THEN 400 ELSE 200 END)::INT AS s, CASE WHEN event_id % 7 = 0 THEN 'Too Many Requests' ELSE event_type END AS b FROM events)""")
def failure_classes(spark, d):
    status = F.expr("CASE event_id % 6 WHEN 0 THEN 429 WHEN 1 THEN 500 WHEN 2 THEN 503 WHEN 3 THEN 400 ELSE 200 END")
    body = F.when(F.col("event_id") % 7 == 0, "Too Many Requests").otherwise(F.col("event_type"))
    return table(spark, d, "events").select("event_id", T.is_rate_limit(status, body).alias("rate_limited"), T.is_transient(status).alias("transient"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'stem_figure,option_figure,stem_table,option_table,answer_figure,analysis_figure,rubric_table,noise,uncertain'
  WHEN o_custkey % 2 = 0 THEN 'answer_figure,analysis_figure,rubric_table,noise,uncertain' ELSE 'stem_figure,option_figure,stem_table,option_table,noise,uncertain' END AS roles FROM orders""")
def role_domains(spark, d):
    mode, stream = F.when(F.col("o_orderstatus") == "P", "mixed").otherwise("pure_paper"), F.when(F.col("o_custkey") % 2 == 0, "answer").otherwise("question")
    return table(spark, d, "orders").select("o_orderkey", F.array_join(assets.allowed_roles(mode, stream), ",").alias("roles"))


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey IN (1, 5, 7)")
def select_known_rows(spark, d):
    return tables.select_known(table(spark, d, "nation").select("n_nationkey", "n_name"), "n_nationkey", [1, 5, 7])


@query("""SELECT event_id, CASE WHEN starts_with(u, 'data:') THEN 'data' WHEN event_id % 3 = 0 THEN 'file' END AS source FROM (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'data:image/png;base64,' ELSE 'http://x/' END || event_type AS u FROM events)""")
def image_sources(spark, d):
    url = F.concat(F.when(F.col("event_id") % 4 == 0, "data:image/png;base64,").otherwise("http://x/"), "event_type")
    return table(spark, d, "events").select("event_id", readers.image_source(url, F.col("event_id") % 3 == 0).alias("source"))


@query("SELECT p_partkey, p_size AS index, p_brand AS mode FROM part WHERE p_size = 7 AND p_brand = 'Brand#11'")
def article_choice(spark, d):
    images = table(spark, d, "part").select("p_partkey", F.col("p_size").alias("index"), F.col("p_brand").alias("mode"))
    return readers.choose_article(images, 7, "Brand#11")


# ---------------------------------------------------------------- blocks, labels, geometry


@query(f"""WITH {BLOCKS_SQL} SELECT p_partkey, {KIND_SQL} AS kind, CASE WHEN p_partkey % 3 = 0 THEN 'b' || p_partkey ELSE 'b' || p_partkey || '_x' END AS base, CASE WHEN p_partkey % 3 = 0 THEN (p_partkey % 10)::INT END AS line FROM blocks""")
def block_kinds(spark, d):
    ident = F.when(F.col("p_partkey") % 3 == 0, F.format_string("b%d_l%d", "p_partkey", F.col("p_partkey") % 10)).otherwise(F.format_string("b%d_x", "p_partkey"))
    return _blocks(spark, d).select("p_partkey", T.asset_kind(F.col("label"), F.col("type"), F.col("figure_id")).alias("kind"), T.line_base(ident).alias("b")).select("p_partkey", "kind", "b.*")


@query(f"""WITH {BLOCKS_SQL}, k AS (SELECT *, {KIND_SQL} AS kind FROM blocks)
SELECT p_brand, coalesce(string_agg(label, ',' ORDER BY a) FILTER (kind = 'table'), '') AS tables, coalesce(string_agg(label, ',' ORDER BY a) FILTER (kind <> 'table'), '') AS figures
FROM (SELECT p_brand, kind = 'table' AS is_table, label, min(kind) AS kind, min(p_partkey) AS a FROM k WHERE kind IS NOT NULL GROUP BY ALL) RIGHT JOIN (SELECT DISTINCT p_brand FROM part) USING (p_brand) GROUP BY p_brand""")
def labels_by_kind(spark, d):
    listed = F.array_sort(F.collect_list(F.struct("p_partkey", "label", "type", "figure_id")))
    got = _blocks(spark, d).groupBy("p_brand").agg(records.labels_by_kind(listed).alias("k"))
    return got.select("p_brand", F.array_join("k.tables", ",").alias("tables"), F.array_join("k.figures", ",").alias("figures"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name WHEN p_partkey % 3 = 1 THEN p_type ELSE '' END AS text FROM part""")
def block_texts(spark, d):
    empty = lambda n, c: F.when(F.col("p_partkey") % 3 == n, F.col(c)).otherwise(F.lit("  "))
    block = F.struct(empty(0, "p_name").alias("text"), empty(1, "p_type").alias("content"), F.lit(None).cast("string").alias("raw"))
    return table(spark, d, "part").select("p_partkey", records.block_text(block).alias("text"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '$' || p_name || '$' WHEN 1 THEN '$$' || p_name || '$$' WHEN 2 THEN p_name ELSE '<b>' || p_name || '</b>' END AS content FROM part""")
def span_contents(spark, d):
    kind = F.expr("CASE p_partkey % 4 WHEN 0 THEN 'inline_equation' WHEN 1 THEN 'interline_equation' ELSE 'text' END")
    content = F.when(F.col("p_partkey") % 4 != 3, F.col("p_name")).otherwise("")
    return table(spark, d, "part").select("p_partkey", T.span_content(kind, content, F.concat(F.lit("<b>"), "p_name", F.lit("</b>"))).alias("content"))


@query("""SELECT p_partkey, round(p_size / 640 * 1000, 1) AS x1, round(p_retailprice / 1000 * 1000, 1) AS y1, p_size / 1000 * 320 AS px, p_retailprice / 1000 * 480 AS py, 0.0::DOUBLE AS lost FROM (SELECT p_partkey, p_size::DOUBLE AS p_size, p_retailprice FROM part)""")
def box_spaces(spark, d):
    box = F.array(F.col("p_size").cast("double"), F.col("p_retailprice"))
    n, s = G.normal_box(box, F.lit(640), F.lit(0)), G.scale_box(box, F.lit(320), F.lit(480))
    return table(spark, d, "part").select("p_partkey", n[0].alias("x1"), n[1].alias("y1"), s[0].alias("px"), s[1].alias("py"), G.side(box, 3).alias("lost"))


@query("""SELECT l_orderkey, greatest(1000.0, max(l_extendedprice) / 10 + 80) AS extent FROM lineitem GROUP BY 1""")
def page_extents(spark, d):
    return layout.page_extents(table(spark, d, "lineitem"), ["l_orderkey"], F.col("l_extendedprice") / 10)


@query("""WITH b AS (SELECT l_orderkey AS run_id, l_linenumber::BIGINT AS question_no, l_suppkey % 3 AS page, min(l_quantity) AS x, max(l_quantity) AS x2, min(l_linenumber) * 100.0 AS y, max(l_linenumber) * 100.0 + 50 AS y2 FROM lineitem GROUP BY 1, 2, 3)
SELECT run_id, question_no, 'q' AS stream, page::INT AS page, 'p.png' AS image, greatest(0, floor(x) - 8)::BIGINT AS x1, greatest(0, floor(y) - 8)::BIGINT AS y1, least(1000, ceil(x2 + 100) + 8)::BIGINT AS x2, least(1000, ceil(y2) + 8)::BIGINT AS y2 FROM b""")
def crop_boxes(spark, d):
    li = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").cast("long").alias("question_no"), F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("label"),
        F.lit("q").alias("stream"), (F.col("l_suppkey") % 3).cast("int").alias("page"), F.lit("p.png").alias("image"),
        F.array("l_quantity", F.col("l_linenumber") * 100.0, F.col("l_quantity") + 100, F.col("l_linenumber") * 100.0 + 50).alias("bbox"),
    )
    return layout.required_crops(li.select("run_id", "question_no", "label"), li.drop("question_no"))


@query("""WITH x AS (SELECT a.p_brand, a.p_partkey, b.p_partkey AS other, a.p_size * 1000 + a.p_retailprice / 10 AS s, b.p_size * 1000 + b.p_retailprice / 10 AS t FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_partkey % 50 = 0)
SELECT p_partkey, other, greatest(s - (t + 20), t - (s + 30), 0.0) AS distance, CASE WHEN t + 20 <= s THEN 'before' WHEN t >= s + 30 THEN 'after' ELSE 'overlap' END AS side FROM x""")
def reading_distances(spark, d):
    part = table(spark, d, "part").select("p_brand", "p_partkey", "p_size", (F.col("p_retailprice") / 10).alias("top"))
    left, right = part.where("p_partkey % 50 = 0").select("p_brand", "p_size", "top", "p_partkey"), part.select("p_brand", F.col("p_size").alias("page"), F.col("top").alias("y"), F.col("p_partkey").alias("other"))
    near = align.key_pairs(left, right, "p_brand")
    r = layout.reading_distance(F.col("p_size"), F.col("top"), F.col("top") + 30, F.col("page"), F.col("y"), F.col("y") + 20)
    return near.select("p_partkey", "other", r.alias("r")).select("p_partkey", "other", "r.*")


@query("""WITH x AS (SELECT a.p_brand AS run_id, a.p_partkey AS asset, (b.p_partkey % 20)::INT AS question_no,
  min(greatest(a.p_retailprice - (b.p_retailprice + 20), b.p_retailprice - (a.p_retailprice + 30), 0.0)) AS distance FROM part a JOIN part b ON a.p_brand = b.p_brand GROUP BY 1, 2, 3)
SELECT run_id, asset, question_no, distance, r::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY run_id, asset ORDER BY distance, question_no) AS r FROM x) WHERE r <= 6""")
def nearest_questions(spark, d):
    part = table(spark, d, "part").select(F.col("p_brand").alias("run_id"), "p_partkey", F.col("p_retailprice").cast("double").alias("top"))
    a = part.select("run_id", F.col("p_partkey").alias("asset"), "top", (F.col("top") + 30).alias("bottom"))
    b = part.select("run_id", (F.col("p_partkey") % 20).cast("int").alias("question_no"), "top", (F.col("top") + 20).alias("bottom"))
    return align.nearest_questions(a, b)


# ---------------------------------------------------------------- text


@query("""SELECT p_partkey, replace(p_name, ' ', '\\t') || '\\f' AS controls, p_name || '\\frac{1}{2}' AS escapes, trim(p_name) AS unnumbered, p_name || ' end' AS marks, '<t>' || p_name || '</t> and ' || p_type AS tables,
  'x ' || p_name AS cleaned, CASE WHEN p_partkey % 2 = 0 THEN 'disallowed_table_placeholder_removed' ELSE 'unknown_table_placeholder_removed' END AS issues FROM part""")
def text_repairs(spark, d):
    n = F.col("p_name")
    cleaned = records.clean_table_marks(F.concat(F.lit("x <table07>  "), n), F.array(F.lit("<table01>")), F.when(F.col("p_partkey") % 2 == 0, F.array(F.lit("<table07>"))).otherwise(F.array(F.lit("<table02>"))))
    return table(spark, d, "part").select(
        "p_partkey", T.restore_controls(F.concat(F.replace(n, F.lit(" "), F.lit("\t")), F.lit("\x0c"))).alias("controls"), T.single_escapes(F.concat(n, F.lit("\\\\frac{1}{2}")), ["frac"]).alias("escapes"),
        T.strip_number(F.concat(F.lit("see 7 and 12. "), n), F.lit(12)).alias("unnumbered"), T.remove_all(F.concat(n, F.lit(" <a01>  <b02> end")), F.array(F.lit("<a01>"), F.lit("<b02>"))).alias("marks"),
        T.substitute_all(F.concat(F.lit("<table01> and "), "p_type"), F.create_map(F.lit("<table01>"), F.concat(F.lit("<t>"), n, F.lit("</t>")))).alias("tables"),
        cleaned["text"].alias("cleaned"), F.array_join(cleaned["issues"], ",").alias("issues"),
    )


@query("""SELECT s_suppkey, array_to_string(list_transform(range(s_suppkey % 5 + 1, s_suppkey % 5 + 4), lambda x: x::VARCHAR), ',') || ',' || (s_suppkey % 7 + 10) AS pages, s_suppkey % 3 + 1 AS a_limit, CASE WHEN s_suppkey % 2 = 0 THEN 5 END AS b_limit FROM supplier""")
def expanded_settings(spark, d):
    k = F.col("s_suppkey")
    limits = T.model_limits(F.format_string("m=1=%d, b =%s,bad=x,z=0", k % 3 + 1, F.when(k % 2 == 0, "5").otherwise("-2")))
    pages = T.expand_ranges(F.format_string("%d-%d, %d", k % 5 + 1, k % 5 + 3, k % 7 + 10))
    return table(spark, d, "supplier").select("s_suppkey", F.array_join(pages, ",").alias("pages"), F.try_element_at(limits, F.lit("m=1")).cast("long").alias("a_limit"), F.try_element_at(limits, F.lit("b")).alias("b_limit"))


@query(f"""WITH {LINES}, a AS (SELECT doc_id, list(line ORDER BY pos) AS x, list(DISTINCT pos // 6) AS p FROM lines GROUP BY doc_id)
SELECT doc_id, len(x)::INT AS n_lines, array_to_string(x[1:2], '|') AS first_two, array_to_string(list_sort(list_filter(p, lambda v: v > 0)), ',') AS pages, array_to_string(x[2:3], '|') AS between, array_to_string(list_filter([2, 3, 4, 5], lambda v: NOT list_contains(p, v)), ',') AS missing FROM a""")
def array_tools(spark, d):
    a = layout.flatten_lines(table(spark, d, "documents"), ["doc_id"], "text").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("x"))
    lines, pages = F.transform("x", lambda v: v["line"]), F.transform("x", lambda v: F.floor(v["pos"] / 6).cast("int"))
    a = a.select("doc_id", lines.alias("lines"), pages.alias("pages"), F.transform("x", lambda v, i: F.format_string("L%d", i)).alias("names"))
    at = A.labels_between(F.col("names"), F.lit("L1"), F.when(F.size("names") > 2, "L2").otherwise("L1"))
    shown = F.transform(at, lambda n: F.element_at("lines", F.substring(n, 2, 9).cast("int") + 1))
    return a.select(
        "doc_id", F.size(A.text_lines(F.array(F.array_join("lines", "\n")))).alias("n_lines"), F.array_join(A.limit_items(F.col("lines"), 2), "|").alias("first_two"), F.array_join(A.page_numbers(F.col("pages")), ",").alias("pages"),
        F.array_join(shown, "|").alias("between"), F.array_join(F.filter(A.missing_to(F.col("pages"), F.lit(5)), lambda v: v > 1), ",").alias("missing"),
    )


@query("""SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'main' WHEN 1 THEN 'a+b' ELSE 'c' END AS models FROM supplier""")
def worker_models(spark, d):
    listed = F.when(F.col("s_suppkey") % 3 == 0, F.array(F.lit(" "))).when(F.col("s_suppkey") % 3 == 1, F.array(F.lit("a"), F.lit(" b "), F.lit("a"))).otherwise(F.array(F.lit("c"), F.lit("c")))
    return table(spark, d, "supplier").select("s_suppkey", A.display_name(A.or_primary(listed, F.lit("main"))).alias("models"))


@query("""SELECT p_partkey, (length(p_name) + length(p_type))::BIGINT AS text_weight, (length(p_name) + length(p_type) + 15)::BIGINT AS context_weight FROM part""")
def task_weights(spark, d):
    return table(spark, d, "part").select("p_partkey", records.text_weight("p_name", "p_type").alias("text_weight"), records.context_weight(F.struct(F.col("p_name").alias("n"), F.col("p_type").alias("t"))).alias("context_weight"))


@query("""SELECT event_id, greatest(0, coalesce(try_cast(props->>'$.k' AS INT), 2048))::INT AS reserve, CASE WHEN user_id % 2 = 0 THEN event_type ELSE 'default' END AS bucket FROM events""")
def reserves(spark, d):
    limits = F.when(F.col("user_id") % 2 == 0, F.create_map("event_type", F.lit(9)))
    return table(spark, d, "events").select("event_id", budget.reserve(F.lit("none"), F.get_json_object("props", "$.k")).alias("reserve"), budget.bucket_of(F.col("event_type"), limits).alias("bucket"))


@query("""WITH RECURSIVE p AS (SELECT p_partkey, (p_size * 97)::BIGINT AS a, (p_partkey % 5000 + 1)::BIGINT AS b FROM part),
s AS (SELECT *, CASE WHEN a * b > 16777216 THEN sqrt(16777216.0 / (a::DOUBLE * b)) WHEN a * b < 65536 THEN sqrt(65536.0 / (a::DOUBLE * b)) ELSE 1.0 END AS k FROM p),
t(p_partkey, w, h, n) AS (SELECT p_partkey, greatest(1, round_even(a * k / 32, 0))::BIGINT, greatest(1, round_even(b * k / 32, 0))::BIGINT, 0 FROM s
  UNION ALL SELECT p_partkey, w - CASE WHEN w * h > 16384 AND w >= h AND w > 1 THEN 1 ELSE 0 END + CASE WHEN w * h < 64 AND w <= h THEN 1 ELSE 0 END,
    h - CASE WHEN w * h > 16384 AND NOT (w >= h AND w > 1) AND h > 1 THEN 1 ELSE 0 END + CASE WHEN w * h < 64 AND w > h THEN 1 ELSE 0 END, n + 1 FROM t WHERE n < 64 AND (w * h > 16384 OR w * h < 64))
SELECT p_partkey, arg_max(greatest(1, w * h), n)::BIGINT AS tokens FROM t GROUP BY p_partkey""")
def image_token_counts(spark, d):
    return table(spark, d, "part").select("p_partkey", G.image_tokens(F.col("p_size") * 97, (F.col("p_partkey") % 5000) + 1).alias("tokens"))


@query("""WITH x AS (SELECT doc_id, substring(text, 20, 200) AS t, 8 + doc_id % 9 AS k FROM documents)
SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN CASE WHEN k >= 10 THEN 'analysis' END WHEN length(regexp_replace(t, '[\\s$\\\\{}()\\[\\]（）,，.。:：;；]+', '', 'g')) >= 8 THEN CASE doc_id % 3 WHEN 0 THEN 'stem' ELSE 'analysis' END END AS best_role,
  CASE WHEN doc_id % 3 = 2 THEN CASE WHEN k >= 10 THEN k / 16.0 END WHEN length(regexp_replace(t, '[\\s$\\\\{}()\\[\\]（）,，.。:：;；]+', '', 'g')) >= 8 THEN 1 END::DOUBLE AS best_ratio FROM x""")
def text_roles(spark, d):
    """A passage of each document, and of every third 16 letters against 8 to 16 of them, beside the whole text and texts without any."""
    third, near = F.col("doc_id") % 3, F.expr("concat(substring('abcdefghijklmnop', 1, 8 + doc_id % 9), substring('0123456789', 1, 8 - doc_id % 9))")
    rows = table(spark, d, "documents").select(
        "doc_id", F.when(third == 2, "Abcdefgh (ijklmnop)").otherwise(F.substring("text", 20, 200)).alias("t"), F.when(third == 1, "0123 4567 89").otherwise(F.col("text")).alias("stem"),
        F.lit("0123 4567 89 #").alias("answer"), F.when(third == 0, "@@@@@@@@@@@@").when(third == 1, F.col("text")).otherwise(near).alias("analysis"),
    )
    return M.best_role(rows, "t", {"stem": "stem", "answer": "answer", "analysis": "analysis"}).select("doc_id", "best_role", "best_ratio")


@query("""SELECT conv_id, turn, '[{"role":"system","content":"be brief"},{"role":"user","content":' || to_json(text)::VARCHAR || '}]' AS messages, text || chr(10) || role AS shown FROM conversations""")
def chat_messages(spark, d):
    parts = F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("text")), F.struct(F.lit("image").alias("type"), F.lit("no").alias("text")), F.struct(F.lit("text").alias("type"), F.col("role").alias("text")))
    return table(spark, d, "conversations").select("conv_id", "turn", models.messages("be brief", F.col("text")).alias("messages"), models.message_text(parts).alias("shown"))


@query("""SELECT conv_id, CASE WHEN conv_id % 5 = 0 THEN 'error' ELSE 'ok' END AS status, CASE WHEN conv_id % 5 = 0 THEN NULL ELSE length(t) END AS chars, 1 AS attempts FROM (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS t FROM conversations GROUP BY conv_id)""")
def model_calls(spark, d):
    """Every conversation's whole text goes through a client; some answers are no JSON and become error rows."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), " ")
    work = table(spark, d, "conversations").groupBy("conv_id").agg(joined.alias("t"))
    asked = work.select("conv_id", F.when(F.col("conv_id") % 5 == 0, "not json").otherwise(F.to_json(F.struct(F.length("t").alias("chars")))).alias("messages"))
    got = models.call_model(asked, models.EchoClient(), "conv_id")
    return got.select("conv_id", "status", F.get_json_object("response", "$.chars").cast("long").alias("chars"), "attempts")
