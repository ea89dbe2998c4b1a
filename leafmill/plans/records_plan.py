"""Queries of records, model answers, assets and files over the driver's tables, each with its SQL."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import images
from ..functions import text as T
from ..llm import kit
from ..operators import align, assets, layout, markup, records, stages
from ..sources import commits, copies, readers, writers
from .catalogue import LINES, _records, query, spread, table
from .papers import BLOCKS_SQL, EXAM_SQL, KIND_SQL, _blocks, exam


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share; a local one only where the session names none and runs locally."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="leafmill-files-")
        spark.conf.set("spark.checkpoint.dir", at)
    return f"{at.rstrip('/')}/leafmill-{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- payloads and contexts


_TURNS = "SELECT conv_id AS run_id, turn::INT AS question_no, role, text FROM conversations"


@query(f"""WITH t AS ({_TURNS}),
n AS (SELECT run_id, question_no, 0 AS side, 0 AS pos, 'B' || question_no AS label FROM t UNION ALL SELECT run_id, question_no, 0, 1, 'B' || (question_no + 1) FROM t UNION ALL SELECT run_id, question_no, 1, 0, 'B' || (question_no + 1) FROM t),
b AS (SELECT run_id, 'B' || question_no AS label, text, CASE WHEN question_no % 3 = 1 THEN 'table' WHEN question_no % 5 = 2 THEN 'figure' END AS kind FROM t),
j AS (SELECT n.*, b.text, b.kind, b.label IS NULL AS missing FROM n LEFT JOIN b USING (run_id, label)),
f AS (SELECT run_id, question_no, kind, label, min((side, pos)) AS f FROM j WHERE kind IS NOT NULL GROUP BY ALL),
p AS (SELECT run_id, question_no, label, '<' || kind || printf('%02d', row_number() OVER (PARTITION BY run_id, question_no, kind ORDER BY f)) || '>' AS placeholder FROM f),
s AS (SELECT j.*, coalesce(p.placeholder, text, '') AS shown FROM j LEFT JOIN p USING (run_id, question_no, label))
SELECT run_id, question_no, string_agg(shown, chr(10) ORDER BY pos) FILTER (side = 0) AS question, string_agg(shown, chr(10) ORDER BY pos) FILTER (side = 1) AS answer, count(*) FILTER (missing) AS missing FROM s GROUP BY 1, 2""")
def payloads(spark, d):
    """Two labels a question, one an answer; every third turn is a table, some are figures, the last turn's next is missing."""
    t = table(spark, d, "conversations").select(F.col("conv_id").alias("run_id"), F.col("turn").cast("int").alias("question_no"), F.coalesce("text", F.lit("")).alias("text"))
    name = lambda c: F.concat(F.lit("B"), c.cast("string"))
    kind = F.when(F.col("question_no") % 3 == 1, "table").when(F.col("question_no") % 5 == 2, "image").otherwise("text")
    blocks = t.select("run_id", name(F.col("question_no")).alias("label"), kind.alias("type"), F.lit("").alias("figure_id"), "text")
    n = F.col("question_no")
    rows = t.select("run_id", "question_no", F.array(name(n), name(n + 1)).alias("question_labels"), F.array(name(n + 1)).alias("answer_labels"))
    got = align.require(records.payloads(rows, blocks), "question_blocks", ["run_id", "question_no"], "surface labels")
    texts = lambda c: F.array_join(F.transform(c, lambda b: b["text"]), "\n")
    lost = F.size(F.filter(F.concat("question_blocks", "answer_blocks"), lambda b: b["missing"])).cast("long")
    return got.select("run_id", "question_no", texts("question_blocks").alias("question"), texts("answer_blocks").alias("answer"), lost.alias("missing"))


@query("""SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN '{"ocr_text":' || to_json(text || chr(10) || role)::VARCHAR || '}' WHEN turn % 3 = 1 THEN '{"question_ocr":' || to_json(text || chr(10) || role)::VARCHAR || ',"answer_ocr":' || to_json(role)::VARCHAR || '}'
  ELSE '{"question_ocr":' || to_json(text || chr(10) || role)::VARCHAR || '}' END AS payload FROM conversations""")
def model_inputs(spark, d):
    block = lambda c: F.struct(c.alias("text"))
    q = F.array(block(F.col("text")), block(F.lit("  ")), block(F.col("role")))
    a = F.when(F.col("turn") % 3 == 1, F.array(block(F.col("role")))).otherwise(F.array(block(F.lit(" "))))
    mode = F.when(F.col("turn") % 3 == 0, "mixed").otherwise("paper_plus_answer_file")
    return table(spark, d, "conversations").select("conv_id", "turn", records.model_input(mode, q, a).alias("payload"))


@query(f"""WITH {LINES}, x AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS r, pos, trim(regexp_replace(line, '\\s+', ' ', 'g')) AS t FROM lines)
SELECT d.doc_id, string_agg(CASE WHEN length(t) <= 60 THEN t ELSE left(t, 59) || '…' END, chr(10) ORDER BY pos) AS context FROM documents d LEFT JOIN x ON x.doc_id = d.doc_id AND r <= 3 GROUP BY d.doc_id""")
def context_texts(spark, d):
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    return table(spark, d, "documents").select("doc_id", records.context_text(lines, 3, 60).alias("context"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type ELSE 'model_issue' END AS type, CASE WHEN event_id % 2 = 0 THEN 'error' ELSE 'warning' END AS severity, 'r' || event_id AS message,
  'unknown' AS failed_type, 'lost ' || event_id AS failed_message FROM events""")
def normal_issues(spark, d):
    code = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise("")
    raw = F.format_string('[{"code":"%s","reason":"r%d","message":"","severity":"%s"}]', code, "event_id", F.when(F.col("event_id") % 2 == 0, "error").otherwise("odd"))
    lost = records.error_record(F.col("event_id"), F.format_string("lost %d", "event_id"))
    got = table(spark, d, "events").select("event_id", F.explode(records.normal_issues(raw)).alias("i"), lost.alias("e"))
    return got.select("event_id", "i.type", "i.severity", "i.message", F.col("e.question_type").alias("failed_type"), F.element_at("e.issues", 1)["message"].alias("failed_message"))


@query("""WITH r AS (SELECT *, CASE l_linenumber % 4 WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 3 THEN 'x' ELSE 'C' END AS k, l_returnflag <> 'N' AS fig, printf('%d-%d-%d', l_linenumber, l_partkey, l_suppkey) AS label FROM lineitem),
x AS (SELECT l_orderkey, k, arg_max(label, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS label FROM r WHERE fig AND k <> 'x' GROUP BY 1, 2)
SELECT o.l_orderkey, max(label) FILTER (k = 'A') AS a, max(label) FILTER (k = 'B') AS b, max(label) FILTER (k = 'C') AS c FROM (SELECT DISTINCT l_orderkey FROM lineitem) o LEFT JOIN x USING (l_orderkey) GROUP BY 1""")
def placeholder_letters(spark, d):
    k = F.expr("CASE l_linenumber % 4 WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 3 THEN 'x' ELSE 'C' END")
    item = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.when(F.col("l_returnflag") != "N", "option_figure").otherwise("stem_figure").alias("role"), k.alias("option_label"), F.format_string("%d-%d-%d", "l_linenumber", "l_partkey", "l_suppkey").alias("label"))
    got = table(spark, d, "lineitem").groupBy("l_orderkey").agg(assets.placeholders_by_letter(F.array_sort(F.collect_list(item))).alias("m"))
    return got.select("l_orderkey", *(F.try_element_at("m", F.lit(x)).alias(x.lower()) for x in "ABC"))


@query(f"""WITH {BLOCKS_SQL}, a AS (SELECT *, {KIND_SQL} AS kind FROM blocks)
SELECT p_brand AS run_id, (p_size % 3)::INT AS page, count(*) FILTER (kind = 'table')::INT AS tables,
  string_agg(CASE WHEN length(trim(p_name)) <= 12 THEN trim(p_name) ELSE left(trim(p_name), 11) || '…' END || CASE WHEN p_partkey % 2 = 0 THEN '2' ELSE '0' END, '|' ORDER BY label || p_partkey) AS texts
FROM a WHERE kind = 'table' GROUP BY 1, 2""")
def table_contexts(spark, d):
    b = _blocks(spark, d).select(F.col("p_brand").alias("run_id"), (F.col("p_size") % 3).cast("int").alias("page"), F.concat("label", F.col("p_partkey").cast("string")).alias("label"), "type", "figure_id", F.col("p_name").alias("text"), "p_partkey")
    c = b.where("p_partkey % 2 = 0").select("run_id", "label", F.array(F.lit(1), F.lit(2)).alias("candidates"))
    got = assets.table_contexts(b.drop("p_partkey"), c, limit=12)
    texts = F.transform("tables", lambda t: F.concat(t["text"], F.size(t["candidates"]).cast("string")))
    return got.select("run_id", "page", F.size("tables").alias("tables"), F.array_join(texts, "|").alias("texts"))


@query(f"""WITH {BLOCKS_SQL}, a AS (SELECT *, {KIND_SQL} AS kind FROM blocks), k AS (SELECT *, CASE p_partkey % 3 WHEN 0 THEN 'stem_figure' WHEN 1 THEN 'answer_figure' END AS pre FROM a WHERE kind IS NOT NULL)
SELECT p_brand AS run_id, CASE WHEN p_partkey % 2 = 0 THEN 'answer' ELSE 'question' END AS stream, p_size % 2 AS page, count(*)::INT AS n,
  coalesce(string_agg(pre, ',' ORDER BY label || p_partkey) FILTER (CASE WHEN p_partkey % 2 = 0 THEN pre = 'answer_figure' ELSE pre = 'stem_figure' END), '') AS roles, sum(CASE WHEN p_partkey % 5 = 0 THEN 2 ELSE 0 END)::BIGINT AS candidates FROM k GROUP BY 1, 2, 3""")
def asset_contexts(spark, d):
    b = _blocks(spark, d).withColumn("kind", T.asset_kind(F.col("label"), F.col("type"), F.col("figure_id"))).where("kind is not null").withColumn("label", F.concat("label", F.col("p_partkey").cast("string")))
    b = b.withColumn("run_id", F.col("p_brand"))
    a = b.select("run_id", F.when(F.col("p_partkey") % 2 == 0, "answer").otherwise("question").alias("stream"), (F.col("p_size") % 2).alias("page"), "label", "kind")
    c = b.where("p_partkey % 5 = 0").select("run_id", "label", F.explode(F.array(F.lit(1), F.lit(2))).alias("rank")).select("run_id", "label", F.col("rank").alias("question_no"), "rank", F.lit(0.0).alias("distance"))
    pre = b.where("p_partkey % 3 < 2").select("run_id", "label", F.expr("CASE p_partkey % 3 WHEN 0 THEN 'stem_figure' ELSE 'answer_figure' END").alias("role"), F.lit(None).cast("string").alias("option_label"))
    got = assets.asset_contexts(a, c, pre, "paper_plus_answer_file")
    n = F.aggregate(F.transform("assets", lambda x: F.coalesce(F.size(x["candidates"]), F.lit(0))), F.lit(0).cast("long"), lambda s, x: s + F.greatest(x, F.lit(0)))
    roles = F.array_join(F.filter(F.transform("assets", lambda x: x["role"]), lambda r: r.isNotNull()), ",")
    return got.select("run_id", "stream", "page", F.size("assets").alias("n"), roles.alias("roles"), n.alias("candidates"))


# ---------------------------------------------------------------- model answers


@query("""SELECT conv_id AS run_id, turn::INT AS question_no, '1-V' || printf('%02d', turn % 3) || '-' || turn AS start_label, turn % 4 <> 0 AS valid, CASE WHEN turn % 2 = 0 THEN 1 ELSE 0 END AS visuals, least(1.0, turn / 2.0)::DOUBLE AS confidence,
  (row_number() OVER (PARTITION BY conv_id ORDER BY turn % 3, '1-V' || printf('%02d', turn % 3) || '-' || turn, turn) - 1)::INT AS ordinal FROM conversations""")
def parsed_ranges(spark, d):
    """A model's ranges, a turn each: some ends and visual labels unknown, a number that is none."""
    t = table(spark, d, "conversations").select(F.col("conv_id").alias("run_id"), "turn")
    name = F.format_string("1-V%02d-%d", F.col("turn") % 3, "turn")
    item = F.format_string('{"question_no":"%d","start_label":"%s","end_label":"%s","visual_labels":["%s","nowhere"],"confidence":"%s","reason":""}', "turn", name, F.when(F.col("turn") % 4 == 0, "nowhere").otherwise(name), F.when(F.col("turn") % 2 == 0, name).otherwise("lost"), F.col("turn") / 2)
    listed = F.array_sort(F.collect_list(F.struct("turn", item.alias("j"))))
    answers = t.groupBy("run_id").agg(F.array_join(F.transform(listed, lambda x: x["j"]), ",").alias("j")).select("run_id", F.format_string('{"question_ranges":[{"question_no":"none"},%s],"risks":[]}', "j").alias("response"))
    got = align.parse_ranges(answers, t.select("run_id", name.alias("label")))
    return got.select("run_id", "question_no", "start_label", "valid", F.size("visual_labels").alias("visuals"), "confidence", "ordinal")


@query("""SELECT p_brand AS run_id, p_partkey AS label, CASE WHEN p_partkey % 5 = 0 OR p_partkey % 5 = 1 THEN NULL WHEN p_partkey % 5 = 2 THEN 'stem_figure' WHEN p_partkey % 5 = 3 THEN 'uncertain' ELSE 'noise' END AS role,
  CASE WHEN p_partkey % 5 = 2 THEN 2 END AS question_no, CASE WHEN p_partkey % 5 IN (1, 2) THEN 'B' END AS option_label, CASE WHEN p_partkey % 5 = 0 THEN 0.0 ELSE least(1.0, p_size / 10.0)::DOUBLE END AS confidence,
  CASE p_partkey % 5 WHEN 0 THEN 'unanswered' WHEN 1 THEN 'bad_role' END AS problem FROM part""")
def checked_assignments(spark, d):
    k = F.col("p_partkey") % 5
    part = table(spark, d, "part").select(F.col("p_brand").alias("run_id"), F.col("p_partkey").alias("label"), "p_size", "p_partkey")
    allowed = assets.allowed_roles(F.lit("pure_paper"), F.lit("question"))
    expected = part.select("run_id", "label", F.array(F.lit(1), F.lit(2)).alias("candidates"), allowed.alias("allowed"))
    answers = part.where(k > 0).select(
        "run_id", "label", F.when(k == 1, "answer_figure").when(k == 4, "noise").otherwise("stem_figure").alias("role"), F.when(k == 2, 2).when(k == 3, 9).otherwise(F.lit(None)).cast("int").alias("question_no"),
        F.when(k < 3, " b ").otherwise("q").alias("option_label"), (F.col("p_size") / 10).alias("confidence"),
    )
    return assets.check_assignments(expected, answers)


@query("""SELECT conv_id AS run_id, 'T' || (turn % 3) AS label, turn::INT AS question_no, CASE WHEN turn = 0 THEN '' ELSE role END AS answer_text, 0.5::DOUBLE AS confidence FROM conversations WHERE turn % 3 = 1 OR (turn % 3 = 2 AND turn IN (2, 5))""")
def answer_tables(spark, d):
    """Three tables a conversation: noise, a key without candidates, a key whose candidates are 2 and 5."""
    t = table(spark, d, "conversations").select(F.col("conv_id").alias("run_id"), "turn", "role")
    entry = F.format_string('{"question_no":"%d","answer_text":" %s ","confidence":"0.5","reason":""}', "turn", "role")
    each = t.groupBy("run_id", (F.col("turn") % 3).alias("k")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", entry.alias("j")))), lambda x: x["j"]), ",").alias("j"))
    item = F.format_string('{"label":"T%d","role":"%s","entries":[%s]}', "k", F.when(F.col("k") == 0, "noise").otherwise("answer_key_table"), "j")
    answers = each.groupBy("run_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", item.alias("j")))), lambda x: x["j"]), ",").alias("j")).select("run_id", F.format_string('{"tables":[%s],"risks":[]}', "j").alias("response"))
    candidates = t.select("run_id").distinct().select("run_id", F.lit("T2").alias("label"), F.array(F.lit(2), F.lit(5)).alias("candidates"))
    return assets.table_entries(answers, candidates).select("run_id", "label", "question_no", "answer_text", "confidence")


@query("""SELECT s_nationkey AS run_id, 'T' || s_suppkey AS label, CASE s_suppkey % 8 WHEN 0 THEN 'answer_key_table' WHEN 1 THEN 'rubric_table' WHEN 2 THEN 'solution_table' WHEN 3 THEN 'noise' ELSE 'uncertain' END AS role,
  CASE WHEN s_suppkey % 8 < 6 THEN least(1.0, (s_suppkey % 8) / 4.0) ELSE 0 END::DOUBLE AS confidence, CASE WHEN s_suppkey % 8 < 6 THEN s_name ELSE '' END AS reason FROM supplier""")
def table_roles(spark, d):
    """Suppliers as tables of an answer page: known roles, an unknown one, none, and tables that the answer leaves out or names twice."""
    s = table(spark, d, "supplier")
    roles = F.array(*(F.lit(r) for r in (*assets.TABLE_ROLES[:4], "riddle", None)))
    item = lambda role, why: F.struct(F.concat(F.lit("T"), "s_suppkey").alias("label"), role.alias("role"), (F.col("s_suppkey") % 8 / 4).cast("string").alias("confidence"), why.alias("reason"))
    told = F.when(F.col("s_suppkey") % 8 < 6, F.array(item(F.lit("noise"), F.lit("first try")), item(F.element_at(roles, (F.least(F.col("s_suppkey") % 8, F.lit(5)) + 1).cast("int")), F.col("s_name"))))
    pages = s.groupBy(F.col("s_nationkey").alias("run_id")).agg(F.collect_list(F.struct(F.concat(F.lit("T"), "s_suppkey").alias("label"))).alias("tables"), F.to_json(F.struct(F.flatten(F.collect_list(told)).alias("tables"))).alias("response"))
    return assets.table_roles(pages, pages)


@query("""SELECT doc_id, concat_ws(',', CASE WHEN doc_id % 4 = 3 THEN 'not_json' END, CASE WHEN doc_id % 4 = 2 THEN 'extra_key:more' END, CASE WHEN doc_id % 4 = 1 THEN 'question_type' END, CASE WHEN doc_id % 4 = 0 THEN 'choice_without_options' END) AS violations FROM documents""")
def parsed_records(spark, d):
    """Records as a model writes them: a choice without options, an unknown type, one key too many, no JSON."""
    kind = F.expr("CASE doc_id % 4 WHEN 0 THEN 'single_choice' WHEN 1 THEN 'riddle' ELSE 'solution' END")
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: T.strip(x) != "")
    none = F.array().cast("array<string>")
    body = F.to_json(
        F.struct(F.lit(records.SCHEMA_VERSION).alias("schema_version"), F.col("doc_id").alias("question_no"), kind.alias("question_type"), lines.alias("stem_latex"), F.struct(*(none.alias(k) for k in records.LETTERS)).alias("options_latex"),
                 none.alias("answer_latex"), none.alias("analysis_latex"), none.alias("rubric_latex"), F.array().cast(f"array<{records.ISSUE}>").alias("issues"))
    )
    raw = F.when(F.col("doc_id") % 4 == 3, "no json").when(F.col("doc_id") % 4 == 2, F.concat(F.regexp_replace(body, r"\}$", ""), F.lit(',"more":1}'))).otherwise(body)
    return records.parse_records(table(spark, d, "documents").select("doc_id", raw.alias("raw")), "raw").select("doc_id", F.array_join("violations", ",").alias("violations"))


# ---------------------------------------------------------------- joins by label


@query("""WITH p AS (SELECT c.conv_id AS run_id, c.turn::INT AS question_no, c.turn AS t FROM conversations c),
l AS (SELECT run_id, question_no, unnest(['B' || t, 'B' || (t + 1)]) AS label, generate_subscripts(['B' || t, 'B' || (t + 1)], 1) AS i FROM p)
SELECT p.run_id, p.question_no, coalesce(k.labels, '') AS labels, coalesce(a.mine, '') AS mine FROM p
LEFT JOIN (SELECT run_id, question_no, string_agg(label, ',' ORDER BY i) AS labels FROM l WHERE try_cast(substr(label, 2) AS INT) % 3 <> 0 OR NOT EXISTS (SELECT 1 FROM p q WHERE q.run_id = l.run_id AND 'B' || q.t = l.label) GROUP BY 1, 2) k USING (run_id, question_no)
LEFT JOIN (SELECT run_id, t + 1 AS question_no, 'B' || t AS mine FROM p WHERE t % 3 = 0 AND t % 2 = 0) a USING (run_id, question_no)""")
def attached_assets(spark, d):
    """Every third turn is an asset of the next question, every second of those noise."""
    t = table(spark, d, "conversations").select(F.col("conv_id").alias("run_id"), F.col("turn").cast("int").alias("question_no"))
    n = F.col("question_no")
    name = lambda c: F.concat(F.lit("B"), c.cast("string"))
    rows = t.select("run_id", "question_no", F.array(name(n), name(n + 1)).alias("labels"))
    own = t.where("question_no % 3 = 0").select("run_id", name(n).alias("label"), (n + 1).alias("question_no"), F.when(n % 2 == 0, "stem_figure").otherwise("noise").alias("role"), F.lit(None).cast("string").alias("option_label"), n.alias("ordinal"))
    later = own.select("run_id", "label", (F.col("question_no") + 5).alias("question_no"), "role", "option_label", (F.col("ordinal") + 100).alias("ordinal"))
    got = assets.attach_assets(rows, own.unionByName(later))
    return got.select("run_id", "question_no", F.array_join("labels", ",").alias("labels"), F.coalesce(F.array_join(F.transform("visual_assets", lambda a: a["label"]), ","), F.lit("")).alias("mine"))


@query("""SELECT conv_id AS run_id, turn::INT AS question_no, CASE WHEN turn % 2 = 0 THEN 'Q-' || turn ELSE '' END AS answers, CASE WHEN turn % 2 = 0 THEN 'found' ELSE 'missing' END AS answer_status FROM conversations""")
def alignment_mixed(spark, d):
    t = table(spark, d, "conversations").select(F.col("conv_id").alias("run_id"), F.col("turn").cast("int").alias("question_no"))
    name = lambda side: F.concat(F.lit(f"{side}-"), F.col("question_no").cast("string"))
    q = t.select("run_id", "question_no", F.array(name("Q")).alias("labels"))
    a = t.select("run_id", "question_no", F.array(name("A"), F.lit("A-none")).alias("labels"), (F.col("question_no") % 2 == 0).alias("valid"), F.col("question_no").alias("ordinal"))
    got = align.align_mixed(q, a, t.select("run_id", name("Q").alias("label")))
    return got.select("run_id", "question_no", F.array_join("answer_labels", ",").alias("answers"), "answer_status")


@query(f"""WITH {EXAM_SQL}, b AS (SELECT *, lag(pos) OVER w AS bp, lag(text) OVER w AS bt FROM exam WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
SELECT doc_id AS run_id, 12 AS question_no, CASE WHEN bp IS NOT NULL AND regexp_matches(regexp_replace(bt, '\\s+', '', 'g'), '12[、.．]') THEN 'L' || bp || ',' ELSE '' END || 'L' || pos AS labels FROM b WHERE pos % 6 = 1""")
def shared_starts(spark, d):
    e = exam(spark, d).select(F.col("doc_id").alias("run_id"), F.concat(F.lit("L"), F.col("pos").cast("string")).alias("label"), F.col("pos").alias("ordinal"), "text")
    # A range a block here, so the block stands for its question while they are joined.
    r = e.where("ordinal % 6 = 1").select("run_id", F.lit(12).alias("question_no"), F.col("label").alias("start_label"), F.col("label").alias("end_label"), F.array().cast("array<string>").alias("visual_labels"), F.col("ordinal").alias("at"))
    keyed = F.concat_ws("|", F.col("run_id").cast("string"), F.floor(F.col("ordinal") / 6).cast("string"))
    near = e.withColumn("run", keyed).drop("run_id").withColumnRenamed("run", "run_id")
    asked = r.withColumn("run", F.concat_ws("|", F.col("run_id").cast("string"), F.floor(F.col("at") / 6).cast("string"))).drop("run_id", "at").withColumnRenamed("run", "run_id")
    got = align.labels_in_ranges(asked, near, shared_start=True)
    return got.select(F.split("run_id", r"\|")[0].cast("long").alias("run_id"), "question_no", F.array_join("labels", ",").alias("labels"))


@query(f"""WITH {BLOCKS_SQL} SELECT p_partkey, unnest(list_distinct([label, 'Q-' || substr(label, 3), 'A-' || substr(label, 3)])) AS form FROM blocks""")
def label_forms(spark, d):
    return align.label_forms(_blocks(spark, d).select("p_partkey", "label")).select("p_partkey", "form")


@query("""WITH a AS (SELECT conv_id AS run_id, turn // 2 AS q, turn, role FROM conversations), l AS (SELECT run_id, q, label, min((turn, i)) AS f FROM (SELECT run_id, q, turn, unnest([1, 2]) AS i, unnest([role, role || '2']) AS label FROM a) GROUP BY ALL)
SELECT run_id, q::INT AS question_no, string_agg(label, ',' ORDER BY f) AS labels FROM l GROUP BY 1, 2""")
def stream_groups(spark, d):
    a = table(spark, d, "conversations").select(F.col("conv_id").alias("run_id"), F.floor(F.col("turn") / 2).cast("int").alias("question_no"), F.col("turn").alias("ordinal"), F.array("role", F.concat("role", F.lit("2"))).alias("labels"))
    got = align.groups_of_stream(a.select("run_id", "question_no", "labels"), a, "answer")
    return got.select("run_id", "question_no", F.array_join("labels", ",").alias("labels"))


@query("""SELECT o_orderkey, o_orderstatus, n::BIGINT AS n FROM orders LEFT JOIN (SELECT l_orderkey AS o_orderkey, count(*) AS n FROM lineitem GROUP BY 1) USING (o_orderkey)""")
def transient_texts(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    n = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.max("l_partkey").alias("top"))
    got = records.attach_texts(o, n, ["o_orderkey"]).withColumn("n", F.col("standardized.n"))
    return records.strip_transient(got)


# ---------------------------------------------------------------- manifests, listings, files


@query("""SELECT c_custkey AS item, CASE WHEN c_custkey % 2 = 0 THEN 'a' || c_custkey ELSE 'b' || c_custkey END AS path, c_custkey % 3 <> 0 AS found FROM customer""")
def first_found_path(spark, d):
    """Two candidates each; the listing has one of them, or none."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("item"))
    path = lambda p: F.concat(F.lit(p), F.col("item").cast("string"))
    candidates = c.select("item", F.posexplode(F.when(F.col("item") % 3 == 0, F.when(F.col("item") % 2 == 0, F.array(path("a"), path("b"))).otherwise(F.array(path("b"), path("a")))).otherwise(F.array(path("a"), path("b")))).alias("pos", "path"))
    listing = c.where("item % 3 <> 0").select(F.when(F.col("item") % 2 == 0, path("a")).otherwise(path("b")).alias("path"))
    return align.first_found(candidates, listing, ["item"])


@query("""SELECT s_suppkey AS run_id, CASE WHEN s_suppkey % 4 = 0 THEN 'missing paper_pdf: p' || s_suppkey || CASE WHEN s_suppkey % 3 = 0 THEN ',missing answer_pdf: a' || s_suppkey ELSE '' END WHEN s_suppkey % 3 = 0 THEN 'missing answer_pdf: a' || s_suppkey ELSE '' END AS errors,
  s_suppkey % 4 <> 0 AND s_suppkey % 3 <> 0 AS ready, (SELECT count(*) FROM supplier) AS total, (SELECT count(*) FROM supplier WHERE s_suppkey % 4 <> 0 AND s_suppkey % 3 <> 0) AS n_ready FROM supplier""")
def import_manifest(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("run_id"), F.format_string("p%d", "s_suppkey").alias("paper_pdf"), F.format_string("a%d", "s_suppkey").alias("answer_pdf"))
    listing = s.where("run_id % 4 <> 0").select(F.col("paper_pdf").alias("path")).unionByName(s.where("run_id % 3 <> 0").select(F.col("answer_pdf").alias("path")))
    items = readers.import_items(s, listing).withColumn("warnings", F.array().cast("array<string>"))
    counts = writers.manifest_counts(items).select("total", F.col("ready").alias("n_ready"))
    # One row of counts.
    return items.select("run_id", F.array_join("errors", ",").alias("errors"), "ready").join(F.broadcast(counts), F.lit(True))


@query("""WITH s AS (SELECT s_nationkey AS k, s_name AS name FROM supplier WHERE s_nationkey % 2 = 0) SELECT k, name, 1 AS source FROM s UNION ALL SELECT c_nationkey, c_name, 2 FROM customer WHERE c_nationkey NOT IN (SELECT k FROM s)""")
def first_nonempty_source(spark, d):
    a = table(spark, d, "supplier").where("s_nationkey % 2 = 0").select(F.col("s_nationkey").alias("k"), F.col("s_name").alias("name"), F.lit(1).alias("source"))
    b = table(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_name").alias("name"), F.lit(2).alias("source"))
    return readers.first_nonempty(a, b, key="k")


@query(f"""WITH {BLOCKS_SQL} SELECT p_partkey, label AS key FROM blocks UNION SELECT p_partkey, f FROM blocks WHERE f <> ''""")
def layout_index(spark, d):
    return readers.two_keys(_blocks(spark, d).select("p_partkey", "label", "figure_id"), "label", "figure_id").select("p_partkey", "key")


@query("SELECT DISTINCT 'run' || c_nationkey AS run_id FROM customer WHERE c_custkey % 3 = 0")
def discovered_runs(spark, d):
    path = F.format_string("/data/run%d/%s", "c_nationkey", F.when(F.col("c_custkey") % 3 == 0, "done.json").otherwise("other.json"))
    return readers.run_ids(table(spark, d, "customer").select(path.alias("path")), "done.json")


@query("""WITH i AS (SELECT n_nationkey AS k, unnest(range(4)) AS i FROM nation)
SELECT 'u' || k AS article_url, i::INT AS index, CASE WHEN k % 2 = 0 THEN CASE i WHEN 0 THEN 'paper' WHEN 1 THEN 'answer' WHEN 2 THEN 'other' ELSE 'unknown' END WHEN k % 3 = 0 THEN 'paper' ELSE 'unknown' END AS phase FROM i""")
def phases_of_images(spark, d):
    images = table(spark, d, "nation").select(F.format_string("u%d", "n_nationkey").alias("article_url"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("index"), F.when(F.col("n_nationkey") % 3 == 0, "期中试卷").when(F.col("n_nationkey") % 3 == 1, "试卷答案").otherwise("other").alias("title"), "n_nationkey")
    seq = images.where("n_nationkey % 2 = 0 and index < 3").select(F.col("article_url").alias("url"), F.lit("image").alias("kind"), F.col("index").cast("string").alias("imageIndex"), F.element_at(F.array(F.lit("paper"), F.lit("answer"), F.lit("other")), F.col("index") + 1).alias("phase"))
    bad = seq.where("imageIndex = '0'").select("url", "kind", F.lit("x").alias("imageIndex"), F.lit("answer").alias("phase"))
    return readers.image_phases(images.drop("n_nationkey").withColumn("phase", F.lit("old")), seq.unionByName(bad)).select("article_url", "index", "phase")


@query(f"""WITH {LINES} SELECT doc_id, pos::INT AS pos, trim(regexp_replace(line, '\\s+', ' ', 'g')) AS text FROM lines""")
def layout_leaves(spark, d):
    """Lines of documents as a layout tree: a page of a block each, nested up to twelve levels down."""
    lines = layout.flatten_lines(table(spark, d, "documents"), ["doc_id"], "text")
    span = F.array(F.struct(F.array(F.struct(F.lit("text").alias("type"), F.col("line").alias("content"))).alias("spans")))
    leaf = F.to_json(F.struct(F.lit("text").alias("type"), span.alias("lines")))
    down = (F.col("pos") % 13).cast("int")
    block = F.concat(F.repeat(F.lit('{"type":"list","blocks":['), down), leaf, F.repeat(F.lit("]}"), down))
    skipped = F.lit('{"type":"image_body","lines":[{"spans":[{"type":"text","content":"never"}]}]}')
    each = lines.select("doc_id", "pos", F.concat(block, F.lit(","), skipped).alias("b"))
    tree = each.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "b"))).alias("x"))
    pages = F.array_join(F.transform("x", lambda v: F.concat(F.lit('{"preproc_blocks":['), v["b"], F.lit("]}"))), ",")
    docs = tree.select("doc_id", F.concat(F.lit("["), pages, F.lit("]")).alias("tree"), F.transform("x", lambda v: v["pos"]).alias("at"))
    got = layout.flatten_tree(docs.select("doc_id", "tree"), ["doc_id"]).join(docs.select("doc_id", "at"), "doc_id")
    return got.select("doc_id", F.element_at("at", F.col("page") + 1).alias("pos"), "text")


@query("""SELECT 'B' || n_nationkey AS label, n_name AS text, n_regionkey::INT AS page, 'page_' || printf('%02d', n_regionkey) AS file FROM nation WHERE n_nationkey % 5 <> 0""")
def packet_files(spark, d):
    """Blocks written as a JSON packet a page, read back by page; unlabelled blocks go."""
    at = scratch(spark, "packets")
    block = F.struct(F.when(F.col("n_nationkey") % 5 != 0, F.format_string("B%d", "n_nationkey")).otherwise("").alias("label"), F.col("n_name").alias("text"), F.col("n_regionkey").cast("int").alias("page"))
    pages = table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(block)).alias("blocks")).select(F.lit("r").alias("run_id"), F.col("n_regionkey").cast("int").alias("page"), "blocks")
    for page in [r.page for r in pages.select("page").distinct().collect()]:  # regions: a handful
        writers.write_json(pages.where(F.col("page") == page), f"{at}/page_{page:02d}", single=True)
    packets = spark.read.schema(readers.PACKET).json(f"{at}/page_*").withColumn("file", F.regexp_extract(F.col("_metadata.file_path"), r"(page_\d+)/", 1))
    return readers.packet_blocks(packets).select("label", "text", "page", "file")


@query("""SELECT doc_id, lang, length(text) AS n, 'kept' AS mark FROM documents UNION ALL SELECT doc_id, lang, length(text), 'log' FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, lang, length(text), 'log' FROM documents WHERE doc_id % 3 = 0""")
def json_round_trip(spark, d):
    """Documents through JSON files, and through a log that is appended twice; stamps of the log are dropped again."""
    at, docs = scratch(spark, "json"), table(spark, d, "documents").select("doc_id", "lang", F.length("text").cast("long").alias("n"))
    writers.write_json(docs, f"{at}/all")
    for k in (2, 3):
        writers.append_log(docs.where(F.col("doc_id") % k == 0), f"{at}/log")
    schema = "doc_id long, lang string, n long"
    empty = spark.createDataFrame([], schema)
    kept = readers.read_jsonl(spark, f"{at}/all", schema).unionByName(readers.read_json(spark, f"{at}/none", schema, empty))
    log = readers.read_jsonl(spark, f"{at}/log", schema + ", created_at string").where("created_at is not null").drop("created_at")
    return kept.withColumn("mark", F.lit("kept")).unionByName(log.withColumn("mark", F.lit("log")))


@query("""SELECT n_nationkey AS question_no, n_name AS name FROM nation WHERE n_nationkey IN (3, 4, 9)""")
def record_files(spark, d):
    """Records in a file as an object with `questions`; only the numbers asked for."""
    at = scratch(spark, "records")
    every = F.array_sort(F.collect_list(F.struct(F.col("n_nationkey").alias("question_no"), F.col("n_name").alias("name"))))
    writers.write_json(table(spark, d, "nation").agg(every.alias("questions")), at, single=True)
    return readers.read_records(spark, f"{at}/part-*", "question_no int, name string", [3, 4, 9])


@query("""SELECT c_nationkey, count(*) FILTER (c_custkey % 2 = 0) AS n, CASE WHEN c_nationkey % 2 = 0 THEN 'new' ELSE 'old' END AS version FROM customer GROUP BY 1""")
def run_overwrites(spark, d):
    """A table by run whose even runs are written again, then a write in place whose former version stays."""
    at = scratch(spark, "runs")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", F.lit("old").alias("version"))
    writers.write_runs(c, f"{at}/t", "c_nationkey")
    writers.write_runs(c.where("c_nationkey % 2 = 0").withColumn("version", F.lit("new")), f"{at}/t", "c_nationkey")
    first = writers.write_back(spark.read.parquet(f"{at}/t"), f"{at}/b")
    writers.write_back(commits.read_table(spark, f"{at}/b").where("c_custkey % 2 = 0"), f"{at}/b", first)
    kept, whole = commits.read_table(spark, f"{at}/b"), commits.read_table(spark, f"{at}/b", first).select("c_nationkey", "version").distinct()
    n = kept.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return whole.join(n, "c_nationkey", "left").select(F.col("c_nationkey").cast("int").alias("c_nationkey"), F.coalesce("n", F.lit(0)).cast("long").alias("n"), "version")


@query("""SELECT c_nationkey AS run_id, count(*) AS n, CASE WHEN c_nationkey % 5 = 0 THEN 'second' ELSE 'first' END AS made, round(sum(c_acctbal + CASE WHEN c_nationkey % 5 = 0 THEN 1 ELSE 0 END), 2) AS total FROM customer WHERE c_nationkey % 7 <> 0 GROUP BY 1""")
def stage_reuse(spark, d):
    """A stage over runs, called again after a fifth of them changed and a seventh went: only changed runs are made again."""
    at = scratch(spark, "stage")
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("run_id"), "c_custkey", F.col("c_acctbal").cast("double").alias("balance"))
    made = lambda when: lambda rows: rows.groupBy("run_id").agg(F.count("*").alias("n"), F.lit(when).alias("made"), F.round(F.sum("balance"), 2).alias("total"))
    stages.run_stage(c, at, made("first"))
    changed = c.where("run_id % 7 <> 0").withColumn("balance", F.col("balance") + F.when(F.col("run_id") % 5 == 0, 1.0).otherwise(0.0))
    return stages.run_stage(changed, at, made("second"))


@query("""SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'png' WHEN 1 THEN 'gif' WHEN 2 THEN 'jpeg' WHEN 6 THEN NULL ELSE 'webp' END AS format,
  CASE WHEN p_partkey % 7 < 6 THEN p_size * 20 END::INT AS width, CASE WHEN p_partkey % 7 < 6 THEN p_partkey % 9000 + 1 END::INT AS height FROM part""")
def image_headers(spark, d):
    """Parts as the first bytes of images of their size: PNG, GIF, JPEG behind other markers, the three kinds of WEBP, and no image."""
    w, h = F.col("p_size").cast("long") * 20, (F.col("p_partkey") % 9000 + 1).cast("long")
    big = lambda v, n: F.lpad(F.hex(v), 2 * n, "0")
    little = lambda v, n: F.concat(*(F.lpad(F.hex(F.shiftright(v, 8 * i).bitwiseAND(F.lit(255).cast("long"))), 2, "0") for i in range(n)))
    code = lambda *x: F.concat(*(F.lit(v.hex()) if isinstance(v, bytes) else v for v in x))
    webp = lambda kind, *x: code(b"RIFF\0\0\0\0WEBP", kind, b"\0\0\0\0", *x)
    forms = [
        code(b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR", big(w, 4), big(h, 4)), code(b"GIF89a", little(w, 2), little(h, 2)),
        code(b"\xff\xd8\xff\xe0\0\x04ab\xff\xff\xdb\0\x03q\xff\xc2\0\x11\x08", big(h, 2), big(w, 2)), webp(b"VP8 ", b"\0\0\0\x9d\x01\x2a", little(w, 2), little(h, 2)),
        webp(b"VP8L", b"\x2f", little(w - 1 + (h - 1) * 16384, 4)), webp(b"VP8X", b"\0\0\0\0", little(w - 1, 3), little(h - 1, 3)), F.hex("p_name"),
    ]
    head = F.element_at(F.array(*forms), (F.col("p_partkey") % len(forms) + 1).cast("int"))
    return table(spark, d, "part").select("p_partkey", images.image_facts(F.unhex(head)).alias("f")).select("p_partkey", "f.*")


@query("""WITH i AS (SELECT c_nationkey AS article_url, 'u' || c_custkey % 50 AS url, min(c_custkey) AS index FROM customer GROUP BY 1, 2), s AS (SELECT c_nationkey AS article_url, 'u' || c_custkey % 50 AS url, min(-c_custkey) AS first_at FROM customer WHERE c_custkey % 3 = 0 GROUP BY 1, 2)
SELECT i.article_url, i.url, i.index, row_number() OVER (PARTITION BY i.article_url ORDER BY first_at NULLS LAST, index)::INT AS place FROM i LEFT JOIN s USING (article_url, url)""")
def images_in_page_order(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("article_url"), F.concat(F.lit("u"), F.col("c_custkey") % 50).alias("url"), "c_custkey")
    listed = c.groupBy("article_url", "url").agg(F.min("c_custkey").alias("index"))
    return readers.dom_order(listed, c.where("c_custkey % 3 = 0").select("article_url", "url", (-F.col("c_custkey")).alias("at")))


@query("""SELECT n_regionkey AS run_id, '<p>' || replace(n_name, 'A', '&amp;') || '</p>' AS html FROM nation""")
def rendered_texts(spark, d):
    """Blocks rendered to HTML and written a folder a run, as text files."""
    at = scratch(spark, "texts")
    rows = table(spark, d, "nation").select(F.col("n_regionkey").alias("run_id"), F.concat(F.lit("<p>"), markup.render_inline(F.replace("n_name", F.lit("A"), F.lit("&"))), F.lit("</p>")).alias("html"))
    writers.write_texts(rows, at)
    return spark.read.text(at).select(F.col("run_id").cast("int").alias("run_id"), F.col("value").alias("html"))


@query("""WITH f AS (SELECT substring(p_brand, 7) AS folder, sha256(string_agg(p_name, ',' ORDER BY p_partkey, p_name) || chr(10)) || '.txt' AS file, sum(length(p_name) + 1) AS bytes FROM part GROUP BY 1)
SELECT p_partkey, CASE WHEN p_partkey % 5 < 3 THEN file END AS file, CASE WHEN p_partkey % 5 < 3 THEN bytes END::BIGINT AS bytes FROM part JOIN f ON folder = substring(p_brand, 7) WHERE p_partkey % 5 < 4""")
def asset_copies(spark, d):
    """A text file a brand; parts as blocks whose file is that of their brand by either key, a lost one, none, or a block without a file; copied and looked up."""
    at, k = scratch(spark, "assets"), F.col("p_partkey")
    part = table(spark, d, "part").withColumn("run_id", F.substring("p_brand", 7, 9))
    writers.write_joined(part, f"{at}/paper", "p_name", ["p_partkey", "p_name"])
    names = readers.page_files(spark, f"{at}/paper/*", "*.txt").select(F.regexp_extract("path", "/paper/(run_id=([^/]+)/.*)", 2).alias("run_id"), F.regexp_extract("path", "/paper/(.*)", 1).alias("name"))
    stream = lambda odd: F.when(odd, "answer").otherwise("question")
    items = names.select("run_id", "name", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("i"))
    path = F.when(F.col("i") % 4 == 3, F.lit("lost.txt")).otherwise(F.replace("name", F.lit("/"), F.lit("\\")))
    items = items.select("run_id", stream(F.col("i") > 3).alias("stream"), F.concat(F.lit("block"), F.col("i") % 4).alias("key"), path.alias("path"))
    key = F.concat(F.lit("block"), k % 5)
    blocks = part.select(
        "run_id", F.lit(at).alias("folder"), stream(k % 2 == 1).alias("stream"), k.alias("pos"), k.cast("string").alias("label"), F.when(k % 5 < 4, "Image").otherwise("text").alias("type"),
        F.when(k % 5 != 1, key).otherwise("").alias("block_id"), F.when(k % 5 == 1, key).alias("figure_id"),
    )
    sources = kit.save(assets.asset_map(blocks, items, names.select(F.concat(F.lit(f"{at}/paper/"), "name").alias("path"))), "sources")
    # Many labels have one file, or none.
    copied = kit.save(copies.copy_files(sources, f"{at}/copies"), "copied")
    return kit.join_small(sources, copied, "source", "left").select(F.col("label").cast("long").alias("p_partkey"), "file", "bytes")


ESCAPED = "replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '\'\'', '&#x27;')"
BLANKS_SQL = """'<span class="blank"></span>' AS b, '<span class="choice-blank"><span class="choice-blank-space"></span></span>' AS c"""


@query(f"""WITH {LINES}, x AS (SELECT doc_id, pos::INT AS pos, ltrim(translate(line, '$\\_', ''), ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS t, {BLANKS_SQL} FROM lines), e AS (SELECT *, {ESCAPED.format("t")} AS e FROM x)
SELECT doc_id, pos, '<p class="text-block">' || CASE (doc_id + pos) % 4
  WHEN 0 THEN e || '.' WHEN 1 THEN e || ' \\(a_{{1}} &lt; \\underline{{\\hspace{{3em}}}}\\) ' || b || '<br>' || c
  WHEN 2 THEN e || ' ' || c || ' ' || b || ' $x &amp; (\\hspace{{1.8em}})$'
  ELSE e || ':</p><div class="table-wrap"><table class="html-table"><tr><th colspan="2">' || pos || '</th></tr><tr><td rowspan="20">$x &lt; ' || doc_id || '$</td><td>' || b || '</td></tr></table></div><p class="text-block">end' END || '</p>' AS html FROM e""")
def rendered_blocks(spark, d):
    """Lines of documents as blocks with formulas, blanks of all kinds and tables."""
    rows = layout.flatten_lines(table(spark, d, "documents"), ["doc_id"], "text").withColumn("line", F.translate("line", "$\\_", ""))
    grid = F.concat(
        F.lit(":\n<Table border=1><tr><th colspan='2'>"), F.col("pos").cast("string"), F.lit("</th></tr><tr><td></td></tr><tr><td rowspan=50>$x &lt; "), F.col("doc_id").cast("string"),
        F.lit("$</td><td>__</td></tr></TABLE><table></table> end "),
    )
    forms = F.array(F.lit(".<table><tr><td> </td></tr></table>"), F.lit(" \\(a_{1} < ___\\) <blank>\n<choice_blank>\n"), F.lit(" （ __ ） \\blankline{} $x & <choice_blank>$"), grid)
    blocks = rows.select("doc_id", "pos", F.concat("line", F.element_at(forms, ((F.col("doc_id") + F.col("pos")) % 4 + 1).cast("int"))).alias("block"))
    return markup.with_tables(blocks, F.array("block")).select("doc_id", "pos", markup.render_block(F.col("block"), F.col("tables")).alias("html"))


@query("""SELECT run_id, page, n_regionkey FROM (SELECT n_regionkey, n_regionkey AS run_id, (row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey))::INT AS page FROM nation) WHERE page IN (1, 3)""")
def chosen_pages(spark, d):
    w = Window.partitionBy("n_regionkey").orderBy("n_nationkey")
    pages = table(spark, d, "nation").select("n_regionkey", F.col("n_regionkey").alias("run_id"), F.row_number().over(w).alias("page"))
    return readers.split_pages(pages, F.array(F.lit(1), F.lit(3)), ("run_id",)).select("run_id", "page", "n_regionkey")


# ---------------------------------------------------------------- records


@query("""SELECT c_nationkey, '## OCR block 1' || chr(10) || string_agg(c_name, chr(10) || chr(10) || '## OCR block ' ORDER BY c_custkey) IS NOT NULL AS some, CASE WHEN c_nationkey % 2 = 0 THEN 'whole' ELSE (SELECT string_agg('## OCR block ' || r || chr(10) || n, chr(10) || chr(10) ORDER BY r)
  FROM (SELECT c_name AS n, row_number() OVER (ORDER BY c_custkey) AS r FROM customer i WHERE i.c_nationkey = o.c_nationkey)) END AS text FROM customer o GROUP BY c_nationkey""")
def answer_texts(spark, d):
    """A whole text where there is one, else the blocks as numbered sections."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))), lambda x: x["c_name"])
    c = table(spark, d, "customer").groupBy("c_nationkey").agg(F.concat(F.array(F.lit(" ")), listed).alias("b"))
    return c.select("c_nationkey", F.lit(True).alias("some"), readers.answer_text(F.when(F.col("c_nationkey") % 2 == 0, "whole").otherwise(""), F.col("b")).alias("text"))


@query(f"""WITH {LINES}, r AS (SELECT d.doc_id, row_number() OVER w AS r, u.line FROM documents d, LATERAL (SELECT unnest(string_split(coalesce(d.text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(d.text, ''), chr(10)), 1) AS pos) u WINDOW w AS (PARTITION BY d.doc_id ORDER BY u.pos)),
b AS (SELECT doc_id, CASE WHEN r <= 2 THEN 'stem_latex' ELSE 'analysis_latex' END AS f, CASE WHEN r <= 2 THEN 0 ELSE 2 END AS a, r, line FROM r WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''),
c AS (SELECT doc_id, f, a, r, regexp_replace(regexp_replace(replace(line, '$', ''), '\\(\\s*\\)', '', 'g'), '\\s+', '', 'g') AS v FROM b)
SELECT source AS run_id, d.doc_id::INT AS question_no, coalesce((SELECT sha256(string_agg(f || '.:' || v, '|' ORDER BY a, r)) FROM c WHERE c.doc_id = d.doc_id AND (f <> 'stem_latex' OR v <> '')), '') AS fingerprint FROM documents d""")
def record_fingerprints(spark, d):
    return records.fingerprints(_records(spark, d))


@query("""WITH t AS (SELECT source AS run_id, (CASE doc_id % 4 WHEN 0 THEN 'fill_blank' WHEN 1 THEN 'single_choice' WHEN 2 THEN 'multiple_choice' ELSE 'solution' END) AS k, doc_id FROM documents)
SELECT run_id, count(*) AS question_count, count(*) FILTER (doc_id % 5 <> 0) AS success_count, count(*) FILTER (doc_id % 5 = 0) AS error_count, count(*) FILTER (k = 'fill_blank')::INT AS fill_blank, count(*) FILTER (k = 'solution')::INT AS solution,
  count(*) FILTER (doc_id % 5 = 0)::INT AS errors, count(*) FILTER (doc_id % 5 > 2)::INT AS warnings, count(*) FILTER (doc_id % 5 > 2)::INT AS odd, round(sum((doc_id % 8) / 8.0), 3)::DOUBLE AS total_elapsed_seconds FROM t GROUP BY 1""")
def record_summary(spark, d):
    k = F.col("question_no") % 5
    found = F.when(k == 0, F.array(records.issue("lost", "error", "m"))).when(k > 2, F.array(records.issue("odd", "warning", "m"))).otherwise(F.array().cast(f"array<{records.ISSUE}>"))
    s = records.summary(_records(spark, d).withColumns({"issues": found, "elapsed": F.col("question_no") % 8 / 8}))
    at = lambda m, key: F.coalesce(F.try_element_at(m, F.lit(key)), F.lit(0))
    return s.select(
        "run_id", "question_count", "success_count", "error_count", at("question_type_counts", "fill_blank").alias("fill_blank"), at("question_type_counts", "solution").alias("solution"),
        at("severity_counts", "error").alias("errors"), at("severity_counts", "warning").alias("warnings"), at("issue_counts", "odd").alias("odd"), "total_elapsed_seconds",
    )


@query(f"""WITH {LINES}, x AS (SELECT doc_id, pos, trim(regexp_replace(line, '\\s+', ' ', 'g')) AS t, line FROM lines)
SELECT doc_id, count(*) AS n_blocks, arg_min(CASE WHEN length(t) <= 260 THEN t ELSE left(t, 259) || '…' END, pos) AS first_text, max(length(t)) > 260 AS cut, count(*) FILTER (regexp_matches(line, '^\\s*\\d{{1,2}}\\s*[.．、]')) AS numbered FROM x GROUP BY doc_id""")
def page_packets(spark, d):
    rows = layout.flatten_lines(table(spark, d, "documents"), ["doc_id"], "text").withColumn("whole", F.length(T.collapse(F.col("line")))).withColumnRenamed("line", "text")
    p = layout.packets(rows, ["doc_id"], "pos")
    numbered = F.size(F.filter("blocks", lambda b: b["detected_question_prefix"].isNotNull())).cast("long")
    return p.select("doc_id", F.size("blocks").cast("long").alias("n_blocks"), F.element_at("blocks", 1)["text"].alias("first_text"), F.exists("blocks", lambda b: b["whole"] > 260).alias("cut"), numbered.alias("numbered"))


@query("""WITH x AS (SELECT l_orderkey, list((l_linenumber, l_partkey, l_suppkey) ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS c FROM lineitem GROUP BY 1)
SELECT l_orderkey, 1 AS table_no, 1 AS "row", i::INT AS col, 'th' AS tag, CASE WHEN i = 1 THEN 2 ELSE 20 END AS colspan, 1 AS rowspan, 'n' || c[i][1] AS text FROM (SELECT *, unnest(range(1, len(c) + 1)) AS i FROM x)
UNION ALL SELECT l_orderkey, 1, 3, i::INT, 'td', 1, CASE WHEN i = 1 THEN 3 ELSE 1 END, c[i][2] || ' & ' || c[i][3] FROM (SELECT *, unnest(range(1, len(c) + 1)) AS i FROM x)""")
def html_tables(spark, d):
    """Orders as tables: a header row with a wide cell, a blank row, a row of cells with markup, references and a high cell."""
    item = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    x = spread(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"), "l_orderkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("c"))
    head = F.transform("c", lambda v, i: F.concat(F.when(i == 0, '<th colspan="2" rowspan="1">').otherwise('<th colspan="99">'), F.lit("n"), v["l_linenumber"].cast("string"), F.lit("</th>")))
    body = F.transform("c", lambda v, i: F.concat(F.when(i == 0, "<td rowspan=3>").otherwise("<td>"), F.lit("<b>"), v["l_partkey"].cast("string"), F.lit("</b>  &amp; "), v["l_suppkey"].cast("string")))
    grid = F.concat(F.lit("text <TABLE><tr>"), F.array_join(head, ""), F.lit("</tr><tr><td> </td></tr><tr>"), F.array_join(body, ""), F.lit("</tr></TABLE> more"))
    return markup.html_tables(x.select("l_orderkey", grid.alias("grid")), ["l_orderkey"], "grid")


@query("""SELECT source AS run_id, doc_id::INT AS question_no, concat_ws(',', CASE WHEN doc_id % 3 = 0 THEN 'question_no_mismatch' END, CASE WHEN doc_id % 2 = 0 THEN 'unbalanced_dollar' END, CASE WHEN doc_id % 5 = 0 THEN 'image_path_in_output' END,
  CASE WHEN doc_id % 4 = 1 THEN 'blank_token_inside_math' END, CASE WHEN doc_id % 7 = 0 THEN 'empty_answer' END, CASE WHEN doc_id % 6 = 0 THEN 'unresolved_table_placeholder,unresolved_table_placeholder' END) AS issues FROM documents
WHERE doc_id % 3 = 0 OR doc_id % 2 = 0 OR doc_id % 5 = 0 OR doc_id % 4 = 1 OR doc_id % 7 = 0 OR doc_id % 6 = 0""")
def record_issues(spark, d):
    """Records with planted faults: a wrong number, an odd dollar, an image path, a blank inside an option's formula, no answer, two tables left."""
    k = lambda n, r=0: F.col("question_no") % n == r
    none = F.array().cast("array<string>")
    r = _records(spark, d)
    stem = F.concat(F.lit("a stem"), F.when(k(2), " $").otherwise(""), F.when(k(6), " <table01> <table02>").otherwise(""))
    mark = lambda n: F.struct(F.lit("table").alias("kind"), F.lit(f"Q-T{n}").alias("label"), F.lit(f"<table0{n}>").alias("placeholder"))
    r = r.withColumns({
        "stem_latex": F.array(stem), "analysis_latex": F.when(k(5), F.array(F.lit("see fig.png"))).otherwise(none), "options_latex": F.struct(F.when(k(4, 1), F.array(F.lit("$x = <blank>$"))).otherwise(none).alias("A"), *(none.alias(x) for x in "BCD")),
        "answer_latex": F.when(k(7), none).otherwise(F.array(F.lit("42"))), "source_no": F.when(k(3), F.col("question_no") + 1).otherwise(F.col("question_no")), "answer_status": F.lit("found"), "placeholders": F.array(mark(1), mark(2)),
    })
    return records.record_issues(r).select("run_id", "question_no", F.array_join(F.transform("found", lambda i: i["type"]), ",").alias("issues")).where("issues <> ''")


@query(f"""WITH {LINES}, x AS (SELECT d.doc_id, d.source, len(string_split(coalesce(d.text, ''), chr(10))) AS n FROM documents d)
SELECT source AS run_id, doc_id::INT AS question_no, concat_ws('; ', CASE WHEN doc_id % 4 IN (1, 2) THEN 'a choice without options' END, CASE WHEN doc_id % 4 = 3 AND doc_id % 5 = 0 THEN 'a solution with a blank in its question' END,
  CASE WHEN doc_id % 3 = 0 THEN 'answer_latex[1] holds an escaped line break' END, CASE WHEN doc_id % 3 = 1 THEN 'answer_latex[1] talks about the task' END, CASE WHEN doc_id % 2 = 0 THEN 'stem_latex[2] has an odd dollar sign' END) AS warnings FROM documents""")
def record_warnings(spark, d):
    k = lambda n, r=0: F.col("question_no") % n == r
    none = F.array().cast("array<string>")
    r = _records(spark, d).withColumns({
        "stem_latex": F.array(F.lit("plain"), F.when(k(2), "one $ here").otherwise("none")), "analysis_latex": none, "answer_ocr": F.lit("text"), "question_ocr": F.when(k(5), "fill ( ) in").otherwise("no"),
        "answer_latex": F.array(F.when(k(3), "a\\n b").when(k(3, 1), "根据输入").otherwise("fine")),
    })
    return records.content_warnings(r).select("run_id", "question_no", F.array_join("warnings", "; ").alias("warnings"))


@query("""WITH r AS (SELECT p_type || ' & ' || p_brand AS run_id FROM part UNION SELECT '<' || event_type || '>' FROM events),
e AS (SELECT run_id, replace(replace(replace(run_id, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS name FROM r WHERE run_id IS NOT NULL)
SELECT run_id, '<li><a href="' || name || '.html">' || name || '</a></li>' AS line FROM e""")
def run_index(spark, d):
    """The index of runs that parts name or events rendered."""
    named = table(spark, d, "part").select(F.concat("p_type", F.lit(" & "), "p_brand").alias("run_id"))
    rendered = table(spark, d, "events").select(F.concat(F.lit("<"), "event_type", F.lit(">")).alias("run_id"))
    return markup.render_index(named, rendered)


@query("""SELECT user_id, (epoch_us(max(ts)) - epoch_us(min(ts)) + 500) // 1000 / 1000.0 AS elapsed FROM events GROUP BY 1""")
def elapsed_seconds(spark, d):
    """Seconds between the first and the last event of each user."""
    ends = table(spark, d, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return ends.select("user_id", records.elapsed(F.col("a"), F.col("b")).alias("elapsed"))
