"""The registered queries: the library's operators over the driver's tables, each with its SQL.

A query is a function of (spark, sf_dir) named after its key; ``SQL`` holds
what DuckDB must return for it. Queries without SQL need an ordered fold, a
parser or a model client; tests hold them against plain Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import geometry as G
from ..functions import mathtext as M
from ..functions import text as T
from ..operators import align, assets, budget, layout, markup, models, records, tables
from ..streaming import flows

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import papers, records_plan  # noqa: F401  they register themselves

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt by key to as many tasks as the session has shuffle partitions: for work that takes long a row, where a table has few row groups or few bytes."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), key)


LINES = """
lines AS (
  SELECT d.doc_id, d.source, u.pos - 1 AS pos, u.line
  FROM documents d, LATERAL (SELECT unnest(string_split(coalesce(d.text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(d.text, ''), chr(10)), 1) AS pos) u
  WHERE trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '')
"""


# ---------------------------------------------------------------- flattening and labels


@query(f"""WITH {LINES}
SELECT source, count(DISTINCT doc_id) AS n_docs, count(*) AS n_blocks, count(*) FILTER (regexp_matches(line, '[.!?]$')) AS n_closed,
       sum(length(regexp_replace(line, '\\s+', '', 'g')))::BIGINT AS compact_chars
FROM lines GROUP BY source""")
def flatten_summary(spark, d):
    rows = layout.flatten_lines(table(spark, d, "documents"), ["doc_id", "source"], "text")
    return rows.groupBy("source").agg(
        F.count_distinct("doc_id").alias("n_docs"), F.count("*").alias("n_blocks"), F.count_if(F.rlike("line", F.lit("[.!?]$"))).alias("n_closed"), F.sum(F.length(T.compact(F.col("line")))).alias("compact_chars")
    )


@query(f"WITH {LINES} SELECT doc_id, pos::INT AS pos, line FROM lines")
def flatten_blocks(spark, d):
    return layout.flatten_lines(table(spark, d, "documents"), ["doc_id"], "text")


@query(f"""WITH {LINES}
SELECT doc_id, pos::INT AS pos, 'D' || CASE WHEN fig THEN '-P' ELSE '-B' END || printf('%02d', row_number() OVER (PARTITION BY doc_id, fig ORDER BY pos)) AS label
FROM (SELECT *, contains(line, '$') AS fig FROM lines)""")
def label_blocks(spark, d):
    rows = layout.flatten_lines(table(spark, d, "documents"), ["doc_id"], "text")
    return layout.label_blocks(rows, ["doc_id"], [F.col("pos")], F.contains("line", F.lit("$")), F.lit("D")).select("doc_id", "pos", "label")


@query(f"""WITH {LINES}
SELECT doc_id, pos::INT AS pos, try_cast(nullif(regexp_extract(line, '^\\s*(\\d{{1,2}})\\s*[.．、]', 1), '') AS INT) AS number,
       regexp_matches(line, '^\\s*[(（][A-DＡ-Ｄ][)）]') AS is_option, length(regexp_replace(line, '\\s+', '', 'g'))::INT AS compact_chars,
       (row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1)::INT AS ordinal
FROM lines""")
def block_flags(spark, d):
    rows = layout.ordinal(layout.flatten_lines(table(spark, d, "documents"), ["doc_id"], "text"), ["doc_id"], [F.col("pos")])
    return rows.select("doc_id", "pos", T.question_number(F.col("line")).alias("number"), T.is_option(F.col("line")).alias("is_option"), F.length(T.compact(F.col("line"))).alias("compact_chars"), "ordinal")


# ---------------------------------------------------------------- text


@query("""SELECT doc_id, CASE WHEN length(t) <= 220 THEN t ELSE left(t, 219) || '…' END AS excerpt
FROM (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS t FROM documents)""")
def text_excerpt(spark, d):
    return table(spark, d, "documents").select("doc_id", T.excerpt(F.col("text")).alias("excerpt"))


@query(f"""WITH {LINES}
SELECT doc_id, pos::INT AS pos, w::INT AS width, greatest(1, ceil(w / 100.0))::BIGINT AS weight
FROM (SELECT doc_id, pos, length(line) + len(regexp_extract_all(line, '[À-ÿ]')) AS w FROM lines)""")
def display_width(spark, d):
    rows = layout.flatten_lines(table(spark, d, "documents"), ["doc_id"], "text")
    return rows.select("doc_id", "pos", T.display_width(F.col("line"), "[À-ÿ]").alias("width"), T.line_weight(F.col("line"), F.lit(400), "[À-ÿ]").alias("weight"))


_DOLLARS = "length(regexp_replace(text, '\\\\.', '', 'gs')) - length(replace(regexp_replace(text, '\\\\.', '', 'gs'), '$', ''))"


@query(f"SELECT doc_id, ({_DOLLARS})::INT AS dollars, ({_DOLLARS}) % 2 = 1 AS odd FROM documents")
def dollar_balance(spark, d):
    n = T.dollars(F.col("text"))
    return table(spark, d, "documents").select("doc_id", n.alias("dollars"), (n % 2 == 1).alias("odd"))


@query(f"""SELECT doc_id, CASE WHEN ({_DOLLARS}) % 2 = 1
  THEN trim(regexp_replace(regexp_extract(text, '(?s)^(.*)\\$', 1), '\\s+$', '') || ' <ocr_gap01>') ELSE text END AS text FROM documents""")
def truncate_unbalanced(spark, d):
    return table(spark, d, "documents").select("doc_id", T.truncate_unbalanced(F.col("text"), F.lit("<ocr_gap01>")).alias("text"))


@query("""SELECT p_partkey, left(regexp_replace(regexp_replace(p_name || '/' || p_type, '[^\\w.-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g'), 80) AS slug FROM part""")
def slugify(spark, d):
    return table(spark, d, "part").select("p_partkey", T.slug(F.concat_ws("/", "p_name", "p_type")).alias("slug"))


@query("""SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS escaped FROM pages""")
def html_escape(spark, d):
    return table(spark, d, "pages").select("page_id", T.escape_html(F.col("html")).alias("escaped"))


@query("""SELECT page_id, (i - 1)::INT AS index, trim(regexp_replace(regexp_replace(raw[i], '<[^>]+>', '', 'g'), '\\s+', ' ', 'g')) AS text
FROM (SELECT page_id, raw, unnest(range(1, len(raw) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?is)<li\\b[^>]*>(.*?)</li>', 1) AS raw FROM pages))""")
def html_rows(spark, d):
    return markup.elements(table(spark, d, "pages"), ["page_id"], "html", "li")


def segment_sql(source: str, keys: str) -> str:
    """CTEs that cut the column v of a table into text and dollar math (documents hold no backslash): seg (keys, g, m, s)."""
    return rf"""
tok AS (SELECT {keys}, i, t, regexp_full_match(t, '(?s)\$\$.*\$\$|\$[^$]+\$') AS m
  FROM (SELECT {keys}, unnest(x) AS t, generate_subscripts(x, 1) AS i FROM (SELECT {keys}, regexp_extract_all(v, '(?s)\$\$.*?\$\$|\$[^$]+\$|\$\$|\$|[^$]+') AS x FROM {source}))),
run AS (SELECT *, sum(CASE WHEN m OR before THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY i) AS g FROM (SELECT *, lag(m) OVER (PARTITION BY {keys} ORDER BY i) AS before FROM tok)),
seg AS (SELECT {keys}, g, bool_or(m) AS m, string_agg(t, '' ORDER BY i) AS s FROM run GROUP BY {keys}, g)"""


def lint_sql(keys: str) -> str:
    """Reasons of the blocks of seg: what a text outside of dollars must not hold."""
    outside = lambda name, pattern: f"CASE WHEN bool_or(NOT m AND regexp_matches(regexp_replace(s, '<[^>]+>', ' ', 'g'), '{pattern}')) THEN '{name}' END"
    reasons = ", ".join(outside(n, x) for n, x in (("latex_command_outside_math", M.COMMAND), ("math_relation_outside_math", M.RELATION), ("subsup_outside_math", M.SUB_SUP)))
    return f"""SELECT {keys}, concat_ws(',', {reasons}) AS reasons FROM seg GROUP BY {keys} HAVING NOT regexp_full_match(string_agg(s, '' ORDER BY g), '{M.PLACEHOLDER}')"""


@query(f"""WITH src AS (SELECT doc_id, coalesce(text, '') AS v FROM documents), {segment_sql("src", "doc_id")}
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY g) - 1)::INT AS pos, m AS is_math, s AS segment FROM seg""")
def math_segments(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.posexplode(M.segments(F.col("text"))).alias("pos", "s")).select("doc_id", "pos", "s.is_math", "s.segment")


@query(f"""WITH {LINES}, src AS (SELECT 'd' || doc_id AS id, pos, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS v FROM lines), {segment_sql("src", "id, pos")},
found AS ({lint_sql("id, pos")})
SELECT id, pos::INT AS pos, reasons FROM found WHERE reasons <> ''
UNION ALL SELECT 'p' || p_partkey, 0, CASE p_partkey % 6 WHEN 0 THEN 'math_relation_outside_math' WHEN 1 THEN 'left_right_count_mismatch' WHEN 2 THEN 'math_condition_split_across_text_connector' ELSE 'latex_command_outside_math,subsup_outside_math' END
FROM part WHERE p_partkey % 6 < 4""")
def math_lint(spark, d):
    """Lines of documents, and parts written as formulas with and without faults."""
    lines = layout.flatten_lines(table(spark, d, "documents"), ["doc_id"], "text").select(F.concat(F.lit("d"), "doc_id").alias("id"), "pos", "line")
    size, name = F.col("p_size").cast("string"), F.col("p_name")
    forms = [
        F.concat(F.lit("x = "), size, F.lit(" and $y$")), F.concat(F.lit(r"$\left( "), size, F.lit("$")), F.concat(F.lit(r"$x \mid "), size, F.lit("$，使得 $z$")),
        F.concat(F.lit(r"\frac{1}{"), size, F.lit("} a_1")), name, F.concat(F.lit(r"$\left( x_1 < 2 \right)$ "), name),
    ]
    parts = table(spark, d, "part").select(F.concat(F.lit("p"), "p_partkey").alias("id"), F.lit(0).alias("pos"), F.element_at(F.array(*forms), (F.col("p_partkey") % 6 + 1).cast("int")).alias("line"))
    return M.with_lint(lines.unionByName(parts), "line").select("id", "pos", F.array_join("reasons", ",").alias("reasons")).where("reasons <> ''")


@query("""SELECT doc_id, md5(regexp_replace(regexp_replace(replace(text, '$', ''), '\\(\\s*\\)', '', 'g'), '\\s+', '', 'g')) AS fingerprint FROM documents""")
def fingerprint_gate(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(T.canonical(F.col("text")).cast("binary")).alias("fingerprint"))


@query("""SELECT c_custkey, CASE WHEN x IN ('A', 'B', 'C', 'D') THEN '$' || x || '$' ELSE x END AS answer, x AS stripped
FROM (SELECT c_custkey, chr((65 + c_custkey % 6)::INT) AS x FROM customer)""")
def short_answers(spark, d):
    letter = F.chr(65 + F.col("c_custkey") % 6)
    marked = F.concat(F.lit(" ("), letter, F.lit(") "), F.lower(letter))
    return table(spark, d, "customer").select("c_custkey", T.short_answer(F.lower(letter)).alias("a"), F.upper(T.strip_option(marked, letter)).alias("stripped")).select(
        "c_custkey", F.when(F.col("a").startswith("$"), F.col("a")).otherwise(F.upper("a")).alias("answer"), "stripped"
    )


@query("SELECT l_orderkey, l_linenumber, l_partkey, 'A-V' || printf('%02d', l_linenumber) || '-B01' AS label FROM lineitem")
def label_switch(spark, d):
    q = F.format_string("Q-V%02d-B01", "l_linenumber")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", T.relabel(q, "A").alias("label"))


@query("SELECT n_nationkey, 'data:text/plain;base64,' || base64(encode(n_name)) AS uri FROM nation")
def data_uris(spark, d):
    return table(spark, d, "nation").select("n_nationkey", T.data_uri(F.col("n_name").cast("binary"), F.lit("text/plain")).alias("uri"))


# ---------------------------------------------------------------- conversations: ordered operators


@query("""SELECT conv_id, turn, CASE WHEN role = 'system' THEN 'commentary' WHEN turn >= min(turn) FILTER (role = 'assistant') OVER (PARTITION BY conv_id) THEN 'answer' ELSE 'question' END AS page_role
FROM conversations""")
def keyword_roles(spark, d):
    w = Window.partitionBy("conv_id")
    first = F.min(F.when(T.has_any(F.col("role"), ["assistant"]), F.col("turn"))).over(w)
    return table(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("role") == "system", "commentary").when(F.col("turn") >= first, "answer").otherwise("question").alias("page_role"))


@query("""WITH s AS (SELECT conv_id, min(turn) FILTER (role = 'assistant' AND turn > 0) AS stop FROM conversations GROUP BY conv_id)
SELECT c.conv_id, string_agg(c.turn::VARCHAR, ',' ORDER BY c.turn) AS turns FROM conversations c JOIN s USING (conv_id) WHERE s.stop IS NULL OR c.turn < s.stop GROUP BY c.conv_id""")
def take_while_surface(spark, d):
    item = F.struct("turn", F.col("turn").cast("string").alias("label"), (F.col("role") == "assistant").alias("is_marker"))
    listed = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("x"))
    return listed.select("conv_id", F.array_join(align.surface(F.col("x")), ",").alias("turns"))


@query("""SELECT conv_id, turn, lag(role) OVER w AS prev_role, length(lag(text) OVER w)::INT AS prev_chars FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def prev_turn_lookup(spark, d):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, d, "conversations").select("conv_id", "turn", F.lag("role").over(w).alias("prev_role"), F.length(F.lag("text").over(w)).alias("prev_chars"))


@query("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def string_agg_pages(spark, d):
    listed = F.array_sort(F.collect_list(F.struct("turn", "text")))
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(listed, lambda x: x["text"]), "\n").alias("text"))


@query("""SELECT conv_id, string_agg(role, ',' ORDER BY t) AS roles FROM (SELECT conv_id, role, min(turn) AS t FROM conversations GROUP BY conv_id, role) GROUP BY conv_id""")
def ordered_distinct(spark, d):
    listed = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(A.ordered_distinct(F.transform(listed, lambda x: x["role"])), ",").alias("roles"))


@query("""SELECT c.conv_id AS run_id, c.turn AS question_no, string_agg('V01-B' || printf('%02d', b.turn), ',' ORDER BY b.turn) AS labels
FROM conversations c JOIN conversations b ON b.conv_id = c.conv_id AND b.turn BETWEEN c.turn AND c.turn + 1
WHERE c.role = 'user' AND EXISTS (SELECT 1 FROM conversations e WHERE e.conv_id = c.conv_id AND e.turn = c.turn + 1) GROUP BY c.conv_id, c.turn""")
def question_ranges(spark, d):
    turns = table(spark, d, "conversations")
    name = lambda c: F.format_string("V01-B%02d", c)
    blocks = turns.select(F.col("conv_id").alias("run_id"), name(F.col("turn")).alias("label"), F.col("turn").alias("ordinal"), "text")
    ranges = turns.where("role = 'user'").select(
        F.col("conv_id").alias("run_id"), F.col("turn").alias("question_no"), name(F.col("turn")).alias("start_label"), name(F.col("turn") + 1).alias("end_label"), F.array().cast("array<string>").alias("visual_labels")
    )
    return align.labels_in_ranges(ranges, blocks).select("run_id", "question_no", F.array_join("labels", ",").alias("labels")).where("labels <> ''")


@query("""WITH q AS (SELECT conv_id, turn FROM conversations WHERE role = 'user'), a AS (SELECT conv_id, turn - 1 AS turn FROM conversations WHERE role = 'assistant')
SELECT q.conv_id AS run_id, q.turn AS question_no, CASE WHEN a.turn IS NULL THEN 'missing' ELSE 'found' END AS answer_status FROM q LEFT JOIN a USING (conv_id, turn)""")
def question_alignment(spark, d):
    turns = table(spark, d, "conversations")
    side = lambda role, shift: turns.where(F.col("role") == role).select(
        F.col("conv_id").alias("run_id"), (F.col("turn") - shift).alias("question_no"), F.array(F.format_string("B%02d", "turn")).alias("labels"), F.lit(True).alias("valid"), F.col("turn").alias("ordinal")
    )
    return align.align(side("user", 0), side("assistant", 1)).select("run_id", "question_no", "answer_status")


@query("""SELECT conv_id, sum(ceil(length(text) / 4.0))::BIGINT AS text_tokens, count(*) AS message_count,
       (sum(ceil(length(text) / 4.0)) + count(*) - 1 + 2048)::BIGINT AS total_tokens FROM conversations GROUP BY conv_id""")
def token_estimate(spark, d):
    return budget.estimates(table(spark, d, "conversations"), "conv_id", "text", "turn")


@query()
def token_estimate_exact(spark, d):
    """Subword tokens of whole conversations."""
    return budget.token_estimates(table(spark, d, "conversations"), "conv_id", "role", "text")


# ---------------------------------------------------------------- documents and labels


@query("""SELECT bucket, string_agg(n::VARCHAR, ',' ORDER BY n) AS missing FROM (
  SELECT b.bucket, unnest(generate_series(b.lo, b.hi)) AS n FROM (SELECT doc_id // 100 AS bucket, min(doc_id) AS lo, max(doc_id) AS hi FROM labels GROUP BY 1) b) x
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = x.n) GROUP BY bucket""")
def missing_numbers(spark, d):
    rows = table(spark, d, "labels").groupBy(F.floor(F.col("doc_id") / 100).alias("bucket")).agg(F.collect_set("doc_id").alias("seen"))
    return rows.select("bucket", F.array_join(A.missing_between(F.col("seen")), ",").alias("missing")).where("missing <> ''")


@query("SELECT md5(text) AS text_md5, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY text")
def first_wins_dedupe(spark, d):
    return tables.first_wins(table(spark, d, "documents").select("text", "doc_id", "source"), ["text"], ["doc_id"]).select(F.md5(F.col("text").cast("binary")).alias("text_md5"), "doc_id", "source")


@query("SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, 0) AS toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def full_text_join(spark, d):
    j = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return j.select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_answers_anti(spark, d):
    return align.missing(table(spark, d, "documents"), table(spark, d, "labels"), ["doc_id"])


@query("""SELECT doc_id, concat_ws(',', CASE WHEN l.doc_id IS NULL THEN 'no_label' END, CASE WHEN contains(text, chr(10)) THEN 'multi_line' END,
  CASE WHEN length(text) < 100 THEN 'short' END, CASE WHEN lang NOT IN ('en', 'de') THEN 'lang' END, CASE WHEN toxic = 1 THEN 'toxic' END) AS violations
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def schema_violations(spark, d):
    j = table(spark, d, "documents").join(table(spark, d, "labels").withColumn("labelled", F.lit(True)), "doc_id", "left")
    found = records.rules(
        {"no_label": F.col("labelled").isNull(), "multi_line": F.contains("text", F.lit("\n")), "short": F.length("text") < 100, "lang": ~F.col("lang").isin("en", "de"), "toxic": F.col("toxic") == 1}
    )
    return j.select("doc_id", F.array_join(found, ",").alias("violations"))


def _records(spark, d) -> DataFrame:
    """Documents as question records: first lines as stem, the rest as analysis, a quarter of them choices."""
    docs, lines = table(spark, d, "documents"), F.split(F.coalesce("text", F.lit("")), "\n")
    none = F.array().cast("array<string>")
    return docs.select(
        F.col("source").alias("run_id"), F.col("doc_id").cast("int").alias("question_no"), F.lit(records.SCHEMA_VERSION).alias("schema_version"),
        F.element_at(F.array(*(F.lit(t) for t in records.QUESTION_TYPES)), (F.pmod("doc_id", F.lit(4)) + 1).cast("int")).alias("question_type"),
        F.filter(F.slice(lines, 1, 2), lambda x: T.strip(x) != "").alias("stem_latex"), F.struct(*(none.alias(k) for k in records.LETTERS)).alias("options_latex"), none.alias("answer_latex"),
        F.filter(F.slice(lines, 3, 1 << 30), lambda x: T.strip(x) != "").alias("analysis_latex"), none.alias("rubric_latex"), F.array().cast(f"array<{records.ISSUE}>").alias("issues"), F.col("text").alias("question_ocr"),
    )


@query("""SELECT source AS run_id, doc_id::INT AS question_no FROM documents WHERE doc_id % 4 IN (1, 2)""")
def record_violations(spark, d):
    r = _records(spark, d)
    whole = F.struct(*(F.col(k) for k in records.RECORD_KEYS))
    return r.where(F.array_contains(records.schema_violations(whole), "choice_without_options")).select("run_id", "question_no")


@query(f"""WITH {LINES}, r AS (SELECT source AS run_id, doc_id::INT AS question_no, pos, CASE WHEN pos < 2 THEN 'stem_latex' ELSE 'analysis_latex' END AS field, line FROM lines),
src AS (SELECT run_id, question_no, field, row_number() OVER (PARTITION BY run_id, question_no, field ORDER BY pos) AS index, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS v FROM r), {segment_sql("src", "run_id, question_no, field, index")},
found AS ({lint_sql("run_id, question_no, field, index")}),
stem AS (SELECT source AS run_id, doc_id::INT AS question_no, coalesce((SELECT string_agg(line, chr(10) ORDER BY pos) FROM r WHERE r.question_no = documents.doc_id AND field = 'stem_latex'), '') AS v FROM documents WHERE doc_id % 4 IN (1, 2)),
n AS (SELECT *, len(regexp_extract_all(v, '(?i)<choice_blank>|（\\s*）|\\(\\s*\\)')) AS n FROM stem)
SELECT run_id, question_no, field, NULL::VARCHAR AS option_key, index::INT AS index, reasons FROM found WHERE reasons <> ''
UNION ALL SELECT run_id, question_no, 'stem_latex', NULL, 0, CASE WHEN n = 0 THEN 'missing_choice_blank' ELSE 'duplicate_choice_blank' END FROM n WHERE n <> 1""")
def record_audit(spark, d):
    return records.audit(_records(spark, d)).select("run_id", "question_no", "field", "option_key", "index", F.array_join("reasons", ",").alias("reasons"))


@query(r"""WITH x AS (SELECT p_partkey, p_name AS n, p_size AS z, p_partkey % 4 AS k, CASE p_partkey % 4 WHEN 0 THEN '<blank>' WHEN 3 THEN '' ELSE '<choice_blank>' END AS b FROM part)
SELECT p_partkey, CASE WHEN k = 3 THEN n || ' ____ | $<blank> + ' || z || '$ is' ELSE n || ' ' || b || ' | $+ ' || z || '$ ' || b || ' is' END || ' | see <table><tr></tr></table>' AS stem,
  '$x < ' || z || '$' AS a, '$y>1 \text{ 或 } ' || n || '$' AS b, '$C$ | ' || n || '。' AS answer, n AS analysis, 0 AS rubrics,
  'unknown_table_placeholder_removed,' || CASE WHEN k = 3 THEN 'blank_token_inside_math' ELSE 'blank_token_moved_out_of_math' END AS issues FROM x""")
def normalised_records(spark, d):
    """Parts as model records: numbers, blanks in and out of formulas, option math, tables and visual placeholders."""
    n, z = F.col("p_name"), F.col("p_size").cast("string")
    block = lambda *x: F.concat(*(F.lit(c) if isinstance(c, str) else c for c in x))
    none = F.array().cast("array<string>")
    marks = [("table", "Q-B1", "<table01>", "<table><tr></tr></table>"), ("image", "Q-B2", "<image01>", None)]
    raw = spread(table(spark, d, "part").select("p_partkey", "p_name", "p_size"), "p_partkey").select(
        "p_partkey", F.col("p_partkey").alias("question_no"), F.element_at(F.array(*(F.lit(t) for t in records.QUESTION_TYPES)), (F.col("p_partkey") % 4 + 1).cast("int")).alias("question_type"),
        F.array(block(F.col("p_partkey").cast("string"), ". ", n, " ____"), block("$<blank> + ", z, "$ is"), F.lit("see <table01> <table09>")).alias("stem_latex"),
        F.struct(F.array(block("(A) x < ", z)).alias("A"), F.array(block("B. y>1 或 ", n)).alias("B"), none.alias("C"), none.alias("D")).alias("options_latex"),
        F.array(F.lit("C"), block(n, "。")).alias("answer_latex"), F.array(block("<image01> ", n)).alias("analysis_latex"), F.array(F.lit("<chart2>")).alias("rubric_latex"), F.array().cast(f"array<{records.ISSUE}>").alias("issues"),
        F.array(*(F.struct(*(F.lit(v).cast("string").alias(k) for k, v in zip(("kind", "label", "placeholder", "html"), m, strict=True))) for m in marks)).alias("placeholders"),
        F.col("p_partkey").alias("source_no"), F.lit("found").alias("answer_status"),
    )
    joined = lambda c: F.array_join(c, " | ")
    return records.normalise(raw).select(
        "p_partkey", joined("stem_latex").alias("stem"), joined("options_latex.A").alias("a"), joined("options_latex.B").alias("b"), joined("answer_latex").alias("answer"), joined("analysis_latex").alias("analysis"),
        F.size("rubric_latex").alias("rubrics"), F.array_join(F.transform("issues", lambda i: i["type"]), ",").alias("issues"),
    )


@query()
def lpt_assign(spark, d):
    docs = table(spark, d, "documents").select("source", "doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("weight"))
    return tables.longest_first(docs, ["source"], "doc_id", "weight", 4)


# ---------------------------------------------------------------- relational: joins, sets, merges


@query("""SELECT o.o_orderkey, CASE WHEN l.n IS NULL THEN 'missing' ELSE 'found' END AS status, coalesce(l.n, 0) AS lines, coalesce(l.numbers, '') AS numbers
FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n, string_agg(l_linenumber::VARCHAR, ',' ORDER BY l_linenumber) AS numbers FROM lineitem GROUP BY 1) l ON o.o_orderkey = l.l_orderkey""")
def alignment_left(spark, d):
    li = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("x"))
    j = table(spark, d, "orders").select("o_orderkey").join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return j.select("o_orderkey", F.when(F.col("x").isNull(), "missing").otherwise("found").alias("status"), F.coalesce(F.size("x"), F.lit(0)).cast("long").alias("lines"), F.coalesce(F.array_join("x", ","), F.lit("")).alias("numbers"))


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def orders_without_lines(spark, d):
    return align.missing(table(spark, d, "orders"), table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"])


@query("SELECT p_partkey, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')")
def semi_membership(spark, d):
    used = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, d, "part").join(used, "p_partkey", "left_semi").select("p_partkey", "p_brand")


@query("""SELECT o_orderkey, b AS band FROM (SELECT o_orderkey, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) AS day FROM orders) o
JOIN (SELECT b, 8766 + b * 90 AS lo, 8766 + b * 90 + 119 AS hi FROM range(0, 40) t(b)) r ON o.day BETWEEN r.lo AND r.hi""")
def range_join(spark, d):
    days = table(spark, d, "orders").select("o_orderkey", F.date_diff("o_orderdate", F.lit("1970-01-01").cast("date")).alias("day"))
    bands = spark.range(40).select(F.col("id").alias("band"), (8766 + F.col("id") * 90).alias("lo"), (8766 + F.col("id") * 90 + 119).alias("hi"))
    return align.range_join(days, bands, "day", "lo", "hi", 60).select("o_orderkey", "band")


@query("""WITH i AS (SELECT p_brand, p_size, min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part GROUP BY 1, 2),
x AS (SELECT p.p_brand, p.p_partkey, p.p_retailprice, i.p_size AS band, CASE WHEN p.p_retailprice BETWEEN i.lo AND i.hi THEN 0 ELSE least(abs(p.p_retailprice - i.lo), abs(p.p_retailprice - i.hi)) END AS distance
  FROM part p JOIN i USING (p_brand)),
r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY distance, band) AS rank FROM x)
SELECT p_partkey, band, round(distance, 4) AS distance, rank::INT AS rank FROM r WHERE rank <= 6""")
def nearest_interval_topk(spark, d):
    part = table(spark, d, "part")
    bands = part.groupBy("p_brand", F.col("p_size").alias("band")).agg(F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi"))
    near = align.nearest_intervals(part.select("p_brand", "p_partkey", "p_retailprice"), bands, ["p_brand"], "p_retailprice", "lo", "hi", "band")
    return near.select("p_partkey", "band", F.round("distance", 4).alias("distance"), "rank")


@query("""SELECT s_suppkey, s_name, CASE WHEN ok THEN round(s_acctbal + 100, 2) ELSE s_acctbal END AS s_acctbal, ok AS merged
FROM (SELECT *, s_nationkey % 2 = 0 AND s_suppkey % 3 <> 0 AS ok FROM supplier)""")
def merge_conditional(spark, d):
    base = table(spark, d, "supplier")
    fixed = base.where("s_nationkey % 2 = 0").select(
        "s_suppkey", F.round(F.col("s_acctbal") + 100, 2).alias("s_acctbal"), F.when(F.col("s_suppkey") % 3 == 0, "rejected").otherwise("fixed_by_rule").alias("status"), F.lit(0).alias("left"), F.lit(True).alias("same")
    )
    ok = F.size(tables.reject_reasons(F.col("status"), F.col("left"), F.col("same"))) == 0
    return tables.merge_where(base, fixed, "s_suppkey", ["s_acctbal"], ok).select("s_suppkey", "s_name", "s_acctbal", "merged")


@query("""SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 11 = 0 THEN 'c_acctbal' END, CASE WHEN c_custkey % 7 = 0 THEN 'c_mktsegment' END) AS changed
FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 11 = 0""")
def change_capture(spark, d):
    old = table(spark, d, "customer")
    new = old.withColumns({"c_acctbal": F.when(F.col("c_custkey") % 11 != 0, F.col("c_acctbal")), "c_mktsegment": F.when(F.col("c_custkey") % 7 == 0, F.lit("CHANGED")).otherwise(F.col("c_mktsegment"))})
    return tables.changed_fields(old, new, "c_custkey", ["c_acctbal", "c_mktsegment"]).where("size(changed) > 0").select("c_custkey", F.array_join("changed", ",").alias("changed"))


@query("""WITH f AS (SELECT o_orderkey, count(*) AS found FROM (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 1 UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 15 = 0) GROUP BY 1)
SELECT o.o_orderkey, coalesce(f.found, 0) AS found, 1::BIGINT AS wanted, CASE WHEN f.found > 1 THEN 'duplicate' ELSE 'missing' END AS problem
FROM orders o LEFT JOIN f USING (o_orderkey) WHERE coalesce(f.found, 0) <> 1""")
def union_complete_check(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    return tables.union_complete([o.where("o_orderkey % 3 = 0"), o.where("o_orderkey % 3 = 1"), o.where("o_orderkey % 15 = 0")], o, "o_orderkey")


@query("""WITH e AS (SELECT l_orderkey, arg_max(l_returnflag, (l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity)) AS t, arg_max(l_discount, (l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity)) AS c FROM lineitem GROUP BY 1)
SELECT o.o_orderkey, CASE WHEN e.t IS NULL THEN o.o_orderstatus WHEN e.t IN ('A') THEN '$' || e.t || '$' ELSE e.t END AS excerpt, greatest(0.05, coalesce(e.c, 0.05)) AS confidence, CASE WHEN e.t IS NULL THEN 'missing' ELSE 'found' END AS status
FROM orders o LEFT JOIN e ON e.l_orderkey = o.o_orderkey""")
def answer_upsert(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("excerpt"), F.lit(0.05).alias("confidence"), F.lit("missing").alias("status"))
    entries = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity").alias("ordinal"), F.col("l_returnflag").alias("answer_text"), F.col("l_discount").alias("confidence"))
    return assets.upsert_spans(rows, entries, ["o_orderkey"])


@query("""SELECT l_partkey, string_agg(l_suppkey::VARCHAR, ',' ORDER BY l_suppkey) AS candidates FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag IN ('A', 'R')) GROUP BY 1""")
def candidate_sets(spark, d):
    li = table(spark, d, "lineitem")
    c = align.candidate_sets(li.where("l_returnflag = 'A'"), li.where("l_returnflag = 'R'"), "l_partkey", "l_suppkey")
    return c.select("l_partkey", F.array_join("candidates", ",").alias("candidates"))


@query("SELECT c_nationkey AS nation, 'customer' AS side FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier) UNION ALL SELECT s_nationkey, 'supplier' FROM (SELECT s_nationkey FROM supplier EXCEPT SELECT c_nationkey FROM customer) UNION ALL SELECT c_nationkey, 'both' FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier)")
def nation_sets(spark, d):
    c, s = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"))
    tag = lambda df, side: df.withColumn("side", F.lit(side))
    return tag(c.subtract(s), "customer").unionByName(tag(s.subtract(c), "supplier")).unionByName(tag(c.intersect(s), "both"))


@query("""WITH l AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), o AS (SELECT o_orderkey AS k, o_custkey FROM orders WHERE o_orderstatus = 'F')
SELECT coalesce(l.k, o.k) AS order_key, l.n AS returned, o.o_custkey AS customer FROM l FULL JOIN o ON l.k = o.k""")
def full_reconcile(spark, d):
    li = table(spark, d, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("order_key")).agg(F.count("*").alias("returned"))
    o = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer"))
    return li.join(o, "order_key", "full")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max_by(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id")
def last_wins_index(spark, d):
    return tables.last_wins(table(spark, d, "events").select("user_id", "event_type", "event_id", "ts"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


# ---------------------------------------------------------------- aggregates


@query("""SELECT 'event_type' AS field, event_type AS value, count(*) AS n FROM events GROUP BY 2 UNION ALL
SELECT 'severity', CASE WHEN value > 100 THEN 'error' WHEN value > 50 THEN 'warning' ELSE 'info' END, count(*) FROM events GROUP BY 2""")
def type_severity_counts(spark, d):
    e = table(spark, d, "events").withColumn("severity", F.when(F.col("value") > 100, "error").when(F.col("value") > 50, "warning").otherwise("info")).select("event_type", "severity")
    return tables.group_counts(e, ["event_type", "severity"])


@query("""SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'view') AS "view", count(*) FILTER (event_type = 'refund') AS refund, count(*) FILTER (event_type NOT IN ('click', 'view', 'refund')) AS other FROM events GROUP BY user_id""")
def dense_pivot_counts(spark, d):
    return tables.dense_counts(table(spark, d, "events"), ["user_id"], "event_type", ["click", "view", "refund"], other="other")


@query("""SELECT l_suppkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS returned, count(*) FILTER (l_discount > 0.05) AS discounted, sum(l_linenumber)::BIGINT AS numbers, coalesce(max(l_extendedprice), 0.0) AS top_price FROM lineitem GROUP BY 1""")
def conditional_summary(spark, d):
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.count_if(F.col("l_discount") > 0.05).alias("discounted"),
        F.sum("l_linenumber").alias("numbers"), F.coalesce(F.max("l_extendedprice"), F.lit(0.0)).alias("top_price"),
    )


@query("""SELECT l_orderkey, greatest(0, floor(min(l_quantity)) - 8)::BIGINT AS x1, greatest(0, floor(min(l_extendedprice / 100)) - 8)::BIGINT AS y1,
  least(1000, ceil(max(l_quantity + 10)) + 8)::BIGINT AS x2, least(1000, ceil(max(l_extendedprice / 100 + 10)) + 8)::BIGINT AS y2 FROM lineitem GROUP BY 1
HAVING least(1000, ceil(max(l_extendedprice / 100 + 10)) + 8) > greatest(0, floor(min(l_extendedprice / 100)) - 8)""")
def bbox_union(spark, d):
    x, y = F.col("l_quantity"), F.col("l_extendedprice") / 100
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(G.union_box(x, y, x + 10, y + 10, 8, 1000, 1000).alias("b")).where("b is not null").select("l_orderkey", "b.*")


@query("""SELECT grouping_id(n_regionkey, o_orderstatus)::BIGINT AS level, n_regionkey, o_orderstatus, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY CUBE (n_regionkey, o_orderstatus)""")
def grouping_sets(spark, d):
    j = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.cube("n_regionkey", "o_orderstatus").agg(F.grouping_id().cast("long").alias("level"), F.count("*").alias("n"))


@query("SELECT event_type AS bucket, sum(floor(value))::BIGINT AS used, min(epoch_us(ts)) AS oldest FROM events GROUP BY 1")
def reservation_usage(spark, d):
    return budget.usage(table(spark, d, "events").select(F.col("event_type").alias("bucket"), F.floor("value").alias("tokens"), F.unix_micros(F.col("ts").cast("timestamp")).alias("ts")))


# ---------------------------------------------------------------- windows, sorts, top-k


@query("""WITH e AS (SELECT date_trunc('month', o_orderdate) AS m, o_orderdate::DATE AS day, max(o_totalprice) AS extent FROM orders GROUP BY 1, 2)
SELECT strftime(day, '%Y-%m-%d') AS day, round(coalesce(sum(extent + 80) OVER (PARTITION BY m ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 2) AS page_offset FROM e""")
def page_offsets(spark, d):
    e = table(spark, d, "orders").groupBy(F.date_trunc("month", "o_orderdate").alias("m"), F.to_date("o_orderdate").alias("day")).agg(F.max("o_totalprice").alias("extent"))
    return layout.offsets(e, ["m"], [F.col("day")], "extent", 80).select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.round("offset", 2).alias("page_offset"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(CASE WHEN n > 1 THEN 1000 * coalesce(before, 0) / total ELSE 0 END, 4) AS y1, round(CASE WHEN n > 1 THEN 1000 * (coalesce(before, 0) + l_quantity) / total ELSE 1000 END, 4) AS y2
FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n, sum(l_quantity) OVER (PARTITION BY l_orderkey) AS total,
  sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM lineitem)""")
def proportional_split(spark, d):
    li = table(spark, d, "lineitem").withColumns({"line": F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"), "top": F.lit(0.0), "bottom": F.lit(1000.0)})
    s = layout.split_lines(li, ["l_orderkey"], "line", "l_quantity", "top", "bottom")
    return s.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("y1", 4).alias("y1"), F.round("y2", 4).alias("y2"))


@query("""SELECT p_partkey, (row_number() OVER (PARTITION BY p_type ORDER BY coalesce(nullif(p_size, 0), 1000000), coalesce(nullif(p_partkey % 10, 0), 1000000), p_name, p_partkey) - 1)::INT AS ordinal FROM part""")
def multi_key_sort_rank(spark, d):
    order = [*layout.label_order(F.col("p_size"), F.col("p_partkey") % 10, F.col("p_name")), F.col("p_partkey")]
    return layout.ordinal(table(spark, d, "part"), ["p_type"], order).select("p_partkey", "ordinal")


@query("""SELECT p_partkey, (row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey % 3 = 0, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_partkey % 7 END, p_retailprice, p_size, p_partkey) - 1)::INT AS ordinal FROM part""")
def reading_order_rank(spark, d):
    order = layout.reading_order(F.when(F.col("p_partkey") % 3 == 0, F.lit("x")).otherwise((F.col("p_partkey") % 7).cast("string")))
    box = F.array(F.col("p_size").cast("double"), F.col("p_retailprice"))
    return layout.ordinal(table(spark, d, "part"), ["p_brand"], layout.block_order(F.col("p_size"), order, box, F.col("p_partkey"))).select("p_partkey", "ordinal")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN n = 4 THEN 'option_figure' ELSE 'stem_figure' END AS role, CASE WHEN n = 4 THEN chr((64 + r)::INT) END AS option_label
FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, round_even(l_partkey / 80.0, 0), l_extendedprice) AS r FROM lineitem)""")
def option_mode(spark, d):
    li = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("at"), F.lit("image").alias("type"), F.lit("").alias("figure_id"),
        F.col("l_linenumber").alias("page"), F.col("l_partkey").cast("double").alias("y"), F.col("l_extendedprice").alias("x"),
    ).withColumn("label", F.to_json("at"))
    got = assets.rule_assets(li, ["order"]).withColumn("at", F.from_json("label", "l_linenumber int, l_partkey long, l_suppkey long"))
    return got.select(F.col("order").alias("l_orderkey"), "at.*", "role", "option_label")


@query("""SELECT c_custkey, 'c_name' AS field, 1 AS index, c_name AS value FROM customer WHERE c_name IS NOT NULL UNION ALL SELECT c_custkey, 'c_mktsegment', 2, c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL""")
def unpivot_fields(spark, d):
    return tables.unpivot(table(spark, d, "customer"), ["c_custkey"], ["c_name", "c_mktsegment"])


@query("""SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN event_type ELSE 'noise' END AS role, greatest(0.0, least(1.0, coalesce(try_cast(props->>'$.k' AS DOUBLE), 0.0) / 50)) AS confidence FROM events""")
def role_normalise(spark, d):
    k = F.get_json_object("props", "$.k").try_cast("double") / 50
    return table(spark, d, "events").select("event_id", F.when(F.col("event_type").isin("click", "view"), F.col("event_type")).otherwise("noise").alias("role"), G.confidence(k.cast("string")).alias("confidence"))


@query("SELECT p_partkey, ((row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) % 3)::INT AS bin FROM part")
def round_robin(spark, d):
    return tables.round_robin(table(spark, d, "part"), [F.col("p_partkey")], 3, ["p_brand"]).select("p_partkey", "bin")


@query("""SELECT n_nationkey, i::INT AS bin, (greatest(1, n_nationkey // 3) + CASE WHEN n_nationkey >= 3 AND i < n_nationkey % 3 THEN 1 ELSE 0 END)::INT AS workers FROM nation, range(3) t(i)""")
def worker_counts(spark, d):
    return table(spark, d, "nation").select("n_nationkey", F.posexplode(tables.distribute(F.col("n_nationkey"), 3)).alias("bin", "workers"))


@query("""SELECT event_id, sum(floor(value)::BIGINT) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 3600 SECONDS PRECEDING AND CURRENT ROW)::BIGINT AS used FROM events""")
def rolling_usage(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", "ts", F.floor("value").alias("tokens"))
    return budget.trailing_usage(e, ["event_type"], "ts", "tokens", 3600).select("event_id", "used")


@query()
def tpm_admission(spark, d):
    return budget.admit(table(spark, d, "events").withColumns({"ts": F.col("ts").cast("timestamp"), "tokens": F.floor("value")}), "event_type", "ts", "tokens", "event_id", 400)


# ---------------------------------------------------------------- streaming windows, in batch


@query("SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n, sum(floor(value))::BIGINT AS total FROM events GROUP BY 1, 2")
def tumbling(spark, d):
    return _starts(flows.windowed(_events(spark, d), "ts", ["event_type"], "1 hour"))


@query("""SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n, sum(floor(value))::BIGINT AS total
FROM (SELECT *, unnest([time_bucket(INTERVAL 30 MINUTES, ts), time_bucket(INTERVAL 30 MINUTES, ts) - INTERVAL 30 MINUTES]) AS s FROM events) GROUP BY 1, 2""")
def sliding(spark, d):
    return _starts(flows.windowed(_events(spark, d), "ts", ["event_type"], "1 hour", "30 minutes"))


@query("""WITH g AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, epoch_us(min(ts)) AS session_start, epoch_us(max(ts) + INTERVAL 30 MINUTES) AS session_end, count(*) AS n FROM s GROUP BY user_id, k""")
def session(spark, d):
    s = flows.sessions(_events(spark, d), "ts", ["user_id"], "30 minutes")
    return s.select("user_id", F.unix_micros("session_start").alias("session_start"), F.unix_micros("session_end").alias("session_end"), "n")


@query("SELECT count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events)")
def stream_dedupe(spark, d):
    return flows.deduplicated(_events(spark, d), ["user_id", "event_type"], "ts").agg(F.count("*").alias("n"))


def _events(spark, d) -> DataFrame:
    return table(spark, d, "events").withColumns({"ts": F.col("ts").cast("timestamp"), "value": F.floor("value")})


def _starts(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))
