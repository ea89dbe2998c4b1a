"""The queries of this subpackage: each applies its operator to its whole intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import kit
from .collocations import ORACLE as COLLOCATION_SQL
from .collocations import collocations
from .decontaminate import find_leaks
from .exact_dedup import exact_groups
from .filter_audit import ORACLE as AUDIT_SQL
from .filter_audit import audit_filters
from .html_extract import extract_pages
from .jaccard_join import jaccard_components
from .language_id import identify_language
from .mixing import ORACLE as MIX_SQL
from .mixing import mix_sources
from .quality import classify_quality
from .quotes import build_chats
from .substring_dedup import substring_dedup
from .suffix_dedup import suffix_dedup
from .toxicity import classify_toxicity


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(kit.read(spark, sf_dir, "documents"))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(kit.read(spark, sf_dir, "pages"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(kit.read(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(kit.read(spark, sf_dir, "documents"), kit.read(spark, sf_dir, "labels"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(kit.read(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(kit.read(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(kit.read(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(kit.read(spark, sf_dir, "documents"), kit.read(spark, sf_dir, "benchmark"))


def op9_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_chats(kit.read(spark, sf_dir, "conversations"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(kit.read(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(kit.read(spark, sf_dir, "documents"), kit.read(spark, sf_dir, "labels"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(kit.read(spark, sf_dir, "documents"), kit.read(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(kit.read(spark, sf_dir, "documents"))


EXACT_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g USING (t)
"""


SUBSTRING_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
v AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 19], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d)),
later AS (SELECT doc_id, p FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS r FROM v) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, p + j AS p FROM later, range(0, 20) t(j)),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

#: Bytes as pairs of hexadecimal digits, so that positions count bytes; overlapping blocks of 500 windows keep substr short.
SUFFIX_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, i * 500 AS start, substr(h, 1000 * i + 1, 1398) AS h FROM (SELECT doc_id, h, unnest(range(0, length(h) // 1000 + 1)) AS i FROM d)),
v AS (SELECT doc_id, start + p AS p, md5_number(substr(h, 2 * p + 1, 400)) AS k FROM (SELECT doc_id, start, h, unnest(range(0, length(h) // 2 - 199)) AS p FROM b)),
again AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM v) WHERE n > 1),
spans AS (SELECT doc_id, min(p) AS lo, max(p) + 200 AS hi FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS s FROM (SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200 THEN 0 ELSE 1 END AS fresh FROM again))
  GROUP BY doc_id, s),
cut AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM spans),
part AS (SELECT d.doc_id, count(*) AS n_spans, sum(hi - lo) AS n_removed, string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) || substr(any_value(h), 2 * max(hi) + 1) AS t
  FROM d JOIN cut USING (doc_id) GROUP BY d.doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(t, h))) AS kept_sha256
FROM d LEFT JOIN part USING (doc_id)
"""

JACCARD_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5_number(array_to_string(w[p:p + 3], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.least, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS least FROM reach GROUP BY a) c USING (doc_id)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": EXACT_SQL, "op3_mix_sources": MIX_SQL, "op5_substring_dedup": SUBSTRING_SQL, "op6_suffix_dedup": SUFFIX_SQL, "op7_jaccard_join": JACCARD_SQL,
        "op11_filter_audit": AUDIT_SQL, "op13_collocations": COLLOCATION_SQL,
    }
