"""Every query with SQL against DuckDB on the smallest tables, and the others for rows."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from leafmill.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return repr(round(v, 6)) if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_against_sql(spark, duck, name):
    got = catalogue.queries()[name](spark, SF)
    cur = duck.execute(catalogue.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(got.columns) == sorted(names)
    want = sorted(tuple(map(plain, r)) for r in cur.fetchall())
    assert sorted(tuple(map(plain, r)) for r in got.select(*(f"`{n}`" for n in names)).collect()) == want


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_runs(spark, name):
    assert catalogue.queries()[name](spark, SF).count() >= 0


def test_math_segments_covers_every_text(spark, tmp_path):
    texts = {1: "no math here", 2: r"so \(x + 1\) and \[y\] end", 3: "costs $a$ each", 4: "open $ only", 5: "", 6: None}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(catalogue.queries()["math_segments"](spark, str(tmp_path)).collect())
    assert {i: "".join(r.segment for r in got if r.doc_id == i) for i in (1, 2, 3, 4)} == {i: texts[i] for i in (1, 2, 3, 4)}
    assert [(r.doc_id, r.segment) for r in got if r.is_math] == [(2, r"\(x + 1\)"), (2, r"\[y\]"), (3, "$a$")]
    assert {r.doc_id for r in got} == {1, 2, 3, 4}


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["source", "n_docs", "n_blocks", "n_closed", "compact_chars"]
    assert df.count() > 0


def test_every_query_has_its_function():
    assert set(catalogue.oracle_sql()) <= set(entry.queries())
    assert set(catalogue.queries()) <= set(entry.queries())
