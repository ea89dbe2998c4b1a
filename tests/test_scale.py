"""Plans and memory that must not grow with a group, and results that stay as they were."""

import pathlib
import random
import tracemalloc

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from leafmill.llm import collocations, kit
from leafmill.operators import align, budget, nearest
from leafmill.plans import catalogue


def test_nearest_plan_stays_small(spark, monkeypatch):
    monkeypatch.setattr(nearest, "CELL_ROWS", 1)
    rng = random.Random(3)
    rows = [("a", i, float(x := rng.randrange(10_000)), float(x + 30)) for i in range(400)]
    both = spark.createDataFrame(rows, "key string, name int, lo double, hi double")
    got = nearest.nearest_groups(both, both.withColumn("g", F.col("name") % 20), ["key"], "name", ("lo", "hi"), "g", ("lo", "hi"), 3)
    # The list of cuts stood in every branch of the plan, which the driver holds as text.
    assert len(got._jdf.queryExecution().toString()) < 200_000
    assert got.count() == 400 * 3


def test_wide_spans_list_no_cells(spark, monkeypatch):
    """A span was a row for each cell it reaches over, on either side; also a query of two spans, and the join of answers that are not few."""
    monkeypatch.setattr(nearest, "CELL_ROWS", 2)
    rng = random.Random(5)

    def rows(n):
        return [(key, i % (n - 9), float(x := rng.randrange(3000)), float(x + rng.choice((0, 5, 900, 2800)))) for key in ("a", "b") for i in range(n)]

    queries, items = rows(70), [(key, g % 23, lo, hi) for key, g, lo, hi in rows(120)]
    q, t = (spark.createDataFrame(r, "key string, name int, lo double, hi double") for r in (queries, items))
    want = []
    for key, name in {r[:2] for r in queries}:
        best = {}
        for lo, hi in (r[2:] for r in queries if r[:2] == (key, name)):
            for _, g, low, high in (i for i in items if i[0] == key):
                best[g] = min(best.get(g, 1e9), max(low - hi, lo - high, 0.0))
        want += [(key, name, g, d, i + 1) for i, (d, g) in enumerate(sorted((d, g) for g, d in best.items())[:4])]
    for limit in (48 << 20, 0):
        monkeypatch.setattr(kit, "BROADCAST_BYTES", limit)
        got = nearest.nearest_groups(q, t.withColumnRenamed("name", "g"), ["key"], "name", ("lo", "hi"), "g", ("lo", "hi"), 4)
        assert sorted(tuple(r) for r in got.select("key", "name", "g", "distance", "rank").collect()) == sorted(want)
    asked = []
    monkeypatch.setattr(nearest, "save", lambda df, name: asked.append((name, df._jdf.queryExecution().toString())) or kit.save(df, name))
    nearest.nearest_groups(q, t.withColumnRenamed("name", "g"), ["key"], "name", ("lo", "hi"), "g", ("lo", "hi"), 4)
    assert "nearest-best" in dict(asked) and not any("sequence(" in plan for _, plan in asked)


def test_admission_takes_a_bucket_batch_by_batch(spark):
    """Batches of five rows: a bucket goes on from batch to batch, the next one starts anew, and a request without a time comes last."""
    rows = [(b, i, float(i // 3 * 7) if i < 40 else None, i % 9 * 60) for b in ("x", "y", None) for i in range(41)]
    table = spark.createDataFrame(rows, "b string, id long, at double, n long").withColumn("ts", F.timestamp_micros((F.col("at") * 1_000_000).cast("long")))
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        out = budget.admit(table, "b", "ts", "n", "id", 400)
        assert "MapInArrow" in out._jdf.queryExecution().toString()
        got = {(r.bucket, r.ident): (r.admitted, r.waited, r.reserved) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    want = {}
    for b in ("x", "y", None):
        gate, clock = budget.Limiter(400), 0.0
        for _, i, t, n in (r for r in rows if r[0] == b):
            clock, _, size = gate.acquire(clock if t is None else max(clock, t), n)
            want[b, i] = clock, None if t is None else round(clock - t, 6), size
    assert got == want


def test_shards_take_few_bytes_a_word():
    rng, n = np.random.default_rng(1), 1 << 16
    ids, piece = rng.integers(0, 5000, n), np.sort(rng.integers(0, n // 8, n))
    tracemalloc.start()
    try:
        order, lcp = collocations.suffix_array(ids, piece, 3)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 80 * n
    assert sorted(order.tolist()) == list(range(n)) and 1 <= lcp.max() <= 3


@pytest.mark.parametrize("name", ["normalised_records", "html_tables"])
def test_long_work_is_dealt_over_tasks(spark, name):
    """A table of one row group must not leave the expressions or the parser to one task."""
    plan = catalogue.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_chunk_tables_have_small_row_groups(spark):
    """A task's chunks were one row group, sorted in memory first, and read again as one batch."""

    def chunks(batches):
        list(batches)
        ids, rng = kit.chunk_ids(), np.random.default_rng(2)
        for i in range(60):
            kind = "message" if i % 3 else "state"
            yield kit.routed(kind, [i], next(ids), [kit.pack((i, rng.bytes(1 << 20)))])

    table = kit.save_chunks(spark.range(1, numPartitions=1).mapInArrow(chunks, kit.ROUTED), "wide", 3)
    files = list(pathlib.Path(table.leafmill_path.removeprefix("file:")).rglob("*.parquet"))
    groups = [pq.ParquetFile(f).metadata.row_group(g).total_byte_size for f in files for g in range(pq.ParquetFile(f).metadata.num_row_groups)]
    assert len(files) == 2 and sum(groups) > 60 << 20 and max(groups) < 12 << 20
    got = {r.owner: kit.unpack(r.payload) for r in table.collect()}
    assert all(got[i][0] == i and len(got[i][1]) == 1 << 20 for i in range(60))


def test_pairs_of_one_key_are_dealt_over_tasks(spark, tmp_path):
    """Parts of one brand, whose pairs were one task's, in arrays shorter than the side; a null brand has no pairs."""
    part = spark.createDataFrame([(i, "b" if i % 7 else None, i % 9, float(i)) for i in range(400)], "p_partkey long, p_brand string, p_size int, p_retailprice double")
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    got = catalogue.queries()["reading_distances"](spark, str(tmp_path)).select("p_partkey", "other", F.spark_partition_id().alias("task")).collect()
    want = sorted((a, b) for a in range(0, 400, 50) for b in range(400) if a % 7 and b % 7)
    assert sorted((r.p_partkey, r.other) for r in got) == want and len({r.task for r in got}) > 1
    left = part.select("p_brand", "p_partkey").where("p_partkey % 50 = 0")
    pairs = align.key_pairs(left, part.select("p_brand", F.col("p_partkey").alias("other")), "p_brand", block=2)
    assert sorted((r.p_partkey, r.other) for r in pairs.collect()) == want
    assert align.key_pairs(left.limit(0), part.select("p_brand", F.col("p_partkey").alias("other")), "p_brand").count() == 0


def test_pairs_write_the_other_side_once(spark, monkeypatch):
    """Each shuffle partition was sent a copy of the left side; few rows are broadcast now, many are still copied, to the same pairs."""
    both = spark.createDataFrame([("ab"[i % 2], i, i % 9) for i in range(300)] + [(None, 300, 1)], "key string, name int, size int")
    left, right = both.where("name % 10 < 2").select("key", "size", "name"), both.select("key", F.col("size").alias("page"), F.col("name").alias("other"))
    want = sorted((a, a % 9, b, b % 9) for a in range(300) if a % 10 < 2 for b in range(300) if a % 2 == b % 2)
    for limit, copied in ((48 << 20, False), (0, True)):
        monkeypatch.setattr(kit, "BROADCAST_BYTES", limit)
        pairs = align.key_pairs(left, right, "key", block=512)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan, "sequence(0, 3" in pairs._jdf.queryExecution().toString()) == (not copied, copied)
        assert sorted((r.name, r["size"], r.other, r.page) for r in pairs.collect()) == want


def test_phrases_leave_shards_once_with_their_totals(spark):
    """Every shard sent each of its phrases as text; now as a number, and one shard emits it with its total, also above 255."""
    for bits in (24, 25, 31):
        seen = collocations._scatter(np.arange(1 << 16, dtype=np.uint64), bits)
        assert len(np.unique(seen)) == 1 << 16 and int(seen.max()) < 1 << bits
    keys, counts = np.array([2, 5, 9, 5, 9, 12], np.uint64), [np.array([299, 150, 1], np.uint32), np.array([150, 1, 400], np.uint32)]
    (m1, r1, f1, t1), (m2, r2, f2, t2) = (collocations._told(x, 3) for x in collocations._judge(keys, counts, 300))
    assert (m1.tolist(), r1.tolist(), f1.tolist(), t1.tolist()) == ([False, True, False], [0], [True], [300])
    assert (m2.tolist(), r2.tolist(), f2.tolist(), t2.tolist()) == ([True, False, True], [0, 1], [False, True], [400])
    rows = [(i, "New york city " * 5 + ". lone", lang) for i in range(80) for lang in ("en", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = collocations.count_phrases(docs, min_count=300, chunk_words=40, owners=3)
    got = sorted(tuple(r) for r in out.collect())
    want = {"new": 400, "york": 400, "city": 400, "new york": 400, "york city": 400, "city new": 320, "new york city": 400, "york city new": 320, "city new york": 320}
    assert got == sorted((lang, len(p.split()), p, n) for lang in ("en", "fr") for p, n in (want | {"": 80 * 16}).items())
