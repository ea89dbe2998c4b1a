"""Sources, sinks and streams."""

import json

import pytest
from pyspark.sql import functions as F

from leafmill.operators import stages
from leafmill.operators.records import RECORD
from leafmill.sources import commits, readers, writers
from leafmill.streaming import flows


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value), encoding="utf-8")


def test_json_roots(spark, tmp_path):
    put(tmp_path / "list.json", [{"question_no": 2}, {"question_no": 1}])
    put(tmp_path / "object.json", {"questions": [{"question_no": 3}]})
    assert [r.question_no for r in readers.read_records(spark, f"{tmp_path}/list.json", RECORD).collect()] == [1, 2]
    assert [r.question_no for r in readers.read_records(spark, f"{tmp_path}/object.json", RECORD).collect()] == [3]
    assert [r.question_no for r in readers.read_records(spark, f"{tmp_path}/list.json", RECORD, [2]).collect()] == [2]
    with pytest.raises(FileNotFoundError):
        readers.read_json(spark, f"{tmp_path}/none.json", "a int")
    default = spark.createDataFrame([(1,)], "a int")
    assert readers.read_json(spark, f"{tmp_path}/none.json", "a int", default).count() == 1


def test_packets(spark, tmp_path):
    for page, labels in ((1, ["a", ""]), (2, ["a", "b"])):
        put(tmp_path / f"page_{page:03d}.json", {"run_id": "r", "page": page, "blocks": [{"label": x, "text": f"{x}{page}"} for x in labels]})
    put(tmp_path / "other.json", {"page": 9})
    got = readers.packet_blocks(readers.read_packets(spark, str(tmp_path)))
    assert {r.label: r.text for r in got.collect()} == {"a": "a2", "b": "b2"}


def test_standardized(spark, tmp_path):
    put(tmp_path / "run" / "q01.json", {"question_no": 1})
    put(tmp_path / "run" / "q001.json", {"question_no": 2})
    put(tmp_path / "run" / "q02.json", {"question_no": None})
    assert [r.question_no for r in readers.read_standardized(spark, str(tmp_path), RECORD).collect()] == [1]


def test_manifests(spark, tmp_path):
    put(tmp_path / "flat.json", {"run_id": "a", "article_url": "u", "title": "数学试卷", "images": [{"index": 0, "url": "x", "width": 5}]})
    put(tmp_path / "nested.json", {"article_url": "v", "title": "答案", "images": [{"attrs": {"data-src": "y", "data-w": "7"}, "probe": {"height": 3, "format": "PNG"}, "download": {"path": "p", "bytes": 9}}, {"url": "z"}]})
    got = {(r.article_url, r["index"]): r for r in readers.unified_images(spark, str(tmp_path)).collect()}
    assert (got["u", 0].url, got["u", 0].width) == ("x", 5)
    assert (got["v", 0].url, got["v", 0].width, got["v", 0].height, got["v", 0].bytes, got["v", 0].format) == ("y", 7, 3, 9, "PNG")
    seq = spark.createDataFrame([("v", "image", "0", "paper"), ("v", "image", "1", "answer"), ("v", "text", None, None), ("u", "image", "bad", "paper")], "url string, kind string, imageIndex string, phase string")
    phases = {(r.article_url, r["index"]): r.phase for r in readers.image_phases(readers.unified_images(spark, str(tmp_path)), seq).collect()}
    assert phases == {("u", 0): "paper", ("v", 0): "paper", ("v", 1): "answer"}


def test_source_choice(spark):
    a, b = spark.createDataFrame([("d1", 1)], "doc string, x int"), spark.createDataFrame([("d1", 2), ("d2", 3)], "doc string, x int")
    assert sorted((r.doc, r.x) for r in readers.first_nonempty(a, b, key="doc").collect()) == [("d1", 1), ("d2", 3)]
    items = spark.createDataFrame([("b1", "f1"), ("b2", None), ("", "f3")], "block_id string, figure_id string")
    assert sorted(r.key for r in readers.two_keys(items, "block_id", "figure_id").collect()) == ["b1", "b2", "f1", "f3"]
    rules = spark.createDataFrame([("r", "p.pdf", None), ("s", "q.pdf", "a.pdf")], "run_id string, paper_pdf string, answer_pdf string")
    listing = spark.createDataFrame([("p.pdf",), ("x/run1/done.txt",)], "path string")
    got = {r.run_id: (r.ready, r.errors) for r in readers.import_items(rules, listing).collect()}
    assert got == {"r": (True, []), "s": (False, ["missing paper_pdf: q.pdf", "missing answer_pdf: a.pdf"])}
    assert [r.run_id for r in readers.run_ids(listing, "done.txt").collect()] == ["run1"]
    counts = writers.manifest_counts(readers.import_items(rules, listing).withColumn("warnings", F.array().cast("array<string>"))).first()
    assert tuple(counts) == (2, 1, 1, 0)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("r", 1), ("s", 2)], "run_id string, x int")
    writers.write_runs(df, f"{tmp_path}/t")
    writers.write_runs(df.where("run_id = 'r'").withColumn("x", F.lit(9)), f"{tmp_path}/t")
    assert sorted((r.run_id, r.x) for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [("r", 9), ("s", 2)]
    df.write.parquet(f"{tmp_path}/bank")
    for _ in range(2):
        writers.write_back(commits.read_table(spark, f"{tmp_path}/bank").withColumn("x", F.col("x") + 1), f"{tmp_path}/bank")
    assert sorted(r.x for r in commits.read_table(spark, f"{tmp_path}/bank").collect()) == [3, 4]
    assert sorted(r.x for r in commits.read_table(spark, f"{tmp_path}/bank", 0).collect()) == [1, 2]
    for _ in range(2):
        writers.append_log(df, f"{tmp_path}/log")
    assert readers.read_jsonl(spark, f"{tmp_path}/log", "run_id string, x int, created_at string").where("created_at is not null").count() == 4
    writers.write_json(df, f"{tmp_path}/json", single=True)
    writers.write_texts(df.withColumn("html", F.lit("a\nb")), f"{tmp_path}/html")
    assert spark.read.text(f"{tmp_path}/html/run_id=r", wholetext=True).first().value == "a\nb\n"
    assert readers.page_files(spark, f"{tmp_path}/html/run_id=r").count() == 1


EVENTS = "ident long, bucket string, ts timestamp, tokens long"


def drain(spark, df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.table(name).collect()


def stream(spark, path, rows):
    for i, r in enumerate(rows):
        spark.createDataFrame(r, "ident long, bucket string, ts string, tokens long").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{path}/b{i}")
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(path))


def at(s):
    return f"2024-01-01 00:{s // 60:02d}:{s % 60:02d}"


def test_streams(spark, tmp_path):
    batches = [[(1, "b", at(0), 60), (2, "b", at(10), 60)], [(2, "b", at(11), 60), (3, "b", at(200), 5)], [(4, "b", at(1000), 1)], [(5, "b", at(5), 7)], [(6, "b", at(2000), 1)]]
    src = stream(spark, tmp_path / "in", batches)
    got = drain(spark, flows.windowed(src, "ts", ["bucket"], "60 seconds", None, "60 seconds", "tokens"), "tumbling_out")
    assert {r.window_start.minute: r.total for r in got}[0] == 180
    once = drain(spark, flows.deduplicated(src, ["ident"], "ts", "1 hour"), "dedupe_out")
    assert sorted(r.ident for r in once) == [1, 2, 3, 4, 5, 6]


def test_stateful_admission(spark, tmp_path):
    src = stream(spark, tmp_path / "in", [[(1, "b", at(0), 60), (9, "c", at(0), 1)], [(2, "b", at(10), 60)], [(3, "b", at(11), 60)]])
    got = {r.ident: r.admitted - r.arrived for r in drain(spark, flows.admitted(src, 100), "admit_out")}
    assert got[1] == 0 and got[9] == 0 and round(got[2], 2) == 50.05 and got[3] > 100


def test_exactly_once(spark, tmp_path):
    src = stream(spark, tmp_path / "in", [[(1, "b", at(0), 1)], [(1, "b", at(0), 1), (2, "b", at(1), 1)]])
    q = flows.exactly_once(src, f"{tmp_path}/out", "ident").option("checkpointLocation", f"{tmp_path}/cp").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.ident for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2]


def test_a_write_that_fails_leaves_the_table(spark, tmp_path, monkeypatch):
    at = f"{tmp_path}/bank"
    table = lambda: sorted(r.x for r in commits.read_table(spark, at).collect())
    up = lambda: commits.read_table(spark, at).withColumn("x", F.col("x") + 1)
    spark.createDataFrame([(1,), (2,)], "x int").write.parquet(at)
    assert writers.write_back(up(), at) == 1
    with monkeypatch.context() as m:  # the data is there, the commit is not
        m.setattr(commits, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            writers.write_back(up(), at)
    assert table() == [2, 3]
    (tmp_path / "bank" / "_commits" / f"{2:020d}.json").write_text('{"folder": "x')  # a commit that was cut off
    assert table() == [2, 3] and commits.version(spark, at) == 2
    assert writers.write_back(up(), at, 2) == 3
    assert table() == [3, 4]
    with pytest.raises(commits.Conflict):
        writers.write_back(up(), at, 2)
    assert table() == [3, 4]
    with pytest.raises(Exception, match="no version 2"):
        commits.read_table(spark, at, 2)
    assert commits.publish(spark.createDataFrame([], "x int"), f"{tmp_path}/new") == 1
    assert commits.read_table(spark, f"{tmp_path}/new").count() == 0


def test_stages_run_again_only_where_inputs_changed(spark, tmp_path, monkeypatch):
    seen = []

    def stage(rows):
        seen.append(sorted(r.run_id or "" for r in rows.select("run_id").distinct().collect()))
        return rows.groupBy("run_id").agg(F.sum("x").alias("total"), F.count("*").alias("n"))

    def call(rows, version="1"):
        source = f"{tmp_path}/in{len(seen)}-{version}"
        spark.createDataFrame(rows, "run_id string, x long").write.mode("overwrite").partitionBy("run_id").parquet(source)
        inputs = spark.read.schema("x long, run_id string").parquet(source)
        return {(r.run_id, r.total, r.n) for r in stages.run_stage(inputs, f"{tmp_path}/stage", stage, version=version).collect()}

    first = [("001", 1), ("001", 2), ("1", 5), ("b", 7), ("b", 7), (None, 9)]
    assert call(first) == {("001", 3, 2), ("1", 5, 1), ("b", 14, 2), (None, 9, 1)}
    assert call(first[::-1]) == call(first) == {("001", 3, 2), ("1", 5, 1), ("b", 14, 2), (None, 9, 1)}
    assert seen == [["", "001", "1", "b"]]
    second = [("001", 1), ("001", 2), ("b", 7), (None, 9), ("new", 1)]
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            call(second)
    assert seen[1:] == [["b", "new"]]
    assert call(second) == {("001", 3, 2), ("b", 7, 1), (None, 9, 1), ("new", 1, 1)}
    assert seen[2:] == [["b", "new"]]
    assert call(second, "2") == {("001", 3, 2), ("b", 7, 1), (None, 9, 1), ("new", 1, 1)}
    assert seen[3:] == [["", "001", "b", "new"]]
    assert call(first, "2") == {("001", 3, 2), ("1", 5, 1), ("b", 14, 2), (None, 9, 1)}
    assert seen[4:] == [["1", "b"]]


def test_unchanged_runs_are_pruned(spark, tmp_path):
    spark.createDataFrame([(f"r{i}", i) for i in range(6)], "run_id string, x long").write.partitionBy("run_id").parquet(f"{tmp_path}/in")
    inputs = spark.read.parquet(f"{tmp_path}/in")
    changed = spark.createDataFrame([("r1",), ("r4",)], "run_id string")
    few = stages.only_runs(inputs, changed)
    assert {r.run_id for r in few.collect()} == {"r1", "r4"}
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [run_id" in plan and "r4" in plan
    prints = {r.run_id: r.fingerprint for r in stages.fingerprints(inputs.union(inputs.where("x = 2"))).collect()}
    again = {r.run_id: r.fingerprint for r in stages.fingerprints(inputs.repartition(3)).collect()}
    assert [k for k in prints if prints[k] != again[k]] == ["r2"]


def test_many_changed_runs_are_joined(spark, monkeypatch):
    monkeypatch.setattr(stages, "NAMED_RUNS", 1)
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "run_id string, x int")
    assert sorted(r.x for r in stages.only_runs(rows, rows.where("x > 1").select("run_id")).collect()) == [2, 3]


def test_image_files(spark, tmp_path):
    at = tmp_path / "pictures"
    (at / "deep").mkdir(parents=True)
    big, little = (lambda v, n: v.to_bytes(n, "big")), (lambda v, n: v.to_bytes(n, "little"))
    files = {
        "a.png": (b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + big(640, 4) + big(70000, 4) + b"rest", ("png", 640, 70000)), "b.gif": (b"GIF87a" + little(300, 2) + little(2, 2), ("gif", 300, 2)),
        "deep/c.jpg": (b"\xff\xd8\xff\xe1" + big(2000, 2) + b"\xff" * 1998 + b"\xff\xd0\xff\xc4" + big(2, 2) + b"\xff\xc0" + big(17, 2) + b"\x08" + big(480, 2) + big(641, 2), ("jpeg", 641, 480)),
        "cut.jpg": (b"\xff\xd8\xff\xe1" + big(2000, 2) + b"x", ("jpeg", None, None)), "cut.png": (b"\x89PNG\r\n\x1a\n\0\0", ("png", None, None)),
        "v.webp": (b"RIFF\0\0\0\0WEBPVP8 \0\0\0\0\0\0\0\x9d\x01\x2a" + little(0x4000 + 100, 2) + little(50, 2), ("webp", 100, 50)),
        "l.webp": (b"RIFF\0\0\0\0WEBPVP8L\0\0\0\0\x2f" + little(99 | 16383 << 14, 4), ("webp", 100, 16384)), "x.webp": (b"RIFF\0\0\0\0WEBPVP8X\0\0\0\0\0\0\0\0" + little(70000, 3) + little(0, 3), ("webp", 70001, 1)),
        "none.bin": (b"plain", (None, None, None)), "one": (b"\xff", (None, None, None)),
    }
    for name, (data, _) in files.items():
        (at / name).write_bytes(data)
    got = {r.path.split("pictures/")[1]: r for r in readers.image_files(spark, str(at)).collect()}
    assert {k: (r.format, r.width, r.height) for k, r in got.items()} == {k: want for k, (_, want) in files.items()}
    assert got["b.gif"].bytes == 10


def test_page_order(spark):
    images = spark.createDataFrame([("p", "a", 0), ("p", "b", 1), ("p", "c", 2), ("q", "a", 0), ("p", None, 3)], "article_url string, url string, index int")
    seq = spark.createDataFrame([("p", "c", 1), ("p", "b", 5), ("p", "c", 9), ("p", None, 0), ("p", "gone", 2)], "article_url string, url string, at int")
    got = {(r.article_url, r.url): r.place for r in readers.dom_order(images, seq).collect()}
    assert got == {("p", "c"): 1, ("p", "b"): 2, ("p", "a"): 3, ("p", None): 4, ("q", "a"): 1}


def test_copies_are_named_by_content(spark, tmp_path):
    """Equal files are one copy, missing ones are rows with nulls, a second run leaves no parts and changes nothing."""
    from leafmill.sources import copies

    (tmp_path / "a.PNG").write_bytes(b"same")
    (tmp_path / "b c.png").write_bytes(b"same")
    (tmp_path / "d").write_bytes(bytes(3 << 20))
    names = ["a.PNG", "b c.png", "d", "gone.png", "a.PNG"]
    rows = spark.createDataFrame([(str(tmp_path / n), 1) for n in names] + [(None, 2), (str(tmp_path), 3)], "source string, file int")
    target = tmp_path / "copies"
    for _ in range(2):
        got = {r.source.rsplit("/", 1)[1]: (r.file, r.bytes) for r in copies.copy_files(rows, f"file://{target}").collect()}
        assert got["a.PNG"] == got["b c.png"] and got["a.PNG"][1] == 4 and got["d"][0].endswith(".png") and got["d"][1] == 3 << 20
        assert got["gone.png"] == got[tmp_path.name] == (None, None) and len(got) == 5
        assert sorted(p.name for p in target.iterdir()) == sorted({got["a.PNG"][0], got["d"][0]})
    assert (target / got["d"][0]).read_bytes() == bytes(3 << 20)
    assert copies.copy_files(rows.limit(0), str(target)).count() == 0


def test_asset_map_takes_the_first_block_whose_file_exists(spark):
    from leafmill.operators import assets

    block = "run_id string, folder string, stream string, pos int, label string, type string, block_id string, figure_id string"
    rows = [
        ("r", "/d", "answer", 0, "L1", "image", "k1", None), ("r", "/d", "question", 9, "L1", "chart", "k2", "k1"), ("r", "/d", "question", 3, "L1", "image", "k3", ""),
        ("r", "/d", "question", 1, "L2", "text", "k2", ""), ("r", "/d", "question", 2, "L3", "Table", None, "k2"), ("r", "/d", "question", 4, "L4", "image", "k4", "k2"), ("r", "/d", "answer", 5, "L5", None, "k1", ""),
    ]
    items = spark.createDataFrame([("r", "question", "k2", "x\\y.png"), ("r", "question", "k3", "none.png"), ("r", "question", "k4", ""), ("r", "answer", "k1", "z.png"), ("r", "question", "", "q")], "run_id string, stream string, key string, path string")
    listing = spark.createDataFrame([("/d/paper/mineru_extract/images/y.png",), ("/d/answer/x/y.png",), ("/d/answer/z.png",)], "path string")
    got = {r.label: r.source for r in assets.asset_map(spark.createDataFrame(rows, block), items, listing).collect()}
    # An item found by the first key counts, even without a path.
    assert got == {"L1": "/d/paper/mineru_extract/images/y.png", "L3": "/d/paper/mineru_extract/images/y.png", "L4": None}


def test_blocks_of_one_path_are_not_multiplied_or_sorted_in_one_task(spark):
    """Every block stood six times in one task's sort, however few the splits; now each path is tried once and labels are dealt."""
    from leafmill.operators import assets

    k = F.col("id")
    blocks = spark.range(0, 3000, 1, 1).select(
        F.lit("r").alias("run_id"), F.lit("/d").alias("folder"), F.when(k % 2 == 0, "question").otherwise("answer").alias("stream"), k.alias("pos"), k.cast("string").alias("label"),
        F.lit("image").alias("type"), F.when(k % 3 > 0, F.lit("k")).alias("block_id"), F.when(k % 3 == 0, F.lit("gone")).alias("figure_id"),
    )
    items = spark.createDataFrame([("r", s, key, path) for s in ("question", "answer") for key, path in (("k", "x.png"), ("gone", "lost.png"))], "run_id string, stream string, key string, path string")
    out = assets.asset_map(blocks, items, spark.createDataFrame([("/d/answer/x.png",), ("/d/paper/mineru_extract/x.png",)], "path string"))
    plan = out._jdf.queryExecution().toString()
    assert "Generate" not in plan and "REPARTITION_BY_NUM" in plan
    got = {int(r.label): r.source for r in out.collect()}
    assert got == {i: "/d/paper/mineru_extract/x.png" if i % 3 else None for i in range(3000)}


def test_joined_texts_are_written_batch_by_batch(spark, tmp_path):
    rows = [(r, i, None if i == 3 else f"{r}{i}") for i in range(50) for r in ("a", "b/c")] + [("none", 1, None), (None, 1, "x")]
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for _ in range(2):
            writers.write_joined(spark.createDataFrame(rows, "run_id string, i int, v string").repartition(3), f"file://{tmp_path}/out", "v", ["i"])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    got = {p.parent.name: p.read_text() for p in (tmp_path / "out").rglob("*") if p.is_file()}
    assert got == {f"run_id={q}": ",".join(f"{r}{i}" for i in range(50) if i != 3) + "\n" for r, q in (("a", "a"), ("b/c", "b%2Fc"))} | {"run_id=none": "\n"}
