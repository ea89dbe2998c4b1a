"""Operators on small tables, expected values derived by hand."""

import json
from collections import Counter
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from leafmill.functions import mathtext as M
from leafmill.operators import align, assets, budget, layout, markup, models, records, tables
from leafmill.sources import readers


def rows(df):
    return [tuple(r) for r in df.collect()]


# ---------------------------------------------------------------- tables


def test_first_and_last_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, None)], "k string, o int, v string")
    assert sorted(rows(tables.first_wins(df, ["k"], ["o"]))) == [("a", 1, "x"), ("b", 3, None)]
    assert sorted(rows(tables.last_wins(df, ["k"], ["o"]))) == [("a", 2, "y"), ("b", 3, None)]
    assert rows(tables.last_wins(df.limit(0), ["k"], ["o"])) == []


def test_merge_and_changes(spark):
    base = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0)], "k int, s string, v double")
    fixed = spark.createDataFrame([(1, "A", "fixed", 0, True), (2, "B", "error", 0, True), (3, "C", "fixed", 1, True)], "k int, s string, status string, n int, same boolean")
    ok = F.size(tables.reject_reasons(F.col("status"), F.col("n"), F.col("same"))) == 0
    assert sorted(rows(tables.merge_where(base, fixed, "k", ["s"], ok))) == [(1, "A", 1.0, True), (2, "b", None, False), (3, "c", 3.0, False)]
    new = spark.createDataFrame([(1, "a", None), (2, "b", None)], "k int, s string, v double")
    assert sorted(rows(tables.changed_fields(base, new, "k", ["s", "v"]))) == [(1, ["v"]), (2, []), (3, [])]
    assert rows(spark.range(1).select(tables.reject_reasons(F.lit("error"), F.lit(2), F.lit(None).cast("boolean")))) == [(["not_fixed", "findings_left", "content_changed"],)]


def test_union_complete(spark):
    want = spark.createDataFrame([(i,) for i in (1, 2, 3)], "k int")
    parts = [spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (9,)], "k int")]
    got = {r.k: r.problem for r in tables.union_complete(parts, want, "k").collect()}
    assert got == {2: "duplicate", 3: "missing", 9: "unexpected"}
    assert tables.same_keys(want, want, "k").count() == 0
    assert sorted(rows(tables.same_keys(want, parts[0], "k"))) == [(3, "left")]


def test_assignment(spark):
    df = spark.createDataFrame([("r", i, w) for i, w in enumerate((5, 4, 3, 3, 3))], "run string, item int, w int")
    got = {r.item: r.bin for r in tables.longest_first(df, ["run"], "item", "w", 2).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 0, 4: 1}
    assert rows(spark.range(1).select(tables.distribute(F.lit(8), 3), tables.distribute(F.lit(2), 3))) == [([3, 3, 2], [1, 1, 1])]
    assert [r.bin for r in tables.round_robin(df, [F.col("item")], 2).orderBy("item").collect()] == [0, 1, 0, 1, 0]
    assert rows(tables.pending(df, df.where("item < 4"), "item").select("item")) == [(4,)]


def test_counts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "y")], "k string, c string")
    assert sorted(rows(tables.dense_counts(df, ["k"], "c", ["x", "z"], other="other"))) == [("a", 1, 0, 1), ("b", 0, 0, 1)]
    assert ("c", None, 1) in rows(tables.group_counts(df, ["k", "c"]))
    assert sorted(rows(tables.unpivot(df, ["k"], ["c"]))) == [("a", "c", 1, "x"), ("b", "c", 1, "y")]


# ---------------------------------------------------------------- layout


def block(label, text="", order=0, kind="text", box=None, figure=None, block_id=None):
    return Row(label=label, block_id=block_id or label, type=kind, bbox=box or [0.0, 0.0, 1.0, 1.0], text=text, page=1, figure_id=figure, order=order)


BLOCK = "label string, block_id string, type string, bbox array<double>, text string, page int, figure_id string, order int"


def test_packets(spark):
    packets = spark.createDataFrame([("r", 2, [block("Q-V02-B01", "b")]), ("r", 1, [block("Q-V01-B01", "1. a"), block(" ", "lost")])], f"run_id string, page int, blocks array<struct<{BLOCK.replace(' ', ':').replace(',:', ',')}>>")
    got = layout.flatten_packets(packets).select("packet_page", "packet_order", "label")
    assert sorted(rows(got)) == [(1, 0, "Q-V01-B01"), (2, 0, "Q-V02-B01")]
    lines = spark.createDataFrame([("r", 0, "3. first"), ("r", 1, "(A) x")], "run_id string, pos int, text string")
    nested = layout.packets(lines, ["run_id"], "pos").first().blocks
    assert [(b.detected_question_prefix, b.looks_like_option) for b in nested] == [(3, False), (None, True)]


def test_tree(spark):
    line = lambda *spans: {"lines": [{"spans": [dict(zip(("type", "content", "html"), s, strict=False)) for s in spans]}]}
    tree = [{"preproc_blocks": [{"type": "text", **line(("text", " a  b"), ("inline_equation", "x"))}, {"type": "image", "blocks": [{"type": "image_body", **line(("text", "no"))}, {"type": "image_caption", **line(("text", "cap"))}]}]}, {"preproc_blocks": [{"type": "text", **line(("text", " "))}]}]
    got = layout.flatten_tree(spark.createDataFrame([("r", json.dumps(tree))], "run_id string, tree string"), ["run_id"])
    assert sorted(rows(got)) == [("r", 0, [0, 0], "text", "a b $x$"), ("r", 0, [1, 1, 0], "image_caption", "cap")]


def test_orders(spark):
    df = spark.createDataFrame([("c", 1, None, 5.0), ("a", 1, 2.0, 9.0), ("b", 1, None, 1.0), ("z", 0, None, 0.0)], "id string, page int, ro double, y double")
    box = F.array(F.lit(0.0), F.col("y"))
    assert [r.id for r in df.orderBy(*layout.block_order(F.col("page"), F.col("ro"), box, F.col("id"))).collect()] == ["z", "a", "b", "c"]
    zero = spark.createDataFrame([("a", 1, 0), ("b", 1, 1), ("c", 2, 0)], "l string, p int, o int")
    assert [r.l for r in zero.orderBy(*layout.label_order(F.col("p"), F.col("o"), F.col("l"))).collect()] == ["b", "a", "c"]


def test_split_lines(spark):
    df = spark.createDataFrame([("b", 1, 1, 0.0, 100.0), ("b", 2, 2, 0.0, 100.0), ("c", 1, 5, 0.0, 100.0), ("d", 1, 1, 0.0, 30.0), ("d", 2, 1, 0.0, 30.0)], "k string, line int, w int, top double, bottom double")
    got = {(r.k, r.line): (round(r.y1, 2), round(r.y2, 2)) for r in layout.split_lines(df, ["k"], "line", "w", "top", "bottom").collect()}
    assert got == {("b", 1): (0, 33.33), ("b", 2): (33.33, 100), ("c", 1): (0, 100), ("d", 1): (0, 30), ("d", 2): (0, 30)}


def test_page_roles(spark):
    pages = [("p", 1, "1. 题"), ("p", 2, "参考答案"), ("p", 3, "x"), ("p", 4, "专家点评"), ("q", 1, "参考答案与试题解析\n1. a\n2. b"), ("q", 2, "y"), ("s", 1, "贴条形码 参考答案"), ("s", 2, "z")]
    got = {(r.run_id, r.page): (r.role, r.mode) for r in layout.page_roles(spark.createDataFrame(pages, "run_id string, page int, text string")).collect()}
    assert got["p", 1] == ("question", "paper_then_answers") and got["p", 3] == ("answer", "paper_then_answers") and got["p", 4][0] == "commentary"
    assert got["q", 1] == got["q", 2] == ("interleaved_solution", "interleaved_solution")
    assert got["s", 1] == ("answer_sheet", "paper_only") and got["s", 2] == ("question", "paper_only")


def test_mode(spark):
    f = lambda *a: spark.range(1).select(layout.pipeline_mode(*(F.lit(x) for x in a))).first()[0]
    assert (f("pure_paper", True, True), f("auto", True, True), f("auto", False, True), f("auto", False, False)) == ("pure_paper", "paper_plus_answer_file", "mixed", "pure_paper")


# ---------------------------------------------------------------- alignment


def blocks(spark):
    texts = ["1. a", "more 2. shared", "b", "3. c", "d"]
    return spark.createDataFrame([("r", f"B{i}", i, t) for i, t in enumerate(texts)], "run_id string, label string, ordinal int, text string")


def test_label_ranges(spark):
    ranges = spark.createDataFrame([("r", 1, "B0", "B1", []), ("r", 2, "B2", "B2", ["P1", "B2"]), ("r", 3, "B3", "Bx", []), ("r", 4, "B4", "B3", ["P9"])], "run_id string, question_no int, start_label string, end_label string, visual_labels array<string>")
    got = {r.question_no: r.labels for r in align.labels_in_ranges(ranges, blocks(spark)).collect()}
    assert got == {1: ["B0", "B1"], 2: ["B2", "P1"], 3: [], 4: ["P9"]}
    shared = {r.question_no: r.labels for r in align.labels_in_ranges(ranges, blocks(spark), shared_start=True).collect()}
    assert shared[2] == ["B1", "B2", "P1"] and shared[1] == ["B0", "B1"]


def test_range_join_meets_once(spark):
    rng = random.Random(1)
    points = [(i, rng.randrange(-50, 200)) for i in range(60)]
    spans = [(i, a := rng.randrange(-50, 200), a + rng.randrange(-5, 90)) for i in range(30)]
    got = align.range_join(spark.createDataFrame(points, "p int, x int"), spark.createDataFrame(spans, "s int, lo int, hi int"), "x", "lo", "hi", 13)
    want = sorted((p, s) for p, x in points for s, lo, hi in spans if lo <= x <= hi)
    assert sorted(rows(got.select("p", "s"))) == want


def test_nearest(spark):
    p = spark.createDataFrame([("r", "asset", 5)], "run string, label string, at int")
    i = spark.createDataFrame([("r", 1, 0, 3), ("r", 2, 4, 7)], "run string, q int, lo int, hi int")
    got = align.nearest_intervals(p, i, ["run"], "at", "lo", "hi", "q").select("q", "distance", "rank")
    assert sorted(rows(got)) == [(1, 2, 2), (2, 0, 1)]


def test_alignment(spark):
    q = spark.createDataFrame([("r", 1, ["a"]), ("r", 2, ["b"])], "run_id string, question_no int, labels array<string>")
    a = spark.createDataFrame([("r", 1, ["x"], True, 0), ("r", 1, ["A-B1", "A-B9"], True, 1), ("r", 2, ["z"], False, 2)], "run_id string, question_no int, labels array<string>, valid boolean, ordinal int")
    got = {r.question_no: (r.answer_labels, r.answer_status) for r in align.align(q, a).collect()}
    assert got == {1: (["A-B1", "A-B9"], "found"), 2: ([], "missing")}
    known = spark.createDataFrame([("r", "Q-B1")], "run_id string, label string")
    mixed = {r.question_no: r.answer_labels for r in align.align_mixed(q, a, known).collect()}
    assert mixed == {1: ["Q-B1"], 2: []}
    assert rows(align.missing(q, a.where("valid"), ["run_id", "question_no"])) == [("r", 2)]
    listing = spark.createDataFrame([("b.pdf",)], "path string")
    c = spark.createDataFrame([("r", 0, "a.pdf"), ("r", 1, "b.pdf"), ("s", 0, "c.pdf")], "run_id string, pos int, path string")
    assert sorted(rows(align.first_found(c, listing, ["run_id"]))) == [("r", "b.pdf", True), ("s", "c.pdf", False)]


def test_parsed_ranges(spark):
    text = json.dumps({"question_ranges": [{"question_no": "2", "start_label": "Q-V02-B01", "end_label": "nope"}, {"question_no": 1, "start_label": "Q-V01-B01", "end_label": "Q-V02-B01", "visual_labels": ["x", "Q-V02-B01"], "confidence": 3}, {"question_no": "x"}]})
    r = spark.createDataFrame([("r", text)], "run_id string, response string")
    b = spark.createDataFrame([("r", "Q-V01-B01"), ("r", "Q-V02-B01")], "run_id string, label string")
    got = {x.question_no: (x.valid, x.visual_labels, x.confidence, x.ordinal) for x in align.parse_ranges(r, b).collect()}
    assert got == {1: (True, ["Q-V02-B01"], 1.0, 0), 2: (False, [], 0.0, 1)}
    assert sorted(x.form for x in align.label_forms(b.limit(1)).collect()) == ["A-V01-B01", "Q-V01-B01"]


def test_known_keys(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert sorted(rows(tables.select_known(df, "k", ["b"]))) == [("b", 2)]
    with pytest.raises(Exception, match="unknown key"):
        tables.select_known(df, "k", ["a", "z"]).collect()


def test_crops(spark):
    labels = spark.createDataFrame([("r", 1, "a"), ("r", 1, "b"), ("r", 2, "lost")], "run_id string, question_no int, label string")
    b = spark.createDataFrame([("r", x, "question", 1, "p.png", box) for x, box in (("a", [10.0, 10.0, 20.0, 20.0]), ("b", [15.0, 30.0, 40.0, 50.0]))], "run_id string, label string, stream string, page int, image string, bbox array<double>")
    assert rows(layout.crop_boxes(labels, b)) == [("r", 1, "question", 1, "p.png", 2, 2, 48, 58)]
    assert rows(layout.page_extents(b, ["page"], F.col("bbox")[3])) == [(1, 1000.0)]


# ---------------------------------------------------------------- records


def record(**changes):
    base = {"schema_version": records.SCHEMA_VERSION, "question_no": 1, "question_type": "solution", "stem_latex": ["x"], "options_latex": dict.fromkeys("ABCD", []), "answer_latex": [], "analysis_latex": [], "rubric_latex": [], "issues": []}
    return base | changes


VIOLATIONS = [
    ({}, []), ({"schema_version": "v0"}, ["schema_version"]), ({"question_type": "essay"}, ["question_type"]), ({"stem_latex": ["a\nb"]}, ["multi_line"]), ({"stem_latex": [" "]}, ["empty_item"]),
    ({"question_type": "single_choice"}, ["choice_without_options"]), ({"extra": 1}, ["extra_key:extra"]), ({"issues": [{"type": "t", "severity": "bad", "message": "m"}]}, ["severity"]),
]


def test_validation(spark):
    df = spark.createDataFrame([(i, json.dumps(record(**c))) for i, (c, _) in enumerate(VIOLATIONS)] + [(99, "no json"), (98, None)], "i int, response string")
    got = {r.i: r.violations for r in records.parse_records(df, "response").collect()}
    assert got == {**{i: v for i, (_, v) in enumerate(VIOLATIONS)}, 99: ["not_json"], 98: ["not_json"]}


def parsed(spark, *changes):
    df = spark.createDataFrame([("r", json.dumps(record(**c))) for c in changes], "run_id string, response string")
    return records.parse_records(df, "response").select("run_id", "record.*")


def test_audit_and_fingerprint(spark):
    df = parsed(spark, {"question_no": 1, "stem_latex": ["x = 1"]}, {"question_no": 2, "question_type": "single_choice", "stem_latex": ["a ( )", "<choice_blank>"], "options_latex": {**dict.fromkeys("BCD", []), "A": [r"$\left( x$"]}})
    got = {(r.question_no, r.field, r.option_key, r["index"]): r.reasons for r in records.audit(df).collect()}
    assert got == {(1, "stem_latex", None, 1): ["math_relation_outside_math"], (2, "options_latex", "A", 1): ["left_right_count_mismatch"], (2, "stem_latex", None, 0): ["duplicate_choice_blank"]}
    same = parsed(spark, {"stem_latex": ["$x = 1$"]}, {"question_no": 2, "stem_latex": [r"\(x=1\)"]}, {"question_no": 3, "stem_latex": ["x = 2"]})
    prints = {r.question_no: r.fingerprint for r in records.fingerprints(same).collect()}
    assert prints[1] == prints[2] != prints[3]


def test_issues_and_warnings(spark):
    df = parsed(spark, {"question_no": 3, "stem_latex": ["3. $x", "see a.png"]}).withColumns(
        {"source_no": F.lit(4), "answer_status": F.lit("found"), "placeholders": F.from_json(F.lit('[{"kind":"ocr_gap","label":"Q-1","placeholder":"<ocr_gap01>"}]'), "array<struct<kind:string,label:string,placeholder:string>>")}
    )
    kinds = [i.type for i in records.record_issues(df).first().found]
    assert kinds == ["question_no_mismatch", "unbalanced_dollar", "image_path_in_output", "missing_question_placeholder", "ocr_gap_in_input", "empty_answer"]
    w = records.content_warnings(df.withColumns({"answer_ocr": F.lit("y"), "question_ocr": F.lit("x ( )")})).first().warnings
    assert w == sorted([records.WARNINGS["no_answer"], records.WARNINGS["blank"], f"stem_latex[1] {records.WARNINGS['dollar']}"])
    assert records.field_set("question_surface") == ["stem_latex", "options_latex"] and records.field_set("a, b") == ["a", "b"]


def test_payloads(spark):
    a = spark.createDataFrame([("r", 1, ["Q-V01-B01", "Q-V01-P01", "Q-V01-P01", "lost"], ["A-V01-B01", "A-V01-P01"])], "run_id string, question_no int, question_labels array<string>, answer_labels array<string>")
    b = spark.createDataFrame([("r", "Q-V01-B01", "text", None, "若 $x$ 则 $y"), ("r", "Q-V01-P01", "image", "f", ""), ("r", "A-V01-B01", "text", None, "ok"), ("r", "A-V01-P01", "image", "g", "")], "run_id string, label string, type string, figure_id string, text string")
    got = records.payloads(a, b).first()
    assert [x.text for x in got.question_blocks] == ["若 $x$ 则 <ocr_gap01>", "<figure01>", "<figure01>", ""]
    assert [x.missing for x in got.question_blocks] == [False, False, False, True]
    assert [x.text for x in got.answer_blocks] == ["ok", "<figure02>"]
    sent = records.payloads(a, b).select(records.model_input(F.lit("paper_plus_answer_file"), F.col("question_blocks"), F.col("answer_blocks")).alias("j")).first().j
    assert json.loads(sent) == {"question_ocr": "若 $x$ 则 <ocr_gap01>\n<figure01>\n<figure01>", "answer_ocr": "ok\n\n<figure02>"}


def test_small_record_functions(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    got = one(records.clean_table_marks(F.lit("a <table01> <table02> <table03>"), F.array(F.lit("<table01>")), F.array(F.lit("<table01>"), F.lit("<table02>"))))
    assert tuple(got) == ("a <table01>", ["disallowed_table_placeholder_removed", "unknown_table_placeholder_removed"])
    issues = one(records.normal_issues(F.lit('[{"code":"c","evidence":"e","severity":"odd"}]')))
    assert [tuple(i) for i in issues] == [("c", "warning", "e")]
    assert one(records.error_record(F.lit(3), F.lit("boom"))).issues[0].message == "boom"
    s = records.summary(parsed(spark, {}, {"question_no": 2, "issues": [{"type": "t", "severity": "error", "message": "m"}]}).withColumn("elapsed", F.lit(0.25))).first()
    assert (s.question_count, s.success_count, s.error_count, s.issue_counts, s.total_elapsed_seconds) == (2, 1, 1, {"t": 1}, 0.5)


# ---------------------------------------------------------------- assets


def test_assets(spark):
    a = [("r", q, f"Q{q}-{i}", "image", "f", 1, float(y), float(x)) for q, at in ((1, [(0, 9), (0, 1), (200, 0), (200, 5)]), (2, [(0, 0)])) for i, (y, x) in enumerate(at)]
    df = spark.createDataFrame(a, "run_id string, question_no int, label string, type string, figure_id string, page int, y double, x double")
    got = {r.label: (r.role, r.option_label) for r in assets.rule_assets(df).collect()}
    assert got == {"Q1-1": ("option_figure", "A"), "Q1-0": ("option_figure", "B"), "Q1-2": ("option_figure", "C"), "Q1-3": ("option_figure", "D"), "Q2-0": ("stem_figure", None)}
    exp = spark.createDataFrame([("r", "a", [1, 2], ["stem_figure", "noise"]), ("r", "b", [1], ["stem_figure"]), ("r", "c", [1], ["stem_figure"]), ("r", "d", [1], ["stem_figure"])], "run_id string, label string, candidates array<int>, allowed array<string>")
    ans = spark.createDataFrame([("r", "a", "stem_figure", 2, "b ", "1.7"), ("r", "b", "answer_figure", 1, None, None), ("r", "d", "stem_figure", 9, None, "0.5")], "run_id string, label string, role string, question_no int, option_label string, confidence string")
    got = {r.label: (r.role, r.question_no, r.option_label, r.confidence, r.problem) for r in assets.check_assignments(exp, ans).collect()}
    assert got == {"a": ("stem_figure", 2, "B", 1.0, None), "b": (None, 1, None, 0.0, "bad_role"), "c": (None, None, None, 0.0, "unanswered"), "d": ("uncertain", None, None, 0.5, None)}


def test_attach_and_sync(spark):
    r = spark.createDataFrame([("r", 1, ["B1", "P1", "B2"]), ("r", 2, ["P1"])], "run_id string, question_no int, labels array<string>")
    a = spark.createDataFrame([("r", "P1", 2, "stem_figure", None, 0), ("r", "P1", 1, "stem_figure", None, 1), ("r", "B2", None, "noise", None, 2)], "run_id string, label string, question_no int, role string, option_label string, ordinal int")
    got = {x.question_no: (x.labels, [v.label for v in x.visual_assets or []]) for x in assets.attach_assets(r, a).collect()}
    assert got == {1: (["B1"], []), 2: ([], ["P1"])}
    bank = spark.createDataFrame([(1, ["a"], "s"), (2, ["b"], "t"), (3, ["c"], "u")], "question_no int, figure_labels array<string>, stem string")
    new = spark.createDataFrame([(1, ["a"]), (2, ["x"])], "question_no int, figure_labels array<string>")
    synced, changes = assets.sync(bank, new)
    assert sorted(rows(synced)) == [(1, ["a"], "s"), (2, ["x"], "t"), (3, ["c"], "u")] and rows(changes) == [(2, ["figure_labels"])]
    entries = spark.createDataFrame([("r", 1, 0, "a", 0.2), ("r", 1, 1, " c ", 0.4)], "run_id string, question_no int, ordinal int, answer_text string, confidence double")
    ans = spark.createDataFrame([("r", 1, "old", 0.9, "missing"), ("r", 2, "old", 0.1, "missing")], "run_id string, question_no int, excerpt string, confidence double, status string")
    assert sorted(rows(assets.upsert_spans(ans, entries))) == [("r", 1, "$C$", 0.9, "found"), ("r", 2, "old", 0.1, "missing")]
    roles = spark.range(1).select(assets.role_for(F.lit("table"), F.lit("rubric")), assets.role_for(F.lit("image"), F.lit(None).cast("string")), F.size(assets.allowed_roles(F.lit("mixed"), F.lit("x"))), F.size(assets.allowed_roles(F.lit("p"), F.lit("answer")))).first()
    assert tuple(roles) == ("rubric_table", "stem_figure", 9, 5)


def test_contexts_and_tables(spark):
    a = spark.createDataFrame([("r", "answer", 1, "A-P1", "image")], "run_id string, stream string, page int, label string, kind string")
    c = spark.createDataFrame([("r", "A-P1", 2, 2, 5), ("r", "A-P1", 1, 1, 0)], "run_id string, label string, question_no int, rank int, distance int")
    p = spark.createDataFrame([("r", "A-P1", "stem_figure", None)], "run_id string, label string, role string, option_label string")
    got = assets.asset_contexts(a, c, p, "paper_plus_answer_file").first().assets[0]
    assert got.role is None and [x.question_no for x in got.candidates] == [1, 2]
    sets = spark.createDataFrame([("r", "T1", [1, 2])], "run_id string, label string, candidates array<int>")
    b = spark.createDataFrame([("r", 1, "T1", "table", None, "x  y"), ("r", 1, "B1", "text", None, "z")], "run_id string, page int, label string, type string, figure_id string, text string")
    assert [(t.label, t.candidates, t.text) for t in assets.table_contexts(b, sets).first().tables] == [("T1", [1, 2], "x y")]
    answer = json.dumps({"tables": [{"label": "T1", "role": "answer_key_table", "entries": [{"question_no": "1", "answer_text": " A ", "confidence": "2"}, {"question_no": 9, "answer_text": "B"}, {"question_no": "?"}]}, {"label": "T2", "role": "odd", "entries": [{"question_no": 1}]}]})
    got = assets.table_entries(spark.createDataFrame([("r", answer)], "run_id string, response string"), sets)
    assert rows(got.select("label", "question_no", "answer_text", "confidence")) == [("T1", 1, "$A$", 1.0)]


def test_normalise(spark):
    df = parsed(spark, {"question_no": 3, "question_type": "single_choice", "stem_latex": ["3. pick ( )", "$a<blank>$"], "options_latex": {"A": ["(A) 1"], "B": ["B. 2"], "C": [], "D": []}, "answer_latex": ["A"]})
    r = records.normalise(df).first()
    assert r.stem_latex == ["pick <choice_blank>", "$a$ <choice_blank>"]
    assert (r.options_latex.A, r.options_latex.B, r.options_latex.C, r.answer_latex) == (["$1$"], ["$2$"], [], ["$A$"])
    assert [i.type for i in r.issues] == ["blank_token_moved_out_of_math"]
    assert spark.range(1).select(records.context_text(F.array(F.lit("a"), F.lit(" "), F.lit("b  c"))).alias("x")).first().x == "a\nb c"


def test_normalise_keeps_blocks_apart(spark):
    """A formula that one block leaves open does not close in the next; option math, tables and placeholders."""
    df = parsed(
        spark, {
            "question_no": 3, "question_type": "fill_blank", "stem_latex": ["a", "$<blank>$ b", "open $ here", "x $ ____", "see <table01> <table02> <table09>", "<image01>", "<Chart7>"],
            "options_latex": {"A": ["x < 2"], "B": ["(B) y>1 或 z=3。"], "C": ["<image02> <table02>"], "D": []}, "answer_latex": ["x<2", "<table02> 是", "<image01> 故"], "analysis_latex": [], "rubric_latex": ["<figure3>"],
        },
    )
    marks = [("table", "Q-B1", "<table01>", "<table>\n <tr></tr></table>"), ("table", "A-B2", "<table02>", ""), ("image", "Q-B3", "<image01>", None), ("image", "Q-B4", "<image02>", None), (None, None, None, None)]
    df = df.withColumn("placeholders", F.from_json(F.lit(json.dumps([dict(zip(("kind", "label", "placeholder", "html"), m, strict=True)) for m in marks])), records.MARKS))
    r = records.normalise(df.withColumns({"source_no": F.lit(4), "answer_status": F.lit("found")})).first()
    assert r.stem_latex == ["a", "<blank> b", "open $ here", "x $ <blank>", "see <table> <tr></tr></table>"]
    assert (r.options_latex.A, r.options_latex.B, r.options_latex.C) == (["$x < 2$"], [r"$y>1 \text{ 或 } z=3$。"], [])
    assert (r.answer_latex, r.rubric_latex) == (["$x<2$", "<table02> 是", "故"], [])
    found = Counter(i.type for i in r.issues)
    assert found == {"blank_token_moved_out_of_math": 1, "disallowed_table_placeholder_removed": 2, "unknown_table_placeholder_removed": 1, "question_no_mismatch": 1, "unresolved_table_placeholder": 1}
    assert set(r.asDict()) == {*df.columns, "source_no", "answer_status"}


# ---------------------------------------------------------------- budget


def test_limiter_waits():
    gate = budget.Limiter(100)
    assert gate.acquire(0.0, 60) == (0.0, 0.0, 60)
    assert gate.acquire(10.0, 60) == (60.05, 50.05, 60)
    assert budget.Limiter(10).acquire(0.0, 99)[2] == 10
    old, new = budget.Limiter(10, shared=True), budget.Limiter(10)
    for g in (old, new):
        g.acquire(0.0, 10)
    assert new.acquire(60.0, 10)[0] == 60.0 and old.acquire(60.0, 10)[0] > 60.0
    with pytest.raises(ValueError, match="positive"):
        budget.Limiter(0)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 30), st.integers(1, 150)), max_size=30))
def test_limiter_never_exceeds(requests):
    gate, now, held = budget.Limiter(100), 0.0, []
    for gap, n in requests:
        now, _, got = gate.acquire(now + gap, n)
        held.append((now, got))
    for t, _ in held:
        assert sum(n for s, n in held if t - 60 < s <= t) <= 100


def test_budget_tables(spark):
    ev = spark.createDataFrame([("b", 1, "2024-01-01 00:00:00", 60), ("b", 2, "2024-01-01 00:00:10", 60), ("c", 3, "2024-01-01 00:00:00", 1)], "bucket string, ident long, ts string, tokens int").withColumn("ts", F.col("ts").cast("timestamp"))
    got = {r.ident: r.waited for r in budget.admit(ev, "bucket", "ts", "tokens", "ident", 100).collect()}
    assert got == {1: 0.0, 2: 50.05, 3: 0.0}
    assert {r.ident: r.used for r in budget.trailing_usage(ev, ["bucket"], "ts", "tokens", 60).collect()} == {1: 60, 2: 120, 3: 1}
    limits = F.create_map(F.lit("m"), F.lit(5))
    assert spark.range(1).select(budget.bucket_of(F.lit("m"), limits), budget.reserve(F.lit("x"), F.lit("7")), budget.reserve(F.lit(None).cast("string"))).first()[:] == ("m", 7, 2048)
    with pytest.raises(Exception, match="no limit"):
        spark.range(1).select(budget.bucket_of(F.lit("n"), limits)).collect()


# ---------------------------------------------------------------- markup and models


def test_rendered_records(spark):
    """Formulas keep their TeX, tables their cells, options their images; what is missing is named."""
    record = {
        "question_no": 3, "stem_latex": ["$x<1$ (__) <x>", " ", "t <table><tr><td colspan='2'>$a$ ____</td></tr></table> u", "<table></table>"],
        "options_latex": {"A": ["A."], "B": ["$b$"], "C": ["see <image02> <"], "D": []}, "answer_latex": ["$y = <blank>$"], "issues": [{"type": "odd", "severity": "error", "message": "<m>"}],
    }
    df = parsed(spark, record).withColumns({
        "visual_assets": F.from_json(F.lit('[{"role":"stem_figure","label":"F1"},{"role":"stem_figure","label":"F1"},{"role":"answer_figure","label":"F2"}]'), "array<struct<role:string,label:string>>"),
        "asset_sources": F.create_map(F.lit("F1"), F.lit("a/f&1.png"), F.lit("A1"), F.lit("a/1.png"), F.lit("C1"), F.lit("a/c.png")),
        "option_assets": F.from_json(F.lit('{"A":{"placeholder":"<image01>","label":"A1"},"C":{"placeholder":"<image02>","label":"C1"},"D":{"label":"D1"}}'), "map<string,struct<placeholder:string,label:string>>"),
    })
    page = markup.render_questions(df).first().html
    choice = '<span class="choice-blank"><span class="choice-blank-space"></span></span>'
    for part in (
        '<section class="question" id="q03"><h2>Q3 <span>', f'<div class="stem"><p class="text-block">$x&lt;1$ {choice} &lt;x&gt;</p>',
        '<p class="text-block">t</p><div class="table-wrap"><table class="html-table"><tr><td colspan="2">$a$ <span class="blank"></span></td></tr></table></div><p class="text-block">u</p></div>',
        '<div class="option-key">A.</div><div class="option-body"><p class="text-block"><img class="option-asset" src="a/1.png" alt="A1"></p></div>',
        '<div class="option-key">B.</div><div class="option-body"><p class="text-block">$b$</p></div>', 'see <img class="option-asset" src="a/c.png" alt="C1"> &lt;',
        '<div class="option-key">D.</div><div class="option-body"><span class="missing-asset">D1</span></div>', '<div class="figures"><img class="figure" src="a/f&amp;1.png" alt="F1"></div>',
        r"$y = \underline{\hspace{3em}}$", '<div class="qa-section answer-figures"><h3>答案配图</h3><div class="qa-body"><div class="figures"><span class="missing-asset">F2</span>', "<li><b>error</b> odd: &lt;m&gt;</li>",
    ):
        assert part in page, (part, page)
    assert "解析" not in page and page.endswith("</section>")


def test_tables_and_pages(spark):
    cells = markup.table_cells("<table><tr><th colspan=3>a</th></tr><tr><td> </td></tr><tr><td rowspan='99'>b<br>c<td>d &amp; e</table> x <table><tr><td>z</table>")
    assert cells == [(1, 1, 1, "th", 3, 1, "a"), (1, 3, 1, "td", 1, 20, "b c"), (1, 3, 2, "td", 1, 1, "d & e"), (2, 1, 1, "td", 1, 1, "z")]
    page = markup.render_runs(parsed(spark, {"stem_latex": ["a < b <blank>"], "issues": [{"type": "left_right_present", "severity": "info", "message": "m"}]})).first().html
    assert '<p class="text-block">a &lt; b <span class="blank"></span></p>' in page and "left_right_present" not in page
    index = markup.render_index(spark.createDataFrame([("b",), ("a<",), (None,)], "run_id string"), spark.createDataFrame([("b",), ("c",)], "run_id string")).collect()
    assert [tuple(r) for r in index] == [(r, f'<li><a href="{e}.html">{e}</a></li>') for r, e in (("a<", "a&lt;"), ("b", "b"), ("c", "c"))]


def test_elapsed(spark):
    times = spark.sql("select timestamp'2024-01-01 00:00:00' as a, timestamp'2024-01-01 00:01:02.0045' as b, cast(null as timestamp) as c")
    row = times.select(records.elapsed(times.a, times.b), records.elapsed(times.b, times.a), records.elapsed(times.a, times.c)).first()
    assert tuple(row) == (62.005, -62.005, None)


def test_model_calls(spark, tmp_path):
    class Flaky:
        def complete(self, messages):
            if messages == "bad":
                return "no json"
            raise models.RateLimited("later") if messages == "busy" else models.Transient("later")

    paused: list[float] = []
    assert models.call(Flaky(), "busy", pause=paused.append)[::3] == ("error", 61) and paused == [60.0] * 60
    assert models.failure_class(429) is models.failure_class(400, "Rate limit") is models.RateLimited
    assert models.failure_class(503) is models.Transient and models.failure_class(404) is None
    work = spark.createDataFrame([(1, "bad"), (2, "x")], "k int, messages string")
    got = {r.k: (r.status, r.attempts) for r in models.call_model(work, Flaky(), "k", pause=lambda _: None).collect()}
    assert got == {1: ("error", 1), 2: ("error", 9)}
    client = models.FixtureClient(default="{}")
    first = models.call_pending(work, client, "k", f"{tmp_path}/results")
    assert {r.k: r.response for r in first.collect()} == {1: "{}", 2: "{}"}
    more = models.call_pending(spark.createDataFrame([(2, "x"), (3, "y")], "k int, messages string"), client, "k", f"{tmp_path}/results")
    assert sorted(r.k for r in more.collect()) == [2, 3] and spark.read.parquet(f"{tmp_path}/results").count() == 3
    assert json.loads(spark.range(1).select(models.messages("s", F.lit("u")).alias("m")).first().m) == [{"role": "system", "content": "s"}, {"role": "user", "content": "u"}]


def test_errors_that_rows_raise(spark):
    labels = spark.createDataFrame([("r", 1, "A"), ("r", 1, "B")], "run_id string, question_no int, label string")
    blocks = spark.createDataFrame([("r", "A", "q", 1, "p.png", [0.0, 0.0, 9.0, 9.0])], "run_id string, label string, stream string, page int, image string, bbox array<double>")
    with pytest.raises(Exception, match="no block for B"):
        layout.required_crops(labels, blocks).collect()
    assert layout.required_crops(labels.where("label = 'A'"), blocks).count() == 1
    rows = spark.createDataFrame([(1, ["x"]), (2, [])], "k int, labels array<string>")
    with pytest.raises(Exception, match="no labels for 2"):
        align.require(rows, "labels", ["k"], "labels").collect()
    pages = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "run_id string, page int")
    with pytest.raises(Exception, match="page out of range"):
        readers.split_pages(pages, F.array(F.lit(2)), ("run_id",)).collect()
    assert readers.split_pages(pages, F.array(F.lit(1)), ("run_id",)).count() == 2


def test_trees_of_any_depth_and_keys_of_any_name(spark):
    text = lambda t: {"type": "text", "lines": [{"spans": [{"type": "text", "content": t}]}]}
    deep = text("deep")
    for _ in range(300):
        deep = {"type": "list", "blocks": [deep, text("beside")], "lines": [{"spans": [{"content": 7, "type": "text"}]}]}
    hidden = {"type": "chart_body", "blocks": [text("never")]}
    df = spark.createDataFrame([(1, 2, "p", json.dumps([{"preproc_blocks": [deep, hidden, None, "x"]}, 3])), (2, 3, "q", None), (3, 4, None, "no json"), (4, 5, "r", "{}")], "k int, page int, path string, tree string")
    got = layout.flatten_tree(df, ["k", "page", "path"], prefix="leaf_").collect()
    assert got[0].asDict().keys() == {"k", "page", "path", "leaf_page", "leaf_path", "leaf_type", "leaf_text"}
    assert len(got) == 601 and {(r.k, r.page, r.path) for r in got} == {(1, 2, "p")}
    assert [r.leaf_path for r in got if r.leaf_text == "deep"] == [[0] * 301 + [0]]
    assert sum(r.leaf_text == "7" for r in got) == 300
    with pytest.raises(ValueError, match="clash"):
        layout.flatten_tree(df, ["page"])
    names = layout.flatten_tree(spark.createDataFrame([(1, 2, 3, 4, 5, 6, json.dumps([{"preproc_blocks": [text("a")]}]))], "k int, i int, b int, c int, l int, words int, tree string"), ["k", "i", "b", "c", "l", "words"])
    assert names.count() == 1


def test_best_role(spark):
    rows = spark.createDataFrame([("the long stem of a question", "the long stem of a question", "another analysis text"), ("nothing alike here", "xxxxxxxxxxxx", "yyyyyyyyyyyy"), ("short", "short", "short")], "t string, stem string, analysis string")
    got = M.best_role(rows, "t", {"stem": "stem", "analysis": "analysis"}).collect()
    assert [(r.best_role, r.best_ratio) for r in got] == [("stem", 1.0), (None, None), (None, None)]


def test_charged_calls(spark):
    work = spark.createDataFrame([(i, "a" if i % 2 else "b", '{"n": 1}', i * 1_000_000) for i in range(6)], "k long, model string, messages string, at long").withColumn("at", F.timestamp_micros("at"))
    limits = F.create_map(F.lit("a"), F.lit(50), F.lit("b"), F.lit(50))
    got = {r.k: r for r in models.charged_calls(work, models.EchoClient(), "k", limits, 50, F.lit(18), "at").collect()}
    assert {r.status for r in got.values()} == {"ok"} and {r.bucket for r in got.values()} == {"a", "b"}
    assert {r.tokens for r in got.values()} == {20} and got[0].waited == got[2].waited == 0 and got[4].waited > 50


@pytest.mark.parametrize("cell_rows", [4, 512])
def test_nearest_spans_by_brute_force(spark, monkeypatch, cell_rows):
    """Many cells and one: long and short spans, ties, copies, a hot key, keys on one side only, nulls."""
    from leafmill.operators import nearest

    monkeypatch.setattr(nearest, "CELL_ROWS", cell_rows)
    rng = random.Random(cell_rows)
    spans = lambda n, key: [(key, i, float(a := rng.randrange(60)), float(a + rng.choice([0, 0, 1, 3, 25]))) for i in range(n)]
    queries = spans(60, "hot") + spans(5, "few") + spans(2, "alone") + [("hot", 99, None, 1.0), ("hot", 98, 5.0, 1.0), (None, 97, 1.0, 2.0), ("hot", 0, 59.0, 59.0)]
    items = [(key, g % 12, a, b) for key, g, a, b in spans(150, "hot") + spans(3, "few") + spans(4, "none")] + [("few", None, 1.0, 2.0), ("hot", 3, None, None), (None, 1, 1.0, 2.0)]
    schema = "key string, {} long, lo double, hi double"
    got = nearest.nearest_groups(spark.createDataFrame(queries, schema.format("q")), spark.createDataFrame(items, schema.format("g")), ["key"], "q", ("lo", "hi"), "g", ("lo", "hi"), 4)
    want = set()
    for key, q in {(x[0], x[1]) for x in queries if x[0]}:
        least = {}
        for _, _, lo, hi in (x for x in queries if x[:2] == (key, q) and x[2] is not None and x[2] <= x[3]):
            for _, g, a, b in (x for x in items if x[0] == key and x[1] is not None and x[2] is not None):
                least[g] = min(least.get(g, 1e9), max(a - hi, lo - b, 0.0))
        want |= {(key, q, g, d, r) for r, (d, g) in enumerate(sorted((d, g) for g, d in least.items())[:4], 1)}
    assert {tuple(r) for r in got.select("key", "q", "g", "distance", "rank").collect()} == want
    assert got.where("key = 'none' or key is null").count() == 0


def test_nearest_intervals_keeps_rows(spark):
    points = spark.createDataFrame([("r", "a", 5.0), ("r", "b", 5.0), ("s", "c", 1.0), ("t", "d", None)], "run string, name string, at double")
    intervals = spark.createDataFrame([("r", 1, 0.0, 4.0, "x"), ("r", 2, 4.0, 9.0, "y"), ("r", 3, 90.0, 99.0, "z")], "run string, no int, lo double, hi double, note string")
    got = align.nearest_intervals(points, intervals, ["run"], "at", "lo", "hi", "no", 2).select("name", "no", "note", "distance", "rank")
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1, "x", 1.0, 2), ("a", 2, "y", 0.0, 1), ("b", 1, "x", 1.0, 2), ("b", 2, "y", 0.0, 1)]
