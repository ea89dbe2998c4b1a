"""Expressions on literal rows, expected values derived by hand."""

import random

import pytest
from pyspark.sql import functions as F

from leafmill.functions import arrays as A
from leafmill.functions import geometry as G
from leafmill.functions import mathtext as M
from leafmill.functions import text as T


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def lit(*items):
    return F.array(*(F.lit(i) for i in items))


def cases():
    return [
        (T.excerpt(F.lit("ab  cdef"), 5), "ab c…"),
        (T.excerpt(F.lit(None).cast("string")), ""),
        (T.strip(F.lit("　a ")), "a"),
        (T.relabel(F.lit("A-V02-B03"), "Q"), "Q-V02-B03"),
        (T.has_marker(F.lit("11. x"), F.lit(1)), True),
        (T.has_marker(F.lit("12 x"), F.lit(1)), False),
        (T.display_width(F.lit("数a")), 3),
        (T.line_weight(F.lit("数" * 40), F.lit(100)), 3),
        (T.dollars(F.lit(r"a $x$ b \$ c $")), 3),
        (T.truncate_unbalanced(F.lit("若 $x$ 则 $y"), F.lit("<ocr_gap01>")), "若 $x$ 则 <ocr_gap01>"),
        (T.truncate_unbalanced(F.lit(r"a \$ b"), F.lit("<g>")), r"a \$ b"),
        (T.strip_number(F.lit("若 x=1.5"), F.lit(1)), "5"),
        (T.strip_number(F.lit("12. find"), F.lit(12)), "find"),
        (T.strip_option(F.lit("(A) 3"), F.lit("A")), "3"),
        (T.strip_option(F.lit("a. 3"), F.lit("A")), "3"),
        (T.short_answer(F.lit(" b ")), "$B$"),
        (T.short_answer(F.lit(" b c ")), "b c"),
        (T.question_number(F.lit(" 3、 x")), 3),
        (T.question_number(F.lit("x 3.")), None),
        (T.is_option(F.lit(" (B) 4")), True),
        (T.is_solution_marker(F.lit("　【解析】")), True),
        (T.restore_controls(F.lit("\x0crac")), r"\frac"),
        (T.single_escapes(F.lit(r"\\frac \\{ \\x"), M.COMMANDS), r"\frac \{ \\x"),
        (T.remove_all(F.lit("a <t> b"), lit("<t>")), "a b"),
        (T.substitute_all(F.lit("a <t>"), F.create_map(F.lit("<t>"), F.lit("T"))), "a T"),
        (T.canonical(F.lit(r"$\left( x \right)$ \text{ a } <choice_blank>")), "(x)a"),
        (T.slug(F.lit("..a b/数.")), "a_b_数"),
        (T.slug(F.lit("  ")), "item"),
        (T.escape_html(F.lit("<a href=\"x\">&'")), "&lt;a href=&quot;x&quot;&gt;&amp;&#x27;"),
        (T.expand_ranges(F.lit("1-3,5")), [1, 2, 3, 5]),
        (T.model_limits(F.lit("m=x=5,n=0,o=q")), {"m=x": 5}),
        (T.is_rate_limit(F.lit(200), F.lit("Too Many Requests")), True),
        (T.is_transient(F.lit(502)), True),
        (T.asset_kind(F.lit("Q-V01-P01"), F.lit("text"), F.lit(None).cast("string")), "image"),
        (T.asset_kind(F.lit("Q-V01-B01"), F.lit("table_caption"), F.lit("f")), None),
        (T.occurrences(F.lit("参考答案与试题解析"), T.INTERLEAVED_KEYWORDS), 2),
        (A.ordered_distinct(lit(" a", "b", "a ", "", " ")), ["a", "b"]),
        (A.missing_between(lit(1, 2, 5)), [3, 4]),
        (A.missing_to(lit(1, 3), F.lit(4)), [2, 4]),
        (A.labels_between(lit("a", "b", "c"), F.lit("b"), F.lit("c")), ["b", "c"]),
        (A.labels_between(lit("a", "b", "c"), F.lit("c"), F.lit("b")), []),
        (A.labels_between(lit("a", "b", "c"), F.lit("x"), F.lit("b")), []),
        (A.take_until(lit("m", "a", "m", "b"), lambda x: x == "m"), ["m", "a"]),
        (A.text_lines(lit("a\n b ", " ")), ["a", "b"]),
        (A.or_primary(lit(" "), F.lit("p")), ["p"]),
        (A.count_maps(lit("b", "a", "b")), {"a": 1, "b": 2}),
        (G.confidence(F.lit("1.5")), 1.0),
        (G.confidence(F.lit("x")), 0.0),
        (G.image_tokens(F.lit(1000), F.lit(1000)), 961),
        (G.image_tokens(F.lit(100), F.lit(100)), 64),
        (G.image_tokens(F.lit(0), F.lit(5)), 0),
        (G.side(F.array(F.lit(1.0)), 3), 0.0),
    ]


def test_expressions(spark):
    every = cases()
    row = spark.range(1).select(*(c.alias(f"c{i}") for i, (c, _) in enumerate(every))).first()
    assert [(i, row[i]) for i in range(len(every)) if row[i] != every[i][1]] == []


def test_bad_ranges(spark):
    for bad in ("3-1", "", "a"):
        with pytest.raises(Exception, match="page"):
            one(spark, T.expand_ranges(F.lit(bad)))


def test_line_base(spark):
    assert tuple(one(spark, T.line_base(F.lit("b12_l3")))) == ("b12", 3)
    assert tuple(one(spark, T.line_base(F.lit("b12")))) == ("b12", None)


def test_union_box(spark):
    rows = spark.createDataFrame([(10.2, 5.1, 20.5, 8.0), (12.0, 4.0, 30.1, 9.9)], "a double, b double, c double, d double")
    assert tuple(rows.agg(G.union_box(*(F.col(c) for c in "abcd"), 8, 100, 100).alias("x")).first().x) == (2, 0, 39, 18)
    assert rows.where("a > 99").agg(G.union_box(*(F.col(c) for c in "abcd"), 8, 100, 100).alias("x")).first().x is None


def segments_of(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", M.segments(F.col("v")).alias("s"))
    got = {r.i: [(x.is_math, x.segment) for x in r.s] for r in df.collect()}
    return [got[i] for i in range(len(values))]


def segments_by_scan(value):
    """Character by character: where an opening has its close, what lies between is math."""
    escaped = lambda i: (i - len(value[:i].rstrip("\\"))) % 2 == 1
    out, begin, at = [], 0, 0
    while at < len(value):
        pair = next(((a, b) for a, b in ((r"\(", r"\)"), (r"\[", r"\]"), ("$$", "$$"), ("$", "$")) if value.startswith(a, at) and (a[0] == "\\" or not escaped(at))), None)
        if pair is None:
            at += 1
            continue
        end = at + len(pair[0])
        while (end := value.find(pair[1], end)) >= 0 and escaped(end):
            end += len(pair[1])
        if end < 0:
            at += len(pair[0])
            continue
        end += len(pair[1])
        out += [(False, value[begin:at])] * (at > begin) + [(True, value[at:end])]
        begin = at = end
    return out + [(False, value[begin:])] * (begin < len(value))


def test_segments(spark):
    values = [r"a $x$ b \$ c $$y$$", "a $x", r"\(a\) \[b\]", None, r"\\(a\)", r"\\$a$", "$$a$ b", "$$$x$", r"\$$x$", r"$a\$b$", r"\(a\\)b\)", "$a\nb$ c"]
    got = segments_of(spark, values)
    assert got[:4] == [[(False, "a "), (True, "$x$"), (False, r" b \$ c "), (True, "$$y$$")], [(False, "a $x")], [(True, r"\(a\)"), (False, " "), (True, r"\[b\]")], []]
    assert got == [segments_by_scan(v or "") for v in values]


def test_segments_of_any_text(spark):
    rng = random.Random(7)
    values = ["".join(rng.choice("a$$\\\\()[] \n") for _ in range(rng.randrange(1, 40))) for _ in range(4000)]
    values += [r"\$$$", r"$$a\$$$", "\\" * 5 + "$$x$$", "$$$$", "$$$", "$x" + " \\y" * 20000 + "$", "a\\" * 30000 + "$"]
    got = segments_of(spark, values)
    assert all("".join(s for _, s in g) == v for v, g in zip(values, got, strict=True))
    assert [v for v, g in zip(values, got, strict=True) if g != segments_by_scan(v)] == []


def test_blanks(spark):
    cases = [
        ("x ____ y", "fill_blank", "x <blank> y", False), ("x (  )", "single_choice", "x <choice_blank>", False), ("$a<blank>$", "fill_blank", "$a$ <blank>", True), ("x ____", "solution", "x ____", False),
        ("x ()", "fill_blank", "x ()", False), ("x () （<blank>）", "multiple_choice", "x <choice_blank> <choice_blank>", False), ("$<blank>$ is", "fill_blank", "<blank> is", True), (r"\_ and a\_b and \\_", "fill_blank", r"<blank> and a\_b and \\_", False),
        (r"is $\underline{\quad}$ or \underline{ \hspace{2em} }", "fill_blank", "is <blank> or<blank>", False), (r"\(a  <blank>  b < blank >\) c", "fill_blank", r"\(a b\) <blank> <blank> c", True), (None, "fill_blank", "", False), ("", None, "", False), (None, None, "", False),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, t string, q string, want string, moved boolean")
    got = df.select("i", M.normal_blanks(F.col("t"), F.col("q")).alias("b"), M.blanks_in_math(F.col("t")).alias("inside")).orderBy("i").collect()
    assert [(r.b.text, r.b.moved) for r in got] == [c[2:] for c in cases]
    assert got[2].inside == ["<blank>"] and got[0].inside == []


def test_parts(spark):
    cases = {"$x$": ("$", "x", "$"), "$$x$$": ("$$", "x", "$$"), r"\(x\)": (r"\(", "x", r"\)"), r"\[x y\]": (r"\[", "x y", r"\]"), "plain": ("", "plain", ""), "$$$$": ("$$", "", "$$")}
    got = spark.createDataFrame([(c,) for c in cases], "s string").select("s", M.parts(F.col("s")).alias("p")).collect()
    assert {r.s: tuple(r.p) for r in got} == cases


def test_option_math(spark):
    cases = {
        "0 < a < 1 且 x > 2。": r"$0 < a < 1 \text{ 且 } x > 2$。", "甲 > 1": "甲 > 1", "$x$": "$x$", "<image01>": "<image01>", r"x<2 \text{且} y>1 或 z=3": r"$x<2 \text{ 且 } y>1 \text{ 或 } z=3$",
        r"\frac{1}{2} \text{当且仅}": r"\frac{1}{2} \text{当且仅}", "word": "word", " x = 1. ": "$x = 1$.", "$x$ 或 y>1": r"$x \text{ 或 } y>1$", r"\text{或  且} x=1": r"$\text{或 且} x=1$", "": "",
    }
    got = spark.createDataFrame([(c,) for c in cases], "s string").select("s", M.option_math(F.col("s")).alias("o")).collect()
    assert {r.s: r.o for r in got} == cases


def test_standalone(spark):
    rows = spark.createDataFrame([("A, B", "single_choice"), (r"\frac{1}{2}", "solution"), ("x 是", "fill_blank"), ("12", "solution"), ("a b", "solution"), ("a b", "fill_blank")], "t string, q string")
    assert [r.x for r in rows.select(M.wrap_standalone(F.col("t"), F.col("q")).alias("x")).collect()] == ["$A, B$", r"$\frac{1}{2}$", "x 是", "$12$", "a b", "$a b$"]


def test_lint(spark):
    rows = [("x = 1 and $y$",), (r"$\left( x$",), (r"$x \mid y$，使得 $z$",), ("<blank>",), ("plain",), (None,), (r"\frac{1}{2} a_1",)]
    got = M.with_lint(spark.createDataFrame(rows, "t string"), "t").collect()
    assert [r.reasons for r in got] == [
        ["math_relation_outside_math"], ["left_right_count_mismatch"], ["math_condition_split_across_text_connector"], [], [], [], ["latex_command_outside_math", "subsup_outside_math"]
    ]


def test_match_ratio_finds_text_after_the_cut():
    import pandas as pd

    from leafmill.functions import mathtext

    long = "".join(f"word{i}" for i in range(100))
    assert list(mathtext.match_ratio.func(pd.Series([long + "the passage held", "short"]), pd.Series(["the passage held", "short"]))) == [1.0, 0.0]


def _plain_encoding():
    import base64

    import tiktoken

    from leafmill.functions import tokens

    lines = open(tokens.VOCABULARY, "rb").read().split(b"\n")
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}
    return tiktoken.Encoding("own", pat_str=tokens.WORDS, mergeable_ranks=ranks, special_tokens={})


def test_encoder_equals_a_known_one():
    import random

    from leafmill.functions import tokens

    known, own, rng = _plain_encoding(), tokens.Encoder(), random.Random(5)
    alphabet = "aab e\n\t '.,s12é中文字🙂ßΩ-_"
    texts = ["", " ", "\n", "it's we'll", "a" * 5000, "中文" * 3000, "ab" * 999 + " " * 700 + "x", *("".join(rng.choices(alphabet, k=rng.randrange(1, 200))) for _ in range(400))]
    for text in texts:
        assert own.encode(text) == known.encode_ordinary(text), text[:80]
    assert own.encode(None) == []


def test_token_estimates_equal_joined_conversations(spark):
    from leafmill.operators import budget

    rows = [(1, "user", "Hi there "), (1, None, "  line\n\n"), (1, " ", ""), (2, "assistant", None), (3, "user", "\n"), (3, "a", "x" * 3000), (None, "user", "no conversation")]
    df = spark.createDataFrame(rows, "conv_id long, role string, text string")
    known, joined = _plain_encoding(), {}
    for conv, role, text in rows:
        joined.setdefault(conv, []).append(f"{(role or '').strip() or 'user'}: {text or ''}")
    got = {r.conv_id: r for r in budget.token_estimates(df, "conv_id", "role", "text").collect()}
    assert {k: r.text_tokens for k, r in got.items()} == {k: len(known.encode_ordinary("\n".join(v))) for k, v in joined.items()}
    assert got[1].total_tokens == got[1].text_tokens + 2048 and got[1].message_count == 3
    assert budget.token_estimates(df.limit(0), "conv_id", "role", "text").count() == 0


def test_similarity_equals_the_known_measure():
    import random
    from difflib import SequenceMatcher

    rng = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rng.choices("abc题🙂", k=rng.randrange(0, 40))) for _ in range(2))
        b = b if rng.random() < 0.5 else a[: rng.randrange(0, 40)] + b
        assert M.similarity(a, b) == SequenceMatcher(None, a, b, autojunk=False).ratio(), (a, b)
    long = "".join(rng.choices("abcdefgh", k=600))
    assert M.similarity(long, long[3:]) == SequenceMatcher(None, long[:260], long[3:263], autojunk=False).ratio()


def test_best_role_equals_comparing_every_pair(spark):
    """What the bounds decide is what the measure would say, for random near and far texts, nulls and blanks."""
    import random

    import pandas as pd

    rng, rows = random.Random(11), []
    for i in range(200):
        a = "".join(rng.choices("abcdef 题，$", k=rng.randrange(0, 60)))
        edit = "".join(c if rng.random() < 0.8 else rng.choice("xyz") for c in a)
        rows.append((i, rng.choice([a, a, None]), rng.choice([edit, a[3:], "other text of no kin", None]), "".join(rng.choices("abcdef", k=30))))
    df = spark.createDataFrame(rows, "i int, t string, p string, q string")
    got = {r.i: (r.best_role, r.best_ratio) for r in M.best_role(df, "t", {"p": "p", "q": "q"}).collect()}
    for i, t, p, q in rows:
        x, y = M.match_ratio.func(pd.Series([t, t]), pd.Series([p, q]))
        best = (("p", x) if x >= y else ("q", y)) if max(x, y) >= 0.58 else (None, None)
        assert got[i] == best, (t, p, q)
