"""Mixing, quality, language, decontamination, HTML and quotation linking."""

import collections
import random
import zlib

import numpy as np
import pytest
from helpers import corpus, frame, words
from pyspark.sql import functions as F

from leafmill.llm import decontaminate, html_extract, language_id, mixing, quality, quotes
from test_dedup import SCHEMA, WORD, rows_of


def mix_want(rows):
    sizes = [len(WORD.findall(t or "")) for _, t, *_ in rows]
    by = collections.defaultdict(int)
    for (*_, s), n in zip(rows, sizes, strict=True):
        by[s] += n
    names = sorted(by, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 2 * by[s]}
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 2.0 * by[s]
            left -= 2 * by[s]
        open_ -= full
    return by, target


def test_mixing(spark):
    rows = corpus()
    by, target = mix_want(rows)
    docs = frame(spark, rows)
    got = mixing.mix_sources(docs, block_rows=4)
    total = collections.Counter()
    again = rows_of(mixing.mix_sources(docs.repartition(5), block_rows=4).select("doc_id", "size", "taken"))
    assert again == rows_of(got.select("doc_id", "size", "taken"))
    sources = {(s, t) for s, t in target.items()}
    for r in got.collect():
        assert 0 <= r.taken <= 2 * r.size
        (s,) = [s for s, t in sources if by[s] == r.source_size and abs(t - r.target) < 1e-6]
        total[s] += r.taken
    assert {s: total[s] for s in target} == {s: int(t + 1e-9) for s, t in target.items()}
    assert got.count() == len(rows)
    assert mixing.mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
    mixed = mixing.mixed_corpus(docs)
    assert mixed.agg(F.sum("taken")).first()[0] == sum(total.values())


def test_mixing_keeps_repeated_rows_apart(spark):
    """Copies of a row that a budget cuts between stay as many rows as they are."""
    text = " ".join(words(random.Random(1), 10))
    rows = [(1, text, "en", "a")] * 4 + [(2, "one two three", "en", "b"), (3, text + " more", "en", None), (None, text, None, "a"), (4, None, "en", "a"), (4, "", "en", "c")]
    docs = frame(spark, rows)
    plan, mixed = mixing.mix_sources(docs).where("taken > 0").collect(), mixing.mixed_corpus(docs).collect()
    key = lambda r: (r.doc_id, r.size, r.source_size, r.target, r.taken)
    assert sorted(map(key, plan), key=repr) == sorted(map(key, mixed), key=repr)
    assert len({r.taken for r in mixed if r.doc_id == 1}) >= 1 and all(len(WORD.findall(r.text)) == r.size for r in mixed)


def quality_rows(n=160):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        line = lambda: " ".join(words(rng, 12)).capitalize() + "." if good else " ".join(w + "###" for w in words(rng, 9)).upper()  # noqa: E731, B023
        rows.append((i, "\n".join(line() for _ in range(rng.randrange(1, 6))), "en", "s"))
        if i % 2:
            labels.append((i, int(good), 0))
    return rows, labels


def test_quality(spark):
    rows, labels = quality_rows()
    extra = [(1000, "", "en", "s"), (1001, None, "en", "s"), (None, "Some words.", None, None), (1002, " \n ", "en", "s"), (5, rows[5][1], "en", "s")]
    table = spark.createDataFrame([*labels, (None, 1, 0), (3, None, 0), (9999, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify_quality(frame(spark, [*rows, *extra]), table).collect()
    assert len(got) == len(rows) + len(extra)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id is not None and r.doc_id < 160:
            assert r.predicted == int(r.doc_id % 3 > 0)
    none = quality.classify_quality(spark.createDataFrame([], SCHEMA), table)
    assert none.count() == 0
    unlabelled = quality.classify_quality(frame(spark, rows[:3]), table.limit(0)).collect()
    assert {r.score for r in unlabelled} == {0.5}
    kept = quality.quality_filter(frame(spark, rows), table)
    assert kept.columns == frame(spark, rows).columns
    assert {r.doc_id for r in kept.collect()} == {i for i in range(160) if i % 3}


def test_forward_backward_by_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    first = np.array([0, 3, 3, 4, 9])
    good, link = rng.normal(size=9), rng.normal(size=(2, 2))
    p, (pairs, doc), z = quality.forward_backward(good, link, first)
    for d, (a, b) in enumerate(zip(first, first[1:], strict=False)):
        if a == b:
            continue
        weights = {y: np.exp(sum(good[a + i] * s for i, s in enumerate(y)) + sum(link[s, t] for s, t in zip(y, y[1:], strict=False))) for y in itertools.product((0, 1), repeat=b - a)}
        total = sum(weights.values())
        assert np.isclose(z[d], np.log(total))
        for i in range(b - a):
            assert np.isclose(p[a + i], sum(w for y, w in weights.items() if y[i]) / total)
        if b - a > 1:
            seen = sum(w * sum((y[0], y[1]) == (1, 0) for _ in [0]) for y, w in weights.items()) / total
            assert np.isclose(pairs[doc == d][0, 1, 0], seen)


def test_segmentations_are_summed():
    names = ["▁", "a", "b", "ab", "▁a", "ba", "▁ababa", "abababababab"]
    table = language_id.Pieces(names)
    probs = np.array([[0.1], [0.2], [0.3], [0.15], [0.05], [0.2], [0.1], [0.02]])
    logs = language_id.log_table(probs)
    p = dict(zip(names, probs[:, 0], strict=True)) | {"c": language_id.UNSEEN}
    cases = ["abab", "a", "ababa", "abcba", "ab" * 9, "b" * 3]
    points = np.frombuffer("".join(cases).encode("utf-32-le"), np.uint32)
    e = np.cumsum([len(w) for w in cases])
    s = e - [len(w) for w in cases]

    def total(word):
        return sum(p[x] * (total(word[len(x) :]) if word[len(x) :] else 1) for x in p if word.startswith(x))

    want = [np.log(total("▁" + w)) for w in cases]
    assert np.allclose(language_id.word_logs(table, logs, points, s, e)[:, 0], want)
    lattice = language_id.Lattice(table, points, s, e)
    assert np.allclose(lattice.backward(logs)[lattice.first, 0], np.array(want)[lattice.order])
    # A long word neither underflows nor is cut: its sum obeys the recursion of its alphabet.
    long = np.full(5000, ord("b"), np.uint32)
    got = language_id.word_logs(table, logs, long, np.array([0]), np.array([5000]))[0, 0]
    assert np.isclose(got, np.log(0.1) + 5000 * np.log(0.3))


def expected_counts(table, names, p, word):
    """Expected number of each piece in a word, by listing its segmentations."""
    found = collections.Counter()
    total = 0.0

    def walk(rest, used, chance):
        nonlocal total
        if not rest:
            total += chance
            for x in used:
                found[x] += chance
        for x in names:
            if rest.startswith(x):
                walk(rest[len(x) :], [*used, x], chance * p[x])

    walk("▁" + word, [], 1.0)
    return {x: v / total for x, v in found.items()}


def test_one_round_of_fitting_by_enumeration():
    names = sorted(["▁", "a", "b", "ab", "▁a", "ba"])
    table, p = language_id.Pieces(names), dict.fromkeys(["▁", "a", "b", "ab", "▁a", "ba"], 1 / 6)
    words_, counts = ["abab", "b", "baab"], np.array([[2.0, 0], [1, 1], [0, 3]])
    got = language_id.fit(table, words_, counts, rounds=1)
    for g in (0, 1):
        total = np.full(6, 0.01)
        for w, n in zip(words_, counts[:, g], strict=True):
            for x, v in expected_counts(table, names, p, w).items():
                total[names.index(x)] += n * v
        assert np.allclose(got[:, g], total / total.sum())


def test_language(spark):
    pytest.importorskip("sentencepiece")
    rng = random.Random(4)
    stock = {"en": "the of and with house water light".split(), "de": "der und mit nicht haus wasser licht".split(), "fr": "le et avec maison eau lumière été".split()}
    rows = [(i, " ".join(rng.choices(stock[lang], k=25)), lang, "s") for i, lang in enumerate(sorted(stock) * 30)]
    extra = [(500, None, "en", "s"), (501, "123 !!", "en", "s"), (502, "", None, "s"), (None, "the house and water", None, "s"), (503, "Ünïcode" * 50, None, "s"), (0, rows[0][1], "de", "s")]
    got = language_id.identify_language(frame(spark, rows + extra)).collect()
    assert len(got) == len(rows) + len(extra)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        if r.doc_id in (500, 501, 502):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None and r.doc_id < 90:
            assert r.lang_pred == rows[r.doc_id][2]
    rare = [(700 + i, "кот и дом", "ru", "s") for i in range(4)]
    few = language_id.identify_language(frame(spark, rows + rare), per_lang=10).collect()
    assert {r.lang_pred for r in few if r.doc_id >= 700} == {"ru"}
    assert language_id.identify_language(spark.createDataFrame([], SCHEMA)).count() == 0
    nothing = language_id.identify_language(spark.createDataFrame([(1, "word", None, None)], SCHEMA)).first()
    assert (nothing.lang_pred, nothing.score) == ("und", 0.0)


def edits(a, b):
    """Edit distance of a to its best stretch in b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_leaks(spark):
    rng = random.Random(8)
    items = [(i, " ".join(words(rng, rng.randrange(6, 50), 5000))) for i in range(12)] + [(20, ""), (21, None), (22, "two words"), (23, "")]
    rows, planted, edited = [], set(), set()
    for i in range(80):
        w = words(rng, rng.randrange(20, 120), 5000)
        k = i % 12
        passage = items[k][1].split()
        if i % 4 == 1:
            planted.add((i, k))
        elif i % 4 == 2 and len(passage) >= 20:
            for _ in range(len(passage) // 10):
                passage[rng.randrange(len(passage))] = "edited"
            planted.add((i, k))
            edited.add((i, k))
        else:
            passage = []
        at = rng.randrange(len(w))
        rows.append((i, " ".join(w[:at]) + "\n" + " ".join(passage).upper() + "!!! " + " ".join(w[at:]), "en", "s"))
    rows += [(900, None, None, None), (901, "", None, None), (None, items[0][1], None, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(frame(spark, rows), bench)
    found = {(r.doc_id, r.item_id): r for r in got.collect()}
    assert planted - edited <= set(found) and (None, 0) in found
    assert len(edited - set(found)) <= 0.1 * len(edited) and edited
    text = {i: decontaminate_words(t) for i, t, *_ in rows}
    for (d, k), r in found.items():
        a = decontaminate_words(items[k][1])
        assert r.distance == edits(a, text[d]) <= 0.2 * len(a)
    kept = decontaminate.decontaminate(frame(spark, rows), bench)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({i for i, *_ in rows if i is not None} - {d for d, _ in found})
    assert decontaminate.find_leaks(frame(spark, rows), bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(spark.createDataFrame([], SCHEMA), bench).count() == 0


def test_leaks_wherever_the_edits_lie(spark):
    rng = random.Random(11)
    items = [(i, " ".join(words(rng, n, 50_000))) for i, n in enumerate((4, 5, 9, 14, 25, 49, 60, 100, 160))]
    rows, want = [], {}
    for i, text in items:
        m = len(text.split())
        k = m // 5
        places = {"head": range(k), "tail": range(m - k, m), "third": rng.sample(range(max(k, m // 3)), k), "spread": range(2, m, 5)[:k]}
        for at in (set(p) for p in places.values()):
            for edit in (lambda w: ["edited"], lambda w: [], lambda w: ["added", w]):
                passage = [x for j, w in enumerate(text.split()) for x in (edit(w) if j in at else [w])]
                want[len(rows), i] = len(at)
                rows.append((len(rows), " ".join([*words(rng, 30, 50_000), *passage, *words(rng, 30, 50_000)]), "en", "s"))
    got = decontaminate.find_leaks(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r.doc_id, r.item_id): r.distance for r in got}
    assert set(found) == set(want)
    assert all(d <= want[x] for x, d in found.items())


def test_leaks_in_scripts_without_spaces_and_short_items(spark):
    han, thai = "若函数在区间上单调递增，则实数的取值范围是多少？", "ประเทศไทยมีกี่จังหวัด"
    items = [(1, han), (2, thai), (3, "two words"), (4, "single"), (5, "东京"), (6, "！？"), (7, "若函数在区间上单调递增，则整数的取值范围是什么？")]
    rows = [
        (1, f"前文说明{han}后文", "zh", "s"), (2, f"ก่อน{thai}หลัง", "th", "s"), (3, "here Two, WORDS are", "en", "s"), (4, "not two wordsmiths", "en", "s"), (5, "(single)", "en", "s"),
        (6, "在东京都", "ja", "s"), (7, "东和京", "ja", "s"), (8, "别的文字，没有题目。", "zh", "s"), (9, "two words，single", "en", "s"), (10, "singles ！？", "en", "s"),
    ]
    got = decontaminate.find_leaks(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (1, 7), (2, 2), (3, 3), (5, 4), (6, 5), (9, 3), (9, 4)}
    assert {(r.item_id, r.distance) for r in got if r.doc_id == 1} == {(1, 0), (7, 3)}


def decontaminate_words(t):
    import re

    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in t or ""))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site name</header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><!-- c --><div class="ad">Buy now, this is a long advertisement text that goes on.</div>
%s<aside>See also this</aside><div id="comments"><p>A reader says something rather long about the article above here.</p></div>
<form><label>Mail</label><input></form><footer>&copy; site &middot; 2024</footer></body></html>"""


def test_html(spark):
    article = "<article><h1>Title &amp; more</h1><p><b>First   para\ngraph with <a href='x'>a link</a>.<br>Next line.<p>Yes.</p><ul><li>One point<li>Two</ul></article>"
    plain = "<div><p>" + "</p><p>".join(f"Paragraph {i} of the main text, which has a good many words in it so that its ratio is high." for i in range(4)) + "</p></div>"
    pages = [(1, "u", PAGE % article), (2, "u", PAGE % plain), (3, "u", None), (4, None, ""), (5, "u", "<p>cut off <b>here"), (1, "u", PAGE % article), (6, "u", "<nav>only menu</nav>"), (7, "u", "plain &lt;text&gt;")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = collections.defaultdict(list)
    for r in html_extract.extract_pages(df).collect():
        assert r.n_chars == len(r.text)
        got[r.page_id].append(r.text)
    assert got[1] == ["Title & more\nFirst para graph with a link. Next line.\nYes.\nOne point\nTwo"] * 2
    assert got[2] == ["\n".join(f"Paragraph {i} of the main text, which has a good many words in it so that its ratio is high." for i in range(4))]
    assert got[3] == got[4] == got[6] == [""]
    assert got[5] == ["cut off here"] and got[7] == ["plain <text>"]
    assert html_extract.extract_pages(df.limit(0)).count() == 0


def test_links_inside_an_article_stay():
    items = [f"Reference number {i}" for i in range(15)]
    listed = "<ul>" + "".join(f"<li><a href='/{x}'>{x}</a></li>" for x in items) + "</ul>"
    nav = "<nav><a href='/'>Home</a></nav>"
    assert html_extract.extract(f"{nav}<article><p>Before the list stands a paragraph.</p>{listed}<p>After it as well.</p><aside>Not this</aside></article>").split("\n") == [
        "Before the list stands a paragraph.", *items, "After it as well."
    ]
    assert html_extract.extract(f"{nav}<main>{listed}</main><p>outside</p>").split("\n") == items


def test_boilerplate_names():
    for name in ("ad", "top-banner", "site_footer wide", "main-menu", "article-share", "Comments"):
        assert html_extract.is_boilerplate(name)
    for name in ("", "no-sidebar page", "story", "shadow", "loading", "article-body", "content-sidebar-wrap", "related-work", "text"):
        assert not html_extract.is_boilerplate(name)


PROSE = [f"Paragraph {i} of the main text, which has a good many words in it so that its ratio of text to tags is high." for i in range(6)]


def test_wrong_hints_do_not_lose_the_article():
    paragraphs = "".join(f"<p>{x}</p>" for x in PROSE)
    menu = "<nav><a href='/'>Home</a></nav>"
    want = "\n".join(PROSE)
    for page in (
        f"<body><form id='aspnetForm'>{menu}<div class='body'>{paragraphs}</div></form></body>",
        f"<body>{menu}<div class='content-sidebar-wrap'>{paragraphs}</div></body>",
        f"<body>{menu}<div class='sidebar'>{paragraphs}</div></body>",
        f"<body>{menu}<article>{paragraphs}<div class='ad'>Buy this now, it is a very good offer.</div><form>Mail <input></form></article></body>",
    ):
        assert html_extract.extract(page) == want
    related = "<div class='related-work'><h2>Related work</h2><p>Others have written of this before, and at length.</p></div>"
    assert html_extract.extract(f"<article>{paragraphs}{related}</article>").split("\n")[-2:] == ["Related work", "Others have written of this before, and at length."]


def test_comments_notices_and_share_bars_go_however_long():
    remarks = "".join(f"<p>Remark {i}: a reader says a good deal about this, and more than the article itself ever did.</p>" for i in range(12))
    two = "<p>The first of two sentences.</p><p>The second one is here.</p>"
    want = "The first of two sentences.\nThe second one is here."
    for page in (
        f"<article>{two}<section class='comments'>{remarks}</section></article>",
        f"<body><div class='content'>{two}</div><section class='comments'>{remarks}</section></body>",
        f"<main>{two}<div class='discussion'>{remarks}</div></main>",
        f"<article>{two}<div class='disclaimer'>This site uses cookies.</div></article>",
        f"<article><header><a href='/s'>Share</a><div><a href='/t'>Tweet</a></div></header>{two}</article>",
        f"<body><div id='comments-list'>{remarks}</div><div class='content'>{two}</div></body>",
    ):
        assert html_extract.extract(page) == want, page
    assert html_extract.extract(f"<article><header><h1><a href='/x'>Title</a></h1><p>By <a href='/me'>me</a></p></header>{two}</article>") == f"Title\nBy me\n{want}"
    assert html_extract.extract(f"<body><div class='comments'>{remarks}</div></body>") == ""


def test_ratios_smoothing_and_clusters_select():
    """No mark and no hint: dense lines are the article; a short line between them is carried by smoothing."""
    links = "".join(f"<p><a href='/{i}'>Link {i}</a></p>" for i in range(12))
    page = f"<body>{links}" + "".join(f"<p>{x}</p>" for x in PROSE[:3]) + "<p>Yes.</p>" + "".join(f"<p>{x}</p>" for x in PROSE[3:]) + f"{links}</body>"
    got = html_extract.extract(page).split("\n")
    assert [x for x in got if not x.startswith("Link")] == [*PROSE[:3], "Yes.", *PROSE[3:]]
    parser = html_extract.Lines()
    parser.feed(page)
    parser.close()
    assert "Yes." not in html_extract.content(parser.lines, sigma=0.01)


def level_by_definition(ratio, sigma):
    n, r = len(ratio), int(np.ceil(3 * sigma))
    weight = lambda d: np.exp(-(d * d) / (2 * sigma * sigma)) if abs(d) <= r else 0.0
    return [sum(weight(i - j) * ratio[j] for j in range(n)) / sum(weight(i - j) for j in range(n)) for i in range(n)]


def test_smoothing_and_threshold_by_definition():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 60):
        x = rng.random(n).tolist()
        assert np.allclose(html_extract.smooth(x), level_by_definition(x, html_extract.SIGMA))
        cut = html_extract.two_means(x)
        low, high = [v for v in x if v < cut], [v for v in x if v >= cut]
        if low and high:
            assert np.isclose(cut, (np.mean(low) + np.mean(high)) / 2)


def test_long_pages():
    paragraphs = [f"Paragraph number {i} " + "with several words of plain text in it " * (i % 9 + 1) for i in range(2000)]
    page = "<body><nav><a href='/'>Home</a></nav><article>" + "".join(f"<p>{x}</p>" for x in paragraphs) + "</article><footer>end</footer></body>"
    assert len(page) > 2 * html_extract.PIECE
    assert html_extract.extract(page) == "\n".join(x.strip() for x in paragraphs)


def test_quote_parsing():
    body, found = quotes.parse("Hi\n\nOn Monday Bo wrote:\n> first line\n> second\n> > deeper one here\nMy answer.\n>> nested")
    assert body == "Hi\nMy answer." or body == "Hi\n\nMy answer."
    assert found == [(1, "first line\nsecond"), (2, "deeper one here"), (2, "nested")]
    assert quotes.parse(None) == ("", [])
    assert quotes.parse("> only a quote here") == ("", [(1, "only a quote here")])


def test_quotes(spark):
    first, second = "What is the capital of this country?", "It is the largest city,\nas everyone knows well."
    rows = [
        (1, 0, "user", first), (1, 1, "assistant", second), (1, 2, "user", f"> {first}\nThat was my question."), (1, 3, "user", "> It is the largest city,\n> as everyone knows well.\nAre you sure about that?"),
        (1, 4, "assistant", "> > as everyone knows well.\n> Are you sure about that?\nYes, quite sure."), (2, 0, "user", f"> {first}\nSame question elsewhere."), (2, 1, None, None),
        (3, 0, "user", "> nobody ever said this sentence\nHm."), (None, 0, "user", "no conversation"), (1, 0, "user", first),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("body", F.lit("clash"))
    got = quotes.format_chats(df)
    by = {(r.conv_id, r.turn): r for r in got.collect()}
    assert got.count() == len(rows)
    parent = {k: (r.parent_conv, r.parent_turn) for k, r in by.items()}
    assert parent[1, 2] == (1, 0) and parent[1, 3] == (1, 1) and parent[1, 4] == (1, 3) and parent[2, 0] == (1, 0)
    assert parent[3, 0] == parent[2, 1] == parent[1, 0] == (None, None)
    assert (by[3, 0].n_quotes, by[3, 0].n_linked) == (1, 0)
    assert by[2, 1].formatted == "<|unknown|>\n\n<|end|>\n" and by[1, 4].formatted == "<|assistant|>\nYes, quite sure.\n<|end|>\n"
    chat = [(r.conv_id, r.turn) for r in sorted((r for r in got.collect() if r.chat_id == 1), key=lambda r: r.position)]
    assert chat == [(1, 0), (1, 0), (1, 2), (2, 0), (1, 1), (1, 3), (1, 4)]
    assert {(r.conv_id, r.turn): r.depth for r in got.collect() if r.chat_id == 1} == {(1, 0): 0, (1, 2): 1, (2, 0): 1, (1, 1): 0, (1, 3): 1, (1, 4): 2}
    built = quotes.build_chats(df, part=3).orderBy("part").collect()
    assert sum(r.n_messages for r in built) == len(rows) and max(r.n_messages for r in built) <= 3
    assert "".join(r.text for r in built if r.chat_id == 1) == "".join(r.formatted for r in sorted((r for r in got.collect() if r.chat_id == 1), key=lambda r: r.position))
    assert quotes.format_chats(df.limit(0)).count() == 0


def test_quotes_without_an_original_stay(spark):
    """Only what is found elsewhere goes: whole quotes, quotes whose every line is found, not those with a line of their own; copies of a row apart."""
    rows = [
        (1, 0, "a", "The first long sentence here.\nAnd then a second sentence."), (1, 1, "b", "Something else in between."),
        (1, 2, "a", "Al wrote:\n> The first long sentence here.\nmine"), (1, 3, "b", "> And then a second sentence.\n> Something else in between.\nboth lines"),
        (1, 4, "a", "top\n\nAl wrote:\n> And then a second sentence.\n> never said by anyone\n\nbottom"), (2, 0, "a", "> nowhere to be found\n> > deeper one\n"),
        (3, 0, "a", "> nowhere to be found\nx"), (3, 0, "a", "> The first long sentence here.\nx"), (3, 1, "a", ">\n> \nblank"),
    ]
    got = sorted((r.conv_id, r.turn, r.formatted.split("\n", 1)[1].removesuffix("\n<|end|>\n")) for r in quotes.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect())
    assert got == [
        (1, 0, rows[0][3]), (1, 1, rows[1][3]), (1, 2, "mine"), (1, 3, "both lines"), (1, 4, "top\n\nAl wrote:\n> And then a second sentence.\n> never said by anyone\n\nbottom"),
        (2, 0, "> nowhere to be found\n> > deeper one"), (3, 0, "> nowhere to be found\nx"), (3, 0, "x"), (3, 1, "blank"),
    ]


def test_quotes_of_later_conversations_and_short_ones(spark):
    a, b, c, d = (f"a sentence that conversation {x} begins with" for x in "abcd")
    rows = [
        (1, 0, "user", f"> {b}\nAs somebody wrote elsewhere."), (5, 0, "user", b),
        # a cycle of three across conversations, with a tail, and a cycle whose first message has an ordered passage too
        (11, 0, "user", f"{a}\n> {c} again"), (12, 0, "user", f"{b} again\n> {a}"), (13, 0, "user", f"{c} again\n> {b} again"), (10, 0, "user", f"> {b} again"),
        (20, 0, "user", "short but ordered"), (21, 0, "user", f"{d}\n> {d} once more\n\n> short but ordered"), (22, 0, "user", f"{d} once more\n> {d}"),
        (30, 0, "user", "Sounds good"), (30, 1, "user", "好的"), (30, 2, "user", "> Sounds good\nFine."), (30, 3, "user", "> 好的\n谢谢"), (30, 4, "user", "Yes.\nSee you on Monday then."),
        (30, 5, "user", "> Yes.\nGreat."), (31, 0, "user", "> Sounds good\nNot said here."), (31, 1, "user", "> later on"), (31, 2, "user", "later on"),
        (32, 0, "user", "> nothing earlier holds this line\nSo?"), (32, 1, "user", "nothing earlier holds this line"),
    ]
    got = quotes.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    parent = {k: (r.parent_conv, r.parent_turn) for k, r in by.items()}
    assert parent[1, 0] == (5, 0) and by[1, 0].n_linked == 1 and by[1, 0].chat_id == 5
    assert parent[11, 0] == (None, None) and parent[12, 0] == (11, 0) and parent[13, 0] == (12, 0) and parent[10, 0] == (12, 0)
    assert {by[k, 0].chat_id for k in (10, 11, 12, 13)} == {11} and by[11, 0].n_linked == 1
    assert parent[21, 0] == (20, 0) and parent[22, 0] == (21, 0)
    assert parent[30, 2] == (30, 0) and parent[30, 3] == (30, 1) and parent[30, 5] == (30, 4)
    assert {parent[31, 0], parent[31, 1], parent[32, 0]} == {(None, None)}


def test_long_threads(spark):
    rows = [(1, i, "user", (f"> message number {i - 1:04d} of the thread\n" if i else "") + f"message number {i:04d} of the thread") for i in range(37)]
    got = quotes.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r.turn: (r.depth, r.position) for r in got} == {i: (i, i) for i in range(37)}


def chats_want(rows):
    """Positions and parents by brute force: every quote is compared with every message."""
    first = -(1 << 62)
    keys = [(first if c is None else c, first if t is None else t) for c, t, *_ in rows]
    own, quoted = {}, collections.defaultdict(list)
    for key, (*_, text) in zip(keys, rows, strict=True):
        body, found = quotes.parse(text)
        own.setdefault(key, []).append((quotes.normal(body), quotes.passages(body)))
        for depth, q in found:
            quoted[key] += [(depth, p, p == quotes.normal(q)) for p in quotes.passages(q)]
    parent, n_linked = {}, collections.Counter()
    for key, found in quoted.items():
        best = []
        for depth, p, whole in found:
            short = len(p) < quotes.MIN_PASSAGE
            fits = lambda k: any(p in ps and (not short or whole or p == w) for w, ps in own[k])  # noqa: E731, B023
            near = [k for k in own if k[0] == key[0] and k[1] < key[1] and fits(k)]
            other = [] if short or near else sorted(k for k in own if fits(k) and (k[0] != key[0]))
            source = max(near) if near else other[0] if other else None
            if source:
                n_linked[key] += 1
                if depth == 1:
                    best.append((len(p), source))
        if best:
            parent[key] = max(best)[1]
    def root(k):
        seen = set()
        while k in parent:
            assert k not in seen, "the fixture has no cycles"
            seen.add(k)
            k = parent[k]
        return k
    children = collections.defaultdict(list)
    for k in sorted(set(keys)):
        if k in parent:
            children[parent[k]].append(k)
    chats = collections.defaultdict(list)
    def walk(k, chat, depth):
        chats[chat].extend([(k, depth)] * len(own[k]))
        for c in children[k]:
            walk(c, chat, depth + 1)
    for k in sorted(set(keys)):
        if k not in parent:
            walk(k, k[0], 0)
    null = lambda x: None if x == first else x
    return sorted(
        ((null(chat), i, null(k[0]), null(k[1]), depth, *map(null, parent.get(k, (first, first))), n_linked[k]) for chat, found in chats.items() for i, (k, depth) in enumerate(found)), key=repr
    )


def test_chats_by_brute_force(spark):
    """Nested quotes, a phrase that many repeat, quotes across conversations, nulls, negative ids and repeated rows."""
    rng = random.Random(21)
    said: dict = {}
    rows = []
    for conv in (-3, 1, 2, 7, 2500, None):
        for turn in (None, *range(-1, 12)) if conv in (1, None) else range(14):
            line = "the one phrase that everybody here repeats" if rng.random() < 0.2 else " ".join(words(rng, rng.randrange(1, 9), 3000))
            text = line
            earlier = [k for k in said if k[0] == conv]
            if earlier and rng.random() < 0.6:
                quote = said[rng.choice(earlier)]
                mark = "> > " if rng.random() < 0.2 else "> "
                text = f"{mark}{quote}\n{line}"
            elif conv in (7, 2500) and rng.random() < 0.5:
                text = f"> {said[rng.choice([k for k in said if k[0] == 2])]}\n{line}"
            said[conv, turn] = line
            rows.append((conv, turn, "user", text))
    rows += rows[3:6]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = quotes.format_chats(df).select("chat_id", "position", "conv_id", "turn", "depth", "parent_conv", "parent_turn", "n_linked")
    want = chats_want(rows)
    assert rows_of(got) == want
    assert sum(r[4] > 0 for r in want) > 15 and max(r[4] for r in want) >= 2


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rows, labels = quality_rows(90)
    rng = random.Random(6)
    good = lambda n: " ".join(words(rng, n, 4000)).capitalize() + "."
    base = [good(60) for _ in range(6)]
    items = [(0, good(20))]
    near = " ".join([*base[0].split()[:-2], "other", "end."])
    texts = [*base, base[1], "  ".join(base[2].split(" ")), near, good(30) + " " + items[0][1] + " " + good(30)]
    rows = [(i, t + ("\n" + good(40) if i % 3 else ""), lang, s) for i, t, lang, s in rows] + [(200 + i, t, "en", "t") for i, t in enumerate(texts)]
    frame(spark, rows, extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, ids = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if i < 4:
            assert out.columns == ["doc_id", "text", "lang", "source"]
        out.write.parquet(f"{tmp_path}/stage{i}")
        docs = spark.read.parquet(f"{tmp_path}/stage{i}")
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
    everything = {r[0] for r in rows}
    assert everything - ids[0] == {i for i in range(90) if i % 3 == 0}
    assert ids[0] - ids[1] == {206, 207}
    assert ids[1] - ids[2] == {208}
    assert ids[2] - ids[3] == {209}
    assert ids[4] <= ids[3] and docs.agg(F.sum("taken")).first()[0] > 0
    ran = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in ran.collect()} == ids[4]


def test_pipeline_takes_odd_rows(spark, tmp_path):
    """Null ids and texts, repeated rows, columns with clashing names, and no documents at all."""
    import corpus_pipeline

    rows, labels = quality_rows(30)
    rng = random.Random(3)
    text = "\n".join(" ".join(words(rng, 30, 4000)).capitalize() + "." for _ in range(3))
    rows += [(300, text, "en", "t"), (300, text, "en", "t"), (None, text, None, None), (None, " ".join(words(rng, 40, 4000)).capitalize() + ".", None, "t"), (301, None, "en", "t"), (None, None, None, None)]
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, " ".join(words(rng, 20, 4000)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    mixed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert [r.text for r in mixed if r.text == text] in ([text], [text, text]) and {r.doc_id for r in mixed if r.text == text} == {300}
    assert sum(r.doc_id is None for r in mixed) <= 1 and all(0 < r.taken <= 2 * r.size for r in mixed)
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, str(tmp_path))
        assert none.count() == 0
        none = spark.createDataFrame([], none.schema)
