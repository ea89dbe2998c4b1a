"""Filter audit, toxicity and collocations against plain versions."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
from helpers import corpus, frame
from leafmill.llm import collocations as C
from leafmill.llm import filter_audit as A
from leafmill.llm import toxicity as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def audit_want(rows, labels):
    texts = {}
    for i, t, *_ in rows:
        k = t or ""
        texts[k] = min(texts.get(k, (2, 0)), (i is None, i or 0))
    marks = {}
    for i, q, x in labels:
        old = marks.get(i, (0, 0))
        marks[i] = (old[0] or q == 1, old[1] or x == 1)
    cases = []
    for i, t, _, source in rows:
        t = t or ""
        words = WORD.findall(t)
        fails = ""
        fails += "A" * (len(words) < 50)
        fails += "B" * (100 * len(set(words)) < 65 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", t)) > 5 * len(t))
        fails += "D" * bool(re.search(r"[#$%&*|]", t))
        fails += "E" * ((i is None, i or 0) > texts[t])
        good, toxic = marks.get(i, (0, 0)) if i is not None else (0, 0)
        cases.append((source or "", fails, int(good), int(toxic)))
    out, share = {}, Counter()
    for part in {c[0] for c in cases}:
        mine = [c for c in cases if c[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [c for c in left if f in c[1]]
                left = [c for c in left if f not in c[1]]
                share[part, f] += len(gone)
                failing = [c for c in mine if f in c[1]]
                out[part, order, step] = (len(left), len(gone), len(failing) - len(gone), sum(c[1] == f for c in mine), sum(c[2] for c in gone), sum(c[3] for c in gone))
    return {k: (*v, share[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit_rows():
    rng = random.Random(3)
    rows = corpus()
    for i in range(100, 160):
        words = [rng.choice(["Up", "down", "UP", "left", "x$y", "so"]) + str(rng.randrange(1 if i % 3 else 400)) for _ in range(rng.randrange(20, 90))]
        rows.append((i, " ".join(words), "en", rng.choice(["src0", "src1", None, ""])))
    rows += [(i + 500, rows[60][1], "en", "hot") for i in range(30)]
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i in range(0, 560, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (6, None, None), (8, 0, 0)]
    return rows, labels


def test_filter_audit(spark):
    rows, labels = audit_rows()
    lab = frame(spark, labels, "doc_id long, quality int, toxic int")
    got = A.audit_filters(frame(spark, rows), lab).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in A.COUNTS) for r in got} == audit_want(rows, labels)
    assert len(got) == 600 * len({r[3] or "" for r in rows})
    assert A.audit_filters(frame(spark, rows[:0]), lab).count() == 0
    none = A.audit_filters(frame(spark, rows[:9]), lab.limit(0)).agg({"good_lost": "max", "toxic_lost": "max"}).first()
    assert tuple(none) == (0, 0)


def test_other_filters_and_many_parts(spark):
    rows = [(i, "A b" if i % 2 else "c $", None, f"p{i}") for i in range(150)]
    two = {x: A.TEXT_FILTERS[x] for x in "CD"}
    got = A.audit_filters(frame(spark, rows), frame(spark, [(1, 1, 1)], "doc_id long, quality int, toxic int"), filters=two, duplicate=None)
    assert got.count() == 150 * 4
    assert {r[0] for r in got.groupBy("part").sum("removed").select("sum(removed)").collect()} == {2}


def test_incidence_by_definition():
    orders, made = A.incidence(3)
    at = [(order, step) for order in orders for step in range(3)]
    for mask in range(8):
        for c, (order, step) in enumerate(at):
            f, before = order[step], order[:step]
            fails, gone = bool(mask >> f & 1), any(mask >> g & 1 for g in before)
            assert made["kept"][mask, c] == (not fails and not gone)
            assert made["removed"][mask, c] == (fails and not gone)
            assert made["redundant"][mask, c] == (fails and gone)
            assert made["unique_fails"][mask, c] == (mask == 1 << f)
            assert made["shapley"][mask, c] == sum(made["removed"][mask, d] for d, (o, s) in enumerate(at) if o[s] == f)


def phrases_want(rows, min_count, top, max_words=3):
    f, n = Counter(), Counter()
    for _, t, lang, *_ in rows:
        lang = "und" if lang is None else lang
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", t):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + m])) for m in range(1, max_words + 1) for i in range(len(words) - m + 1))
    keep = {k: a for k, a in f.items() if a >= min_count and len(k[1]) > 1}
    out = {}
    for (lang, p), a in keep.items():
        longer = [b for (g, q), b in keep.items() if g == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if any(100 * b >= 50 * a for b in longer):
            continue
        cuts = [(1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return {(lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)}


def phrase_rows():
    rng = random.Random(11)
    rows = []
    for i in range(60):
        words = [rng.choice("the The of a river bank New york city déjà vu été".split()) + rng.choice(["", "", "", ",", ".", "\n", "!"]) for _ in range(rng.randrange(0, 60))]
        rows.append((i, " ".join(words) + "  New York City\tis", rng.choice(["en", "en", "fr", None, "und", ""]), "s"))
    rows += [(70 + i, "hot pair of words " * 40, "en", "s") for i in range(5)]
    return [*rows, (80, None, "en", "s"), (81, "", None, "s"), (82, " ,. \n", "de", "s"), (83, "one", "de", "s"), (84, "x y 𝒳 " * 30, "fr", "s"), (None, "New York City", "en", "s"), (0, rows[0][1], "en", "s"), (90, " ".join(f"w{rng.randrange(40)}" for _ in range(9000)), "en", "s")]


def test_collocations(spark):
    rows = phrase_rows()
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    for options in ({}, {"chunk_words": 50, "owners": 3}, {"top": 4}):
        got = C.collocations(frame(spark, rows), **options).collect()
        want = phrases_want(rows, 10, options.get("top", 2000))
        assert {tuple(r[c] for c in columns) for r in got} == want
        assert len(got) == len(want)
    assert C.collocations(frame(spark, rows[:0])).count() == 0
    assert C.collocations(frame(spark, [(1, "a, b. c", "en", "s")])).count() == 0


def test_longer_phrases(spark):
    rows = phrase_rows()[:40]
    got = C.collocations(frame(spark, rows), max_words=5, min_count=4).collect()
    assert {tuple(r) for r in got} == phrases_want(rows, 4, 2000, 5)


def test_suffixes_by_definition():
    rng = np.random.default_rng(2)
    for words in (1, 2, 3, 5):
        ids, piece = rng.integers(0, 4, 300), np.sort(rng.integers(0, 60, 300))
        last = np.searchsorted(piece, piece, "right") - np.arange(300)
        order, lcp = C.suffix_array(ids, piece, words)
        cut = [tuple(ids[i : i + min(words, last[i])]) for i in range(300)]
        assert sorted(order.tolist()) == list(range(300))
        assert all(cut[a] <= cut[b] for a, b in zip(order, order[1:], strict=False))
        common = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert lcp.tolist()[1:] == [common(cut[a], cut[b]) for a, b in zip(order, order[1:], strict=False)]
        for size in range(1, words + 1):
            at, n = C.intervals(order, lcp, last, size)
            want = Counter(tuple(ids[i : i + size]) for i in range(300) if last[i] >= size)
            assert {tuple(ids[i : i + size]): k for i, k in zip(at, n, strict=True)} == want


def test_products_pass_64_bits(spark):
    a, b = 9_000_000_000, 12_000_000_000
    got = spark.sql(f"SELECT CAST(1000000 AS decimal(7,0)) * CAST({a}L AS decimal(19,0)) * CAST({a}L AS decimal(19,0)) div (CAST({b}L AS decimal(19,0)) * CAST({a + 1}L AS decimal(19,0))) AS s").first().s
    assert got == 1000000 * a * a // (b * (a + 1))


def toxic_rows(n=400):
    rng = random.Random(4)
    common = "the of and to in that it was for on are as with his they at be this from have or by one had".split()
    insults = ["grobnik", "smarvel", "flurgon", "trindle"]
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = [rng.choice(common) + rng.choice(["", "", ",", "."]) for _ in range(rng.randrange(8, 300))]
        for _ in range(3 * bad):
            words[rng.randrange(len(words))] = rng.choice(insults)
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_rows()
    odd = [(1000, "you smarvell", None, None), (1001, "a grobn1k here", None, None), (1002, "of the " * 20000 + "flurgon.", None, None), (1003, "", None, None), (1004, None, None, None), (None, "such a grobnik", None, None), (1005, "of the " * 20000, None, None), (5, rows[5][1], None, None)]
    lab = frame(spark, [*labels, (None, 1, 1), (1000, 1, None), (5, 1, 0)], "doc_id long, quality int, toxic int")
    got = T.classify_toxicity(frame(spark, rows + odd), lab).collect()
    assert len(got) == len(rows) + len(odd)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    truth = dict((i, x) for i, _, x in labels)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 50
    assert np.mean([p == y for p, y in held]) > 0.95
    by = {r.doc_id: r for r in got}
    assert [by[i].predicted for i in (1000, 1001, 1002, 1003, 1004, None, 1005)] == [1, 1, 1, 0, 0, 1, 0]
    assert by[1003].score == by[1004].score
    assert not by[None].held_out
    assert len({r.score for r in got if r.doc_id == 5}) == 1
    assert T.classify_toxicity(frame(spark, rows[:0]), lab).count() == 0
    blank = T.classify_toxicity(frame(spark, rows[:20]), lab.limit(0)).collect()
    assert {(r.score, r.predicted) for r in blank} == {(0.0, 0)}


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    rows, labels = toxic_rows(200)
    from zlib import crc32

    other = [(i, q, x if crc32(str(i).encode()) % 5 else 1 - x) for i, q, x in labels]
    a, b = (T.classify_toxicity(frame(spark, rows), frame(spark, x, "doc_id long, quality int, toxic int")).select("doc_id", "score").collect() for x in (labels, other))
    assert {tuple(r) for r in a} == {tuple(r) for r in b}


def test_scores_by_definition():
    """The score of a text is the softmax of the largest mean over passages of mean subword shares."""
    rng = np.random.default_rng(5)
    shares, bias = rng.normal(0, 3, T.BUCKETS).astype(np.float32), -0.5
    texts = ["One, two three four (five) six seven eight nine ten eleven twelve thirteen", "", "...", "déjà vu!", "a b", " ".join(f"w{i}" for i in range(23))]
    raw = [t.encode() for t in texts]
    got = T.score_texts(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in raw])]), shares, bias)

    def bucket(t):
        points = np.array([ord(c) for c in t], np.uint64)
        return int(T.kit.rolling_hash(points, np.array([0]), np.array([len(points)]))[0] % np.uint64(T.BUCKETS))

    def word(t):
        core = t.strip("".join(c for c in map(chr, range(33, 127)) if not c.isalnum())) or t
        marked = f"_{core.lower()}_"
        grams = [marked] + [marked[i : i + n] for n in T.GRAMS for i in range(len(marked) - n + 1)]
        return np.mean([shares[bucket(g)] for g in grams])

    for t, score in zip(texts, got, strict=True):
        w = [word(x) for x in t.split()]
        starts = sorted({min(i, max(len(w) - T.PASSAGE, 0)) for i in range(0, max(len(w), 1), T.STRIDE)})
        best = max([np.mean(w[i : i + T.PASSAGE]) for i in starts] if w else [0])
        assert abs(score - 1 / (1 + np.exp(-(best + bias)))) < 1e-6
