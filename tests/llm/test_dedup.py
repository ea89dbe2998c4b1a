"""Exact, substring, suffix and Jaccard dedup against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from helpers import corpus, frame, words

from leafmill.llm import exact_dedup, graph, jaccard_join, kit, substring_dedup, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
LAST = (1 << 63) - 1
SCHEMA = "doc_id long, text string, lang string, source string"


def order(i):
    return LAST if i is None else i


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_rice_codes():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        for top in (1, 50, 1 << 48):
            v = np.sort(rng.integers(0, top, n, np.uint64))
            assert (kit.rice_decode(kit.rice_encode(v)) == v).all()


def test_words_follow_the_definition():
    texts = ["a b", "", " x\ty ", "no break\x85z", "é\x0bf"]
    data = [t.encode() for t in texts]
    buf = np.frombuffer(b"".join(data), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    s, e, first = kit.word_bounds(buf, starts)
    got = [[bytes(buf[s[j] : e[j]]).decode() for j in range(first[i], first[i + 1])] for i in range(len(texts))]
    assert got == [WORD.findall(t) for t in texts]


def test_exact(spark):
    rows = corpus()
    got = exact_dedup.exact_groups(frame(spark, rows), owners=3, chunk_rows=5)
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    want = []
    for i, t, *_ in rows:
        n = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        ids = [x for x in groups[n] if x is not None]
        keep = min(ids) if ids else None
        want.append((i, keep, len(groups[n]), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    assert rows_of(got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")) == sorted(want, key=repr)
    assert "doc_id" in exact_dedup.exact_dedup(frame(spark, rows)).columns


@pytest.mark.parametrize("chunk_bytes", [1, 2000, 1 << 22])
def test_substring(spark, monkeypatch, chunk_bytes):
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", chunk_bytes)
    rows = corpus()
    window = 20
    firsts: dict = {}
    split = [WORD.findall(t or "") for _, t, *_ in rows]
    for (i, *_), w in zip(rows, split, strict=True):
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            firsts[k] = min(firsts.get(k, (LAST, LAST)), (order(i), p))
    want = []
    for (i, *_), w in zip(rows, split, strict=True):
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if firsts[tuple(w[p : p + window])] < (order(i), p):
                gone[p : p + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = substring_dedup.substring_dedup(frame(spark, rows), window=window, owners=3)
    assert rows_of(got.select("doc_id", "n_words", "n_removed", "kept_sha256")) == sorted(want, key=repr)
    assert sum(r[2] for r in want) > 100


@pytest.mark.parametrize("dedup", [substring_dedup.substring_dedup, suffix_dedup.suffix_dedup])
def test_answers_go_to_the_chunks(spark, dedup):
    """No plan shuffles or broadcasts the chunks: their side of the last join is a bucketed scan."""
    got = dedup(frame(spark, corpus()), owners=8)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Broadcast" not in plan
    join = plan[plan.index("ShuffledHashJoin") :]
    assert "Exchange" not in join[: join.index("Bucketed: true")]


@pytest.mark.parametrize("window", range(2, 24))
def test_covers_meet(window):
    v, on, k = substring_dedup.cover_of(window)
    assert v + k - 1 <= window
    assert all(any(on[(i + d) % v] and on[(j + d) % v] for d in range(v)) for i in range(v) for j in range(v))


def test_transform_by_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        length = rng.choice([1, 2, 3, 5, 8, 9, 20])
        segments = [bytes(rng.choice(rng.choice([b"ab", b"abcd"])) for _ in range(rng.randrange(60))) for _ in range(rng.randrange(1, 8))]
        segments.append(segments[0][: len(segments[0]) // 2] + segments[-1])
        weights = np.array([rng.randrange(1, 3) for _ in segments])
        count = collections.Counter()
        for s, w in zip(segments, weights, strict=True):
            for i in range(len(s) - length + 1):
                count[s[i : i + length]] += w
        got = suffix_dedup.repeated_starts(segments, weights, length)
        assert [g.tolist() for g in got] == [[count[s[i : i + length]] >= 2 for i in range(len(s) - length + 1)] for s in segments]


def suffix_want(rows, length):
    texts = [(t or "").encode() for _, t, *_ in rows]
    count = collections.Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    want = []
    for (i, *_), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if count[t[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int(np.diff(np.concatenate([[0], gone.astype(int), [0]])).clip(0).sum())
        want.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone]) if t else b"").hexdigest()))
    return sorted(want, key=repr)


@pytest.mark.parametrize(("length", "chunk_bytes"), [(40, 1), (40, 4 << 20), (200, 3000), (200, 4 << 20)])
def test_suffix(spark, monkeypatch, length, chunk_bytes):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(kit.slices, "__defaults__", (min(chunk_bytes, kit.SLICE_BYTES),))
    rows = corpus()
    got = suffix_dedup.suffix_dedup(frame(spark, rows), length=length, owners=3)
    assert rows_of(got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == suffix_want(rows, length)


def test_hot_anchor_is_divided(spark, monkeypatch):
    rng = random.Random(9)
    line = " ".join(words(rng, 20))
    rows = [(i, " ".join(words(rng, 30)) + " " + line + " " + " ".join(words(rng, 30 if i % 3 else 1)), "en", "s") for i in range(40)]
    rows += [(100 + i, rows[i][1][10:], "en", "s") for i in range(10)]
    answer = suffix_dedup._answer(60)
    payloads = []
    monkeypatch.setattr(suffix_dedup, "SPLIT", 50)
    texts = [r[1].encode() for r in rows]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    buf = np.frombuffer(b"".join(texts), np.uint8)
    place, grams, doc, first, many = suffix_dedup.choose(buf, starts, 60)
    by = np.argsort(grams, kind="stable")
    import pickle

    data = buf.tobytes()
    size = (many + 59)[by]
    payloads.append(pickle.dumps((grams[by], (place - first)[by], np.zeros(len(by), np.int8), size, b"".join(data[first[j] : first[j] + many[j] + 59] for j in by))))
    flags = np.unpackbits(np.frombuffer(answer(payloads)[0], np.uint8), count=int(many.sum())).astype(bool)
    count = collections.Counter(t[p : p + 60] for t in texts for p in range(len(t) - 59))
    want = [count[data[first[j] + o : first[j] + o + 60]] > 1 for j in by for o in range(many[j])]
    assert flags.tolist() == want


def jaccard_want(rows, k, percent):
    sets = []
    for _, t, *_ in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                up[root(a)] = root(b)
    least = {}
    for i, (x, *_) in enumerate(rows):
        if x is not None:
            least[root(i)] = min(least.get(root(i), LAST), x)
    return sorted(((x, len(sets[i]), least.get(root(i), x) if sets[i] else x) for i, (x, *_) in enumerate(rows)), key=repr)


@pytest.mark.parametrize(("k", "percent", "shingles"), [(4, 85, 1 << 20), (2, 60, 150)])
def test_jaccard(spark, k, percent, shingles):
    rows = corpus()
    got = jaccard_join.jaccard_components(frame(spark, rows), k=k, percent=percent, owners=3, group_shingles=shingles)
    assert rows_of(got.select("doc_id", "n_shingles", "component_id")) == jaccard_want(rows, k, percent)


def test_divide_skip_finds_all_links():
    rng = np.random.default_rng(4)
    for trial in range(20):
        base = np.unique(rng.integers(0, 500, 80, np.uint64))
        sets = []
        for _ in range(30):
            s = base[rng.random(len(base)) > 0.08] if trial % 2 else np.unique(rng.integers(0, 90, 60, np.uint64))
            sets.append(np.unique(np.concatenate([s, rng.integers(0, 1000, 4, np.uint64)])))
        links = jaccard_join.divide_skip(sets, None, 80)
        forest = jaccard_join.Forest(len(sets))
        for a, b in links:
            shared = len(np.intersect1d(sets[a], sets[b]))
            assert 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared)
            forest.join(a, b)
        for a in range(len(sets)):
            for b in range(a):
                shared = len(np.intersect1d(sets[a], sets[b]))
                if 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                    assert len(set(forest.roots(np.array([a, b])))) == 1


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (10, 9), (9, 8), (7, 7), (20, 5), (5, 20), *((30 + i, 31 + i) for i in range(40))]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8, 10: 8, 5: 5, 20: 5, **{i: 30 for i in range(30, 71)}}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    for f in (exact_dedup.exact_groups, exact_dedup.exact_dedup, substring_dedup.substring_dedup, suffix_dedup.suffix_dedup, jaccard_join.jaccard_components, jaccard_join.jaccard_dedup):
        assert f(none).count() == 0


def cancelling(n=2048):
    """Two strings whose polynomial hashes modulo 2**64 are equal for every odd base."""
    t = "".join("ab"[bin(i).count("1") & 1] for i in range(n))
    return t, t.translate(str.maketrans("ab", "ba"))


def test_structured_words_do_not_collide(spark):
    t, u = cancelling()
    shared = " ".join(f"w{i}" for i in range(19))
    docs = frame(spark, [(1, f"{shared} {t}", "en", "s"), (2, f"{shared} {u}", "en", "s"), (3, f"{shared} {t}", "en", "s")])
    assert {r.doc_id: r.n_removed for r in substring_dedup.substring_dedup(docs).collect()} == {1: 0, 2: 0, 3: 20}
    alone = frame(spark, [(1, t, "en", "s"), (2, u, "en", "s"), (3, t, "en", "s")])
    assert {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(alone).collect()} == {1: 1, 2: 2, 3: 1}
    for n in (8, 16, 64, 512, 513, 4096):
        data = np.frombuffer("".join(cancelling(n)).encode(), np.uint8)
        a, b = kit.bytes_hash(data, np.array([0, n]), np.array([n, 2 * n]))
        assert a != b


def test_hashes_are_of_the_words_alone():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    s = rng.integers(0, 3900, 3000)
    e = s + rng.integers(1, 40, 3000)
    h = kit.bytes_hash(data, s, e)
    names = [data[a:b].tobytes() for a, b in zip(s, e, strict=True)]
    assert len(set(names)) == len(set(zip(names, h.tolist(), strict=True))) == len(set(h.tolist()))
    words_ = h[:500]
    for k in (1, 2, 3, 7, 20):
        at = np.arange(500 - k + 1)
        g = kit.gram_hashes(words_, at, k)
        want = {}
        for i in at:
            want.setdefault(tuple(words_[i : i + k]), g[i])
            assert want[tuple(words_[i : i + k])] == g[i] == kit.gram_hashes(words_[i : i + k], np.array([0]), k)[0]
        assert len(set(g.tolist())) == len(want)


def test_a_group_of_many_blocks(spark):
    """Near copies of one text in many blocks, some of them linked only to members of other blocks."""
    rng = random.Random(12)
    base = words(rng, 100)
    rows = []
    for i in range(60):
        copy = list(base)
        for j in range(i % 7):
            copy[(17 * j + i) % 100] = f"x{i}-{j}"
        rows.append((i, " ".join(copy), "en", "s"))
    other = words(rng, 60) + base[:40]
    rows += [(100 + i, " ".join([*other[: 55 + i], *(f"y{j}" for j in range(i))]), "en", "s") for i in range(20)]
    for shingles in (120, 400):
        got = jaccard_join.jaccard_components(frame(spark, rows), k=2, percent=70, owners=3, group_shingles=shingles)
        assert rows_of(got.select("doc_id", "n_shingles", "component_id")) == jaccard_want(rows, 2, 70)
