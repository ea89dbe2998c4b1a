"""Toxicity: bags of subwords, averaged, into a linear softmax.

A word's vector is the mean of the vectors of itself and of its character
n-grams between word marks, hashed into BUCKETS, so a misspelling nobody has
seen shares most of its vectors with the word it stands for. A passage of
PASSAGE words is the mean of its words' vectors, put through a linear softmax;
a document is as toxic as its most toxic passage, since a few words in a
long text would vanish in the mean of all. Vectors and softmax are trained
together in numpy: each step takes the top passage of each document and
carries the gradient back through it to the subwords. Steps are as long as the
gradient is along its direction, so what many documents share grows first.

Training is on the driver, from at most `per_label` rows of each label, chosen
by the hash of their ids, and as long as they have at most `max_chars`
characters a label (documented bounds; a row of over a tenth of `max_chars` is
no training row). Scoring covers all rows and whole texts: as mean and softmax
are linear, a bucket's share of the logit is one number, so tasks get BUCKETS
numbers and score distinct words once a slice.

Features see text alone: never labels, language, source or id. Defined results:
a null text or one without words scores as a passage without known subwords
does (by PRIOR); without training rows of both labels every score is 0; a null id is not held out and
never learned from; of repeated labels of one id the higher counts; repeated
rows are scored each, alike; a score of just 0.5 is toxic; a very long text is
scored whole; an empty table gives no rows; other columns may have any names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kit
from .language_id import code_points, fold

FOLDS, TEST_FOLD, PER_LABEL, MAX_CHARS = 5, 0, 3000, 4_000_000
BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
DIMENSIONS, PASSAGE, STRIDE = 8, 8, 4
STEPS, DECAY = 200, 1e-3
#: Length of a step in the vectors and in the softmax.
RATES = (3.0, 0.05)
#: Log-odds of a passage of which no subword is known: it is taken as clean.
PRIOR = -2.0
MARK = 0x5F  # stands for both ends of a word
_LETTER = np.ones(0x80, bool)
_LETTER[[c for c in range(0x80) if not chr(c).isalnum()]] = False
_BLANK = np.isin(np.arange(0x80), [0x20, *range(0x09, 0x0E)])


def marked_words(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words between marks, laid out again: code points, starts, ends, and the first word of each text.

    A word is a run outside white space, without punctuation at its ends unless it has nothing else.
    """
    points = np.where((points >= 65) & (points <= 90), points + 32, points)
    low = np.minimum(points, 0x7F)
    solid = (points >= 0x80) | ~_BLANK[low]
    edge = np.zeros(len(points) + 1, bool)
    edge[starts] = True
    s = np.flatnonzero(solid & (~np.append(False, solid[:-1]) | edge[:-1])[: len(solid)])
    e = np.flatnonzero(solid & (~np.append(solid[1:], False) | edge[1:])[: len(solid)]) + 1
    first = np.searchsorted(s, starts)
    inner = np.flatnonzero((points >= 0x80) | _LETTER[low])
    lo, hi = np.searchsorted(inner, s), np.searchsorted(inner, e)
    some = hi > lo
    s, e = s.copy(), e.copy()
    s[some], e[some] = inner[lo[some]], inner[hi[some] - 1] + 1
    size = e - s + 2
    end = np.cumsum(size)
    out = np.full(int(end[-1]) if len(end) else 0, MARK, np.uint64)
    at = np.arange(len(out)) - np.repeat(end - size, size)
    body = (at > 0) & (at < np.repeat(size, size) - 1)
    out[body] = points[(np.repeat(s, size) + at - 1)[body]]
    return out, end - size, end, first


def subwords(points: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and its n-grams, and the first one of each word."""
    counts = [np.maximum(e - s - n + 1, 0) for n in GRAMS]
    of = np.concatenate([[0], np.cumsum(1 + sum(counts))])
    out = np.empty(of[-1], np.int32)
    out[of[:-1]] = kit.rolling_hash(points, s, e) % np.uint64(BUCKETS)
    at = of[:-1] + 1
    for n, count in zip(GRAMS, counts, strict=True):
        begin = _runs(s, count)
        out[_runs(at, count)] = kit.rolling_hash(points, begin, begin + n) % np.uint64(BUCKETS)
        at += count
    return out, of


def vocabulary(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of the texts as numbers, the first word of each text, and subwords() of the distinct words; slice by slice."""
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    known, prints, counts, parts, sizes = np.zeros(0, np.uint64), [], [], [], []
    for a, b in kit.slices(starts):
        buf = np.frombuffer(b"".join(texts[a:b]), np.uint8)
        points, s, e, first = marked_words(*code_points(buf, starts[a : b + 1] - starts[a]))
        mine = kit.rolling_hash(points, s, e)
        seen, lead = np.unique(mine, return_index=True)
        lead = lead[~np.isin(seen, known)]
        buckets, of = subwords(points, s[lead], e[lead])
        known = np.concatenate([known, mine[lead]])
        prints.append(mine)
        counts.append(np.diff(first))
        parts.append(buckets)
        sizes.append(np.diff(of))
    order = np.argsort(known)
    word = order[np.searchsorted(known[order], np.concatenate(prints or [known]))]
    join = lambda x: np.concatenate([[0], np.cumsum(np.concatenate(x or [np.zeros(0, np.int64)]))]).astype(np.int64)
    return word, join(counts), np.concatenate(parts or [np.zeros(0, np.int32)]), join(sizes)


def distinct(points: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of distinct words, and which one each word is."""
    prints = kit.rolling_hash(points, s, e)
    _, lead, back = np.unique(prints, return_index=True, return_inverse=True)
    return lead, back


def passages(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of passages and the first passage of each text: every STRIDE words, the last one up to the end."""
    n = np.diff(first)
    count = np.where(n > 0, np.maximum(0, -(-(n - PASSAGE) // STRIDE)) + 1, 0)
    begin = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(n)), count)
    s = first[:-1][doc] + np.minimum((np.arange(len(doc)) - begin[doc]) * STRIDE, np.maximum(n[doc] - PASSAGE, 0))
    return s, np.minimum(s + PASSAGE, first[1:][doc]), begin


def means(values: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Means over passages, summed word by word, so equal texts get equal means wherever they lie."""
    total = np.zeros(len(s))
    for k in range(PASSAGE):
        inside = s + k < e
        total[inside] += values[s[inside] + k]
    return total / (e - s)


def fit(word: np.ndarray, first: np.ndarray, buckets: np.ndarray, of: np.ndarray, label: np.ndarray, steps: int = STEPS, seed: int = 7) -> tuple[np.ndarray, float]:
    """Each bucket's share of the log-odds of label 1, and the bias; every text has a word."""
    used = np.unique(buckets)
    sub = np.searchsorted(used, buckets).astype(np.int32)
    size = np.diff(of)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.01, (len(used), DIMENSIONS))
    softmax = rng.normal(0, 0.5, (DIMENSIONS, 2))
    ps, pe, begin = passages(first)
    weight = 0.5 / np.bincount(label, minlength=2)[label]
    speeds, scales = [np.zeros_like(x) for x in (vectors, softmax)], [0.0, 0.0]
    for step in range(1, steps + 1):
        # The softmax of means is the mean of softmax shares, so all words take one number a subword.
        each = np.add.reduceat((vectors @ (softmax[:, 1] - softmax[:, 0]))[sub], of[:-1]) / size
        gap = means(each[word], ps, pe) + PRIOR
        best = np.maximum.reduceat(gap, begin[:-1])
        hit = np.flatnonzero(gap == np.repeat(best, np.diff(begin)))
        top = hit[np.searchsorted(hit, begin[:-1])]
        up = (1 / (1 + np.exp(-np.clip(best, -500, 500))) - label) * weight
        slope = np.stack([-up, up], axis=1)
        # Back to the words of the top passages, then to their subwords.
        long = pe[top] - ps[top]
        at = _runs(ps[top], long)
        share = np.repeat(slope / long[:, None], long, axis=0)
        touched, where = np.unique(word[at], return_inverse=True)
        d_word = np.stack([np.bincount(where, share[:, k], len(touched)) for k in (0, 1)], axis=1)
        n = size[touched]
        parts = sub[_runs(of[touched], n)]
        bags = np.add.reduceat(vectors[parts], np.cumsum(n) - n, axis=0) / n[:, None]
        spread = np.repeat(d_word @ softmax.T / n[:, None], n, axis=0)
        d_vectors = np.stack([np.bincount(parts, spread[:, k], len(used)) for k in range(DIMENSIONS)], axis=1)
        for i, (x, grad) in enumerate(((vectors, d_vectors), (softmax, bags.T @ d_word))):
            speeds[i] += 0.1 * (grad - speeds[i])
            scales[i] += 0.05 * (float((grad * grad).sum()) - scales[i])
            x *= 1 - DECAY
            x -= RATES[i] * (speeds[i] / (1 - 0.9**step)) / (np.sqrt(scales[i] / (1 - 0.95**step)) + 1e-12)
    out = np.zeros(BUCKETS, np.float32)
    out[used] = vectors @ (softmax[:, 1] - softmax[:, 0])
    return out, PRIOR


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places start[i] .. start[i] + size[i] of all i, one after another."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def score_texts(buf: np.ndarray, starts: np.ndarray, shares: np.ndarray, bias: float) -> np.ndarray:
    points, s, e, first = marked_words(*code_points(buf, starts))
    best = np.full(len(starts) - 1, bias)
    some = np.diff(first) > 0
    if some.any():
        lead, word = distinct(points, s, e)
        buckets, of = subwords(points, s[lead], e[lead])
        each = np.add.reduceat(shares[buckets].astype(np.float64), of[:-1]) / np.diff(of)
        ps, pe, begin = passages(first)
        best[some] += np.maximum.reduceat(means(each[word], ps, pe), begin[:-1][some])
    return 1 / (1 + np.exp(-np.clip(best, -500, 500)))


def train(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic", folds=FOLDS, test_fold=TEST_FOLD, per_label=PER_LABEL, max_chars=MAX_CHARS):
    """Bucket shares and bias (None without training rows of both labels)."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold(id_col, folds) != test_fold))
    known = known.groupBy(F.col(id_col).cast("long").alias("l_id")).agg((F.max(label_col) == 1).cast("int").alias("label"))
    key = F.md5(F.col("l_id").cast("string").cast("binary"))
    # At most per_label rows of each label: a proven size.
    picks = [known.where(F.col("label") == y).orderBy(key).limit(per_label) for y in (0, 1)]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(F.length("text").between(1, max_chars // 10))
    rows = rows.join(F.broadcast(picks[0].unionAll(picks[1])), F.col("doc_id") == F.col("l_id")).select("label", "text", key.alias("key"), F.xxhash64("text").alias("tie"))
    # Rows of a repeated id count each, so cut again, then by characters.
    got = []
    for y in (0, 1):
        few = kit.save(rows.where(F.col("label") == y).orderBy("key", "tie").limit(per_label), "toxicity-sample")
        upto = F.sum(F.length("text")).over(Window.orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, 0))
        got += [(y, r.text) for r in few.withColumn("upto", upto).where(F.col("upto") <= max_chars).orderBy("key", "tie").select("text").collect()]
        kit.drop_saved(few)
    word, first, buckets, of = vocabulary([t.encode() for _, t in got])
    some = np.diff(first) > 0
    label = np.array([y for y, _ in got], np.int64)[some] if got else np.zeros(0, np.int64)
    if len(np.unique(label)) < 2:
        return None
    return fit(word, np.append(first[:-1][some], first[-1]), buckets, of, label)


def score_toxicity(docs: DataFrame, model, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id and toxicity_score for every row."""

    def run(batches):
        for batch in batches:
            if model is None:
                s = [np.zeros(batch.num_rows)]
            else:
                s = [score_texts(buf, starts, *model) for _, _, buf, starts in kit.texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(s or [np.zeros(0)]), pa.float64())], ["doc_id", "toxicity_score"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(kit.lean(run), "doc_id long, toxicity_score double")


def classify_toxicity(
    docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic", folds=FOLDS, test_fold=TEST_FOLD, per_label=PER_LABEL, max_chars=MAX_CHARS
) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = train(docs, labels, id_col, text_col, label_col, folds, test_fold, per_label, max_chars)
    score = F.col("toxicity_score")
    return score_toxicity(docs, model, id_col, text_col).select(
        "doc_id", F.coalesce(fold("doc_id", folds) == test_fold, F.lit(False)).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted")
    )
