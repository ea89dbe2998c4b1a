"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is labelled good or bad from the shape of its own and both
neighbouring lines; labels of neighbours are tied by transition weights. A
document's score is the mean of its lines' marginals P(good), from the
forward-backward recursions, weighted by line length.

The field is fitted on the driver from at most ``max_train`` labelled rows,
whole, chosen by the hash of their ids and as long as they have at most
``max_lines`` lines together (documented bounds, so what the driver holds is
bounded in bytes; a row of over a tenth of ``max_lines`` is no training row, and
a training document gives its label to its lines). Scoring covers all rows and whole texts
and ships only the weights.

Features see text alone: never labels, language, source or id. Defined results:
a null or blank text has no line and gets the share of good training documents
as its score; without training documents every score is 0.5; a null id is not
held out and never learned from; of repeated labels of one id the lower counts;
repeated rows are scored each, alike; a score of just 0.5 is good; a very long
text is scored whole; an empty table gives no rows; other columns may have any
names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kit

FOLDS, TEST_FOLD, MAX_TRAIN, MAX_LINES = 3, 1, 4000, 400_000
N_BASE = 14


def _lut(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[np.frombuffer(chars, np.uint8)] = True
    return t


_UPPER = _lut(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _lut(b"abcdefghijklmnopqrstuvwxyz")
_DIGIT = _lut(b"0123456789")
_SPACE = _lut(b" \t\r\x0b\x0c")
_POINT = _lut(b".,;:?'\"-()")
_HIGH = np.arange(256) >= 0x80
_LEAD = np.arange(256) >= 0xC0
_ODD = ~(_UPPER | _LOWER | _DIGIT | _SPACE | _POINT | _HIGH | _lut(b"\n"))
_END = _lut(b".?!:\"'")


def line_features(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, byte lengths and first line of each text; lines of white space only are left out."""
    n = len(buf)
    cut = np.flatnonzero(buf == 0x0A)
    begin = np.unique(np.concatenate([starts[:-1], cut + 1]))
    begin = begin[begin < n]
    end = np.append(begin[1:], n)
    end = np.where((end > begin) & (buf[end - 1] == 0x0A), end - 1, end) if len(end) else end

    def count(table):
        total = np.zeros(n + 1, np.int32)
        np.cumsum(table[buf], out=total[1:])
        return (total[end] - total[begin]).astype(np.float32)

    space, size = count(_SPACE), (end - begin).astype(np.float32)
    keep = size > space
    begin, end, space, size = begin[keep], end[keep], space[keep], size[keep]
    upper, lower, digit, point, high, odd = (count(t) for t in (_UPPER, _LOWER, _DIGIT, _POINT, _HIGH, _ODD))
    letters = np.maximum(upper + lower + high, 1)
    word = (size - space) / (space + 1)
    first = np.searchsorted(begin, starts)
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(first))
    prints = kit.bytes_hash(buf, begin, end) ^ kit.mix(doc.astype(np.uint64))
    order = np.argsort(prints, kind="stable")
    again = np.zeros(len(begin), np.float32)
    again[order[1:]] = prints[order][1:] == prints[order][:-1]
    x = np.stack(
        [
            np.ones_like(size), np.log1p(size) / 5, upper / letters, digit / size, odd / size, np.minimum(1, 8 * odd / size), 8 * point / size,
            np.minimum(word / 10, 3), (word > 12).astype(np.float32), (_UPPER | _LEAD)[buf[begin]].astype(np.float32), _END[buf[end - 1]].astype(np.float32),
            again, (size < 40).astype(np.float32), (upper > 0.5 * letters).astype(np.float32),
        ],
        axis=1,
    ).astype(np.float32) if len(begin) else np.zeros((0, N_BASE), np.float32)
    return x, size.astype(np.float64), first


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Own features, then those of the line before and the line after; zeros where there is none."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    heads = first[:-1][np.diff(first) > 0]
    tails = first[1:][np.diff(first) > 0] - 1
    before[heads] = 0
    after[tails] = 0
    return np.concatenate([x, before, after], axis=1)


def forward_backward(good: np.ndarray, link: np.ndarray, first: np.ndarray):
    """Marginals P(good) of all lines, expected transitions and log Z of each text.

    good: log-potential of the state good (bad has 0); link: 2 x 2 log-potentials.
    Texts advance side by side, longest first, one line a step.
    """
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    longest = int(n[order[0]]) if len(order) else 0
    live = np.searchsorted(-n[order], -np.arange(longest), "left")
    u = np.stack([np.zeros_like(good), good], 1)
    a, b = np.empty_like(u), np.zeros_like(u)
    at = first[:-1][order]
    for t in range(longest):
        i = at[: live[t]] + t
        a[i] = u[i] if t == 0 else u[i] + np.logaddexp(a[i - 1, :1] + link[0], a[i - 1, 1:] + link[1])
    for t in range(longest - 2, -1, -1):
        i = at[: live[t + 1]] + t
        ahead = u[i + 1] + b[i + 1]
        b[i] = np.logaddexp(link[:, 0] + ahead[:, :1], link[:, 1] + ahead[:, 1:])
    z = np.zeros(len(n))
    some = n > 0
    z[some] = np.logaddexp(*a[first[1:][some] - 1].T)
    doc = np.repeat(np.arange(len(n)), n)
    marginal = np.exp(a[:, 1] + b[:, 1] - z[doc])
    inner = np.ones(len(good), bool)
    inner[first[:-1][some]] = False
    j = np.flatnonzero(inner)
    pairs = np.exp(a[j - 1][:, :, None] + link[None] + (u[j] + b[j])[:, None, :] - z[doc[j]][:, None, None])
    return marginal, (pairs, doc[j]), z


def fit(x: np.ndarray, first: np.ndarray, label: np.ndarray, steps: int = 160, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features and of the transitions: Adam on the mean log-likelihood a line of each text."""
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    share = 1 / (np.maximum(n, 1) * len(n))
    y = label[doc].astype(np.float64)
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        link = theta[-4:].reshape(2, 2)
        p, (pairs, of), _ = forward_backward(x @ theta[:-4], link, first)
        grad = np.empty_like(theta)
        grad[:-4] = x.T @ ((y - p) * share[doc])
        seen = np.zeros((2, 2))
        for k in (0, 1):
            seen[k, k] = share[of][label[of] == k].sum()
        grad[-4:] = (seen - (pairs * share[of][:, None, None]).sum(0)).ravel()
        grad -= l2 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta += 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return theta[:-4], theta[-4:].reshape(2, 2)


def score_texts(buf: np.ndarray, starts: np.ndarray, weights: np.ndarray, link: np.ndarray, prior: float) -> np.ndarray:
    x, size, first = line_features(buf, starts)
    if not len(x) or not weights.any():
        return np.full(len(starts) - 1, prior)
    p, _, _ = forward_backward(with_neighbours(x, first) @ weights, link, first)
    total = np.concatenate([[0], np.cumsum(size)])
    good = np.concatenate([[0], np.cumsum(size * p)])
    w = total[first[1:]] - total[first[:-1]]
    return np.where(w > 0, np.clip((good[first[1:]] - good[first[:-1]]) / np.maximum(w, 1), 0, 1), prior)


def fold(id_col: str, folds: int):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def train(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality", folds=FOLDS, test_fold=TEST_FOLD, max_train=MAX_TRAIN, max_lines=MAX_LINES):
    """Weights, transitions and the share of good documents, from the training folds."""
    pick = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold(id_col, folds) != test_fold))
        .groupBy(F.col(id_col).cast("long").alias("l_id")).agg(F.min(label_col).cast("int").alias("label"))
        .orderBy(F.md5(F.col("l_id").cast("string").cast("binary"))).limit(max_train)
    )

    def features(batches):
        for batch in batches:
            y, key = batch.column("label").to_pylist(), batch.column("key")
            for a, b, buf, starts in kit.texts_of(batch):
                x, _, first = line_features(buf, starts)
                rows = [x[first[i] : first[i + 1]].tobytes() for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([key.slice(a, b - a), pa.array(y[a:b], pa.int32()), pa.array(np.diff(first), pa.int64()), pa.array(rows, pa.binary())], ["key", "label", "lines", "x"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # At most max_train rows: a proven size.
    rows = rows.join(F.broadcast(pick), F.col("doc_id") == F.col("l_id"))
    rows = rows.select(F.concat_ws(".", F.md5(F.col("doc_id").cast("string").cast("binary")), F.hex(F.xxhash64("text"))).alias("key"), "label", "text")
    # Rows of a repeated id count each: cut again, then by lines.
    rows = kit.save(rows.mapInArrow(kit.lean(features), "key string, label int, lines long, x binary").where(F.col("lines") <= max_lines // 10).orderBy("key", "label").limit(max_train), "quality-sample")
    upto = rows.select("key", "lines").withColumn("total", F.sum("lines").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)))
    keys = upto.where(F.col("total") <= max_lines).select("key").distinct()
    fits = rows.join(F.broadcast(keys), "key", "left_semi")
    got = sorted((r.label, bytes(r.x)) for r in fits.select("label", "x").collect())
    kit.drop_saved(rows)
    if not got:
        return np.zeros(3 * N_BASE), np.zeros((2, 2)), 0.5
    prior = float(np.mean([y for y, _ in got]))
    got = [(y, np.frombuffer(x, np.float32).reshape(-1, N_BASE)) for y, x in got if x]
    if not got:
        return np.zeros(3 * N_BASE), np.zeros((2, 2)), prior
    first = np.concatenate([[0], np.cumsum([len(x) for _, x in got])])
    x = with_neighbours(np.concatenate([x for _, x in got]), first).astype(np.float64)
    weights, link = fit(x, first, np.array([y for y, _ in got]))
    return weights, link, prior


def score_quality(docs: DataFrame, model, id_col="doc_id", text_col="text", columns=()) -> DataFrame:
    """doc_id, quality_score and the named other columns of docs (not the text), for every row."""
    weights, link, prior = model

    def run(batches):
        for batch in batches:
            s = [score_texts(buf, starts, weights, link, prior) for _, _, buf, starts in kit.texts_of(batch)]
            keep = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(np.concatenate(s or [np.zeros(0)]), pa.float64())], [*keep, "quality_score"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *columns)
    return slim.mapInArrow(kit.lean(run), slim.drop("text").schema.add("quality_score", "double"))


def quality_filter(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality", threshold: float = 0.5, **options) -> DataFrame:
    """The rows of docs with a score of at least threshold, all columns as they are."""
    weights, link, prior = train(docs, labels, id_col, text_col, label_col, **options)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            text = pa.RecordBatch.from_arrays([batch.column(at)], ["text"])
            s = [score_texts(buf, starts, weights, link, prior) for _, _, buf, starts in kit.texts_of(text)]
            yield batch.filter(pa.array(np.concatenate(s or [np.zeros(0)]) >= threshold))

    return docs.mapInArrow(kit.lean(run), docs.schema)


def classify_quality(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality", folds=FOLDS, test_fold=TEST_FOLD, max_train=MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = train(docs, labels, id_col, text_col, label_col, folds, test_fold, max_train)
    score = F.col("quality_score")
    return score_quality(docs, model, id_col, text_col).select(
        "doc_id", F.coalesce(fold("doc_id", folds) == test_fold, F.lit(False)).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted")
    )
