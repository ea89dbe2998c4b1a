"""Language ID by segmentation-marginalised unigrams over a fixed public vocabulary.

Each language has a probability for every piece of the vocabulary. A word's
probability is the sum over all its segmentations into pieces, by the forward
algorithm; a text's is the product over its words, and the language with the
largest posterior wins. Piece probabilities are fitted by expectation
maximisation (forward and backward sums give expected piece counts).

Fitting takes at most ``per_lang`` documents of each language, chosen by the
hash of their ids, with at most ``max_chars`` characters a language (documented
bounds of the sample of labelled rows; a text of over a tenth of ``max_chars``
is no training text), and all words of these. As the sample is drawn by
language, a rare one is in it like a frequent one. Prediction covers every row
and whole texts; a task scores a distinct word once a slice and keeps a bounded
cache of words.

A word is a maximal run of letters, lower-cased, of any length, behind a start
mark. All pieces of the vocabulary that consist of letters count, of any
length; a character outside the vocabulary has a small fixed probability. Sums
are in the log domain, so long words (texts of scripts without spaces) neither
underflow nor are cut.

Defined results: null text or no letter: ``und`` with score 0; nothing learned:
``und`` everywhere; a null id is not held out and never learned from; languages
tie in code point order; repeated rows are predicted each, alike; a very long
text or word is summed whole; an empty table gives no rows; other columns may
have any names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kit

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
FOLDS, TEST_FOLD, PER_LANG, MAX_CHARS = 5, 0, 400, 2_000_000
START = 0x2581
UNSEEN, ROUNDS = 1e-9, 3
CACHE_WORDS = 1 << 18
#: Symbols of the words that one pass of the forward algorithm takes.
PASS_SYMBOLS = 1 << 17
_tables: dict[str, np.ndarray] = {}


def letters() -> tuple[np.ndarray, np.ndarray]:
    """Which code points are letters, and the lower case of the first ones."""
    if not _tables:
        _tables["alpha"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        low = [c if len(chr(c).lower()) != 1 else ord(chr(c).lower()) for c in range(0x590)]
        _tables["lower"] = np.array(low, np.uint32)
    return _tables["alpha"], _tables["lower"]


def code_points(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts in buf and their offsets."""
    points = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    if lead[-1] != len(points):  # invalid UTF-8: text by text
        each = [np.frombuffer(buf[a:b].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32) for a, b in zip(starts, starts[1:], strict=False)]
        return np.concatenate(each or [points[:0]]), np.concatenate([[0], np.cumsum([len(e) for e in each])]).astype(np.int64)
    return points, lead[starts]


def letter_words(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased points, starts and ends of words, and the first word of each text."""
    alpha, lower = letters()
    points = np.where(points < len(lower), lower[np.minimum(points, len(lower) - 1)], points)
    solid = alpha[points]
    edge = np.zeros(len(points) + 1, bool)
    edge[starts] = True
    prior = np.concatenate([[False], solid[:-1]]) if len(solid) else solid
    after = np.concatenate([solid[1:], [False]]) if len(solid) else solid
    s = np.flatnonzero(solid & (~prior | edge[:-1]))
    e = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return points, s, e, np.searchsorted(s, starts)


def word_prints(points: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    return kit.bytes_hash(np.ascontiguousarray(points, np.uint32).view(np.uint8), 4 * s, 4 * e)


def load_pieces(path: str) -> list[str]:
    """All pieces of letters, with or without the word-start mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    mark = chr(START)
    found = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(p for p in found if p == mark or p.removeprefix(mark).isalpha())


class Pieces:
    """The vocabulary as a trie in sorted arrays."""

    def __init__(self, pieces: list[str]):
        child: dict[int, int] = {}
        ends: dict[int, int] = {}
        for i, p in enumerate(pieces):
            node = 0
            for c in p:
                node = child.setdefault(node << 21 | ord(c), len(child) + 1)
            ends[node] = i
        self.n = len(pieces)
        self.longest = max(map(len, pieces))
        self.keys = np.array(sorted(child), np.int64)
        self.next = np.array([child[k] for k in self.keys.tolist()], np.int64)
        self.piece = np.full(len(child) + 1, self.n, np.int32)
        self.piece[list(ends)] = list(ends.values())

    def edges(self, symbols: np.ndarray, stop: np.ndarray):
        """(size, positions, pieces) for each size: the pieces that start at the positions; stop: where each one's word ends.

        A single symbol that is no piece comes as piece n.
        """
        at, node = np.arange(len(symbols)), np.zeros(len(symbols), np.int64)
        for size in range(1, self.longest + 1):
            inside = at + size <= stop[at]
            at, node = at[inside], node[inside]
            key = node << 21 | symbols[at + size - 1]
            j = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[j] == key
            if size == 1:
                found = np.where(ok, self.piece[self.next[j]], self.n)
                yield 1, at, found
            at, node = at[ok], self.next[j[ok]]
            if size > 1:
                hit = self.piece[node] < self.n
                if hit.any():
                    yield size, at[hit], self.piece[node[hit]]
            if not len(at):
                break


class Lattice:
    """All segmentations of some words, longest word first. State j of a word stands behind its j-th symbol."""

    def __init__(self, pieces: Pieces, points: np.ndarray, s: np.ndarray, e: np.ndarray):
        size = e - s + 1
        self.order = np.argsort(-size, kind="stable")
        self.size = size = size[self.order]
        begin = np.cumsum(size) - size
        symbols = np.full(int(size.sum()), START, np.int64)
        inner = np.ones(len(symbols), bool)
        inner[begin] = False
        symbols[inner] = points[np.repeat(s[self.order] - begin - 1, size)[inner] + np.flatnonzero(inner)]
        word = np.repeat(np.arange(len(size)), size)
        #: First and last state of each word.
        self.first, self.last = begin + np.arange(len(size)), begin + np.arange(len(size)) + size
        self.states = len(symbols) + len(size)
        longest = min(pieces.longest, int(size[0]))
        #: By size and end state: the piece, or n + 1 for none.
        self.table = np.full((longest, self.states + longest), pieces.n + 1, np.int32)
        self.starts, self.ends, self.found = [], [], []
        for n, at, found in pieces.edges(symbols, (begin + size)[word]):
            self.starts.append(at + word[at])
            self.ends.append(at + word[at] + n)
            self.found.append(found)
            self.table[n - 1, self.ends[-1]] = found
        self.steps = np.arange(1, longest + 1)[:, None]

    def forward(self, logs: np.ndarray) -> np.ndarray:
        """log of the summed probability of all segmentations up to each state, a column a language."""
        a = np.full((self.states, logs.shape[1]), -np.inf)
        a[self.first] = 0
        for j in range(1, int(self.size[0]) + 1):
            at = self.first[: np.searchsorted(-self.size, -j, "right")] + j
            m = min(j, len(self.table))
            a[at] = _log_sum(a[at - self.steps[:m]] + logs[self.table[:m, at]])
        return a

    def backward(self, logs: np.ndarray) -> np.ndarray:
        """The same from each state to the end of its word."""
        b = np.full((self.states + len(self.table), logs.shape[1]), -np.inf)
        b[self.last] = 0
        for j in range(int(self.size[0]) - 1, -1, -1):
            at = self.first[: np.searchsorted(-self.size, -j - 1, "right")] + j
            ahead = at + self.steps
            b[at] = _log_sum(b[ahead] + logs[self.table[self.steps - 1, ahead]])
        return b


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = np.maximum(x.max(0), -1e300)
    with np.errstate(divide="ignore"):
        return top + np.log(np.exp(x - top).sum(0))


def log_table(probs: np.ndarray) -> np.ndarray:
    """Logs of the pieces' probabilities, then of the unseen symbol and of no piece."""
    with np.errstate(divide="ignore"):
        return np.concatenate([np.log(probs), np.full((1, probs.shape[1]), np.log(UNSEEN)), np.full((1, probs.shape[1]), -np.inf)])


def passes(s: np.ndarray, e: np.ndarray) -> list[np.ndarray]:
    """Words in groups of like length, each of at most PASS_SYMBOLS symbols (or one word)."""
    order = np.argsort(s - e, kind="stable")
    group = np.cumsum((e - s + 1)[order]) // PASS_SYMBOLS
    return np.split(order, np.flatnonzero(np.diff(group)) + 1) if len(order) else []


def word_logs(pieces: Pieces, logs: np.ndarray, points: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """log P(word) in each language, summed over all segmentations."""
    out = np.empty((len(s), logs.shape[1]))
    for x in passes(s, e):
        lattice = Lattice(pieces, points, s[x], e[x])
        out[x[lattice.order]] = lattice.forward(logs)[lattice.last]
    return out


def fit(pieces: Pieces, words: list[str], counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities of each language by expectation maximisation; counts: words x languages."""
    probs = np.full((pieces.n, counts.shape[1]), 1 / pieces.n)
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    e = np.cumsum([len(w) for w in words])
    s = e - [len(w) for w in words]
    for _ in range(rounds):
        logs, total = log_table(probs), np.zeros((pieces.n + 1, counts.shape[1]))
        for x in passes(s, e):
            lattice = Lattice(pieces, points, s[x], e[x])
            a, b = lattice.forward(logs), lattice.backward(logs)
            n = counts[x[lattice.order]]
            z = a[lattice.last]
            word = np.repeat(np.arange(len(z)), lattice.size + 1)
            for u, v, found in zip(lattice.starts, lattice.ends, lattice.found, strict=True):
                share = np.exp(a[u] + logs[found] + b[v] - z[word[u]]) * n[word[u]]
                for g in range(counts.shape[1]):
                    total[:, g] += np.bincount(found, share[:, g], pieces.n + 1)
        probs = (total[:-1] + 0.01) / (total[:-1] + 0.01).sum(0)
    return probs


def fold(id_col: str, folds: int):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def train(docs: DataFrame, pieces: list[str], id_col="doc_id", text_col="text", lang_col="lang", folds=FOLDS, test_fold=TEST_FOLD, per_lang=PER_LANG, max_chars=MAX_CHARS):
    """Languages in order and piece probabilities (None if nothing can be learned)."""
    pick = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (fold(id_col, folds) != test_fold))
    pick = pick.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.md5(F.col(id_col).cast("string").cast("binary")).alias("k"))
    # The hash admits about the bound of each language before the exact cut, so the cut holds few texts.
    many = kit.save(pick.groupBy("lang").agg(F.count("*").alias("many")), "languages")
    share = F.conv(F.substring("k", 1, 8), 16, 10).cast("double") / 2**32
    pick = kit.join_small(pick, many, "lang", "inner").where(share <= 1.2 * (per_lang + 50) / F.col("many")).where(F.length("text") <= max_chars // 10)
    by = Window.partitionBy("lang").orderBy("k", F.xxhash64("text"))
    pick = pick.withColumns({"rank": F.row_number().over(by), "chars": F.sum(F.length("text")).over(by.rowsBetween(Window.unboundedPreceding, 0))})
    pick = pick.where((F.col("rank") <= per_lang) & (F.col("chars") <= max_chars))

    def words(batches):
        for batch in batches:
            lang = batch.column("lang").to_pylist()
            for a, b, buf, starts in kit.texts_of(batch):
                points, s, e, first = letter_words(*code_points(buf, starts))
                prints = word_prints(points, s, e)
                for i in range(b - a):
                    _, at, times = np.unique(prints[first[i] : first[i + 1]], return_index=True, return_counts=True)
                    at += first[i]
                    found = [points[x:y].astype(np.uint32).tobytes().decode("utf-32-le") for x, y in zip(s[at], e[at], strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array([lang[a + i]] * len(found), pa.string()), pa.array(found, pa.string()), pa.array(times, pa.int64())], ["lang", "word", "n"])

    got = pick.select("lang", "text").mapInArrow(kit.lean(words), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).collect()
    if not got:
        return [], None
    langs = sorted({r.lang for r in got})
    names = sorted({r.word for r in got})
    at = {w: i for i, w in enumerate(names)}
    counts = np.zeros((len(names), len(langs)))
    for r in got:
        counts[at[r.word], langs.index(r.lang)] += r.n
    return langs, fit(Pieces(pieces), names, counts)


def identify_language(docs: DataFrame, vocabulary: str = VOCABULARY, id_col="doc_id", text_col="text", lang_col="lang", folds=FOLDS, test_fold=TEST_FOLD, per_lang=PER_LANG, max_chars=MAX_CHARS) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    pieces = load_pieces(vocabulary)
    langs, probs = train(docs, pieces, id_col, text_col, lang_col, folds, test_fold, per_lang, max_chars)

    def run(batches):
        table, logs_of = Pieces(pieces), log_table(probs) if probs is not None else None
        known, logs = np.zeros(0, np.uint64), np.zeros((0, len(langs)))
        for batch in batches:
            names, scores = [], []
            for a, b, buf, starts in kit.texts_of(batch):
                points, s, e, first = letter_words(*code_points(buf, starts))
                if probs is None or not len(s):
                    names += ["und"] * (b - a)
                    scores += [0.0] * (b - a)
                    continue
                prints, lead, back = np.unique(word_prints(points, s, e), return_index=True, return_inverse=True)
                at = np.minimum(np.searchsorted(known, prints), max(len(known) - 1, 0))
                hit = known[at] == prints if len(known) else np.zeros(len(prints), bool)
                each = np.empty((len(prints), len(langs)))
                each[hit] = logs[at[hit]]
                miss = np.flatnonzero(~hit)
                each[miss] = word_logs(table, logs_of, points, s[lead[miss]], e[lead[miss]])
                if len(known) < CACHE_WORDS and len(miss):
                    known, logs = np.concatenate([known, prints[miss]]), np.concatenate([logs, each[miss]])
                    order = np.argsort(known)
                    known, logs = known[order], logs[order]
                total = np.zeros((len(back) + 1, len(langs)))
                np.cumsum(each[back], axis=0, out=total[1:])
                text = total[first[1:]] - total[first[:-1]]
                best = text.argmax(1)
                post = 1 / np.exp(text - text.max(1, keepdims=True)).sum(1)
                some = np.diff(first) > 0
                names += [langs[i] if ok else "und" for i, ok in zip(best, some, strict=True)]
                scores += np.where(some, post, 0.0).tolist()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = slim.mapInArrow(kit.lean(run), "doc_id long, lang_pred string, score double")
    return out.select("doc_id", F.coalesce(fold("doc_id", folds) == test_fold, F.lit(False)).alias("held_out"), "lang_pred", "score")
