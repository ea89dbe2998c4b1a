"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts are words (runs of letters, digits and non-ASCII bytes, A-Z lowered), so
punctuation glued to a passage does not hide it. In scripts written without
spaces every character is a word, and full-width and general punctuation
separates like ASCII punctuation. The CGK embedding walks along
a sequence: at step j it reads the word under its pointer and moves on when
that word's random bit for step j is 1; at the end of the sequence it stays.

Recall: an item of m words in which k edits are allowed is cut into k + 1
segments of nearly equal length that span it. Wherever the edits lie, one
segment has none (an edit touches one segment at most), so its walk reads the
same words in the document and collides in every sampled step: one repetition
a segment gives a recall of 1 at the stated similarity, for items of any
length and for edits of any kind and place.

LSH: the key of a segment is SAMPLES of the 2n steps of its walk, one from
each part; a walk from each word of a document embeds the windows of all
segment lengths at once (at a similarity of 0.8 up to 5 words; a longer segment
is keyed by its first MAX_SEGMENT words). Windows whose keys equal a segment's
are candidates. Candidates are verified: the item's exact edit distance, in
words, to the best stretch around the window must be at most (1 - similarity)
of the item's words.

Items are a checked size: more than ITEMS_AT_ONCE go in blocks, a pass each.
Documents stay where they are; only hits leave a task.

Defined results: null or blank texts and items without any word have no hits;
items too short for an edit (fewer than 5 words at 0.8) are found by exact
match of their words; equal items each hit; of several places at one distance
the first counts; repeated rows hit each, alike; null ids come out as null; a
very long text is searched whole; an empty table gives no rows; other columns
are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kit

SIMILARITY = 0.8
SAMPLES, MAX_SEGMENT = 6, 8
ITEMS_AT_ONCE = 20_000
_INSIDE = np.zeros(256, bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _INSIDE[_a:_b] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: First and last code points of scripts without spaces between words: Thai and Lao, Tibetan, Myanmar, Khmer, Tai,
#: kana and Bopomofo, Han, Yi, half-width kana, kana and Han beyond the first plane.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x3029),
    (0x3031, 0x303C), (0x3041, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA000, 0xA4CF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF),
    (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF),
)
#: The same of punctuation and spaces outside ASCII that stand between words.
BETWEEN = (
    (0x2000, 0x200A), (0x2010, 0x2029), (0x202F, 0x205F), (0x3000, 0x3004), (0x3008, 0x3020), (0x302A, 0x3030), (0x303D, 0x303F), (0x30FB, 0x30FB),
    (0xFE30, 0xFE4F), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65),
)


def _within(points: np.ndarray, ranges) -> np.ndarray:
    edges = np.array(ranges)
    at = np.searchsorted(edges[:, 0], points, "right") - 1
    return (at >= 0) & (points <= edges[at, 1])


def words_of(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and the first word of each text."""
    s, e, first = kit.word_bounds(buf, starts, _INSIDE)
    # Characters of three and four bytes; nothing below U+0800 is unspaced.
    lead = np.flatnonzero(buf >= 0xE0)
    size = 3 + (buf[lead] >= 0xF0)
    whole = lead + size <= len(buf)
    lead, size = lead[whole], size[whole]
    if len(lead):
        b = buf[lead[:, None] + np.arange(3)].astype(np.int64) & 0x3F
        last = buf[lead + size - 1].astype(np.int64) & 0x3F
        points = np.where(size == 3, (b[:, 0] & 0xF) << 12 | b[:, 1] << 6 | b[:, 2], (b[:, 0] & 7) << 18 | b[:, 1] << 12 | b[:, 2] << 6 | last)
        between = _within(points, BETWEEN)
        single = _within(points, UNSPACED) & ~between
        apart = single | between
        if apart.any():
            # A character that stands apart ends the word before it and starts the next; punctuation is then left out.
            cuts = np.unique(np.concatenate([s, lead[apart], (lead + size)[apart]]))
            ends = np.unique(np.concatenate([e, lead[apart], (lead + size)[apart]]))
            # Pieces of words lie between neighbouring cuts inside one word.
            word = np.searchsorted(s, cuts, "right") - 1
            s = cuts[(word >= 0) & (cuts < e[word])]
            e = ends[np.searchsorted(ends, s, "right")]
            keep = ~np.isin(s, lead[between])
            s, e = s[keep], e[keep]
            first = np.searchsorted(s, starts)
    return kit.bytes_hash(_LOWER[buf], s, e), first


def segments(n: int, edits: int) -> list[tuple[int, int]]:
    """(offset, length) of the edits + 1 segments that span n words; edits < n."""
    cuts = [n * i // (edits + 1) for i in range(edits + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


class Plan:
    """Random choices of the walk and of the sampled steps of each window length, the same everywhere."""

    def __init__(self, lengths: list[int], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.steps = 2 * max(lengths)
        self.turn = rng.integers(1, 1 << 63, self.steps, np.uint64) * np.uint64(2) + np.uint64(1)
        self.sampled: dict[int, set[int]] = {}
        for n in lengths:
            cuts = np.linspace(0, 2 * n, SAMPLES + 1).astype(int)
            self.sampled[n] = {int(rng.integers(a, max(b, a + 1))) for a, b in zip(cuts, cuts[1:], strict=False)}

    def keys(self, words: np.ndarray, at: np.ndarray, wanted: list[int]) -> dict[int, np.ndarray]:
        """By window length the keys of the walks from each position; words go on for self.steps behind the last."""
        keys = {n: np.zeros(len(at), np.uint64) for n in wanted}
        p = at.copy()
        for j in range(1 + max(max(self.sampled[n]) for n in wanted)):
            read = words[p]
            for n in wanted:
                if j in self.sampled[n]:
                    keys[n] *= np.uint64(0x9E3779B97F4A7C15)
                    keys[n] += read if j < n else words[np.minimum(p, at + (n - 1))]
            p += ((read * self.turn[j]) >> np.uint64(63)).astype(p.dtype)
        return keys


class Items:
    def __init__(self, rows: list[tuple[int, str]], similarity: float):
        data = [t.encode() for _, t in rows]
        starts = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
        words, first = words_of(np.frombuffer(b"".join(data), np.uint8), starts)
        every = [(i, words[a:b], a) for (i, _), a, b in zip(rows, first.tolist(), first[1:].tolist(), strict=False)]
        self.items = [(i, w) for i, w, _ in every if len(w)]
        self.lists = [w.tolist() for _, w in self.items]
        self.allowed = [int((1 - similarity) * len(w) + 1e-9) for _, w in self.items]
        base = [a for _, w, a in every if len(w)]
        cut: dict[int, list[tuple[int, int]]] = {}
        for k, (_, w) in enumerate(self.items):
            for offset, n in segments(len(w), min(self.allowed[k], len(w) - 1)):
                cut.setdefault(min(n, MAX_SEGMENT), []).append((k, offset))
        self.plan = Plan(sorted(cut)) if cut else None
        self.tables = {}
        for n, own in cut.items():
            whose, offset = np.array(own).T
            padded = np.concatenate([words, np.zeros(self.plan.steps, np.uint64)])
            keys = self.plan.keys(padded, np.array(base)[whose] + offset, [n])[n]
            order = np.argsort(keys)
            bits = min(24, max(16, (16 * len(keys)).bit_length()))
            near = np.zeros(1 << bits, bool)
            near[(keys >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.tables[n] = (keys[order], whose[order], offset[order], near, np.uint64(64 - bits))
        self.masks: dict[int, dict[int, int]] = {}

    def candidates(self, words: np.ndarray) -> np.ndarray:
        """Distinct (position of the window, item, presumed start of the item) rows whose keys collide."""
        padded = np.concatenate([words, np.zeros(self.plan.steps, np.uint64)])
        found = []
        for n, keys in self.plan.keys(padded, np.arange(len(words), dtype=np.int32), list(self.tables)).items():
            table, whose, offset, near, shift = self.tables[n]
            p = np.flatnonzero(near[(keys >> shift).astype(np.int32)])
            lo, hi = np.searchsorted(table, keys[p], "left"), np.searchsorted(table, keys[p], "right")
            count = hi - lo
            at = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(count.sum())
            p = np.repeat(p, count)
            found.append(np.stack([p, whose[at], p - offset[at]], 1))
        return np.unique(np.concatenate(found), axis=0)

    def distance(self, k: int, text: list[int]) -> tuple[int, int]:
        """Edit distance of item k to its best stretch in text, and where that ends: Myers' bit vectors."""
        words = self.items[k][1]
        mask = self.masks.get(k)
        if mask is None:
            mask = self.masks[k] = {}
            for i, w in enumerate(words.tolist()):
                mask[w] = mask.get(w, 0) | 1 << i
        m = len(words)
        full, top = (1 << m) - 1, 1 << (m - 1)
        pv, mv, score, best, end = full, 0, m, m, 0
        for j, w in enumerate(text):
            eq = mask.get(w, 0)
            xv = eq | mv
            xh = ((((eq & pv) + pv) ^ pv) | eq) & full
            ph = mv | (~(xh | pv) & full)
            mh = pv & xh
            score += bool(ph & top) - bool(mh & top)
            ph, mh = (ph << 1) & full, (mh << 1) & full
            pv = mh | (~(xv | ph) & full)
            mv = ph & xv
            if score < best:
                best, end = score, j + 1
        return best, end

    def hits(self, words: np.ndarray, first: np.ndarray):
        """(text, item id, words of the item, distance, position) of every verified item, once a text."""
        if self.plan is None or not len(words):
            return
        pairs = self.candidates(words)
        if not len(pairs):
            return
        doc = np.searchsorted(first, pairs[:, 0], "right") - 1
        order = np.lexsort((pairs[:, 2], pairs[:, 1], doc))
        doc, (_, item, at) = doc[order], pairs[order].T
        # Candidates of one text and item whose stretches touch are verified as one stretch.
        room = np.array(self.allowed)[item]
        apart = np.ones(len(doc), bool)
        apart[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (at[1:] - at[:-1] > room[1:] + 1)
        head = np.flatnonzero(apart)
        tail = np.append(head[1:], len(doc)) - 1
        last, best = None, None
        for d, k, p, q in zip(doc[head].tolist(), item[head].tolist(), at[head].tolist(), at[tail].tolist(), strict=True):
            if (d, k) != last:
                if best:
                    yield best
                last, best = (d, k), None
            if best and best[3] == 0:
                continue
            m, room = len(self.items[k][1]), self.allowed[k]
            lo = max(int(first[d]), p - room)
            hi = min(int(first[d + 1]), q + m + 2 * room)
            text = words[lo:hi].tolist()
            have = set(text)
            # Each word of the item that the stretch lacks costs an edit.
            if sum(w not in have for w in self.lists[k]) > room:
                continue
            score, end = self.distance(k, text)
            if score <= room and (best is None or score < best[3]):
                best = (d, self.items[k][0], m, score, max(0, lo + end - m - int(first[d])))
        if best:
            yield best


def _leaks(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col="item_id", item_text="text", similarity: float = SIMILARITY) -> DataFrame:
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text")).where("text is not null")
    blocks = max(1, -(-items.count() // ITEMS_AT_ONCE))
    slim = kit.keyed(docs, id_col, text_col)
    out = None
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        part = slim.mapInArrow(kit.lean(_scan(Items([(r.item_id, r.text) for r in rows], similarity))), "doc_id long, thash long, item_id long, item_words long, distance long, position long")
        out = part if out is None else out.unionByName(part)
    return out


def _scan(items: Items):
    def scan(batches):
        for batch in batches:
            ids, thash = kit.ids_of(batch.column("doc_id")), batch.column("thash").to_numpy(zero_copy_only=False)
            for a, _, buf, starts in kit.texts_of(batch):
                rows = list(items.hits(*words_of(buf, starts)))
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [kit.ids_back(ids[a + np.array(cols[0])]), pa.array(thash[a + np.array(cols[0])]), *(pa.array(c, pa.int64()) for c in cols[1:])],
                        ["doc_id", "thash", "item_id", "item_words", "distance", "position"],
                    )

    return scan


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """doc_id, item_id, item_words, distance, position: a row for each item that a document holds."""
    return _leaks(docs, benchmark, id_col, text_col, **options).drop("thash")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """The rows of docs that hold no item."""
    return kit.without(docs, _leaks(docs, benchmark, id_col, text_col, **options), id_col, text_col)
