"""Substring dedup of word windows by difference-cover anchors.

A perfect difference set D modulo v holds, for each distance, two residues
that far apart. So of any two equal windows of w words, at positions i and j,
some offset d < v puts both i + d and j + d on residues of D: hashing the
w - v + 1 words at cover positions only, both windows hash an aligned anchor
alike, wherever they start.

1. Texts are range-partitioned by id and text hash and cut into chunks, so a
   chunk lies wholly before or after another. The chunks are a table bucketed by
   the task that made them: this is the only time texts are shuffled. Each chunk
   sends its anchors to their owners as compressed fingerprints; those that
   occur elsewhere come back marked.
2. Extension: a window can repeat only if an anchor inside it is marked. Each
   marked anchor is extended to all windows around it; their words are read
   from the text and digested whole (BLAKE2b, 128 bits). Fingerprints thus only
   choose what is looked at; equal digests of whole windows decide.
3. A chunk sends each digest once; its owner marks it for all chunks but the
   first. Inside a chunk the first occurrence is known.
4. The words to remove, a bit each, go to the chunks.

The plan is the same at every size: answers go to the chunks' buckets, nothing
is broadcast. Owners grow with the bytes of the texts, so that what one holds
does not.

No pair is ever listed: the work is linear in the number of windows, and a hot
window costs its owner one entry a chunk.

Defined results: a null text has no words; null ids come last; rows that share
an id count one after another, by the hash of their texts; equal rows (id and
text) count as one document, so they do not remove each other; equal texts
under two ids: the later loses all its windows; an empty table gives no rows;
other columns are not read, whatever their names. Very long texts are handled
whole: memory follows the longest text, and a chunk holds one text at least.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kit

WINDOW = 20
#: Perfect difference sets by their modulus.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9)}
PRINT_BITS = 48
#: Bytes of text of one chunk, about, and of all texts for each owner.
CHUNK_BYTES, OWNER_BYTES = 4 << 20, 64 << 20


def cover_of(window: int) -> tuple[int, np.ndarray, int]:
    """The largest cover whose anchors still have a third of a window, its residues, and the anchor's words."""
    v = max(m for m in COVERS if window - m + 1 >= max(1, window // 3))
    on = np.zeros(v, bool)
    on[list(COVERS[v])] = True
    return v, on, window - v + 1


def _anchor_places(first: np.ndarray, on: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    at, doc = kit.positions(first, k)
    keep = on[(at - first[:-1][doc]) % len(on)]
    return at[keep], doc[keep]


def anchors(window: int):
    v, on, k = cover_of(window)

    def find(buf, starts):
        words, first, _, _ = kit.word_hashes(buf, starts)
        at, doc = _anchor_places(first, on, k)
        return kit.gram_hashes(words, at, k) >> np.uint64(64 - PRINT_BITS), np.bincount(doc, minlength=len(starts) - 1)

    return find


def candidates(first: np.ndarray, flag: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, text) of the windows with a marked anchor; flag marks the anchors of all texts in order."""
    v, on, k = cover_of(window)
    at, _ = _anchor_places(first, on, k)
    seen = np.zeros(first[-1] + 2, np.int32)
    seen[at[flag] + 1] = 1
    np.cumsum(seen, out=seen)
    start, of = kit.positions(first, window)
    keep = seen[start + v] > seen[start]
    return start[keep], of[keep]


def _digest(data: memoryview, s: np.ndarray, e: np.ndarray) -> str:
    return hashlib.sha256(b" ".join([data[a:b] for a, b in zip(s.tolist(), e.tolist(), strict=True)])).hexdigest()


def _whole(text: bytes) -> str:
    return hashlib.sha256(b" ".join(text.split())).hexdigest()


def digests(text: bytes, s: np.ndarray, e: np.ndarray, start: np.ndarray, window: int) -> np.ndarray:
    """128-bit BLAKE2b of the words of each window, joined by one space: rows of two uint64."""
    joined = b" ".join([text[a:b] for a, b in zip(s.tolist(), e.tolist(), strict=True)])
    at = np.concatenate([[0], np.cumsum(e - s + 1)])
    spans = zip(at[start].tolist(), (at[start + window] - 1).tolist(), strict=True)
    raw = b"".join([hashlib.blake2b(joined[a:b], digest_size=16).digest() for a, b in spans])
    return np.frombuffer(raw, np.uint64).reshape(-1, 2)


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def _prints(texts: list[bytes], window: int, owners: int):
    """Distinct anchors of a chunk, sorted; the place among them of each anchor; how often each occurs; the owners' shares."""
    buf, starts = _joined(texts)
    find = anchors(window)
    found = [find(buf[starts[a] : starts[b]], starts[a : b + 1] - starts[a])[0] for a, b in kit.slices(starts)]
    seen, back, times = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
    return seen, back, times, list(kit.by_owner(seen, PRINT_BITS, owners))


def _chunks(window: int, owners: int):
    """Sorted texts to chunks, and their anchors for the owners."""

    def scan(batches):
        chunk = kit.chunk_ids()
        held: list[list] = []
        n = 0

        def flush():
            k = next(chunk)
            yield kit.routed("state", [-1], k, [kit.pack(held)])
            seen, _, _, cuts = _prints([t for _, _, t, _ in held], window, owners)
            if cuts:
                yield kit.routed("message", [o for o, _, _ in cuts], k, [kit.rice_encode(seen[a:b]) for _, a, b in cuts])

        for batch in batches:
            ids, hashes = kit.ids_of(batch.column("doc_id")).tolist(), batch.column("thash").to_pylist()
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py().encode("utf-8", "surrogatepass")
                if held and held[-1][:2] == [ids[i], hashes[i]] and held[-1][2] == text:
                    held[-1][3] += 1
                    continue
                if n >= CHUNK_BYTES:
                    yield from flush()
                    held.clear()
                    n = 0
                held.append([ids[i], hashes[i], text, 1])
                n += len(text)
        if held:
            yield from flush()

    return scan


def _windows(window: int, owners: int):
    """Chunks with their marked anchors: window digests for their owners, and the state to apply the answers to."""

    def digest(chunk, held, replies):
        texts = [t for _, _, t, _ in held]
        _, back, times, cuts = _prints(texts, window, owners)
        marked = times > 1
        told = {r["owner"]: r["reply"] for r in replies}
        for o, a, b in cuts:
            marked[a:b] |= kit.unmark(told[o], b - a)
        flag = marked[back]
        buf, starts = _joined(texts)
        s, e, first = kit.word_bounds(buf, starts)
        start, of = candidates(first, flag, window)
        if not len(start):
            return
        s -= np.repeat(starts[:-1], np.diff(first))
        e -= np.repeat(starts[:-1], np.diff(first))
        found = []
        for i, a, b in zip(*_runs(of), strict=True):
            f, g = first[i], first[i + 1]
            found.append(digests(texts[i], s[f:g], e[f:g], start[a:b] - f, window))
        one, two = np.concatenate(found).T
        # The sort is stable, so the first of equal digests is the first in text order.
        order = np.lexsort((two, one))
        new = np.ones(len(order), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        lead = np.flatnonzero(new)
        later = np.ones(len(order), bool)
        later[order[lead]] = False
        back = np.empty(len(order), np.uint32)
        back[order] = np.cumsum(new) - 1
        one, two = one[order][lead], two[order][lead]
        cuts = list(kit.by_owner(one, 64, owners))
        state = (np.diff(first).astype(np.int32), np.packbits(flag), len(flag), back, np.packbits(later), cuts)
        yield kit.routed("state", [-1], chunk, [kit.pack(state)])
        where = held[0][:2]
        yield kit.routed("message", [o for o, _, _ in cuts], chunk, [kit.pack((where, kit.rice_encode(one[a:b]), two[a:b].tobytes())) for _, a, b in cuts])

    def scan(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, payload, replies = (batch.column(c)[i].as_py() for c in ("chunk", "payload", "replies"))
                yield from digest(chunk, kit.unpack(payload), replies)

    return scan


def _runs(of: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """(text, from, to) of the runs of equal texts in a sorted array."""
    cuts = np.flatnonzero(np.diff(of, prepend=-1))
    return of[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(of)]


def _after_first(payloads: list[bytes]) -> list[bytes]:
    """Owner's answer: for each chunk a bitmap of the windows that an earlier chunk holds."""
    ids, hashes, one, two = [], [], [], []
    for p in payloads:
        (doc_id, thash), a, b = kit.unpack(p)
        one.append(kit.rice_decode(a))
        two.append(np.frombuffer(b, np.uint64))
        ids.append(np.full(len(one[-1]), doc_id, np.int64))
        hashes.append(np.full(len(one[-1]), thash, np.int64))
    sizes = [len(x) for x in one]
    ids, hashes, one, two = (np.concatenate(x) for x in (ids, hashes, one, two))
    order = np.lexsort((hashes, ids, two, one))
    later = np.zeros(len(order), bool)
    later[order[1:]] = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
    out, at = [], 0
    for n in sizes:
        out.append(np.packbits(later[at : at + n]).tobytes())
        at += n
    return out


def _verdicts(window: int):
    """The words that go from each chunk, a bit each; no row where all stay."""

    def judge(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, payload, replies = (batch.column(c)[i].as_py() for c in ("chunk", "payload", "replies"))
                counts, flag, n, back, later, cuts = kit.unpack(payload)
                told = {r["owner"]: r["reply"] for r in replies}
                gone = np.concatenate([kit.unmark(told[o], b - a) for o, a, b in cuts])
                dup = np.unpackbits(later, count=len(back)).astype(bool) | gone[back]
                if not dup.any():
                    continue
                first = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                hit = candidates(first, np.unpackbits(flag, count=n).astype(bool), window)[0][dup]
                cover = np.zeros(first[-1] + 1, np.int32)
                cover[hit] += 1
                cover[hit + window] -= 1
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([np.packbits(np.cumsum(cover)[:-1] > 0).tobytes()])], ["chunk", "gone"])

    return judge


def _apply(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            held, gone = kit.unpack(batch.column("payload")[i].as_py()), batch.column("gone")[i].as_py()
            texts = [t for _, _, t, _ in held]
            buf, starts = _joined(texts)
            s, e, first = kit.word_bounds(buf, starts)
            keep = ~kit.unmark(gone, len(s)) if gone else np.ones(len(s), bool)
            s -= np.repeat(starts[:-1], np.diff(first))
            e -= np.repeat(starts[:-1], np.diff(first))
            rows = []
            for (doc_id, _, text, times), a, b in zip(held, first[:-1].tolist(), first[1:].tolist(), strict=True):
                stay = keep[a:b]
                lost = b - a - int(stay.sum())
                sha = _digest(memoryview(text), s[a:b][stay], e[a:b][stay]) if lost else _whole(text)
                rows += [(doc_id, b - a, lost, sha)] * times
            yield pa.RecordBatch.from_arrays(
                [kit.ids_back(np.array([r[0] for r in rows])), *(pa.array([r[j] for r in rows], t) for j, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.string())))],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, owners: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 after removing each word that a window seen earlier covers."""
    owners = owners or kit.owners_for(docs, text_col, OWNER_BYTES)
    order = (F.col("doc_id").asc_nulls_last(), F.col("thash"))
    ranged = kit.keyed(docs, id_col, text_col).repartitionByRange(owners, *order).sortWithinPartitions(*order)
    chunks = kit.save_chunks(ranged.mapInArrow(kit.lean(_chunks(window, owners)), kit.ROUTED), "substring-chunks", owners)
    texts = chunks.where("kind = 'state'")
    marks = kit.exchange(chunks.where("kind = 'message'").select("owner", "chunk", "payload"), owners, kit.repeated_marks, "substring-marks")
    kit.drop_saved(chunks, "message")
    digested = kit.with_told(texts, marks).select("chunk", "payload", "replies").mapInArrow(kit.lean(_windows(window, owners)), kit.ROUTED)
    windows = kit.save_chunks(digested, "substring-windows", owners)
    firsts = kit.exchange(windows.where("kind = 'message'").select("owner", "chunk", "payload"), owners, _after_first, "substring-first")
    kit.drop_saved(windows, "message")
    kit.drop_saved(marks)
    judged = kit.with_told(windows.where("kind = 'state'"), firsts).select("chunk", "payload", "replies")
    gone = judged.mapInArrow(kit.lean(_verdicts(window)), "chunk long, gone binary")
    return kit.with_told(texts, gone, "left").select("payload", "gone").mapInArrow(kit.lean(_apply), "doc_id long, n_words long, n_removed long, kept_sha256 string")
