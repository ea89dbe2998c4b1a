"""Suffix-array dedup: threshold-bounded interval expansion on a Burrows-Wheeler transform.

Bytes that a `length`-byte string covers go if the string starts anywhere else.

1. Routing. Equal strings choose equal anchors: the smallest hash among the
   ANCHOR-byte grams inside them. Texts are cut into chunks where they are read,
   as a table bucketed by the task that read them; each chunk sends its anchors
   to their owners as compressed fingerprints, and only those that occur twice
   go on.
   A marked anchor's segment is the stretch of all windows that chose it, so
   any two equal windows lie in two segments of one anchor.
2. Each chunk sends its distinct segments, with whether it holds them twice,
   to the anchors' owners; owners merge equal segments and add their weights.
3. An owner concatenates the segments of some anchors, up to BATCH bytes, sorts
   the suffixes by `length` symbols (prefix doubling), takes the transform and
   runs breadth first over the intervals of strings of 1, 2, 3 ... symbols:
   extending an interval backwards by a symbol gives an interval of a string
   one longer, whose right end, if new, gets that common-prefix length. Values
   come in increasing order and the search stops below `length`. Boundaries
   still without a value separate suffixes that share `length` bytes; a run of
   such suffixes with weight two or more repeats.
4. Bitmaps of the repeated starts go back; the covered spans go to the chunks,
   which lose them.

Texts are never shuffled and nothing is broadcast, at any size: answers go to
the chunks' buckets. Owners grow with the bytes of the texts.

An anchor whose segments are all equal needs no transform: its one segment
repeats by its weight. An anchor with more than SPLIT bytes of segments (a hot
line) is divided by the windows' offset to the anchor and by the bytes that
all windows of an offset range share, which equal windows have in common.

Defined results: a null text is empty; matches never cross texts; copies of a
row count as elsewhere even under one id; null ids come out as null; an empty
table gives no rows; other columns are not read, whatever their names. Very
long texts are handled whole: memory follows the longest text.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kit

LENGTH, PRINT_BITS = 200, 48
BATCH, SPLIT = 1 << 18, 2 << 20
#: Owners of segments for each shuffle partition: segments are long, so an owner has few.
OWNERS = 4
#: Bytes of text of one chunk, about, and of all texts for each owner of anchors.
CHUNK_BYTES, OWNER_BYTES = 4 << 20, 64 << 20
_LOW = np.uint64((1 << 24) - 1)


def gram_of(length: int) -> int:
    """Bytes of an anchor: long enough to be rare, short enough to be chosen sparsely."""
    return max(1, length // 4)


def choose(buf: np.ndarray, starts: np.ndarray, length: int):
    """Anchors in text order: their positions, hashes, texts, first window start and number of windows."""
    k = gram_of(length)
    w = length - k + 1
    n = len(buf)
    size = np.diff(starts)
    none = np.zeros(0, np.int64)
    if n < length or not (size >= length).any():
        return none, np.zeros(0, np.uint64), none, none, none
    at = np.arange(n - k + 1)
    grams = kit.rolling_hash(buf, at, at + k)
    key = (grams & ~_LOW) | (at.astype(np.uint64) & _LOW)
    blocks = -(-len(key) // w)
    grid = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
    grid[: len(key)] = key
    grid = grid.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    many = np.maximum(size - length + 1, 0)
    doc = np.repeat(np.arange(len(size)), many)
    s = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many) + starts[:-1][doc]
    least = np.minimum(back[s], ahead[s + w - 1])
    place = s + ((least - s.astype(np.uint64)) & _LOW).astype(np.int64)
    head = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])]))
    # The smallest hashes are small: mixed again, they spread over all owners.
    return place[head], kit.mix(grams[place[head]]), doc[head], s[head], np.diff(np.append(head, len(s)))


def anchors(length: int):
    def find(buf, starts):
        _, grams, doc, _, _ = choose(buf, starts, length)
        return grams >> np.uint64(64 - PRINT_BITS), np.bincount(doc, minlength=len(starts) - 1)

    return find


# ---------------------------------------------------------------- the transform


def sort_suffixes(text: np.ndarray, length: int) -> np.ndarray:
    """Suffixes in the order of their first `length` symbols (9 bits each); ties in any order.

    Intervals of strings of up to `length` symbols have the same ends whatever
    the order of ties, so the search is not affected.
    """
    n = len(text)
    key = np.zeros(n, np.uint64)
    h = min(7, length)
    padded = np.concatenate([text.astype(np.uint64), np.zeros(h, np.uint64)])
    for j in range(h):
        key |= padded[j : j + n] << np.uint64(9 * (6 - j))
    while True:
        order = np.argsort(key)
        ordered = key[order]
        new = np.concatenate([[False], ordered[1:] != ordered[:-1]])
        if h >= length or new.sum() == n - 1:
            return order
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(new) + 1
        step = min(h, length - h)
        key = rank * np.uint64(n + 2)
        key[: n - step] += rank[step:]
        h += step


def expand(before: np.ndarray, length: int) -> np.ndarray:
    """Which boundaries between neighbouring suffixes have a common prefix below `length`.

    before: the transform. Intervals of one level are disjoint, so a level is
    a few array operations.
    """
    n = len(before)
    step = np.empty(n, np.int64)
    step[np.argsort(before, kind="stable")] = np.arange(n)
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    lo, hi = np.array([0]), np.array([n])
    for _ in range(length):
        one = hi - lo == 1
        single = step[lo[one]]
        lo, hi = lo[~one], hi[~one]
        size = hi - lo
        ident = np.repeat(np.arange(len(lo)), size)
        rows = np.arange(len(ident)) + np.repeat(lo - np.cumsum(size) + size, size)
        key = ident * 512 + before[rows]
        order = np.argsort(key, kind="stable")
        key = key[order]
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        tail = np.append(head[1:], len(key)) - 1 if len(key) else head
        lo = np.concatenate([single, step[rows[order[head]]]])
        hi = np.concatenate([single, step[rows[order[tail]]]]) + 1
        new = ~known[hi]
        lo, hi = lo[new], hi[new]
        known[hi] = True
        if not len(lo):
            break
    return known[:n]


def repeated_starts(segments: list[bytes], weights: np.ndarray, length: int) -> list[np.ndarray]:
    """For each segment, which of its windows occur with a total weight of two or more."""
    size = np.array([len(s) for s in segments])
    text = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8).astype(np.uint16) + 1
    ends = np.cumsum(size + 1) - 1
    text[ends] = 0
    order = sort_suffixes(text, length)
    run = np.cumsum(expand(text[order - 1], length)) - 1
    whose = np.repeat(np.arange(len(size)), size + 1)
    valid = np.arange(len(text)) + length <= ends[whose]
    weight = np.bincount(run, np.where(valid, weights[whose], 0)[order])
    again = np.zeros(len(text), bool)
    again[order] = weight[run] >= 2
    again &= valid
    return [again[e - n : e - n + max(0, n - length + 1)] for e, n in zip(ends, size, strict=True)]


def _split(members: list[int], segments: list[bytes], weights: np.ndarray, places: list[int], length: int, parts: int = 6) -> list[np.ndarray]:
    """A hot anchor's segments, divided by offset range and by the bytes all windows of the range share."""
    span = length - gram_of(length) + 1
    flags = {i: np.zeros(len(segments[i]) - length + 1, bool) for i in members}
    todo: list[dict[bytes, list]] = []
    for a in range(0, span, -(-span // parts)):
        b = min(span, a + -(-span // parts))
        buckets: dict[bytes, dict[bytes, list]] = {}
        for i in members:
            p, s = places[i], segments[i]
            lo, hi = max(0, p - b + 1), min(len(s) - length, p - a)
            if lo > hi:
                continue
            # Windows at [p - b + 1, p - a] all hold the bytes [p - a, p - b + 1 + length).
            buckets.setdefault(s[p - a : p - b + 1 + length], {}).setdefault(s[lo : hi + length], []).append((i, lo))
        todo.extend(buckets.values())
    # Each window start is in one range, so buckets may share a batch: no window counts twice.
    batch: list[tuple[bytes, int, list]] = []
    held = 0

    def flush():
        found = repeated_starts([t for t, _, _ in batch], np.array([w for _, w, _ in batch]), length)
        for (_, _, who), again in zip(batch, found, strict=True):
            for i, lo in who:
                flags[i][lo : lo + len(again)] = again

    for sub in todo:
        rows = [(t, min(2, sum(weights[i] for i, _ in who)), who) for t, who in sub.items()]
        if len(rows) == 1:
            t, w, who = rows[0]
            for i, lo in who:
                flags[i][lo : lo + len(t) - length + 1] = w >= 2
            continue
        batch += rows
        held += sum(len(t) for t, _, _ in rows)
        if held > BATCH:
            flush()
            batch.clear()
            held = 0
    if batch:
        flush()
    return [flags[i] for i in members]


def _answer(length: int):
    """Owner's answer: for each sender the repeated starts of its segments, one bitmap."""

    def answer(payloads: list[bytes]) -> list[bytes]:
        index: dict[tuple[int, bytes], int] = {}
        segments: list[bytes] = []
        weights: list[int] = []
        places: list[int] = []
        groups: dict[int, list[int]] = {}
        sent = []
        for turn, p in enumerate(payloads):
            prints, at, twice, size, blob = pickle.loads(p)
            payloads[turn] = p = None
            mine, end = [], 0
            for x, o, t, n in zip(prints.tolist(), at.tolist(), twice.tolist(), size.tolist(), strict=True):
                s = blob[end : end + n]
                end += n
                i = index.get((x, s))
                if i is None:
                    i = index[x, s] = len(segments)
                    segments.append(s)
                    weights.append(0)
                    places.append(o)
                    groups.setdefault(x, []).append(i)
                weights[i] = min(2, weights[i] + 1 + t)
                mine.append(i)
            sent.append(mine)
        index.clear()
        flags: list = [None] * len(segments)
        weight = np.array(weights)
        batch: list[int] = []
        held = 0

        def flush():
            for i, f in zip(batch, repeated_starts([segments[i] for i in batch], weight[batch], length), strict=True):
                flags[i] = f

        for members in groups.values():
            total = sum(len(segments[i]) for i in members)
            if len(members) == 1:
                flags[members[0]] = np.full(len(segments[members[0]]) - length + 1, weight[members[0]] >= 2)
            elif total > SPLIT:
                for i, f in zip(members, _split(members, segments, weight, places, length), strict=True):
                    flags[i] = f
            else:
                if held + total > BATCH and batch:
                    flush()
                    batch, held = [], 0
                batch += members
                held += total
        if batch:
            flush()
        return [np.packbits(np.concatenate([flags[i] for i in mine])).tobytes() for mine in sent]

    return answer


# ---------------------------------------------------------------- the dataflow


def _chunks(length: int, owners: int):
    """Texts to chunks, with the places of their anchors among the chunk's distinct ones, and these for the owners."""
    find = anchors(length)

    def scan(batches):
        chunk = kit.chunk_ids()
        held: list[tuple] = []
        prints: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        size = 0

        def flush():
            seen, back, times = np.unique(np.concatenate(prints), return_inverse=True, return_counts=True)
            cuts = list(kit.by_owner(seen, PRINT_BITS, owners))
            k = next(chunk)
            state = (held, np.concatenate(counts).astype(np.int32), back.astype(np.uint32), np.packbits(times > 1), len(seen), cuts)
            yield kit.routed("state", [-1], k, [kit.pack(state)])
            if cuts:
                yield kit.routed("message", [o for o, _, _ in cuts], k, [kit.rice_encode(seen[a:b]) for _, a, b in cuts])

        for batch in batches:
            ids = kit.ids_of(batch.column("doc_id")).tolist()
            for a, b, buf, starts in kit.texts_of(batch):
                found, many = find(buf, starts)
                prints.append(found)
                counts.append(many)
                data, cuts = buf.tobytes(), starts.tolist()
                held += [(ids[a + i], data[cuts[i] : cuts[i + 1]]) for i in range(b - a)]
                size += len(data)
                if size >= CHUNK_BYTES:
                    yield from flush()
                    for kept in (held, prints, counts):
                        kept.clear()
                    size = 0
        if held:
            yield from flush()

    return scan


def _segments(length: int, owners: int):
    """Chunks with their marked anchors: distinct segments to owners, and the state to apply the answers to."""

    def send(chunk, state, replies):
        held, counts, back, local, n, cuts = state
        marked = np.unpackbits(local, count=n).astype(bool)
        told = {r["owner"]: r["reply"] for r in replies}
        for o, a, b in cuts:
            marked[a:b] |= kit.unmark(told[o], b - a)
        each = marked[back]
        ends = np.cumsum(counts, dtype=np.int64)
        total = np.concatenate([[0], np.cumsum(each)])
        busy = np.flatnonzero(total[ends] > total[ends - counts])
        if not len(busy):
            return
        index: dict[bytes, int] = {}
        prints: list[int] = []
        places: list[int] = []
        twice: list[bool] = []
        segs: list[int] = []
        lows: list[int] = []
        begin = np.cumsum([0, *(len(t) for _, t in held)])
        own = np.cumsum([0, *(len(held[i][1]) for i in busy.tolist())])
        for a, b in kit.slices(own):
            data = b"".join(held[i][1] for i in busy[a:b].tolist())
            place, grams, doc, first, many = choose(np.frombuffer(data, np.uint8), own[a : b + 1] - own[a], length)
            on = np.flatnonzero(np.concatenate([each[ends[i] - counts[i] : ends[i]] for i in busy[a:b].tolist()]))
            # From places among the busy texts of the slice to places in the chunk.
            low = first + begin[busy[a + doc]] - (own[a + doc] - own[a])
            for j in on.tolist():
                s, m = int(first[j]), int(many[j])
                k = index.setdefault(data[s : s + m + length - 1], len(index))
                if k == len(prints):
                    prints.append(int(grams[j]) >> (64 - PRINT_BITS))
                    places.append(int(place[j]) - s)
                    twice.append(False)
                else:
                    twice[k] = True
                segs.append(k)
                lows.append(int(low[j]))
        order = np.argsort(np.array(prints, np.uint64), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        keys = np.array(prints, np.uint64)[order]
        segments = list(index)
        size = np.array([len(segments[i]) for i in order], np.int32)
        cuts = list(kit.by_owner(keys, PRINT_BITS, owners))
        yield kit.routed("state", [-1], chunk, [kit.pack((begin, rank[segs], np.array(lows), size - length + 1, cuts))])
        at, two = np.array(places, np.int32)[order], np.array(twice, np.int8)[order]
        for o, a, b in cuts:
            payload = kit.pack((keys[a:b], at[a:b], two[a:b], size[a:b], b"".join(segments[i] for i in order[a:b])))
            yield kit.routed("message", [o], chunk, [payload])

    def scan(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, payload, replies = (batch.column(c)[i].as_py() for c in ("chunk", "payload", "replies"))
                yield from send(chunk, kit.unpack(payload), replies)

    return scan


def _verdicts(length: int):
    """The spans that go from each chunk, as places in its joined texts; no row where nothing goes."""

    def judge(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, payload, replies = (batch.column(c)[i].as_py() for c in ("chunk", "payload", "replies"))
                begin, ranks, lows, many, cuts = kit.unpack(payload)
                told = {r["owner"]: r["reply"] for r in replies}
                ends = np.cumsum(many, dtype=np.int64)
                again = np.concatenate([kit.unmark(told[o], int(ends[b - 1] - ends[a] + many[a])) for o, a, b in cuts])
                cover = np.zeros(begin[-1] + 1, np.int32)
                for k, lo in zip(ranks.tolist(), lows.tolist(), strict=True):
                    hit = np.flatnonzero(again[ends[k] - many[k] : ends[k]]) + lo
                    cover[hit] += 1
                    cover[hit + length] -= 1
                edge = np.zeros(begin[-1] + 2, np.int8)
                edge[1:-1] = np.cumsum(cover)[:-1] > 0
                # Spans that touch across two texts are two.
                turns = np.diff(edge)
                inner = begin[(begin > 0) & (begin < begin[-1])]
                inner = np.unique(inner[(edge[inner] > 0) & (edge[inner + 1] > 0)])
                spans = np.sort(np.concatenate([np.flatnonzero(turns > 0), inner])), np.sort(np.concatenate([np.flatnonzero(turns < 0), inner]))
                if len(spans[0]):
                    yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([pickle.dumps(spans)])], ["chunk", "gone"])

    return judge


def _apply(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            held, gone = kit.unpack(batch.column("payload")[i].as_py())[0], batch.column("gone")[i].as_py()
            lo, hi = pickle.loads(gone) if gone else (np.zeros(0, np.int64),) * 2
            begin = np.cumsum([0, *(len(t) for _, t in held)])
            cut = np.searchsorted(lo, begin)
            rows = []
            for (doc_id, text), at, a, b in zip(held, begin[:-1].tolist(), cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                digest, last = hashlib.sha256(), 0
                view = memoryview(text)
                for x, y in zip((lo[a:b] - at).tolist(), (hi[a:b] - at).tolist(), strict=True):
                    digest.update(view[last:x])
                    last = y
                digest.update(view[last:])
                rows.append((doc_id, len(text), int((hi[a:b] - lo[a:b]).sum()), b - a, digest.hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [kit.ids_back(np.array([r[0] for r in rows])), *(pa.array([r[j] for r in rows], t) for j, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.int64()), (4, pa.string())))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )


def suffix_dedup(docs: DataFrame, id_col="doc_id", text_col="text", length: int = LENGTH, owners: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 after removing all repeated bytes."""
    owners = owners or kit.owners_for(docs, text_col, OWNER_BYTES)
    keepers = owners * OWNERS
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    chunks = kit.save_chunks(slim.mapInArrow(kit.lean(_chunks(length, owners)), kit.ROUTED), "suffix-chunks", owners)
    texts = chunks.where("kind = 'state'")
    marks = kit.exchange(chunks.where("kind = 'message'").select("owner", "chunk", "payload"), owners, kit.repeated_marks, "suffix-marks")
    kit.drop_saved(chunks, "message")
    sent = kit.with_told(texts, marks).select("chunk", "payload", "replies").mapInArrow(kit.lean(_segments(length, keepers)), kit.ROUTED)
    segments = kit.save_chunks(sent, "suffix-segments", owners)
    answer = _answer(length)
    repeats = kit.exchange(segments.where("kind = 'message'").select("owner", "chunk", "payload"), keepers, lambda sent: answer([kit.pickled(p) for p in sent]), "suffix-repeats")
    kit.drop_saved(segments, "message")
    kit.drop_saved(marks)
    judged = kit.with_told(segments.where("kind = 'state'"), repeats).select("chunk", "payload", "replies")
    gone = judged.mapInArrow(kit.lean(_verdicts(length)), "chunk long, gone binary")
    return kit.with_told(texts, gone, "left").select("payload", "gone").mapInArrow(kit.lean(_apply), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
