"""N-gram Jaccard join by T-occurrence search with DivideSkip.

Documents link when the Jaccard similarity of their sets of k-word shingles
reaches `percent`. Texts with one set are one class; classes are compared.

1. Global order: hash order, shingles that are frequent in many slices of the
   corpus last (a bounded list; any fixed order gives the same links).
2. Similar sets of sizes s and t share o >= T = ceil(percent * max(s, t)), so
   the prefixes of s - T + l shingles in that order share at least l. A prefix
   is exchanged as compressed fingerprints; its owner marks shingles that
   another class or another sender has too and names the list by the smallest
   label of its classes (pivot). A class with fewer marked shingles than any
   partner would share is out.
3. A class keeps the pivots of its marked shingles but for a few it can spare:
   if each side drops less than half of what it must share, both still meet.
   Whole sets go to their pivots' groups, in blocks of GROUP_SHINGLES by hash.
4. In a block, each set searches the inverted lists: its L longest lists are
   set aside, the short ones are merged, the sets reaching T - L are looked up
   in the long lists by binary search, and those reaching the exact overlap
   link. Sets that are already linked are not compared again.
5. Groups of several blocks: the group's hub (its smallest class) visits every
   block, so a group of near copies falls into one component in one pass. What
   is not in the group's largest component is then searched against the group,
   in pairs of blocks; pairs inside that component need no comparison. Work is
   the group's size times what lies outside its largest component.
6. Links form components (graph.components).

Nothing lists all pairs of a group; only links that join two parts leave a task.
Shingles are named by 64-bit hashes of their words, classes by 128-bit BLAKE2b
digests of their sets; fingerprints and labels only choose what is compared.

Defined results: a text with fewer words than k has its whole sequence as one
shingle; a null or blank text has the empty set and links with nothing; null
ids never name a component unless all its ids are null; rows that share an id
count each by its text; equal sets are one class, however many rows have them;
a very long text makes one set, held whole; an empty table gives no rows; other
columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graph, kit

K, PERCENT = 4, 85
PRINT_BITS = 48
#: Entries of the list of frequent shingles, and what makes one: texts of a slice that have it.
HOT_MAX, HOT_TEXTS = 50_000, 3
#: Shingles of a group (or of a block of a large group); blocks of the second pass hold twice as many.
GROUP_SHINGLES = 1 << 16
#: Bytes of a class's name that name lists; groups that share them are one group.
LABEL_BYTES = 5
#: Bytes of sets in one batch that leaves a task.
SHIP_BYTES = 4 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def sets_of(buf: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending within it, and their offsets."""
    words, first, _, _ = kit.word_hashes(_LOWER[buf], starts)
    n = np.diff(first)
    at, doc = kit.positions(first, k)
    prints = [kit.gram_hashes(words, at, k)]
    doc = [doc]
    for m in range(1, k):
        few = np.flatnonzero(n == m)
        prints.append(kit.gram_hashes(words, first[:-1][few], m))
        doc.append(few)
    prints, doc = np.concatenate(prints), np.concatenate(doc)
    order = np.lexsort((prints, doc))
    prints, doc = prints[order], doc[order]
    new = np.ones(len(prints), bool)
    new[1:] = (prints[1:] != prints[:-1]) | (doc[1:] != doc[:-1])
    prints, doc = prints[new], doc[new]
    return prints, np.searchsorted(doc, np.arange(len(starts)))


def set_names(prints: np.ndarray, off: np.ndarray) -> list[bytes]:
    """The name of each set, 16 bytes; the empty set has none."""
    data, at = prints.tobytes(), (8 * off).tolist()
    return [hashlib.blake2b(data[a:b], digest_size=16).digest() if b > a else b"" for a, b in zip(at, at[1:], strict=False)]


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """What a set of n shares with any similar set, at least."""
    return (percent * n + 99) // 100


def extra(n: np.ndarray, percent: int) -> np.ndarray:
    """The l of the prefix of a set of n shingles; it never falls with n."""
    return np.maximum(1, (100 - percent) * n // 110)


def must_share(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that the prefixes of a set of n and of any similar set share: the l of its smallest partner."""
    return extra(least_overlap(n, percent), percent)


def _labels(names: list[bytes]) -> np.ndarray:
    return np.array([int.from_bytes(x[:LABEL_BYTES], "little") for x in names], np.int64)


def _pack(labels: np.ndarray) -> bytes:
    return np.ascontiguousarray(labels.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :LABEL_BYTES]).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    short = np.frombuffer(data, np.uint8).reshape(-1, LABEL_BYTES)
    out = np.zeros((len(short), 8), np.uint8)
    out[:, :LABEL_BYTES] = short
    return out.view("<i8").ravel().astype(np.int64)


def _fresh(names: list[bytes], seen: dict[bytes, int]) -> np.ndarray:
    """Which sets are not empty and not yet in seen, where they are numbered."""
    new = np.zeros(len(names), bool)
    for i, x in enumerate(names):
        if x and x not in seen:
            seen[x] = len(seen)
            new[i] = True
    return new


def _survey(k: int):
    """Size and name of each text's set, and shingles that many texts of a slice have."""

    def survey(batches):
        for batch in batches:
            for a, b, buf, starts in kit.texts_of(batch):
                prints, off = sets_of(buf, starts, k)
                name = set_names(prints, off)
                m = b - a
                part = batch.slice(a, m)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(["set"] * m), part.column("doc_id"), part.column("thash"), pa.array(np.diff(off), pa.int64()), pa.array(name, pa.binary())],
                    ["kind", "doc_id", "thash", "n", "cls"],
                )
                fresh = _fresh(name, {})
                p, times = np.unique(prints[np.repeat(fresh, np.diff(off))], return_counts=True)
                hot = times >= HOT_TEXTS
                h = int(hot.sum())
                if h:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(["hot"] * h), pa.nulls(h, pa.int64()), pa.array(p[hot].view(np.int64)), pa.array(times[hot], pa.int64()), pa.nulls(h, pa.binary())],
                        ["kind", "doc_id", "thash", "n", "cls"],
                    )

    return survey


def _prefixes(k: int, percent: int, hot: np.ndarray, owners: int):
    """Prefixes of the sets to messages, with the state to use the answers."""

    def scan(batches):
        chunk = kit.chunk_ids()
        index: dict[bytes, int] = {}
        held: list[tuple] = []
        n = 0

        def flush():
            names = list(index)
            sizes, counts, prints = (np.concatenate(x) for x in zip(*held, strict=True))
            whose = np.repeat(np.arange(len(names)), counts)
            label = _labels(names)
            seen, back = np.unique(prints, return_inverse=True)
            low, high = np.full(len(seen), len(names)), np.zeros(len(seen), np.int64)
            least = np.full(len(seen), np.iinfo(np.int64).max)
            np.minimum.at(low, back, whose)
            np.maximum.at(high, back, whose)
            np.minimum.at(least, back, label[whose])
            cuts = list(kit.by_owner(seen, PRINT_BITS, owners))
            c = next(chunk)
            yield kit.routed("state", [-1], c, [pickle.dumps((names, sizes, counts, back.astype(np.uint32), cuts))])
            yield kit.routed(
                "message", [o for o, _, _ in cuts], c,
                [pickle.dumps((kit.rice_encode(seen[a:b]), _pack(least[a:b]), np.flatnonzero(high[a:b] > low[a:b]).astype(np.uint32))) for _, a, b in cuts],
            )

        for batch in batches:
            for _, _, buf, starts in kit.texts_of(batch):
                prints, off = sets_of(buf, starts, k)
                size = np.diff(off)
                fresh = _fresh(set_names(prints, off), index)
                if not fresh.any():
                    continue
                take = size - least_overlap(size, percent) + extra(size, percent)
                doc = np.repeat(np.arange(len(size)), size)
                at = np.minimum(np.searchsorted(hot, prints), max(len(hot) - 1, 0))
                common = hot[at] == prints if len(hot) else np.zeros(len(prints), bool)
                order = np.lexsort((prints, common, doc))
                rank = np.arange(len(prints)) - off[:-1][doc]
                keep = (rank < take[doc]) & fresh[doc]
                # Prefixes hold the smallest hashes: mixed again, they spread over all owners.
                part = kit.mix(prints[order][keep]) >> np.uint64(64 - PRINT_BITS)
                held.append((size[fresh], np.bincount(doc[keep], minlength=len(size))[fresh], part))
                n += len(part)
                if n >= kit.CHUNK_ANCHORS:
                    yield from flush()
                    index.clear()
                    held.clear()
                    n = 0
        if n:
            yield from flush()

    return scan


def _pivots(payloads: list[bytes]) -> list[bytes]:
    """Owner's answer: which shingles two classes or two senders have, and the smallest label of each such list.

    Two senders may hold one class; labels are too short to tell, so both are marked and the class meets only itself.
    """
    prints, low, many = [], [], []
    for p in payloads:
        a, b, c = pickle.loads(p)
        prints.append(kit.rice_decode(a))
        low.append(_unpack(b))
        flag = np.zeros(len(low[-1]), bool)
        flag[c] = True
        many.append(flag)
    sizes = [len(p) for p in prints]
    prints, low, many = np.concatenate(prints), np.concatenate(low), np.concatenate(many)
    order = np.argsort(prints, kind="stable")
    head = np.ones(len(order), bool)
    head[1:] = prints[order][1:] != prints[order][:-1]
    lead = np.flatnonzero(head)
    pivot = np.minimum.reduceat(low[order], lead)
    marked = (np.diff(np.append(lead, len(order))) > 1) | np.logical_or.reduceat(many[order], lead)
    run = np.empty(len(order), np.int64)
    run[order] = np.cumsum(head) - 1
    out, at = [], 0
    for n in sizes:
        r = run[at : at + n]
        names, which = np.unique(pivot[r][marked[r]], return_inverse=True)
        out.append(pickle.dumps((np.packbits(marked[r]), _pack(names), which.astype(np.uint16 if len(names) < 1 << 16 else np.uint32))))
        at += n
    return out


def _members(percent: int):
    """(pivot, class, size) rows of the classes that may have a partner."""

    def receive(batches):
        for batch in batches:
            for payload, replies in zip(batch.column("payload").to_pylist(), batch.column("replies").to_pylist(), strict=True):
                names, sizes, counts, back, cuts = pickle.loads(payload)
                total = cuts[-1][2]
                marked, pivot = np.zeros(total, bool), np.zeros(total, np.int64)
                told = {r["owner"]: r["reply"] for r in replies}
                for o, a, b in cuts:
                    bits, low, which = pickle.loads(told[o])
                    here = np.unpackbits(bits, count=b - a).astype(bool)
                    marked[a:b] = here
                    pivot[np.flatnonzero(here) + a] = _unpack(low)[which]
                doc = np.repeat(np.arange(len(names)), counts)
                use = marked[back]
                need = must_share(sizes, percent)
                enough = np.bincount(doc[use], minlength=len(names)) >= need
                use &= enough[doc]
                doc, at = doc[use], pivot[back[use]]
                order = np.lexsort((at, doc))
                doc, at = doc[order], at[order]
                head = np.ones(len(doc), bool)
                head[1:] = (doc[1:] != doc[:-1]) | (at[1:] != at[:-1])
                lead = np.flatnonzero(head)
                times = np.diff(np.append(lead, len(doc)))
                doc, at = doc[lead], at[lead]
                # Rarest pivots first: they may go while fewer than half of the shared shingles go with them.
                order = np.lexsort((times, doc))
                doc, at, times = doc[order], at[order], times[order]
                run = np.cumsum(times)
                start = np.searchsorted(doc, doc)
                gone = run - np.where(start > 0, run[start - 1], 0)
                keep = gone > (need[doc] - 1) // 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at[keep]), pa.array([names[i] for i in doc[keep].tolist()], pa.binary()), pa.array(sizes[doc[keep]], pa.int64())], ["pivot", "cls", "n"]
                )

    return receive


class Forest:
    """Union-find over a group's sets."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, i: np.ndarray) -> np.ndarray:
        r = self.up[i]
        while True:
            s = self.up[r]
            if (s == r).all():
                return r
            r = s

    def join(self, a: int, b: int) -> bool:
        a, b = self.roots(np.array([a, b]))
        self.up[max(a, b)] = min(a, b)
        return a != b


def divide_skip(sets: list[np.ndarray], side: np.ndarray | None, percent: int, mu: float = 0.01, part: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join two parts of a group of sets.

    side: with it, only pairs on different sides are compared; part: with it, sets of one part are linked already.
    """
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    sets, size = [sets[i] for i in order], size[order]
    side = side[order] if side is not None else None
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    by = np.lexsort((owner, tokens))
    posts, ordered = owner[by], tokens[by]
    head = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    stop = np.append(head[1:], len(ordered))
    keys = ordered[head]
    forest, links = Forest(len(sets)), []
    if part is not None:
        _, lead, which = np.unique(part[order], return_index=True, return_inverse=True)
        forest.up = lead[which]
    for x in range(1, len(sets)):
        lists = np.searchsorted(keys, sets[x])
        length = stop[lists] - head[lists]
        need = -(-percent * size[x] // 100)
        lists, length = lists[length > 1], length[length > 1]
        if len(lists) < need:
            continue
        down = np.argsort(-length, kind="stable")
        longest = max(2, int(length[down[0]]))
        skip = min(need - 1, int(need / (mu * np.log2(longest) + 1)))
        long, short = lists[down[:skip]], lists[down[skip:]]
        # The stable sort finds the lists as sorted runs and merges them, as a heap would; its cost is theirs alone.
        merged = np.sort(np.concatenate([posts[head[i] : stop[i]] for i in short]), kind="stable")
        merged = merged[: np.searchsorted(merged, x)]
        run = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]])) if len(merged) else merged
        count = np.diff(np.append(run, len(merged)))
        enough = count >= need - skip
        found, count = merged[run[enough]], count[enough]
        keep = size[found] * 100 >= percent * size[x]
        if side is not None:
            keep &= side[found] != side[x]
        if keep.any():
            keep &= forest.roots(found) != forest.roots(np.array([x]))[0]
        found, have = found[keep], count[keep]
        if not len(found):
            continue
        for done, i in enumerate(long):
            alive = have + (skip - done) >= need
            if not alive.all():
                found, have = found[alive], have[alive]
                if not len(found):
                    break
            one = posts[head[i] : stop[i]]
            at = np.minimum(np.searchsorted(one, found), len(one) - 1)
            have = have + (one[at] == found)
        ok = 100 * have >= percent * (size[found] + size[x] - have)
        links += [(int(order[x]), int(order[y])) for y in found[ok] if forest.join(x, int(y))]
    return links


def _search(percent: int):
    def search(keys, table):
        names = table.column("cls").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        block, probe = keys[1].as_py(), keys[2].as_py()
        across = probe >= 0
        links = []
        if len(sets) > 1:
            side, part = table.column("side").to_numpy(), np.array(table.column("part").to_pylist(), object)
            links = divide_skip(sets, None if block == -1 - probe else side, percent, part=part) if across else divide_skip(sets, None, percent)
        return pa.table({"a": pa.array([names[i] for i, _ in links], pa.binary()), "b": pa.array([names[j] for _, j in links], pa.binary())})

    return search


GROUPS = "array<struct<pivot:long,block:int,blocks:int,hub:boolean,probe:int,probes:int,part:binary>>"
SHIPPED = "pivot long, block int, probe int, side int, part binary, cls binary, shingles binary"
_SHIPPED = [("pivot", pa.int64()), ("block", pa.int32()), ("probe", pa.int32()), ("side", pa.int32()), ("part", pa.binary()), ("cls", pa.binary()), ("shingles", pa.binary())]


def _targets(g: dict):
    """(block, probe, side) of the tasks that a member's set goes to.

    First pass (no probes): its own block, with probe -1; the hub goes to all.
    Second pass: blocks of the largest component meet blocks of the rest
    (probes); blocks of the rest meet each other as (-1 - lower, higher).
    """
    if g["probes"] == 0:
        yield from ((b, -1, 0) for b in (range(g["blocks"]) if g["hub"] else (g["block"],)))
    elif g["probe"] < 0:
        yield from ((g["block"], p, 0) for p in range(g["probes"]))
    else:
        mine = g["probe"]
        yield from ((b, mine, 1) for b in range(g["blocks"]))
        yield from ((-1 - min(mine, p), max(mine, p), int(mine > p)) for p in range(g["probes"]))


def _ship(k: int):
    """Whole sets of the members, a row for each of their tasks; batches are cut by bytes."""

    def ship(batches):
        sent: set[bytes] = set()
        cols: list[list] = [[] for _ in _SHIPPED]
        held = 0
        for batch in batches:
            groups = batch.column("groups").to_pylist()
            for a, b, buf, starts in kit.texts_of(batch):
                prints, off = sets_of(buf, starts, k)
                for i, name in enumerate(set_names(prints, off)):
                    if name in sent:  # a copy of the row
                        continue
                    sent.add(name)
                    blob = prints[off[i] : off[i + 1]].tobytes()
                    for g in groups[a + i]:
                        for block, probe, side in _targets(g):
                            for c, v in zip(cols, (g["pivot"], block, probe, side, g["part"], name, blob), strict=True):
                                c.append(v)
                            held += len(blob) + 64
                            if held >= SHIP_BYTES:
                                yield kit.emit(_SHIPPED, *cols)
                                cols, held = [[] for _ in _SHIPPED], 0
        if held:
            yield kit.emit(_SHIPPED, *cols)

    return ship


def _links(slim: DataFrame, sets: DataFrame, member: DataFrame, k: int, percent: int) -> DataFrame:
    """Links found in the tasks of member (cls, g), saved. A class is in a handful of groups, so its list is short."""
    listed = member.groupBy("cls").agg(F.collect_list("g").alias("groups"))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "thash")
    one = sets.where("n > 0").groupBy("cls").agg(F.min(first).alias("one")).select("cls", "one.doc_id", "one.thash")
    wanted = kit.save(listed.join(one, "cls").select(F.col("doc_id").alias("m_id"), F.col("thash").alias("m_hash"), F.col("groups").cast(GROUPS)), "jaccard-wanted")
    on = F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("thash") == F.col("m_hash"))
    held = kit.join_small(slim, wanted, on, "inner").select("text", "groups")
    found = held.mapInArrow(kit.lean(_ship(k)), SHIPPED).groupBy("pivot", "block", "probe").applyInArrow(_search(percent), "a binary, b binary")
    out = kit.save(found.where("a <> b").distinct(), "jaccard-links")
    kit.drop_saved(wanted)
    return out


def jaccard_classes(docs: DataFrame, id_col="doc_id", text_col="text", k: int = K, percent: int = PERCENT, owners: int | None = None, group_shingles: int = GROUP_SHINGLES) -> tuple[DataFrame, DataFrame]:
    """(doc_id, thash, n, cls) of every row, and (node, root) of the classes that have links."""
    spark = docs.sparkSession
    owners = owners or kit.parts(spark)
    slim = kit.keyed(docs, id_col, text_col)
    rows = kit.save(slim.mapInArrow(kit.lean(_survey(k)), "kind string, doc_id long, thash long, n long, cls binary"), "jaccard-sets", by="kind")
    sets = rows.where("kind = 'set'").select("doc_id", "thash", "n", "cls")
    frequent = rows.where("kind = 'hot'").groupBy("thash").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "thash").limit(HOT_MAX)
    hot = np.sort(np.array([r.thash for r in frequent.collect()], np.int64).view(np.uint64))
    chunks = kit.save(slim.select("text").mapInArrow(kit.lean(_prefixes(k, percent, hot, owners)), kit.ROUTED), "jaccard-prefixes", by="kind")
    replies = kit.exchange(chunks.where("kind = 'message'").select("owner", "chunk", "payload"), owners, _pivots, "jaccard-pivots")
    states = chunks.where("kind = 'state'").select("chunk", "payload")
    members = kit.save(kit.join_replies(states, replies).mapInArrow(kit.lean(_members(percent)), "pivot long, cls binary, n long").distinct(), "jaccard-members")
    kit.drop_saved(chunks)
    kit.drop_saved(replies)
    groups = members.groupBy("pivot").agg(F.count("*").alias("m"), F.sum("n").alias("total"), F.min("cls").alias("hub")).where("m > 1")
    groups = kit.save(groups.select("pivot", "hub", F.ceil(F.col("total") / group_shingles).cast("int").alias("blocks")), "jaccard-groups")
    within = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")
    none, zero = F.lit(-1), F.lit(0)
    member = members.join(groups, "pivot").select(
        "pivot", "cls", "n", F.struct("pivot", within("blocks").alias("block"), "blocks", (F.col("cls") == F.col("hub")).alias("hub"), none.alias("probe"), zero.alias("probes"), F.lit(None).cast("binary").alias("part")).alias("g")
    )
    links = _links(slim, sets, member, k, percent)
    roots = kit.save(graph.components(links), "jaccard-roots")
    # Groups of several blocks: what lies outside the largest component still has to meet the rest.
    large = member.where("g.blocks > 1").join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    large = kit.save(large, "jaccard-large")
    top = large.groupBy("pivot", "root").agg(F.sum("n").alias("t")).groupBy("pivot").agg(F.max(F.struct("t", "root")).alias("top"), F.sum("t").alias("all"))
    many = lambda c: F.ceil(c / (2 * group_shingles)).cast("int")
    open_ = top.select("pivot", F.col("top.root").alias("top"), many(F.col("top.t")).alias("blocks"), many(F.col("all") - F.col("top.t")).alias("probes")).where("probes > 0")
    rest = F.col("root") != F.col("top")
    again = large.join(open_, "pivot").select(
        "cls",
        F.struct("pivot", F.when(~rest, within("blocks")).otherwise(none).alias("block"), "blocks", F.lit(False).alias("hub"),
                 F.when(rest, within("probes")).otherwise(none).alias("probe"), "probes", F.col("root").alias("part")).alias("g"),
    )
    if open_.take(1):
        more = _links(slim, sets, again, k, percent)
        roots = kit.save(graph.components(links.unionByName(more)), "jaccard-roots")
    return sets, roots


def _components(docs: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    sets, root = jaccard_classes(docs, id_col, text_col, **options)
    full = kit.join_small(sets, root.withColumnRenamed("node", "cls"), "cls", "left")
    full = full.select("doc_id", "thash", "n", F.when(F.col("n") > 0, F.coalesce("root", "cls")).alias("root"))
    full = kit.save(full, "jaccard-full")
    least = full.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"), F.count("*").alias("m")).where("m > 1").drop("m")
    least = kit.save(least, "jaccard-least")
    return kit.join_small(full, least, "root", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"), "thash")


def jaccard_components(docs: DataFrame, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    return _components(docs, id_col, text_col, **options).drop("thash")


def jaccard_dedup(docs: DataFrame, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """The rows of docs that stay: of each component, the document with the smallest id."""
    return kit.without(docs, _components(docs, id_col, text_col, **options).where("not doc_id <=> component_id"), id_col, text_col)
