"""Phrase collocation mining by word-id suffix arrays.

1. Tasks split texts into pieces and words and gather up to CHUNK_WORDS words:
   a shard. Its (language, word) pairs are numbered; numpy prefix doubling sorts
   the suffixes of the number sequence up to the phrase length, and runs of a
   common prefix (LCP intervals) are the shard's n-gram counts.
2. Counts are summed length by length by owners. Words go as text; an owner
   numbers those that reach `min_count` over all shards, and tells each shard
   the numbers of its own. A phrase that occurs `min_count` times has inner
   phrases that do so too, so a longer one goes as a number made of its first
   words' number and its last word's, if its own first and last part have
   passed. The numbers are exact (a bijection deals them over the owners, no
   fingerprint); sorted, they are sent as Golomb codes of their gaps.
3. Of the shards that hold a phrase the owner tells one its total. That shard
   emits it as text, so text leaves a shard once a phrase of the table, and a
   hot phrase is one number a shard.
4. Cuts, scores, containment and ranks are DataFrame joins over these counts.
   Products are decimals of 38 digits. The first `top` of a language are taken
   in slices by hash first, so a hot language is not sorted in one task.

Shards live in the shared folder, in buckets of the tasks that made them, and
are not shuffled; a lost executor repeats tasks only. Memory follows CHUNK_WORDS
or the longest text, and an owner's share of the numbers.

Defined results: a null text is empty; a null language is ``und``, one with
that name; ids are not read, repeated rows count each; a very long text counts
whole; ties are broken by count and phrase, so ranks are unique; a language
without candidates and an empty table give no rows; other columns may have any
names.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kit

MAX_WORDS, MIN_COUNT, CONTAINED, TOP = 3, 10, 50, 2000
CHUNK_WORDS = 1 << 19
#: Bits of the fingerprints that deal words over owners; words are compared as text.
PRINT_BITS = 32
#: Text bytes whose phrases one owner takes.
OWNER_BYTES = 1 << 25
#: Ends of pieces, and what parts words besides.
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
GRAMS = "lang string, size int, phrase string, n long"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_END = np.isin(np.arange(256), list(PIECE_ENDS))
_SOLID = ~_END & ~np.isin(np.arange(256), list(BLANKS))


def suffix_array(ids: np.ndarray, piece: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first `words` numbers (within their piece), and how many of these each shares with the one before.

    Prefix doubling: ranks of 1, 2, 4 ... numbers; ranks of a suffix that ends
    earlier are smaller. piece: the piece of each position.
    """
    n = len(ids)
    last = left_in_piece(piece)
    # Numbers below n serve as ranks as they are.
    dense = n and ids.min() >= 0 and ids.max() < n
    ranks, span, order = [((ids if dense else np.unique(ids, return_inverse=True)[1]) + 1).astype(np.int32)], 1, None
    while span < words:
        key = ranks[-1].astype(np.int64)
        key *= n + 1
        np.add(key[: n - span], ranks[-1][span:], out=key[: n - span], where=last[: n - span] > span) if span < n else None
        order = np.argsort(key, kind="stable" if 2 * span >= words else None)
        key = key[order]
        rank = np.empty(n, np.int32)
        rank[order] = np.cumsum(np.append(True, key[1:] != key[:-1])[:n], dtype=np.int32)
        del key
        ranks.append(rank)
        span *= 2
    order = (np.argsort(ranks[-1], kind="stable") if order is None else order).astype(np.int32)
    # A shared prefix of k numbers: compare it by runs of powers of two, from the left.
    a, b = order[:-1], order[1:]
    lcp = np.zeros(max(n - 1, 0), np.int32)
    for level in range(len(ranks) - 1, -1, -1):
        left = np.minimum(last[a], last[b]) - lcp
        step = np.flatnonzero((left >= 1 << level) & (lcp + (1 << level) <= words))
        same = step[ranks[level][a[step] + lcp[step]] == ranks[level][b[step] + lcp[step]]]
        lcp[same] += 1 << level
    return order, np.append(np.int32(0), lcp) if n else lcp


def left_in_piece(piece: np.ndarray) -> np.ndarray:
    """Words from each position to the end of its piece."""
    ends = np.append(np.flatnonzero(piece[1:] != piece[:-1]), len(piece) - 1) if len(piece) else np.zeros(0, np.int64)
    return (np.repeat(ends + 1, np.diff(ends, prepend=-1)) - np.arange(len(piece))).astype(np.int32)


def intervals(order: np.ndarray, lcp: np.ndarray, last: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A position and the count of each run of suffixes that share `size` numbers."""
    whole = np.flatnonzero(last[order] >= size)
    if not len(whole):
        return whole, whole
    # Suffixes too short for `size` stand before or between runs, and lcp < size there.
    fresh = np.flatnonzero(np.append(lcp[whole] < size, True))
    return order[whole[fresh[:-1]]], np.diff(fresh)


def shard_words(buf: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of the texts, lower-cased, the text of each and a number of its piece that grows."""
    buf = _LOWER[buf]
    s, e, first = kit.word_bounds(buf, starts, _SOLID)
    ends = np.flatnonzero(_END[buf])
    text = np.repeat(np.arange(len(starts) - 1), np.diff(first))
    piece = np.searchsorted(ends, s) + text
    inner = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(_SOLID[buf], out=inner[1:])
    # In order, so the solid bytes are the words one after another.
    offsets = np.append(inner[s], inner[-1]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_string(), len(s), [None, pa.py_buffer(offsets), pa.py_buffer(buf[_SOLID[buf]].tobytes())])
    return words, text, piece


class Shard:
    """Up to CHUNK_WORDS words as numbers of (language, word) pairs in pieces."""

    def __init__(self, words: pa.Array, lang: pa.Array, piece: np.ndarray):
        words, lang = words.dictionary_encode(), lang.dictionary_encode()
        pair = lang.indices.to_numpy().astype(np.int64) * len(words.dictionary) + words.indices.to_numpy()
        pairs, ids = np.unique(pair, return_inverse=True)
        self.ids, self.piece = ids.astype(np.int32), piece
        self.words = words.dictionary.take(pa.array(pairs % max(1, len(words.dictionary))))
        self.langs, self.lang = lang.dictionary, (pairs // max(1, len(words.dictionary))).astype(np.int32)

    def pack(self) -> bytes:
        return kit.pack((self.ids.astype(np.uint32), np.diff(self.piece, prepend=0).astype(np.uint32), " ".join(self.words.to_pylist()), self.langs.to_pylist(), self.lang))

    @classmethod
    def unpack(cls, blob: bytes) -> Shard:
        self = cls.__new__(cls)
        ids, steps, words, langs, self.lang = kit.unpack(blob)
        self.ids, self.piece = ids.astype(np.int32), np.cumsum(steps, dtype=np.int64)
        # No word holds a blank.
        self.words, self.langs = pa.array(words.split(" "), pa.large_string()), pa.array(langs, pa.string())
        return self

    def suffixes(self, words: int) -> None:
        self.order, self.lcp = suffix_array(self.ids, self.piece, words)
        self.last = left_in_piece(self.piece)

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        return intervals(self.order, self.lcp, self.last, size)

    def prints(self) -> np.ndarray:
        """Fingerprint of each (language, word)."""
        off = np.frombuffer(self.words.buffers()[1], np.int64)[self.words.offset :][: len(self.words) + 1]
        data = self.words.buffers()[2]
        buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        lang = np.array([zlib.crc32(x.encode()) for x in self.langs.to_pylist()], np.uint64)
        return kit.mix(kit.bytes_hash(buf, off[:-1], off[1:]) ^ kit.mix(lang)[self.lang])

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        columns = [self.words.take(pa.array(self.ids[at + k])) for k in range(size)]
        return columns[0] if size == 1 else pc.binary_join_element_wise(*columns, pa.scalar(" ", pa.large_string()))


def _scatter(keys: np.ndarray, bits: int) -> np.ndarray:
    """A bijection of the numbers of `bits` bits that deals them evenly over their range."""
    mask, half = np.uint64((1 << bits) - 1), np.uint64(bits // 2)
    for odd in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9):
        keys = keys * np.uint64(odd) & mask
        keys ^= keys >> half
    return keys


def _judge(keys: np.ndarray, counts: list[np.ndarray], min_count: int) -> list[bytes]:
    """For each sender: the largest rank of all, which of its keys reach min_count, their ranks, which it is the first to send, and the totals of these."""
    seen, start, back = np.unique(keys, return_index=True, return_inverse=True)
    total = np.bincount(back, np.concatenate(counts), len(seen)).astype(np.int64)
    rank = np.cumsum(total >= min_count) - 1
    first = np.zeros(len(keys), bool)
    first[start] = True
    top, at, out = int(rank[-1]) + 1 if len(rank) else 0, 0, []
    for part in counts:
        mine, mark = back[at : at + len(part)], first[at : at + len(part)]
        many = total[mine] >= min_count
        mine, mark = mine[many], mark[many]
        ranks = rank[mine]
        coded = kit.rice_encode(ranks.astype(np.uint64)) if (np.diff(ranks) > 0).all() else ranks.astype(np.uint32)
        out.append(top.to_bytes(8, "big") + kit.pack((np.packbits(many).tobytes(), coded, np.packbits(mark).tobytes(), total[mine][mark].tobytes())))
        at += len(part)
    return out


def _sum_words(min_count: int):
    def answer(payloads: list[bytes]) -> list[bytes]:
        words, langs, counts, known = [], [], [], {}
        for names, lang, text, n in map(kit.unpack, payloads):
            langs.append(np.array([known.setdefault(x, len(known)) for x in names], np.int64)[lang])
            words.append(pa.array(text.split(" "), pa.large_string()))
            counts.append(np.frombuffer(n, np.uint32))
        words = pa.concat_arrays(words).dictionary_encode()
        return _judge(np.concatenate(langs) * len(words.dictionary) + words.indices.to_numpy(), counts, min_count)

    return answer


def _sum_numbers(min_count: int):
    def answer(payloads: list[bytes]) -> list[bytes]:
        parts = [kit.unpack(p) for p in payloads]
        return _judge(np.concatenate([kit.rice_decode(p) for p, _ in parts]), [np.frombuffer(n, np.uint32) for _, n in parts], min_count)

    return answer


def _told(reply: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of n keys sent: which passed, their ranks, which of these the sender emits, and their totals."""
    many, ranks, mark, totals = kit.unpack(reply[8:])
    many = kit.unmark(many, n)
    ranks = kit.rice_decode(ranks) if isinstance(ranks, bytes) else ranks
    return many, ranks.astype(np.int64), kit.unmark(mark, len(ranks)), np.frombuffer(totals, np.int64)


def _largest(replies: DataFrame) -> int:
    """Ranks of the owner that has most."""
    heads = replies.select(F.explode("replies.reply").alias("reply")).select(F.conv(F.hex(F.substring("reply", 1, 8)), 16, 10).cast("long").alias("top"))
    return heads.agg(F.max("top")).first()[0] or 0


class Numbers:
    """A shard's phrases as numbers, length by length, as far as owners have told them."""

    def __init__(self, shard: Shard, owners: int, bits: list[int]):
        self.shard, self.owners, self.bits = shard, owners, bits

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """(language, word) pairs in order of their owners, and the fingerprints that deal them."""
        prints = self.shard.prints() >> np.uint64(64 - PRINT_BITS)
        order = np.argsort(prints, kind="stable")
        return order, prints[order]

    def keys(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Phrases whose first and last part passed, as places in grams(size), in order of their numbers, and these; needs held of size - 1."""
        at, _ = self.shard.grams(size)
        ok = np.flatnonzero((self.held[at] >= 0) & (self.held[at + 1] >= 0))
        at = at[ok]
        keys = _scatter(self.held[at].astype(np.uint64) << np.uint64(self.bits[0]) | self.word[self.shard.ids[at + size - 1]].astype(np.uint64), self.width(size))
        order = np.argsort(keys)
        return ok[order], keys[order]

    def width(self, size: int) -> int:
        return max(24, self.bits[size - 2] + self.bits[0])

    def take(self, size: int, replies: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Take in what owners told of a length; a position and the total of each phrase that this shard is to emit."""
        order, keys = self.words() if size == 1 else self.keys(size)
        at, n = (np.arange(len(self.shard.words)), None) if size == 1 else self.shard.grams(size)
        number, mine, totals = np.full(len(at), -1, np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for o, a, b in kit.by_owner(keys, PRINT_BITS if size == 1 else self.width(size), self.owners):
            many, ranks, mark, total = _told(replies[o], b - a)
            passed = order[a:b][many]
            number[passed] = ranks * self.owners + o
            mine.append(passed[mark])
            totals.append(total)
        # Of each position the number of the phrase that starts there.
        self.held = np.full(len(self.shard.ids) + 1, -1, np.int64)
        if size == 1:
            self.word = number
            self.held[:-1] = number[self.shard.ids]
        else:
            self.held[self.shard.order[self.shard.last[self.shard.order] >= size]] = np.repeat(number, n)
        return at[np.concatenate(mine)], np.concatenate(totals)


def count_phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
    owners: int | None = None, chunk_words: int = CHUNK_WORDS,
) -> DataFrame:
    """lang, size, phrase, n: occurrences of all phrases of up to max_words words that reach min_count; size 0 holds all word occurrences."""
    if min_count < 1:
        raise ValueError("min_count must be at least 1")
    spark = docs.sparkSession
    slim = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    owners = owners or max(kit.parts(spark), size // OWNER_BYTES)

    def scan(batches):
        chunk, held, n = kit.chunk_ids(), [], 0

        def flush():
            at = np.cumsum([0, *(int(p[-1]) + 1 if len(p) else 0 for _, _, p in held)])
            words, langs, pieces = pa.concat_arrays([w for w, _, _ in held]), pa.concat_arrays([x for _, x, _ in held]), np.concatenate([p + a for (_, _, p), a in zip(held, at, strict=False)])
            # Words live on as numbers only.
            held.clear()
            shard = Shard(words, langs, pieces)
            del words, langs, pieces
            k = next(chunk)
            yield kit.routed("state", [-1], k, [shard.pack()])
            order, prints = Numbers(shard, owners, []).words()
            counts, names = np.bincount(shard.ids, minlength=len(shard.words)).astype(np.uint32), shard.langs.to_pylist()
            cuts = list(kit.by_owner(prints, PRINT_BITS, owners))
            text = shard.words.take(pa.array(order))
            payloads = [kit.pack((names, shard.lang[order[a:b]], " ".join(text[a:b].to_pylist()), counts[order[a:b]].tobytes())) for _, a, b in cuts]
            yield kit.routed("message", [o for o, _, _ in cuts], k, payloads)

        for batch in batches:
            lang = batch.column("lang")
            for a, b, buf, starts in kit.texts_of(batch):
                words, text, piece = shard_words(buf, starts)
                if len(words):
                    held.append((words, lang.slice(a, b - a).take(pa.array(text)), piece))
                    n += len(words)
                if n >= chunk_words:
                    yield from flush()
                    held, n = [], 0
        if n:
            yield from flush()

    def told_shards(batches, bits, size):
        """Each chunk, its shard sorted up to `size` words, its numbers, and replies by length and owner."""
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard.unpack(batch.column("payload")[i].as_py())
                shard.suffixes(size)
                replies = {t["size"]: {r["owner"]: r["reply"] for r in t["replies"]} for t in batch.column("told")[i].as_py()}
                yield batch.column("chunk")[i].as_py(), shard, Numbers(shard, owners, bits), replies

    def send(bits, size):
        """Numbers of the phrases of `size` words with their counts, to their owners."""

        def run(batches):
            for chunk, shard, numbers, replies in told_shards(batches, bits, size):
                for k in range(1, size):
                    numbers.take(k, replies.get(k, {}))
                order, keys = numbers.keys(size)
                n = shard.grams(size)[1][order].astype(np.uint32)
                cuts = list(kit.by_owner(keys, numbers.width(size), owners))
                yield kit.routed("message", [o for o, _, _ in cuts], chunk, [kit.pack((kit.rice_encode(keys[a:b]), n[a:b].tobytes())) for _, a, b in cuts])

        return run

    def receive(bits):
        def run(batches):
            for _, shard, numbers, replies in told_shards(batches, bits, max_words):
                langs = shard.langs
                total = np.bincount(shard.lang[shard.ids], minlength=len(langs))
                yield pa.RecordBatch.from_arrays([langs, pa.array(np.zeros(len(langs)), pa.int32()), pa.array([""] * len(langs)), pa.array(total, pa.int64())], ["lang", "size", "phrase", "n"])
                for size in range(1, max_words + 1):
                    at, n = numbers.take(size, replies.get(size, {}))
                    for j in range(0, len(at), 1 << 16):
                        x, m = at[j : j + (1 << 16)], n[j : j + (1 << 16)]
                        pair, text = (x, shard.words.take(pa.array(x))) if size == 1 else (shard.ids[x], shard.phrases(x, size))
                        yield pa.RecordBatch.from_arrays(
                            [langs.take(pa.array(shard.lang[pair])), pa.array(np.full(len(x), size), pa.int32()), text.cast(pa.string()), pa.array(m, pa.int64())], ["lang", "size", "phrase", "n"]
                        )

        return run

    rows = kit.save_chunks(slim.mapInArrow(kit.lean(scan), kit.ROUTED), "shards", owners)
    states = rows.where("kind = 'state'")
    told, bits = [kit.exchange(rows.where("kind = 'message'").select("owner", "chunk", "payload"), owners, _sum_words(min_count), "word-replies")], []
    kit.drop_saved(rows, "message")

    def informed():
        every = [t.select("chunk", F.struct(F.lit(k + 1).alias("size"), "replies").alias("told")) for k, t in enumerate(told)]
        one = functools.reduce(DataFrame.union, every).groupBy("chunk").agg(F.collect_list("told").alias("told"))
        return kit.with_told(states, one).select("chunk", "payload", "told")

    for k in range(2, max_words + 1):
        bits = [*bits, (owners * _largest(told[-1])).bit_length()]
        if bits[-1] + bits[0] > 64:
            raise ValueError("more phrases than numbers of 64 bits")
        sent = informed().mapInArrow(kit.lean(send(bits, k)), kit.ROUTED).select("owner", "chunk", "payload")
        told.append(kit.exchange(sent, owners, _sum_numbers(min_count), "phrase-replies"))
    out = kit.save(informed().mapInArrow(kit.lean(receive(bits)), GRAMS), "phrases", by="size")
    for saved in (rows, *told):
        kit.drop_saved(saved)
    totals = out.where("size = 0").groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    return totals.unionByName(out.where("size > 0").select("lang", "size", "phrase", "n"))


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
    contained: int = CONTAINED, top: int = TOP, **options,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of each language by their lowest-scoring cut.

    A phrase goes if a longer one that holds it has at least `contained` percent of its occurrences.
    """
    grams = count_phrases(docs, text_col, lang_col, max_words, min_count, **options)
    n = grams.where("size = 0").select("lang", F.col("n").alias("total"))
    parts = grams.where("size >= 1").select(F.col("lang").alias("p_lang"), F.col("phrase").alias("p_phrase"), F.col("n").alias("p_n"))
    both = grams.where("size >= 2").select("lang", "size", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    some = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    cuts = both.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", some(F.lit(1), F.col("k")).alias("head"), some(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    for part, name in (("head", "l"), ("rest", "r")):
        cuts = cuts.join(parts, (F.col("lang") == F.col("p_lang")) & (F.col(part) == F.col("p_phrase"))).withColumnRenamed("p_n", name).drop("p_lang", "p_phrase", part)
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumns({"up": F.lit(1_000_000).cast("decimal(7,0)") * exact("a") * exact("a"), "down": exact("l") * exact("r")})
    best = cuts.withColumn("cut", F.struct(F.expr("up div down").alias("score"), "k", "l", "r")).groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut"))
    # Inner phrases of longer candidates, each with the most that one of these has.
    inner = both.where("size >= 3").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1))).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
    inner = inner.groupBy(F.col("lang").alias("i_lang"), some(F.col("i"), F.col("m")).alias("i_phrase")).agg(F.max("a").alias("longer"))
    on = (F.col("lang") == F.col("i_lang")) & (F.col("phrase") == F.col("i_phrase")) & (100 * F.col("longer") >= contained * F.col("a"))
    left = best.join(inner, on, "left_anti").select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    spread = F.pmod(F.xxhash64("phrase"), F.lit(kit.parts(docs.sparkSession)))
    left = left.withColumn("slice", spread).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("rank") <= top)
    left = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    # As many rows as languages.
    return left.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


ORACLE = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, range(1, 4) r(m))),
f AS (SELECT lang, m, phrase, count(*) AS a, string_split(phrase, ' ') AS ws FROM g GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1),
s AS (SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, (1000000::HUGEINT * c.a * c.a // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:k], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, array_to_string(ws[j:j + 1], ' ') AS phrase, max(a) AS longer FROM (SELECT *, unnest([1, 2]) AS j FROM f WHERE m = 3) GROUP BY ALL),
q AS (SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM b LEFT JOIN i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM q JOIN n USING (lang) WHERE rank <= 2000
"""
