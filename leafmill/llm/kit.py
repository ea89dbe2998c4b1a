"""Shared tools: shared-folder tables, Arrow text access, vectorised hashing, fingerprint exchange.

Everything here works on bounded slices: a slice is a run of whole texts of
about ``SLICE_BYTES`` bytes (one longer text makes a slice of its own), so
memory follows the longest text, never the partition.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import hashlib
import pickle
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one vectorised pass holds.
SLICE_BYTES = 1 << 19
#: A side is broadcast while its measured bytes are at most this many.
BROADCAST_BYTES = 48 << 20
#: Tables with rows of megabytes: Parquet looks at the bytes it holds after every row, not after 100, and ends a row group at
#: 8 MB. A reader's batch is within one row group, so neither end holds more, however many rows a task has.
WIDE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.block.size": str(8 << 20), "parquet.enable.dictionary": "false"}
#: The largest id; it stands for a null id in orderings, so null ids come last.
NO_ID = np.iinfo(np.int64).max

U64 = np.uint64
_BASE_A, _BASE_B = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


# ---------------------------------------------------------------- shared tables


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a local one is set only where the session names none."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="leafmill-shared-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        at = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", at)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def save(df: DataFrame, name: str, by: str | None = None, wide: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors.

    `by` names a column of few values; a filter on it then reads only its files. `wide`: its rows are long, see WIDE_ROWS.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/leafmill-{name}-{uuid.uuid4().hex}"
    write = df.write.options(**WIDE_ROWS) if wide else df.write
    (write.partitionBy(by) if by else write).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.leafmill_path = path
    return back


def save_chunks(rows: DataFrame, name: str, buckets: int) -> DataFrame:
    """Write rows with a `kind` and a `chunk` of chunk_ids() as a table bucketed by the task that made the chunk, and read it back.

    with_told() then brings each chunk what belongs to it without moving the chunks. Payloads come from pack(), compressed where they were made.
    """
    spark = rows.sparkSession
    table = f"leafmill_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/leafmill-{name}-{table[9:]}"
    made = rows.withColumn("part", F.shiftright("chunk", 32))
    # A writer a kind stays open: sorted by kind first, a task would hold all its chunks in memory.
    held = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "8")
    try:
        made.write.partitionBy("kind").bucketBy(buckets, "part").options(**WIDE_ROWS).option("compression", "uncompressed").option("path", path).saveAsTable(table)
    finally:
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", held)
    back = spark.table(table)
    back.leafmill_path = path
    return back


def with_told(chunks: DataFrame, told: DataFrame, how: str = "inner") -> DataFrame:
    """Join chunks of save_chunks() with told, a row a chunk, by chunk: only told is shuffled, at any size.

    The table is bucketed by part, so part alone is the key; the chunk is compared as a condition, few chunks share a part.
    """
    told = told.withColumnRenamed("chunk", "told_chunk").withColumn("told_part", F.shiftright("told_chunk", 32))
    on = (chunks["part"] == F.col("told_part")) & (chunks["chunk"] - F.col("told_chunk") == 0)
    return chunks.join(told.hint("shuffle_hash"), on, how)


def drop_saved(df: DataFrame, kind: str | None = None) -> None:
    """Delete a table that save() or save_chunks() wrote, or one kind of its rows, once no result reads it any more."""
    path = getattr(df, "leafmill_path", None)
    if path:
        jvm = df.sparkSession._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{path}/kind={kind}" if kind else path)
        with contextlib.suppress(Exception):
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def parts(spark: SparkSession) -> int:
    """Number of shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def owners_for(docs: DataFrame, text_col: str, share: int) -> int:
    """Owners of fingerprints: as many as shuffle partitions, more where each would have over `share` bytes of text."""
    size = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    return max(parts(docs.sparkSession), -(-size // share))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _width(kind: T.DataType) -> int:
    """Bytes of a value, about; of an array, of one item."""
    if isinstance(kind, T.StructType):
        return 8 + sum(_width(f.dataType) for f in kind)
    return _width(kind.elementType) if isinstance(kind, T.ArrayType) else 24 if isinstance(kind, T.StringType | T.BinaryType) else 8


def small(df: DataFrame) -> DataFrame:
    """A saved side, marked for broadcast where its summed bytes are at most BROADCAST_BYTES; else it is shuffled."""
    width = F.lit(16)
    for f in df.schema:
        if isinstance(f.dataType, T.StringType | T.BinaryType):
            width += F.coalesce(F.octet_length(f.name), F.lit(0)) + 16
        elif isinstance(f.dataType, T.ArrayType):
            width += F.greatest(F.size(f.name), F.lit(0)) * _width(f.dataType) + 24
        else:
            width += _width(f.dataType)
    size = df.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def join_small(left: DataFrame, right: DataFrame, on, how: str) -> DataFrame:
    """Join with a saved side: broadcast while its measured bytes are few, else shuffle."""
    return left.join(small(right), on, how)


# ---------------------------------------------------------------- workers


def release() -> None:
    """Hand memory that Arrow and the C library hold in reserve back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """`run` for mapInArrow, which releases its reserve as a task ends: workers outlive tasks, and idle ones count as memory."""

    def trimmed(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return trimmed


# ---------------------------------------------------------------- text access


def text_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of an Arrow string or binary column, without copying; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    if offsets is None or len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), off


def slices(off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of whole texts with at most `limit` bytes each, or one text."""
    n, a = len(off) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, b
        a = b


def ids_of(col) -> np.ndarray:
    """Ids as int64, null as NO_ID."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return pc.fill_null(col.cast(pa.int64()), NO_ID).to_numpy(zero_copy_only=False)


def ids_back(ids: np.ndarray) -> pa.Array:
    """int64 ids to Arrow, NO_ID as null."""
    return pa.array(ids, pa.int64(), mask=ids == NO_ID)


# ---------------------------------------------------------------- hashing

_NONWS = np.ones(256, bool)
_NONWS[[0x20, *range(0x09, 0x0E)]] = False
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Bytes of a lane, and what a last lane of so many bytes keeps.
_LANE = 8
_KEEP = np.array([0, *((1 << 8 * i) - 1 for i in range(1, 9))], U64)
#: Longer byte strings are digested one by one.
_LONG = 512


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64 for i < n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        m = max(n, 1 << 16)
        up, down = np.full(m, base, U64), np.full(m, pow(base, -1, 1 << 64), U64)
        up[0] = down[0] = 1
        have = _POWERS[base] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        if m > 8 * SLICE_BYTES:
            _POWERS.pop(base)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection in which every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def rolling_hash(values: np.ndarray, s: np.ndarray, e: np.ndarray, base: int = _BASE_A) -> np.ndarray:
    """Polynomial hash modulo 2**64 of values[s[i]:e[i]]: cheap at every position, but it has structured collisions.

    Only to choose places or features from; what it finds equal must be compared.
    """
    up, down = powers(base, len(values) + 1)
    acc = np.zeros(len(values) + 1, U64)
    v = values.astype(U64)
    v += U64(1)
    v *= up[: len(values)]
    np.cumsum(v, out=acc[1:])
    return mix((acc[e] - acc[s]) * down[s] + (e - s).astype(U64))


def _fold(h: np.ndarray, x: np.ndarray, base: int) -> np.ndarray:
    """Take one more value into a hash. The rounds are not linear in any modulus, so no structure cancels out."""
    return mix((h ^ (h >> U64(29))) * U64(base) ^ mix(x + U64(base >> 1)))


def bytes_hash(buf: np.ndarray, s: np.ndarray, e: np.ndarray, base: int = _BASE_A) -> np.ndarray:
    """64-bit hash of each byte string buf[s[i]:e[i]], eight bytes a round; long strings by BLAKE2b."""
    padded = np.concatenate([buf, np.zeros(_LANE, np.uint8)])
    lanes = np.ndarray((len(buf) + 1,), "<u8", padded.data, 0, (1,))
    size = e - s
    out = mix(size.astype(U64) ^ U64(base))
    live = np.flatnonzero((size > 0) & (size <= _LONG))
    at = s[live]
    while len(live):
        left = e[live] - at
        out[live] = _fold(out[live], lanes[at].astype(U64) & _KEEP[np.minimum(left, _LANE)], base)
        on = left > _LANE
        live, at = live[on], at[on] + _LANE
    key = base.to_bytes(8, "little")
    for i in np.flatnonzero(size > _LONG).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(buf[s[i] : e[i]].tobytes(), digest_size=8, key=key).digest(), "little")
    return out


def word_bounds(buf: np.ndarray, starts: np.ndarray, inside: np.ndarray = _NONWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs outside \\x20, \\x09-\\x0D) and the first word of each text.

    `starts` are the offsets of the texts in buf, with the end as last item;
    `inside` says which bytes belong to words.
    """
    solid = inside[buf]
    inner = starts[1:-1]
    inner = inner[(inner > 0) & (inner < len(buf))]
    before = np.empty_like(solid)
    before[:1] = False
    before[1:] = solid[:-1]
    before[inner] = False
    s = np.flatnonzero(solid & ~before)
    after = np.empty_like(solid)
    after[-1:] = False
    after[:-1] = solid[1:]
    after[inner - 1] = False
    e = np.flatnonzero(solid & ~after) + 1
    return s, e, np.searchsorted(s, starts)


def word_hashes(buf: np.ndarray, starts: np.ndarray, base: int = _BASE_A):
    """(hash of each word, first word of each text, word starts, word ends)."""
    s, e, first = word_bounds(buf, starts)
    return bytes_hash(buf, s, e, base), first, s, e


def gram_hashes(words: np.ndarray, at: np.ndarray, k: int, base: int = _BASE_B) -> np.ndarray:
    """Hash of the k words from each position of `at`: by runs of 1, 2, 4 ... words, which overlapping grams share."""
    out = np.full(len(at), k, U64)
    if not len(at):
        return out
    run, size, done = mix(words ^ U64(base)), 1, 0
    while True:
        if k & size:
            out = _fold(out, run[at + done], base)
            done += size
        size *= 2
        if size > k:
            return out
        run = _fold(run[: len(run) - size // 2], run[size // 2 :], base + 2 * size)


def positions(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All (global position, text) at which k words of one text start."""
    n = np.maximum(np.diff(first) - k + 1, 0)
    doc = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + first[:-1][doc]
    return at, doc


# ---------------------------------------------------------------- Golomb-Rice coding


def rice_encode(values: np.ndarray) -> bytes:
    """Sorted uint64 values (repeats allowed) as Golomb codes of their gaps, divisor a power of two.

    The unary quotients and the binary remainders form two streams, so both
    ends are vectorised: n, log2 of the divisor, first value, bits of quotients.
    """
    n = len(values)
    if not n:
        return b""
    gaps = np.diff(values)
    mean = int(gaps.mean()) if n > 1 else 0
    k = max(0, mean.bit_length() - 1)
    q = (gaps >> U64(k)).astype(np.int64)
    ends = np.cumsum(q + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if n > 1 else 0, bool)
    unary[ends] = True
    low = np.zeros((n - 1, k), bool)
    for b in range(k):
        low[:, b] = (gaps >> U64(b)) & U64(1)
    head = np.array([n, k, int(values[0]), len(unary)], U64).tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(low.ravel()).tobytes()


def rice_decode(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, U64)
    n, k, first, bits = (int(x) for x in np.frombuffer(blob, U64, 4))
    raw = np.frombuffer(blob, np.uint8, offset=32)
    cut = (bits + 7) // 8
    ends = np.flatnonzero(np.unpackbits(raw[:cut], count=bits)) if bits else np.zeros(0, np.int64)
    q = np.diff(ends, prepend=-1) - 1
    low = np.unpackbits(raw[cut:], count=(n - 1) * k).reshape(n - 1, k) if k and n > 1 else np.zeros((n - 1, 0), np.uint8)
    gaps = q.astype(U64) << U64(k)
    for b in range(k):
        gaps |= low[:, b].astype(U64) << U64(b)
    out = np.empty(n, U64)
    out[0] = first
    out[1:] = gaps
    return np.cumsum(out, dtype=U64)


# ---------------------------------------------------------------- exchange

MESSAGE = "owner int, chunk long, payload binary"
REPLY = "chunk long, owner int, reply binary"


def chunk_ids() -> Iterator[int]:
    """Ids unique to this task; they are used only after their rows are saved."""
    from pyspark import TaskContext

    context = TaskContext.get()
    base = (context.partitionId() if context else 0) << 32
    while True:
        yield base
        base += 1


def owner_of(prints: np.ndarray, bits: int, owners: int) -> np.ndarray:
    """Owner of each fingerprint of `bits` bits; owners hold ranges, so sorted prints have sorted owners."""
    return (((prints >> U64(bits - 24)) * U64(owners)) >> U64(24)).astype(np.int32)


def by_owner(prints: np.ndarray, bits: int, owners: int) -> Iterator[tuple[int, int, int]]:
    """(owner, from, to) over sorted fingerprints."""
    cuts = np.searchsorted(owner_of(prints, bits, owners), np.arange(owners + 1))
    for o in np.flatnonzero(np.diff(cuts)):
        yield int(o), int(cuts[o]), int(cuts[o + 1])


def exchange(messages: DataFrame, owners: int, answer: Callable[[list[bytes]], list[bytes]], name: str) -> DataFrame:
    """Send (owner, chunk, payload) rows to their owners; returns saved (chunk, replies) rows.

    An owner reads its payloads one after another and answers each sender; a
    sender sends a fingerprint once however often it holds it, so a hot
    fingerprint costs its owner one entry a sender.
    """

    def own(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chunks, payloads = None, [], []

        def reply() -> pa.RecordBatch:
            replies = answer(payloads)
            return pa.RecordBatch.from_arrays(
                [pa.array(chunks, pa.int64()), pa.array([now] * len(chunks), pa.int32()), pa.array(replies, pa.binary())], ["chunk", "owner", "reply"]
            )

        for batch in batches:
            for i in range(batch.num_rows):
                o, c, p = (batch.column(x)[i].as_py() for x in ("owner", "chunk", "payload"))
                if o != now and chunks:
                    yield reply()
                    chunks, payloads = [], []
                now = o
                chunks.append(c)
                payloads.append(p)
        if chunks:
            yield reply()

    # Sorted, so a task holds the payloads of one owner at a time.
    replies = messages.repartition(owners, "owner").sortWithinPartitions("owner").mapInArrow(lean(own), REPLY)
    return save(replies.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("owner", "reply"))).alias("replies")), name, wide=True)


def join_replies(states: DataFrame, replies: DataFrame) -> DataFrame:
    """Bring each chunk its replies; the states hold no texts, so both sides are shuffled."""
    return states.hint("shuffle_hash").join(replies.hint("shuffle_hash"), "chunk")


def repeated_marks(payloads: list[bytes]) -> list[bytes]:
    """Owner's answer: for each sender a bitmap of the fingerprints that another sender holds too."""
    all_prints = [rice_decode(p) for p in payloads]
    flat = np.concatenate(all_prints)
    order = np.argsort(flat, kind="stable")
    ordered = flat[order]
    twin = np.zeros(len(flat), bool)
    same = ordered[1:] == ordered[:-1]
    twin[1:] = same
    twin[:-1] |= same
    marks = np.empty(len(flat), bool)
    marks[order] = twin
    out, at = [], 0
    for p in all_prints:
        out.append(np.packbits(marks[at : at + len(p)]).tobytes())
        at += len(p)
    return out


def emit(schema: list[tuple[str, pa.DataType]], *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for (_, t), c in zip(schema, columns, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in schema])


# ---------------------------------------------------------------- messages and texts

#: Anchors of one chunk.
CHUNK_ANCHORS = 1 << 20
ROUTED = "kind string, owner int, chunk long, payload binary"
ROUTED_ARROW = [("kind", pa.string()), ("owner", pa.int32()), ("chunk", pa.int64()), ("payload", pa.binary())]


def pack(state) -> bytes:
    """A payload: pickled and compressed, so the JVM neither holds it whole nor compresses it (its codec would hold up the collector)."""
    raw = pickle.dumps(state)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def pickled(blob: bytes) -> bytes:
    return pa.decompress(memoryview(blob)[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True)


def unpack(blob: bytes):
    return pickle.loads(pickled(blob))


def routed(kind: str, owners: list[int], chunk: int, payloads: list[bytes]) -> pa.RecordBatch:
    n = len(owners)
    return emit(ROUTED_ARROW, [kind] * n, owners, [chunk] * n, payloads)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and the text's 64-bit hash; id and hash together name a text."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"), F.xxhash64(text_col).alias("thash"))


def without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs whose id and text hash are not in gone (doc_id, thash)."""
    out = save(gone.select(F.col("doc_id").alias("gone_id"), F.col("thash").alias("gone_hash")).distinct(), "gone")
    on = docs[id_col].cast("long").eqNullSafe(out["gone_id"]) & (F.xxhash64(docs[text_col]) == out["gone_hash"])
    return join_small(docs, out, on, "left_anti")


def texts_of(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a batch's texts: (from, to, bytes, offsets in them)."""
    buf, off = text_bytes(batch.column("text"))
    for a, b in slices(off):
        yield a, b, buf[off[a] : off[b]], off[a : b + 1] - off[a]


def unmark(marks: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(marks, np.uint8), count=n).astype(bool)
