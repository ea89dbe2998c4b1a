"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Each task digests its texts (white space runs become one space) and packs
   the sorted digests of up to CHUNK_ROWS documents into one row: a chunk.
2. Each chunk sends its distinct fingerprints, Golomb-coded, to the owners of
   their ranges; owners answer with bitmaps of those that others hold too.
3. Documents with a marked fingerprint are suspects. Only their texts are
   shuffled, and grouped by the normalised text itself, which compares bytes;
   the map side combines copies first, so a hot text moves once a task.

Defined results: a null text is an empty one; a null id comes after all ids;
rows that share id and text are one document and are all kept or all dropped;
an empty table gives no rows; columns besides id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kit

CHUNK_ROWS = 1 << 16
#: Bits of a fingerprint; more makes longer messages, fewer makes more false suspects.
PRINT_BITS = 48
WS = r"[\x20\x09-\x0D]+"
_SPACE = frozenset(b" \t\n\x0b\x0c\r")


def normal(text: bytes) -> bytes:
    """Each run of white space becomes one space, at the ends too."""
    words = text.split()
    if not words:
        return b" " if text else b""
    return (b" " if text[0] in _SPACE else b"") + b" ".join(words) + (b" " if text[-1] in _SPACE else b"")


def _pack(chunk_rows: int):
    def pack(batches):
        chunk = kit.chunk_ids()
        ids, hashes, shas, n = [], [], [], 0

        def out():
            sha = np.frombuffer(b"".join(shas), np.uint8).reshape(-1, 32)
            prints = sha[:, :8].copy().view(">u8").ravel().astype(np.uint64)
            order = np.argsort(prints, kind="stable")
            packed = (np.concatenate(ids)[order], np.concatenate(hashes)[order], sha[order])
            return pa.RecordBatch.from_arrays([pa.array([next(chunk)], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in packed)], ["chunk", "ids", "hashes", "shas"])

        for batch in batches:
            buf, off = kit.text_bytes(batch.column("text"))
            view = memoryview(buf)
            shas.append(b"".join(hashlib.sha256(normal(bytes(view[off[i] : off[i + 1]]))).digest() for i in range(len(off) - 1)))
            ids.append(kit.ids_of(batch.column("doc_id")))
            hashes.append(batch.column("thash").to_numpy(zero_copy_only=False))
            n += batch.num_rows
            if n >= chunk_rows:
                yield out()
                ids, hashes, shas, n = [], [], [], 0
        if n:
            yield out()

    return pack


def _prints(shas: bytes) -> np.ndarray:
    sha = np.frombuffer(shas, np.uint8).reshape(-1, 32)
    return sha[:, :8].copy().view(">u8").ravel().astype(np.uint64) >> np.uint64(64 - PRINT_BITS)


def _send(owners: int):
    def send(batches):
        for batch in batches:
            for chunk, shas in zip(batch.column("chunk").to_pylist(), batch.column("shas").to_pylist(), strict=True):
                prints = np.unique(_prints(shas))
                told = [(o, kit.rice_encode(prints[a:b])) for o, a, b in kit.by_owner(prints, PRINT_BITS, owners)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o for o, _ in told], pa.int32()), pa.array([chunk] * len(told), pa.int64()), pa.array([m for _, m in told], pa.binary())],
                    ["owner", "chunk", "payload"],
                )

    return send


def _receive(owners: int):
    def receive(batches):
        for batch in batches:
            for ids, hashes, shas, replies in zip(*(batch.column(c).to_pylist() for c in ("ids", "hashes", "shas", "replies")), strict=True):
                all_prints = _prints(shas)
                prints, back, n = np.unique(all_prints, return_inverse=True, return_counts=True)
                marks = n > 1
                told = {r["owner"]: r["reply"] for r in replies}
                for o, a, b in kit.by_owner(prints, PRINT_BITS, owners):
                    marks[a:b] |= np.unpackbits(np.frombuffer(told[o], np.uint8), count=b - a).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        kit.ids_back(np.frombuffer(ids, np.int64)),
                        pa.array(np.frombuffer(hashes, np.int64)),
                        pa.array([shas[i : i + 32].hex() for i in range(0, len(shas), 32)], pa.string()),
                        pa.array(marks[back]),
                    ],
                    ["doc_id", "thash", "text_sha256", "suspect"],
                )

    return receive


def _groups(docs: DataFrame, id_col: str, text_col: str, owners: int | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    spark = docs.sparkSession
    owners = owners or kit.parts(spark)
    slim = kit.keyed(docs, id_col, text_col)
    chunks = kit.save(slim.mapInArrow(kit.lean(_pack(chunk_rows)), "chunk long, ids binary, hashes binary, shas binary"), "digests")
    replies = kit.exchange(chunks.select("chunk", "shas").mapInArrow(kit.lean(_send(owners)), kit.MESSAGE), owners, kit.repeated_marks, "marks")
    flagged = chunks.join(replies, "chunk").mapInArrow(kit.lean(_receive(owners)), "doc_id long, thash long, text_sha256 string, suspect boolean")
    flagged = kit.save(flagged, "flagged")
    suspects = flagged.where("suspect").select(F.col("doc_id").alias("suspect_id")).distinct()
    suspects = kit.save(suspects, "suspects")
    texts = kit.join_small(slim, suspects, F.col("doc_id").eqNullSafe(F.col("suspect_id")), "left_semi")
    same = (
        texts.withColumn("normal", F.regexp_replace("text", WS, " "))
        .groupBy("normal")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
        .select(F.sha2(F.col("normal").cast("binary"), 256).alias("text_sha256"), "keep_id", "group_size")
    )
    same = kit.save(same, "groups")
    keep = F.when(F.col("group_size").isNotNull(), F.col("keep_id")).otherwise(F.col("doc_id"))
    return kit.join_small(flagged.drop("suspect"), same, "text_sha256", "left").select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
        "thash",
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    return _groups(docs, id_col, text_col, **options).drop("thash")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that stay: of equal texts, the one with the smallest id."""
    return kit.without(docs, _groups(docs, id_col, text_col, **options).where("not kept"), id_col, text_col)
