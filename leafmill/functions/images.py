"""Format and size of images from their first bytes, as expressions over binary columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Markers of a JPEG that are looked at before its frame; a file with more has no known size.
JPEG_MARKERS = 512
# JPEG markers that start a frame, and those without a length.
FRAMES = (
    0xC0, 0xC1, 0xC2, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF,
)
BARE = (
    0x01, 0xD0, 0xD1, 0xD2, 0xD3, 0xD4, 0xD5, 0xD6, 0xD7, 0xD8,
)


def big(c: Column, at: Column | int, n: int) -> Column:
    """n bytes from place `at` (from 0) as a number, the first byte highest; null where they are cut off."""
    found = F.substring(c, F.lit(at) + 1, F.lit(n))
    return F.when(F.octet_length(found) == n, F.conv(F.hex(found), 16, 10).cast("long"))


def little(c: Column, at: int, n: int) -> Column:
    """n bytes from place `at` as a number, the first byte lowest."""
    return sum((big(c, at + i, 1) * (1 << 8 * i) for i in range(1, n)), big(c, at, 1))


def _has(c: Column, at: int, signature: bytes) -> Column:
    return F.coalesce(F.substring(c, at + 1, len(signature)) == F.lit(bytearray(signature)), F.lit(False))


def _jpeg(c: Column) -> Column:
    """(width, height) of the first frame: markers are passed by their lengths."""
    state = lambda at, width, height: F.struct(at.cast("long").alias("at"), width.cast("long").alias("width"), height.cast("long").alias("height"))
    none = F.lit(None).cast("long")

    def step(s: Column, _: Column) -> Column:
        kind = big(c, s["at"] + 1, 1)
        there = big(c, s["at"], 1) == 0xFF
        frame = there & kind.isin(*FRAMES)
        on = F.when(kind == 0xFF, s["at"] + 1).when(kind.isin(*BARE), s["at"] + 2).otherwise(s["at"] + 2 + big(c, s["at"] + 2, 2))
        # A null place is the end: the frame was found, or the file is broken off.
        return F.when(s["at"].isNull(), s).otherwise(state(F.when(there & ~frame, on), F.when(frame, big(c, s["at"] + 7, 2)), F.when(frame, big(c, s["at"] + 5, 2))))

    return F.aggregate(F.sequence(F.lit(1), F.lit(JPEG_MARKERS)), state(F.lit(2), none, none), step)


def image_facts(c: Column) -> Column:
    """(format, width, height) of a PNG, JPEG, GIF or WEBP image; all null for other bytes, sizes null where the header is cut off."""
    riff = _has(c, 0, b"RIFF") & _has(c, 8, b"WEBP")
    fact = lambda name, width, height: F.struct(F.lit(name).alias("format"), width.cast("int").alias("width"), height.cast("int").alias("height"))
    bits = little(c, 21, 4)
    # Inside an array, so that the markers are walked once for both numbers.
    jpeg = F.transform(F.array(_jpeg(c)), lambda j: fact("jpeg", j["width"], j["height"]))[0]
    lossy, low = little(c, 26, 2), F.lit(0x3FFF).cast("long")
    return (
        F.when(_has(c, 0, b"\x89PNG\r\n\x1a\n"), fact("png", big(c, 16, 4), big(c, 20, 4)))
        .when(_has(c, 0, b"GIF87a") | _has(c, 0, b"GIF89a"), fact("gif", little(c, 6, 2), little(c, 8, 2)))
        .when(_has(c, 0, b"\xff\xd8\xff"), jpeg)
        .when(riff & _has(c, 12, b"VP8 "), fact("webp", lossy.bitwiseAND(low), little(c, 28, 2).bitwiseAND(low)))
        .when(riff & _has(c, 12, b"VP8L"), fact("webp", bits.bitwiseAND(low) + 1, F.shiftright(bits, 14).bitwiseAND(low) + 1))
        .when(riff & _has(c, 12, b"VP8X"), fact("webp", little(c, 24, 3) + 1, little(c, 27, 3) + 1))
        .otherwise(fact(None, F.lit(None), F.lit(None)))
    )
