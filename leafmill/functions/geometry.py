"""Boxes, confidences and image token counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the image token formula.
FACTOR, MIN_PIXELS, MAX_PIXELS = 32, 65_536, 16_777_216


def normal_box(box: Column, width: Column, height: Column) -> Column:
    """A box in page units to the canonical space of 0 to 1000, one decimal; a side without a size has 1000."""
    w, h = (F.coalesce(F.nullif(x.cast("double"), F.lit(0.0)), F.lit(1000.0)) for x in (width, height))
    return F.transform(box, lambda v, i: F.round(v / F.when(i % 2 == 0, w).otherwise(h) * 1000, 1))


def scale_box(box: Column, width: Column, height: Column) -> Column:
    return F.transform(box, lambda v, i: v / 1000 * F.when(i % 2 == 0, width).otherwise(height))


def side(box: Column, i: int) -> Column:
    """A side of a box, 0.0 where it is missing."""
    return F.coalesce(F.try_element_at(box, F.lit(i + 1)), F.lit(0.0))


def union_box(x1: Column, y1: Column, x2: Column, y2: Column, margin: int, width: int, height: int) -> Column:
    """Aggregate: the whole box around all boxes with a margin, clamped; null when empty."""
    a, b = F.greatest(F.lit(0), F.floor(F.min(x1)) - margin), F.greatest(F.lit(0), F.floor(F.min(y1)) - margin)
    c, d = F.least(F.lit(width), F.ceil(F.max(x2)) + margin), F.least(F.lit(height), F.ceil(F.max(y2)) + margin)
    return F.when(F.min(x1).isNotNull() & (c > a) & (d > b), F.struct(a.alias("x1"), b.alias("y1"), c.alias("x2"), d.alias("y2")))


def confidence(c: Column) -> Column:
    """A number clamped to 0..1; what is none is 0."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(c.try_cast("double"), F.lit(0.0))))


def image_tokens(width: Column, height: Column) -> Column:
    """Tiles of FACTOR pixels after scaling into the pixel limits; 0 without a size.

    Rounding can leave the scaled area outside a limit by a few tiles, so a
    bounded fold steps the longer side down or the shorter side up until it fits.
    """
    pixels = width.cast("double") * height
    scale = F.when(pixels > MAX_PIXELS, F.sqrt(MAX_PIXELS / pixels)).when(pixels < MIN_PIXELS, F.sqrt(MIN_PIXELS / pixels)).otherwise(1.0)
    tiles = lambda x: F.greatest(F.lit(1), F.bround(x * scale / FACTOR).cast("long"))
    low, high = MIN_PIXELS // FACTOR**2, MAX_PIXELS // FACTOR**2
    start = F.struct(tiles(width).cast("long").alias("w"), tiles(height).cast("long").alias("h"))

    def step(s: Column, _: Column) -> Column:
        w, h = s["w"], s["h"]
        over, under = w * h > high, w * h < low
        down_w = over & (w >= h) & (w > 1)
        down_h = over & ~down_w & (h > 1)
        up_w = under & (w <= h)
        up_h = under & (w > h)
        return F.struct(
            (w - F.when(down_w, 1).otherwise(0) + F.when(up_w, 1).otherwise(0)).cast("long").alias("w"),
            (h - F.when(down_h, 1).otherwise(0) + F.when(up_h, 1).otherwise(0)).cast("long").alias("h"),
        )

    return F.when((width <= 0) | (height <= 0), F.lit(0).cast("long")).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(64)), start, step, lambda s: F.greatest(F.lit(1).cast("long"), s["w"] * s["h"])))
