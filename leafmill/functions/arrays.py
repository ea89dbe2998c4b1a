"""Array expressions: order-preserving sets, gaps, take-while, ranges of labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def ordered_distinct(a: Column) -> Column:
    """Trimmed, blanks dropped, first occurrences kept in order; null is empty."""
    clean = F.filter(F.transform(F.coalesce(a, F.array().cast("array<string>")), lambda x: strip(x.cast("string"))), lambda x: x != "")
    return F.array_distinct(clean)


def or_primary(a: Column, primary: Column) -> Column:
    """The ordered set, or the one primary name where it is empty."""
    d = ordered_distinct(a)
    return F.when(F.size(d) == 0, F.array(primary)).otherwise(d)


def missing_between(a: Column) -> Column:
    """Numbers between the least and the largest that the array lacks, in order."""
    return F.when(F.size(a) > 0, F.array_except(F.sequence(F.array_min(a), F.array_max(a)), a)).otherwise(a)


def missing_to(a: Column, n: Column) -> Column:
    return F.when(n > 0, F.array_except(F.sequence(F.lit(1), n), a)).otherwise(F.array().cast("array<int>"))


def take_until(a: Column, stop) -> Column:
    """Items before the first one that stops, which never is the first item."""
    hits = F.filter(F.transform(a, lambda x, i: F.when((i > 0) & stop(x), i)), lambda i: i.isNotNull())
    return F.when(F.size(hits) > 0, F.slice(a, F.lit(1), F.array_min(hits))).otherwise(a)


def labels_between(labels: Column, start: Column, end: Column) -> Column:
    """Labels from start to end; an unknown end or a reversed range gives none."""
    s, e = F.array_position(labels, start), F.array_position(labels, end)
    return F.when((s > 0) & (e >= s), F.slice(labels, F.greatest(s, F.lit(1)).cast("int"), F.greatest(e - s + 1, F.lit(0)).cast("int"))).otherwise(F.array().cast("array<string>"))


def union_labels(*arrays: Column) -> Column:
    return ordered_distinct(F.concat(*arrays))


def text_lines(a: Column) -> Column:
    """Blocks to their trimmed, non-blank lines, flat."""
    lines = F.flatten(F.transform(F.coalesce(a, F.array().cast("array<string>")), lambda x: F.split(x, "\n")))
    return F.filter(F.transform(lines, strip), lambda x: x != "")


def limit_items(a: Column, n: int) -> Column:
    return F.slice(a, 1, n)


def count_maps(a: Column) -> Column:
    """Distinct items and their counts as a map."""
    return F.map_from_entries(F.transform(F.array_sort(F.array_distinct(a)), lambda k: F.struct(k.alias("key"), F.size(F.filter(a, lambda x: x == k)).alias("value"))))


def page_numbers(pages: Column) -> Column:
    """Distinct positive page numbers in order."""
    return F.array_sort(F.array_distinct(F.filter(pages, lambda p: p > 0)))


def display_name(models: Column) -> Column:
    """Models of several workers as one name: the one, or all joined by +."""
    return F.array_join(models, "+")
