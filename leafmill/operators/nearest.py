"""Nearest spans: for each query span the k nearest groups of item spans of its keys, without pairing all of a key.

The axis of each key is cut into cells at quantiles of all ends, so a hot key
has more cells and a run of few spans has one. An item lies in the cells of its
ends; what it says to other cells is kept as k groups a cell:

* `full`: the k smallest groups of items that cover the cell and end elsewhere;
* `any`: the k smallest groups of items that touch the cell;
* `left`, `right`: the k nearest groups of items that end before, or start
  after, the cell, carried from cell to cell.

A query meets the items of its two end cells, and those lists; between its end
cells every item is at distance 0, so `any` is enough there. Cells between two
ends are never listed: they are two runs of a power of two of cells, for which
`full` and `any` are kept. Distances inside a cell are one numpy table at a
time. Queries of one span are answered once. So the rows that are made follow
queries times k, however many cells a span reaches over, and no task gets a
whole key.

Bounds and the placed sides are saved to the shared folder: the list of cuts
stands in one plan only, and the plan of the answer, which reads each side
several times, stays small for the driver. A side is broadcast only by its
measured bytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types

from ..llm.kit import save, small
from .tables import top_k

#: Ends of spans that a cell is made for, and the most cells of a key.
CELL_ROWS, MOST_CELLS = 512, 4096
_FINE = 64
#: Cells of a distance table.
TABLE = 1 << 20


def _bounds(ends: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, bounds): the values at which cells begin, as many as the key's ends call for."""
    # No key needs more cuts than all ends together do.
    n = min(MOST_CELLS, max(1, -(-ends.count() // CELL_ROWS)))
    cuts = [i / n for i in range(1, n)]
    if not cuts:
        return ends.select(*keys).distinct().withColumn("_bounds", F.array().cast("array<double>"))
    q = ends.groupBy(*keys).agg(F.percentile_approx("_v", cuts, max(100, 4 * n)).alias("_q"), F.count("*").alias("_n"))
    step = F.greatest(F.lit(1), F.ceil(F.lit(n * CELL_ROWS) / F.col("_n"))).cast("int")
    return q.select(*keys, F.array_distinct(F.filter("_q", lambda x, i: (i + 1) % step == 0)).alias("_bounds"))


def _cell(v: Column) -> Column:
    """Number of bounds up to v, in two steps so that few are looked at."""
    upto = lambda a: F.size(F.filter(a, lambda b: b <= v))
    coarse = upto(F.filter("_bounds", lambda b, i: i % _FINE == _FINE - 1))
    return (coarse * _FINE + upto(F.slice("_bounds", coarse * _FINE + 1, _FINE))).cast("int")


def _carried(ends: DataFrame, cells: DataFrame, keys: Sequence[str], k: int, forward: bool) -> DataFrame:
    """For each of the cells the k nearest groups that end before it (or start after it): (keys, _cell, _group, _v)."""
    near = F.max("_v") if forward else F.min("_v")
    each = ends.groupBy(*keys, "_cell", "_group").agg(near.alias("_v"))
    each = top_k(each, [*keys, "_cell"], [F.col("_v").desc() if forward else F.col("_v"), F.col("_group")], k).select(*keys, "_cell", "_group", "_v")

    def carry(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        # At most k rows a cell, and at most MOST_CELLS cells: a proven size, whatever the key's rows.
        out, held = [], {}
        news = {cell: list(zip(x["_group"], x["_v"], strict=True)) for cell, x in own.groupby("_cell")}
        wanted = set(asked["_cell"])
        for cell in sorted(wanted | news.keys(), reverse=not forward):
            if cell in wanted:
                out += [(cell, g, v) for g, v in held.items()]
            for g, v in news.get(cell, ()):
                held[g] = v if g not in held else (max if forward else min)(held[g], v)
            held = dict(sorted(held.items(), key=lambda x: (-x[1] if forward else x[1], x[0]))[:k])
        found = pd.DataFrame(out, columns=["_cell", "_group", "_v"], dtype=object)
        return _keyed(found, asked, keys, ["_cell", "_group", "_v"])

    return each.groupBy(*keys).cogroup(cells.groupBy(*keys)).applyInPandas(carry, each.schema)


def _keyed(found: pd.DataFrame, of: pd.DataFrame, keys: Sequence[str], columns: list[str]) -> pd.DataFrame:
    """The found rows behind the keys of the group they belong to."""
    for c in keys:
        found[c] = pd.Series([of[c].iloc[0] if len(of) else None] * len(found), dtype=object)
    return found[[*keys, *columns]]


def _run(first: Column, last: Column) -> Column:
    """The two runs of 2**level cells that make up the cells from first to last, as an array of (_level, _cell); null where there are none."""
    level = F.length(F.bin(last - first + 1)) - 1
    node = lambda cell: F.struct(level.alias("_level"), cell.cast("int").alias("_cell"))
    return F.when(last >= first, F.array_distinct(F.array(node(first), node(last + 1 - F.call_function("shiftleft", F.lit(1), level)))))


def _runs(rows: DataFrame) -> DataFrame:
    """rows once for each of the two runs of the cells between their end cells, with _level and _cell."""
    return rows.withColumn("_node", F.explode(_run(F.col("_c") + 1, F.col("_d") - 1))).select(*rows.columns, "_node.*")


def _covered(nodes: DataFrame, keys: Sequence[str], k: int, schema: types.StructType) -> DataFrame:
    """(keys, _cell, _group): the k smallest groups of the runs (keys, _level, _cell, _group) that each cell is in."""

    def spread(own: pd.DataFrame) -> pd.DataFrame:
        # At most k groups for each of MOST_CELLS cells on each level, whatever the key's rows.
        levels: dict[int, dict] = {}
        for level, cell, g in zip(own["_level"], own["_cell"], own["_group"], strict=True):
            levels.setdefault(level, {}).setdefault(cell, set()).add(g)
        for level in range(max(levels), 0, -1):
            below = levels.setdefault(level - 1, {})
            for cell, groups in levels.get(level, {}).items():
                for c in (cell, cell + (1 << level - 1)):
                    below[c] = set(sorted(below.get(c, set()) | groups)[:k])
        found = pd.DataFrame([(c, g) for c, groups in levels[0].items() for g in groups], columns=["_cell", "_group"], dtype=object)
        return _keyed(found, own, keys, ["_cell", "_group"])

    return nodes.groupBy(*keys).applyInPandas(spread, schema)


def _smallest_of_runs(touched: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """(keys, _level, _cell, _groups): the k smallest groups of the 2**level cells from each cell on."""
    levels = MOST_CELLS.bit_length()
    names, kinds = ["_level", "_cell", "_groups"], (types.IntegerType(), types.IntegerType(), types.ArrayType(touched.schema["_group"].dataType))
    schema = types.StructType([*(touched.schema[c] for c in keys), *map(types.StructField, names, kinds)])

    def build(own: pd.DataFrame) -> pd.DataFrame:
        # At most k groups for each of MOST_CELLS cells on each level, whatever the key's rows.
        row, out = [[] for _ in range(own["_cell"].max() + 1)], []
        for cell, g in zip(own["_cell"], own["_group"], strict=True):
            row[cell].append(g)
        for level in range(levels):
            out += [(level, i, g) for i, g in enumerate(row) if g]
            step = 1 << level
            row = [sorted({*g, *row[i + step]})[:k] if i + step < len(row) else g for i, g in enumerate(row)]
        return _keyed(pd.DataFrame(out, columns=names, dtype=object), own, keys, names)

    return touched.groupBy(*keys).applyInPandas(build, schema)


def nearest_groups(
    queries: DataFrame, items: DataFrame, keys: Sequence[str], query: str, span: tuple[str, str], group: str, item_span: tuple[str, str], k: int = 6
) -> DataFrame:
    """(keys, query, group, distance, rank): the k groups with the nearest item, ranked by distance and group.

    The distance of two closed spans is 0 where they meet, else the gap between
    them, in doubles. `query` names a query within its keys. Rows with a null
    key, name, group or end, and reversed spans, take no part.
    """
    number = lambda c: F.col(c).cast("double")
    # Named anew, so that both sides may come from one table.
    own = [F.col(c).alias(c) for c in keys]
    q = queries.select(*own, F.col(query).alias("_id"), number(span[0]).alias("_lo"), number(span[1]).alias("_hi")).dropna().where("_lo <= _hi")
    q = save(q, "nearest-queries")
    # Of equal spans the k smallest groups are enough, and queries of one span are answered once.
    t = items.select(*own, F.col(group).alias("_group"), number(item_span[0]).alias("_lo"), number(item_span[1]).alias("_hi")).dropna().where("_lo <= _hi").distinct()
    t = save(top_k(t, [*keys, "_lo", "_hi"], ["_group"], k).drop("rank"), "nearest-items")
    spans = save(q.select(*keys, "_lo", "_hi").distinct(), "nearest-asked")
    ends = lambda d: d.select(*keys, F.explode(F.array("_lo", "_hi")).alias("_v"))
    bounds = save(_bounds(ends(t).unionAll(ends(spans)), keys), "nearest-bounds")
    placed = lambda d: d.join(bounds, list(keys)).withColumns({"_c": _cell(F.col("_lo")), "_d": _cell(F.col("_hi"))}).drop("_bounds")
    spans, t = save(placed(spans), "nearest-spans"), save(placed(t), "nearest-placed")

    at = lambda d: d.withColumn("_cell", F.explode(F.array_distinct(F.array("_c", "_d"))))
    smallest = lambda d, *of: top_k(d.select(*keys, *of, "_group").distinct(), [*keys, *of], ["_group"], k).drop("rank")
    partial = at(t)
    cell_group = types.StructType([*(t.schema[c] for c in keys), types.StructField("_cell", types.IntegerType()), t.schema["_group"]])
    full = _covered(smallest(_runs(t), "_level", "_cell"), keys, k, cell_group)
    touched = smallest(partial.select(*keys, "_cell", "_group").unionAll(full), "_cell")
    asked = at(spans)
    cells = asked.select(*keys, "_cell").distinct()
    left = _carried(t.select(*keys, F.col("_d").alias("_cell"), "_group", F.col("_hi").alias("_v")), cells, keys, k, True)
    right = _carried(t.select(*keys, F.col("_c").alias("_cell"), "_group", F.col("_lo").alias("_v")), cells, keys, k, False)

    # What a cell knows, as spans: of items elsewhere the end that counts, and no other.
    known = partial.select(*keys, "_cell", "_group", "_lo", "_hi")
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    for part, lo, hi in ((full, low, high), (left, low, F.col("_v")), (right, F.col("_v"), high)):
        known = known.unionAll(part.select(*keys, "_cell", "_group", lo.alias("_lo"), hi.alias("_hi")))
    answer = types.StructType([*(spans.schema[c] for c in (*keys, "_lo", "_hi")), t.schema["_group"], types.StructField("distance", types.DoubleType())])
    pairs = asked.select(*keys, "_cell", "_lo", "_hi").groupBy(*keys, "_cell").cogroup(known.groupBy(*keys, "_cell"))
    here = pairs.applyInPandas(_tables(keys, k), answer)
    between = _runs(spans).join(_smallest_of_runs(touched, keys, k).hint("shuffle_hash"), [*keys, "_level", "_cell"])
    between = between.select(*keys, "_lo", "_hi", F.explode("_groups").alias("_group"), F.lit(0.0).alias("distance"))
    found = here.unionAll(between).groupBy(*keys, "_lo", "_hi", "_group").agg(F.min("distance").alias("distance"))
    best = top_k(found, [*keys, "_lo", "_hi"], [F.col("distance"), F.col("_group")], k)
    best = save(best.groupBy(*keys, "_lo", "_hi").agg(F.collect_list(F.struct("_group", "distance")).alias("_best")), "nearest-best")
    # Dealt by query first: where the answers are few and broadcast, rows stay in their tasks from here on.
    near = small(best)
    q = q if near is best else q.repartition(*keys, "_id")
    rows = q.join(near, [*keys, "_lo", "_hi"]).select(*keys, "_id", F.inline("_best"))
    best = top_k(rows.groupBy(*keys, "_id", "_group").agg(F.min("distance").alias("distance")), [*keys, "_id"], [F.col("distance"), F.col("_group")], k)
    return best.withColumnsRenamed({"_id": query, "_group": group})


def _tables(keys: Sequence[str], k: int):
    def run(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        parts = list(_nearest(asked, known, k)) if len(asked) and len(known) else []
        found = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({c: pd.Series([], dtype=object) for c in ("_lo", "_hi", "_group", "distance")})
        return _keyed(found, asked, keys, ["_lo", "_hi", "_group", "distance"])

    return run


def _nearest(asked: pd.DataFrame, known: pd.DataFrame, k: int) -> Iterator[pd.DataFrame]:
    """The k nearest groups of each span, a table of at most TABLE distances at a time."""
    known = known.sort_values("_group", kind="stable")
    group = known["_group"].to_numpy()
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    lo, hi = known["_lo"].to_numpy(), known["_hi"].to_numpy()
    step = max(1, TABLE // len(known))
    for i in range(0, len(asked), step):
        some = asked.iloc[i : i + step]
        gap = np.maximum(np.maximum(lo[None] - some["_hi"].to_numpy()[:, None], some["_lo"].to_numpy()[:, None] - hi[None]), 0.0)
        gap = np.minimum.reduceat(gap, first, axis=1)
        order = np.argsort(gap, axis=1, kind="stable")[:, :k]
        held = {c: some[c].to_numpy().repeat(order.shape[1]) for c in ("_lo", "_hi")}
        yield pd.DataFrame({**held, "_group": group[first][order.ravel()], "distance": np.take_along_axis(gap, order, 1).ravel()})
