"""Exact k nearest donors for every missing cell of every query, on the coordinates both rows know.

Distance is sqrt(square * width / shared): the squared differences over the shared coordinates, scaled to all of them. Rows
with any pattern of known cells lie in one space, so the work is the same for one pattern and for as many as there are rows.

A tree with three-way splits cuts the space into boxes: an axis at the median of a bounded sample, and a box of its own for
donors that do not know the axis. Round one looks in the query's own box and gives each missing cell a radius; round two looks
in every other box that the radius touches. A box's lower bound spreads the gaps of its split axes over all coordinates that
query and box can share, which never exceeds the distance to any donor inside, so the answer is exact for any sample.

Two steps keep the work near the size of the input. Nothing is nearer than distance zero and ties go to the smaller key, so a
query whose missing cells all have k donors at distance zero among the donors with the smallest keys is settled by look-ups
there (`zero_distance`). A shared tree prunes nothing at the splits of axes that a query does not know. So of the others, every
pattern of known cells that would look in many boxes of it is searched by a tree of its own, which splits only axes that its
queries know: donors that share the same coordinates with them then lie in the same boxes.

Donors and queries of a box meet in chunks of bounded size. A chunk's distances are one matrix product of known values,
squares and masks; what may be among the k nearest of a cell is computed again coordinate by coordinate, so rounding decides
nothing, and k rows per missing cell leave a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.operators.neighbours import BOX_DONORS, CHUNK_BOXES, CHUNK_QUERIES, ONE_BOX, SAMPLE_PER_BOX
from tabprep.session import materialise, run_together

MAX_BOXES = 16_384      # the tree sent to tasks and the sample stay this small
TILE_CELLS = 1_000_000  # distances held at once inside a task
FIRST_DONORS = 8, 64    # donors with the smallest keys that are sent to every task, in boxes, step by step
SETTLED_ENOUGH = 0.25   # share of the queries that a step must settle for the next to follow
PATTERNS = 16           # patterns of known cells searched by trees of their own
TOGETHER = 8            # trees searched at once: one's planning and last tasks overlap with another's distances
COUNTED_PATTERNS = 1_024  # frequent patterns of known cells whose cost in the shared tree is compared
WIDE_KNOWN = 4          # with up to this many known cells round one looks in the query's box for every set of shared coordinates
LOOKUP_CELLS = 1_000_000  # donors looked up at once inside a task


@dataclass(frozen=True)
class GapTree:
    """Node n splits axis[n] at cut[n] (-1: a box); its children are low[n] (at most the cut), low[n] + 1 and low[n] + 2 (unknown)."""

    axis: np.ndarray
    cut: np.ndarray
    low: np.ndarray

    @classmethod
    def build(cls, sample: np.ndarray, boxes: int, least: int) -> GapTree:
        axis, cut, low = [-1], [0.0], [0]
        most = max(least, len(sample) // max(1, boxes))  # sampled donors left in a box
        open_ = [(0, sample)] if boxes > 1 else []
        while open_:
            node, points = open_.pop(0)
            if len(points) < 2 * most:
                continue
            known = ~np.isnan(points)
            # A wide axis prunes well, but only for donors that know it.
            with np.errstate(all="ignore"):
                spread = np.where(known.any(axis=0), np.nanmax(np.where(known, points, -np.inf), axis=0)
                                  - np.nanmin(np.where(known, points, np.inf), axis=0), 0) * known.mean(axis=0)
            for j in np.argsort(-spread, kind="stable"):
                if not spread[j] > 0:
                    break
                values = points[known[:, j], j]
                at = float(np.median(values))
                if min((values > at).sum(), (values <= at).sum()) < least:
                    continue
                axis[node], cut[node], low[node] = int(j), at, len(axis)
                axis += [-1] * 3
                cut += [0.0] * 3
                low += [0] * 3
                with np.errstate(invalid="ignore"):
                    parts = points[points[:, j] <= at], points[points[:, j] > at], points[~known[:, j]]
                open_ += [(low[node] + n, part) for n, part in enumerate(parts)]
                break
        return cls(np.array(axis), np.array(cut), np.array(low))

    @property
    def boxes(self) -> int:
        return int((self.axis < 0).sum())

    def reached(self, known: Sequence[bool]) -> float:
        """Boxes that a query of these known axes looks in at a radius of zero, when cuts halve the queries."""
        reach = np.zeros(len(self.axis))
        reach[0] = 1
        for node in np.flatnonzero(self.axis >= 0):
            low, share = self.low[node], 0.5 if known[self.axis[node]] else 1
            reach[low:low + 3] = reach[node] * np.array([share, share, 1])
        return float(reach[self.axis < 0].sum())

    def locate(self, points: np.ndarray, donors: bool) -> np.ndarray:
        """Box of each point. A query that does not know an axis looks for donors that do, in the lower box."""
        node = np.zeros(len(points), np.int64)
        while True:
            inner = np.flatnonzero(self.axis[node] >= 0)
            if not len(inner):
                return node
            value = points[inner, self.axis[node[inner]]]
            with np.errstate(invalid="ignore"):
                side = np.where(np.isnan(value), 2 if donors else 0, value > self.cut[node[inner]])
            node[inner] = self.low[node[inner]] + side.astype(np.int64)

    def touched(self, points: np.ndarray, square_radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query row, box) for every box whose lower bound does not exceed the query's radius."""
        return self.bounded(points, square_radius)[:2]

    def bounded(self, points: np.ndarray, square_radius: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, box, squared lower bound) for every box whose lower bound does not exceed the query's radius."""
        width = points.shape[1]
        row, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        gap = np.where(np.isnan(points), np.nan, 0.0)  # per coordinate that may be shared, NaN for the others
        least = np.zeros(len(points))
        rows, boxes, bounds = [], [], []
        while len(row):
            leaf = self.axis[node] < 0
            rows.append(row[leaf])
            boxes.append(node[leaf])
            bounds.append(least[leaf])
            row, node, gap = row[~leaf], node[~leaf], gap[~leaf]
            axis, at = self.axis[node], np.arange(len(row))
            offset = points[row, axis] - self.cut[node]
            sides = []
            for side in (0, 1, 2):
                reach = gap.copy()
                if side == 2:
                    reach[at, axis] = np.nan
                else:
                    with np.errstate(invalid="ignore"):
                        outside = offset <= 0 if side else offset > 0
                    reach[at[outside], axis[outside]] = np.abs(offset[outside])
                possible = (~np.isnan(reach)).sum(axis=1)
                bound = np.nansum(reach ** 2, axis=1) * width / np.maximum(possible, 1)
                keep = (possible > 0) & (bound <= square_radius[row])
                sides.append((row[keep], self.low[node[keep]] + side, reach[keep], bound[keep]))
            row, node, gap, least = (np.concatenate(parts) for parts in zip(*sides))
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return np.concatenate(rows), np.concatenate(boxes), np.concatenate(bounds)


def nearest_per_cell(donors: np.ndarray, queries: np.ndarray, k: int, square_radius: np.ndarray | None = None):
    """(query row, missing column, donor row, distance): the k nearest donors of each missing cell; donors in tie order.

    With radii, donors beyond a query's radius may be left out.
    """
    width = donors.shape[1]
    known = ~np.isnan(donors)
    centre = np.where(known.any(axis=0), np.nansum(donors, axis=0) / np.maximum(known.sum(axis=0), 1), 0)
    d = np.where(known, donors - centre, 0)
    right = np.concatenate([known, d ** 2, d], axis=1).T
    known_t = known.T.astype(float)
    largest = float((d ** 2).sum(axis=1).max(initial=0))
    out = []
    step = max(1, TILE_CELLS // max(1, len(donors)))
    for begin in range(0, len(queries), step):
        block = queries[begin:begin + step]
        has = ~np.isnan(block)
        q = np.where(has, block - centre, 0)
        shared = has.astype(float) @ known_t
        with np.errstate(divide="ignore", invalid="ignore"):
            square = (np.concatenate([q ** 2, has, -2 * q], axis=1) @ right) * (width / shared)
        square[shared == 0] = np.inf
        # How far the product may be off.
        noise = 1e-12 * width * ((q ** 2).sum(axis=1) + largest + 1e-300)
        if square_radius is not None:
            limit = square_radius[begin:begin + step] * (1 + 1e-9) + noise
        for j in np.flatnonzero(~has.all(axis=0)):
            asking, able = np.flatnonzero(~has[:, j]), np.flatnonzero(known[:, j])
            if not len(able):
                continue
            part = square[np.ix_(asking, able)]
            if square_radius is None or not np.isfinite(limit[asking]).all():
                bound = np.partition(part, k - 1, axis=1)[:, k - 1] + noise[asking] if len(able) > k else np.full(len(asking), np.inf)
                bound = bound if square_radius is None else np.minimum(bound, limit[asking])
            else:
                bound = limit[asking]
            row, col = np.nonzero((part <= bound[:, None]) & np.isfinite(part))
            row, col = asking[row], able[col]
            both = shared[row, col]
            exact = np.zeros(len(row))
            for c in range(width):
                exact += np.where(has[row, c] & known[col, c], (donors[col, c] - block[row, c]) ** 2, 0)
            distance = np.sqrt(exact * (width / both))
            order = np.lexsort((col, distance, row))
            row, col, distance = row[order], col[order], distance[order]
            keep = np.arange(len(row)) - np.searchsorted(row, row) < k
            out.append((row[keep] + begin, np.full(int(keep.sum()), j), col[keep], distance[keep]))
    if not out:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, float))
    return tuple(np.concatenate(parts) for parts in zip(*out))


def _marks(values: np.ndarray) -> np.ndarray:
    """One word per known value, 0 for an unknown one: sums of them tell points apart, whatever coordinates are summed."""
    known = ~np.isnan(values)
    word = (np.where(known, values, 0) + 0.0).view(np.uint64) + np.arange(1, values.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        word = (word ^ (word >> np.uint64(shift))) * np.uint64(factor)
    return np.where(known, word ^ (word >> np.uint64(31)), np.uint64(0))


def zero_distance(donors: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, missing column, donor row) of the first k donors at distance zero, for queries that have k for every missing cell.

    Donors come in tie order. Queries with the same known cells share one order of the donors by what both know; a query is
    looked up once per set of coordinates that some donor shares with it.
    """
    width = donors.shape[1]
    bit = np.left_shift(np.int64(1), np.arange(width))
    known = ~np.isnan(donors)
    donor_mask, query_mask = known @ bit, ~np.isnan(queries) @ bit
    donor_marks, query_marks = _marks(donors), _marks(queries)
    out = []
    for pattern in np.unique(query_mask):
        asking = np.flatnonzero(query_mask == pattern)
        has = (pattern & bit) != 0
        shared = donor_mask & pattern
        able = np.flatnonzero((shared != 0) & (donor_mask != shared))
        # The set of shared coordinates is part of the mark.
        marks = donor_marks[:, has].sum(axis=1, dtype=np.uint64)[able] + _marks(shared[able, None].astype(float))[:, 0]
        order = np.argsort(marks, kind="stable")
        marks, able = marks[order], able[order]
        sets = np.unique(shared[able])
        if not len(sets):
            continue
        salt = _marks(sets[:, None].astype(float))[:, 0]
        member = ((sets[:, None] & bit) != 0).astype(np.uint64).T
        missing = np.flatnonzero(~has)
        per_cell = []
        for j in missing:
            mine = known[able, j]
            per_cell.append((np.append(marks[mine], np.zeros(k, np.uint64)), np.append(able[mine], np.full(k, len(donors)))))
        step = max(1, LOOKUP_CELLS // (len(sets) * k))
        for begin in range(0, len(asking), step):
            rows = asking[begin:begin + step]
            wanted = query_marks[rows] @ member + salt
            alive = np.ones(len(rows), bool)
            chosen = np.empty((len(rows), len(missing), k), np.int64)
            for n, (sorted_marks, place) in enumerate(per_cell):
                at = np.flatnonzero(alive)
                start = np.searchsorted(sorted_marks[:-k], wanted[at])[..., None] + np.arange(k)
                met = np.where(sorted_marks[start] == wanted[at][..., None], place[start], len(donors)).reshape(len(at), len(sets) * k)
                first = np.sort(np.partition(met, k - 1, axis=1)[:, :k], axis=1)
                found = first[:, -1] < len(donors)
                # Equal marks are not yet equal values.
                with np.errstate(invalid="ignore"):
                    gap = donors[first[found]] - queries[rows[at[found]]][:, None, :]
                equal = ((gap == 0) | ~(known[first[found]] & has)).all(axis=(1, 2))
                found[found] = equal
                chosen[at, n] = first
                alive[at[~found]] = False
            settled = np.flatnonzero(alive)
            out.append((np.repeat(rows[settled], len(missing) * k), np.tile(np.repeat(missing, k), len(settled)), chosen[settled].ravel()))
    if not out:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(parts) for parts in zip(*out))


def nearest_for_gaps(
    donors: DataFrame, queries: DataFrame, axes: Sequence[str], key: str, query: str, n_donors: int, n_queries: int, k: int,
    box_donors: int = BOX_DONORS, chunk_queries: int = CHUNK_QUERIES,
) -> DataFrame:
    """(query, cell, key, distance, value): the k nearest donors of every missing cell, ties by key.

    `donors`: key and axes. `queries`: a unique number `query` and axes. `cell` is an axis position, `value` what the donor has
    there. The row counts only steer how finely the work is cut. Cells without any donor give no rows.
    """
    axes = list(axes)
    search = _GapSearch(axes, key, query, k)
    if not _pays(n_donors, n_queries, box_donors):
        return _near(search, donors, queries, n_donors, n_queries, box_donors, chunk_queries)
    donors = materialise(donors.select(key, *axes))
    queries = queries.select(query, *axes)
    done = []
    for boxes in FIRST_DONORS:
        first = _first_by_key(donors, axes, key, n_donors, boxes * box_donors)
        if first is None:
            break
        looked = materialise(_settled(queries, axes, key, query, k, first, dict(donors.dtypes)[key]))
        done.append(looked.where("near IS NOT NULL").select(query, F.inline("near")))
        queries, before = looked.where("near IS NULL").drop("near"), n_queries
        n_queries = queries.count()
        if not n_queries or before - n_queries < SETTLED_ENOUGH * before or boxes * box_donors >= n_donors:
            break

    runs = []
    if n_queries:
        pattern = sum((F.col(a).isNotNull().cast("bigint") * F.lit(1 << j) for j, a in enumerate(axes[:62])), F.lit(0).cast("bigint"))
        tree, counted = run_together(
            donors.sparkSession,
            lambda: _plan(donors, axes, key, n_donors, n_queries, k, box_donors, None),
            lambda: queries.groupBy(pattern.alias("p")).count().orderBy(F.col("count").desc(), "p").limit(COUNTED_PATTERNS).collect())
        # Beyond 62 axes the pattern does not name all of them: one tree for all.
        frequent = counted if len(axes) <= 62 and tree.boxes > 1 else []
        # What counts is how many queries look at all donors, so few queries weigh much when they know few axes.
        every = (1 << len(axes)) - 1
        cost = {r["p"]: r["count"] * tree.reached([r["p"] >> j & 1 for j in range(len(axes))]) / tree.boxes
                for r in frequent if 0 < r["p"] < every}
        # A tree of its own costs a pass over the donors.
        own = {r["p"]: r["count"] for r in sorted(frequent, key=lambda r: -cost.get(r["p"], 0))[:PATTERNS]
               if cost.get(r["p"], 0) >= max(1, chunk_queries // 32)}
        for p, n in own.items():
            inside = [a for j, a in enumerate(axes) if p >> j & 1]
            outside = [a for a in axes if a not in inside]
            able = donors.where(F.coalesce(*inside).isNotNull() & F.coalesce(*outside).isNotNull())
            asked = queries.where(pattern == p)
            runs.append(lambda able=able, asked=asked, n=n, inside=inside: _near(
                search, able, asked, n_donors, n, box_donors, chunk_queries, inside))
        rest = n_queries - sum(own.values())
        if rest:
            asked = queries.where(~pattern.isin(list(own))) if own else queries
            runs.append(lambda: _near(search, donors, asked, n_donors, rest, box_donors, chunk_queries, None, tree))
    for begin in range(0, len(runs), TOGETHER):
        done += run_together(donors.sparkSession, *runs[begin:begin + TOGETHER])
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _near(search: _GapSearch, donors, queries, n_donors, n_queries, box_donors, chunk_queries, known: Sequence[str] | None = None,
          tree: GapTree | None = None) -> DataFrame:
    """The search by boxes. `known`: axes that every query knows, and no other; only they are split. `tree`: planned before."""
    axes, key, query, k = search.axes, search.key, search.query, search.k
    if tree is None or not _pays(n_donors, n_queries, box_donors):
        tree = _plan(donors, axes, key, n_donors, n_queries, k, box_donors, known)
    if tree.boxes == 1:
        # Every chunk of donors sees every part of the queries once.
        pieces = {"chunks": max(1, -(-n_donors // (CHUNK_BOXES * box_donors))), "parts": max(1, -(-n_queries // chunk_queries))}
        cut = {"box": F.lit(0), **{c: F.lit(n) for c, n in pieces.items()}}
        return _first_k(search.run(donors.withColumns(cut), queries.withColumns(cut), None), query, key, k)

    shared = donors.sparkSession.sparkContext.broadcast((tree.axis, tree.cut, tree.low))
    donors = materialise(_located(donors, axes, shared, True))
    wide = known is not None and len(known) <= WIDE_KNOWN
    # One row per box: at most MAX_BOXES and the boxes of what is unknown beside them.
    chunks = F.broadcast(_pieces(donors, "chunks", CHUNK_BOXES * box_donors))

    def round_of(wanted: DataFrame, radius: str | None) -> DataFrame:
        parts = F.broadcast(_pieces(wanted, "parts", chunk_queries))
        return search.run(donors.join(chunks, "box").join(parts, "box"), wanted.join(chunks, "box").join(parts, "box"), radius)

    if wide:
        asked = queries.withColumns({"radius": F.lit(0.0), "box": F.lit(-1).cast("bigint")})
        first = round_of(materialise(_spread(asked, axes, query, shared, False).drop("radius")), None)
        queries = queries.withColumn("box", F.lit(-1).cast("bigint"))
    else:
        queries = materialise(_located(queries, axes, shared, False))
        first = round_of(queries, None)
    first = materialise(_first_k(first, query, key, k))
    # The largest kth distance of the query's missing cells; a cell with fewer than k donors so far leaves it open.
    per_cell = first.groupBy(query, "cell").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far"))
    missing = sum((F.col(a).isNull().cast("int") for a in axes), F.lit(0))
    radius = per_cell.groupBy(F.col(query).alias("r__query")).agg(F.count_if(F.col("n") >= k).alias("full"), F.max("far").alias("far"))
    reach = queries.join(radius, F.col(query) == F.col("r__query"), "left").withColumn(
        "radius", F.when(F.col("full") >= missing, F.col("far") * F.col("far")).otherwise(F.lit(float("inf"))))
    second = round_of(materialise(_spread(reach.drop("r__query", "full", "far"), axes, query, shared, wide)), "radius")
    return _first_k(first.unionByName(second), query, key, k)


def _pays(n_donors: int, n_queries: int, box_donors: int) -> bool:
    """Cutting pays when the distances to all donors would cost more than a second round."""
    return n_donors > 2 * box_donors and n_donors * n_queries > ONE_BOX * box_donors ** 2


def _first_by_key(donors: DataFrame, axes, key: str, n_donors: int, rows: int) -> pa.Table | None:
    """About `rows` donors: all up to some key, in key order. None where too many share their key to be sent to tasks."""
    if len(axes) > 62:
        return None
    wanted = donors.select(key, *axes)
    if n_donors > rows:
        # A sample by hash says below which key they lie.
        rate = max(1, n_donors // (8 * SAMPLE_PER_BOX * -(-n_donors // rows)))
        picked = donors.where(F.pmod(F.xxhash64(key, *axes), F.lit(rate)) == 0).select(key)
        below = picked.orderBy(key).limit(max(1, rows // rate)).agg(F.max(key)).first()[0]
        wanted = wanted.where(F.col(key).isNull() | (F.col(key) <= F.lit(below)))
    table = wanted.orderBy(key, *axes).limit(2 * rows + 1).toArrow()
    return None if table.num_rows > 2 * rows else table.combine_chunks()


def _settled(queries: DataFrame, axes: Sequence[str], key: str, query: str, k: int, first: pa.Table, kind: str) -> DataFrame:
    """Queries with `near`: the rows of the result where donors at distance zero settle all missing cells, else NULL."""
    from pyspark.sql.types import StructType

    shared = queries.sparkSession.sparkContext.broadcast((first.column(key).combine_chunks(), _matrix(first, axes)))
    fields = [pa.field("cell", pa.int32()), first.schema.field(key), pa.field("distance", pa.float64()), pa.field("value", pa.float64())]
    near = f"near array<struct<cell:int,`{key}`:{kind},distance:double,value:double>>"
    schema = StructType([*queries.schema.fields, *StructType.fromDDL(near).fields])

    def look(part: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        keys, donors = shared.value
        table = pa.Table.from_batches(part).combine_chunks()
        q, cell, d = zero_distance(donors, _matrix(table, axes), k)
        order = np.argsort(q, kind="stable")
        q, cell, d = q[order], cell[order], d[order]
        count = np.bincount(q, minlength=table.num_rows)
        ends = np.concatenate([[0], np.cumsum(count)])
        near = pa.StructArray.from_arrays(
            [pa.array(cell, pa.int32()), keys.take(pa.array(d)), pa.array(np.zeros(len(d))), pa.array(donors[d, cell])], fields=fields)
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), near, mask=pa.array(count == 0))
        return pa.table([*table.columns, lists], names=schema.names).to_batches(max_chunksize=CHUNK_QUERIES)

    def run(batches):
        # The donors are put in order once per pattern and piece of queries.
        part, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                part.append(batch)
                rows += batch.num_rows
            if rows >= 8 * CHUNK_QUERIES:
                yield from look(part)
                part, rows = [], 0
        if part:
            yield from look(part)

    spark = queries.sparkSession
    return queries.repartition(spark.sparkContext.defaultParallelism, query).mapInArrow(run, schema)


def _plan(donors, axes, key, n_donors, n_queries, k, box_donors, known) -> GapTree:
    boxes = min(MAX_BOXES, -(-n_donors // box_donors))
    if not _pays(n_donors, n_queries, box_donors):
        return GapTree.build(np.zeros((0, len(axes))), 1, 1)
    # Every m-th donor by hash: a bounded number per box, however many donors there are.
    rate = max(1, n_donors // (boxes * max(SAMPLE_PER_BOX, 2 * k)))
    picked = donors.where(F.pmod(F.xxhash64(key), F.lit(rate)) == 0).select(*axes)
    sample = picked.toPandas().to_numpy(dtype=float)
    if known is not None:
        sample[:, [j for j, a in enumerate(axes) if a not in known]] = np.nan
    return GapTree.build(sample, boxes, max(k, SAMPLE_PER_BOX // 4))


def _pieces(df: DataFrame, name: str, rows: int) -> DataFrame:
    return df.groupBy("box").agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).cast("int").alias(name))


def _matrix(table, axes: Sequence[str]) -> np.ndarray:
    return np.stack([table.column(a).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table.column(a).to_numpy()
                     for a in axes], axis=1).astype(float)


def _located(df: DataFrame, axes: Sequence[str], shared, as_donors: bool) -> DataFrame:
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([*df.schema.fields, StructField("box", LongType())])

    def run(batches):
        tree = GapTree(*shared.value)
        for batch in batches:
            box = tree.locate(_matrix(batch, axes), as_donors)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(box, pa.int64())], names=schema.names)

    return df.mapInArrow(run, schema)


def _spread(reach: DataFrame, axes: Sequence[str], query: str, shared, past_zero: bool) -> DataFrame:
    """One row per (query, other box that its radius touches); `past_zero` leaves out boxes that a radius of zero touches."""
    cols = [query, *axes, "radius", "box"]
    reach = reach.select(*cols)

    def run(batches):
        tree = GapTree(*shared.value)
        for batch in batches:
            square = batch.column("radius").to_numpy(zero_copy_only=False) * (1 + 1e-9)
            row, box, bound = tree.bounded(_matrix(batch, axes), square)
            own = bound <= 0 if past_zero else box == batch.column("box").to_numpy()[row]
            row, box = row[~own], box[~own]
            # Many boxes per query: hand them over in pieces.
            for begin in range(0, len(row), 100_000):
                part = batch.take(pa.array(row[begin:begin + 100_000]))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(box[begin:begin + 100_000], pa.int64())], names=cols)

    return reach.mapInArrow(run, reach.schema)


@dataclass(frozen=True)
class _GapSearch:
    """One round: donors and queries meet box by box, every donor chunk seeing every query part of its box once."""

    axes: list[str]
    key: str
    query: str
    k: int

    def run(self, donors: DataFrame, queries: DataFrame, radius: str | None) -> DataFrame:
        """Both sides carry box, chunks and parts."""
        def own(column: Column, of: str) -> Column:
            return F.pmod(column, F.col(of)).cast("int")

        def all_of(of: str) -> Column:
            return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

        left = donors.withColumn("chunk", own(F.xxhash64(self.key), "chunks")).withColumn("part", all_of("parts"))
        right = queries.withColumn("part", own(F.xxhash64(self.query), "parts")).withColumn("chunk", all_of("chunks"))
        # The work is in the distances, not the bytes, so the tasks must not be merged by their small input size.
        spark = donors.sparkSession
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
        group = ["box", "chunk", "part"]
        left = left.select(*group, self.key, *self.axes).repartition(tasks, *group)
        right = right.select(*group, self.query, *self.axes, *([radius] if radius else [])).repartition(tasks, *group)
        kind = dict(left.dtypes)[self.key]
        schema = f"`{self.query}` bigint, cell int, `{self.key}` {kind}, distance double, value double"
        return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(self._task(radius), schema)

    def _task(self, radius: str | None):
        axes, key, query, k = self.axes, self.key, self.query, self.k

        def find(left: pa.Table, right: pa.Table) -> pa.Table:
            left = left.take(pc.sort_indices(left.column(key)))
            donors, queries = _matrix(left, axes), _matrix(right, axes)
            limit = right.column(radius).to_numpy() if radius else None
            q, cell, d, distance = nearest_per_cell(donors, queries, k, limit)
            return pa.table({
                query: right.column(query).take(pa.array(q)), "cell": pa.array(cell, pa.int32()), key: left.column(key).take(pa.array(d)),
                "distance": pa.array(distance, pa.float64()), "value": pa.array(donors[d, cell], pa.float64()),
            })

        return find


def _first_k(found: DataFrame, query: str, key: str, k: int) -> DataFrame:
    ranked = Window.partitionBy(query, "cell").orderBy("distance", key)
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).drop("rank")
