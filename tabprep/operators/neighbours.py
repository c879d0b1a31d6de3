"""Exact k-nearest-neighbour join over donor spaces that spread across tasks.

A *space* is a set of donors compared with queries on the same coordinates. Each space is cut into boxes at the
medians of a bounded donor sample, so dense regions get more boxes. Round one looks in the query's own box and gives
a radius; round two looks in every other box the ball of that radius touches. The result is exact for any sample: the
sample only decides how even the boxes are. Donors and queries of a busy box are cut into chunks, so a task holds a
bounded number of rows and returns k rows per query, never the pairs.

The two-round scheme follows the published partition-based kNN joins (Lu et al., VLDB 2012).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.session import materialise

BOX_DONORS = 2_048        # donors aimed at per box
CHUNK_BOXES = 8           # one task gets up to this many boxes' donors at a time
CHUNK_QUERIES = 16_384    # queries one task gets at a time
ONE_BOX = 50              # a space of up to this many full boxes of distances is searched in one round
MAX_BOXES = 65_536        # of all spaces together; the tables sent to tasks and the sample stay this small
SAMPLE_PER_BOX = 32
MATRIX_CELLS = 500_000    # distance cells held at once inside a task; a block that stays in the processor's cache


@dataclass(frozen=True)
class Boxes:
    """Median splits of one space as a binary tree in heap order: node n has children 2n and 2n + 1."""

    axis: np.ndarray
    cut: np.ndarray

    @classmethod
    def build(cls, sample: np.ndarray, depth: int, least: int) -> Boxes:
        axis = np.full(1 << (depth + 1), -1, dtype=np.int64)
        cut = np.zeros(1 << (depth + 1))
        level = {1: sample}
        for _ in range(depth):
            below = {}
            for node, points in level.items():
                spread = points.max(axis=0) - points.min(axis=0) if len(points) else np.zeros(1)
                widest = int(spread.argmax())
                if spread[widest] <= 0:
                    continue
                at = float(np.median(points[:, widest]))
                right = points[:, widest] > at
                if right.sum() < least or (~right).sum() < least:
                    continue
                axis[node], cut[node] = widest, at
                below[2 * node], below[2 * node + 1] = points[~right], points[right]
            level = below
        return cls(axis, cut)

    def locate(self, points: np.ndarray) -> np.ndarray:
        """Box of each point."""
        node = np.ones(len(points), dtype=np.int64)
        while True:
            axis = self.axis[node]
            inner = np.flatnonzero(axis >= 0)
            if not len(inner):
                return node
            goes_right = points[inner, axis[inner]] > self.cut[node[inner]]
            node[inner] = 2 * node[inner] + goes_right

    def touched(self, points: np.ndarray, square_radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query row, box) for every box that meets the query's ball."""
        row = np.arange(len(points))
        node = np.ones(len(points), dtype=np.int64)
        gap = np.zeros_like(points)
        rows, boxes = [], []
        while len(row):
            axis = self.axis[node]
            leaf = axis < 0
            rows.append(row[leaf])
            boxes.append(node[leaf])
            row, node, gap, axis = row[~leaf], node[~leaf], gap[~leaf], axis[~leaf]
            offset = points[row, axis] - self.cut[node]
            at = np.arange(len(row))
            sides = []
            for right in (0, 1):
                reach = gap.copy()
                outside = offset <= 0 if right else offset > 0
                reach[at[outside], axis[outside]] = np.abs(offset[outside])
                keep = (reach ** 2).sum(axis=1) <= square_radius[row]
                sides.append((row[keep], 2 * node[keep] + right, reach[keep]))
            row, node, gap = (np.concatenate(parts) for parts in zip(*sides))
        return np.concatenate(rows), np.concatenate(boxes)


def _nearest_in_chunk(donors: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, donor row, squared distance) of the k nearest donors; donors come in tie order."""
    step = max(1, MATRIX_CELLS // max(1, len(donors)))
    out = []
    for start in range(0, len(queries), step):
        block = queries[start:start + step]
        square = np.zeros((len(block), len(donors)))
        for j in range(donors.shape[1]):
            offset = np.subtract.outer(block[:, j], donors[:, j])
            offset *= offset
            square += offset
        if len(donors) > k:
            bound = np.partition(square, k - 1, axis=1)[:, k - 1]
            q, d = np.nonzero(square <= bound[:, None])
        else:
            q, d = np.nonzero(np.ones_like(square, dtype=bool))
        value = square[q, d]
        order = np.lexsort((d, value, q))
        q, d, value = q[order], d[order], value[order]
        starts = np.searchsorted(q, np.arange(len(block)))
        keep = np.arange(len(q)) - starts[q] < k
        out.append((q[keep] + start, d[keep], value[keep]))
    return tuple(np.concatenate(part) for part in zip(*out))


def nearest(
    donors: DataFrame,
    queries: DataFrame,
    donor_axes: Sequence[str],
    query_axes: Sequence[str],
    used: dict[str, Sequence[int]],
    donor_rows: dict[str, int],
    query_rows: dict[str, int],
    k: int,
    key: str,
    box_donors: int = BOX_DONORS,
    chunk_queries: int = CHUNK_QUERIES,
) -> DataFrame:
    """The k nearest donors of each query within its space, nearest first by (distance, key).

    `donors`: space, donor_axes, key. `queries`: space, query_axes, which also identify a query. `used` gives the axis
    positions compared in each space; the other axes just come along. `donor_rows` and `query_rows` are estimates that
    only steer how finely the work is cut. Returns space, query_axes, key, donor_axes and `square` = squared distance.
    """
    # Cutting a space pays when the distances to all its donors would cost more than the second round.
    large = {s for s, n in donor_rows.items() if n > 2 * box_donors and n * query_rows[s] > ONE_BOX * box_donors ** 2}
    trees = _plan_boxes(donors, donor_axes, used, donor_rows, large, k, key, box_donors)
    # Plain arrays, so that unpickling needs nothing but numpy.
    plain = {s: (t.axis, t.cut) for s, t in trees.items()}
    shared = donors.sparkSession.sparkContext.broadcast((plain, used))
    search = _Search(list(donor_axes), list(query_axes), used, k, key)
    identity, chunk_donors = list(query_axes), CHUNK_BOXES * box_donors

    if not any((t.axis >= 0).any() for t in trees.values()):
        chunks = _per_space({s: -(-n // chunk_donors) for s, n in donor_rows.items()})
        parts = _per_space({s: -(-n // chunk_queries) for s, n in query_rows.items()})
        found = search.run(
            donors.withColumns({"box": F.lit(1), "chunks": chunks, "parts": parts}),
            queries.withColumns({"box": F.lit(1), "chunks": chunks, "parts": parts}),
        )
        return _top(found, identity, k, key)

    donors = materialise(_located(donors, donor_axes, shared))
    queries = materialise(_located(queries, query_axes, shared))
    # One row per box: at most MAX_BOXES.
    chunks = F.broadcast(_pieces(donors, "chunks", chunk_donors))

    def round_of(wanted: DataFrame) -> DataFrame:
        parts = F.broadcast(_pieces(wanted, "parts", chunk_queries))
        place = ["space", "box"]
        return search.run(donors.join(chunks, place).join(parts, place), wanted.join(chunks, place).join(parts, place))

    first = materialise(_top(round_of(queries), identity, k, key))
    # kth distance found so far; fewer than k donors in the own box leave the radius open.
    radius = first.groupBy("space", *identity).agg(
        F.when(F.count(F.lit(1)) >= k, F.max("square")).otherwise(F.lit(float("inf"))).alias("radius")
    )
    names = {c: f"r__{c}" for c in ["space", *identity]}
    on = [F.col(c).eqNullSafe(F.col(r)) for c, r in names.items()]
    reach = queries.join(radius.withColumnsRenamed(names), on, "left").drop(*names.values())
    reach = reach.withColumn("radius", F.coalesce("radius", F.lit(float("inf"))))
    second = round_of(materialise(_spread(reach, query_axes, shared)))
    return _top(first.unionByName(second), identity, k, key)


def _per_space(counts: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for s, n in counts.items() for x in (s, max(1, n))])[F.col("space")]


def _pieces(df: DataFrame, name: str, rows: int) -> DataFrame:
    """(space, box, pieces): into how many pieces the rows of a box are cut."""
    counts = df.groupBy("space", "box").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("space", "box", F.ceil(F.col("n") / F.lit(rows)).cast("int").alias(name))


def _plan_boxes(donors, axes, used, donor_rows, large, k, key, box_donors) -> dict[str, Boxes]:
    deepest = int(np.log2(max(1, MAX_BOXES // max(1, len(large)))))
    depth = {
        s: min(int(np.ceil(np.log2(n / box_donors))), deepest) if s in large else 0 for s, n in donor_rows.items()
    }
    sample: dict[str, np.ndarray] = {}
    wanted = {s: (1 << d) * max(SAMPLE_PER_BOX, 2 * k) for s, d in depth.items() if d > 0}
    if wanted:
        # Every m-th donor by hash; about SAMPLE_PER_BOX points per box reach the driver, however large the space.
        rate = F.lit(0)
        for s, n in wanted.items():
            rate = F.when(F.col("space") == s, F.lit(max(1, donor_rows[s] // n))).otherwise(rate)
        picked = donors.where(F.col("space").isin(list(wanted))).where(F.pmod(F.xxhash64(key, "space"), rate) == 0)
        rows = picked.select("space", *axes).toPandas()
        for s, part in rows.groupby("space"):
            sample[s] = part[[axes[j] for j in used[s]]].to_numpy(dtype=float)
    trees = {}
    for s in donor_rows:
        points = sample.get(s, np.zeros((0, len(used[s]))))
        trees[s] = Boxes.build(points, depth[s], max(k, 1))
    return trees


def _located(df: DataFrame, axes: Sequence[str], shared) -> DataFrame:
    @F.pandas_udf("int")
    def box(space: pd.Series, points: pd.DataFrame) -> pd.Series:
        trees, columns = shared.value
        out = np.ones(len(space), dtype=np.int32)
        values = points.to_numpy(dtype=float)
        for s, at in space.groupby(space).indices.items():
            out[at] = Boxes(*trees[s]).locate(values[at][:, columns[s]])
        return pd.Series(out)

    return df.withColumn("box", box("space", F.struct(*axes)))


def _spread(reach: DataFrame, axes: Sequence[str], shared) -> DataFrame:
    """One row per (query, other box its ball touches)."""
    @F.pandas_udf("array<int>")
    def boxes(space: pd.Series, points: pd.DataFrame, radius: pd.Series, own: pd.Series) -> pd.Series:
        trees, columns = shared.value
        values, square = points.to_numpy(dtype=float), radius.to_numpy(dtype=float) * (1 + 1e-9)
        out = np.empty(len(space), dtype=object)
        for s, at in space.groupby(space).indices.items():
            rows, found = Boxes(*trees[s]).touched(values[at][:, columns[s]], square[at])
            order = np.argsort(rows, kind="stable")
            parts = np.split(found[order], np.searchsorted(rows[order], np.arange(1, len(at))))
            for i, part in zip(at, parts):
                out[i] = part[part != own.iloc[i]].astype(np.int32)
        return pd.Series(out)

    spread = reach.withColumn("boxes", boxes("space", F.struct(*axes), "radius", "box"))
    return spread.select("space", *axes, F.explode("boxes").alias("box"))


@dataclass(frozen=True)
class _Search:
    """One round: donors and queries meet box by box, every donor chunk seeing every query part of its box once."""

    donor_axes: list[str]
    query_axes: list[str]
    used: dict[str, Sequence[int]]
    k: int
    key: str

    def run(self, donors: DataFrame, queries: DataFrame) -> DataFrame:
        """Both sides carry `chunks` and `parts`. Hashing cuts evenly whatever the keys and points are."""
        group = ["space", "box", "chunk", "part"]

        def own(column: Column, of: str) -> Column:
            return F.pmod(column, F.col(of)).cast("int")

        def all_of(of: str) -> Column:
            return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

        left = donors.withColumn("chunk", own(F.xxhash64(self.key), "chunks")).withColumn("part", all_of("parts"))
        right = queries.withColumn("part", own(F.xxhash64(*self.query_axes), "parts"))
        right = right.withColumn("chunk", all_of("chunks"))
        # The work is in the distances, not the bytes, so the tasks must not be merged by their small input size.
        spark = donors.sparkSession
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
        left = left.select(*group, self.key, *self.donor_axes).repartition(tasks, *group)
        right = right.select(*group, *self.query_axes).repartition(tasks, *group)
        kinds = {f.name: f.dataType.simpleString() for f in [*right.schema.fields, *left.schema.fields]}
        out = ["space", *self.query_axes, self.key, *self.donor_axes]
        schema = ", ".join([f"`{c}` {kinds[c]}" for c in out] + ["square double"])
        return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(self._task(out), schema)

    def _task(self, out: list[str]):
        donor_axes, query_axes, used, k, key = self.donor_axes, self.query_axes, self.used, self.k, self.key

        def find(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty or right.empty:
                return pd.DataFrame(columns=[*out, "square"])
            at = list(used[right["space"].iloc[0]])
            left = left.sort_values(key, kind="stable")
            q, d, square = _nearest_in_chunk(
                left[donor_axes].to_numpy(dtype=float)[:, at], right[query_axes].to_numpy(dtype=float)[:, at], k
            )
            found = right[["space", *query_axes]].iloc[q].reset_index(drop=True)
            picked = left[[key, *donor_axes]].iloc[d].reset_index(drop=True)
            return pd.concat([found, picked], axis=1).assign(square=square)

        return find


def _top(found: DataFrame, identity: Sequence[str], k: int, key: str) -> DataFrame:
    ranked = Window.partitionBy("space", *identity).orderBy("square", key)
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).drop("rank")
