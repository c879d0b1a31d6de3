"""Operator 13, approximate nearest neighbours by multi-index hashing of learned binary codes; nearness is the inner product.

Codes. Rotations are learned by iterative quantization on a bounded sample (`Search.sample` rows, `SAMPLE_VALUES` numbers):
each turns the vectors so that their signs lose least. As many rotations as `bits` asks for are stacked; a code is the signs
of the rotated vector. The sample also tells how far codes of true neighbours stray from the distance that their angle
predicts: `slack` standard deviations hold `Search.inside` of them.

Index. Every row is indexed. Equal vectors form one class, of which the k + 1 smallest ids are kept, so that copies cost
nothing further. Classes are dealt over slices of about `slice_rows` by the size of their norm and a hash. A slice cuts its
codes into substrings of `chunk` bits and keeps, per substring, a table from value to classes. A code within Hamming radius r
agrees with the query on some substring up to r // (number of substrings) bits (pigeonhole), so asking every table for the
values that near finds every code within r; the rest of the code is compared, and codes within r are ranked by the inner
product of the floats in double precision. Near values are listed by flipping bits or, where those are more than the table
holds, by comparing the table's values.

Search. A query starts in its own slice and widens its radius until the k-th best product found says that no wider radius is
needed: beyond bits * angle / pi + slack * deviation only the stated share of neighbours is missed. That product is the floor
with which all other slices are asked, in blocks of `block_rows` queries, each block and slice a task's group; a slice whose
norms cannot reach the floor is not searched. Tasks return what reaches the floor, k + 1 classes per query at most.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part, neither do vectors of
another length than the query's; a row without an id is a candidate, last among ties, never a query; rows with equal ids are
rows of their own, and each asks; fewer candidates than k give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.llm.text import quoted
from tabprep.session import materialise
from tabprep.sizing import hinted, lookup_table

SAMPLE_VALUES = 4_000_000  # numbers the sample may hold
LENGTHS = 8  # vector lengths for which rotations are learned, the most frequent; others get random directions
TURNS = 20  # of the rotation's fit
PROBES = 400  # rows of the sample whose neighbours show how far codes stray
WORTHWHILE = 256  # values worth a step
PROBE_COST = 8  # looking a value up costs as much as comparing with so many
NORM_STEPS = 4  # norm bands per doubling


KINDS = {8: np.uint8, 16: np.uint16, 32: np.uint32, 64: np.uint64}


@dataclass(frozen=True)
class Search:
    k: int = 20
    bits: int = 256
    chunk: int = 64
    sample: int = 20_000
    inside: float = 0.98
    slice_rows: int = 32_768
    block_rows: int = 4_096

    def __post_init__(self):
        if self.bits % 64 or self.chunk not in KINDS or self.k < 1:
            raise ValueError("bits must be a multiple of 64, chunks of 8, 16, 32 or 64 bits, k positive")


# Codes ------------------------------------------------------------------------------------------------------------------

def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def learn(x: np.ndarray, bits: int, seed: int = 13) -> np.ndarray:
    """Directions, one column per bit, from the rows of a sample."""
    rng, width = np.random.default_rng(seed), x.shape[1]
    basis = np.linalg.svd(x.T @ x)[0][:, :bits]
    y, parts = x @ basis, []
    while sum(p.shape[1] for p in parts) < bits:
        turn = np.linalg.qr(rng.normal(size=(y.shape[1], y.shape[1])))[0]
        for _ in range(TURNS):
            # The rotation that brings the vectors closest to their signs.
            u, _, v = np.linalg.svd(y.T @ np.where(y @ turn > 0, 1.0, -1.0))
            turn = u @ v
        parts.append(basis @ turn)
    return np.concatenate(parts, axis=1)[:, :bits] if width else np.zeros((0, bits))


def directions(width: int, bits: int) -> np.ndarray:
    """Random directions, the same in every task, for lengths of vectors that nothing was learned of."""
    return np.random.default_rng(width).normal(size=(width, bits))


def codes(x: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """One row of 64-bit words per vector."""
    return np.packbits(x @ turn > 0, axis=1).view(np.uint64)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def slack_of(x: np.ndarray, turn: np.ndarray, search: Search) -> float:
    """Deviations that hold `inside` of the sample's true neighbours, two at least."""
    if len(x) < 2:
        return 3.0
    code, k = codes(x, turn), min(search.k, len(x) - 1)
    stray = []
    for i in range(min(PROBES, len(x))):
        cosine = x @ x[i]
        cosine[i] = -2
        near = np.argpartition(-cosine, k - 1)[:k]
        p = np.arccos(np.clip(cosine[near], -1, 1)) / np.pi
        stray.append((apart(code[near], code[i]) - search.bits * p) / np.sqrt(search.bits * p * (1 - p) + 1))
    return max(2.0, float(np.quantile(np.concatenate(stray), search.inside)))


@lru_cache(maxsize=64)
def _flips(chunk: int, step: int) -> np.ndarray:
    """All values with `step` of `chunk` bits set."""
    return np.array([sum(1 << b for b in bits) for bits in combinations(range(chunk), step)], KINDS[chunk])


# The index of a slice ----------------------------------------------------------------------------------------------------

class Tables:
    """Codes of a slice by substring, with the vectors behind them."""

    def __init__(self, vectors: np.ndarray, code: np.ndarray, weight: np.ndarray, search: Search, slack: float):
        self.x, self.code, self.weight, self.search, self.slack = vectors, code, weight, search, slack
        norm = np.linalg.norm(vectors, axis=1)
        self.least, self.most = norm.min(), norm.max()
        self.kind = KINDS[search.chunk]
        parts = code.view(self.kind)
        self.parts = parts.shape[1]
        values, members, begin, self.table = [], [], [], [0]
        for t in range(self.parts):
            order = np.argsort(parts[:, t], kind="stable")
            value, start = np.unique(parts[order, t], return_index=True)
            values.append(value)
            members.append(order)
            begin.append(start + t * len(code))
            self.table.append(self.table[-1] + len(value))
        self.values, self.members = np.concatenate(values), np.concatenate(members)
        self.begin = np.r_[np.concatenate(begin), len(self.members)]

    def radius(self, floor: float, size: float) -> int:
        """Codes within it hold all but the stated share of the vectors whose product reaches `floor`; -1 where none can."""
        if floor == -math.inf:
            return self.search.bits
        cosine = floor / size / (self.most if floor >= 0 else self.least)
        if cosine > 1 + 1e-9:
            return -1
        p = math.acos(max(-1.0, min(1.0, cosine))) / math.pi
        return min(self.search.bits, int(self.search.bits * p + self.slack * math.sqrt(self.search.bits * p * (1 - p)) + 2))

    def search_one(self, q: np.ndarray, code: np.ndarray, floor: float, need: int) -> tuple[np.ndarray, np.ndarray]:
        """(members, products): those that reach the floor, `need` rows of them and their near ties."""
        size = float(np.linalg.norm(q))
        given = floor > -math.inf
        limit = self.radius(floor, size)
        seen = np.zeros(len(self.code), bool)
        found, product = np.empty(0, np.int64), np.empty(0)
        waiting, distance = np.empty(0, np.int64), np.empty(0, np.int64)  # met, but beyond the radius so far
        shells = self._shells(code.view(self.kind))
        # With a floor the radius is known, and all its values are asked at once.
        step = min(self.search.chunk, limit // self.parts) if given else 0
        while limit >= 0:
            place, step = shells(step, given)
            count = self.begin[place + 1] - self.begin[place]
            member = self.members[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - self.begin[place], count)]
            fresh = np.zeros(len(seen), bool)
            fresh[member] = True
            fresh = np.flatnonzero(fresh & ~seen)
            seen[fresh] = True
            waiting, distance = np.r_[waiting, fresh], np.r_[distance, apart(self.code[fresh], code)]
            whole = min(limit, (step + 1) * self.parts - 1)  # every code within it has been met
            inside = distance <= whole
            new, waiting, distance = waiting[inside], waiting[~inside], distance[~inside]
            if len(new):
                found, product = np.r_[found, new], np.r_[product, self.x[new] @ q]
                keep, bar = self._best(found, product, need, size)
                found, product = found[keep], product[keep]
                if bar > floor:
                    floor = bar
                    limit = min(limit, self.radius(floor, size))
            if whole >= limit or step >= self.search.chunk:
                break
            step += 1
        keep = product >= floor - self._noise(size)
        return found[keep], product[keep]

    def _shells(self, chunks: np.ndarray):
        """Places of the values at distance `step` from the query's substrings, or up to it; and the distance reached."""
        ranked = cuts = None

        def at(step: int, upto: bool) -> tuple[np.ndarray, int]:
            nonlocal ranked, cuts
            if ranked is None and math.comb(self.search.chunk, step) * self.parts * PROBE_COST <= len(self.values) and not (upto and step):
                flips, places = _flips(self.search.chunk, step), []
                for t in range(self.parts):
                    values = self.values[self.table[t]:self.table[t + 1]]
                    wanted = chunks[t] ^ flips
                    met = np.searchsorted(values, wanted)
                    met = met[values[np.minimum(met, len(values) - 1)] == wanted]
                    places.append(met + self.table[t])
                return np.concatenate(places), step
            if upto:
                return np.flatnonzero(np.bitwise_count(self.values ^ np.repeat(chunks, np.diff(self.table))) <= step), step
            if ranked is None:
                near = np.bitwise_count(self.values ^ np.repeat(chunks, np.diff(self.table)))
                ranked = np.argsort(near, kind="stable")
                cuts = np.searchsorted(near[ranked], np.arange(self.search.chunk + 2))
            # As many further distances as double what has been met, so that sparse ones cost no step each.
            reached = int(np.searchsorted(cuts[1:], 2 * cuts[step] + WORTHWHILE))
            reached = min(max(step, reached), self.search.chunk)
            return ranked[cuts[step]:cuts[reached + 1]], reached

        return at

    def _noise(self, size: float) -> float:
        return 1e-12 * size * self.most

    def _best(self, found, product, need, size) -> tuple[np.ndarray, float]:
        order = np.argsort(-product, kind="stable")
        rows = np.cumsum(self.weight[found[order]])
        last = int(np.searchsorted(rows, need))
        if last >= len(order):
            return order, -math.inf
        bar = float(product[order[last]])
        return order[:int(np.searchsorted(-product[order], -bar + self._noise(size), "right"))], bar


def exact(a: np.ndarray, b: np.ndarray) -> float:
    """The inner product, rounded once: products of single precision numbers are exact in double precision."""
    return math.fsum((a * b).tolist())


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _words(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


FOUND = "ask bigint, ids array<bigint>, score double"


def _group_task(search: Search, slacks: dict[int, float]):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        asks, ids, scores = [], [], []
        if left.num_rows and right.num_rows:
            lists = left.column("ids").to_pylist()
            weight = np.array([len(i) for i in lists])
            x = _matrix(left.column("vector"))
            tables = Tables(x, _words(left.column("code")), weight, search, slacks.get(x.shape[1], 3.0))
            floors = right.column("floor").to_pylist()
            for ask, q, code, floor in zip(
                    right.column("ask").to_pylist(), _matrix(right.column("q_vector")), _words(right.column("q_code")), floors):
                member, _ = tables.search_one(q, code, -math.inf if floor is None else floor, search.k + 1)
                best = sorted((-exact(x[m], q), math.inf if lists[m][0] is None else lists[m][0], m) for m in member.tolist())
                for score, _, m in best[:search.k + 1]:
                    asks.append(ask)
                    ids.append(lists[m])
                    scores.append(-score)
        return pa.table([pa.array(asks, pa.int64()), pa.array(ids, pa.list_(pa.int64())), pa.array(scores, pa.float64())],
                        names=["ask", "ids", "score"])

    return run


# Spark plan -------------------------------------------------------------------------------------------------------------

def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _rows(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part; single precision stays as it is, all else becomes double."""
    kind = df.schema[vector_col].dataType
    vector = quoted(vector_col)
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)):
        vector = vector.cast("array<double>")
    return df.select(quoted(id_col).cast("bigint").alias("id"), vector.alias("vector")).where(usable(F.col("vector")))


def fit(members: DataFrame, search: Search) -> dict[int, tuple[np.ndarray, float]]:
    """{vector length: (directions, slack)} for the most frequent lengths; reads a bounded sample on the driver."""
    lengths = members.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(LENGTHS).collect()
    models = {}
    for r in lengths:
        rows = max(1, min(search.sample, SAMPLE_VALUES // r["dim"]))
        # The rows with the smallest hashes: as good as random, and the same in every run.
        drawn = members.where(F.col("dim") == r["dim"]).select("vector", F.xxhash64("vector").alias("h")).orderBy("h").limit(rows)
        x = unit(_matrix(drawn.select("vector").toArrow().column(0)))
        turn = learn(x, search.bits)
        models[r["dim"]] = (turn, slack_of(x, turn, search))
    return models


def _with_codes(members: DataFrame, models: dict, search: Search) -> DataFrame:
    sent = members.sparkSession.sparkContext.broadcast({d: turn for d, (turn, _) in models.items()})
    schema = T.StructType([*members.schema.fields, T.StructField("code", T.BinaryType()), T.StructField("band", T.LongType())])

    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            code, band = [None] * len(dims), np.zeros(len(dims), np.int64)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = _matrix(batch.column("vector").take(pa.array(at)))
                turn = sent.value.get(int(d))
                words = codes(unit(x), directions(int(d), search.bits) if turn is None else turn)
                top = np.abs(x).max(axis=1)
                band[at] = np.floor(NORM_STEPS * (np.log2(top) + np.log2(np.linalg.norm(x / top[:, None], axis=1))))
                for k, w in zip(at, words):
                    code[k] = w.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code, pa.binary()), pa.array(band)], names=schema.names)

    return members.mapInArrow(run, schema)


def _met(index: DataFrame, asks: DataFrame, search: Search, slacks: dict[int, float]) -> DataFrame:
    """Groups of (slice, block): the slice's classes and some queries; both sides carry `slice` and `block`."""
    spark = index.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    left = index.select("slice", "block", "vector", "code", "ids").repartition(tasks, "slice", "block")
    # Both sides may come from one table; new names keep their columns apart.
    right = asks.select("slice", "block", "ask", "vector", "code", "floor").toDF("q_slice", "q_block", "ask", "q_vector", "q_code", "floor")
    right = right.repartition(tasks, "q_slice", "q_block")
    return left.groupBy("slice", "block").cogroup(right.groupBy("q_slice", "q_block")).applyInArrow(_group_task(search, slacks), FOUND)


def nearest(df: DataFrame, asks: Column, id_col: str = "vec_id", vector_col: str = "embedding", search: Search = Search()) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found of every row with an id for which `asks` holds.

    `asks` is a condition on a column `id`.
    """
    k = search.k
    rows = _rows(df, id_col, vector_col).withColumn("asks", F.coalesce(F.col("id").isNotNull() & asks, F.lit(False)))
    # Of equal vectors only the k + 1 smallest ids can be wanted; the limit is applied before the shuffle too.
    smallest = Window.partitionBy("vector", "asks").orderBy(F.col("id").asc_nulls_last())
    few = rows.withColumn("nth", F.row_number().over(smallest)).where(F.col("nth") <= k + 1)
    ids = F.slice(F.array_sort(F.collect_list(F.struct(F.col("id").isNull().alias("no"), "id"))), 1, k + 1)["id"]
    grouped = few.groupBy("vector").agg(ids.alias("ids"), F.max("asks").alias("asks"))
    # Writing the table fixes the numbers.
    members = materialise(grouped.withColumn("ask", F.monotonically_increasing_id()).withColumn("dim", F.size("vector")))
    models = fit(members, search)
    slacks = {d: slack for d, (_, slack) in models.items()}
    coded = materialise(_with_codes(members, models, search))

    # One row per length and norm band.
    dealt = materialise(coded.groupBy("dim", "band").agg(
        F.ceil(F.count(F.lit(1)) / search.slice_rows).cast("int").alias("slices"), F.count_if("asks").alias("n_asks")))
    small, is_small = lookup_table(dealt)
    place = F.pmod(F.xxhash64("ask"), F.col("slices")).cast("int")
    index = coded.join(hinted(small, is_small), ["dim", "band"]).withColumn("slice", F.xxhash64("dim", "band", place))

    def blocks(n: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(n / search.block_rows)).cast("int")

    def own(parts: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(1), "ask"), parts).cast("int")

    # First each query in its own slice.
    parts = blocks(F.col("n_asks") / F.col("slices"))
    every = F.explode(F.sequence(F.lit(0), parts - 1))
    asking = index.where("asks")
    first = materialise(_met(
        index.where("n_asks > 0").withColumn("block", every),
        asking.withColumn("block", own(parts)).withColumn("floor", F.lit(None).cast("double")), search, slacks))
    found = first
    if (dealt.agg(F.sum("slices")).first()[0] or 0) > dealt.select("dim").distinct().count():
        # The floor: the product behind which k + 1 rows have been found.
        best_first = Window.partitionBy("ask").orderBy(F.desc("score"))
        bars = first.withColumn("rows", F.sum(F.size("ids")).over(best_first.rowsBetween(Window.unboundedPreceding, 0)))
        floors = bars.where(F.col("rows") >= k + 1).groupBy("ask").agg(F.max("score").alias("floor"))
        per_length = dealt.groupBy("dim").agg(
            F.collect_list(F.struct("band", "slices")).alias("bands"), F.sum("n_asks").alias("all_asks"))
        lengths, few_lengths = lookup_table(per_length)
        n_blocks = blocks(F.col("all_asks"))
        wide = index.join(hinted(lengths.drop("bands"), few_lengths), "dim").where("all_asks > 0").withColumn(
            "block", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
        others = F.flatten(F.transform("bands", lambda b: F.transform(
            F.sequence(F.lit(0), b["slices"] - 1), lambda s: F.xxhash64(F.col("dim"), b["band"], s))))
        asked = asking.join(floors, "ask", "left").join(hinted(lengths, few_lengths), "dim").withColumn("block", own(n_blocks))
        asked = asked.withColumn("home", F.col("slice")).withColumn("slice", F.explode(others)).where("slice <> home")
        found = first.unionByName(materialise(_met(wide, asked, search, slacks)))

    # k + 1 classes, then k + 1 rows of each query's vector, then the rows of each query but itself.
    order = [F.desc("score"), F.col("ids")[0].asc_nulls_last()]
    ranked = found.withColumn("nth", F.row_number().over(Window.partitionBy("ask").orderBy(*order))).where(F.col("nth") <= k + 1)
    listed = ranked.select("ask", F.explode(F.transform(
        "ids", lambda i: F.struct((-F.col("score")).alias("below"), i.isNull().alias("no"), i.alias("id")))).alias("row"))
    best = listed.groupBy("ask").agg(F.slice(F.array_sort(F.collect_list("row")), 1, k + 1).alias("best"))
    queries = rows.where("asks").select("id", "vector").join(asking.select("vector", "ask"), "vector").drop("vector")
    met = queries.join(best, "ask")
    itself = F.array_position(F.transform("best", lambda r: F.coalesce(r["id"], F.lit(-1))), F.col("id")) - 1
    left = met.withColumn("at", itself.cast("int")).select(
        "id", F.slice(F.filter("best", lambda r, n: n != F.col("at")), 1, k).alias("best"))
    return left.select(F.col("id").alias("query_id"), F.posexplode("best").alias("rank", "row")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("row.id").alias("vec_id"), (-F.col("row.below")).alias("score"))


def recall(df: DataFrame, found: DataFrame, queries: int = 200, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20) -> float:
    """Share of the true nearest products that `found` reaches, over up to `queries` of its queries (those of smallest hash).

    The chosen queries, a bounded number, are compared with all rows in blocks.
    """
    rows = _rows(df, id_col, vector_col)
    chosen = found.select("query_id").distinct().orderBy(F.xxhash64("query_id")).limit(queries)
    asked = {r["id"]: np.array(r["vector"], float) for r in rows.join(F.broadcast(chosen), F.col("id") == F.col("query_id")).collect()}
    sent = df.sparkSession.sparkContext.broadcast(asked)

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            x = [np.array(v, float) for v in batch.column(1).to_pylist()]
            for q, vector in sent.value.items():
                near = sorted(((exact(v, vector), i) for v, i in zip(x, ids) if i != q and len(v) == len(vector)), reverse=True, key=lambda p: p[0])[:k]
                yield pa.RecordBatch.from_arrays([pa.array([q] * len(near), pa.int64()), pa.array([s for s, _ in near], pa.float64())], names=["q", "s"])

    nearest_first = Window.partitionBy("q").orderBy(F.desc("s"))
    true = rows.mapInArrow(run, "q bigint, s double").withColumn("n", F.row_number().over(nearest_first)).where(F.col("n") <= k)
    bars = true.groupBy("q").agg(F.min("s").alias("bar"), F.count(F.lit(1)).alias("wanted"))
    hits = bars.join(found, F.col("q") == F.col("query_id"), "left").groupBy("q", "wanted").agg(F.count_if(F.col("score") >= F.col("bar")).alias("hits"))
    total = hits.agg(F.sum(F.least("hits", "wanted")), F.sum("wanted")).first()
    return (total[0] or 0) / total[1] if total[1] else 1.0
