"""Operator 4, embedding near-dedup: navigable small-world graphs per shard, verified by cosine, joined to components.

Vectors are compared within their label. Equal vectors collapse into one class first, which keeps their number, so that
copies cost nothing further and still count as links. The classes of a label are dealt over shards of about `shard_rows`
by a hash; each shard is one task that builds a graph (`hnsw.py`) over its classes, once. The graph is written as rows: a
class, its vector and its links in every layer. The classes of the label that search it come in slices of about
`slice_rows`; each slice of each shard is a task that reads the graph's rows and searches for its own classes and those
of other shards, so a large label is many tasks of bounded length.

Searches start with beams of `beam`. When it is built, the shard audits itself: its classes are drawn at random until
`linked` of them have a link to another class or none is left, their links are found by an exact scan, and beams double
until the mean share that a class with links finds reaches `recall`. Searches from other shards are audited alike: up to
`foreign` of a slice's are drawn until `linked` have a link. A slice gives no answer before its audit, so that all its
answers come from the beam that passed. A search whose whole
beam lies within the threshold is repeated with a wider one, until the beam reaches past the links; when a beam
would hold a good part of the shard, the shard is scanned exactly instead. All links are verified in double precision.

A task returns one row per searched class (number of links) and ties to the local component's root, so
results grow with the vectors, not with the pairs. Components are joined by `graph.py`.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite components, or whose label is null, links
with nothing; finite components of any size are compared (vectors are scaled by a power of two first); vectors of
different lengths do not link; a row without an id counts as a vector but never names a
component (null if none has an id); rows with equal vectors and ids count as separate vectors; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.llm.graph import components
from tabprep.llm.gray import _root, unite
from tabprep.llm.hnsw import Graph
from tabprep.llm.text import quoted
from tabprep.session import materialise
from tabprep.sizing import hinted, lookup_table

NEAR = 1e-4  # how far single precision may be off
QUERIES = 256
PAIRS = 4_000_000  # similarities of an exact scan held at once


@dataclass(frozen=True)
class Search:
    threshold: float = 0.93
    shard_rows: int = 50_000
    slice_rows: int = 10_000
    beam: int = 32
    audit: int = 256
    recall: float = 0.995
    linked: int = 200
    foreign: int = 10_000


def usable(vector: Column, label: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(label.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class Shard:
    """The graph of one shard, its audited beam, and verified links; built anew or from the rows of `built`."""

    def __init__(self, vectors: np.ndarray, search: Search, built: tuple[np.ndarray, np.ndarray, int] | None = None):
        self.search = search
        self.wide = vectors
        self.norm = np.linalg.norm(vectors, axis=1)
        self.asked = 0  # searches of other shards drawn so far
        self.pools = {True: [], False: []}  # own and other classes with links: (vector, own place or -1, number of links)
        unit = vectors / self.norm[:, None]
        if built:
            height, links, self.beam = built
            self.graph = Graph.restored(unit, height, links)
        else:
            self.graph, self.beam = Graph(unit), search.beam
            self.audit(vectors, True)

    def audit(self, vectors: np.ndarray, own: bool) -> None:
        """Draw vectors until enough of them have links, and widen the beam until theirs are found."""
        if self._whole(self.beam):
            return
        n, pool = len(vectors), self.pools[own]
        if own:
            most = n
        elif len(pool) < self.search.linked and self.asked < self.search.foreign:
            most = max(self.search.foreign - self.asked, self.search.audit)
        else:
            most = self.search.audit
        drawn = np.random.default_rng(n).permutation(n)[:most]
        for begin in range(0, len(drawn), self.search.audit):
            # What is drawn beyond the first ones only serves to fill the pool.
            if begin and len(pool) >= self.search.linked:
                break
            picked = drawn[begin:begin + self.search.audit]
            place = picked if own else np.full(len(picked), -1)
            total = self._tally(self._scan(vectors[picked]), place)
            pool += [(vectors[picked[k]], place[k], total[k]) for k in np.flatnonzero(total)]
            self.asked += 0 if own else len(picked)
        del pool[:-2 * max(self.search.linked, self.search.audit)]
        if not pool:
            return
        sample, place, total = (np.array(x) for x in zip(*pool))
        while not self._whole(self.beam):
            if (self._tally(self._links(sample, self.beam), place) / total).mean() >= self.search.recall:
                break
            self.beam *= 2

    def _tally(self, links, place: np.ndarray) -> np.ndarray:
        """How many links each vector has, the one to itself left out."""
        total = np.zeros(len(place), np.int64)
        for i, j in links:
            np.add.at(total, i, place[i] != j)
        return total

    def _whole(self, beam: int) -> bool:
        return beam * 4 >= len(self.wide)

    def _verified(self, vectors, i, j):
        """Of the candidate pairs those whose cosine in double precision reaches the threshold."""
        dot = np.einsum("ij,ij->i", vectors[i], self.wide[j])
        near = dot / (np.linalg.norm(vectors, axis=1)[i] * self.norm[j]) >= self.search.threshold
        return i[near], j[near]

    def _scan(self, vectors):
        """(places in `vectors`, members) of all links, by comparing with the whole shard."""
        unit = (vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.float32)
        step = max(1, PAIRS // len(self.wide))
        for begin in range(0, len(unit), step):
            i, j = np.nonzero(unit[begin:begin + step] @ self.graph.x.T >= self.search.threshold - NEAR)
            yield self._verified(vectors, i + begin, j)

    def _links(self, vectors, beam):
        if self._whole(beam):
            yield from self._scan(vectors)
            return
        unit = (vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.float32)
        for begin in range(0, len(unit), QUERIES):
            block = np.arange(begin, min(len(unit), begin + QUERIES))
            ids, sims = self.graph.nearest(unit[block], beam)
            inside = (ids >= 0) & (sims >= self.search.threshold - NEAR)
            full = inside.all(axis=1)
            i, c = np.nonzero(inside & ~full[:, None])
            yield self._verified(vectors, block[i], ids[i, c])
            if full.any():
                again = block[full]
                for i, j in self._links(vectors[again], beam * 2):
                    yield again[i], j

    def links(self, vectors: np.ndarray):
        return self._links(vectors, self.beam)


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    vectors = flat.reshape(len(column), -1)
    # Powers of two change no cosine, and keep squares of very large and very small numbers finite.
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def _answers(shard: Shard, node, weight, ask_node, ask_vectors, own: bool, label):
    """One row per searched class, its links' weight; and ties to the roots of local components.

    `node` ascends; `label` holds the members' components found so far.
    """
    total = np.zeros(len(ask_node), np.int64)
    if own:
        place, names = np.searchsorted(node, ask_node), node
    else:
        shard.audit(ask_vectors, False)
        place, names = len(node) + np.arange(len(ask_node)), np.r_[node, ask_node]
        label = np.r_[label, place]
    for i, j in shard.links(ask_vectors):
        apart = place[i] != j
        i, j = i[apart], j[apart]
        unite(label, place[i], j)
        np.add.at(total, i, weight[j])
    root = _root(label, np.arange(len(label)))
    tied = np.flatnonzero(root != np.arange(len(label)))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.r_[ask_node, names[tied]]), pa.array(np.r_[total, np.zeros(len(tied), np.int64)]),
         pa.array(np.r_[ask_node, names[root[tied]]])], names=["node", "links", "tie"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each value of the first column; they come sorted by it."""
    held, current = [], None
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else []
        for begin, end in zip(cuts, np.r_[cuts[1:], len(keys)]):
            if held and keys[begin] != current:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            current = keys[begin]
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    return table.column(name).combine_chunks()


def _graph_task(search: Search):
    """Rows of (shard, slices, node, weight, vector), sorted by shard and node, get the links of the shard's graph and its beam."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            shard = Shard(_vectors(_column(table, "vector")), search)
            size, links = shard.graph.rows()
            made = [pa.array(shard.graph.height.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.array(links)),
                    pa.array(np.full(len(size), shard.beam, np.int32))]
            for name, column in zip(("height", "links", "beam"), made):
                table = table.append_column(name, column)
            yield from table.to_batches(max_chunksize=10_000)

    return run


def _slice_task(search: Search):
    """Rows come sorted by task, then members (role 0), own searches (1) and those of other shards (2), each by node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            role = _column(table, "role").to_numpy(zero_copy_only=False)
            cuts = np.searchsorted(role, [0, 1, 2, 3])
            members, *asking = (table.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:]))
            if not members.num_rows:  # a shard that the hash left empty
                continue
            node, weight, height = (_column(members, c).to_numpy(zero_copy_only=False) for c in ("node", "weight", "height"))
            links = _column(members, "links").flatten().to_numpy(zero_copy_only=False)
            beam = int(_column(members, "beam")[0].as_py())
            shard = Shard(_vectors(_column(members, "vector")), search, (height, links, beam))
            label = np.arange(len(node))
            for own, part in zip((True, False), asking):
                if part.num_rows:
                    asked = _column(part, "node").to_numpy(zero_copy_only=False)
                    yield _answers(shard, node, weight, asked, _vectors(_column(part, "vector")), own, label)

    return run


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    search: Search = Search()) -> DataFrame:
    """n_links, component_id and kept for every row, with its id."""
    vector, label = quoted(vector_col), quoted(label_col)
    rows = df.select(quoted(id_col).alias("id"), vector.alias("vector"), label.cast("string").alias("label"))
    keyed = rows.select(
        "id", "label", "vector", usable(F.col("vector"), F.col("label")).alias("usable")).select(
        "*", F.when(F.col("usable"), F.xxhash64(F.lit(1), "label", "vector")).alias("h1"),
        F.when(F.col("usable"), F.xxhash64(F.lit(2), "label", "vector")).alias("h2"))
    # `first` holds one of equal vectors; the number in `node` is fixed by writing the table.
    grouped = keyed.where("usable").groupBy("h1", "h2").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("weight"), F.first("label").alias("label"),
        F.first("vector").alias("vector"))
    members = materialise(grouped.withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("vector")))

    groups = materialise(members.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")))
    dealt = groups.withColumn("shards", F.ceil(F.col("n") / search.shard_rows).cast("int")).withColumn(
        "slices", F.ceil(F.col("n") / search.slice_rows).cast("int"))
    small, is_small = lookup_table(dealt)
    shard_of = F.xxhash64("label", "dim", "at")
    placed = members.join(hinted(small, is_small), ["label", "dim"]).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int"))
    n_shards, n_tasks = dealt.agg(F.sum("shards"), F.sum(F.col("shards").cast("bigint") * F.col("slices"))).first()
    parts = int(min(4 * (n_shards or 1), 20_000))  # more than shards, so that two of them seldom share a task
    kept = placed.withColumn("at", F.col("own")).select(shard_of.alias("shard"), "slices", "node", "weight", "vector")
    built = kept.repartitionByRange(parts, "shard").sortWithinPartitions("shard", "node")
    schema = T.StructType([*built.schema.fields, T.StructField("height", T.IntegerType()),
                           T.StructField("links", T.ArrayType(T.IntegerType())), T.StructField("beam", T.IntegerType())])
    graphs = materialise(built.mapInArrow(_graph_task(search), schema))

    task = F.xxhash64("shard", "slice")
    sent = graphs.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).select(
        task.alias("task"), F.lit(0).alias("role"), "node", "weight", "vector", "height", "links", "beam")
    asked = placed.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select(
        shard_of.alias("shard"), F.pmod(F.xxhash64(F.lit(1), "node"), F.col("slices")).cast("int").alias("slice"),
        F.when(F.col("at") == F.col("own"), 1).otherwise(2).alias("role"), "node", "vector").select(
        task.alias("task"), "role", "node", F.lit(None).cast("bigint").alias("weight"), "vector",
        F.lit(None).cast("int").alias("height"), F.lit(None).cast("array<int>").alias("links"), F.lit(None).cast("int").alias("beam"))
    parts = int(min(4 * (n_tasks or 1), 20_000))
    sent = sent.union(asked).repartitionByRange(parts, "task").sortWithinPartitions("task", "role", "node")
    answers = materialise(sent.mapInArrow(_slice_task(search), "node bigint, links bigint, tie bigint"))

    links = answers.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(answers.where("node <> tie"), "node", "tie")
    rooted = materialise(
        members.select("h1", "h2", "node", "least", "weight").join(links, "node").join(roots, "node", "left")
        .select("h1", "h2", "least", (F.col("links") + F.col("weight") - 1).alias("links"), F.coalesce("root", "node").alias("root")))
    named = materialise(rooted.groupBy("root").agg(F.min("least").alias("component")))
    found = materialise(rooted.join(named, "root").select("h1", "h2", "links", "component"))

    apart = keyed.where("not usable").select(
        F.col("id").alias(id_col), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    met = keyed.where("usable").join(found, ["h1", "h2"]).select(
        F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    return met.union(apart).withColumn("kept", F.coalesce(quoted(id_col) == F.col("component_id"), F.lit(False)))
