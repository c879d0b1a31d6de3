"""Operator 3, SimHash near-dedup over a Gray-order hierarchical index.

Fingerprints: letters A-Z in lower case, words, three-word shingles with repeats (fewer words: the whole sequence; none:
fingerprint zero); each shingle is hashed by XXH64 with seed 42, and a bit of the fingerprint is 1 if it is set in over
half of the hashes. Fingerprints that differ in at most `limit` bits are linked.

Candidates: documents collapse into distinct fingerprints first, so copies cost nothing further. The 64 bits are cut into
`limit` + 1 blocks; two linked fingerprints agree in one block at least, and so in any of its bits: each fingerprint goes to
one group per block, by as few of the block's bits as make groups of about AIMED fingerprints. Every group is searched with the
Gray-order index of `gray.py`; it returns a tree of links per component, never all pairs. A group with more than GROUP
fingerprints is routed again by whole blocks of its other bits, which keeps every link and bounds what one task holds.
Components are joined by `graph.py`.

Defined cases: a null or empty text has fingerprint zero, linked like any other; whole texts are hashed; a row with a
null id takes part, and a component in which no row has an id has a null component id; repeated rows share their result;
an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_digest

from tabprep.llm.graph import components
from tabprep.llm.gray import GrayIndex, gray_rank
from tabprep.llm.text import others, quoted, whole
from tabprep.session import materialise

SEED = 42
SHINGLE = 3
LIMIT = 3
GROUP = 20_000
AIMED = 2_048  # fingerprints aimed at per group, as far as a block's bits allow
LEVELS = 4
ROWS = 255  # as many bits of one place fit into a byte when added


def fingerprint(text: str) -> bytes:
    """The fingerprint's eight bytes, most significant first."""
    # Bytes only know ASCII letters and white space, which is what the definition asks for.
    words = text.encode().lower().split()
    if not words:
        return bytes(8)
    data = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0, *[e + 1 for e in ends[:-1]]]
    if len(words) > SHINGLE:
        digests = [xxh64_digest(data[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1:])]
    else:
        digests = [xxh64_digest(data, SEED)]
    bits = np.unpackbits(np.frombuffer(b"".join(digests), np.uint8)).reshape(-1, 64)
    sums = np.add.reduceat(bits, np.arange(0, len(bits), ROWS), axis=0, dtype=np.uint8)
    return np.packbits(sums.sum(axis=0, dtype=np.int64) * 2 > len(digests)).tobytes()


def with_fingerprint(df: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """Replace the text by its fingerprint, as a bigint with the same bits."""
    given = df.select(*others(df, [out, text_col]), whole(text_col).alias("simhash__text"))
    schema = T.StructType([*given.schema.fields[:-1], T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            codes = np.frombuffer(b"".join([fingerprint(t) for t in texts]), ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(codes)], names=schema.names)

    return given.mapInArrow(run, schema)


def _ranges(width: int, blocks: int, bits: int) -> list[tuple[int, int]]:
    """For each block of the lower `width` bits, which are cut as equally as possible, its lowest `bits` bits."""
    cuts = [width * n // blocks for n in range(blocks + 1)]
    return [(a, min(b, a + bits)) for a, b in zip(cuts, cuts[1:])]


def _value(a: int, b: int) -> Column:
    return F.expr(f"shiftrightunsigned(rest, {a}) & {(1 << (b - a)) - 1}L")


def _without(width: int, a: int, b: int) -> Column:
    """The lower `width` bits less those from a to b."""
    if a == b:
        return F.col("rest")
    upper = f"shiftleft(shiftrightunsigned(rest, {b}) & {(1 << (width - b)) - 1}L, {a})" if b < width else "0L"
    return F.expr(f"(rest & {(1 << a) - 1}L) | {upper}")


def _route(rows: DataFrame, width: int, blocks: int, bits: int) -> DataFrame:
    """One row per block: the key so far with the block's value, and the bits that the key does not hold."""
    # Without a bit to route by all blocks would make the same group.
    ranges = _ranges(width, blocks, bits) if bits else [(0, 0)]
    targets = F.array(*[
        F.struct(F.concat_ws(".", F.col("key"), F.lit(str(n)), F.hex(_value(a, b))).alias("key"), _without(width, a, b).alias("rest"))
        for n, (a, b) in enumerate(ranges)
    ])
    return rows.select("code", F.inline(targets))


def _linked(routes: DataFrame, limit: int) -> DataFrame:
    """Links (a, b) that join the near codes of each group, one row per link of a tree."""
    placed = routes.select(F.xxhash64("key").alias("key"), "code").repartition("key").sortWithinPartitions("key")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def links(key: np.ndarray, code: np.ndarray) -> pa.RecordBatch:
        code = code.view(np.uint64)
        order = np.lexsort((gray_rank(code), key))
        key, code = key[order], code[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, int)
        sizes = np.diff(np.r_[starts, len(key)])
        a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        for start, size in zip(starts, sizes):
            group = code[start:start + size]
            root = GrayIndex(group).link(limit)
            tied = root != np.arange(size)
            a.append(group[tied])
            b.append(group[root[tied]])
        found = [np.concatenate(x).view(np.int64) for x in (a, b)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last group of a batch may go on in the next.
        key, code = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            key = np.r_[key, batch.column(0).to_numpy(zero_copy_only=False)]
            code = np.r_[code, batch.column(1).to_numpy(zero_copy_only=False)]
            if len(key) and key[0] != key[-1]:
                cut = np.searchsorted(key, key[-1])
                yield links(key[:cut], code[:cut])
                key, code = key[cut:], code[cut:]
        yield links(key, code)

    return placed.mapInArrow(run, schema)


def near_links(codes: DataFrame, limit: int = LIMIT, group: int = GROUP) -> DataFrame:
    """Links (a, b) between the distinct bigints `code`, enough to connect all that differ in at most `limit` bits."""
    blocks, width = limit + 1, 64
    # As few bits as make groups of about AIMED; groups that come out larger than `group` are routed again by whole blocks.
    bits = min(width // blocks, max(0, round(math.log2(max(1, codes.count()) / AIMED))))
    rows = codes.select("code", F.col("code").alias("rest"), F.lit("").alias("key"))
    found = None
    for level in range(LEVELS):
        routes = _route(rows, width, blocks, bits)
        if level < LEVELS - 1:
            large = materialise(routes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group))
        done = level == LEVELS - 1 or large.isEmpty()
        part = _linked(routes if done else routes.join(large, "key", "left_anti"), limit)
        found = part if found is None else found.union(part)
        if done:
            return found
        rows = materialise(routes.join(large, "key", "left_semi"))
        width -= bits
        bits = width // blocks
    return found


def classes(signed: DataFrame, id_col: str, code_col: str = "fingerprint", limit: int = LIMIT) -> DataFrame:
    """(code, component): for each distinct fingerprint the smallest id in its component."""
    codes = materialise(signed.groupBy(quoted(code_col).alias("code")).agg(F.min(quoted(id_col)).alias("least")))
    roots = components(near_links(codes, limit)).withColumnRenamed("node", "code")
    rooted = materialise(codes.join(roots, "code", "left").select("code", "least", F.coalesce("root", "code").alias("root")))
    least = materialise(rooted.groupBy("root").agg(F.min("least").alias("component")))
    return materialise(rooted.select("code", "root").join(least, "root").select("code", "component"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """Fingerprint (bigint) and component_id of every row, with the columns of `df` but the text."""
    signed = materialise(with_fingerprint(df.drop("component_id"), text_col))
    found = classes(signed, id_col, limit=limit)
    return signed.join(
        found.select(F.col("code").alias("fingerprint"), F.col("component").alias("component_id")), "fingerprint")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row of each component: the one with the smallest id, ties by the hash of the whole row."""
    row = F.xxhash64(*[quoted(c) for c in df.columns])
    signed = materialise(with_fingerprint(
        df.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"), row.alias("row"))))
    component = classes(signed, "id", limit=limit)
    found = materialise(signed.join(component.withColumnRenamed("code", "fingerprint"), "fingerprint"))
    first = F.min(F.struct(F.col("id").isNull(), "id", "row"))
    kept = materialise(found.groupBy(
        F.when(F.col("component").isNull(), F.col("fingerprint")).alias("nameless"), "component").agg(first.alias("first"))
        .select(F.col("first.row").alias("simhash__row")).distinct())
    alone = Window.partitionBy("simhash__row").orderBy("simhash__row")
    return (
        df.withColumn("simhash__row", row).join(kept, "simhash__row", "left_semi")
        .withColumn("simhash__copy", F.row_number().over(alone)).where("simhash__copy = 1").select(*[quoted(c) for c in df.columns])
    )
