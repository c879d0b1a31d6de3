"""Operator 1, suffix-array dedup: remove bytes covered by a string of `length` bytes that also starts earlier.

Documents are ordered by id, places by their offset; strings are judged on the input and overlaps count. No task could
hold a suffix array of the whole table, so equal strings are first brought together by what they share:

1. Anchors. Every string has an anchor, its substring of ANCHOR bytes with the smallest hash (leftmost if tied). It
   depends on the string alone, so equal strings have equal anchors. Neighbouring strings mostly share one, so a document
   becomes a list of runs: the strings with one anchor, as (hash of the anchor, hash of the run's bytes, document, offset, number).
   Equal runs within a batch are settled on the spot; one of them goes on.
2. Meeting. Runs meet by anchor. Anchors met once are done with. Where all runs of an anchor are equal, all but the
   earliest are repeats. Only different runs with one anchor need their bytes.
3. Suffix arrays. Those runs get their bytes from the documents, and meet by anchor again in chunks of whole anchors; each
   chunk's suffix array (`suffix.py`) puts equal strings side by side, and all but the earliest are repeats.
4. Removal. The covered stretches of a document are joined and cut out of its text.

A passage that many documents share has many different runs at its edges, where the neighbouring text takes part. Such
anchors are found in a sample of about SAMPLE documents (SHARE of them); their strings are sent singly, by a hash of the
string itself, so that copies are settled within batches and no anchor gathers a share of all rows. The sample only
chooses the route; either way finds the same repeats. After the meeting the bytes of every anchor's different runs are
counted; if some exceed CHUNK, stages 1 and 2 are repeated with the strings of those anchors sent singly too.

Hashes are 64 bits and compared only within an anchor; the anchor adds another 64.

Defined cases: a null text counts as empty; documents under `length` bytes lose nothing; rows with a null id come first;
rows with the same id are ordered by a hash of the text, and rows with equal id and text are one document and get equal
results; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.llm.suffix import repeats
from tabprep.llm.text import others, quoted, whole
from tabprep.operators.ordering import with_row_index
from tabprep.session import materialise

ANCHOR = 32
TILE = 1 << 20  # offsets that fit beside a hash
PLACE = np.uint64(TILE - 1)
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
SAMPLE = 20_000
SHARE = 0.02
CHUNK = 4_000_000  # bytes of one suffix array
BASE = 0x9E3779B97F4A7C15

_bytes = np.random.default_rng(2024).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    np.multiply.accumulate(np.full(n - 1, base, np.uint64), out=out[1:])
    return out


class _Powers:
    """Powers of the hash's base and of its inverse, made once per worker."""

    up = down = np.empty(0, np.uint64)

    @classmethod
    def get(cls, n: int):
        if len(cls.up) < n:
            cls.up, cls.down = _powers(BASE, n), _powers(pow(BASE, -1, 2**64), n)
        return cls.up, cls.down


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        v = np.minimum(v[:-n], v[n:])
        n *= 2
    rest = width - n
    return np.minimum(v[:len(v) - rest], v[rest:]) if rest else v


class Tile:
    """Hashes of a stretch of bytes; strings start in the given ranges (begin, end) only."""

    def __init__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int):
        n = len(data)
        up, self.down = _Powers.get(TILE + 2)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_bytes[data] * up[:n], out=self.sums[1:])
        self.anchors = _mixed(self.strings(np.arange(n - ANCHOR + 1), ANCHOR))
        least = _sliding_min((self.anchors & ~PLACE) | np.arange(len(self.anchors), dtype=np.uint64), length - ANCHOR + 1)
        allowed = np.zeros(n + 1, np.int32)
        np.add.at(allowed, begin, 1)
        np.add.at(allowed, end, -1)
        least[np.cumsum(allowed)[:len(least)] <= 0] = NONE
        at = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        number = np.diff(np.r_[at, len(least)])
        real = least[at] != NONE
        #: offset, number of strings and anchor hash of every run
        self.at, self.number = at[real], number[real]
        self.key = self.anchors[(least[self.at] & PLACE).astype(np.int64)]

    def strings(self, at: np.ndarray, length) -> np.ndarray:
        """Unmixed hashes of the strings of the given lengths."""
        return (self.sums[at + length] - self.sums[at]) * self.down[at]


def _tiles(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first byte, last byte, begins, ends) of tiles: many documents, or part of one that is too long for a tile."""
    long = np.flatnonzero(np.diff(offsets) > TILE // 2)
    row, n = 0, len(offsets) - 1
    while row < n:
        first = int(offsets[row])
        if row in long:
            last = int(offsets[row + 1])
            while last - first >= length:
                stop = min(last, first + TILE)
                yield first, stop, np.array([0]), np.array([stop - first - length + 1])
                first = stop - length + 1
            row += 1
            continue
        after = int(np.searchsorted(offsets, first + TILE // 2, side="right")) - 1
        next_long = long[long > row]
        after = min(max(after, row + 1), int(next_long[0]) if len(next_long) else n)
        begin, end = offsets[row:after] - first, offsets[row + 1:after + 1] - first - length + 1
        fits = end > begin
        if fits.any():
            yield first, int(offsets[after]), begin[fits], end[fits]
        row = after


def _text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return data, offsets


def _merge(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Join overlapping and touching stretches of each document."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    fresh = np.r_[True, doc[1:] != doc[:-1]]
    # The furthest end so far within the document: ends are lifted by the document's turn, which sorts them apart.
    lift = (np.cumsum(fresh) - 1) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift)
    fresh |= np.r_[True, start[1:] + lift[1:] > reach[:-1]]
    at = np.flatnonzero(fresh)
    return doc[at], start[at], reach[np.r_[at[1:], len(doc)] - 1] - lift[at]


RUNS = "key bigint, content bigint, doc bigint, start bigint, number int"
ROWS = "key bigint, doc bigint, start bigint, number bigint"


def _later(key, content, doc, start):
    """Order by key, content, document and start, and mark all but the first of equal contents."""
    order = np.lexsort((start, doc, content, key))
    k, c = key[order], content[order]
    return order, np.r_[False, (k[1:] == k[:-1]) & (c[1:] == c[:-1])] if len(order) else np.empty(0, bool)


def _runs_task(length: int, hot: np.ndarray):
    """Stage 1. A row whose `number` is negative is a stretch to remove, of that many bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = _text_buffers(batch.column(1))
            parts = []
            for first, last, begin, end in _tiles(offsets, length):
                tile = Tile(data[first:last], begin, end, length)
                at, number, key = tile.at, tile.number, tile.key
                content = _mixed(tile.strings(at, number + length - 1) + number.astype(np.uint64))
                if len(hot):
                    split = hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key
                    if split.any():
                        times = number[split]
                        single = np.repeat(at[split], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                        own = _mixed(tile.strings(single, length))
                        # Another mix of the same bytes leads to a task of the string's own.
                        routed = _mixed(own ^ np.repeat(key[split], times))
                        at, number = np.r_[at[~split], single], np.r_[number[~split], np.ones(len(single), number.dtype)]
                        key, content = np.r_[key[~split], routed], np.r_[content[~split], own]
                row = np.searchsorted(offsets, at + first, side="right") - 1
                parts.append((key.view(np.int64), content.view(np.int64), docs[row], at + first - offsets[row], number))
            if not parts:
                continue
            key, content, doc, start, number = (np.concatenate(x) for x in zip(*parts))
            order, later = _later(key, content, doc, start)
            first, gone = order[~later], order[later]
            d, s, e = _merge(doc[gone], start[gone], start[gone] + number[gone] + length - 1)
            columns = (np.r_[key[first], _mixed((d ^ s).astype(np.uint64)).view(np.int64)],
                       np.r_[content[first], np.zeros(len(d), np.int64)], np.r_[doc[first], d], np.r_[start[first], s],
                       np.r_[number[first], s - e].astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "content", "doc", "start", "number"])

    return run


def _meeting_task(length: int):
    """Stage 2. Rows without a key are stretches to remove; rows with one are runs whose bytes must be compared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        key, content, doc, start, number = (
            np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in range(5))
        held.clear()
        settled = number < 0
        gone = [(doc[settled], start[settled], start[settled] - number[settled])]
        key, content, doc, start, number = (x[~settled] for x in (key, content, doc, start, number))
        # Anchors met once, the large majority, need no further look.
        order = np.argsort(key, kind="stable")
        k = key[order]
        same = np.r_[False, k[1:] == k[:-1]] if len(k) else np.empty(0, bool)
        order = order[same | np.r_[same[1:], False]] if len(k) else order
        key, content, doc, start, number = (x[order] for x in (key, content, doc, start, number))
        order, later = _later(key, content, doc, start)
        repeat = order[later]
        gone.append((doc[repeat], start[repeat], start[repeat] + number[repeat] + length - 1))
        first = order[~later]
        k = key[first]
        same = np.r_[False, k[1:] == k[:-1]] if len(k) else np.empty(0, bool)
        first = first[same | np.r_[same[1:], False]] if len(k) else first
        d, s, e = _merge(*(np.concatenate(x) for x in zip(*gone)))
        keys = pa.array(np.r_[np.zeros(len(d), np.int64), key[first]], mask=np.r_[np.ones(len(d), bool), np.zeros(len(first), bool)])
        columns = (np.r_[d, doc[first]], np.r_[s, start[first]], np.r_[e - s, number[first]].astype(np.int64))
        yield pa.RecordBatch.from_arrays([keys, *[pa.array(c) for c in columns]], names=["key", "doc", "start", "number"])

    return run


def _bytes_task(length: int):
    """Stage 3a. The bytes of a document's runs: rows of (document, text, runs)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column(2)
            rows = np.repeat(np.arange(batch.num_rows), runs.value_lengths().to_numpy(zero_copy_only=False))
            flat = runs.flatten()
            key, start, number = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            data, offsets = _text_buffers(batch.column(1))
            memory = memoryview(data)
            begin = offsets[rows] + start
            pieces = [bytes(memory[a:b]) for a, b in zip(begin.tolist(), (begin + number + length - 1).tolist())]
            docs = batch.column(0).to_numpy(zero_copy_only=False)[rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(docs), pa.array(start), pa.array(pieces, pa.binary())],
                names=["key", "doc", "start", "piece"])

    return run


def _array_task(length: int):
    """Stage 3b. Suffix arrays over chunks of whole keys; rows come sorted by key."""
    def chunk(key, doc, start, pieces):
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        # All strings of all pieces, in the joined text with a place between pieces.
        number = sizes - length + 1
        where = np.r_[0, np.cumsum(sizes + 1)[:-1]]
        inside = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        piece = np.repeat(np.arange(len(pieces)), number)
        classes = repeats(pieces, where[piece] + inside, length)
        d, s = doc[piece], start[piece] + inside
        order = np.lexsort((s, d, classes))
        c = classes[order]
        gone = order[np.r_[False, c[1:] == c[:-1]]]
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in _merge(d[gone], s[gone], s[gone] + length)], names=["doc", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append((*(batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)), batch.column(3).to_pylist()))
            size += sum(map(len, held[-1][3]))
            while size > CHUNK:
                key, doc, start = (np.concatenate([h[k] for h in held]) for k in range(3))
                pieces = [p for h in held for p in h[3]]
                cut = int(np.searchsorted(np.cumsum([len(p) for p in pieces]), CHUNK)) + 1
                cut = int(np.searchsorted(key, key[min(cut, len(key) - 1)]))  # back to where its key begins
                if not cut:
                    cut = int(np.searchsorted(key, key[0], side="right"))  # one key alone is larger
                if cut >= len(key):
                    held = [(key, doc, start, pieces)]
                    break  # the last key may go on in the next batch
                yield chunk(key[:cut], doc[:cut], start[:cut], pieces[:cut])
                held = [(key[cut:], doc[cut:], start[cut:], pieces[cut:])]
                size = sum(map(len, pieces[cut:]))
        if held and len(held[0][0]):
            key, doc, start = (np.concatenate([h[k] for h in held]) for k in range(3))
            yield chunk(key, doc, start, [p for h in held for p in h[3]])

    return run


def _hot_anchors(docs: DataFrame, length: int) -> np.ndarray:
    """Anchors with different runs in at least SHARE of a sample of documents, ascending. At most a few thousand."""
    total = docs.count()
    every = max(1, total // SAMPLE)
    sample = docs.where(F.pmod(F.xxhash64("doc"), F.lit(every)) == 0)
    runs = sample.mapInArrow(_runs_task(length, np.empty(0, np.uint64)), RUNS).where("number > 0")
    # A document counts once per anchor, copies of a run once in all.
    distinct = runs.groupBy("key", "content").agg(F.min("doc").alias("doc")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    least = max(50, int(SHARE * min(total, SAMPLE)))
    found = distinct.where(F.col("n") >= least).select("key").toPandas()
    return np.sort(found["key"].to_numpy(np.int64).view(np.uint64))


def _numbered(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(all rows with their document number `doc` and text, the documents once each)."""
    kind = dict(df.dtypes)[id_col]
    id_, text = quoted(id_col), whole(text_col)
    rows = df.select(*others(df, ["suffix__text"]), text.alias("suffix__text"))
    plain = kind in ("bigint", "int", "smallint", "tinyint")
    if plain:
        odd = df.groupBy(id_.alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null")
        plain = odd.isEmpty()
    if plain:
        rows = rows.withColumn("suffix__doc", id_.cast("bigint"))
        return rows, rows.select(F.col("suffix__doc").alias("doc"), F.col("suffix__text").alias("text"))
    # Numbers by id and text, for ids that repeat, are null or are no whole numbers.
    rows = rows.withColumn("suffix__id", id_).withColumn("suffix__digest", F.md5("suffix__text"))
    listed = materialise(rows.select(
        F.col("suffix__id").isNotNull().alias("named"), "suffix__id", "suffix__digest").distinct())
    numbers = materialise(with_row_index(listed, ["named", "suffix__id", "suffix__digest"], "suffix__doc"))
    numbers = numbers.select(
        "suffix__doc", F.col("suffix__id").alias("suffix__other"), F.col("suffix__digest").alias("suffix__same"))
    on = F.col("suffix__id").eqNullSafe(F.col("suffix__other")) & (F.col("suffix__digest") == F.col("suffix__same"))
    rows = materialise(rows.join(numbers, on).drop("suffix__id", "suffix__digest", "suffix__other", "suffix__same"))
    once = rows.select(F.col("suffix__doc").alias("doc"), F.col("suffix__text").alias("text")).dropDuplicates(["doc"])
    return rows, once


def _met(docs: DataFrame, length: int, hot: np.ndarray) -> DataFrame:
    runs = docs.mapInArrow(_runs_task(length, hot), RUNS)
    return materialise(runs.repartition("key").mapInArrow(_meeting_task(length), ROWS))


def _large_anchors(met: DataFrame, length: int) -> np.ndarray:
    """Anchors whose different runs do not fit into one suffix array, ascending; each stands for over CHUNK bytes."""
    size = met.where("key is not null").groupBy("key").agg(F.sum(F.col("number") + length - 1).alias("size"))
    found = size.where(F.col("size") > CHUNK).select("key").toPandas()
    return np.sort(found["key"].to_numpy(np.int64).view(np.uint64))


def _gathered(docs: DataFrame, length: int) -> DataFrame:
    """Stages 1 and 2, again with the strings of large anchors sent singly if there are any."""
    hot = _hot_anchors(docs, length)
    met = _met(docs, length, hot)
    large = _large_anchors(met, length)
    return _met(docs, length, np.union1d(hot, large)) if len(large) else met


def repeated_stretches(docs: DataFrame, length: int = 100) -> DataFrame:
    """(doc, start, end) of stretches to remove; they may overlap. `docs` has unique numbers `doc` and `text`.

    Strings are found by an anchor of ANCHOR bytes inside them, so `length` must not be less.
    """
    if length < ANCHOR:
        raise ValueError(f"strings must have {ANCHOR} bytes at least")
    met = _gathered(docs, length)
    unclear = met.where("key is not null")
    wanted = unclear.groupBy("doc").agg(F.collect_list(F.struct("key", "start", "number")).alias("runs"))
    pieces = docs.join(wanted, "doc").select("doc", "text", "runs").mapInArrow(
        _bytes_task(length), "key bigint, doc bigint, start bigint, piece binary")
    compared = pieces.repartition("key").sortWithinPartitions("key").mapInArrow(
        _array_task(length), "doc bigint, start bigint, end bigint")
    settled = met.where("key is null").select("doc", "start", (F.col("start") + F.col("number")).alias("end"))
    return settled.union(compared)


def _removal_task(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = batch.num_columns
            texts, spans = batch.column(width - 2).to_pylist(), batch.column(width - 1).to_pylist()
            out = []
            for text, stretches in zip(texts, spans):
                data, left, at, removed, n = text.encode(), [], 0, 0, 0
                for stretch in sorted((s["start"], s["end"]) for s in stretches or ()):
                    if stretch[0] > at or not n:
                        left.append(data[at:stretch[0]])
                        n += 1
                        removed += stretch[1] - stretch[0]
                        at = stretch[1]
                    elif stretch[1] > at:
                        removed += stretch[1] - at
                        at = stretch[1]
                kept = b"".join([*left, data[at:]])
                out.append((len(data), removed, n, hashlib.sha256(kept).hexdigest(), kept))
            columns = zip(*out) if out else ([], [], [], [], [])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            made = dict(zip(("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"), map(pa.array, columns, kinds)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *[made[n] for n in names]], names=[*batch.schema.names[:-2], *names])

    return run


OUTPUTS = {"n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(), "kept_sha256": T.StringType(),
           "kept": T.BinaryType()}


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100,
          out: tuple[str, ...] = ("n_bytes", "n_removed", "n_spans", "kept")) -> DataFrame:
    """Replace the text by any of: its bytes, bytes removed, maximal stretches removed, `kept` bytes and their digest."""
    rows, docs = _numbered(df, id_col, text_col)
    found = materialise(repeated_stretches(docs, length))
    spans = found.groupBy(F.col("doc").alias("suffix__doc")).agg(F.collect_list(F.struct("start", "end")).alias("suffix__spans"))
    joined = rows.join(spans, "suffix__doc", "left").select(*others(df, [*out, text_col]), "suffix__text", "suffix__spans")
    schema = T.StructType([*joined.schema.fields[:-2], *[T.StructField(n, OUTPUTS[n]) for n in out]])
    return joined.mapInArrow(_removal_task(list(out)), schema)
