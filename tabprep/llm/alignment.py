"""Operator 11, alignment of two tokenizers' tokens by divide and conquer at shared cuts, with corpus-wide link counts.

A text behind one space is encoded by a byte-level BPE (A) and by a piece BPE with byte fallback (B, which adds the space
itself). Where an A token and a B token end at the same byte, the text is cut. `split` finds the cuts: an interval of
tokens looks for a common end near its middle, bisecting B's ends for the ends of A's tokens, nearest to the middle
first and in rings of doubled width; it is divided there and both halves go on. An interval in which no ring holds a
common end is a leaf: one group of A and B tokens that cover the same bytes. All open intervals of a batch of texts take
a step together, so a level costs a few array operations.

Inside a group the tokens whose byte ranges overlap are linked. How many documents hold a pair of ids linked is counted
over the corpus: a task lists each pair once per *bundle* (documents of one task, about `BUNDLE` links), Spark sums them,
and each bundle asks for the counts of its own pairs only, so a frequent pair costs a row per bundle instead of a row per
document. Documents keep their pairs as places in the bundle's list, packed. The bundles meet their counts in groups that
are as large as a bundle. Everything between the passes is a written table; nothing is collected or broadcast but the two
vocabulary files, whose size is fixed.

Defined cases: texts that are null or empty, or that A or B does not reproduce byte by byte, have no tokens: zeros, and
`groups` and `groups_sha256` are empty; special strings in a text are plain text; repeated rows and ids count as separate
documents; an empty table gives no rows; columns named like an output are replaced, all others are carried.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.llm.bpe import byte_symbols
from tabprep.llm.text import others, whole
from tabprep.session import materialise

TEXT_BYTES = 2_000_000  # texts aligned together; a longer text is aligned alone
BUNDLE = 6_000_000  # links after which a task starts another bundle; a longer text is a bundle of its own
LONG = 100_000  # characters from which a text goes to the slower encoder, which takes any
SEQUENCES = 1 << 24  # bundles one task may number
# Fixed value: how byte-level files of this kind split a text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
TEXTS = ("groups", "groups_sha256")
SUMS = ("n_best", "count_sum")


class Pair:
    """Both tokenizers, with the bytes of every id."""

    def __init__(self, definition: str, model: bytes):
        import sentencepiece
        import tiktoken
        import tokenizers

        parts = json.loads(definition)
        level, vocab = parts["pre_tokenizer"], parts["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in parts["model"]["merges"]]
        made = [vocab[a + b] for a, b in merges]
        ordinary = (
            parts["normalizer"] is None and parts["model"]["type"] == "BPE" and level["type"] == "ByteLevel" and level["use_regex"]
            and not level["add_prefix_space"] and not parts["model"].get("ignore_merges") and made == sorted(made)
        )
        if not ordinary:
            raise ValueError("tokenizer A must be a plain byte-level BPE whose ids follow its merges")
        byte = {s: b for b, s in byte_symbols().items()}
        special = {t["content"] for t in parts["added_tokens"]}
        spelled = {i: bytes(byte[c] for c in s) for s, i in vocab.items() if s not in special}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks={s: i for i, s in spelled.items()}, special_tokens={})
        # The same ids; the faster encoder ends on a run of a million blanks.
        self.slow_a = tokenizers.Tokenizer.from_str(definition)
        self.slow_a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_a = pa.array([spelled.get(i, b"") for i in range(max(spelled) + 1)], pa.binary())
        self.bytes_b = pa.array([
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i)
            else p.replace("▁", " ").encode() for i, p in enumerate(pieces)], pa.binary())
        self.length_a, self.length_b = (np.diff(np.frombuffer(x.buffers()[1], np.int32)[:len(x) + 1]) for x in (self.bytes_a, self.bytes_b))
        # Decimal ids with what may follow them: "," inside a side, "|" after A's side, ";" after B's, nothing at the end.
        self.written = pa.array([f"{i}{mark}" for i in range(max(len(self.bytes_a), len(self.bytes_b))) for mark in (",", "|", ";", "")])

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [self.a.encode_ordinary(" " + t) if len(t) <= LONG else self.slow_a.encode(" " + t, add_special_tokens=False).ids for t in texts]
        return a, self.b.encode(texts, num_threads=1) if texts else []


@lru_cache(maxsize=2)
def _pair(definition: str, model: bytes) -> Pair:
    return Pair(definition, model)


def _spread(begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, value): for each k the values begin[k], begin[k] + 1, ... `count[k]` of them."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count - begin, count)


def split(ends_a: np.ndarray, ends_b: np.ndarray, a0, a1, b0, b1) -> tuple[np.ndarray, np.ndarray]:
    """First A and first B token of every group, in order.

    Interval k holds the tokens a0[k]..a1[k]-1 and b0[k]..b1[k]-1, which cover the same bytes; ends rise over all intervals.
    """
    first_b = np.full(len(ends_a) + 1, -1, np.int64)  # by first A token, of the leaves
    a0, a1, b0, b1 = (np.asarray(x, np.int64) for x in (a0, a1, b0, b1))
    while len(a0):
        single = (a1 - a0 == 1) | (b1 - b0 == 1)
        first_b[a0[single]] = b0[single]
        a0, a1, b0, b1 = (x[~single] for x in (a0, a1, b0, b1))
        middle = (a0 + a1 - 2) // 2
        at = np.full(len(a0), -1, np.int64)  # the A token behind which an interval is divided, and the B token
        at_b = np.zeros(len(a0), np.int64)
        # Tokens [low, high) have been asked; the last token of an interval ends it and is no cut.
        low, high, width = middle.copy(), middle.copy(), 1
        looking = np.arange(len(a0))
        while len(looking):
            new_low = np.maximum(low[looking] - width + 1, a0[looking])
            new_high = np.minimum(high[looking] + width, a1[looking] - 1)
            left = _spread(new_low, low[looking] - new_low)
            right = _spread(high[looking], new_high - high[looking])
            owner, token = np.concatenate([left[0], right[0]]), np.concatenate([left[1], right[1]])
            met = np.searchsorted(ends_b, ends_a[token])
            same = ends_b[np.minimum(met, len(ends_b) - 1)] == ends_a[token]
            owner, token, met = looking[owner[same]], token[same], met[same]
            near = np.lexsort((np.abs(token - middle[owner]), owner))
            owner, token, met = owner[near], token[near], met[near]
            nearest = np.r_[True, owner[1:] != owner[:-1]][:len(owner)]
            at[owner[nearest]], at_b[owner[nearest]] = token[nearest], met[nearest]
            low[looking], high[looking] = new_low, new_high
            looking = looking[(at[looking] < 0) & ((new_low > a0[looking]) | (new_high < a1[looking] - 1))]
            width *= 2
        leaf = at < 0
        first_b[a0[leaf]] = b0[leaf]
        a0, a1, b0, b1, at, at_b = (x[~leaf] for x in (a0, a1, b0, b1, at, at_b))
        a0, a1 = np.concatenate([a0, at + 1]), np.concatenate([at + 1, a1])
        b0, b1 = np.concatenate([b0, at_b + 1]), np.concatenate([at_b + 1, b1])
    begin = np.flatnonzero(first_b >= 0)
    return begin, first_b[begin]


def links(ends_a: np.ndarray, ends_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked tokens, A's in order. Groups of one A or one B token are linked throughout."""
    size_a, size_b = np.diff(np.r_[group_a, len(ends_a)]), np.diff(np.r_[group_b, len(ends_b)])
    first, last = np.repeat(group_b, size_a), np.repeat(group_b + size_b - 1, size_a)
    several = np.flatnonzero(np.repeat((size_a > 1) & (size_b > 1), size_a))
    begin = np.where(several > 0, ends_a[several - 1], 0)
    first[several] = np.searchsorted(ends_b, begin, "right")
    last[several] = np.searchsorted(ends_b, ends_a[several], "left")
    return _spread(first, last - first + 1)


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    count = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int64, int(count.sum())), count


def _spells(table: pa.Array, ids: np.ndarray, count: np.ndarray, wanted: list[bytes]) -> np.ndarray:
    """Which texts the ids spell byte by byte."""
    taken = table.take(pa.array(ids))
    data = taken.buffers()[2].to_pybytes() if len(ids) else b""
    place = np.frombuffer(taken.buffers()[1], np.int32)[np.r_[0, np.cumsum(count)]] if len(ids) else np.zeros(len(count) + 1, np.int64)
    return np.array([data[i:j] == w for i, j, w in zip(place, place[1:], wanted)], bool)


class Aligned:
    """Groups and links of some texts; texts without tokens have none."""

    def __init__(self, pair: Pair, texts: list[str | None]):
        n = len(texts)
        self.counts = np.zeros((n, len(COUNTS)), np.int64)
        self.pair = pair
        asked = np.array([k for k, t in enumerate(texts) if t], np.int64)
        given = [texts[k] for k in asked]
        a, b = pair.encode(given)
        wanted = [b" " + t.encode() for t in given]
        ids_a, count_a = _flat(a)
        ids_b, count_b = _flat(b)
        good = _spells(pair.bytes_a, ids_a, count_a, wanted) & _spells(pair.bytes_b, ids_b, count_b, wanted)
        if not good.all():
            ids_a, ids_b = ids_a[np.repeat(good, count_a)], ids_b[np.repeat(good, count_b)]
            asked, count_a, count_b = asked[good], count_a[good], count_b[good]
        self.docs, self.ids_a, self.ids_b, self.count_a, self.count_b = asked, ids_a, ids_b, count_a, count_b
        ends_a, ends_b = np.cumsum(pair.length_a[ids_a], dtype=np.int64), np.cumsum(pair.length_b[ids_b], dtype=np.int64)
        upto_a, upto_b = np.cumsum(count_a), np.cumsum(count_b)
        self.group_a, self.group_b = split(ends_a, ends_b, upto_a - count_a, upto_a, upto_b - count_b, upto_b)
        self.link_a, self.link_b = links(ends_a, ends_b, self.group_a, self.group_b)
        self.last_group = np.searchsorted(self.group_a, upto_a)
        n_groups = np.diff(np.r_[0, self.last_group])
        n_links = np.diff(np.r_[0, np.searchsorted(self.link_a, upto_a)])
        self.counts[asked] = np.stack([count_a, count_b, n_groups, n_links], axis=1) if len(asked) else 0

    def written(self) -> list[bytes]:
        """The groups of every text, `a1,a2|b1;a3|b2,b3`."""
        out = [b""] * len(self.counts)
        if not len(self.docs):
            return out
        size_a, size_b = np.diff(np.r_[self.group_a, len(self.ids_a)]), np.diff(np.r_[self.group_b, len(self.ids_b)])
        # A's tokens of a group stand before its B tokens, groups in order.
        place_a = np.arange(len(self.ids_a)) + np.repeat(self.group_b, size_a)
        place_b = np.arange(len(self.ids_b)) + np.repeat(self.group_a + size_a, size_b)
        entry = np.empty(len(self.ids_a) + len(self.ids_b), np.int64)
        entry[place_a], entry[place_b] = self.ids_a * 4, self.ids_b * 4
        entry[place_a[self.group_a + size_a - 1]] += 1
        entry[place_b[self.group_b + size_b - 1]] += 2
        entry[place_b[np.cumsum(self.count_b) - 1]] += 1
        taken = self.pair.written.take(pa.array(entry))
        data = taken.buffers()[2].to_pybytes()
        cuts = np.frombuffer(taken.buffers()[1], np.int32)[np.r_[0, np.cumsum(self.count_a + self.count_b)]]
        for k, doc in enumerate(self.docs):
            out[doc] = data[cuts[k]:cuts[k + 1]]
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair of ids, links), one entry per text and pair, sorted."""
        n_b = len(self.pair.bytes_b)
        room = len(self.pair.bytes_a) * n_b
        doc = np.repeat(self.docs, self.counts[self.docs, 3])
        code = np.sort(doc * room + self.ids_a[self.link_a] * n_b + self.ids_b[self.link_b])
        at = np.flatnonzero(np.r_[True, code[1:] != code[:-1]][:len(code)])
        return code[at] // room, code[at] % room, np.diff(np.r_[at, len(code)])


def _packed(places: np.ndarray, times: np.ndarray) -> bytes:
    """Rising places in the bundle's list, as differences, and how often each counts; byte planes compress well."""
    steps = np.stack([np.diff(places, prepend=0), times]).astype("<u4")
    return zlib.compress(steps.view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1).tobytes(), 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(2, 4, -1)
    steps = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4")[:, :, 0].astype(np.int64)
    return np.cumsum(steps[0]), steps[1]


class _Bundle:
    """Rows of one task that share a list of pairs."""

    def __init__(self):
        self.rows, self.owner, self.code, self.times = [], [], [], []
        self.docs = self.links = 0

    def add(self, rows: pa.RecordBatch, doc: np.ndarray, code: np.ndarray, times: np.ndarray) -> None:
        self.rows.append(rows)
        self.owner.append(doc + self.docs)
        self.code.append(code)
        self.times.append(times)
        self.docs += rows.num_rows
        self.links += len(code)

    def table(self, number: int, schema: pa.Schema, n_b: int) -> pa.Table:
        owner, code, times = (np.concatenate(x) for x in (self.owner, self.code, self.times))
        distinct, place, docs = np.unique(code, return_inverse=True, return_counts=True)
        cuts = np.searchsorted(owner, np.arange(self.docs + 1))
        packed = [_packed(place[i:j], times[i:j]) for i, j in zip(cuts, cuts[1:])]
        rows = pa.Table.from_batches(self.rows).append_column("al__packed", pa.array(packed, pa.binary()))
        counts = {"al__a": distinct // n_b, "al__b": distinct % n_b, "al__docs": docs}

        def filled(n: int, given: dict) -> pa.Table:
            given = given | {"al__bundle": np.full(n, number)}
            return pa.table([given[f.name] if f.name in given and isinstance(given[f.name], pa.ChunkedArray)
                             else pa.array(given[f.name], f.type) if f.name in given else pa.nulls(n, f.type) for f in schema], schema=schema)

        return pa.concat_tables([filled(self.docs, {c: rows.column(c) for c in rows.column_names}), filled(len(distinct), counts)])


def _aligned_rows(kept: int, schema: T.StructType, out: Sequence[str], sent):
    """Rows of documents and rows of pairs, bundle by bundle."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*sent.value)
        number = TaskContext.get().partitionId() * SEQUENCES
        bundle = _Bundle()
        for batch in batches:
            for part in _in_size(batch):
                texts = part.column(kept).to_pylist()
                aligned = Aligned(pair, texts)
                columns = {f.name: part.column(k) for k, f in enumerate(list(schema)[:kept])}
                columns |= {c: pa.array(aligned.counts[:, k]) for k, c in enumerate(COUNTS)}
                if any(c in out for c in TEXTS):
                    written = aligned.written()
                    texts = {"groups": lambda: [w.decode() for w in written],
                             "groups_sha256": lambda: [hashlib.sha256(w).hexdigest() if w else "" for w in written]}
                    columns |= {c: pa.array(texts[c](), pa.string()) for c in TEXTS if c in out}
                rows = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
                bundle.add(rows, *aligned.pairs())
                if bundle.links >= BUNDLE:
                    yield from bundle.table(number, arrow, len(pair.bytes_b)).to_batches(max_chunksize=50_000)
                    number, bundle = number + 1, _Bundle()
        if bundle.docs:
            yield from bundle.table(number, arrow, len(pair.bytes_b)).to_batches(max_chunksize=50_000)

    return run


def _in_size(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The same rows in parts of about TEXT_BYTES of text."""
    size = batch.column(batch.num_columns - 1)
    cut = np.cumsum(np.nan_to_num(pa.compute.binary_length(size).to_numpy(zero_copy_only=False))) // TEXT_BYTES
    starts = np.flatnonzero(np.r_[True, cut[1:] != cut[:-1]][:len(cut)])
    for begin, end in zip(starts, np.r_[starts[1:], batch.num_rows]):
        yield batch.slice(begin, end - begin)


def _summed(key: tuple, docs: pa.Table, counts: pa.Table, names: list[str]) -> pa.Table:
    """n_best and count_sum of a bundle's documents; its list of pairs is sorted by ids."""
    a, b, count, best = (counts.column(c).to_numpy() for c in ("al__a", "al__b", "al__count", "al__best"))
    order = np.lexsort((b, a))
    values = np.stack([best[order].astype(np.int64), count[order]])
    sums = np.zeros((docs.num_rows, 2), np.int64)
    for k, data in enumerate(docs.column("al__packed").to_pylist()):
        place, times = _unpacked(data)
        sums[k] = (values[:, place] * times).sum(axis=1)
    return pa.table([*[docs.column(c) for c in names[:-2]], pa.array(sums[:, 0]), pa.array(sums[:, 1])], names=names)


def align(df: DataFrame, text_col: str = "text", path_a: str | None = None, path_b: str | None = None,
          out: Sequence[str] = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")) -> DataFrame:
    """Add any of n_a, n_b, n_groups, n_links, n_best, count_sum, groups and groups_sha256.

    `path_a` is a byte-level BPE's JSON file and `path_b` a piece model; the public ones where none is given.
    """
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast(_read_files(path_a, path_b))
    kept = others(df, out)
    # Columns of the input get plain names on the way, so that none can clash.
    given = df.select(*[c.alias(f"in__{k}") for k, c in enumerate(kept)], whole(text_col).alias("al__text"))
    inputs = given.schema.fields[:-1]
    own = [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField(c, T.StringType()) for c in TEXTS if c in out]
    extra = [T.StructField("al__packed", T.BinaryType()), T.StructField("al__bundle", T.LongType()), T.StructField("al__a", T.IntegerType()),
             T.StructField("al__b", T.IntegerType()), T.StructField("al__docs", T.LongType())]
    nullable = [T.StructField(f.name, f.dataType) for f in inputs]
    schema = T.StructType([*nullable, *own, *extra])
    names = df.select(*kept).columns
    rows = given.mapInArrow(_aligned_rows(len(inputs), schema, out, sent), schema)
    if not any(c in out for c in SUMS):
        docs = rows.where("al__packed is not null")
        return docs.select(*[F.col(f"in__{k}").alias(n) for k, n in enumerate(names)], *out)

    rows = materialise(rows)
    listed = rows.where("al__a is not null").select("al__bundle", "al__a", "al__b", "al__docs")
    summed = listed.groupBy("al__a", "al__b").agg(F.sum("al__docs").alias("al__count"))
    # An id of A has at most as many pairs as B has ids.
    best = F.col("al__count") == F.max("al__count").over(Window.partitionBy("al__a"))
    counts = materialise(summed.withColumn("al__best", best))
    asked = listed.drop("al__docs").withColumnRenamed("al__bundle", "al__asker").join(counts, ["al__a", "al__b"])
    docs = rows.where("al__packed is not null").drop("al__a", "al__b", "al__docs")
    result = T.StructType([*nullable, *own, *[T.StructField(c, T.LongType()) for c in SUMS]])

    def sums(key, left: pa.Table, right: pa.Table) -> pa.Table:
        return _summed(key, left, right, result.names)

    met = docs.groupBy("al__bundle").cogroup(asked.groupBy("al__asker")).applyInArrow(sums, result)
    return met.select(*[F.col(f"in__{k}").alias(n) for k, n in enumerate(names)], *out)


def _read_files(path_a: str | None, path_b: str | None) -> tuple[str, bytes]:
    """Both files as they are, read on the driver: a fixed 2 MB."""
    if path_a is None or path_b is None:
        import public_tokenizers

        path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
        path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        return a.read(), b.read()
