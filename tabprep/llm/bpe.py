"""Operator 2, BPE encoding and decoding with a public vocabulary file.

The file's normalizer and splitter give pieces; each piece becomes a doubly linked list of symbols, and a priority queue
holds the merges of neighbours by rank, leftmost first. A merge whose symbols have changed since it was queued is stale
and skipped. Decoding concatenates vocabulary strings, separated by spaces, as the file names no decoder.

Whole texts are encoded, row by row, in tasks that Spark schedules over its input splits: no shuffle, nothing is
collected, and a lost executor only repeats its splits. The file is read on the driver (its path is a parameter) and
sent to the tasks as it is: a fixed 2 MB, whatever the data. Pieces never cross white space, so each task remembers
the ids of the white-space-delimited chunks it has seen, MEMO at most, and starts over when there are more; this
changes no result.

Defined cases: a null text counts as empty; an empty text has no ids and decodes to the empty text; the file's special
strings in a text become their special ids, as the library does; rows are independent, so ties and repeats need no rule;
an empty table gives no rows; ids outside the vocabulary decode to nothing.
"""

from __future__ import annotations

import hashlib
import json
import struct
import sys
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.llm.text import others, quoted, whole

MEMO = 400_000
ROWS = 500
# A queue entry has the place in its lower bits; a piece has fewer symbols than that.
SHIFT = 40
PLACE = (1 << SHIFT) - 1
LITTLE = sys.byteorder == "little"
KINDS = {
    "ids": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
    "n_tokens": (T.LongType(), pa.int64()),
    "decoded": (T.StringType(), pa.string()),
    "ids_sha256": (T.StringType(), pa.string()),
    "decoded_sha256": (T.StringType(), pa.string()),
}


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte: itself if it prints, else the next one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in prints else chr(next(spare)) for b in range(256)}


class Memo(dict):
    """Results of a function, `MEMO` at most."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, key):
        if len(self) >= MEMO:
            self.clear()
        self[key] = value = self.compute(key)
        return value


class Tokenizer:
    """Encoder and decoder of one vocabulary file; refuses files whose parts it does not know."""

    def __init__(self, definition: str):
        parts = json.loads(definition)
        model = parts["model"]
        self._refuse_unknown(parts, model)
        vocab = model["vocab"]
        strings = {i: s for s, i in vocab.items()} | {t["id"]: t["content"] for t in parts["added_tokens"]}
        self.strings = [strings.get(i) for i in range(max(strings) + 1)]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(vocab[a], vocab[b]): rank << SHIFT for rank, (a, b) in enumerate(pairs)}
        self.results = [vocab[a + b] for a, b in pairs]
        self.end = model.get("end_of_word_suffix") or ""
        symbols = byte_symbols()
        self.inner = [vocab[symbols[b]] for b in range(256)]
        self.last = [vocab[symbols[b] + self.end] for b in range(256)]
        self.pattern = regex.compile(parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self.special_pattern = regex.compile(
            "(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.memo = Memo(self._ids)

    @staticmethod
    def _refuse_unknown(parts, model) -> None:
        names = [n["type"] for n in parts["normalizer"]["normalizers"]]
        split, level = parts["pre_tokenizer"]["pretokenizers"]
        known = (
            names == ["NFC", "Replace", "Lowercase"] and model["type"] == "BPE" and not model.get("byte_fallback")
            and split["type"] == "Split" and split["behavior"] == "Removed" and split["invert"]
            and level["type"] == "ByteLevel" and not level["use_regex"] and not level["add_prefix_space"]
            and parts["decoder"] is None and parts["post_processor"] is None and not model.get("ignore_merges")
            and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in parts["added_tokens"])
        )
        if not known:
            raise ValueError("this vocabulary file has parts that the encoder does not know")

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge neighbours by rank, leftmost first. A queue entry is the rank, shifted, plus the left symbol's place."""
        n = len(symbols)
        ranks, results = self.ranks.get, self.results
        queue = []
        left = symbols[0]
        for i in range(1, n):
            right = symbols[i]
            rank = ranks((left, right))
            if rank is not None:
                queue.append(rank + i - 1)
            left = right
        if not queue:
            return symbols
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heapify(queue)
        while queue:
            entry = heappop(queue)
            i = entry & PLACE
            j = after[i]
            if j >= n or symbols[i] < 0 or ranks((symbols[i], symbols[j])) != entry - i:
                continue  # stale: a neighbour was merged meanwhile
            symbols[i] = new = results[entry >> SHIFT]
            symbols[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                rank = ranks((new, symbols[k]))
                if rank is not None:
                    heappush(queue, rank + i)
            h = before[i]
            if h >= 0:
                rank = ranks((symbols[h], new))
                if rank is not None:
                    heappush(queue, rank + h)
        return [s for s in symbols if s >= 0]

    def _piece_ids(self, piece: str) -> bytes:
        data = piece.encode()
        inner = self.inner
        symbols = [inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        ids = self.merge(symbols)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _ids(self, chunk: str) -> bytes:
        """Ids, as bytes, of a run without white space, or of a normalized piece behind a line feed."""
        if chunk[0] == "\n":
            return self._piece_ids(chunk[1:])
        # Lower case goes character by character, so the sigma at a word's end has no form of its own.
        plain = chunk.isascii()
        text = chunk.lower() if plain else unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        if text.isalpha():
            return self._piece_ids(text) if text == chunk else self.memo[text if plain else "\n" + text]
        if text[-1] in ".,;:!?" and text[:-1].isalpha():
            return self.memo[text[:-1] if plain else "\n" + text[:-1]] + self.memo["\n" + text[-1]]
        return b"".join([self.memo["\n" + p] for p in self.pattern.findall(text)])

    def _chunks(self, text: str) -> list[str]:
        # str.split also splits at four control characters that are not white space for the file's pattern.
        controls = not text.isprintable() and any(c in text for c in "\x1c\x1d\x1e\x1f")
        return [c for c in regex.split(r"\p{White_Space}+", text) if c] if controls else text.split()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not (self.special_pattern and any(s in text for s in self.special)):
            return b"".join(map(self.memo.__getitem__, self._chunks(text)))
        ids = []
        for n, part in enumerate(self.special_pattern.split(text)):
            if n % 2:
                ids.append(struct.pack("<I", self.special[part]))
            else:
                ids += map(self.memo.__getitem__, self._chunks(part))
        return b"".join(ids)

    def decode(self, ids: Iterable[int]) -> str:
        known = self.strings
        return " ".join([known[i] for i in ids if 0 <= i < len(known) and known[i] is not None])

    def decode_packed(self, ids: bytes) -> str:
        return " ".join(map(self.strings.__getitem__, memoryview(ids).cast("I") if LITTLE else unpacked(ids)))


def unpacked(ids: bytes) -> tuple[int, ...]:
    return struct.unpack(f"<{len(ids) // 4}I", ids)


@lru_cache(maxsize=2)
def _tokenizer(definition: str) -> Tokenizer:
    return Tokenizer(definition)


def read_definition(path: str | None = None) -> str:
    """The vocabulary file's text; the public word BPE file where no path is given."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


def _column(name: str, encoded: list[bytes], decoded: list[str]) -> pa.Array:
    if name == "n_tokens":
        return pa.array([len(i) // 4 for i in encoded], pa.int64())
    if name == "ids":
        ends = np.cumsum([0, *[len(i) // 4 for i in encoded]], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(encoded), "<i4").astype(np.int32)))
    if name == "decoded":
        return pa.array(decoded, pa.string())
    if name == "ids_sha256":
        return pa.array([hashlib.sha256(i).hexdigest() for i in encoded], pa.string())
    return pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string())


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts and ids take little memory as Python objects."""
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS):
            yield batch.slice(begin, ROWS)


def encode(df: DataFrame, text_col: str = "text", path: str | None = None, out: Sequence[str] = ("ids",)) -> DataFrame:
    """Add any of `ids`, `n_tokens`, `decoded` and the SHA-256 digests `ids_sha256` and `decoded_sha256`."""
    sent = df.sparkSession.sparkContext.broadcast(read_definition(path))
    kept = others(df, [*out])
    given = df.select(*kept, whole(text_col).alias("bpe__text"))
    schema = T.StructType([*given.schema.fields[:-1], *[T.StructField(n, KINDS[n][0]) for n in out]])
    with_text = any(n.startswith("decoded") for n in out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(sent.value)
        for batch in _small(batches):
            encoded = [tokenizer.encode(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            decoded = [tokenizer.decode_packed(i) for i in encoded] if with_text else []
            columns = [*batch.columns[:-1], *[_column(n, encoded, decoded) for n in out]]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return given.mapInArrow(run, schema)


def decode(df: DataFrame, ids_col: str = "ids", path: str | None = None, out: str = "decoded") -> DataFrame:
    """Add the text of an array of ids; null ids count as none."""
    sent = df.sparkSession.sparkContext.broadcast(read_definition(path))
    given = df.select(*others(df, [out]), F.coalesce(quoted(ids_col), F.array().cast("array<int>")).alias("bpe__ids"))
    schema = T.StructType([*given.schema.fields[:-1], T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(sent.value)
        for batch in _small(batches):
            texts = [tokenizer.decode(ids) for ids in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    return given.mapInArrow(run, schema)
