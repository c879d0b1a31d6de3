"""Operator 12, the fill-in-the-middle transformation, on UTF-8 bytes with a sparse index of multibyte characters.

A text is cut into units, lines or characters, at two places drawn from a hash of its id, and its prefix, middle and suffix
are put in another order behind marks, so that a model learns to fill gaps. Work is on the bytes as they come from Arrow.
`Places` records only the multibyte characters: their positions and how many bytes exceed one per character. A cut between
characters becomes a cut between bytes, and the other way round, by one `searchsorted` in that record; stretches of ASCII,
usually the whole text, cost an addition. Line cuts are found in bytes and reported in characters, character cuts are drawn
in characters and made in bytes, so both directions are used.

Rows are independent: one pass over the input splits, without a shuffle; an executor holds one batch.

Defined cases: a null text counts as empty; an empty text, a text that holds a mark, and a text beyond the rate stay as
they are (form `plain`, lengths null); a null id is drawn as the empty string; equal ids draw equal numbers, so repeated
rows give repeated results; lines are `[^\\n]*\\n|[^\\n]+`; an empty table gives no rows; columns named like an output are
replaced, all others are carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.llm.text import others, quoted, whole

KINDS = {
    "n": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(),
    "output": T.StringType(), "output_sha256": T.StringType(), "restored": T.StringType(), "restored_sha256": T.StringType(),
}


@dataclass(frozen=True)
class Plan:
    """How texts are cut and joined; rates are percent."""

    seed: str = "7:"
    unit: str = "lines"
    fim_rate: int = 100
    spm_rate: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = self.marks
        if self.unit not in ("lines", "chars"):
            raise ValueError("the unit is lines or chars")
        if not all(marks) or any(a in b for k, a in enumerate(marks) for n, b in enumerate(marks) if k != n):
            raise ValueError("marks must not be empty or parts of each other")
        # Else a mark could seem to begin in the text before it.
        if any(m[:n] == m[-n:] for m in marks for n in range(1, len(m))):
            raise ValueError("a mark must not begin as it ends")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


class Places:
    """Character and byte positions of one text; keeps its multibyte characters only."""

    def __init__(self, data: np.ndarray):
        # A character's first byte tells its length; continuation bytes are 10xxxxxx.
        lead = np.flatnonzero(data >= 0xC0)
        first = data[lead]
        extra = 1 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
        self.excess = np.cumsum(extra)  # bytes beyond one per character, up to and with each of them
        self.chars = lead - (self.excess - extra)  # their positions in characters
        self.bytes = lead
        self.n_bytes = len(data)
        self.n_chars = len(data) - int(extra.sum())

    def to_bytes(self, char: np.ndarray) -> np.ndarray:
        """Byte positions of positions between characters."""
        return self._shifted(char, self.chars, 1)

    def to_chars(self, byte: np.ndarray) -> np.ndarray:
        """Character positions of byte positions that lie between characters."""
        return self._shifted(byte, self.bytes, -1)

    def _shifted(self, place, exceptions: np.ndarray, sign: int) -> np.ndarray:
        place = np.asarray(place, np.int64)
        if not len(exceptions):
            return place
        before = np.searchsorted(exceptions, place, "left")
        return place + sign * np.where(before > 0, self.excess[np.maximum(before, 1) - 1], 0)


def numbers(key: str) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers of a key."""
    digest = hashlib.sha256(key.encode()).digest()
    return tuple(int.from_bytes(digest[k:k + 4], "big") for k in (0, 4, 8, 12))


def transform(text: bytes, key: str, plan: Plan) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, prefix and middle in characters, output) of one text."""
    data = np.frombuffer(text, np.uint8)
    if plan.unit == "lines":
        cuts = np.flatnonzero(data == 10) + 1
        n = len(cuts) + (len(data) > 0 and data[-1] != 10)
        places = None
    else:
        places = Places(data)
        n = places.n_chars
    h1, h2, h3, h4 = numbers(key)
    if not text or any(m.encode() in text for m in plan.marks) or h3 % 100 >= plan.fim_rate:
        return int(n), "plain", None, None, text
    units = sorted((h1 % (n + 1), h2 % (n + 1)))
    if plan.unit == "lines":
        at = np.array([0 if u == 0 else len(data) if u == n else cuts[u - 1] for u in units], np.int64)
        # Only what lies before the second cut is looked at; the rest of the text needs no positions.
        chars = Places(data[:at[1]]).to_chars(at)
    else:
        chars = np.array(units, np.int64)
        at = places.to_bytes(chars)
    first, second = (int(x) for x in at)
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    p, s, m = (x.encode() for x in plan.marks)
    spm = h4 % 100 < plan.spm_rate
    output = s + suffix + p + prefix + m + middle if spm else p + prefix + s + suffix + m + middle
    return int(n), "spm" if spm else "psm", int(chars[0]), int(chars[1] - chars[0]), output


def restore(output: bytes, form: str, plan: Plan = Plan()) -> bytes:
    """The text from its output and form alone."""
    if form == "plain":
        return output
    p, s, m = (x.encode() for x in plan.marks)
    first, second = (s, p) if form == "spm" else (p, s)
    if not output.startswith(first):
        raise ValueError("the output does not start with the mark of its form")
    one, rest = output[len(first):].split(second, 1)
    two, middle = rest.split(m, 1)
    prefix, suffix = (two, one) if form == "spm" else (one, two)
    return prefix + middle + suffix


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def fill_in_middle(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", plan: Plan = Plan(),
                   out: Sequence[str] = ("n", "form", "prefix_chars", "middle_chars", "output")) -> DataFrame:
    """Add any of n, form, prefix_chars, middle_chars, output, output_sha256, restored and restored_sha256."""
    kept = others(df, out)
    key = F.coalesce(quoted(id_col).cast("string"), F.lit("")).alias("fim__key")
    given = df.select(*kept, key, whole(text_col).alias("fim__text"))
    carried = given.schema.fields[:-2]
    schema = T.StructType([*carried, *[T.StructField(c, KINDS[c]) for c in out]])
    again = any(c.startswith("restored") for c in out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = batch.column(len(carried) + 1).cast(pa.binary()), batch.column(len(carried)).to_pylist()
            columns = {c: [] for c in out}
            for text, key in zip(texts, keys):
                n, form, prefix, middle, output = transform(text.as_py(), plan.seed + key, plan)
                text = restore(output, form, plan) if again else b""
                row = {"n": n, "form": form, "prefix_chars": prefix, "middle_chars": middle, "output": output, "restored": text}
                for c in out:
                    columns[c].append(_sha(row[c.removesuffix("_sha256")]) if c.endswith("_sha256") else row[c])
            made = [pa.array(columns[c], pa.int64()) if KINDS[c] == T.LongType()
                    else pa.array(columns[c], pa.binary()).cast(pa.string()) if c in ("output", "restored")
                    else pa.array(columns[c], pa.string()) for c in out]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(carried)], *made], names=schema.names)

    return given.mapInArrow(run, schema)
