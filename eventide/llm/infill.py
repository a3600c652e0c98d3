"""Fill-in-the-middle: a text cut into prefix, middle and suffix and reordered.

Cuts are drawn by tokens or by code points, but texts are cut as bytes.  The
bridge between both is a sparse exception index: only the characters of more
than one byte are recorded, by position and by the excess bytes up to them.  A
cut is converted by a binary search among them; between two of them (all of an
ASCII text) the two positions differ by a constant.

The draws come from the sha256 of ``seed:id`` alone, so a rerun, a lost
executor or another partitioning gives the same rows, and no shuffle is needed.

Defined cases: a null text is empty; an empty text and one that holds a
sentinel stay plain; a null id draws from ``seed:``; repeated rows get the
same result each; an empty table gives no rows; clashing columns of the input
are replaced.
"""

from __future__ import annotations

import hashlib
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from eventide.llm import textscan as ts

#: The sentinels of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_ADDED = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType())])


class ExceptionIndex(NamedTuple):
    """Characters of several bytes in one text: where they start, and how
    many excess bytes stand before them (one entry more at the end)."""

    byte_at: np.ndarray
    char_at: np.ndarray
    excess: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray) -> "ExceptionIndex":
        at = np.flatnonzero(data >= 0xC0)
        lead = data[at]
        excess = np.zeros(len(at) + 1, np.int64)
        np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0), out=excess[1:])
        return cls(at, at - excess[:-1], excess)

    def to_chars(self, at):
        """Code points before a byte position that starts a character (or ends the text)."""
        return at - self.excess[np.searchsorted(self.byte_at, at)]

    def to_bytes(self, at):
        """Byte position after so many code points."""
        return at + self.excess[np.searchsorted(self.char_at, at)]


def token_ends(s: ts.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Ends (bytes in the slice) of all tokens, and each row's first token, one
    entry more at the end.  A token is a word with the blanks before it, or the
    blanks that end a text."""
    word = ts.BLANK_WORD[s.data].view(np.int8)
    edge = np.flatnonzero(np.diff(np.concatenate((word, [0]))) == -1) + 1
    tail = s.end > s.begin
    tail[tail] = ~ts.BLANK_WORD[s.data[s.end[tail] - 1]]
    ends = np.sort(np.concatenate((edge, s.end[tail])), kind="stable")
    # the end of a row is a possible token end, the start of a row is none
    return ends, np.concatenate((np.searchsorted(ends, s.begin, "right"), [len(ends)]))


def draws(doc_id, seed: int) -> list[int]:
    """The first four 32-bit groups of sha256 of ``seed:id``."""
    digest = hashlib.sha256(b"%d:%s" % (seed, b"" if doc_id is None else str(doc_id).encode())).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12)]


def arrange(text: bytes, cut: int, stop: int, form: str) -> bytes:
    """The output for a text whose middle is text[cut:stop]."""
    prefix, middle, suffix = text[:cut], text[cut:stop], text[stop:]
    if form == "psm":
        return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))


def restore(output: bytes, form: str) -> bytes:
    """The text behind an output.  The parts hold no sentinel, and none can
    arise across a part's end, so the first sentinel of its kind is the cut."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    if not output.startswith(first):
        raise ValueError(f"not an output of form {form}")
    a, rest = output[len(first):].split(second, 1)
    b, middle = rest.split(MIDDLE, 1)
    return b"".join((a, middle, b) if form == "psm" else (b, middle, a))


def fill_in_middle(docs: DataFrame, rate: int = 50, spm_rate: int = 80, seed: int = 42, unit: str = "token",
                   id_col: str = "doc_id", text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """The ``columns`` of ``docs`` (all by default) with n (tokens, or code
    points with ``unit="char"``), form (plain, psm, spm), prefix_chars,
    middle_chars (code points; null if plain) and output.  ``rate`` per cent of
    the texts are reordered, ``spm_rate`` per cent of them suffix first."""
    if unit not in ("token", "char"):
        raise ValueError("unit is token or char")
    own = _ADDED.names
    columns = [c for c in (docs.columns if columns is None else columns) if c not in own]
    carried = docs.select(*columns, F.col(id_col).cast("string").alias("__id"),
                          F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("__id").to_pylist()
            out: dict[str, list] = {name: [] for name in own}
            for s in ts.slices(batch.column("__text")):
                ends, first = token_ends(s) if unit == "token" else (None, None)
                for r in range(s.rows):
                    h1, h2, h3, h4 = draws(ids[s.first + r], seed)
                    begin = int(s.begin[r])
                    data = s.data[begin:int(s.end[r])]
                    text = data.tobytes()
                    index = None
                    if unit == "token":
                        n = int(first[r + 1] - first[r])
                    else:
                        index = ExceptionIndex.of(data)
                        n = int(index.to_chars(len(text)))
                    out["n"].append(n)
                    plain = not text or h3 % 100 >= rate or any(x in text for x in (PREFIX, SUFFIX, MIDDLE))
                    form = "plain" if plain else "spm" if h4 % 100 < spm_rate else "psm"
                    out["form"].append(form)
                    if plain:
                        out["prefix_chars"].append(None)
                        out["middle_chars"].append(None)
                        out["output"].append(text)
                        continue
                    units = np.sort(np.array([h1 % (n + 1), h2 % (n + 1)]))
                    index = index or ExceptionIndex.of(data)
                    if unit == "token":
                        # the end of token k, or the start of the text
                        cuts = np.where(units > 0, ends[first[r] + np.maximum(units, 1) - 1] - begin, 0)
                        chars = index.to_chars(cuts)
                    else:
                        chars, cuts = units, index.to_bytes(units)
                    out["prefix_chars"].append(int(chars[0]))
                    out["middle_chars"].append(int(chars[1] - chars[0]))
                    out["output"].append(arrange(text, int(cuts[0]), int(cuts[1]), form))
            arrays = [pa.array(out["n"], pa.int64()), pa.array(out["form"], pa.string()),
                      pa.array(out["prefix_chars"], pa.int64()), pa.array(out["middle_chars"], pa.int64()),
                      pa.array(out["output"], pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *arrays], [*columns, *own])

    return carried.mapInArrow(run, T.StructType([carried.schema[c] for c in columns] + list(_ADDED.fields)))


def restored(outputs: DataFrame, output_col: str = "output", form_col: str = "form", into: str = "restored"
             ) -> DataFrame:
    """``outputs`` with the exact text rebuilt from output and form."""
    columns = [c for c in outputs.columns if c != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(output_col).cast(pa.large_binary())
            forms = batch.column(form_col).to_pylist()
            back = [None if f is None or not t.is_valid else restore(t.as_py(), f) for t, f in zip(texts, forms)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(back, pa.binary()).cast(pa.string())],
                [*columns, into])

    return outputs.select(*columns).mapInArrow(
        run, T.StructType([outputs.schema[c] for c in columns] + [T.StructField(into, T.StringType())]))
