"""Benchmark decontamination by a prefix-filtered set join.

An item is cut into windows of ``window`` words (one shorter window, if it has
fewer).  A window is the set of its placed word shingles (shingle, offset).  A
document window of the same length contains it if at least ``containment`` of
the set occurs there, shingle by shingle at the same offsets; with 1.0 that is
a word-for-word occurrence.

The join: shingles are ordered by rarity in the whole corpus; by the prefix
principle an occurrence must hold one of the ``m - ceil(containment * m) + 1``
rarest of its window's m shingles, so only those are looked up.  A hit gives
the window's start (positional bound); the start and the window's length must
lie inside the document (length bound); then words are compared one by one.

The items' windows are shipped to the tasks in blocks of a bounded size, one
pass over the documents per block, so their number isn't limited; documents
are neither shuffled nor collected.

Defined cases: words are runs of digits, letters a-z (A-Z folded) and all
non-ASCII characters; null and empty texts have no words and no hits; null item
texts have no windows, and an item without id makes hits but is not listed;
repeated rows are judged one by one; without items nothing is hit; clashing
columns of the input are replaced.
"""

from __future__ import annotations

import math
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from eventide.llm import textscan as ts
from eventide.llm.scratch import materialize

WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Text of the windows that one pass ships to every task.
BLOCK_BYTES = 8 << 20

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    T.StructField("item_ids", T.ArrayType(T.LongType())),
])
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def words_column(text: Column) -> Column:
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(F.regexp_extract_all(low, F.lit(f"({WORD_PATTERN})"), F.lit(1)), F.array())


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct windows (words joined by blanks) with the items that hold them."""
    w = F.col("__w")
    cut = F.when(F.size(w) == 0, F.array().cast("array<string>")) \
        .when(F.size(w) <= window, F.array(F.array_join(w, " "))) \
        .otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - window + 1, F.lit(1))),
                               lambda i: F.array_join(F.slice(w, i, window), " ")))
    rows = items.select(F.col(id_col).cast("long").alias("item"),
                        words_column(F.col(text_col).cast("string")).alias("__w"))
    return (rows.select("item", F.explode(cut).alias("window"))
            .groupBy("window").agg(F.collect_set("item").alias("items")))


class Index(NamedTuple):
    """Windows of one block and the shingles to look up."""

    length: np.ndarray      # words of each window
    text: list              # bytes, words joined by blanks
    hashes: np.ndarray      # (windows, longest): word hashes, 0 beyond the length
    items: list             # item ids of each window
    sizes: list             # shingle lengths in use
    keys: np.ndarray        # sorted distinct shingle hashes
    first: np.ndarray       # keys[i] has the postings first[i] .. first[i + 1]
    post_window: np.ndarray
    post_offset: np.ndarray


def _placed_shingles(rows: list, shingle: int):
    """(length, hashes, window, offset, hash) of the windows of a block."""
    texts = pa.array([r["window"] for r in rows], pa.large_string())
    length, parts, win, off, key = [], [], [], [], []
    for s in ts.slices(texts):
        w = ts.words(s, ts.ALNUM_WORD)
        n = np.diff(w.first)
        length.append(n)
        parts += [w.hash[a:b] for a, b in zip(w.first[:-1], w.first[1:])]
        for size in range(1, shingle + 1):
            at, h = ts.shingles(w, size)
            # windows shorter than a shingle are one shingle as a whole
            mine = (n[w.row[at]] >= shingle) if size == shingle else (n[w.row[at]] == size)
            at, h = at[mine], h[mine]
            win.append(w.row[at] + s.first)
            off.append(at - w.first[w.row[at]])
            key.append(h)
    length = np.concatenate(length)
    hashes = np.zeros((len(length), max(1, int(length.max()))), np.uint64)
    for i, p in enumerate(parts):
        hashes[i, :len(p)] = p
    return length, hashes, np.concatenate(win), np.concatenate(off), np.concatenate(key)


def _shingle_counts(docs: DataFrame, text_col: str, keys, sizes: list) -> DataFrame:
    """How often each of the (sorted) ``keys`` occurs in the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = keys.value
        seen = np.zeros(len(known), np.int64)
        for batch in batches:
            for s in ts.slices(batch.column(0)):
                w = ts.words(s, ts.ALNUM_WORD)
                for size in sizes:
                    _, h = ts.shingles(w, size)
                    i = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    seen += np.bincount(i[known[i] == h], minlength=len(known))
        i = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(seen[i])], ["i", "n"])

    return (docs.select(text_col).mapInArrow(count, "i long, n long")
            .groupBy("i").agg(F.sum("n").alias("n")))


def build_index(docs: DataFrame, text_col: str, rows: list, shingle: int, containment: float) -> Index:
    """Order the block's shingles by rarity and keep each window's prefix."""
    length, hashes, win, off, key = _placed_shingles(rows, shingle)
    sizes = sorted({int(min(shingle, n)) for n in set(length.tolist())})
    known = np.unique(key)
    shipped = docs.sparkSession.sparkContext.broadcast(known)
    rarity = np.zeros(len(known), np.int64)
    for r in _shingle_counts(docs, text_col, shipped, sizes).toLocalIterator():     # one row per key at most
        rarity[r["i"]] = r["n"]
    shipped.destroy()
    count = rarity[np.searchsorted(known, key)]
    order = np.lexsort((off, key, count, win))
    win, off, key, count = win[order], off[order], key[order], count[order]
    m = np.bincount(win, minlength=len(length))
    rank = np.arange(len(win)) - np.concatenate(([0], np.cumsum(m)))[win]
    need = np.array([n - math.ceil(containment * n) + 1 for n in m.tolist()])
    keep = (rank < need[win]) & (count > 0)     # a shingle that nowhere occurs finds nothing
    win, off, key = win[keep], off[keep], key[keep]
    order = np.argsort(key, kind="stable")
    keys, first = np.unique(key[order], return_index=True)
    return Index(length, [r["window"].encode() for r in rows], hashes,
                 [sorted(r["items"]) for r in rows], sizes, keys,
                 np.append(first, len(key)), win[order], off[order])


def find_windows(s: ts.Slice, w: ts.Words, x: Index, shingle: int, containment: float):
    """(first word, window) of all occurrences in the rows of a slice."""
    starts, wins = [], []
    for size in x.sizes:
        if not len(x.keys):
            break
        at, h = ts.shingles(w, size)
        i = np.minimum(np.searchsorted(x.keys, h), len(x.keys) - 1)
        hit = x.keys[i] == h
        at, i = at[hit], i[hit]
        n = x.first[i + 1] - x.first[i]
        post = np.repeat(x.first[i], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        win = x.post_window[post]
        start = np.repeat(at, n) - x.post_offset[post]
        row = np.repeat(w.row[at], n)
        inside = (start >= w.first[row]) & (start + x.length[win] <= w.first[row + 1]) \
            & (np.minimum(x.length[win], shingle) == size)
        starts.append(start[inside])
        wins.append(win[inside])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(np.stack([np.concatenate(starts), np.concatenate(wins)], 1), axis=0)
    start, win = pairs[:, 0], pairs[:, 1]
    # words by hash first, all candidates at once
    longest = x.hashes.shape[1]
    at = start[:, None] + np.arange(longest)
    used = np.arange(longest) < x.length[win][:, None]
    same = used & (w.hash[np.minimum(at, max(len(w.hash) - 1, 0))] == x.hashes[win])
    good = np.zeros(len(start), bool)
    shingles = np.maximum(x.length[win] - shingle + 1, 1)
    need = np.ceil(containment * shingles - 1e-9).astype(int)
    for size in x.sizes:
        mine = np.minimum(x.length[win], shingle) == size
        run = np.ones((int(mine.sum()), longest - size + 1), bool)
        for k in range(size):
            run &= same[mine][:, k:longest - size + 1 + k]
        good[mine] = run.sum(1) >= need[mine]
    start, win, same = start[good], win[good], same[good]
    # then the bytes of the words that count as equal
    exact = np.ones(len(start), bool)
    for j, (a, q) in enumerate(zip(start.tolist(), win.tolist())):
        n = int(x.length[q])
        mine = [bytes(s.data[b:e]).lower() for b, e in zip(w.start[a:a + n], w.end[a:a + n])]
        if same[j, :n].all():
            exact[j] = b" ".join(mine) == x.text[q]
        else:
            theirs = x.text[q].split(b" ")
            eq = [f and p == t for f, p, t in zip(same[j], mine, theirs)]
            size = min(shingle, n)
            exact[j] = sum(all(eq[k:k + size]) for k in range(n - size + 1)) >= need[good][j]
    return start[exact], win[exact]


def _merge(spans: list) -> list:
    out: list = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 3,
                  containment: float = 1.0, id_col: str = "item_id", text_col: str = "text",
                  item_text_col: str = "text", columns: list[str] | None = None,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``columns`` of ``docs`` (all by default) with n_words, hit_spans
    (merged ranges of words inside occurrences) and item_ids (sorted)."""
    spark = docs.sparkSession
    own = RESULT.fieldNames()
    columns = [c for c in (docs.columns if columns is None else columns) if c not in own]
    windows = materialize(item_windows(items, window, id_col, item_text_col), "windows")
    total = windows.agg(F.sum(F.octet_length("window") + 8 * F.size("items"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    todo = docs.select(*columns, *([] if text_col in columns else [text_col]))
    for b in range(blocks):
        rows = windows.filter(F.expr(f"pmod(xxhash64(window), {blocks}) = {b}")).orderBy("window").collect()
        index = build_index(docs, text_col, rows, shingle, containment) if rows else None
        last = b == blocks - 1
        todo = _scan(todo, index, text_col, columns if last else
                     [c for c in todo.columns if c not in own], shingle, containment)
        if not last:
            todo = materialize(todo, "decontaminate")
    return todo


def _scan(docs: DataFrame, index: Index | None, text_col: str, columns: list[str], shingle: int,
          containment: float) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(index)
    schema = T.StructType([docs.schema[c] for c in columns] + RESULT.fields)
    names = [*columns, *RESULT.fieldNames()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = shipped.value
        for batch in batches:
            before = "item_ids" in batch.schema.names
            n_words, spans, items = [], [], []
            for s in ts.slices(batch.column(text_col)):
                w = ts.words(s, ts.ALNUM_WORD)
                start, win = (find_windows(s, w, x, shingle, containment) if x is not None
                              else (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                row_of = w.row[start] if len(start) else start
                found: dict = {}
                for r, a, q in zip(row_of.tolist(), start.tolist(), win.tolist()):
                    found.setdefault(r, []).append((a - int(w.first[r]), q))
                counts = np.diff(w.first)
                for r in range(s.rows):
                    got, ids = [], set()
                    if before:
                        got = [(p["start"], p["end"]) for p in batch.column("hit_spans")[s.first + r].as_py()]
                        ids = set(batch.column("item_ids")[s.first + r].as_py())
                    for a, q in found.get(r, ()):
                        got.append((a, a + int(x.length[q])))
                        ids.update(x.items[q])
                    n_words.append(int(counts[r]))
                    spans.append([{"start": a, "end": b} for a, b in _merge(got)])
                    items.append(sorted(ids))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(n_words, pa.int64()),
                 pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.int64()))], names)

    return docs.mapInArrow(scan, schema)
