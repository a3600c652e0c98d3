"""Exact substring deduplication over a sparse suffix array.

A byte goes if some ``length``-byte string that covers it also starts earlier
(in a document with a smaller id, or earlier in the same one).  The suffixes
are put in order by bucket-pointer refinement, as deep as ``length`` bytes:

1.  Initial buckets.  A suffix's bucket is its first q = length / 2 bytes (a
    64-bit identifier).  Of the suffixes only anchors enter: in every window of
    ``length`` bytes the q-gram with the smallest identifier (leftmost, if
    equal), so equal windows have equal anchors at the same place.  An anchor
    stands for the run of windows that chose it, about q / 2 of them.
2.  Refinement by later offsets.  Anchors of a bucket are sorted on the
    identifiers at the later offsets of their run (its first window's two
    halves and its last one's second half): equal identifiers mean that all
    windows of the run are equal.  Anchors alone in their bucket are final.
    Anchors equal to an earlier one are repeats as a whole.
3.  Recursion.  A bucket that step 2 has split hands its distinct members down:
    each of their windows is a suffix of its own, with (identifier, identifier
    at offset q) as its refined bucket, i.e. the initial buckets' identifiers
    are used again at the later offset.  In a refined bucket all but the
    earliest suffix are repeats.

Every task first refines what it has itself, so a bucket, however frequent,
gets at most one row of a kind from each task; buckets are then dealt by
identifier in packed arrays.  Texts are shuffled once by document.

Defined cases: matches never cross documents; null and empty texts, and texts
shorter than ``length``, lose nothing; a null id sorts first; rows with equal
ids are separate documents, ordered by text; an empty table gives no rows;
clashing columns of the input are replaced.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from eventide.llm import textscan as ts

_U = np.uint64
#: Window starts looked at together (longer documents go in pieces).
PIECE = 1 << 20
#: Text bytes that one bucket's packed arrays stand for, about.
BUCKET_TEXT_BYTES = 32 << 20

ANCHOR, SEVERAL, REPEAT, OPEN = 0, 1, 2, 3
# 96 bits tell buckets apart: a is the identifier, b half of a second one.
_FIELDS = [("a", np.uint64), ("b", np.uint32), ("doc", np.int64), ("ord", np.int32), ("at", np.uint32),
           ("n", np.uint32), ("kind", np.int8)]
PACKED = "bucket int, " + ", ".join(f"{f} binary" for f, _ in _FIELDS)
FOUND = "doc long, ord int, at long, n int, open boolean"


def gram_ids(data: np.ndarray, q: int) -> np.ndarray:
    """Identifier of the q bytes from every position."""
    h, iv = ts.prefix_hash(data)
    n = len(data) - q + 1
    return ts.mix64((h[q:q + n] - h[:n]) * iv[:n])


def _window_min(x: np.ndarray, size: int) -> np.ndarray:
    out, span = x, 1
    while span * 2 <= size:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = size - span
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def anchors(s: ts.Slice, length: int):
    """(identifier, context identifier, row, offset of the first window, windows)
    of all anchors in a slice."""
    q = length // 2
    got = []
    step = max(PIECE, 1)
    for i in range(0, max(len(s.data) - length + 1, 0), step):
        data = s.data[i:i + step + length - 1]
        g = gram_ids(data, q)
        bits = _U(max(1, int(len(g)).bit_length()))
        place = np.arange(len(g), dtype=np.uint64)
        low = _window_min(((g >> bits) << bits) | place, length - q + 1)
        best = (low & ((_U(1) << bits) - _U(1))).astype(np.int64)
        starts = np.arange(i, i + len(best))
        row = np.searchsorted(s.begin, starts, "right") - 1
        valid = starts + length <= s.end[row]
        edge = valid.copy()
        edge[1:] &= ~valid[:-1] | (best[1:] != best[:-1])
        lo = np.flatnonzero(edge)
        if not len(lo):
            continue
        # a run ends before the next run or the next window that isn't inside
        stop = np.flatnonzero(np.append(edge[1:] | ~valid[1:], True) & valid)
        n = stop - lo + 1
        ctx = ts.mix64(g[lo] + _U(7))
        for part in (g[lo + length - q], g[stop + length - q], n.astype(np.uint64)):
            ctx = ts.mix64(ctx * _U(0xD1342543DE82EF95) + part)
        got.append((g[best[lo]], (ctx >> _U(32)).astype(np.uint32), row[lo], lo + i - s.begin[row[lo]], n))
    if not got:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint32, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*got))


def _columns(**given) -> dict:
    n = len(given["doc"])
    return {f: np.asarray(given.get(f, np.zeros(n, t)), t) for f, t in _FIELDS}


def _join(parts: list[dict]) -> dict:
    return {f: np.concatenate([p[f] for p in parts]) if parts else np.zeros(0, t) for f, t in _FIELDS}


def _take(x: dict, at: np.ndarray, **change) -> dict:
    return {f: (np.full(int(at.sum()) if at.dtype == bool else len(at), change[f], t) if f in change else x[f][at])
            for f, t in _FIELDS}


def refine(x: dict) -> tuple[dict, dict, np.ndarray]:
    """Sort rows that share their first identifier.  Returns the rows that
    have company, whether each repeats an earlier row with both identifiers
    equal, and marks of the rows whose bucket holds several contexts."""
    order = np.argsort(x["a"], kind="stable")
    a = x["a"][order]
    same = a[1:] == a[:-1]
    some = np.zeros(len(a), bool)
    some[1:] |= same
    some[:-1] |= same
    x = _take(x, order[some])
    order = np.lexsort((x["at"], x["ord"], x["doc"], x["b"], x["kind"] != SEVERAL, x["a"]))
    x = _take(x, order)
    new_a = np.ones(len(x["a"]), bool)
    new_a[1:] = x["a"][1:] != x["a"][:-1]
    new_b = new_a.copy()
    new_b[1:] |= (x["b"][1:] != x["b"][:-1]) | (x["kind"][1:] != x["kind"][:-1])
    bucket = np.cumsum(new_a) - 1
    several = np.bincount(bucket, weights=new_b, minlength=int(new_a.sum())) > 1
    return x, ~new_b, several[bucket]


def locally(x: dict) -> dict:
    """Refine one task's own anchors: what is settled, what goes on."""
    order = np.argsort(x["a"], kind="stable")
    a = x["a"][order]
    alone = np.ones(len(a), bool)
    alone[1:] &= a[1:] != a[:-1]
    alone[:-1] &= a[1:] != a[:-1]
    y, repeat, several = refine(x)
    single = ~repeat & ~several
    split = ~repeat & several
    first = split.copy()
    if len(split):
        first[1:] &= y["a"][1:] != y["a"][:-1]
    return _join([_take(x, np.sort(order[alone])), _take(y, single),
                  _take(y, repeat, kind=REPEAT), _take(y, split, kind=OPEN), _take(y, first, kind=SEVERAL)])


def pack(x: dict, buckets: int) -> pa.RecordBatch:
    """One row per bucket; in it, rows in document order (they compress well)."""
    order = np.lexsort((x["at"], x["ord"], x["doc"]))
    x = _take(x, order)
    bucket = ((x["a"] >> _U(32)) % _U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    x, bucket = _take(x, order), bucket[order]
    used, first = np.unique(bucket, return_index=True)
    cut = np.append(first, len(bucket))
    cols = [pa.array(used, pa.int32())]
    for f, t in _FIELDS:
        cols.append(pa.array([ts.planes(x[f][i:j]) for i, j in zip(cut[:-1], cut[1:])], pa.binary()))
    return pa.RecordBatch.from_arrays(cols, ["bucket", *(f for f, _ in _FIELDS)])


def unpack(table: pa.Table) -> dict:
    return {f: np.concatenate([ts.from_planes(c, t) for c in table.column(f).to_pylist()]) for f, t in _FIELDS}


def _found(parts: list[dict]) -> pa.Table:
    x = _join(parts)
    return pa.table({"doc": x["doc"], "ord": x["ord"], "at": x["at"].astype(np.int64),
                     "n": x["n"].astype(np.int32), "open": x["kind"] == OPEN})


def settle_anchors(table: pa.Table) -> pa.Table:
    """Steps 1 and 2 for one bucket of identifiers."""
    x = unpack(table)
    through = x["kind"] >= REPEAT
    y, repeat, several = refine(_take(x, ~through))
    real = y["kind"] == ANCHOR
    return _found([_take(x, through), _take(y, repeat & real, kind=REPEAT),
                   _take(y, ~repeat & several & real, kind=OPEN)])


def settle_windows(table: pa.Table) -> pa.Table:
    """Step 3 for one bucket of refined identifiers."""
    x = unpack(table)
    through = x["kind"] == REPEAT
    y, repeat, _ = refine(_take(x, ~through))
    return _found([_take(x, through), _take(y, repeat, kind=REPEAT)])


def _runs(at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge overlapping or touching [at, at + n)."""
    order = np.argsort(at, kind="stable")
    at, end = at[order], np.maximum.accumulate((at + n)[order])
    new = np.ones(len(at), bool)
    new[1:] = at[1:] > end[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1) if len(at) else np.zeros(0, int)
    return at[new], end[last] - at[new]


def documents_with_order(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[str]]:
    """Add __doc (null: smallest) and __ord, which tells rows of one id apart;
    and say which of the two it takes to know a document."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-2 ** 63).cast("long"))
    docs = docs.withColumn("__doc", key)
    several = docs.groupBy("__doc").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()
    if not several:
        return docs.withColumn("__ord", F.lit(0)), ["doc"]
    order = Window.partitionBy("__doc").orderBy(text_col)
    return docs.withColumn("__ord", F.row_number().over(order)), ["doc", "ord"]


def drop_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text",
                 columns: list[str] | None = None) -> DataFrame:
    """The ``columns`` of ``docs`` (all by default) with removed (byte ranges
    start, end in order) and kept (the remaining bytes)."""
    spark = docs.sparkSession
    own = ["removed", "kept"]
    columns = [c for c in (docs.columns if columns is None else columns) if c not in own]
    base, known_by = documents_with_order(docs, id_col, text_col)
    base = base.withColumn("__bytes", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    carried = base.select(*columns, "__doc", "__ord", "__bytes")
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_TEXT_BYTES))
    q = length // 2

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, order = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            parts = []
            for s in ts.slices(batch.column(2), 2 * PIECE):
                a, b, row, at, n = anchors(s, length)
                row = row + s.first
                parts.append(_columns(a=a, b=b, doc=doc[row], ord=order[row], at=at, n=n))
            yield pack(locally(_join(parts)), buckets)

    def open_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, order = batch.column("__doc").to_numpy(), batch.column("__ord").to_numpy()
            parts = []
            for r in range(batch.num_rows):
                marks = batch.column("__marks")[r].values
                at, n, is_open = (marks.field(k).to_numpy(zero_copy_only=False) for k in ("at", "n", "open"))
                f_at, f_n = _runs(at[~is_open], n[~is_open])
                parts.append(_columns(a=ts.mix64(f_at.astype(np.uint64)), doc=np.full(len(f_at), doc[r]),
                                      ord=np.full(len(f_at), order[r]), at=f_at, n=f_n,
                                      kind=np.full(len(f_at), REPEAT)))
                at, n = _runs(at[is_open], n[is_open])
                raw = np.frombuffer(batch.column("__bytes")[r].as_buffer(), np.uint8)
                for lo, k in zip(at.tolist(), n.tolist()):
                    for i in range(lo, lo + k, PIECE):
                        m = min(PIECE, lo + k - i)
                        g = gram_ids(raw[i:i + m + length - 1], q)
                        # the refined identifier is that of both halves
                        a, b = g[:m], g[length - q:length - q + m]
                        parts.append(_columns(a=ts.mix64(a * _U(0xD1342543DE82EF95) + b),
                                              b=(ts.mix64(b * _U(0xD1342543DE82EF95) + a) >> _U(32)), doc=np.full(m, doc[r]),
                                              ord=np.full(m, order[r]), at=np.arange(i, i + m), n=np.ones(m)))
            x = _join(parts)
            windows = x["kind"] != REPEAT
            y = _take(x, windows)
            z, repeat, _ = refine(y)
            own_first = _take(z, ~repeat)
            order_ = np.argsort(y["a"], kind="stable")
            a = y["a"][order_]
            alone = np.ones(len(a), bool)
            alone[1:] &= a[1:] != a[:-1]
            alone[:-1] &= a[1:] != a[:-1]
            yield pack(_join([_take(x, ~windows), _take(y, order_[alone]), own_first,
                              _take(z, repeat, kind=REPEAT)]), buckets)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans, kept = [], []
            for r in range(batch.num_rows):
                raw = batch.column("__bytes")[r].as_buffer().to_pybytes()
                marks = batch.column("__marks")[r]
                if not marks.is_valid:
                    spans.append([])
                    kept.append(raw)
                    continue
                at, n = (marks.values.field(k).to_numpy(zero_copy_only=False) for k in ("at", "n"))
                at, n = _runs(at, n + (length - 1))
                pieces, last = [], 0
                for i, m in zip(at.tolist(), n.tolist()):
                    pieces.append(raw[last:i])
                    last = i + m
                kept.append(b"".join([*pieces, raw[last:]]))
                spans.append([{"start": i, "end": i + m} for i, m in zip(at.tolist(), n.tolist())])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(spans, kind), pa.array(kept, pa.binary())],
                [*columns, *own])

    def per_document(found: DataFrame) -> DataFrame:        # a list no longer than its text
        return found.groupBy(*known_by).agg(F.collect_list(F.struct("at", "n", "open")).alias("__marks"))

    first = (carried.select("__doc", "__ord", "__bytes").mapInArrow(scan, PACKED)
             .groupBy("bucket").applyInArrow(settle_anchors, FOUND))
    keys = lambda d: [F.col(f"__{k}") == d[k] for k in known_by]
    marked = per_document(first)
    # both joins take the same columns of the documents, so they share one shuffle of the texts
    second = (carried.join(marked, keys(marked)).mapInArrow(open_windows, PACKED)
              .groupBy("bucket").applyInArrow(settle_windows, FOUND))
    gone = per_document(second)
    schema = T.StructType([carried.schema[c] for c in columns] + [
        T.StructField("removed", T.ArrayType(T.StructType([
            T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("kept", T.BinaryType())])
    return carried.join(gone, keys(gone), "left").mapInArrow(cut, schema)
