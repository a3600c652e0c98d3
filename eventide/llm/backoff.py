"""Stupid-backoff language-model scores, computed relationally.

The model is the n-gram count table of the documents themselves.  A word scores
c(context word) / c(context) for the longest context, up to ``order`` - 1 words
of its document, whose n-gram was counted at least ``cutoff`` times; every step
to a shorter context costs a factor ``alpha``, and at the end stands c(word) /
c(all words).  A document's score is the sum of the logarithms (base 10).

The joins are those of exploded n-grams with the count table, but on packed
rows: documents are dealt into units; a unit sends its distinct n-grams, with
its own counts, as sorted arrays to the table's partitions (ranges of the
n-gram hash); a partition adds the counts up and answers each unit; the unit's
documents meet the answers and sum their words.  A frequent n-gram is one entry
per unit, wherever it stands.

n-grams are known by hashes of ``SPARE_BITS`` more bits than the corpus size in
bytes has (at most 64 in all), so the chance that an n-gram shares its hash with
another one is about one in a million at any size.

Defined cases: words are runs of digits, letters and non-ASCII characters, A-Z
folded; a null or empty text has no words and score 0; repeated rows count and
score one by one, null ids included; an empty table gives no rows; extra
columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventide.llm import textscan as ts
from eventide.llm.scratch import materialize

_U = np.uint64
#: Text bytes of a unit, about, and those that a partition of the count table stands for.
UNIT_BYTES = 6 << 20
PART_BYTES = 4 << 20
#: Bits that n-gram hashes have beyond those of the corpus size in bytes.
SPARE_BITS = 20


def unit_grams(texts, order: int, id_bits: int):
    """(row of each word, place of the word in its row, distinct keys, unit
    counts, per n: index of the n-gram that starts at each word, or -1)."""
    row, place, hashes, first_row = [], [], [], 0
    grams: list = [[] for _ in range(order)]
    at_word = 0
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    for s in ts.slices(texts):
        w = ts.words(s, ts.ALNUM_WORD)
        row.append(w.row + s.first)
        place.append(np.arange(len(w.row)) - w.first[w.row])
        for n in range(1, order + 1):
            at, h = ts.shingles(w, n)
            grams[n - 1].append((at + at_word, h))
        at_word += len(w.row)
    row = np.concatenate(row) if row else np.zeros(0, np.int64)
    place = np.concatenate(place) if place else np.zeros(0, np.int64)
    at = [np.concatenate([g[0] for g in gs]) if gs else np.zeros(0, np.int64) for gs in grams]
    keys = [np.concatenate([g[1] for g in gs]) if gs else np.zeros(0, np.uint64) for gs in grams]
    every = np.concatenate(keys) >> _U(64 - id_bits)
    uniq, inv, count = np.unique(every, return_inverse=True, return_counts=True)
    index, i = [], 0
    for a in at:
        ix = np.full(len(row), -1, np.int64)
        ix[a] = inv[i:i + len(a)]
        index.append(ix)
        i += len(a)
    return row, place, uniq, count, index


def _cuts(uniq: np.ndarray, parts: int, id_bits: int) -> np.ndarray:
    """Where the key ranges of the table's partitions begin in sorted keys."""
    edges = [(p << id_bits) // parts for p in range(1, parts)]
    return np.concatenate(([0], np.searchsorted(uniq, np.array(edges, np.uint64)), [len(uniq)])).astype(np.int64)


def backoff_scores(docs: DataFrame, order: int = 3, cutoff: int = 2, alpha: float = 0.4, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, score, score_per_word (null
    without words), backoffs (steps to shorter contexts)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    units = max(1, -(-total // UNIT_BYTES))
    parts = max(1, -(-total // PART_BYTES))
    id_bits = min(64, SPARE_BITS + max(1, math.ceil(math.log2(total + 2))))
    rows = docs.select(F.pmod(F.xxhash64(F.col(id_col), F.octet_length(text), F.crc32(text.cast("binary"))),
                              F.lit(units)).cast("int").alias("unit"),
                       F.col(id_col).alias("doc_id"), text.alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()

    def ask(table: pa.Table) -> pa.Table:
        _, _, uniq, count, _ = unit_grams(table.column("text"), order, id_bits)
        cut = _cuts(uniq, parts, id_bits)
        out = {"part": [], "unit": [], "keys": [], "counts": []}
        for p, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
            if b > a:
                out["part"].append(p)
                out["unit"].append(table.column("unit")[0].as_py())
                out["keys"].append(ts.planes(np.diff(uniq[a:b], prepend=_U(0))))
                out["counts"].append(ts.planes(count[a:b].astype(np.uint32)))
        return pa.table({"part": pa.array(out["part"], pa.int32()), "unit": pa.array(out["unit"], pa.int32()),
                         "keys": pa.array(out["keys"], pa.binary()), "counts": pa.array(out["counts"], pa.binary())})

    def add_up(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(ts.from_planes(k, np.uint64), dtype=np.uint64) for k in table.column("keys").to_pylist()]
        counts = np.concatenate([ts.from_planes(c, np.uint32) for c in table.column("counts").to_pylist()])
        sizes = np.cumsum([0] + [len(k) for k in keys])
        uniq, inv = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        total = np.bincount(inv, weights=counts, minlength=len(uniq)).astype(np.uint64)
        answers = [ts.planes(total[inv[a:b]]) for a, b in zip(sizes[:-1], sizes[1:])]
        return pa.table({"unit": table.column("unit"), "part": table.column("part"),
                         "totals": pa.array(answers, pa.binary())})

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        row, place, uniq, _, index = unit_grams(left.column("text"), order, id_bits)
        by_part = sorted(zip(right.column("part").to_pylist(), right.column("totals").to_pylist()))
        total = (np.concatenate([ts.from_planes(t, np.uint64) for _, t in by_part]) if by_part
                 else np.zeros(0, np.uint64)).astype(np.float64)
        n_docs, n = left.num_rows, len(row)
        words = np.arange(n)
        value, steps, open_ = np.zeros(n), np.zeros(n, np.int64), np.ones(n, bool)
        for size in range(order, 1, -1):
            i = words[open_ & (place >= size - 1)]
            c = total[index[size - 1][i - size + 1]]
            seen = c >= cutoff
            j = i[seen]
            value[j] = np.log10(c[seen]) - np.log10(total[index[size - 2][j - size + 1]])
            open_[j] = False
            steps[i[~seen]] += 1
        j = words[open_]
        value[j] = np.log10(total[index[0][j]])         # over all words: see below
        value += steps * math.log10(alpha)
        return pa.table({"doc_id": left.column("doc_id"),
                         "n_words": np.bincount(row, minlength=n_docs),
                         "part_score": np.bincount(row, weights=value, minlength=n_docs).astype(np.float64),
                         "n_single": np.bincount(row, weights=open_, minlength=n_docs).astype(np.int64),
                         "backoffs": np.bincount(row, weights=steps, minlength=n_docs).astype(np.int64)})

    asked = rows.groupBy("unit").applyInArrow(ask, "part int, unit int, keys binary, counts binary")
    answered = asked.groupBy("part").applyInArrow(add_up, "unit int, part int, totals binary")
    scored = materialize(
        rows.groupBy("unit").cogroup(answered.groupBy("unit")).applyInArrow(
            score, f"doc_id {id_type}, n_words long, part_score double, n_single long, backoffs long"), "scores")
    # words that are scored without context share the number of all words
    words = scored.agg(F.sum("n_words")).first()[0] or 1
    value = F.col("part_score") - F.col("n_single") * math.log10(max(1, words))
    return scored.select("doc_id", "n_words", value.alias("score"),
                         F.when(F.col("n_words") > 0, value / F.col("n_words")).alias("score_per_word"), "backoffs")
