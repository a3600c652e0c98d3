"""Near duplicates by one-permutation MinHash with optimal densification.

One hash per shingle: its high part picks a bin, the smallest hash of a bin is
the bin's value, and empty bins borrow from bins drawn by a hash of (bin,
attempt) until one is full (optimal densification).  Bins are grouped into
bands; documents that agree in a band share a bucket.

Buckets give star-shaped candidates: members are compared with centres, not with
every other member.  The order of centres is the same in all buckets (the member
whose buckets are the fullest comes first), so the buckets of one family agree on
few centres.  In a round a member is compared with the centres it shares most
buckets with, and only members of the smaller group are; rounds have more centres
as fewer members are left.  Groups that are linked hook themselves to the larger
one after each round, and a bucket goes on while it holds several.
What is mixed after all ``ROUNDS`` goes to an exact join: two sets that are
alike share one of their rarest shingles (prefix filter with lengths and
positions), so that every pair of a bucket is compared, known to be of one
group, or unable to be alike.  Candidates are confirmed on the full shingle
sets, and links are joined into components.

Documents with equal sets are one class from the start: only the smallest id
of a class is compared.

Defined cases: a null text, or one without words, has an empty set and is
linked with nothing; with fewer words than a shingle the whole sequence is one
shingle; a null id is never linked and stays; rows that repeat an id are one
document, linked if any of its texts is; an empty table gives no rows; extra
columns are left out.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventide.llm import textscan as ts
from eventide.llm.components import connected_components
from eventide.llm.scratch import materialize

_U = np.uint64
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)
#: Centres of a bucket in each round; a member is compared with half of them.
ROUNDS = (1, 2, 4, 8)
#: Counters of shingles by which the exact join orders them.
SLOTS = 1 << 20


def shingle_sets(s: ts.Slice, size: int, word_class: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, shingle hash) of a slice, ordered by row."""
    w = ts.words(s, word_class)
    rows, hashes = [], []
    for k in range(1, size + 1):
        at, h = ts.shingles(w, k)
        if k < size:        # a text of k words is one shingle
            whole = np.diff(w.first)[w.row[at]] == k
            at, h = at[whole], h[whole]
        rows.append(w.row[at])
        hashes.append(h)
    row, h = np.concatenate(rows), np.concatenate(hashes)
    # one sort key for (row, hash): equal keys are equal pairs (but for a 64-bit chance)
    order = np.argsort(h ^ ts.mix64(row.astype(np.uint64) + _U(1)), kind="stable")
    row, h = row[order], h[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    row, h = row[fresh], h[fresh]
    order = np.argsort(row, kind="stable")
    return row[order], h[order]


def signatures(row: np.ndarray, h: np.ndarray, rows: int, bins: int) -> np.ndarray:
    """(rows, bins) densified one-permutation signatures."""
    x = ts.mix64(h + _U(0x5851F42D4C957F2D))
    at = ((x >> _U(32)) * _U(bins)) >> _U(32)
    sig = np.full(rows * bins, _EMPTY, np.uint64)
    np.minimum.at(sig, row * bins + at.astype(np.int64), ts.mix64(x))
    sig = sig.reshape(rows, bins)
    full = sig != _EMPTY
    out = sig.copy()
    todo_r, todo_b = np.nonzero(~full & full.any(1)[:, None])
    attempt = 0
    while len(todo_r):
        attempt += 1
        src = (ts.mix64(todo_b.astype(np.uint64) * _U(0x100000001B3) + _U(attempt << 20)) % _U(bins)).astype(np.int64)
        ok = full[todo_r, src]
        out[todo_r[ok], todo_b[ok]] = sig[todo_r[ok], src[ok]]
        todo_r, todo_b = todo_r[~ok], todo_b[~ok]
    return out


def signature_table(docs: DataFrame, shingle: int, bands: int, rows_per_band: int, word_class: np.ndarray,
                    id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, two 64-bit prints of the whole set, one key per band."""
    bins = bands * rows_per_band

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in ts.slices(batch.column(1)):
                row, h = shingle_sets(s, shingle, word_class)
                n = np.bincount(row, minlength=s.rows)
                edge = np.concatenate(([0], np.cumsum(n)))
                prints = []
                for salt in (_U(0x6A09E667F3BCC909), _U(0xBB67AE8584CAA73B)):
                    total = np.concatenate(([_U(0)], np.cumsum(ts.mix64(h ^ salt), dtype=np.uint64)))
                    prints.append((total[edge[1:]] - total[edge[:-1]]).view(np.int64))
                sig = signatures(row, h, s.rows, bins).reshape(s.rows, bands, rows_per_band)
                key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (s.rows, bands)) + _U(1)
                for k in range(rows_per_band):
                    key = ts.mix64(key * _U(0xD1342543DE82EF95) + sig[:, :, k])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.first, s.rows), pa.array(n), *map(pa.array, prints),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, s.rows * bands + 1, bands), pa.int32()),
                                              pa.array(np.ascontiguousarray(key).view(np.int64).ravel()))],
                    ["doc_id", "n_shingles", "print1", "print2", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(sign, "doc_id long, n_shingles long, print1 long, print2 long, bands array<long>")


def confirm(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int, word_class: np.ndarray) -> DataFrame:
    """``pairs`` (centre, member) whose full sets are alike.  Members' texts
    are joined first, so that a centre with very many members only meets them
    in a join that AQE may split."""

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            good = np.zeros(batch.num_rows, bool)
            i = 0
            while i < batch.num_rows:
                j, load = i, 0
                while j < batch.num_rows and (j == i or load < ts.SLICE_BYTES):
                    load += len(a[j].as_buffer()) + len(b[j].as_buffer())
                    j += 1
                sides = []
                for col in (a, b):
                    s = next(ts.slices(col.slice(i, j - i), 1 << 62))
                    sides.append(shingle_sets(s, shingle, word_class))
                (ra, ha), (rb, hb) = sides
                na, nb = (np.bincount(r, minlength=j - i) for r in (ra, rb))
                ka, kb = (h ^ ts.mix64(r.astype(np.uint64) + _U(1)) for r, h in sides)
                both = np.bincount(ra[np.isin(ka, kb)], minlength=j - i)
                good[i:j] = (both > 0) & (100 * both >= percent * (na + nb - both))
                i = j
            at = pa.array(np.flatnonzero(good))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)],
                                             ["centre", "member"])

    t = texts.select("doc_id", "text")
    both = (pairs.join(t.withColumnRenamed("text", "text_m"), F.col("member") == F.col("doc_id")).drop("doc_id")
            .join(t.withColumnRenamed("text", "text_c"), F.col("centre") == F.col("doc_id")).drop("doc_id"))
    return both.select("centre", "member", "text_c", "text_m").mapInArrow(alike, "centre long, member long").distinct()


def rare_shingles(texts: DataFrame, shingle: int, percent: int, word_class: np.ndarray) -> DataFrame:
    """(doc_id, n, token, at): of each text the rarest shingles, so many that
    two texts that are alike have one in common; ``at`` is the place among all
    shingles of the text, rarest first.  Rarity is read from ``SLOTS`` counters;
    any order that all texts share is right, a rough one only costs pairs."""

    def sets(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for s in ts.slices(batch.column(1)):
                row, h = shingle_sets(s, shingle, word_class)
                yield batch.column(0).slice(s.first, s.rows).to_numpy(zero_copy_only=False), row, h

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for _, _, h in sets(batches):
            total += np.bincount((h % _U(SLOTS)).astype(np.int64), minlength=SLOTS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["slot", "n"])

    rows = texts.select("doc_id", "text")
    table = rows.mapInArrow(tally, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SLOTS, np.int64)
    counts[table.column("slot").to_numpy()] = table.column("n").to_numpy()

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, row, h in sets(batches):
            often = counts[(h % _U(SLOTS)).astype(np.int64)]
            order = np.lexsort((h, often, row))
            row, h, often = row[order], h[order], often[order]
            n = np.bincount(row, minlength=len(ids))
            at = np.arange(len(row)) - (np.cumsum(n) - n)[row]
            # a shingle counted once is in no other text
            keep = np.flatnonzero((at <= n[row] - (percent * n[row] + 99) // 100) & (often > 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[row[keep]].astype(np.int64)), pa.array(n[row[keep]].astype(np.int64)),
                 pa.array(h[keep].view(np.int64)), pa.array(at[keep].astype(np.int64))], ["doc_id", "n", "token", "at"])

    return rows.mapInArrow(rarest, "doc_id long, n long, token long, at long")


def rare_pairs(texts: DataFrame, label: DataFrame, shingle: int, percent: int, word_class: np.ndarray) -> DataFrame:
    """(a, b) of all texts of different groups that may be alike."""
    rare = materialize(rare_shingles(texts, shingle, percent, word_class).join(label.select("doc_id", "label"), "doc_id"),
                       "rare")
    mixed = rare.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter(F.col("lo") != F.col("hi"))
    rare = materialize(rare.join(mixed.select("token"), "token"), "rare-shared")
    one, two = (rare.select("token", *(F.col(c).alias(c + x) for c in ("doc_id", "n", "at", "label"))) for x in "12")
    n = F.col("n1") + F.col("n2")
    left = F.least(F.col("n1") - F.col("at1"), F.col("n2") - F.col("at2"))      # of the first common one on
    return (one.join(two, (one["token"] == two["token"]) & (F.col("doc_id1") < F.col("doc_id2"))
                     & (F.col("label1") != F.col("label2")) & (left * (100 + percent) >= n * percent))
            .select(F.col("doc_id1").alias("a"), F.col("doc_id2").alias("b")).distinct())


def _between(links: DataFrame, group: DataFrame) -> DataFrame:
    """Links between different groups, as (from, to) labels."""
    one, two = (group.select(F.col("doc_id").alias(d), F.col("label").alias(x)) for d, x in
                (("centre", "from"), ("member", "to")))
    return links.join(one, "centre").join(two, "member").filter(F.col("from") != F.col("to")).select("from", "to")


def hooked(links: DataFrame, label: DataFrame, groups: DataFrame) -> DataFrame:
    """``label`` after new links: every group hooks itself to the largest group
    that it is linked with, if that is larger (equal: the smaller label), and
    goes by the group four hooks further at most.  Hooks only lead to larger
    groups, so there is no ring; what stays apart is joined in a later round or
    at the end."""
    edges = _between(links, label)
    edges = edges.unionByName(edges.select(F.col("to").alias("from"), F.col("from").alias("to")))
    a, b = (groups.select(F.col("label").alias(x), F.col("size").alias(f"size_{x}")) for x in ("from", "to"))
    rank = F.struct(F.col("size_to").alias("s"), (-F.col("to")).alias("l"), F.col("to").alias("t"))
    hook = materialize(
        edges.distinct().join(a, "from").join(b, "to")
        .filter(F.struct("size_to", -F.col("to")) > F.struct("size_from", -F.col("from")))
        .groupBy("from").agg(F.max(rank).alias("r")).select("from", F.col("r.t").alias("to")), "hooks")

    def twice(h: DataFrame) -> DataFrame:
        further = h.select(F.col("from").alias("to"), F.col("to").alias("end"))
        return h.join(further, "to", "left").select("from", F.coalesce("end", "to").alias("to"))

    hook = twice(twice(hook))
    return label.join(hook, F.col("label") == F.col("from"), "left").select(
        "doc_id", "n", "fame", F.coalesce("to", "label").alias("label"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 26, rows_per_band: int = 5,
                    word_class: np.ndarray = ts.BLANK_WORD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * |intersection| >= percent * |union| of their
    shingle sets; a component's id is its smallest doc_id, which is kept."""
    table = materialize(signature_table(docs, shingle, bands, rows_per_band, word_class, id_col, text_col), "signatures")
    full = table.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    prints = ["print1", "print2", "n_shingles"]
    classes = materialize(full.groupBy(*prints).agg(F.min("doc_id").alias("rep")), "classes")
    members = full.join(classes, prints)
    reps = members.filter(F.col("doc_id") == F.col("rep"))
    every = materialize(reps.select("doc_id", F.col("n_shingles").alias("n"), F.posexplode("bands").alias("band", "key")),
                        "bands")
    shared = materialize(every.groupBy("band", "key").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1), "buckets")
    rows = materialize(every.join(shared, ["band", "key"]), "bucketed")
    # of each candidate: its text, one byte of each bin, and how full its buckets are
    fame = materialize(rows.groupBy("doc_id").agg(F.sum("c").alias("fame"), F.max("n").alias("n")), "fame")
    rows = rows.select("band", "key", "doc_id")
    texts = materialize(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                        .join(fame.select("doc_id"), "doc_id", "left_semi"), "candidate-texts")
    label = fame.select("doc_id", "n", "fame", F.col("doc_id").alias("label"))
    links = tested = None

    def test(pairs: DataFrame) -> DataFrame:
        """The new links among ``pairs``, which count as tested from now on."""
        nonlocal links, tested
        pairs = materialize(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        good = materialize(confirm(pairs.select(F.col("a").alias("centre"), F.col("b").alias("member")),
                                   texts, shingle, percent, word_class), "links")
        links = good if links is None else links.unionByName(good)
        return good

    for turn, parts in enumerate(ROUNDS):
        groups = label.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
        known = materialize(rows.join(label.join(groups, "label"), "doc_id"), "known")
        # of each part of a bucket that holds more than one group: the best known member of its largest group
        part = F.expr(f"pmod(xxhash64(doc_id, {turn}), {parts})")
        first = F.struct((-F.col("size")).alias("big"), (-F.col("fame")).alias("f"), F.xxhash64("doc_id").alias("h"),
                         F.col("doc_id").alias("centre"), F.col("n").alias("n_c"), F.col("label").alias("label_c"))
        stars = materialize(
            known.groupBy("band", "key", part.alias("part"))
            .agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min(first).alias("s"))
            .groupBy("band", "key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.collect_list("s").alias("s"))
            .filter(F.col("lo") != F.col("hi")).select("band", "key", "s"), "centres")
        if not stars.limit(1).count():
            rows = None
            break
        # buckets of one group are done
        known = materialize(known.join(stars, ["band", "key"]), "stars")
        rows = known.select("band", "key", "doc_id")
        smaller = F.struct(-F.col("big"), F.col("label_c")) > F.struct("size", "label")
        asked = (known.select("doc_id", "n", "size", "label", F.inline("s"))
                 .filter(smaller & (F.least("n", "n_c") * 100 >= F.greatest("n", "n_c") * percent))
                 .groupBy("doc_id", "centre").agg(F.count(F.lit(1)).alias("shared"))
                 .select("doc_id", "shared", F.least("centre", "doc_id").alias("a"), F.greatest("centre", "doc_id").alias("b")))
        if tested is not None:
            asked = asked.join(tested, ["a", "b"], "left_anti")
        # the more centres, the fewer members are left: a round's pairs do not grow
        best = F.slice(F.sort_array(F.collect_list(F.struct("shared", F.xxhash64("a", "b"), "a", "b")), False),
                       1, max(1, parts // 2))
        good = test(asked.groupBy("doc_id").agg(best.alias("p")).select(F.inline("p")).select("a", "b").distinct())
        label = materialize(hooked(good, label, groups), "labels")
    if rows is not None:
        known = materialize(rows.join(label, "doc_id"), "known")
        mixed = known.groupBy("band", "key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")) \
            .filter(F.col("lo") != F.col("hi")).select("band", "key")
        mixed = materialize(known.join(mixed, ["band", "key"]).select("doc_id").distinct(), "mixed")
        if mixed.limit(1).count():
            pairs = rare_pairs(materialize(texts.join(mixed, "doc_id"), "mixed-texts"), label, shingle, percent, word_class)
            test(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
    if links is None:
        found = members.select("doc_id", "n_shingles", F.col("rep").alias("component_id"))
    else:
        # links between the groups that the rounds have made, and the smallest document of what they join
        group = label.select("doc_id", "label")
        between = materialize(_between(links, group).distinct(), "between")
        of = materialize(connected_components(between.select(F.col("from").alias("u"), F.col("to").alias("v"))), "components")
        group = group.join(of, F.col("label") == F.col("node"), "left").select(
            "doc_id", F.coalesce("component", "label").alias("label"))
        least = group.groupBy("label").agg(F.min("doc_id").alias("component"))
        of = materialize(group.join(least, "label").select(F.col("doc_id").alias("node"), "component"), "least")
        found = (materialize(members.select("doc_id", "n_shingles", "rep"), "members")
                 .join(of, F.col("rep") == F.col("node"), "left")
                 .select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id")))
    alone = table.filter((F.col("n_shingles") == 0) | F.col("doc_id").isNull()) \
        .select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
