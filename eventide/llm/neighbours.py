"""Embedding near-duplicates by NN-descent.

Every vector keeps a list of the ``k`` nearest ones found so far.  Lists start
from random-projection leaves (blocks of bounded size); then each vector's
neighbours, and those that have it as theirs, are compared with each other, and
lists take what is nearer, until few change.  Only pairs of which one side is
new are compared again.

Threshold edges are the list entries that pass the cosine in double precision;
they are joined into components.  A list whose entries all pass is saturated: it
may be too short for the vector's links.  It is enlarged to its whole
component: components are compared block by block (two blocks in memory), and
only numbers of links leave a block pair, never pairs.  For links that lead out
of the component, the vectors of saturated lists get new lists that take
partners from other components only; what passes joins the components, and this
goes on until no list is saturated or nothing is joined.

Recall is audited: ``audit`` vectors are compared with all vectors, and more
leaves and rounds follow while the links found are less than ``recall`` of the
true ones; if they still are after the last try, that is an error.

Defined cases: vectors that are null, zero, or hold null or non-finite
components link with nothing, as do rows without an id; vectors of different
length are never linked; equal vectors are one class, compared once; repeated
rows are separate vectors; an empty table gives no rows; extra columns are left
out.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from eventide.llm.components import connected_components
from eventide.llm.scratch import materialize

LEAF = 256          # vectors of a projection leaf, about; larger leaves are split
BLOCK = 512         # vectors of a component's block
LISTS = "u long, v long, sim float"


def _matrix(column: pa.Array, dtype: str = "<f4") -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = b"".join(column.to_pylist())
    return np.frombuffer(rows, dtype).reshape(len(column), -1).astype(np.float32 if dtype != "<f8" else np.float64)


def unit_vectors(classes: DataFrame) -> DataFrame:
    """(id, vec): unit vectors in half precision, for looking around only."""

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([np.asarray(v, np.float64) for v in batch.column(1).to_pylist()]) \
                if batch.num_rows else np.zeros((0, 1))
            x = x / np.abs(x).max(1, keepdims=True)
            x = (x / np.sqrt((x * x).sum(1, keepdims=True))).astype("<f2")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "vec"])

    return classes.select("id", "embedding").mapInArrow(unit, "id long, vec binary")


def leaf_lists(vectors: DataFrame, n: int, dim: int, k: int, trees: int, seed: int) -> DataFrame:
    """Nearest within leaves of random projections.  ``vectors``: (id, vec,
    component, wanted); a list takes no partner of its own component, and only
    the wanted vectors get one."""
    bits = min(40, max(0, math.ceil(math.log2(max(1, n / LEAF)))))
    planes = np.random.RandomState(seed).randn(trees, bits, dim).astype(np.float32)
    power = (1 << np.arange(bits, dtype=np.int64))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), "<f2")
            for t in range(trees):
                leaf = ((x @ planes[t].T > 0) * power).sum(1) if bits else np.zeros(len(x), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)), pa.array(leaf.astype(np.int64)),
                     *batch.columns], ["tree", "leaf", "id", "vec", "component", "wanted"])

    def nearest(table: pa.Table) -> pa.Table:
        ids, x = table.column("id").to_numpy(), _matrix(table.column("vec"), "<f2")
        group, wanted = table.column("component").to_numpy(), np.array(table.column("wanted").to_pylist(), bool)
        m = min(k, len(ids) - 1)
        if m <= 0 or not wanted.any():
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64()),
                             "sim": pa.array([], pa.float32())})
        sim = x[wanted] @ x.T
        sim[group[wanted][:, None] == group[None, :]] = -2
        best = np.argpartition(-sim, m - 1, axis=1)[:, :m]
        near = np.take_along_axis(sim, best, 1).ravel().astype(np.float32)
        other = near > -1.5
        return pa.table({"u": np.repeat(ids[wanted], m)[other], "v": ids[best.ravel()][other], "sim": near[other]})

    rows = vectors.select("id", "vec", "component", "wanted").mapInArrow(
        leaves, "tree int, leaf long, id long, vec binary, component long, wanted boolean")
    sizes = rows.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("c"))
    split = rows.join(materialize(sizes, "leaf-sizes"), ["tree", "leaf"]).withColumn(
        "part", F.expr(f"pmod(xxhash64(id, tree, {seed}), greatest(1, cast(ceil(c / {1.5 * LEAF}) as long)))"))
    return split.select("tree", "leaf", "part", "id", "vec", "component", "wanted").groupBy("tree", "leaf", "part") \
        .applyInArrow(nearest, LISTS)


def best_of(rows: DataFrame, k: int) -> DataFrame:
    """The k nearest of each u; ``fresh`` stays true only for pairs that were
    never in the list before."""
    one = rows.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    order = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    return one.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k)


def descend(lists: DataFrame, vectors: DataFrame, k: int, seed: int) -> DataFrame:
    """One round: neighbours of neighbours that beat the list's last entry."""
    out = lists.select(F.col("u").alias("w"), F.col("v").alias("x"), "fresh")
    # of those that have w as a neighbour, k drawn anew in every round
    draw = Window.partitionBy("v").orderBy(F.xxhash64("u", F.lit(seed)))
    back = (lists.withColumn("d", F.row_number().over(draw)).filter(F.col("d") <= k)
            .select(F.col("v").alias("w"), F.col("u").alias("x"), "fresh"))
    near = out.unionByName(back).groupBy("w", "x").agg(F.max("fresh").alias("fresh"))
    last = lists.groupBy("u").agg(F.when(F.count(F.lit(1)) >= k, F.min("sim")).otherwise(F.lit(-2.0))
                                  .cast("float").alias("last"))
    known = vectors.join(last, F.col("id") == F.col("u"), "left").select("id", "vec", "last")

    def meet(table: pa.Table) -> pa.Table:
        ids, x = table.column("x").to_numpy(), _matrix(table.column("vec"), "<f2")
        fresh = np.array(table.column("fresh").to_pylist(), bool)
        last = table.column("last").fill_null(-2.0).to_numpy()
        sim = x @ x.T
        good = (sim > last[:, None] + 1e-4) & (fresh[:, None] | fresh[None, :])
        np.fill_diagonal(good, False)
        i, j = np.nonzero(good)
        return pa.table({"u": ids[i], "v": ids[j], "sim": sim[i, j].astype(np.float32)})

    found = (near.join(known, F.col("x") == F.col("id")).select("w", "x", "fresh", "vec", "last")
             .groupBy("w").applyInArrow(meet, LISTS))
    return best_of(lists.select("u", "v", "sim", F.lit(False).alias("fresh"))
                   .unionByName(found.withColumn("fresh", F.lit(True))), k)


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of all rows of a and b, in double precision."""
    a, b = (m / np.abs(m).max(1, keepdims=True) for m in (a, b))
    return (a @ b.T) / np.sqrt((a * a).sum(1))[:, None] / np.sqrt((b * b).sum(1))[None, :]


def _doubles(column) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column.to_pylist()])


def passing(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The (u, v) whose cosine in double precision passes."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (_doubles(batch.column(c)) for c in (2, 3))
            a, b = (m / np.abs(m).max(1, keepdims=True) for m in (a, b))
            cos = (a * b).sum(1) / np.sqrt((a * a).sum(1)) / np.sqrt((b * b).sum(1))
            at = pa.array(np.flatnonzero(cos >= threshold))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], ["u", "v"])

    c = classes.select("id", "embedding")
    both = (pairs.join(c.withColumnRenamed("embedding", "a"), F.col("u") == F.col("id")).drop("id")
            .join(c.withColumnRenamed("embedding", "b"), F.col("v") == F.col("id")).drop("id"))
    return both.select("u", "v", "a", "b").mapInArrow(test, "u long, v long")


def link_counts(members: DataFrame, threshold: float) -> DataFrame:
    """``members`` (component, id, copies, embedding): for each id the number
    of vectors linked with it, copies counted, by comparing all of a component
    block by block."""
    sizes = materialize(members.groupBy("component").agg(F.count(F.lit(1)).alias("c")), "component-sizes")
    n = F.expr(f"cast(ceil(c / {BLOCK}) as int)")
    placed = (members.join(sizes, "component").withColumn("blocks", n)
              .withColumn("block", F.expr("cast(pmod(xxhash64(id), blocks) as int)"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")))

    def count(table: pa.Table) -> pa.Table:
        ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
        block, x = table.column("block").to_numpy(), _doubles(table.column("embedding"))
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        a, b = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        n = np.zeros(len(ids), np.int64)
        if len(a) and len(b):
            ok = _cosine(x[a], x[b]) >= threshold
            if lo == hi:
                np.fill_diagonal(ok, False)
                n[a] = ok @ copies[a]
            else:
                n[a] = ok @ copies[b]
                n[b] = ok.T @ copies[a]
        return pa.table({"id": ids, "n": n})

    return (placed.select("component", "lo", "hi", "block", "id", "copies", "embedding")
            .groupBy("component", "lo", "hi").applyInArrow(count, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")))


def true_links(classes: DataFrame, queries: DataFrame, threshold: float) -> dict[int, int]:
    """Links of a bounded set of vectors, by comparing them with all."""
    rows = queries.collect()
    if not rows:
        return {}
    q_ids = np.array([r["id"] for r in rows])
    q = np.stack([np.asarray(r["embedding"], np.float64) for r in rows])

    def against(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(q_ids), np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                ids, copies = part.column(0).to_numpy(), part.column(1).to_numpy()
                ok = _cosine(q, _doubles(part.column(2))) >= threshold
                ok &= q_ids[:, None] != ids[None, :]
                total += ok @ copies
        yield pa.RecordBatch.from_arrays([pa.array(q_ids), pa.array(total)], ["id", "n"])

    got = classes.select("id", "copies", "embedding").mapInArrow(against, "id long, n long") \
        .groupBy("id").agg(F.sum("n").alias("n")).collect()
    return {r["id"]: r["n"] for r in got}


def near_vectors(table: DataFrame, threshold: float = 0.95, k: int = 10, trees: int = 4, rounds: int = 6,
                 change: float = 0.005, audit: int = 1000, recall: float = 0.97, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    v = F.col("embedding")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"),
                        F.col(vector_col).cast("array<double>").alias("embedding"))
    sound = (F.col("vec_id").isNotNull() & v.isNotNull()
             & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists(v, lambda x: x != 0))
    rows = materialize(rows.withColumn("sound", F.coalesce(sound, F.lit(False))), "vectors")
    usable = rows.filter("sound")
    classes = materialize(usable.groupBy("embedding").agg(F.min("vec_id").alias("id"),
                                                          F.count(F.lit(1)).alias("copies")), "vector-classes")
    # rows of one id may hold several vectors; a class is known by its smallest id and its vector
    several = classes.groupBy("id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").limit(1).count()
    if several:
        classes = materialize(classes.withColumn("id", F.xxhash64("id", "embedding")), "vector-classes")
    dims = [r[0] for r in classes.select(F.size("embedding")).distinct().collect()]
    linked = None
    for dim in sorted(dims):
        part = classes.filter(F.size("embedding") == dim)
        found = _one_dimension(part, dim, threshold, k, trees, rounds, change, audit, recall)
        linked = found if linked is None else linked.unionByName(found)
    alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if linked is None:
        out = alone
    else:
        # smallest vec_id of a component (class ids are hashes where ids repeat)
        known = (classes.join(linked, "id", "left")
                 .select("embedding", "copies", F.coalesce("component", "id").alias("component"),
                         F.coalesce("n", F.lit(0)).alias("n")))
        each = usable.join(known, "embedding")
        if several:
            low = materialize(each.groupBy("component").agg(F.min("vec_id").alias("low")), "component-low")
            each = each.join(low, "component").drop("component").withColumnRenamed("low", "component")
        out = each.select("vec_id", (F.col("n") + F.col("copies") - 1).alias("n_links"),
                          F.col("component").alias("component_id"))
        out = out.unionByName(rows.filter(~F.col("sound")).select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _near_pairs(lists: DataFrame, threshold: float) -> DataFrame:
    return lists.filter(F.col("sim") >= threshold - 0.01).select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _saturated(lists: DataFrame, threshold: float, k: int) -> DataFrame:
    """Vectors whose list is full of partners that pass."""
    return lists.filter(F.col("sim") >= threshold - 0.01).groupBy("u").agg(F.count(F.lit(1)).alias("c")) \
        .filter(F.col("c") >= k).select("u")


def join_components(lists: DataFrame, edges: DataFrame, of: DataFrame, vectors: DataFrame, classes: DataFrame,
                    n: int, dim: int, threshold: float, k: int, trees: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Edges and components, with the links between components that saturated
    lists have no room for."""
    full = materialize(_saturated(lists, threshold, k), "saturated")
    while full.limit(1).count():
        seed += 1
        placed = materialize(
            vectors.join(of, F.col("id") == F.col("node"), "left").join(full, F.col("id") == F.col("u"), "left")
            .select("id", "vec", F.coalesce("component", "id").alias("component"), F.col("u").isNotNull().alias("wanted")),
            "placed-vectors")
        cross = materialize(best_of(leaf_lists(placed, n, dim, k, trees, seed).withColumn("fresh", F.lit(True)), k),
                            "cross-lists")
        more = materialize(passing(_near_pairs(cross, threshold), classes, threshold), "cross-links")
        if not more.limit(1).count():
            break
        edges = edges.unionByName(more)
        of = materialize(connected_components(edges), "vector-components")
        full = materialize(_saturated(cross, threshold, k), "saturated")
    return edges, of


def _one_dimension(classes: DataFrame, dim: int, threshold: float, k: int, trees: int, rounds: int,
                   change: float, audit: int, recall: float) -> DataFrame:
    """(id, component, n) for the classes of one vector length."""
    n = classes.count()
    vectors = materialize(unit_vectors(classes), "unit-vectors")
    queries = classes.select("id", "embedding").orderBy(F.xxhash64("id")).limit(audit)      # a stated number
    truth = true_links(classes, queries, threshold)
    wanted = sum(truth.values())
    apart = vectors.select("id", "vec", F.col("id").alias("component"), F.lit(True).alias("wanted"))
    lists, extra, seed = None, None, 1
    while True:
        first = leaf_lists(apart, n, dim, k, trees, seed).withColumn("fresh", F.lit(True))
        if lists is not None:
            first = first.unionByName(lists.select("u", "v", "sim", F.lit(False).alias("fresh")))
        lists = materialize(best_of(first, k), "neighbours")
        for turn in range(rounds):
            lists = materialize(descend(lists, vectors, k, seed + turn), "neighbours")
            if lists.filter("fresh").count() <= change * n * k:
                break
        edges = materialize(passing(_near_pairs(lists, threshold), classes, threshold), "vector-links")
        if extra is not None:
            edges = edges.unionByName(extra)
        of = materialize(connected_components(edges), "vector-components")
        extra, of = join_components(lists, edges, of, vectors, classes, n, dim, threshold, k, trees, 1000 * seed)
        members = materialize(classes.join(of, F.col("id") == F.col("node"))
                              .select("component", "id", "copies", "embedding"), "component-members")
        counts = materialize(link_counts(members, threshold), "link-counts")
        got = {r["id"]: r["n"] for r in
               counts.join(F.broadcast(queries.select("id")), "id").select("id", "n").collect()}
        if sum(got.values()) >= recall * wanted:
            return members.select("id", "component").join(counts, "id", "left")
        if seed > 50:
            raise RuntimeError(f"{sum(got.values())} of {wanted} links of the audited vectors found, {recall} wanted: "
                               "more trees, rounds or a larger k are needed")
        seed += 10
