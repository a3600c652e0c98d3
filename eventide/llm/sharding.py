"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Only DataFrame and SQL functions run here.  Rows get dense numbers in the
order of (id, text crc, size); the permutation maps number ``i`` to a position
``p``, which gives both places: shard ``p mod n`` and slot ``p div n``.  From
the row count and the seed alone anybody can compute the place of a row number,
without the table.

Defined cases: null ids are numbered first; a null text has the size of an
empty one; repeated rows get numbers of their own (which of two equal rows gets
which is immaterial); an empty table gives no rows; columns of the input that
clash with result columns are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from eventide.llm.scratch import materialize

ROUNDS = 6
#: Walks unrolled in one pass; more passes follow while a row is outside.
WALKS = 16


def domain(n_rows: int) -> tuple[int, int]:
    """A grid a * b >= n_rows with less than a cells to spare."""
    a = math.isqrt(max(0, n_rows - 1)) + 1
    return a, max(1, -(-n_rows // a))


def feistel_sql(x: str, a: int, b: int, seed: int) -> str:
    """One pass over [0, a*b): the digits of ``x`` in base (a, b) are shifted
    in turn by a keyed hash of each other, which is a bijection."""
    step = (f"if(k % 2 = 0,"
            f" named_struct('l', pmod(s.l + pmod(xxhash64({seed}, k, s.r), {a}L), {a}L), 'r', s.r),"
            f" named_struct('l', s.l, 'r', pmod(s.r + pmod(xxhash64({seed}, k, s.l), {b}L), {b}L)))")
    return (f"aggregate(sequence(0, {ROUNDS - 1}),"
            f" named_struct('l', pmod({x} div {b}L, {a}L), 'r', pmod({x}, {b}L)),"
            f" (s, k) -> {step}, s -> s.l * {b}L + s.r)")


def permute(df: DataFrame, number: str, n_rows: int, seed: int, out: str) -> DataFrame:
    """Add ``out``: the place of row ``number`` in a permutation of
    [0, n_rows).  Cells of the grid beyond n_rows are walked out of (cycle
    walking); each walk is a further pass of the same bijection."""
    a, b = domain(n_rows)
    df = df.withColumn(out, F.expr(feistel_sql(number, a, b, seed)))
    spare = a * b - n_rows          # no walk is longer than this
    walks = 0
    while walks < spare:
        step = min(WALKS, spare - walks)
        df = df.withColumn(out, F.expr(
            f"if({out} < {n_rows}L, {out}, aggregate(sequence(1, {step}), {out},"
            f" (v, i) -> if(v < {n_rows}L, v, {feistel_sql('v', a, b, seed)})))"))
        walks += step
        if walks < spare and not df.filter(F.col(out) >= n_rows).limit(1).count():
            break
    return df


def number_rows(df: DataFrame, order: list[str], number: str) -> tuple[DataFrame, int]:
    """Dense numbers 0.. in ``order``: one range shuffle (which also splits
    long runs of close ids), an index inside each slice, and the sum of the
    slices before it.  The numbered rows are a table of the shared folder, as
    sampled range bounds must not be drawn twice."""
    placed = (df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
              .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
              .withColumn("__at", F.monotonically_increasing_id())
              .withColumn("__slice", F.shiftright("__at", 33))
              .withColumn("__index", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
              .drop("__at"))
    placed = materialize(placed, "numbered")
    sizes = sorted((r["__slice"], r["n"]) for r in       # one row per partition
                   placed.groupBy("__slice").agg(F.count(F.lit(1)).alias("n")).collect())
    before, total = {}, 0
    for part, n in sizes:
        before[part] = total
        total += n
    offsets = df.sparkSession.createDataFrame(list(before.items()), "__slice long, __before long")
    out = (placed.join(F.broadcast(offsets), "__slice")
           .withColumn(number, F.col("__before") + F.col("__index"))
           .drop("__slice", "__index", "__before"))
    return out, total


def feistel_shards(docs: DataFrame, n_shards: int, seed: int = 1, id_col: str = "doc_id",
                   text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Deal all rows into ``n_shards`` shards whose counts differ by one at most.

    Returns the ``carry`` columns (all by default) with size (UTF-8 bytes of
    the text plus 1), text_crc32, row_number, position, shard and slot (gapless
    from 0 in each shard)."""
    own = ["size", "text_crc32", "row_number", "position", "shard", "slot"]
    carry = [c for c in (docs.columns if carry is None else carry) if c not in own]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    slim = docs.select(
        F.col(id_col).alias("__id"), *carry,
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    numbered, total = number_rows(slim, ["__id", "text_crc32", "size"], "row_number")
    placed = permute(numbered, "row_number", total, seed, "position")
    return (placed
            .withColumn("shard", F.expr(f"position % {n_shards}L").cast("int"))
            .withColumn("slot", F.expr(f"position div {n_shards}L"))
            .select(*carry, *own))
