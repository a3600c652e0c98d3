"""Mixing overlapping sources to target weights by min-cost flow.

A document may belong to several sources.  Documents are aggregated by
membership pattern; a flow network routes each pattern's words to the sources
it belongs to, up to their targets.  A pattern's r-th repetition costs more
than its (r-1)-th (convex cost), so nothing repeats while something fresh is
left.  Only patterns and sources, never documents, reach the driver.  Then
every pattern takes all documents a whole number of times, and a seeded choice
of documents once more for the rest.

Targets: the sources share the words of all documents by weight; a target is
at most ``max_repeat`` times its source's words and the excess is shared again
by weight, until none is above (water filling).

Defined cases: a null text has size 0 and a null source is a source of its own
(last in the order of weights); sources without words get target 0; rows with
equal ids are separate rows, chosen in an order drawn from id, text and seed;
an empty table gives no rows; clashing columns of the input are replaced.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.llm.scratch import materialize

#: Documents of one pattern are dealt over so many that a bucket has about
#: this number; only the bucket where the choice ends is looked at one by one.
BUCKET_DOCS = 4000
#: Sources and patterns are lists in the driver; more than this is refused.
MAX_PATTERNS = 1_000_000


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def fill_targets(sizes: list[int], weights: list[float], max_repeat: int, share: float = 1.0) -> list[float]:
    """Water filling: min(max_repeat * size, level * weight), summing to the
    share of all words (or less, where every source is at its limit)."""
    target = [0.0] * len(sizes)
    left = share * sum(sizes)
    open_ = sorted((i for i in range(len(sizes)) if sizes[i] > 0),
                   key=lambda i: (max_repeat * sizes[i] / weights[i], i))
    weight = sum(weights[i] for i in open_)
    for i in open_:
        target[i] = min(float(max_repeat * sizes[i]), left * weights[i] / weight)
        left -= target[i]
        weight -= weights[i]
    return target


def route(patterns: list[tuple[frozenset, int]], targets: dict, max_repeat: int) -> list[list[tuple]]:
    """Min-cost flow by successive cheapest paths, on whole words.

    Arcs: pattern -> each of its sources (free, unlimited); each pattern is fed
    by ``max_repeat`` arcs of its own word count, the r-th at cost r - 1.
    Returns per pattern its (source, words) routes."""
    want = {s: int(round(t)) for s, t in targets.items()}
    sent: list[dict] = [dict() for _ in patterns]
    used = [0] * len(patterns)
    of_source: dict = {}
    for p, (members, _) in enumerate(patterns):
        for s in members:
            of_source.setdefault(s, []).append(p)
    # Patterns of one source first compete with nobody else's words; a path from
    # a source goes back over patterns whose words can be moved to it.
    for rep in range(max_repeat):
        limit = [(rep + 1) * n for _, n in patterns]
        moved = True
        while moved:
            moved = False
            for goal in sorted(want, key=str):
                while want[goal] > 0:
                    # breadth first from the goal: which pattern has free words?
                    came: dict = {goal: None}
                    queue, end = [goal], None
                    while queue and end is None:
                        s = queue.pop(0)
                        for p in of_source.get(s, ()):
                            if used[p] < limit[p]:
                                end = (s, p)
                                break
                            for other, w in sent[p].items():
                                if w > 0 and other not in came:
                                    came[other] = (s, p)
                                    queue.append(other)
                    if end is None:
                        break
                    s, p = end
                    amount, path = min(want[goal], limit[p] - used[p]), []
                    while came[s] is not None:
                        nxt, q = came[s]
                        path.append((s, nxt, q))
                        amount = min(amount, sent[q][s])
                        s = nxt
                    s, p = end
                    sent[p][s] = sent[p].get(s, 0) + amount
                    used[p] += amount
                    for src, nxt, q in path:        # src gives its words of q to nxt
                        sent[q][src] -= amount
                        sent[q][nxt] = sent[q].get(nxt, 0) + amount
                    want[goal] -= amount
                    moved = True
    return [sorted(((s, w) for s, w in d.items() if w), key=str) for d in sent]


def mix(docs: DataFrame, weights: list[float], max_repeat: int = 3, seed: int = 1,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        carry: list[str] | None = None, share: float = 1.0) -> DataFrame:
    """``source_col`` is a string (one source) or an array of strings.  Sources
    in code point order, null last, take ``weights`` in turn.

    Returns the ``carry`` columns (all by default) with size, source_size and
    target (of the document's first source), repeats and taken = size *
    repeats."""
    spark = docs.sparkSession
    own = ["size", "source_size", "target", "repeats", "taken"]
    carry = [c for c in (docs.columns if carry is None else carry) if c not in own]
    is_list = docs.schema[source_col].dataType.typeName() == "array"
    members = (F.array_sort(F.array_distinct(F.coalesce(F.col(source_col), F.array()))) if is_list
               else F.array(F.col(source_col).cast("string")))
    members = F.when(F.size(members) == 0, F.array(F.lit(None).cast("string"))).otherwise(members)
    # order drawn from seed, id and text: the same in every run
    draw = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    size_of = count_words(F.col(text_col))
    # numbers only: no text is written or shuffled before it is known to be chosen
    slim = materialize(docs.select(members.alias("__members"), size_of.alias("size"), draw.alias("__draw")), "mix")
    stats = (slim.groupBy("__members").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs"))
             .limit(MAX_PATTERNS + 1).collect())
    if len(stats) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    stats.sort(key=lambda r: [(m is None, (m or "").encode("utf-32-be")) for m in r["__members"]])
    size: dict = {}
    for r in stats:
        for m in r["__members"]:
            size[m] = size.get(m, 0) + r["words"]
    names = sorted(size, key=lambda m: (m is None, (m or "").encode("utf-32-be")))
    total = sum(r["words"] for r in stats)
    filled = fill_targets([size[m] for m in names],
                          [weights[i % len(weights)] for i in range(len(names))], max_repeat,
                          share * total / max(1, sum(size.values())))
    target = dict(zip(names, filled))
    routes = route([(frozenset(r["__members"]), r["words"]) for r in stats], target, max_repeat)
    plan = []
    for p, (r, got) in enumerate(zip(stats, routes)):
        words = sum(w for _, w in got)
        whole = words // r["words"] if r["words"] else 0
        plan.append((r["__members"], p, int(whole), int(words - whole * r["words"]),
                     max(1, r["docs"] // BUCKET_DOCS), size[r["__members"][0]], float(target[r["__members"][0]])))
    key = key_of(F.col("__members"))
    plan = materialize(spark.createDataFrame(
        plan, "__members array<string>, __p long, __whole long, __rest long, __n long, source_size long, target double")
        .withColumn("__key", key).drop("__members"), "mix-plan")
    bucket = F.expr("(__draw & 9223372036854775807L) % __n").alias("__bucket")
    dealt = slim.withColumn("__key", key).join(plan.select("__key", "__p", "__n"), "__key").select(
        "__p", "size", "__draw", bucket)
    # words by bucket; a pattern's rest is used up in one bucket, its cut
    sums = dealt.groupBy("__p", "__bucket").agg(F.sum("size").alias("w")).join(plan.select("__p", "__rest"), "__p")
    upto = F.sum("w").over(Window.partitionBy("__p").orderBy("__bucket"))
    cuts = (sums.withColumn("upto", upto).filter(F.col("upto") > F.col("__rest"))
            .groupBy("__p").agg(F.min(F.struct("__bucket", (F.col("__rest") - (F.col("upto") - F.col("w"))).alias("left")))
                                .alias("__cut")))
    # one row per pattern: what a document needs to know is joined to it, texts stay where they are
    law = materialize(plan.join(cuts, "__p", "left").select(
        "__key", "__p", "__whole", "__n", "source_size", "target", F.col("__cut.__bucket").alias("__cut"),
        F.coalesce("__cut.left", F.lit(0).cast("long")).alias("__left")), "mix-law")
    rows = (docs.select(*carry, key_of(members).alias("__key"), size_of.alias("size"), draw.alias("__draw"))
            .join(law, "__key").select("*", bucket))
    at_cut = (F.col("__bucket") == F.coalesce("__cut", F.lit(-1))) & (F.col("__left") > 0)
    cols = [*carry, "size", "source_size", "target"]
    before = F.col("__cut").isNull() | (F.col("__bucket") < F.col("__cut"))
    sure = rows.filter(~at_cut).withColumn("repeats", F.col("__whole") + before.cast("long"))
    # the cut goes through one task per pattern: numbers only, equal ones together
    edge = (dealt.join(law.select("__p", "__cut", "__left"), "__p").filter(at_cut)
            .groupBy("__p", "__draw", "size").agg(F.count(F.lit(1)).alias("n"), F.first("__left").alias("left")))
    chosen = edge.groupBy("__p").applyInPandas(take_rest, "__p long, __draw long, size long, __take long")
    w = Window.partitionBy("__p", "__draw", "size").orderBy(F.lit(0))
    picked = (rows.filter(at_cut).withColumn("__nth", F.row_number().over(w))
              .join(chosen, ["__p", "__draw", "size"])
              .withColumn("repeats", F.col("__whole") + (F.col("__nth") <= F.col("__take")).cast("long")))
    out = sure.select(*cols, "repeats").unionByName(picked.select(*cols, "repeats"))
    return out.withColumn("repeats", F.when(F.col("size") > 0, F.col("repeats")).otherwise(F.lit(0))) \
        .withColumn("taken", F.col("size") * F.col("repeats")).select(*carry, *own)


def key_of(members: Column) -> Column:
    """A membership pattern without nulls, so that it can be joined."""
    return F.transform(members, lambda m: F.coalesce(F.concat(F.lit("="), m), F.lit("")))


def take_rest(rows: pd.DataFrame) -> pd.DataFrame:
    """Choose documents of one bucket (draw, size, n of them), in seeded order,
    while they fit into what is left; at the end one more if that comes nearer."""
    rows = rows.sort_values(["__draw", "size"], kind="stable").reset_index(drop=True)
    left, take, skipped = int(rows["left"].iloc[0]), [], None
    for i, (n, size) in enumerate(zip(rows["n"].tolist(), rows["size"].tolist())):
        k = n if size == 0 else min(n, left // size)
        take.append(k)
        left -= k * size
        if k < n and (skipped is None or size < rows["size"][skipped]):
            skipped = i
    if skipped is not None and rows["size"][skipped] - left < left:
        take[skipped] += 1
    return pd.DataFrame({"__p": rows["__p"], "__draw": rows["__draw"], "size": rows["size"], "__take": take})
