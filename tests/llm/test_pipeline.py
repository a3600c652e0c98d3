"""Every stage on what its predecessor kept, held against plain Python."""

import zlib

import pytest
from pyspark.sql import functions as F

from eventide.llm import mixing as mx
from eventide.llm.scratch import materialize
from tests.conftest import SF001, have_testdata
from tests.llm.data import BLANK, words
from tests.llm.test_minhash import brute as brute_components

pytestmark = pytest.mark.skipif(not have_testdata(), reason="driver test data missing")


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline

    docs, out = spark.read.parquet(f"{SF001}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialize(stage(spark, docs, SF001), f"test-{name}")
        out.append((name, before, docs))
    return out


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_columns(stages):
    assert [n for n, _, _ in stages] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    for _, before, after in stages[:-1]:
        assert sorted(after.columns) == sorted(before.columns)


def test_toxicity_keeps_clean_documents(spark, stages):
    _, before, after = stages[0]
    labels = dict(rows(spark.read.parquet(f"{SF001}/labels.parquet"), "doc_id", "toxic"))
    left = {i for i, in rows(after, "doc_id")}
    clean = [i for i, in rows(before, "doc_id") if labels.get(i) == 0]
    assert sum(i in left for i in clean) >= 0.95 * len(clean)


def test_near_duplicates_and_passages(spark, stages):
    _, before, after = stages[1]
    _, of = brute_components(rows(before, "doc_id", "text"), 5, 80)
    assert sorted(i for i, in rows(after, "doc_id")) == sorted(i for i, c in of.items() if i == c)
    _, before, after = stages[2]
    windows = set()
    for t, in rows(spark.read.parquet(f"{SF001}/benchmark.parquet"), "text"):
        w = words(t)
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9) if w else 0)}
    lengths = {len(w) for w in windows}
    clean = [i for i, w in ((i, words(t)) for i, t in rows(before, "doc_id", "text"))
             if not any(tuple(w[k:k + n]) in windows for n in lengths for k in range(len(w) - n + 1))]
    assert sorted(i for i, in rows(after, "doc_id")) == sorted(clean)


def test_mixing_and_shards(stages):
    _, before, after = stages[3]
    size = {i: (s, len(BLANK.findall(t or ""))) for i, s, t in rows(before, "doc_id", "source", "text")}
    sums, taken, times = {}, {}, {}
    for s, n in size.values():
        sums[s] = sums.get(s, 0) + n
    for i, in rows(after, "doc_id"):
        taken[size[i][0]] = taken.get(size[i][0], 0) + size[i][1]
        times[i] = times.get(i, 0) + 1
    names = sorted(sums)
    target = dict(zip(names, mx.fill_targets([sums[n] for n in names],
                                             [[5.0, 2.0, 1.0][k % 3] for k in range(len(names))], 3)))
    assert max(times.values()) <= 3
    longest = max(n for _, n in size.values())
    assert all(abs(taken.get(s, 0) - target[s]) <= max(0.1 * target[s], longest / 2) for s in names)
    _, before, after = stages[4]
    assert sorted(rows(after, "doc_id", "text_crc32")) == sorted(
        (i, zlib.crc32((t or "").encode())) for i, t in rows(before, "doc_id", "text"))
    by = {}
    for s, slot in rows(after, "shard", "slot"):
        by.setdefault(s, []).append(slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1


def test_run_is_the_stages(spark, stages):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, SF001)
    assert got.columns == stages[-1][2].columns and got.count() == stages[-1][2].count()


def test_empty_documents(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF001}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_rows_that_repeat_an_id_are_told_apart(spark):
    from eventide.llm.stages import drop_near_duplicates

    t, u, v = (" ".join(f"{c}{k}" for k in range(60)) for c in "tuv")
    docs = spark.createDataFrame(
        [(1, t), (2, t), (2, u), (None, u + " tail"), (None, v), (None, v), (5, None), (5, ""), (6, v)],
        "doc_id long, text string").select("*", *(F.lit("x").alias(c) for c in ("lang", "source", "label", "__clash")),
                                           F.lit(0).alias("n_chars"))
    kept = drop_near_duplicates(spark, docs, SF001)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(rows(kept, "doc_id", "text"), key=str) == sorted([(1, t), (2, u), (6, v), (5, None), (5, "")], key=str)
    assert drop_near_duplicates(spark, docs.limit(0), SF001).count() == 0
