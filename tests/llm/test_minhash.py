import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventide.llm import minhash as mh, textscan as ts
from eventide.llm.components import connected_components
from tests.llm.data import BLANK, components, documents, frame, words


def brute(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = words(t, BLANK)
        sets.setdefault(i, []).append(frozenset(
            tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset())
    links = [(a, b) for a in sets for b in sets if a < b
             if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b])]
    return sets, components(sets, links)


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_equals_brute_force(spark, size, percent):
    rng = random.Random(7)
    rows = documents(spark, 50)
    vocabulary = ["w%d" % i for i in range(300)]
    for g in range(6):          # drifting families: neighbours alike, ends not
        text = [rng.choice(vocabulary) for _ in range(120)]
        for k in range(8):
            rows.append((500 + 10 * g + k, " ".join(text), "en", "s", 1, *["c"] * 8))
            for _ in range(2):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
    rows += [rows[5], rows[5]]
    got = mh.near_duplicates(frame(spark, rows), shingle=size, percent=percent).collect()
    assert len(got) == len(rows)
    sets, of = brute([(r[0], r[1]) for r in rows if r[0] is not None], size, percent)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
            continue
        assert r["n_shingles"] in [len(s) for s in sets[r["doc_id"]]]
        assert r["component_id"] == of[r["doc_id"]], r["doc_id"]
        assert r["kept"] == (r["doc_id"] == r["component_id"])


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_no_link_is_lost_in_a_mixed_bucket(spark, size, percent):
    rng = random.Random(11)
    common, rows = ["c%d" % k for k in range(160)], []
    for g in range(110):            # a common passage, a few words of the group, changes of the text
        own = ["g%d_%d" % (g, k) for k in range(60)]
        for _ in range(3):
            text = common + own
            for _ in range(2):
                text[rng.randrange(len(text))] = "x%d" % rng.randrange(10 ** 9)
            rows.append((len(rows), " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keys = {r["doc_id"]: r["bands"][0] for r in
            mh.signature_table(df, size, 1, 2, ts.BLANK_WORD, "doc_id", "text").collect()}
    assert max(list(keys.values()).count(k) for k in set(keys.values())) >= 100
    sets = {i: {tuple(t.split()[k:k + size]) for k in range(len(t.split()) - size + 1)} for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and keys[a] == keys[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    of = components(sets, links)
    got = {r["doc_id"]: r["component_id"] for r in
           mh.near_duplicates(df, shingle=size, percent=percent, bands=1, rows_per_band=2).collect()}
    lost = [(a, b) for a, b in links if got[a] != got[b]]
    assert len(links) > 60 and not lost, (len(links), len(lost))
    assert all(got[a] <= of[a] for a in got)


def test_nothing_to_compare(spark):
    assert mh.near_duplicates(frame(spark, [])).count() == 0
    only = documents(spark)[7:10]
    assert mh.near_duplicates(frame(spark, only)).filter("kept").count() == 3


def test_signature_agreement_estimates_similarity():
    rng = random.Random(1)
    base = ["w%d" % rng.randrange(10 ** 6) for _ in range(400)]
    other = base[:330] + ["v%d" % i for i in range(70)]
    s = next(ts.slices(pa.array([" ".join(base), " ".join(other), "one two"])))
    row, h = mh.shingle_sets(s, 3, ts.BLANK_WORD)
    sig = mh.signatures(row, h, 3, 2000)
    a, b = (set(h[row == r].tolist()) for r in (0, 1))
    assert abs((sig[0] == sig[1]).mean() - len(a & b) / len(a | b)) < 0.06
    assert (sig != np.uint64(0xFFFFFFFFFFFFFFFF)).all()         # densified, the one-shingle text too


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(400 + i, 401 + i) for i in range(40)] + [(600, 600 + i) for i in range(1, 50)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in
           connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == components(nodes, [x for x in links if x[0] != x[1]])
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_kept_rows_of_the_stage(spark):
    from eventide.llm.stages import drop_near_duplicates

    rows = documents(spark)
    got = drop_near_duplicates(spark, frame(spark, rows + [rows[5]]), "").select("doc_id").collect()
    ids = [r[0] for r in got]
    assert len(ids) == len(set(ids))
    assert not {10, 11, 13, 14} & set(ids) and {4, 7, 8, 9, 12, None} <= set(ids)
    assert frame(spark, rows).select(F.count("doc_id")).first()[0] == len(rows) - 1
