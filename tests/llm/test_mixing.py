import random

from eventide.llm import mixing as mx
from tests.llm.data import BLANK, documents, frame


def test_targets_fill_up_to_their_limit():
    assert mx.fill_targets([100, 100, 100], [5, 2, 1], 3) == [187.5, 75.0, 37.5]
    got = mx.fill_targets([10, 100, 100], [5, 2, 1], 3)
    assert got[0] == 30 and abs(sum(got) - 210) < 1e-9 and abs(got[1] / got[2] - 2) < 1e-9
    assert mx.fill_targets([0, 10], [5, 2], 3) == [0.0, 10.0]
    assert mx.fill_targets([], [5], 3) == []


def test_flow_moves_shared_documents_to_the_source_that_needs_them():
    a, b, ab = frozenset("a"), frozenset("b"), frozenset("ab")
    routes = mx.route([(a, 50), (ab, 40), (b, 5)], {"a": 50, "b": 45}, 3)
    assert [dict(r) for r in routes] == [{"a": 50}, {"b": 40}, {"b": 5}]
    # nothing fresh left: the cheapest repetitions come next, none beyond the limit
    routes = mx.route([(a, 10), (ab, 10)], {"a": 100, "b": 30}, 3)
    assert sum(w for r in routes for _, w in r) == 60


def brute_sums(rows):
    sums = {}
    for r in rows:
        sums[r[3]] = sums.get(r[3], 0) + len(BLANK.findall(r[1] or ""))
    return sums


def test_mix_comes_near_its_targets(spark):
    rng = random.Random(2)
    rows = documents(spark, 60)
    rows += [(1000 + i, " ".join("w" for _ in range(rng.randint(0, 30))), "en", rng.choice(["s0", "s1", "zz", None]),
              0, *["c"] * 8) for i in range(800)]
    rows += [rows[3]] * 2
    docs = frame(spark, rows)
    got = mx.mix(docs, [5.0, 2.0, 1.0], carry=["doc_id", "source"]).collect()
    sums = brute_sums(rows)
    names = sorted(sums, key=lambda s: (s is None, s or ""))
    target = dict(zip(names, mx.fill_targets([sums[n] for n in names],
                                             [[5.0, 2.0, 1.0][i % 3] for i in range(len(names))], 3)))
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r["source_size"] == sums[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6
        assert r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s in names:
        assert abs(taken[s] - target[s]) <= max(31, 0.02 * target[s]), s
    key = lambda rs: sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in rs)
    assert key(got) == key(mx.mix(docs.repartition(7), [5.0, 2.0, 1.0], carry=["doc_id", "source"]).collect())


def test_many_buckets_and_lists_of_sources(spark, monkeypatch):
    monkeypatch.setattr(mx, "BUCKET_DOCS", 20)
    rng = random.Random(4)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 20))), rng.choice([["a"], ["a", "b"], ["b"], [], None]))
            for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    got = mx.mix(docs, [1.0, 3.0], carry=["doc_id", "source"]).collect()
    assert len(got) == len(rows)
    total = sum(len(t.split()) for _, t, _ in rows)
    assert abs(sum(r["taken"] for r in got) - total) <= 0.03 * total


def test_no_documents(spark):
    assert mx.mix(frame(spark, []), [5.0, 2.0, 1.0], carry=["doc_id"]).count() == 0
