import numpy as np
import pytest

from eventide.llm.neighbours import near_vectors
from tests.llm.data import components


def brute(rows, threshold):
    sound = [(i, np.array(v, float)) for i, v in rows
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, degree = [], {}
    for p, (i, a) in enumerate(sound):
        for j, b in sound[p + 1:]:
            if len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= threshold:
                links.append((i, j))
                degree[i] = degree.get(i, 0) + 1
                degree[j] = degree.get(j, 0) + 1
    return degree, components({i for i, _ in rows if i is not None}, links)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.RandomState(2)
    rows, i = [], 0
    for size in [1] * 150 + [2, 3, 8, 40, 700]:       # one dense group of more than a block
        centre = rng.randn(16)
        for _ in range(size):
            rows.append((i, (centre + 0.1 * rng.randn(16)).astype(np.float32).tolist()))
            i += 1
    order = rng.permutation(len(rows))
    rows = [(int(p), rows[k][1]) for p, k in enumerate(order)]
    rows += [(5000 + k, rows[3][1]) for k in range(5)]          # equal vectors
    rows += [(6000, None), (6001, []), (6002, [0.0] * 16), (6003, [1.0, None] + [0.0] * 14),
             (6004, [float("nan")] * 16), (6005, [float("inf")] + [0.0] * 15), (None, rows[3][1]),
             (6006, [1.0, 2.0]), (6007, [2.0, 4.0]), (6008, [1e30] * 16), (6009, [1e30] * 16)]
    return rows


def test_links_equal_brute_force(spark, vectors):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors],
                               "vec_id long, embedding array<float>, label string, n_links int")
    got = near_vectors(df, threshold=0.9, audit=300).collect()
    degree, of = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v])
                        for i, v in vectors], 0.9)
    assert len(got) == len(vectors)
    found = sum(r["n_links"] for r in got)
    assert found >= 0.9 * sum(degree.values())
    wrong = 0
    for r in got:
        if r["vec_id"] is None:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, None, True)
            continue
        assert r["n_links"] <= degree.get(r["vec_id"], 0)           # none below the threshold
        assert r["kept"] == (r["vec_id"] == r["component_id"])
        wrong += (r["n_links"], r["component_id"]) != (degree.get(r["vec_id"], 0), of[r["vec_id"]])
    assert wrong <= 0.02 * len(got)


def test_empty_and_repeated(spark):
    schema = "vec_id long, embedding array<float>"
    assert near_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0])]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in
                 near_vectors(spark.createDataFrame(rows, schema)).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (1, 1, 1), (2, 1, 1)]


def test_full_lists_do_not_hide_links_between_groups(spark):
    rng = np.random.RandomState(5)
    base, off = np.eye(16)[0], np.eye(16)[1]
    rows = []
    for centre in (base, 0.96 * base + 0.28 * off):         # 0.96 across, above 0.999 inside
        rows += [(len(rows) + k, (centre + 0.002 * rng.randn(16)).tolist()) for k in range(20)]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), threshold=0.95).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(39, 0)}


def test_a_failed_audit_is_an_error(spark):
    rows = [(i, [1.0, 0.001 * i]) for i in range(5)]
    with pytest.raises(RuntimeError, match="audited"):
        near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), rounds=0, recall=1.01)
