import math
from collections import Counter

import pytest

from eventide.llm import backoff as bo
from tests.llm.data import documents, frame, words


def brute(rows, order, cutoff, alpha):
    count, total = Counter(), 0
    for _, t in rows:
        w = words(t)
        total += len(w)
        for n in range(1, order + 1):
            count.update(zip(*[w[k:] for k in range(n)]))
    out = []
    for i, t in rows:
        w, s, steps = words(t), 0.0, 0
        for k in range(len(w)):
            for n in range(min(order, k + 1), 0, -1):
                g = tuple(w[k - n + 1:k + 1])
                if n == 1:
                    s += math.log10(count[g] / total)
                elif count[g] >= cutoff:
                    s += math.log10(count[g] / count[g[:-1]])
                    break
                else:
                    s += math.log10(alpha)
                    steps += 1
        out.append((str(i), len(w), round(s, 6), steps))
    return sorted(out)


@pytest.mark.parametrize("order,unit", [(3, 16 << 20), (3, 4000), (1, 4000), (4, 9000)])
def test_equals_brute_force(spark, monkeypatch, order, unit):
    monkeypatch.setattr(bo, "UNIT_BYTES", unit)
    monkeypatch.setattr(bo, "PART_BYTES", unit // 2)
    rows = documents(spark)
    rows += [rows[5]] * 2
    got = bo.backoff_scores(frame(spark, rows), order=order).collect()
    want = brute([(r[0], r[1]) for r in rows], order, 2, 0.4)
    mine = sorted((str(r["doc_id"]), r["n_words"], round(r["score"], 6), r["backoffs"]) for r in got)
    assert [x[:2] + x[3:] for x in mine] == [x[:2] + x[3:] for x in want]
    assert all(abs(a[2] - b[2]) < 1e-5 for a, b in zip(mine, want))
    assert all((r["score_per_word"] is None) == (r["n_words"] == 0) for r in got)


def test_no_documents(spark):
    assert bo.backoff_scores(frame(spark, [])).count() == 0
    assert bo.backoff_scores(frame(spark, documents(spark)[7:9])).select("score").distinct().collect()[0][0] == 0
