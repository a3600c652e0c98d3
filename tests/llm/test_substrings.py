import random

import numpy as np
import pyarrow as pa
import pytest

from eventide.llm import substrings as ss, textscan as ts
from tests.llm.data import documents, frame


def brute(rows, length):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][1] or ""))
    seen, out = set(), {}
    for i in order:
        raw = (rows[i][1] or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            if raw[k:k + length] in seen:
                gone[k:k + length] = True
            seen.add(raw[k:k + length])
        out.setdefault(rows[i][0], []).append((gone, raw))
    return out


def check(got, rows, length):
    want = brute(rows, length)
    assert len(got) == len(rows)
    result = {}
    for r in got:
        result.setdefault(r["doc_id"], []).append(r)
    for doc, cases in want.items():
        mine = sorted((tuple((s["start"], s["end"]) for s in r["removed"]), bytes(r["kept"])) for r in result[doc])
        theirs = []
        for gone, raw in cases:
            edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
            theirs.append((tuple(zip(edge[::2].tolist(), edge[1::2].tolist())),
                           bytes(np.frombuffer(raw, np.uint8)[~gone])))
        assert mine == sorted(theirs), doc


def test_equals_brute_force_on_repetitive_texts(spark):
    rng = random.Random(3)
    pool = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 60))) for _ in range(12)]
    rows = [(i * 3 % 101, "".join(rng.choice(pool) for _ in range(rng.randint(0, 12))), "", "", 0, *["c"] * 8)
            for i in range(80)]
    for length in (20, 40):
        got = ss.drop_repeats(frame(spark, rows), length=length, columns=["doc_id"]).collect()
        check(got, [(r[0], r[1]) for r in rows], length)


def test_awkward_rows(spark):
    rows = documents(spark, extra=[(20, "x" * 400), (20, "x" * 400), (21, "ab" * 300)])
    got = ss.drop_repeats(frame(spark, rows), length=100, columns=["doc_id"]).collect()
    check(got, [(r[0], r[1]) for r in rows], 100)
    docs = frame(spark, rows)
    assert set(ss.drop_repeats(docs).columns) == set(docs.columns)
    assert ss.drop_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("piece", [64, 1 << 20])
def test_every_window_has_one_anchor(monkeypatch, piece):
    monkeypatch.setattr(ss, "PIECE", piece)
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab") for _ in range(n)) for n in (10, 20, 200, 0, 333)]
    s = next(ts.slices(pa.array(texts)))
    _, _, row, at, n = ss.anchors(s, 20)
    covered = sorted((r, i) for r, a, k in zip(row, at, n) for i in range(a, a + k))
    assert covered == [(r, i) for r, t in enumerate(texts) for i in range(len(t) - 19)]
