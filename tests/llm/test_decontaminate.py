import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from eventide.llm.decontaminate import decontaminate
from tests.llm.data import documents, frame, sentence, words


def brute(docs, items, window, shingle, containment):
    wins = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[k:k + window]), set()).add(item)
    out = {}
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for win, its in wins.items():
            n, q = len(win), min(shingle, len(win))
            need = math.ceil(containment * (n - q + 1) - 1e-9)
            for k in range(len(w) - n + 1):
                same = sum(w[k + j:k + j + q] == list(win[j:j + q]) for j in range(n - q + 1))
                if same >= need:
                    hit.update(range(k, k + n))
                    ids |= its - {None}
        out[doc] = (len(w), len(hit), sorted(ids))
    return out


@pytest.fixture(scope="module")
def case():
    rng = random.Random(5)
    rows = documents(None, 60)
    vocabulary = ["w%d" % i for i in range(120)]
    items = [(i, sentence(rng, rng.choice([1, 3, 9, 10, 14]), vocabulary)) for i in range(25)]
    items += [(90, None), (91, ""), (92, "... !"), (None, "w1 w2"), (93, items[3][1]), (93, items[3][1])]
    rows += [(200 + i, f"Start {t.upper()}, end. {t}" if t else t, "en", "s", 1, *["clash"] * 8)
             for i, (_, t) in enumerate(items[:12])]
    # a passage with one word changed
    long = next(t for _, t in items if t and len(t.split()) == 14).split()
    long[5] = "changed"
    rows.append((300, " ".join(long), "en", "s", 1, *["clash"] * 8))
    return rows, items


@pytest.mark.parametrize("containment,block", [(1.0, 8 << 20), (1.0, 300), (0.5, 8 << 20), (0.5, 300)])
def test_equals_brute_force(spark, case, containment, block):
    rows, items = case
    got = decontaminate(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"), window=10,
                        containment=containment, block_bytes=block, columns=["doc_id", "lang"]).collect()
    want = brute([(r[0], r[1]) for r in rows], items, 10, 3, containment)
    assert len(got) == len(rows)
    for r in got:
        hit = sum(s["end"] - s["start"] for s in r["hit_spans"])
        assert (r["n_words"], hit, r["item_ids"]) == want[r["doc_id"]], r["doc_id"]


def test_empty_tables_and_clashing_columns(spark, case):
    rows, items = case
    docs = frame(spark, rows)
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate(docs, none)
    assert set(got.columns) == set(docs.columns)        # clashing result columns are replaced
    assert got.filter(F.size("hit_spans") > 0).count() == 0 and got.count() == len(rows)
    assert decontaminate(docs.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_query_digest_of_no_items(spark):
    from eventide.llm.queries import op1_prefix_decontamination

    r = op1_prefix_decontamination(spark, "/root/testdata/sf0.001").filter(~F.col("contaminated")).first()
    assert r["items_sha256"] == hashlib.sha256(b"").hexdigest() and r["n_hit"] == 0
