import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from eventide.llm import phrases as ph
from eventide.llm import textscan as ts
from tests.llm.data import FOLD, documents, frame


def pieces(text):
    for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(FOLD)):
        yield re.findall("[^ \t]+", piece)


def counted(rows, max_words):
    out = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            out[(lang, 0, "")] += len(w)
            for n in range(1, max_words + 1):
                for i in range(len(w) - n + 1):
                    out[(lang, n, " ".join(w[i:i + n]))] += 1
    return out


def brute(rows, max_words=3, min_count=10, keep=2000, percent=50):
    f = counted(rows, max_words)
    cand = {k: c for k, c in f.items() if k[1] > 1 and c >= min_count}
    best = {}
    for (lang, n, phrase), a in cand.items():
        w = phrase.split(" ")
        if any(100 * b >= percent * a and lang == x and m > n and any(v.split(" ")[i:i + n] == w for i in range(m - n + 1))
               for (x, m, v), b in cand.items()):
            continue
        cuts = []
        for k in range(1, n):
            l, r = f[(lang, k, " ".join(w[:k]))], f[(lang, n - k, " ".join(w[k:]))]
            cuts.append((10 ** 6 * a * a // (l * r), k, l, r))
        best.setdefault(lang, []).append((phrase, a, *min(cuts)))
    out = []
    for lang, found in best.items():
        found.sort(key=lambda x: (-x[2], -x[1], x[0].encode()))
        out += [(lang, i + 1, p, a, l, r, f[(lang, 0, "")], s) for i, (p, a, s, _, l, r) in enumerate(found[:keep])]
    return sorted(out)


def texts(seed=5, n=120):
    rng = random.Random(seed)
    vocabulary = ["New", "york", "city", "the", "of", "Éa", "日本", "x\x00y", "a-b"] + ["w%d" % i for i in range(25)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(300))
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.choice([0, 1, 3, 40, 200])):
            words.append(rng.choice(vocabulary) + rng.choice(["", "", "", "", ",", ".", "\n", " \t", "!?"]))
        text = " ".join(words) + (" " + passage if i % 3 == 0 else "")
        rows.append((i, text, rng.choice(["en", "de", None])))
    return rows


def run(spark, rows, **given):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    return sorted(tuple(r) for r in ph.collocations(df, **given).collect())


def test_against_brute_force(spark):
    rows = texts() + [(900, None, "en"), (901, "", "de"), (902, " ., ", None), (903, "tick tock " * 3000, "en"),
                      (904, "tick tock " * 3000, "en"), (None, "no id at all", None)]
    assert run(spark, rows) == brute([(r[2], r[1]) for r in rows])


def test_several_units_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(ph, "UNIT_BYTES", 4000)
    monkeypatch.setattr(ph, "RANGE_BYTES", 5000)
    monkeypatch.setattr(ph, "SPARE_BITS", -6)            # collisions pass the sieve and are mended
    rows = texts(6)
    want = brute([(r[2], r[1]) for r in rows])
    assert run(spark, rows) == want


@pytest.mark.parametrize("max_words, percent", [(2, 50), (4, 30)])
def test_other_lengths(spark, max_words, percent):
    rows = texts(7, 60)
    assert run(spark, rows, max_words=max_words, min_count=6, inside_percent=percent) == \
        brute([(r[2], r[1]) for r in rows], max_words, 6, percent=percent)


def test_first_rows_of_a_group_in_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr(ph, "RANK_FACTOR", 4)
    rows = texts(8)
    assert run(spark, rows, keep=3) == brute([(r[2], r[1]) for r in rows], keep=3)


def test_phrase_counts_with_clashing_columns(spark):
    rows = documents(spark)
    got = ph.phrase_counts(frame(spark, rows), 3, 2).collect()
    want = {k: c for k, c in counted([(r[2], r[1]) for r in rows], 3).items() if c >= 2 or k[1] == 0}
    assert {(r.lang, r.n, r.phrase): r.f for r in got} == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert ph.collocations(df).collect() == []


@pytest.mark.parametrize("longest", [7, 4096])
def test_chunks_cover_every_gram_once(longest):
    rng = random.Random(2)
    shared = " ".join("w%d" % rng.randrange(50) for _ in range(400))
    raw = ["a b c", "", "x", shared + ". tail", "head, " + shared, " ".join("w%d" % rng.randrange(9) for _ in range(2000))]
    seen, total = Counter(), Counter()
    for s in ts.slices(pa.array(raw), 500):
        chunks, row = ph.parse(s, 2, spacing=6, longest=longest)
        for c in chunks:
            seen[c] += 1
            words = re.findall("[^ \n]+", c.decode())
            assert len(words) <= longest + 2
            own = len(words) if c.endswith(b"\n") else len(words) - 2
            total["words"] += own
    assert total["words"] == sum(len(re.findall("[^ .,]+", t)) for t in raw)
    # the shared passage is cut alike in both texts
    assert sum(c for x, c in seen.items() if c > 1) > 2


def test_score_is_exact_beyond_64_bits(spark):
    """The score's expression on counts of 10^12."""
    from pyspark.sql import functions as F

    a, l, r = 10 ** 12 - 7, 3 * 10 ** 12 + 1, 10 ** 12 + 9
    wide = lambda c: f"cast({c} as decimal(15, 0))"
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    score = df.select(F.expr(f"(cast(1000000 as decimal(8, 0)) * {wide('a')} * {wide('a')}) div "
                             f"({wide('l')} * {wide('r')})")).first()[0]
    assert score == 10 ** 6 * a * a // (l * r)


def test_spelled_tells_phrases_apart_by_two_hashes():
    t = pa.table({"lang": ["en", "en"], "chunk": pa.array([b"a b a\n", b"c d\n"], pa.binary()), "n": [2, 3]})
    g = ph.Grams(t, 2)
    g.key = np.zeros_like(g.key)                         # every first hash collides
    lang, size, phrase, n = g.spelled(np.arange(len(g.key)))
    assert dict(zip(phrase, n.tolist())) == {b"a": 4, b"b": 2, b"c": 3, b"d": 3, b"a b": 2, b"b a": 2, b"c d": 3}
