"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

import random
import re

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n_words string, score string,"
          " shard string, removed string, kept string, size string, hit_spans string, item_ids string")


def words(text, pattern=ALNUM):
    return pattern.findall((text or "").translate(FOLD))


def sentence(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def documents(spark, n=60, seed=1, extra=()):
    """Random texts over a small vocabulary with copies, near copies, nulls,
    empty and blank texts, one long text, a null id and clashing columns."""
    rng = random.Random(seed)
    vocabulary = ["Alpha", "beta", "gämma", "delta,", "eps.", "zeta", "Ñu", "x1", "the", "of", "日本", "r2"] + \
        ["w%d" % i for i in range(120)]
    rows = []
    for i in range(n):
        rows.append((i, sentence(rng, rng.choice([1, 2, 5, 30, 80]), vocabulary)))
    rows[7] = (7, None)
    rows[8] = (8, "")
    rows[9] = (9, " \n\t ")
    rows[10] = (10, rows[4][1])
    rows[11] = (11, rows[4][1])
    rows[12] = (12, sentence(rng, 80, vocabulary))
    rows[13] = (13, rows[12][1] + " tail")
    rows[14] = (14, rows[12][1].upper())
    rows[15] = (15, sentence(rng, 6000, vocabulary))
    rows[16] = (16, "aaaa " * 200)
    rows[17] = (17, "!!! ??? ...")
    rows += list(extra)
    rows.append((None, "no id at all"))
    return [(i, t, "en", None if (i or 0) % 7 == 3 else f"s{(i or 0) % 4}", len(t or ""), *["clash"] * 8)
            for i, t in rows]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
