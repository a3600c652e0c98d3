import struct
import zlib

import pytest
import xxhash

from eventide.llm import sharding as sh
from tests.llm.data import documents, frame


def spark_hash(*parts):
    seed = 42
    for p, kind in parts:
        seed = xxhash.xxh64(struct.pack(kind, p), seed=seed).intdigest()
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def place(x, n, seed):
    """The same permutation, in plain Python."""
    a, b = sh.domain(n)
    while True:
        left, right = x // b % a, x % b
        for k in range(sh.ROUNDS):
            if k % 2 == 0:
                left = (left + spark_hash((seed, "<i"), (k, "<i"), (right, "<q")) % a) % a
            else:
                right = (right + spark_hash((seed, "<i"), (k, "<i"), (left, "<q")) % b) % b
        x = left * b + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1001])
def test_permutation_is_the_documented_one(spark, n):
    df = spark.range(n).withColumnRenamed("id", "i")
    got = {r["i"]: r["p"] for r in sh.permute(df, "i", n, 9, "p").collect()}
    assert sorted(got.values()) == list(range(n))
    assert all(got[i] == place(i, n, 9) for i in range(0, n, max(1, n // 50)))


def test_shards_of_awkward_rows(spark):
    rows = documents(spark) + [documents(spark)[0]] * 3
    docs = frame(spark, rows)
    got = sh.feistel_shards(docs, 8, carry=["doc_id", "text"]).collect()
    assert len(got) == len(rows)
    assert sorted(r["row_number"] for r in got) == list(range(len(rows)))
    by = {}
    for r in got:
        raw = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        assert (r["shard"], r["slot"]) == (r["position"] % 8, r["position"] // 8)
        by.setdefault(r["shard"], []).append(r["slot"])
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    again = sh.feistel_shards(docs.repartition(5), 8, carry=["doc_id", "text"]).collect()
    key = lambda rs: sorted((str(r["doc_id"]), r["text"] or "", r["shard"], r["slot"]) for r in rs)
    assert key(got) == key(again)
    order = sorted(got, key=lambda r: r["row_number"])
    ids = [r["doc_id"] for r in order]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert set(sh.feistel_shards(docs, 8).columns) >= set(docs.columns)
    assert sh.feistel_shards(docs.limit(0), 8).count() == 0
