import random

import numpy as np
import pytest
import zlib
from pyspark.sql import functions as F

from eventide.llm import toxicity as tx
from tests.llm.data import documents, frame


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    vocabulary = ["w%d" % i for i in range(400)]
    bad = ["badword", "uglytail", "nastyness", "nastyful"]
    docs, labels = [], []
    for i in range(1500):
        sentences = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 9))) for _ in range(rng.randint(1, 12))]
        toxic = i % 6 == 0
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] += " " + rng.choice(bad).upper()
        docs.append((i, ". ".join(sentences) + "."))
        if i % 3 != 1:
            labels.append((i, int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels + labels[:5] + [(99999, 1), (3, None), (None, 1)], "doc_id long, toxic int"))


def test_held_out_accuracy_and_place(spark, corpus):
    docs, labels = corpus
    model = tx.train(docs, labels)
    got = tx.score_documents(docs, model).withColumn("held", tx.held_out(F.col("doc_id"))).collect()
    assert len(got) == 1500
    wrong = 0
    for r in got:
        assert r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        if r["held"] or r["doc_id"] % 3 == 1:               # never learned from
            wrong += (r["score"] >= 0.5) != (r["doc_id"] % 6 == 0)
        for s in r["offending"]:
            assert any(b in s["sentence"].lower() for b in ("badword", "uglytail", "nasty"))
        assert r["score"] < 0.5 or r["offending"] or r["score"] < 0.75
    assert wrong <= 5
    again = tx.train(docs.repartition(3), labels)
    assert np.allclose(np.sort(model.weights), np.sort(again.weights), atol=1e-6)


def test_awkward_rows(spark, corpus):
    docs, labels = corpus
    rows = documents(spark)
    model = tx.train(docs, labels)
    got = tx.score_documents(frame(spark, rows), model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["score"] == 0 for r in got if r["doc_id"] in (7, 8, 9, 17))
    assert tx.score_documents(frame(spark, []), model).count() == 0
    none = tx.train(docs, labels.limit(0))
    assert tx.score_documents(docs, none).filter("score > 0").count() == 0
    assert tx.train(docs.limit(0), labels).bias == float("-inf")
