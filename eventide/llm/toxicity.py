"""Toxicity by multiple-instance learning.

Only documents are labelled; the toxic thing is in some sentence.  A sentence
has a logistic score over its words and word beginnings; a document's score is
the noisy-or of its sentences, 1 - prod(1 - p), and the weights are fitted to
the documents' labels through it.  The fitted sentence scores then say where
the offending sentences are.

Learning uses a bounded sample of labelled documents (``max_docs``, expected
size, drawn by a hash of the id); candidate features are counted on it in Spark
and the ``max_features`` that tell most are fitted.  Scoring is one pass over
the documents without a shuffle.

Defined cases: words are runs of digits, letters and non-ASCII characters, A-Z
folded; a null or empty text has no sentence and score 0; several labels of one
document: toxic if any is; null labels and null ids are not learned from; with
no toxic document to learn from all scores are 0; repeated rows are scored one
by one; clashing columns of the input are replaced.
"""

from __future__ import annotations

from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from eventide.llm import textscan as ts
from eventide.llm.scratch import materialize

#: Word beginnings of these many bytes are features beside the words.
STEMS = (4, 5, 6)
MIN_DOCS = 4
_STOP = np.isin(np.arange(256), [10, 33, 46, 63])        # line end ! . ?

RESULT = T.StructType([
    T.StructField("score", T.DoubleType()),
    T.StructField("offending", T.ArrayType(T.StructType([
        T.StructField("sentence", T.StringType()), T.StructField("score", T.DoubleType())]))),
])


class Model(NamedTuple):
    keys: np.ndarray        # sorted feature hashes
    weights: np.ndarray
    bias: float


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True where crc32 of the id as text, modulo ``folds``, is 0 (null: true)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def sentence_features(s: ts.Slice) -> tuple[ts.Words, np.ndarray, np.ndarray]:
    """(words, sentence number of each word, feature hashes: words x kinds)."""
    w = ts.words(s, ts.ALNUM_WORD)
    sentence = np.cumsum(_STOP[s.data])[w.start] if len(w.start) else np.zeros(0, np.int64)
    _, sentence = np.unique(sentence, return_inverse=True)
    kinds = [w.hash]
    for k in STEMS:
        part = ts.range_hash(s.data, w.start, np.minimum(w.start + k, w.end), ts.FOLD_AZ)
        kinds.append(ts.mix64(part + np.uint64(k)))
    return w, sentence, np.stack(kinds, 1)


def _pairs(group: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (group, feature) pairs."""
    if not len(group):
        return group, feature
    order = np.lexsort((feature, group))
    group, feature = group[order], feature[order]
    fresh = np.ones(len(group), bool)
    fresh[1:] = (group[1:] != group[:-1]) | (feature[1:] != feature[:-1])
    return group[fresh].astype(np.int64), feature[fresh]


def feature_counts(sample: DataFrame) -> DataFrame:
    """Documents of either label that hold a feature: key, toxic, clean."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = np.asarray(batch.column(1).to_pylist(), np.int64)
            for s in ts.slices(batch.column(0)):
                w, _, feats = sentence_features(s)
                row, key = _pairs(np.repeat(w.row, feats.shape[1]), feats.ravel())
                key, at = np.unique(key, return_inverse=True)
                n = np.bincount(at, minlength=len(key))
                bad = np.bincount(at, weights=label[s.first + row], minlength=len(key)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(bad), pa.array(n - bad)], ["key", "toxic", "clean"])

    return (sample.select("text", "toxic").mapInArrow(count, "key long, toxic long, clean long")
            .groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def known_in_sentences(s: ts.Slice, keys: np.ndarray):
    """(row of each sentence, sentence, index of a known feature in it)."""
    w, sentence, feats = sentence_features(s)
    n = int(sentence.max()) + 1 if len(sentence) else 0
    row_of = np.zeros(n, np.int64)
    row_of[sentence] = w.row
    flat = feats.ravel()
    at = np.minimum(np.searchsorted(keys, flat), max(len(keys) - 1, 0))
    hit = keys[at] == flat if len(keys) else np.zeros(len(flat), bool)
    sen, feat = _pairs(np.repeat(sentence, feats.shape[1])[hit], at[hit].astype(np.uint64))
    return w, sentence, row_of, sen, feat.astype(np.int64)


def training_bags(sample: DataFrame, keys) -> DataFrame:
    """Per document: label, sentences, and (sentence, feature) pairs."""

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_pylist()
            for s in ts.slices(batch.column(0)):
                _, _, row_of, sen, feat = known_in_sentences(s, keys.value)
                order = np.argsort(row_of[sen], kind="stable")
                sen, feat = sen[order], feat[order]
                cut = np.searchsorted(row_of[sen], np.arange(s.rows + 1))
                count = np.bincount(row_of, minlength=s.rows)
                yield pa.RecordBatch.from_pylist(
                    [{"toxic": label[s.first + r], "n": int(count[r]),
                      "sen": sen[cut[r]:cut[r + 1]].tolist(), "feat": feat[cut[r]:cut[r + 1]].tolist()}
                     for r in range(s.rows)],
                    pa.schema([("toxic", pa.int64()), ("n", pa.int64()),
                               ("sen", pa.list_(pa.int64())), ("feat", pa.list_(pa.int64()))]))

    return sample.select("text", "toxic").mapInArrow(
        bag, "toxic long, n long, sen array<long>, feat array<long>")


def fit_noisy_or(bags: list, n_features: int, start: np.ndarray, steps: int = 400, rate: float = 0.05,
                 l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """Adam on the noisy-or log loss.  ``bags``: (label, sentences, sen, feat)."""
    label = np.array([b[0] for b in bags], np.float64)
    plain, sen_all, feat_all, doc_of = np.zeros(len(bags)), [], [], []
    n_sen = 0
    for d, (_, n, sen, feat) in enumerate(bags):
        ids, local = np.unique(np.asarray(sen, np.int64), return_inverse=True)
        plain[d] = n - len(ids)          # sentences without a known feature
        sen_all.append(local + n_sen)
        feat_all.append(np.asarray(feat, np.int64))
        doc_of.append(np.full(len(ids), d))
        n_sen += len(ids)
    sen, feat, doc = (np.concatenate(x).astype(np.int64) for x in (sen_all, feat_all, doc_of))
    theta = np.append(start, -6.0)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    weight = np.where(label > 0, 1.0, 1.0) / len(label)
    for t in range(1, steps + 1):
        w, b = theta[:-1], theta[-1]
        z = b + np.bincount(sen, weights=w[feat], minlength=n_sen)
        total = np.bincount(doc, weights=np.logaddexp(0, z), minlength=len(label)) + plain * np.logaddexp(0, b)
        gain = np.exp(-total) / np.maximum(-np.expm1(-total), 1e-12)
        pull = weight * np.where(label > 0, -gain, 1.0)          # dLoss / dtotal
        dz = pull[doc] / (1 + np.exp(-z))
        grad = np.empty_like(theta)
        grad[:-1] = np.bincount(feat, weights=dz[sen], minlength=n_features) + l2 * w / n_features
        grad[-1] = dz.sum() + (pull * plain).sum() / (1 + np.exp(-b))
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad ** 2
        theta = theta - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return theta[:-1], float(theta[-1])


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 20_000, max_features: int = 3000,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", seed: int = 1) -> Model:
    """Learn from the labelled documents that are not held out."""
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
             .groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("long").alias("toxic")))
    total = known.count()
    share = min(1.0, max_docs / max(1, total))
    drawn = known.filter(F.pmod(F.xxhash64("__id", F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000))
    sample = materialize(
        docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
        .join(F.broadcast(drawn), "__id")           # about max_docs rows of two numbers
        .select("text", "toxic"), "toxic-sample")
    n = sample.groupBy("toxic").count().collect()
    n = {r["toxic"]: r["count"] for r in n}
    bad, good = n.get(1, 0), n.get(0, 0)
    if not bad:
        return Model(np.zeros(0, np.uint64), np.zeros(0), float("-inf"))
    odds = F.log((F.col("toxic") + 0.1) / (bad + 0.2)) - F.log((F.col("clean") + 0.1) / (good + 0.2))
    best = (feature_counts(sample).filter(F.col("toxic") + F.col("clean") >= min(MIN_DOCS, bad))
            .withColumn("odds", odds).filter(F.abs("odds") > 0.7)
            .withColumn("gain", F.abs("odds") * F.sqrt(F.greatest("toxic", "clean")))
            .orderBy(F.desc("gain"), "key").limit(max_features).select("key", "odds").collect())
    keys = np.array([r["key"] for r in best], np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys, start = keys[order], np.clip(np.array([r["odds"] for r in best])[order], -1, 3) * 0.5
    shipped = docs.sparkSession.sparkContext.broadcast(keys)
    bags = [(r["toxic"], r["n"], r["sen"], r["feat"])
            for r in training_bags(sample, shipped).orderBy("toxic", "n", F.col("sen").cast("string"),
                                                            F.col("feat").cast("string")).toLocalIterator()]
    shipped.destroy()
    weights, bias = fit_noisy_or(bags, len(keys), start)
    return Model(keys, weights, bias)


def score_documents(docs: DataFrame, model: Model, text_col: str = "text", columns: list[str] | None = None,
                    limit: float = 0.5) -> DataFrame:
    """The ``columns`` of ``docs`` (all by default) with score and offending:
    the sentences whose own score is at least ``limit``, in order."""
    own = RESULT.fieldNames()
    columns = [c for c in (docs.columns if columns is None else columns) if c not in own]
    rows = docs.select(*columns, *([] if text_col in columns else [text_col]))
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([rows.schema[c] for c in columns] + RESULT.fields)
    kind = pa.list_(pa.struct([("sentence", pa.string()), ("score", pa.float64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = shipped.value
        for batch in batches:
            scores, places = [], []
            for s in ts.slices(batch.column(text_col)):
                w, sentence, row_of, sen, feat = known_in_sentences(s, x.keys)
                z = x.bias + np.bincount(sen, weights=x.weights[feat], minlength=len(row_of))
                total = np.bincount(row_of, weights=np.logaddexp(0, z), minlength=s.rows)
                scores.append(-np.expm1(-total))
                found: list = [[] for _ in range(s.rows)]
                p = 1 / (1 + np.exp(-z))
                for q in np.flatnonzero(p >= limit).tolist():
                    mine = np.flatnonzero(sentence == q)
                    raw = bytes(s.data[w.start[mine[0]]:w.end[mine[-1]]])
                    found[row_of[q]].append({"sentence": raw.decode("utf-8", "replace"), "score": float(p[q])})
                places += found
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns),
                 pa.array(np.concatenate(scores) if scores else np.zeros(0)), pa.array(places, kind)],
                [*columns, *own])

    return rows.mapInArrow(score, schema)
