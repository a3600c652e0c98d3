"""Phrase collocations by prefix-free parsing.

Texts are read as words; ``.,;:!?`` and line ends part them into pieces that
no phrase crosses.  Everything is counted per language.

1.  Parsing.  A window of w = ``max_words`` - 1 words whose hash falls on a
    trigger starts a new chunk; a chunk reaches to the end of the next trigger
    window, so neighbours overlap by w words and equal passages give equal
    chunks wherever they stand.  The last chunk of a text carries an end mark.
2.  Dictionary.  Equal chunks meet in one unit (dealt by their hash) and become
    one entry with their number, the parse frequency.
3.  Counting.  n-grams are counted in the distinct chunks, weighted by the
    frequency.  An n-gram belongs to the chunk in which it starts before the
    last w words (the next chunk has those), so overlaps count once.
    A sieve comes first: each unit sends its n-grams as short sorted hashes
    with weights to the ranges of the hash space; a range adds up and answers
    one bit per n-gram, whether ``min_count`` is reached.  Hashes that collide
    can only let a rare n-gram pass.  What passes is counted exactly, by its
    words, in one aggregation over strings.

All numbers behind a result are thus exact, and scores are computed as whole
numbers of 38 digits.

Defined cases: A-Z are folded; a null language is ``und``; null and empty texts
have no words; repeated rows count each; an empty table gives no rows; extra
columns are left out.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from eventide.llm import textscan as ts
from eventide.llm.scratch import materialize

_U = np.uint64
_STEP = _U(0xD1342543DE82EF95)
#: Words between two triggers on average, and at most in a chunk.
SPACING = 24
LONGEST = 4096
#: Chunk bytes of a unit, and text bytes that a range of the sieve stands for, about.
UNIT_BYTES = 3 << 20
RANGE_BYTES = 4 << 20
#: Bits that sieve hashes have beyond those of the corpus size in bytes.
SPARE_BITS = 8
#: A ranking task gets at most so many times the rows that a group keeps.
RANK_FACTOR = 32

_BYTES = np.arange(256)
_PIECE_END = np.isin(_BYTES, [*b".,;:!?", 10, 11, 12, 13])
_WORD = ~(_PIECE_END | (_BYTES == 32) | (_BYTES == 9))
_LOW = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_CANONICAL_WORD = (_BYTES != 32) & (_BYTES != 10)
_SECOND = np.random.RandomState(77).randint(1, 1 << 62, 256, dtype=np.int64).astype(np.uint64) | _U(1)


def _edges(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def parse(s: ts.Slice, width: int, spacing: int = SPACING, longest: int = LONGEST) -> tuple[list[bytes], np.ndarray]:
    """The chunks of a slice's texts, and the row of each.  In a chunk words are
    parted by a blank, pieces by a line feed; one at its end is the end mark."""
    data = _LOW[s.data]
    word = _WORD[data]
    start, end = _edges(word)
    n = len(start)
    if not n:
        return [], np.zeros(0, np.int64)
    first = np.searchsorted(start, np.append(s.begin, len(data) + 1))
    row = np.repeat(np.arange(s.rows), np.diff(first))
    ends = np.concatenate(([0], np.cumsum(_PIECE_END[data])))
    stop = np.ones(n, bool)
    stop[:-1] = (ends[start[1:]] > ends[end[:-1]]) | (row[1:] != row[:-1])
    # texts in canonical form: every gap is one byte
    data = np.append(data, np.uint8(10))
    data[end] = np.where(stop, 10, 32)
    word = np.append(word, False)
    word[end] = True
    text = data[word].tobytes()
    to = np.cumsum(end - start + 1) - 1
    at = to - (end - start)

    opens = np.zeros(n, bool)
    opens[first[:-1][np.diff(first) > 0]] = True
    texts = np.flatnonzero(opens)
    m = n - width + 1
    if m > 0:
        h = ts.mix64(ts.range_hash(s.data, start, end, ts.FOLD_AZ) + stop)
        window = np.zeros(m, _U)
        for k in range(width):
            window = ts.mix64(window * _STEP + h[k:k + m])
        opens[:m] |= (window % _U(spacing) == 0) & (row[:m] == row[width - 1:width - 1 + m])
    begin = np.flatnonzero(opens)
    size = np.diff(np.append(begin, n))
    if (size > longest).any():
        extra = [np.arange(b + longest, b + k, longest) for b, k in zip(begin[size > longest], size[size > longest])]
        extra = np.concatenate(extra)
        extra = extra[extra + width <= first[row[extra] + 1]]
        begin = np.union1d(begin, extra)
    after = np.append(begin[1:], n)                         # where the next chunk starts
    last = np.append(np.isin(begin[1:], texts), True)
    stop_at = np.where(last, to[after - 1] + 1, to[np.minimum(after + width, n) - 1])
    return [text[a:b] for a, b in zip(at[begin].tolist(), stop_at.tolist())], row[begin]


def _distinct(lang: pa.Array, chunk: pa.Array, n: pa.Array) -> pa.Table:
    t = pa.table({"lang": lang, "chunk": chunk, "n": n}).group_by(["lang", "chunk"]).aggregate([("n", "sum")])
    return t.rename_columns(["lang", "chunk", "n"] if t.column_names[0] == "lang" else ["n", "lang", "chunk"])


def _parse_batches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks: list[bytes] = []
            rows = []
            for s in ts.slices(batch.column("text")):
                got, row = parse(s, width)
                chunks += got
                rows.append(row + s.first)
            if chunks:
                t = _distinct(batch.column("lang").take(pa.array(np.concatenate(rows))), pa.array(chunks, pa.binary()),
                              pa.array(np.ones(len(chunks), np.int64)))
                yield from t.select(["lang", "chunk", "n"]).combine_chunks().to_batches()
    return run


class Grams:
    """All n-grams of a unit's distinct chunks."""

    def __init__(self, table: pa.Table, max_words: int):
        t = _distinct(*(table.column(c).combine_chunks() for c in ("lang", "chunk", "n"))).combine_chunks()
        langs = t.column("lang").combine_chunks().dictionary_encode()
        code, names = langs.indices.to_numpy(), langs.dictionary.to_pylist()
        salt = ts.mix64(np.array([hash_text(x) for x in names] or [0], np.uint64))
        weight = t.column("n").to_numpy()
        data, begin, end, weights, lang = [], [], [], [], []
        keys: list = [[] for _ in range(max_words)]
        starts: list = [[] for _ in range(max_words)]
        at = base = 0
        for s in ts.slices(t.column("chunk")):
            start, stop_at = _edges(_CANONICAL_WORD[s.data])
            first = np.searchsorted(start, np.append(s.begin, len(s.data) + 1))
            row = np.repeat(np.arange(s.rows), np.diff(first))
            h = ts.range_hash(s.data, start, stop_at, ts.EXACT)
            gap = np.append(s.data, np.uint8(10))[stop_at] == 10
            marked = s.data[s.end - 1] == 10
            own = np.arange(len(start)) < (first[1:] - np.where(marked, 0, max_words - 1))[row]
            code_of = code[s.first + row]
            key = np.zeros(len(start), np.uint64)
            for k in range(max_words):
                m = len(start) - k
                if m <= 0:
                    break
                if k:
                    own = own[:m] & ~gap[k - 1:k - 1 + m]
                key = ts.mix64(key[:m] * _STEP + h[k:k + m])
                i = np.flatnonzero(own)
                keys[k].append(ts.mix64(key[i] + salt[code_of[i]] + _U(k)))
                starts[k].append((i + at).astype(np.int32))
            data.append(s.data)
            begin.append((start + base).astype(np.int32))
            end.append((stop_at + base).astype(np.int32))
            weights.append(weight[s.first + row])
            lang.append(code_of.astype(np.int32))
            at += len(start)
            base += len(s.data)
        def join(parts, kind):
            out = np.concatenate(parts) if parts else np.zeros(0, kind)
            parts.clear()
            return out

        self.max_words, self.names = max_words, names
        self.data, self.begin, self.end = join(data, np.uint8), join(begin, np.int32), join(end, np.int32)
        self.weight, self.lang = join(weights, np.int64), join(lang, np.int32)
        self.sizes = [sum(map(len, k)) for k in keys]
        self.word = join([x for k in starts for x in k], np.int32)
        del starts
        self.key = join([x for k in keys for x in k], np.uint64)

    def short(self, id_bits: int):
        """(distinct short keys, their weights, the place of each n-gram's key)."""
        short = self.key >> _U(64 - id_bits)
        order = np.argsort(short).astype(np.int32)
        short = short[order]
        new = np.ones(len(short), bool)
        new[1:] = short[1:] != short[:-1]
        place = np.empty(len(short), np.int32)
        place[order] = np.cumsum(new, dtype=np.int32) - 1
        first = np.flatnonzero(new)
        weights = np.add.reduceat(self.weight[self.word[order]], first) if len(first) else np.zeros(0, np.int64)
        return short[first], weights, place

    def spelled(self, chosen: np.ndarray):
        """(language, words, phrase, weight) of the distinct ones of the chosen n-grams."""
        size = np.repeat(np.arange(self.max_words), self.sizes)[chosen]
        word, key = self.word[chosen], self.key[chosen]
        begin, end = self.begin[word], self.end[word + size]
        # two independent hashes of 64 bits tell phrases apart
        h = ts.range_hash(self.data, self.begin, self.end, _SECOND)
        other = np.zeros(len(word), np.uint64)
        for k in range(self.max_words):
            more = size >= k
            other[more] = ts.mix64(other[more] * _STEP + h[word[more] + k])
        order = np.lexsort((other, key))
        key, other = key[order], other[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (other[1:] != other[:-1])
        sums = np.add.reduceat(self.weight[word[order]], np.flatnonzero(new)) if len(key) else np.zeros(0, np.int64)
        pick = order[new]
        raw = self.data.tobytes()
        phrases = [raw[a:b] for a, b in zip(begin[pick].tolist(), end[pick].tolist())]
        return self.lang[word[pick]], size[pick] + 1, phrases, sums

    def words_by_language(self) -> list[tuple[str, int]]:
        mine = self.word[:self.sizes[0]]
        n = np.bincount(self.lang[mine], weights=self.weight[mine], minlength=len(self.names))
        return [(x, int(c)) for x, c in zip(self.names, n)]


def hash_text(text: str) -> int:
    out = 1469598103934665603
    for b in text.encode():
        out = (out ^ b) * 1099511628211 % (1 << 64)
    return out


def phrase_counts(docs: DataFrame, max_words: int = 3, min_count: int = 10, text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """Exact counts of all phrases of up to ``max_words`` words that occur at
    least ``min_count`` times: lang, n (words), phrase, f; and for every
    language a row of n = 0 whose f counts all its words."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    units = max(1, -(-total // UNIT_BYTES))
    ranges = max(1, -(-total // RANGE_BYTES))
    id_bits = min(64, SPARE_BITS + max(1, math.ceil(math.log2(total + 2))))
    chunks = (docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text.alias("text"))
              .mapInArrow(_parse_batches(max_words - 1), "lang string, chunk binary, n long"))
    chunks = chunks.withColumn("unit", F.pmod(F.xxhash64("lang", "chunk"), F.lit(units)).cast("int"))

    def ask(table: pa.Table) -> pa.Table:
        keys, weights, _ = Grams(table, max_words).short(id_bits)
        edges = [(r << id_bits) // ranges for r in range(1, ranges)]
        cut = np.concatenate(([0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)])).astype(np.int64)
        used = np.flatnonzero(np.diff(cut))
        return pa.table({
            "range": pa.array(used, pa.int32()),
            "unit": pa.array([table.column("unit")[0].as_py()] * len(used), pa.int32()),
            "keys": pa.array([ts.planes(np.diff(keys[cut[r]:cut[r + 1]], prepend=_U(0))) for r in used], pa.binary()),
            "weights": pa.array([ts.planes(weights[cut[r]:cut[r + 1]]) for r in used], pa.binary())})

    def sieve(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(ts.from_planes(k, np.uint64), dtype=np.uint64) for k in table.column("keys").to_pylist()]
        weights = np.concatenate([ts.from_planes(c, np.int64) for c in table.column("weights").to_pylist()])
        cut = np.cumsum([0] + [len(k) for k in keys])
        uniq, inv = np.unique(np.concatenate(keys), return_inverse=True)
        often = np.bincount(inv, weights=weights, minlength=len(uniq)) >= min_count
        return pa.table({"unit": table.column("unit"), "range": table.column("range"),
                         "n": pa.array([len(k) for k in keys], pa.int32()),
                         "often": pa.array([np.packbits(often[inv[a:b]]).tobytes() for a, b in zip(cut, cut[1:])],
                                           pa.binary())})

    def spell(left: pa.Table, right: pa.Table) -> pa.Table:
        grams = Grams(left, max_words)
        uniq, _, inv = grams.short(id_bits)
        answers = sorted(zip(right.column("range").to_pylist(), right.column("n").to_pylist(),
                             right.column("often").to_pylist()))
        often = [np.unpackbits(np.frombuffer(bits, np.uint8), count=n) for _, n, bits in answers]
        often = np.concatenate(often).astype(bool) if often else np.zeros(len(uniq), bool)
        lang, size, phrases, sums = grams.spelled(np.flatnonzero(often[inv]))
        words = grams.words_by_language()
        names = np.array([*grams.names, ""], object)
        return pa.table({
            "lang": pa.array([*names[lang], *(x for x, _ in words)], pa.string()),
            "n": pa.array([*size.tolist(), *([0] * len(words))], pa.int32()),
            "phrase": pa.array(phrases + [b""] * len(words), pa.binary()).cast(pa.string()),
            "f": pa.array([*sums.tolist(), *(c for _, c in words)], pa.int64())})

    asked = chunks.groupBy("unit").applyInArrow(ask, "range int, unit int, keys binary, weights binary")
    answered = asked.groupBy("range").applyInArrow(sieve, "unit int, range int, n int, often binary")
    named = chunks.groupBy("unit").cogroup(answered.groupBy("unit")).applyInArrow(
        spell, "lang string, n int, phrase string, f long")
    return (named.groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f"))
            .filter((F.col("n") == 0) | (F.col("f") >= min_count)))


def first_per_group(df: DataFrame, group: str, order: list, keep: int, spread: str) -> DataFrame:
    """The first ``keep`` rows of each group with their rank.  Groups are cut
    by the hash of ``spread`` until a task ranks a bounded number of rows."""
    rows = df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    while rows > RANK_FACTOR * keep:
        parts = -(-rows // (RANK_FACTOR * keep // 2))
        within = Window.partitionBy(group, "__part").orderBy(*order)
        df = (df.withColumn("__part", F.pmod(F.xxhash64(spread, F.lit(parts)), F.lit(parts)))
              .withColumn("__rank", F.row_number().over(within))
              .filter(F.col("__rank") <= keep).drop("__rank", "__part"))
        rows = parts * keep
    return (df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long"))
            .filter(F.col("rank") <= keep))


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, inside_percent: int = 50,
                 keep: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each language's ``keep`` best phrases of 2 to ``max_words`` words: lang,
    rank, phrase, a (its count), l and r (counts of the parts at the cut that
    scores lowest), n (words of the language), score (10^6 a^2 / (l r)).  A
    phrase inside a longer one that has ``inside_percent`` of its count or more
    is left out."""
    counts = materialize(phrase_counts(docs, max_words, min_count, text_col, lang_col), "phrases")
    one = counts.filter("n > 0")
    found = one.filter("n > 1").select("lang", "phrase", F.col("f").alias("a"), F.col("n").alias("size"),
                                       F.split("phrase", " ").alias("w"))
    words = lambda start, n: F.array_join(F.slice("w", start, n), " ")
    part = lambda name, f: one.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = (found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
            .withColumn("head", words(F.lit(1), F.col("k")))
            .withColumn("tail", words(F.col("k") + 1, F.col("size") - F.col("k")))
            .join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"]))
    wide = lambda c: f"cast({c} as decimal(15, 0))"
    score = F.expr(f"(cast(1000000 as decimal(8, 0)) * {wide('a')} * {wide('a')}) div ({wide('l')} * {wide('r')})")
    scored = (cuts.withColumn("score", score)
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best")))
    longer = (found.filter("size > 2")
              .withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
              .withColumn("i", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
              .select("lang", words(F.col("i"), F.col("m")).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("around")))
    kept = (scored.join(longer, ["lang", "phrase"], "left")
            .filter(F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * inside_percent))
            .select("lang", "phrase", "a", "best.l", "best.r", "best.score"))
    ranked = first_per_group(materialize(kept, "collocations"), "lang",
                             [F.desc("score"), F.desc("a"), F.asc("phrase")], keep, "phrase")
    return (ranked.join(counts.filter("n = 0").select("lang", F.col("f").alias("n")), "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
