import hashlib
import random

from eventide.llm import lines as ln
from tests.llm.data import FOLD, documents, frame

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=10):
    """(id, text) -> (n_lines, n_dropped, kept text) per row."""
    holder = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.strip(BLANKS).translate(FOLD)
            if len(key) >= min_chars:
                holder[key] = min(holder.get(key, (1, 0)), (0 if i is None else 1, i or 0)) \
                    if key in holder else (0 if i is None else 1, i or 0)
    out = []
    for i, t in rows:
        all_lines = (t or "").split("\n")
        mine = (0 if i is None else 1, i or 0)
        kept = [x for x in all_lines if holder.get(x.strip(BLANKS).translate(FOLD), mine) == mine]
        out.append((i, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def result(df):
    return sorted([(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in df.collect()], key=str)


def texts(seed=3, n=80):
    rng = random.Random(seed)
    pool = ["a line that is repeated", "  A Line that IS repeated \t", "short", "ÄÖÜ äöü ßß", "äöüäöüäöüä", "日本語日本語日本語日",
            "日本語日本語日本", "\x0bvertical tab line\x0c", "0123456789", "012345678", "", " ", "carriage return line\r"]
    pool += ["line number %d of the pool" % i for i in range(30)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.choice([1, 2, 6, 40])))) for i in range(n)]
    rng.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    extra = [(200 + i, t) for i, t in texts()] + [(300, None), (301, ""), (302, "\n"), (303, "x" * 200 + "\n" + "x" * 200)]
    rows = documents(spark, extra=extra)
    df = frame(spark, rows).repartition(7)
    got = result(ln.dedup_lines(df, columns=["doc_id"], with_text=True))
    assert got == brute([(r[0], r[1]) for r in rows])


def test_long_text_and_a_line_in_every_document(spark):
    long_text = "\n".join(["the very same line"] * 200_000 + ["line %d" % i for i in range(50_000)])
    rows = [(i, f"the very same line\nown line of {i:06d}\n{'tail of all' if i % 2 else 'tail'}") for i in range(5, 900)]
    rows += [(3, long_text), (4, long_text.upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(11)
    assert result(ln.dedup_lines(df, with_text=True, columns=["doc_id"])) == brute(rows)


def test_rows_of_one_id_are_one_document(spark):
    rows = [(2, "first shared line\nanother one here"), (2, "another one here\nfirst shared line\nx"),
            (2, "another one here\nfirst shared line\nx"), (5, "first shared line"), (None, "another one here"),
            (None, "null id own line\nnull id own line")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = result(ln.dedup_lines(df, with_text=True, columns=["doc_id"]))
    assert got == brute(rows)
    # the null id comes first, so its copy of the line stays
    assert [g for g in got if g[0] is None and g[1] == 1][0][2] == 0


def test_bitmaps_say_what_stays(spark):
    rows = [(1, "one two three four\nonly in the first"), (2, "x\none two three four\ny"), (3, "nothing to lose")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in ln.dedup_lines(df).collect()}
    assert set(got[1].asDict()) == {"doc_id", "text", "n_lines", "n_dropped", "keep"}
    assert got[1].keep is None and got[3].keep is None
    assert ln.unpack_bits(bytes(got[2].keep), 3).tolist() == [True, False, True]


def test_no_text_is_shuffled_for_bitmaps(spark, capsys):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    ln.dedup_lines(df, columns=["doc_id"]).explain()
    plan = capsys.readouterr().out
    joined = [p for p in plan.splitlines() if "SortMergeJoin" in p or "HashJoin" in p]
    assert joined and "__text" not in "".join(joined)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, keep string, n_lines string")
    out = ln.dedup_lines(empty, with_text=True)
    assert out.columns == ["doc_id", "text", "n_lines", "n_dropped", "keep", "kept_text"] and out.count() == 0


def test_a_hash_range_is_streamed_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        rows = texts(9, 60)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        assert result(ln.dedup_lines(df, with_text=True, columns=["doc_id"])) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_query_columns(spark):
    from eventide.llm.queries import op11_line_dedup
    import tests.conftest as c

    rows = op11_line_dedup(spark, c.SF001).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{c.SF001}/documents.parquet").collect()]
    want = [(i, n, d, hashlib.sha256(k.encode()).hexdigest()) for i, n, d, k in brute(docs)]
    assert sorted([tuple(r) for r in rows], key=str) == sorted(want, key=str)
