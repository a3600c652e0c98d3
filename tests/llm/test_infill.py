import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from eventide.llm import infill as fim
from tests.llm.data import documents, frame

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(doc_id, text, rate=50, spm_rate=80, unit="token"):
    text = text or ""
    tokens = TOKEN.findall(text) if unit == "token" else list(text)
    n = len(tokens)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    form = "spm" if h4 % 100 < spm_rate else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return (doc_id, n, form, len(pre), len(mid), out)


def rows_of(spark):
    extra = [(100, "<P> in a text"), (101, "almost <P and <S"), (102, "x<"), (103, "日本語 テキスト　𝒳𝒴 ß"),
             (104, " leading and trailing \t\n"), (105, "  no break   is no blank"), (106, "a"), (107, " "),
             (108, "𝒳" * 500 + " " + "ab" * 40_000), (109, "wörter " * 60_000)]
    return documents(spark, n=90, extra=extra + [(110 + i, "é< <P ab %d <" % i * (i + 1)) for i in range(40)])


@pytest.mark.parametrize("unit, rate, spm_rate", [("token", 50, 80), ("token", 100, 40), ("char", 100, 50)])
def test_against_brute_force(spark, unit, rate, spm_rate):
    rows = rows_of(spark)
    got = fim.fill_in_middle(frame(spark, rows).repartition(5), rate, spm_rate, unit=unit, columns=["doc_id"])
    back = fim.restored(got).collect()
    want = sorted((expected(r[0], r[1], rate, spm_rate, unit) for r in rows), key=str)
    assert sorted((tuple(r)[:6] for r in back), key=str) == want
    texts = {r[0]: r[1] or "" for r in rows}
    assert all(r.restored == texts[r.doc_id] for r in back)
    assert {r.form for r in back} == {"plain", "psm", "spm"}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab <>PSM\n\tßé日𝒳"), max_size=40))
def test_index_converts_both_ways(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    index = fim.ExceptionIndex.of(raw)
    for c in range(len(text) + 1):
        b = len(text[:c].encode())
        assert index.to_bytes(c) == b and index.to_chars(b) == c
    assert len(index.byte_at) == sum(len(x.encode()) > 1 for x in text)      # nothing for ASCII


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("a <>PSM"), max_size=12), st.integers(0, 12), st.integers(0, 12),
       st.sampled_from(["psm", "spm"]))
def test_restore_inverts_arrange(text, a, b, form):
    if any(x in text for x in ("<P>", "<S>", "<M>")):
        return
    a, b = sorted((min(a, len(text)), min(b, len(text))))
    assert fim.restore(fim.arrange(text.encode(), a, b, form), form) == text.encode()


def test_restore_refuses_other_forms():
    with pytest.raises(ValueError):
        fim.restore(b"no sentinel", "psm")


def test_empty_table_repeated_rows_and_clashing_columns(spark):
    schema = "doc_id long, text string, form string, output string, n string, restored string"
    empty = fim.restored(fim.fill_in_middle(spark.createDataFrame([], schema)))
    assert empty.count() == 0
    assert empty.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    twice = spark.createDataFrame([(7, "some words in here", "x", "y", "z", "r")] * 2, schema)
    one, other = fim.fill_in_middle(twice, rate=100).collect()
    assert one == other and one.form != "plain"


def test_unknown_unit(spark):
    with pytest.raises(ValueError):
        fim.fill_in_middle(spark.createDataFrame([(1, "a")], "doc_id long, text string"), unit="byte")
