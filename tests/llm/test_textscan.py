import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from eventide.llm import textscan as ts
from tests.llm.data import ALNUM, BLANK, FOLD, words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB1 .\né日\x85\x1c", max_size=30)), max_size=12),
       st.integers(1, 40))
def test_words_are_those_of_the_patterns(texts, limit):
    for word_class, pattern in ((ts.ALNUM_WORD, ALNUM), (ts.BLANK_WORD, BLANK)):
        got = [[] for _ in texts]
        for s in ts.slices(pa.array(texts, pa.string()), limit):
            w = ts.words(s, word_class)
            for r, a, b in zip(w.row, w.start, w.end):
                got[s.first + r].append(bytes(s.data[a:b]).decode().translate(FOLD))
        assert got == [words(t, pattern) for t in texts]


def test_hashes_know_a_word_wherever_it_stands():
    texts = ["one Two three", "THREE two", "x" * (3 * ts.SLICE_BYTES) + " two"]
    seen = {}
    for s in ts.slices(pa.array(texts)):
        w = ts.words(s, ts.ALNUM_WORD)
        for a, b, h in zip(w.start, w.end, w.hash):
            word = bytes(s.data[a:b]).decode().translate(FOLD)
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen) == 4


def test_shingles_stay_inside_a_row():
    s = next(ts.slices(pa.array(["a b c", "d", "", "e f"])))
    w = ts.words(s, ts.ALNUM_WORD)
    at, h = ts.shingles(w, 2)
    assert at.tolist() == [0, 1, 4]
    assert len(np.unique(h)) == 3
