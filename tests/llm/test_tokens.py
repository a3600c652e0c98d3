import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from eventide.llm import tokens as tk
from eventide.session import scratch_path
from tests.llm.data import documents, frame

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2 ** 32 - 1), min_size=1, max_size=300))
def test_block_round_trip(ids):
    ids = np.array(ids, np.uint32)
    assert tk.unpack_block(tk.pack_block(ids)).tolist() == ids.tolist()


def test_outliers_do_not_widen_a_block():
    ids = np.random.RandomState(1).randint(100, 200, 8192).astype(np.uint32)
    plain = len(tk.pack_block(ids))
    ids[[5, 4000]] = [2 ** 31, 0]
    assert len(tk.pack_block(ids)) < plain + 1100      # the minimum moved to 0: one bit more, two exceptions
    assert tk.unpack_block(tk.pack_block(np.full(9, 7, np.uint32))).tolist() == [7] * 9


def whole(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(VOCABULARY)
    return [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aBc's tré́.,!\n\t  \x1c\x85<|>12ΣσİÉ日≠-", max_size=40))
def test_pieces_equal_whole_texts(text):
    assert tk.word_encoder(VOCABULARY)(text).tolist() == whole([text])[0]


def test_special_marks_in_texts():
    for t in ["<|endoftext|>", "a <|startoftext|>.", "x<|endoftext|>b. <|ENDOFTEXT|>", "it's don't. '", ". , ..", ""]:
        assert tk.word_encoder(VOCABULARY)(t).tolist() == whole([t])[0], t


def test_files_hold_all_documents_in_order(spark):
    rows = documents(spark) + [(30, "again", *["x"] * 2, 1, *["c"] * 8)]
    folder = scratch_path(spark, "test-tokens")
    manifest = tk.write_token_shards(frame(spark, rows), VOCABULARY, folder, end_id=2)
    got = sorted(tk.read_token_shards(manifest, folder).collect(), key=lambda r: r["start"])
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for r, row, ids in zip(got, order, whole([r[1] or "" for r in order])):
        ids = np.array([*ids, 2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (
            row[0], at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(got) == len(rows)
    m = max(manifest.collect(), key=lambda r: r["n_tokens"])
    reader = tk.ShardReader(folder, m["path"])
    every = reader.ids(0, reader.n_ids)
    assert len(every) == m["n_tokens"]
    assert reader.ids(17, 60).tolist() == every[17:60].tolist()      # random access


def test_no_documents(spark):
    assert tk.token_shards(frame(spark, []), VOCABULARY, end_id=2).count() == 0
