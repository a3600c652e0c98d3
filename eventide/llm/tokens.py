"""Token ids in a binary format: patched frame-of-reference (PFOR) blocks.

A shard file holds the ids of consecutive documents, in blocks of
``BLOCK_IDS`` ids.  Of a block the minimum is subtracted; the width is the one
(of 0 to 32 bits) that most of the differences fit, as the ``PERCENTILE``-th of
their bit widths says; the differences are packed at that width, and those that
need more bits go in full to an exception list (position, difference).

File layout (little endian):

    blocks      u32 minimum, u16 ids, u8 width, u8 zero, u16 exceptions, u16 zero,
                packed bits (one plane per bit, lowest first, whole bytes each),
                u16 positions, u32 differences of the exceptions
    documents   i64 ids of documents, u8 null marks, u64 numbers of token ids
    index       u64 start of each block
    trailer     u64 start of documents, u64 documents, u64 blocks, u64 token ids,
                u32 crc32 of documents and index, 8 bytes MAGIC

The index gives the block of any id of the shard without reading the others.

Defined cases: a null text is an empty one (its end id only); a null document
id sorts first; rows with equal ids are separate documents, ordered by text; an
empty table makes no files and no rows; extra columns are left out.
"""

from __future__ import annotations

import os
import struct
import zlib
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from eventide.llm.scratch import materialize
from eventide.session import scratch_path

BLOCK_IDS = 8192
PERCENTILE = 95
MAGIC = b"PFORTOK1"
_HEAD = struct.Struct("<IHBBHH")
_TRAILER = struct.Struct("<QQQQI8s")
#: Distinct words whose ids a worker remembers, twice: those of late and those before.
CACHE_WORDS = 700_000
#: ASCII marks that can be parted from the letters before them.
_MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"


# ---- blocks ---------------------------------------------------------------

def pack_block(ids: np.ndarray) -> bytes:
    low = int(ids.min())
    diff = ids - np.uint32(low)
    at = (len(ids) * PERCENTILE - 1) // 100
    width = int(np.partition(diff, at)[at]).bit_length()
    out = np.flatnonzero(diff >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    planes = []
    for bit in range(0, width, 8):
        byte = (diff >> np.uint32(bit)).astype(np.uint8)
        shift = np.arange(min(8, width - bit), dtype=np.uint8)[:, None]
        planes.append(np.packbits((byte >> shift) & np.uint8(1), axis=1).tobytes())
    return (_HEAD.pack(low, len(ids), width, 0, len(out), 0) + b"".join(planes)
            + out.astype("<u2").tobytes() + diff[out].astype("<u4").tobytes())


def unpack_block(raw: bytes) -> np.ndarray:
    low, n, width, _, n_out, _ = _HEAD.unpack_from(raw)
    at, row = _HEAD.size, (n + 7) // 8
    bits = np.unpackbits(np.frombuffer(raw, np.uint8, width * row, at).reshape(width, row), axis=1, count=n)
    diff = np.zeros(n, np.uint32)
    for bit in range(0, width, 8):
        lane = bits[bit:bit + 8]
        byte = np.bitwise_or.reduce(lane << np.arange(len(lane), dtype=np.uint8)[:, None], axis=0)
        diff |= byte.astype(np.uint32) << np.uint32(bit)
    at += width * row
    where = np.frombuffer(raw, "<u2", n_out, at)
    diff[where] = np.frombuffer(raw, "<u4", n_out, at + 2 * n_out)
    return diff + np.uint32(low)


# ---- files ----------------------------------------------------------------

class ShardWriter:
    """Writes one shard block by block; the file gets its name when complete,
    so a repeated or killed task never leaves a part of one under it."""

    def __init__(self, folder: str, name: str):
        self.fs, base = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(base, recursive=True)
        self.path = f"{base}/{name}"
        self.part = f"{self.path}.{os.getpid()}.{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}"
        self.out = self.fs.open_output_stream(self.part)
        self.at, self.ids, self.wait, self.waiting = 0, 0, [], 0
        self.starts: list = []
        self.doc_ids: list = []
        self.lengths: list = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.wait.append(ids)
        self.waiting += len(ids)
        if self.waiting >= BLOCK_IDS:
            self._blocks(False)

    def _blocks(self, rest: bool) -> None:
        ids = np.concatenate(self.wait) if self.wait else np.zeros(0, np.uint32)
        end = len(ids) if rest else len(ids) - len(ids) % BLOCK_IDS
        for i in range(0, end, BLOCK_IDS):
            raw = pack_block(ids[i:min(end, i + BLOCK_IDS)])
            self.starts.append(self.at)
            self.out.write(raw)
            self.at += len(raw)
        self.ids += end
        self.wait, self.waiting = [ids[end:]], len(ids) - end

    def close(self) -> tuple[str, int, int, int]:
        self._blocks(True)
        table = (np.array([d or 0 for d in self.doc_ids], "<i8").tobytes()
                 + np.array([d is None for d in self.doc_ids], "u1").tobytes()
                 + np.array(self.lengths, "<u8").tobytes() + np.array(self.starts, "<u8").tobytes())
        self.out.write(table)
        self.out.write(_TRAILER.pack(self.at, len(self.doc_ids), len(self.starts), self.ids,
                                     zlib.crc32(table), MAGIC))
        self.out.close()
        self.fs.move(self.part, self.path)
        return self.path, len(self.doc_ids), self.ids, self.at + len(table) + _TRAILER.size


class ShardReader:
    def __init__(self, folder: str, path: str):
        fs, _ = pafs.FileSystem.from_uri(folder)
        self.f = fs.open_input_file(path)
        size = self.f.size()
        docs_at, n, blocks, self.n_ids, crc, magic = _TRAILER.unpack(
            self.f.read_at(_TRAILER.size, size - _TRAILER.size))
        table = self.f.read_at(size - _TRAILER.size - docs_at, docs_at)
        if magic != MAGIC or zlib.crc32(table) != crc:
            raise ValueError(f"damaged token file {path}")
        ids = np.frombuffer(table, "<i8", n)
        null = np.frombuffer(table, "u1", n, 8 * n)
        self.doc_ids = [None if m else int(d) for d, m in zip(ids, null)]
        self.lengths = np.frombuffer(table, "<u8", n, 9 * n).astype(np.int64)
        self.starts = np.append(np.frombuffer(table, "<u8", blocks, 17 * n), docs_at).astype(np.int64)

    def block(self, i: int) -> np.ndarray:
        return unpack_block(self.f.read_at(int(self.starts[i + 1] - self.starts[i]), int(self.starts[i])))

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start .. stop of the shard; reads only the blocks they are in."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK_IDS, (stop - 1) // BLOCK_IDS
        got = np.concatenate([self.block(i) for i in range(first, last + 1)])
        return got[start - first * BLOCK_IDS: stop - first * BLOCK_IDS]

    def documents(self) -> Iterator[tuple[int | None, int, Iterator[np.ndarray]]]:
        """(document id, number of ids, its ids in pieces), one block in memory."""
        at, held, block = 0, -1, np.zeros(0, np.uint32)
        for doc_id, n in zip(self.doc_ids, self.lengths.tolist()):
            def pieces(at=at, n=n):
                nonlocal held, block
                while n:
                    i = at // BLOCK_IDS
                    if i != held:
                        held, block = i, self.block(i)
                    piece = block[at - i * BLOCK_IDS: at - i * BLOCK_IDS + n]
                    yield piece
                    at, n = at + len(piece), n - len(piece)
            yield doc_id, n, pieces()
            at += n


# ---- encoding -------------------------------------------------------------

class WordEncoder:
    """Encodes whole texts through a memory of words.

    Only for tokenizers whose words end at white space, as those that drop it
    and mark word ends: then a text's ids are those of its blank-separated
    pieces, one after the other.  ``tests/llm`` holds this against whole-text
    encoding."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        """Words of letters only are encoded many at a time: each is one
        pre-token, so its ids end at the one id that marks a word's end."""
        plain = [w for w in words if w.isalpha()]
        other = [w for w in words if not w.isalpha()]
        for i in range(0, len(plain), 400):
            some = plain[i:i + 400]
            ids = np.array(self.tok.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            stop = np.flatnonzero(self.ends[ids]) + 1
            if len(stop) == len(some):
                raw, a = ids.tobytes(), 0
                for w, b in zip(some, stop.tolist()):
                    self.known[w] = raw[4 * a:4 * b]
                    a = b
            else:
                other += some
        for i in range(0, len(other), 400):
            some = other[i:i + 400]
            for w, e in zip(some, self.tok.encode_batch_fast(some, add_special_tokens=False)):
                self.known[w] = np.array(e.ids, "<u4").tobytes()

    def _reduce(self, word: str) -> tuple[str, str]:
        """(word in lower case, marks behind it) where both can be encoded apart:
        in Latin-1, lower-casing and composition act on single characters, and
        a run of letters and the run of marks behind it are two pre-tokens."""
        if max(word) >= "\u0100" or "<" in word:
            return word, ""
        low = word.lower()
        core = low.rstrip(_MARKS)
        if core and core[-1].isalpha():
            return core, low[len(core):]
        return low, ""

    def encode(self, text: str) -> np.ndarray:
        known = self.known
        words = text.replace("\n", " ").split(" ")
        try:
            return np.frombuffer(b"".join(map(known.__getitem__, words)), "<u4")
        except KeyError:
            pass
        if len(known) > CACHE_WORDS:        # the words in use move over again
            self.old, self.known = known, {"": b""}
            known = self.known
        new = {}
        for w in set(words).difference(known):
            ids = self.old.get(w)
            if ids is None:
                new[w] = self._reduce(w)
            else:
                known[w] = ids
        if new:
            parts = {p for pair in new.values() for p in pair}.difference(known)
            for p in [p for p in parts if p in self.old]:
                known[p] = self.old[p]
            self._learn(list(parts.difference(known)))
            for w, (core, tail) in new.items():
                known[w] = known[core] + known[tail]
        return np.frombuffer(b"".join(map(known.__getitem__, words)), "<u4")


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> Callable[[str], np.ndarray]:
    """The worker's encoder of a vocabulary file (kept between tasks)."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path].encode


def write_token_shards(docs: DataFrame, vocabulary: str, folder: str, end_id: int, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Encode all documents and write them in ascending id order; the shards
    are the slices of one range shuffle.  Returns the manifest, one row per
    shard: shard, path, n_docs, n_tokens, n_bytes and start (ids before it)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encode, out = word_encoder(vocabulary), None
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if out is None:
                    out = ShardWriter(folder, f"shard-{shard:06d}.pfor")
                out.add(doc_id, np.concatenate([encode(text.as_py()), end]))
        if out is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(
                ("shard", "path", "n_docs", "n_tokens", "n_bytes"), (shard, *out.close())))])

    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
            .repartitionByRange(F.col("doc_id").asc_nulls_first())
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))
    shards = materialize(rows.mapInArrow(
        write, "shard long, path string, n_docs long, n_tokens long, n_bytes long"), "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)     # one row per shard
    return shards.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document from the files of a manifest: doc_id, start (ids
    of all documents before it), n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                rows = []
                for doc_id, n, pieces in ShardReader(folder, path).documents():
                    crc = 0
                    for ids in pieces:
                        crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                    rows.append((doc_id, at, n, crc))
                    at += n
                    if len(rows) == 10_000:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)

    n = max(1, manifest.count())        # a task per shard
    return (manifest.select("shard", "path", "start").repartitionByRange(n, "shard")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def _rows(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                      ["doc_id", "start", "n_tokens", "ids_crc32"])


def token_shards(docs: DataFrame, vocabulary: str, end_id: int, **cols) -> DataFrame:
    """Write, then read back: the round trip as one table."""
    folder = scratch_path(docs.sparkSession, "llm-tokens")
    return read_token_shards(write_token_shards(docs, vocabulary, folder, end_id, **cols), folder)
