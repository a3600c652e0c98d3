"""Line deduplication by sorted hash ranges, returned as keep bitmaps.

A line's key is the line without blanks at both ends, A-Z folded.  A key of
``min_chars`` code points or more that several documents hold keeps its lines
in the document with the smallest id only.

1.  Each batch of documents turns its lines into 128-bit key hashes and is
    its own first reader: of a key's documents in the batch only the smallest
    goes on, with the places of its lines; the lines of the others are
    repeats already.  So a key, however frequent, gets one row from a batch.
2.  These rows are partitioned by equal ranges of the hash (hashes are
    uniform, so the ranges need no sample) and sorted inside by (hash,
    document, place).  A task streams its rows once, remembers the document
    that opened the current hash, and reports the places of all later ones.
3.  The reported places are gathered by document into a bitmap of its lines,
    compressed.  No text takes part in any shuffle up to here; ``kept_text``
    joins bitmaps and texts where the remaining text itself is wanted.

Defined cases: a null or empty text is one empty line; a null id is smaller
than all others; rows of one id are one document for the rule, and each has
its own bitmap (told apart by a hash of the text); a key several times in its
smallest document stays there each time; an empty table gives no rows;
clashing columns of the input are replaced.
"""

from __future__ import annotations

import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

#: Text bytes that a hash range stands for, about.
RANGE_TEXT_BYTES = 32 << 20
_ROWS = "range int, high long, low long, doc long, version long, place int, places binary, repeat boolean"
_GONE = "doc long, version long, places binary"


def pack_bits(keep: np.ndarray) -> bytes:
    """A compressed bitmap: bit i (lowest first in each byte) is line i."""
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 1)


def unpack_bits(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(raw), np.uint8), count=n, bitorder="little").astype(bool)


def line_keys(text: bytes, min_chars: int) -> dict[bytes, list[int]]:
    """Places of each key's lines, by the key's hash."""
    out: dict[bytes, list[int]] = {}
    digest = xxhash.xxh3_128_digest
    # bytes.lower and bytes.strip know ASCII only: A-Z, and the blanks 20 and 09 to 0D
    for i, line in enumerate(text.lower().split(b"\n")):
        key = line.strip()
        # a code point has 1 to 4 bytes, so only some lengths need the exact count
        if len(key) >= min_chars and (len(key) >= 4 * min_chars or key.isascii()
                                      or len(key.decode("utf-8", "replace")) >= min_chars):
            out.setdefault(digest(key), []).append(i)
    return out


def _places(lists: list[list[int]]) -> list[bytes]:
    return [np.asarray(x, "<u4").tobytes() for x in lists]


def _scan(ranges: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column(0).to_numpy()
            version = batch.column(1).to_numpy()
            text = batch.column(2).cast(pa.large_binary())
            key, row, places = [], [], []
            for r in range(batch.num_rows):
                found = line_keys(text[r].as_py(), min_chars)
                key += found.keys()
                row += [r] * len(found)
                places += found.values()
            if not key:
                continue
            raw = np.frombuffer(b"".join(key), ">u8").reshape(-1, 2).astype(np.uint64)
            row = np.array(row)
            order = np.lexsort((doc[row], raw[:, 1], raw[:, 0]))
            raw, row = raw[order], row[order]
            new = np.ones(len(raw), bool)
            new[1:] = (raw[1:] != raw[:-1]).any(axis=1)
            opener = doc[row][np.flatnonzero(new)][np.cumsum(new) - 1]
            repeat = doc[row] > opener
            first = np.flatnonzero(~repeat)
            # equal shares of the hash space: the high 32 bits times the number of ranges
            at = ((raw[first, 0] >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
            gone: dict[int, list[int]] = {}
            for i in np.flatnonzero(repeat).tolist():
                gone.setdefault(int(row[i]), []).extend(places[order[i]])
            done = np.array(list(gone), np.int64)
            who = np.concatenate([row[first], done]).astype(np.int64)
            zero = np.zeros(len(done), np.int64)
            lists = [places[order[i]] for i in first.tolist()] + list(gone.values())
            yield pa.RecordBatch.from_arrays([
                # settled rows stay anywhere: dealt by document
                pa.array(np.concatenate([at, (version[done] % ranges).astype(np.int32)]), pa.int32()),
                pa.array(np.concatenate([raw[first, 0].view(np.int64), zero])),
                pa.array(np.concatenate([raw[first, 1].view(np.int64), zero])),
                pa.array(doc[who]), pa.array(version[who]),
                pa.array([x[0] for x in lists], pa.int32()), pa.array(_places(lists), pa.binary()),
                pa.array(np.concatenate([np.zeros(len(first), bool), np.ones(len(done), bool)])),
            ], ["range", "high", "low", "doc", "version", "place", "places", "repeat"])
    return run


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (hash, document, place): whatever follows the document
    that opened a hash is a repeat."""
    last, opener = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        high, low, doc = (batch.column(i).to_numpy() for i in (1, 2, 3))
        settled = batch.column(7).to_numpy(zero_copy_only=False)
        new = np.ones(len(doc), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1]) | (settled[1:] != settled[:-1])
        if last == (high[0], low[0], settled[0]):
            new[0] = False
        # group 0 is the hash carried over from the batch before
        openers = np.concatenate(([opener], doc[new]))
        group = np.cumsum(new)
        drop = settled | (doc > openers[group])
        last, opener = (high[-1], low[-1], settled[-1]), openers[group[-1]]
        if drop.any():
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(drop)) for c in (batch.column(3), batch.column(4), batch.column(6))],
                ["doc", "version", "places"])


def _known(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Add __doc, __version (which tells the texts of one id apart) and __text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select("*", F.coalesce(F.col(id_col).cast("long"), F.lit(-2 ** 63).cast("long")).alias("__doc"),
                       F.xxhash64(text).alias("__version"), text.alias("__text"))


def repeated_lines(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text"
                   ) -> DataFrame:
    """The documents that lose lines: doc (null id: the smallest long), version
    (xxhash64 of the text), gone (binaries of 32-bit line numbers)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_TEXT_BYTES))
    rows = (_known(docs.select(id_col, text_col), id_col, text_col).select("__doc", "__version", "__text")
            .mapInArrow(_scan(ranges, min_chars), _ROWS))
    ordered = (rows.repartitionById(ranges, F.col("range"))
               .sortWithinPartitions("repeat", "high", "low", "doc", "place"))
    return ordered.mapInArrow(_stream, _GONE).groupBy("doc", "version").agg(F.collect_list("places").alias("gone"))


def dedup_lines(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text",
                columns: list[str] | None = None, with_text: bool = False) -> DataFrame:
    """The ``columns`` of ``docs`` (all by default) with n_lines, n_dropped,
    keep (compressed bitmap of the lines, see ``unpack_bits``; null: all stay)
    and, ``with_text``, kept_text: the lines that stay, joined by line feeds."""
    own = ["n_lines", "n_dropped", "keep"] + (["kept_text"] if with_text else [])
    columns = [c for c in (docs.columns if columns is None else columns) if c not in own]
    gone = repeated_lines(docs, min_chars, id_col, text_col)
    base = _known(docs, id_col, text_col).withColumn(
        "__lines", F.octet_length("__text") - F.octet_length(F.replace("__text", F.lit("\n"), F.lit(""))) + 1)
    # without the text asked for, none is shuffled
    carried = base.select(*columns, "__doc", "__version", F.col("__lines").cast("long").alias("__lines"),
                          *(["__text"] if with_text else []))
    joined = carried.join(gone, (F.col("__doc") == gone.doc) & (F.col("__version") == gone.version), "left")

    def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines = batch.column("__lines").to_numpy()
            dropped = np.zeros(batch.num_rows, np.int64)
            keeps: list[bytes | None] = [None] * batch.num_rows
            places = batch.column("gone")
            hit = np.flatnonzero(places.is_valid().to_numpy(zero_copy_only=False))
            texts = batch.column("__text").cast(pa.large_string()) if with_text else None
            kept = {}
            for r in hit.tolist():
                keep = np.ones(n_lines[r], bool)
                keep[np.frombuffer(b"".join(places[r].as_py()), "<u4")] = False
                dropped[r] = len(keep) - np.count_nonzero(keep)
                keeps[r] = pack_bits(keep)
                if with_text:
                    lines = texts[r].as_py().split("\n")
                    kept[r] = "\n".join([lines[i] for i in np.flatnonzero(keep).tolist()])
            out = [*(batch.column(c) for c in columns), pa.array(n_lines), pa.array(dropped),
                   pa.array(keeps, pa.binary())]
            if with_text:
                out.append(texts if not kept else pa.array(
                    [kept[r] if r in kept else texts[r].as_py() for r in range(batch.num_rows)], pa.large_string()))
                out[-1] = out[-1].cast(pa.string())
            yield pa.RecordBatch.from_arrays(out, [*columns, *own])

    schema = T.StructType([carried.schema[c] for c in columns] + [
        T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
        T.StructField("keep", T.BinaryType())] + ([T.StructField("kept_text", T.StringType())] if with_text else []))
    return joined.mapInArrow(bitmaps, schema)
