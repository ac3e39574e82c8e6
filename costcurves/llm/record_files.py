"""Operator 7: token ids in length-delimited binary record files with a separate offset index.

Texts are encoded by a tokenizers-library file, an end id follows each, and records are written in
ascending id order. A record is framed as in TFRecord files:

    length (u64) | masked CRC-32C of the length bytes (u32) | data | masked CRC-32C of the data (u32)

all little-endian, mask(c) = rotate_right(c, 15) + 0xA282EAD8. The data is the document id (i64), the
width of an id in bytes (u8) and the ids in that width. Beside each record file lies an index: one
(offset u64, length u64, ids u64) a record, so that a shuffled reader seeks to any record.

Each task writes its own new files in the shared folder and returns their manifest rows; files of lost
attempts are in no manifest row. Readers check both sums.

Defined cases: a null text reads as empty and has the end id only. Null document ids are written as the
smallest i64 and come first. Equal ids are ordered by text. A very long text is one record. An empty table writes no
file and gives an empty manifest. Only the id and text columns are read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, trimmed, whole_text
from .slice_bpe import SliceBpe, text_slices
from .word_cache import kept_by_worker

END_ID = 0
FILE_BYTES = 64 << 20
MASK_DELTA = 0xA282EAD8
NO_ID = -(1 << 63)
FRAME, FRAME_SIZE = "<QI", 12
HEAD, HEAD_SIZE = "<qB", 9
ENTRY = np.dtype([("offset", "<u8"), ("length", "<u8"), ("ids", "<u8")])
MANIFEST = "file string, records long, ids long, block int, part int"


def crc_tables(polynomial: int = 0x82F63B78) -> np.ndarray:
    """Tables for eight bytes at once, by the rule of the reflected polynomial (CRC-32C)."""
    t = np.zeros((8, 256), np.uint32)
    for i in range(256):
        c = i
        for _ in range(8):
            c = c >> 1 ^ (polynomial if c & 1 else 0)
        t[0, i] = c
    for k in range(1, 8):
        t[k] = t[k - 1] >> np.uint32(8) ^ t[0, t[k - 1] & np.uint32(255)]
    return t


CRC = crc_tables()


def past_zeros(n: int) -> np.ndarray:
    """Tables of what n zero bytes make of a sum, for each of its four bytes."""
    c = (np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)).astype(np.uint32)
    for _ in range(n):
        c = c >> np.uint32(8) ^ CRC[0, c & np.uint32(255)]
    return c


CHUNK = 1024
SHIFT = past_zeros(CHUNK)


def looked_up(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    low = tables[0, x & np.uint32(255)] ^ tables[1, x >> np.uint32(8) & np.uint32(255)]
    return low ^ tables[2, x >> np.uint32(16) & np.uint32(255)] ^ tables[3, x >> np.uint32(24)]


def crc32c(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of many byte strings of four bytes or more.

    Each is cut in chunks from its end, so that only zeros, which don't change a sum of 0, stand before its
    first byte. All chunks are summed side by side and then folded into their strings.
    """
    if not parts:
        return np.empty(0, np.uint32)
    sizes = np.array([len(p) for p in parts], np.int64)
    chunks = -(-sizes // CHUNK)
    ends = np.cumsum(chunks)
    data = np.zeros(int(ends[-1]) * CHUNK, np.uint8)
    for p, end, n in zip(parts, (ends * CHUNK).tolist(), sizes.tolist(), strict=True):
        data[end - n:end] = np.frombuffer(p, np.uint8)
    data[(ends * CHUNK - sizes)[:, None] + np.arange(4)] ^= np.uint8(255)
    words = data.view("<u4").reshape(-1, CHUNK // 4).T.copy()
    crc = np.zeros(words.shape[1], np.uint32)
    for i in range(0, CHUNK // 4, 2):
        crc = looked_up(CRC[7:3:-1], crc ^ words[i]) ^ looked_up(CRC[3::-1], words[i + 1])
    first = ends - chunks
    out = crc[first]
    for j in range(1, int(chunks.max())):
        more = np.flatnonzero(chunks > j)
        out[more] = looked_up(SHIFT, out[more]) ^ crc[first[more] + j]
    return out ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    crc = crc.astype(np.uint64)
    return ((crc >> np.uint64(15) | crc << np.uint64(17)) + np.uint64(MASK_DELTA) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def framed(data: list[bytes]) -> list[bytes]:
    lengths = [struct.pack("<Q", len(d)) for d in data]
    sums = zip(masked(crc32c(lengths)).tolist(), masked(crc32c(data)).tolist(), strict=True)
    return [n + struct.pack("<I", a) + d + struct.pack("<I", b) for n, d, (a, b) in zip(lengths, data, sums, strict=True)]


def unframed(blob: bytes) -> list[bytes]:
    """The data of consecutive records; raises where a sum does not hold."""
    at, lengths, sums, data, ends = 0, [], [], [], []
    while at < len(blob):
        n, s = struct.unpack_from(FRAME, blob, at)
        lengths.append(blob[at:at + 8])
        sums.append(s)
        if at + FRAME_SIZE + n + 4 > len(blob):
            raise ValueError("a record ends beyond its file")
        data.append(blob[at + FRAME_SIZE:at + FRAME_SIZE + n])
        ends.append(struct.unpack_from("<I", blob, at + FRAME_SIZE + n)[0])
        at += FRAME_SIZE + n + 4
    if (masked(crc32c(lengths)) != np.array(sums, np.uint32)).any() or (
            masked(crc32c(data)) != np.array(ends, np.uint32)).any():
        raise ValueError("a record's checksum does not hold")
    return data


def packed(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return struct.pack(HEAD, NO_ID if doc_id is None else doc_id, width) + ids


def unpacked(data: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, width = struct.unpack_from(HEAD, data)
    return None if doc_id == NO_ID else doc_id, np.frombuffer(data, f"<u{width}", offset=HEAD_SIZE).astype("<u4")


class RecordWriter:
    """One record file and its index."""

    def __init__(self, folder: str, name: str):
        self.files, path = fs.FileSystem.from_uri(folder)
        self.files.create_dir(path)
        self.name, self.entries, self.at = f"{folder}/{name}", [], 0
        self.path = f"{path}/{name}"
        self.out = self.files.open_output_stream(self.path)

    def write(self, records: list[bytes], ids: list[int]) -> None:
        for r, n in zip(framed(records), ids, strict=True):
            self.entries.append((self.at, len(r), n))
            self.at += len(r)
            self.out.write(r)

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        index = np.array(self.entries, ENTRY)
        with self.files.open_output_stream(self.path + ".index") as out:
            out.write(index.tobytes())
        return self.name, len(index), int(index["ids"].sum())


def read_index(file: str) -> np.ndarray:
    files, path = fs.FileSystem.from_uri(file + ".index")
    with files.open_input_stream(path) as f:
        return np.frombuffer(f.read(), ENTRY)


def read_records(file: str, picks: list[int] | None = None, at_once: int = 8 << 20) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of the records with these numbers, in this order; of all records if None."""
    files, path = fs.FileSystem.from_uri(file)
    index = read_index(file)
    with files.open_input_file(path) as f:
        if picks is not None:
            for i in picks:
                blob = f.read_at(int(index[i]["length"]), int(index[i]["offset"]))
                yield from map(unpacked, unframed(blob))
            return
        i = 0
        while i < len(index):
            j = max(i + 1, int(np.searchsorted(index["offset"], int(index[i]["offset"]) + at_once)))
            size = int(index["length"][i:j].sum())
            yield from map(unpacked, unframed(f.read_at(size, int(index[i]["offset"]))))
            i = j


def write_records(docs: DataFrame, tokenizer: str, folder: str, blocks: int, id_col: str = "doc_id",
                  text_col: str = "text", file_bytes: int = FILE_BYTES, added: bool = False) -> DataFrame:
    """Write all documents to ``folder`` and return the manifest, stored: one row a file, with its first id's place.

    ``added``: as in ``SliceBpe``.

    Columns: file, block, part (files are in order of block and part), records, ids, start.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    # Ranges of ids are the blocks, one a partition: they follow the data, and no bounds reach the plan.
    rows = rows.repartitionByRange(blocks, F.col("doc_id").asc_nulls_first())
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text").withColumn("block", F.spark_partition_id())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, found = kept_by_worker(("bpe", tokenizer, added), lambda: SliceBpe(tokenizer, added)), []
        writer, part = None, 0
        for rows in text_slices(batches, 1):
            encoded = coder.records(rows.column(1), END_ID)
            block = rows.column(2)[0].as_py()
            packs = [packed(i, ids, coder.width) for i, ids in zip(rows.column(0).to_pylist(), encoded, strict=True)]
            if writer is None:
                writer = RecordWriter(folder, f"{block:08d}-{part:06d}-{uuid.uuid4().hex}.records")
            writer.write(packs, [len(ids) // coder.width for ids in encoded])
            if writer.at >= file_bytes:
                found.append((*writer.close(), block, part))
                writer, part = None, part + 1
        if writer is not None:
            found.append((*writer.close(), block, part))
        if found:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)],
                                             names=["file", "records", "ids", "block", "part"])

    manifest = stored(rows.mapInArrow(trimmed(write, ("bpe", tokenizer, added)), MANIFEST), "record-manifest")
    # One row a file of up to FILE_BYTES.
    before = Window.orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_back(manifest: DataFrame, partitions: int) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, file, record) of every record, from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                start, out = row["start"], []
                for k, (doc_id, ids) in enumerate(read_records(row["file"])):
                    out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), row["file"], k))
                    start += len(ids)
                names = ["doc_id", "start", "n_tokens", "ids_crc32", "file", "record"]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    files = manifest.select("file", "start").repartition(partitions, "file")
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, file string, record long")
