"""Token ids of whole texts as binary files of compressed bit or byte planes.

A file is a row of frames, each ended by a newline byte so that Spark's text writer, with its commit
protocol and on any Hadoop file system, can write it:

* ``TPC1`` block of at most ``block`` ids: u32 ids, u8 bytes per id, u8 planes, u32 length of each plane,
  then the planes. The ids are transposed, so plane k holds bit (or byte) k of every id, and each
  plane is compressed with zstandard by itself.
* ``TPD1`` documents: u32 documents, u32 length, zstandard of (i64 doc_id, u8 null, u32 tokens) columns.
* ``TPX1`` the chunk index, last: u32 frames, then u64 offset, u32 ids and u8 kind of each frame;
  its last eight bytes before the newline are its own offset.

Documents lie in ascending doc_id order (nulls first, equal ids by a hash of their text) inside a file and
from file to file. Null and empty texts have the end id alone. Other columns of the input are not read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourlake.llm import tokens
from hourlake.llm.chunks import save, slices

BLOCK = 1 << 16
DOCS_PER_FRAME = 4096
#: Text of a file; a longer text is a file of its own at most.
FILE_BYTES = 64 << 20


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """Bit planes (low bit first) or byte planes (low byte first) of a block of ids."""
    rows = np.ascontiguousarray(ids).view(np.uint8).reshape(len(ids), ids.dtype.itemsize)
    if not bits:
        return [rows[:, k].tobytes() for k in range(rows.shape[1])]
    return [np.packbits((rows[:, k // 8] >> (k % 8)) & 1).tobytes() for k in range(8 * rows.shape[1])]


def from_planes(planes: list[bytes], n: int, width: int) -> np.ndarray:
    """The ids of :func:`to_planes`."""
    rows = np.zeros((n, width), np.uint8)
    if len(planes) == width:
        for k, plane in enumerate(planes):
            rows[:, k] = np.frombuffer(plane, np.uint8)
    else:
        for k, plane in enumerate(planes):
            rows[:, k // 8] |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n) << (k % 8)
    return rows.view(f"<u{width}").ravel()


def _block_frame(ids: np.ndarray, bits: bool, level: int) -> bytes:
    pack = zstandard.ZstdCompressor(level=level)
    planes = [pack.compress(p) for p in to_planes(ids, bits)]
    head = struct.pack("<4sIBB", b"TPC1", len(ids), ids.dtype.itemsize, len(planes))
    return head + np.array([len(p) for p in planes], "<u4").tobytes() + b"".join(planes)


def _docs_frame(doc_ids: list, sizes: list[int], level: int) -> bytes:
    body = np.array([d or 0 for d in doc_ids], "<i8").tobytes() + bytes(d is None for d in doc_ids) \
        + np.array(sizes, "<u4").tobytes()
    packed = zstandard.ZstdCompressor(level=level).compress(body)
    return struct.pack("<4sII", b"TPD1", len(doc_ids), len(packed)) + packed


class _FileFrames:
    """Frames of one file, in order; holds at most a block of ids and a frame of documents."""

    def __init__(self, kind: np.dtype, bits: bool, block: int, level: int):
        self.kind, self.bits, self.block, self.level = kind, bits, block, level
        self.left, self.docs, self.sizes, self.index, self.at = b"", [], [], [], 0

    def _frame(self, frame: bytes, n: int, what: int) -> bytes:
        self.index.append((self.at, n, what))
        self.at += len(frame) + 1
        return frame

    def _blocks(self, final: bool):
        width = self.kind.itemsize
        step, at = self.block * width, 0
        while len(self.left) - at >= step or (final and at < len(self.left)):
            ids = np.frombuffer(self.left[at: at + step], self.kind)
            at += step
            yield self._frame(_block_frame(ids, self.bits, self.level), len(ids), 0)
        self.left = self.left[at:]

    def add(self, doc_ids: list, ids: list[bytes]):
        self.left += b"".join(ids)
        self.docs += doc_ids
        self.sizes += [len(x) // self.kind.itemsize for x in ids]
        yield from self._blocks(False)
        while len(self.docs) >= DOCS_PER_FRAME:
            yield self._docs_frame()

    def _docs_frame(self) -> bytes:
        n = DOCS_PER_FRAME
        frame = _docs_frame(self.docs[:n], self.sizes[:n], self.level)
        done = len(self.docs[:n])
        self.docs, self.sizes = self.docs[n:], self.sizes[n:]
        return self._frame(frame, done, 1)

    def finish(self):
        yield from self._blocks(True)
        while self.docs:
            yield self._docs_frame()
        offset, n, what = zip(*self.index, strict=True)
        yield (struct.pack("<4sI", b"TPX1", len(self.index)) + np.array(offset, "<u8").tobytes()
               + np.array(n, "<u4").tobytes() + bytes(what) + struct.pack("<Q", self.at))


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, planes: str = "byte",
                      block: int = BLOCK, level: int = 3, end_id: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Write the ids of every whole text of ``docs`` (doc_id, text), each ended by ``end_id``, to new files at ``path``.

    ``planes``: "byte" or "bit". One shuffle ranges the documents by doc_id; a task streams its range into one file, and there
    are as many ranges as ``file_bytes`` of text need each, so files stay of one size as the table grows. Rows that share a
    doc_id (or have none) are ranged by their text and by where they were read, so they need not share a file.
    """
    if planes not in ("bit", "byte"):
        raise ValueError(f"planes must be 'bit' or 'byte', not {planes!r}")
    where = tokenizer or tokens.public_path()

    def frames(batches):
        out = _FileFrames(tokens.id_type(where), planes == "bit", block, level)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = tokens.encode_column(part.column("text"), where, end_id)
                found = list(out.add(part.column("doc_id").to_pylist(), ids))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["frame"])
        if out.index or out.docs:
            yield pa.RecordBatch.from_arrays([pa.array(list(out.finish()), pa.binary())], ["frame"])

    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // file_bytes))
    order = ["doc_id", "h", "at"]
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("h", F.xxhash64("text"))
     .withColumn("at", F.monotonically_increasing_id())
     .repartitionByRange(files, *order).sortWithinPartitions(*order).drop("h", "at")
     .mapInArrow(frames, "frame binary").select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", "\n").text(path))


def read_file(raw: bytes):
    """(doc_id or None, ids) of every document of one file, through its chunk index, a block at a time."""
    index_at = struct.unpack("<Q", raw[-9:-1])[0]
    n = struct.unpack("<4sI", raw[index_at: index_at + 8])[1]
    at = index_at + 8
    offset = np.frombuffer(raw, "<u8", n, at)
    count = np.frombuffer(raw, "<u4", n, at + 8 * n)
    kind = np.frombuffer(raw, np.uint8, n, at + 12 * n)
    unpack = zstandard.ZstdDecompressor()

    def blocks():
        for o, size in zip(offset[kind == 0].tolist(), count[kind == 0].tolist(), strict=True):
            _, n_ids, width, n_planes = struct.unpack("<4sIBB", raw[o: o + 10])
            if n_ids != size:
                raise ValueError(f"the chunk index says {size} ids, the block {n_ids}")
            lengths = np.frombuffer(raw, "<u4", n_planes, o + 10).tolist()
            o += 10 + 4 * n_planes
            parts = []
            for length in lengths:
                parts.append(unpack.decompress(raw[o: o + length]))
                o += length
            yield from_planes(parts, n_ids, width)

    source, have = blocks(), np.zeros(0, "<u2")
    for o in offset[kind == 1].tolist():
        _, docs, length = struct.unpack("<4sII", raw[o: o + 12])
        body = unpack.decompress(raw[o + 12: o + 12 + length])
        ids, null = np.frombuffer(body, "<i8", docs), np.frombuffer(body, np.uint8, docs, 8 * docs)
        for doc_id, missing, size in zip(ids.tolist(), null.tolist(), np.frombuffer(body, "<u4", docs, 9 * docs).tolist(), strict=True):
            parts, need = [], size
            while need > len(have):
                parts.append(have)
                need -= len(have)
                have = next(source)
            parts.append(have[:need])
            have = have[need:]
            yield None if missing else doc_id, np.concatenate(parts) if len(parts) > 1 else parts[0]


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Rows read back from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, file.

    ``with_ids`` adds the ids as little-endian unsigned 32-bit binary. Starts come from the totals of the
    files, one row each, in file order. No files or no documents give no rows.
    """
    def rows(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                out, start, held = [], 0, 0
                for doc_id, ids in read_file(content.as_py()):
                    raw = ids.astype("<u4").tobytes()
                    out.append((name, doc_id, start, len(ids), zlib.crc32(raw), raw if with_ids else None))
                    start += len(ids)
                    held += len(raw)
                    if len(out) >= 10_000 or with_ids and held > 4 << 20:
                        yield _batch(out)
                        out, held = [], 0
                yield _batch(out)

    fields = "file string, doc_id long, local long, n_tokens long, ids_crc32 long, ids binary"
    # Empty files (an empty range) hold no frames.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")
    read = save(files.select("path", "content").mapInArrow(rows, fields), "token-rows")
    totals = read.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    # In the order of their tasks' numbers, which the names pad to five digits only.
    part = F.regexp_extract("file", "part-([0-9]+)[^/]*$", 1).cast("long")
    before = totals.select("file", (F.sum("n").over(Window.orderBy(part, "file")) - F.col("n")).alias("before"))
    out = read.join(before, "file").select(
        "doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", "file", "ids")
    return out if with_ids else out.drop("ids")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      ["file", "doc_id", "local", "n_tokens", "ids_crc32", "ids"])
