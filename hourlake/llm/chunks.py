"""Chunk tables: documents packed some hundred to a row, and exchanges of hashed keys between chunks.

Many operators ask of every key of a text (a window, a shingle) whether other documents hold it too.
One Spark row per key would cost far more than the key itself, so documents are written once as
chunks, a chunk names its distinct keys in ascending order, and one shuffle by key range brings
equal keys of all chunks together. A key crosses the network once per chunk that holds it, however
many documents of the chunk share it, so the hottest key makes at most one entry per chunk. The
answer comes back as one byte per key in the same order.
"""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.session import scratch_dir

CHUNK_BYTES = 1 << 20


#: Folders that :func:`save` wrote inside :func:`collecting`.
_COLLECTED: list[list[str]] = []


@contextmanager
def collecting() -> Iterator[list[str]]:
    """The folders that :func:`save` writes inside, for :func:`clear` once nothing reads them any more."""
    folders: list[str] = []
    _COLLECTED.append(folders)
    try:
        yield folders
    finally:
        _COLLECTED.pop()


def clear(spark: SparkSession, folders: list[str]) -> None:
    """Delete scratch folders and empty the list."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    folders.clear()


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: a lineage cut that outlives executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    for folders in _COLLECTED:
        folders.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few(df: DataFrame, most: int = 10_000) -> DataFrame:
    """``df`` for the side of a join that is small as a rule, such as a row per source: broadcast if it has at
    most ``most`` rows; else Spark joins by sorting, and adaptive execution splits hot keys."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def release() -> None:
    """Give freed memory of this Python worker back to the system.

    Spark reuses a worker for the tasks of other operators, and what the allocators keep then counts against the executor beside
    what those need. Token caches are dropped too: an operator that tokenizes does not call this before its end.
    """
    if (tokens := sys.modules.get("hourlake.llm.tokens")) is not None:
        tokens.forget()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def tidy(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``function`` over the batches of a task, with :func:`release` before and behind it."""
    def run(batches):
        release()
        yield from function(batches)
        release()

    return run


def slices(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about ``limit`` bytes of text; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64
    total = np.cumsum(size)
    begin = 0
    while begin < batch.num_rows:
        done = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, done + limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def _pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(blob) -> pa.RecordBatch:
    """The rows of a chunk."""
    raw = blob.as_buffer() if hasattr(blob, "as_buffer") else blob
    return pa.ipc.open_stream(raw).read_next_batch()


def write_chunks(docs: DataFrame, text: str = "text", name: str = "chunks") -> DataFrame:
    """Write the rows of ``docs``, all columns, as chunks: ``chunk`` long, ``rows`` blob.

    The ids are random; they mean something only because the table is written before it is read.
    """
    def pack(batches):
        for batch in batches:
            parts = list(slices(batch, text))
            ids = [uuid.uuid4().int >> 65 for _ in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([_pack(p) for p in parts], pa.binary())], ["chunk", "rows"])

    return save(docs.mapInArrow(tidy(pack), "chunk long, rows binary"), name)


def entries(batch_chunk: int, keys: np.ndarray, columns: list[np.ndarray], buckets: int) -> list[tuple]:
    """Rows (bucket, chunk, n, blob) for ascending distinct ``keys`` with their columns; buckets are key ranges."""
    width = np.uint64((1 << 64) // buckets)
    at = np.minimum(keys // width, np.uint64(buckets - 1)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(at)) + 1
    begins, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
    return [(int(at[b]), batch_chunk, int(e - b), b"".join(c[b:e].tobytes() for c in (keys, *columns)))
            for b, e in zip(begins, ends, strict=True) if e > b]


ENTRY = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("n", pa.int32()), ("blob", pa.binary())])


def entry_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ENTRY, strict=True)], schema=ENTRY)


def bucket_count(chunks: DataFrame) -> int:
    """As many key ranges as keep each to a few chunks' worth of keys."""
    return max(64, chunks.count() // 4)


def exchange(asked: DataFrame, types: list[str], answer: Callable[..., np.ndarray], kind: str = "u1") -> DataFrame:
    """Bring equal keys of all chunks together and send the answers back.

    ``asked`` has the rows of :func:`entries`; ``types`` are the numpy types of the extra columns.
    ``answer(keys, holder, *columns)`` sees all entries of a key range (``holder`` tells chunks apart)
    and returns one number of type ``kind`` for each. Result: ``chunk``, ``answers`` array of (bucket, bits).
    """
    def reduce(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sizes = table.column("n").to_numpy()
        blobs = table.column("blob").to_pylist()
        parts = [[] for _ in range(1 + len(types))]
        for n, blob in zip(sizes, blobs, strict=True):
            at = 0
            for part, t in zip(parts, ["u8", *types], strict=True):
                part.append(np.frombuffer(blob, t, n, at))
                at += n * np.dtype(t).itemsize
        columns = [np.concatenate(p) for p in parts]
        bits = answer(columns[0], np.repeat(np.arange(len(sizes)), sizes), *columns[1:]).astype(kind)
        ends = np.cumsum(sizes)
        return pa.table({"bucket": table.column("bucket"), "chunk": table.column("chunk"),
                         "bits": pa.array([bits[e - n: e].tobytes() for n, e in zip(sizes, ends, strict=True)], pa.binary())})

    answered = asked.groupBy("bucket").applyInArrow(reduce, "bucket int, chunk long, bits binary")
    return answered.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers"))


def joined_bits(answers, kind: str = "u1") -> np.ndarray | None:
    """The answers of one chunk in the order of its keys; None if it asked nothing."""
    if answers is None:
        return None
    return np.frombuffer(b"".join(a["bits"] for a in sorted(answers, key=lambda a: a["bucket"])), kind)
