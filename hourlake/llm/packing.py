"""Mixture-controlled packing of token ids into windows of fixed length by deficit round-robin.

Each source is a queue of its documents in doc_id order. The target proportion of a source is its share
of all ids, the only one that every window up to the last can keep when each id is packed once. A window
gives every source credit for its proportion of the free places; a source takes as many ids as its whole
credit covers and keeps the rest as deficit, and the source with the largest deficit fills what is left.

The stream of windows is cut into segments that run in parallel. A segment takes the same fraction of
every queue, so its bounds, its place in the stream and the deficits that it inherits follow from the
sources' totals alone; windows go on across segments without padding.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourlake.llm import tokens
from hourlake.llm.chunks import few, save, slices

LENGTH = 1024
SEGMENT_IDS = 1 << 20
MAX_SEGMENTS = 1 << 16


def tokenize(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """Written table of every document's ids: row (unique), doc_id, source, n_tokens, ids (little-endian binary)."""
    where = tokenizer or tokens.public_path()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                ids = tokens.encode_column(part.column("text"), where, end_id)
                width = tokens.id_type(where).itemsize
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("source"), pa.array([len(x) // width for x in ids], pa.int64()),
                     pa.array(ids, pa.binary())], ["doc_id", "source", "n_tokens", "ids"])

    # The source's marker keeps null apart from every name.
    source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("source")
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), source, "text") \
        .mapInArrow(run, "doc_id long, source string, n_tokens long, ids binary")
    return save(out.withColumn("row", F.monotonically_increasing_id()), "tokens")


def _queue_places(table: DataFrame) -> DataFrame:
    """row, source, n_tokens, at: each document's first place in its source's queue, by a two-level running sum."""
    def local(batches):
        part, done = TaskContext.get().partitionId(), {}
        for batch in batches:
            at = []
            for source, n in zip(batch.column("source").to_pylist(), batch.column("n_tokens").to_pylist(), strict=True):
                at.append(done.get(source, 0))
                done[source] = at[-1] + n
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("source"), batch.column("n_tokens"), pa.array(at, pa.int64()),
                 pa.array([part] * batch.num_rows, pa.int32())], ["row", "source", "n_tokens", "local", "part"])

    order = ["source", "doc_id", "row"]
    placed = save(table.select("row", "doc_id", "source", "n_tokens").repartitionByRange(*order)
                  .sortWithinPartitions(*order).select("row", "source", "n_tokens")
                  .mapInArrow(local, "row long, source string, n_tokens long, local long, part int"), "queues")
    sums = placed.groupBy("source", "part").agg(F.sum("n_tokens").alias("n"))
    before = sums.select("source", "part", (F.sum("n").over(
        Window.partitionBy("source").orderBy("part")) - F.col("n")).alias("before"))
    return placed.join(before, ["source", "part"]).select(
        "row", "source", "n_tokens", (F.col("before") + F.col("local")).alias("at"))


def round_robin(queues: list[list[tuple[int, int, int]]], shares: list[float], deficits: list[float], offset: int,
                length: int) -> list[tuple[int, int, int, int]]:
    """Deal queues of (row, start, ids) into windows, from place ``offset`` of the stream on.

    Returns (row, start, ids, place) pieces, none across a window's end. ``deficits`` are the ids that each
    source is owed at ``offset``.
    """
    out, owed, place = [], list(deficits), offset
    heads, left = [0] * len(queues), [sum(x[2] for x in q) for q in queues]
    taken = [0] * len(queues)
    rest = sum(left)

    def take(k: int, n: int) -> None:
        nonlocal place, rest
        owed[k] -= n
        left[k] -= n
        rest -= n
        while n:
            row, start, size = queues[k][heads[k]]
            m = min(n, size - taken[k])
            out.append((row, start + taken[k], m, place))
            place += m
            n -= m
            taken[k] += m
            if taken[k] == size:
                heads[k] += 1
                taken[k] = 0

    while rest:
        room = min(length - place % length, rest)
        for k, share in enumerate(shares):
            owed[k] += share * room
        for k in range(len(queues)):
            if room and left[k] and owed[k] >= 1:
                n = min(int(owed[k]), left[k], room)
                take(k, n)
                room -= n
        while room:
            k = max((k for k in range(len(queues)) if left[k]), key=lambda k: owed[k])
            n = min(room, left[k])
            take(k, n)
            room -= n
    return out


def pack(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None, end_id: int = 0,
         segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, source, text) in sequences of ``length`` ids; other columns are not read.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source, ids (little-endian unsigned
    32-bit binary). Only the last sequence is shorter than ``length``. Null and empty texts have the end id
    alone, a null source is a queue of its own, repeated rows and doc_ids are documents of their own, and an
    empty table gives no pieces.
    """
    table = tokenize(docs, tokenizer, end_id)
    width = tokens.id_type(tokenizer or tokens.public_path()).itemsize
    total = table.agg(F.sum("n_tokens")).first()[0] or 0
    segments = max(1, -(-total // max(segment_ids, -(-total // MAX_SEGMENTS))))
    places = save(_queue_places(table), "places")
    queues = places.groupBy("source").agg(F.sum("n_tokens").alias("queue"))
    # Segment g holds the places [g * queue div segments, (g + 1) * queue div segments) of a queue.
    first = F.expr(f"((at + 1) * {segments}L - 1) div queue")
    last = F.expr(f"((at + n_tokens) * {segments}L - 1) div queue")
    cut = places.join(few(queues), "source").withColumn("segment", F.explode(F.sequence(first, last)))
    lo = F.greatest("at", F.expr(f"segment * queue div {segments}L"))
    hi = F.least(F.col("at") + F.col("n_tokens"), F.expr(f"(segment + 1) * queue div {segments}L"))
    cut = cut.select("segment", "source", "queue", "row", "at", (lo - F.col("at")).alias("start"), (hi - lo).alias("n"))
    sizes = cut.groupBy("segment").agg(F.sum("n").alias("n"))
    offsets = sizes.select("segment", (F.sum("n").over(Window.orderBy("segment")) - F.col("n")).alias("place"))

    def deal(group: pa.Table) -> pa.Table:
        group = group.sort_by([("source", "ascending"), ("at", "ascending"), ("start", "ascending")])
        g, place = group.column("segment")[0].as_py(), group.column("place")[0].as_py()
        names = group.column("source").to_pylist()
        rows = list(zip(*(group.column(c).to_pylist() for c in ("row", "start", "n")), strict=True))
        begins = [i for i in range(len(names)) if not i or names[i] != names[i - 1]] + [len(names)]
        parts = [rows[a:b] for a, b in zip(begins[:-1], begins[1:], strict=True)]
        sums = [group.column("queue")[a].as_py() for a in begins[:-1]]
        owed = [s * place / total - g * s // segments for s in sums]
        here = np.array(round_robin(parts, [s / total for s in sums], owed, place, length), np.int64).reshape(-1, 4)
        here = here[np.argsort(here[:, 0], kind="stable")]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(here[:, 0])) + 1, [len(here)]]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(here[:, k])) for k in (1, 2, 3)]
        return pa.table({"row": pa.array(here[cuts[:-1], 0]), "starts": lists[0], "sizes": lists[1], "places": lists[2]})

    plan = cut.join(offsets, "segment").groupBy("segment").applyInArrow(
        deal, "row long, starts array<long>, sizes array<long>, places array<long>")

    def pieces(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                counts = pc.list_value_length(part.column("sizes")).to_numpy()
                start, size, place = (part.column(c).flatten().to_numpy() for c in ("starts", "sizes", "places"))
                owner = np.repeat(np.arange(part.num_rows), counts)
                raw = [x.as_buffer() for x in part.column("ids")]
                ids = [np.frombuffer(raw[o], f"<u{width}", n, s * width).astype("<u4").tobytes()
                       for o, s, n in zip(owner.tolist(), start.tolist(), size.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(owner)), pa.array(start), pa.array(size),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()), part.column("n_tokens").take(pa.array(owner)),
                    pa.array(place // length), pa.array(place % length), part.column("source").take(pa.array(owner)),
                    pa.array(ids, pa.binary())], names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source", "ids"]
    fields = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
              "source string, ids binary")
    out = table.join(plan, "row").select("doc_id", "n_tokens", "source", "ids", "starts", "sizes", "places")
    return out.mapInArrow(pieces, fields).withColumn("source", F.expr("if(source = '', null, substr(source, 2))"))


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences of :func:`pack`: sequence_id, ids (array of int), in place order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.concat_ws("", F.transform(parts, lambda p: F.hex(p["ids"])))
    index = F.sequence(F.lit(0), (F.length("x") / 8 - 1).cast("int"))
    ids = F.transform(index, lambda k: F.conv(F.concat(
        *[F.substr(F.col("x"), k * 8 + F.lit(7 - 2 * j), F.lit(2)) for j in range(4)]), 16, 10).cast("int"))
    return pieces.groupBy("sequence_id").agg(joined.alias("x")).select("sequence_id", ids.alias("ids"))
