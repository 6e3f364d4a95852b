"""Join of documents whose sets of word n-grams are alike: Jaccard similarity at or above a threshold, exactly.

Equal sets are one class, and classes are compared. Of two sets that are alike enough, both hold a common
n-gram among the few that come first in a common order, so classes meet in the tiles of their first n-grams.
The order is by hash, with n-grams that very many documents hold at the end: a passage that everybody quotes
makes no tile, unless a document consists of little else.

In a tile, classes go by size and meet only others in the band that the threshold leaves them. A class has a
bitmap of one bit or two per n-gram, the parity of the n-grams hashed to each bit; the bits in which two maps
differ are a lower bound of the n-grams that the sets differ in, hence an upper bound of their overlap.
What passes is decided by intersecting the sorted arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.llm import words as W
from hourlake.llm.chunks import bucket_count, entries, entry_batch, exchange, joined_bits, save, tidy, unpack, write_chunks
from hourlake.llm.components import components
from hourlake.llm.quality_lines import span_hashes

SHINGLE = 5
PERCENT = 75
#: N-grams go last in the order if at least so many documents hold them, and more than 1 in 2**20 of all.
COMMON_DOCS = 32
TILE_ROWS = 2048


def shingle_sets(column: pa.Array, length: int = SHINGLE) -> list[np.ndarray]:
    """Each text's distinct n-gram hashes, ascending; fewer words than ``length`` are one n-gram, none an empty set."""
    w = W.split_words(column, lower=True)
    h = W.word_hashes(w)
    grams = W.window_hashes(h, length)
    short = span_hashes(h, w.first[:-1], w.first[1:])
    out = []
    for k, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
        out.append(np.unique(grams[a: b - length + 1]) if b - a >= length else short[k: k + (b > a)].copy())
    return out


def class_key(grams: np.ndarray) -> int:
    """64-bit name of a set."""
    m = W.mix(grams ^ np.uint64(0x9FB21C651E98DF25))
    return int(W.pair(m.sum(dtype=np.uint64, keepdims=True), np.bitwise_xor.reduce(m, keepdims=True))
               .view(np.int64)[0])


def bitmap(grams: np.ndarray) -> bytes:
    """Parity bitmap with the least power of two of at least 64 and as many bits as n-grams."""
    size = max(64, 1 << (len(grams) - 1).bit_length())
    at = (grams >> np.uint64(20)) & np.uint64(size - 1)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=size) & 1).astype(np.uint8)).tobytes()


def first_grams(grams: np.ndarray, common: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The n-grams of which a set that is alike must hold one among its own: common ones last, then by hash."""
    n = len(grams) - -(-percent * len(grams) // 100) + 1
    if not len(common):
        return grams[:n]
    late = common[np.minimum(np.searchsorted(common, grams), len(common) - 1)] == grams
    return np.concatenate([grams[~late], grams[late]])[:n]


def alike(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether 100 * intersection >= percent * union of two ascending arrays."""
    if len(a) > len(b):
        a, b = b, a
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum()) if len(a) else 0
    return bool(len(a)) and 100 * both >= percent * (len(a) + len(b) - both)


_ROWS = ("doc_id long, sig long, n long, class long, bits binary, chunk long, at int, grams array<long>, held array<int>")


def _describe(chunks: DataFrame, length: int) -> DataFrame:
    """A row per document; the first of a chunk also counts the n-grams that several sets of the chunk hold."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows = unpack(batch.column("rows")[i])
                sets = shingle_sets(rows.column("text"), length)
                keys = [class_key(s) if len(s) else None for s in sets]
                one = {k: s for k, s in zip(keys, sets, strict=True) if k is not None}
                grams, count = np.unique(np.concatenate([*one.values(), np.zeros(0, np.uint64)]), return_counts=True)
                n = rows.num_rows
                lists = [[x[count > 1].tolist()] + [None] * (n - 1) for x in (grams.view(np.int64), count)]
                yield pa.RecordBatch.from_arrays([
                    rows.column("_id"), rows.column("_sig"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(keys, pa.int64()),
                    pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([batch.column("chunk")[i].as_py()] * n, pa.int64()), pa.array(np.arange(n), pa.int32()),
                    pa.array(lists[0], pa.list_(pa.int64())), pa.array(lists[1], pa.list_(pa.int32()))],
                    ["doc_id", "sig", "n", "class", "bits", "chunk", "at", "grams", "held"])

    return save(chunks.mapInArrow(tidy(run), _ROWS), "sets")


def _common(rows: DataFrame) -> np.ndarray:
    """Ascending n-grams to order last. Each is counted at least as often as the threshold, a millionth of all
    n-grams, so there are at most 2**20 of them however large the input."""
    total = rows.agg(F.sum("n")).first()[0] or 0
    least = max(COMMON_DOCS, total >> 20)
    found = (rows.where("grams is not null").select(F.explode(F.arrays_zip("grams", "held")).alias("g"))
             .groupBy("g.grams").agg(F.sum("g.held").alias("n")).where(F.col("n") >= least).select("grams"))
    return np.sort(np.array([r[0] for r in found.collect()], np.int64).view(np.uint64))


class _Firsts:
    """Distinct sets of a chunk with their first n-grams, and the distinct first n-grams of all."""

    def __init__(self, rows: pa.RecordBatch, length: int, common: np.ndarray, percent: int):
        one = {class_key(s): s for s in shingle_sets(rows.column("text"), length) if len(s)}
        self.keys = np.array(list(one), np.int64)
        self.sizes = np.array([len(s) for s in one.values()], np.int64)
        firsts = [first_grams(s, common, percent) for s in one.values()]
        self.owner = np.repeat(np.arange(len(firsts)), [len(f) for f in firsts]).astype(np.int64)
        # First n-grams have small hashes; scrambled, they spread evenly over the key ranges.
        grams = W.mix(np.concatenate([*firsts, np.zeros(0, np.uint64)]))
        self.grams, self.begin, self.which, self.count = np.unique(
            grams, return_index=True, return_inverse=True, return_counts=True)


def _shared(keys: np.ndarray, holder: np.ndarray, owner: np.ndarray, many: np.ndarray) -> np.ndarray:
    """For each entry whether two classes hold its n-gram."""
    order = np.argsort(keys, kind="stable")
    k, o = keys[order], owner[order]
    begin = np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1])
    hit = (np.minimum.reduceat(o, begin) != np.maximum.reduceat(o, begin)) | (np.maximum.reduceat(many[order], begin) > 0)
    out = np.zeros(len(keys), np.uint8)
    out[order] = np.repeat(hit, np.diff(np.append(begin, len(k))))
    return out


def _meetings(chunks: DataFrame, common: np.ndarray, length: int, percent: int) -> DataFrame:
    """(gram, class, n): the first n-grams that two classes or more have among theirs."""
    shared, buckets = chunks.sparkSession.sparkContext.broadcast(common), bucket_count(chunks)

    def ask(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                f = _Firsts(unpack(batch.column("rows")[i]), length, shared.value, percent)
                if len(f.grams):
                    columns = [f.keys[f.owner[f.begin]], (f.count > 1).astype(np.uint8)]
                    yield entry_batch(entries(batch.column("chunk")[i].as_py(), f.grams, columns, buckets))

    def tell(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                f = _Firsts(unpack(batch.column("rows")[i]), length, shared.value, percent)
                hit = joined_bits(batch.column("answers")[i].as_py())[f.which] > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f.grams[f.which][hit].view(np.int64)), pa.array(f.keys[f.owner[hit]]),
                     pa.array(f.sizes[f.owner[hit]])], ["gram", "class", "n"])

    known = exchange(chunks.mapInArrow(tidy(ask), "bucket int, chunk long, n int, blob binary"), ["i8", "u1"], _shared)
    return save(chunks.join(known, "chunk").mapInArrow(tidy(tell), "gram long, class long, n long"), "meetings")


def _decide(pairs: DataFrame, rows: DataFrame, chunks: DataFrame, length: int, percent: int) -> DataFrame:
    """The class pairs (a, b) whose sets are alike. The sets are made anew from one document of each class."""
    pairs = save(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("class")).unionAll(pairs.select(F.col("b").alias("class"))).distinct()
    places = rows.where("class is not null").groupBy("class").agg(F.min("chunk").alias("chunk")).join(wanted, "class")
    places = places.groupBy("chunk").agg(F.collect_list("class").alias("classes"))

    def make(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                classes = set(batch.column("classes")[i].as_py())
                sets = {class_key(s): s for s in shingle_sets(unpack(batch.column("rows")[i]).column("text"), length) if len(s)}
                found = [(k, s.tobytes()) for k, s in sets.items() if k in classes]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in found], pa.int64()), pa.array([s for _, s in found], pa.binary())], ["class", "grams"])

    sets = save(chunks.join(places, "chunk").mapInArrow(tidy(make), "class long, grams binary"), "arrays")
    left = sets.select(F.col("class").alias("a"), F.col("grams").alias("x"))
    right = sets.select(F.col("class").alias("b"), F.col("grams").alias("y"))

    def check(batches):
        for batch in batches:
            ok = [alike(*(np.frombuffer(v.as_buffer(), np.uint64) for v in xy), percent)
                  for xy in zip(batch.column("x"), batch.column("y"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return save(pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(tidy(check), "a long, b long"), "alike")


def _whole_groups(batches, keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of sorted rows with equal keys, and where each group begins and the last ends."""
    held: pa.Table | None = None

    def cuts(table: pa.Table) -> np.ndarray:
        columns = [table.column(k).to_numpy() for k in keys]
        return np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
        at = cuts(table)
        if len(at):
            yield table.slice(0, at[-1]), np.concatenate([[0], at])
            held = table.slice(at[-1])
        else:
            held = table
    if held is not None and held.num_rows:
        yield held.combine_chunks(), np.array([0, held.num_rows])


class Bitmaps:
    """Parity bitmaps of many sets as 64-bit words behind each other; row r is words[begin[r]: begin[r] + size[r]]."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
        raw = column.buffers()[2]
        self.words = np.frombuffer(raw, np.uint64, raw.size // 8) if raw is not None else np.zeros(0, np.uint64)
        self.begin, self.size = offsets[:-1] // 8, np.diff(offsets) // 8

    def rows(self, at: np.ndarray, size: int) -> np.ndarray:
        """The bitmaps of rows that have ``size`` words, or twice as many: those with their halves laid over
        each other, which is the bitmap that the set has at the smaller size."""
        out = self.words[self.begin[at][:, None] + np.arange(size)]
        large = np.flatnonzero(self.size[at] > size)
        if len(large):
            out[large] ^= self.words[(self.begin[at[large]] + size)[:, None] + np.arange(size)]
        return out


def _passes(n: np.ndarray, m: np.ndarray, apart: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of n and m, that differ in ``apart`` elements at least, may be alike."""
    return (100 + percent) * ((n + m - apart) // 2) >= percent * (n + m)


def couples(n: np.ndarray, part: np.ndarray, maps: Bitmaps, first: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Those of ``first`` whose row and the next one are of different parts and may be alike."""
    small = first + (n[first] > n[first + 1])
    large = 2 * first + 1 - small
    ok = (part[first] != part[first + 1]) & (100 * n[small] >= percent * n[large])
    out = []
    for size in np.unique(maps.size[small[ok]]).tolist():
        at = np.flatnonzero(ok & (maps.size[small] == size))
        for k in range(0, len(at), max(1, (1 << 20) // size)):
            some = at[k: k + max(1, (1 << 20) // size)]
            a, b = small[some], large[some]
            apart = np.bitwise_count(maps.rows(a, size) ^ maps.rows(b, size)).sum(axis=1, dtype=np.int64)
            out.append(first[some[_passes(n[a], n[b], apart, percent)]])
    return np.concatenate([*out, np.zeros(0, np.int64)])


def tile_pairs(n: np.ndarray, part: np.ndarray, maps: Bitmaps, rows: np.ndarray, side: np.ndarray, crossing: bool,
               percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``rows`` of different parts whose sizes and bitmaps leave the similarity possible.

    Rows go by size, a block at a time against the band of sizes that any of the block may be alike to.
    ``crossing``: only pairs of different sides.
    """
    rows = rows[np.argsort(n[rows], kind="stable")]
    size_of, last = maps.size[rows], np.searchsorted(n[rows], n[rows] * 100 // percent, side="right")
    left, right = [], []
    begin = 0
    while begin < len(rows):
        words = int(size_of[begin])
        # Rows of one bitmap size, so many that the block's table of words stays at some megabytes.
        band = int(last[begin]) - begin
        end = min(int(np.searchsorted(size_of, words, side="right")), begin + max(1, (1 << 19) // (words * max(1, band))))
        stop = int(last[end - 1])
        i, j = np.arange(begin, end), np.arange(begin + 1, stop)
        a, b = rows[i], rows[j]
        ok = (j[None] > i[:, None]) & (j[None] < last[i][:, None]) & (part[a][:, None] != part[b][None])
        if crossing:
            ok &= side[a][:, None] != side[b][None]
        x, y = np.nonzero(ok)
        if len(x):
            own, other = maps.rows(a, words), maps.rows(b, words)
            for k in range(0, len(x), max(1, (1 << 20) // words)):
                xs, ys = x[k: k + max(1, (1 << 20) // words)], y[k: k + max(1, (1 << 20) // words)]
                apart = np.bitwise_count(own[xs] ^ other[ys]).sum(axis=1, dtype=np.int64)
                hit = _passes(n[a[xs]], n[b[ys]], apart, percent)
                left.append(a[xs[hit]])
                right.append(b[ys[hit]])
        begin = end
    return np.concatenate([*left, np.zeros(0, np.int64)]), np.concatenate([*right, np.zeros(0, np.int64)])


def _candidates(meetings: DataFrame, parts: DataFrame | None, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct class pairs (a < b) of different parts that meet in a tile and pass its bounds.

    A tile of more than TILE_ROWS classes is split into blocks, and every two blocks meet in a group of their own. Tiles
    report the partners of a class in one row.
    """
    met = meetings.select("gram", "class").distinct()
    if parts is None:
        met = met.withColumn("part", F.col("class"))
    else:
        met = met.join(parts, "class", "left").select("gram", "class", F.coalesce("part", "class").alias("part"))
    met = save(met, "met")
    mixed = met.groupBy("gram").agg(F.count("*").alias("rows"), F.min("part").alias("lo"), F.max("part").alias("hi")) \
        .where("lo <> hi").select("gram", F.ceil(F.col("rows") / TILE_ROWS).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    tiles = met.join(mixed, "gram").withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.select("gram", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
                         "block", "class", "part").join(classes, "class")

    def run(batches):
        for table, cuts in _whole_groups(batches, ["gram", "p", "q"]):
            n, part, side, p, q, names = (table.column(c).to_numpy() for c in ("n", "part", "block", "p", "q", "class"))
            maps = Bitmaps(table.column("bits").chunk(0))
            size = np.diff(cuts)
            # Two rows with different blocks in a tile of two blocks, or any two in a tile of one.
            two = cuts[:-1][size == 2]
            two = couples(n, part, maps, two[(p[two] == q[two]) | (side[two] != side[two + 1])], percent)
            left, right = [two], [two + 1]
            for begin, end in zip(cuts[:-1][size > 2].tolist(), cuts[1:][size > 2].tolist(), strict=True):
                a, b = tile_pairs(n, part, maps, np.arange(begin, end), side, p[begin] != q[begin], percent)
                left.append(a)
                right.append(b)
            x, y = names[np.concatenate(left)], names[np.concatenate(right)]
            a, b = np.minimum(x, y), np.maximum(x, y)
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = np.concatenate([np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            a, b = a[new], b[new]
            if len(a):
                begins = np.concatenate([[0], np.flatnonzero(a[1:] != a[:-1]) + 1])
                ends = np.append(begins, len(a)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(a[begins]), pa.ListArray.from_arrays(pa.array(ends), pa.array(b))], ["a", "bs"])

    keys = ["gram", "p", "q"]
    met = tiles.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tidy(run), "a long, bs array<long>")
    # A pair that met in many tiles is one.
    return met.groupBy("a").agg(F.array_distinct(F.flatten(F.collect_list("bs"))).alias("bs")).select("a", F.explode("bs").alias("b"))


def _prepared(docs: DataFrame, length: int, percent: int, columns: tuple[str, ...] = ("text",)):
    # A hash of the whole row decides between rows of one doc_id, so reruns agree.
    sig = F.xxhash64(*[c for c, kind in docs.dtypes if c in ("text", *columns) and "map<" not in kind])
    chunks = write_chunks(docs.select(*columns, F.col("doc_id").cast("long").alias("_id"), sig.alias("_sig")))
    rows = _describe(chunks, length)
    meetings = _meetings(chunks, _common(rows), length, percent)
    classes = rows.where("class is not null").select("class", "n", "bits").dropDuplicates(["class"])
    return chunks, rows, meetings, classes


def links(docs: DataFrame, length: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """All links, as pairs (a, b) of classes, and the membership (doc_id, n_shingles, class); class is null for empty sets."""
    chunks, rows, meetings, classes = _prepared(docs, length, percent)
    found = _decide(_candidates(meetings, None, classes, percent), rows, chunks, length, percent)
    return found, rows.select("doc_id", F.col("n").alias("n_shingles"), "class")


def _joined(prepared, length: int, percent: int) -> DataFrame:
    """Written table (class, least, group): the least doc_id of each class, and the least class that it is linked with."""
    chunks, rows, meetings, classes = prepared
    center = meetings.groupBy("gram").agg(F.min("class").alias("a"))
    star = meetings.join(center, "gram").where("class <> a").select("a", F.col("class").alias("b"), "n").distinct()
    sizes = classes.select(F.col("class").alias("a"), F.col("n").alias("m"), F.col("bits").alias("x"))
    near = star.join(sizes, "a").where((F.col("n") * 100 >= F.col("m") * percent) & (F.col("m") * 100 >= F.col("n") * percent))
    near = near.join(classes.select(F.col("class").alias("b"), F.col("bits").alias("y")), "b")

    def bound(batches):
        for batch in batches:
            # The two of a pair as neighbours.
            both = pa.concat_arrays([batch.column("x"), batch.column("y")])
            order = np.arange(2 * batch.num_rows).reshape(2, -1).T.ravel()
            n = np.concatenate([batch.column("m").to_numpy(), batch.column("n").to_numpy()])[order]
            first = np.arange(0, len(order), 2)
            hit = couples(n, np.arange(len(order)), Bitmaps(both.take(pa.array(order))), first, percent) // 2
            yield batch.select(["a", "b"]).take(pa.array(hit))

    first = _decide(near.select("a", "b", "n", "m", "x", "y").mapInArrow(tidy(bound), "a long, b long"), rows, chunks, length, percent)
    parts = save(components(first).select(F.col("node").alias("class"), F.col("component").alias("part")), "parts")
    rest = _decide(_candidates(meetings, parts, classes, percent), rows, chunks, length, percent)
    joined = components(parts.where("class <> part").select(F.col("class").alias("a"), F.col("part").alias("b"))
                        .unionByName(rest)).select(F.col("node").alias("class"), F.col("component").alias("group"))
    ids = rows.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least")) \
        .join(joined, "class", "left").select("class", "least", F.coalesce("group", "class").alias("group"))
    return save(ids, "groups")


def groups(docs: DataFrame, length: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document (doc_id, text); other columns are not read.

    First every class is compared with the least class of each of its tiles, and what is alike is joined.
    Then tiles look for links between classes not joined yet, so a large group of copies is not compared pair
    by pair, and no link that matters is lost. Null and empty texts have an empty set and are linked with nothing;
    rows with the same doc_id are one document for component_id; null doc_ids are no component's least, so a
    group of them alone has a null component_id. An empty table gives no rows.
    """
    prepared = _prepared(docs, length, percent)
    rows, ids = prepared[1], _joined(prepared, length, percent)
    named = ids.join(ids.groupBy("group").agg(F.min("least").alias("component_id")), "group").select("class", "component_id")
    return rows.join(named, "class", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(
            F.col("component_id")).alias("component_id"))


def firsts(docs: DataFrame, length: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The first row of every group of linked texts, all columns of ``docs`` (doc_id, text, any others).

    A group is one of texts, whatever their doc_ids: rows that share a doc_id, or have none, stay if their texts
    are in different groups. First is the least doc_id, nulls last, then the least hash of the row. Rows whose set
    is empty are linked with nothing and all stay.
    """
    prepared = _prepared(docs, length, percent, tuple(docs.columns))
    chunks, rows = prepared[:2]
    ids = _joined(prepared, length, percent)
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sig", "chunk", "at").alias("key")
    best = rows.where("class is not null").groupBy("class").agg(F.min(key).alias("key")).join(ids, "class")
    best = best.groupBy("group").agg(F.min("key").alias("key")).select("key.chunk", "key.at")
    kept = best.unionByName(rows.where("class is null").select("chunk", "at")).groupBy("chunk").agg(
        F.sort_array(F.collect_list("at")).alias("kept"))
    names = docs.columns

    def run(batches):
        for batch in batches:
            for blob, at in zip(batch.column("rows"), batch.column("kept"), strict=True):
                yield unpack(blob).select(names).take(at.values)

    return chunks.join(kept, "chunk").select("rows", "kept").mapInArrow(tidy(run), docs.schema)
