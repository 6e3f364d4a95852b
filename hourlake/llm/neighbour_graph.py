"""Nearest neighbours by cosine: a neighbour graph built by NN-descent, searched greedily.

Equal vectors are one node. Nodes are numbered so that likely neighbours stand together and cut into blocks; a node
starts with its nearest of a window and some random nodes. In a round of NN-descent every node compares its
neighbours, forward and reverse, with each other: the neighbours of neighbours. As Spark jobs: reverse edges go to the
block of the node they end at; blocks ask the home blocks of their members for vectors, each member once per block;
pairs better than what a node has go to that node's block, which merges them into its list. A search keeps a pool of
the nearest nodes seen for each query, and a round expands the nearest unexpanded ones at the graph's blocks, until
a pool holds none. The descent and the search use int8 vectors; the pools are then scored in double precision.

Approximate by nature: lists are of bounded length, reverse edges beyond the nearest are left out. All bounds are
parameters; every node is in the graph, whatever its degree or the number of its copies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from hourlake.llm.chunks import few, save
from hourlake.llm.order import numbered

BLOCK = 4096
#: Nodes of a block of the search graph, which carries its neighbours' vectors.
SUB = 512
WINDOW = 512
#: Neighbours of a node, random ones among the first, reverse ones that a round and the search use.
NEIGHBOURS, RANDOM, REVERSE, SEARCH_REVERSE = 24, 8, 16, 32
DESCENTS = 3
#: Nodes that a search holds, and how many of them it expands at once.
POOL, EXPAND = 640, 128
#: Sampled vectors that order the nodes.
PIVOTS = 256
NEAREST = 5
#: Bytes of requests that may be broadcast.
BROADCAST_BYTES = 64 << 20
_NONE = np.float32(-2)


# ------------------------------------------------------------------ vectors

def nodes(vectors: DataFrame) -> DataFrame:
    """place, v, ids of the distinct usable vectors of ``vectors`` (vec_id, embedding); ids are the least few that share one.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without a vec_id, take no part.
    """
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")).where(
        F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.exists("v", lambda x: x != 0)
        & F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))))
    # Spark limits the ranks before the shuffle too, so very many copies are a few rows per task. One more than a
    # search returns: a query leaves itself out.
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    distinct = save(usable.withColumn("rank", rank).where(F.col("rank") <= NEAREST + 1).groupBy("v").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-distinct")
    sample = [r.v for r in distinct.select("v").orderBy(F.xxhash64("v"), "v").limit(PIVOTS).collect()]
    dim = distinct.agg(F.max(F.size("v"))).first()[0] or 1
    pivots = np.zeros((max(len(sample), 1), dim))
    for k, v in enumerate(sample):
        pivots[k, :len(v)] = np.array(v) / max(float(np.linalg.norm(v)), 1e-300)

    def near(batches):
        for batch in batches:
            x = _unit(_matrix(batch.column("v"), dim)[0]) @ pivots.T
            cell = x.argmax(axis=1) if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("v"), batch.column("ids"), pa.array(cell, pa.int32()), pa.array(x[np.arange(len(x)), cell])],
                ["v", "ids", "cell", "near"])

    kind = distinct.schema["v"].dataType.simpleString()
    placed = numbered(distinct.mapInArrow(near, f"v {kind}, ids array<long>, cell int, near double"),
                      ["cell", "near", F.xxhash64("v")], name="ann-order")
    return placed.select("place", "v", "ids")


def _matrix(column, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Doubles of a list column, shorter rows padded with zeros, and the lengths of the rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(size), dim))
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out, size.astype(np.int32)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    scale = (np.abs(unit).max(axis=1) / 127.0).astype(np.float32)
    return np.rint(unit / scale[:, None]).astype(np.int8), scale


class _Known:
    """Int8 vectors of some nodes by place: similarities, that of vectors of different lengths being -2."""

    def __init__(self, place: np.ndarray, q: np.ndarray, scale: np.ndarray, size: np.ndarray):
        order = np.argsort(place, kind="stable")
        self.place = place[order]
        self.x = q[order].astype(np.float32) * scale[order, None]
        self.size = size[order]
        self.mixed = len(size) > 0 and bool((size != size[0]).any())

    def index(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.place, place)


def _blobs(row: dict, *names_kinds) -> list[np.ndarray]:
    return [np.frombuffer(row[n], k) for n, k in names_kinds]


def _split(target: np.ndarray, columns: list[np.ndarray]):
    """(target, bytes of each column) for each distinct target."""
    order = np.argsort(target, kind="stable")
    target = target[order]
    cuts = np.flatnonzero(np.diff(target)) + 1
    begins = np.concatenate([[0], cuts]).tolist() if len(target) else []
    ends = [*cuts.tolist(), len(target)]
    columns = [c[order] for c in columns]
    return [(int(target[b]), *[c[b:e].tobytes() for c in columns]) for b, e in zip(begins, ends, strict=False)]


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _batch(rows: list[tuple], schema: pa.Schema):
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]


def _schema(**kinds) -> tuple[pa.Schema, str]:
    types = {"long": pa.int64(), "binary": pa.binary(), "float": pa.float32()}
    return pa.schema([(n, types[k]) for n, k in kinds.items()]), ", ".join(f"{n} {k}" for n, k in kinds.items())


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays(_batch(rows, schema), schema=schema)


def _best(group: np.ndarray, item: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Indices of the ``most`` best distinct items of each group, groups ascending, best first, ties to smaller items."""
    order = np.lexsort((-score, item, group))
    g, i = group[order], item[order]
    order = order[np.concatenate([[True], (g[1:] != g[:-1]) | (i[1:] != i[:-1])])] if len(order) else order
    order = order[np.lexsort((item[order], -score[order], group[order]))]
    g = group[order]
    rank = np.arange(len(g)) - np.searchsorted(g, g)
    return order[rank < most]


VECTORS, VECTORS_DDL = _schema(block="long", q="binary", scale="binary", size="binary", exact="binary", n_ids="binary", ids="binary")
LISTS, LISTS_DDL = _schema(block="long", ids="binary", sims="binary", kth="binary")
EDGES, EDGES_DDL = _schema(block="long", local="binary", other="binary", sims="binary")
MEMBERS, MEMBERS_DDL = _schema(block="long", ids="binary")
ASKS, ASKS_DDL = _schema(block="long", asker="long", local="binary")
REPLIES, REPLIES_DDL = _schema(block="long", place="binary", q="binary", scale="binary", size="binary", kth="binary")
GRAPH, GRAPH_DDL = _schema(sub="long", degree="binary", member="binary", place="binary", q="binary", scale="binary", size="binary")


def vector_blocks(placed: DataFrame, dim: int) -> DataFrame:
    """A row per block of nodes: int8 vectors, scales, lengths, the vectors in double precision, the ids that share each."""
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        x, size = _matrix(table.column("v"), dim)
        q, scale = _quantised(_unit(x))
        ids = table.column("ids").to_pylist()
        return _rows([(table.column("place")[0].as_py() // BLOCK, q.tobytes(), scale.tobytes(), size.tobytes(), x.tobytes(),
                       np.array([len(i) for i in ids], np.uint8).tobytes(), np.array([k for i in ids for k in i], np.int64).tobytes())],
                     VECTORS)

    block = F.floor(F.col("place") / BLOCK).cast("long").alias("block")
    return save(placed.select(block, "place", "v", "ids").groupBy("block").applyInArrow(pack, VECTORS_DDL), "ann-vectors")


# ------------------------------------------------------------------ NN-descent

def first_lists(vectors: DataFrame, n: int, dim: int) -> DataFrame:
    """The nearest of a window for each node, and nodes drawn by a hash of its place, without similarities yet."""
    def start(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                q, scale, size = _blobs(row, ("q", np.int8), ("scale", np.float32), ("size", np.int32))
                m = len(scale)
                x = q.reshape(m, dim).astype(np.float32) * scale[:, None]
                base = row["block"] * BLOCK
                ids, sims = np.full((m, NEIGHBOURS), -1, np.int64), np.full((m, NEIGHBOURS), _NONE)
                for part in np.array_split(np.arange(m), -(-m // WINDOW)):
                    s = x[part] @ x[part].T
                    s[size[part][:, None] != size[part][None, :]] = _NONE
                    np.fill_diagonal(s, _NONE)
                    k = min(NEIGHBOURS - RANDOM, len(part) - 1)
                    if k > 0:
                        top = np.argpartition(-s, k - 1, axis=1)[:, :k]
                        best = np.take_along_axis(s, top, 1)
                        ids[part, :k], sims[part, :k] = np.where(best > -1.5, base + part[top], -1), best
                seed = (base + np.arange(m, dtype=np.uint64))[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(RANDOM, dtype=np.uint64)[None, :] * np.uint64(0xD1B54A32D192ED03)
                seed ^= seed >> np.uint64(31)
                seed *= np.uint64(0xBF58476D1CE4E5B9)
                seed ^= seed >> np.uint64(29)
                drawn = (seed % np.uint64(n)).astype(np.int64)
                ids[:, -RANDOM:] = np.where(drawn == (base + np.arange(m))[:, None], -1, drawn)
                out.append((row["block"], ids.tobytes(), sims.tobytes(), sims.min(axis=1).tobytes()))
            yield pa.RecordBatch.from_arrays(_batch(out, LISTS), schema=LISTS)

    return save(vectors.select("block", "q", "scale", "size").mapInArrow(start, LISTS_DDL), "ann-lists")


def _lists(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids, sims = _blobs(row, ("ids", np.int64), ("sims", np.float32))
    return ids.reshape(-1, NEIGHBOURS), sims.reshape(-1, NEIGHBOURS)


def members(lists: DataFrame, most: int, own: bool) -> DataFrame:
    """The neighbours of each node, -1 where there are fewer: forward, the nearest ``most`` reverse ones, itself if ``own``."""
    def turn(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ids, sims = _lists(row)
                at, k = np.nonzero(ids >= 0)
                to, s, source = ids[at, k], sims[at, k], at + row["block"] * BLOCK
                keep = _best(to, source, s, most)
                out += _split(to[keep] // BLOCK, [(to[keep] % BLOCK).astype(np.uint16), source[keep], s[keep]])
            yield pa.RecordBatch.from_arrays(_batch(out, EDGES), schema=EDGES)

    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return MEMBERS.empty_table()
        row = left.to_pylist()[0]
        ids, _ = _lists(row)
        local, other, sims = _joined(right, "local", np.uint16), _joined(right, "other", np.int64), _joined(right, "sims", np.float32)
        new = ~(ids[local] == other[:, None]).any(axis=1) if len(local) else np.zeros(0, bool)
        local, other, sims = local[new].astype(np.int64), other[new], sims[new]
        keep = _best(local, other, sims, most)
        local, other = local[keep], other[keep]
        extra = np.full((len(ids), most), -1, np.int64)
        extra[local, np.arange(len(local)) - np.searchsorted(local, local)] = other
        parts = [ids, extra] + ([np.arange(len(ids))[:, None] + row["block"] * BLOCK] if own else [])
        return _rows([(row["block"], np.concatenate(parts, axis=1).tobytes())], MEMBERS)

    reverse = lists.select("block", "ids", "sims").mapInArrow(turn, EDGES_DDL)
    return save(lists.select("block", "ids", "sims").groupBy("block").cogroup(reverse.groupBy("block")).applyInArrow(gather, MEMBERS_DDL),
                "ann-members")


def replies(wanted: DataFrame, vectors: DataFrame, lists: DataFrame, dim: int) -> DataFrame:
    """The vectors of all members of each block, each once, with the least similarity of their own lists."""
    def ask(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ids = np.unique(np.frombuffer(row["ids"], np.int64))
                ids = ids[ids >= 0]
                out += [(home, row["block"], local) for home, local in _split(ids // BLOCK, [(ids % BLOCK).astype(np.uint16)])]
            yield pa.RecordBatch.from_arrays(_batch(out, ASKS), schema=ASKS)

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return REPLIES.empty_table()
        row = right.to_pylist()[0]
        q, scale, size, kth = _blobs(row, ("q", np.int8), ("scale", np.float32), ("size", np.int32), ("kth", np.float32))
        q = q.reshape(-1, dim)
        out = []
        for asker, local in zip(left.column("asker").to_pylist(), left.column("local").to_pylist(), strict=True):
            at = np.frombuffer(local, np.uint16).astype(np.int64)
            out.append((asker, (at + row["block"] * BLOCK).tobytes(), q[at].tobytes(), scale[at].tobytes(), size[at].tobytes(), kth[at].tobytes()))
        return _rows(out, REPLIES)

    asks = wanted.mapInArrow(ask, ASKS_DDL)
    known = vectors.select("block", "q", "scale", "size").join(lists.select("block", "kth"), "block")
    return asks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(answer, REPLIES_DDL)


def _known(table: pa.Table, dim: int) -> tuple[_Known, np.ndarray]:
    place = _joined(table, "place", np.int64)
    known = _Known(place, _joined(table, "q", np.int8).reshape(-1, dim), _joined(table, "scale", np.float32), _joined(table, "size", np.int32))
    return known, _joined(table, "kth", np.float32)[np.argsort(place, kind="stable")]


def descend(vectors: DataFrame, lists: DataFrame, dim: int) -> DataFrame:
    """One round of NN-descent."""
    wanted = members(lists, REVERSE, own=True)

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return EDGES.empty_table()
        known, kth = _known(right, dim)
        rows = np.frombuffer(left.column("ids")[0].as_py(), np.int64).reshape(-1, NEIGHBOURS + REVERSE + 1)
        found = []
        for begin in range(0, len(rows), 256):
            ids = rows[begin: begin + 256]
            at = known.index(np.maximum(ids, known.place[0]))
            x = known.x[at]
            s = np.matmul(x, x.transpose(0, 2, 1))
            better = (s > kth[at][:, :, None]) & (ids[:, :, None] != ids[:, None, :]) & (ids >= 0)[:, :, None] & (ids >= 0)[:, None, :]
            if known.mixed:
                better &= known.size[at][:, :, None] == known.size[at][:, None, :]
            g, a, b = np.nonzero(better)
            u, w, sim = ids[g, a], ids[g, b], s[g, a, b]
            keep = _best(u, w, sim, NEIGHBOURS)
            found.append((u[keep], w[keep], sim[keep]))
        u, w, sim = (np.concatenate(c) for c in zip(*found, strict=True))
        keep = _best(u, w, sim, NEIGHBOURS)
        u, w, sim = u[keep], w[keep], sim[keep]
        return _rows(_split(u // BLOCK, [(u % BLOCK).astype(np.uint16), w, sim]), EDGES)

    def merge(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        ids, sims = _lists(row)
        m = len(ids)
        u = np.concatenate([np.repeat(np.arange(m), NEIGHBOURS), _joined(right, "local", np.uint16).astype(np.int64)])
        w = np.concatenate([ids.ravel(), _joined(right, "other", np.int64)])
        s = np.concatenate([sims.ravel(), _joined(right, "sims", np.float32)])
        real = w >= 0
        u, w, s = u[real], w[real], s[real]
        keep = _best(u, w, s, NEIGHBOURS)
        u, w, s = u[keep], w[keep], s[keep]
        rank = np.arange(len(u)) - np.searchsorted(u, u)
        ids, sims = np.full((m, NEIGHBOURS), -1, np.int64), np.full((m, NEIGHBOURS), _NONE)
        ids[u, rank], sims[u, rank] = w, s
        return _rows([(row["block"], ids.tobytes(), sims.tobytes(), sims[:, -1].tobytes())], LISTS)

    updates = wanted.groupBy("block").cogroup(replies(wanted, vectors, lists, dim).groupBy("block")).applyInArrow(compare, EDGES_DDL)
    return save(lists.groupBy("block").cogroup(updates.groupBy("block")).applyInArrow(merge, LISTS_DDL), "ann-lists")


def search_graph(vectors: DataFrame, lists: DataFrame, dim: int) -> DataFrame:
    """A row per ``SUB`` nodes: their neighbours both ways, and the vectors of those, each once."""
    wanted = members(lists, SEARCH_REVERSE, own=False)

    def pack(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return GRAPH.empty_table()
        place = _joined(right, "place", np.int64)
        order = np.argsort(place, kind="stable")
        place = place[order]
        q, scale, size = (_joined(right, "q", np.int8).reshape(-1, dim)[order], _joined(right, "scale", np.float32)[order],
                          _joined(right, "size", np.int32)[order])
        rows = np.frombuffer(left.column("ids")[0].as_py(), np.int64).reshape(-1, NEIGHBOURS + SEARCH_REVERSE)
        first, out = left.column("block")[0].as_py() * (BLOCK // SUB), []
        for k in range(0, len(rows), SUB):
            ids = rows[k: k + SUB]
            some, member = np.unique(ids[ids >= 0], return_inverse=True)
            at = np.searchsorted(place, some)
            out.append((first + k // SUB, (ids >= 0).sum(axis=1).astype(np.uint16).tobytes(), member.astype(np.int32).tobytes(),
                        some.tobytes(), q[at].tobytes(), scale[at].tobytes(), size[at].tobytes()))
        return _rows(out, GRAPH)

    return save(wanted.groupBy("block").cogroup(replies(wanted, vectors, lists, dim).groupBy("block")).applyInArrow(pack, GRAPH_DDL), "ann-graph")


# ------------------------------------------------------------------ search

STATE, STATE_DDL = _schema(home="long", query="long", exact="binary", ids="binary", sims="binary", done="binary", waiting="long")
REQUESTS, REQUESTS_DDL = _schema(sub="long", query="long", vector="binary", size="long", least="float", local="binary")
FOUND, FOUND_DDL = _schema(home="long", query="long", ids="binary", sims="binary")


def _expandable(done: np.ndarray) -> np.ndarray:
    return np.flatnonzero(done == 0)[:EXPAND]


def _start(places: DataFrame, vectors: DataFrame, lists: DataFrame, dim: int) -> DataFrame:
    """The first pools: the lists of the queries' own nodes. ``places`` has the distinct ``query`` places."""
    def begin(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return STATE.empty_table()
        row = right.to_pylist()[0]
        ids, sims = _lists(row)
        exact = np.frombuffer(row["exact"], np.float64).reshape(-1, dim)
        size = np.frombuffer(row["size"], np.int32)
        out = []
        for query in left.column("query").to_pylist():
            k = query - row["block"] * BLOCK
            have = ids[k] >= 0
            # Only the first neighbours' similarities may be unknown; they are found when others reach them.
            out.append((row["block"], query, exact[k, :size[k]].tobytes(), ids[k][have].tobytes(), sims[k][have].tobytes(),
                        np.zeros(have.sum(), np.uint8).tobytes(), int(have.sum())))
        return _rows(out, STATE)

    asked = places.select(F.floor(F.col("query") / BLOCK).cast("long").alias("block"), "query")
    known = vectors.select("block", "exact", "size").join(lists.select("block", "ids", "sims"), "block")
    return save(asked.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(begin, STATE_DDL), "ann-pools")


def search(places: DataFrame, vectors: DataFrame, lists: DataFrame, graph: DataFrame, dim: int) -> DataFrame:
    """Pools of the nearest nodes of each query place, greedily enlarged until all their nodes are expanded."""
    def request(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                exact, ids, sims, done = _blobs(row, ("exact", np.float64), ("ids", np.int64), ("sims", np.float32), ("done", np.uint8))
                at = ids[_expandable(done)]
                unit = np.zeros(dim, np.float16)
                unit[:len(exact)] = _unit(exact[None, :])[0]
                least = float(sims[-1]) if len(sims) >= POOL else float(_NONE)
                out += [(sub, row["query"], unit.tobytes(), len(exact), least, local)
                        for sub, local in _split(at // SUB, [(at % SUB).astype(np.uint16)])]
            yield pa.RecordBatch.from_arrays(_batch(out, REQUESTS), schema=REQUESTS)

    def expand(batches):
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                degree, member, place, q, scale, size = _blobs(row, ("degree", np.uint16), ("member", np.int32), ("place", np.int64),
                                                               ("q", np.int8), ("scale", np.float32), ("size", np.int32))
                x = q.reshape(-1, dim).astype(np.float32) * scale[:, None]
                end = np.cumsum(degree.astype(np.int64))
                begin = end - degree
                for r in row["requests"]:
                    local = np.frombuffer(r["local"], np.uint16).astype(np.int64)
                    count = degree[local].astype(np.int64)
                    at = np.unique(member[np.repeat(begin[local] - (np.cumsum(count) - count), count) + np.arange(count.sum())])
                    s = x[at] @ np.frombuffer(r["vector"], np.float16).astype(np.float32)
                    good = (s > r["least"]) & (place[at] != r["query"]) & (size[at] == r["size"])
                    at, s = at[good], s[good]
                    if len(at) > POOL:
                        top = np.argpartition(-s, POOL - 1)[:POOL]
                        at, s = at[top], s[top]
                    if len(at):
                        out.append((r["query"] // BLOCK, r["query"], place[at].tobytes(), s.tobytes()))
            yield pa.RecordBatch.from_arrays(_batch(out, FOUND), schema=FOUND)

    def merge(left: pa.Table, right: pa.Table) -> pa.Table:
        got: dict[int, list] = {}
        for query, ids, sims in zip(right.column("query").to_pylist(), right.column("ids").to_pylist(), right.column("sims").to_pylist(), strict=True):
            got.setdefault(query, []).append((ids, sims))
        out = []
        for row in left.to_pylist():
            ids, sims, done = _blobs(row, ("ids", np.int64), ("sims", np.float32), ("done", np.uint8))
            done = done.copy()
            done[_expandable(done)] = 1
            new = got.get(row["query"], [])
            item = np.concatenate([ids, *[np.frombuffer(i, np.int64) for i, _ in new]])
            score = np.concatenate([sims, *[np.frombuffer(s, np.float32) for _, s in new]])
            seen = np.concatenate([done, np.zeros(len(item) - len(ids), np.uint8)])
            # A node met again keeps that it was expanded, and the similarity now known.
            order = np.lexsort((-seen.astype(np.int8), item))
            flag = seen[order][np.searchsorted(item[order], item)]
            keep = _best(np.zeros(len(item), np.int64), item, score, POOL)
            out.append((row["home"], row["query"], row["exact"], item[keep].tobytes(), score[keep].tobytes(), flag[keep].tobytes(),
                        int((flag[keep] == 0).sum())))
        return _rows(out, STATE)

    pools = _start(places, vectors, lists, dim)
    queries = pools.count()
    small = queries * EXPAND * (2 * dim + 64) <= BROADCAST_BYTES
    while True:
        asked = pools.mapInArrow(request, REQUESTS_DDL).groupBy("sub").agg(
            F.collect_list(F.struct("query", "vector", "size", "least", "local")).alias("requests"))
        found = graph.join(F.broadcast(asked) if small else asked, "sub").mapInArrow(expand, FOUND_DDL)
        seen = Observation()
        pools = save(pools.groupBy("home").cogroup(found.groupBy("home")).applyInArrow(merge, STATE_DDL)
                     .observe(seen, F.sum("waiting").alias("waiting")), "ann-pools")
        if not seen.get["waiting"]:
            return pools


def _scored(pools: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """query, top: the best (score, vec_id) of each pool and of the query's own node, in double precision."""
    asks_schema, asks_ddl = _schema(block="long", query="long", exact="binary", local="binary")
    score_schema = pa.schema([("query", pa.int64()), ("score", pa.float64()), ("vec_id", pa.int64())])

    def ask(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                at = np.append(np.frombuffer(row["ids"], np.int64), row["query"])
                out += [(block, row["query"], row["exact"], local) for block, local in _split(at // BLOCK, [(at % BLOCK).astype(np.uint16)])]
            yield pa.RecordBatch.from_arrays(_batch(out, asks_schema), schema=asks_schema)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return score_schema.empty_table()
        row = right.to_pylist()[0]
        x = np.frombuffer(row["exact"], np.float64).reshape(-1, dim)
        size, count, ids = _blobs(row, ("size", np.int32), ("n_ids", np.uint8), ("ids", np.int64))
        norm = np.sqrt((x * x).sum(axis=1))
        end = np.cumsum(count.astype(np.int64))
        out = []
        for query, exact, local in zip(left.column("query").to_pylist(), left.column("exact").to_pylist(), left.column("local").to_pylist(), strict=True):
            at = np.frombuffer(local, np.uint16).astype(np.int64)
            v = np.frombuffer(exact, np.float64)
            at = at[size[at] == len(v)]
            s = (x[at, :len(v)] * v).sum(axis=1) / (norm[at] * np.sqrt((v * v).sum()))
            each = np.repeat(np.arange(len(at)), count[at])
            names = ids[np.concatenate([np.arange(end[a] - count[a], end[a]) for a in at])] if len(at) else ids[:0]
            top = np.lexsort((names, -s[each]))[:NEAREST + 1]
            out += zip([query] * len(top), s[each][top].tolist(), names[top].tolist(), strict=True)
        return pa.Table.from_arrays(_batch(out, score_schema), schema=score_schema)

    asked = pools.select("query", "exact", "ids").mapInArrow(ask, asks_ddl)
    known = vectors.select("block", "exact", "size", "n_ids", "ids")
    scores = asked.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(score, "query long, score double, vec_id long")
    best = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id")))
    return scores.groupBy("query").agg(F.slice(best, 1, NEAREST + 1).alias("top"))


def nearest(vectors: DataFrame, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id, score: for every row of ``vectors`` (vec_id, embedding) whose vec_id ``every`` divides, its
    nearest rows by cosine among all others, nearest first, ties to the smaller vec_id.

    Fewer rows where there are fewer candidates; vectors of another length are none. Copies of a vector are found through
    their node, however many they are. Rows alike in vec_id and vector are one query and candidates each; a vec_id that names
    several vectors is a query for each. Null, zero and non-finite vectors and null vec_ids take no part;
    other columns are not looked at; an empty table gives no rows.
    """
    placed = save(nodes(vectors), "ann-nodes")
    n, dim = placed.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    dim = dim or 1
    blocks = vector_blocks(placed, dim)
    lists = first_lists(blocks, max(n, 1), dim)
    for _ in range(DESCENTS):
        lists = descend(blocks, lists, dim)
    graph = search_graph(blocks, lists, dim)

    # Copies beyond a node's few ids are queries too, so queries meet their node by vector. Two hashes stand for it.
    def keys(v):
        return [F.xxhash64(v).alias("a"), F.xxhash64(F.lit(1), v).alias("b")]

    asked = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")).where(F.col("vec_id") % every == 0)
    queries = save(asked.select("vec_id", *keys(F.col("v"))).distinct().join(placed.select(F.col("place").alias("query"), *keys(F.col("v"))), ["a", "b"])
                   .select("vec_id", "query"), "ann-queries")
    pools = search(queries.select("query").distinct(), blocks, lists, graph, dim)
    top = few(save(_scored(pools, blocks, dim), "ann-top"))
    own = F.array_position(F.transform("top", lambda t: t["vec_id"]), F.col("vec_id")).cast("int")
    others = F.when(own > 0, F.concat(F.slice("top", F.lit(1), own - 1), F.slice("top", own + 1, F.lit(NEAREST + 1)))).otherwise(F.col("top"))
    ranked = queries.join(top, "query").select(F.col("vec_id").alias("query_id"), F.slice(others, 1, NEAREST).alias("top"))
    return ranked.select("query_id", F.posexplode("top").alias("at", "t")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"), (-F.col("t.minus")).alias("score"))
