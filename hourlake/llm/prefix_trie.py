"""The trie of conversation prefixes, from sorted conversations and range-minimum queries over their LCPs.

A turn is a 128-bit digest, a conversation the bytes of its turns' digests, and the table is sorted by them. In
sorted order the members of a prefix stand next to each other: they are the rows around any of them up to where the
common prefix of neighbours (LCP) gets shorter than the prefix. Every candidate prefix finds both ends for itself by
binary descent of a sparse table of LCP minima; members, least ids, leaves and saved text are then differences of
running sums or further range minima, so nothing is passed from one prefix to another and no stack is kept.

The order is cut into blocks of a fixed number of conversations, which are independent: a block holds its rows, the
row before and the row behind. Intervals are clipped to the block. Only the prefixes that cross a block's edge (at
most as many as one conversation has turns, for each edge) need the other blocks: their clipped pieces are sums
and minima, added up by the digest of the prefix.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.llm.chunks import save
from hourlake.llm.order import numbered

#: Conversations of a block.
BLOCK = 2048
#: Consecutive conv_ids that share the head of the first of them, and the most turns a head has.
FAMILY, HEAD = 100, 6
WIDTH = 16
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def rebuild(conversations: DataFrame, family: int = FAMILY, head: int = HEAD) -> DataFrame:
    """conv_id, key binary (16 bytes a turn), chars array<int>: every conversation with its head exchanged.

    The first h = CRC-32(decimal conv_id) % ``head`` turns are those of conversation conv_id - conv_id % ``family``
    (all if it has fewer, none if there is none), the others its own from its turn h + 1 on. Turns go by ``turn``, null
    first; of turns that share it, by the digest of role and text. Null role or text counts as empty, a null conv_id names
    no conversation. A row is one conversation: 20 bytes a turn, whatever the length of the texts.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), (F.col("conv_id") - F.col("conv_id") % family).cast("long").alias("base"),
        F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"), name.alias("name"),
                 F.length(text).alias("chars")).alias("turn"))
    # One shuffle by family serves the grouping and the join.
    own = turns.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    heads = own.where(F.col("conv_id") == F.col("base")).select("base", F.slice("turns", 1, head - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % head).cast("int")
    whole = F.concat(F.coalesce(F.slice("head", F.lit(1), h), F.slice("turns", 1, 0)),
                     F.slice("turns", h + 1, F.size("turns")))
    return own.join(heads, "base", "left").select("conv_id", whole.alias("turns")).select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["name"]), "")).alias("key"),
        F.transform("turns", lambda t: t["chars"]).alias("chars"))


def neighbour_lcps(keys: list[bytes]) -> np.ndarray:
    """Common turns of each key with the one before it, from the second on."""
    size = np.array([len(k) // WIDTH for k in keys], np.int64)
    flat = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
    begin = np.cumsum(size) - size
    both = np.minimum(size[:-1], size[1:])
    pair = np.repeat(np.arange(len(both)), both)
    turn = np.arange(both.sum()) - np.repeat(np.cumsum(both) - both, both)
    differ = np.flatnonzero((flat[begin[pair] + turn] != flat[begin[pair + 1] + turn]).any(axis=1))
    which, first = np.unique(pair[differ], return_index=True)
    out = both.copy()
    out[which] = turn[differ[first]]
    return out


def sparse_table(x: np.ndarray) -> list[np.ndarray]:
    """Minima of x[i : i + 2**k], for each k."""
    out = [x]
    while 2 ** len(out) <= len(x):
        half = 2 ** (len(out) - 1)
        out.append(np.minimum(out[-1][:-half], out[-1][half:]))
    return out


def extents(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row around each row ``at`` that share its first ``depth`` turns; ``table`` is of the rows' LCPs."""
    last = len(table[0]) - 1
    left, right = at.copy(), at.copy()
    for k in range(len(table) - 1, -1, -1):
        step = 1 << k
        ok = (left >= step) & (table[k][np.maximum(left - step + 1, 0)] >= depth)
        left = np.where(ok, left - step, left)
        ok = right + step <= last
        ok &= table[k][np.where(ok, right + 1, 0)] >= depth
        right = np.where(ok, right + step, right)
    return left, right


def range_min(table: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    level = np.frexp((right - left + 1).astype(np.float64))[1] - 1
    out = np.empty(len(left), table[0].dtype)
    for k in range(len(table)):
        some = level == k
        out[some] = np.minimum(table[k][left[some]], table[k][right[some] - (1 << k) + 1])
    return out


def _prefix_digests(key: bytes, depth: int) -> list[bytes]:
    """128-bit digests of the first 0 .. ``depth`` turns."""
    state, out = hashlib.sha256(), []
    for d in range(depth + 1):
        if d:
            state.update(key[(d - 1) * WIDTH: d * WIDTH])
        out.append(state.copy().digest()[:WIDTH])
    return out


PIECE = pa.schema([("block", pa.int64()), ("open", pa.bool_()), ("digest", pa.binary()), ("parent_digest", pa.binary()),
                   ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
                   ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()), ("before", pa.int64()),
                   ("ends", pa.string())])
PIECE_DDL = ("block long, open boolean, digest binary, parent_digest binary, conv_id long, depth long, parent_conv_id long, "
             "n_convs long, n_children long, n_leaves long, saved long, before long, ends string")


def block_nodes(rows: pa.Table, size: int = BLOCK) -> pa.Table:
    """The nodes of one block, in :data:`PIECE`: whole ones, and pieces of those that cross its edges (``open``).

    ``saved`` is, of a piece, what it adds to the sum of the members' LCP texts; ``before`` is the text before the last
    turn. ``ends`` is the hash of the ids that end here, of a piece the ids themselves.
    """
    rows = rows.sort_by("place")
    block = rows.column("block")[0].as_py()
    own = np.flatnonzero(rows.column("place").to_numpy() // size == block)
    a, b = int(own[0]), int(own[-1]) + 1
    keys = rows.column("key").to_pylist()
    lcps = neighbour_lcps(keys)
    # -1 before the first row and behind the last: nothing is shared, not even the root.
    lcp = np.concatenate([[lcps[a - 1] if a else -1], lcps[a:b - 1]])
    behind = int(lcps[b - 1]) if b < len(keys) else -1
    m = b - a
    length = np.array([len(k) // WIDTH for k in keys[a:b]], np.int64)
    ids = rows.column("conv_id").to_numpy()[a:b]
    lists = rows.column("chars").combine_chunks().slice(a, m) if m else None
    total = np.concatenate([[0], np.cumsum(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64))])
    row_at = np.cumsum(length) - length
    before_lcp = total[row_at + np.maximum(lcp, 0)] - total[row_at]
    following = np.concatenate([lcp[1:], [behind]])
    leaf = np.concatenate([[0], np.cumsum(following < length)])
    shared = np.concatenate([[0], np.cumsum(before_lcp)])

    # Candidates: prefixes that a row has and the row before it lacks; of the first row all.
    first = lcp + 1
    first[0] = 0
    count = length - first + 1
    node_at = np.cumsum(count) - count
    row = np.repeat(np.arange(m), count)
    depth = np.arange(len(row)) - node_at[row] + first[row]
    table = sparse_table(lcp)
    left, right = extents(table, row, depth)
    from_before = (row == 0) & (depth <= lcp[0])
    crosses = from_before | ((right == m - 1) & (behind >= depth))
    parent_left, _ = extents(table, row, depth - 1)
    parent = node_at[parent_left] + depth - 1 - first[parent_left]
    has_parent = depth > 0
    children = np.bincount(parent[has_parent & ~from_before], minlength=len(row))
    before = np.where(has_parent, total[row_at[row] + np.maximum(depth - 1, 0)] - total[row_at[row]], 0)
    n = right - left + 1
    # The first member of a prefix shares it with no row before; one from before this block does.
    saved = shared[right + 1] - shared[left + np.where(from_before, 0, 1)]
    saved = np.where(crosses, saved, saved - (n - 1) * before)
    least = range_min(sparse_table(ids), left, right)

    head = _prefix_digests(keys[a], int(lcp[0])) if lcp[0] >= 0 else []
    tail = _prefix_digests(keys[b - 1], behind) if behind >= 0 else []
    digest = [None] * len(row)
    for k in np.flatnonzero(crosses).tolist():
        digest[k] = (head if from_before[k] else tail)[depth[k]]
    ends = [None if c else EMPTY_SHA256 for c in crosses.tolist()]
    # Equal rows follow each other; a run is the members that end at the node of its first row.
    start = np.flatnonzero((lcp != length) | (np.arange(m) == 0))
    texts = list(map(str, ids.tolist()))
    for s, e in zip(start.tolist(), [*start[1:].tolist(), m], strict=True):
        k = int(node_at[s] + length[s] - first[s])
        joined = ",".join(texts[s:e])
        ends[k] = joined if crosses[k] else hashlib.sha256(joined.encode()).hexdigest()
    up = np.where(has_parent, parent, 0)
    parent_open = has_parent & crosses[up]
    return pa.Table.from_arrays([
        pa.array(np.full(len(row), block), pa.int64()), pa.array(crosses), pa.array(digest, pa.binary()),
        pa.array([digest[p] if o else None for p, o in zip(up.tolist(), parent_open.tolist(), strict=True)], pa.binary()),
        pa.array(least, pa.int64()), pa.array(depth, pa.int64()),
        pa.array(least[up], pa.int64(), mask=~has_parent | parent_open), pa.array(n, pa.int64()), pa.array(children, pa.int64()),
        pa.array(leaf[right + 1] - leaf[left], pa.int64()), pa.array(saved, pa.int64()), pa.array(before, pa.int64()),
        pa.array(ends, pa.string())], schema=PIECE)


def _hash_runs(batches):
    """(digest, ids) sorted by digest and place -> (digest, SHA-256 of all ids of a digest, comma-joined); a state per digest."""
    now, state = None, None
    for batch in batches:
        done = []
        for digest, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if digest != now:
                if state is not None:
                    done.append((now, state.hexdigest()))
                now, state = digest, hashlib.sha256(ids.encode())
            else:
                state.update(("," + ids).encode())
        yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())],
                                         ["digest", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()], pa.string())],
                                         ["digest", "ends_sha256"])


def trie(rebuilt: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per distinct prefix of the conversations of :func:`rebuild` (conv_id unique): conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``conv_id`` is the least member, the root's parent is null. Equal conversations are members of the same nodes; one
    without turns is a member of the root alone; no conversation, no rows. A prefix shared by any number of
    conversations is a row per block it touches. The ids of very many equal conversations go through one task, for that is
    how SHA-256 works, in order and a row at a time.
    """
    placed = numbered(rebuilt, ["key", "conv_id"], name="trie-order").drop("size")
    here = F.floor(F.col("place") / block).cast("long")
    edge = F.pmod("place", F.lit(block))
    seen_by = F.array_compact(F.array(here, F.when((edge == 0) & (F.col("place") > 0), here - 1), F.when(edge == block - 1, here + 1)))
    rows = placed.select(F.explode(seen_by).alias("block"), "place", "conv_id", "key", "chars")

    def nodes(table: pa.Table) -> pa.Table:
        block_no = table.column("block")[0].as_py()
        if not (table.column("place").to_numpy() // block == block_no).any():
            return PIECE.empty_table()  # the block behind the last has only the row before it
        return block_nodes(table, block)

    pieces = save(rows.groupBy("block").applyInArrow(nodes, PIECE_DDL), "trie-pieces")
    open_pieces = pieces.where("open")
    merged = save(open_pieces.groupBy("digest").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.max("parent_digest").alias("parent_digest"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        (F.sum("saved") - (F.sum("n_convs") - 1) * F.min("before")).alias("saved")), "trie-open")
    least = merged.select(F.col("digest").alias("parent_digest"), F.col("conv_id").alias("parent_conv"))
    runs = open_pieces.where(F.col("ends").isNotNull()).select("digest", "ends", "block") \
        .repartition("digest").sortWithinPartitions("digest", "block").select("digest", "ends") \
        .mapInArrow(_hash_runs, "digest binary, ends_sha256 string")
    crossing = merged.join(least, "parent_digest", "left").join(runs, "digest", "left").select(
        "conv_id", "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
    # A whole node below a crossing one asks by block too, so that the children of a hot prefix are not one key.
    known = open_pieces.select("block", F.col("digest").alias("parent_digest")).join(least, "parent_digest")
    inside = pieces.where("not open").join(known, ["block", "parent_digest"], "left").select(
        "conv_id", "depth", F.coalesce("parent_conv", "parent_conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
    return inside.unionAll(crossing)
