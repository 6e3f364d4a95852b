"""Near-duplicate vectors by tiles of int8 products with rigorous error bounds.

A unit vector u is s * q + e with int8 q, scale s and the exact length of e measured after rounding. For two
vectors the cosine differs from s s' q.q' by at most |e'| (1 + |e|) + |e|, so most pairs are settled by the
product of the quantised tiles (whole numbers, exact in the float type used); the others are computed in double
precision. Equal vectors are one class with a multiplicity, so a group of copies is one row of a tile.

Vectors are dealt to cells by their nearest of some pivots and cells are cut into tiles. Two cells whose
angular radii and pivots prove every pair below the threshold are not compared. Tiles report sums and
stars, never pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.llm.chunks import save
from hourlake.llm.components import components

THRESHOLD = 0.9
TILE_ROWS = 4096
#: Pivots: one for each four tiles, and a bounded number of them.
MAX_PIVOTS = 512
_SLACK = 1e-6


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and an upper bound of each row's error length."""
    scale = np.abs(unit).max(axis=1) / 127.0
    q = np.rint(unit / scale[:, None])
    error = np.sqrt(((unit - q * scale[:, None]) ** 2).sum(axis=1)) * (1 + 1e-12) + 1e-15
    return q.astype(np.int8), scale, error


def above(x: np.ndarray, y: np.ndarray, threshold: float, same: bool, block: int = 512):
    """Index arrays (i, j) of the rows of x and y with cosine >= threshold, a block of rows at a time; i < j if ``same``."""
    (nx, ny) = (np.sqrt((v * v).sum(axis=1)) for v in (x, y))
    ux, uy = x / nx[:, None], y / ny[:, None]
    (qx, sx, ex), (qy, sy, ey) = quantise(ux), quantise(uy)
    # Sums of products of int8 values are whole numbers that float32 holds up to 2**24.
    kind = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64
    qx, qy = qx.astype(kind), np.ascontiguousarray(qy.astype(kind).T)
    for at in range(0, len(x), block):
        rows = slice(at, at + block)
        product = (qx[rows] @ qy).astype(np.float32, copy=False)
        product *= sx[rows, None].astype(np.float32)
        product *= sy[None, :].astype(np.float32)
        # Upper bound of the cosine >= threshold; the slack covers the float32 scaling.
        least = (threshold - _SLACK - ex[rows, None] - ey[None, :] * (1 + ex[rows, None])).astype(np.float32)
        i, j = np.nonzero(product >= least)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), 1 << 16):
            a, b = i[k: k + (1 << 16)], j[k: k + (1 << 16)]
            exact = np.einsum("ij,ij->i", x[a], y[b]) / (nx[a] * ny[b])
            hit = exact >= threshold
            if hit.any():
                yield a[hit], b[hit]


def stars(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least index reachable from each of n indices by the links (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _matrix(column) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding); no other column is read.

    Null, empty, zero and non-finite vectors and vectors with null components link with nothing, as do vectors of
    different lengths. Repeated rows are vectors of their own. Rows without vec_id count as links but are no
    component's least; their component_id is null if they have only each other. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    good = F.coalesce((F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("k1", F.when(good, F.xxhash64("embedding"))).withColumn(
        "k2", F.when(good, F.xxhash64(F.lit(1), "embedding")))
    named = rows.select("vec_id", "k1", "k2")
    classes = rows.where("k1 is not null").groupBy("k1", "k2").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("embedding").alias("embedding"))
    classes = save(classes.withColumn("class", F.monotonically_increasing_id())
                   .withColumn("size", F.size("embedding")), "vectors")
    count = classes.count()
    wanted = max(1, min(MAX_PIVOTS, count // (4 * tile_rows)))
    pivots = [np.array(r[0]) for r in classes.orderBy("k1", "k2").limit(wanted).select("embedding").collect()]
    pivots = [p / np.linalg.norm(p) for p in pivots]

    def place(batches):
        for batch in batches:
            cells, angles = [], []
            for x in batch.column("embedding").to_pylist():
                x = np.array(x)
                x = x / np.sqrt((x * x).sum())
                cos = [float(p @ x) if len(p) == len(x) else -1.0 for p in pivots]
                best = int(np.argmax(cos))
                # Vectors of other lengths than the pivots' share the cell behind the last.
                fits = len(pivots[best]) == len(x)
                cells.append(best if fits else len(pivots))
                angles.append(math.acos(max(-1.0, min(1.0, cos[best]))) if fits else math.pi)
            yield pa.RecordBatch.from_arrays([batch.column("class"), batch.column("copies"), batch.column("embedding"),
                                              batch.column("size"), pa.array(cells, pa.int32()), pa.array(angles)],
                                             ["class", "copies", "embedding", "size", "cell", "angle"])

    placed = save(classes.select("class", "copies", "embedding", "size").mapInArrow(
        place, "class long, copies long, embedding array<double>, size int, cell int, angle double"), "cells")
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("radius"))
    # At most one row a pivot, and one more.
    radius = {r["cell"]: r["radius"] for r in cells.collect()}
    reach = math.acos(threshold) + 1e-9

    def may_link(a: int, b: int) -> bool:
        if a == b or len(pivots) in (a, b) or len(pivots[a]) != len(pivots[b]):
            return a == b or len(pivots) in (a, b)
        apart = math.acos(max(-1.0, min(1.0, float(pivots[a] @ pivots[b]))))
        return apart <= radius[a] + radius[b] + reach

    allowed = [(a, b) for a in radius for b in radius if a <= b and may_link(a, b)]
    tiled = placed.join(cells.select("cell", F.ceil(F.col("n") / tile_rows).cast("int").alias("tiles")), "cell")
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("class"), F.col("tiles")).cast("int"))

    def gather(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        x = _matrix(table.column("embedding"))
        blob = [np.ascontiguousarray(v).tobytes() for v in (table.column("class").to_numpy(), table.column("copies").to_numpy(), x)]
        return pa.table({"cell": table.column("cell")[:1], "size": table.column("size")[:1], "tile": table.column("tile")[:1],
                         "n": pa.array([len(x)], pa.int32()), "blob": pa.array([b"".join(blob)], pa.binary())})

    tiles = save(tiled.groupBy("cell", "size", "tile").applyInArrow(
        gather, "cell int, size int, tile int, n int, blob binary"), "tiles")
    tiles = tiles.withColumn("id", F.xxhash64("cell", "size", "tile"))
    heads = tiles.select("cell", "size", "id")
    meet = spark.createDataFrame(allowed or [(-1, -1)], "cell_a int, cell_b int")
    a = heads.select(F.col("cell").alias("cell_a"), "size", F.col("id").alias("a"))
    b = heads.select(F.col("cell").alias("cell_b"), "size", F.col("id").alias("b"))
    pairs = a.join(meet, "cell_a").join(b, ["cell_b", "size"]).where("cell_a < cell_b or a <= b").select("a", "b")
    sides = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("id"))
    sent = sides.join(tiles.select("id", "size", "n", "blob"), "id")

    def compare(table: pa.Table) -> pa.Table:
        parts = []
        for r in table.to_pylist():
            n, blob = r["n"], r["blob"]
            parts.append((np.frombuffer(blob, np.int64, n), np.frombuffer(blob, np.int64, n, 8 * n),
                          np.frombuffer(blob, np.float64, n * r["size"], 16 * n).reshape(n, r["size"])))
        same = len(parts) == 1
        (ca, ma, xa), (cb, mb, xb) = parts[0], parts[-1]
        shift = 0 if same else len(ca)
        total = len(ca) + (0 if same else len(cb))
        links = np.zeros(total, np.int64)
        label = np.arange(total)
        for i, j in above(xa, xb, threshold, same):
            j2 = j + shift
            np.add.at(links, i, mb[j])
            np.add.at(links, j2, ma[i])
            # Stars so far and the new links together.
            old = np.flatnonzero(label != np.arange(total))
            label = stars(total, np.concatenate([i, old]), np.concatenate([j2, label[old]]))
        names = ca if same else np.concatenate([ca, cb])
        hit = np.flatnonzero(links)
        return pa.table({"class": names[hit], "links": links[hit], "root": names[label[hit]]})

    found = save(sent.groupBy("a", "b").applyInArrow(compare, "class long, links long, root long"), "near")
    joined = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    sums = found.groupBy("class").agg(F.sum("links").alias("links"))
    whole = classes.select("k1", "k2", "copies", "least", "class").join(sums, "class", "left").join(
        joined.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = whole.groupBy("component").agg(F.min("least").alias("component_id"))
    whole = whole.join(least, "component").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = named.join(whole, ["k1", "k2"], "left")
    component = F.when(F.col("k1").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
