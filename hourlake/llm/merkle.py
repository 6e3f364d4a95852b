"""A Merkle manifest of a table: leaf, subtree and root digests, and for every row the proof that it is in.

The rows of a tree are numbered in order by one range shuffle. Every level is a table of nodes keyed by
(tree, place); a node meets its siblings by equijoins of the level with itself on the computed place of the
sibling (place XOR 1 in a binary tree, the place of each slot offset otherwise), and the rows of slot zero, which
then hold all digests of their run, emit the parents. All trees go up together, so there are as many rounds as the
largest has levels, of geometrically fewer rows. Proofs come down the same way: one chain of joins in which each
node takes its parent's proof, so a step is computed once per node, not once per leaf below it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlake.llm.chunks import few, save
from hourlake.llm.order import numbered

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: One row in so many is folded from a changed leaf.
TAMPER_EVERY = 7


def field_text(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 length in bytes, a colon, the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def field_value(text: Column) -> Column:
    """The string behind :func:`field_text`."""
    return F.when(text != "-", F.substring(text, F.instr(text, ":") + 1, F.length(text)))


def _digest(*parts: Column) -> Column:
    """SHA-256 of digests concatenated as lowercase hex, nulls left out."""
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.lower(F.hex(p)), F.lit("")) for p in parts]), 256))


def _climb(nodes: DataFrame, arity: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all trees of ``nodes`` (tree, place, size, node, others) and their tops (tree, level, node).

    A level has the nodes of trees with more than one left, each with its siblings ``s1`` .. by slot offset.
    """
    most = nodes.agg(F.max("size")).first()[0] or 0
    tables, tops, level = [], [nodes.where("size = 1").select("tree", F.lit(0).alias("level"), "node")], 0
    while most > 1:
        many = nodes.where("size > 1")
        slot = F.pmod("place", F.lit(arity))
        out = many
        for offset in range(1, arity):
            # Seen from its sibling, a node stands `offset` slots further round the run.
            seen_from = F.col("place") - slot + F.pmod(slot + (arity - offset), F.lit(arity)) if arity > 2 \
                else F.col("place").bitwiseXOR(F.lit(1))
            out = out.join(many.select("tree", seen_from.alias("place"), F.col("node").alias(f"s{offset}")), ["tree", "place"], "left")
        table = save(out, f"{name}-level")
        tables.append(table)
        parent = _digest(F.col("node"), *[F.col(f"s{o}") for o in range(1, arity)])
        nodes = table.where(F.pmod("place", F.lit(arity)) == 0).select(
            "tree", F.floor(F.col("place") / arity).cast("long").alias("place"),
            F.ceil(F.col("size") / arity).cast("long").alias("size"), parent.alias("node"))
        most, level = -(-most // arity), level + 1
        tops.append(nodes.where("size = 1").select("tree", F.lit(level).alias("level"), "node"))
    out = tops[0]
    for top in tops[1:]:
        out = out.unionAll(top)
    return tables, save(out, f"{name}-tops")


def _step(arity: int) -> Column:
    """The digests of a run left and right of a node, as one path element."""
    slot = F.pmod("place", F.lit(arity))

    def side(here) -> Column:
        held = []
        for at in range(arity):  # by slot, so left to right
            for offset in range(1, arity):
                held.append(F.when((F.pmod(slot + offset, F.lit(arity)) == at) & here(at), F.col(f"s{offset}")))
        return F.concat(*[F.coalesce(h, F.lit(b"")) for h in held])

    return F.struct(side(lambda at: F.lit(at) < slot).alias("before"), side(lambda at: F.lit(at) > slot).alias("behind"))


def _descend(tables: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """(tree, place, others of the leaves, path) of all leaves; ``tops`` has tree, level and the path from there on.
    Trees of one leaf are not in it."""
    ends = {r.level for r in tops.select("level").distinct().collect()}  # a few dozen numbers at most
    paths = None
    for level in range(len(tables), 0, -1):
        if level < len(tables):
            paths = tables[level].join(paths, (tables[level].tree == paths._tree) & (
                F.floor(tables[level].place / arity).cast("long") == paths._place)).select(
                F.col("tree").alias("_tree"), F.col("place").alias("_place"),
                F.concat(F.array(_step(arity)), "path").alias("path"))
        if level in ends:
            here = tops.where(F.col("level") == level).select(F.col("tree").alias("_tree"), F.lit(0).cast("long").alias("_place"), "path")
            paths = here if paths is None else paths.unionAll(here)
    leaves = tables[0]
    siblings = [f"s{o}" for o in range(1, arity)]
    return leaves.join(paths, (leaves.tree == paths._tree) & (F.floor(leaves.place / arity).cast("long") == paths._place)).select(
        *[c for c in leaves.columns if c not in siblings], F.concat(F.array(_step(arity)), "path").alias("path"))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all sibling digests of a path as hex, level by level, left to right."""
    steps = F.transform(path, lambda s: F.concat(F.lower(F.hex(s["before"])), F.lower(F.hex(s["behind"]))))
    return F.sha2(F.array_join(steps, ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex) and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(
        F.concat(F.lower(F.hex(s["before"])), acc, F.lower(F.hex(s["behind"]))), 256))


def manifest(docs: DataFrame, arity: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of the five fields in :func:`field_text`; the leaves of a ``lang`` ascend by doc_id
    (null first, then by leaf) and every ``arity`` consecutive nodes become one until one is left, the lang's subroot.
    The subroots, ordered by lang (null first, by UTF-8 bytes), give the root likewise. Where 7 divides the CRC-32 of
    the decimal doc_id, the root is folded from a leaf whose n_chars is one more (a null stays); a null doc_id is never
    changed. Rows alike in all fields are leaves of their own. A null lang is a tree of its own; extra columns are
    ignored; an empty table gives no rows; texts of any length are hashed whole.
    """
    if arity < 2:
        raise ValueError("arity is 2 or more")
    texts = {f: field_text(F.col(f)) for f in FIELDS}
    more = {**texts, "n_chars": field_text(F.col("n_chars").cast("decimal(20,0)") + 1)}
    leaf, changed = (F.unhex(F.sha2(F.concat(*[t[f] for f in FIELDS]), 256)) for t in (texts, more))
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    leaves = save(docs.select("doc_id", texts["lang"].alias("tree"), leaf.alias("node"),
                              F.when(tampered & F.col("n_chars").isNotNull(), changed).alias("changed")), "merkle-leaves")
    nodes = numbered(leaves, ["tree", "doc_id", "node"], ["tree"], "merkle-order")
    tables, tops = _climb(nodes, arity, "merkle")

    lang = field_value(F.col("tree"))
    subtrees = numbered(tops.select(F.lit("").alias("tree"), F.col("tree").alias("lang_tree"), "level", "node", lang.alias("lang")),
                        ["tree", "lang"], ["tree"], "merkle-subtrees")
    root_tables, root_tops = _climb(subtrees, arity, "merkle-root")
    found = root_tops.select(F.lower(F.hex("node"))).collect()  # one digest, or none for an empty table
    root = found[0][0] if found else ""
    if root_tables:
        end = root_tops.select("tree", "level", F.array().cast("array<struct<before:binary,behind:binary>>").alias("path"))
        above = _descend(root_tables, end, arity).select(F.col("lang_tree").alias("tree"), F.col("level"), "node", "path")
    else:
        above = subtrees.select(F.col("lang_tree").alias("tree"), "level", "node",
                                F.array().cast("array<struct<before:binary,behind:binary>>").alias("path"))
    above = save(above, "merkle-above")
    alone = nodes.where("size = 1").join(above.select("tree", "path"), "tree").select("tree", "doc_id", "node", "changed", "path")
    out = alone
    if tables:
        out = _descend(tables, above, arity).select("tree", "doc_id", "node", "changed", "path").unionAll(alone)
    out = out.join(few(above.select("tree", F.lower(F.hex("node")).alias("subroot"))), "tree")
    start = F.lower(F.hex(F.coalesce("changed", "node")))
    out = out.select("doc_id", F.lower(F.hex("node")).alias("leaf"), "subroot", F.lit(root).alias("root"),
                     proof_digest(F.col("path")).alias("proof_sha256"), fold(start, F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
