"""The prefix trie, the neighbour graph and the Merkle manifest against brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from conftest import SF
from hourlake.llm import merkle, neighbour_graph, prefix_trie
from hourlake.llm.order import numbered
from hourlake.llm.queries import QUERIES


@pytest.mark.parametrize("parts", [1, 5])
def test_places_in_order(spark, parts):
    rows = [(random.Random(k).choice("ab"), k % 7) for k in range(200)] + [("c", None)] + [("a", 3)] * 100
    df = spark.createDataFrame(rows, "tree string, v long").repartition(parts)
    got = {}
    for r in numbered(df, ["tree", "v"], ["tree"]).collect():
        got.setdefault(r.tree, []).append((r.place, r.v, r.size))
    for tree, found in got.items():
        found.sort()
        values = [v for t, v in rows if t == tree]
        assert [p for p, _, _ in found] == list(range(len(values))) and {s for _, _, s in found} == {len(values)}
        assert [v for _, v, _ in found] == sorted(values, key=lambda v: (v is not None, v))


# ------------------------------------------------------------------ conversations

def brute_trie(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((t is not None, t or 0, name, role, text))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    children, leaves, saved = ({p: 0 for p in nodes} for _ in range(3))
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1]) if p else 0
            leaves[p[:d]] += not children[p]
    ends = {p: ",".join(str(m) for m in sorted(m for m in ms if len(built[m]) == len(p))) for p, ms in nodes.items()}
    return sorted(((min(ms), len(p), min(nodes[p[:-1]]) if p else None, len(ms), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends[p].encode()).hexdigest()) for p, ms in nodes.items()), key=repr)


def messy_turns():
    rng = random.Random(3)
    shapes = [[0], [0, 1], [None, 1, 1], [0, 1, 2, 3, 4, 5, 6], list(range(9)), [2, 2, 2]]
    rows = [(c, t, rng.choice(["u", "a", None]), rng.choice(["x", "yy", "\u65e5\u672c", None, ""]), "extra")
            for c in [*range(-130, 260), None] for t in rng.choice(shapes)]
    rows += [(900 + k, 0, "u", "same", "extra") for k in range(60)]          # a large group of equal conversations
    rows.append(rows[0])
    rows.append((5000, 0, "u", "long " * 50_000, "extra"))
    return rows


@pytest.mark.parametrize("block", [2048, 16, 1])
def test_trie_matches_brute_force(spark, block):
    """Blocks of one conversation make every prefix cross an edge."""
    rows = messy_turns()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, block string").repartition(3)
    out = prefix_trie.trie(prefix_trie.rebuild(df), block)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute_trie([r[:4] for r in rows])
    assert prefix_trie.trie(prefix_trie.rebuild(df.limit(0)), block).count() == 0


def test_extents_match_a_scan():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 33):
        lcp = rng.integers(0, 4, n)
        lcp[0] = -1
        table = prefix_trie.sparse_table(lcp)
        at, depth = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(0, 5)))
        left, right = prefix_trie.extents(table, at, depth)
        for i, d, lo, hi in zip(at, depth, left, right):
            a = i
            while a > 0 and lcp[a] >= d:
                a -= 1
            b = i
            while b + 1 < n and lcp[b + 1] >= d:
                b += 1
            assert (lo, hi) == (a, b)
        values = rng.integers(0, 100, n)
        least = prefix_trie.range_min(prefix_trie.sparse_table(values), left, right)
        assert least.tolist() == [values[a:b + 1].min() for a, b in zip(left, right)]


# ------------------------------------------------------------------ documents

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows, arity):
    def enc(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, **other):
        return H(*[enc({**r, **other}[f]) for f in merkle.FIELDS])

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            x = levels[-1]
            levels.append([H(*x[i:i + arity]) for i in range(0, len(x), arity)])
        return levels

    def siblings(levels, i):
        for x in levels[:-1]:
            lo = i - i % arity
            yield x[lo:i], x[i + 1:lo + arity]
            i //= arity

    langs = {}
    for r in rows:
        langs.setdefault(r["lang"], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in order:
        some = sorted(langs[x], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[x] = some, climb([leaf(r) for r in some])
    top = climb([trees[x][1][-1][0] for x in order])
    out = []
    for j, x in enumerate(order):
        some, levels = trees[x]
        for i, r in enumerate(some):
            path = [*siblings(levels, i), *siblings(top, j)]
            changed = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None
            folded = leaf(r, n_chars=r["n_chars"] + 1) if changed else leaf(r)
            for before, behind in path:
                folded = H(*before, folded, *behind)
            proof = H(*[d for before, behind in path for d in (*before, *behind)])
            out.append((r["doc_id"], leaf(r), levels[-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("arity", [2, 3])
def test_manifest_matches_brute_force(spark, messy, empty, arity):
    rows = [r.asDict() for r in messy.collect()]
    out = merkle.manifest(messy, arity)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute_manifest(rows, arity)
    assert merkle.manifest(empty, arity).count() == 0
    one = messy.where("doc_id = 43")
    assert [tuple(r) for r in merkle.manifest(one, arity).collect()] == brute_manifest([r.asDict() for r in one.collect()], arity)


def test_a_changed_leaf_is_told(spark):
    got = QUERIES["op13_merkle_manifest"](spark, SF).collect()
    assert {r.verified for r in got} == {True, False} and len({r.root for r in got}) == 1
    for r in got:
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0)


# ------------------------------------------------------------------ vectors

def brute_nearest(rows, every=50, most=5):
    usable = [(i, np.array(v, float)) for i, v in rows
              if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for at, (i, v) in enumerate(usable):
        if i % every == 0:
            scores = [(-float(v @ w) / (math.sqrt(v @ v) * math.sqrt(w @ w)), j) for k, (j, w) in enumerate(usable)
                      if k != at and len(w) == len(v)]
            out.setdefault(i, []).append([(j, -s) for s, j in sorted((round(s, 12), j) for s, j in scores)[:most]])
    return out


def test_small_tables_are_searched_whole(spark):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(120)]
    rows += [(200 + k, rows[0][1]) for k in range(30)]                 # copies of a query's vector, more than it returns
    rows += [(300 + k, [2 * x for x in rows[1][1]]) for k in range(3)]  # parallel, not equal
    rows += [(1000, [1.0, 0.0, 2.0]), (1001, [1.0, 0.5, 2.0]), (1050, [1.0])]      # other lengths
    rows += [(400, None), (450, [0.0] * 8), (500, [float("nan")] + [1.0] * 7), (550, [None] + [1.0] * 7), (600, []), (650, [float("inf")] * 8)]
    rows += [(None, rows[3][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label string").repartition(3)
    want = brute_nearest(rows)
    got = {}
    for r in neighbour_graph.nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {q for q, found in want.items() if found[0]}
    for q, found in got.items():
        expected = want[q][0]
        assert [x[0] for x in found] == list(range(1, len(expected) + 1))
        assert [x[1] for x in found] == [j for j, _ in expected]
        assert np.allclose([x[2] for x in found], [s for _, s in expected], atol=1e-12)
    assert neighbour_graph.nearest(df.limit(0)).count() == 0


def test_recall_where_the_graph_is_searched(spark, monkeypatch):
    """More nodes than a pool holds: near copies, and vectors without any structure, which are the hardest. (Copies nearer
    to each other than int8 tells apart would have to fit a pool.)"""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(2500, 24))
    x[2000:] = x[0] + 0.2 * rng.normal(size=(500, 24))
    rows = [(k, v) for k, v in enumerate(x.tolist())]
    for name, value in (("POOL", 160), ("EXPAND", 32), ("BLOCK", 1024), ("SUB", 256), ("WINDOW", 128)):
        monkeypatch.setattr(neighbour_graph, name, value)
    got = {}
    for r in neighbour_graph.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute_nearest(rows)
    found = sum(len(got[q] & {j for j, _ in w[0]}) for q, w in want.items())
    assert set(got) == set(want) and found >= 0.95 * 5 * len(want)
