"""Operators on documents against brute force in plain Python, over messy rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hourlake.llm import (jaccard_join, language_id, lm_score, mixing, packing, quality_lines, substring_dedup, token_planes,
                          tokens, words)
from hourlake.session import scratch_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def split(text):
    return WORD.findall(text or "")


def plain_ids(text):
    from tokenizers import Tokenizer

    if not hasattr(plain_ids, "t"):
        plain_ids.t = Tokenizer.from_file(tokens.public_path())
    return [*plain_ids.t.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_and_windows():
    texts = ["a b  c\n", None, "", "é x y", " \x0b"]
    w = words.split_words(pa.array(texts, pa.string()))
    raw = w.data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(w.start, w.end)] == [x for t in texts for x in split(t)]
    assert w.count.tolist() == [len(split(t)) for t in texts]
    h = words.word_hashes(w)
    assert len(set(h.tolist())) == len(h)
    sliced = words.split_words(pa.array(["zz zz", *texts], pa.string()).slice(1))
    assert (words.word_hashes(sliced) == h).all()
    seq = np.array([1, 2, 1, 2, 1, 2, 3], np.uint64)
    for n in range(1, 8):
        got = words.window_hashes(seq, n)
        want = [tuple(seq[i: i + n]) for i in range(len(seq) - n + 1)]
        assert [[a == b for b in got] for a in got] == [[a == b for b in want] for a in want]


def test_base_counts_and_verdict(messy):
    got = quality_lines.judge(messy, limit_docs=3, limit_share=0.0).collect()
    assert len(got) == messy.count()
    texts = {}
    for r in messy.collect():
        texts.setdefault(r.source, set()).add(r.text)
    norm = lambda line: " ".join(split(line.encode().lower().decode("utf8")))
    held = {s: Counter(x for t in ts if t for x in {norm(y) for y in t.split("\n") if split(y)}) for s, ts in texts.items()}
    by_key = {}
    for r in messy.collect():
        t, w = r.text or "", split(r.text)
        seen, dup = set(), 0
        for line in t.split("\n"):
            if split(line):
                dup += line in seen
                seen.add(line)
        c = Counter(tuple(w[i: i + 8]) for i in range(len(w) - 7))
        cover = {j for i in range(len(w) - 7) if c[tuple(w[i: i + 8])] > 1 for j in range(i, i + 8)}
        gone = sum(len(split(y)) for y in t.split("\n") if split(y) and held[r.source][norm(y)] > 3)
        failed = len(w) < 20 or 100 * len(cover) > 30 * len(w)
        left = len(w) - gone
        by_key.setdefault(r.doc_id, []).append((len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover), failed,
                                                not failed and left >= 20 and left >= 0.5 * len(w), gone))
    mine = {}
    for r in got:
        mine.setdefault(r.doc_id, []).append((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed,
                                              r.kept, r.removed_words))
    assert {k: sorted(v) for k, v in mine.items()} == {k: sorted(v) for k, v in by_key.items()}


def test_lines_above_the_limit_go(spark):
    rows = [(k, f"Common  LINE here\nown {k} " + " ".join(f"u{k}x{j}" for j in range(30)), "h") for k in range(6)]
    rows += [(k, "common line here\n" + "common line here\n" * 8, "h") for k in (6,)] + [(9, rows[0][1], "h")] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    judged = quality_lines.judge(docs, limit_docs=6, limit_share=0.0)
    assert {r.removed_words for r in judged.where("doc_id < 6").collect()} == {3}
    cleaned = {r.text for r in quality_lines.clean(docs, judged).where("doc_id = 1").collect()}
    assert cleaned == {"own 1 " + " ".join(f"u1x{j}" for j in range(30))}
    # Copies of one text are one document: nothing is common below the limit.
    assert quality_lines.judge(docs.where("doc_id in (0, 9)"), limit_docs=2, limit_share=0.0).where("removed_words > 0").count() == 0


@pytest.mark.parametrize("base", [5, 20, 3])
def test_repeated_windows_match_brute_force(plain, base):
    seen, want = {}, []
    rows = sorted(plain.collect(), key=lambda r: r.doc_id)
    for r in rows:
        w = split(r.text)
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            key = tuple(w[i: i + 20])
            if key in seen:
                gone[i: i + 20] = [True] * 20
            seen.setdefault(key, r.doc_id)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want.append((r.doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = sorted(tuple(r) for r in substring_dedup.digest(plain, base=base).collect())
    assert got == want
    assert any(x[2] for x in want)
    texts = {r.doc_id: r.text for r in substring_dedup.remove_repeats(plain, base=base).collect()}
    for doc_id, _, n, sha in want:
        assert hashlib.sha256(" ".join(split(texts[doc_id])).encode()).hexdigest() == sha
        if not n:
            assert texts[doc_id] == next(r.text for r in rows if r.doc_id == doc_id)


def test_repeats_in_messy_rows(messy, empty):
    out = substring_dedup.digest(messy)
    assert out.count() == messy.count()
    assert substring_dedup.remove_repeats(messy).columns == messy.columns
    # A repeated row is no earlier than its twin; a null doc_id is later than all others.
    assert {r.n_removed for r in out.where("doc_id = 3").collect()} == {120}
    assert max(r.n_removed for r in out.where("doc_id is null").collect()) == 120
    assert substring_dedup.digest(empty).count() == 0


def jaccard_sets(rows):
    out = []
    for r in rows:
        w = [x.encode().lower() for x in split(r.text)]
        out.append({tuple(w[i: i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def reachable(nodes, links):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_jaccard_groups_and_links_match_brute_force(plain):
    rows = plain.collect()
    sets = jaccard_sets(rows)
    pairs = [(a.doc_id, b.doc_id) for i, a in enumerate(rows) for j, b in enumerate(rows[:i])
             if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    top = reachable([r.doc_id for r in rows], pairs)
    want = sorted((r.doc_id, len(s), top[r.doc_id]) for r, s in zip(rows, sets))
    assert sorted(tuple(r) for r in jaccard_join.groups(plain).collect()) == want
    found, member = jaccard_join.links(plain)
    of = {}
    for r in member.collect():
        of.setdefault(r["class"], []).append(r.doc_id)
    of.pop(None)
    got = {tuple(sorted((x, y))) for r in found.collect() for x in of[r.a] for y in of[r.b]}
    got |= {(x, y) for ids in of.values() for x in ids for y in ids if x < y}
    assert got == {tuple(sorted(p)) for p in pairs}


def test_jaccard_messy_and_empty(messy, empty):
    out = jaccard_join.groups(messy)
    assert out.count() == messy.count()
    base = {r.component_id for r in out.where("doc_id in (0, 3, 6)").collect()}
    assert base == {0}
    assert {r.component_id for r in out.where("doc_id is null and n_shingles > 50").collect()} == {0}
    assert {(r.n_shingles, r.component_id) for r in out.where("doc_id in (40, 41, 42)").collect()} == {(0, 40), (0, 41), (0, 42)}
    assert jaccard_join.groups(empty).count() == 0


def test_jaccard_order_keeps_links_whatever_is_common():
    rng = np.random.default_rng(3)
    for _ in range(200):
        pool = np.unique(rng.integers(0, 1 << 63, 60, dtype=np.uint64))
        a, b = (np.sort(rng.choice(pool, rng.integers(1, 50), replace=False)) for _ in range(2))
        common = np.sort(rng.choice(pool, 20, replace=False))
        if jaccard_join.alike(a, b):
            assert set(jaccard_join.first_grams(a, common).tolist()) & set(jaccard_join.first_grams(b, common).tolist())
            n, part = np.array([len(a), len(b)]), np.array([0, 1])
            maps = jaccard_join.Bitmaps(pa.array([jaccard_join.bitmap(a), jaccard_join.bitmap(b)], pa.binary()))
            i, _ = jaccard_join.tile_pairs(n, part, maps, np.arange(2), part, False)
            assert len(i) == 1 and len(jaccard_join.couples(n, part, maps, np.array([0]))) == 1
    both = len(set(a.tolist()) & set(b.tolist()))
    assert jaccard_join.alike(a, b) == (100 * both >= 75 * (len(a) + len(b) - both))


def test_tiles_of_bitmaps_match_pair_by_pair():
    rng = np.random.default_rng(6)
    sets = []
    for k in range(150):
        base = rng.integers(0, 1 << 63, rng.integers(1, 400), dtype=np.uint64) if k % 3 == 0 else sets[-1]
        keep = rng.random(len(base)) < 0.95
        sets.append(np.unique(np.concatenate([base[keep], rng.integers(0, 1 << 63, 1 + len(base) // 30, dtype=np.uint64)])))
    n, part, side = np.array([len(x) for x in sets]), np.arange(150) % 40, np.arange(150) % 2
    maps = jaccard_join.Bitmaps(pa.array([jaccard_join.bitmap(x) for x in sets], pa.binary()))
    for crossing in (False, True):
        a, b = jaccard_join.tile_pairs(n, part, maps, np.arange(150), side, crossing)
        got = {tuple(sorted(x)) for x in zip(a.tolist(), b.tolist())}
        assert len(got) == len(a)
        for i in range(150):
            for j in range(i):
                may = part[i] != part[j] and (not crossing or side[i] != side[j])
                if may and jaccard_join.alike(sets[i], sets[j]):
                    assert (j, i) in got
                if (j, i) in got:
                    assert may and 100 * min(n[i], n[j]) >= 75 * max(n[i], n[j])


def test_tokens_equal_the_library(messy):
    texts = [r.text for r in messy.collect()] + [" lead", "tail ", "a  b", "x  y", "don't", "\n\nq r", "a \n b"]
    got = tokens.encode_column(pa.array(texts, pa.string()), tokens.public_path())
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [plain_ids(t) for t in texts]


def test_tokens_of_odd_white_space_and_signs():
    rng = random.Random(1)
    signs = [" ", " ", "\n", "\t", "a", "b", "'s", "é", "日", "\u00a0", "\u2003", ".", "1", "<|endoftext|>", "\x1c", "\r", "ñandú", "word", "\u0085"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    for _ in range(2):  # unknown units, then known ones
        got = tokens.encode_column(pa.array(texts, pa.string()), tokens.public_path())
        assert [np.frombuffer(x, "<u2").tolist() for x in got] == [plain_ids(t) for t in texts]


def test_special_tokens_are_tokens():
    texts = ["x <|endoftext|> y", "<|endoftext|>", None, "a<|endoftext|><|endoftext|> b\n<|endoftext|>", "<|endoftext", "|>", "x  y", " <|ENDOFTEXT|>",
             "word " * 3000 + "<|endoftext|>" + " word" * 3000]
    for column in (pa.array(texts, pa.string()), pa.array(["q", *texts], pa.string()).slice(1)):
        for _ in range(2):  # with a cache, too
            got = tokens.encode_column(column, tokens.public_path())
            assert [np.frombuffer(g, tokens.id_type(tokens.public_path())).tolist() for g in got] == [plain_ids(t) for t in texts]
    assert plain_ids("x <|endoftext|> y")[:3] == [87, 220, 50256]
    tokens.forget()


def test_units_are_learned_once_and_words_end_before_signs(monkeypatch):
    """Known units, with whatever signs behind them, are looked up; a cache that is full is emptied and goes on right."""
    rng = random.Random(5)
    signs = ["a", "Zebra", "t", "re", "'", "'s", "'re", ",", "...", "$", "9", "42", " ", "  ", "\n", "-", "@", "[", "`", "{", "~", "_", "é", "ñ", "日", "\u00a0", "\t"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 12))) for _ in range(6000)]
    want = [plain_ids(t) for t in texts]
    for most in (tokens.CACHE_UNITS, 50):
        monkeypatch.setattr(tokens, "CACHE_UNITS", most)
        tokens.forget()
        for some in (slice(0, 6000), slice(0, 3000), slice(3000, 3010), slice(2000, 6000)):
            got = tokens.encode_column(pa.array(texts[some], pa.string()), tokens.public_path())
            assert [np.frombuffer(x, "<u2").tolist() for x in got] == want[some]
    tokens.forget()
    learn, asked = tokens._learn, []
    monkeypatch.setattr(tokens, "CACHE_UNITS", 1000)
    monkeypatch.setattr(tokens, "_learn", lambda state, data, begin, *rest: asked.append(len(begin)) or learn(state, data, begin, *rest))
    for text in ("one word", "one word, one word. One, word!", "word, word. one"):
        tokens.encode_column(pa.array([text]), tokens.public_path())
    assert asked == [2, 5, 1]  # "one", " word"; ",", " one", ".", " One", "!"; "word"
    tokens.forget()


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_token_files_round_trip(spark, messy, empty, planes):
    path = scratch_dir(spark, "test-planes")
    token_planes.write_token_files(messy, path, planes=planes, block=1000)
    rows = sorted(token_planes.read_token_files(spark, path, with_ids=True).collect(), key=lambda r: r.start)
    given = messy.collect()
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in given), key=lambda x: (x is not None, x or 0))
    start = 0
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
    assert sorted((r.doc_id or -1, r.ids_crc32) for r in rows) == sorted((r.doc_id or -1, crc(plain_ids(r.text))) for r in given)
    path = scratch_dir(spark, "test-planes")
    token_planes.write_token_files(empty, path, planes=planes)
    assert token_planes.read_token_files(spark, path).count() == 0


def test_token_files_of_a_hot_id_and_large_numbers(spark, tmp_path_factory):
    """A third of all rows without an id need not share a file; files go by number, not by name."""
    rows = [(None, f"text {k} " * 20) for k in range(200)] + [(k, f"other {k}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = str(tmp_path_factory.mktemp("run-planes")) + "/files"
    token_planes.write_token_files(docs, path, file_bytes=2_000)
    got = token_planes.read_token_files(spark, path).collect()
    assert len({r.file for r in got if r.doc_id is None}) > 1 and len({r.file for r in got}) > 8
    import os
    names = sorted(n for n in os.listdir(path) if n.startswith("part-") and os.path.getsize(f"{path}/{n}"))
    for n in names:  # as names are beyond 99,999 tasks
        os.rename(f"{path}/{n}", f"{path}/" + n.replace(n[:10], f"part-{99_997 + int(n[5:10])}", 1))
        if os.path.exists(f"{path}/.{n}.crc"):
            os.rename(f"{path}/.{n}.crc", f"{path}/." + n.replace(n[:10], f"part-{99_997 + int(n[5:10])}", 1) + ".crc")
    again = token_planes.read_token_files(spark, path).collect()
    starts = lambda found: sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found), key=repr)
    assert starts(again) == starts(got)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))


def test_planes_of_both_widths():
    for kind in ("<u2", "<u4"):
        ids = np.random.default_rng(1).integers(0, 50_000, 1003).astype(kind)
        for bits in (True, False):
            planes = token_planes.to_planes(ids, bits)
            assert len(planes) == ids.dtype.itemsize * (8 if bits else 1)
            assert (token_planes.from_planes(planes, len(ids), ids.dtype.itemsize) == ids).all()


def check_packing(docs, pieces, length):
    by_doc = {}
    for r in docs.collect():
        ids = plain_ids(r.text)
        by_doc.setdefault((r.doc_id, len(ids)), []).append(ids)
    spans, places = {}, {}
    for r in pieces:
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
        assert any(np.frombuffer(r.ids, "<u4").tolist() == x[r.start: r.start + r.length] for x in by_doc[r.doc_id, r.doc_tokens])
        spans.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for key, ids in by_doc.items():
        cover = Counter(k for s, n in spans[key] for k in range(s, s + n))
        assert set(cover) == set(range(key[1])) and set(cover.values()) == {len(ids)}
    total = sum(k[1] * len(v) for k, v in by_doc.items())
    assert sorted(places) == list(range(-(-total // length)))
    for k, x in places.items():
        at = 0
        for offset, n in sorted(x):
            assert offset == at
            at += n
        assert at == (length if k < len(places) - 1 else total - length * k)


@pytest.mark.parametrize("segment", [1 << 20, 3000])
def test_packing_places_every_id_once(messy, empty, segment):
    pieces = packing.pack(messy, length=256, segment_ids=segment).collect()
    check_packing(messy, pieces, 256)
    total = sum(r.length for r in pieces)
    share = Counter()
    for r in pieces:
        share[r.source] += r.length
    windows = Counter((r.sequence_id, r.source) for r in pieces for _ in range(r.length))
    last = max(r.sequence_id for r in pieces)
    # Each window holds the mixture to within the deficits that sources can carry.
    for s, n in share.items():
        for k in range(last):
            assert abs(windows[k, s] - 256 * n / total) <= len(share) + 1
    assert packing.pack(empty).count() == 0
    ids = packing.sequences(packing.pack(messy, length=256).where("sequence_id = 0")).first().ids
    first = sorted((r for r in pieces if r.sequence_id == 0), key=lambda r: r.offset)
    if segment == 1 << 20:
        assert ids == [x for r in first for x in np.frombuffer(r.ids, "<u4").tolist()]


def test_mixing_meets_its_targets(plain, messy, empty):
    got = mixing.mix(plain).collect()
    size = {r.doc_id: len(split(r.text)) for r in plain.collect()}
    assert {r.doc_id: r["size"] for r in got} == size
    sums, taken = Counter(), Counter()
    for r in got:
        sums[r.source] += r["size"]
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
    names = sorted((s for s in sums if s is not None)) + [None] * (None in sums)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    capped = set()
    while True:
        rest = sum(sums.values()) - sum(3 * sums[s] for s in capped)
        level = rest / sum(weight[s] for s in names if s not in capped)
        new = {s for s in names if s not in capped and level * weight[s] > 3 * sums[s] + 1e-9}
        if not new:
            break
        capped |= new
    for r in got:
        want = 3 * sums[r.source] if r.source in capped else level * weight[r.source]
        assert r.source_size == sums[r.source] and math.isclose(r.target, want, rel_tol=1e-9)
    for s in names:
        sizes = [r["size"] for r in got if r.source == s and r["size"]]
        want = next(r.target for r in got if r.source == s)
        assert abs(taken[s] - want) <= min(sizes)
        # The rates solve the balance: they give the target exactly, and tilt with size alone.
        rates = [(r["size"], r.rate) for r in got if r.source == s and r["size"]]
        assert math.isclose(sum(a * b for a, b in rates), want, rel_tol=1e-6)
        tilt = {round(math.log(b) / a, 9) for a, b in rates if 1e-12 < b < 3 - 1e-9}
        assert len(tilt) <= 1
    again = mixing.mix(plain.repartition(7)).collect()
    assert sorted((r.doc_id, r.copies) for r in again) == sorted((r.doc_id, r.copies) for r in got)
    mixed = mixing.mix(messy)
    assert mixed.count() == messy.count()
    copies = mixing.repeat(messy, mixed)
    assert copies.columns == messy.columns and copies.count() == mixed.agg(F.sum("copies")).first()[0]
    assert mixing.mix(empty).count() == 0


def test_language_is_learned_from_bytes(spark, messy, empty):
    rng = np.random.default_rng(0)
    parts = {"xx": ["lo", "mi", "ra", "sol"], "yy": ["krz", "szt", "bry", "oww"], "zz": ["aée", "éau", "uèi", "oçi"]}
    rows = []
    for k in range(600):
        lang = sorted(parts)[k % 3]
        rows.append((k, " ".join("".join(rng.choice(parts[lang], 3)) for _ in range(rng.integers(3, 80))), lang))
    rows += [(1000, None, "xx"), (1001, "12 !?", "yy"), (1002, "", None), (None, rows[0][1], "zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert len(got) == len(rows)
    held = [k for k in range(600) if zlib.crc32(str(k).encode()) % 4 == 2]
    assert {k for k, r in got.items() if r.held_out} == set(held) | {k for k in (1000, 1001, 1002) if zlib.crc32(str(k).encode()) % 4 == 2}
    assert np.mean([got[k].lang_pred == rows[k][2] for k in held]) > 0.97
    assert [got[k].lang_pred for k in (1000, 1001, 1002)] == ["und"] * 3 and all(0 <= r.score <= 1 for r in got.values())
    # Nothing is learned from held-out labels.
    wrong = docs.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    assert sorted((r.doc_id or -1, r.lang_pred) for r in language_id.identify(wrong).collect()) == sorted(
        (k or -1, r.lang_pred) for k, r in got.items())
    assert language_id.identify(empty).count() == 0
    assert language_id.identify(messy).count() == messy.count()


def test_language_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(2)
    w = {k: v.astype(np.float64) for k, v in language_id.start_weights(3, 4).items()}
    x, y = rng.integers(0, 257, (7, 5)), rng.integers(0, 3, 5)
    _, grad = language_id.gradients(w, x, y)
    for k in w:
        at = np.unravel_index(np.abs(grad[k]).argmax(), grad[k].shape)
        ends = []
        for step in (1e-3, -1e-3):
            moved = {n: v.copy() for n, v in w.items()}
            moved[k][at] += step
            ends.append(language_id.gradients(moved, x, y)[0])
        assert math.isclose((ends[0] - ends[1]) / 2e-3, grad[k][at], rel_tol=0.02, abs_tol=1e-5)


def test_language_model_prefers_the_corpus(spark, messy, empty):
    rng = np.random.default_rng(4)
    order = [f"t{k}" for k in range(30)]
    rows = [(k, " ".join(order[(k + j) % 30] for j in range(80))) for k in range(200)]
    rows += [(900, " ".join(rng.permutation(order).tolist() * 2)), (901, None), (902, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in lm_score.score(docs).collect()}
    assert got[0].n_tokens == 80 and got[0].mean_log_prob > got[900].mean_log_prob + 1
    assert (got[901].n_tokens, got[901].log_likelihood, got[901].mean_log_prob) == (0, 0.0, None) == tuple(got[902])[1:]
    assert lm_score.score(messy).count() == messy.count()
    assert lm_score.score(empty).count() == 0


def test_language_model_scores_one_by_one(spark):
    docs = spark.createDataFrame([(k, f"a b c{k % 7} d a e") for k in range(50)], "doc_id long, text string")
    counts = lm_score.corpus_counts(docs)
    assert {r.n for r in counts.collect()} >= {100, 50} and counts.agg(F.sum("n")).first()[0] == 300
    hashes, rank, sizes = lm_score.vocabulary(counts)
    w = words.split_words(pa.array(["a b zq", ""], pa.string()), lower=True)
    classes = lm_score.token_classes(w, (hashes, rank))
    assert classes[0] == 0 and classes[2] >= lm_score.GROUPS * lm_score.PER_GROUP - lm_score.ENDINGS
    around = lm_score.contexts(classes, w.first)
    edge = lm_score.GROUPS * lm_score.PER_GROUP
    assert around.tolist() == [[edge, edge, classes[1], classes[2]], [edge, classes[0], classes[2], edge], [classes[0], classes[1], edge, edge]]
    weights = lm_score.start_weights()
    for a, t in zip(around, classes):
        every = np.array([lm_score.log_probabilities(weights, a[None], np.array([k]))[0] for k in range(edge)])
        assert math.isclose(np.exp(every).sum(), 1, rel_tol=1e-5)
