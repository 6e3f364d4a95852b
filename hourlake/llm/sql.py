"""The queries that SQL can express, as DuckDB runs them on the same tables."""

WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _window(n: int) -> str:
    """Word x and the n - 1 words behind it in its document."""
    return "concat_ws(' ', x, " + ", ".join(f"lead(x, {k}) OVER d" for k in range(1, n)) + ")"


OP1 = f"""
WITH d AS (SELECT doc_id, source, text, {WORDS.format('text')} AS w FROM documents),
places AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i, len(w) AS size FROM d),
starts AS (SELECT doc_id, i, size, {_window(8)} AS seq FROM places WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, seq) AS n FROM starts WHERE i + 7 <= size),
cover AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM windows WHERE n > 1) GROUP BY 1),
l AS (SELECT doc_id, source, text, line, {WORDS.format('line')} AS lw FROM (
  SELECT doc_id, source, text, unnest(str_split(coalesce(text, ''), chr(10))) AS line FROM documents)),
full_lines AS (SELECT doc_id, source, text, line, {LOWER.format("array_to_string(lw, ' ')")} AS norm, len(lw) AS n FROM l WHERE len(lw) > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY 1),
hosts AS (SELECT source, greatest(10, CAST(floor(count(*) * CAST(0.002 AS DOUBLE)) AS BIGINT)) AS most FROM documents GROUP BY 1),
common AS (SELECT f.source, f.norm FROM (SELECT source, norm, count(DISTINCT text) AS n FROM full_lines GROUP BY 1, 2) f
  JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source WHERE f.n > h.most),
gone AS (SELECT f.doc_id, sum(f.n) AS n FROM full_lines f JOIN common c ON f.norm = c.norm AND f.source IS NOT DISTINCT FROM c.source GROUP BY 1),
counts AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words,
  CAST(coalesce(gone.n, 0) AS BIGINT) AS removed_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN cover USING (doc_id) LEFT JOIN gone USING (doc_id)),
failed AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words - removed_words >= 20 AND n_words - removed_words >= 0.5 * n_words AS kept, removed_words
FROM failed
"""

OP3 = f"""
WITH d AS (SELECT doc_id, {WORDS.format('text')} AS w FROM documents),
places AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i, len(w) AS size FROM d),
starts AS (SELECT doc_id, i, size, {_window(20)} AS seq FROM places WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
windows AS (SELECT doc_id, i, row_number() OVER (PARTITION BY seq ORDER BY doc_id, i) AS place FROM starts WHERE i + 19 <= size),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM windows WHERE place > 1),
kept AS (SELECT p.doc_id, string_agg(p.x, ' ' ORDER BY p.i) AS text, count(*) AS n
  FROM places p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.j = p.i WHERE g.j IS NULL GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256 FROM d LEFT JOIN kept k USING (doc_id)
"""

_REACH = """
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(node, other) AS (SELECT a, a FROM both_ways UNION SELECT r.node, x.b FROM reach r JOIN both_ways x ON x.a = r.other),
top AS (SELECT node, min(other) AS component FROM reach GROUP BY 1)
"""

OP4 = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id < b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.9),
{_REACH},
degree AS (SELECT a, count(*) AS n FROM both_ways GROUP BY 1)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(component, vec_id) AS component_id,
  vec_id = coalesce(component, vec_id) AS kept
FROM embeddings LEFT JOIN degree ON degree.a = vec_id LEFT JOIN top ON top.node = vec_id
"""

OP6 = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
c AS (SELECT *, contains(role, '\') OR contains(role, ': ') OR contains(text, '\') OR contains(text, '</turn>') AS conflict FROM t),
n AS (SELECT *, 4 + length(role) + 2 + length(text) + 8 + CASE WHEN conflict
  THEN length(regexp_replace(role || text, '[^\\#:<]', '', 'g')) ELSE 0 END AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
"""

OP10 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(LOWER.format('text'))} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.o >= 75 * (x.n + y.n - p.o)),
{_REACH}
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(component, d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN top ON top.node = d.doc_id
"""

#: CRC-32 of the bytes of a decimal number, a bit at a time.
CRC32 = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST({} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda a, c: list_reduce(list_prepend(xor(a, c), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(f) for f in ("doc_id", "source", "lang", n_chars, "text")) + ")"


OP13 = f"""
WITH RECURSIVE l AS (SELECT doc_id, {_field('lang')} AS tree, lang, {_leaf('n_chars')} AS leaf,
  CASE WHEN n_chars IS NOT NULL AND {CRC32.format('doc_id')} % 7 = 0 THEN {_leaf('(CAST(n_chars AS HUGEINT) + 1)')} END AS changed FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS size FROM l),
up AS (SELECT 0 AS level, tree, place, size, leaf AS node FROM leaves
  UNION ALL SELECT level + 1, tree, place // 2, (size + 1) // 2, sha256(string_agg(node, '' ORDER BY place)) FROM up WHERE size > 1 GROUP BY level, tree, place // 2, size),
subs AS (SELECT u.tree, u.level, u.node, row_number() OVER (ORDER BY l.lang NULLS FIRST) - 1 AS place, count(*) OVER () AS size
  FROM up u JOIN (SELECT DISTINCT tree, lang FROM leaves) l USING (tree) WHERE u.size = 1),
top AS (SELECT 0 AS level, place, size, node FROM subs
  UNION ALL SELECT level + 1, place // 2, (size + 1) // 2, sha256(string_agg(node, '' ORDER BY place)) FROM top WHERE size > 1 GROUP BY level, place // 2, size),
sides AS (SELECT u.tree, u.level, u.place, s.node AS other FROM up u LEFT JOIN up s ON s.tree = u.tree AND s.level = u.level AND s.place = xor(u.place, 1) WHERE u.size > 1
  UNION ALL SELECT b.tree, b.level + t.level, NULL, o.node FROM subs b JOIN top t ON t.size > 1 AND t.place = b.place >> t.level
  LEFT JOIN top o ON o.level = t.level AND o.place = xor(t.place, 1)),
walk AS (SELECT leaves.doc_id, leaves.tree, leaves.leaf, leaves.place AS seat, b.level AS height, b.place AS branch, 0 AS level, '' AS proof, coalesce(changed, leaf) AS folded, leaves.place
    FROM leaves JOIN subs b USING (tree)
  UNION ALL SELECT w.doc_id, w.tree, w.leaf, w.seat, w.height, w.branch, w.level + 1, w.proof || coalesce(s.other, ''),
    CASE WHEN s.other IS NULL THEN sha256(w.folded)
      WHEN (CASE WHEN w.level < w.height THEN w.seat >> w.level ELSE w.branch >> (w.level - w.height) END) % 2 = 1 THEN sha256(s.other || w.folded) ELSE sha256(w.folded || s.other) END, w.place
    FROM walk w JOIN sides s ON s.tree = w.tree AND s.level = w.level AND (s.place IS NULL OR s.place = w.seat >> w.level)),
done AS (SELECT *, row_number() OVER (PARTITION BY tree, seat ORDER BY level DESC) AS last FROM walk),
root AS (SELECT node AS root FROM top WHERE size = 1)
SELECT d.doc_id, d.leaf, b.node AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM done d JOIN subs b USING (tree), root WHERE last = 1
"""

OP11 = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(sha256(strlen(role) || ':' || role || text) ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS names,
  list(length(text) ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS sizes FROM t GROUP BY 1),
h AS (SELECT *, {CRC32.format('conv_id')} % 6 AS h FROM own),
r AS (SELECT h.conv_id, coalesce(b.names[:h], []) || h.names[h + 1:] AS names, coalesce(b.sizes[:h], []) || h.sizes[h + 1:] AS sizes
  FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 100),
places AS (SELECT conv_id, names, sizes, unnest(range(0, len(names) + 1)) AS depth FROM r),
nodes AS (SELECT array_to_string(names[:depth], ' ') AS p, array_to_string(names[:greatest(depth - 1, 0)], ' ') AS up, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
  any_value(CASE WHEN depth > 0 THEN names[:depth - 1] END) AS above, (count(*) - 1) * coalesce(any_value(CASE WHEN depth > 0 THEN sizes[depth] END), 0) AS saved,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = len(names)), '')) AS ends_sha256 FROM places GROUP BY ALL),
kids AS (SELECT up AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
every AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (p)),
sums AS (SELECT a AS p, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT n_children, saved, unnest(list_append(list_transform(range(0, depth), lambda k: array_to_string(above[:k], ' ')), p)) AS a FROM every) GROUP BY 1)
SELECT e.conv_id, e.depth, CASE WHEN e.depth > 0 THEN u.conv_id END AS parent_conv_id, e.n_convs, e.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, e.ends_sha256
FROM every e JOIN sums USING (p) LEFT JOIN every u ON u.p = e.up AND u.depth = e.depth - 1
"""
