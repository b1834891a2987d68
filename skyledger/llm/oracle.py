"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from skyledger.llm import licenses
from skyledger.llm.queries import BEST, CAP, WEIGHTS

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6 = f"""
WITH d AS (SELECT doc_id, sha256({LOWER}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


def mixing_sql(documents: str = "documents", columns: str = "doc_id, size, source_size, target, taken") -> str:
    """Targets by water filling; copies in order of the hash; the border document in part."""
    weight = f"list_extract([{', '.join(map(str, WEIGHTS))}], ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::INT)"
    return f"""
WITH d AS (
  SELECT *, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM {documents}),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, {weight}::BIGINT AS weight, {CAP}.0::DOUBLE * source_size AS lim FROM s),
f AS (SELECT *, lim / weight AS fill, sum(source_size) OVER () AS total FROM w),
l AS (
  SELECT *, (total - coalesce(sum(lim) OVER (ORDER BY fill, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / sum(weight) OVER (ORDER BY fill, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level FROM f),
t AS (
  SELECT source, source_size, least(lim, (SELECT max(level) FROM l) * weight) AS target FROM l),
r AS (
  SELECT d.*, t.source_size, t.target,
    floor(CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 1 END + 1e-9)::BIGINT AS whole
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, round(target)::BIGINT - sum(whole * size) OVER (PARTITION BY source) -
    (sum(size) OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size) AS remaining FROM r),
x AS (
  SELECT *, CASE WHEN whole >= {CAP} THEN 0 ELSE greatest(0, least(size, remaining)) END::BIGINT AS extra FROM c),
y AS (
  SELECT *, (whole * size + extra)::BIGINT AS taken,
    (whole + CASE WHEN size > 0 THEN floor(extra / size + 0.5) ELSE 0 END)::BIGINT AS copies FROM x)
SELECT {columns} FROM y
"""


def licenses_sql() -> str:
    def words(w):
        return f"string_split('{' '.join(w)}', ' ')"

    templates = licenses.TEMPLATES
    each = list(enumerate(templates))
    columns = lambda form: ",\n  ".join(form(i, t) for i, t in each)
    rare = lambda i, t: (
        f"CASE WHEN list_has_all(w, {words(t.key_words)}) THEN list_filter(ranked, lambda x: list_contains({words(t.words)}, x)"
        f" AND list_contains(w, x))[1:{licenses.RARE}] ELSE [] END AS r{i}")
    implied = lambda i, t: (
        f"list_sort(flatten(list_transform(r{i}, lambda r: list_distinct(flatten(list_transform("
        f"list_filter(range({len(t.words)}), lambda o: {words(t.words)}[o + 1] = r), lambda o: list_transform("
        f"list_filter(range(len(w)), lambda p: w[p + 1] = r), lambda p: p - o))))))) AS s{i}")
    agreed = lambda i, t: f"list_distinct(list_filter(s{i}, lambda s, j: j > 1 AND s{i}[j - 1] = s)) AS c{i}"
    stands = lambda t: " AND ".join(
        f"len(list_filter(range(greatest(s + {at - t.slack}, 0), least(s + {at + t.slack}, len(w) - {len(key)}) + 1),"
        f" lambda q: w[q + 1:q + {len(key)}] = {words(key)})) > 0" for at, key in t.keys)
    verified = lambda i, t: f"list_filter(c{i}, lambda s: {stands(t)}) AS t{i}"
    shares = ",\n  ".join(
        f"coalesce(list_max(list_transform(t{i}, lambda s: len(list_filter(range({len(t.words)}), lambda k: s + k >= 0"
        f" AND w[s + k + 1] = {words(t.words)}[k + 1])) / {len(t.words)}.0::DOUBLE)), 0.0)" for i, t in each)
    base = [i for i, t in each if t.base]
    label = lambda ids: "[" + ", ".join(f"CASE WHEN len(t{i}) > 0 THEN '{templates[i].label}' END" for i in ids) + "]"
    joined = lambda ids: f"coalesce(array_to_string(list_sort(list_distinct(list_filter({label(ids)}, lambda x: x IS NOT NULL))), ','), '')"
    return rf"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex({LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
f AS (
  SELECT word, count(*) AS df FROM (SELECT unnest(list_distinct(w)) AS word FROM d)
  WHERE list_contains({words(sorted({w for t in templates for w in t.words}))}, word) GROUP BY word),
k AS (SELECT coalesce(list(word ORDER BY df, word), []) AS ranked FROM f),
r AS (SELECT doc_id, w, {columns(rare)} FROM d, k),
s AS (SELECT doc_id, w, {columns(implied)} FROM r),
c AS (SELECT doc_id, w, {columns(agreed)} FROM s),
p AS (SELECT doc_id, w, {columns(verified)} FROM c),
b AS (SELECT *, {' || '.join(f't{i}' for i in base)} AS bases FROM p)
SELECT doc_id, len(w)::BIGINT AS n_words, len(bases)::BIGINT AS n_base,
  list_min(bases)::BIGINT AS first_word, list_max(bases)::BIGINT AS last_word,
  {joined(base)} AS base_labels, {joined([i for i, _ in each])} AS labels,
  greatest(0.0::DOUBLE, {shares})::DOUBLE AS score
FROM b
"""


OP3 = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


def _tree(nodes: str, name: str, keys: str) -> str:
    """Levels of trees of fan three over ``nodes`` (keys, i, h) as the CTE ``name`` (keys, lvl, i, h, n)."""
    return f"""
{name} AS (
  SELECT {keys}, 0 AS lvl, i, h, count(*) OVER (PARTITION BY {keys}) AS n FROM {nodes}
  UNION ALL
  SELECT {keys}, lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 2) // 3)
  FROM {name} WHERE n > 1 GROUP BY {keys}, lvl, i // 3)"""


def _leaf(text: str) -> str:
    fields = [f"coalesce(octet_length(encode({v}))::VARCHAR || ':' || {v}, '-')" for v in (
        "doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)]
    return f"sha256({' || '.join(fields)})"


#: The low bit of a crc32 by its shift register, eight steps a digit.
CRC_EVEN = """list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda a, b: CASE WHEN xor(a, b) & 1 = 1 THEN xor(xor(a, b) >> 1, 3988292384) ELSE xor(a, b) >> 1 END) & 1 = 1"""

OP11 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('x' || source, '') AS tree, {_leaf('text')} AS leaf,
    CASE WHEN {CRC_EVEN} THEN {_leaf("replace(text, chr(10), '')")} END AS forged FROM documents),
leaves AS (SELECT *, leaf AS h, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS i FROM d),
{_tree('leaves', 'low', 'tree')},
subroots AS (SELECT 0 AS top, tree, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS i FROM low WHERE n = 1),
{_tree('subroots', 'high', 'top')},
steps AS (
  SELECT l.doc_id, l.i AS leaf_i, l.tree, lvl AS step, b.i AS place, b.h FROM leaves l JOIN low b ON b.tree = l.tree AND b.n > 1
    AND b.i // 3 = l.i // (3 * (3 ** b.lvl)::BIGINT) AND b.i <> l.i // (3 ** b.lvl)::BIGINT
  UNION ALL
  SELECT l.doc_id, l.i, l.tree, 1000 + lvl, b.i, b.h FROM leaves l JOIN subroots s ON s.tree = l.tree JOIN high b ON b.n > 1
    AND b.i // 3 = s.i // (3 * (3 ** b.lvl)::BIGINT) AND b.i <> s.i // (3 ** b.lvl)::BIGINT),
proofs AS (SELECT doc_id, leaf_i, tree, sha256(string_agg(h, '' ORDER BY step, place)) AS proof FROM steps GROUP BY ALL),
levels AS (
  SELECT tree, -1 AS top, lvl, any_value(n) AS n FROM low WHERE n > 1 GROUP BY ALL
  UNION ALL SELECT t.tree, 0, 1000 + lvl, any_value(n) FROM high, (SELECT DISTINCT tree FROM d) t WHERE n > 1 GROUP BY ALL),
runs AS (
  SELECT v.tree, l.doc_id, l.i AS leaf_i, v.lvl AS step, row_number() OVER (PARTITION BY l.tree, l.i ORDER BY v.lvl) AS k,
    CASE WHEN v.top = 0 THEN s.i // (3 ** (v.lvl - 1000))::BIGINT ELSE l.i // (3 ** v.lvl)::BIGINT END AS place
  FROM leaves l JOIN levels v ON v.tree = l.tree JOIN subroots s ON s.tree = l.tree),
sides AS (
  SELECT r.tree, r.leaf_i, r.k,
    coalesce(string_agg(s.h, '' ORDER BY s.place) FILTER (s.place < r.place), '') AS lefts,
    coalesce(string_agg(s.h, '' ORDER BY s.place) FILTER (s.place > r.place), '') AS rights
  FROM runs r LEFT JOIN steps s ON s.tree = r.tree AND s.leaf_i = r.leaf_i AND s.step = r.step GROUP BY ALL),
folded AS (
  SELECT tree, i AS leaf_i, 0 AS k, coalesce(forged, leaf) AS h FROM leaves
  UNION ALL
  SELECT f.tree, f.leaf_i, f.k + 1, sha256(s.lefts || f.h || s.rights)
  FROM folded f JOIN sides s ON s.tree = f.tree AND s.leaf_i = f.leaf_i AND s.k = f.k + 1),
ends AS (SELECT tree, leaf_i, arg_max(h, k) AS h FROM folded GROUP BY ALL),
root AS (SELECT h FROM high WHERE n = 1)
SELECT l.doc_id, l.leaf, s.h AS subroot, root.h AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
  e.h AS folded_root, e.h = root.h AS verified
FROM leaves l JOIN subroots s ON s.tree = l.tree JOIN ends e ON e.tree = l.tree AND e.leaf_i = l.i
  LEFT JOIN proofs p ON p.tree = l.tree AND p.leaf_i = l.i, root
"""


def search_sql(k: int) -> str:
    """Every document scored for every item, from counts of all terms."""
    terms = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms} AS w FROM documents),
s AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0),
m AS (SELECT r, 50 + ((50 * len(w)::BIGINT * docs) // total) AS m FROM d, s WHERE len(w) > 0),
p AS (SELECT r, doc_id, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, unnest(w) AS term FROM d) GROUP BY ALL),
t AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM p, s GROUP BY term),
q AS (SELECT DISTINCT b, item_id, term FROM (
  SELECT row_number() OVER () AS b, item_id, unnest({terms}) AS term FROM benchmark)),
x AS (
  SELECT b, item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM q JOIN t USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY b ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM x WHERE score > 0 QUALIFY rank <= {k}
"""


def all_sql() -> dict[str, str]:
    return {
        "op3_neighbours": OP3,
        "op5_mixing": mixing_sql(),
        "op6_exact_dedup": OP6,
        "op9_licenses": licenses_sql(),
        "op11_merkle": OP11,
        "op12_ranked_search": search_sql(BEST),
    }
