"""The queries that SQL can express, for DuckDB, written apart from the Spark code."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _low(c: str) -> str:
    return f"translate(coalesce({c}, ''), '{_UPPER}', '{_LOWER}')"


def _words(c: str, separators: str) -> str:
    return f"list_filter(string_split_regex({_low(c)}, '{separators}'), lambda x: x <> '')"


_PLAIN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = r"[\x20\x09-\x0D]+"

_URLS = f"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m AS (SELECT page_id, host, path, rules.h || p AS rule, v,
    ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY length(rules.h || p) DESC NULLS LAST) AS nth
  FROM h LEFT JOIN rules ON (host = rules.h OR ends_with(host, '.' || rules.h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN host = '' THEN 'block' ELSE 'allow' END) AS verdict
FROM m WHERE nth = 1
"""

_TOP = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

_LEAKS = f"""
WITH d AS (SELECT doc_id, {_words('text', _PLAIN)} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words('text', _PLAIN)} AS w FROM benchmark),
windows AS (SELECT DISTINCT item, n, array_to_string(w[i + 1 : i + n], ' ') AS g FROM (
  SELECT item, w, least(10, len(w)) AS n, unnest(range(greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
places AS (SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS g FROM (
  SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item FROM places JOIN windows USING (n, g)),
marked AS (SELECT doc_id, COUNT(DISTINCT spot) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS spot FROM hits) GROUP BY 1),
items AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (
  SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked ON d.doc_id = marked.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""

_JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words('text', _SPACED)} AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 5], ' ') AS g FROM (
    SELECT doc_id, w, unnest(range(greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, COUNT(*) AS n FROM g GROUP BY 1),
same AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS (SELECT a, b FROM same JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT a AS doc_id, a AS other FROM both_ways UNION
  SELECT reached.doc_id, both_ways.b FROM reached JOIN both_ways ON reached.other = both_ways.a),
smallest AS (SELECT doc_id, MIN(other) AS least FROM reached GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(least, d.doc_id) AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN smallest ON d.doc_id = smallest.doc_id
"""

_ARCHIVES = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT page_id, html, strlen(html) AS n, MIN(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, n AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""

def _crc32(c: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, bit by bit."""
    byte = f"CAST('0x' || substr(hex(encode({c})), 2 * i + 1, 2) AS BIGINT)"
    data = f"list_transform(range(octet_length(encode({c}))), lambda i: {byte})"
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda c, b: {bits}), 4294967295)"


_TRIE = rf"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL),
given AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS steps
  FROM turns GROUP BY conv_id),
cut AS (SELECT conv_id, steps, {_crc32('CAST(conv_id AS VARCHAR)')} % 4 AS h FROM given),
rebuilt AS (SELECT cut.conv_id, list_concat(coalesce(base.steps[1:h], []), cut.steps[h + 1:]) AS steps
  FROM cut LEFT JOIN given base ON base.conv_id = cut.conv_id - cut.conv_id % 20),
prefixes AS (SELECT conv_id, len(steps) AS n, d, steps[1:d] AS prefix, md5(CAST(to_json(steps[1:d]) AS VARCHAR)) AS node,
    CASE WHEN d > 0 THEN md5(CAST(to_json(steps[1:d - 1]) AS VARCHAR)) END AS parent
  FROM (SELECT conv_id, steps, unnest(range(len(steps) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT node, d, any_value(parent) AS parent, any_value(prefix) AS prefix, MIN(conv_id) AS conv_id,
    COUNT(*) AS n_convs, COUNT(*) FILTER (n > d) AS longer,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends
  FROM prefixes GROUP BY node, d),
costs AS (SELECT *, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(list_filter(string_split_regex(prefix[d].text,
    '{_SPACED}'), lambda x: x <> '')) END AS cost FROM nodes),
above AS (SELECT cost, longer, md5(CAST(to_json(prefix[1:k]) AS VARCHAR)) AS node
  FROM (SELECT *, unnest(range(d + 1)) AS k FROM costs)),
sums AS (SELECT node, SUM(cost) AS saved, COUNT(*) FILTER (longer = 0) AS leaves FROM above GROUP BY node),
children AS (SELECT parent AS node, COUNT(*) AS n FROM nodes GROUP BY parent)
SELECT nodes.conv_id, nodes.d AS depth, up.conv_id AS parent_conv_id, nodes.n_convs, coalesce(children.n, 0) AS n_children,
  sums.leaves AS n_leaves, CAST(sums.saved AS BIGINT) AS saved_tokens, nodes.ends AS ends_sha256
FROM nodes JOIN sums USING (node) LEFT JOIN children USING (node) LEFT JOIN nodes up ON up.node = nodes.parent
"""

_SPELLING = f"""
WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]{{7,}}')) AS run FROM documents),
low AS (SELECT doc_id, translate(run, '{_UPPER}', '{_LOWER}') AS run FROM runs),
per AS (SELECT doc_id, run, COUNT(*) AS n FROM low GROUP BY doc_id, run),
hashed AS (SELECT run, n, {_crc32("CAST(doc_id AS VARCHAR) || ':' || run")} AS h FROM per),
cut AS (SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM hashed),
words AS (SELECT word, CAST(SUM(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING SUM(n) >= 2),
without AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS near, b.n AS m FROM without a JOIN without b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN without b ON a.word = b.rest
  UNION SELECT b.word, a.word, a.n FROM words a JOIN without b ON a.word = b.rest),
best AS (SELECT word, COUNT(*) AS n_near, list({{'m': -m, 'near': near}} ORDER BY -m, near)[1] AS top FROM pairs GROUP BY word),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.m >= 10 * n THEN top.near END AS form,
  CASE WHEN -top.m >= 10 * n THEN -top.m END AS form_n FROM words LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS held FROM forms UNION ALL
  SELECT walk.word, forms.form FROM walk JOIN forms ON walk.held = forms.word WHERE forms.form IS NOT NULL),
ends AS (SELECT walk.word, held AS root FROM walk JOIN forms ON held = forms.word WHERE form IS NULL)
SELECT forms.word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""

_LINES = f"""
WITH l AS (SELECT doc_id, generate_subscripts(ls, 1) AS spot, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (SELECT doc_id, spot, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key FROM l),
many AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING COUNT(DISTINCT doc_id) >= 10)
SELECT doc_id, COUNT(*) AS n_lines, COUNT(many.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY spot) FILTER (many.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN many USING (key) GROUP BY doc_id
"""

ORACLES = {
    "op4_urls": _URLS,
    "op5_topk": _TOP,
    "op6_decontaminate": _LEAKS,
    "op8_jaccard": _JACCARD,
    "op9_warc": _ARCHIVES,
    "op11_trie": _TRIE,
    "op12_spelling": _SPELLING,
    "op13_lines": _LINES,
}
