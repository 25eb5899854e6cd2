"""DuckDB SQL for the operators' queries that SQL can express."""

from __future__ import annotations

from noticeweave.llm.licenses import COVER, K_NOTICE, K_PHRASE, NEAR, NOTICES, PHRASES
from noticeweave.llm.urls import URL_RULES

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{}')"

OP3 = """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
  s AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
  links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM s a JOIN s b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
  hub AS (SELECT a AS node, least(a, min(b)) AS h FROM links GROUP BY 1)
  """


def _components(edges: str) -> str:
    """A recursive walk over the classes of edges (a, b), both ways."""
    return f"walk(node, root) AS (SELECT DISTINCT a, a FROM {edges} UNION SELECT w.node, x.b FROM walk w JOIN {edges} x ON w.root = x.a), label AS (SELECT node, min(root) AS component FROM walk GROUP BY 1)"


OP3 = OP3.replace("WITH v", "WITH RECURSIVE v").rsplit(",\n  hub", 1)[0] + f""", {_components('links')}, degree AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
  SELECT vec_id, CAST(coalesce(degree.n, 0) AS BIGINT) AS n_links, coalesce(component, vec_id) AS component_id, coalesce(component, vec_id) = vec_id AS kept
  FROM v LEFT JOIN degree ON a = vec_id LEFT JOIN label ON node = vec_id"""

OP6 = rf"""WITH d AS (SELECT doc_id, {_WORDS.format(r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')} AS w FROM documents),
  i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS.format(r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')} AS w FROM benchmark),
  runs AS (SELECT DISTINCT item_id, array_to_string(w[p : p + 9], ' ') AS run, least(len(w), 10) AS n FROM i, unnest(generate_series(1, greatest(1, len(w) - 9))) x(p) WHERE len(w) > 0 AND item_id IS NOT NULL),
  sizes AS (SELECT DISTINCT n FROM runs),
  places AS (SELECT doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') AS run FROM d, sizes, unnest(generate_series(1, len(w) - n + 1)) x(p)),
  hits AS MATERIALIZED (SELECT doc_id, p, n, item_id FROM places JOIN runs USING (run, n)),
  covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM hits, unnest(generate_series(p, p + n - 1)) y(q) GROUP BY 1),
  items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY 1)
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""

OP7 = rf"""WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(r'[^\x20\x09-\x0D]+')} AS w FROM documents),
  g AS (SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS gram FROM d, unnest(generate_series(1, greatest(1, len(w) - 4))) x(p) WHERE len(w) > 0),
  n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
  shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
  one AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
  links AS MATERIALIZED (SELECT a, b FROM one UNION ALL SELECT b, a FROM one), {_components('links')}
  SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN label ON node = d.doc_id"""

_TEMPLATES = ", ".join(f"({i}, '{label}', {i < len(PHRASES)}, {K_PHRASE if i < len(PHRASES) else K_NOTICE}, '{text}')" for i, (text, label) in enumerate([*PHRASES, *NOTICES]))

OP2 = rf"""WITH d AS (SELECT doc_id, {_WORDS.format(r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')} AS w FROM documents),
  t AS (SELECT template, label, phrase, k, string_split(said, ' ') AS w FROM (VALUES {_TEMPLATES}) x(template, label, phrase, k, said)),
  known AS (SELECT template, label, phrase, k, len(w) AS length, len(w) - k + 1 AS runs, p - 1 AS spot, array_to_string(w[p : p + k - 1], ' ') AS run FROM t, unnest(generate_series(1, len(w) - k + 1)) x(p)),
  rolled AS (SELECT doc_id, k, p - 1 AS place, array_to_string(w[p : p + k - 1], ' ') AS run FROM d, (VALUES ({K_PHRASE}), ({K_NOTICE})) s(k), unnest(generate_series(1, len(w) - k + 1)) x(p)),
  votes AS (SELECT DISTINCT doc_id, template, label, phrase, k, length, runs, place, spot, place - spot AS diagonal FROM rolled JOIN known USING (k, run)),
  steps AS (SELECT *, CASE WHEN coalesce(diagonal - lag(diagonal) OVER w > (CASE WHEN phrase THEN 0 ELSE {NEAR} END), FALSE) THEN 1 ELSE 0 END AS new FROM votes WINDOW w AS (PARTITION BY doc_id, template ORDER BY diagonal, spot)),
  spanned AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY diagonal, spot) AS span FROM steps),
  merged AS (SELECT doc_id, template, label, phrase, length, runs, span, count(DISTINCT spot) AS votes, min(place) AS first, max(place) + k - 1 AS last FROM spanned GROUP BY doc_id, template, label, phrase, k, length, runs, span),
  found AS (SELECT * FROM merged WHERE CASE WHEN phrase THEN votes = runs ELSE votes / runs >= {COVER} AND last - first + 1 <= length * 1.5 + {NEAR} END),
  told AS (SELECT doc_id, count(*) FILTER (phrase) AS n_base, min(first) FILTER (phrase) AS first_word, max(first) FILTER (phrase) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(votes / runs) AS score FROM found GROUP BY 1)
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
  FROM d LEFT JOIN told USING (doc_id)"""

_REST = "(CASE WHEN contains({0}, '://') THEN substr({0}, strpos({0}, '://') + 3) ELSE '' END)"
_HOST = f"translate(regexp_extract({_REST}, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = f"regexp_extract({_REST}, '^[^/?#]*([^?#]*)', 1)"
_NODE = rf"nullif({_HOST}, '') || regexp_replace({_PATH}, '/+$', '') || regexp_extract({_REST}, '^[^?#]*(\?[^#]*)', 1)"
_UNREAD = r"(?is)<!--.*?(?:-->|\z)|" + "|".join(rf"<{tag}\b.*?(?:</{tag}\b|\z)" for tag in ("script", "style", "template", "noscript", "textarea"))
_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)

OP9 = rf"""WITH RECURSIVE p AS (SELECT page_id, url, {_HOST.format("coalesce(url, '')")} AS host, {_PATH.format("coalesce(url, '')")} AS path, {_NODE.format("coalesce(url, '')")} AS node FROM pages),
  linked AS (SELECT url, regexp_replace(html, '{_UNREAD}', ' ', 'g') AS h FROM pages WHERE url IS NOT NULL AND regexp_matches(html, '(?i)canonical|refresh')),
  tags AS (SELECT url, unnest(regexp_extract_all(h, '(?is)<(?:link|meta)\b[^>]*')) AS tag FROM linked),
  links AS (SELECT url, replace(CASE WHEN regexp_matches(tag, '(?is)^<link\b.*\brel\s*=\s*["'']?canonical\b') THEN regexp_extract(tag, '(?is)^<link\b.*\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
      WHEN regexp_matches(tag, '(?is)^<meta\b.*\bhttp-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(tag, '(?is)^<meta\b.*\bcontent\s*=\s*["''][^"''>]*?\burl\s*=\s*([^"''\s>]+)', 1) END, '&amp;', '&') AS link FROM tags),
  resolved AS (SELECT DISTINCT url, CASE WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link WHEN starts_with(link, '//') THEN 'http:' || link WHEN starts_with(link, '/') THEN 'http://' || {_HOST.format("url")} || link
      ELSE 'http://' || {_HOST.format("url")} || regexp_replace({_PATH.format("url")}, '[^/]*$', '') || CASE WHEN {_PATH.format("url")} = '' THEN '/' ELSE '' END || link END AS other FROM links WHERE link <> ''),
  ends AS (SELECT {_HOST.format("u")} AS host, {_PATH.format("u")} AS path, {_NODE.format("u")} AS node FROM (SELECT url AS u FROM resolved UNION SELECT other FROM resolved)),
  rules(rule_host, rule_path, ruling) AS (VALUES {_RULES}),
  found AS (SELECT host, path, rule_host || rule_path AS rule, ruling FROM (SELECT host, path FROM p UNION SELECT host, path FROM ends) JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC, ruling = 'allow' DESC, rule DESC) = 1),
  one AS (SELECT {_NODE.format("url")} AS a, {_NODE.format("other")} AS b FROM resolved), edges AS MATERIALIZED (SELECT a, b FROM one WHERE a <> b UNION SELECT b, a FROM one WHERE a <> b), {_components('edges')},
  members AS (SELECT DISTINCT host, path, component FROM (SELECT host, path, node FROM p UNION SELECT host, path, node FROM ends) JOIN label USING (node)),
  classes AS (SELECT component, bool_or(ruling = 'allow') AS allowed, bool_or(ruling = 'block') AS blocked FROM members LEFT JOIN found USING (host, path) GROUP BY 1)
  SELECT page_id, p.host, p.path, rule, coalesce(ruling, CASE WHEN allowed THEN 'allow' WHEN blocked THEN 'block' END, 'allow') AS verdict
  FROM p LEFT JOIN found USING (host, path) LEFT JOIN label ON p.node = label.node LEFT JOIN classes USING (component)"""

OP10 = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), s AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
  m AS (SELECT payload_digest, max(page_id) AS target FROM s WHERE payload_bytes >= 1000 GROUP BY 1)
  SELECT page_id, payload_bytes, payload_digest, CASE WHEN target IS NOT NULL AND target <> page_id AND payload_bytes >= 1000 THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN target <> page_id AND payload_bytes >= 1000 THEN target END AS refers_to FROM s LEFT JOIN m USING (payload_digest)"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, half a byte at a time."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    half = lambda x: f"xor({x} >> 4, {table}[({x} & 15) + 1])"
    signs = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {signs}), lambda a, b: {half(half('xor(a, b)'))}), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"


def _walk(start: str, nodes: str, key: str) -> str:
    """From (lang, doc_id, leaf, i, n, cur, sibs) up a tree of nodes (key, level, i, h), one level a step."""
    same = f"s.{key} IS NOT DISTINCT FROM w.{key} AND " if key else ""
    up = "sha256(CASE WHEN s.h IS NULL THEN cur WHEN w.i % 2 = 1 THEN s.h || cur ELSE cur || s.h END)"
    return f"""SELECT lang, doc_id, leaf, 0 AS level, i, n, cur, sibs FROM {start} UNION ALL
    SELECT w.lang, doc_id, leaf, w.level + 1, w.i // 2, (w.n + 1) // 2, {up}, sibs || coalesce(s.h, '') FROM {{walk}} w LEFT JOIN {nodes} s ON {same}s.level = w.level AND s.i = xor(w.i, 1) WHERE w.n > 1"""


_NODES = "SELECT {key} level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY {key} level, n, i // 2"

OP13 = f"""WITH RECURSIVE f AS (SELECT doc_id, lang, n_chars, {_field('doc_id')} || {_field('source')} || {_field('lang')} AS before, {_field('text')} AS after,
    CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN 1 ELSE 0 END AS more FROM documents),
  leaves AS (SELECT doc_id, lang, sha256(before || {_field('n_chars')} || after) AS leaf, sha256(before || {_field('(n_chars + more)')} || after) AS found FROM f),
  placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
  nodes AS (SELECT lang, 0 AS level, i, n, leaf AS h FROM placed UNION ALL {_NODES.format(key='lang,', name='nodes')}),
  subroots AS MATERIALIZED (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
  tops AS (SELECT 0 AS level, i, n, h FROM subroots UNION ALL {_NODES.format(key='', name='tops')}),
  start AS (SELECT lang, doc_id, leaf, i, n, found AS cur, '' AS sibs FROM placed),
  climb AS ({_walk('start', 'nodes', 'lang').format(walk='climb')}),
  middle AS (SELECT c.lang, doc_id, leaf, r.i, r.n, cur, sibs FROM climb c JOIN subroots r ON r.lang IS NOT DISTINCT FROM c.lang WHERE c.n = 1),
  rise AS ({_walk('middle', 'tops', '').format(walk='rise')})
  SELECT doc_id, leaf, r.h AS subroot, t.h AS root, sha256(sibs) AS proof_sha256, cur AS folded_root, cur = t.h AS verified
  FROM rise JOIN subroots r ON r.lang IS NOT DISTINCT FROM rise.lang, (SELECT h FROM tops WHERE n = 1) t WHERE rise.n = 1"""

OP12 = """WITH v AS (SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
  scored AS MATERIALIZED (SELECT a.row AS anchor, a.vec_id AS anchor_id, b.row AS row, b.vec_id AS id, a.label = b.label AS own, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.row <> b.row AND len(a.e) = len(b.e)),
  positives AS (SELECT * FROM scored WHERE own QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, row) <= 5)
  SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER w AS INT) AS rank, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.own AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
  WINDOW w AS (PARTITION BY p.anchor, p.row ORDER BY n.score DESC, n.id, n.row) QUALIFY rank <= 10"""

ORACLES = {"op2_license_scan": OP2, "op3_embedding_near_dedup": OP3, "op6_benchmark_decontamination": OP6, "op7_ngram_jaccard_join": OP7, "op9_url_filter": OP9, "op10_warc": OP10, "op12_hard_negatives": OP12, "op13_merkle_manifest": OP13}
