"""DuckDB SQL of the queries that SQL can express, over whole tables."""

# Every string of 50 bytes, as hexadecimal digits, with the smallest doc_id it starts in.
OP6 = r"""WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substring(h, CAST(2 * i + 1 AS BIGINT), 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
f AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
hit AS (SELECT w.doc_id, w.i FROM w JOIN f USING (s) WHERE f.least < w.doc_id),
marked AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM hit),
numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, run),
parts AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS since FROM spans),
kept AS (SELECT p.doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans,
    string_agg(substring(h, CAST(2 * since + 1 AS BIGINT), CAST(2 * (a - since) AS BIGINT)), '' ORDER BY a)
      || substring(any_value(h), CAST(2 * max(b) + 1 AS BIGINT)) AS rest
  FROM parts p JOIN d ON d.doc_id = p.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id"""

# Links are pairs that share a shingle; components are what a document reaches over them.
OP8 = r"""WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM t UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, min(b) AS component_id
FROM t JOIN reach ON reach.a = t.doc_id LEFT JOIN n ON n.doc_id = t.doc_id GROUP BY t.doc_id, n.n"""

ESCAPED = r"\\|<\|turn\|>|<\|text\|>|<\|end\|>|<\|close\|>|<s>|</s>|\[INST\]|\[/INST\]|<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>"

# A turn is written with 23 characters of marks; an escape adds one character.
OP5 = rf"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
c AS (SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, sha256(role || chr(10) || text)) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, sha256(role || chr(10) || text)) FILTER (role = 'assistant'), '') AS loss,
    CAST(sum(23 + length(role) + length(text) + len(regexp_extract_all(role, '{ESCAPED}')) + len(regexp_extract_all(text, '{ESCAPED}'))) AS BIGINT) AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM c"""


def _host(url: str) -> str:
    rest = f"substring({url}, instr({url}, '://') + 3)"
    return f"translate(regexp_extract({rest}, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _path(url: str) -> str:
    return rf"regexp_extract(substring({url}, instr({url}, '://') + 3), '^[^/?#]*([^?#]*)', 1)"


def _query(url: str) -> str:
    return rf"regexp_extract(substring({url}, instr({url}, '://') + 3), '^[^?#]*(\?[^#]*)', 1)"


TRACKING = "utm_[a-z]+|fbclid|gclid"


def op2(rules: list[tuple[str, str, str]]) -> str:
    """Absolute and root-relative targets of canonical links and refreshes are followed; the tables name no others."""
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    fits = "(host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path)"
    kept = rf"regexp_replace(regexp_replace({_query('url')}, '([?&])(?:{TRACKING})=[^&]*(?:&|$)', '\1', 'g'), '[?&]+$', '')"
    # RE2 has no look-behind: the separator is taken in and put back.
    return rf"""WITH RECURSIVE rules(said, rule_host, rule_path) AS (VALUES {values}),
p AS (SELECT page_id, url, regexp_replace(html, '(?s)<!--.*?-->', '', 'g') AS html, instr(url, '://') > 0 AS ok FROM pages),
named AS (SELECT url, unnest([regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?([^"''\s>]*)', 1),
    regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)\burl\s*=\s*["'']?([^"''>]*)', 1)]) AS target FROM p WHERE ok),
targets AS (SELECT url AS source, CASE WHEN target LIKE '%://%' THEN target ELSE split_part(url, '://', 1) || '://' || {_host('url')} || target END AS url
  FROM named WHERE target <> ''),
urls AS (SELECT url FROM p WHERE ok UNION SELECT url FROM targets),
nodes AS (SELECT url, {_host('url')} || {_path('url')} || {_query('url')} AS node,
    {_host('url')} || CASE WHEN length({_path('url')}) > 1 THEN regexp_replace({_path('url')}, '/$', '') ELSE {_path('url')} END || {kept} AS plain FROM urls),
edges AS (SELECT node AS a, plain AS b FROM nodes UNION SELECT x.node, y.node FROM targets JOIN nodes x ON x.url = source JOIN nodes y ON y.url = targets.url),
links AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reach(a, b) AS (SELECT a, a FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
members AS (SELECT DISTINCT a AS node, {_host("('x://' || a)")} AS host, {_path("('x://' || a)")} AS path FROM links),
places AS (SELECT DISTINCT host, path FROM members UNION SELECT DISTINCT {_host('url')}, {_path('url')} FROM p WHERE ok),
judged AS (SELECT host, path, said, rule_host || rule_path AS rule FROM places JOIN rules ON {fits}
  QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule_host || rule_path) DESC, said) = 1),
spread AS (SELECT reach.a AS node, CASE WHEN bool_or(said = 'allow') THEN 'allow' ELSE 'block' END AS spread
  FROM reach JOIN members ON members.node = reach.b JOIN judged USING (host, path) GROUP BY reach.a),
own AS (SELECT page_id, url, CASE WHEN ok THEN {_host('url')} ELSE '' END AS host, CASE WHEN ok THEN {_path('url')} ELSE '' END AS path,
    CASE WHEN ok THEN {_host('url')} || {_path('url')} || {_query('url')} END AS node FROM p)
SELECT page_id, url, own.host, own.path, rule, coalesce(said, spread, 'allow') AS verdict, rule IS NULL AND spread IS NOT NULL AS alias
FROM own LEFT JOIN judged ON judged.host = own.host AND judged.path = own.path LEFT JOIN spread ON spread.node = own.node"""
