"""SQL of the queries that SQL can express."""

OP2 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
  SELECT *, coalesce(lag(role) OVER w <> role, true) AS opens,
         length(replace(replace(replace(text, '\', '\s'), '<', '\l'), '>', '\g')) AS text_chars,
         length(replace(replace(replace(role, '\', '\s'), '<', '\l'), '>', '\g')) AS role_chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(text_chars + CASE WHEN opens THEN role_chars + length('<turn ></turn>') + 1 ELSE length('<next>') END) AS BIGINT)
         AS formatted_chars
FROM marked GROUP BY conv_id
"""

OP1 = r"""
WITH templates(label, own, name, unless) AS (VALUES
  ('mit', ['released', 'under', 'the', 'mit', 'license'], ['mit'], []),
  ('mit', ['permission', 'is', 'hereby', 'granted', 'free', 'of', 'charge', 'to', 'any', 'person', 'obtaining', 'a', 'copy', 'this', 'software'], NULL, []),
  ('apache', ['licensed', 'under', 'the', 'apache', 'license', 'version', '2', '0'], ['apache'], []),
  ('apache', ['you', 'may', 'not', 'use', 'this', 'file', 'except', 'in', 'compliance', 'with', 'the', 'license'], NULL, []),
  ('gpl', ['this', 'work', 'is', 'licensed', 'under', 'the', 'gnu', 'general', 'public', 'license', 'version', '3'], ['gnu', 'general', 'public'], []),
  ('gpl', ['you', 'can', 'redistribute', 'it', 'and', 'or', 'modify', 'under', 'the', 'terms', 'of', 'gnu', 'general', 'public', 'license'], ['gnu', 'general', 'public'], []),
  ('bsd', ['redistribution', 'and', 'use', 'in', 'source', 'binary', 'forms', 'with', 'or', 'without', 'modification', 'are', 'permitted'], NULL, []),
  ('cc-by', ['licensed', 'under', 'cc', 'by', '4', '0'], ['cc', 'by'], ['nc', 'nd', 'sa']),
  ('cc-by-nc', ['licensed', 'under', 'cc', 'by', 'nc', '4', '0'], ['cc', 'by', 'nc'], ['nd', 'sa']),
  ('cc-by-sa', ['licensed', 'under', 'cc', 'by', 'sa', '4', '0'], ['cc', 'by', 'sa'], ['nc', 'nd']),
  ('proprietary', ['all', 'rights', 'reserved', 'no', 'part', 'may', 'be', 'reproduced', 'without', 'written', 'permission'], NULL, [])
), worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), phrases(label, p) AS (VALUES ('mit', ['mit', 'license']), ('apache', ['apache', 'license']), ('gpl', ['general', 'public', 'license'])),
places AS (
  SELECT doc_id, label, i FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM worded WHERE list_contains(w, 'license')), phrases
  WHERE w[i + 1 : i + len(p)] = p
), base AS (
  SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM places GROUP BY doc_id
), blocks AS (
  SELECT doc_id, w, s, w[s + 1 : s + 64] AS b FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 1 - 32, 0) + 1, 32)) AS s FROM worded)
), held AS (
  SELECT doc_id, label, len(list_intersect(b, own)) / len(own) AS containment,
    name IS NULL OR list_bool_or(list_transform(range(s, s + 65 - len(name)), lambda i:
      w[i + 1 : i + len(name)] = name AND NOT coalesce(list_contains(unless, w[i + len(name) + 1]), false))) AS stated
  FROM blocks, templates
  WHERE len(list_intersect(b, own)) >= ceil(0.8 * len(own) - 1e-9)
), method AS (SELECT doc_id, max(containment) AS best FROM held GROUP BY doc_id),
every AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM places UNION ALL SELECT doc_id, label FROM held WHERE stated) GROUP BY doc_id
), resembled AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM held GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, z AS last_word,
       coalesce(base.labels, '') AS base_labels, coalesce(every.labels, '') AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score,
       coalesce(resembled.labels, '') AS held_labels
FROM worded LEFT JOIN resembled USING (doc_id) LEFT JOIN base USING (doc_id) LEFT JOIN method USING (doc_id) LEFT JOIN every USING (doc_id)
"""

OP7 = r"""
WITH worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, len(p) AS n, array_to_string(p, ' ') AS p FROM (
    SELECT item_id, w[i + 1 : i + 10] AS p
    FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS i FROM items WHERE len(w) > 0))
), lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM worded),
occurrences AS (
  SELECT doc_id, i, windows.n, item_id FROM places, lengths, windows
  WHERE windows.n = lengths.n AND i + lengths.n <= len(w) AND array_to_string(w[i + 1 : i + lengths.n], ' ') = p
), hit AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest(range(n)) AS k FROM occurrences) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM occurrences GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM worded LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""

OP6 = r"""
WITH coded AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
windows AS (
  SELECT doc_id, i, substring(x, 2 * i + 1, 100) AS s
  FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 49)) AS i FROM coded WHERE len(x) >= 100)
), owned AS (SELECT s, min(doc_id) AS owner FROM windows GROUP BY s HAVING count(DISTINCT doc_id) > 1),
cut AS (SELECT doc_id, i FROM windows JOIN owned USING (s) WHERE doc_id > owner),
reach AS (
  SELECT doc_id, i, i > coalesce(max(i + 50) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS fresh
  FROM cut
), runs AS (SELECT doc_id, i, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM reach),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS z FROM runs GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, run, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY run), 0) AS a, a AS z FROM spans
  UNION ALL SELECT doc_id, max(run) + 1, max(z), NULL FROM spans GROUP BY doc_id
), stays AS (
  SELECT doc_id, string_agg(substring(x, 2 * a + 1, 2 * (coalesce(z, len(x) // 2) - a)), '' ORDER BY run) AS x
  FROM gaps JOIN coded USING (doc_id) GROUP BY doc_id
), sums AS (SELECT doc_id, sum(z - a) AS n, count(*) AS k FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(len(coded.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(k, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(stays.x, coded.x))) AS kept_sha256
FROM coded LEFT JOIN stays USING (doc_id) LEFT JOIN sums USING (doc_id)
"""

def _url_level(k: int) -> str:
    """Tables of one level of the template tree: ``tree{k}`` with one more segment generalised."""
    return f"""
  at{k} AS MATERIALIZED (SELECT *, coalesce(segments[{k + 1}], '') AS segment FROM tree{k}),
  branches{k} AS MATERIALIZED (SELECT host, done, segment, sum(n) AS bn, sum(labelled) AS bl, sum(bad) AS bb FROM at{k} GROUP BY ALL),
  parents{k} AS MATERIALIZED (
    SELECT host, done, sum(bn) AS pn, count(*) AS children, sum(CASE WHEN bl >= 5 THEN bl ELSE 0 END) AS pl,
      sum(CASE WHEN bl >= 5 THEN bb ELSE 0 END) AS pb FROM branches{k} GROUP BY ALL),
  steps{k} AS MATERIALIZED (
    SELECT host, done, segment, CASE WHEN segment = '' THEN ''
      WHEN children >= 10 AND children >= 0.3::DOUBLE * pn THEN '/*'
      WHEN bl >= 5 AND pl - bl >= 5 AND abs(bb / bl - (pb - bb) / (pl - bl))
        <= 1.96::DOUBLE * sqrt((pb / pl) * (1 - pb / pl) * (1 / bl + 1 / (pl - bl))) THEN '/*'
      ELSE '/' || segment END AS step
    FROM branches{k} JOIN parents{k} USING (host, done)),
  tree{k + 1} AS MATERIALIZED (
    SELECT host, segments, n, labelled, bad, done || step AS done FROM at{k} JOIN steps{k} USING (host, done, segment)),"""


URL_LEVELS = 8  # the tree is unrolled; no given path has more segments (tests assert it)
_STEM = r"regexp_replace(x, '\.[A-Za-z]{1,5}$', '')"
OP8 = rf"""
WITH RECURSIVE rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
parts AS (SELECT row_number() OVER () AS r, page_id, url, substr(url, strpos(url, '://') + 3) AS rest FROM pages),
urls AS (
  SELECT r, page_id,
    CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM parts),
fits AS (
  SELECT r, h || p AS rule, verdict FROM urls, rules
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(h || p) DESC, h || p) = 1),
shaped AS (
  SELECT urls.*, rule, verdict, list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x:
    CASE WHEN regexp_full_match({_STEM}, '[0-9]+') OR length({_STEM}) >= 40
        OR (regexp_full_match({_STEM}, '[0-9A-Fa-f-]{{8,}}') AND regexp_matches({_STEM}, '[0-9]'))
        OR (length({_STEM}) >= 12 AND regexp_matches({_STEM}, '[0-9].*[0-9].*[0-9]'))
      THEN '*' || regexp_extract(x, '\.[A-Za-z]{{1,5}}$') ELSE x END) AS own
  FROM urls LEFT JOIN fits USING (r)),
ruled AS (SELECT *, own AS segments FROM shaped),
tree0 AS (
  SELECT host, segments, count(*) AS n, count(verdict) AS labelled,
    sum(CASE WHEN verdict = 'block' THEN 1 ELSE 0 END) AS bad, '' AS done FROM ruled GROUP BY host, segments),
{"".join(_url_level(k) for k in range(URL_LEVELS))}
ends AS (
  SELECT host, done AS template, sum(labelled) AS labelled, sum(bad) AS bad FROM tree{URL_LEVELS} GROUP BY ALL),
named AS (SELECT *, regexp_replace(host, ':[0-9]*$', '') AS plain, string_split(template, '/') AS parts FROM ends),
branches AS (
  SELECT host, template, labelled, bad, unnest(range(1, len(parts) + 1)) AS k, parts, CASE
    WHEN regexp_matches(plain, '^[0-9.]+$|^\[') THEN plain
    ELSE regexp_extract(plain, '(?:[^.]+\.)?(?:[^.]{{1,3}}\.[a-z]{{2}}|[^.]+)$') END AS domain FROM named),
joined AS (SELECT *, array_to_string(parts[1:k], '/') AS branch FROM branches),
own AS (SELECT domain, host, branch, sum(labelled) AS hl, sum(bad) AS hb FROM joined GROUP BY ALL),
wide AS (SELECT domain, branch, sum(hl) AS dl, sum(hb) AS db FROM own GROUP BY ALL),
chain AS (
  SELECT joined.host, template, k, len(parts) AS last, dl, db, hl, hb FROM joined
  JOIN own ON own.host = joined.host AND own.branch = joined.branch
  JOIN wide ON wide.domain = joined.domain AND wide.branch = joined.branch),
shares AS (
  SELECT host, template, 0 AS k, coalesce((SELECT sum(bad)::DOUBLE / nullif(sum(labelled), 0) FROM ends), 0.25::DOUBLE) AS p FROM ends
  UNION ALL
  SELECT chain.host, chain.template, chain.k,
    (hb + 4.0::DOUBLE * ((db + 4.0::DOUBLE * p) / (dl + 4.0::DOUBLE))) / (hl + 4.0::DOUBLE)
  FROM shares JOIN chain ON chain.host = shares.host AND chain.template = shares.template AND chain.k = shares.k + 1),
judged AS (SELECT host, template, arg_max(p, k) AS share FROM shares GROUP BY ALL),
leaves AS (
  SELECT t.host, segments, template, share FROM tree{URL_LEVELS} t JOIN judged ON t.host = judged.host AND done = template)
SELECT page_id, ruled.host, path, rule,
  coalesce(verdict, CASE WHEN share >= 0.6::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict, template, share
FROM ruled JOIN leaves ON ruled.host = leaves.host AND ruled.segments = leaves.segments
"""

OP12 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), coded AS (SELECT *, left(sha256(length(role) || ':' || role || text), 32) AS token FROM turns),
ordered AS (
  SELECT conv_id, token, length(text) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, token) - 1 AS i FROM coded
), sizes AS (SELECT conv_id, count(*) AS n FROM ordered GROUP BY conv_id),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
      lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) % 6 AS h
  FROM sizes
), heads AS (SELECT convs.*, least(h, coalesce(n, 0)) AS taken FROM convs LEFT JOIN sizes ON sizes.conv_id = base),
rebuilt AS (
  SELECT heads.conv_id, i + 1 AS d, token, chars FROM heads JOIN ordered ON ordered.conv_id = base AND i < taken
  UNION ALL
  SELECT heads.conv_id, taken + i - h + 1, token, chars FROM heads JOIN ordered ON ordered.conv_id = heads.conv_id AND i >= h
), steps AS (
  SELECT conv_id, 0 AS d, '' AS path, 0 AS chars FROM convs
  UNION ALL SELECT conv_id, d, string_agg(token, '') OVER (PARTITION BY conv_id ORDER BY d), chars FROM rebuilt
), nodes AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n, any_value(chars) AS chars FROM steps GROUP BY path, d),
broods AS (SELECT left(path, length(path) - 32) AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
sums AS (
  SELECT steps.path, sum((nodes.n - 1) * nodes.chars) AS saved, count(*) FILTER (broods.n IS NULL) AS leaves
  FROM nodes JOIN steps ON steps.conv_id = nodes.conv_id AND steps.d <= nodes.d LEFT JOIN broods ON broods.path = nodes.path
  GROUP BY steps.path
), whole AS (SELECT conv_id, max_by(path, d) AS path FROM steps GROUP BY conv_id),
ends AS (SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM whole GROUP BY path)
SELECT nodes.conv_id, CAST(nodes.d AS BIGINT) AS depth, above.conv_id AS parent_conv_id, nodes.n AS n_convs,
  coalesce(broods.n, 0) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes JOIN sums USING (path) LEFT JOIN broods USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes AS above ON nodes.d > 0 AND above.path = left(nodes.path, length(nodes.path) - 32)
"""

SQL = {"op12_conversation_prefix_trie": OP12, "op8_url_filters": OP8, "op6_suffix_array_dedup": OP6, "op7_benchmark_decontamination": OP7, "op1_license_scans": OP1, "op2_chat_formatting": OP2}
