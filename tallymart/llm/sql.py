"""DuckDB SQL for the numbered queries that SQL can express. The others are tested against brute force."""

OP6 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
         ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words
), members AS (SELECT doc_id, len(s) AS n, unnest(s) AS m FROM sets
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS nab
  FROM members a JOIN members b ON a.m = b.m AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY 1, 2
), links AS (SELECT a, b FROM shared WHERE 100 * nab >= 80 * (na + nb - nab)
), edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY 1)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least l ON s.doc_id = l.a
"""

# Runs of five words in place of two; a shorter text has its whole sequence as its one member.
OP11 = OP6.replace(
    "WHEN len(w) = 1 THEN [w[1]]\n         ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])",
    "WHEN len(w) < 5 THEN [array_to_string(w, ' ')]\n         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))",
).replace(", s.doc_id = l.component_id AS kept", "")

WORDS8 = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)

OP8 = f"""
WITH docs AS (SELECT doc_id, {WORDS8} AS w FROM documents
), items AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS8} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2),
         lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS t
  FROM items WHERE len(w) > 0
), lengths AS (SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM docs JOIN lengths ON len(w) >= n
), cut AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t FROM places
), hits AS (SELECT doc_id, c.n, c.i, item FROM cut c JOIN windows v ON c.t = v.t AND c.n = v.n
), marked AS (
  SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN marked m ON d.doc_id = m.doc_id LEFT JOIN named i ON d.doc_id = i.doc_id
"""

CANON = r"""
  regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^www[0-9]*\.', '')
  || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '')
  || CASE WHEN params <> '' THEN '?' || params ELSE '' END
"""

OP9 = rf"""
WITH base AS (
  SELECT page_id, url, html, md5(coalesce(html, '')) AS d, 1700000000 + page_id * 60 AS t FROM pages
), records AS (
  SELECT page_id * 4 AS id, url, t, true AS is_full, '"' || d || '"' AS tag, html,
         'cache-control=max-age=60;content-length=' || length(coalesce(html, '')) || ';content-type=text/html;etag="' || d || '"' AS h FROM base
  UNION ALL SELECT page_id * 4 + 1, 'HTTPS://www.' || regexp_replace(url, '^https?://(www[.])?', '') || '#top', t + 1800, false,
         '"' || d || '"', NULL, 'cache-control=max-age=600;content-length=0;etag=W/"' || d || '"' FROM base
  UNION ALL SELECT page_id * 4 + 2, url, t + 3600, false, '"other"', NULL, 'etag="other"' FROM base WHERE page_id % 5 = 0
  UNION ALL SELECT page_id * 4 + 3, url, t - 31536000, false, '"' || d || '"', NULL,
         'cache-control=max-age=600;content-length=0;etag=W/"' || d || '"' FROM base WHERE page_id % 7 = 0
), cut AS (
  SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM records
), split AS (
  SELECT *, array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
         lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|sessionid|jsessionid|phpsessid|sid)='))), '&') AS params FROM cut
), named AS (SELECT *, {CANON} AS page FROM split
), dated AS (
  SELECT *, last_value(CASE WHEN is_full THEN struct_pack(id := id, tag := tag, h := h, html := html) END IGNORE NULLS)
         OVER (PARTITION BY page ORDER BY t, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM named
), told AS (
  SELECT *, CASE WHEN s IS NULL THEN 'no_earlier_response' WHEN s.tag = tag THEN 'resolved' ELSE 'validator_differs' END AS outcome
  FROM dated WHERE NOT is_full
)
SELECT id AS record_id, page AS canonical_url, outcome,
       CASE WHEN outcome = 'resolved' THEN s.id END AS source_id,
       CASE WHEN outcome = 'resolved' THEN 'cache-control=max-age=600;' || regexp_extract(s.h, '(content-length=.*;content-type=text/html;)', 1)
            || 'etag=W/' || tag ELSE h END AS headers,
       CASE WHEN outcome = 'resolved' THEN sha256(s.html) END AS payload_sha256
FROM told
"""

OP10 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP12 = r"""
WITH read AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), told AS (
  SELECT doc_id, part, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         min(doc_id) OVER (PARTITION BY t) AS least FROM read
), failed AS (
  SELECT doc_id, part, len(w) < 50 AS A, 100 * len(list_distinct(w)) < 65 * len(w) AS B,
         100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * len(t) AS C,
         regexp_matches(t, '[#$%&*|]') AS D, coalesce(least < doc_id, false) AS E FROM told
), named AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1
), counts AS (
  SELECT part, A, B, C, D, E, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM failed LEFT JOIN named USING (doc_id) GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), fails AS (
  SELECT *, (CASE WHEN A THEN 'A' ELSE '' END) || (CASE WHEN B THEN 'B' ELSE '' END) || (CASE WHEN C THEN 'C' ELSE '' END)
         || (CASE WHEN D THEN 'D' ELSE '' END) || (CASE WHEN E THEN 'E' ELSE '' END) AS mask FROM counts
), steps AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS f, n, good, toxic, mask,
         contains(mask, substr(filter_order, step, 1)) AS meets,
         len(translate(substr(filter_order, 1, step - 1), mask, '')) < step - 1 AS before
  FROM fails, orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), sums AS (
  SELECT part, filter_order, step, f, CAST(coalesce(sum(n) FILTER (NOT meets AND NOT before), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (meets AND NOT before), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (meets AND before), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (mask = f), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(good) FILTER (meets AND NOT before), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(toxic) FILTER (meets AND NOT before), 0) AS BIGINT) AS toxic_lost
  FROM steps GROUP BY ALL
)
SELECT * EXCLUDE (f), CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM sums
"""


def _field(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ["doc_id", "source", "lang", n_chars, "text"])) + ")"


CRC32 = """xor(4294967295::BIGINT, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda k: ascii(substr(CAST(doc_id AS VARCHAR), k, 1))::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                             lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)))"""


def _levels(name: str, base: str) -> str:
    """All nodes (tree, h, i, d, n) over the leaves (tree, i, d, n) of ``base``."""
    return f"""{name} AS (
  SELECT tree, 0 AS h, i, d, n FROM {base}
  UNION ALL SELECT tree, h + 1, i // 2, sha256(d || coalesce(e, '')), (n + 1) // 2
  FROM (SELECT *, lead(d) OVER (PARTITION BY tree ORDER BY i) AS e FROM {name}) WHERE i % 2 = 0 AND n > 1
)"""


def _steps(name: str, levels: str, base: str) -> str:
    """(tree, i, steps): the siblings of each leaf from below, with their side; ``-`` for none."""
    return f"""{name} AS (
  SELECT b.tree, b.i, list(CASE WHEN s.d IS NULL THEN '-' WHEN (b.i >> k.h) % 2 = 0 THEN 'R' || s.d ELSE 'L' || s.d END ORDER BY k.h) AS steps
  FROM {base} b JOIN (SELECT DISTINCT tree, h FROM {levels} WHERE n > 1) k ON k.tree = b.tree
  LEFT JOIN {levels} s ON s.tree = b.tree AND s.h = k.h AND s.i = xor(b.i >> k.h, 1::BIGINT) GROUP BY ALL
)"""


OP13 = f"""
WITH RECURSIVE told AS (
  SELECT doc_id, lang, {_leaf("n_chars")} AS leaf, CASE WHEN {CRC32} % 7 = 0 THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS changed
  FROM documents
), ranked AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM told
), leaves AS (SELECT tree, i, leaf AS d, n FROM ranked
), {_levels("low", "leaves")}, subroots AS (
  SELECT 0::BIGINT AS tree, tree AS i, d, count(*) OVER () AS n FROM low WHERE n = 1
), {_levels("high", "subroots")}, {_steps("inner_steps", "low", "leaves")}, {_steps("outer_steps", "high", "subroots")}, paths AS (
  SELECT r.doc_id, r.leaf, r.changed, s.d AS subroot, (SELECT d FROM high WHERE n = 1) AS root,
         list_concat(coalesce(p.steps, []), coalesce(q.steps, [])) AS steps
  FROM ranked r JOIN subroots s ON s.i = r.tree LEFT JOIN inner_steps p ON p.tree = r.tree AND p.i = r.i LEFT JOIN outer_steps q ON q.i = r.tree
), folded AS (
  SELECT *, list_reduce(list_concat([changed], steps), lambda a, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || a WHEN 'R' THEN a || s[2:] ELSE a END)) AS folded_root
  FROM paths
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded
"""

SQL = {
    "op6_minhash": OP6,
    "op8_decontamination": OP8,
    "op9_warc": OP9,
    "op10_exact": OP10,
    "op11_setjoin": OP11,
    "op12_filteraudit": OP12,
    "op13_merkle": OP13,
}
