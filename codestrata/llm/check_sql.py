"""DuckDB SQL with the rows of the operators' queries, over the same tables."""

from codestrata.llm import link_graph as L

#: Upper case to lower case, A-Z only.
LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def url_filters(steps: int = 10) -> str:
    """The rules, the links of hosts, and ``steps`` steps of both flows, one after another."""
    lower = LOWERED.format
    fits = "(host = split_part({0}, '/', 1) OR ends_with(host, '.' || split_part({0}, '/', 1))) AND starts_with(path, substr({0}, instr({0}, '/')))"
    rules = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in L.RULES)
    pattern = L.LINK.replace("'", "''")
    parts = [
        f"rules(rule, says) AS (VALUES {rules})",
        f"""cut AS (SELECT page_id, html, {lower("regexp_extract(rest, '^[^/?#]*')")} AS host,
          regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM (SELECT *, CASE WHEN contains(coalesce(url, ''), '://')
            THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages))""",
        f"""ruled AS (SELECT *, (SELECT max_by(rule, length(rule)) FROM rules WHERE {fits.format("rule")}) AS rule FROM cut)""",
        "told AS (SELECT r.*, says FROM ruled r LEFT JOIN rules USING (rule))",
        f"""links AS (SELECT DISTINCT src, dst FROM (SELECT host AS src, {lower("unnest(regexp_extract_all(html, '" + pattern + "', 1))")} AS dst FROM cut)
          WHERE src <> '' AND src <> dst)""",
        """arcs AS (SELECT 'trust' AS kind, src AS f, dst AS t FROM links UNION ALL SELECT 'distrust', dst, src FROM links)""",
        "degrees AS (SELECT kind, f, count(*) AS arcs FROM arcs GROUP BY ALL)",
        f"""seeds AS (SELECT host, CASE says WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, count(*) * {L.UNIT} AS has
          FROM told WHERE host <> '' AND says IS NOT NULL GROUP BY ALL)""",
        "s0 AS (SELECT * FROM seeds)",
    ]
    for k in range(1, steps + 1):
        parts.append(
            f"""s{k} AS (SELECT host, kind, sum(has) AS has FROM (SELECT host, kind, has * {100 - L.FLOW} // 100 AS has FROM seeds
          UNION ALL SELECT t, kind, has * {L.FLOW} // (100 * arcs) FROM s{k - 1} JOIN degrees d USING (kind) JOIN arcs a USING (kind)
            WHERE d.f = host AND a.f = host) GROUP BY ALL)"""
        )
    parts.append(
        f"""amounts AS (SELECT host, coalesce(sum(has) FILTER (kind = 'trust'), 0)::BIGINT AS trust, coalesce(sum(has) FILTER (kind = 'distrust'), 0)::BIGINT AS distrust
          FROM (SELECT * FROM s{steps} WHERE (SELECT count(*) FROM links) > 0 UNION ALL SELECT * FROM s0 WHERE (SELECT count(*) FROM links) = 0) GROUP BY ALL)"""
    )
    return f"""WITH {", ".join(parts)} SELECT page_id, host, path, rule, coalesce(says, CASE WHEN distrust > trust THEN 'block' ELSE 'allow' END) AS verdict,
      coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust FROM told LEFT JOIN amounts USING (host)"""


COLLOCATIONS = f"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array({LOWERED.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
  words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]'), lambda w: w <> '') AS ws FROM pieces),
  totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM words GROUP BY lang),
  grams AS (SELECT lang, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase, count(*) AS a
    FROM (SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM words, (SELECT unnest([1, 2, 3, 4]) AS size))
    GROUP BY ALL HAVING count(*) >= 30),
  cuts AS (SELECT lang, phrase, size, a, p, unnest(range(1, size)) AS k FROM (SELECT *, string_split(phrase, ' ') AS p FROM grams WHERE size > 1)),
  scores AS (SELECT c.lang, c.phrase, c.size, c.a, c.p, k, x.a AS l, y.a AS r, ((2000000::HUGEINT * c.a) // (x.a + y.a))::BIGINT AS score FROM cuts c
    JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.p[1:k], ' ')
    JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.p[k + 1:c.size], ' ')),
  best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
  inside AS (SELECT lang, array_to_string(p[i:i + m - 1], ' ') AS phrase, max(a) AS most
    FROM (SELECT *, unnest(range(1, size - m + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS m FROM best)) GROUP BY ALL),
  kept AS (SELECT b.* FROM best b LEFT JOIN inside i USING (lang, phrase) WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
  JOIN totals USING (lang) WHERE rank <= 2000"""

def _crc32(text: str) -> str:
    """crc32 of a decimal number: eight shifts for each of its bytes."""
    byte = f"ord(substr({text}, (i // 8 + 1)::INT, 1))"
    mixed = f"(CASE WHEN i % 8 = 0 THEN xor(c, {byte}::BIGINT) ELSE c END)"
    step = f"CASE WHEN {mixed} % 2 = 1 THEN xor({mixed} // 2, 3988292384) ELSE {mixed} // 2 END"
    return f"xor(list_reduce(range(8 * length({text})), lambda c, i: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


def merkle_manifest() -> str:
    """All levels of the trees, and the paths of all leaves through them."""

    def field(value: str) -> str:
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR END"

    def leaf(n_chars: str) -> str:
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"

    def fold(nodes: str, name: str) -> str:
        """All levels of the trees of ``nodes`` (tree, level, spot, n, node)."""
        return f"""{name} AS (SELECT * FROM {nodes} UNION ALL SELECT tree, level + 1, spot // 2, ((n + 1) // 2)::BIGINT AS n,
          sha256(string_agg(node, '' ORDER BY spot)) FROM {name} WHERE n > 1 GROUP BY tree, level, spot // 2, n)"""

    turned = "CASE WHEN s.node IS NULL THEN sha256({0}) WHEN p.spot % 2 = 1 THEN sha256(s.node || {0}) ELSE sha256({0} || s.node) END"
    return f"""WITH RECURSIVE rows AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf("n_chars")} AS leaf, {leaf("n_chars + 1")} AS other,
    coalesce({_crc32("doc_id::VARCHAR")} % 7 = 0, false) AS changed FROM documents),
  leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot, count(*) OVER (PARTITION BY tree) AS n FROM rows),
  lowest AS (SELECT tree, 0 AS level, spot, n, leaf AS node FROM leaves),
  {fold("lowest", "nodes")},
  subroots AS (SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS spot, count(*) OVER () AS n FROM nodes WHERE n = 1),
  tops AS (SELECT '*' AS tree, 0 AS level, spot, n, node FROM subroots),
  {fold("tops", "upper")},
  paths AS (SELECT l.doc_id, l.leaf, l.tree, l.spot AS id, 0 AS level, l.spot, l.n, false AS above, CASE WHEN changed THEN other ELSE leaf END AS node, '' AS proof FROM leaves l
    UNION ALL
    SELECT p.doc_id, p.leaf, p.tree, p.id, CASE WHEN p.n = 1 THEN 0 ELSE p.level + 1 END, CASE WHEN p.n = 1 THEN t.spot ELSE p.spot // 2 END,
      CASE WHEN p.n = 1 THEN t.n ELSE ((p.n + 1) // 2)::BIGINT END, p.above OR p.n = 1,
      CASE WHEN p.n = 1 THEN p.node ELSE {turned.format("p.node")} END, p.proof || CASE WHEN p.n = 1 THEN '' ELSE coalesce(s.node, '') END
    FROM paths p JOIN subroots t ON t.tree = p.tree
    LEFT JOIN (SELECT * FROM nodes UNION ALL SELECT * FROM upper) s
      ON s.tree = CASE WHEN p.above THEN '*' ELSE p.tree END AND s.level = p.level AND s.spot = xor(p.spot, 1) AND p.n > 1
    WHERE p.n > 1 OR NOT p.above)
SELECT doc_id, leaf, t.node AS subroot, u.node AS root, sha256(proof) AS proof_sha256, p.node AS folded_root, p.node = u.node AS verified
FROM paths p JOIN subroots t USING (tree), (SELECT node FROM upper WHERE n = 1) u WHERE p.above AND p.n = 1"""

#: Rows of ``documents`` with a number, as ids may repeat.
NUMBERED = "numbered AS (SELECT *, row_number() OVER () AS rid FROM documents)"
SPACES = "[^\\x20\\x09-\\x0D]+"

_WORD = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"
DECONTAMINATION = f"""WITH {NUMBERED},
  texts AS (SELECT rid, doc_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, {_WORD}) AS ws FROM numbered),
  items AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, {_WORD}) AS ws FROM benchmark WHERE item_id IS NOT NULL),
  windows AS (SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS w
    FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM (SELECT *, least(10, len(ws)) AS n FROM items WHERE len(ws) > 0))),
  lengths AS (SELECT DISTINCT n FROM windows),
  spots AS (SELECT rid, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM texts, lengths)),
  found AS (SELECT DISTINCT rid, n, i, w FROM spots SEMI JOIN windows USING (n, w)),
  hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM found) GROUP BY rid),
  named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT rid, item FROM found JOIN windows USING (n, w)) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)"""

SUBSTRING_DEDUP = f"""WITH {NUMBERED},
  texts AS (SELECT rid, doc_id, regexp_extract_all(coalesce(text, ''), '{SPACES}') AS ws FROM numbered),
  windows AS (SELECT rid, doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS w FROM (SELECT *, unnest(range(1, len(ws) - 18)) AS i FROM texts)),
  first_ones AS (SELECT w, min((doc_id, rid, i)) AS f FROM windows GROUP BY w),
  gone AS (SELECT DISTINCT rid, unnest(range(i, i + 20)) AS p FROM windows JOIN first_ones USING (w) WHERE f <> (doc_id, rid, i)),
  words AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM texts),
  kept AS (SELECT rid, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (rid, p) GROUP BY rid),
  removed AS (SELECT rid, count(*) AS n FROM gone GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (rid) LEFT JOIN removed USING (rid)"""

SUFFIX_DEDUP = f"""WITH {NUMBERED},
  texts AS (SELECT rid, doc_id, encode(coalesce(text, '')) AS b, strlen(coalesce(text, '')) AS n FROM numbered),
  strings AS (SELECT rid, i, md5(array_slice(b, i, i + 199)) AS s FROM (SELECT rid, b, unnest(range(1, n - 198)) AS i FROM texts WHERE n >= 200)),
  again AS (SELECT rid, i FROM strings SEMI JOIN (SELECT s FROM strings GROUP BY s HAVING count(*) > 1) USING (s)),
  spans AS (SELECT rid, min(i) AS a, max(i) + 199 AS z FROM (SELECT *, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS run
    FROM (SELECT *, CASE WHEN i > coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i), -1000) + 200 THEN 1 ELSE 0 END AS fresh FROM again)) GROUP BY rid, run),
  edges AS (SELECT rid, count(*) AS n_spans, sum(z - a + 1) AS n_removed, list(a ORDER BY a) AS starts, list(z ORDER BY a) AS ends FROM spans GROUP BY rid),
  kept AS (SELECT rid, string_agg(hex(array_slice(b, f, t)), '' ORDER BY f) AS h FROM
    (SELECT rid, b, unnest(list_concat([1], list_transform(ends, lambda e: e + 1))) AS f, unnest(list_concat(list_transform(starts, lambda s: s - 1), [n])) AS t
      FROM texts JOIN edges USING (rid)) WHERE t >= f GROUP BY rid)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  CASE WHEN e.rid IS NULL THEN sha256(b) ELSE sha256(unhex(coalesce(h, ''))) END AS kept_sha256
FROM texts LEFT JOIN edges e USING (rid) LEFT JOIN kept USING (rid)"""

JACCARD_JOIN = f"""WITH RECURSIVE {NUMBERED},
  texts AS (SELECT rid, doc_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '{SPACES}') AS ws FROM numbered),
  sets AS MATERIALIZED (SELECT DISTINCT rid, md5(array_to_string(ws[i:i + 4], ' ')) AS s FROM (SELECT *, unnest(range(1, greatest(2, len(ws) - 3))) AS i FROM texts WHERE len(ws) > 0)),
  sizes AS MATERIALIZED (SELECT rid, count(*) AS n FROM sets GROUP BY rid),
  pairs AS MATERIALIZED (SELECT p, q FROM (SELECT a.rid AS p, b.rid AS q, count(*) AS shared FROM sets a JOIN sets b ON a.s = b.s AND a.rid <> b.rid GROUP BY ALL) x
    JOIN sizes i ON i.rid = p JOIN sizes j ON j.rid = q WHERE 100 * shared >= 80 * (i.n + j.n - shared)),
  reached AS (SELECT rid AS p, rid AS q FROM texts UNION SELECT r.p, l.q FROM reached r JOIN pairs l ON l.p = r.q),
  groups AS (SELECT p AS rid, min(doc_id) AS component_id FROM reached JOIN texts t ON t.rid = q GROUP BY p),
  links AS (SELECT p AS rid, count(*) AS n_links FROM pairs GROUP BY p)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM texts JOIN groups USING (rid) LEFT JOIN sizes USING (rid) LEFT JOIN links USING (rid)"""
