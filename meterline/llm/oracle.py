"""The same results in DuckDB SQL, where SQL can express them."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"'[^\x20\x09-\x0D]+'"

EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, {LOWER.format("coalesce(text, '')")} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
       sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""


def quality_rules(documents: str) -> str:
    """The measures, verdicts and source rows of a table; CTEs that end in ``judged``."""
    return f"""
d AS (SELECT row_number() OVER () AS rid, *, coalesce(text, '') AS t FROM {documents}),
w AS (SELECT *, regexp_extract_all(t, {WORD}) AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {WORD})) AS ls FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS g
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
rep AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, range(5) r(k) GROUP BY rid),
m AS (SELECT w.*, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
      FROM w LEFT JOIN cov USING (rid)),
f AS (SELECT *, n_words < 10 AS short, 100 * n_repeat_words > 20 * n_words AS repeated FROM m),
h AS (SELECT source, count(*) AS n, sum(short::INT) AS fs, sum(repeated::INT) AS fr
      FROM f WHERE source <> '' GROUP BY source),
p AS (SELECT avg(fs / n) AS ms, var_pop(fs / n) AS vs, avg(fr / n) AS mr, var_pop(fr / n) AS vr FROM h),
s AS (SELECT *, greatest(ms * (1 - ms) / nullif(vs, 0) - 1, 0) AS ss,
             greatest(mr * (1 - mr) / nullif(vr, 0) - 1, 0) AS sr FROM p),
v AS (SELECT source FROM h, s
      WHERE greatest(CASE WHEN vs > 0 THEN (fs + ms * ss) / (n + ss) ELSE ms END,
                     CASE WHEN vr > 0 THEN (fr + mr * sr) / (n + sr) ELSE mr END) > 0.5),
judged AS (SELECT f.*, short OR repeated AS base_failed,
                  NOT (short OR repeated) AND v.source IS NULL AS kept
           FROM f LEFT JOIN v ON f.source = v.source)
"""


QUALITY_RULES = f"""
WITH {quality_rules("documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
FROM judged
"""

WARC_BUNDLES = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, strlen(t) AS payload_bytes, sha1(t) AS payload_digest FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS keep FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN keep END AS refers_to
FROM k
"""


def line_dedup(documents: str) -> str:
    """Lines with their keys, and the text of each row without repeated lines; CTEs that end in ``cleaned``."""
    blanks = r"'[\x20\x09-\x0D]'"
    stripped = f"regexp_replace(regexp_replace(line, '^' || {blanks} || '+', ''), {blanks} || '+$', '')"
    return f"""
ld AS (SELECT row_number() OVER () AS lrid, *, string_split(coalesce(text, ''), chr(10)) AS ls FROM {documents}),
ll AS (SELECT lrid, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM ld),
lk AS (SELECT lrid, line, pos, {LOWER.format(stripped)} AS k FROM ll),
rl AS (SELECT k FROM lk WHERE k <> '' GROUP BY k HAVING count(DISTINCT lrid) >= 10),
lm AS (SELECT lrid, count(*) AS n_lines, count(rl.k) AS n_dropped,
              coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (rl.k IS NULL), '') AS kept
       FROM lk LEFT JOIN rl ON lk.k = rl.k GROUP BY lrid),
cleaned AS (SELECT ld.*, n_lines, n_dropped, kept FROM ld JOIN lm USING (lrid))
"""


LINE_DEDUP = f"""
WITH {line_dedup("documents")}
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM cleaned
"""
TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
RANKED_SEARCH = f"""
WITH q AS (
  SELECT item_id, irow, unnest(list_distinct(regexp_extract_all({LOWER.format("coalesce(text, '')")}, {TERM}))) AS term
  FROM (SELECT *, row_number() OVER () AS irow FROM benchmark)
),
d AS (
  SELECT drow, doc_id, ts, len(ts) AS n
  FROM (SELECT row_number() OVER () AS drow, doc_id,
          regexp_extract_all({LOWER.format("coalesce(text, '')")}, {TERM}) AS ts FROM documents)
),
c AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM d WHERE n > 0),
p AS (
  SELECT drow, term, count(*) AS tf FROM (SELECT drow, unnest(ts) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY drow, term
),
w AS (
  SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY term, nn
),
s AS (
  SELECT item_id, irow, drow, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nn) // ll))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN d USING (drow), c
  GROUP BY item_id, irow, drow, doc_id
),
r AS (
  SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY irow ORDER BY score DESC, doc_id ASC NULLS LAST, drow)::INTEGER AS rank
  FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""


def crc32(text: str) -> str:
    """The checksum of an ASCII text: eight shifts a byte by the reversed polynomial."""
    shift = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    byte = f"list_reduce([xor(s, b)] || range(8), lambda c, i: {shift})"
    codes = f"list_transform(string_split({text}, ''), lambda a: ascii(a)::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda s, b: {byte}), 4294967295)"


def merkle_leaf(text: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


def merkle_levels(name: str, leaves: str) -> str:
    """All nodes of all trees, level by level; nodes of a run share ``up``."""
    return f"""
{name} AS (
  SELECT tree, 0 AS level, pos, n, node FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 16, n
)"""


def merkle_steps(leaves: str, nodes: str) -> str:
    """(key, level, l, r): the siblings on the path of each leaf."""
    return f"""
SELECT f.key, a.level,
  coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
  coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
FROM {leaves} f
JOIN {nodes} a ON a.tree = f.tree AND a.n > 1 AND a.pos = f.pos // (16 ** a.level)::BIGINT
JOIN {nodes} b ON b.tree = a.tree AND b.level = a.level AND b.pos // 16 = a.pos // 16
GROUP BY f.key, a.level, a.pos"""


MERKLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {merkle_leaf("text")} AS leaf,
    CASE WHEN {crc32("doc_id::VARCHAR")} % 5 = 0 THEN {merkle_leaf(LOWER.format("text"))} END AS altered
  FROM documents
),
leaves AS (
  SELECT *, leaf AS node, coalesce('=' || source, '') AS tree,
    row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS key,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n
  FROM d
),
{merkle_levels("nodes", "leaves")},
subroots AS (
  SELECT '' AS tree, tree AS key, node, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1
),
{merkle_levels("upper", "subroots")},
low AS ({merkle_steps("leaves", "nodes")}),
high AS ({merkle_steps("subroots", "upper")}),
steps AS (
  SELECT key, level, l, r FROM low
  UNION ALL
  SELECT leaves.key, 1000 + level, l, r FROM leaves JOIN high ON leaves.tree = high.key
),
lists AS (
  SELECT key, list({{'l': l, 'r': r}} ORDER BY level) AS path, string_agg(l || r, '' ORDER BY level) AS proof
  FROM steps GROUP BY key
),
found AS (
  SELECT doc_id, leaf, subroots.node AS subroot, (SELECT node FROM upper WHERE n = 1) AS root,
    sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce([coalesce(altered, leaf)] || coalesce(list_transform(path, lambda p: p.l || '+' || p.r), []),
      lambda a, p: sha256(string_split(p, '+')[1] || a || string_split(p, '+')[2])) AS folded_root
  FROM leaves JOIN subroots ON leaves.tree = subroots.key LEFT JOIN lists ON lists.key = leaves.key
)
SELECT *, folded_root = root AS verified FROM found
"""

ORACLE_SQL = {
    "op3_warc_bundles": WARC_BUNDLES,
    "op10_line_dedup": LINE_DEDUP,
    "op12_ranked_search": RANKED_SEARCH,
    "op13_merkle_manifest": MERKLE,
    "op8_exact_dedup": EXACT_DEDUP,
    "op9_quality_rules": QUALITY_RULES,
}
