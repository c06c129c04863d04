"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each query is written against the driver's parquet views. Rules are written
anew in SQL; prompt templates, instructions, stop words and white space are
taken from the package (golden tests cover these): named CTE fragments (below) are assembled per
query together with their dependencies. RE2 has no look-around, so the
splits use the sentinel trick (insert ``chr(1)`` and split on it); RE2 ``\\w``
is ASCII, so word characters are spelled ``[\\p{L}\\p{N}_]``.
"""

from __future__ import annotations

from ..functions.stopwords import english_stop_words
from ..functions.text import DIGIT, PY_WS, WS
from .templates import (COMMON_PARTS, DEFAULT_DOC_TITLE, DEFAULT_TITLE_A, DEFAULT_TITLE_B, NO_NEIGHBOURS,
                        PAIR_TYPES, QUESTION_TYPES, SYSTEM_PROMPT, TEMPLATES)

NL = "chr(10)"


WS_LIT = "(" + " || ".join(f"chr({ord(c)})" for c in PY_WS) + ")"


def _ws_strip(x: str) -> str:
    """Python ``str.strip()``."""
    return f"trim({x}, {WS_LIT})"


def _sq(s: str) -> str:
    """A SQL string literal (DuckDB), newlines spelled with chr(10)."""
    parts = s.split("\n")
    lits = ["'" + p.replace("'", "''") + "'" for p in parts]
    return "(" + f" || {NL} || ".join(lits) + ")" if len(lits) > 1 else lits[0]


def _h(x: str) -> str:
    return f"('0x' || substr(md5({x}), 1, 8))::BIGINT"


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTES[name] = (deps, sql)


# --- derived markdown corpus --------------------------------------------------
cte("md_documents", (), f"""
SELECT doc_id, 'doc_' || doc_id AS document_name,
  (CASE WHEN doc_id % 3 = 0 THEN ''
        WHEN doc_id % 30 = 1 THEN '---' || {NL} || 'title: Doc --- ' || doc_id || {NL} || 'lang: ' || lang || {NL} || '---' || {NL}
        WHEN doc_id % 30 = 2 THEN '---' || {NL} || 'title: Doc ' || doc_id || {NL}
        WHEN doc_id % 30 = 4 THEN '---' || {NL} || 'title: Doc ' || doc_id || {NL} || 'keywords:' || {NL} || '  - ' || lang
                                  || {NL} || '  - corpus' || {NL} || '---' || {NL}
        WHEN doc_id % 30 = 7 THEN '---' || {NL} || 'title: Doc ' || doc_id || {NL}
             || CASE doc_id % 90 WHEN 7 THEN 'no mapping here' WHEN 37 THEN '  lang: ' || lang
                ELSE 'part:' || {NL} || '    pages: 3' || {NL} || '  name: two' END || {NL} || '---' || {NL}
        WHEN doc_id % 30 = 8 THEN array_to_string(['---', 'title: Doc ' || doc_id, 'origin:', '  name: ' || source, '  languages:',
             '  - ' || lang, '  - xx', 'lang: none', 'parts:', '  - name: one', '    pages: ' || (doc_id % 50),
             '  - name: two # unread', 'empty:', 'lang: ' || lang, '---', ''], {NL})
        WHEN doc_id % 30 = 10 THEN array_to_string(['---', 'title: Doc ' || doc_id, 'summary: >', '  written in', '  ' || lang, '',
             '  from: ' || source, 'note: |-', '  - a', '    b', 'open: true', '---', ''], {NL})
        ELSE '---' || {NL} || 'title: Doc ' || doc_id || {NL} || 'lang: ' || lang || {NL} || 'source: ' || source || {NL} || '---' || {NL} END)
  || array_to_string(list_transform(string_split(text, {NL}), lambda l, j:
       CASE (j - 1) % 4
         WHEN 0 THEN repeat('#', (1 + ((j - 1) // 4) % 3)::INT) || ' ' || substr(l, 1, 60) || {NL} || l
                     || CASE WHEN (j - 1) % 28 = 4 THEN ' NO_CONTENT_HERE' ELSE '' END
         WHEN 1 THEN {NL} || l
         WHEN 2 THEN {NL} || '- ' || replace(replace(l, '. ', '.' || {NL} || CASE WHEN doc_id % 4 = 1 THEN '  - ' ELSE '- ' END),
                                             CASE WHEN doc_id % 8 = 5 THEN ' the ' ELSE chr(2) END, ' the' || {NL} || '    - ')
         ELSE l || CASE WHEN doc_id % 5 = 0 THEN ' {{{{FIGURE_' || (doc_id % 7) || '.' || (j - 1) || '}}}}' ELSE '' END
       END), {NL}) AS raw
FROM documents""")

# --- frontmatter ----------------------------------------------------------------
cte("fm0", ("md_documents",), f"""
SELECT doc_id, document_name, raw,
  CASE WHEN starts_with(raw, '---') AND instr(substr(raw, 4), '---') > 0
       THEN instr(substr(raw, 4), '---') + 3 ELSE 0 END AS close_pos
FROM md_documents""")

# The tree by joins: every line's scope, every node's parent (the nearest node before it that is indented less).
FM_KEY = """'^("[^"]*"|''[^'']*''|[^ \t#:"''\\[\\]{}&*!|>%@`,?-][^:"'']*?)[ \t]*:(?:[ \t]+(.*))?$'"""
FM_HEAD, FM_QUOTED = "'^[|>][+-]?$'", """'^"[^"]*"$|^''[^'']*''$'"""


def _unquoted(x: str) -> str:
    return f"""regexp_replace({x}, '^"([^"]*)"$|^''([^'']*)''$', '\\1\\2')"""


cte("fm_lines", ("fm0",), f"""
SELECT *, length(pre) AS col, regexp_matches(rest, {FM_KEY}) AS is_key,
  CASE WHEN regexp_matches(rest, {FM_KEY}) THEN {_ws_strip(f"regexp_extract(rest, {FM_KEY}, 2)")} ELSE rest END AS val,
  list_filter(range(length(pre)), lambda c: substr(pre, c + 1, 1) = '-') AS dashes
FROM (SELECT *, {_ws_strip("substr(l, length(pre) + 1)")} AS rest
      FROM (SELECT *, length(regexp_extract(l, '^ *')) AS ind, regexp_extract(l, '^ *(?:-(?: +|$))*') AS pre
            FROM (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i
                  FROM (SELECT doc_id, string_split(replace({_ws_strip("substr(raw, 4, close_pos - 4)")}, chr(13), ''), {NL}) AS ls
                        FROM fm0 WHERE close_pos > 0))))""")

cte("fm_blocks", ("fm_lines",), f"""
SELECT h.doc_id, h.i AS a, coalesce(min(m.i), 1 << 30) AS z
FROM fm_lines h LEFT JOIN fm_lines m ON m.doc_id = h.doc_id AND m.i > h.i AND {_ws_strip("m.l")} <> ''
  AND m.ind <= CASE WHEN h.is_key THEN h.col ELSE coalesce(list_last(h.dashes), 0) END
WHERE regexp_matches(h.val, {FM_HEAD}) AND NOT starts_with(h.rest, '#')
GROUP BY 1, 2""")

cte("fm_scoped", ("fm_lines", "fm_blocks"), f"""
SELECT *, EXISTS (SELECT 1 FROM fm_blocks b WHERE b.doc_id = n.doc_id AND n.i > b.a AND n.i < b.z) AS verbatim,
  {_ws_strip("l")} = '' OR starts_with(rest, '#') AND len(dashes) = 0 AS skipped,
  CASE WHEN regexp_matches(val, {FM_QUOTED}) THEN val ELSE regexp_replace(val, '(^|\\s+)#.*$', '') END AS plain
FROM fm_lines n""")

cte("fm_nodes", ("fm_scoped",), f"""
SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS id
FROM (SELECT doc_id, i * 1000000 + c AS pos, 2 * c + 1 AS ind, 'item' AS kind, NULL AS key
      FROM (SELECT doc_id, i, unnest(dashes) AS c FROM fm_scoped WHERE NOT verbatim AND NOT skipped)
      UNION ALL
      SELECT doc_id, i * 1000000 + 500000, 2 * col, 'key', {_unquoted(f"regexp_extract(rest, {FM_KEY}, 1)")}
      FROM fm_scoped WHERE NOT verbatim AND NOT skipped AND is_key)""")

cte("fm_texts", ("fm_scoped",), """
SELECT doc_id, i * 1000000 + 600000 AS pos, l AS t, 1 << 30 AS ind FROM fm_scoped WHERE verbatim
UNION ALL
SELECT doc_id, i * 1000000 + 600000, plain, CASE WHEN is_key OR len(dashes) > 0 THEN 1 << 30 ELSE 2 * col END
FROM fm_scoped WHERE NOT verbatim AND NOT skipped AND plain <> ''""")

cte("fm_parents", ("fm_nodes",), """
SELECT n.doc_id, n.id, n.ind, n.kind, n.key, coalesce(max(p.id), 0) AS parent
FROM fm_nodes n LEFT JOIN fm_nodes p ON p.doc_id = n.doc_id AND p.pos < n.pos AND p.ind < n.ind
GROUP BY ALL""")

cte("fm_owned", ("fm_texts", "fm_nodes"), """
SELECT t.doc_id, t.pos, t.t, coalesce(max(p.id) FILTER (p.ind < t.ind), 0) AS parent, coalesce(max(p.id), 0) AS latest
FROM fm_texts t LEFT JOIN fm_nodes p ON p.doc_id = t.doc_id AND p.pos < t.pos
GROUP BY ALL""")

cte("fm_values", ("fm_owned",), f"""
SELECT doc_id, parent AS id, list(t ORDER BY pos) AS ts FROM fm_owned GROUP BY ALL""")

cte("fm_broken", ("fm_scoped", "fm_parents", "fm_owned", "fm_values"), f"""
SELECT doc_id FROM fm_scoped WHERE NOT verbatim AND NOT skipped AND regexp_matches(l, '^ *\t')
UNION SELECT doc_id FROM fm_parents WHERE parent = 0 AND kind = 'item'
UNION SELECT doc_id FROM fm_owned WHERE parent = 0 OR parent <> latest
UNION SELECT doc_id FROM fm_parents GROUP BY doc_id, parent
      HAVING count(DISTINCT kind) > 1 OR count(DISTINCT ind) FILTER (kind = 'key') > 1
UNION SELECT p.doc_id FROM fm_parents p JOIN fm_owned o ON o.doc_id = p.doc_id AND o.parent = p.parent
UNION SELECT doc_id FROM fm_values
      WHERE NOT regexp_matches(ts[1], {FM_HEAD}) AND NOT (regexp_matches(ts[1], {FM_QUOTED}) AND len(ts) = 1)
        AND (regexp_matches(ts[1], '^["'']') OR list_bool_or(list_transform(ts, lambda t: regexp_matches(t, ':(\\s|$)'))))""")

cte("fm_alive", ("fm_parents", "fm_broken"), """
SELECT *, CASE WHEN kind = 'item' THEN row_number() OVER (PARTITION BY doc_id, parent ORDER BY id) - 1 END AS nth
FROM fm_parents n
WHERE doc_id NOT IN (SELECT doc_id FROM fm_broken)
  AND NOT EXISTS (SELECT 1 FROM fm_parents m WHERE m.doc_id = n.doc_id AND m.parent = n.parent AND m.key = n.key AND m.id > n.id)""")

cte("fm_paths", ("fm_alive",), """
SELECT doc_id, id, key, kind, [kind] AS kinds, id AS top, '$["' || key || '"]' AS path FROM fm_alive WHERE parent = 0
UNION ALL
SELECT n.doc_id, n.id, n.key, n.kind, list_append(p.kinds, n.kind), p.top,
       p.path || CASE WHEN n.kind = 'item' THEN '[' || n.nth || ']' ELSE '["' || n.key || '"]' END
FROM fm_paths p JOIN fm_alive n ON n.doc_id = p.doc_id AND n.parent = p.id""")

cte("fm_strings", ("fm_values",), f"""
SELECT doc_id, id, regexp_matches(ts[1], {FM_HEAD}) AS is_block,
  CASE WHEN NOT regexp_matches(ts[1], {FM_HEAD}) THEN array_to_string(ts, ' ')
       WHEN ends_with(ts[1], '-') OR rtrim(body, {NL}) = '' THEN rtrim(body, {NL})
       WHEN ends_with(ts[1], '+') THEN body || {NL} ELSE rtrim(body, {NL}) || {NL} END AS txt
FROM (SELECT *, CASE WHEN starts_with(ts[1], '>') THEN
          replace(regexp_replace(replace(whole, {NL} || {NL}, chr(1)), {NL}, ' ', 'g'), chr(1), {NL}) ELSE whole END AS body
      FROM (SELECT *, array_to_string(list_transform(ts[2:], lambda r: substr(r, margin + 1)), {NL}) AS whole
            FROM (SELECT *, coalesce(length(regexp_extract(list_filter(ts[2:], lambda r: {_ws_strip("r")} <> '')[1], '^ *')), 0) AS margin
                  FROM fm_values)))""")

cte("fm_steps", ("fm_paths", "fm_strings"), """
SELECT n.*, len(kinds) AS depth, coalesce(s.is_block, false) AS is_block, coalesce(s.txt, '') AS txt,
  lag(len(kinds)) OVER w AS before, lead(len(kinds)) OVER w AS after, lead(kind) OVER w AS next_kind
FROM fm_paths n LEFT JOIN fm_strings s USING (doc_id, id)
WINDOW w AS (PARTITION BY n.doc_id ORDER BY n.id)""")

cte("fm_pieces", ("fm_steps",), f"""
SELECT *, coalesce(after, 0) <= depth AS leaf,
  CASE WHEN before >= depth THEN ',' ELSE '' END || CASE WHEN kind = 'key' THEN to_json(key)::VARCHAR || ':' ELSE '' END AS lead_in,
  CASE WHEN after > depth THEN CASE WHEN next_kind = 'item' THEN '[' ELSE '{{' END
       ELSE CASE WHEN is_block THEN to_json(txt)::VARCHAR WHEN txt IN ('', '~', 'null') THEN 'null'
                 WHEN txt IN ('true', 'false') OR regexp_matches(txt, '^-?(0|[1-9][0-9]*)([.][0-9]+)?$') THEN txt
                 ELSE to_json({_unquoted("txt")})::VARCHAR END
            || array_to_string(list_transform(list_reverse(kinds[coalesce(after, 1) + 1:]),
                                              lambda k: CASE k WHEN 'item' THEN ']' ELSE '}}' END), '') END AS piece
FROM fm_steps""")

cte("fm_flat", ("fm_pieces", "fm_parents"), f"""
SELECT doc_id, list({{'key': key, 'value': value}} ORDER BY first_id) AS metadata
FROM (SELECT doc_id, max(key) FILTER (id = top) AS key,
        CASE WHEN count(*) = 1 THEN {_unquoted("max(txt)")}
             WHEN bool_and(id = top OR leaf AND kind = 'item') THEN
               '[' || string_agg({_unquoted("txt")}, ', ' ORDER BY id) FILTER (id <> top) || ']'
             ELSE string_agg(CASE WHEN id = top THEN '' ELSE lead_in END || piece, '' ORDER BY id) END AS value
      FROM fm_pieces GROUP BY doc_id, top)
JOIN (SELECT doc_id, key, min(id) AS first_id FROM fm_parents WHERE parent = 0 GROUP BY ALL) USING (doc_id, key)
GROUP BY doc_id""")

cte("frontmatter", ("fm0", "fm_broken", "fm_flat"), f"""
SELECT doc_id, document_name, close_pos > 0 AS has_frontmatter, ok OR close_pos = 0 AS fm_parsed,
  coalesce(metadata, []) AS metadata,
  CASE WHEN ok THEN regexp_replace(substr(raw, close_pos + 3), '^\\s+', '') ELSE raw END AS content
FROM (SELECT *, close_pos > 0 AND doc_id NOT IN (SELECT doc_id FROM fm_broken) AS ok FROM fm0) LEFT JOIN fm_flat USING (doc_id)""")

# --- sections -------------------------------------------------------------------
cte("sections", ("frontmatter",), f"""
SELECT doc_id, document_name, section_idx, section,
  CASE WHEN regexp_matches(section, '^#+ ') THEN {_ws_strip("regexp_extract(section, '^#+ ([^' || chr(10) || ']*)', 1)")}
       ELSE 'Section' END AS title,
  {_ws_strip("regexp_replace(section, '^#+ [^' || chr(10) || ']*', '')")} AS body
FROM (
  SELECT doc_id, document_name, unnest(kept) AS section, generate_subscripts(kept, 1) AS section_idx
  FROM (
    SELECT doc_id, document_name,
      list_transform(list_filter(string_split(regexp_replace(content, '(?m)^(#+ )', chr(1) || '\\1', 'g'), chr(1)),
                                 lambda p: {_ws_strip("p")} <> '' AND NOT contains(p, 'NO_CONTENT_HERE')),
                     lambda p: {_ws_strip("p")}) AS kept
    FROM frontmatter))""")

# --- facts ------------------------------------------------------------------------
W = "[\\p{L}\\p{N}_]"
SENT = (
    "list_filter(string_split(replace(replace("
    "regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(p,"
    f" '({W}\\.{W}\\.)', '\\1' || chr(2) || 'Q', 'g'),"
    " '(\\d+\\.\\d+)', '\\1' || chr(2) || 'Q', 'g'),"
    " '([A-Za-z]\\.[A-Za-z]\\.)', '\\1' || chr(2) || 'Q', 'g'),"
    " '([.!?])\\s+([a-z])', '\\1' || chr(3) || '\\2', 'g'),"
    " '([.!?])\\s+', '\\1' || chr(1), 'g'),"
    " chr(2) || 'Q', ''), chr(3), ' '), chr(1)), lambda s: " + _ws_strip("s") + " <> '')"
)
ITEMS = (
    "list_transform((string_split(array_to_string(list_transform("
    f"list_filter(list_transform(string_split(p, {NL}), lambda l: {_ws_strip('l')}), lambda l: l <> ''),"
    " lambda l: CASE WHEN regexp_matches(l, '^(\\d+\\.|\\*|-)\\s') THEN chr(1) || regexp_replace(l, '^(\\d+\\.|\\*|-)\\s+', '')"
    f" ELSE l END), {NL}), chr(1)))[2:],"
    f" lambda c: replace(regexp_replace(c, {NL} || '$', ''), {NL}, ' '))"
)

cte("fact_arrays", ("sections",), f"""
SELECT doc_id, document_name, section_idx, body,
  CASE WHEN len(ff) = 0 AND body <> '' THEN [body] ELSE ff END AS facts
FROM (
  SELECT doc_id, document_name, section_idx, body,
    list_filter(list_transform(flatten(list_transform(
      list_filter(list_transform(string_split(regexp_replace(body, {NL} || '\\s*' || {NL}, chr(1), 'g'), chr(1)),
                                 lambda p: {_ws_strip("p")}), lambda p: p <> ''),
      lambda p: CASE WHEN regexp_matches(p, '^\\s*(\\d+\\.|\\*|-)\\s') THEN {ITEMS} ELSE {SENT} END)),
      lambda f: {_ws_strip("f")}), lambda f: length(f) > 10) AS ff
  FROM sections)""")

cte("facts", ("fact_arrays",), """
SELECT doc_id, document_name, section_idx, unnest(facts) AS fact,
       generate_subscripts(facts, 1) - 1 AS fact_number
FROM fact_arrays""")


# --- images ---------------------------------------------------------------------
REF_RE = "'\\{\\{([^}]+)\\}\\}'"
cte("content_refs", ("frontmatter",), f"""
SELECT doc_id, document_name, unnest(r) AS ref, generate_subscripts(r, 1) AS ref_pos
FROM (SELECT doc_id, document_name, regexp_extract_all(content, {REF_RE}, 1) AS r FROM frontmatter)""")

cte("manifest", ("content_refs",), f"""
SELECT unnest(CASE b WHEN 0 THEN [document_name || '/' || ref || '.png']
                     WHEN 1 THEN [document_name || '/' || ref || '.jpg', 'markdown_docs/' || document_name || '/' || ref || '.png']
                     WHEN 2 THEN ['markdown_docs/' || document_name || '/' || ref || '.jpeg']
                     ELSE [] END) AS path
FROM (SELECT DISTINCT document_name, ref, {_h("document_name || ref")} % 4 AS b FROM content_refs)""")

cte("section_refs", ("sections",), f"""
SELECT doc_id, document_name, section_idx, unnest(r) AS ref, generate_subscripts(r, 1) AS ref_pos
FROM (SELECT doc_id, document_name, section_idx, regexp_extract_all(section, {REF_RE}, 1) AS r FROM sections)""")

cte("trunc_refs", ("sections",), f"""
SELECT doc_id, document_name, section_idx, unnest(r) AS ref, generate_subscripts(r, 1) AS ref_pos
FROM (SELECT doc_id, document_name, section_idx, regexp_extract_all(section, {REF_RE}, 1) AS r FROM sections)""")

CANDS = """(VALUES (1, '', '.png'), (2, '', '.jpg'), (3, '', '.jpeg'),
        (4, 'markdown_docs/', '.png'), (5, 'markdown_docs/', '.jpg'), (6, 'markdown_docs/', '.jpeg')) c(prio, pre, ext)"""


def _resolved(src: str, keys: str) -> str:
    return f"""
SELECT {keys}, ref_pos, ref, arg_min(path, prio) AS image_path
FROM (SELECT r.*, c.prio, c.pre || r.document_name || '/' || r.ref || c.ext AS path FROM {src} r, {CANDS})
WHERE path IN (SELECT path FROM manifest)
GROUP BY {keys}, ref_pos, ref"""


cte("section_resolved", ("section_refs", "manifest"), _resolved("section_refs", "doc_id, document_name, section_idx"))
cte("trunc_resolved", ("trunc_refs", "manifest"), _resolved("trunc_refs", "doc_id, document_name, section_idx"))
cte("content_resolved", ("content_refs", "manifest"), _resolved("content_refs", "doc_id, document_name"))

cte("section_images", ("section_resolved",), """
SELECT doc_id, section_idx, list(image_path ORDER BY ref_pos) AS image_paths FROM section_resolved GROUP BY ALL""")
cte("trunc_images", ("trunc_resolved",), """
SELECT doc_id, section_idx, list(image_path ORDER BY ref_pos) AS image_paths FROM trunc_resolved GROUP BY ALL""")

# --- neighbours -------------------------------------------------------------------
TOK_RE = "'[\\p{L}\\p{N}_]{2,}'"
STOP = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in english_stop_words()) + ")"
cte("nsec", ("sections",), "SELECT doc_id, count(*) AS n FROM sections GROUP BY doc_id")
cte("ctf", ("sections",), f"""
SELECT doc_id, section_idx, term, count(*) AS tf
FROM (SELECT doc_id, section_idx, unnest(regexp_extract_all(lower(section), {TOK_RE})) AS term FROM sections)
WHERE term NOT IN {STOP}
GROUP BY ALL""")
cte("vocab", ("ctf", "nsec"), """
SELECT v.doc_id, v.term, ln((1.0 + n) / (1.0 + dfreq)) + 1 AS idf
FROM (SELECT doc_id, term, count(*) AS dfreq FROM ctf GROUP BY doc_id, term) v JOIN nsec USING (doc_id)""")
cte("cw", ("ctf", "vocab"), """
SELECT doc_id, section_idx, term, tf, idf,
       tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id, section_idx)) AS weight
FROM ctf JOIN vocab USING (doc_id, term)""")
cte("qw", ("sections", "vocab"), f"""
SELECT doc_id, section_idx, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id, section_idx)) AS weight
FROM (SELECT doc_id, section_idx, term, count(*) AS tf
      FROM (SELECT doc_id, section_idx, unnest(regexp_extract_all(lower(section), {TOK_RE})) AS term FROM sections)
      GROUP BY ALL) JOIN vocab USING (doc_id, term)""")
cte("fqw", ("facts", "vocab"), f"""
SELECT doc_id, section_idx, fact_number, term,
       tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id, section_idx, fact_number)) AS weight
FROM (SELECT doc_id, section_idx, fact_number, term, count(*) AS tf
      FROM (SELECT doc_id, section_idx, fact_number, unnest(regexp_extract_all(lower(fact), {TOK_RE})) AS term FROM facts)
      GROUP BY ALL) JOIN vocab USING (doc_id, term)""")


def _knn(qsrc: str, qkeys: list[str], self_col: str) -> str:
    qk = ", ".join(f"q.{k}" for k in qkeys)
    part = ", ".join(f"p.{k}" for k in qkeys)
    on = " AND ".join(f"d.{k} = p.{k}" for k in qkeys)
    return f"""
SELECT {", ".join(qkeys)}, nbr_idx, sim, row_number() OVER (PARTITION BY {", ".join(qkeys)} ORDER BY rk)::BIGINT AS rank
FROM (
  SELECT {part}, p.c AS nbr_idx, coalesce(d.sim, 0.0) AS sim, nsec.n,
         row_number() OVER (PARTITION BY {part} ORDER BY round(coalesce(d.sim, 0.0), 6) DESC, p.c) AS rk
  FROM (SELECT DISTINCT {qk}, s.section_idx AS c FROM {qsrc} q JOIN sections s ON s.doc_id = q.doc_id) p
  JOIN nsec ON nsec.doc_id = p.doc_id
  LEFT JOIN (SELECT {qk}, c.section_idx AS c, sum(q.weight * c.weight) AS sim
             FROM {qsrc}_w q JOIN cw c ON c.doc_id = q.doc_id AND c.term = q.term GROUP BY ALL) d
    ON {on} AND d.c = p.c)
WHERE rk <= least(3, n - 1) AND nbr_idx <> {self_col}"""


cte("qsec", ("sections",), "SELECT doc_id, section_idx FROM sections")
cte("qsec_w", ("qw",), "SELECT * FROM qw")
cte("qfact", ("facts",), "SELECT doc_id, section_idx, fact_number FROM facts")
cte("qfact_w", ("fqw",), "SELECT * FROM fqw")
cte("section_neighbours", ("qsec", "qsec_w", "cw", "nsec"), _knn("qsec", ["doc_id", "section_idx"], "section_idx"))
cte("fact_neighbours", ("qfact", "qfact_w", "cw", "nsec"),
    _knn("qfact", ["doc_id", "section_idx", "fact_number"], "section_idx"))

cte("neighbour_ctx", ("section_neighbours", "sections", "trunc_images", "section_images"), f"""
SELECT s.doc_id, s.section_idx,
  coalesce(n.ntext, 'No additional relevant sections found') AS neighbour_text,
  coalesce(n.nimgs, []) AS neighbour_images,
  coalesce(si.image_paths, []) AS own_images
FROM sections s
LEFT JOIN (SELECT nb.doc_id, nb.section_idx,
             string_agg(t.section, {NL} || {NL} ORDER BY nb.rank) AS ntext,
             flatten(list(coalesce(ti.image_paths, []) ORDER BY nb.rank)) AS nimgs
           FROM section_neighbours nb
           JOIN sections t ON t.doc_id = nb.doc_id AND t.section_idx = nb.nbr_idx
           LEFT JOIN trunc_images ti ON ti.doc_id = nb.doc_id AND ti.section_idx = nb.nbr_idx
           GROUP BY nb.doc_id, nb.section_idx) n
  ON n.doc_id = s.doc_id AND n.section_idx = s.section_idx
LEFT JOIN section_images si ON si.doc_id = s.doc_id AND si.section_idx = s.section_idx""")

# --- requests -----------------------------------------------------------------------
def _concat(parts: list[tuple[str, str | None]], slot_sql: dict[str, str]) -> str:
    out = []
    for lit, slot in parts:
        if lit:
            out.append(_sq(lit))
        if slot:
            out.append(slot_sql[slot])
    return "(" + " || ".join(out) + ")"


def _title(col: str, default: str) -> str:
    return (f"CASE WHEN regexp_matches({col}, '^#+ ') THEN "
            + _ws_strip(f"regexp_extract({col}, '^#+ ([^' || chr(10) || ']*)', 1)") + f" ELSE {_sq(default)} END")


def _body(col: str) -> str:
    return _ws_strip(f"regexp_replace({col}, '^#+ [^' || chr(10) || ']*', '')")


def _img_name(p: str) -> str:
    b = f"regexp_extract({p}, '[^/]*$')"
    return f"CASE WHEN regexp_matches({b}, '^\\.[^.]*$') THEN {b} ELSE regexp_replace({b}, '\\.[^./]*$', '') END"


cte("doc_ctx", ("frontmatter",), f"""
SELECT doc_id, doc_title, metadata_txt, {_concat(COMMON_PARTS, {"doc_title": "doc_title"})} AS instructions
FROM (SELECT doc_id,
        coalesce(list_filter(metadata, lambda e: e.key = 'title')[1].value, {_sq(DEFAULT_DOC_TITLE)}) AS doc_title,
        CASE WHEN len(metadata) > 0 THEN 'Document metadata:' || {NL}
             || array_to_string(list_transform(metadata, lambda e: '- ' || e.key || ': ' || e.value), {NL}) || {NL}
             ELSE '' END AS metadata_txt
      FROM frontmatter)""")

cte("seeds", ("fact_arrays",), f"""
SELECT doc_id, section_idx,
  CASE WHEN len(facts) > 0 THEN facts[({_h("doc_id || '|' || section_idx || '|FACTUAL_RECALL'")} % len(facts)) + 1]
       ELSE body END AS seed_fact
FROM fact_arrays""")

cte("ph", ("sections",), "SELECT doc_id, section_idx, md5(section) AS h FROM sections")
cte("partners", ("ph", "nsec"), f"""
SELECT * FROM (
  SELECT a.doc_id, a.section_idx,
    CASE WHEN c.h <> a.h THEN c.section_idx WHEN f.h1 <> a.h THEN 1 ELSE s2.m2 END AS partner_idx
  FROM (SELECT ph.*, ((section_idx + {_h("doc_id || '|' || section_idx || '|partner'")} % (n - 1)) % n) + 1 AS cand
        FROM ph JOIN nsec USING (doc_id) WHERE n >= 2) a
  JOIN ph c ON c.doc_id = a.doc_id AND c.section_idx = a.cand
  JOIN (SELECT doc_id, h AS h1 FROM ph WHERE section_idx = 1) f ON f.doc_id = a.doc_id
  LEFT JOIN (SELECT ph.doc_id, min(ph.section_idx) AS m2 FROM ph JOIN (SELECT doc_id, h AS h1 FROM ph WHERE section_idx = 1) f1
             ON f1.doc_id = ph.doc_id WHERE ph.h <> f1.h1 GROUP BY ph.doc_id) s2 ON s2.doc_id = a.doc_id)
WHERE partner_idx IS NOT NULL""")

cte("sctx", ("sections", "doc_ctx", "neighbour_ctx", "seeds", "partners"), f"""
SELECT s.doc_id, s.document_name, s.section_idx, s.section, s.title, s.body, d.doc_title, d.metadata_txt,
  d.instructions, sd.seed_fact, p.partner_idx, nc.neighbour_text,
  list_concat(nc.own_images, nc.neighbour_images) AS all_images,
  CASE WHEN len(list_concat(nc.own_images, nc.neighbour_images)) > 0 THEN
    'Images attached to this request:' || {NL} || array_to_string(list_transform(list_concat(nc.own_images, nc.neighbour_images),
      lambda p: '- image ' || {_img_name("p")} || ': ' || p), {NL})
    || {NL} || 'Refer to an image only where it helps the question.' || {NL} || {NL}
  ELSE '' END AS images_block,
  {_title("s.section", DEFAULT_TITLE_A)} AS title_a,
  coalesce({_title("b.section", DEFAULT_TITLE_B)}, '') AS title_b,
  coalesce({_body("b.section")}, '') AS body2
FROM sections s
JOIN doc_ctx d ON d.doc_id = s.doc_id
JOIN neighbour_ctx nc ON nc.doc_id = s.doc_id AND nc.section_idx = s.section_idx
LEFT JOIN seeds sd ON sd.doc_id = s.doc_id AND sd.section_idx = s.section_idx
LEFT JOIN partners p ON p.doc_id = s.doc_id AND p.section_idx = s.section_idx
LEFT JOIN sections b ON b.doc_id = s.doc_id AND b.section_idx = p.partner_idx""")

cte("fact_nctx", ("fact_neighbours", "sections"), f"""
SELECT fn.doc_id, fn.section_idx, fn.fact_number,
       string_agg(t.section, {NL} || {NL} ORDER BY fn.rank) AS fact_neighbour_text
FROM fact_neighbours fn JOIN sections t ON t.doc_id = fn.doc_id AND t.section_idx = fn.nbr_idx
GROUP BY fn.doc_id, fn.section_idx, fn.fact_number""")

TYPES_SQL = "(VALUES " + ", ".join(f"({o}, '{t}', '{d}')" for o, t, d in QUESTION_TYPES) + ") t(ordinal, question_type, difficulty)"
_PAIRS = "(" + ", ".join(f"'{t}'" for t in PAIR_TYPES) + ")"


def _render(fact_rows: bool) -> str:
    slots = {"metadata": "metadata_txt", "instructions": "instructions", "section": "section",
             "neighbours": "neighbour_text", "images": "images_block", "title": "title", "body": "body",
             "title_a": "title_a", "title_b": "title_b", "body2": "body2",
             "seed_fact": "''" if fact_rows else "coalesce(seed_fact, '')",
             "fact": "fact" if fact_rows else "''",
             "fact_neighbours": "fact_neighbour_text" if fact_rows else "''"}
    whens = "\n".join(f"    WHEN '{t}' THEN {_concat(parts, slots)}" for t, parts in TEMPLATES.items())
    return f"CASE question_type\n{whens}\n  END"


cte("requests", ("sctx", "facts", "fact_nctx"), f"""
SELECT md5(concat_ws('|', doc_id, section_idx, question_type, fact_number)) AS request_id, *,
       CASE WHEN question_type = 'SECTION_SUMMARY' THEN true END AS is_summary,
       (section_idx - 1) // 100 AS batch_id
FROM (
  SELECT doc_id, document_name, section_idx, NULL::INTEGER AS fact_number, question_type, difficulty, ordinal,
         {_render(False)} AS prompt, all_images AS images
  FROM sctx, {TYPES_SQL}
  WHERE question_type <> 'FACT_BASED' AND (question_type NOT IN {_PAIRS} OR partner_idx IS NOT NULL)
  UNION ALL
  SELECT doc_id, document_name, section_idx, fact_number, question_type, difficulty, ordinal,
         {_render(True)} AS prompt, all_images AS images
  FROM (SELECT f.doc_id, f.section_idx, f.fact_number, f.fact, c.* EXCLUDE (doc_id, section_idx),
               coalesce(n.fact_neighbour_text, {_sq(NO_NEIGHBOURS)}) AS fact_neighbour_text
        FROM facts f JOIN sctx c ON c.doc_id = f.doc_id AND c.section_idx = f.section_idx
        LEFT JOIN fact_nctx n ON n.doc_id = f.doc_id AND n.section_idx = f.section_idx AND n.fact_number = f.fact_number),
       {TYPES_SQL}
  WHERE question_type = 'FACT_BASED')""")


def _chat_json(prompt: str, images: str) -> str:
    sys_msg = f"to_json({{'role': 'system', 'content': {_sq(SYSTEM_PROMPT)}}})"
    parts = (f"list_concat([to_json({{'type': 'text', 'text': {prompt}}})::VARCHAR], "
             f"list_transform({images}, lambda p: to_json({{'type': 'image_url', 'image_url': {{'url': p}}}})::VARCHAR))")
    return (f"('[' || {sys_msg} || ',' || '{{\"role\":\"user\",\"content\":[' || array_to_string({parts}, ',') || ']}}' || ']')")

# --- responses ---------------------------------------------------------------------
cte("responses", ("requests", "sections", "section_images"), f"""
SELECT request_id, attempt,
  CASE WHEN form <= 4 THEN good WHEN form = 5 THEN no_answer
       WHEN form = 6 THEN 'Sure. Here is the pair:' || {NL} || '```json' || {NL} || good || {NL} || '```' || {NL} || 'Hope it helps.'
       WHEN form = 7 THEN '{{' || chr(7) || substr(replace(good, '"', chr(39)), 2)
       WHEN form = 8 AND attempt = 1 THEN NULL
       WHEN form = 8 THEN 'I am unable to produce a pair for this section.'
       ELSE good || ' and ' || good END AS text
FROM (
  SELECT request_id, attempt, head || ', "answer": "A ' || md5(section) || '"}}' AS good, head || '}}' AS no_answer,
         CASE WHEN {_h("request_id")} % 50 = 0 THEN 8 WHEN attempt = 3 THEN 0
              ELSE {_h("request_id || attempt")} % 10 END AS form
  FROM (SELECT r.request_id, s.section, s.doc_id, s.section_idx,
               '{{"question": "Q ' || r.question_type || ' ' || r.section_idx || '", "question_images": '
               || to_json(coalesce(si.image_paths, []::VARCHAR[])) AS head
        FROM requests r JOIN sections s ON s.doc_id = r.doc_id AND s.section_idx = r.section_idx
        LEFT JOIN section_images si ON si.doc_id = r.doc_id AND si.section_idx = r.section_idx),
       (VALUES (1), (2), (3)) a(attempt)
  WHERE attempt < 3 OR {_h("concat_ws('|', doc_id, section_idx)")} % 7 <> 0)""")

cte("parsed", ("responses",), """
SELECT request_id, attempt, status,
  CASE WHEN status = 'ok' THEN json_extract_string(js, '$.question') END AS question,
  CASE WHEN status = 'ok' THEN json_extract_string(js, '$.answer') END AS answer,
  CASE WHEN status = 'ok' THEN
    CASE WHEN json_type(js, '$.question_images') IS NULL OR json_type(js, '$.question_images') = 'NULL' THEN []::VARCHAR[]
         WHEN json_type(js, '$.question_images') = 'ARRAY' THEN from_json(json_extract(js, '$.question_images'), '["VARCHAR"]')
         ELSE [json_extract_string(js, '$.question_images')] END END AS question_images,
  CASE WHEN status = 'ok' THEN list_contains(json_keys(js), 'question') END AS has_question,
  CASE WHEN status = 'ok' THEN list_contains(json_keys(js), 'answer') END AS has_answer
FROM (SELECT *, CASE WHEN text IS NULL THEN 'no_response' WHEN js = '' THEN 'no_json'
                     WHEN NOT json_valid(js) OR json_type(js) <> 'OBJECT' THEN 'bad_json' ELSE 'ok' END AS status
      FROM (SELECT *, regexp_extract(text, '(?s)\\{.*\\}') AS js FROM responses))""")

UNIT_COLS = "doc_id, section_idx, question_type"
cte("grid", ("requests", "parsed"), f"""
SELECT r.request_id, r.doc_id, r.section_idx, r.question_type, r.document_name, r.fact_number, r.difficulty,
       r.is_summary, ua.attempt, coalesce(p.status, 'no_response') AS status, p.question, p.answer,
       p.question_images, p.has_question, p.has_answer
FROM requests r
JOIN (SELECT DISTINCT r2.doc_id, r2.section_idx, r2.question_type, p2.attempt
      FROM parsed p2 JOIN requests r2 ON r2.request_id = p2.request_id) ua
  ON ua.doc_id = r.doc_id AND ua.section_idx = r.section_idx AND ua.question_type = r.question_type
LEFT JOIN parsed p ON p.request_id = r.request_id AND p.attempt = ua.attempt""")

cte("outcomes", ("grid",), f"""
SELECT {UNIT_COLS}, attempt, bool_and(status = 'ok') AS ok,
       CASE WHEN min(coalesce(fact_number, -1)) FILTER (WHERE status <> 'ok') >= 0
            THEN min(coalesce(fact_number, -1)) FILTER (WHERE status <> 'ok') END AS fact_number,
       arg_min(status, coalesce(fact_number, -1)) FILTER (WHERE status <> 'ok') AS error
FROM grid GROUP BY {UNIT_COLS}, attempt""")

cte("firsts", ("outcomes",), f"""
SELECT {UNIT_COLS}, min(attempt) FILTER (WHERE ok) AS first_ok, max(attempt) AS last_attempt
FROM outcomes GROUP BY {UNIT_COLS}""")

cte("failures", ("outcomes", "firsts"), f"""
SELECT o.doc_id, o.section_idx, o.question_type, o.attempt, o.fact_number, o.error
FROM outcomes o JOIN firsts f USING ({UNIT_COLS})
WHERE NOT o.ok AND (f.first_ok IS NULL OR o.attempt < f.first_ok)""")

cte("qa", ("grid", "firsts"), f"""
SELECT g.* FROM grid g JOIN firsts f USING ({UNIT_COLS}) WHERE g.attempt = f.first_ok""")

cte("still", ("outcomes", "firsts"), f"""
SELECT {UNIT_COLS}, any_value(f.last_attempt) AS attempts,
       arg_max({{'e': o.error, 'f': o.fact_number}}, o.attempt).e AS last_error,
       arg_max({{'e': o.error, 'f': o.fact_number}}, o.attempt).f AS fact_number
FROM firsts f JOIN outcomes o USING ({UNIT_COLS}) WHERE f.first_ok IS NULL
GROUP BY {UNIT_COLS}""")


# --- dataset --------------------------------------------------------------------------
def _user_json(q: str, imgs: str) -> str:
    parts = (f"list_concat([to_json({{'type': 'text', 'text': {q}}})::VARCHAR], list_transform({imgs}, lambda u: "
             f"to_json({{'type': 'image_url', 'image_url': {{'url': u, 'detail': 'auto'}}}})::VARCHAR))")
    return f"""('{{"role":"user","content":[' || array_to_string({parts}, ',') || ']}}')"""


def _asst_json(a: str) -> str:
    return f"to_json({{'role': 'assistant', 'content': {a}}})::VARCHAR"


def _records(src: str, imgs: str) -> str:
    qt, df = "coalesce(question_type, 'UNKNOWN')", "coalesce(difficulty, 'UNKNOWN')"
    user, asst = _user_json("coalesce(question, '')", imgs), _asst_json("coalesce(answer, '')")
    return f"""
SELECT request_id, doc_id, document_name, section_idx, fact_number,
       CASE WHEN {qt} = 'SECTION_SUMMARY' THEN 'eval' ELSE 'train' END AS split,
       {qt} AS question_type, {df} AS difficulty,
       '{{"messages":[' || {user} || ',' || {asst} || '],'
         || substr(to_json({{'question_type': {qt}, 'difficulty': {df}}})::VARCHAR, 2) AS record,
       '[' || {user} || ',' || {asst} || ']' AS messages
FROM {src}
WHERE coalesce(has_question, false) AND coalesce(has_answer, false)"""


cte("records", ("qa",), _records("qa", "coalesce(question_images, []::VARCHAR[])"))
cte("audit_qa", ("qa",), f"""
SELECT * REPLACE (list_transform(coalesce(question_images, []::VARCHAR[]), lambda u:
         CASE WHEN {_h("u || request_id")} % 6 = 0 THEN u || '.missing' ELSE u END) AS question_images)
FROM qa""")
cte("audit_records", ("audit_qa",), "SELECT split || '-' || document_name AS file, request_id AS rec_key, messages FROM ("
    + _records("audit_qa", "question_images") + ")")
cte("image_uses", ("audit_records",), """
SELECT file, rec_key, p.image_url.url AS image_url, context
FROM (SELECT file, rec_key, context, unnest(from_json(m.content, '[{"type":"VARCHAR","image_url":{"url":"VARCHAR"}}]')) AS p
      FROM (SELECT file, rec_key, json_extract_string(messages, '$[1].content') AS context,
                   unnest(from_json(messages, '[{"role":"VARCHAR","content":"JSON"}]')) AS m
            FROM audit_records)
      WHERE m.role = 'user')
WHERE p.type = 'image_url'""")
cte("invalid_images", ("image_uses", "manifest"), """
SELECT * FROM image_uses WHERE image_url NOT IN (SELECT path FROM manifest)""")
cte("file_verdicts", ("audit_records", "invalid_images"), """
SELECT f.file, coalesce(b.n, 0)::BIGINT AS n_invalid, true AS readable, coalesce(b.n, 0) = 0 AS valid
FROM (SELECT DISTINCT file FROM audit_records) f
LEFT JOIN (SELECT file, count(*) AS n FROM invalid_images GROUP BY file) b USING (file)""")

# --- paragraph-level views ----------------------------------------------------------
cte("paras", ("sections",), f"""
SELECT doc_id, section_idx, unnest(ps) AS p, generate_subscripts(ps, 1) AS para_idx
FROM (SELECT doc_id, section_idx,
             list_filter(list_transform(string_split(regexp_replace(body, {NL} || '\\s*' || {NL}, chr(1), 'g'), chr(1)),
                                        lambda p: {_ws_strip("p")}), lambda p: p <> '') AS ps
      FROM sections)""")

LINKED = (
    "list_transform(flat, lambda it, i: CASE WHEN it.indent > 0 THEN "
    "coalesce(list_filter(flat[1:i - 1], lambda q: q.indent < it.indent)[-1].head, '') || ' - ' || it.text ELSE it.text END)"
)
cte("linked_items", ("paras",), f"""
SELECT doc_id, section_idx, para_idx, {LINKED} AS items
FROM (SELECT doc_id, section_idx, para_idx,
        list_transform((string_split(array_to_string(list_transform(
            list_filter(string_split(p, {NL}), lambda l: {_ws_strip('l')} <> ''),
            lambda l: CASE WHEN regexp_matches({_ws_strip('l')}, '^(\\d+\\.|\\*|-)\\s')
                           THEN chr(1) || (length(l) - length(regexp_replace(l, '^\\s+', ''))) || ':'
                                || regexp_replace({_ws_strip('l')}, '^(\\d+\\.|\\*|-)\\s+', '')
                           ELSE {_ws_strip('l')} END), {NL}), chr(1)))[2:],
          lambda c: {{'indent': regexp_extract(c, '^([0-9]+):', 1)::INT,
                      'head': regexp_extract(regexp_replace(c, '^[0-9]+:', ''), '^([^' || {NL} || ']*)', 1),
                      'text': replace(regexp_replace(regexp_replace(c, '^[0-9]+:', ''), {NL} || '$', ''), {NL}, ' ')}}) AS flat
      FROM paras WHERE regexp_matches(p, '^\\s*(\\d+\\.|\\*|-)\\s'))""")


def with_ctes(*names: str, body: str, instead: dict[str, tuple[tuple[str, ...], str]] | None = None) -> str:
    """The body after the named fragments and all they need; ``instead`` replaces fragments."""
    ctes = {**CTES, **(instead or {})}
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in ctes[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    defs = ",\n".join(f"{n} AS ({ctes[n][1]}\n)" for n in order)
    # regex classes with Python's Unicode meaning: \s -> Python whitespace, \d -> decimal digit
    return f"WITH RECURSIVE {defs}\n{body}".replace("\\s", WS).replace("\\d", DIGIT)


# sections of volumes of 500 documents, numbered through
VOLUMES = {"plain_sections": CTES["sections"], "sections": (("plain_sections",), """
SELECT doc_id // 500 AS doc_id, row_number() OVER (PARTITION BY doc_id // 500 ORDER BY doc_id, section_idx) AS section_idx,
       section
FROM plain_sections""")}

# the limits of published datasets: 2,000 characters of a section, 500 terms of a document
BOUNDED = {"ctf": (("sections",), f"""
SELECT doc_id, section_idx, term, count(*) AS tf
FROM (SELECT doc_id, section_idx, unnest(regexp_extract_all(lower(substr(section, 1, 2000)), {TOK_RE})) AS term
      FROM sections)
WHERE term NOT IN {STOP}
GROUP BY ALL"""), "vocab": (("ctf", "nsec"), """
SELECT v.doc_id, v.term, ln((1.0 + n) / (1.0 + dfreq)) + 1 AS idf
FROM (SELECT doc_id, term, count(*) AS dfreq FROM ctf GROUP BY doc_id, term
      QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY sum(tf) DESC, term) <= 500) v JOIN nsec USING (doc_id)""")}


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    neighbours = """
SELECT doc_id, section_idx::BIGINT AS section_idx, rank, nbr_idx::BIGINT AS nbr_idx,
       round(round(sim, 6) * 1e6)::BIGINT AS sim_e6 FROM section_neighbours"""
    q["volume_section_neighbours"] = with_ctes("section_neighbours", instead=VOLUMES, body=neighbours.replace(
        "doc_id,", "doc_id AS volume_id,", 1))
    q["bounded_section_neighbours"] = with_ctes("section_neighbours", instead=BOUNDED, body=neighbours)
    q["bounded_term_weights"] = with_ctes("cw", instead=BOUNDED, body="""
SELECT doc_id, section_idx::BIGINT AS section_idx, term, tf::BIGINT AS tf,
       round(idf * 1e6)::BIGINT AS idf_e6, round(weight * 1e6)::BIGINT AS weight_e6 FROM cw""")
    q["document_names"] = with_ctes("md_documents", body="""
SELECT doc_id, document_name, length(raw)::BIGINT AS raw_len, md5(raw) AS raw_md5 FROM md_documents""")
    q["frontmatter_split"] = with_ctes("frontmatter", body="""
SELECT doc_id, has_frontmatter, fm_parsed, length(content)::BIGINT AS content_len, md5(content) AS content_md5
FROM frontmatter""")
    q["frontmatter_metadata"] = with_ctes("frontmatter", body="""
SELECT doc_id, (generate_subscripts(metadata, 1))::BIGINT AS key_pos,
       unnest(metadata).key AS meta_key, unnest(metadata).value AS meta_value
FROM frontmatter""")
    q["frontmatter_tree"] = with_ctes("fm_pieces", body=f"""
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY id) AS leaf_pos, path, {_unquoted("txt")} AS value,
       CASE WHEN is_block OR txt NOT IN ('', '~', 'null') THEN {_unquoted("txt")} END AS tree_value
FROM fm_pieces WHERE leaf""")
    q["metadata_check"] = with_ctes("frontmatter", body="""
SELECT doc_id, document_name, k AS missing_key
FROM frontmatter, (VALUES ('title'), ('description')) t(k)
WHERE NOT list_contains(list_transform(metadata, lambda e: e.key), k)""")
    q["sections"] = with_ctes("sections", body="""
SELECT doc_id, section_idx::BIGINT AS section_idx, title, length(section)::BIGINT AS section_len,
       md5(section) AS section_md5, md5(body) AS body_md5
FROM sections""")
    q["facts"] = with_ctes("facts", body="""
SELECT doc_id, section_idx::BIGINT AS section_idx, fact_number::BIGINT AS fact_number, fact
FROM facts""")
    q["image_refs"] = with_ctes("section_refs", body="""
SELECT doc_id, section_idx::BIGINT AS section_idx, ref_pos::BIGINT AS ref_pos, ref FROM section_refs""")
    q["image_resolution"] = with_ctes("section_resolved", body="""
SELECT doc_id, section_idx::BIGINT AS section_idx, ref_pos::BIGINT AS ref_pos, ref, image_path FROM section_resolved""")
    q["missing_images"] = with_ctes("section_refs", "section_resolved", body="""
SELECT doc_id, section_idx::BIGINT AS section_idx, ref_pos::BIGINT AS ref_pos, ref FROM section_refs r
WHERE NOT EXISTS (SELECT 1 FROM section_resolved x WHERE x.doc_id = r.doc_id AND x.section_idx = r.section_idx
                  AND x.ref_pos = r.ref_pos)""")
    q["image_preflight"] = with_ctes("content_refs", "content_resolved", body="""
SELECT r.doc_id, count(*)::BIGINT AS n_refs, count(x.image_path)::BIGINT AS n_resolved,
       count(*) FILTER (WHERE x.image_path IS NULL)::BIGINT AS n_missing
FROM content_refs r LEFT JOIN content_resolved x ON x.doc_id = r.doc_id AND x.ref_pos = r.ref_pos
GROUP BY r.doc_id""")
    q["section_images"] = with_ctes("section_resolved", body="""
SELECT doc_id, section_idx::BIGINT AS section_idx,
       row_number() OVER (PARTITION BY doc_id, section_idx ORDER BY ref_pos)::BIGINT AS image_pos, image_path,
       CASE WHEN regexp_matches(b, '^\\.[^.]*$') THEN b ELSE regexp_replace(b, '\\.[^./]*$', '') END AS image_name,
       CASE lower(regexp_extract(b, '\\.([^.]*)$', 1)) WHEN 'png' THEN 'image/png' WHEN 'jpg' THEN 'image/jpeg'
            WHEN 'jpeg' THEN 'image/jpeg' ELSE 'application/octet-stream' END AS mime_type
FROM (SELECT *, regexp_extract(image_path, '[^/]*$') AS b FROM section_resolved)""")
    q["term_weights"] = with_ctes("cw", body="""
SELECT doc_id, section_idx::BIGINT AS section_idx, term, tf::BIGINT AS tf,
       round(idf * 1e6)::BIGINT AS idf_e6, round(weight * 1e6)::BIGINT AS weight_e6 FROM cw""")
    q["section_neighbours"] = with_ctes("section_neighbours", body="""
SELECT doc_id, section_idx::BIGINT AS section_idx, rank, nbr_idx::BIGINT AS nbr_idx,
       round(round(sim, 6) * 1e6)::BIGINT AS sim_e6 FROM section_neighbours""")
    q["fact_neighbours"] = with_ctes("fact_neighbours", body="""
SELECT doc_id, section_idx::BIGINT AS section_idx, fact_number::BIGINT AS fact_number, rank,
       nbr_idx::BIGINT AS nbr_idx, round(round(sim, 6) * 1e6)::BIGINT AS sim_e6 FROM fact_neighbours""")
    q["neighbour_context"] = with_ctes("neighbour_ctx", body="""
SELECT doc_id, section_idx::BIGINT AS section_idx, length(neighbour_text)::BIGINT AS neighbour_len,
       md5(neighbour_text) AS neighbour_md5, array_to_string(neighbour_images, '|') AS neighbour_images,
       array_to_string(list_concat(own_images, neighbour_images), '|') AS all_images,
       len(list_concat(own_images, neighbour_images))::BIGINT AS n_images
FROM neighbour_ctx""")
    q["request_grid"] = with_ctes("requests", body="""
SELECT request_id, doc_id, section_idx::BIGINT AS section_idx, fact_number::BIGINT AS fact_number, question_type,
       difficulty, is_summary, batch_id::BIGINT AS batch_id FROM requests""")
    q["recall_seed_fact"] = with_ctes("seeds", body="""
SELECT doc_id, section_idx::BIGINT AS section_idx, seed_fact FROM seeds""")
    q["partner_sections"] = with_ctes("partners", body="""
SELECT doc_id, section_idx::BIGINT AS section_idx, partner_idx::BIGINT AS partner_idx FROM partners""")
    q["rendered_prompts"] = with_ctes("requests", body="""
SELECT request_id, question_type, length(prompt)::BIGINT AS prompt_len, md5(prompt) AS prompt_md5,
       len(images)::BIGINT AS n_images FROM requests""")
    q["chat_requests"] = with_ctes("requests", body=f"""
SELECT request_id, length(j)::BIGINT AS chat_len, md5(j) AS chat_md5
FROM (SELECT request_id, {_chat_json("prompt", "images")} AS j FROM requests)""")
    q["json_substring"] = with_ctes("responses", body="""
SELECT request_id, attempt::BIGINT AS attempt, js <> '' AS has_json, length(js)::BIGINT AS json_len, md5(js) AS json_md5,
       md5(regexp_extract(regexp_replace(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x9f]', '', 'g'), '(?s)\\{.*\\}'))
         AS sanitized_md5
FROM (SELECT *, regexp_extract(text, '(?s)\\{.*\\}') AS js FROM responses)""")
    q["parsed_responses"] = with_ctes("parsed", body="""
SELECT request_id, attempt::BIGINT AS attempt, status, question, answer,
       array_to_string(question_images, '|') AS question_images, has_question, has_answer FROM parsed""")
    q["failed_sections"] = with_ctes("failures", body="""
SELECT doc_id, section_idx::BIGINT AS section_idx, question_type, attempt::BIGINT AS attempt,
       fact_number::BIGINT AS fact_number, error FROM failures""")
    q["retry_first_success"] = with_ctes("firsts", body="""
SELECT doc_id, section_idx::BIGINT AS section_idx, question_type, first_ok::BIGINT AS first_ok
FROM firsts WHERE first_ok IS NOT NULL""")
    q["still_failing"] = with_ctes("still", body="""
SELECT doc_id, section_idx::BIGINT AS section_idx, question_type, attempts::BIGINT AS attempts, last_error,
       fact_number::BIGINT AS fact_number FROM still""")
    q["pending_requests"] = with_ctes("requests", "firsts", body="""
SELECT r.request_id, (coalesce(f.last_attempt, 0) + 1)::BIGINT AS next_attempt
FROM requests r LEFT JOIN firsts f USING (doc_id, section_idx, question_type)
WHERE f.first_ok IS NULL AND coalesce(f.last_attempt, 0) + 1 <= 51""")
    q["capped_pending_requests"] = with_ctes("requests", "firsts", body="""
SELECT r.request_id, (coalesce(f.last_attempt, 0) + 1)::BIGINT AS next_attempt
FROM requests r LEFT JOIN firsts f USING (doc_id, section_idx, question_type)
WHERE f.first_ok IS NULL AND coalesce(f.last_attempt, 0) + 1 <= 3""")
    q["request_batches"] = with_ctes("requests", body="""
SELECT request_id, ((section_idx - 1) // 5)::BIGINT AS batch_id FROM requests""")
    q["chat_records"] = with_ctes("records", body="""
SELECT request_id, split, question_type, difficulty, length(record)::BIGINT AS record_len, md5(record) AS record_md5
FROM records""")
    q["dataset_array_files"] = with_ctes("records", body="""
SELECT s.split || '-' || d.document_name AS name, true AS complete, coalesce(n, 0)::BIGINT AS n_records, records_md5
FROM (SELECT DISTINCT document_name FROM records) d CROSS JOIN (VALUES ('train'), ('eval')) s(split)
LEFT JOIN (SELECT split, document_name, count(*) AS n, md5(string_agg(md5(record), '' ORDER BY md5(record))) AS records_md5
           FROM records GROUP BY ALL) r ON r.document_name = d.document_name AND r.split = s.split""")
    q["quarantine"] = with_ctes("qa", body="""
SELECT request_id, doc_id, section_idx::BIGINT AS section_idx, fact_number::BIGINT AS fact_number, question_type,
       'missing_key' AS reason
FROM qa WHERE NOT (coalesce(has_question, false) AND coalesce(has_answer, false))""")
    q["train_eval_counts"] = with_ctes("records", body="""
SELECT document_name, count(*) FILTER (WHERE split = 'train')::BIGINT AS n_train,
       count(*) FILTER (WHERE split = 'eval')::BIGINT AS n_eval
FROM records GROUP BY document_name""")
    q["type_stats"] = with_ctes("requests", "records", "qa", "failures", "still", body=f"""
SELECT question_type, difficulty, sum(req)::BIGINT AS n_requests, sum(qa)::BIGINT AS n_qa,
       sum(quar)::BIGINT AS n_quarantined, sum(fail)::BIGINT AS n_failed_attempts, sum(still)::BIGINT AS n_still_failing
FROM (
  SELECT question_type, difficulty, 1 AS req, 0 AS qa, 0 AS quar, 0 AS fail, 0 AS still FROM requests
  UNION ALL SELECT question_type, difficulty, 0, 1, 0, 0, 0 FROM records
  UNION ALL SELECT question_type, difficulty, 0, 0, 1, 0, 0 FROM qa
            WHERE NOT (coalesce(has_question, false) AND coalesce(has_answer, false))
  UNION ALL SELECT f.question_type, t.difficulty, 0, 0, 0, 1, 0 FROM failures f JOIN {TYPES_SQL} USING (question_type)
  UNION ALL SELECT s.question_type, t.difficulty, 0, 0, 0, 0, 1 FROM still s JOIN {TYPES_SQL} USING (question_type))
GROUP BY ROLLUP (question_type, difficulty)
HAVING question_type IS NULL OR difficulty IS NOT NULL""")
    q["invalid_images"] = with_ctes("invalid_images", body="""
SELECT file, rec_key AS request_id, image_url, context, substr(context, 1, 100) AS preview FROM invalid_images""")
    q["file_verdicts"] = with_ctes("file_verdicts", body="SELECT file, n_invalid, readable, valid FROM file_verdicts")
    q["dataset_verdict"] = with_ctes("file_verdicts", body="""
SELECT coalesce(bool_and(valid), true) AS all_valid, count(*)::BIGINT AS n_files FROM file_verdicts""")
    q["list_items"] = with_ctes("paras", body=f"""
SELECT doc_id, section_idx::BIGINT AS section_idx, para_idx::BIGINT AS para_idx,
       generate_subscripts(items, 1)::BIGINT AS item_pos, unnest(items) AS item
FROM (SELECT doc_id, section_idx, para_idx, {ITEMS} AS items FROM paras
      WHERE regexp_matches(p, '^\\s*(\\d+\\.|\\*|-)\\s'))""")
    q["list_items_linked"] = with_ctes("linked_items", body="""
SELECT doc_id, section_idx::BIGINT AS section_idx, para_idx::BIGINT AS para_idx,
       generate_subscripts(items, 1)::BIGINT AS item_pos, unnest(items) AS item
FROM linked_items""")
    q["sentences"] = with_ctes("paras", body=f"""
SELECT doc_id, section_idx::BIGINT AS section_idx, para_idx::BIGINT AS para_idx,
       generate_subscripts(ss, 1)::BIGINT AS sent_pos, unnest(ss) AS sentence
FROM (SELECT doc_id, section_idx, para_idx, {SENT} AS ss FROM paras
      WHERE NOT regexp_matches(p, '^\\s*(\\d+\\.|\\*|-)\\s'))""")
    return q
