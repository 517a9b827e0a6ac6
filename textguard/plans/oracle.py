"""DuckDB SQL twins of the registered queries (the correctness oracle).

Plain SQL over the driver's tables, composed from a few shared CTEs so each
fixture relation is defined once. DuckDB notes: regexp_replace needs the 'g'
flag; count_if/sum return HUGEINT (cast to BIGINT); string literals keep
backslashes; trim takes an explicit character set.
"""

from __future__ import annotations

from textguard.functions import lexicon as lx
from textguard.functions import rules
from textguard.functions import text as tx
from textguard.plans.fixtures import BATCH, KOREAN_SENTENCES
from textguard.schemas import BLOCK_TARGET, CATEGORY_SETS

_P = lx.sql_lexicon_pattern()
WS = "(' ' || chr(9) || chr(13) || chr(10))"
NL = "chr(10)"
BT = f"'{BLOCK_TARGET}'"


def _sql_list(items) -> str:
    return "[" + ", ".join("'" + i + "'" for i in items) + "]"


def purify_sql(col: str) -> str:
    out = col
    for e in lx.DEFAULT_LEXICON:
        out = f"regexp_replace({out}, '{lx.sql_word_pattern(e.word)}', '{e.stem}', 'g')"
    return out


def kw_sql(col: str) -> str:
    return f"list_sort(list_distinct(regexp_extract_all(lower({col}), '{_P}', 1)))"


def one_line(col: str) -> str:
    return f"regexp_replace({col}, '[\\r\\n]+', ' ', 'g')"


def strip(col: str) -> str:
    return f"trim({col}, {WS})"


def int_or_null(col: str, typ: str = "INTEGER") -> str:
    """Python int(): optional sign and digits only (DuckDB would accept '1.0')."""
    return f"CASE WHEN regexp_matches({strip(col)}, '^[+-]?[0-9]+$') THEN TRY_CAST({strip(col)} AS {typ}) END"


def cat_tokens(col: str) -> str:
    return f"list_sort(list_distinct(list_filter(string_split_regex(trim({col}, ' '), '\\s*[/,]\\s*'), lambda t: length(t) > 0)))"


_SLUR = _sql_list([e.word for e in lx.DEFAULT_LEXICON if e.category == "SLUR"])
_COMM = _sql_list([e.word for e in lx.DEFAULT_LEXICON if e.category == "COMMUNITY"])


def category_sql(kw: str) -> str:
    return (
        f"CASE WHEN list_has_any({kw}, {_SLUR}) AND list_has_any({kw}, {_COMM}) THEN 'COMMUNITY/SLUR' "
        f"WHEN list_has_any({kw}, {_SLUR}) THEN 'SLUR' WHEN list_has_any({kw}, {_COMM}) THEN 'COMMUNITY' ELSE 'NORMAL' END"
    )


# --------------------------------------------------------------------------- fixture CTEs
LABELLED = f"""
lab_k AS (
  SELECT d.doc_id, d.text, l.toxic, l.quality, {kw_sql('d.text')} AS kw
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
),
lab_s AS (SELECT *, CAST(least(5, len(kw)) AS INTEGER) AS severity FROM lab_k),
lab_a AS (
  SELECT *, CAST(CASE WHEN severity >= 4 THEN 1 WHEN severity >= 1 THEN 2 ELSE 0 END AS INTEGER) AS action FROM lab_s
),
labelled AS (
  SELECT doc_id AS row_id,
         text AS source,
         CASE action WHEN 1 THEN {BT} WHEN 2 THEN {purify_sql('text')} ELSE text END AS target,
         action,
         severity,
         {category_sql('kw')} AS category,
         '[' || CASE WHEN len(kw) = 0 THEN 'none' ELSE array_to_string(kw, ', ') END || '] -> '
             || CASE action WHEN 1 THEN 'block' WHEN 2 THEN 'purify' ELSE 'keep' END AS reason,
         CASE WHEN toxic IS NULL THEN 'unlabelled' WHEN toxic = 0 THEN 'clean'
              WHEN quality = 1 THEN 'abuse' ELSE 'abuse, low_quality' END AS origin_tags
  FROM lab_a
)"""

DIRTY = """
dirty AS (
  SELECT row_id, source,
         CASE WHEN action = 1 AND row_id % 5 = 0 THEN source
              WHEN action = 0 AND row_id % 50 = 3 THEN source || '.' ELSE target END AS target,
         action, severity, category, reason,
         CASE WHEN row_id % 7 = 0 THEN 'clean' ELSE origin_tags END AS origin_tags
  FROM labelled
)"""

CONTRACT = """
contract_rows AS (
  SELECT row_id,
         CASE WHEN row_id % 59 = 0 THEN ' ' ELSE source END AS source,
         target,
         CAST(CASE WHEN row_id % 37 = 0 THEN 3 ELSE action END AS INTEGER) AS action,
         CAST(CASE WHEN row_id % 41 = 0 THEN 7 ELSE severity END AS INTEGER) AS severity,
         CASE WHEN row_id % 43 = 0 THEN 'GENDER, SLUR' WHEN row_id % 47 = 0 THEN 'POLITICAL/SLUR' ELSE category END AS category,
         CASE WHEN row_id % 53 = 0 THEN 'no keywords given' ELSE reason END AS reason,
         origin_tags
  FROM dirty
)"""

STRING_TYPED = """
string_typed AS (
  SELECT row_id, source, target,
         CASE WHEN row_id % 97 = 0 THEN 'x' WHEN row_id % 89 = 0 THEN ' 2 ' WHEN row_id % 83 = 0 THEN '1.0'
              ELSE CAST(action AS VARCHAR) END AS action,
         CAST(severity AS VARCHAR) AS severity, category, reason, origin_tags
  FROM dirty
)"""

SPLITS = f"""
sp_counts AS (SELECT action, count(*) AS n_class FROM labelled GROUP BY action),
sp_tot AS (
  SELECT action, n_class, CAST(sum(n_class) OVER () AS BIGINT) AS big_n,
         CAST((sum(n_class) OVER () * 2 + 9) // 10 AS BIGINT) AS big_h
  FROM sp_counts
),
sp_q1 AS (SELECT *, (n_class * big_h) // big_n AS q1, (n_class * big_h) % big_n AS r1 FROM sp_tot),
sp_h AS (
  SELECT *, CAST(q1 + CASE WHEN row_number() OVER (ORDER BY r1 DESC, action) <= big_h - sum(q1) OVER () THEN 1 ELSE 0 END AS BIGINT) AS n_hold
  FROM sp_q1
),
sp_q2 AS (
  SELECT *, (big_h + 1) // 2 AS big_t, (n_hold * ((big_h + 1) // 2)) // big_h AS q2, (n_hold * ((big_h + 1) // 2)) % big_h AS r2
  FROM sp_h
),
sp_quota AS (
  SELECT action, n_class, n_hold,
         CAST(q2 + CASE WHEN row_number() OVER (ORDER BY r2 DESC, action) <= big_t - sum(q2) OVER () THEN 1 ELSE 0 END AS BIGINT) AS n_test
  FROM sp_q2
),
sp_ranked AS (
  SELECT l.*, row_number() OVER (PARTITION BY action ORDER BY md5('42:' || CAST(row_id AS VARCHAR)), row_id) - 1 AS rk
  FROM labelled l
),
splits AS (
  SELECT r.row_id, r.source, r.target, r.action, r.severity, r.category, r.reason, r.origin_tags,
         CASE WHEN rk < q.n_test THEN 'test' WHEN rk < q.n_hold THEN 'valid' ELSE 'train' END AS split
  FROM sp_ranked r JOIN sp_quota q ON r.action = q.action
)"""

RESPONSES = """
responses AS (
  SELECT doc_id,
         CASE doc_id % 6 WHEN 0 THEN 'PASS | 1 | ok' WHEN 1 THEN 'PASS|5|high' WHEN 2 THEN ' BLOCK | 4 | bad | extra'
                         WHEN 3 THEN 'PASS | x | nan' WHEN 4 THEN 'PASS | 2' ELSE 'garbage' END AS raw
  FROM documents
)"""

SCORED_CALLS = """
scored_calls AS (
  SELECT doc_id, CASE WHEN doc_id % 25 = 0 THEN NULL WHEN doc_id % 25 = 1 THEN '' ELSE raw END AS raw
  FROM responses
)"""


def verdicts_cte(name: str, src: str) -> str:
    return f"""
{name}_p AS (
  SELECT doc_id, string_split(raw, '|') AS p, {int_or_null("string_split(raw, '|')[2]")} AS sc FROM {src}
),
{name} AS (
  SELECT doc_id,
         CASE WHEN sc IS NOT NULL THEN {strip('p[1]')} ELSE 'ERROR' END AS decision,
         CAST(coalesce(sc, 5) AS INTEGER) AS score,
         CASE WHEN sc IS NOT NULL THEN coalesce({strip('p[3]')}, 'N/A') ELSE 'Parsing Failed' END AS reason
  FROM {name}_p
),
{name}_routed AS (
  SELECT *, CASE WHEN decision = 'PASS' AND score < 4 THEN 'passed' ELSE 'blocked' END AS route FROM {name}
)"""


BATCH_REPLIES = f"""
br_idx AS (SELECT row_id, target, (row_number() OVER (ORDER BY row_id) - 1) // {BATCH} AS batch FROM labelled),
batch_replies AS (
  SELECT batch,
         coalesce(string_agg(CASE WHEN row_id % 17 <> 3 THEN 'ID:' || CAST(row_id AS VARCHAR) || ' | PASS | 2 | ' || {one_line('target')} END,
                    {NL} ORDER BY row_id), '')
           || {NL} || 'note: batch finished' || {NL} || 'ID:x | PASS | 2' AS raw
  FROM br_idx GROUP BY batch
),
br_lines AS (
  SELECT batch, line, string_split(line, '|') AS f
  FROM (SELECT batch, unnest(string_split(raw, {NL})) AS line FROM batch_replies)
  WHERE contains(line, '|') AND len(string_split(line, '|')) >= 4
),
parsed AS (
  SELECT batch, {int_or_null("string_split(" + strip('f[1]') + ", ':')[2]", "BIGINT")} AS id,
         {strip('f[1]')} AS id_info, {strip('f[2]')} AS decision, {strip('f[3]')} AS score, {strip('f[4]')} AS target
  FROM br_lines
)"""


def keyed_cte(name: str, where: str = "") -> str:
    return f"""
{name} AS (
  SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, doc_id, text,
         regexp_replace(text, '{tx.SANITIZE_RX}', '', 'g') AS key
  FROM documents {where}
)"""


RAWPROC = keyed_cte("raw_k") + "," + keyed_cte("proc_k", "WHERE doc_id NOT IN (120, 121)")

GAPS = """
mism AS (SELECT p.pos AS i, p.key FROM raw_k r JOIN proc_k p ON r.pos = p.pos WHERE r.key <> p.key),
hits AS (
  SELECT m.i, min(t.k) AS n_missing
  FROM mism m CROSS JOIN range(1, 5) t(k) JOIN raw_k r ON r.pos = m.i + t.k AND r.key = m.key
  GROUP BY m.i
)"""

KOREAN = (
    "ko_s AS (SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{s}', '{e}')" for i, (s, e) in enumerate(KOREAN_SENTENCES))
    + ") t(k, text, expected)),\n"
    + f"korean AS (SELECT c.conv_id, c.turn, s.text, s.expected FROM conversations c "
    + f"JOIN ko_s s ON CAST((c.conv_id * 31 + c.turn) % {len(KOREAN_SENTENCES)} AS INTEGER) = s.k)"
)

PREDS = """
preds AS (
  SELECT row_id, action AS label, source, target,
         CAST(row_id % 7 AS DOUBLE) AS l0, CAST(row_id % 5 AS DOUBLE) AS l1, CAST(row_id % 3 AS DOUBLE) AS l2
  FROM labelled
),
pr_e AS (
  SELECT *, exp(l0 - greatest(l0, l1, l2)) AS e0, exp(l1 - greatest(l0, l1, l2)) AS e1, exp(l2 - greatest(l0, l1, l2)) AS e2
  FROM preds
),
pr AS (
  SELECT *, e0 / (e0 + e1 + e2) AS p0, e1 / (e0 + e1 + e2) AS p1, e2 / (e0 + e1 + e2) AS p2,
         CAST(CASE WHEN l0 >= l1 AND l0 >= l2 THEN 0 WHEN l1 >= l2 THEN 1 ELSE 2 END AS INTEGER) AS prediction
  FROM pr_e
)"""

FEWSHOT = f"""
fewshot AS (
  SELECT string_agg({one_line('source')} || chr(9) || {one_line('target')} || {NL}, '' ORDER BY row_id) AS fewshot,
         count(*) AS n_examples
  FROM (SELECT * FROM labelled WHERE action = 2 ORDER BY row_id LIMIT 3)
)"""


PACKED = f"""
pk_idx AS (SELECT row_id, source, row_number() OVER (ORDER BY row_id) - 1 AS idx FROM labelled),
packed AS (
  SELECT idx // {BATCH} AS batch, min(row_id) AS first_id, count(*) AS n_rows,
         string_agg('ID:' || CAST(row_id AS VARCHAR) || ' | TEXT:' || {one_line('source')}, {NL} ORDER BY idx) AS body
  FROM pk_idx GROUP BY idx // {BATCH}
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


ORACLE: dict[str, str] = {}


def register(name: str, *ctes: str, body: str) -> None:
    if name in ORACLE:
        raise KeyError(f"duplicate oracle entry {name}")
    ORACLE[name] = with_ctes(*ctes, body=body) if ctes else body


L = LABELLED
D = (LABELLED, DIRTY)

# =========================================================================== R
register("r11_label", L, body="SELECT * FROM labelled")
register(
    "r3_action_from_severity",
    body=f"""
SELECT doc_id, severity, CAST(CASE WHEN severity >= 4 THEN 1 WHEN severity >= 1 THEN 2 ELSE 0 END AS INTEGER) AS action
FROM (SELECT doc_id, CAST(least(5, len(regexp_extract_all(lower(text), '{_P}', 1))) AS INTEGER) AS severity FROM documents)""",
)
_T = strip("text")
register(
    "r4_ending_rule",
    KOREAN,
    body=f"""
SELECT conv_id, turn, text, expected, label, CAST(CASE WHEN label = 'COMMUNITY' THEN 2 ELSE 0 END AS INTEGER) AS action
FROM (
  SELECT *, CASE WHEN regexp_matches({_T}, '{rules.ENDS_WITH_NO}') AND regexp_matches({_T}, '{rules.INTERROGATIVE_RX}') THEN 'NORMAL'
                 WHEN regexp_matches({_T}, '{rules.ENDS_WITH_NO}') THEN 'COMMUNITY'
                 WHEN regexp_matches({_T}, '{rules.COMMUNITY_END_RX}') THEN 'COMMUNITY' END AS label
  FROM korean
)""",
)
register("r5_purify", body=f"SELECT doc_id, {purify_sql('text')} AS purified FROM documents")
register("r5_purify_by_join", body=f"SELECT doc_id, {purify_sql('text')} AS purified FROM documents")
register("r5_purify_by_automaton", body=f"SELECT doc_id, {purify_sql('text')} AS purified FROM documents")
register(
    "r6_large_lexicon",
    body="""
SELECT d.doc_id, coalesce(h.keywords, '') AS keywords, CAST(coalesce(h.n, 0) AS INTEGER) AS n_hits, coalesce(h.categories, 'NORMAL') AS categories
FROM documents d LEFT JOIN (
  SELECT doc_id, array_to_string(list_sort(list(DISTINCT word)), ',') AS keywords, count(*) AS n, array_to_string(list_sort(list(DISTINCT word[1])), '/') AS categories
  FROM (SELECT doc_id, lower(unnest(regexp_extract_all(text, '[A-Za-z0-9_]+'))) AS word FROM documents)
  WHERE word IN (SELECT w FROM (SELECT unnest(regexp_extract_all(lower(text), '[A-Za-z0-9_]+')) AS w FROM benchmark) WHERE regexp_matches(w, '^[a-z]{5,}$'))
  GROUP BY doc_id) h ON d.doc_id = h.doc_id""",
)
register("r5_purify_by_map", body=f"SELECT doc_id, {purify_sql('text')} AS purified FROM documents")
register(
    "r6_lexicon_hits",
    body=f"""
SELECT doc_id, array_to_string(kw, ', ') AS keywords, CAST(len(kw) AS INTEGER) AS n_distinct,
       CAST(len(regexp_extract_all(lower(text), '{_P}', 1)) AS INTEGER) AS n_hits,
       {category_sql('kw')} AS categories
FROM (SELECT doc_id, text, {kw_sql('text')} AS kw FROM documents)""",
)
_SQUEEZED = "regexp_replace(text, '[^\\p{L}\\p{N}\\s]', '', 'g')"
register(
    "r7_squeeze_match",
    body=f"SELECT doc_id, CAST(len({kw_sql('text')}) AS INTEGER) AS n_plain, CAST(len({kw_sql(_SQUEEZED)}) AS INTEGER) AS n_squeezed FROM documents",
)
# What is put between letters goes before the words are looked for; in the squeezed text the stems stand where the words stood.
register(
    "r7_purify_obfuscated",
    body=f"SELECT doc_id, CAST(len(regexp_extract_all(lower({_SQUEEZED}), '{_P}', 1)) AS INTEGER) AS n_hits, {purify_sql(_SQUEEZED)} AS purified FROM documents",
)
register(
    "r8_meta_commentary",
    L,
    body=f"""
SELECT row_id, regexp_extract(target, '{rules.META_RX}', 1) AS phrase
FROM (SELECT row_id, source, CASE WHEN action = 2 AND row_id % 2 = 0 THEN target || ' 반성하십시오.' ELSE target END AS target FROM labelled)
WHERE regexp_matches(target, '{rules.META_RX}') AND NOT coalesce(regexp_matches(source, '{rules.META_RX}'), false)""",
)


def _nchar(col, ch):
    return f"CAST(length({col}) - length(replace({col}, '{ch}', '')) AS INTEGER)"


def _nsent(col):
    return f"len(regexp_extract_all({col}, '[.?!]+', 0))"


register(
    "r9_structure_check",
    *D,
    body=f"""
SELECT row_id, {_nsent('source')} = {_nsent('target')} AS sentences_kept,
       {_nchar('source', '?')} = {_nchar('target', '?')} AS questions_kept,
       {_nchar('source', '!')} = {_nchar('target', '!')} AS exclaims_kept
FROM dirty""",
)
register("r10_formal_ending", KOREAN, body=f"SELECT conv_id, turn, regexp_matches({_T}, '{rules.FORMAL_RX}') AS formal FROM korean")

_ALLOWED = _sql_list(CATEGORY_SETS["v0.5"])
register(
    "r1_contract_violations",
    *D,
    CONTRACT,
    f"cr_t AS (SELECT *, {cat_tokens('coalesce(category, ' + chr(39) + chr(39) + ')')} AS toks FROM contract_rows)",
    f"cr_u AS (SELECT *, list_filter(toks, lambda t: NOT list_contains({_ALLOWED}, t)) AS unknown FROM cr_t)",
    body=f"""
SELECT row_id, 'action_domain' AS rule, 'error' AS level, CAST(action AS VARCHAR) AS detail FROM cr_u WHERE action IS NULL OR action NOT IN (0, 1, 2)
UNION ALL SELECT row_id, 'severity_domain', 'error', CAST(severity AS VARCHAR) FROM cr_u WHERE severity IS NULL OR severity NOT BETWEEN 0 AND 5
UNION ALL SELECT row_id, 'category_domain', 'error', array_to_string(unknown, '/') FROM cr_u WHERE len(toks) = 0 OR len(unknown) > 0
UNION ALL SELECT row_id, 'reason_format', 'error', substring(reason, 1, 40) FROM cr_u WHERE NOT coalesce(regexp_matches(reason, '^\\[(.+?)\\] -> (.+)$'), false)
UNION ALL SELECT row_id, 'empty_source', 'error', '' FROM cr_u WHERE length(coalesce({strip('source')}, '')) = 0
UNION ALL SELECT row_id, 'normal_changed', 'warn', '' FROM cr_u WHERE action = 0 AND target IS DISTINCT FROM source""",
)
register("r2_normal_keeps_source", *D, body="SELECT row_id, 'warn' AS level FROM dirty WHERE action = 0 AND target IS DISTINCT FROM source")
register(
    "r12_build_requests",
    L,
    PACKED,
    FEWSHOT,
    body=f"""
SELECT batch, first_id, n_rows,
       concat_ws({NL} || '---' || {NL}, b.text, fewshot.fewshot, packed.body) AS prompt
FROM packed LEFT JOIN benchmark b ON b.item_id = packed.batch % (SELECT count(*) FROM benchmark) CROSS JOIN fewshot""",
)

_DOM = ", ".join(f"('{v}', '{t}')" for v, toks in CATEGORY_SETS.items() for t in toks)
register(
    "s3_category_domain",
    L,
    f"dom AS (SELECT * FROM (VALUES {_DOM}) t(version, token))",
    f"used AS (SELECT token, count(*) AS n_rows FROM (SELECT unnest({cat_tokens('category')}) AS token FROM labelled) GROUP BY token)",
    body="SELECT d.version, d.token, coalesce(u.n_rows, 0) AS n_rows FROM dom d LEFT JOIN used u ON d.token = u.token",
)

# =========================================================================== F
register("f1_filter_flagged", body="SELECT d.doc_id, d.text FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.toxic = 1")
register("f2_project", L, body="SELECT row_id, source AS text, action AS label FROM labelled")
_IDX = "(SELECT row_id, action, row_number() OVER (ORDER BY row_id) - 1 AS idx FROM labelled)"
register("f3_slice_rows", L, body=f"SELECT row_id, action, idx FROM {_IDX} WHERE idx >= 50 AND idx < 100")
register("f4_drop_range", L, body=f"SELECT row_id, action, idx FROM {_IDX} WHERE idx < 377 OR idx >= 474")
register("f5_nmt_subset", L, body="SELECT row_id, source, target FROM labelled WHERE action <> 1")
register("f6_safety_gate", RESPONSES, verdicts_cte("v", "responses"), body="SELECT doc_id, decision, score, reason, route FROM v_routed")
register("f7_drop_failed", RESPONSES, SCORED_CALLS, body="SELECT doc_id, raw FROM scored_calls WHERE length(coalesce(raw, '')) > 0")
register("f8_head", L, body="SELECT row_id, action FROM labelled ORDER BY row_id LIMIT 25")
register(
    "f9_repair_normal",
    *D,
    body="""
SELECT row_id, source, CASE WHEN action = 0 AND target IS DISTINCT FROM source THEN source ELSE target END AS target,
       action, severity, category, reason, origin_tags FROM dirty""",
)
register(
    "f10_repair_block",
    *D,
    body=f"""
SELECT row_id, source, CASE WHEN action = 1 THEN {BT} ELSE target END AS target,
       action, severity, category, reason, origin_tags FROM dirty""",
)
register(
    "f11_typed",
    *D,
    STRING_TYPED,
    body=f"""
SELECT row_id, {int_or_null('action')} AS action, {int_or_null('severity')} AS severity
FROM string_typed WHERE {int_or_null('action')} IS NOT NULL""",
)
register(
    "f12_threshold_route",
    L,
    PREDS,
    body=f"""
SELECT row_id, round(1.0::DOUBLE - p0, 6) AS toxicity, (1.0::DOUBLE - p0) >= 0.6 AS rewritten,
       CASE WHEN (1.0::DOUBLE - p0) >= 0.6 THEN {purify_sql('source')} ELSE source END AS output
FROM pr""",
)

# =========================================================================== J
_LCOLS = "l.row_id, l.source, {t}, l.action, l.severity, l.category, l.reason, l.origin_tags"
register(
    "j1_override_by_source",
    L,
    "fixes AS (SELECT source AS key, 'fixed: ' || CAST(min(row_id) AS VARCHAR) AS new_target FROM labelled WHERE action = 2 GROUP BY source)",
    body="SELECT " + _LCOLS.format(t="CASE WHEN f.key IS NOT NULL THEN f.new_target ELSE l.target END AS target")
    + " FROM labelled l LEFT JOIN fixes f ON l.source = f.key",
)
register(
    "j2_override_by_target",
    L,
    "fixes AS (SELECT target AS key, 'fixed: ' || CAST(min(row_id) AS VARCHAR) AS new_target FROM labelled WHERE action = 2 GROUP BY target)",
    body="SELECT " + _LCOLS.format(t="CASE WHEN f.key IS NOT NULL THEN f.new_target ELSE l.target END AS target")
    + " FROM labelled l LEFT JOIN fixes f ON l.target = f.key",
)
register("j3_pending", L, body="SELECT row_id, action FROM labelled l WHERE NOT EXISTS (SELECT 1 FROM labels d WHERE d.doc_id = l.row_id)")
_B = f"b AS (SELECT row_id, (row_number() OVER (ORDER BY row_id) - 1) // {BATCH} AS batch FROM labelled)"
register(
    "j4_pending_batches_first_id",
    L,
    _B,
    "firsts AS (SELECT batch, min(row_id) AS first_id FROM b GROUP BY batch)",
    "skipped AS (SELECT batch FROM firsts f WHERE EXISTS (SELECT 1 FROM labels d WHERE d.doc_id = f.first_id))",
    body="SELECT row_id, batch FROM b WHERE batch NOT IN (SELECT batch FROM skipped)",
)
register(
    "j4_pending_batches_complete",
    L,
    _B,
    body="SELECT row_id, batch FROM b WHERE NOT EXISTS (SELECT 1 FROM labels d WHERE d.doc_id = b.row_id)",
)
register(
    "j5_positional_diff",
    RAWPROC,
    body="""
SELECT coalesce(r.pos, p.pos) + 1 AS line,
       CASE WHEN p.pos IS NULL THEN 'missing_in_proc' WHEN r.pos IS NULL THEN 'extra_in_proc' ELSE 'changed' END AS kind,
       r.text AS raw_text, p.text AS proc_text
FROM raw_k r FULL OUTER JOIN proc_k p ON r.pos = p.pos
WHERE r.key IS DISTINCT FROM p.key""",
)
_GAP_BODY = """
SELECT g.i + 1 AS gap_line, CAST(g.n_missing AS INTEGER) AS n_missing, r.pos + 1 AS missing_line, r.text AS missing_text
FROM {src} g CROSS JOIN range(0, 4) t(j) JOIN raw_k r ON r.pos = g.i + t.j
WHERE t.j < g.n_missing"""
register("j6_find_gaps", RAWPROC, GAPS, "first_gap AS (SELECT * FROM hits ORDER BY i LIMIT 1)", body=_GAP_BODY.format(src="first_gap"))
# Lost rows are those of raw that processed lacks by id; a run of them starts where as
# many processed rows came before as the run's position less the rows lost before it.
# Rows after the last processed one are still to come.
register(
    "j6_find_gaps_all",
    RAWPROC,
    "block AS (SELECT pos, text, doc_id % 300 - 20 - ((doc_id // 300) * 83) % 200 AS since, (doc_id // 300) % 6 AS more FROM raw_k)",
    "lost AS (SELECT pos, text, pos - row_number() OVER (ORDER BY pos) + 1 AS i FROM block WHERE since BETWEEN 0 AND more)",
    body="""
SELECT i + 1 AS gap_line, CAST(count(*) OVER (PARTITION BY i) AS INTEGER) AS n_missing, pos + 1 AS missing_line, text AS missing_text,
       count(*) OVER (PARTITION BY i) <= 4 AS within_k
FROM lost WHERE pos < (SELECT max(pos) FROM block WHERE since NOT BETWEEN 0 AND more)""",
)
register(
    "j7_coverage",
    RAWPROC,
    body="""
SELECT n_raw, n_proc, n_mismatch,
       CASE WHEN n_mismatch > 0 THEN 'discrepancy' WHEN n_proc > n_raw THEN 'longer' WHEN n_proc < n_raw THEN 'prefix' ELSE 'match' END AS verdict,
       CASE WHEN n_mismatch = 0 AND n_proc < n_raw THEN n_proc + 1 END AS next_line
FROM (
  SELECT count(r.pos) AS n_raw, count(p.pos) AS n_proc,
         CAST(count_if(r.pos IS NOT NULL AND p.pos IS NOT NULL AND r.key <> p.key) AS BIGINT) AS n_mismatch
  FROM raw_k r FULL OUTER JOIN proc_k p ON r.pos = p.pos
)""",
)
register(
    "j8_missing_rows",
    RAWPROC,
    body="SELECT r.doc_id, r.text FROM raw_k r WHERE NOT EXISTS (SELECT 1 FROM proc_k p WHERE p.key = r.key)",
)
register("j9_with_context", L, body="SELECT l.row_id, b.text AS policy FROM labelled l LEFT JOIN benchmark b ON b.item_id = l.row_id % (SELECT count(*) FROM benchmark)")
register(
    "j10_attach_responses",
    L,
    BATCH_REPLIES,
    body="""
SELECT l.row_id, l.action, r.decision, r.score AS reply_score, r.target AS reply, r.decision IS NOT NULL AS has_reply
FROM labelled l LEFT JOIN parsed r ON r.id = l.row_id""",
)
register(
    "j11_tag_integrity",
    *D,
    "rt AS (SELECT source AS src, list(DISTINCT origin_tags) AS tags FROM labelled GROUP BY source)",
    body="""
SELECT d.row_id, d.origin_tags, array_to_string(list_sort(rt.tags), ' | ') AS raw_tags
FROM dirty d JOIN rt ON d.source = rt.src
WHERE d.origin_tags IS NULL OR NOT list_contains(rt.tags, d.origin_tags)""",
)
register(
    "j12_leakage",
    L,
    SPLITS,
    body="""
SELECT source, CAST(count(DISTINCT split) AS INTEGER) AS n_splits, count(*) AS n_rows
FROM splits GROUP BY source HAVING count(DISTINCT split) > 1""",
)

# =========================================================================== A
register(
    "a1_dedup_exact",
    body="SELECT min(d.doc_id) AS doc_id, d.text FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.toxic = 1 GROUP BY d.text",
)
register(
    "a2_funnel",
    body="""
SELECT count(*) AS n_total, CAST(count_if(l.toxic = 1) AS BIGINT) AS n_flagged,
       count(DISTINCT CASE WHEN l.toxic = 1 THEN d.text END) AS n_distinct_flagged
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
register(
    "a3_audit_counts",
    *D,
    body=f"""
SELECT CAST(count_if(action <> 0 AND {strip('origin_tags')} = 'clean') AS BIGINT) AS n_toxic_clean,
       CAST(count_if(action = 1 AND target IS DISTINCT FROM {BT}) AS BIGINT) AS n_block_mismatch,
       CAST(count_if(action = 0 AND target IS DISTINCT FROM source) AS BIGINT) AS n_normal_mismatch
FROM dirty""",
)
register("a4_verdict_counts", RESPONSES, verdicts_cte("v", "responses"), body="SELECT route, count(*) AS n FROM v_routed GROUP BY route")
register("a5_split_counts", L, SPLITS, body="SELECT split, action, count(*) AS n FROM splits GROUP BY split, action")
register("a7_fewshot_block", L, FEWSHOT, body="SELECT fewshot, n_examples FROM fewshot")
register(
    "a7_sampled_fewshot",
    L,
    "drawn AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY md5('11:' || CAST(row_id AS VARCHAR))) AS n FROM labelled)",
    body=f"""
SELECT category, string_agg({one_line('source')} || chr(9) || {one_line('target')} || {NL}, '' ORDER BY row_id) AS fewshot, count(*) AS n_examples
FROM drawn WHERE n <= 3 GROUP BY category""",
)
register("a8_pack_batches", L, PACKED, body="SELECT batch, first_id, n_rows, body FROM packed")
register("a9_done_keys", body="SELECT DISTINCT doc_id AS row_id FROM labels")
register(
    "a10_label_distribution",
    L,
    body=f"""
SELECT dim, value, count(*) AS n FROM (
  SELECT 'action' AS dim, CAST(action AS VARCHAR) AS value FROM labelled
  UNION ALL SELECT 'severity_action', CAST(severity AS VARCHAR) || ':' || CAST(action AS VARCHAR) FROM labelled
  UNION ALL SELECT 'category', unnest({cat_tokens('category')}) FROM labelled
  UNION ALL SELECT 'tag', unnest(string_split_regex(origin_tags, ',\\s*')) FROM labelled
) GROUP BY dim, value""",
)
_CM = "cm AS (SELECT CAST(label AS INTEGER) AS label, prediction, count(*) AS n FROM pr GROUP BY label, prediction)"
register(
    "a11_weighted_f1",
    L,
    PREDS,
    _CM,
    """pc AS (
  SELECT c, sum(support) AS support, sum(predicted) AS predicted, sum(tp) AS tp FROM (
    SELECT label AS c, n AS support, 0 AS predicted, 0 AS tp FROM cm
    UNION ALL SELECT prediction, 0, n, CASE WHEN label = prediction THEN n ELSE 0 END FROM cm
  ) GROUP BY c
)""",
    body="""
SELECT round(sum(CAST(support AS DOUBLE) * CASE WHEN support + predicted > 0 THEN 2.0::DOUBLE * tp / (support + predicted) ELSE 0.0::DOUBLE END)
             / sum(support), 6) AS weighted_f1,
       CAST(sum(support) AS BIGINT) AS n,
       round(CAST(sum(tp) AS DOUBLE) / CAST(sum(support) AS DOUBLE), 6) AS accuracy
FROM pc""",
)
register("a12_confusion", L, PREDS, _CM, body="SELECT label, prediction, n, label = prediction AS correct FROM cm")
_BAYES = [
    L,
    SPLITS,
    "nb_docs AS (SELECT s.row_id, s.split, l.action AS label, list_filter(string_split_regex(lower(l.source), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS w FROM splits s JOIN labelled l USING (row_id))",
    "nb_classes AS (SELECT label, count(*) AS texts, CAST(sum(len(w)) AS BIGINT) AS n_words FROM nb_docs WHERE split = 'train' GROUP BY label)",
    "nb_counts AS (SELECT word, label, count(*) AS n FROM (SELECT label, unnest(w) AS word FROM nb_docs WHERE split = 'train') GROUP BY word, label)",
    "nb_words AS (SELECT DISTINCT word FROM nb_counts)",
    """nb_weights AS (
  SELECT v.word, c.label, ln((coalesce(n.n, 0) + 1.0::DOUBLE) / (c.n_words + (SELECT count(*) FROM nb_words))) AS weight
  FROM nb_words v CROSS JOIN nb_classes c LEFT JOIN nb_counts n ON n.word = v.word AND n.label = c.label)""",
    """nb_scores AS (
  SELECT d.row_id, d.split, d.label AS truth, c.label, ln(c.texts / (SELECT sum(texts) FROM nb_classes)::DOUBLE) + coalesce(s.s, 0) AS s
  FROM nb_docs d CROSS JOIN nb_classes c LEFT JOIN (
    SELECT t.row_id, w.label, sum(w.weight) AS s FROM (SELECT row_id, unnest(w) AS word FROM nb_docs WHERE split <> 'train') t JOIN nb_weights w ON w.word = t.word GROUP BY t.row_id, w.label) s
  ON s.row_id = d.row_id AND s.label = c.label WHERE d.split <> 'train')""",
    """nb_pred AS (
  SELECT row_id, split, truth AS label, arg_min(label, {'c': -s, 'l': label}) AS prediction, 1 / sum(exp(s - top)) AS confidence
  FROM (SELECT *, max(s) OVER (PARTITION BY row_id) AS top FROM nb_scores) GROUP BY row_id, split, truth)""",
]
register("m2_bayes_weights", *_BAYES, body="SELECT word, label, round(weight, 6) AS weight FROM nb_weights")
register("m3_bayes_classify", *_BAYES, body="SELECT row_id, label, prediction, round(confidence, 6) AS confidence FROM nb_pred WHERE split = 'test'")
register(
    "m4_bayes_evaluate",
    *_BAYES,
    "nb_cm AS (SELECT label, prediction, count(*) AS n FROM nb_pred GROUP BY label, prediction)",
    """nb_pc AS (
  SELECT c, sum(support) AS support, sum(predicted) AS predicted, sum(tp) AS tp FROM (
    SELECT label AS c, n AS support, 0 AS predicted, 0 AS tp FROM nb_cm
    UNION ALL SELECT prediction, 0, n, CASE WHEN label = prediction THEN n ELSE 0 END FROM nb_cm) GROUP BY c)""",
    body="""
SELECT round(sum(CAST(support AS DOUBLE) * CASE WHEN support + predicted > 0 THEN 2.0::DOUBLE * tp / (support + predicted) ELSE 0.0::DOUBLE END) / sum(support), 6) AS weighted_f1,
       CAST(sum(support) AS BIGINT) AS n, round(CAST(sum(tp) AS DOUBLE) / CAST(sum(support) AS DOUBLE), 6) AS accuracy
FROM nb_pc""",
)
register(
    "a13_build_vocab",
    L,
    body=f"""
SELECT token, count(*) AS n
FROM (SELECT unnest(string_split_regex({strip('target')}, '\\s+')) AS token FROM labelled)
WHERE length(token) > 0 GROUP BY token HAVING count(*) >= 1""",
)

# =========================================================================== W
register("w1_global_index", body="SELECT doc_id, lang, row_number() OVER (ORDER BY lang, doc_id) - 1 AS idx FROM documents")
_RULES = f"""
aud AS (
  SELECT row_id, source, 'clean' AS rule FROM dirty WHERE action <> 0 AND {strip('origin_tags')} = 'clean'
  UNION ALL SELECT row_id, source, 'block' FROM dirty WHERE action = 1 AND target IS DISTINCT FROM {BT}
  UNION ALL SELECT row_id, source, 'normal' FROM dirty WHERE action = 0 AND target IS DISTINCT FROM source
)"""
register(
    "w2_audit_samples",
    *D,
    _RULES,
    body="""
SELECT rule, row_id, substring(source, 1, 40) AS preview, CAST(rn AS INTEGER) AS rn
FROM (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY row_id) AS rn FROM aud)
WHERE rn <= CASE rule WHEN 'clean' THEN 10 WHEN 'block' THEN 5 ELSE 10 END""",
)
register("w4_batch_id", L, _B, body="SELECT row_id, batch FROM b")

# =========================================================================== P
_MD5 = "md5('42:' || CAST(row_id AS VARCHAR))"
register("p1_shuffle", L, body=f"SELECT row_id, row_number() OVER (ORDER BY {_MD5}, row_id) - 1 AS pos FROM labelled")
register(
    "p2_random_split",
    L,
    f"sh AS (SELECT row_id, row_number() OVER (ORDER BY {_MD5}, row_id) - 1 AS pos, count(*) OVER () AS n FROM labelled)",
    body="""
SELECT row_id, CASE WHEN pos < n * 8 // 10 THEN 'train' WHEN pos < n * 8 // 10 + n // 10 THEN 'valid' ELSE 'test' END AS split FROM sh""",
)
register("p3_stratified_split", L, SPLITS, body="SELECT row_id, action, split FROM splits")
register(
    "p4_check_strata",
    L,
    SPLITS,
    body="SELECT action, n_class, n_hold, n_test, n_class >= 2 AND n_hold >= 2 AS ok FROM sp_quota",
)
register("p5_sample_n", L, body=f"SELECT row_id, action FROM labelled ORDER BY {_MD5}, row_id LIMIT 10")
register(
    "k3_parallel_pairs",
    L,
    SPLITS,
    body=f"""
SELECT split, row_number() OVER (PARTITION BY split ORDER BY {_MD5}, row_id) AS line_no, row_id,
       {one_line('source')} AS src, {one_line('target')} AS tgt
FROM splits WHERE action <> 1""",
)

# =========================================================================== U
register("u1_union_batches", L, body="SELECT severity, row_id, action FROM labelled WHERE action IN (0, 1, 2)")
register(
    "u2_append_new",
    L,
    "ex AS (SELECT row_id, source, origin_tags FROM labelled WHERE origin_tags <> 'unlabelled')",
    body="""
SELECT row_id, origin_tags FROM ex
UNION ALL
SELECT row_id, origin_tags FROM labelled l WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.source = l.source)""",
)
register(
    "u3_complement_check",
    RESPONSES,
    SCORED_CALLS,
    "ok AS (SELECT * FROM scored_calls WHERE length(coalesce(raw, '')) > 0)",
    verdicts_cte("v", "ok"),
    body="""
SELECT n_input, n_failed, n_passed, n_blocked, n_lost,
       (n_passed + n_blocked = n_input - n_failed) AND n_rows = n_input AND n_lost = 0 AS holds
FROM (
  SELECT count(*) AS n_rows, count(DISTINCT c.doc_id) AS n_input,
         CAST(count_if(length(coalesce(c.raw, '')) = 0) AS BIGINT) AS n_failed,
         CAST(count_if(r.route = 'passed') AS BIGINT) AS n_passed,
         CAST(count_if(r.route = 'blocked') AS BIGINT) AS n_blocked,
         CAST(count_if(length(coalesce(c.raw, '')) > 0 AND r.route IS NULL) AS BIGINT) AS n_lost
  FROM scored_calls c LEFT JOIN v_routed r ON c.doc_id = r.doc_id
)""",
)

# =========================================================================== X
register(
    "x1_sanitize",
    body=f"""
SELECT doc_id, regexp_replace(text, '{tx.SANITIZE_RX}', '', 'g') AS key,
       regexp_replace(text, '{tx.SANITIZE_RX_STRICT_REFERENCE}', '', 'g') AS key_strict
FROM documents""",
)
register("x3_parse_verdict", RESPONSES, verdicts_cte("v", "responses"), body="SELECT doc_id, decision, score, reason FROM v")
register("x4_parse_batch", L, BATCH_REPLIES, body="SELECT batch, id, id_info, decision, score, target FROM parsed")
register(
    "x5_parse_id",
    L,
    BATCH_REPLIES,
    body="SELECT batch, count(id) AS n_ids, min(id) AS min_id, max(id) AS max_id FROM parsed GROUP BY batch",
)
register(
    "x6_clean_reply",
    L,
    body=f"""
SELECT row_id, {strip("replace(replace(replace('[순화된 문장] [' || target || ']  ', '[순화된 문장]', ''), '[', ''), ']', '')")} AS cleaned
FROM labelled""",
)
register(
    "x7_request_line",
    L,
    body=f"SELECT row_id, 'ID:' || CAST(row_id AS VARCHAR) || ' | TEXT:' || {one_line('source')} AS line FROM labelled",
)
register(
    "x8_class_scores",
    L,
    PREDS,
    body="""
SELECT row_id, round(p0, 6) AS p0, round(p1, 6) AS p1, round(p2, 6) AS p2, prediction,
       round(greatest(p0, p1, p2), 6) AS confidence,
       CASE prediction WHEN 0 THEN 'NORMAL' WHEN 1 THEN 'BLOCK' ELSE 'PURIFY' END AS label_name
FROM pr""",
)
_TOK = f"string_split_regex({strip('source')}, '\\s+')"
register(
    "x9_pad_tokens",
    L,
    body=f"""
SELECT row_id, CAST(len(toks) AS INTEGER) AS n_tokens,
       array_to_string(list_resize(list_slice(toks, 1, 128), 128, '{tx.PAD}'), ' ') AS padded,
       CAST(least(len(toks), 128) AS INTEGER) AS mask_sum
FROM (SELECT row_id, {_TOK} AS toks FROM labelled)""",
)
register(
    "x10_category_tokens",
    *D,
    CONTRACT,
    body=f"""
SELECT row_id, array_to_string({cat_tokens('category')}, '/') AS category_norm, CAST(len({cat_tokens('category')}) AS INTEGER) AS n_tokens
FROM contract_rows""",
)
register(
    "x11_tag_tokens",
    L,
    body="""
SELECT row_id, CAST(len(string_split_regex(origin_tags, ',\\s*')) AS INTEGER) AS n_tags,
       array_to_string(string_split_regex(origin_tags, ',\\s*'), '|') AS tags
FROM labelled""",
)
_RX = "'^\\[(.+?)\\] -> (.+)$'"
register(
    "x12_parse_reason",
    L,
    body=f"""
SELECT row_id, regexp_extract(reason, {_RX}, 1) AS keywords, regexp_extract(reason, {_RX}, 2) AS rationale,
       CAST(len(string_split(regexp_extract(reason, {_RX}, 1), ', ')) AS INTEGER) AS n_keywords
FROM labelled""",
)
register(
    "x13_severity_band",
    L,
    body="""
SELECT row_id, CASE WHEN severity BETWEEN 0 AND 1 THEN 'harmless' WHEN severity BETWEEN 2 AND 3 THEN 'abusive'
                    WHEN severity BETWEEN 4 AND 5 THEN 'extreme' END AS band
FROM labelled""",
)

# =========================================================================== M
register(
    "m1_score",
    L,
    body=f"""
SELECT row_id, CASE WHEN sc >= 4 THEN 'BLOCK' ELSE 'PASS' END AS decision, sc AS score,
       CASE WHEN len(kw) = 0 THEN 'none' ELSE array_to_string(kw, ', ') END AS reason
FROM (SELECT row_id, kw, CAST(1 + least(4, len(kw)) AS INTEGER) AS sc FROM (SELECT row_id, {kw_sql('source')} AS kw FROM labelled))""",
)
register(
    "m5_expand_tones",
    L,
    body="""
SELECT l.row_id, t.tone FROM labelled l CROSS JOIN (VALUES ('격식체'), ('해요체'), ('비즈니스 톤')) t(tone) WHERE l.action = 2""",
)

# =========================================================================== T
register(
    "t1_moderate_stream",
    L,
    body="SELECT * FROM labelled",
)
register(
    "t1_routed_stream",
    L,
    body="""
SELECT row_id, round(severity / (severity + 1.0::DOUBLE), 6) AS toxicity,
       CASE WHEN action = 1 OR severity / (severity + 1.0::DOUBLE) >= 0.6 THEN target ELSE source END AS output,
       CASE WHEN action = 1 THEN 'blocked' WHEN severity / (severity + 1.0::DOUBLE) >= 0.6 THEN 'rewritten' ELSE 'passed' END AS route
FROM labelled""",
)
register(
    "t2_stream_dedup",
    body="""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type FROM (
  WITH RECURSIVE e AS (
    SELECT event_id, ts, user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn
    FROM events WHERE ts IS NOT NULL),
  walk AS (
    SELECT event_id, ts, user_id, event_type, rn, ts AS last_kept, true AS kept FROM e WHERE rn = 1
    UNION ALL
    SELECT n.event_id, n.ts, n.user_id, n.event_type, n.rn,
           CASE WHEN n.ts > w.last_kept + INTERVAL 10 MINUTE THEN n.ts ELSE w.last_kept END,
           n.ts > w.last_kept + INTERVAL 10 MINUTE
    FROM walk w JOIN e n ON n.user_id = w.user_id AND n.event_type = w.event_type AND n.rn = w.rn + 1)
  SELECT * FROM walk) WHERE kept""",
)
register(
    "t3_manner_score_batch",
    body="""
SELECT strftime(time_bucket(INTERVAL '1 hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, user_id,
       CAST(count_if(event_type = 'error') AS BIGINT) AS manner_score, count(*) AS n_events
FROM events GROUP BY 1, 2""",
)

# =========================================================================== S, K (round trips)
register("s1_k1_tsv_round_trip", L, body="SELECT row_id, source, action, reason, 4::INTEGER AS n_fields FROM labelled")
register("s2_parallel_scan", L, body="SELECT row_id, source, action, reason, 4::INTEGER AS n_fields FROM labelled")
register("k2_append_twice", L, body="SELECT row_id, action, severity FROM labelled")
register("s4_k4_splits_round_trip", L, SPLITS, body="SELECT row_id, action, split FROM splits")
register("k5_routes_twice", L, body="SELECT row_id, CASE WHEN action = 1 THEN 'blocked' ELSE 'passed' END AS route FROM labelled")
register("k6_replace_dataset", L, body="SELECT row_id, CAST(severity + 1 AS INTEGER) AS severity FROM labelled")
register("s5_read_policy", body="SELECT item_id, text AS policy FROM benchmark")
register(
    "a6_modified_count",
    L,
    body="""
SELECT count(*) AS n_rows, CAST(count_if(source IN (SELECT source FROM labelled WHERE action = 2)) AS BIGINT) AS n_modified FROM labelled""",
)
