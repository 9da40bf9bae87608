"""The same results as plain SQL over the test tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

AS_OF = 1704067200  # 2024-01-01T00:00:00Z

# --- shared subqueries -------------------------------------------------------------------------------

CLICKS = r"""
event_docs AS (
  SELECT event_type || '::u' || user_id || '::' || CAST(floor(epoch(ts)) AS BIGINT) AS doc_id, props AS value
  FROM events),
clicks AS (
  SELECT doc_id, value, CAST(regexp_extract(doc_id, '^click::(\w+)::(\d+)$', 2) AS BIGINT) AS s
  FROM event_docs WHERE regexp_matches(doc_id, '^click::(\w+)::(\d+)$') AND json_valid(value)),
dated AS (
  SELECT doc_id, value, s % 60 AS sec, strftime(to_timestamp(s) AT TIME ZONE 'UTC', '%Y%m%d') AS day FROM clicks)
"""

CLICK_KEYS = """
listed AS (
  SELECT i - 1 AS key_ord, '["2024010' || i || '",0]' AS view_key FROM range(1, 4) AS t(i)
  UNION ALL SELECT 3, '["20240101",1]' UNION ALL SELECT 4, '["20240101",1]')
"""

TEXTS = """
indexed AS (
  SELECT '["' || lang || '",' || (doc_id % 4) || ']' AS view_key, CAST(doc_id AS VARCHAR) AS doc_id,
         source AS emitted
  FROM documents
  UNION ALL SELECT '["en",' || (page_id % 4) || ']', 'p' || page_id, 'page' FROM pages),
stored AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, text AS value FROM documents),
listed AS (
  SELECT i AS key_ord, '["en",' || i || ']' AS view_key FROM range(0, 4) AS t(i)
  UNION ALL SELECT 4, '["de",1]' UNION ALL SELECT 5, '["de",1]' UNION ALL SELECT 6, '["xx",0]')
"""

PAGED = (
    TEXTS
    + """,
rows_of AS (
  SELECT l.key_ord, i.doc_id, row_number() OVER (PARTITION BY l.key_ord ORDER BY i.doc_id) - 1 AS rn
  FROM listed l JOIN indexed i USING (view_key)),
per_key AS (
  SELECT key_ord, sum(n) OVER (ORDER BY key_ord) - n AS first_page
  FROM (SELECT key_ord, (count(*) + 49) // 50 AS n FROM rows_of GROUP BY key_ord)),
paged AS (
  SELECT r.key_ord, r.doc_id, r.rn // 50 AS page_in_key, CAST(p.first_page + r.rn // 50 AS BIGINT) AS page_no
  FROM rows_of r JOIN per_key p USING (key_ord))
"""
)


def escaped(column: str) -> str:
    return (
        f"replace(replace(replace(replace({column}, '\\', '\\\\'), chr(9), '\\t'), chr(10), '\\n'), "
        "chr(13), '\\r')"
    )


PROFILES = f"""
profiles AS (
  SELECT 'u' || c_custkey AS doc_id, c_name AS value,
         CASE WHEN c_custkey % 6 = 2 THEN {AS_OF} + c_custkey
              WHEN c_custkey % 14 = 4 THEN {AS_OF} - c_custkey END AS e
  FROM customer),
live AS (SELECT * FROM profiles WHERE e IS NULL OR e > {AS_OF})
"""

FEED = """
feed AS (
  SELECT 'u' || user_id * 20 AS doc_id, event_id AS seq, 'v' || event_id || ';' AS v, event_id % 5 AS x,
         CASE WHEN event_type = 'signup' THEN 'ADD'
              WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN 'SET'
              WHEN event_type = 'purchase' THEN 'REPLACE'
              WHEN event_type = 'click' AND event_id % 2 = 0 THEN 'APPEND'
              WHEN event_type = 'click' THEN 'PREPEND'
              WHEN event_type = 'view' THEN 'TOUCH'
              WHEN event_id % 3 = 0 THEN 'NONE' ELSE 'DELETE' END AS op
  FROM events)
"""

SPECS = """
specs AS (SELECT c_custkey, c_nationkey AS lo, c_custkey % 15 AS hi FROM customer),
expanded AS (
  SELECT c_custkey, 0 AS pos, i AS sub_pos, '["c' || c_custkey || '","' || lpad(CAST(i AS VARCHAR), 2, '0') || '"]' AS raw_key
  FROM specs, range(0, 13) AS t(i)
  UNION ALL SELECT c_custkey, 1, 0, '"a;' || lo || '"' FROM specs
  UNION ALL
  SELECT c_custkey, 2, i - lo,
         'k' || CASE WHEN length(CAST(lo AS VARCHAR)) = length(CAST(hi AS VARCHAR))
                     THEN lpad(CAST(i AS VARCHAR), CAST(length(CAST(hi AS VARCHAR)) AS INTEGER), '0') ELSE CAST(i AS VARCHAR) END
  FROM (SELECT c_custkey, lo, hi, unnest(range(lo, hi + 1)) AS i FROM specs)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY pos, sub_pos) - 1 AS key_ord,
         count(*) OVER (PARTITION BY c_custkey) AS n
  FROM expanded)
"""

# --- key specs ---------------------------------------------------------------------------------------

ORACLES["key_split"] = r"""
WITH specs AS (SELECT page_id, translate(html, '{}/', '[]\') AS spec FROM pages),
chars AS (SELECT page_id, unnest(string_split(spec, '')) AS c, generate_subscripts(string_split(spec, ''), 1) AS i FROM specs),
marked AS (SELECT *, coalesce(lag(c) OVER (PARTITION BY page_id ORDER BY i), '') <> '\' AS free FROM chars),
states AS (
  SELECT page_id, i, c,
    coalesce(sum(CASE WHEN c = '"' AND free THEN 1 ELSE 0 END)
      OVER (PARTITION BY page_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 AS quoted,
    coalesce(last_value(CASE WHEN free AND c IN ('[', ']') THEN c END IGNORE NULLS)
      OVER (PARTITION BY page_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ']') AS bracket
  FROM marked),
cuts AS (SELECT *, CASE WHEN c = ';' AND quoted = 0 AND bracket = ']' THEN 1 ELSE 0 END AS cut FROM states),
numbered AS (SELECT *, sum(cut) OVER (PARTITION BY page_id ORDER BY i) AS seg FROM cuts),
texts AS (
  SELECT page_id, seg AS pos, coalesce(string_agg(CASE WHEN cut = 0 THEN c END, '' ORDER BY i), '') AS raw_key
  FROM numbered GROUP BY page_id, seg),
all_keys AS (
  SELECT s.page_id, p.pos, coalesce(x.raw_key, '') AS raw_key, m.last_pos
  FROM (SELECT page_id, CAST(max(seg) AS BIGINT) AS last_pos FROM numbered GROUP BY page_id) m
  JOIN specs s USING (page_id), LATERAL (SELECT unnest(range(0, m.last_pos + 1)) AS pos) p
  LEFT JOIN texts x ON x.page_id = s.page_id AND x.pos = p.pos)
SELECT page_id, CAST(pos AS INTEGER) AS pos, raw_key FROM all_keys WHERE NOT (pos = last_pos AND raw_key = '')
"""

ORACLES["key_expand"] = f"WITH {SPECS} SELECT c_custkey, pos, sub_pos, key_ord, raw_key, raw_key AS view_key FROM ordered"

ORACLES["key_chunks"] = f"""
WITH {SPECS},
sized AS (SELECT *, CAST(ceil(n / (c_custkey % 5 + 1)) AS BIGINT) AS per_chunk FROM ordered)
SELECT c_custkey, key_ord // per_chunk AS chunk_id, count(*) AS n_keys, min(key_ord) AS first_key, max(key_ord) AS last_key
FROM sized GROUP BY ALL
"""

# --- views and scans ---------------------------------------------------------------------------------

ORACLES["view_define"] = f"""
WITH {CLICKS}
SELECT '["' || day || '",' || (sec % 2) || ']' AS view_key, day AS k0, CAST(sec % 2 AS VARCHAR) AS k1, doc_id,
       CAST(NULL AS VARCHAR) AS emitted
FROM dated
"""

ORACLES["view_sample"] = f"""
WITH {CLICKS}
SELECT '["' || day || '",' || (sec % 10) || ']' AS view_key, doc_id FROM dated WHERE sec % 10 < 3
"""

ORACLES["import_clicks"] = f"""
WITH {CLICKS}, {CLICK_KEYS},
indexed AS (SELECT '["' || day || '",' || (sec % 2) || ']' AS view_key, doc_id, value FROM dated)
SELECT key_ord, view_key, doc_id, value FROM listed JOIN indexed USING (view_key)
"""
ORACLES["stored_view_scan"] = ORACLES["import_clicks"]

ORACLES["stored_view_odd_keys"] = """
WITH parts AS (
  SELECT doc_id, lang, CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'a/b' WHEN 2 THEN 'k=v' WHEN 3 THEN 'it''s'
         WHEN 4 THEN 'null' WHEN 5 THEN ' ' END AS part
  FROM documents)
SELECT '[' || coalesce('"' || part || '"', 'null') || ',"' || lang || '"]' AS view_key, coalesce(part, 'null') AS k0,
       lang AS k1, CAST(doc_id AS VARCHAR) AS doc_id
FROM parts
"""

ORACLES["view_scan"] = f"""
WITH {TEXTS}
SELECT l.key_ord, i.view_key, i.doc_id, i.emitted, s.value
FROM listed l JOIN indexed i USING (view_key) LEFT JOIN stored s ON s.doc_id = i.doc_id
"""

ORACLES["view_scan_by_table"] = """
WITH docs AS (
  SELECT 'o' || o_orderkey AS doc_id, strftime(o_orderdate, '%Y%m') AS m, o_orderpriority AS value, o_custkey FROM orders),
wanted AS (
  SELECT m, count(*) AS n_orders FROM docs
  WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY') GROUP BY m)
SELECT '["' || d.m || '"]' AS view_key, any_value(w.n_orders) AS n_orders, count(*) AS n_rows,
       min(d.doc_id) AS first_doc, max(d.value) AS last_value
FROM docs d JOIN wanted w USING (m) GROUP BY d.m
"""

ORACLES["view_pages"] = f"WITH {PAGED} SELECT key_ord, doc_id, page_in_key, page_no FROM paged"

PAGE_LINES = f"""
WITH {PAGED},
lines AS (
  SELECT 'part-' || lpad(CAST(p.page_no AS VARCHAR), 5, '0') AS page,
         {escaped("p.doc_id")} || chr(9) || {escaped("s.value")} AS value
  FROM paged p JOIN stored s USING (doc_id))
"""
ORACLES["view_page_lines"] = PAGE_LINES + "SELECT page, value FROM lines"
ORACLES["job_import_paged"] = (
    PAGE_LINES + "SELECT page, count(*) AS n_lines, max(value) AS last_line FROM lines GROUP BY page"
)

ORACLES["import_profile"] = f"""
WITH {CLICKS},
listed AS (
  SELECT i - 1 AS key_ord, '202401' || lpad(CAST(i AS VARCHAR), 2, '0') AS day, 0 AS part FROM range(1, 32) AS t(i)
  UNION ALL SELECT i + 30, '202402' || lpad(CAST(i AS VARCHAR), 2, '0'), 1 FROM range(1, 30) AS t(i))
SELECT l.key_ord // 15 AS chunk_id, count(DISTINCT l.key_ord) AS n_keys, count(d.doc_id) AS n_rows
FROM listed l LEFT JOIN dated d ON d.day = l.day AND d.sec % 2 = l.part GROUP BY l.key_ord // 15
"""

ORACLES["json_documents"] = f"""
WITH {CLICKS},
docs AS (SELECT doc_id, value FROM event_docs UNION ALL SELECT CAST(doc_id AS VARCHAR), text FROM documents)
SELECT json_valid(value) AS is_json, count(*) AS n, min(doc_id) AS first_doc FROM docs GROUP BY 1
"""

# --- text and cells ----------------------------------------------------------------------------------

ORACLES["text_lines"] = f"SELECT CAST(doc_id AS VARCHAR) || chr(9) || {escaped('text')} AS value FROM documents"
ORACLES["text_lines_plain"] = "SELECT doc_id || '|' || text AS value FROM documents"
ORACLES["text_lines_parsed"] = "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text AS value FROM documents"
ORACLES["cells"] = """
SELECT hex(encode(text)) AS row_key, 'd' AS family, 'source' AS qualifier,
       hex(encode(arg_max(source, doc_id))) AS value
FROM documents GROUP BY text
"""

# --- lines as actions --------------------------------------------------------------------------------

LINES = """
lines AS (
  SELECT o_orderkey AS seq, 'o' || o_orderkey * 2 AS k, o_orderkey % 7 AS kind, o_orderstatus AS st FROM orders)
"""
ORACLES["parse_lines"] = f"""
WITH {LINES}
SELECT CASE WHEN kind = 5 THEN '' ELSE k END AS doc_id, seq, 'ADD' AS op,
       CASE WHEN kind = 6 THEN '' ELSE st END AS value, 3600 AS expiry
FROM lines WHERE kind IN (0, 5, 6)
"""
ORACLES["parse_lines_unary"] = f"""
WITH {LINES}
SELECT CASE WHEN kind IN (2, 5) THEN '' ELSE k END AS doc_id, seq, 'DELETE' AS op,
       CASE WHEN kind = 6 THEN '' WHEN kind IN (0, 5) THEN st END AS value, 0 AS expiry
FROM lines WHERE kind <> 3
"""
ORACLES["line_rejects"] = f"""
WITH {LINES}
SELECT op, 'LINES_WITH_WRONG_COLUMNS_COUNT' AS counter,
       CAST(sum(CASE WHEN kind = 3 OR (kind IN (1, 2, 4) AND op IN ('SET', 'APPEND')) THEN 1 ELSE 0 END) AS BIGINT) AS value
FROM lines, (VALUES ('SET'), ('DELETE'), ('TOUCH'), ('APPEND')) AS o(op) GROUP BY op
"""
ORACLES["action_builders"] = """
SELECT event_id,
       CASE event_id % 9 WHEN 0 THEN 'SET' WHEN 1 THEN 'ADD' WHEN 2 THEN 'REPLACE' WHEN 3 THEN 'APPEND'
            WHEN 4 THEN 'PREPEND' WHEN 5 THEN 'DELETE' WHEN 8 THEN 'NONE' ELSE 'TOUCH' END AS op,
       CASE WHEN event_id % 9 < 5 THEN props END AS value,
       CASE WHEN event_id % 9 IN (0, 1, 2, 6) THEN CAST(user_id % 100 AS INTEGER) ELSE 0 END AS expiry
FROM events
"""

# --- mutations by one operation ------------------------------------------------------------------------

UNIFORM = f"""
WITH {PROFILES}, {FEED},
per_key AS (
  SELECT doc_id, arg_min(v, seq) AS first_v, arg_max(v, seq) AS last_v, string_agg(v, '' ORDER BY seq) AS tail,
         string_agg(v, '' ORDER BY seq DESC) AS head, min(seq) AS first_seq
  FROM feed GROUP BY doc_id),
joined AS (
  SELECT p.doc_id, p.value, p.e, k.doc_id IS NOT NULL AS hit, p.e IS NULL OR p.e > {AS_OF} AS alive,
         k.last_v, k.tail, k.head
  FROM profiles p LEFT JOIN per_key k USING (doc_id)),
fresh AS (SELECT * FROM per_key WHERE doc_id NOT IN (SELECT doc_id FROM live))
"""


def _unchanged(condition: str) -> str:
    return f"SELECT doc_id, value, e AS expires_epoch FROM joined WHERE {condition}"


_CHANGED = "hit AND alive"
_LATER = AS_OF + 60
ORACLES["apply_set"] = f"""{UNIFORM} {_unchanged('NOT hit')}
UNION ALL SELECT doc_id, last_v, {_LATER} FROM per_key"""
ORACLES["apply_add"] = f"""{UNIFORM} {_unchanged('NOT hit OR alive')}
UNION ALL SELECT doc_id, first_v, {_LATER} FROM fresh"""
ORACLES["apply_replace"] = f"""{UNIFORM} {_unchanged(f'NOT ({_CHANGED})')}
UNION ALL SELECT doc_id, last_v, {_LATER} FROM joined WHERE {_CHANGED}"""
ORACLES["apply_append"] = f"""{UNIFORM} {_unchanged(f'NOT ({_CHANGED})')}
UNION ALL SELECT doc_id, value || tail, e FROM joined WHERE {_CHANGED}"""
ORACLES["apply_prepend"] = f"""{UNIFORM} {_unchanged(f'NOT ({_CHANGED})')}
UNION ALL SELECT doc_id, head || value, e FROM joined WHERE {_CHANGED}"""
ORACLES["apply_delete"] = f"{UNIFORM} {_unchanged(f'NOT ({_CHANGED})')}"
ORACLES["apply_touch"] = f"""{UNIFORM} {_unchanged(f'NOT ({_CHANGED})')}
UNION ALL SELECT doc_id, value, {_LATER} FROM joined WHERE {_CHANGED}"""
ORACLES["apply_exists"] = ORACLES["apply_touch"]
ORACLES["apply_none"] = f"{UNIFORM} {_unchanged('TRUE')}"

ORACLES["operation_outcomes"] = f"""{UNIFORM},
ops AS (SELECT unnest(['SET', 'ADD', 'REPLACE', 'APPEND', 'PREPEND', 'DELETE', 'TOUCH', 'NONE']) AS op)
SELECT f.doc_id, f.seq, o.op,
       CASE WHEN o.op = 'NONE' THEN 'ignored'
            WHEN o.op = 'SET' THEN 'stored'
            WHEN o.op = 'ADD' THEN CASE WHEN l.doc_id IS NULL AND f.seq = k.first_seq THEN 'stored' ELSE 'exists' END
            WHEN l.doc_id IS NULL THEN 'missing'
            WHEN o.op = 'DELETE' THEN CASE WHEN f.seq = k.first_seq THEN 'deleted' ELSE 'missing' END
            WHEN o.op = 'TOUCH' THEN 'touched' ELSE 'stored' END AS outcome
FROM feed f JOIN per_key k USING (doc_id) LEFT JOIN live l ON l.doc_id = f.doc_id, ops o
"""

# --- mixed mutations: one action at a time ---------------------------------------------------------------

MIXED = f"""
WITH RECURSIVE {PROFILES}, {FEED},
steps AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS rn FROM feed WHERE op <> 'NONE'),
run AS (
  SELECT k.doc_id, CAST(0 AS BIGINT) AS rn, l.doc_id IS NOT NULL AS present, l.value AS value, l.e AS e,
         CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS op, CAST(NULL AS VARCHAR) AS outcome
  FROM (SELECT DISTINCT doc_id FROM steps) k LEFT JOIN live l ON l.doc_id = k.doc_id
  UNION ALL
  SELECT r.doc_id, s.rn,
         CASE WHEN s.op IN ('SET', 'ADD') THEN TRUE WHEN s.op = 'DELETE' THEN FALSE ELSE r.present END,
         CASE WHEN s.op = 'SET' OR (s.op = 'ADD' AND NOT r.present) OR (s.op = 'REPLACE' AND r.present) THEN s.v
              WHEN s.op = 'APPEND' AND r.present THEN r.value || s.v
              WHEN s.op = 'PREPEND' AND r.present THEN s.v || r.value
              WHEN s.op = 'DELETE' THEN NULL ELSE r.value END,
         CASE WHEN s.op = 'SET' OR (s.op = 'ADD' AND NOT r.present) OR (s.op IN ('REPLACE', 'TOUCH') AND r.present)
              THEN CASE WHEN s.x > 0 THEN {AS_OF} + s.x END
              WHEN s.op = 'DELETE' THEN NULL ELSE r.e END,
         s.seq, s.op,
         CASE WHEN s.op = 'SET' THEN 'stored'
              WHEN s.op = 'ADD' THEN CASE WHEN r.present THEN 'exists' ELSE 'stored' END
              WHEN NOT r.present THEN 'missing'
              WHEN s.op = 'DELETE' THEN 'deleted' WHEN s.op = 'TOUCH' THEN 'touched' ELSE 'stored' END
  FROM run r JOIN steps s ON s.doc_id = r.doc_id AND s.rn = r.rn + 1),
outcomes AS (
  SELECT doc_id, seq, op, outcome FROM run WHERE rn > 0
  UNION ALL SELECT doc_id, seq, op, 'ignored' FROM feed WHERE op = 'NONE'),
changed AS (SELECT doc_id FROM outcomes GROUP BY doc_id
  HAVING sum(CASE WHEN outcome IN ('stored', 'deleted', 'touched') THEN 1 ELSE 0 END) > 0),
final AS (SELECT doc_id, arg_max(present, rn) AS present, max(rn) AS rn FROM run GROUP BY doc_id)
"""
ORACLES["apply_mixed"] = f"""{MIXED}
SELECT doc_id, value, e AS expires_epoch FROM profiles WHERE doc_id NOT IN (SELECT doc_id FROM changed)
UNION ALL
SELECT r.doc_id, r.value, r.e FROM run r JOIN final f ON f.doc_id = r.doc_id AND f.rn = r.rn
WHERE f.present AND r.doc_id IN (SELECT doc_id FROM changed)
"""
ORACLES["apply_changes"] = f"""{MIXED}
SELECT r.doc_id, CASE WHEN f.present THEN r.value END AS value, CASE WHEN f.present THEN r.e END AS expires_epoch,
       NOT f.present AS deleted
FROM run r JOIN final f ON f.doc_id = r.doc_id AND f.rn = r.rn WHERE r.doc_id IN (SELECT doc_id FROM changed)
"""
ORACLES["job_save_actions"] = ORACLES["apply_mixed"]
ORACLES["mixed_outcomes"] = f"{MIXED} SELECT doc_id, seq, op, outcome FROM outcomes"
ORACLES["outcome_counters"] = f"""{MIXED}
SELECT 'FAILED_STORE_OPERATIONS' AS counter, count(*) AS value FROM outcomes WHERE outcome IN ('exists', 'missing')
UNION ALL SELECT 'EXISTENT_KEYS', count(*) FROM outcomes WHERE outcome = 'exists'
UNION ALL SELECT 'NON_EXISTENT_TOUCHED_KEYS', count(*) FROM outcomes WHERE op = 'TOUCH' AND outcome = 'missing'
"""
ORACLES["failed_shares"] = f"""{MIXED}
SELECT seq % 20 AS chunk_id, count(*) AS n_rows, CAST(sum(CASE WHEN outcome IN ('exists', 'missing') THEN 1 ELSE 0 END) AS BIGINT) AS n_failed,
       round(sum(CASE WHEN outcome IN ('exists', 'missing') THEN 1.0 ELSE 0.0 END) / count(*), 9) AS failed_share
FROM outcomes GROUP BY seq % 20
"""

ORACLES["apply_dialogue"] = """
SELECT 'c' || conv_id AS doc_id, string_agg(role || ': ' || text || chr(10), '' ORDER BY turn) AS value
FROM conversations GROUP BY conv_id
"""

ORDERS = f"""
order_docs AS (
  SELECT 'o' || o_orderkey AS doc_id, o_orderstatus || '/' || o_orderpriority AS value,
         CASE WHEN o_orderkey % 5 > 0 THEN {AS_OF} + o_orderkey % 5 * 3600 END AS e
  FROM orders)
"""
ORACLES["expiry_live"] = f"""
WITH {ORDERS}
SELECT doc_id, value, e AS expires_epoch FROM order_docs WHERE e IS NULL OR e > {AS_OF} + 7200
"""

ORACLES["key_existence_split"] = f"""
WITH {PROFILES}, {FEED}
SELECT l.doc_id IS NOT NULL AS present, count(*) AS n_keys, CAST(sum(k.n) AS BIGINT) AS n_rows
FROM (SELECT doc_id, count(*) AS n FROM feed GROUP BY doc_id) k LEFT JOIN live l ON l.doc_id = k.doc_id GROUP BY 1
"""

ORACLES["existing_feed_rows"] = f"""
WITH {PROFILES}, {FEED} SELECT doc_id, seq, op FROM feed WHERE doc_id IN (SELECT doc_id FROM live)
"""
ORACLES["missing_feed_rows"] = f"""
WITH {PROFILES}, {FEED} SELECT doc_id, seq, op FROM feed WHERE doc_id NOT IN (SELECT doc_id FROM live)
"""

# --- updates -----------------------------------------------------------------------------------------

ORACLES["update_profiles"] = f"""
WITH {PROFILES},
totals AS (
  SELECT 'u' || user_id * 20 AS doc_id, 'n=' || count(*) || ',last=' || max(event_id) AS t
  FROM events WHERE event_type = 'purchase' GROUP BY user_id)
SELECT doc_id, value, e AS expires_epoch FROM profiles WHERE doc_id NOT IN (SELECT doc_id FROM totals)
UNION ALL
SELECT t.doc_id, CASE WHEN l.doc_id IS NULL THEN t.t ELSE l.value || '|' || t.t END,
       {AS_OF} + CASE WHEN l.doc_id IS NULL THEN 60 ELSE 90 END
FROM totals t LEFT JOIN live l ON l.doc_id = t.doc_id
"""
ORACLES["job_update"] = ORACLES["update_profiles"]

SEQUENTIAL = f"""
WITH RECURSIVE {PROFILES},
steps AS (
  SELECT 'u' || user_id * 20 AS doc_id, event_type AS kind, 'v' || event_id || ';' AS v,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
  FROM events),
run AS (
  SELECT k.doc_id, CAST(0 AS BIGINT) AS rn, l.value AS value, l.e AS e, 0 AS stored, 0 AS ignored
  FROM (SELECT DISTINCT doc_id FROM steps) k LEFT JOIN live l ON l.doc_id = k.doc_id
  UNION ALL
  SELECT r.doc_id, s.rn,
         CASE WHEN s.kind = 'error' THEN NULL WHEN r.value IS NULL THEN s.v
              WHEN length(r.value) > 40 THEN s.v ELSE r.value || s.v END,
         CASE WHEN s.kind = 'error' THEN NULL WHEN r.value IS NULL THEN {AS_OF} + 60
              WHEN length(r.value) > 40 THEN NULL ELSE r.e END,
         CASE WHEN r.value IS NULL AND s.kind = 'error' THEN 0 ELSE 1 END,
         CASE WHEN r.value IS NULL AND s.kind = 'error' THEN 1 ELSE 0 END
  FROM run r JOIN steps s ON s.doc_id = r.doc_id AND s.rn = r.rn + 1),
final AS (SELECT doc_id, max(rn) AS rn FROM run GROUP BY doc_id)
"""
ORACLES["update_sequential"] = f"""{SEQUENTIAL}
SELECT doc_id, value, e AS expires_epoch FROM profiles WHERE doc_id NOT IN (SELECT doc_id FROM final)
UNION ALL
SELECT r.doc_id, r.value, r.e FROM run r JOIN final f ON f.doc_id = r.doc_id AND f.rn = r.rn
WHERE r.value IS NOT NULL
"""
ORACLES["update_python_merge"] = ORACLES["update_sequential"]
ORACLES["update_summary"] = f"""{SEQUENTIAL}
SELECT doc_id, CAST(sum(stored) AS BIGINT) AS stored, CAST(0 AS BIGINT) AS already_exists, CAST(0 AS BIGINT) AS missing,
       CAST(0 AS BIGINT) AS missing_touched, CAST(sum(ignored) AS BIGINT) AS ignored
FROM run GROUP BY doc_id
"""

COMPOSED = SEQUENTIAL.replace(
    "WHEN length(r.value) > 40 THEN s.v ELSE", "WHEN s.kind = 'purchase' THEN 'p' || r.value || '|' || s.v ELSE"
).replace("WHEN length(r.value) > 40 THEN NULL ELSE", f"WHEN s.kind = 'purchase' THEN {AS_OF} + 90 ELSE")
ORACLES["update_in_one_pass"] = ORACLES["update_sequential"].replace(SEQUENTIAL, COMPOSED)
ORACLES["update_in_one_pass_summary"] = ORACLES["update_summary"].replace(SEQUENTIAL, COMPOSED)

ORACLES["lookup_merge"] = """
SELECT CAST(l.doc_id * 2 AS VARCHAR) AS doc_id, l.doc_id AS seq,
       CASE WHEN d.doc_id IS NULL THEN 'NONE' WHEN l.toxic = 1 THEN 'DELETE' ELSE 'REPLACE' END AS op,
       CASE WHEN d.doc_id IS NOT NULL AND l.toxic <> 1 THEN d.text || 'q' || l.quality END AS value,
       0 AS expiry
FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id * 2
"""

ORACLES["batch_stats"] = """
WITH lanes AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)
SELECT 'BULKS_COUNT' AS counter, CAST(sum((n + 127) // 128) AS BIGINT) AS value FROM lanes
UNION ALL SELECT 'BULK_SIZES_SUM', CAST(sum(n) AS BIGINT) FROM lanes
"""
ORACLES["batches"] = """
WITH numbered AS (
  SELECT event_type, event_id, (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 128 AS batch_id
  FROM events)
SELECT event_type, batch_id, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id
FROM numbered GROUP BY event_type, batch_id
"""

# --- retries and gates -------------------------------------------------------------------------------

ATTEMPTS = f"""
WITH {FEED},
log AS (
  SELECT doc_id, seq, op, t AS try_no,
         CASE WHEN t < seq % 4 THEN 'Temporary failure' WHEN seq % 10 = 7 THEN 'Timed out'
              WHEN seq % 10 = 3 THEN 'Data exists for key' ELSE 'Success' END AS status,
         CASE WHEN t < seq % 4 AND t < 2 THEN 1 ELSE 0 END AS wait_ms
  FROM feed, range(0, 3) AS r(t) WHERE op <> 'NONE' AND t <= seq % 4)
"""
ORACLES["push_log"] = f"""{ATTEMPTS}
SELECT doc_id, seq, op, CAST(try_no AS INTEGER) AS try_no, status, CAST(wait_ms AS INTEGER) AS wait_ms FROM log"""
ORACLES["push_resumable_log"] = ORACLES["push_log"]
ORACLES["fetched_documents"] = """
SELECT 'u' || user_id * 20 AS doc_id, event_id, CASE WHEN user_id % 2 = 0 THEN 'profile of u' || user_id * 20 END AS existing
FROM events
"""
ORACLES["update_outside_log"] = """
SELECT 'u' || user_id * 20 AS doc_id, event_id AS seq, CASE WHEN user_id % 2 = 0 THEN 'APPEND' ELSE 'ADD' END AS op,
       CAST(t AS INTEGER) AS try_no,
       CASE WHEN t < event_id % 4 THEN 'Temporary failure' WHEN event_id % 10 = 7 THEN 'Timed out'
            WHEN event_id % 10 = 3 THEN 'Data exists for key' ELSE 'Success' END AS status,
       CASE WHEN t < event_id % 4 AND t < 2 THEN 1 ELSE 0 END AS wait_ms
FROM events, range(0, 3) AS r(t) WHERE t <= event_id % 4
"""
ORACLES["attempt_profile"] = f"""{ATTEMPTS}
SELECT 'FAILED_STORE_OPERATIONS' AS counter, count(*) AS value FROM log WHERE status <> 'Success'
UNION ALL SELECT 'EXISTENT_KEYS', count(*) FROM log WHERE status LIKE '%exists%'
UNION ALL SELECT 'NON_EXISTENT_TOUCHED_KEYS', count(*) FROM log WHERE status <> 'Success' AND op = 'TOUCH'
UNION ALL SELECT 'TIMEOUT_OPERATIONS', count(*) FROM log WHERE status = 'Timed out'
UNION ALL SELECT 'TOTAL_TIMEOUT', CAST(sum(wait_ms) AS BIGINT) FROM log
UNION ALL SELECT 'EXP_BACKOFF_COUNT_FOR_TRY_' || try_no, count(*) FROM log WHERE try_no > 0 GROUP BY try_no
UNION ALL SELECT 'FAILED_RECORDS', count(*) FROM (SELECT seq, arg_max(status, try_no) AS s FROM log GROUP BY seq) WHERE s <> 'Success'
"""
ORACLES["backoff_waits"] = """
SELECT event_id, coalesce(string_agg(CAST(w AS VARCHAR), ',' ORDER BY i), '') AS waits, coalesce(CAST(sum(w) AS BIGINT), 0) AS total_wait
FROM (SELECT e.event_id, t.i, CASE WHEN t.i IS NOT NULL THEN least(CAST(pow(2, t.i) AS BIGINT), 1000) END AS w
      FROM events e LEFT JOIN range(0, 18) AS t(i) ON t.i < e.event_id % 18)
GROUP BY event_id
"""

# --- jobs --------------------------------------------------------------------------------------------

ORACLES["job_import"] = f"""
WITH {TEXTS}
SELECT i.doc_id, s.value FROM listed l JOIN indexed i USING (view_key) JOIN stored s ON s.doc_id = i.doc_id
"""
ORACLES["job_import_cells"] = f"""
WITH {TEXTS}
SELECT DISTINCT hex(encode(i.doc_id)) AS row_key, 'd' AS family, 'text' AS qualifier, hex(encode(s.value)) AS value
FROM listed l JOIN indexed i USING (view_key) JOIN stored s ON s.doc_id = i.doc_id
"""
EXPORTED = f"""
WITH {LINES}, {ORDERS},
base AS (SELECT * FROM order_docs),
alive AS (SELECT * FROM base WHERE e IS NULL OR e > {AS_OF}),
pairs AS (SELECT k, CASE WHEN kind = 6 THEN '' ELSE st END AS v FROM lines WHERE kind IN (0, 6))
"""
ORACLES["job_export"] = f"""{EXPORTED}
SELECT doc_id, value, e AS expires_epoch FROM base
UNION ALL SELECT k, v, {AS_OF} + 60 FROM pairs WHERE k NOT IN (SELECT doc_id FROM base)
"""
ORACLES["job_export_counters"] = f"""{EXPORTED}
SELECT 'FAILED_STORE_OPERATIONS' AS counter, count(*) AS value FROM pairs WHERE k NOT IN (SELECT doc_id FROM alive)
UNION ALL SELECT 'EXISTENT_KEYS', 0
UNION ALL SELECT 'NON_EXISTENT_TOUCHED_KEYS', 0
UNION ALL SELECT 'LINES_WITH_WRONG_COLUMNS_COUNT', count(*) FROM lines WHERE kind IN (1, 2, 3, 4)
"""

# --- larger feeds ------------------------------------------------------------------------------------

LINE_FEED = """
stored AS (SELECT 'o' || o_orderkey AS doc_id, o_orderstatus || '/' || o_orderpriority AS value FROM orders),
feed AS (
  SELECT 'o' || l_orderkey AS doc_id,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS seq,
         'q' || CAST(l_quantity AS BIGINT) AS v, l_linenumber % 9 AS kind
  FROM lineitem)
"""
ORACLES["apply_line_feed"] = f"""
WITH {LINE_FEED}, newest AS (SELECT doc_id, arg_max(v, seq) AS v FROM feed GROUP BY doc_id)
SELECT coalesce(s.doc_id, n.doc_id) AS doc_id, coalesce(n.v, s.value) AS value, CAST(NULL AS BIGINT) AS expires_epoch
FROM stored s FULL OUTER JOIN newest n ON n.doc_id = s.doc_id
"""
ORACLES["apply_line_feed_mixed"] = f"""
WITH RECURSIVE {LINE_FEED},
steps AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS rn FROM feed WHERE kind <> 8),
run AS (
  SELECT k.doc_id, CAST(0 AS BIGINT) AS rn, s.doc_id IS NOT NULL AS present, s.value AS value
  FROM (SELECT DISTINCT doc_id FROM steps) k LEFT JOIN stored s ON s.doc_id = k.doc_id
  UNION ALL
  SELECT r.doc_id, t.rn, CASE WHEN kind IN (0, 1) THEN TRUE WHEN kind = 5 THEN FALSE ELSE present END,
         CASE WHEN kind = 0 OR (kind = 1 AND NOT present) OR (kind = 2 AND present) THEN t.v
              WHEN kind = 3 AND present THEN r.value || t.v WHEN kind = 4 AND present THEN t.v || r.value
              WHEN kind = 5 THEN NULL ELSE r.value END
  FROM run r JOIN steps t ON t.doc_id = r.doc_id AND t.rn = r.rn + 1),
final AS (SELECT doc_id, arg_max(present, rn) AS present, arg_max(coalesce(value, ''), rn) AS value FROM run GROUP BY doc_id)
SELECT doc_id, value, CAST(NULL AS BIGINT) AS expires_epoch FROM stored WHERE doc_id NOT IN (SELECT doc_id FROM final)
UNION ALL SELECT doc_id, value, CAST(NULL AS BIGINT) FROM final WHERE present
"""

# --- cells loaded twice --------------------------------------------------------------------------------

ORACLES["cells_loaded"] = """
WITH first AS (SELECT url AS k, arg_max(md5(html), page_id) AS v FROM pages WHERE url IS NOT NULL GROUP BY url),
more AS (
  SELECT k, arg_max(v, put) AS v FROM (
    SELECT 'https://' || source AS k, lang AS v, doc_id AS put FROM documents
    UNION ALL SELECT url, 'seen', page_id FROM pages WHERE html LIKE '%<article%')
  WHERE k IS NOT NULL AND v IS NOT NULL GROUP BY k)
SELECT hex(encode(k)) AS row_key, 'd' AS family, 'digest' AS qualifier, hex(encode(v)) AS value
FROM (SELECT k, coalesce(m.v, f.v) AS v FROM first f FULL OUTER JOIN more m USING (k))
"""

# --- long key lists ------------------------------------------------------------------------------------

ORACLES["import_long_range"] = f"""
WITH {CLICKS}, listed AS (
  SELECT '2024' || lpad(CAST(d AS VARCHAR), 4, '0') AS day, part FROM range(1, 1232) AS t(d), range(2) AS p(part)
  UNION ALL SELECT '20240115', part FROM range(3) AS p(part))
SELECT doc_id, value FROM dated JOIN listed ON listed.day = dated.day AND listed.part = dated.sec % 2
"""

# --- stores in buckets, and views that follow them -----------------------------------------------------

ORACLES["store_buckets_apply"] = ORACLES["apply_mixed"]
ORACLES["store_buckets_export"] = ORACLES["job_export"]
ORACLES["store_buckets_update"] = ORACLES["job_update"]
ORACLES["store_snapshots_shared"] = """
WITH stored AS (
  SELECT 'o' || o_orderkey AS doc_id, o_orderstatus || '/' || o_orderpriority AS value,
         o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9900) AS gone
  FROM orders)
SELECT 1 AS version, doc_id, value FROM stored UNION ALL SELECT 2, doc_id, value FROM stored WHERE NOT gone
"""
ORACLES["store_lookup"] = """
SELECT 'o' || o_orderkey AS doc_id, o_orderstatus || '/' || o_orderpriority AS value FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1
"""
_AFTER_FEED = f"""
SELECT '[' || length(value) % 7 || ']' AS view_key, CAST(length(value) % 7 AS VARCHAR) AS k0, doc_id,
       substr(value, 1, 4) AS emitted
FROM ({ORACLES["apply_mixed"]})
"""
ORACLES["view_after_changes"] = _AFTER_FEED
ORACLES["followed_view_scan"] = f"""
SELECT key_ord, doc_id, emitted FROM ({_AFTER_FEED})
JOIN (VALUES (0, '0'), (1, '1'), (2, '2'), (3, '3'), (4, '5'), (5, '5'), (6, '9')) AS listed(key_ord, k0) USING (k0)
"""

ORACLES["job_import_page_files"] = ORACLES["job_import_paged"]
