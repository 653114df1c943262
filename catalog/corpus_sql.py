"""The corpus of corpus_tables.py in SQL, and chunking restated with windows over lines."""

from __future__ import annotations

from catalog.corpus_tables import FAMILIES, KINDS, VENDORS, WORDS


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_FIELDS = [
    ("Document ID", "CASE WHEN kind <> 'META' THEN number END"),
    ("Vendor", "CASE WHEN scoped OR kind = 'Transition' THEN "
               "CASE WHEN d % 29 = 0 THEN other ELSE vendor END END"),
    ("Device Family", "CASE WHEN scoped THEN family END"),
    ("Primary Vendor", "CASE WHEN kind = 'CrossVendor' THEN vendor END"),
    ("Dependent Vendor", "CASE WHEN kind = 'CrossVendor' THEN other END"),
    ("Transition Category", "CASE WHEN kind = 'Transition' THEN cat END"),
    ("Site Criticality Scope", "CASE WHEN kind = 'Policy' THEN scope END"),
    ("Evidence Strength", "CASE WHEN kind <> 'META' THEN strength END"),
]
_NL = "chr(10)"

DOCUMENTS = f"""
b0 AS (
  SELECT doc_id AS d, text, CASE WHEN doc_id = 8 THEN 'META' ELSE {_list(KINDS)}[doc_id % 8 + 1]
      END AS kind,
    {_list(VENDORS)}[(doc_id // 8) % 5 + 1] AS vendor,
    {_list(VENDORS)}[(doc_id // 8 + 1) % 5 + 1] AS other,
    {_list(FAMILIES)}[(doc_id // 40) % 6 + 1] AS family,
    format('KB-{{:03d}}', doc_id + 1) AS number,
    ['major', 'extreme'][(doc_id // 40) % 2 + 1] AS band,
    ['Major', 'Extreme'][(doc_id // 40) % 2 + 1] AS cat,
    ['HIGH', 'MEDIUM', 'LOW'][(doc_id // 8) % 3 + 1] AS scope,
    CASE WHEN doc_id % 37 <> 0 THEN ['HIGH', 'MEDIUM', 'LOW'][doc_id % 3 + 1] END AS strength,
    (doc_id // 8) % 4 AS layout, string_split(text, {_NL}) AS ls FROM documents),
b1 AS (SELECT *, kind IN ('Postmortem', 'Advisory', 'RiskNote', 'Runbook') AS scoped,
    ['| ', '**', '', ''][layout + 1] AS pre, [' | ', ':** ', ': ', ' '][layout + 1] AS sep,
    [' |', '', '', ''][layout + 1] AS post FROM b0),
docs AS (
  SELECT d, kind || '_' || CASE WHEN scoped THEN vendor || '_' || family || '_'
      WHEN kind = 'CrossVendor' THEN vendor || '_to_' || other || '_'
      WHEN kind = 'Transition' THEN vendor || '_' || band || '_'
      ELSE 'Topic_' END || number || '.md' AS filename,
    kind, vendor, other, family, band, scope, strength, number, scoped,
    concat_ws({_NL}, '# ' || kind || ' report ' || d || {_NL},
      CASE WHEN layout = 0 THEN '| Field | Value |' || {_NL} || '|---|---|' END,
      {', '.join(f"pre || '{n}' || sep || ({v}) || post" for n, v in _FIELDS)})
    || {_NL} || {_NL}
    || 'Observed with ' || {_list(WORDS)}[d % 10 + 1] || ' and '
    || {_list(WORDS)}[(d // 10) % 10 + 1] || '.' || {_NL}
    || format('Cited records DEP_{{:06d}}, DEP_{{:06d}} and DEP_{{:d}}.', d * 13,
      CASE WHEN d % 19 = 0 THEN d + 900000000 ELSE d * 13 + 5 END, d % 1000)
    || CASE WHEN d % 31 = 0 THEN ' See UPC_12.' ELSE '' END
    || CASE WHEN kind = 'Matrix' THEN ' Covers ' || vendor || '.' ELSE '' END
    || CASE WHEN kind = 'META' THEN {_NL} || '| HIGH | 100+ records | 330 |' || {_NL}
         || '| LOW | 5+ records | 7 |' ELSE '' END
    || {_NL} || {_NL}
    || CASE WHEN kind = 'Policy' THEN CASE WHEN (d // 8) % 5 = 4 THEN '## Rules' || {_NL}
         ELSE '## Mandatory Rules' || {_NL} END ELSE '' END
    || array_to_string(CASE
      WHEN kind IN ('Postmortem', 'Transition', 'CrossVendor') THEN
        list_transform(ls, lambda x, i: CASE WHEN (i - 1) % 3 = 0
          THEN '## Section ' || (i - 1) || {_NL} || x ELSE x END)
      WHEN kind = 'Advisory' THEN list_transform(ls, lambda x, i: CASE
          WHEN (i - 1) % 3 = 0 THEN '## Section ' || (i - 1) || {_NL} || x
          WHEN (i - 1) % 3 = 1 THEN x || {_NL} || '| Metric | Value |' || {_NL} || '|---|---|'
            || {_NL} || '| line | ' || (i - 1) || ' |'
          ELSE {_NL} || x END)
      WHEN kind = 'RiskNote' THEN list_transform(ls, lambda x: x || {_NL})
      WHEN kind = 'Runbook' THEN list_transform(ls, lambda x, i: CASE WHEN (i - 1) % 6 = 0
          THEN '## Stage ' || (i - 1) || {_NL} || x ELSE ((i - 1) % 6) || '. ' || x END)
      WHEN kind = 'Policy' THEN list_transform(ls, lambda x, i: CASE WHEN i = len(ls)
          THEN {_NL} || '## Exception Process' || {_NL} || x ELSE i || '. ' || x END)
      ELSE ls END, {_NL})
    || CASE WHEN d % 2 = 0 THEN {_NL} || '---' || {_NL} || '*Generated from the event history*'
       ELSE '' END AS text
  FROM b1)
"""


def field(text: str, name: str, values) -> str:
    return (f"nullif(regexp_extract({text}, '{name}[\\s|:*]+({'|'.join(values)})\\b', 1), '')")


MANIFEST = f"""
{DOCUMENTS},
man AS (
  SELECT d, CASE WHEN kind = 'META' THEN 'KB-000' ELSE number END AS doc_id, filename,
    'md' AS source_format, kind AS document_type,
    CASE kind WHEN 'Postmortem' THEN 'vector' WHEN 'Advisory' THEN 'hybrid'
      WHEN 'RiskNote' THEN 'vector' WHEN 'Transition' THEN 'hybrid' WHEN 'CrossVendor' THEN 'vector'
      WHEN 'META' THEN 'always' ELSE 'vectorless' END AS retrieval_mode,
    CASE WHEN kind IN ('Policy', 'Matrix', 'META') THEN 'vendor-neutral'
      WHEN kind = 'CrossVendor' THEN 'cross-vendor' ELSE vendor END AS vendor,
    CASE WHEN kind IN ('Policy', 'Matrix', 'META') THEN []::VARCHAR[]
      WHEN kind = 'CrossVendor' THEN [vendor, other] ELSE [vendor] END AS vendors,
    CASE WHEN scoped THEN family END AS device_family,
    CASE WHEN kind = 'Transition' THEN band END AS transition_class,
    CASE WHEN kind = 'Policy' THEN {field('text', 'Site Criticality Scope', ['HIGH', 'MEDIUM', 'LOW'])}
      END AS site_criticality_scope,
    {field('text', 'Evidence Strength', ['HIGH', 'MEDIUM', 'LOW'])} AS evidence_strength,
    'internal_derived' AS provenance,
    list_sort(list_distinct(list_filter(regexp_extract_all(text, '\\bDEP_\\d+'),
      lambda x: length(x) >= 10))) AS source_deployment_ids,
    list_sort(list_distinct(list_filter(regexp_extract_all(text, '\\bDEP_\\d+'),
      lambda x: length(x) < 10))) AS malformed_refs,
    sha256(text) AS sha256, text
  FROM docs)
"""

_STRIP = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
_AGG = "string_agg(line, chr(10) ORDER BY pos)"

CHUNKS = f"""
{MANIFEST},
l0 AS (
  SELECT filename, document_type AS kind, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM man),
l1 AS (
  SELECT *, regexp_full_match(line, '\\s*-{{3,}}\\s*') AS sep, line ~ '^\\s*$' AS blank,
    regexp_full_match(line, '\\s*\\*[^*_].*\\*\\s*') OR regexp_full_match(line, '\\s*_[^*_].*_\\s*')
      AS italic FROM l0),
l2 AS (SELECT *, max(CASE WHEN sep THEN pos END) OVER (PARTITION BY filename) AS last_sep FROM l1),
l3 AS (
  SELECT *, count(*) FILTER (WHERE pos > last_sep AND NOT blank) OVER d AS tail,
    count(*) FILTER (WHERE pos > last_sep AND NOT blank AND NOT italic) OVER d AS tail_plain
  FROM l2 WINDOW d AS (PARTITION BY filename)),
l AS (
  SELECT filename, kind, line, pos, blank, line ~ '^\\s*#' AS heading,
    starts_with(line, '## ') AS h2, line ~ '^\\s*\\|' AS trow,
    CASE WHEN line ~ '^\\s*\\d+\\.\\s+' THEN
      regexp_extract(line, '^\\s*(\\d+)\\.', 1)::BIGINT END AS step
  FROM l3 WHERE NOT sep AND NOT (last_sep IS NOT NULL AND tail > 0 AND tail_plain = 0
    AND pos >= last_sep)),
whole AS (SELECT filename, kind, {_STRIP.format(_AGG)} AS text,
    count(step) AS steps FROM l GROUP BY ALL),
-- sections: raw runs at '## ', heading-only ones folded forward, the last one back
r0 AS (SELECT *, sum(h2::INT) OVER (PARTITION BY filename ORDER BY pos) AS raw FROM l
  WHERE kind IN ('Postmortem', 'Transition', 'CrossVendor', 'Advisory', 'Policy')),
r1 AS (SELECT filename, raw, bool_or(NOT blank AND NOT heading) AS body FROM r0 GROUP BY ALL),
r2 AS (SELECT filename, raw, coalesce(
    min(CASE WHEN body THEN raw END) OVER (PARTITION BY filename ORDER BY raw
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
    max(CASE WHEN body THEN raw END) OVER (PARTITION BY filename), 0) AS sec FROM r1),
s AS (SELECT r0.*, sec, dense_rank() OVER (PARTITION BY filename ORDER BY sec) AS sec_no
  FROM r0 JOIN r2 USING (filename, raw)),
ns AS (SELECT filename, count(DISTINCT sec) AS n FROM s GROUP BY 1),
headed AS (
  SELECT filename, sec AS a, 0 AS b, 'prose' AS chunk_kind, {_STRIP.format(_AGG)} AS text
  FROM s JOIN ns USING (filename)
  WHERE n >= 2 AND kind IN ('Postmortem', 'Transition', 'CrossVendor') GROUP BY filename, sec),
-- advisory: runs of equal table-ness between blank lines, under the section's heading
a1 AS (SELECT s.*, max((NOT blank AND NOT heading)::INT) OVER (
    PARTITION BY filename, sec ORDER BY pos) AS started
  FROM s JOIN ns USING (filename) WHERE kind = 'Advisory' AND n >= 2),
a2 AS (SELECT filename, sec, coalesce({_STRIP.format(_AGG)}, '') AS head FROM a1
  WHERE started = 0 GROUP BY ALL),
a3 AS (SELECT *, lag(blank) OVER w AS pb, lag(trow) OVER w AS pt FROM a1 WHERE started = 1
  WINDOW w AS (PARTITION BY filename, sec ORDER BY pos)),
a4 AS (SELECT *, sum(CASE WHEN NOT blank AND (pb IS NULL OR pb OR pt <> trow) THEN 1 ELSE 0 END)
    OVER (PARTITION BY filename, sec ORDER BY pos) AS run FROM a3),
advised AS (
  SELECT filename, sec AS a, run AS b, CASE WHEN bool_or(trow) THEN 'table' ELSE 'prose' END
      AS chunk_kind, {_STRIP.format(f"coalesce(any_value(head), '') || chr(10) || chr(10) || {_AGG}")}
      AS text
  FROM a4 LEFT JOIN a2 USING (filename, sec) WHERE NOT blank GROUP BY filename, sec, run),
-- risk notes: greedy balanced groups in closed form
n1 AS (SELECT *, lag(blank) OVER (PARTITION BY filename ORDER BY pos) AS pb FROM l
  WHERE kind = 'RiskNote'),
n2 AS (SELECT *, sum(CASE WHEN NOT blank AND (pb IS NULL OR pb) THEN 1 ELSE 0 END)
    OVER (PARTITION BY filename ORDER BY pos) AS para FROM n1),
n3 AS (SELECT filename, para, {_STRIP.format(_AGG)} AS text FROM n2 WHERE NOT blank GROUP BY ALL),
n4 AS (SELECT *, floor(len(regexp_extract_all(text, '\\S+')) * 1.3::DOUBLE)::BIGINT AS size FROM n3),
n5 AS (SELECT *, sum(size) OVER (PARTITION BY filename) AS total,
    coalesce(sum(size) OVER (PARTITION BY filename ORDER BY para ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING), 0) + size / 2.0::DOUBLE AS mid FROM n4),
n6 AS (SELECT *, greatest(ceil(total / 700.0::DOUBLE), 1)::BIGINT AS groups FROM n5),
n7 AS (SELECT *, 1 + len(list_filter(range(1, groups), lambda k:
    mid > total / groups::DOUBLE * k)) AS target FROM n6),
n8 AS (SELECT *, para - 1 + least(1, min(CASE WHEN para > 1 THEN target - (para - 1) END) OVER (
    PARTITION BY filename ORDER BY para)) AS grp FROM n7),
noted AS (SELECT filename, coalesce(grp, 1) AS a, 0 AS b, 'prose' AS chunk_kind,
    string_agg(text, chr(10) || chr(10) ORDER BY para) AS text FROM n8 GROUP BY 1, 2),
-- runbooks: wrapped lines, runs by parity of the twos since the last certain restart
k0 AS (SELECT l.* FROM l JOIN whole w USING (filename)
  WHERE l.kind = 'Runbook' AND w.steps > 0 AND NOT blank),
k1 AS (SELECT *, lag(line) OVER w AS above, lead(step) OVER w AS below,
    count(step) OVER (PARTITION BY filename ORDER BY pos) AS g FROM k0
  WINDOW w AS (PARTITION BY filename ORDER BY pos)),
k2 AS (SELECT *, step IS NULL AND NOT regexp_matches(trim(above), '[.:!?]$')
    AND coalesce(below <> 1, true) AND NOT regexp_matches(line, '^\\s*[#>*|-]') AS can FROM k1),
k3 AS (SELECT *, step IS NULL AND g > 0 AND coalesce(bool_and(coalesce(can, false)) FILTER (
    WHERE step IS NULL) OVER (PARTITION BY filename, g ORDER BY pos), true) AS cont FROM k2),
k4 AS (SELECT *, sum((NOT cont)::INT) OVER (PARTITION BY filename ORDER BY pos) AS item FROM k3),
k5 AS (SELECT filename, item, max(step) AS no, CASE WHEN max(step) IS NULL THEN any_value(line)
    ELSE string_agg(trim(line), ' ' ORDER BY pos) END AS text FROM k4 GROUP BY 1, 2),
k6 AS (SELECT *, lag(no) OVER (PARTITION BY filename ORDER BY item) AS before
  FROM k5 WHERE no IS NOT NULL),
k7 AS (SELECT *, sum(CASE WHEN before IS NULL OR no <= 1 OR (no >= 3 AND before <> no - 1)
    THEN 1 ELSE 0 END) OVER (PARTITION BY filename ORDER BY item) AS seg FROM k6),
k8 AS (SELECT *, sum((no = 2 AND before IS NOT NULL)::INT) OVER (PARTITION BY filename, seg
    ORDER BY item) % 2 = 1 AS c FROM k7),
k9 AS (SELECT filename, item, no, text, sum((NOT c)::INT) OVER (PARTITION BY filename ORDER BY item)
    AS run FROM k8),
m1 AS (SELECT k5.*, coalesce(max(k9.run) OVER (PARTITION BY k5.filename ORDER BY k5.item), 0) AS run
  FROM k5 LEFT JOIN k9 ON k5.filename = k9.filename AND k5.item = k9.item),
m2 AS (SELECT *, max(run) OVER (PARTITION BY filename) AS runs,
    row_number() OVER (PARTITION BY filename, run, no IS NULL ORDER BY item DESC) AS from_end,
    row_number() OVER (PARTITION BY filename, run, no IS NULL ORDER BY item) - 1 AS i,
    count(*) OVER (PARTITION BY filename, run, no IS NULL) AS c FROM m1),
heads AS (SELECT filename, run + 1 AS run, text AS head FROM m2
  WHERE no IS NULL AND from_end = 1 AND run < runs),
m3 AS (SELECT *, (c + 3) // 4 AS gr FROM m2 WHERE no IS NOT NULL),
m4 AS (SELECT *, CASE WHEN i < (c % gr) * (c // gr + 1) THEN i // (c // gr + 1)
    ELSE (c % gr) + (i - (c % gr) * (c // gr + 1)) // (c // gr) END AS part FROM m3),
booked AS (
  SELECT m4.filename, m4.run AS a, part AS b, 'step' AS chunk_kind,
    {_STRIP.format("coalesce(any_value(head), '') || chr(10) || string_agg(text, chr(10) ORDER BY item)")}
      AS text
  FROM m4 LEFT JOIN heads ON heads.filename = m4.filename AND heads.run = m4.run
  GROUP BY m4.filename, m4.run, part
  UNION ALL
  SELECT filename, run, 1000000000, 'prose', {_STRIP.format('string_agg(text, chr(10) ORDER BY item)')}
  FROM m2 WHERE no IS NULL AND NOT (from_end = 1 AND run < runs) GROUP BY 1, 2),
-- policies: one chunk per rule with the title and the exception section
p1 AS (SELECT s.*, first_value(line) OVER (PARTITION BY filename, sec ORDER BY pos) AS top
  FROM s WHERE kind = 'Policy'),
p2 AS (SELECT filename, min(CASE WHEN starts_with(top, '## Mandatory Rules') THEN sec END) AS rules,
    min(CASE WHEN starts_with(top, '## Exception Process') THEN sec END) AS exc,
    coalesce(arg_min(line, pos) FILTER (WHERE starts_with(line, '# ')), '') AS title
  FROM p1 GROUP BY 1),
p3 AS (SELECT filename, {_AGG} AS terms FROM p1 JOIN p2 USING (filename) WHERE sec = exc GROUP BY 1),
ruled AS (
  SELECT filename, sec AS a, pos AS b, 'rule' AS chunk_kind,
    {_STRIP.format("title || chr(10) || top || chr(10) || line || chr(10) || chr(10) || terms")} AS text
  FROM p1 JOIN p2 USING (filename) JOIN p3 USING (filename)
  WHERE rules IS NOT NULL AND sec = rules AND step IS NOT NULL
  UNION ALL
  SELECT filename, sec, 0, 'prose', {_STRIP.format(_AGG)} FROM p1 JOIN p2 USING (filename)
  WHERE rules IS NOT NULL AND exc IS NOT NULL AND sec <> rules AND sec <> exc GROUP BY 1, 2),
pieces AS (SELECT * FROM headed UNION ALL SELECT * FROM advised UNION ALL SELECT * FROM noted
  UNION ALL SELECT * FROM booked UNION ALL SELECT * FROM ruled),
alls AS (SELECT * FROM pieces UNION ALL
  SELECT filename, 0, 0, 'whole', text FROM whole
  WHERE filename NOT IN (SELECT filename FROM pieces)),
chunks AS (
  SELECT doc_id || '_chunk_' || (row_number() OVER (PARTITION BY filename ORDER BY a, b) - 1)
      AS chunk_id, doc_id, row_number() OVER (PARTITION BY filename ORDER BY a, b) - 1 AS chunk_index,
    chunk_kind, document_type, vendor, vendors, evidence_strength, device_family,
    transition_class, site_criticality_scope, filename, alls.text AS text
  FROM alls JOIN man USING (filename))
"""
