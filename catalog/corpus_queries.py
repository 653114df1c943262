"""Corpus manifest, lint, citations, chunking."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import corpus_sql as Q
from catalog import corpus_tables as ct
from catalog import table_sql as S
from catalog.registry import query
from catalog.tables import deployments
from shiplens.operators import chunking, corpus

_SHOWN = """doc_id, filename, source_format, document_type, retrieval_mode, vendor,
array_to_string(vendors, ',') AS vendors, device_family, transition_class,
site_criticality_scope, evidence_strength, provenance,
array_to_string(source_deployment_ids, ',') AS source_deployment_ids,
array_to_string(malformed_refs, ',') AS malformed_refs, sha256"""


@query("manifest", f"WITH {Q.MANIFEST} SELECT {_SHOWN} FROM man")
def manifest(spark, sf):
    lists = ("vendors", "source_deployment_ids", "malformed_refs")
    return ct.manifest(spark, sf).drop("text").withColumns(
        {c: F.array_join(c, ",") for c in lists})


_REVIEWED = f"""
{Q.MANIFEST},
num AS (SELECT *, regexp_extract(filename, '(\\d+)\\.md$', 1)::BIGINT AS n FROM man),
rev AS (SELECT * REPLACE (
    CASE WHEN n % 43 = 0 THEN 'UNRATED' ELSE evidence_strength END AS evidence_strength,
    CASE WHEN n % 47 = 0 THEN '0' ELSE sha256 END AS sha256,
    CASE WHEN n % 59 = 0 THEN 'hearsay' ELSE provenance END AS provenance)
  FROM num WHERE n % 53 <> 0)
"""
_V = list(ct.VENDORS)


@query("lint_violations", f"""
WITH {_REVIEWED},
j AS (SELECT r.*, m.evidence_strength AS m_strength, m.sha256 AS m_sha, m.provenance AS m_prov
  FROM rev r JOIN man m USING (filename)),
v AS (
  SELECT filename, 'unknown_provenance' AS rule, provenance AS detail FROM j
    WHERE provenance NOT IN ('internal_derived', 'external_sourced')
  UNION ALL SELECT filename, 'missing_evidence_strength', coalesce(evidence_strength, 'none') FROM j
    WHERE document_type <> 'META' AND coalesce(evidence_strength, '') NOT IN ('HIGH','MEDIUM','LOW')
  UNION ALL SELECT filename, 'content_changed', 'sha256' FROM j WHERE sha256 <> m_sha
  UNION ALL SELECT filename, 'differs:evidence_strength', coalesce(evidence_strength, 'none')
    || ' but document says ' || coalesce(m_strength, 'none') FROM j
    WHERE evidence_strength IS DISTINCT FROM m_strength
  UNION ALL SELECT filename, 'differs:provenance', provenance || ' but document says ' || m_prov FROM j
    WHERE provenance <> m_prov
  UNION ALL SELECT filename, 'body_vendor_disagrees',
      coalesce({Q.field('text', 'Vendor', _V)}, 'none') FROM j
    WHERE len(vendors) = 1 AND {Q.field('text', 'Vendor', _V)} IS DISTINCT FROM vendors[1]
  UNION ALL SELECT filename, 'body_family_disagrees', {Q.field('text', 'Device Family', ct.FAMILIES)}
    FROM j WHERE {Q.field('text', 'Device Family', ct.FAMILIES)} IS NOT NULL
      AND {Q.field('text', 'Device Family', ct.FAMILIES)} IS DISTINCT FROM device_family
  UNION ALL SELECT filename, 'references_upcoming', 'UPC_12' FROM j WHERE text LIKE '%UPC_12%')
SELECT * FROM v""")
def lint_violations(spark, sf):
    return corpus.record_problems(
        ct.reviewed(spark, sf), ct.documents(spark, sf), ct.CONTRACT)


def _index(spark, sf):
    n = F.regexp_extract("filename", r"(\d+)\.md$", 1).cast("bigint")
    return ct.documents(spark, sf).select("filename").where(n % 61 != 0)


@query("presence_problems", f"""
WITH {_REVIEWED}
SELECT filename, 'presence' AS rule, 'directory only' AS detail FROM num WHERE n % 53 = 0
UNION ALL SELECT filename, 'index', 'directory only' FROM num WHERE n % 61 = 0""")
def presence_problems(spark, sf):
    return corpus.presence_problems(
        ct.documents(spark, sf), ct.reviewed(spark, sf), _index(spark, sf))


@query("duplicate_doc_ids", f"""
WITH {Q.MANIFEST}, x AS (SELECT CASE WHEN d % 71 = 0 THEN 'KB-001' ELSE doc_id END AS doc_id FROM man)
SELECT doc_id, count(*) AS documents FROM x GROUP BY 1 HAVING count(*) > 1""")
def duplicate_doc_ids(spark, sf):
    n = F.regexp_extract("filename", r"(\d+)\.md$", 1).cast("bigint") - 1
    return corpus.duplicate_doc_ids(ct.manifest(spark, sf).withColumn(
        "doc_id", F.when(n % 71 == 0, "KB-001").otherwise(F.col("doc_id"))))


@query("strength_totals", f"""
WITH {Q.MANIFEST}
SELECT s AS strength, CASE s WHEN 'HIGH' THEN 330 WHEN 'LOW' THEN 7 ELSE 0 END AS claimed,
  (SELECT count(*) FROM man WHERE evidence_strength = s) AS carried
FROM (SELECT unnest(['HIGH', 'MEDIUM', 'LOW']) AS s)""")
def strength_totals(spark, sf):
    return corpus.strength_totals(
        ct.manifest(spark, sf), ct.documents(spark, sf), ct.CONTRACT)


@query("unresolved_refs", f"""
WITH {Q.MANIFEST}, c AS (SELECT filename, unnest(source_deployment_ids) AS deployment_id FROM man)
SELECT filename, deployment_id FROM c WHERE deployment_id NOT IN (
  SELECT format('DEP_{{:06d}}', o_orderkey) FROM orders)""")
def unresolved_refs(spark, sf):
    return corpus.unresolved_refs(
        ct.manifest(spark, sf), deployments(spark, sf, ("deployment_id",))
    ).select("filename", "deployment_id")


_GOLD = f"""
{Q.MANIFEST}, {S.DEPLOYMENTS},
c AS (SELECT filename, doc_id, document_type, vendors, device_family,
    unnest(CASE WHEN len(source_deployment_ids) = 0 THEN [NULL] ELSE source_deployment_ids END)
      AS deployment_id FROM man),
j AS (SELECT c.*, dep.deployment_id IS NOT NULL AS found, vendor_name, device_type
  FROM c LEFT JOIN dep USING (deployment_id)),
gold AS (SELECT filename, doc_id, document_type, count(deployment_id) AS cited,
    count(*) FILTER (WHERE found) AS resolved,
    round(avg(CASE WHEN found AND len(vendors) > 0
      THEN list_contains(vendors, vendor_name)::INT END), 9) AS vendor_match,
    round(avg(CASE WHEN found AND device_family IS NOT NULL
      THEN coalesce(device_type = device_family, false)::INT END), 9) AS family_match
  FROM j GROUP BY ALL)
"""


def _consistency(spark, sf):
    history = deployments(spark, sf, ("deployment_id", "vendor_name", "device_type"))
    return corpus.gold_consistency(ct.manifest(spark, sf), history)


@query("gold_consistency", f"WITH {_GOLD} SELECT * FROM gold")
def gold_consistency(spark, sf):
    return _consistency(spark, sf).withColumns(
        {c: F.round(c, 9) for c in ("vendor_match", "family_match")})


@query("gold_by_type", f"""
WITH {_GOLD}
SELECT document_type, count(*) AS documents, sum(cited) AS cited, sum(resolved) AS resolved,
  round(avg(vendor_match), 6) AS vendor_match, round(avg(family_match), 6) AS family_match
FROM gold GROUP BY 1""")
def gold_by_type(spark, sf):
    return corpus.gold_by_type(_consistency(spark, sf)).withColumns(
        {c: F.round(c, 6) for c in ("vendor_match", "family_match")})


@query("chunks", f"""
WITH {Q.CHUNKS}
SELECT chunk_id, doc_id, chunk_index, chunk_kind, document_type, filename, text FROM chunks""")
def chunks(spark, sf):
    return ct.chunks(spark, sf).select(
        "chunk_id", "doc_id", "chunk_index", "chunk_kind", "document_type", "filename", "text")


@query("chunk_counts", f"""
WITH {Q.CHUNKS}
SELECT document_type, count(*) AS chunks, count(DISTINCT doc_id) AS documents
FROM chunks GROUP BY 1""")
def chunk_counts(spark, sf):
    return chunking.chunk_counts(ct.chunks(spark, sf))


@query("structure_warnings", f"""
WITH {Q.CHUNKS},
pd AS (SELECT doc_id, filename, document_type, count(*) AS chunks,
    bool_or(chunk_kind = 'whole') AS collapsed FROM chunks
  WHERE document_type NOT IN ('Matrix', 'META') GROUP BY ALL),
md AS (SELECT document_type, median(chunks) AS median FROM pd GROUP BY 1)
SELECT doc_id, filename, document_type, chunks, median, collapsed FROM pd JOIN md USING (document_type)
WHERE collapsed OR abs(chunks - median) / median > 0.5""")
def structure_warnings(spark, sf):
    return chunking.structure_warnings(ct.chunks(spark, sf))


@query("chunk_invariants", f"""
WITH {Q.CHUNKS},
x AS (SELECT *, list_filter(string_split(text, chr(10)), lambda t: regexp_matches(t, '^\\s*\\d+\\.\\s+'))
    AS st, string_split(text, chr(10)) AS ls,
    floor(len(regexp_extract_all(text, '\\S+')) * 1.3::DOUBLE) AS size FROM chunks),
y AS (SELECT *, list_transform(st, lambda t: regexp_extract(t, '^\\s*(\\d+)\\.', 1)::BIGINT) AS nums FROM x)
SELECT chunk_id AS subject, 'merges_sections' AS rule FROM y WHERE chunk_kind <> 'whole'
  AND document_type IN ('Postmortem', 'Transition', 'CrossVendor')
  AND len(list_filter(ls, lambda t: starts_with(t, '## '))) <> 1
UNION ALL SELECT chunk_id, 'no_leading_heading' FROM y WHERE chunk_kind <> 'whole'
  AND document_type IN ('Postmortem', 'Transition', 'CrossVendor') AND NOT regexp_matches(ls[1], '^\\s*#')
UNION ALL SELECT chunk_id, 'empty' FROM y WHERE regexp_matches(text, '^\\s*$')
UNION ALL SELECT chunk_id, 'vendor_outside_pair' FROM y WHERE document_type = 'CrossVendor'
  AND chunk_kind <> 'whole' AND len(list_filter({Q._list(_V)}, lambda v:
    contains(text, v) AND NOT list_contains(vendors, v))) > 0
UNION ALL SELECT chunk_id, 'prose_with_table' FROM y WHERE document_type = 'Advisory'
  AND chunk_kind = 'prose' AND len(list_filter(ls, lambda t: regexp_matches(t, '^\\s*\\|'))) > 0
UNION ALL SELECT chunk_id, 'table_cut' FROM y WHERE document_type = 'Advisory'
  AND chunk_kind <> 'whole' AND len(list_filter(list_transform(ls, lambda t, i:
    regexp_matches(t, '^\\s*\\|') AND (i = 1 OR NOT regexp_matches(ls[i - 1], '^\\s*\\|'))
    AND (i = len(ls) OR NOT regexp_matches(ls[i + 1], '^\\s*\\|[\\s:|-]+\\|\\s*$'))), lambda b: b)) > 0
UNION ALL SELECT chunk_id, 'note_size' FROM y WHERE document_type = 'RiskNote'
  AND chunk_kind <> 'whole' AND NOT size BETWEEN 300 AND 700
UNION ALL SELECT chunk_id, 'few_steps' FROM y WHERE chunk_kind = 'step' AND len(nums) < 2
UNION ALL SELECT chunk_id, 'steps_not_contiguous' FROM y WHERE chunk_kind = 'step' AND len(nums) > 0
  AND nums <> range(nums[1], nums[1] + len(nums))
UNION ALL SELECT chunk_id, 'not_one_rule' FROM y WHERE chunk_kind = 'rule' AND len(nums) <> 1
UNION ALL SELECT chunk_id, 'rule_without_exception' FROM y WHERE chunk_kind = 'rule'
  AND NOT contains(text, 'Exception Process')""")
def chunk_invariants(spark, sf):
    return chunking.invariant_violations(ct.chunks(spark, sf), ct.VENDORS)
