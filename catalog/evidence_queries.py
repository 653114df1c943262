"""Vector top-k, retrieval routes, the gate and retrieval evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import corpus_sql as Q
from catalog import corpus_tables as ct
from catalog import table_sql as S
from catalog.contract_queries import _CORPUS_FLAG_SQL, QUERY_TEXT_SQL
from catalog.registry import ORACLES, query
from catalog.tables import deployments, risk_score_expression, table
from shiplens.functions import flags as fl
from shiplens.operators import gate, reteval, retrieval, scoring
from shiplens.operators.topk import filtered_topk
from shiplens.plans import evidence
from shiplens.sources.evidence_index import EvidenceIndex
from shiplens.sources.scratch import materialise, new_path


@query("cosine_topk", """
WITH v AS (SELECT vec_id::VARCHAR AS id, label, embedding::DOUBLE[] AS e FROM embeddings),
p AS (SELECT q.id AS query_id, i.id AS item_id, round(list_dot_product(q.e, i.e), 6) AS score
  FROM v q JOIN v i ON q.label = i.label),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM p)
SELECT query_id, item_id, score, rank FROM r WHERE rank <= 5""")
def cosine_topk(spark, sf):
    """Every vector against all vectors of its own label."""
    vectors = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("item_id"),
        F.col("label").cast("string").alias("slot"), F.col("embedding").alias("vector"))
    queries = vectors.withColumnRenamed("item_id", "query_id").withColumn("k", F.lit(5))
    return filtered_topk(queries, vectors).select("query_id", "item_id", "score", "rank")


@query("cosine_topk_hot_slot", """
WITH v AS (SELECT vec_id::VARCHAR AS id, embedding::DOUBLE[] AS e FROM embeddings),
p AS (SELECT q.id AS query_id, i.id AS item_id, round(list_dot_product(q.e, i.e), 6) AS score
  FROM v q JOIN v i ON true),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM p)
SELECT query_id, item_id, score, rank FROM r WHERE rank <= 3""")
def cosine_topk_hot_slot(spark, sf):
    """Every vector against all others, one slot cut into many blocks on both sides."""
    vectors = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("item_id"), F.lit("all").alias("slot"),
        F.col("embedding").alias("vector"))
    queries = vectors.withColumnRenamed("item_id", "query_id").withColumn("k", F.lit(3))
    return filtered_topk(queries, vectors, items_per_block=100, queries_per_block=150).select(
        "query_id", "item_id", "score", "rank")


def history(spark, sf):
    """Flagged deployments, written once for queries that read them in several steps: each step would
    sum up the lines of all orders anew."""
    return materialise(ct.flagged(spark, sf), "history")


def cited_history(spark, sf, known):
    """Likewise the flagged deployments that a record cites, for queries that ask for no others: an id is looked
    up among all orders before lines, customers and parts are joined."""
    ids = known.select(F.explode("source_deployment_ids").alias("deployment_id")).distinct()
    return materialise(ct.flagged(spark, sf, materialise(ids, "cited")), "history")


def records(spark, sf):
    """The manifest without texts, written once likewise."""
    return materialise(ct.manifest(spark, sf).drop("text"), "records")


def upcoming(spark, sf, rows=None):
    """Flagged deployments (`rows`, if they are written), a few of them from a vendor the corpus does not know."""
    key = F.substring("deployment_id", 5, 20).cast("bigint")
    return (ct.flagged(spark, sf) if rows is None else rows).withColumn(
        "vendor_name", F.when(key % 101 == 0, "Moxa").otherwise(F.col("vendor_name")))


def searchable(spark, sf):
    return evidence.build_corpus(ct.documents(spark, sf), ct.CONTRACT)[1]


_MENTIONS = ", ".join(
    "CASE WHEN " + " OR ".join(f"contains(lower({{0}}), '{w}')" for w in words)
    + f" THEN '{flag}' END" for flag, words in fl.CORPUS_FLAG_WORDS.items())


def mentioned(text: str) -> str:
    return f"list_filter([{_MENTIONS.format(text)}], lambda f: f IS NOT NULL)"


def _vectors(name: str, source: str, key: str, text: str) -> str:
    """CTE `name` (id, e): the hashed-word unit vector, rounded to single precision."""
    return f"""
{name}_w AS (SELECT {key} AS id,
    ('0x' || right(md5(unnest(regexp_extract_all(lower({text}), '[a-z0-9_]+'))), 2))::INT AS b
  FROM {source}),
{name}_c AS (SELECT id, b, count(*) AS n FROM {name}_w GROUP BY ALL),
{name}_n AS (SELECT id, map_from_entries(list((b, n))) AS m, sqrt(sum(n * n))::DOUBLE AS size
  FROM {name}_c GROUP BY 1),
{name} AS (SELECT id, list_transform(range(256), lambda b:
    (coalesce(m[b::INT], 0) / size)::FLOAT::DOUBLE)::DOUBLE[256] AS e FROM {name}_n)"""


_CHUNKS = Q.CHUNKS
_UP = f"""
{_CORPUS_FLAG_SQL},
up AS (SELECT * REPLACE (CASE WHEN o_orderkey % 101 = 0 THEN 'Moxa' ELSE vendor_name END
    AS vendor_name), CASE WHEN flags = '' THEN []::VARCHAR[] ELSE string_split(flags, ',') END AS fl
  FROM flagged),
asked AS (SELECT deployment_id AS query_id, {QUERY_TEXT_SQL} AS qtext, vendor_name, device_type,
    site_criticality, transition_class, cross_vendor_dependency_count, fl FROM up)
"""


def _routes(asked: str) -> str:
    """All six routes for the queries in CTE `asked`."""
    return f"""
items AS (
  SELECT 'evidence|' || unnest(list_distinct(vendors)) AS slot, chunk_id FROM chunks
    WHERE document_type IN ('Postmortem', 'Advisory', 'RiskNote')
  UNION ALL SELECT 'transition|' || unnest(list_distinct(vendors)) || '|' || transition_class, chunk_id
    FROM chunks WHERE document_type = 'Transition'
  UNION ALL SELECT 'cross_vendor|' || vendors[1], chunk_id FROM chunks
    WHERE document_type = 'CrossVendor'),
slots AS (
  SELECT query_id, 'evidence|' || vendor_name AS slot, 5 AS k FROM {asked}
  UNION ALL SELECT query_id, 'transition|' || vendor_name || '|' || transition_class, 2 FROM {asked}
    WHERE transition_class IS NOT NULL
  UNION ALL SELECT query_id, 'cross_vendor|' || vendor_name, 2 FROM {asked}
    WHERE cross_vendor_dependency_count > 0),
searched AS (SELECT * FROM chunks WHERE chunk_id IN (SELECT chunk_id FROM items)),
{_vectors('cv', 'searched', 'chunk_id', 'text')},
{_vectors('qv', asked, 'query_id', 'qtext')},
pairs AS (
  SELECT s.query_id, s.slot, s.k, i.chunk_id, round(array_inner_product(qv.e, cv.e), 6) AS score
  FROM slots s JOIN items i USING (slot) JOIN qv ON qv.id = s.query_id
  JOIN cv ON cv.id = i.chunk_id),
vhits AS (SELECT query_id, string_split(slot, '|')[1] AS route,
    row_number() OVER (PARTITION BY query_id, slot ORDER BY score DESC, chunk_id) AS rank,
    chunk_id, score, k FROM pairs),
rb AS (SELECT DISTINCT unnest(vendors) AS v, device_family, doc_id, chunk_index, chunk_id FROM chunks
  WHERE document_type = 'Runbook' AND chunk_index < 2),
rbr AS (SELECT *, row_number() OVER (PARTITION BY v, device_family ORDER BY doc_id, chunk_index)
    AS rank FROM rb),
pol AS (SELECT site_criticality_scope AS scope, chunk_kind, doc_id, chunk_index, chunk_id,
    {mentioned('text')} AS m FROM chunks
  WHERE document_type = 'Policy' AND chunk_kind IN ('rule', 'whole')),
combos AS (SELECT DISTINCT site_criticality, fl FROM {asked}),
polr AS (SELECT site_criticality, fl, chunk_id, len(list_intersect(m, fl)) AS n,
    row_number() OVER (PARTITION BY site_criticality, fl ORDER BY chunk_kind <> 'rule',
      len(list_intersect(m, fl)) DESC, doc_id, chunk_index) AS rank
  FROM combos JOIN pol ON scope = site_criticality WHERE len(list_intersect(m, fl)) > 0),
mat AS (SELECT v, arg_min(chunk_id, doc_id || lpad(chunk_index::VARCHAR, 9, '0')) AS chunk_id
  FROM (SELECT DISTINCT vendor_name AS v FROM {asked}) JOIN chunks
    ON document_type = 'Matrix' AND contains(text, v) GROUP BY 1),
hits AS (
  SELECT query_id, route, rank, chunk_id, score FROM vhits WHERE rank <= k
  UNION ALL SELECT query_id, 'runbook', rank, chunk_id, 1.0 FROM {asked}
    JOIN rbr ON v = vendor_name AND device_family = device_type
  UNION ALL SELECT query_id, 'policy', rank, chunk_id, n::DOUBLE FROM {asked} a
    JOIN polr ON polr.site_criticality = a.site_criticality AND polr.fl = a.fl WHERE rank <= 2
  UNION ALL SELECT query_id, 'matrix', 1, chunk_id, 1.0 FROM {asked} JOIN mat ON v = vendor_name)
"""


_HITS = f"{_CHUNKS}, {_UP}, {_routes('asked')}"


def _hits(spark, sf):
    corpus, rows = searchable(spark, sf), upcoming(spark, sf, history(spark, sf))
    return rows, corpus, retrieval.route_all(rows, corpus, written=True)


@query("retrieval_routes", f"WITH {_HITS} SELECT query_id, route, rank, chunk_id, score FROM hits")
def retrieval_routes(spark, sf):
    return _hits(spark, sf)[2].rows().withColumn("score", F.round("score", 6))


_GATE = """
ev AS (SELECT h.query_id, count(*) AS matched, count(DISTINCT c.doc_id) AS documents,
    avg(h.score) AS mean_score, string_agg(c.text, ' ' ORDER BY h.rank) AS texts
  FROM hits h JOIN chunks c USING (chunk_id) JOIN {asked} a ON a.query_id = h.query_id
  WHERE h.route = 'evidence' AND list_contains(c.vendors, a.vendor_name) GROUP BY 1),
gr AS (SELECT a.query_id, a.vendor_name, a.fl, matched, documents, mean_score,
    list_filter(a.fl, lambda f: list_contains({mentioned}, f)) AS grounded
  FROM {asked} a LEFT JOIN ev USING (query_id)),
rs AS (SELECT *, CASE WHEN matched IS NULL
    THEN 'no ' || coalesce(vendor_name, 'nan') || ' evidence in the corpus'
    ELSE concat_ws('; ',
      CASE WHEN matched < 3 THEN matched || ' vendor-matched chunks (need 3)' END,
      CASE WHEN documents < 2 THEN documents || ' distinct document(s) (need 2)' END,
      CASE WHEN len(fl) > 0 AND len(grounded) / len(fl)::DOUBLE < 1 / 3.0::DOUBLE
        THEN len(grounded) || '/' || len(fl) || ' active flags grounded in the evidence' END)
    END AS reasons FROM gr),
verdicts AS (SELECT query_id, CASE WHEN matched IS NULL THEN 'insufficient_evidence'
    WHEN reasons <> '' THEN 'low_confidence' WHEN len(fl) > 0 THEN 'concern_found'
    ELSE 'no_flag_evidence' END AS verdict, reasons, coalesce(matched, 0) AS matched,
    coalesce(documents, 0) AS documents, round(mean_score, 4) AS mean_score,
    CASE WHEN matched IS NULL THEN '' ELSE array_to_string(grounded, ',') END AS grounded FROM rs)
"""


def _gate_sql(asked: str) -> str:
    return _GATE.format(asked=asked, mentioned=mentioned("coalesce(texts, '')"))


_VERDICTS = f"{_HITS}, {_gate_sql('asked')}"


def _verdicts(spark, sf):
    corpus, rows = searchable(spark, sf), upcoming(spark, sf, history(spark, sf))
    hits = retrieval.retrieve(rows, corpus, routes=("evidence",), written=True)
    return rows, corpus, gate.assess(rows, hits, corpus)


@query("evidence_gate", f"""
WITH {_VERDICTS}
SELECT query_id, verdict, reasons, matched, documents, grounded, round(mean_score, 3) AS mean_score
FROM verdicts""")
def evidence_gate(spark, sf):
    return _verdicts(spark, sf)[2].withColumns({
        "reasons": F.array_join("reasons", "; "), "grounded": F.array_join("grounded", ","),
        "mean_score": F.round("mean_score", 3)})


@query("verdict_counts", f"""
WITH {_VERDICTS} SELECT verdict, count(*) AS rows FROM verdicts GROUP BY 1""")
def verdict_counts(spark, sf):
    return reteval.verdict_counts(_verdicts(spark, sf)[2])


@query("verdict_by_band", f"""
WITH {_VERDICTS},
sc AS (SELECT deployment_id AS query_id, CASE WHEN p >= 0.4::DOUBLE THEN 'HIGH'
    WHEN p >= 0.2::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS band
  FROM (SELECT deployment_id, o_orderkey, least((coalesce(past_failure_count, 0) * 9::DOUBLE
      + coalesce(max_cvss_score, 0) * 2::DOUBLE + CASE WHEN site_criticality = 'HIGH' THEN 11.0
      ELSE 0.0 END::DOUBLE + (o_orderkey % 83)::DOUBLE) / 180.0::DOUBLE, 1.0::DOUBLE) AS p FROM dep)
  WHERE o_orderkey % 7 <> 0)
SELECT coalesce(band, 'unscored') AS band, {', '.join(
    f"count(*) FILTER (WHERE verdict = '{v}') AS {v}" for v in gate.VERDICTS)}
FROM verdicts LEFT JOIN sc USING (query_id) GROUP BY 1""")
def verdict_by_band(spark, sf):
    rows, _, verdicts = _verdicts(spark, sf)
    key = F.substring("deployment_id", 5, 20).cast("bigint")
    scores = rows.where(key % 7 != 0).select(
        "deployment_id", scoring.band(risk_score_expression(), F.lit(0.4)).alias("risk_band"))
    return reteval.verdicts_by_band(verdicts, scores)


@query("route_coverage", f"""
WITH {_HITS}
SELECT r AS route, round((SELECT count(DISTINCT query_id) FROM hits WHERE route = r)
  / (SELECT count(*) FROM asked)::DOUBLE, 4) AS coverage
FROM (SELECT unnest({list(retrieval.ROUTE_LIMITS)}) AS r)""")
def route_coverage(spark, sf):
    rows, _, hits = _hits(spark, sf)
    return reteval.route_coverage(rows, hits)


_ROUTE_OF = """CASE WHEN document_type IN ('Postmortem', 'Advisory', 'RiskNote') THEN 'evidence'
WHEN document_type = 'Transition' THEN 'transition' WHEN document_type = 'CrossVendor'
THEN 'cross_vendor' WHEN document_type = 'Runbook' THEN 'runbook' END"""
_GOLD = f"""
{_CHUNKS}, {_CORPUS_FLAG_SQL},
cites AS (SELECT doc_id, document_type, vendors, device_family, {_ROUTE_OF} AS route,
    unnest(source_deployment_ids) AS deployment_id FROM man),
gold AS (SELECT doc_id, document_type, route, vendor_name AS vendor, deployment_id
  FROM cites JOIN flagged USING (deployment_id)
  WHERE route IS NOT NULL AND list_contains(vendors, vendor_name)
    AND (device_family IS NULL OR device_type = device_family))
"""
_GRADED = f"""
{_GOLD},
asked AS (SELECT deployment_id AS query_id, {QUERY_TEXT_SQL} AS qtext, vendor_name, device_type,
    site_criticality, transition_class, cross_vendor_dependency_count,
    CASE WHEN flags = '' THEN []::VARCHAR[] ELSE string_split(flags, ',') END AS fl
  FROM flagged WHERE deployment_id IN (SELECT deployment_id FROM gold)),
{_routes('asked')},
graded AS (SELECT g.doc_id, g.document_type, g.route, g.vendor, g.deployment_id,
    bool_or(h.query_id IS NOT NULL) AS applied,
    min(CASE WHEN c.doc_id = g.doc_id THEN h.rank END) AS rank
  FROM gold g LEFT JOIN hits h ON h.query_id = g.deployment_id AND h.route = g.route
  LEFT JOIN chunks c ON c.chunk_id = h.chunk_id GROUP BY ALL)
"""


def _cited(known, rows):
    """(gold queries, the deployments they cite)."""
    gold = materialise(reteval.gold_queries(known, rows))
    return gold, rows.join(gold.select("deployment_id").distinct(), "deployment_id", "left_semi")


def _graded(corpus, known, rows, routes=tuple(retrieval.ROUTE_LIMITS)):
    gold, cited = _cited(known, rows)
    return reteval.outcomes(gold, retrieval.route_all(cited, corpus, routes=routes), corpus)


@query("gold_queries", f"WITH {_GOLD} SELECT * FROM gold")
def gold_queries(spark, sf):
    return reteval.gold_queries(ct.manifest(spark, sf), ct.flagged(spark, sf))


@query("recall_mrr", f"""
WITH {_GRADED}, e AS (SELECT * FROM graded WHERE route = 'evidence'),
sl AS (SELECT 'all' AS slice, 'all' AS value, rank FROM e
  UNION ALL SELECT 'document_type', document_type, rank FROM e
  UNION ALL SELECT 'vendor', vendor, rank FROM e)
SELECT slice, value, count(*) AS queries, round(avg((rank IS NOT NULL)::INT), 4) AS recall_at_5,
  round(avg(coalesce(1.0::DOUBLE / rank, 0)), 4) AS mrr FROM sl GROUP BY ALL""")
def recall_mrr(spark, sf):
    known = records(spark, sf)
    return reteval.evidence_quality(_graded(
        searchable(spark, sf), known, cited_history(spark, sf, known), ("evidence",)))


@query("route_quality", f"""
WITH {_GRADED}
SELECT route, count(*) AS queries, round(avg(applied::INT), 4) AS applied,
  round(avg(CASE WHEN applied THEN (rank IS NOT NULL)::INT END), 4) AS returned_cited_doc_when_applied
FROM graded WHERE route <> 'evidence' GROUP BY 1""")
def route_quality(spark, sf):
    known = records(spark, sf)
    return reteval.route_quality(_graded(searchable(spark, sf), known, cited_history(spark, sf, known)))


_FIRST = "(SELECT min(deployment_id) FROM up WHERE vendor_name <> 'Moxa')"
_PROBED = f"""
{_CHUNKS}, {_UP},
asked2 AS (
  SELECT 'out of corpus ' || vendor_name || ' ' || query_id AS query_id, qtext, vendor_name,
    device_type, site_criticality, transition_class, cross_vendor_dependency_count, fl,
    'insufficient_evidence' AS expected FROM asked WHERE vendor_name = 'Moxa'
  UNION ALL SELECT 'synthetic out of corpus', qtext, 'OutOfCorpusVendor', device_type,
    site_criticality, transition_class, cross_vendor_dependency_count, fl, 'insufficient_evidence'
    FROM asked WHERE query_id = {_FIRST}
  UNION ALL SELECT 'flag never discussed', q.q, vendor_name, device_type, site_criticality,
    transition_class, cross_vendor_dependency_count, ['high_network_stress'], 'low_confidence'
    FROM asked, (SELECT {QUERY_TEXT_SQL} AS q FROM (SELECT * REPLACE ('high_network_stress' AS flags)
      FROM up WHERE deployment_id = {_FIRST})) q WHERE query_id = {_FIRST}),
{_routes('asked2')}, {_gate_sql('asked2')},
controls AS (SELECT v.query_id AS probe, expected, verdict, reasons, verdict = expected AND
    CASE expected WHEN 'low_confidence' THEN contains(reasons, 'active flags grounded')
      ELSE contains(reasons, 'evidence in the corpus') END AS passed
  FROM verdicts v JOIN asked2 USING (query_id))
"""


@query("negative_controls", f"""WITH {_PROBED}
SELECT probe, expected, verdict, reasons, 0 AS generator_calls, passed FROM controls""")
def negative_controls(spark, sf):
    """The probes sent all the way, beside a writer whose calls are counted."""
    return evidence.controls(
        records(spark, sf), searchable(spark, sf), upcoming(spark, sf, history(spark, sf)),
        lambda messages: ["said"] * len(messages),
    ).withColumns({"reasons": F.array_join("reasons", "; "), "generator_calls": F.col("generator_calls").cast("int")})


@query("quality_gates", f"""
SELECT gate, observed, required, observed >= required AS passed FROM (
  SELECT CASE slice WHEN 'all' THEN 'evidence_recall_at_5' ELSE 'evidence_recall_at_5[' || value || ']' END AS gate,
    coalesce(recall_at_5, 0)::DOUBLE AS observed,
    CASE slice WHEN 'all' THEN {reteval.MIN_RECALL} ELSE {reteval.MIN_TYPE_RECALL} END::DOUBLE AS required
  FROM ({ORACLES["recall_mrr"]}) WHERE slice IN ('all', 'document_type')
  UNION ALL SELECT 'negative_controls', coalesce(avg(passed::INT), 1)::DOUBLE, 1.0::DOUBLE
  FROM ({ORACLES["negative_controls"]}) AS controls)""")
def quality_gates(spark, sf):
    corpus, known, rows = searchable(spark, sf), records(spark, sf), history(spark, sf)
    graded = _graded(corpus, known, rows, ("evidence",))
    controls = reteval.negative_controls(reteval.control_probes(known, upcoming(spark, sf, rows)), corpus)
    return reteval.quality_gates(reteval.evidence_quality(graded), controls)


@query("probe_set", f"""
WITH {_UP.strip()},
sc AS (SELECT deployment_id, vendor_name, CASE WHEN o_orderkey % 13 <> 0 THEN least((
    coalesce(past_failure_count, 0) * 9::DOUBLE + coalesce(max_cvss_score, 0) * 2::DOUBLE
    + CASE WHEN site_criticality = 'HIGH' THEN 11.0 ELSE 0.0 END::DOUBLE
    + (o_orderkey % 83)::DOUBLE) / 180.0::DOUBLE, 1.0::DOUBLE) END AS p FROM up),
r AS (SELECT *, row_number() OVER (PARTITION BY vendor_name ORDER BY p DESC NULLS LAST, deployment_id)
    AS top, row_number() OVER (PARTITION BY vendor_name ORDER BY p NULLS FIRST, deployment_id DESC)
    AS bottom FROM sc WHERE vendor_name <> 'Moxa')
SELECT vendor_name, deployment_id, 'ranked' AS kind FROM r WHERE top <= 3 OR bottom = 1
UNION ALL SELECT vendor_name, deployment_id, 'out_of_corpus' FROM sc WHERE vendor_name = 'Moxa'
UNION ALL SELECT 'OutOfCorpusVendor', min(deployment_id), 'synthetic' FROM sc
  WHERE vendor_name <> 'Moxa'""")
def probe_set(spark, sf):
    key = F.substring("deployment_id", 5, 20).cast("bigint")
    rows = upcoming(spark, sf).withColumn(
        "risk_probability", F.when(key % 13 != 0, risk_score_expression()))
    return reteval.probe_set(ct.manifest(spark, sf), rows)


@query("evidence_blocks", f"""
WITH {_GRADED},
f AS (SELECT query_id, chunk_id, route, rank, list_position({list(retrieval.ROUTE_LIMITS)}, route) AS rn,
    row_number() OVER (PARTITION BY query_id, chunk_id
      ORDER BY list_position({list(retrieval.ROUTE_LIMITS)}, route), rank) AS first FROM hits),
n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rn, rank, chunk_id) AS no
  FROM f WHERE first = 1)
SELECT query_id, string_agg(chunk_id, ',' ORDER BY no) AS evidence_ids,
  md5(string_agg('[Evidence ' || no || '] ' || doc_id || ' (' || document_type || ', ' || route || ')'
    || chr(10) || text, chr(10) || chr(10) ORDER BY no)) AS block
FROM n JOIN chunks USING (chunk_id) GROUP BY 1""")
def evidence_blocks(spark, sf):
    corpus, known = searchable(spark, sf), records(spark, sf)
    _, cited = _cited(known, cited_history(spark, sf, known))
    blocks = retrieval.evidence_blocks(retrieval.route_all(cited, corpus).written(), corpus)
    return blocks.select("query_id", F.array_join("evidence_ids", ",").alias("evidence_ids"),
                         F.md5("block").alias("block"))


@query("evidence_index", f"""
WITH {_CHUNKS}
SELECT 'corpus-20260103' AS index_version, document_type, count(*) AS chunks FROM chunks GROUP BY 2""")
def evidence_index(spark, sf):
    """Three builds, two promotions, one prune; the served version is read back."""
    index = EvidenceIndex(spark, new_path(spark, "index"))
    corpus = searchable(spark, sf)
    index.promote(index.build(corpus, "20260101"))
    index.build(corpus, "20260102")
    index.promote(index.build(corpus, "20260103"))
    index.prune(keep=2)
    return index.read().groupBy("document_type").agg(F.count("*").alias("chunks")).withColumn(
        "index_version", F.lit(index.current()))


@query("explain_deployments", f"""
WITH {_VERDICTS}
SELECT query_id, verdict, CASE verdict WHEN 'insufficient_evidence' THEN 'No ' || vendor_name
    || ' evidence exists in the corpus. Documents about other vendors do not apply, and similarity '
    || 'is not relevance. Refer this deployment to an engineer familiar with the vendor.'
  WHEN 'low_confidence' THEN 'Low confidence, not explained: ' || reasons END AS text,
  (SELECT count(DISTINCT chunk_id) FROM hits h WHERE h.query_id = v.query_id) AS evidence
FROM verdicts v JOIN asked USING (query_id)""")
def explain_deployments(spark, sf):
    """Retrieve, gate, assemble; no generator, so only refusals and doubts carry a text."""
    rows = evidence.explain(upcoming(spark, sf), searchable(spark, sf))
    return rows.select("query_id", "verdict", "text",
                       F.coalesce(F.size("evidence_ids"), F.lit(0)).alias("evidence"))
