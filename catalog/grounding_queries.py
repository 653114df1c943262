"""Grounding checks, citation marking, claim scoring and generation rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import corpus_sql as Q
from catalog import corpus_tables as ct
from catalog.contract_queries import _CORPUS_FLAG_SQL
from catalog.contract_queries import context_blocks as _contexts
from catalog.registry import ORACLES, query
from catalog.tables import table
from shiplens.operators import grounding

CITATION = r"KB-\d{3,}"
CLAIMS = (
    "This device has kernel_touched raised.", "This update shows no tier_1_device.",
    "The planned rollout carries high_cvss.", "Past records mention bootloader_touched.",
)


def _explanations(spark, sf):
    """One explanation per document about the deployment of the same number."""
    d = F.col("d")
    number = F.format_string("KB-%03d", d + 1)
    said = F.get(F.array(*[F.lit(c) for c in CLAIMS]), (d % 4).cast("int"))
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("d"), F.col("text").alias("body"), "n_chars")
    corpus = ct.documents(spark, sf).select(
        (F.regexp_extract("filename", r"(\d+)\.md$", 1).cast("bigint") - 1).alias("d"),
        F.col("text").alias("evidence"))
    made = docs.select(
        "d", F.format_string("DEP_%06d", d).alias("deployment_id"),
        F.concat(
            F.lit("This deployment resembles "), number,
            F.when(d % 3 == 0, F.concat(F.lit(" and "), F.format_string("KB-%03d", d + 2)))
            .otherwise(""), F.lit(" [Evidence 4]. It met "), (d * 7 % 100).cast("string"),
            F.lit(" failures over "), F.format_number("n_chars", 0), F.lit(" steps. "), said,
            F.lit(" "), F.col("body")).alias("text"),
        F.array(number).alias("retrieved"))
    facts = ct.flagged(spark, sf).select("deployment_id", "active_flags").join(
        _contexts(spark, sf), "deployment_id")
    return made.join(corpus, "d").join(facts, "deployment_id").withColumn(
        "require_citation", F.size("active_flags") > 0)


_NUMBERS = """list_distinct(regexp_extract_all(replace(regexp_replace(regexp_replace({0},
  'KB-\\d{{3,}}', '', 'g'), '(?i)\\bEvidence\\s+\\d+\\b', '', 'g'), ',', ''), '\\d+(?:\\.\\d+)?'))"""
_CONTEXT_CTE = ORACLES["context_block"].split("SELECT deployment_id, 'Vendor: '")[1]
_EXPLAINED = f"""
{Q.DOCUMENTS}, {_CORPUS_FLAG_SQL},
ctx AS (SELECT deployment_id, 'Vendor: ' {_CONTEXT_CTE}),
ex AS (
  SELECT b.d, f.deployment_id, [format('KB-{{:03d}}', b.d + 1)] AS retrieved, docs.text AS evidence, ctx.context,
    CASE WHEN flags = '' THEN []::VARCHAR[] ELSE string_split(flags, ',') END AS fl,
    'This deployment resembles ' || format('KB-{{:03d}}', b.d + 1)
    || CASE WHEN b.d % 3 = 0 THEN ' and ' || format('KB-{{:03d}}', b.d + 2) ELSE '' END
    || ' [Evidence 4]. It met ' || (b.d * 7 % 100) || ' failures over '
    || format('{{:,}}', doc0.n_chars) || ' steps. ' || {Q._list(CLAIMS)}[b.d % 4 + 1] || ' ' || b.text AS text
  FROM b0 b JOIN documents doc0 ON doc0.doc_id = b.d JOIN docs ON docs.d = b.d
  JOIN flagged f ON f.deployment_id = format('DEP_{{:06d}}', b.d)
  JOIN ctx ON ctx.deployment_id = f.deployment_id),
ck AS (
  SELECT *, list_sort(list_filter(list_distinct(regexp_extract_all(text, 'KB-\\d{{3,}}')),
      lambda c: NOT list_contains(retrieved, c))) AS unretrieved,
    list_sort(list_filter({_NUMBERS.format('text')}, lambda n: NOT list_contains(
      {_NUMBERS.format("(context || ' ' || evidence)")}, n))) AS stray,
    list_filter(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s:
      regexp_matches(s, '(?i)\\b(this|the upcoming|the planned|the proposed|the current) (deployment|update|upgrade|device|rollout|transition)\\b|\\bthe one planned\\b|\\bthis one\\b')
      AND NOT regexp_matches(s, '(?i)\\b(not|no|none|absent|without|isn''t|aren''t)\\b')) AS sentences
  FROM ex),
checked AS (SELECT *, list_sort(list_filter({list(grounding.CORPUS_FLAGS)}, lambda f:
    NOT list_contains(fl, f) AND len(list_filter(sentences, lambda s: contains(s, f))) > 0)) AS borrowed
  FROM ck)
"""


def _checked(spark, sf):
    return grounding.grounding_checks(_explanations(spark, sf), CITATION)


@query("grounding_checks", f"""
WITH {_EXPLAINED}
SELECT deployment_id, array_to_string(unretrieved, ',') AS unretrieved_citations,
  array_to_string(stray, ',') AS stray_numbers, array_to_string(borrowed, ',') AS borrowed_flags,
  len(unretrieved) = 0 AS citations_ok, len(stray) = 0 AS numbers_ok, len(borrowed) = 0 AS flags_ok
FROM checked""")
def grounding_checks(spark, sf):
    lists = ("unretrieved_citations", "stray_numbers", "borrowed_flags")
    return _checked(spark, sf).select(
        "deployment_id", *[F.array_join(c, ",").alias(c) for c in lists],
        "citations_ok", "numbers_ok", "flags_ok")


@query("strike_citations", f"""
WITH {_EXPLAINED}
SELECT deployment_id, md5(CASE WHEN len(unretrieved) = 0 THEN text ELSE
  regexp_replace(text, '(' || array_to_string(unretrieved, '|') || ')\\b', '~~\\1~~ *(not retrieved)*', 'g')
  END) AS marked FROM checked""")
def strike_citations(spark, sf):
    return _checked(spark, sf).select("deployment_id", F.md5(grounding.mark_unretrieved(
        F.col("text"), F.col("unretrieved_citations"), CITATION)).alias("marked"))


VERDICTS = ("supported", "unsupported", "maybe", "not_a_claim")


def _replies(spark, sf):
    """Every assistant turn as a judge's reply, judged in three passes."""
    turns = table(spark, sf, "conversations").where(F.col("role") == "assistant").withColumn(
        "pass", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    verdicts = F.array(*[F.lit(v) for v in VERDICTS])
    found = F.transform(F.split("text", "\n"), lambda line, i: F.struct(
        F.when(i % 5 == 4, F.concat(F.lit("There is no evidence: "), line)).otherwise(line)
        .alias("claim"),
        F.get(verdicts, ((i + F.col("turn") + F.col("pass")) % 4).cast("int")).alias("verdict")))
    reply = F.concat(F.lit("Here it is: "), F.to_json(F.struct(found.alias("claims"))))
    return turns.select("conv_id", "turn", "pass", F.when(
        F.col("conv_id") % 17 == 0, "I cannot judge this.").otherwise(reply).alias("reply"))


_KEYS = ["conv_id", "turn", "pass"]
_CLAIMED = """
t AS (SELECT conv_id, turn, p AS pass, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM conversations, range(0, 3) x(p) WHERE role = 'assistant'),
c AS (SELECT conv_id, turn, pass, i, CASE (i + turn + pass) % 4 WHEN 0 THEN 'supported'
    WHEN 3 THEN 'not_a_claim' ELSE CASE WHEN i % 5 = 4 OR regexp_matches(line,
      '(?i)\\b(does not|doesn''t|cannot|can''t|do not|don''t) (apply|explain|account for)')
    THEN 'not_a_claim' ELSE 'unsupported' END END AS verdict FROM t WHERE conv_id % 17 <> 0),
f AS (SELECT conv_id, turn, pass, count(verdict) AS labelled,
    count(*) FILTER (WHERE verdict = 'supported') AS supported,
    count(*) FILTER (WHERE verdict = 'unsupported') AS unsupported
  FROM (SELECT * FROM c UNION ALL SELECT DISTINCT conv_id, turn, pass, 0, NULL FROM t
    WHERE conv_id % 17 = 0) GROUP BY ALL),
g AS (SELECT *, round(CASE WHEN supported + unsupported > 0
    THEN supported / (supported + unsupported)::DOUBLE END, 4) AS precision,
    CASE WHEN labelled > 0 THEN unsupported = 0 END AS faithful FROM f),
j AS (SELECT pass, round(sum(supported) FILTER (WHERE precision IS NOT NULL)
    / (sum(supported + unsupported) FILTER (WHERE precision IS NOT NULL))::DOUBLE, 4)
    AS judge_claim_precision,
  round(avg(faithful::INT) FILTER (WHERE precision IS NOT NULL), 4) AS judge_all_supported,
  count(*) FILTER (WHERE precision IS NULL) AS judge_unparseable FROM g GROUP BY 1)
"""


def _graded(spark, sf):
    return grounding.faithfulness(grounding.claims(_replies(spark, sf), _KEYS), _KEYS)


@query("claim_verdicts", f"""
WITH {_CLAIMED}
SELECT pass, verdict, count(*) AS rows FROM c GROUP BY ALL
UNION ALL SELECT pass, NULL, count(*) FROM f WHERE labelled = 0 GROUP BY 1""")
def claim_verdicts(spark, sf):
    return grounding.claims(_replies(spark, sf), _KEYS).groupBy("pass", "verdict").agg(
        F.count("*").alias("rows"))


@query("claim_precision", f"WITH {_CLAIMED} SELECT * FROM g")
def claim_precision(spark, sf):
    return _graded(spark, sf)


@query("judge_rates", f"WITH {_CLAIMED} SELECT * FROM j")
def judge_rates(spark, sf):
    return grounding.judge_rates(_graded(spark, sf), ["pass"])


@query("judge_spread", f"""
WITH {_CLAIMED}
SELECT count(*) AS passes, round(avg(judge_claim_precision), 4) AS precision_mean,
  round(max(judge_claim_precision) - min(judge_claim_precision), 4) AS precision_spread FROM j""")
def judge_spread(spark, sf):
    return grounding.judge_spread(grounding.judge_rates(_graded(spark, sf), ["pass"]))


_RESULTS = f"""
{_EXPLAINED},
res AS (SELECT *, d % 10 <> 0 AS generated, (d % 10 = 0) = (d % 20 = 0) AND
    (d % 20 <> 0 OR d % 10 = 0) AS refusal_correct, d % 50 = 1 AS failed FROM checked)
"""


def _results(spark, sf):
    d = F.col("d")
    return grounding.refusals(_checked(spark, sf).withColumns({
        "verdict": F.when(d % 10 == 0, "insufficient_evidence").otherwise("concern_found"),
        "out_of_corpus": d % 20 == 0, "generated": d % 10 != 0,
        "error": F.when(d % 50 == 1, "stopped"),
    }))


@query("refusals", f"WITH {_RESULTS} SELECT deployment_id, refusal_correct FROM res")
def refusals(spark, sf):
    return _results(spark, sf).select("deployment_id", "refusal_correct")


@query("generation_rates", f"""
WITH {_RESULTS}, w AS (SELECT
    round(avg((len(unretrieved) = 0)::INT) FILTER (WHERE generated), 4) AS citations_ok,
    round(avg((len(stray) = 0)::INT) FILTER (WHERE generated), 4) AS numbers_ok,
    round(avg((len(borrowed) = 0)::INT) FILTER (WHERE generated), 4) AS flags_ok,
    round(avg(refusal_correct::INT), 4) AS refusal_correct,
    avg((NOT failed)::INT) AS no_generation_errors FROM res)
SELECT gate, observed, 1.0 AS required, observed >= 1.0 AS passed
FROM (UNPIVOT w ON citations_ok, numbers_ok, flags_ok, refusal_correct, no_generation_errors
  INTO NAME gate VALUE observed)""")
def generation_rates(spark, sf):
    return grounding.generation_rates(_results(spark, sf))
