"""Deployments to gated, checked explanations, and the graded retrieval report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.functions.embedding import Embedder, hashed_words
from shiplens.functions.narrative import context_block
from shiplens.operators import corpus as corpus_ops
from shiplens.operators import gate, grounding, reteval, retrieval
from shiplens.operators.chunking import chunk, page_footer
from shiplens.sources.ledger import CallLedger, Generator, call_of
from shiplens.sources.scratch import materialise, new_path

# What the generator is told when no flag is raised, and what a row reads whose vendor
# the corpus does not cover, around the vendor's name.
NO_FLAG_NOTE = (
    "\n\nNOTE: This deployment raises none of the risk flags the evidence discusses. "
    "The evidence therefore does not explain the model score. Say so plainly, and do not "
    "attribute the score to the evidence."
)
REFUSAL = (
    "No ", " evidence exists in the corpus. Documents about other vendors do not apply, and similarity "
    "is not relevance. Refer this deployment to an engineer familiar with the vendor.",
)
# What a judge is asked, before the context, the evidence and the explanation; it may be any text that
# asks for this reply.
JUDGE_PROMPT = (
    "Check an explanation of a deployment's risk against the context and the evidence its writer had. "
    "List each of its claims with a verdict: supported, if the context or a cited document says so; "
    "unsupported, if neither does; not_a_claim, for a recommendation or a remark that evidence is missing. "
    'Answer with JSON alone: {"claims": [{"claim": "...", "verdict": "..."}]}'
)


def build_corpus(
    documents: DataFrame, contract: corpus_ops.CorpusContract = corpus_ops.CORPUS,
    embed: Embedder = hashed_words,
) -> tuple[DataFrame, DataFrame]:
    """(manifest without texts, searchable chunks) of a (filename, text) table."""
    read = documents.where(F.col("text").isNotNull()).repartition("filename")
    manifest = materialise(corpus_ops.manifest(read, contract), "manifest")
    return manifest.drop("text"), retrieval.prepare_chunks(
        chunk(manifest, footer=page_footer(contract.product)), embed)


def explain(
    deployments: DataFrame, corpus: DataFrame, generate: Generator | None = None,
    config: gate.GateConfig = gate.GateConfig(), *, embed: Embedder = hashed_words,
    scored: bool = False, citation: str = grounding.CITATION, note: str = NO_FLAG_NOTE,
    refusal_text: tuple[str, str] = REFUSAL, ledger: CallLedger | None = None,
) -> DataFrame:
    """One row per deployment: verdict, context, evidence, text and checks.

    Refused and doubtful rows get their reason as text and never reach the generator, which
    `generator_calls` shows: the calls that the ledger holds for a row's message. With a ledger of an
    earlier run, what was answered then isn't asked again.
    """
    deployments = materialise(deployments, "deployments")  # read by each step
    hits = retrieval.route_all(deployments, corpus, embed, written=True).written()
    verdicts = gate.assess(deployments, hits.direct, corpus, config)
    parts, pieces = retrieval.block_parts(hits, corpus)
    facts = deployments.select(
        F.col("deployment_id").alias("query_id"), "vendor_name", "active_flags",
        context_block(F.col("active_flags"), scored=scored).alias("context"))
    rows = retrieval.with_blocks(facts.join(verdicts.hint("merge"), "query_id").join(
        parts.hint("merge"), "query_id", "left"), pieces)
    refusal = F.concat(
        F.lit(refusal_text[0]), F.coalesce("vendor_name", F.lit("nan")), F.lit(refusal_text[1]))
    doubt = F.concat(F.lit("Low confidence, not explained: "), F.array_join("reasons", "; "))
    rows = rows.withColumn(
        "text", F.when(F.col("verdict") == "insufficient_evidence", refusal)
        .when(F.col("verdict") == "low_confidence", doubt))
    if generate is None:
        return rows
    spark = deployments.sparkSession
    ledger = ledger or CallLedger(new_path(spark, "calls"), "writer")
    message = F.concat(
        F.lit("UPCOMING DEPLOYMENT\n"), "context", F.lit("\n\nHISTORICAL EVIDENCE\n"), F.coalesce("block", F.lit("")),
        F.when(F.col("verdict") == "no_flag_evidence", F.lit(note)).otherwise(""))
    # written first: the messages are read again by each wave of calls
    rows = materialise(rows.withColumn("message", message), "explanations")
    asked = rows.where(F.col("text").isNull()).select("query_id", "message", F.lit(0).alias("attempt"))
    answers = ledger.answers(asked, generate).select("query_id", F.col("text").alias("answer"), F.lit(True).alias("called"))
    made = ledger.calls(spark).groupBy("call").agg(F.count("*").alias("made"))
    done = rows.withColumn("call", call_of(F.col("message"))).join(made, "call", "left").join(
        answers, "query_id", "left").withColumns({
            "generator_calls": F.coalesce("made", F.lit(0)),
            "generated": F.col("answer").isNotNull(),
            "error": F.when(F.col("called") & F.col("answer").isNull(), "no text"),
            "text": F.coalesce("text", "answer"),
            "evidence": F.coalesce("block", F.lit("")),
            "retrieved": F.coalesce("document_ids", F.array().cast("array<string>")),
            "require_citation": F.col("verdict") != "no_flag_evidence",
        }).drop("answer", "called", "made", "call", "message")
    return grounding.grounding_checks(done, citation)


def evaluate(
    manifest: DataFrame, corpus: DataFrame, history: DataFrame, upcoming: DataFrame,
    config: gate.GateConfig = gate.GateConfig(), *, embed: Embedder = hashed_words,
) -> dict[str, DataFrame]:
    """The retrieval report as tables: quality, routes, coverage, verdicts, controls, gates."""
    gold = materialise(reteval.gold_queries(manifest, history), "gold")
    cited = history.join(gold.select("deployment_id").distinct(), "deployment_id", "left_semi")
    graded = materialise(reteval.outcomes(
        gold, retrieval.route_all(cited, corpus, embed), corpus), "graded")
    hits = retrieval.route_all(upcoming, corpus, embed).written()
    controls = materialise(reteval.negative_controls(
        reteval.control_probes(manifest, upcoming), corpus, config, embed=embed), "controls")
    quality = reteval.evidence_quality(graded)
    return {
        "quality": quality, "routes": reteval.route_quality(graded),
        "coverage": reteval.route_coverage(upcoming, hits),
        "verdicts": gate.assess(upcoming, hits.direct, corpus, config), "controls": controls,
        "gates": reteval.quality_gates(quality, controls),
    }


def controls(
    manifest: DataFrame, corpus: DataFrame, upcoming: DataFrame, generate: Generator,
    config: gate.GateConfig = gate.GateConfig(), **options,
) -> DataFrame:
    """(probe, expected, verdict, reasons, generator_calls, passed): control probes sent through the whole
    way to an explanation. One passes with the right verdict, for the right reason, and no call."""
    probes = materialise(reteval.control_probes(manifest, upcoming), "probes")
    rows = explain(probes.withColumn("deployment_id", F.col("probe")), corpus, generate, config, **options)
    right = F.exists("reasons", lambda r: F.contains(r, F.col("reason")))
    return probes.select("probe", "expected", "reason").join(
        rows, probes["probe"] == rows["query_id"]
    ).select("probe", "expected", "verdict", "reasons", "generator_calls", (
        (F.col("verdict") == F.col("expected")) & right & (F.col("generator_calls") == 0)).alias("passed"))


def judged(explained: DataFrame, judge: Generator, ledger: CallLedger, passes: int = 1) -> DataFrame:
    """(query_id, pass, labelled, supported, unsupported, precision, faithful) of texts that were
    generated, each judged `passes` times."""
    message = F.concat(
        F.lit(f"{JUDGE_PROMPT}\n\nDEPLOYMENT CONTEXT\n"), "context", F.lit("\n\nEVIDENCE\n"), "evidence",
        F.lit("\n\nEXPLANATION\n"), "text")
    asked = explained.where("generated").select(
        "query_id", message.alias("message"), F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("attempt"))
    replies = ledger.answers(asked, judge).select("query_id", F.col("attempt").alias("pass"), F.col("text").alias("reply"))
    return grounding.faithfulness(grounding.claims(replies, ["query_id", "pass"]), ["query_id", "pass"])


def generation_report(
    manifest: DataFrame, corpus: DataFrame, upcoming: DataFrame, writer: Generator, folder: str,
    judge: Generator | None = None, config: gate.GateConfig = gate.GateConfig(), **options,
) -> dict[str, DataFrame]:
    """A fixed set of probes explained, checked, judged and rated: tables `results`, `judged`, `gates`.

    All calls go to ledgers under `folder`: a report that was broken off goes on where it stopped.
    """
    probes = materialise(reteval.probe_set(manifest, upcoming), "probes")
    rows = probes.withColumnRenamed("vendor_name", "probed").join(upcoming, "deployment_id").withColumns({
        "vendor_name": F.col("probed"),
        "probe": F.concat_ws(" ", "kind", "probed", "deployment_id"),
    })
    asked = materialise(rows.withColumn("deployment_id", F.col("probe")), "asked")
    explained = explain(asked, corpus, writer, config, ledger=CallLedger(folder, "writer"), **options)
    kinds = asked.select(F.col("probe").alias("query_id"), (F.col("kind") != "ranked").alias("out_of_corpus"))
    results = materialise(grounding.refusals(explained.join(kinds, "query_id")), "results")
    out = {"results": results}
    rates = None
    if judge is not None:
        out["judged"] = materialise(judged(results, judge, CallLedger(folder, "judge")), "judged")
        rates = grounding.judge_rates(out["judged"])
    return out | {"gates": grounding.generation_rates(results, rates)}


def rejudged_report(results: DataFrame, judge: Generator, folder: str, passes: int = 3) -> dict[str, DataFrame]:
    """The texts of a report judged again, several times and without a writer: tables `passes` with each
    pass's rates, and `spread`, how far the judge moves on the same texts."""
    found = materialise(judged(results, judge, CallLedger(folder, "rejudge"), passes), "rejudged")
    rates = materialise(grounding.judge_rates(found, ["pass"]), "passes")
    return {"judged": found, "passes": rates, "spread": grounding.judge_spread(rates)}
