"""Corpus lint, chunking, top-k, routes, gate, evaluation, grounding."""

from __future__ import annotations

import random
import re
import threading
import time
import tracemalloc
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog import evidence_queries
from shiplens.functions import flags as fl
from shiplens.functions.embedding import hashed_words
from shiplens.operators import chunking, corpus, gate, grounding, reteval, retrieval, topk
from shiplens.operators.topk import best_of, filtered_topk
from shiplens.plans import evidence
from shiplens.sources.evidence_index import EvidenceIndex, PromotedMeanwhile
from shiplens.sources.ledger import CallLedger
from shiplens.sources.scratch import materialise

OUTAGE = """# Gateway outage at the water plant

Document ID: FG-DOC-052
Vendor: Schneider
Device Family: Gateway
Evidence Strength: LOW

Six gateways lost their routes: DEP_004101, DEP_004100, DEP_004101 again, and DEP_77.
"""
DRIFT = """# Clock drift
| Field | Value |
|---|---|
| Document ID | FG-DOC-058 |
| Vendor | Honeywell |
| Device Family | RTU |
| Evidence Strength | MEDIUM |

One unit only, DEP_009000.
"""
PAIR = """# Pump controllers behind a switch
**Document ID:** FG-DOC-130
**Primary Vendor:** Honeywell
**Dependent Vendor:** Schneider
**Evidence Strength:** HIGH

Seen at three sites.
"""
NIGHT = """# Work at night
Document ID FG-DOC-410
Site Criticality Scope LOW
Evidence Strength HIGH

## Mandatory Rules
1. Two people on the call.

## Exception Process
The shift lead decides.
"""
ABOUT = "# Reading order\n| HIGH | 90+ | 2 |\n| MEDIUM | 30+ | 1 |\n| LOW | 3+ | 1 |\nNothing upcoming is cited."
OUTAGE_FILE = "Postmortem_Schneider_Gateway_FAILED_FG-DOC-052.md"
DRIFT_FILE = "Postmortem_Honeywell_RTU_DEGRADED_FG-DOC-058.md"
PAIR_FILE = "CrossVendor_Honeywell_to_Schneider_FG-DOC-130.md"
NIGHT_FILE = "Policy_Night_FG-DOC-410.md"
FILES = {
    OUTAGE_FILE: OUTAGE, DRIFT_FILE: DRIFT, PAIR_FILE: PAIR, NIGHT_FILE: NIGHT, "META_Order.md": ABOUT,
}


def documents(spark, **changes):
    files = {**FILES, **changes}
    return spark.createDataFrame(list(files.items()), "filename string, text string")


def test_manifest_reads_every_layout(spark):
    got = {r["filename"]: r for r in corpus.manifest(documents(spark)).collect()}
    assert got[OUTAGE_FILE]["source_deployment_ids"] == ["DEP_004100", "DEP_004101"]
    assert got[OUTAGE_FILE]["malformed_refs"] == ["DEP_77"]
    assert got[DRIFT_FILE]["source_deployment_ids"] == ["DEP_009000"]
    assert (got[PAIR_FILE]["vendor"], got[PAIR_FILE]["vendors"]) == ("cross-vendor", ["Honeywell", "Schneider"])
    assert got[NIGHT_FILE]["site_criticality_scope"] == "LOW"
    assert [got[f]["evidence_strength"] for f in FILES] == ["LOW", "MEDIUM", "HIGH", "HIGH", None]
    assert got["META_Order.md"]["doc_id"] == "FG-DOC-000"


def test_named_fields_take_any_white_space(spark):
    row = spark.createDataFrame([("Vendor:\u00a0Cisco",)], "t string").select(
        corpus.named_field(F.col("t"), "Vendor", ("Cisco",))).first()
    assert row[0] == "Cisco"


def problems(spark, docs=None, **record):
    reviewed = corpus.manifest(documents(spark)).drop("text")
    name = OUTAGE_FILE
    for column, value in record.items():
        kind = dict(reviewed.dtypes)[column]
        reviewed = reviewed.withColumn(column, F.when(
            F.col("filename") == name, F.lit(value).cast(kind)).otherwise(F.col(column)))
    found = corpus.record_problems(reviewed, documents(spark, **(docs or {})))
    return {r["rule"] for r in found.collect()}


def test_untouched_corpus_is_clean(spark):
    assert problems(spark) == set()
    reviewed = corpus.manifest(documents(spark))
    totals = corpus.strength_totals(reviewed, documents(spark)).collect()
    assert {r["carried"] for r in totals} == {1, 2}
    assert all(r["claimed"] == r["carried"] for r in totals)


def test_lint_moves_no_texts(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        reviewed = corpus.manifest(documents(spark)).drop("text")
        found = corpus.record_problems(reviewed, documents(spark))
        plan = found._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    moved = [part for part in plan.split("\n\n") if re.match(r"\(\d+\) Exchange", part.strip())]
    assert moved and not any(re.search(r"\btext#", part) for part in moved)


@pytest.mark.parametrize("record, rule", [
    ({"document_type": "Memo"}, "unknown_document_type"), ({"doc_id": "FG-1"}, "bad_doc_id"),
    ({"provenance": "hearsay"}, "unknown_provenance"),
    ({"evidence_strength": None}, "missing_evidence_strength"),
    ({"vendors": ["Acme"]}, "unknown_vendor"), ({"device_family": "Toaster"}, "unknown_device_family"),
    ({"transition_class": "minor"}, "unknown_transition_class"), ({"sha256": "0"}, "content_changed"),
    ({"vendor": "Siemens"}, "differs:vendor"),
])
def test_record_rules_fire(spark, record, rule):
    assert rule in problems(spark, **record)


@pytest.mark.parametrize("name, old, new, rule", [
    (DRIFT_FILE, "ID | FG-DOC-058", "ID | FG-DOC-085", "body_id_disagrees"),
    (OUTAGE_FILE, "Vendor: Schneider", "Vendor: Honeywell", "body_vendor_disagrees"),
    (OUTAGE_FILE, "Family: Gateway", "Family: Switch", "body_family_disagrees"),
    (DRIFT_FILE, "One unit", "UPC_00400 and one unit", "references_upcoming"),
    (PAIR_FILE, "Dependent Vendor:** Schneider", "Dependent Vendor:** Cisco", "body_vendor_pair_disagrees"),
    (NIGHT_FILE, "Scope LOW", "Scope ANY", "differs:site_criticality_scope"),
])
def test_body_rules_fire(spark, name, old, new, rule):
    assert rule in problems(spark, docs={name: FILES[name].replace(old, new)})


def test_corpus_rules(spark):
    reviewed = corpus.manifest(documents(spark))
    history = spark.createDataFrame(
        [("DEP_004100", "Schneider", "Switch"), ("DEP_004101", "Cisco", "Gateway")],
        "deployment_id string, vendor_name string, device_type string")
    assert [r["deployment_id"] for r in corpus.unresolved_refs(reviewed, history).collect()] == ["DEP_009000"]
    lost = reviewed.where("doc_id <> 'FG-DOC-058'")
    got = {(r["rule"], r["detail"]) for r in corpus.presence_problems(
        documents(spark), lost, documents(spark)).collect()}
    assert got == {("presence", "directory only")}
    assert corpus.duplicate_doc_ids(reviewed.unionByName(reviewed)).count() == len(FILES)
    rows_ = {r["doc_id"]: r for r in corpus.gold_consistency(reviewed, history).collect()}
    row = rows_["FG-DOC-052"]
    assert (row["cited"], row["resolved"], row["vendor_match"], row["family_match"]) == (2, 2, 0.5, 0.5)
    assert rows_["FG-DOC-058"]["resolved"] == 0


def chunked(spark, docs):
    """{name: [(kind, text)]} of documents named <type>_<anything>."""
    rows = [(n, n.split("_")[0], t) for n, t in docs.items()]
    df = spark.createDataFrame(rows, "doc_id string, document_type string, text string").withColumns({
        "retrieval_mode": F.lit("x"), "vendor": F.lit("x"), "vendors": F.array(F.lit("x")),
        "evidence_strength": F.lit("x"), "provenance": F.lit("x"), "source_format": F.lit("md"),
        "filename": F.col("doc_id")}).repartition(4)
    got: dict[str, list] = {n: [] for n in docs}
    for i, r in enumerate(chunking.chunk(df).orderBy("doc_id", "chunk_index").collect()):
        assert r["chunk_id"] == f"{r['doc_id']}_chunk_{r['chunk_index']}"
        assert r["chunk_index"] == len(got[r["doc_id"]])
        got[r["doc_id"]].append((r["chunk_kind"], r["text"]))
    return got


HAND = {
    "Postmortem_parts": ("# Title\nopening\n## A\nfirst\n## B\nsecond", [
        ("prose", "# Title\nopening"), ("prose", "## A\nfirst"), ("prose", "## B\nsecond")]),
    "Transition_bare_heading": ("# Title\n## A\ntext\n---\n## Z", [("whole", "# Title\n## A\ntext\n## Z")]),
    "Postmortem_closing": ("## A\ntext\n---\n*to be read with care*", [("whole", "## A\ntext")]),
    "CrossVendor_footer": ("## A\ntext\nDo not reference this document in tickets", [("whole", "## A\ntext")]),
    "Matrix_whole": ("| a |\n|---|\n| b |", [("whole", "| a |\n|---|\n| b |")]),
    "META_whole": ("# One\n## Two\nthree", [("whole", "# One\n## Two\nthree")]),
    "Policy_two_rules": (
        "# Rules of the house\nwhy\n## Mandatory Rules\n1. wait\n2. ask\n## Exception Process\nthe lead decides", [
            ("prose", "# Rules of the house\nwhy"),
            ("rule", "# Rules of the house\n## Mandatory Rules\n1. wait\n\n## Exception Process\nthe lead decides"),
            ("rule", "# Rules of the house\n## Mandatory Rules\n2. ask\n\n## Exception Process\nthe lead decides")]),
    "Policy_no_exception": ("## Mandatory Rules\n1. wait", [("whole", "## Mandatory Rules\n1. wait")]),
}


def test_chunks_written_by_hand(spark):
    got = chunked(spark, {n: t for n, (t, _) in HAND.items()})
    for name, (_, want) in HAND.items():
        assert got[name] == want, name


def marked_documents(kinds, seed=23):
    """Random documents in which every line that counts carries a word of its own."""
    rng, docs = random.Random(seed), {}
    shapes = ["", "# h {}", "## h {}", "### h {}", "plain {}", "1. step {}", "2. step {}", "3. step {}", "7. step {}",
              "| cell {} |", "- item {}", "word {} " + "w " * 120, "---"]
    for kind in kinds:
        for i in range(80):
            lines = rng.choices(shapes, k=rng.randint(1, 30))
            docs[f"{kind}_{i}"] = "\n".join(x.format(f"m{n}") for n, x in enumerate(lines))
    return docs


def marks(text):
    return [w for w in text.replace("|", " ").split() if w[:1] == "m" and w[1:].isdigit()]


def test_nothing_is_lost_and_order_is_kept(spark):
    docs = marked_documents(["Postmortem", "Transition", "CrossVendor", "RiskNote", "Matrix", "META", "Advisory", "Runbook"])
    for name, chunks in chunked(spark, docs).items():
        seen = list(dict.fromkeys(m for _, text in chunks for m in marks(text)))
        assert set(seen) == set(marks(docs[name])), name
        if name.split("_")[0] not in ("Advisory", "Runbook"):  # these repeat and move headings
            assert seen == marks(docs[name]), name


def test_structure_is_kept_whole(spark):
    table = "\n".join(["| a | b |", "|---|---|", *[f"| {i} | x |" for i in range(40)]])
    steps = "\n".join(f"{i}. do {i}" for i in range(1, 18))
    rules = "\n".join(f"{i}. rule {i}" for i in range(1, 8))
    got = chunked(spark, {
        "Advisory_t": f"# Notice\nbefore\n\n{table}\n\nafter", "Runbook_s": f"# Steps\nintro\n\n{steps}\n\nend",
        "Policy_r": f"# P\nwhy\n## Mandatory Rules\n{rules}\n## Exception Process\nask",
        "RiskNote_n": "\n\n".join(f"paragraph {i} " + "long words stand here " * 12 for i in range(30)),
    })
    held = [text for _, text in got["Advisory_t"] if "|---|---|" in text]
    assert len(held) == 1 and held[0].count("\n| ") >= 41  # a table is never cut
    sizes = [sum(line.split(". ")[0].isdigit() for line in text.split("\n")) for kind, text in got["Runbook_s"] if kind == "step"]
    assert sum(sizes) == 17 and max(sizes) - min(sizes) <= 1  # even groups of steps
    assert [sum(f"{i}. rule" in text for i in range(1, 8)) for kind, text in got["Policy_r"] if kind == "rule"] == [1] * 7
    low, high = chunking.NOTE_TOKENS
    assert all(low * 3 <= len(text) <= high * 5 for _, text in got["RiskNote_n"][:-1])


def test_a_long_document_takes_time_in_proportion(spark):
    """Four times the lines take up to four times as long, and the plan's own time beside it."""
    def seconds(n):
        text = "# R\n" + "\n".join(f"{i % 9 + 1}. step {i}" for i in range(n))
        chunked(spark, {"Runbook_w": "1. a"})
        start = time.perf_counter()
        chunked(spark, {"Runbook_long": text})
        return time.perf_counter() - start

    seconds(200)
    assert seconds(16000) < 3 * max(seconds(4000), 1.5)


def test_step_runs_over_block_borders(spark):
    """Runs as long as several blocks of states keep their steps, in order and number."""
    n = 5 * chunking.BLOCK + 3
    text = "Above:\n" + "\n".join(f"{i}. step {i}" for i in range(1, n + 1)) + "\nNext:\n1. a\n2. b"
    got = chunked(spark, {"Runbook_x": text})["Runbook_x"]
    steps = [line for _, chunk in got for line in chunk.split("\n")[1:]]
    assert steps == [f"{i}. step {i}" for i in range(1, n + 1)] + ["1. a", "2. b"]
    assert [chunk.split("\n")[0] for _, chunk in got] == ["Above:"] * (len(got) - 1) + ["Next:"]


def chunk_rows(spark, rows):
    return spark.createDataFrame(
        [(f"{d}_chunk_{i}", d, i, k, t, v, f"{d}.md", "md", x) for d, i, k, t, v, x in rows],
        "chunk_id string, doc_id string, chunk_index int, chunk_kind string, document_type string,"
        "vendors array<string>, filename string, source_format string, text string")


@pytest.mark.parametrize("row, rule", [
    (("a", 0, "prose", "Postmortem", ["Cisco"], " "), "empty"),
    (("a", 0, "prose", "Postmortem", ["Cisco"], "x\n## One"), "no_leading_heading"),
    (("a", 0, "prose", "Postmortem", ["Cisco"], "## One\n## Two"), "merges_sections"),
    (("a", 0, "prose", "CrossVendor", ["Cisco"], "## One\nSiemens"), "vendor_outside_pair"),
    (("a", 0, "table", "Advisory", ["Cisco"], "h\n| a |\n| b |"), "table_cut"),
    (("a", 0, "prose", "Advisory", ["Cisco"], "h\n| a |\n|---|"), "prose_with_table"),
    (("a", 0, "prose", "RiskNote", ["Cisco"], "short"), "note_size"),
    (("a", 0, "step", "Runbook", ["Cisco"], "h\n1. one"), "few_steps"),
    (("a", 0, "step", "Runbook", ["Cisco"], "h\n1. one\n3. three"), "steps_not_contiguous"),
    (("a", 0, "rule", "Policy", [], "h\n1. one\n2. two\n## Exception Process"), "not_one_rule"),
    (("a", 0, "rule", "Policy", [], "h\n1. one"), "rule_without_exception"),
    (("a", 1, "whole", "Runbook", [], "x"), "index_not_contiguous"),
])
def test_invariants_fire(spark, row, rule):
    found = chunking.invariant_violations(chunk_rows(spark, [row]), corpus.CORPUS.vendors)
    assert rule in {r["rule"] for r in found.collect()}


def test_document_invariants_and_warnings(spark):
    rows = [("m", 0, "whole", "Matrix", [], "x"), ("m", 1, "whole", "Matrix", [], "x")]
    rules = {r["rule"] for r in chunking.invariant_violations(
        chunk_rows(spark, rows), ()).collect()}
    assert rules == {"must_be_one_chunk"}
    twice = chunk_rows(spark, [rows[0], rows[0]])
    assert "chunk_id_repeated" in {r["rule"] for r in chunking.invariant_violations(twice, ()).collect()}
    notes = [(d, i, "prose", "Postmortem", [], "## x") for d, n in (("a", 4), ("b", 4), ("c", 9))
             for i in range(n)] + [("w", 0, "whole", "Postmortem", [], "x")]
    got = {r["doc_id"]: r for r in chunking.structure_warnings(chunk_rows(spark, notes)).collect()}
    assert set(got) == {"c", "w"} and got["w"]["collapsed"] and got["c"]["median"] == 4.0


def unit(rng, n, d=8):
    x = rng.normal(size=(n, d))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def test_topk_agrees_with_brute_force_however_it_is_cut(spark):
    rng = np.random.default_rng(0)
    slots = np.where(rng.random(240) < 0.4, "hot", rng.choice(["a", "b", "c"], 240))
    items = unit(rng, 240)
    items[10] = items[11]
    queries, wanted = unit(rng, 60), rng.choice(["hot", "a", "none"], 60)
    i_df = spark.createDataFrame(
        [(s, f"i{n:03d}", v.tolist()) for n, (s, v) in enumerate(zip(slots, items))],
        "slot string, item_id string, vector array<float>")
    q_df = spark.createDataFrame(
        [(f"q{n}", s, int(n % 4), v.tolist()) for n, (s, v) in enumerate(zip(wanted, queries))],
        "query_id string, slot string, k int, vector array<float>")
    want = set()
    for n, (slot, q) in enumerate(zip(wanted, queries)):
        scored = sorted((-round(float(q.astype(float) @ items[m].astype(float)), 6), f"i{m:03d}")
                        for m in range(240) if slots[m] == slot)
        want |= {(f"q{n}", r + 1, item) for r, (_, item) in enumerate(scored[: n % 4])}

    def got(**options):
        return {(r["query_id"], r["rank"], r["item_id"])
                for r in filtered_topk(q_df, i_df, **options).collect()}

    assert got() == want
    assert got(items_per_block=30, queries_per_block=9) == got(items_per_block=7, queries_per_block=50) == want


def test_topk_of_equal_items_stays_small():
    """Ties name every cell of a product; they are scored a few thousand at a time."""
    items = np.zeros((20_000, 256), np.float32)
    items[:, 0] = 1.0
    tracemalloc.start()
    rows, cols, found, rank = best_of(np.eye(256)[:40] * 1.0, items, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert list(cols) == [0, 1, 2] * 40 and list(found[:3]) == [1.0] * 3 and not found[3:].any()
    assert peak < 400_000_000


def test_topk_sends_no_table_that_grows_with_the_queries(spark, tmp_path):
    """Equal vectors make files far smaller than their rows, so sizes of files said to broadcast them."""
    rows = spark.range(300).select(
        F.col("id").cast("string").alias("query_id"), F.lit("s").alias("slot"), F.lit(2).alias("k"),
        F.array(*[F.lit(0.5).cast("float")] * 4).alias("vector"))
    rows.write.parquet(f"{tmp_path}/q")
    queries = spark.read.parquet(f"{tmp_path}/q")
    plan = filtered_topk(queries, queries.withColumnRenamed("query_id", "item_id"))._jdf.queryExecution().executedPlan().toString()
    sent = plan.split("BroadcastExchange")[1:]
    assert sent and all("vector" not in x.split("Scan parquet")[1].splitlines()[0].split("PushedFilters")[0]
                        and "query_id" not in x.split("Scan parquet")[1].splitlines()[0] for x in sent)


def test_topk_sends_no_row_once_for_every_block(spark, monkeypatch):
    """Small blocks are products of a task, not rows sent: 400 blocks a side met in 160,000 groups."""
    kept = []
    monkeypatch.setattr(topk, "materialise", lambda df, name: kept.append(materialise(df, name)) or kept[-1])
    rng = np.random.default_rng(1)
    vectors = np.repeat(unit(rng, 40), 10, axis=0)  # ten copies of each
    items = spark.createDataFrame([("s", f"i{n:03d}", v.tolist()) for n, v in enumerate(vectors)],
                                  "slot string, item_id string, vector array<float>")
    queries = items.select(F.col("item_id").alias("query_id"), "slot", F.lit(3).alias("k"), "vector")
    got = {}
    for r in filtered_topk(queries, items, items_per_block=1, queries_per_block=1).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["item_id"]
    assert got == {f"i{n:03d}": {r + 1: f"i{n // 10 * 10 + r:03d}" for r in range(3)} for n in range(400)}
    assert max(kept[0].drop("slot").first()) <= 8


def test_best_of_agrees_with_brute_force_on_ties_in_any_blocks():
    rng = np.random.default_rng(2)
    items, queries = (rng.integers(0, 2, (n, 5)) / 2.0 for n in (300, 70))
    scores = np.round(queries @ items.T, 6)
    for k in (1, 4, 299, 400):
        want = [(q, i, r + 1) for q in range(70) for r, i in enumerate(np.lexsort((np.arange(300), -scores[q]))[:k])]
        for blocks in ((1, 1), (7, 11), (20_000, 5_000)):
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr(topk, "CELLS_PER_PRODUCT", 100)
                rows, cols, found, rank = best_of(queries, items.astype(np.float32), k, *blocks)
            assert list(zip(rows, cols, rank)) == want and (found == scores[rows, cols]).all()


RECORDS = [
    ("FG-DOC-311", "Postmortem", ["Honeywell"], "RTU", None, None, ["DEP_004100"]),
    ("FG-DOC-312", "Advisory", ["Honeywell"], "RTU", None, None, []),
    ("FG-DOC-314", "Postmortem", ["Cisco"], "RTU", None, None, ["DEP_004102"]),
    ("FG-DOC-320", "Transition", ["Honeywell"], None, "extreme", None, ["DEP_004103", "DEP_004104"]),
    ("FG-DOC-321", "Transition", ["Honeywell"], None, "major", None, []),
    ("FG-DOC-330", "CrossVendor", ["Honeywell", "Schneider"], None, None, None, []),
    ("FG-DOC-331", "CrossVendor", ["Schneider", "Honeywell"], None, None, None, []),
    ("FG-DOC-340", "Runbook", ["Honeywell"], "RTU", None, None, []),
    ("FG-DOC-341", "Runbook", ["Honeywell"], "HMI", None, None, ["DEP_004105"]),
    ("FG-DOC-342", "Runbook", ["Honeywell"], "RTU", None, None, []),
    ("FG-DOC-350", "Policy", [], None, None, "LOW", []),
    ("FG-DOC-351", "Policy", [], None, None, "HIGH", []),
    ("FG-DOC-360", "Matrix", [], None, None, None, []),
    ("FG-DOC-361", "Matrix", [], None, None, None, []),
]
TEXTS = [
    ("FG-DOC-311", 0, "prose", "the bootloader stopped after a repeat"),
    ("FG-DOC-311", 1, "prose", "failure of the RTU clock, bootloader replaced"),
    ("FG-DOC-312", 0, "prose", "advice on clocks of an RTU"),
    ("FG-DOC-314", 0, "prose", "bootloader of another maker"),
    ("FG-DOC-320", 0, "prose", "across three majors"), ("FG-DOC-320", 1, "prose", "what broke"),
    ("FG-DOC-320", 2, "prose", "what held"), ("FG-DOC-321", 0, "prose", "one major only"),
    ("FG-DOC-330", 0, "prose", "pumps wait for a switch"), ("FG-DOC-331", 0, "prose", "a switch waits for pumps"),
    ("FG-DOC-340", 0, "prose", "before you begin"), ("FG-DOC-340", 1, "step", "1. stop\n2. copy"),
    ("FG-DOC-340", 2, "step", "3. write\n4. start"), ("FG-DOC-341", 0, "prose", "screens only"),
    ("FG-DOC-342", 0, "prose", "short form"),
    ("FG-DOC-350", 0, "whole", "bootloader cvss emergency tier 1"),
    ("FG-DOC-350", 1, "rule", "1. cvss needs a date. Exception Process"),
    ("FG-DOC-350", 2, "rule", "2. bootloader and cvss need two people. Exception Process"),
    ("FG-DOC-351", 0, "rule", "1. bootloader needs a board. Exception Process"),
    ("FG-DOC-360", 0, "whole", "| Cisco | LOW |"), ("FG-DOC-361", 0, "whole", "| Honeywell | LOW |\n| Cisco | HIGH |"),
]
BASE = {
    "deployment_id": "N7", "vendor_name": "Honeywell", "device_type": "RTU", "current_firmware": "2.9",
    "target_firmware": "6.1", "max_cvss_score": 8.8, "site_criticality": "LOW",
    "deployment_type": "PLANNED", "transition_class": "extreme",
    "cross_vendor_dependency_count": 1.0, "active_flags": ["bootloader_touched", "high_cvss"],
}
ROW = ("deployment_id string, vendor_name string, device_type string, current_firmware string,"
       "target_firmware string, max_cvss_score double, site_criticality string,"
       "deployment_type string, transition_class string, cross_vendor_dependency_count double,"
       "active_flags array<string>")


def rows(spark, *changes):
    return spark.createDataFrame([tuple({**BASE, **c}.values()) for c in changes], ROW)


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame(
        RECORDS, "doc_id string, document_type string, vendors array<string>, device_family string,"
        "transition_class string, site_criticality_scope string,"
        "source_deployment_ids array<string>")


@pytest.fixture(scope="module")
def searchable(spark, records):
    facts = {r[0]: r for r in RECORDS}
    chunks = spark.createDataFrame(
        [(f"{d}_chunk_{i}", d, i, k, *facts[d][1:6], t) for d, i, k, t in TEXTS],
        "chunk_id string, doc_id string, chunk_index int, chunk_kind string, document_type string,"
        "vendors array<string>, device_family string, transition_class string,"
        "site_criticality_scope string, text string")
    return retrieval.prepare_chunks(chunks)


def test_a_document_id_that_stands_twice_multiplies_nothing(spark):
    files = {"Postmortem_Honeywell_RTU_FAILED_FG-DOC-311.md": "# A\nfirst",
             "Postmortem_Cisco_HMI_FAILED_FG-DOC-311.md": "# B\nsecond", "notes.pdf": None}
    _, chunks = evidence.build_corpus(spark.createDataFrame(list(files.items()), "filename string, text string"))
    assert sorted((r["vendors"][0], r["device_family"], r["text"]) for r in chunks.collect()) == [
        ("Cisco", "HMI", "# B\nsecond"), ("Honeywell", "RTU", "# A\nfirst")]


def test_a_footer_is_the_named_product_s(spark):
    """Lines that begin with another product's name are text."""
    text = "# A\nfirst\nAcme AI RAG Knowledge Base\nOther AI RAG Knowledge Base\nSource: 12 historical rows"
    files = spark.createDataFrame([("Advisory_Cisco_HMI_FG-DOC-311.md", text)], "filename string, text string")
    for product, kept in ((None, ["Acme", "Other"]), ("Acme", ["Other"]), ("A.m", ["Acme", "Other"])):
        _, chunks = evidence.build_corpus(files, corpus.CorpusContract(product=product))
        said = "\n".join(r["text"] for r in chunks.collect())
        assert [w for w in ("Acme", "Other") if w in said] == kept and "Source" not in said


def routed(spark, searchable, **change):
    out: dict[str, list] = {}
    for r in retrieval.retrieve(rows(spark, change), searchable).orderBy("route", "rank").collect():
        out.setdefault(r["route"], []).append(r["chunk_id"].replace("FG-DOC-", "").replace("_chunk_", "."))
    return out


def test_every_route_for_a_covered_row(spark, searchable):
    got = routed(spark, searchable)
    assert set(got["evidence"]) == {"311.0", "311.1", "312.0"}
    assert set(got["transition"]) < {"320.0", "320.1", "320.2"} and len(got["transition"]) == 2
    assert got["cross_vendor"] == ["330.0"]
    assert got["runbook"] == ["340.0", "340.1", "342.0"]
    assert got["policy"] == ["350.2", "350.1"]  # more flags first, rules before whole texts
    assert got["matrix"] == ["361.0"]
    assert routed(spark, searchable, vendor_name="Cisco")["matrix"] == ["360.0"]


@pytest.mark.parametrize("change, missing", [
    ({"vendor_name": "Acme"}, {"evidence", "transition", "cross_vendor", "runbook", "matrix"}),
    ({"vendor_name": "Schneider"}, {"evidence", "transition", "runbook", "matrix"}),
    ({"device_type": "Switch"}, {"runbook"}), ({"transition_class": None}, {"transition"}),
    ({"transition_class": "minor"}, {"transition"}),
    ({"cross_vendor_dependency_count": 0.0}, {"cross_vendor"}),
    ({"cross_vendor_dependency_count": None}, {"cross_vendor"}),
    ({"site_criticality": "MEDIUM"}, {"policy"}), ({"active_flags": ["kernel_touched"]}, {"policy"}),
])
def test_a_route_without_a_match_returns_nothing(spark, searchable, change, missing):
    assert set(retrieval.ROUTE_LIMITS) - set(routed(spark, searchable, **change)) == missing


def judged(spark, searchable, config=gate.GateConfig(), **change):
    df = rows(spark, change)
    return gate.assess(df, retrieval.retrieve(df, searchable, routes=("evidence",)),
                       searchable, config).first()


def test_gate(spark, searchable):
    assert judged(spark, searchable)["verdict"] == "concern_found"
    assert judged(spark, searchable, active_flags=[])["verdict"] == "no_flag_evidence"
    unknown = judged(spark, searchable, vendor_name="Acme")
    assert unknown["verdict"] == "insufficient_evidence"
    assert unknown["reasons"] == ["no Acme evidence in the corpus"]
    thin = judged(spark, searchable, active_flags=["tier_1_device", "high_network_stress"])
    assert thin["verdict"] == "low_confidence"
    assert thin["reasons"] == ["0/2 active flags grounded in the evidence"]
    strict = judged(spark, searchable, gate.GateConfig(6, 3, min_mean_score=1.1))
    assert strict["reasons"][:2] == ["3 vendor-matched chunks (need 6)", "2 distinct document(s) (need 3)"]
    assert strict["reasons"][2].startswith("mean score ")


def test_gate_sees_a_keyword_across_two_chunks(spark, searchable):
    df = rows(spark, {"active_flags": ["repeat_failure_device"]})
    for order, grounded in (((0, 1), ["repeat_failure_device"]), ((1, 0), [])):
        hits = spark.createDataFrame(
            [("N7", "evidence", n + 1, f"FG-DOC-311_chunk_{c}", 0.5) for n, c in enumerate(order)],
            "query_id string, route string, rank int, chunk_id string, score double")
        assert gate.assess(df, hits, searchable).first()["grounded"] == grounded


def test_a_seam_is_as_wide_as_the_longest_keyword():
    assert retrieval.EDGE == max(len(w) for words in fl.CORPUS_FLAG_WORDS.values() for w in words)


def test_evidence_blocks_keep_first_occurrence(spark, searchable):
    hits = retrieval.route_all(rows(spark, {}), searchable)
    twice = retrieval.Routed(hits.direct.unionByName(hits.direct.withColumn("route", F.lit("matrix"))), hits.lists, hits.members)
    row = retrieval.evidence_blocks(twice, searchable).first()
    assert len(row["evidence_ids"]) == len(set(row["evidence_ids"])) == 12
    assert row["block"].startswith("[Evidence 1] FG-DOC-31")


def test_what_holds_a_runbook_list_is_not_shuffled_again(spark, searchable):
    hits = retrieval.route_all(rows(spark, {"deployment_id": "A"}), searchable).written()
    plan = retrieval.evidence_blocks(hits, searchable)._jdf.queryExecution().optimizedPlan().toString()
    first = next(line for line in plan.splitlines() if "Join" in line)
    assert "LeftOuter" in first and "list_key" in first


def test_runbook_lists_are_kept_once_and_read_as_if_written_out(spark, searchable):
    """Blocks, coverage and grades from the lists equal those of the rows; no plan pairs queries with runbooks."""
    asked = rows(spark, *[{"deployment_id": f"A{i}"} for i in range(30)],
                 {"deployment_id": "B", "device_type": "Switch"},
                 {"deployment_id": "C", "active_flags": [], "transition_class": None, "cross_vendor_dependency_count": 0.0},
                 {"deployment_id": "D", "vendor_name": "Acme", "active_flags": []})
    hits = retrieval.route_all(asked, searchable).written()
    assert hits.direct.where("route = 'runbook'").count() == 0 and hits.lists.count() < 10
    facts = {r["chunk_id"]: r for r in searchable.collect()}
    order = list(retrieval.ROUTE_LIMITS)
    want: dict[str, dict] = {}
    for r in sorted(hits.rows().collect(), key=lambda r: (r["query_id"], order.index(r["route"]), r["rank"])):
        want.setdefault(r["query_id"], {}).setdefault(r["chunk_id"], r["route"])
    got = {r["query_id"]: r for r in retrieval.evidence_blocks(hits, searchable).collect()}
    assert set(got) == set(want) and "D" not in got
    for q, found in want.items():
        assert got[q]["evidence_ids"] == list(found)
        assert got[q]["document_ids"] == sorted({facts[c]["doc_id"] for c in found})
        assert got[q]["block"] == "\n\n".join(
            f"[Evidence {n}] {facts[c]['doc_id']} ({facts[c]['document_type']}, {route})\n{facts[c]['text']}"
            for n, (c, route) in enumerate(found.items(), 1))
    few = hits.rows(spark.createDataFrame([("A3",)], "query_id string"))
    assert {r["query_id"] for r in few.collect()} == {"A3"}
    coverage = {r["route"]: r["coverage"] for r in reteval.route_coverage(asked, hits).collect()}
    assert coverage["runbook"] == round(31 / 33, 4)


def test_gold_and_quality(spark, records, searchable):
    history = rows(spark, *[{"deployment_id": f"DEP_00410{i}"} for i in (0, 3, 5)],
                   {"deployment_id": "DEP_004102", "vendor_name": "Siemens"},
                   {"deployment_id": "DEP_004104", "transition_class": "major"})
    gold = reteval.gold_queries(records, history)
    pairs = {(r["doc_id"], r["deployment_id"]) for r in gold.collect()}
    assert ("FG-DOC-311", "DEP_004100") in pairs and ("FG-DOC-320", "DEP_004103") in pairs
    assert ("FG-DOC-314", "DEP_004102") not in pairs
    graded = reteval.outcomes(gold, retrieval.route_all(history, searchable), searchable)
    quality = {(r["slice"], r["value"]): r for r in reteval.evidence_quality(graded).collect()}
    assert quality["all", "all"]["recall_at_5"] == 1.0 and 0 < quality["all", "all"]["mrr"] <= 1
    routes = {r["route"]: r for r in reteval.route_quality(graded).collect()}
    assert set(routes) <= set(retrieval.ROUTE_LIMITS)


def test_report_and_controls(spark, records, searchable):
    upcoming = rows(spark, {"deployment_id": "N1"}, {"deployment_id": "N2"}, {"deployment_id": "N3", "vendor_name": "Acme"})
    history = rows(spark, {"deployment_id": "DEP_004100"})
    report = evidence.evaluate(records, searchable, history, upcoming)
    controls = report["controls"].collect()
    assert len(controls) == 3 and all(r["passed"] for r in controls)
    coverage = {r["route"]: r["coverage"] for r in report["coverage"].collect()}
    assert coverage["evidence"] == pytest.approx(2 / 3, abs=1e-3) and coverage["policy"] == 1.0


def test_controls_work_their_probes_out_once(spark, records, searchable):
    """Probes are read three times; what makes them sums up all orders' lines."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        made.add(1)
        return x

    upcoming = rows(spark, {"deployment_id": "N1"}, {"deployment_id": "N3", "vendor_name": "Acme"})
    probes = materialise(reteval.control_probes(records, upcoming)).withColumn("vendor_name", counted("vendor_name"))
    assert all(r["passed"] for r in reteval.negative_controls(probes, searchable).collect())
    assert made.value == probes.count() == 3


def test_queries_sum_up_the_lines_once(spark, monkeypatch, tmp_path):
    """Deployments are written before the steps that read them, which else join all orders and lines anew."""
    for name, columns in {
        "orders": "id AS o_orderkey, id % 9 AS o_custkey, 'F' AS o_orderstatus, '1-URGENT' AS o_orderpriority,"
                  " timestamp'2024-01-01' AS o_orderdate",
        "customer": "id AS c_custkey, id % 3 AS c_nationkey, 'BUILDING' AS c_mktsegment",
        "part": "id AS p_partkey, 'ECONOMY' AS p_type, 'b' AS p_brand, 1 AS p_size",
        "lineitem": "id AS l_orderkey, 1 AS l_linenumber, id % 5 AS l_partkey, 2.0D AS l_quantity, 0.1D AS l_tax,"
                    " 'R' AS l_returnflag, 0.1D AS l_discount",
        "documents": "id AS doc_id, 'kernel_touched words' AS text",
    }.items():
        spark.range(60).selectExpr(*columns.split(", ")).write.parquet(f"{tmp_path}/{name}.parquet")
    sent, write = [], materialise

    def reads_lines(df):
        return "l_orderkey" in df._jdf.queryExecution().optimizedPlan().toString()

    def kept(df, name="table"):
        sent.append((name, reads_lines(df)))
        return write(df, name)

    for module in (evidence_queries, reteval, retrieval):
        monkeypatch.setattr(module, "materialise", kept)
    for query in ("quality_gates", "route_quality"):
        sent.clear()
        made = getattr(evidence_queries, query)(spark, str(tmp_path))
        assert [name for name, reads in sent if reads] == ["history"] and not reads_lines(made)


def test_explain_never_generates_for_refused_rows(spark, searchable):
    def generate(messages):
        assert all("Vendor: Honeywell" in m for m in messages)
        return ["This upgrade fails like [FG-DOC-311] and [FG-DOC-777]."] * len(messages)

    df = rows(spark, {}, {"deployment_id": "N8", "vendor_name": "Acme"},
              {"deployment_id": "N9", "active_flags": ["high_network_stress"]}).withColumns({
        "fleet_tier": F.lit("TIER_2"), "version_jump_magnitude": F.lit(7.0),
        "maintenance_window": F.lit(0.0), "past_failure_count": F.lit(1.0)})
    got = {r["query_id"]: r for r in evidence.explain(df, searchable, generate).collect()}
    assert got["N7"]["generated"] and not got["N8"]["generated"] and not got["N9"]["generated"]
    assert got["N7"]["unretrieved_citations"] == ["FG-DOC-777"]
    assert got["N8"]["text"] == "Acme".join(evidence.REFUSAL)
    assert got["N9"]["text"].startswith("Low confidence")


def test_no_call_is_made_twice(spark, tmp_path):
    """Equal messages are one call; what failed is asked again; waves that were written stay."""
    ledger = CallLedger(str(tmp_path / "calls"), "m", wave=4, batch=3)
    asked = spark.createDataFrame(
        [(f"q{i}", f"message {i % 9}", i % 2) for i in range(30)] + [("none", None, 0)], "query_id string, message string, attempt int")

    def some(messages):
        return [None if m.endswith("3") else m.upper() for m in messages]

    first = {(r["query_id"], r["attempt"]): r["text"] for r in ledger.answers(asked, some).collect()}
    assert first["q1", 1] == "MESSAGE 1" and first["q3", 1] is None and first["none", 0] is None and len(first) == 31
    assert ledger.calls(spark).count() == 18
    assert spark.read.parquet(f"{tmp_path}/calls/m/*").select(F.input_file_name()).distinct().count() > 3

    def only_failed(messages):
        assert set(messages) == {"message 3"}
        return ["now"] * len(messages)

    again = {(r["query_id"], r["attempt"]): r["text"] for r in ledger.answers(asked, only_failed).collect()}
    assert again["q3", 1] == "now" and ledger.calls(spark).count() == 20

    def none(messages):
        raise AssertionError("called")

    assert {(r["query_id"], r["attempt"]): r["text"] for r in ledger.answers(asked, none).collect()} == again


def test_a_report_goes_on_where_it_stopped(spark, records, searchable, tmp_path):
    base = rows(spark, {"deployment_id": "N1"}, {"deployment_id": "N2"}, {"deployment_id": "N3", "vendor_name": "Acme"})
    upcoming = base.withColumns({
        "risk_probability": F.lit(0.5), "fleet_tier": F.lit("TIER_2"), "version_jump_magnitude": F.lit(7.0),
        "maintenance_window": F.lit(0.0), "past_failure_count": F.lit(1.0)})

    def writer(messages):
        return ["As in [FG-DOC-311]."] * len(messages)

    def judge(messages):
        return ['{"claims": [{"claim": "a", "verdict": "supported"}]}'] * len(messages)

    def none(messages):
        raise AssertionError("called")

    folder = str(tmp_path / "ledgers")
    first = evidence.generation_report(records, searchable, upcoming, writer, folder, judge)
    again = evidence.generation_report(records, searchable, upcoming, none, folder, none)
    for name in ("results", "judged", "gates"):
        assert sorted(map(str, first[name].collect())) == sorted(map(str, again[name].collect()))
    kept = {r["query_id"]: r for r in first["results"].collect()}
    assert {q: r["generator_calls"] for q, r in kept.items()} == {
        "ranked Honeywell N1": 1, "ranked Honeywell N2": 1, "out_of_corpus Acme N3": 0, "synthetic OutOfCorpusVendor N1": 0}
    gates = {r["gate"]: r["passed"] for r in first["gates"].collect()}
    assert all(gates.values()) and "judge_claim_precision" in gates
    more = evidence.rejudged_report(first["results"], judge, folder, 3)
    assert more["passes"].count() == 3 and more["spread"].first()["precision_spread"] == 0.0
    assert evidence.rejudged_report(first["results"], none, folder, 3)["passes"].count() == 3
    controls = evidence.controls(records, searchable, upcoming, none).collect()
    assert len(controls) == 3 and all(r["passed"] and r["generator_calls"] == 0 for r in controls)


def checks(spark, text, flags=(), context="CVSS 7.9", texts="took 1,204 hours", required=True):
    df = spark.createDataFrame(
        [(text, context, texts, ["FG-DOC-001"], list(flags), required)],
        "text string, context string, evidence string, retrieved array<string>,"
        "active_flags array<string>, require_citation boolean")
    return grounding.grounding_checks(df).first()


def test_grounding(spark):
    good = checks(spark, "It took 1204 hours at 7.9 [FG-DOC-001], see Evidence 12.")
    assert good["citations_ok"] and good["numbers_ok"] and good["flags_ok"]
    assert checks(spark, "In 73 cases [FG-DOC-002].")["stray_numbers"] == ["73"]
    assert checks(spark, "In \u0664\u0662 cases [FG-DOC-001].")["stray_numbers"] == ["\u0664\u0662"]
    assert checks(spark, "In all cases [FG-DOC-002].")["unretrieved_citations"] == ["FG-DOC-002"]
    assert not checks(spark, "No source.")["citations_ok"]
    assert checks(spark, "No source.", required=False)["citations_ok"]
    flagged = "Past cases had kernel_touched. This upgrade has kernel_touched too."
    assert checks(spark, flagged)["borrowed_flags"] == ["kernel_touched"]
    assert checks(spark, flagged, flags=["kernel_touched"])["flags_ok"]
    assert checks(spark, "This upgrade has no kernel_touched.")["flags_ok"]


def test_striking(spark):
    df = spark.createDataFrame(
        [("see FG-DOC-001, FG-DOC-002; FG-DOC-001", ["FG-DOC-001"])], "t string, b array<string>")
    assert df.select(grounding.mark_unretrieved(F.col("t"), F.col("b"))).first()[0] == (
        "see ~~FG-DOC-001~~ *(not retrieved)*, FG-DOC-002; ~~FG-DOC-001~~ *(not retrieved)*")


def test_claims(spark):
    replies = spark.createDataFrame([
        (1, 'ok {"claims": [{"claim": "a", "verdict": "Supported"}, {"claim": "b", "verdict": "hm"},'
            ' {"claim": "The evidence does not apply.", "verdict": "unsupported"}, "x"]}'),
        (2, "nothing"), (3, '{"claims": []}'), (4, '{"claims": [{"verdict": "not_a_claim"}]}'),
    ], "id int, reply string")
    rows_ = grounding.claims(replies, ["id"])
    graded = {r["id"]: r for r in grounding.faithfulness(rows_, ["id"]).collect()}
    assert (graded[1]["supported"], graded[1]["unsupported"], graded[1]["precision"]) == (1, 1, 0.5)
    assert graded[2]["precision"] is None and graded[2]["faithful"] is None
    assert graded[4]["precision"] is None and graded[4]["faithful"] is True
    rates = grounding.judge_rates(grounding.faithfulness(rows_, ["id"])).first()
    assert rates["judge_claim_precision"] == 0.5 and rates["judge_unparseable"] == 3


def test_probe_set(spark, records):
    values = [("Honeywell", f"d{i}", p) for i, p in enumerate([0.9, 0.9, 0.5, 0.4, None])]
    df = spark.createDataFrame([*values, ("Acme", "m1", 0.1), ("Cisco", "c1", 0.2)],
                               "vendor_name string, deployment_id string, risk_probability double")
    got = {(r["vendor_name"], r["deployment_id"]) for r in reteval.probe_set(records, df).collect()}
    assert got == {("Honeywell", "d0"), ("Honeywell", "d1"), ("Honeywell", "d2"), ("Honeywell", "d4"),
                   ("Cisco", "c1"), ("Acme", "m1"), ("OutOfCorpusVendor", "c1")}


def test_index_promotion_and_pruning(spark, searchable, tmp_path):
    index = EvidenceIndex(spark, str(tmp_path / "index"))
    assert index.current() is None and index.versions().count() == 0
    with pytest.raises(ValueError, match="promoted"):
        index.read()
    with pytest.raises(ValueError, match="No version"):
        index.promote("corpus-20250101")
    one, two, three, four = (index.build(searchable, f"2026010{i}") for i in range(1, 5))
    assert index.promote(one) is None and index.promote(two) == one and index.promote(one) == two
    assert index.prune(keep=2) == [two, three]
    assert index.current() == one and index.read().count() == len(TEXTS)

    def verdict(passed):
        return lambda built: spark.createDataFrame([(passed,)], "passed boolean")

    assert index.build_and_promote(searchable, verdict(False), "20260108") is None
    assert index.current() == one
    assert index.build_and_promote(searchable, verdict(True), "20260109") == index.current()
    assert four in {r[0] for r in index.versions().collect()}


def test_of_two_promotions_at_one_step_one_wins(spark, searchable, tmp_path):
    """Both read the log before either writes; what is published is whole or not there."""
    indexes = [EvidenceIndex(spark, str(tmp_path / "index")) for _ in range(8)]
    names = [indexes[0].build(searchable.limit(1), f"2026020{i}") for i in range(8)]
    gate_ = threading.Barrier(len(indexes))

    def one(index, name):
        number = index._next_number()
        gate_.wait()
        try:
            index._claim(number, name)
            return name
        except PromotedMeanwhile:
            return None

    with ThreadPoolExecutor(len(indexes)) as pool:
        won = [w for w in pool.map(one, indexes, names) if w]
    assert len(won) == 1 and indexes[0].current() == won[0]
    assert indexes[0].promote(names[0]) == won[0] and indexes[1].current() == names[0]


def test_embedder_vectors_are_unit_length():
    vectors = hashed_words(["Kernel kernel jump", "", "a b c"])
    assert np.linalg.norm(vectors, axis=1) == pytest.approx([1.0, 0.0, 1.0], abs=1e-6)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_topk_of_uncut_slots_merges_nothing_and_repeated_ids_stay(spark):
    """Where no slot's items are cut, winners are final in their task: no window, no second look at the queries.
    Ids that repeat get what the merged plan gives them, and null ones nothing."""
    rng = np.random.default_rng(5)
    items = spark.createDataFrame([("s" if n % 3 else "t", f"i{n:02d}", v.tolist()) for n, v in enumerate(unit(rng, 60))],
                                  "slot string, item_id string, vector array<float>")
    asked = [(None if n == 7 else f"q{n % 20}", "s" if n % 2 else "t", n % 5, v.tolist()) for n, v in enumerate(unit(rng, 50))]
    queries = spark.createDataFrame(asked, "query_id string, slot string, k int, vector array<float>")
    whole, cut = filtered_topk(queries, items), filtered_topk(queries, items, items_per_block=7)
    assert "Window" not in plan_text(whole) and "Window" in plan_text(cut)
    got, want = (sorted(map(tuple, df.select("query_id", "slot", "item_id", "score", "rank").collect())) for df in (whole, cut))
    assert got == want and len(got) > 60


def test_queries_are_sent_packed(spark):
    """One row for many queries of a slot, with their mostly empty vectors compressed."""
    rows = spark.range(3_000, numPartitions=1).select(
        F.col("id").cast("string").alias("query_id"), F.lit("s").alias("slot"),
        F.transform(F.sequence(F.lit(0), F.lit(255)), lambda i: F.when(i == F.col("id") % 256, 1.0).otherwise(0.0)
                    .cast("float")).alias("vector"))
    packed = topk._packed(rows, ["slot"]).collect()
    assert len(packed) == 1 and len(packed[0]["packed"]) < 3_000 * 60


def test_the_gate_deals_hits_once(spark, searchable):
    """By query only: few chunks' facts are sent to the hits, not hits to the chunks."""
    asked = rows(spark, {"deployment_id": "A"}, {"deployment_id": "A"}, {"deployment_id": "B", "vendor_name": "Acme"})
    verdicts = gate.assess(asked, retrieval.retrieve(asked, searchable, routes=("evidence",)), searchable)
    assert "hashpartitioning(chunk_id" not in plan_text(verdicts)
    got = {r["query_id"]: r for r in verdicts.collect()}
    assert verdicts.where("query_id = 'A'").count() == 2
    assert got["B"]["verdict"] == "insufficient_evidence" and got["A"]["matched"] % 4 == 0


def test_ids_of_evidence_carry_no_texts(spark, searchable):
    hits = retrieval.route_all(rows(spark, {"deployment_id": "A"}), searchable).written()
    blocks = retrieval.evidence_blocks(hits, searchable)
    assert "text" in plan_text(blocks)
    assert "text" not in plan_text(blocks.select("query_id", "evidence_ids"))


def test_runbooks_are_written_out_from_one_joined_row(spark, searchable):
    hits = retrieval.route_all(rows(spark, {"deployment_id": "A"}), searchable).written()
    assert "Generate inline(listed" in plan_text(hits.rows())


def test_cited_deployments_are_looked_up_before_lines_are_summed_up(spark):
    from catalog import corpus_tables as ct

    sf = "/root/testdata/sf0.001"
    ids = spark.sql("SELECT explode(array('DEP_000007', 'DEP_000123', 'DEP_000123', 'DEP_999999', null)) AS deployment_id")
    some, all_rows = ct.flagged(spark, sf, ids), ct.flagged(spark, sf)
    lines = [x for x in plan_text(some).splitlines() if "l_quantity" in x or "LeftSemi" in x]
    assert any("LeftSemi" in x for x in lines)
    want = all_rows.where("deployment_id IN ('DEP_000007', 'DEP_000123')").collect()
    assert sorted(map(str, some.collect())) == sorted(map(str, want)) and len(want) == 2
