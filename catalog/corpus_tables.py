"""An evidence corpus made of the documents table: names, metadata layouts and structure.

Every document keeps its whole text. Its number decides its type, vendor, layout and the
structure its lines are given, so that every rule and strategy meets real work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.tables import deployments, table
from shiplens.functions import flags as fl
from shiplens.functions.versions import jump_band
from shiplens.operators import chunking, corpus

VENDORS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
FAMILIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
KINDS = ("Postmortem", "Advisory", "RiskNote", "Runbook", "Policy", "Matrix",
         "Transition", "CrossVendor")
WORDS = ("kernel_touched", "bootloader_touched", "protocol mismatch", "cvss",
         "high criticality", "maintenance window", "repeat failure", "tier 1",
         "emergency", "version jump")
CONTRACT = corpus.CorpusContract(
    vendors=VENDORS, families=FAMILIES, doc_id=r"KB-\d{3,}", meta_doc_id="KB-000",
    valid_deployment_ref=r"^DEP_\d{6,}$",
)


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(filename, text)."""
    d = F.col("doc_id")
    step, family_step = F.floor(d / 8), F.floor(d / 40)
    kind = F.when(d == 8, "META").otherwise(_pick(KINDS, d % 8))
    vendor, other = _pick(VENDORS, step % 5), _pick(VENDORS, (step + 1) % 5)
    family, band = _pick(FAMILIES, family_step % 6), family_step % 2
    number = F.format_string("KB-%03d", d + 1)
    base = table(spark, sf_dir, "documents").select(
        "doc_id", "text", kind.alias("kind"), vendor.alias("vendor"), other.alias("other"),
        family.alias("family"), number.alias("number"),
        _pick(("major", "extreme"), band).alias("band"),
        _pick(("Major", "Extreme"), band).alias("category"),
        _pick(("HIGH", "MEDIUM", "LOW"), step % 3).alias("scope"),
        F.when(d % 37 != 0, _pick(("HIGH", "MEDIUM", "LOW"), d % 3)).alias("strength"),
        (step % 4).cast("int").alias("layout"),
    )
    kind = F.col("kind")
    scoped = kind.isin("Postmortem", "Advisory", "RiskNote", "Runbook")
    fields = [
        ("Document ID", F.when(kind != "META", F.col("number"))),
        ("Vendor", F.when(scoped | (kind == "Transition"), F.when(
            d % 29 == 0, F.col("other")).otherwise(F.col("vendor")))),
        ("Device Family", F.when(scoped, F.col("family"))),
        ("Primary Vendor", F.when(kind == "CrossVendor", F.col("vendor"))),
        ("Dependent Vendor", F.when(kind == "CrossVendor", F.col("other"))),
        ("Transition Category", F.when(kind == "Transition", F.col("category"))),
        ("Site Criticality Scope", F.when(kind == "Policy", F.col("scope"))),
        ("Evidence Strength", F.when(kind != "META", F.col("strength"))),
    ]
    before = _pick(("| ", "**", "", ""), F.col("layout"))
    between = _pick((" | ", ":** ", ": ", " "), F.col("layout"))
    after = _pick((" |", "", "", ""), F.col("layout"))
    header = F.concat_ws(
        "\n", F.concat(F.lit("# "), kind, F.lit(" report "), d.cast("string"), F.lit("\n")),
        F.when(F.col("layout") == 0, "| Field | Value |\n|---|---|"),
        *[F.concat(before, F.lit(n), between, v, after) for n, v in fields],
    )
    cited = F.concat(
        F.lit("Observed with "), _pick(WORDS, d % 10), F.lit(" and "),
        _pick(WORDS, F.floor(d / 10) % 10), F.lit(".\n"),
        F.format_string("Cited records DEP_%06d, DEP_%06d and DEP_%d.", d * 13,
                        F.when(d % 19 == 0, d + 900_000_000).otherwise(d * 13 + 5), d % 1000),
        F.when(d % 31 == 0, " See UPC_12.").otherwise(""),
        F.when(kind == "Matrix", F.concat(F.lit(" Covers "), F.col("vendor"), F.lit(".")))
        .otherwise(""),
        F.when(kind == "META", "\n| HIGH | 100+ records | 330 |\n| LOW | 5+ records | 7 |")
        .otherwise(""),
    )
    lines = F.split("text", "\n")
    last = F.size(lines) - 1

    def section(x: Column, i: Column) -> Column:
        return F.concat(F.lit("## Section "), i.cast("string"), F.lit("\n"), x)

    structured = {
        "headed": F.transform(lines, lambda x, i: F.when(i % 3 == 0, section(x, i)).otherwise(x)),
        "Advisory": F.transform(
            lines, lambda x, i: F.when(i % 3 == 0, section(x, i)).when(i % 3 == 1, F.concat(
                x, F.lit("\n| Metric | Value |\n|---|---|\n| line | "), i.cast("string"),
                F.lit(" |"))).otherwise(F.concat(F.lit("\n"), x))),
        "RiskNote": F.transform(lines, lambda x: F.concat(x, F.lit("\n"))),
        "Runbook": F.transform(lines, lambda x, i: F.when(i % 6 == 0, F.concat(
            F.lit("## Stage "), i.cast("string"), F.lit("\n"), x)).otherwise(
            F.concat((i % 6).cast("string"), F.lit(". "), x))),
        "Policy": F.transform(lines, lambda x, i: F.when(i == last, F.concat(
            F.lit("\n## Exception Process\n"), x)).otherwise(
            F.concat((i + 1).cast("string"), F.lit(". "), x))),
    }
    body = F.when(kind.isin("Postmortem", "Transition", "CrossVendor"), structured["headed"])
    for name in ("Advisory", "RiskNote", "Runbook", "Policy"):
        body = body.when(kind == name, structured[name])
    rules = F.when(kind == "Policy", F.when(step % 5 == 4, "## Rules\n")
                   .otherwise("## Mandatory Rules\n")).otherwise("")
    footer = F.when(d % 2 == 0, "\n---\n*Generated from the event history*").otherwise("")
    name = F.concat(
        kind, F.lit("_"),
        F.when(scoped, F.concat(F.col("vendor"), F.lit("_"), F.col("family"), F.lit("_")))
        .when(kind == "CrossVendor", F.concat("vendor", F.lit("_to_"), "other", F.lit("_")))
        .when(kind == "Transition", F.concat("vendor", F.lit("_"), "band", F.lit("_")))
        .otherwise("Topic_"),
        "number", F.lit(".md"))
    return base.select(
        name.alias("filename"),
        F.concat(header, F.lit("\n\n"), cited, F.lit("\n\n"), rules,
                 F.array_join(body.otherwise(lines), "\n"), footer).alias("text"),
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.manifest(documents(spark, sf_dir), CONTRACT)


def reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest as reviewed earlier: some records since outdated, some missing."""
    n = F.regexp_extract("filename", r"(\d+)\.md$", 1).cast("bigint")
    return manifest(spark, sf_dir).drop("text").where(n % 53 != 0).withColumns({
        "evidence_strength": F.when(n % 43 == 0, "UNRATED").otherwise(F.col("evidence_strength")),
        "sha256": F.when(n % 47 == 0, "0").otherwise(F.col("sha256")),
        "provenance": F.when(n % 59 == 0, "hearsay").otherwise(F.col("provenance")),
    })


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunk(manifest(spark, sf_dir))


QUERY_INPUTS = (
    "deployment_id", "vendor_name", "device_type", "current_firmware", "target_firmware",
    "max_cvss_score", "site_criticality", "deployment_type", "version_jump_magnitude",
    "cross_vendor_dependency_count", "kernel_touched", "bootloader_touched",
    "protocol_mismatch_flag", "maintenance_window", "past_failure_count", "fleet_tier",
    "network_stress_score", "deployment_outcome",
)


def flagged(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    """Deployments, of the ids in `only` if given, with `active_flags` and `transition_class`, as retrieval
    takes them."""
    return deployments(spark, sf_dir, QUERY_INPUTS, only).withColumns({
        "active_flags": fl.raised(fl.corpus_flag_conditions()),
        "transition_class": jump_band(F.col("version_jump_magnitude")),
    })
