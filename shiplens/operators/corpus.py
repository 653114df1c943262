"""The evidence corpus as tables: manifest facts, record lint, corpus lint, gold checks.

Every rule is a column expression; violations come out as rows (filename, rule, detail).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.functions.values import content_hash


@dataclass(frozen=True)
class CorpusContract:
    """Closed vocabularies and id formats. Fixed values of the evidence corpus."""

    document_types: tuple[tuple[str, str], ...] = (
        ("Postmortem", "vector"), ("Advisory", "hybrid"), ("RiskNote", "vector"),
        ("Runbook", "vectorless"), ("Policy", "vectorless"), ("Matrix", "vectorless"),
        ("Transition", "hybrid"), ("CrossVendor", "vector"), ("META", "always"),
    )
    vendors: tuple[str, ...] = ("Cisco", "Honeywell", "Schneider", "Siemens")
    families: tuple[str, ...] = ("PLC", "HMI", "RTU", "Switch", "Gateway", "Controller")
    strengths: tuple[str, ...] = ("HIGH", "MEDIUM", "LOW")
    provenances: tuple[str, ...] = ("internal_derived", "external_sourced")
    bands: tuple[str, ...] = ("major", "extreme")
    scopes: tuple[str, ...] = ("HIGH", "MEDIUM", "LOW")
    device_scoped: tuple[str, ...] = ("Postmortem", "Advisory", "RiskNote", "Runbook")
    doc_id: str = r"FG-DOC-\d{3}"
    meta_doc_id: str = "FG-DOC-000"
    deployment_ref: str = r"\bDEP_\d+"
    valid_deployment_ref: str = r"^DEP_\d{6}$"
    upcoming_ref: str = r"\bUPC_\d+"
    #: The product whose name begins a page's footer; without one no such line is taken for a footer.
    product: str | None = None

    @property
    def type_names(self) -> list[str]:
        return [name for name, _ in self.document_types]


CORPUS = CorpusContract()
# The fields of a manifest record.
MANIFEST_FIELDS = [
    "doc_id", "filename", "source_format", "document_type", "retrieval_mode", "vendor",
    "vendors", "device_family", "transition_class", "site_criticality_scope",
    "evidence_strength", "provenance", "source_deployment_ids", "malformed_refs", "sha256",
]


def named_field(text: Column, name: str, values: tuple[str, ...]) -> Column:
    """First value of a named field in any layout: table, bold, colon or plain."""
    found = F.regexp_extract(text, rf"(?U){name}[\s|:*]+({'|'.join(values)})\b", 1)
    return F.when(found != "", found)


def references(text: Column, pattern: str) -> Column:
    """Distinct matches, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))


def manifest(documents: DataFrame, contract: CorpusContract = CORPUS) -> DataFrame:
    """(filename, text) -> one record per document, plus `text` for later steps."""
    c = contract
    text = F.col("text")
    stem = F.regexp_replace("filename", r"(?<=.)\.[^.]*$", "")
    parts = F.split(stem, "_")
    kind = F.col("document_type")
    modes = F.create_map(*[F.lit(x) for pair in c.document_types for x in pair])
    facts = documents.select(
        "filename", "text", parts.alias("parts"), F.get(parts, F.lit(0)).alias("document_type"),
        references(text, c.deployment_ref).alias("refs"),
    )
    return facts.select(
        F.when(kind == "META", c.meta_doc_id)
        .otherwise(F.element_at("parts", -1)).alias("doc_id"),
        "filename",
        F.regexp_extract("filename", r".\.([^.]*)$", 1).alias("source_format"),
        kind,
        F.try_element_at(modes, kind).alias("retrieval_mode"),
        F.when(kind.isin("Policy", "Matrix", "META"), F.array().cast("array<string>"))
        .when(kind == "CrossVendor", F.array(F.get("parts", F.lit(1)), F.get("parts", F.lit(3))))
        .otherwise(F.array(F.get("parts", F.lit(1)))).alias("vendors"),
        F.when(kind.isin(*c.device_scoped), F.get("parts", F.lit(2))).alias("device_family"),
        F.when(kind == "Transition", F.get("parts", F.lit(2))).alias("transition_class"),
        F.when(kind == "Policy", named_field(text, "Site Criticality Scope", c.scopes))
        .alias("site_criticality_scope"),
        named_field(text, "Evidence Strength", c.strengths).alias("evidence_strength"),
        F.lit("internal_derived").alias("provenance"),
        F.filter("refs", lambda r: r.rlike(c.valid_deployment_ref))
        .alias("source_deployment_ids"),
        F.filter("refs", lambda r: ~r.rlike(c.valid_deployment_ref)).alias("malformed_refs"),
        content_hash(text).alias("sha256"), "text",
    ).withColumn(
        "vendor",
        F.when(F.size("vendors") == 0, "vendor-neutral")
        .when(F.size("vendors") > 1, "cross-vendor").otherwise(F.get("vendors", F.lit(0))),
    ).select(*MANIFEST_FIELDS, "text")


def _shown(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("none"))


def record_problems(
    reviewed: DataFrame, documents: DataFrame, contract: CorpusContract = CORPUS
) -> DataFrame:
    """(filename, rule, detail) for every rule a reviewed record or its document breaks.

    What a rule needs of a text is worked out beside the text, so that records meet narrow rows in
    one join on the file name; everything after it is a projection.
    """
    c = contract
    text = F.col("text")
    derived = manifest(documents, c).withColumns({
        "body_id": F.regexp_extract(text, c.doc_id, 0),
        "body_vendor": named_field(text, "Vendor", c.vendors),
        "body_family": named_field(text, "Device Family", c.families),
        "category": named_field(text, "Transition Category", ("Major", "Extreme")),
        "pair": F.array(named_field(text, "Primary Vendor", c.vendors),
                        named_field(text, "Dependent Vendor", c.vendors)),
        "upcoming": references(text, c.upcoming_ref),
    }).drop("text")
    both = reviewed.select(
        "filename", *[F.col(f).alias(f"r_{f}") for f in MANIFEST_FIELDS if f != "filename"]
    ).join(derived, "filename")

    def record(name: str) -> Column:
        return F.col(f"r_{name}")

    def outside(value: Column, allowed) -> Column:
        return ~F.coalesce(value.isin(list(allowed)), F.lit(False))

    kind, vendors = record("document_type"), record("vendors")
    body_id, body_vendor, body_family = F.col("body_id"), F.col("body_vendor"), F.col("body_family")
    category, pair, upcoming = F.col("category"), F.col("pair"), F.col("upcoming")
    rules = {
        "unknown_document_type": (outside(kind, c.type_names), kind),
        "bad_doc_id": (~F.coalesce(record("doc_id").rlike(f"^({c.doc_id})$"), F.lit(False)),
                       record("doc_id")),
        "unknown_provenance": (outside(record("provenance"), c.provenances),
                               record("provenance")),
        "missing_evidence_strength": (
            ~kind.eqNullSafe(F.lit("META"))
            & outside(record("evidence_strength"), c.strengths), record("evidence_strength")),
        "unknown_vendor": (F.exists(vendors, lambda v: outside(v, c.vendors)),
                           F.array_join(vendors, ",", "none")),
        "unknown_device_family": (
            record("device_family").isNotNull() & outside(record("device_family"), c.families),
            record("device_family")),
        "unknown_transition_class": (
            record("transition_class").isNotNull()
            & outside(record("transition_class"), c.bands), record("transition_class")),
        "policy_without_scope": (
            (kind == "Policy") & outside(record("site_criticality_scope"), c.scopes),
            record("site_criticality_scope")),
        "content_changed": (~record("sha256").eqNullSafe(F.col("sha256")), F.lit("sha256")),
        **{
            f"differs:{f}": (~record(f).eqNullSafe(F.col(f)), F.concat(
                _shown(record(f)), F.lit(" but document says "), _shown(F.col(f))))
            for f in MANIFEST_FIELDS if f not in ("filename", "sha256")
        },
        "body_id_disagrees": (
            ~kind.eqNullSafe(F.lit("META")) & ~body_id.eqNullSafe(record("doc_id")), body_id),
        "body_vendor_disagrees": (
            (F.size(vendors) == 1) & ~body_vendor.eqNullSafe(F.get(vendors, F.lit(0))),
            body_vendor),
        "body_vendor_pair_disagrees": (
            (kind == "CrossVendor") & ~pair.eqNullSafe(vendors),
            F.array_join(pair, ",", "none")),
        "body_family_disagrees": (
            body_family.isNotNull() & ~body_family.eqNullSafe(record("device_family")),
            body_family),
        "body_transition_disagrees": (
            (kind == "Transition")
            & ~F.lower(category).eqNullSafe(record("transition_class")), category),
        "references_upcoming": (F.size(upcoming) > 0, F.array_join(upcoming, ",")),
    }
    found = F.array_compact(F.array(*[
        F.when(F.coalesce(broken, F.lit(False)),
               F.struct(F.lit(rule).alias("rule"), _shown(detail).alias("detail")))
        for rule, (broken, detail) in rules.items()
    ]))
    return both.select("filename", F.inline(found))


def presence_problems(
    files: DataFrame, reviewed: DataFrame, index: DataFrame
) -> DataFrame:
    """File names not in all of directory, manifest and index: one union, one grouping."""
    marks = None
    for place, df in (("directory", files), ("manifest", reviewed), ("index", index)):
        part = df.select("filename", F.lit(place).alias("place"))
        marks = part if marks is None else marks.unionByName(part)
    seen = marks.groupBy("filename").agg(*[
        F.bool_or(F.col("place") == p).alias(p) for p in ("directory", "manifest", "index")
    ])
    wrong = F.array_compact(F.array(
        F.when(F.col("directory") != F.col("manifest"), F.struct(
            F.lit("presence").alias("rule"),
            F.when(F.col("manifest"), "manifest only").otherwise("directory only")
            .alias("detail"))),
        F.when(F.col("directory") != F.col("index"), F.struct(
            F.lit("index").alias("rule"),
            F.when(F.col("index"), "index only").otherwise("directory only").alias("detail"))),
    ))
    return seen.select("filename", F.inline(wrong))


def duplicate_doc_ids(reviewed: DataFrame) -> DataFrame:
    return reviewed.groupBy("doc_id").agg(F.count("*").alias("documents")).where(
        F.col("documents") > 1
    )


def strength_totals(
    reviewed: DataFrame, documents: DataFrame, contract: CorpusContract = CORPUS
) -> DataFrame:
    """(strength, claimed, carried): the META table's claims against the documents."""
    level = "|".join(contract.strengths)
    row = rf"\|\s*(?:{level})\s*\|[^|\n]*\|\s*\d+\s*\|"
    meta = documents.where(F.col("filename").startswith("META"))
    rows = meta.select(F.explode(F.regexp_extract_all("text", F.lit(row), F.lit(0))).alias("row"))
    claims = rows.select(
        F.regexp_extract("row", rf"\|\s*({level})\s*\|", 1).alias("strength"),
        F.regexp_extract("row", r"(\d+)\s*\|$", 1).cast("bigint").alias("claimed"),
        F.lit(0).cast("bigint").alias("carried"),
    )
    carried = reviewed.where(F.col("evidence_strength").isNotNull()).select(
        F.col("evidence_strength").alias("strength"), F.lit(0).cast("bigint").alias("claimed"),
        F.lit(1).cast("bigint").alias("carried"),
    )
    levels = documents.sparkSession.createDataFrame(
        [(s, 0, 0) for s in contract.strengths], "strength string, claimed long, carried long"
    )
    return levels.unionByName(claims).unionByName(carried).groupBy("strength").agg(
        F.sum("claimed").alias("claimed"), F.sum("carried").alias("carried")
    )


def unresolved_refs(reviewed: DataFrame, history: DataFrame) -> DataFrame:
    """(filename, deployment_id): cited ids the history does not hold."""
    cited = reviewed.select("filename", F.explode("source_deployment_ids").alias("deployment_id"))
    return cited.join(history.select("deployment_id"), "deployment_id", "left_anti")


def gold_consistency(reviewed: DataFrame, history: DataFrame) -> DataFrame:
    """Per document: citations, resolved ones, and how often vendor and family agree."""
    cited = reviewed.select(
        "filename", "doc_id", "document_type", "vendors", "device_family",
        F.explode_outer("source_deployment_ids").alias("deployment_id"),
    )
    rows = history.select("deployment_id", "vendor_name", "device_type")
    joined = cited.join(rows.withColumn("found", F.lit(True)), "deployment_id", "left")
    same_vendor = F.coalesce(F.array_contains("vendors", F.col("vendor_name")), F.lit(False))
    same_family = F.coalesce(F.col("device_type") == F.col("device_family"), F.lit(False))
    found = F.col("found")
    return joined.groupBy("filename", "doc_id", "document_type").agg(
        F.count("deployment_id").alias("cited"), F.count_if(found).alias("resolved"),
        F.avg(F.when(found & (F.size("vendors") > 0), same_vendor.cast("int")))
        .alias("vendor_match"),
        F.avg(F.when(found & F.col("device_family").isNotNull(), same_family.cast("int")))
        .alias("family_match"),
    )


def gold_by_type(consistency: DataFrame) -> DataFrame:
    return consistency.groupBy("document_type").agg(
        F.count("*").alias("documents"), F.sum("cited").alias("cited"),
        F.sum("resolved").alias("resolved"), F.avg("vendor_match").alias("vendor_match"),
        F.avg("family_match").alias("family_match"),
    )
