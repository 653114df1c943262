"""Six-route evidence retrieval for all deployments at once.

Vector routes filter by vendor (and jump band) before scoring. Metadata routes never touch a
vector: what they return depends on a few columns only, so it is worked out once per distinct
combination and joined back to the deployments. The runbook route has no limit, so its hits are
not joined back: they stay one list for each vendor and device family, and who has which list is
kept beside them. Coverage, grading and assembly work on the lists; rows are made when asked for.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplens.functions import flags as fl
from shiplens.functions.embedding import Embedder, embedded, hashed_words
from shiplens.functions.narrative import query_text
from shiplens.operators.topk import filtered_topk
from shiplens.sources.scratch import materialise

EVIDENCE_TYPES = ["Postmortem", "Advisory", "RiskNote"]
# Routes in order with the most chunks each returns (runbooks: per document).
ROUTE_LIMITS = {
    "evidence": 5, "transition": 2, "cross_vendor": 2, "runbook": 2, "policy": 2, "matrix": 1,
}
VECTOR_ROUTES = ("evidence", "transition", "cross_vendor")
# As many characters as a keyword across a seam can have on one side of it.
EDGE = max(len(word) for words in fl.CORPUS_FLAG_WORDS.values() for word in words)
QUERY_COLUMNS = [
    "vendor_name", "device_type", "current_firmware", "target_firmware", "max_cvss_score",
    "site_criticality", "deployment_type", "transition_class",
    "cross_vendor_dependency_count", "active_flags",
]


def route_number(route: Column) -> Column:
    return reduce(
        lambda made, item: made.when(route == item[1], item[0]),
        list(enumerate(ROUTE_LIMITS))[1:], F.when(route == "evidence", 0),
    )


def prepare_chunks(chunks: DataFrame, embed: Embedder = hashed_words) -> DataFrame:
    """The searchable corpus, written once: chunk facts, flag mentions, vectors.

    Chunks carry their record's scope, so a document id that stands twice multiplies nothing.
    `flag_mask` has a bit per flag the chunk mentions. `edge` keeps both ends of the text,
    enough to see a keyword that only appears where two chunks are put side by side.
    """
    text = F.col("text")
    lowered = F.lower(text)
    searched = F.col("document_type").isin([*EVIDENCE_TYPES, "Transition", "CrossVendor"])
    facts = chunks.withColumns({
        "flag_mask": fl.mention_mask(text),
        "edge": F.concat(F.left(lowered, F.lit(EDGE)), F.lit("\u0000"),
                         F.right(lowered, F.lit(EDGE))),
    })
    return materialise(
        facts.withColumn("vector", embedded(F.when(searched, text), embed)), "corpus")


def _slot(route: str, *parts: Column) -> Column:
    return F.concat_ws("|", F.lit(route), *parts)


def vector_items(corpus: DataFrame) -> DataFrame:
    """(slot, item_id, vector): a chunk once per filter value it satisfies."""
    kind = F.col("document_type")
    per_vendor = F.transform("vendors", lambda v: F.when(
        kind.isin(EVIDENCE_TYPES), _slot("evidence", v)
    ).otherwise(_slot("transition", v, F.col("transition_class"))))
    slots = F.when(kind == "CrossVendor", F.array(
        _slot("cross_vendor", F.get("vendors", F.lit(0))))).otherwise(per_vendor)
    return corpus.where(F.col("vector").isNotNull()).select(
        F.explode(F.array_distinct(slots)).alias("slot"), F.col("chunk_id").alias("item_id"),
        "vector",
    )


def vector_queries(
    deployments: DataFrame, embed: Embedder = hashed_words, key: str = "deployment_id"
) -> DataFrame:
    """(query_id, slot, k, vector): one embedding per deployment for all its routes."""
    vendor = F.col("vendor_name")
    slots = F.array_compact(F.array(
        F.struct(_slot("evidence", vendor).alias("slot"),
                 F.lit(ROUTE_LIMITS["evidence"]).alias("k")),
        F.when(F.col("transition_class").isNotNull(), F.struct(
            _slot("transition", vendor, F.col("transition_class")).alias("slot"),
            F.lit(ROUTE_LIMITS["transition"]).alias("k"))),
        F.when(F.coalesce(F.col("cross_vendor_dependency_count") > 0, F.lit(False)), F.struct(
            _slot("cross_vendor", vendor).alias("slot"),
            F.lit(ROUTE_LIMITS["cross_vendor"]).alias("k"))),
    ))
    return deployments.where(vendor.isNotNull()).select(
        F.col(key).alias("query_id"), slots.alias("slots"),
        embedded(query_text(F.col("active_flags")), embed).alias("vector"),
    ).select("query_id", F.inline("slots"), "vector")


def _ranked(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    return df.withColumn(
        "rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def _runbook_hits(corpus: DataFrame) -> DataFrame:
    first = corpus.where(
        (F.col("document_type") == "Runbook")
        & (F.col("chunk_index") < ROUTE_LIMITS["runbook"])
    ).select(F.explode(F.array_distinct("vendors")).alias("vendor_name"),
             F.col("device_family").alias("device_type"), "doc_id", "chunk_index", "chunk_id")
    return _ranked(first, ["vendor_name", "device_type"], "doc_id", "chunk_index").withColumn(
        "score", F.lit(1.0))


def _policy_hits(corpus: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per (site_criticality, flags mask) the best policy chunks, rules before whole texts.

    Chunks with the same scope, kind and flags are interchangeable but for their place, so
    only the first few of each can ever be returned: at most a few thousand rows remain,
    against at most a few thousand distinct flag combinations.
    """
    limit = ROUTE_LIMITS["policy"]
    candidates = corpus.where(
        (F.col("document_type") == "Policy") & F.col("chunk_kind").isin("rule", "whole")
        & (F.col("flag_mask") != 0)
    ).select(F.col("site_criticality_scope").alias("site_criticality"), "chunk_kind",
             "flag_mask", "doc_id", "chunk_index", "chunk_id")
    few = _ranked(
        candidates, ["site_criticality", "chunk_kind", "flag_mask"], "doc_id", "chunk_index"
    ).where(F.col("rank") <= limit).drop("rank")
    matched = F.bit_count(F.col("flag_mask").bitwiseAND(F.col("flags")))
    scored = wanted.join(few, "site_criticality").withColumn("matched", matched).where(
        F.col("matched") > 0)
    return _ranked(
        scored, ["site_criticality", "flags"], F.col("chunk_kind") != "rule",
        F.desc("matched"), "doc_id", "chunk_index",
    ).where(F.col("rank") <= limit).select(
        "site_criticality", "flags", "rank", "chunk_id",
        F.col("matched").cast("double").alias("score"))


def _matrix_hits(corpus: DataFrame, vendors: DataFrame) -> DataFrame:
    """Per vendor the first matrix chunk whose text names it.

    The distinct vendor names, a closed vocabulary, are read as one array and tested per
    chunk, so no pair that does not match becomes a row.
    """
    names = vendors.agg(F.collect_set("vendor_name")).scalar()
    matrices = corpus.where(F.col("document_type") == "Matrix").withColumn("names", names)
    named = matrices.select(
        F.explode(F.filter("names", lambda v: F.contains(F.col("text"), v)))
        .alias("vendor_name"), "doc_id", "chunk_index", "chunk_id")
    return named.groupBy("vendor_name").agg(
        F.min_by("chunk_id", F.struct("doc_id", "chunk_index")).alias("chunk_id")
    ).withColumns({"rank": F.lit(1), "score": F.lit(1.0)})


#: What a runbook list is looked up by, and parts that the members of one key are dealt over.
LIST_KEYS = ["vendor_name", "device_type"]
DEALS = 64


@dataclass(frozen=True)
class Routed:
    """Hits of many queries. `direct` has (query_id, route, rank, chunk_id, score), a few rows a query;
    `lists` has (vendor_name, device_type, rank, chunk_id, score) of the runbook route once for each
    key; `members` has (query_id, vendor_name, device_type)."""

    direct: DataFrame
    lists: DataFrame
    members: DataFrame

    def rows(self, queries: DataFrame | None = None) -> DataFrame:
        """(query_id, route, rank, chunk_id, score), the lists written out; of the queries in
        `queries` (query_id) if given."""
        direct, members = self.direct, self.members
        if queries is not None:
            direct, members = (df.join(queries.select("query_id"), "query_id", "left_semi") for df in (direct, members))
        deal = F.pmod(F.xxhash64("query_id"), F.lit(DEALS)).cast("int")
        lists = self.lists.groupBy(*LIST_KEYS).agg(F.collect_list(F.struct("rank", "chunk_id")).alias("listed"))
        lists = lists.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1))))
        listed = members.withColumn("_deal", deal).join(lists.hint("merge"), [*LIST_KEYS, "_deal"]).select(
            "query_id", F.lit("runbook").alias("route"), F.inline("listed"), F.lit(1.0).alias("score")).select(
            "query_id", "route", "rank", "chunk_id", "score")
        return direct.unionByName(listed)

    def listed(self) -> DataFrame:
        """The members whose key has a list."""
        keys = self.lists.select(*LIST_KEYS).distinct()  # vendors times families of the corpus
        return self.members.join(F.broadcast(keys), LIST_KEYS, "left_semi")

    def written(self) -> Routed:
        """The same from the shared folder, for callers that read it several times."""
        return Routed(*(materialise(df, "hits") for df in (self.direct, self.lists, self.members)))


def route_all(
    deployments: DataFrame, corpus: DataFrame, embed: Embedder = hashed_words, *,
    key: str = "deployment_id", routes: tuple[str, ...] = tuple(ROUTE_LIMITS), written: bool = False, **topk,
) -> Routed:
    """The hits of every deployment row.

    The columns the routes read are written once, unless the rows are `written` already: each route is a pass
    of its own.
    """
    if not written:
        asked = deployments.select(key, *QUERY_COLUMNS).repartition(key)  # embedding is the costly part
        deployments = materialise(asked, "asked")
    base = deployments.select(
        F.col(key).alias("query_id"), *LIST_KEYS, "site_criticality",
        fl.flags_mask(F.col("active_flags")).alias("flags"))
    found = [base.where("false").select("query_id", F.lit("").alias("route"), F.lit(0).alias("rank"),
                                        F.lit("").alias("chunk_id"), F.lit(0.0).alias("score"))]
    vector_routes = [r for r in routes if r in VECTOR_ROUTES]
    if vector_routes:
        route = F.substring_index("slot", "|", 1)
        queries = vector_queries(deployments, embed, key).where(route.isin(vector_routes))
        items = vector_items(corpus).where(route.isin(vector_routes))
        found.append(filtered_topk(queries, items, **topk).select(
            "query_id", route.alias("route"), "rank", F.col("item_id").alias("chunk_id"),
            "score"))

    def looked_up(name: str, hits: DataFrame, keys: list[str]) -> DataFrame:
        # a few rows for each flag set or vendor, sent to the deployments, never the other way round
        return base.select("query_id", *keys).join(F.broadcast(hits), keys).select(
            "query_id", F.lit(name).alias("route"), "rank", "chunk_id", "score")

    if "policy" in routes:
        wanted = base.where("flags != 0").select("site_criticality", "flags").distinct()
        found.append(looked_up(
            "policy", _policy_hits(corpus, wanted), ["site_criticality", "flags"]))
    if "matrix" in routes:
        vendors = base.select("vendor_name").where("vendor_name is not null").distinct()
        found.append(looked_up("matrix", _matrix_hits(corpus, vendors), ["vendor_name"]))
    lists = _runbook_hits(corpus).select(*LIST_KEYS, "rank", "chunk_id", "score")
    return Routed(
        reduce(DataFrame.unionByName, found), lists if "runbook" in routes else lists.where("false"),
        base.select("query_id", *LIST_KEYS))


def retrieve(deployments: DataFrame, corpus: DataFrame, embed: Embedder = hashed_words, **options) -> DataFrame:
    """(query_id, route, rank, chunk_id, score) for every deployment row; options as for `route_all`."""
    return route_all(deployments, corpus, embed, **options).rows()


def with_chunks(hits: DataFrame, corpus: DataFrame, columns: list[str]) -> DataFrame:
    return hits.join(corpus.select("chunk_id", *columns).hint("merge"), "chunk_id")


def assemble(hits: DataFrame) -> DataFrame:
    """Hits deduplicated across routes, first occurrence kept, numbered per query."""
    place = F.struct(route_number(F.col("route")).alias("n"), F.col("rank"))
    first = hits.groupBy("query_id", "chunk_id").agg(
        F.min_by(F.struct("route", "rank", "score"), place).alias("h"))
    flat = first.select("query_id", "chunk_id", "h.*")
    return _ranked(
        flat.withColumnRenamed("rank", "route_rank"), ["query_id"],
        route_number(F.col("route")), "route_rank", "chunk_id",
    ).withColumnRenamed("rank", "evidence_no")


def _entries(numbered: DataFrame, corpus: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the entries in order: `items` (chunk_id, doc_id) and `said`, each text without its number.

    They are put together apart, so that no text is carried where only ids are asked for.
    """
    place = ["evidence_no", "chunk_id", "doc_id"]
    names = materialise(corpus.select("chunk_id", "doc_id"), "names")
    items = numbered.join(names, "chunk_id").groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(*place))).alias("items"))
    said = F.concat(
        F.lit("] "), F.col("doc_id"), F.lit(" ("), F.col("document_type"), F.lit(", "), F.col("route"), F.lit(")\n"),
        F.col("text"))
    texts = with_chunks(numbered, corpus, ["doc_id", "document_type", "text"]).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(*place, said.alias("said"))))["said"].alias("said"))
    return items.join(texts.hint("merge"), keys, "left")


def _spelled(items: Column, before: Column) -> Column:
    """The entries' texts, numbered on from `before`."""
    return F.transform(items, lambda x, i: F.concat(
        F.lit("[Evidence "), (before + i + 1).cast("string"), x))


def block_parts(hits: Routed, corpus: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(query_id, items, said, before, list_key) of each query that has evidence, and the runbook lists as
    pieces of text: (list_key, listed, list_ids, list_documents, list_text).

    Runbook chunks are in no other route, and stand between the routes before and after theirs. So a
    list is put together once for each key and number of entries before it, nine at most for a query
    of its own id, and each query takes its list as one piece of text. Hits are read twice.
    """
    runbook = list(ROUTE_LIMITS).index("runbook")
    before = F.count_if(route_number(F.col("route")) < runbook).over(Window.partitionBy("query_id"))
    # dealt by query once: what follows keeps each query's hits together
    direct = assemble(hits.direct.repartition("query_id")).withColumn("before", before.cast("int"))
    own = _entries(direct, corpus, ["query_id", "before"])
    asked = hits.listed().select("query_id", *LIST_KEYS)
    parts = own.join(asked.hint("merge"), "query_id", "full").withColumns({
        "before": F.coalesce("before", F.lit(0)),
        **{c: F.coalesce(c, F.array().cast(own.schema[c].dataType)) for c in ("items", "said")},
    }).select("query_id", "items", "said", "before", F.when(
        F.col(LIST_KEYS[0]).isNotNull(), F.struct(*LIST_KEYS, "before")).alias("list_key"))
    first = hits.lists.groupBy(*LIST_KEYS, "chunk_id").agg(F.min("rank").alias("evidence_no"))
    lists = _entries(first.withColumn("route", F.lit("runbook")), corpus, LIST_KEYS)
    numbers = direct.groupBy("query_id").agg(F.max("before").alias("before"))
    wanted = asked.join(numbers.hint("merge"), "query_id", "left").select(
        *LIST_KEYS, F.coalesce("before", F.lit(0)).alias("before")).distinct()
    pieces = lists.join(F.broadcast(wanted), LIST_KEYS).select(
        F.struct(*LIST_KEYS, "before").alias("list_key"), F.size("items").alias("listed"),
        F.col("items.chunk_id").alias("list_ids"), F.array_distinct("items.doc_id").alias("list_documents"),
        F.array_join(_spelled(F.col("said"), F.col("before")), "\n\n").alias("list_text"))
    return parts, pieces


def with_blocks(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """`rows`, which hold the columns of `block_parts` or nulls, with evidence_ids, document_ids and block.

    The pieces come last: a list is as long as the corpus makes it, so what holds it isn't shuffled again.
    """
    kept = [c for c in rows.columns if c not in ("items", "said", "before", "list_key")]
    joined = rows.join(pieces.hint("merge"), "list_key", "left")
    empty, found = F.array().cast("array<string>"), F.col("items").isNotNull()
    list_ids, documents = F.coalesce("list_ids", empty), F.coalesce("list_documents", empty)

    def halves(name: str) -> tuple[Column, Column]:
        return F.slice(name, F.lit(1), F.col("before")), F.slice(
            name, F.col("before") + 1, F.greatest(F.size(name) - F.col("before"), F.lit(0)))

    early, late = halves("items")
    first, last = halves("said")
    texts = F.concat(
        _spelled(first, F.lit(0)), F.array_compact(F.array("list_text")),
        _spelled(last, F.col("before") + F.coalesce("listed", F.lit(0))))
    return joined.select(
        *kept, F.when(found, F.concat(early["chunk_id"], list_ids, late["chunk_id"])).alias("evidence_ids"),
        F.when(found, F.array_sort(F.array_union("items.doc_id", documents))).alias("document_ids"),
        F.when(found, F.array_join(texts, "\n\n")).alias("block"))


def evidence_blocks(hits: Routed, corpus: DataFrame) -> DataFrame:
    """(query_id, evidence_ids, document_ids, block): the numbered evidence per query."""
    return with_blocks(*block_parts(hits, corpus))
