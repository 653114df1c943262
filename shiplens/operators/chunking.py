"""Split each document type along its own structure, without a shuffle.

A document is one row, and its lines are an array in that row, so every strategy is an
array expression: the whole corpus is chunked in one narrow pass inside the JVM. A strategy
takes the cleaned lines and returns ARRAY<STRUCT<kind, text>>; register more in STRATEGIES.
A strategy that finds none of its structure returns the document as one `whole` chunk.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.functions.values import WHITESPACE as WS
from shiplens.functions.values import is_blank, strip, token_estimate

SEPARATOR = rf"^[{WS}]*-{{3,}}[{WS}]*\z"
ITALIC = rf"(?s)^[{WS}]*([*_])[^*_].*\1[{WS}]*\z"
# How the footers a page repeats begin, and what follows a product's name in one.
PAGE_FOOTER = (
    r"^(Source: \d+ historical|Do not reference this document|"
    r"Policy informed by|Vectorless retrieval target)"
)
PRODUCT_FOOTER = " AI RAG Knowledge Base"
STEP = rf"^[{WS}]*(\d+)\.[{WS}]+"
TABLE_ROW = rf"^[{WS}]*\|"
TABLE_RULE = rf"^[{WS}]*\|[{WS}:|-]+\|[{WS}]*\z"
HEADING = rf"^[{WS}]*#"
SECTION = "## "
NOTE_TOKENS = (300, 700)
STEPS_PER_CHUNK = 4
MAX_DEVIATION = 0.5
BLOCK = 128
WHOLE_BY_DESIGN = ("Matrix", "META")
HEADED = ("Postmortem", "Transition", "CrossVendor")

CHUNKS = "array<struct<kind:string,text:string>>"


def page_footer(product: str | None = None) -> str:
    """The pattern of page footers; with `product`, the lines that begin with its name are among them."""
    if product is None:
        return PAGE_FOOTER
    return f"{PAGE_FOOTER}|^{re.escape(product + PRODUCT_FOOTER)}"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it by name inside `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _where(items: Column, test: Callable[[Column, Column], Column]) -> Column:
    """Positions, from 0, at which the test holds."""
    return F.array_compact(F.transform(items, lambda x, i: F.when(test(x, i), i)))


def _spans(items: Column, starts: Column) -> Column:
    """The slices of `items` from each start up to the next."""
    return F.transform(starts, lambda s, j: F.slice(
        items, s + 1, F.coalesce(F.get(starts, j + 1), F.size(items)) - s))


def _states(items: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """State after each item, one entry per item.

    A growing array is copied at every step, so items are taken in blocks: what is copied is a
    block's states and the list of blocks, and the time grows with the items, not their square.
    """
    def along(block: Column, before: Column) -> Column:
        run = F.aggregate(
            block, F.array(before),
            lambda done, x: F.concat(done, F.array(step(F.element_at(done, -1), x))),
        )
        return F.slice(run, F.lit(2), F.size(block))

    def blocks(held: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(held) - 1, F.lit(0)), F.lit(BLOCK))
        made = F.aggregate(
            starts, F.array(F.array(zero)),
            lambda done, at: F.concat(done, F.array(along(
                F.slice(held, at + 1, F.lit(BLOCK)), F.element_at(F.element_at(done, -1), -1)))),
        )
        return F.flatten(F.slice(made, F.lit(2), F.size(starts)))

    return _let(items, blocks)


def _joined(lines: Column) -> Column:
    return strip(F.array_join(lines, "\n"))


def _chunk(kind: str | Column, text: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(kind.alias("kind"), text.alias("text"))


def _is_body(line: Column) -> Column:
    return ~is_blank(line) & ~line.rlike(HEADING)


def clean_lines(text: Column, footer: str = PAGE_FOOTER) -> Column:
    """Lines without separators, page footers and a closing italic block."""
    lines = F.split(F.replace(text, F.lit("\r\n"), F.lit("\n")), "\n")

    def cut(lines: Column) -> Column:
        last = F.array_max(_where(lines, lambda x, i: x.rlike(SEPARATOR)))

        def tail(last: Column) -> Column:
            rest = F.filter(F.slice(lines, last + 2, F.size(lines)), lambda x: ~is_blank(x))
            closing = (F.size(rest) > 0) & F.forall(rest, lambda x: x.rlike(ITALIC))
            return F.when(closing, F.slice(lines, F.lit(1), last)).otherwise(lines)

        return F.when(last.isNull(), lines).otherwise(_let(F.coalesce(last, F.lit(0)), tail))

    return F.filter(
        _let(lines, cut), lambda x: ~x.rlike(SEPARATOR) & ~strip(x).rlike(footer)
    )


def sections(lines: Column) -> Column:
    """Sections at `## `; a section of headings only joins the next, the last the previous."""

    def fold(raw: Column) -> Column:
        return _let(F.transform(raw, lambda s: F.exists(s, _is_body)), lambda full: _let(
            _where(raw, lambda s, j: (j == 0) | F.get(full, j - 1)),
            lambda starts: _let(
                F.when(
                    (F.size(starts) > 1) & ~F.exists(
                        F.slice(full, F.element_at(starts, -1) + 1, F.size(full)),
                        lambda f: f),
                    F.slice(starts, F.lit(1), F.size(starts) - 1),
                ).otherwise(starts),
                lambda kept: F.transform(_spans(raw, kept), F.flatten),
            ),
        ))

    starts = _where(lines, lambda x, i: (i == 0) | x.startswith(SECTION))
    return _let(starts, lambda s: _let(_spans(lines, s), lambda raw: F.when(
        F.size(raw) > 0, fold(raw)).otherwise(raw)))


def whole(lines: Column) -> Column:
    return F.array(_chunk("whole", _joined(lines)))


def by_heading(lines: Column) -> Column:
    return _let(sections(lines), lambda found: F.when(F.size(found) < 2, whole(lines)).otherwise(
        F.transform(found, lambda s: _chunk("prose", _joined(s)))))


def advisory(lines: Column) -> Column:
    """Tables whole, prose by paragraph, each under its section's heading lines."""

    def is_row(line: Column) -> Column:
        return line.rlike(TABLE_ROW)

    def runs(heading: Column, body: Column) -> Column:
        starts = _where(body, lambda x, i: ~is_blank(x) & (
            (i == 0) | is_blank(F.get(body, i - 1))
            | (is_row(x) != is_row(F.get(body, i - 1)))))
        return _let(starts, lambda s: F.transform(_spans(body, s), lambda span: _let(
            F.filter(span, lambda x: ~is_blank(x)),
            lambda run: _chunk(
                F.when(is_row(F.get(run, F.lit(0))), "table").otherwise("prose"),
                strip(F.concat(heading, F.lit("\n\n"), F.array_join(run, "\n")))),
        )))

    def split(section: Column) -> Column:
        first = F.array_min(_where(section, lambda x, i: _is_body(x)))
        return _let(F.coalesce(first, F.size(section)), lambda at: _let(
            F.slice(section, at + 1, F.size(section)),
            lambda body: runs(_joined(F.slice(section, F.lit(1), at)), body)))

    return _let(sections(lines), lambda found: F.when(F.size(found) < 2, whole(lines)).otherwise(
        F.flatten(F.transform(found, split))))


def risk_note(lines: Column) -> Column:
    """Paragraphs in the fewest groups that fit, each aiming at an equal share of tokens."""

    def groups(paragraphs: Column) -> Column:
        sizes = F.transform(paragraphs, token_estimate)
        total = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, x: a + x)

        def assign(sizes: Column, total: Column) -> Column:
            count = F.greatest(F.ceil(total / F.lit(NOTE_TOKENS[1])), F.lit(1)).cast("bigint")
            share = total / count
            zero = F.struct(F.lit(0).cast("bigint").alias("done"),
                            F.lit(0).cast("bigint").alias("group"))

            def step(state: Column, size: Column) -> Column:
                full = (state["group"] < count) & (
                    state["done"] + size / F.lit(2) > share * state["group"])
                return F.struct(
                    (state["done"] + size).alias("done"),
                    F.when((state["group"] == 0) | full, state["group"] + 1)
                    .otherwise(state["group"]).alias("group"))

            return F.transform(_states(sizes, zero, step), lambda s: s["group"])

        def spans(group: Column) -> Column:
            first = _where(group, lambda g, i: (i == 0) | (g != F.get(group, i - 1)))
            return F.transform(_let(first, lambda f: _spans(paragraphs, f)), lambda span: _chunk(
                "prose", F.array_join(span, "\n\n")))

        return _let(sizes, lambda z: _let(total, lambda t: _let(assign(z, t), spans)))

    starts = _where(lines, lambda x, i: ~is_blank(x) & (
        (i == 0) | is_blank(F.get(lines, i - 1))))
    paragraphs = _let(starts, lambda s: F.transform(_spans(lines, s), lambda span: _joined(
        F.filter(span, lambda x: ~is_blank(x)))))
    return _let(paragraphs, lambda p: F.when(
        F.size(p) == 0, F.array(_chunk("prose", F.lit("")))).otherwise(groups(p)))


def runbook(lines: Column) -> Column:
    """Numbered steps in even groups of up to four, each under the line above its run.

    A run starts where numbering restarts or breaks. An unnumbered line continues a step
    only mid-sentence, never directly above a `1.`, and never if it starts like markup.
    """

    def digits(line: Column) -> Column:
        return F.regexp_extract(line, STEP, 1)

    def number(line: Column) -> Column:
        return F.when(line.rlike(STEP), F.coalesce(
            digits(line).try_cast("bigint"), F.lit(-1).cast("bigint")))

    def joins(lines: Column, x: Column, i: Column) -> Column:
        """Whether line i may continue a step that reaches up to line i - 1."""
        above, below = F.get(lines, i - 1), F.get(lines, i + 1)
        return (
            (i > 0) & ~x.rlike(STEP) & ~strip(above).rlike(r"[.:!?]\z")
            & ~F.coalesce(digits(below) == "1", F.lit(False))
            & ~x.rlike(rf"^[{WS}]*[#>*|-]")
        )

    def items(lines: Column) -> Column:
        """Steps with their wrapped lines rejoined, and every other line by itself."""
        facts = F.transform(lines, lambda x, i: F.struct(
            x.rlike(STEP).alias("step"),
            F.coalesce(joins(lines, x, i), F.lit(False)).alias("joins")))
        inside = _states(facts, F.lit(False), lambda s, f: f["step"] | (s & f["joins"]))
        return _let(inside, lambda inside: _let(
            _where(lines, lambda x, i: x.rlike(STEP) | ~F.get(inside, i)),
            lambda starts: F.transform(_spans(lines, starts), lambda span: _let(
                F.get(span, F.lit(0)), lambda first: F.struct(
                    number(first).alias("no"),
                    F.when(first.rlike(STEP), F.array_join(F.transform(span, strip), " "))
                    .otherwise(first).alias("text"))))))

    def number_runs(items: Column) -> Column:
        zero = F.struct(F.lit(0).cast("bigint").alias("at"),
                        F.lit(0).cast("bigint").alias("run"))

        def step(state: Column, item: Column) -> Column:
            restart = (item["no"] == 1) | (state["run"] == 0) | (item["no"] != state["at"] + 1)
            return F.when(item["no"].isNull(), state).when(restart, F.struct(
                F.lit(1).cast("bigint").alias("at"), (state["run"] + 1).alias("run"))
            ).otherwise(F.struct((state["at"] + 1).alias("at"), state["run"].alias("run")))

        return F.transform(_states(items, zero, step), lambda s: s["run"])

    def assemble(items: Column, runs: Column) -> Column:
        """Items in order, run 0 being what stands above the first step."""
        none = F.lit(0).cast("bigint")
        starts = _where(runs, lambda r, i: r != F.coalesce(F.get(runs, i - 1), none))

        def texts(span: Column, steps: bool) -> Column:
            picked = F.filter(span, lambda x: x["no"].isNotNull() if steps else x["no"].isNull())
            return F.transform(picked, lambda x: x["text"])

        def prose(block: Column, last: Column) -> Column:
            """What follows a run, without the line the next run takes as its heading."""
            rest = F.when(last, block).otherwise(
                F.slice(block, F.lit(1), F.greatest(F.size(block) - 1, F.lit(0))))
            return _let(rest, lambda r: F.when(
                F.size(r) > 0, F.array(_chunk("prose", _joined(r)))
            ).otherwise(F.array().cast(CHUNKS)))

        def step_chunks(heading: Column, steps: Column) -> Column:
            groups = F.ceil(F.size(steps) / F.lit(STEPS_PER_CHUNK)).cast("int")
            base = F.floor(F.size(steps) / groups).cast("int")
            extra = F.size(steps) % groups
            return F.transform(F.sequence(F.lit(0), groups - 1), lambda g: _chunk(
                "step", _joined(F.concat(F.array(heading), F.slice(
                    steps, g * base + F.least(g, extra) + 1,
                    base + F.when(g < extra, 1).otherwise(0))))))

        def chunks(opening: Column, found: Column) -> Column:
            def one(span: Column, j: Column) -> Column:
                above = F.when(j == 0, opening).otherwise(texts(F.get(found, j - 1), False))
                heading = _let(above, lambda b: F.coalesce(
                    F.get(b, F.size(b) - 1), F.lit("")))
                steps = _let(heading, lambda h: _let(
                    texts(span, True), lambda s: step_chunks(h, s)))
                return F.concat(steps, _let(texts(span, False), lambda b: prose(
                    b, j == F.size(found) - 1)))

            return F.concat(prose(opening, F.lit(False)), F.flatten(F.transform(found, one)))

        return _let(starts, lambda first: _let(
            texts(F.slice(items, F.lit(1), F.get(first, F.lit(0))), False),
            lambda opening: _let(_spans(items, first), lambda found: chunks(opening, found))))

    filled = F.filter(lines, lambda x: ~is_blank(x))
    return F.when(
        F.exists(lines, lambda x: x.rlike(STEP)),
        _let(filled, lambda f: _let(items(f), lambda it: _let(
            number_runs(it), lambda runs: assemble(it, runs)))),
    ).otherwise(whole(lines))


def policy(lines: Column) -> Column:
    """One rule per chunk, carrying the title and the exception process with it."""

    def titled(found: Column, name: str) -> Column:
        return F.array_min(_where(
            found, lambda s, j: F.get(s, F.lit(0)).startswith(SECTION + name)))

    def build(found: Column, rules: Column, exception: Column) -> Column:
        title = F.coalesce(
            F.get(F.filter(lines, lambda x: x.startswith("# ")), F.lit(0)), F.lit(""))
        terms = F.array_join(F.get(found, exception), "\n")
        none = F.array().cast(CHUNKS)

        def one(section: Column, j: Column) -> Column:
            rule_chunks = F.transform(
                F.filter(section, lambda x: x.rlike(STEP)),
                lambda rule: _chunk("rule", strip(F.concat_ws(
                    "\n", title, F.get(section, F.lit(0)), rule, F.lit(""), terms))))
            return F.when(j == exception, none).when(j == rules, rule_chunks).otherwise(
                F.array(_chunk("prose", _joined(section))))

        return F.flatten(F.transform(found, one))

    return _let(sections(lines), lambda found: _let(
        titled(found, "Mandatory Rules"), lambda rules: _let(
            titled(found, "Exception Process"), lambda exception: F.when(
                rules.isNull() | exception.isNull(), whole(lines)
            ).otherwise(build(found, rules, exception)))))


STRATEGIES: dict[str, Callable[[Column], Column]] = {
    "Postmortem": by_heading, "Advisory": advisory, "RiskNote": risk_note,
    "Runbook": runbook, "Policy": policy, "Matrix": whole, "Transition": by_heading,
    "CrossVendor": by_heading, "META": whole,
}
CARRIED = [
    "document_type", "retrieval_mode", "vendor", "vendors", "evidence_strength",
    "provenance", "source_format", "filename",
]
# What retrieval filters by, carried where the manifest has it.
SCOPE = ["device_family", "transition_class", "site_criticality_scope"]


def chunk(
    manifest: DataFrame, strategies: dict[str, Callable[[Column], Column]] | None = None,
    footer: str = PAGE_FOOTER,
) -> DataFrame:
    """Manifest rows with `text` -> chunk rows, in one pass over the documents. `footer` is the
    pattern of lines that a page repeats at its end."""
    def dispatch(lines: Column) -> Column:
        by_strategy: dict[Callable, list[str]] = {}
        for name, strategy in (strategies or STRATEGIES).items():
            by_strategy.setdefault(strategy, []).append(name)
        pieces = F.lit(None).cast(CHUNKS)
        for strategy, names in by_strategy.items():
            chosen = F.col("document_type").isin(names)
            pieces = F.when(chosen, strategy(lines)).otherwise(pieces)
        return pieces

    # Bound by name, the cleaned lines are made once per document, not once per use.
    pieces = _let(clean_lines(F.col("text"), footer), dispatch)
    carried = CARRIED + [c for c in SCOPE if c in manifest.columns]
    return (
        manifest.select("doc_id", *carried, F.posexplode(pieces).alias("chunk_index", "piece"))
        .select(
            F.concat_ws("_chunk_", "doc_id", F.col("chunk_index").cast("string"))
            .alias("chunk_id"),
            "doc_id", "chunk_index", F.col("piece.kind").alias("chunk_kind"), *carried,
            F.col("piece.text").alias("text"),
        )
    )


def chunk_counts(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("document_type").agg(
        F.count("*").alias("chunks"), F.countDistinct("doc_id").alias("documents")
    )


def structure_warnings(chunks: DataFrame) -> DataFrame:
    """Documents whose chunk count is far from their type's median, or that collapsed.

    Chunk counts per document are small whole numbers, so the median per type is taken
    over (count, documents) pairs.
    """
    per_doc = chunks.where(~F.col("document_type").isin(*WHOLE_BY_DESIGN)).groupBy(
        "doc_id"
    ).agg(
        F.min_by("filename", "chunk_index").alias("filename"),
        F.min_by("document_type", "chunk_index").alias("document_type"),
        F.min_by("source_format", "chunk_index").alias("source_format"),
        F.count("*").alias("chunks"),
        F.bool_or(F.col("chunk_kind") == "whole").alias("collapsed"),
    )
    sizes = per_doc.where(F.col("source_format") == "md").groupBy(
        "document_type", "chunks").agg(F.count("*").alias("n"))
    medians = sizes.groupBy("document_type").agg(
        F.expr("percentile(chunks, 0.5, n)").alias("median"))
    # One row per document type.
    joined = per_doc.join(F.broadcast(medians), "document_type", "left")
    off = F.coalesce(
        (F.col("median") > 0)
        & (F.abs(F.col("chunks") - F.col("median")) / F.col("median") > MAX_DEVIATION),
        F.lit(False))
    return joined.where(F.col("collapsed") | off).select(
        "doc_id", "filename", "document_type", "chunks", "median", "collapsed")


def _table_defects(text: Column) -> Column:
    """Table runs whose second row is not the rule under a header."""
    lines = F.split(text, "\n")
    return F.size(_where(lines, lambda x, i: x.rlike(TABLE_ROW)
        & ~F.coalesce(F.get(lines, i - 1).rlike(TABLE_ROW), F.lit(False))
        & ~F.coalesce(F.get(lines, i + 1).rlike(TABLE_RULE), F.lit(False))))


def invariant_violations(
    chunks: DataFrame, vendors: tuple[str, ...]
) -> DataFrame:
    """(subject, rule): every promise of the strategies that a chunk table breaks."""
    kind, dtype, text = F.col("chunk_kind"), F.col("document_type"), F.col("text")
    lines = F.split(text, "\n")
    numbers = F.transform(
        F.filter(lines, lambda x: x.rlike(STEP)),
        lambda x: F.regexp_extract(x, STEP, 1).try_cast("bigint"))
    gaps = F.exists(numbers, lambda n: ~n.between(
        F.get(numbers, F.lit(0)), F.get(numbers, F.lit(0)) + F.size(numbers) - 1)) | (
        F.size(F.array_distinct(numbers)) != F.size(numbers)) | (
        F.array_sort(numbers) != numbers)
    size = token_estimate(text)
    structured = kind != "whole"
    rules = {
        "empty": is_blank(text),
        "no_leading_heading": structured & dtype.isin(*HEADED)
        & ~F.get(lines, F.lit(0)).rlike(HEADING),
        "merges_sections": structured & dtype.isin(*HEADED)
        & (F.size(F.filter(lines, lambda x: x.startswith(SECTION))) != 1),
        "vendor_outside_pair": structured & (dtype == "CrossVendor") & F.exists(
            F.array(*[F.lit(v) for v in vendors]).cast("array<string>"),
            lambda v: F.contains(text, v) & ~F.array_contains("vendors", v)),
        "table_cut": structured & (dtype == "Advisory") & (_table_defects(text) > 0),
        "prose_with_table": (kind == "prose") & (dtype == "Advisory")
        & F.exists(lines, lambda x: x.rlike(TABLE_ROW)),
        "note_size": structured & (dtype == "RiskNote")
        & ~size.between(NOTE_TOKENS[0], NOTE_TOKENS[1]),
        "few_steps": (kind == "step") & (F.size(numbers) < 2),
        "steps_not_contiguous": (kind == "step") & (F.size(numbers) > 0) & gaps,
        "not_one_rule": (kind == "rule") & (F.size(numbers) != 1),
        "rule_without_exception": (kind == "rule") & ~F.contains(text, F.lit("Exception Process")),
    }
    per_chunk = chunks.select(F.col("chunk_id").alias("subject"), F.explode(F.array_compact(
        F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))).alias("rule"))
    repeated = chunks.groupBy("chunk_id").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("chunk_id").alias("subject"), F.lit("chunk_id_repeated").alias("rule"))
    per_doc = chunks.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.min("chunk_index").alias("low"),
        F.max("chunk_index").alias("high"), F.countDistinct("chunk_index").alias("distinct"),
        F.bool_or(dtype.isin(*WHOLE_BY_DESIGN)).alias("single"),
    )
    documents = per_doc.select(F.col("doc_id").alias("subject"), F.explode(F.array_compact(
        F.array(
            F.when((F.col("low") != 0) | (F.col("high") != F.col("n") - 1)
                   | (F.col("distinct") != F.col("n")), F.lit("index_not_contiguous")),
            F.when(F.col("single") & (F.col("n") != 1), F.lit("must_be_one_chunk")),
        ))).alias("rule"))
    return per_chunk.unionByName(repeated).unionByName(documents)

