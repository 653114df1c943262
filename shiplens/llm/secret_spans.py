"""Secret scans with multipart credential linking.

Strong spans (assigned keys, access identifiers, long hexadecimal runs) are reported on sight. Weak
candidates (short assigned values, plain identifiers, endpoints) are reported only where the parts
that complete them stand in the same scope: spans no further apart than SCOPE code points. The
interval join of parts runs within a text, over spans in order of their starts.

Defined results: a null or empty text has no spans; rows are judged one by one, so repeated rows
and ids give repeated results; columns of other names pass through untouched. Ties of start are
ordered by kind, as listed in KINDS. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.llm.rows import slices

#: The strong kinds' patterns and least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "identifier", "weak_secret", "endpoint")
#: Code points between linked parts.
SCOPE = 240
#: An identifier's name may follow a prefix that ends in a mark or a change of case.
IDENTIFIER = re.compile(
    r"""(?-i:(?<![A-Za-z0-9])|(?<=[a-z0-9])(?=[A-Z]))(?:user(?:_?name)?|login|client_?id|account|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]+)""",
    re.ASCII | re.IGNORECASE,
)
ENDPOINT = re.compile(r"""(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?|ftp)://[^\s"'<>]+""", re.ASCII)
LONG_HEX = re.compile(r"[0-9a-f]{16,}")
#: Weak kinds whose spans must stand in scope before a weak candidate of a kind is reported.
NEEDS = {
    "identifier": (("assign", "weak_secret"),),
    "weak_secret": (("identifier", "access"),),
    "endpoint": (("identifier", "access"), ("assign", "weak_secret")),
}


def strong_spans(text: str) -> tuple[list[tuple[int, str, int]], list[tuple[int, int]]]:
    """Strong spans, and the spans of assignments whose value is too short for one."""
    spans, short = [], []
    for m in ASSIGN.finditer(text):
        length = m.end(2) - m.start(2)
        if length >= LEAST["assign"]:
            spans.append((m.start(), "assign", m.end()))
        else:
            short.append(m.span())
    if "AKIA" in text:
        spans += [
            (m.start(), "access", m.end()) for m in ACCESS.finditer(text)
            if m.end() - m.start() >= LEAST["access"]
        ]
    # a maximal run of sixteen or more is what the base pattern's longest matches leave
    spans += [(m.start(), "hex", m.end()) for m in LONG_HEX.finditer(text)]
    return spans, short


def linked(parts: dict[str, list[tuple[int, int]]]) -> list[tuple[int, str, int]]:
    """Weak spans with every part they need in scope. parts: spans of each kind."""
    starts = {k: sorted(v) for k, v in parts.items()}
    reach = {k: _running_ends(v) for k, v in starts.items()}

    def near(kinds, start: int, end: int) -> bool:
        for kind in kinds:
            spans = starts.get(kind, [])
            upto = bisect_right(spans, (end + SCOPE, 1 << 62))
            # of the spans that begin early enough, the furthest end shows if one reaches the scope
            if upto and reach[kind][upto - 1] >= start - SCOPE:
                return True
        return False

    return [
        (a, kind, b) for kind, needed in NEEDS.items() for a, b in starts.get(kind, [])
        if all(near(kinds, a, b) for kinds in needed)
    ]


def _running_ends(spans: list[tuple[int, int]]) -> list[int]:
    out, most = [], -1
    for _, end in spans:
        most = max(most, end)
        out.append(most)
    return out


def spans_of(text: str) -> list[tuple[int, str, int]]:
    """All spans of a text as (start, kind, end), in order."""
    spans, short = strong_spans(text)
    taken = sorted((a, b) for a, _, b in spans)
    begins, ends = [a for a, _ in taken], _running_ends(taken)

    def free(a: int, b: int) -> bool:
        before = bisect_left(begins, b)
        return not before or ends[before - 1] <= a

    parts = {k: [(a, b) for a, kind, b in spans if kind == k] for k in ("assign", "access")}
    parts["weak_secret"] = [s for s in short if free(*s)]
    parts["endpoint"] = [m.span() for m in ENDPOINT.finditer(text) if free(*m.span())] if "://" in text else []
    if parts["assign"] or parts["weak_secret"]:
        parts["identifier"] = [m.span() for m in IDENTIFIER.finditer(text) if free(*m.span())]
    rank = {k: i for i, k in enumerate(KINDS)}
    return sorted(spans + linked(parts), key=lambda s: (s[0], rank[s[1]], s[2]))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan(docs: DataFrame, text_col: str = "text", spans_col: str = "secret_spans",
         redacted_col: str | None = None, mask: str = "[SECRET]") -> DataFrame:
    """`docs` and an array of (kind, start, end); with redacted_col, also the text with all spans
    masked (overlapping ones as one). Nothing is shuffled or collected."""
    names = docs.columns
    added = [spans_col, *([redacted_col] if redacted_col else [])]
    if clash := set(added) & set(names):
        raise ValueError(f"columns already there: {sorted(clash)}")
    schema = docs.withColumn(spans_col, F.lit(None).cast("array<struct<kind:string,start:int,end:int>>"))
    if redacted_col:
        schema = schema.withColumn(redacted_col, F.lit(None).cast("string"))

    def run(batches):
        for part in slices(batches, text_col):
            texts = part.column(text_col).to_pylist()
            found = [spans_of(t) if t else [] for t in texts]
            columns = [part.column(c) for c in names] + [pa.array(
                [[{"kind": k, "start": a, "end": b} for a, k, b in spans] for spans in found], SPANS
            )]
            if redacted_col:
                columns.append(pa.array([t if not s else masked(t, s, mask) for t, s in zip(texts, found)], pa.string()))
            yield pa.record_batch(columns, names=[*names, *added])

    return docs.mapInArrow(run, schema.schema)


def masked(text: str, spans: list[tuple[int, str, int]], mask: str) -> str:
    out, at, end = [], 0, 0
    for a, _, b in spans:
        if a >= end:
            out += [text[at:a], mask]
        at = end = max(end, b)
    return "".join([*out, text[at:]])


def digest(scanned: DataFrame, spans_col: str = "secret_spans") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of scanned rows."""
    listed = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    ), ",")
    spans = F.col(spans_col)
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(spans).alias("spans"),
    )
