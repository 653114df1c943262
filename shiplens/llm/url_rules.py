"""URL filters: pattern rules found by their rarest literal token.

Every rule is a regular expression over host and path with the literal tokens that any URL it
matches must hold. The tokens are counted over all URLs, a rule is filed under its rarest one, and
a URL runs only the expressions filed under its own tokens. The rule list is configuration: its
index travels as a literal, so its size is that of the list and doesn't grow with the data.

Defined results: a null URL, or one without `://`, has empty host and path, no rule, and the
verdict for no matching rule (allow); repeated rows and ids give repeated results; further columns
are left out. Of rules that fit, the longest wins, then the one that is first in order.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the rules that name a host and the start of a path.
PLACES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
)
#: Words that mark a host as one to block when they stand there as a word of their own.
BLOCKED_WORDS = (
    "adult", "ads", "bets", "casino", "gambling", "phishing", "pills", "poker", "porn", "spam",
    "tracker", "viagra", "warez", "xxx",
)


@dataclass(frozen=True)
class Rule:
    """name: what is reported, None for rules of words; weight: the longer of two rules wins."""

    verdict: str
    name: str | None
    pattern: str
    tokens: tuple[str, ...]
    weight: int


def place_rule(verdict: str, place: str) -> Rule:
    """Fits a host and its subdomains where the path begins with the rule's."""
    host, slash, rest = place.partition("/")
    path = slash + rest
    end = _quoted(path) if path else r"(?:/|\z)"
    # a token counts if nothing can lengthen it: it must end inside the rule or with the host
    inside = re.findall(r"[0-9A-Za-z]+(?=[^0-9A-Za-z])", path)
    return Rule(verdict, place, rf"\A(?:[^/]*\.)?{_quoted(host)}{end}",
                (*re.findall(r"[0-9A-Za-z]+", host), *inside), len(place))


def word_rule(verdict: str, word: str) -> Rule:
    """Fits where the word stands in the host between dots, hyphens or the ends."""
    return Rule(verdict, None, rf"\A(?:[^/]*[.-])?{_quoted(word)}(?:[./-]|\z)",
                tuple(re.findall(r"[0-9A-Za-z]+", word)), 0)


def _quoted(text: str) -> str:
    return re.sub(r"([^0-9A-Za-z])", r"\\\1", text)


def production_rules() -> list[Rule]:
    return [place_rule(*p) for p in PLACES] + [word_rule("block", w) for w in BLOCKED_WORDS]


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + F.lit(3), F.length(url))).otherwise(
        F.lit("")
    )
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + F.lit(1), F.length(rest)), r"\A[^?#]*", 0)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lowered, path


def token_counts(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url") -> dict[str, int]:
    """In how many URLs each token of the rules stands: at most one entry per token comes back."""
    known = F.array(*[F.lit(t) for t in sorted({t for r in rules for t in r.tokens})])
    host, path = host_and_path(F.col(url_col))
    held = F.array_intersect(F.regexp_extract_all(F.concat(host, path), F.lit("[0-9A-Za-z]+"), 0), known)
    counted = pages.select(F.explode(held).alias("token")).groupBy("token").count()
    return {row["token"]: row["count"] for row in counted.collect()}


def judge(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) for every row; nothing is shuffled after the token counts."""
    if any(not r.tokens for r in rules):
        raise ValueError("a rule without a literal token can't be filed")
    counts = token_counts(pages, rules, url_col)
    filed: dict[str, list[int]] = {}
    for i, rule in enumerate(rules):
        rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t))
        filed.setdefault(rarest, []).append(i)
    rows = [F.struct(
        F.lit(-r.weight).alias("weight"), F.lit(i).alias("place"), F.lit(r.name).cast("string").alias("name"),
        F.lit(r.verdict).alias("verdict"), F.lit(r.pattern).alias("pattern"),
    ) for i, r in enumerate(rules)]
    index = F.create_map(*[x for token, places in filed.items() for x in (
        F.lit(token), F.array(*[rows[i] for i in places]),
    )])
    host, path = host_and_path(F.col(url_col))
    placed = pages.select(F.col(id_col).alias(id_col), host.alias("host"), path.alias("path"))
    address = F.concat("host", "path")
    tokens = F.array_distinct(F.regexp_extract_all(address, F.lit("[0-9A-Za-z]+"), 0))
    candidates = F.flatten(F.transform(
        F.filter(tokens, lambda t: F.map_contains_key(index, t)), lambda t: F.element_at(index, t)
    ))
    placed = placed.withColumn("fits", F.array_min(
        F.filter(candidates, lambda c: F.regexp_like(address, c["pattern"]))
    ))
    return placed.select(
        id_col, "host", "path", F.col("fits")["name"].alias("rule"),
        F.coalesce(F.col("fits")["verdict"], F.lit("allow")).alias("verdict"),
    )


def judge_sql(table: str = "pages") -> str:
    """The same in DuckDB's SQL, with every rule tried on every row."""
    quoted = lambda s: s.replace("'", "''")
    rules = sorted(enumerate(production_rules()), key=lambda r: (-r[1].weight, r[0]))
    fits = lambda r: f"regexp_matches(host || path, '{quoted(r.pattern)}')"
    name = " ".join(f"WHEN {fits(r)} THEN '{quoted(r.name)}'" for _, r in rules if r.name)
    verdict = " ".join(f"WHEN {fits(r)} THEN '{r.verdict}'" for _, r in rules)
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM {table}
), named AS (
  SELECT page_id, rest, regexp_extract(rest, '\\A[^/?#]*') AS raw FROM cut
), placed AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '\\A[^?#]*') AS path FROM named
)
SELECT page_id, host, path, CASE {name} ELSE NULL END AS "rule", CASE {verdict} ELSE 'allow' END AS verdict
FROM placed"""
