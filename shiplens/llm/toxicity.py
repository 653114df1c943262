"""Toxicity: a weighted lexicon, matched by Aho-Corasick over folded text.

Folding undoes disguise: letters of other alphabets that look like Latin ones, full-width and accented
forms, digits and signs that stand for letters inside a word; l, i and 1 become one letter. What is
left are words of letters with one blank between. Patterns are whole words and beginnings of words.

The lexicon is learned from labelled documents, a bounded sample of each label (SAMPLE). A pattern
is judged by how many different pairs of neighbours it has among toxic and among clean documents, so
copies of one document count once, and kept where that can't be chance. Exception phrases are pairs of
words that hold a pattern and that only clean documents have, and those that the caller adds; a match
inside one doesn't count. A document's sum of weights, the heaviest match of each word, is divided by a
power of its number of words; the power and the curve from that to a score are fitted to the sample.

Labels, language, source and id are no inputs of a score: equal texts have equal scores.

Defined results: a null or empty text, or one without letters, has no match and the score of none;
without labels, or with one label only, the lexicon is empty and every score is that label, 0 if there
is none; labels that are null are left out, of repeated labels the largest counts; rows
that share an id are scored one by one and the one whose text has the least hash is learned from; a
row without id is not held out; texts of any length are read whole; further columns pass through.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from dataclasses import dataclass, field
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.llm.rows import slices
from shiplens.sources.scratch import materialise

#: Labelled documents of each label that the lexicon is learned from at most.
SAMPLE = 2000
#: Lengths of beginnings of words that may become patterns.
BEGINNINGS = (4, 5, 6)
#: Least evidence of a pattern (twice the logarithm of how unlikely its split is by chance), the least
#: log odds, and the largest weight.
EVIDENCE, ODDS, HEAVIEST = 30.0, 2.0, 6.0
#: Patterns and phrases kept at most, those of most evidence.
PATTERNS, PHRASES = 4096, 4096
#: Pairs of clean documents' neighbours that a phrase needs.
PHRASE_DOCUMENTS = 3
#: Powers of the number of words that are tried, and the pull of the curve's steepness towards 0.
POWERS, RIDGE = (0.0, 0.25, 0.5, 0.75, 1.0), 1e-4
#: Score from which a document is predicted toxic.
TOXIC = 0.7
#: Exception phrases known beforehand.
KNOWN_PHRASES = ("clown fish", "trash can", "trash bin", "pond scum")

# Letters that look like Latin ones, and signs read as letters.
_LIKE = dict(zip("аевкмнорстухіјѕԁԛԝɡαβεικνορτυχγηωϲ", "aebkmhopctyxijsdqwgabeikvoptuxynwc"))
_SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i"}


class _Table(dict):
    """What a character is read as: letters, a sign that may be one, nothing or a blank."""

    def __missing__(self, code: int) -> str:
        out = []
        for c in unicodedata.normalize("NFKD", chr(code).lower()):
            c = _LIKE.get(c, c)
            if c.isalpha():
                out.append("i" if c == "l" else c)
            elif unicodedata.category(c) not in ("Mn", "Cf"):
                out.append(c if c in _SIGNS or c.isdigit() else " ")
        self[code] = "".join(out)
        return self[code]


_TABLE = _Table()
_READ = str.maketrans(_SIGNS)


def _word(token: str) -> str:
    """A token with digits or signs: those inside a word are letters, those around it nothing."""
    token = token.rstrip("!|@$")
    if not any(c.isalpha() for c in token):
        return ""
    return "".join(c for c in token.translate(_READ) if c.isalpha())


def folded(text: str | None) -> list[str]:
    words = (text or "").translate(_TABLE).split()
    return [w for w in (t if t.isalpha() else _word(t) for t in words) if w]


@dataclass(frozen=True)
class Lexicon:
    """Patterns begin with a blank and end with one if they are whole words. A score is the chance
    1 / (1 + exp(-(level + slope * sum of weights / words ** power)))."""

    weights: dict[str, float] = field(default_factory=dict)
    phrases: Sequence[str] = ()
    power: float = 0.0
    level: float = 0.0
    slope: float = 0.0

    def automaton(self):
        found = ahocorasick.Automaton()
        for pattern, w in self.weights.items():
            found.add_word(pattern, (len(pattern), w))
        for phrase in self.phrases:
            found.add_word(f" {phrase} ", (len(phrase) + 2, None))
        found.make_automaton()
        return found


def matches(automaton, words: list[str]) -> dict[int, float]:
    """The heaviest weight by place of the word in " w1 w2 ... ", without what exception phrases cover."""
    if not words or not len(automaton):
        return {}
    held, covered = {}, []
    for end, (size, w) in automaton.iter(f" {' '.join(words)} "):
        begin = end - size + 1
        if w is None:
            covered.append((begin, end))
        elif w > held.get(begin, 0.0):
            held[begin] = w
    if covered:
        starts, ends = (np.array(x) for x in zip(*sorted(covered)))
        reach = np.maximum.accumulate(ends)
        for begin in list(held):
            k = int(np.searchsorted(starts, begin, "right")) - 1
            if k >= 0 and begin < reach[k]:  # the blank at a phrase's end opens the next word
                del held[begin]
    return held


def _measured(automaton, texts) -> tuple[np.ndarray, np.ndarray]:
    """Each text's sum of weights and number of words."""
    sums, counts = np.zeros(len(texts)), np.zeros(len(texts))
    for i, text in enumerate(texts):
        words = folded(text)
        sums[i], counts[i] = sum(matches(automaton, words).values()), len(words)
    return sums, counts


def _chance(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def curve(sums: np.ndarray, counts: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """(power, level, slope) of least loss on the sample, by Newton's steps for each power. Both labels
    weigh alike, so a score doesn't hang on how many of each were drawn."""
    best = None
    share = np.where(toxic, 0.5 / max(toxic.sum(), 1), 0.5 / max((~toxic).sum(), 1))
    for power in POWERS:
        x = sums / np.maximum(counts, 1) ** power
        scale = float(np.median(x[x > 0])) if (x > 0).any() else 1.0  # a usual match is 1
        a = np.stack([np.ones(len(x)), x / scale], 1)
        beta, pull = np.zeros(2), np.array([1e-6, RIDGE])
        for _ in range(50):
            p = _chance(a @ beta)
            slope = a.T @ (share * (p - toxic)) + pull * beta
            bend = (a * (share * p * (1 - p))[:, None]).T @ a + np.diag(pull)
            step = np.linalg.solve(bend, slope)
            beta -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        p = np.clip(_chance(a @ beta), 1e-12, 1 - 1e-12)
        loss = -(share * np.where(toxic, np.log(p), np.log(1 - p))).sum() + (pull * beta**2).sum() / 2
        if best is None or loss < best[0] - 1e-9:
            best = (loss, power, float(beta[0]), float(beta[1] / scale))
    return best[1:]


def is_held_out(id_col: str = "doc_id") -> Column:
    """Ids whose labels nothing is learned from: those whose checksum leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(text, toxic) of at most `size` labelled documents of each label, those of least hash."""
    told = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out()).groupBy(
        F.col("doc_id").cast("long").alias("doc")).agg(F.max(F.col("toxic") > 0).alias("toxic"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")).where(
        ~is_held_out("doc"))
    there = told.join(rows.select("doc"), "doc", "left_semi")
    chosen = there.where("toxic").orderBy(F.xxhash64("doc"), "doc").limit(size).union(
        there.where("NOT toxic").orderBy(F.xxhash64("doc"), "doc").limit(size))
    # bounded by twice the size
    return rows.join(F.broadcast(chosen), "doc").groupBy("doc", "toxic").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("text", "toxic")


def hash_pair(a: str, b: str) -> int:
    """A number for two neighbours, the same in every process."""
    return crc32(a.encode()) << 31 ^ crc32(b.encode())


def _patterns(word: str) -> list[str]:
    return [f" {word} ", *(f" {word[:k]}" for k in BEGINNINGS if len(word) >= k)]


def _evidence(rows: DataFrame) -> list[tuple[str, float]]:
    """(pattern, weight) of those that toxic documents have beyond chance."""

    def run(batches):
        for part in slices(batches, "text"):
            for text, bad in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                words = ["", *folded(text), ""]
                for at in range(1, len(words) - 1, 10_000):
                    here = range(at, min(at + 10_000, len(words) - 1))
                    own = {(p, hash_pair(words[i - 1], words[i + 1])) for i in here for p in _patterns(words[i])}
                    yield pa.record_batch([
                        pa.array([p for p, _ in own], pa.string()), pa.array([n for _, n in own], pa.int64()),
                        pa.array([bad] * len(own), pa.bool_())], names=["pattern", "around", "toxic"])

    # equal neighbours count once for each label: copies of a document are no further evidence
    seen = rows.mapInArrow(run, "pattern string, around long, toxic boolean").groupBy("pattern", "around").agg(
        F.max("toxic").alias("bad"), F.min("toxic").alias("only_bad"))
    counts = seen.groupBy("pattern").agg(
        F.count_if("bad").cast("double").alias("a"), F.count_if(~F.col("only_bad")).cast("double").alias("b"))
    totals = seen.where("pattern LIKE ' % '").agg(F.count_if("bad"), F.count_if(~F.col("only_bad"))).first()
    n_bad, n_good = (max(float(t or 0), 1.0) for t in totals)
    a, b = F.col("a"), F.col("b")
    share = n_bad / (n_bad + n_good)
    split = lambda n, total, p: F.when(n > 0, n * F.log(n / (total * p))).otherwise(0.0)
    kept = counts.withColumns({
        "evidence": 2 * (split(a, a + b, share) + split(b, a + b, 1 - share)),
        # the log odds less two of their standard deviations
        "odds": F.log((a + 0.5) / (b + 0.5)) - F.log(F.lit(n_bad / n_good)),
        "spread": F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)),
    }).where((F.col("evidence") >= EVIDENCE) & (F.col("odds") >= ODDS)).select(
        "pattern", "evidence", F.least(F.lit(HEAVIEST), F.greatest(F.lit(0.5), F.col("odds") - F.col("spread"))).alias("weight"))
    return [(r["pattern"], r["weight"]) for r in kept.orderBy(F.desc("evidence"), "pattern").limit(PATTERNS).collect()]


def _phrases(rows: DataFrame, lexicon: Lexicon) -> list[str]:
    """Pairs of words around a match that several clean documents have and no toxic one."""

    def run(batches):
        automaton = lexicon.automaton()
        for part in slices(batches, "text", 64):
            out = []
            for i, (text, bad) in enumerate(zip(part.column("text").to_pylist(), part.column("toxic").to_pylist())):
                words = folded(text)
                held = matches(automaton, words)
                at, pairs = 0, set()
                for k, w in enumerate(words):
                    if at in held:
                        pairs |= {f"{x} {y}" for x, y in zip(words[max(0, k - 1) : k + 1], words[max(1, k) : k + 2])}
                        pairs |= {f"{w} {words[k + 1]}"} if k + 1 < len(words) else set()
                    at += len(w) + 1
                out += [(p, bad) for p in pairs]
            yield pa.record_batch([pa.array([p for p, _ in out], pa.string()), pa.array([t for _, t in out], pa.bool_())],
                                  names=["phrase", "toxic"])

    found = rows.mapInArrow(run, "phrase string, toxic boolean").groupBy("phrase").agg(
        F.count_if("toxic").alias("a"), F.count("*").alias("n"))
    kept = found.where((F.col("a") == 0) & (F.col("n") >= PHRASE_DOCUMENTS)).orderBy(F.desc("n"), "phrase").limit(PHRASES)
    return [r["phrase"] for r in kept.collect()]


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SAMPLE,
          phrases: Sequence[str] = KNOWN_PHRASES) -> Lexicon:
    rows = materialise(sample(docs, labels, id_col, text_col, size), "toxic-sample")
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return Lexicon(level=60.0 if True in n else -60.0)
    known = [" ".join(folded(p)) for p in phrases]
    first = Lexicon(dict(_evidence(rows)), known)
    lexicon = Lexicon(first.weights, [*known, *_phrases(rows, first)])

    def run(batches):
        automaton = lexicon.automaton()
        for part in slices(batches, "text", 64):
            sums, counts = _measured(automaton, part.column("text").to_pylist())
            yield pa.record_batch([pa.array(sums), pa.array(counts), part.column("toxic")], names=["sum", "words", "toxic"])

    # three numbers for each row of the sample
    got = rows.mapInArrow(run, "sum double, words double, toxic boolean").orderBy("sum", "words", "toxic").collect()
    power, level, slope = curve(np.array([r[0] for r in got]), np.array([r[1] for r in got]),
                                np.array([r[2] for r in got], bool))
    return Lexicon(lexicon.weights, lexicon.phrases, power, level, max(slope, 0.0))


def score(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """`docs` with each text's score; nothing is shuffled."""
    if score_col in docs.columns:
        raise ValueError(f"column already there: {score_col}")
    names = docs.columns
    schema = docs.withColumn(score_col, F.lit(0.0)).schema

    def run(batches):
        automaton = lexicon.automaton()
        for part in slices(batches, text_col):
            sums, counts = _measured(automaton, part.column(text_col).to_pylist())
            x = lexicon.level + lexicon.slope * sums / np.maximum(counts, 1) ** lexicon.power
            yield pa.record_batch([*part.columns, pa.array(_chance(x))], names=[*names, score_col])

    return docs.mapInArrow(run, schema)


def predictions(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    lexicon = learn(docs, labels, id_col, text_col)
    scored = score(docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col)), lexicon, text_col)
    return scored.select(
        id_col, is_held_out(id_col).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))
