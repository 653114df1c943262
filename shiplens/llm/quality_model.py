"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text's features are hashes of its distinct lower-cased words and of how its words are built, one
weight each, shared by all thresholds: P(grade <= k) = logistic(threshold k - sum of weights), with
thresholds in ascending order. The fit runs on a bounded sample of labelled rows (SAMPLE, those of
least hash, so the same for any partitioning); scoring reads every document once.

Grades come from the labels: 0 for toxic texts, 1 for texts of no quality, 2 for the rest.

Defined results: a null or empty text has no features and so the grade of no evidence, which the
thresholds give; labels that are null are left out of the fit; with no labels, or labels of one
grade, that grade (or the best) is expected of every text; rows that share an id are judged one by
one; further columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.llm.rows import ranges, slices, text_bytes
from shiplens.llm.words import mix, words

#: Labelled rows the fit may see at most, and bits of a feature's number.
SAMPLE, BITS = 8000, 18
GRADES = 3
#: Passes of the fit, its step, and the pull of weights towards zero, which chance features feel as
#: one over the root of the sample's size.
ROUNDS, STEP, PULL = 300, 0.3, 0.0155
#: Tail probability from which a text is selected.
SELECT = 0.5
_KINDS = 8


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -50, 50)))


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each text end to end, and how many each has."""
    data, starts = text_bytes(column)
    hashes, first, last, counts = words(data, starts)
    n = len(counts)
    row = np.repeat(np.arange(n), counts)
    numbers = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    # how words are built: letters, digits, marks inside, marks at the end, one mark alone
    letter = ((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 128)
    digit = (data >= 48) & (data <= 57)
    total = lambda mask: np.concatenate([[0], np.cumsum(mask)])
    length = last - first
    letters, digits = (t[last] - t[first] for t in (total(letter), total(digit)))
    marks = length - letters - digits
    tail = np.zeros(len(first), np.int64)
    for k in range(1, 4):
        there = length >= k
        at = np.maximum(last - k, 0)
        tail += there & (tail == k - 1) & (~letter[at] & ~digit[at] if len(data) else False)
    kinds = [
        marks == length, tail >= 2, tail >= 3, (marks > tail) & (length > 1), digits > 0, length > 20,
        (letters == length) & (length < 3),
    ]
    counted = [np.bincount(row[k], minlength=n) for k in kinds]
    order = np.lexsort((numbers, row))
    row_o, numbers_o = row[order], numbers[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (row_o[1:] != row_o[:-1]) | (numbers_o[1:] != numbers_o[:-1])
    # words that stand twice side by side, and distinct words in all, as shares of the words
    twice = np.zeros(len(row), bool)
    twice[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    counted += [np.bincount(row[twice], minlength=n)]
    distinct = np.bincount(row_o[fresh], minlength=n)
    shares = np.stack([c / np.maximum(counts, 1) for c in [*counted, counts - distinct]], 1)
    steps = np.minimum((shares * 20).astype(np.int64), 19)
    size = np.minimum(np.log2(counts + 1).astype(np.int64), 15)
    built = np.concatenate([
        mix((np.arange(shares.shape[1])[None, :] * 64 + steps + 1).astype(np.uint64)),
        mix((size[:, None] + 4096).astype(np.uint64)),
    ], 1) >> np.uint64(64 - BITS)
    present = counts > 0
    all_rows = np.concatenate([row_o[fresh], np.repeat(np.arange(n), built.shape[1])])
    all_numbers = np.concatenate([numbers_o[fresh], built.astype(np.int64).ravel()])
    kept = present[all_rows]
    all_rows, all_numbers = all_rows[kept], all_numbers[kept]
    order = np.argsort(all_rows, kind="stable")
    return all_numbers[order], np.bincount(all_rows, minlength=n)


def scores(weights: np.ndarray, numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(weights[numbers], dtype=np.float64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def fit(numbers: np.ndarray, counts: np.ndarray, grades: np.ndarray) -> Model:
    """Proportional odds by proximal adaptive steps over the whole sample."""
    weights = np.zeros(1 << BITS)
    if len(grades) == 0 or len(np.unique(grades)) == 1:
        grade = int(grades[0]) if len(grades) else GRADES - 1
        return Model(weights, np.where(np.arange(GRADES - 1) < grade, -20.0, 20.0))
    n = len(grades)
    held = np.bincount(numbers, minlength=1 << BITS)
    used = np.flatnonzero(held >= 3)  # a feature of one or two texts says nothing of others
    place = np.full(1 << BITS, -1)
    place[used] = np.arange(len(used))
    row = np.repeat(np.arange(n), counts)
    column = place[numbers]
    row, column = row[column >= 0], column[column >= 0]
    ends = np.searchsorted(row, np.arange(n), "right")
    below = np.array([(grades <= k).mean() for k in range(GRADES - 1)]).clip(1e-3, 1 - 1e-3)
    # thresholds as a first one and logarithms of gaps, so that they stay in order
    cut = np.log(below / (1 - below))
    base, gaps = cut[0], np.log(np.maximum(np.diff(cut), 1e-2))
    w, squares = np.zeros(len(used)), np.full(len(used), 1e-8)
    side = np.full(GRADES - 1, 1e-8)
    for _ in range(ROUNDS):
        cuts = base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        total = np.concatenate([[0.0], np.cumsum(w[column])])
        score = total[ends] - total[np.concatenate([[0], ends[:-1]])]
        edge = 1 / (1 + np.exp(-np.clip(np.concatenate([[-50.0], cuts, [50.0]])[None, :] - score[:, None], -50, 50)))
        upper, lower = edge[np.arange(n), grades + 1], edge[np.arange(n), grades]
        slope_u = np.where(grades + 1 < GRADES, upper * (1 - upper), 0.0)
        slope_l = np.where(grades > 0, lower * (1 - lower), 0.0)
        chance = np.maximum(np.where(grades + 1 < GRADES, upper, 1.0) - np.where(grades > 0, lower, 0.0), 1e-9)
        # of the mean negative log chance
        by_score = (slope_u - slope_l) / chance / n
        grad = np.bincount(column, weights=by_score[row], minlength=len(used))
        by_cut = np.zeros(GRADES - 1)
        for k in range(GRADES - 1):
            by_cut[k] = (-(slope_u / chance)[grades == k].sum() + (slope_l / chance)[grades == k + 1].sum()) / n
        squares += grad**2
        rate = STEP / np.sqrt(squares)
        w -= rate * grad
        w = np.sign(w) * np.maximum(np.abs(w) - rate * PULL / np.sqrt(n), 0)
        tails = np.cumsum(by_cut[::-1])[::-1]
        by_side = np.concatenate([[tails[0]], tails[1:] * np.exp(gaps)])
        side += by_side**2
        move = STEP * by_side / np.sqrt(side)
        base, gaps = base - move[0], gaps - move[1:]
    weights[used] = w
    return Model(weights, base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SAMPLE):
    """(feature numbers, counts, grades) of at most `size` labelled documents, those of least hash; of
    rows that share an id the one whose text has the least hash is taken."""
    graded = labels.where("quality IS NOT NULL AND toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(
        F.col("doc_id").cast("long").alias("doc")
    ).agg(F.min(F.when(F.col("toxic") > 0, 0).when(F.col("quality") <= 0, 1).otherwise(2)).alias("grade"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    chosen = graded.join(rows.select("doc"), "doc", "left_semi").orderBy(F.xxhash64("doc"), "doc").limit(size)

    def run(batches):
        for part in slices(batches, "text"):
            numbers, counts = features(part.column("text"))
            offsets = np.concatenate([[0], np.cumsum(counts)])
            data = numbers.astype(np.int32)
            yield pa.record_batch([
                part.column("doc"), part.column("grade"),
                pa.array([data[a:b].tobytes() for a, b in zip(offsets, offsets[1:])], pa.binary()),
            ], names=["doc", "grade", "numbers"])

    # the sample is bounded by its size, so it may travel to the documents
    picked = rows.join(F.broadcast(chosen), "doc").groupBy("doc", "grade").agg(
        F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    ).select("doc", "grade", "least.text").mapInArrow(run, "doc long, grade int, numbers binary")
    got = sorted(picked.collect(), key=lambda r: (r["doc"], bytes(r["numbers"])))
    lists = [np.frombuffer(r["numbers"], np.int32) for r in got]
    return (
        np.concatenate([np.zeros(0, np.int32), *lists]).astype(np.int64),
        np.array([len(x) for x in lists], np.int64), np.array([r["grade"] for r in got], np.int64),
    )


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    return fit(*sample(docs, labels, id_col, text_col))


def judge(docs: DataFrame, model: Model, text_col: str = "text",
          grade_col: str = "expected_grade", tail_col: str = "tail_probability") -> DataFrame:
    """`docs` with the expected grade and the probability of the best one; nothing is shuffled."""
    if clash := {grade_col, tail_col} & set(docs.columns):
        raise ValueError(f"columns already there: {sorted(clash)}")
    names = docs.columns
    used = np.flatnonzero(model.weights)
    values, thresholds = model.weights[used], model.thresholds
    schema = docs.withColumn(grade_col, F.lit(0.0)).withColumn(tail_col, F.lit(0.0)).schema

    def run(batches):
        weights = np.zeros(1 << BITS)
        weights[used] = values
        own = Model(weights, thresholds)
        for part in slices(batches, text_col):
            tails = own.tails(scores(weights, *features(part.column(text_col))))
            yield pa.record_batch(
                [*part.columns, pa.array(tails.sum(1)), pa.array(tails[:, -1])], names=[*names, grade_col, tail_col]
            )

    return docs.mapInArrow(run, schema)


def select(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           least: float = SELECT) -> DataFrame:
    """The judged rows of `docs` whose chance of the best grade is at least `least`."""
    judged = judge(docs, train(docs, labels, id_col, text_col), text_col)
    return judged.where(F.col("tail_probability") >= least)
