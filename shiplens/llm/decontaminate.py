"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Every run of SEED words of a test item is a seed. Documents' runs are looked up among the seeds,
and stretches of a document around the hits of one item become candidate passages. A passage
matches when the best local alignment of its words with the item's (equal words MATCH, else
MISMATCH, gaps GAP) reaches SHARE of the score of the whole item. Passages that have too few of the
item's words for that, whatever their order, are not aligned; all others are.

Test items are small beside the corpus, but not taken to be: they are worked off in slices of at
most SLICE bytes, each of which travels to the tasks.

Defined results: a null text matches nothing; an item that is null or has fewer than SEED words
matches nothing; rows that share an id are one document and repeated items one item; the best
passage of a document and item is reported, ties by place; further columns are left out.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.llm.rows import batch_of, ranges, slices, text_bytes
from shiplens.llm.words import grams, mix, words

#: Words of a seed, and the share of an item's full score that makes a match.
SEED, SHARE = 3, 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
#: Bytes of test items that travel at once.
SLICE = 4 << 20
#: Cells of one alignment batch.
CELLS = 1 << 20


def _keyed(item: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """One number for an item and a word."""
    return mix(hashes + mix(item.astype(np.uint64) + np.uint64(1)))


class Items:
    """Word lists of test items and the places of their seeds, sorted by seed."""

    def __init__(self, ids: list[int], texts: list[str]):
        data, starts = text_bytes(pa.array(texts, pa.string()))
        hashes, _, _, counts = words(data, starts)
        ends = np.cumsum(counts)
        self.ids = ids
        self.words = [hashes[e - n : e] for e, n in zip(ends, counts)]
        runs, room = grams(hashes, np.where(counts >= SEED, counts, counts), SEED)
        item = np.repeat(np.arange(len(ids)), room)
        offset = ranges(np.zeros(len(ids), np.int64), room)
        usable = counts[item] >= SEED
        order = np.argsort(runs[usable], kind="stable")
        self.seeds, self.item, self.offset = runs[usable][order], item[usable][order], offset[usable][order]
        # a table of low bits tells most runs apart from seeds without a search
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self.seeds & np.uint64((1 << 22) - 1)] = True
        # each item's words and how often it has them
        self.keys, self.often = np.unique(_keyed(np.repeat(np.arange(len(ids)), counts), hashes), return_counts=True)

    def hits(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of runs that are seeds, and for each the place among the sorted seeds; a seed of
        several items gives one pair for each."""
        at = np.flatnonzero(self.maybe[runs & np.uint64((1 << 22) - 1)])
        low = np.searchsorted(self.seeds, runs[at], "left")
        n = np.searchsorted(self.seeds, runs[at], "right") - low
        return np.repeat(at, n), ranges(low, n)


def align(item: np.ndarray, passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each passage with the item, and the word it ends before."""
    width = max(map(len, passages))
    inside = np.arange(width)[None, :] < np.array([len(p) for p in passages])[:, None]
    text = np.zeros((len(passages), width), np.uint64)
    text[inside] = np.concatenate(passages)
    place = np.arange(1, width + 1) * -GAP
    above = np.zeros((len(passages), width + 1), np.int64)
    best, end = np.zeros(len(passages), np.int64), np.zeros(len(passages), np.int64)
    for word in item:
        step = np.where((text == word) & inside, MATCH, MISMATCH)
        row = np.maximum(np.maximum(above[:, :-1] + step, above[:, 1:] + GAP), 0)
        # gaps along the passage: the best of all cells to the left, less a step for each
        row = np.maximum.accumulate(row + place, axis=1) - place
        above[:, 1:] = row
        most = np.where(inside, row, -1).max(1)
        better = most > best
        if better.any():
            best[better] = most[better]
            end[better] = np.where(inside, row, -1)[better].argmax(1) + 1
    return best, end


def _common(items: Items, item: np.ndarray, sizes: np.ndarray, flat: np.ndarray, span: np.ndarray) -> np.ndarray:
    """The most words each passage can match with its item: those they have in common, as often as
    both have them, and no more than stand within `span` words of the passage."""
    passage = np.repeat(np.arange(len(item)), sizes)
    keys = _keyed(item[passage], flat)
    place = np.minimum(np.searchsorted(items.keys, keys), len(items.keys) - 1)
    there = items.keys[place] == keys
    pairs, n = np.unique(passage[there] * len(items.keys) + place[there], return_counts=True)
    both = np.bincount(
        pairs // len(items.keys), weights=np.minimum(n, items.often[pairs % len(items.keys)]), minlength=len(item)
    )
    total = np.concatenate([[0], np.cumsum(there)])
    ends = np.cumsum(sizes)
    at = np.arange(len(flat))
    near = total[np.minimum(at + span[passage], ends[passage])] - total[at]
    return np.minimum(both, np.maximum.reduceat(near, ends - sizes))


def _stretches(part: pa.RecordBatch, items: Items, lengths: np.ndarray):
    """(doc, item, first, last) of stretches around hits, each document's place among the words, and
    the words."""
    hashes, _, _, counts = words(*text_bytes(part.column("text")))
    runs, room = grams(hashes, counts, SEED)
    at, seed = items.hits(runs)
    run_ends = np.cumsum(room)
    doc = np.searchsorted(run_ends, at, "right")
    at = at - (run_ends - room)[doc]
    long = counts[doc] >= SEED
    at, seed, doc = at[long], seed[long], doc[long]
    if not len(at):
        return None
    item = items.item[seed]
    # where the item would begin and end, with room for words put in or left out
    slack = lengths[item] // 2 + SEED
    low = np.maximum(at - items.offset[seed] - slack, 0)
    high = np.minimum(at - items.offset[seed] + lengths[item] + slack, counts[doc])
    order = np.lexsort((low, item, doc))
    doc, item, low, high = (x[order] for x in (doc, item, low, high))
    fresh = np.concatenate([[True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])])
    # stretches that overlap are one; none of another pair reaches into this one's numbers
    pair = np.cumsum(fresh)
    top = int(counts.max()) + 1
    reach = np.maximum.accumulate(high + pair * top)
    fresh[1:] |= low[1:] + pair[1:] * top > reach[:-1]
    begin = np.flatnonzero(fresh)
    stop = reach[np.append(begin[1:], len(low)) - 1] - pair[begin] * top
    return doc[begin], item[begin], low[begin], stop, np.cumsum(counts) - counts, hashes


def _aligned(docs: DataFrame, items: Items, share: float) -> DataFrame:
    """The matches of every passage; nothing is shuffled."""
    lengths = np.array([len(w) for w in items.words], np.int64)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.int64()), ("similarity", pa.float64()),
        ("first_word", pa.int64()), ("end_word", pa.int64()),
    ])

    def scored(held: dict[int, list[tuple[int, int, np.ndarray]]]):
        found = []
        for item, group in held.items():
            target, at = items.words[item], 0
            group.sort(key=lambda g: len(g[2]))
            while at < len(group):
                n = 1
                while at + n < len(group) and (n + 1) * len(group[at + n][2]) <= CELLS:
                    n += 1
                scores, ends = align(target, [g[2] for g in group[at : at + n]])
                full = MATCH * len(target)
                for (doc, first, _), score, end in zip(group[at : at + n], scores.tolist(), ends.tolist()):
                    if score >= share * full:
                        found.append((doc, items.ids[item], score, score / full, first, first + end))
                at += n
        if found:
            yield batch_of(schema, **dict(zip(schema.names, zip(*found))))

    def run(batches):
        held: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        size = 0
        for part in slices(batches, "text"):
            if (got := _stretches(part, items, lengths)) is None:
                continue
            doc, item, first, stop, offset, hashes = got
            ids = part.column("doc").to_numpy(zero_copy_only=False)
            # an alignment that reaches the share has so many matches, so close together
            least = share * lengths
            span = np.maximum(np.ceil((MATCH - GAP) * lengths / -GAP - MATCH * least / -GAP), 1).astype(np.int64)
            sizes = stop - first
            block = np.cumsum(sizes) // CELLS
            for k in np.unique(block):
                own = np.flatnonzero(block == k)
                flat = hashes[ranges((offset[doc] + first)[own], sizes[own])]
                common = _common(items, item[own], sizes[own], flat, span[item[own]])
                for i in own[common >= least[item[own]]].tolist():
                    begin = offset[doc[i]]
                    passage = hashes[begin + first[i] : begin + stop[i]].copy()
                    held.setdefault(int(item[i]), []).append((int(ids[doc[i]]), int(first[i]), passage))
                    size += len(passage)
                if size >= CELLS:
                    yield from scored(held)
                    held, size = {}, 0
        yield from scored(held)

    return docs.mapInArrow(
        run, "doc_id long, item_id long, score long, similarity double, first_word long, end_word long"
    )


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, score, similarity, first_word, end_word) of each document and item that
    match: the passage's first candidate word and the word before which its alignment ends."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")).where(
        F.col("doc").isNotNull() & F.col("text").isNotNull()
    )
    tests = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).where(
        F.col("id").isNotNull() & F.col("text").isNotNull()
    ).distinct()
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // SLICE) or 1
    parts = []
    for k in range(n):
        part = sorted(tests.where(F.pmod(F.xxhash64("id"), F.lit(n)) == k).collect())
        items = Items([r["id"] for r in part], [r["text"] for r in part])
        parts.append(_aligned(rows, items, share))
    best = reduce(DataFrame.union, parts).groupBy("doc_id", "item_id").agg(F.max(F.struct(
        "score", "similarity", (-F.col("first_word")).alias("before"), "end_word"
    )).alias("best"))
    return best.select(
        "doc_id", "item_id", "best.score", "best.similarity", (-F.col("best.before")).alias("first_word"),
        "best.end_word",
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the rows whose text matches a test item. Every row is judged by its own text, by
    its 64-bit hash: rows without id as well, and rows that share an id each for itself. An empty
    benchmark or table takes nothing away; rows without text stay."""
    of_text = F.xxhash64(F.col(text_col).cast("string"))
    texts = docs.select(of_text.alias("doc_id"), F.col(text_col).alias("text"))
    found = matches(texts, benchmark).select(F.col("doc_id").alias("_text")).distinct()
    return docs.join(found, of_text == F.col("_text"), "left_anti").select(docs.columns)
