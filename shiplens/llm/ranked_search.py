"""Ranked lexical search by presence masks.

Items (the queries) are a stated set that travels to every document; documents are never moved. Two
passes read the corpus. The first counts documents, terms and, for the items' terms, the documents
that hold them. The second takes documents a block at a time: each term of an item is a bitmap over
the block, the bitmaps laid side by side give every document's mask of matched terms, and documents
of one mask form a group with one bound: what its terms could score at most, with the block's largest
counts and least length. Groups are scored in descending order of bound until the item's list is full
and no bound left reaches its last score. A task keeps its lists from block to block, so later blocks
are mostly passed over; Spark merges the tasks' lists, first in parts and then whole.

Scores are whole numbers. Terms are compared as 64-bit hashes.

Defined results: a null or empty text has no terms and counts as no document; a document's length
counts all its terms however long the text; repeated rows and rows that share an id are documents
each, equal ones in any order; rows without id rank behind their equals; repeated rows of an item
count once, and texts that share an item id are ranked one by one; an item without terms, or whose
terms nobody holds, gives no row, as do empty tables; further columns are left out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiplens.llm.rows import batch_of, slices, text_bytes
from shiplens.llm.words import words

#: Documents of a block at most and at least, and the (term, document) counts that it should hold.
BLOCK_ROWS, LEAST_ROWS, CELLS = 4096, 256, 1 << 23
#: Documents whose groups are scored at a time.
STEP = 128
#: Distinct terms of the items that are searched in one pass over the corpus.
PASS_TERMS = 1 << 16
#: Parts in which the tasks' lists are merged first.
PARTS = 64
#: The bytes between terms.
GAPS = np.zeros(256, bool)
GAPS[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_NONE = (1 << 63) - 1


@dataclass(frozen=True)
class Items:
    """Items of one pass: `terms` are sorted hashes, `lists` each item's places in them with repeats."""

    first: int
    terms: np.ndarray
    lists: list[tuple[np.ndarray, np.ndarray]]


def weight(documents: int, holding: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in holding.tolist()], np.int64)


def measure(lengths: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """A document's m: 75 and a quarter of its length in hundredths of the mean."""
    if lengths.size and 25 * int(lengths.max()) * documents > _NONE:
        return np.array([75 + 25 * n * documents // terms for n in lengths.tolist()], np.int64)
    return 75 + 25 * lengths * documents // max(terms, 1)


def factor(count: np.ndarray, m: np.ndarray) -> np.ndarray:
    count = count.astype(np.int64)
    return 1_000_000_000 * count // np.maximum(1000 * count + 12 * m, 1)


def term_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each text's terms end to end, as hashes, and how many it has."""
    hashes, _, _, counts = words(*text_bytes(column), gaps=GAPS)
    return hashes, counts.astype(np.int64)


def _items(texts: list[str | None]) -> list[Items]:
    """The items, in passes of a bounded number of terms."""
    hashes, counts = term_hashes(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    passes, held, begin = [], set(), 0
    for i, (end, n) in enumerate(zip(ends.tolist(), counts.tolist())):
        new = set(hashes[end - n : end].tolist())
        if held and len(held | new) > PASS_TERMS:
            passes.append((begin, i))
            held, begin = set(), i
        held |= new
    out = []
    for a, b in [*passes, (begin, len(texts))]:
        terms = np.unique(hashes[(ends[a] - counts[a]) : ends[b - 1]]) if b > a else np.zeros(0, np.uint64)
        lists = [np.unique(np.searchsorted(terms, hashes[ends[i] - counts[i] : ends[i]]), return_counts=True)
                 for i in range(a, b)]
        out.append(Items(a, terms, lists))
    return out


def _held(terms: np.ndarray, hashes: np.ndarray, counts: np.ndarray):
    """(term, document, times) of the block's terms that are among `terms`, by term and document."""
    if not len(terms) or not len(hashes):
        return np.zeros((3, 0), np.int64)
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    hit = terms[at] == hashes
    keys, times = np.unique(at[hit] * len(counts) + np.repeat(np.arange(len(counts)), counts)[hit], return_counts=True)
    return np.stack([keys // len(counts), keys % len(counts), times])


def _statistics(docs: DataFrame, text_col: str, terms: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and how many documents hold each of `terms`."""

    def run(batches):
        documents = total = 0
        holding = np.zeros(len(terms), np.int64)
        for part in slices(batches, text_col):
            hashes, counts = term_hashes(part.column(text_col))
            documents += int((counts > 0).sum())
            total += int(counts.sum())
            holding += np.bincount(_held(terms, hashes, counts)[0], minlength=len(terms))
        at = np.flatnonzero(holding)
        yield pa.record_batch([pa.array([-2, -1, *at.tolist()], pa.int64()),
                               pa.array([documents, total, *holding[at].tolist()], pa.int64())], names=["term", "n"])

    # a number for each term of the items
    got = dict(docs.select(text_col).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    return got.get(-2, 0), got.get(-1, 0), np.array([got.get(t, 0) for t in range(len(terms))], np.int64)


def _best(held, ids: np.ndarray, scores: np.ndarray, k: int):
    ids, scores = np.concatenate([held[0], ids]), np.concatenate([held[1], scores])
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def search_block(bits: np.ndarray, times: np.ndarray, m: np.ndarray, ids: np.ndarray,
                 rows: np.ndarray, gains: np.ndarray, best, k: int):
    """An item's k best after one block. `bits` and `times` are (term, document) presence and counts,
    `rows` the item's terms among them, `gains` a term's weight times its repeats in the item."""
    here = np.unpackbits(bits[rows], axis=1, count=len(m)).astype(bool)
    some = np.flatnonzero(here.any(axis=0))
    if not len(some):
        return best
    most = gains * factor(times[rows].max(axis=1), m[some].min())
    packed = np.packbits(here[:, some], axis=0)
    masks = np.zeros((len(some), -(-len(packed) // 8) * 8), np.uint8)  # one row a document, in whole words
    masks[:, : len(packed)] = packed.T
    groups, group = np.unique(masks.view(np.uint64 if masks.shape[1] == 8 else f"V{masks.shape[1]}").ravel(),
                              return_inverse=True)
    held = np.unpackbits(groups.view(np.uint8).reshape(len(groups), -1), axis=1, count=len(rows))
    bounds = held.astype(np.int64) @ most
    bound = bounds[group]
    order = np.argsort(-bound, kind="stable")
    some, bound = some[order], bound[order]
    at = 0
    while at < len(some):
        floor = best[1][-1] if len(best[1]) == k else 0
        if bound[at] < floor or bound[at] <= 0:  # equal scores may still have a smaller id
            break
        # the next group, and what whole groups follow it up to STEP documents
        end = int(np.searchsorted(-bound, -bound[at], "right"))
        following = len(some) if at + STEP >= len(some) else int(np.searchsorted(-bound, -bound[at + STEP], "left"))
        end = max(end, following if len(best[1]) == k else end)
        chosen = some[at:end]
        scores = gains @ factor(times[np.ix_(rows, chosen)], m[chosen][None, :])
        fit = scores > 0 if len(best[1]) < k else scores >= floor
        if fit.any():
            best = _best(best, ids[chosen[fit]], scores[fit], k)
        at = end
    return best


def _lists(docs: DataFrame, id_col: str, text_col: str, items: Items, k: int) -> DataFrame:
    """(item, id, score): each task's best documents of each item."""
    documents, total, holding = _statistics(docs, text_col, items.terms)
    weights = weight(documents, holding)
    schema = pa.schema([("item", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    size = max(LEAST_ROWS, min(BLOCK_ROWS, CELLS // max(len(items.terms), 1)))

    def blocks(batches):
        """(terms, documents and times of what is held, lengths, ids) of about `size` documents."""
        parts, n = [], 0
        for part in slices(batches, text_col):
            hashes, counts = term_hashes(part.column(text_col))
            held = _held(items.terms, hashes, counts)
            held[1] += n
            parts.append((held, counts, part.column("id").fill_null(_NONE).to_numpy()))
            n += len(counts)
            if n >= size:
                yield tuple(np.concatenate(x, axis=-1) for x in zip(*parts))
                parts, n = [], 0
        if parts:
            yield tuple(np.concatenate(x, axis=-1) for x in zip(*parts))

    def run(batches):
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(items.lists)
        for (term, doc, n), lengths, ids in blocks(batches):
            present, row = np.unique(term, return_inverse=True)
            place = np.full(len(items.terms), -1)
            place[present] = np.arange(len(present))
            times = np.zeros((len(present), len(ids)), np.int32)
            times[row, doc] = n
            bits, m = np.packbits(times > 0, axis=1), measure(lengths, documents, total)
            for i, (terms, repeats) in enumerate(items.lists):
                rows = place[terms]
                here = rows >= 0
                if here.any():
                    gains = weights[terms[here]] * repeats[here]
                    best[i] = search_block(bits, times, m, ids, rows[here], gains, best[i], k)
        for i, (found, scores) in enumerate(best):
            if len(found):
                yield batch_of(schema, item=np.full(len(found), items.first + i), id=found, score=scores)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias(text_col))
    return rows.mapInArrow(run, "item long, id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item, rank, id, score): each item's k documents of highest score above 0."""
    # the query set, which the caller states; its terms go out a bounded number at a time
    asked = sorted(
        (tuple(r) for r in items.select(item_col, item_text_col).where(F.col(item_text_col).isNotNull()).distinct().collect()),
        key=repr,
    )
    spark = docs.sparkSession
    found = spark.createDataFrame([], "item long, id long, score long")
    for part in _items([t for _, t in asked]) if asked else []:
        found = found.union(_lists(docs, id_col, text_col, part, k))
    order = [F.desc("score"), F.col("id")]
    for keys in (["item", "part"], ["item"]):
        ranked = found.withColumn("part", F.spark_partition_id() % PARTS) if "part" in keys else found
        place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
        found = ranked.withColumn("rank", place).where(F.col("rank") <= k).select("item", "id", "score", "rank")
    names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(asked)], f"item long, name {items.schema[item_col].dataType.simpleString()}")
    return found.join(names, "item").select(
        F.col("name").alias(item_col), F.col("rank").cast("int").alias("rank"),
        F.when(F.col("id") < _NONE, F.col("id")).alias(id_col), "score",
    )


#: The query's rows in DuckDB.
SEARCH_SQL = r"""
WITH said AS (
  SELECT doc_id, row_number() OVER () AS row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), counted AS (SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM said GROUP BY row, term),
lengths AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY row),
whole AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM lengths),
measures AS (SELECT row, 75 + ((25 * n * big_n) // big_l) AS m FROM lengths, whole),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM counted, whole GROUP BY term, big_n
), asked AS (
  SELECT item, item_id, term, count(*) AS times FROM (
    SELECT item_id, row_number() OVER () AS item, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)
  ) GROUP BY item, item_id, term
), scored AS (
  SELECT a.item, any_value(a.item_id) AS item_id, c.row, any_value(c.doc_id) AS doc_id,
    CAST(sum(a.times * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 12 * m.m))) AS BIGINT) AS score
  FROM asked a JOIN weights w USING (term) JOIN counted c USING (term) JOIN measures m ON m.row = c.row
  GROUP BY a.item, c.row
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS "rank", doc_id, score FROM ranked WHERE place <= 20"""
