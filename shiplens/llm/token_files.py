"""Token-id files of Simple-8b words.

A word of 64 bits holds a selector in its top four bits and as many ids as fit, all of one width,
below. Blocks of BLOCK ids start at word boundaries and their offsets are kept, so all blocks are
packed and unpacked side by side. A value that fits no selector is an escape: its word holds the
place of the value in a list beside the words.

A file is a Parquet file of chunks (columns of CHUNK below): one shard of the id-ordered corpus,
cut between documents. Spark's writer commits it, so a lost executor's half-written shard is never
read, and any store Spark can reach will do.

Defined results: a null or empty text has no ids of its own, only the end id; rows whose id is null
come first; rows that share an id stand side by side, in the order of their texts' hashes; further
columns are left out.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm.rows import batch_of, ranges, slices
from shiplens.llm.segments import Segments, vocabulary
from shiplens.sources.scratch import new_path

#: Ids of one independently packed block, and of one chunk unless a document has more.
BLOCK, CHUNK_IDS = 1024, 1 << 20
#: Fixed values of Simple-8b: values per word and bits per value, for each selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = 15
LOW = np.uint64((1 << 60) - 1)
CHUNK = (
    "shard int, first long, docs array<long>, counts array<long>, n_ids long, "
    "words binary, offsets binary, escaped binary"
)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, each block's first word, and escaped values, of unsigned ids.

    Selector 15, one value to a word, is the escape: a value that no other selector can hold.
    """
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint64)
    n_blocks = -(-n // BLOCK)
    ends = np.minimum(np.arange(1, n_blocks + 1) * BLOCK, n)
    # the selector a word would take if it began at each id: the one that holds most
    chosen = np.full(n, ESCAPE, np.uint8)
    bits = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)  # rounding never takes one off
    for s in range(ESCAPE - 1, -1, -1):
        fits = bits <= WIDTHS[s]
        if not fits.any():
            continue
        run, have = fits, 1
        padded = np.ones(n, bool)
        while have < COUNTS[s]:
            step = int(min(have, COUNTS[s] - have))
            padded[: n - step] = run[step:] if step < n else True
            padded[max(n - step, 0) :] = True
            run = run & padded
            have += step
            if not run.any():
                break
        chosen[run] = s
    # a run that reaches into the next block counts as one only if it doesn't end there first;
    # the shorter run that is left fits the same selector, so cutting it is enough
    at, live, opens = np.arange(n_blocks) * BLOCK, np.arange(n_blocks), np.zeros(n, bool)
    taken = np.where(chosen == ESCAPE, 1, COUNTS[chosen]).astype(np.int16)
    while len(at):
        opens[at] = True
        at = at + taken[at]
        on = at < ends[live]
        at, live = at[on], live[on]
    start = np.flatnonzero(opens)
    owner = start // BLOCK
    selector = chosen[start]
    count = np.minimum(taken[start], ends[owner] - start).astype(np.int64)
    words = selector.astype(np.uint64) << np.uint64(60)
    packed = np.flatnonzero(selector < ESCAPE)
    for k in range(int(count[packed].max()) if len(packed) else 0):
        packed = packed[count[packed] > k]
        shift = (WIDTHS[selector[packed]] * k).astype(np.uint64)
        words[packed] |= ids[start[packed] + k] << shift
    lone = np.flatnonzero(selector == ESCAPE)
    words[lone] |= np.arange(len(lone), dtype=np.uint64)
    offsets = np.searchsorted(owner, np.arange(n_blocks + 1))
    return words, offsets, ids[start[lone]]


def unpack(words: np.ndarray, offsets: np.ndarray, escaped: np.ndarray, n: int) -> np.ndarray:
    """The ids of `pack`, all words at once."""
    if not n:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    count = np.where(selector == ESCAPE, 1, COUNTS[selector])
    # a block's last word is cut where the block ends
    n_blocks = len(offsets) - 1
    sizes = np.minimum(np.arange(1, n_blocks + 1) * BLOCK, n) - np.arange(n_blocks) * BLOCK
    total = np.concatenate([[0], np.cumsum(count)])
    over = total[offsets[1:]] - total[offsets[:-1]] - sizes
    count[offsets[1:] - 1] -= over
    start = np.cumsum(count) - count
    lone = np.flatnonzero(selector == ESCAPE)
    lone_at, lone_value = start[lone], (words[lone] & LOW).astype(np.int64)
    width = WIDTHS[selector].astype(np.uint64)
    mask = (np.uint64(1) << width) - np.uint64(1)
    body = words & LOW
    ids = np.zeros(n, np.uint64)
    for k in range(int(count.max())):
        live = np.flatnonzero(count > k)
        if len(live) < len(count):
            body, width, mask, start, count = body[live], width[live], mask[live], start[live], count[live]
        ids[start + k] = body & mask
        body = body >> width
    if len(escaped):
        ids[lone_at] = escaped[lone_value]
    return ids


@lru_cache(2)
def _segments(spec: bytes) -> Segments:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(spec.decode())
    library.model._resize_cache(0)  # pieces come once each, so what it keeps of them is not met again

    def encode(text: str) -> np.ndarray:
        return np.array(library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)

    return Segments(vocabulary(spec), encode)


def write(docs: DataFrame, spec: bytes, path: str, end_id: int,
          id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every row with the tokenizer library, close it with end_id, and write the ids in
    ascending id order: shards are ranges of ids, sorted within."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc"), text.alias("text"))
        .repartitionByRange("doc").sortWithinPartitions("doc", F.xxhash64("text"))
    )

    def run(batches):
        own, shard, first = _segments(spec), TaskContext.get().partitionId(), 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def chunk():
            nonlocal first, held
            docs_of = [d for h in held for d in h[0]]
            ids, counts = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            words, offsets, escaped = pack(ids)
            row = {
                "shard": [shard], "first": [first], "docs": [docs_of], "counts": [counts],
                "n_ids": [len(ids)], "words": [words.tobytes()],
                "offsets": [offsets.astype(np.uint32).tobytes()], "escaped": [escaped.tobytes()],
            }
            first, held = first + len(ids), []
            return batch_of(schema, **row)

        size = 0
        for part in slices(batches, "text", rows=4096, size=4 << 20):
            ids, counts = own.ids(part.column("text"))
            closed = np.full(len(ids) + len(counts), end_id, np.int64)
            closed[ranges(np.cumsum(counts + 1) - counts - 1, counts)] = ids
            held.append((part.column("doc").to_pylist(), closed, counts + 1))
            size += len(closed)
            if size >= CHUNK_IDS:
                yield chunk()
                size = 0
        if held:
            yield chunk()

    schema = pa.schema([
        ("shard", pa.int32()), ("first", pa.int64()), ("docs", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("words", pa.binary()),
        ("offsets", pa.binary()), ("escaped", pa.binary()),
    ])
    ordered.mapInArrow(run, CHUNK).write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document's ids, and how many stand before them."""
    return _documents(spark, path, "ids array<long>", lambda ids, ends: [
        ids[a:b] for a, b in zip(ends[:-1], ends[1:])
    ])


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), the checksum over the ids as little-endian 32 bits."""

    def crc(ids, ends):
        data, at = ids.astype("<u4").tobytes(), (ends * 4).tolist()
        return [zlib.crc32(data[a:b]) for a, b in zip(at, at[1:])]

    return _documents(spark, path, "ids_crc32 long", crc)


def _documents(spark: SparkSession, path: str, column: str, value) -> DataFrame:
    chunks = spark.read.schema(CHUNK).parquet(path)
    # one row per shard, so the running total over all of them is small
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("size")).selectExpr(
        "shard", "coalesce(sum(size) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING "
        "AND 1 PRECEDING), 0) AS base",
    )
    # a row for each task that wrote, so it may travel to every chunk
    placed = chunks.join(F.broadcast(totals), "shard").withColumn("first", F.col("first") + F.col("base")).drop("base")
    name, kind = column.split(" ", 1)
    out = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
        (name, pa.int64() if kind == "long" else pa.list_(pa.int64())),
    ])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                ids = unpack(
                    np.frombuffer(row["words"].as_py(), np.uint64),
                    np.frombuffer(row["offsets"].as_py(), np.uint32).astype(np.int64),
                    np.frombuffer(row["escaped"].as_py(), np.uint64), row["n_ids"].as_py(),
                )
                counts = row["counts"].values.to_numpy()
                ends = np.concatenate([[0], np.cumsum(counts)])
                yield batch_of(out, **{
                    "doc_id": row["docs"].values, "start": row["first"].as_py() + ends[:-1],
                    "n_tokens": counts, name: value(ids, ends),
                })

    return placed.mapInArrow(run, f"doc_id long, start long, n_tokens long, {column}")


def files_of(docs: DataFrame, spec: bytes, end_id: int) -> str:
    """Write `docs` to a new folder of the shared scratch space; its path."""
    path = new_path(docs.sparkSession, "token-ids")
    write(docs, spec, path, end_id)
    return path
