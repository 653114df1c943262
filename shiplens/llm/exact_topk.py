"""Exact top-k search by tiled matrix products.

Queries are dealt into tiles and candidates into blocks; each tile meets each block in one matrix
product, of which only a tile's k best per query are kept. A task merges the lists of the products
it makes, and Spark merges the tasks' lists, first within and then across partitions.

Vectors become integers floor(scale * x), so scores are exact: products whose sums fit 53 bits use
floating-point matrices, others Python's integers, held to the range of a long. Ties go to the
smaller id.

Defined results: a vector that is null or holds a null or non-finite component, and a row without
id, take no part; rows alike in id and vector count once; a query meets every candidate of its own
length but those with its id; further columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiplens.llm.rows import batch_of

#: Vectors of one tile of queries and of one block of candidates.
TILE, BLOCK = 1024, 4096
#: Blocks that one task multiplies with a tile.
SHARE = 4
LONG = (1 << 63) - 1


def vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, vector) of whole rows, the components as whole numbers held in doubles."""
    vector = F.col(vector_col).cast("array<double>")
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    valid = F.col(id_col).isNotNull() & vector.isNotNull() & F.coalesce(whole, F.lit(False))
    scaled = F.transform(vector, lambda x: x * F.lit(float(scale)))
    return rows.where(valid).select(F.col(id_col).cast("long").alias("id"), scaled.alias("vector")).distinct()


def _packed(rows: DataFrame, n: int) -> DataFrame:
    """Rows dealt by id into n parts; one row per part, vector length and run of at most BLOCK."""
    schema = pa.schema([
        ("part", pa.int32()), ("size", pa.int32()), ("ids", pa.binary()), ("matrix", pa.binary()),
    ])

    def run(batches):
        part = TaskContext.get().partitionId()
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def row(size: int):
            ids = np.concatenate([h[0] for h in held[size]])
            matrix = np.concatenate([h[1] for h in held.pop(size)])
            order = np.argsort(ids, kind="stable")
            return batch_of(schema, part=[part], size=[size], ids=[ids[order].tobytes()],
                            matrix=[matrix[order].tobytes()])

        for batch in batches:
            ids = batch.column("id").to_numpy()
            lists = batch.column("vector")
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            flat = np.floor(pc.list_flatten(lists).to_numpy(zero_copy_only=False))
            ends = np.cumsum(sizes)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                matrix = flat[(ends[at] - size)[:, None] + np.arange(size)[None, :]]
                for a in range(0, len(at), BLOCK):
                    held.setdefault(size, []).append((ids[at[a : a + BLOCK]], matrix[a : a + BLOCK]))
                    if sum(len(h[0]) for h in held[size]) >= BLOCK:
                        yield row(size)
        for size in list(held):
            yield row(size)

    return rows.repartition(n, "id").mapInArrow(run, "part int, size int, ids binary, matrix binary")


def product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer scores of whole-number matrices, exact."""
    size = q.shape[1]
    if not size:
        return np.zeros((len(q), len(c)), np.int64)
    if float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * size < 2.0**50:
        return (q @ c.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in q.tolist()], object).reshape(q.shape)
    other = np.array([[int(x) for x in row] for row in c.tolist()], object).reshape(c.shape)
    return np.array(
        [[max(-LONG - 1, min(LONG, int(v))) for v in row] for row in exact.dot(other.T).tolist()], np.int64
    ).reshape(len(q), len(c))


def _tile_top(q_ids, q, c_ids, c, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of each query's best in one block of ids in ascending order."""
    scores = product(q, c)
    own = q_ids[:, None] == c_ids[None, :]
    place = np.arange(len(c_ids))[None, :]
    if np.abs(scores.astype(np.float64)).max(initial=0) < 2.0**45:
        keys = np.where(own, -(1 << 62), scores * BLOCK * 2 - place)
    else:  # ranks in place of keys that would not fit
        order = np.lexsort((np.broadcast_to(place, scores.shape), -scores, own), axis=1)
        keys = np.empty_like(scores)
        np.put_along_axis(keys, order, -np.broadcast_to(place, scores.shape), 1)
    if len(c_ids) > k:
        top = np.argpartition(-keys, k - 1, axis=1)[:, :k]
    else:
        top = np.broadcast_to(place, scores.shape)
    rows = np.broadcast_to(np.arange(len(q_ids))[:, None], top.shape)
    kept = ~own[rows, top]
    return q_ids[rows[kept]], c_ids[top[kept]], scores[rows[kept], top[kept]]


def _merged(query, other, score, k: int):
    order = np.lexsort((other, -score, query))
    query, other, score = query[order], other[order], score[order]
    first = np.concatenate([[True], query[1:] != query[:-1]])
    begin = np.maximum.accumulate(np.where(first, np.arange(len(query)), 0))
    kept = np.arange(len(query)) - begin < k
    return query[kept], other[kept], score[kept]


def top_k(rows: DataFrame, is_query: Column, k: int, scale: int = 256,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): each query's k best among all other rows."""
    clean = vectors(rows, id_col, vector_col, scale)
    # is_query is a condition on the id, which is what the cleaned rows keep
    queries = clean.withColumnRenamed("id", id_col).where(is_query).withColumnRenamed(id_col, "id")
    n_tiles = max(1, -(-queries.count() // TILE))
    n_blocks = max(1, -(-rows.count() // BLOCK))
    # a task gets one tile and a few blocks, however many blocks there are
    n_shares = -(-n_blocks // SHARE)
    tiles = _packed(queries, n_tiles).select(
        F.col("part").alias("tile"), "size", F.col("ids").alias("q_ids"), F.col("matrix").alias("q"),
        F.explode(F.sequence(F.lit(0), F.lit(n_shares - 1))).alias("share"),
    )
    blocks = _packed(clean, n_blocks).select(
        F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1))).alias("tile"), "size",
        F.pmod("part", F.lit(n_shares)).alias("share"), "ids", "matrix",
    )
    schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                q_ids, c_ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                q = np.frombuffer(row["q"]).reshape(len(q_ids), row["size"])
                c = np.frombuffer(row["matrix"]).reshape(len(c_ids), row["size"])
                held.append(_tile_top(q_ids, q, c_ids, c, k))
                if sum(len(h[0]) for h in held) > 32 * TILE * k:
                    held = [_merged(*map(np.concatenate, zip(*held)), k)]
        if held:
            query, other, score = _merged(*map(np.concatenate, zip(*held)), k)
            yield batch_of(schema, query_id=query, id=other, score=score)

    pairs = blocks.join(tiles, ["tile", "size", "share"]).select("size", "ids", "matrix", "q_ids", "q")
    lists = pairs.mapInArrow(run, "query_id long, id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return lists.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"
    )
