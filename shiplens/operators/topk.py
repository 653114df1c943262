"""Exact filtered top-k by dot product of unit vectors.

The filter is an equality on `slot`, applied before anything is scored, and scored pairs
never become rows: a task multiplies a share of the queries with a share of the items, block
by block, and emits the best k per query. Both sides of a slot are dealt into shares, and the
shares' winners are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiplens.sources.scratch import materialise

ITEMS_PER_BLOCK = 20_000
QUERIES_PER_BLOCK = 5_000
CELLS_PER_PRODUCT = 1_000_000
PAIRS_AT_A_TIME = 8_192
DIGITS = 6
#: Rows of a side that a task holds, unless a block has more, and shares that a slot of fewer rows is dealt into.
ROWS_PER_SHARE, SHARES = 32_768, 8
RESULT = "query_id string, slot string, item_id string, score double, rank int"


def _squares(vectors: np.ndarray):
    """The largest squared length of each few thousand vectors."""
    for at in range(0, len(vectors), PAIRS_AT_A_TIME):
        yield (vectors[at:at + PAIRS_AT_A_TIME].astype(np.float64) ** 2).sum(1).max()


def _best(rows: np.ndarray, cols: np.ndarray, found: np.ndarray, k: int):
    """Of scored pairs the k best of each row, in order, and their places from 0."""
    order = np.lexsort((cols, -found, rows))
    rows, cols, found = rows[order], cols[order], found[order]
    first = np.r_[0, np.flatnonzero(np.diff(rows)) + 1]
    place = np.arange(len(rows)) - np.repeat(first, np.diff(np.r_[first, len(rows)]))
    keep = place < k
    return rows[keep], cols[keep], found[keep], place[keep]


def best_of(
    queries: np.ndarray, items: np.ndarray, k: int,
    items_per_block: int = ITEMS_PER_BLOCK, queries_per_block: int = QUERIES_PER_BLOCK,
):
    """(query row, item row, score, rank) of the k best items per query, ties to the lower.

    A single-precision product names the candidates: everything within twice its error
    bound, and the rounding unit, of the k-th best of the first product, or of the k-th best
    found since. Only those are scored in double precision and rounded, so equal vectors tie
    whatever block they met in. A product takes blocks of items side by side while it stays small.
    """
    out = []
    n, d = items.shape
    wide = min(n, max(items_per_block, CELLS_PER_PRODUCT // queries_per_block))
    step = max(1, min(queries_per_block, CELLS_PER_PRODUCT // max(1, wide)))
    size = np.sqrt(max(_squares(queries)) * max(_squares(items)))
    slack = 2 * (d + 2) * np.finfo(np.float32).eps * size + 2 * 10.0 ** -DIGITS
    for start in range(0, len(queries), step):
        block = queries[start:start + step].astype(np.float64)
        single, least = block.astype(np.float32), np.full((len(block), 1), -np.inf)
        rows, cols, place = (np.zeros(0, np.int64) for _ in range(3))
        found = np.zeros(0)
        for begin in range(0, n, wide):
            rough = single @ items[begin:begin + wide].T
            if not begin and k < wide:
                least = np.partition(rough, wide - k, axis=1)[:, wide - k, None] - slack
            near, far = np.divmod(np.flatnonzero(rough >= least.astype(np.float32)), rough.shape[1])
            if not len(near):
                continue
            scores = np.empty(len(near))
            for at in range(0, len(near), PAIRS_AT_A_TIME):  # ties may name every cell
                part = slice(at, at + PAIRS_AT_A_TIME)
                scores[part] = np.einsum(
                    "ij,ij->i", block[near[part]], items[begin + far[part]].astype(np.float64))
            rows, cols, found, place = _best(
                np.r_[rows, near], np.r_[cols, begin + far], np.r_[found, np.round(scores, DIGITS)], k)
            last = place == k - 1
            least[rows[last], 0] = found[last] - slack
        out.append((rows + start, cols, found, place + 1))
    return tuple(np.concatenate(part) for part in zip(*out))


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """One row a vector, of the type they come in."""
    if vectors.null_count:
        raise ValueError("A vector is null")
    lists = vectors.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _copies(vectors: np.ndarray) -> np.ndarray:
    """The same number for equal rows."""
    rows = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.itemsize * vectors.shape[1])))
    return np.unique(rows.ravel(), return_inverse=True)[1]


def _firsts(copies: np.ndarray, k: int) -> np.ndarray:
    """Which rows are among the first k of their copies; later ones lose every tie."""
    order = np.argsort(copies, kind="stable")
    first = np.r_[0, np.flatnonzero(np.diff(copies[order])) + 1]
    place = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    return np.sort(order[place < k])


def _winners(queries: pa.Table, items: pa.Table, schema: pa.Schema, items_per_block: int, queries_per_block: int):
    """Best items for queries of one slot; each query row carries its own k."""
    items = items.take(pc.sort_indices(items["item_id"]))
    vectors, parts = _matrix(items["vector"]).astype(np.float32, copy=False), []
    same = _copies(vectors)
    for k in pc.unique(queries["k"]).to_pylist():
        if k is None or k <= 0:
            continue
        group = queries.filter(pc.equal(queries["k"], k))
        asked, kept = _matrix(group["vector"]), _firsts(same, k)
        copies = _copies(asked)
        own = _firsts(copies, 1)  # one of each text; the others get what it gets
        rows, cols, found, rank = best_of(asked[own], vectors[kept], k, items_per_block, queries_per_block)
        number = np.empty(len(own), np.int64)
        number[copies[own]] = np.arange(len(own))
        begin = np.searchsorted(rows, np.arange(len(own) + 1))
        each, mine = np.diff(begin), number[copies]
        at = np.repeat(np.arange(len(mine)), each[mine])
        of = np.arange(len(at)) - np.repeat(np.cumsum(each[mine]) - each[mine], each[mine]) + begin[mine][at]
        parts.append(pa.Table.from_arrays([
            group["query_id"].take(pa.array(at)), group["slot"].take(pa.array(at)),
            items["item_id"].take(pa.array(kept[cols[of]])), pa.array(found[of]),
            pa.array(rank[of].astype(np.int32)),
        ], schema=schema))
    return pa.concat_tables([schema.empty_table(), *parts])


def _limited(found: pa.Table, queries: pa.Table, schema: pa.Schema) -> pa.Table:
    """Winners of one slot as they stand once merged: ranked for each query id, cut by each k asked with it."""
    found = found.filter(pc.is_valid(found["query_id"]))
    if pc.count_distinct(queries["query_id"], mode="all").as_py() == queries.num_rows:
        return found
    found = found.sort_by([("query_id", "ascending"), ("score", "descending"), ("item_id", "ascending")])
    ids = found["query_id"].combine_chunks().dictionary_encode().indices.to_numpy()
    first = np.flatnonzero(np.r_[True, np.diff(ids) != 0]) if len(ids) else np.zeros(0, int)
    rank = np.arange(len(ids)) - np.repeat(first, np.diff(np.r_[first, len(ids)])) + 1
    ranked = found.set_column(4, "rank", pa.array(rank.astype(np.int32)))
    both = ranked.join(queries.select(["query_id", "k"]), "query_id", join_type="inner")
    return both.filter(pc.less_equal(both["rank"], both["k"])).select(schema.names).cast(schema)


def _packed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """`rows` with many rows of like keys in one, compressed: vectors are long, and mostly zeros."""
    from_keys = rows.select(*keys).schema
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in from_keys) + ", packed binary"
    def bundles(held: list[pa.RecordBatch]):
        table = pa.Table.from_batches(held).combine_chunks().sort_by([(k, "ascending") for k in keys])
        codes = [table[k].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False) for k in keys]
        starts = np.flatnonzero(np.r_[True, np.any([np.diff(c) != 0 for c in codes], axis=0)])
        payload, out, options = table.drop_columns(keys), [], pa.ipc.IpcWriteOptions(compression="zstd")
        for a, b in zip(starts, np.r_[starts[1:], table.num_rows]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, payload.schema, options=options) as writer:
                writer.write_table(payload.slice(a, b - a).combine_chunks())
            out.append(sink.getvalue().to_pybytes())
        firsts = table.select(keys).take(pa.array(starts))
        yield from firsts.append_column("packed", pa.array(out, pa.binary())).combine_chunks().to_batches()

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held, n = [*held, batch], n + batch.num_rows
            if n >= ROWS_PER_SHARE:
                yield from bundles(held)
                held, n = [], 0
        if n:
            yield from bundles(held)

    return rows.mapInArrow(run, schema)


def _unpacked(rows: pa.Table) -> pa.Table:
    """The rows of one group, with the slot they share."""
    table = pa.concat_tables([pa.ipc.open_stream(part.as_buffer()).read_all() for part in rows["packed"]])
    return table.append_column("slot", pa.repeat(rows["slot"][0], table.num_rows))


def _blocked(
    queries: DataFrame, items: DataFrame, items_per_block: int, queries_per_block: int
) -> DataFrame:
    def shares(df: DataFrame, size: int, name: str) -> DataFrame:
        """Shares of each slot: so few that a row isn't sent once for every block of the other side."""
        n = F.count("*")
        held = F.greatest(F.ceil(n / F.lit(ROWS_PER_SHARE)), F.lit(SHARES))
        return df.groupBy("slot").agg(F.least(F.ceil(n / F.lit(size)), held).cast("int").alias(name))

    # One row per slot, written so that its own size decides whether it is broadcast: a join's
    # guessed size is the product of its sides', beside which the rows with their vectors look small.
    sizes = materialise(shares(items, items_per_block, "item_shares").join(
        shares(queries, queries_per_block, "query_shares"), "slot"), "sizes")

    def placed(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        """Rows in one share of their own side, repeated for every share of the other."""
        return (
            df.join(sizes, "slot")
            .withColumn(own[:-1], F.pmod(F.xxhash64(key), F.col(own)).cast("int"))
            .withColumn(other[:-1], F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            .drop("item_shares", "query_shares")
        )

    left = placed(queries.select("query_id", "slot", "k", "vector"), "query_id",
                  "query_shares", "item_shares")
    # named anew, as both sides may come from one table
    renamed = items.select(*[F.col(c).alias(c) for c in ("slot", "item_id", "vector")])
    right = placed(renamed, "item_id", "item_shares", "query_shares")
    keys = ["slot", "item_share", "query_share"]
    schema = pa.schema([("query_id", pa.string()), ("slot", pa.string()), ("item_id", pa.string()),
                        ("score", pa.float64()), ("rank", pa.int32())])
    whole = sizes.agg(F.max("item_shares")).first()[0] in (None, 1)  # one number

    def run(q: pa.Table, i: pa.Table) -> pa.Table:
        if not q.num_rows or not i.num_rows:
            return schema.empty_table()
        q, i = _unpacked(q), _unpacked(i)
        found = _winners(q, i, schema, items_per_block, queries_per_block)
        return _limited(found, q, schema) if whole else found

    winners = _packed(left, keys).groupBy(*keys).cogroup(_packed(right, keys).groupBy(*keys)).applyInArrow(run, RESULT)
    if whole:  # each slot's items were together, so nothing is left to merge
        return winners
    place = F.row_number().over(
        Window.partitionBy("query_id", "slot").orderBy(F.desc("score"), "item_id"))
    # A row per query: files of like rows are many times smaller than the rows a broadcast would hold.
    limits = queries.select("query_id", "slot", "k").hint("merge")
    return winners.withColumn("rank", place).join(limits, ["query_id", "slot"]).where(
        F.col("rank") <= F.col("k")).drop("k")


def filtered_topk(
    queries: DataFrame, items: DataFrame, *,
    items_per_block: int = ITEMS_PER_BLOCK, queries_per_block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """`queries` (query_id, slot, k, vector) and `items` (slot, item_id, vector) to
    (query_id, slot, item_id, score, rank). Ids are strings; vectors are unit arrays."""
    return _blocked(queries, items, items_per_block, queries_per_block)
