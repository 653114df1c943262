"""Merkle manifest of a dataset: a proof for every row, by butterfly exchange.

Each group of rows (a source) is a tree over its rows in order of id; the groups' roots, in order of
group, are the leaves of one more tree. Nodes are hashes of runs of FANOUT nodes below.

Rows are put in order by ranges, and a tree is cut into aligned blocks of FANOUT**DEPTH leaves, so a
source that holds most rows is many blocks. A block hashes its own subtree in place. Then blocks meet
in rounds: in round r a block asks one block of each neighbouring subtree of FANOUT**r blocks (the one
at its own place there, so that the asking spreads) for the root it holds, notes the roots as its
proof's next level, and hashes the parent itself. Siblings hash the same parent, each for its own use;
after the last round every block holds its upper proof and the tree's root, and nothing is sent down.

Defined results: a null field is hashed as `-`, an empty text as `0:`, a text of any length whole; a
null group is a group of its own and comes first; rows without id come first in their group; rows that
share an id follow in order of their leaf, repeated rows are leaves each; an empty table gives no row;
columns that aren't hashed are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiplens.sources.scratch import materialise

#: Nodes of a run, and levels that a block of leaves hashes alone.
FANOUT, DEPTH = 3, 7
#: Columns of a row that its leaf covers.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Repeated rows are dealt over as many ranges at most.
SPREAD = 4096
PROOF = "array<struct<before:string,after:string>>"
_PROOF = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def leaf(values: dict[str, Column]) -> Column:
    """The leaf's digest: each value as its length in bytes and itself."""
    parts = [
        F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-"))
        for v in values.values()
    ]
    return F.sha2(F.concat(*parts), 256)


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _levels(nodes: list[str], depth: int | None) -> list[list[str]]:
    """The nodes and all levels above: `depth` of them, or up to a single node."""
    levels = [nodes]
    while len(nodes) > 1 if depth is None else len(levels) <= depth:
        nodes = [_hash("".join(nodes[i : i + FANOUT])) for i in range(0, len(nodes), FANOUT)]
        levels.append(nodes)
    return levels


def _ordered(leaves: DataFrame, name: str) -> DataFrame:
    """(tree, key, leaf, claim) with each row's place in its tree and the tree's size. No tree is put
    in order by one task: rows go by ranges, and a range's rows are counted on from those before."""
    written = materialise(leaves, f"{name}-leaves")  # ranges are drawn from a sample, so it is read twice
    ranges = written.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD))).repartitionByRange(
        "tree", "key", "leaf", "salt"
    ).sortWithinPartitions("tree", "key", "leaf").select(*leaves.columns, F.spark_partition_id().alias("part"))

    def count(batches):
        last, n = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            trees = batch.column("tree").dictionary_encode()
            code = trees.indices.to_numpy()
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            at = np.arange(len(code)) - np.repeat(first, np.diff(np.append(first, len(code))))
            if trees.dictionary[int(code[0])].as_py() == last:
                at[: first[1] if len(first) > 1 else len(at)] += n
            last, n = trees.dictionary[int(code[-1])].as_py(), int(at[-1]) + 1
            yield batch.append_column("at", pa.array(at))

    schema = ranges.withColumn("at", F.lit(0).cast("long")).schema
    rows = materialise(ranges.mapInArrow(count, schema), f"{name}-order")
    # a row for each range that a tree has rows in
    sizes = rows.groupBy("tree", "part").agg(F.count("*").alias("n"))
    tree = W.partitionBy("tree")
    earlier = F.sum("n").over(tree.orderBy("part")) - F.col("n")
    offsets = sizes.select("tree", "part", earlier.alias("before"), F.sum("n").over(tree).alias("leaves"))
    return rows.join(offsets, ["tree", "part"]).select(
        *leaves.columns, (F.col("before") + F.col("at")).alias("place"), "leaves"
    )


def _blocks(leaves: DataFrame, key_type: str, name: str) -> DataFrame:
    """One row a block: its place among the tree's blocks, its leaves in order, its subtree's root."""
    size = FANOUT**DEPTH
    placed = _ordered(leaves, name).withColumns({
        "block": F.floor(F.col("place") / size), "blocks": F.ceil(F.col("leaves") / size),
    }).select("tree", "block", "blocks", "place", "key", "leaf", "claim")

    def subtree(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        nodes = table.column("leaf").to_pylist()
        blocks = table.column("blocks")[0].as_py()
        root = _levels(nodes, None if blocks == 1 else DEPTH)[-1][0]
        key = table.schema.field("key").type
        return pa.table({
            "tree": table.column("tree").slice(0, 1), "block": table.column("block").slice(0, 1),
            "blocks": table.column("blocks").slice(0, 1),
            "keys": pa.array([table.column("key").to_pylist()], pa.list_(key)),
            "leaves": pa.array([nodes], pa.list_(pa.string())),
            "claims": pa.array([table.column("claim").to_pylist()], pa.list_(pa.string())),
            "root": pa.array([root]),
        })

    schema = f"tree string, block long, blocks long, keys array<{key_type}>, leaves array<string>, " \
             "claims array<string>, root string"
    return materialise(placed.groupBy("tree", "block").applyInArrow(subtree, schema), f"{name}-blocks")


def _exchange(blocks: DataFrame, name: str) -> DataFrame:
    """(tree, block, root of the tree, proof from the block's root up), after all rounds."""
    nodes = blocks.select("tree", "block", "blocks", "root", F.array().cast(PROOF).alias("proof"))
    most = nodes.agg(F.max("blocks")).first()[0] or 1
    step, turn = 1, 0
    while step < most:
        own = F.floor(F.col("block") / step)  # the node of this level that the block is part of
        first = (own - own % FANOUT + F.col("k")) * step  # the first block of the run's k-th node
        asked = nodes.where(F.col("blocks") > step).select(
            "tree", "block", "blocks", F.explode(F.sequence(F.lit(0), F.lit(FANOUT - 1))).alias("k")
        ).where((F.col("k") != own % FANOUT) & (first < F.col("blocks"))).select(
            "tree", "block", "k",
            (first + F.col("block") % step % F.least(F.lit(step), F.col("blocks") - first)).alias("partner"),
        )
        told = asked.join(nodes.select("tree", F.col("block").alias("partner"), F.col("root").alias("theirs")),
                          ["tree", "partner"])
        met = told.groupBy("tree", "block").agg(*(
            F.max(F.when(F.col("k") == k, F.col("theirs"))).alias(f"at{k}") for k in range(FANOUT)))
        place = own % FANOUT
        side = lambda keep: F.concat(*(F.when(keep(k), F.coalesce(f"at{k}", F.lit(""))).otherwise("") for k in range(FANOUT)))
        before, after = side(lambda k: place > k), side(lambda k: place < k)
        rises = F.col("blocks") > step
        nodes = materialise(nodes.join(met, ["tree", "block"], "left").select(
            "tree", "block", "blocks",
            F.when(rises, F.sha2(F.concat(before, "root", after), 256)).otherwise(F.col("root")).alias("root"),
            F.when(rises, F.concat("proof", F.array(F.struct(before.alias("before"), after.alias("after"))))).otherwise(
                F.col("proof")).alias("proof"),
        ), f"{name}-round{turn}")
        step, turn = step * FANOUT, turn + 1
    return nodes


def _proofs(blocks: DataFrame, upper: DataFrame, key_type: str, named: Sequence[str]) -> DataFrame:
    """One row a leaf: its key, digest and claim, its whole proof and the columns `named` of `upper`."""
    joined = blocks.drop("root").join(upper.select("tree", "block", "proof", *named), ["tree", "block"])
    schema = f"tree string, key {key_type}, leaf string, claim string, proof {PROOF}, " + \
             ", ".join(f"{n} string" for n in named)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                nodes = row.column("leaves")[0].as_py()
                alone = row.column("blocks")[0].as_py() == 1
                levels = [
                    [{"before": "".join(level[j - j % FANOUT : j]),
                      "after": "".join(level[j + 1 : j - j % FANOUT + FANOUT])} for j in range(len(level))]
                    for level in _levels(nodes, None if alone else DEPTH)[:-1]
                ]
                above = row.column("proof")[0].as_py()
                keys, claims = row.column("keys").flatten(), row.column("claims").flatten()
                tree, tail = row.column("tree")[0].as_py(), [row.column(n)[0].as_py() for n in named]
                for at in range(0, len(nodes), 512):
                    n = min(512, len(nodes) - at)
                    proof = [
                        [level[j // FANOUT**k] for k, level in enumerate(levels)] + above for j in range(at, at + n)
                    ]
                    yield pa.record_batch([
                        pa.array([tree] * n, pa.string()), keys.slice(at, n), pa.array(nodes[at : at + n], pa.string()),
                        claims.slice(at, n), pa.array(proof, _PROOF), *(pa.array([t] * n, pa.string()) for t in tail),
                    ], names=["tree", "key", "leaf", "claim", "proof", *named])

    return joined.mapInArrow(run, schema)


def prove(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
          claim: dict[str, Column] | None = None) -> DataFrame:
    """One row a row of `docs`: id, group, leaf, claim, subroot, root and proof, whose entries are the
    siblings before and after the node, level by level. `claim` replaces values by what somebody else
    says they are; its digest is carried along for `fold`."""
    values = {f: F.col(f) for f in fields}
    key_type = docs.schema[id_col].dataType.simpleString()
    leaves = docs.select(
        # a null group sorts before all others, the empty one included
        F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0")).alias("tree"),
        F.col(id_col).alias("key"), leaf(values).alias("leaf"), leaf(values | (claim or {})).alias("claim"),
    )
    blocks = _blocks(leaves, key_type, "rows")
    nodes = _exchange(blocks, "rows")
    # any block of a tree holds its root; the first stands for it
    tops = nodes.where("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("key"),
                                           F.col("root").alias("leaf"), F.col("root").alias("claim"))
    groups = _blocks(tops, "string", "groups")
    above = _proofs(groups, _exchange(groups, "groups"), "string", ["root"]).select(
        F.col("key").alias("tree"), "root", F.col("proof").alias("last"))
    upper = nodes.select("tree", "block", F.col("root").alias("subroot"), "proof").join(above, "tree").select(
        "tree", "block", "subroot", "root", F.concat("proof", "last").alias("proof"))
    group = F.when(F.col("tree") == "0", F.lit(None)).otherwise(F.expr("substr(tree, 2)"))
    return _proofs(blocks, upper, key_type, ["subroot", "root"]).select(
        F.col("key").alias(id_col), group.alias(group_col), "leaf", "claim", "subroot", "root", "proof")


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf's digest and a proof lead to."""
    return F.aggregate(proof, start, lambda node, p: F.sha2(F.concat(p["before"], node, p["after"]), 256))


def digest(proved: DataFrame, id_col: str = "doc_id") -> DataFrame:
    siblings = F.array_join(F.transform("proof", lambda p: F.concat(p["before"], p["after"])), "")
    folded = fold(F.col("claim"), F.col("proof"))
    return proved.select(id_col, "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                         folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered(text_col: str = "text", id_col: str = "doc_id") -> dict[str, Column]:
    """The claim of the registered query: documents of even checksum lost their line feeds."""
    even = F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0
    return {text_col: F.when(even, F.replace(F.col(text_col), F.lit("\n"), F.lit(""))).otherwise(F.col(text_col))}


def digest_sql(levels: int = 13, tops: int = 7) -> str:
    """The query's rows in DuckDB, for trees of at most 3**levels rows and 3**tops sources."""
    table = []
    for i in range(256):
        for _ in range(8):
            i = i >> 1 ^ (0xEDB88320 if i & 1 else 0)
        table.append(i)
    fields = [f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in FIELDS]
    told = [*fields[:-1], "coalesce(strlen(told) || ':' || told, '-')"]
    ctes = [f"""
numbered AS (
  SELECT *, coalesce(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])), 4294967295) AS crc FROM documents
), hashed AS (
  SELECT doc_id, coalesce('1' || source, '0') AS tree, sha256({' || '.join(fields)}) AS leaf,
    sha256({' || '.join(told)}) AS claim
  FROM (SELECT *, CASE WHEN xor(crc, 4294967295) % 2 = 0 AND doc_id IS NOT NULL THEN replace(text, chr(10), '') ELSE text END AS told FROM numbered)
), n0 AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM hashed
), l0 AS (SELECT tree, place AS p, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM n0)"""]

    def rise(kind: str, k: int) -> str:
        return f"""
{kind}{k + 1} AS (
  SELECT tree, p // 3 AS p, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY p)) ELSE any_value(h) END AS h,
    (any_value(n) + 2) // 3 AS n FROM {kind}{k} GROUP BY tree, p // 3
)"""

    def siblings(kind: str, k: int) -> str:
        """Of each node: what stands before and after it in its run."""
        return f"""
{kind}s{k} AS (
  SELECT tree, p, n, coalesce(lag(h, 2) OVER w, '') || coalesce(lag(h) OVER w, '') AS b,
    coalesce(lead(h) OVER w, '') || coalesce(lead(h, 2) OVER w, '') AS a FROM {kind}{k}
  WINDOW w AS (PARTITION BY tree, p // 3 ORDER BY p)
)"""

    ctes += [f(k) for k in range(levels) for f in (lambda k: siblings("l", k), lambda k: rise("l", k))]
    ctes.append(f"""
t0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS p, h, count(*) OVER () AS n, tree AS own FROM l{levels})""")
    ctes += [f(k) for k in range(tops) for f in (lambda k: siblings("t", k), lambda k: rise("t", k))]
    ctes.append("""
f0 AS (
  SELECT d.doc_id, d.tree, d.leaf, d.claim AS f, '' AS proof, d.place, t0.p AS top, t0.h AS subroot FROM n0 d JOIN t0 ON t0.own = d.tree
)""")
    at = 0
    for kind, count, place in (("l", levels, "place"), ("t", tops, "top")):
        for k in range(count):
            tree = "f.tree" if kind == "l" else "''"
            ctes.append(f"""
f{at + 1} AS (
  SELECT f.* REPLACE (CASE WHEN s.n > 1 THEN sha256(s.b || f.f || s.a) ELSE f.f END AS f, f.proof || s.b || s.a AS proof)
  FROM f{at} f JOIN {kind}s{k} s ON s.tree = {tree} AND s.p = f.{place} // {3**k}
)""")
            at += 1
    return "WITH" + ",".join(ctes) + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM f{at} CROSS JOIN (SELECT h AS root FROM t{tops})"""
