"""MinHash near-duplicates with tensored banding.

Two small collections of MinHash groups are made per document, and every pair of a group of the
first and one of the second forms a table key: SIDE * SIDE tables from 2 * SIDE * ROWS hashes in
place of SIDE * SIDE * 2 * ROWS. Documents that share a key are candidates, and every link is
confirmed on the full sets of shingles.

Documents alike in their sets are one class and enter once. A table key's members first meet two
of their number, the smallest and the smallest that has copies (or the largest); links confirmed so far join them into
components. What a key still leaves apart, the members outside its largest component, then meets
that component and one another in blocks. So every two members of a key are compared or already
joined, no key's pairs are listed, and a key of any size is spread over tasks.

A pair at similarity 0.75 shares no key with probability 1e-4, at 0.8 with 1e-5, at 0.85 with
less than 1e-6: (1 - (1 - J**ROWS)**SIDE)**2 is the chance of a shared key.

Defined results: a null text, or one without words, has the empty set and is linked with nothing;
rows that share an id are one vertex; a row without id is linked with nothing and kept (its
component is null); further columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.llm.components import components
from shiplens.llm.rows import batch_of, slices
from shiplens.llm.words import mix, shared, shingle_sets
from shiplens.sources.scratch import materialise

#: Words of a shingle; percentage of the union two sets must share.
WORDS, SHARE = 5, 75
#: MinHash groups of each collection, and hashes of a group.
SIDE, ROWS = 12, 2
#: Documents of one run of comparisons with a hub, and of the two sides of a block.
SPAN, LEFT, RIGHT = 128, 256, 1024
_RANDOM = np.random.default_rng(1907)
_TIMES = _RANDOM.integers(1, 1 << 63, 2 * SIDE * ROWS, dtype=np.uint64) | np.uint64(1)
_PLUS = _RANDOM.integers(1, 1 << 63, 2 * SIDE * ROWS, dtype=np.uint64)


def groups(sets: list[np.ndarray]) -> np.ndarray:
    """The 2 * SIDE group values of each non-empty set, the first collection's before the second's."""
    if not sets:
        return np.zeros((0, 2 * SIDE), np.uint64)
    flat = np.concatenate(sets)
    begins = np.cumsum([0] + [len(s) for s in sets[:-1]])
    low = np.stack([np.minimum.reduceat(flat * t + p, begins) for t, p in zip(_TIMES, _PLUS)], 1)
    out = np.zeros((len(sets), 2 * SIDE), np.uint64)
    for r in range(ROWS):
        out = mix(out + low[:, r::ROWS] + np.uint64(r + 1))
    return out


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, n_shingles, same, left, right): `same` is equal for equal sets and null for empty ones."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    schema = pa.schema([
        ("doc", pa.int64()), ("n_shingles", pa.int64()), ("same", pa.binary()),
        ("left", pa.list_(pa.int64())), ("right", pa.list_(pa.int64())),
    ])

    def run(batches):
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column("text"), WORDS)
            made = iter(groups([s for s in sets if len(s)]).view(np.int64).tolist())
            rows = [next(made) if len(s) else None for s in sets]
            yield batch_of(
                schema, doc=part.column("doc"), n_shingles=[len(s) for s in sets],
                same=[hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                left=[r and r[:SIDE] for r in rows], right=[r and r[SIDE:] for r in rows],
            )

    return rows.mapInArrow(
        run, "doc long, n_shingles long, same binary, left array<long>, right array<long>"
    )


def _members(classes: DataFrame) -> DataFrame:
    """(key, doc, low, top, size) of keys that two classes share."""
    tables = F.flatten(F.transform("left", lambda x, i: F.transform(
        "right", lambda y, j: F.xxhash64(x, y, i, j)
    )))
    # a class becomes many rows, so the few files that hold them are dealt out first
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = classes.repartition(n, "doc").select("doc", "copies", F.explode(tables).alias("key"))
    copied = F.min(F.when(F.col("copies") > 1, F.col("doc")))
    wide = keys.groupBy("key").agg(
        F.count("*").alias("size"), F.min("doc").alias("low"), F.coalesce(copied, F.max("doc")).alias("top"),
    ).where("size > 1")
    return keys.select("key", "doc").join(wide, "key")


def _confirm(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Links (a, b) among rows (keys..., side, doc, label, text): within equal keys, every document
    of side 1 meets those of side 0, unless both have one label. Side 0 comes first in a task and
    is bounded by how the keys were made; side 1 streams past it."""
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "side")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        at, held, flat, owner, sizes = None, [], None, None, None
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column("text"), WORDS)
            plain = {c: part.column(c).to_pylist() for c in (*keys, "side", "doc", "label")}
            out: tuple[list, list] = ([], [])
            for i, own in enumerate(sets):
                key = tuple(plain[k][i] for k in keys)
                if key != at:
                    at, held, flat = key, [], None
                doc, label = plain["doc"][i], plain["label"][i]
                if plain["side"][i] == 0:
                    held.append((doc, label, own))
                    flat = None
                    continue
                if not held or not len(own):
                    continue
                if flat is None:
                    flat = np.concatenate([h[2] for h in held])
                    sizes = np.array([len(h[2]) for h in held])
                    owner = np.repeat(np.arange(len(held)), sizes)
                if len(held) == 1:
                    common = np.array([shared(own, flat)])
                else:
                    place = np.minimum(np.searchsorted(own, flat), len(own) - 1)
                    common = np.bincount(owner[own[place] == flat], minlength=len(held))
                near = 100 * common >= SHARE * (sizes + len(own) - common)
                for k in np.flatnonzero(near).tolist():
                    other, its, _ = held[k]
                    if other != doc and (label is None or label != its):
                        out[0].append(min(other, doc))
                        out[1].append(max(other, doc))
            if out[0]:
                yield batch_of(schema, a=out[0], b=out[1])

    return dealt.mapInArrow(run, "a long, b long")


def _with_hubs(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links of members with the two hubs of their keys."""
    pairs = members.select(F.explode(F.array("low", "top")).alias("hub"), "doc").where("hub <> doc").distinct()
    parts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / SPAN).cast("int").alias("parts"))
    others = pairs.join(parts, "hub").select(
        "hub", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("side"), "doc"
    )
    hubs = parts.select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("side"),
        F.col("hub").alias("doc"),
    )
    rows = hubs.union(others).withColumn("label", F.lit(None).cast("long")).join(texts, "doc")
    return _confirm(rows, ["hub", "part"])


def _apart(members: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Links among what the hubs left apart within a key."""
    known = members.where("size > 2").select("key", "doc").join(
        labels.withColumnRenamed("node", "doc"), "doc", "left"
    ).withColumn("label", F.coalesce("component", "doc")).drop("component")
    counted = known.groupBy("key", "label").agg(F.count("*").alias("n"))
    largest = counted.groupBy("key").agg(
        F.max(F.struct("n", (-F.col("label")).alias("least"))).alias("most"), F.count("*").alias("kinds")
    ).where("kinds > 1").select("key", (-F.col("most.least")).alias("main"))
    loose = materialise(
        known.join(largest, "key").where("label <> main").select("main", "doc", "label").distinct(), "loose"
    )
    main = loose.select("main").distinct()
    inside = labels.select(F.col("component").alias("main"), F.col("node").alias("doc"), F.col("component").alias("label"))
    alone = main.select("main", F.col("main").alias("doc"), F.col("main").alias("label"))
    whole = inside.join(main, "main").union(alone).union(loose.select("main", "doc", "label")).distinct()
    blocks = loose.groupBy("main").agg(F.ceil(F.count("*") / LEFT).cast("int").alias("lefts")).join(
        whole.groupBy("main").agg(F.ceil(F.count("*") / RIGHT).cast("int").alias("rights")), "main"
    )
    block = lambda n: F.pmod(F.xxhash64("doc"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = loose.join(blocks, "main").select(
        "main", block("lefts").alias("l"), every("rights").alias("r"), F.lit(0).alias("side"), "doc", "label"
    )
    right = whole.join(blocks, "main").select(
        "main", every("lefts").alias("l"), block("rights").alias("r"), F.lit(1).alias("side"), "doc", "label"
    )
    return _confirm(left.union(right).join(texts, "doc"), ["main", "l", "r"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row: the component is named by its smallest
    id, whose document is the one that is kept."""
    sketches = materialise(sketch(docs, id_col, text_col), "sketches")
    whole = sketches.where("same IS NOT NULL AND doc IS NOT NULL")
    classes = materialise(whole.groupBy("same").agg(
        F.min("doc").alias("doc"), F.count("*").alias("copies"), F.first("left").alias("left"),
        F.first("right").alias("right"),
    ), "classes")
    members = materialise(_members(classes), "members")
    involved = members.select("doc").distinct()
    texts = materialise(
        docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
        .join(involved, "doc", "left_semi"), "texts"
    )
    # rows of one vertex hang together whatever their texts are
    same_set = whole.join(classes.select("same", F.col("doc").alias("a")), "same").where("a <> doc").select(
        "a", F.col("doc").alias("b")
    ).distinct()
    links = materialise(_with_hubs(members, texts), "links")
    labels = components(links)
    more = materialise(_apart(members, labels, texts), "links")
    found = components(same_set.union(links).union(more))
    return sketches.join(found, sketches.doc == found.node, "left").select(
        F.col("doc").alias(id_col), "n_shingles",
        F.coalesce("component", "doc").alias("component_id"),
        F.coalesce(F.col("doc") == F.coalesce("component", "doc"), F.lit(True)).alias("kept"),
    )
