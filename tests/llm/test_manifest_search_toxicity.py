"""The manifest, ranked search and toxicity beside plain restatements."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from shiplens.llm import merkle, ranked_search, toxicity
from tests.llm.cases import CLASHING, SCHEMA, corpus, documents, words

def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- manifest


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree_by_hand(leaves):
    """(root, each leaf's list of (siblings before, siblings after))."""
    proofs, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for i, proof in enumerate(proofs):
            j = at[i]
            run = nodes[j - j % 3 : j - j % 3 + 3]
            proof.append(("".join(run[: j % 3]), "".join(run[j % 3 + 1 :])))
            at[i] = j // 3
        nodes = [H(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)]
    return nodes[0], proofs


def manifest_by_hand(rows):
    """rows of (doc_id, source, lang, n_chars, text)."""
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs, members = [], []
    for s in order:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_by_hand(r)))
        subs.append(tree_by_hand([leaf_by_hand(r) for r in own]))
        members.append(own)
    if not subs:
        return []
    root, tops = tree_by_hand([s[0] for s in subs])
    out = []
    for (sub, proofs), own, top in zip(subs, members, tops):
        for r, proof in zip(own, proofs):
            whole = proof + top
            told = list(r)
            if r[0] is not None and crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                told[4] = r[4].replace("\n", "")
            node = leaf_by_hand(told)
            for before, after in whole:
                node = H(before, node, after)
            out.append((r[0], leaf_by_hand(r), sub, root, H(*(b + a for b, a in whole)), node, node == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("depth", [1, 2, 7])
@pytest.mark.parametrize("sources", [1, 9])
def test_manifest_equals_plain_trees(spark, monkeypatch, depth, sources):
    monkeypatch.setattr(merkle, "DEPTH", depth)
    rng = random.Random(depth)
    rows = []
    for i, text in corpus(depth):
        source = rng.choice([None, "", "é", "src0", "src0", *[f"s{k}" for k in range(sources)]]) if sources > 1 else "a"
        rows.append((i, text, rng.choice([None, "en"]), source, rng.choice([None, 0, 12345678901])))
    rows += [rows[5]] * 4 + [(None, None, None, rows[0][3], None), (-3, "a\nb", "", rows[0][3], -7), (2, "x\n" * 50_000, "en", "long", 7)]
    docs = spark.createDataFrame([(*r, 1, "k", "t", "l", "x", "p", 2, "w") for r in rows], f"{SCHEMA}, {CLASHING}")
    got = merkle.digest(merkle.prove(docs.repartition(5), claim=merkle.tampered()))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = manifest_by_hand([(r[0], r[3], r[2], r[4], r[1]) for r in rows])
    assert collected(got) == want
    assert {v for *_, v in want} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 9, 10, 28])
def test_manifest_of_few_rows(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "DEPTH", 1)
    docs = documents(spark, [(i, f"t{i}\n") for i in range(n)])
    want = manifest_by_hand([(i, "src0", "en", len(f"t{i}\n"), f"t{i}\n") for i in range(n)])
    assert collected(merkle.digest(merkle.prove(docs, claim=merkle.tampered()))) == want


def test_a_source_of_most_rows_is_many_blocks(spark, monkeypatch):
    """No group of the jobs holds more than a block, however many rows a source has."""
    monkeypatch.setattr(merkle, "DEPTH", 2)
    docs = documents(spark, [(i, "t") for i in range(500)])
    blocks = merkle._blocks(docs.select(F.lit("1a").alias("tree"), F.col("doc_id").alias("key"), F.lit("x").alias("leaf"),
                                        F.lit("x").alias("claim")), "bigint", "t")
    sizes = [r[0] for r in blocks.select(F.size("leaves")).collect()]
    assert max(sizes) == 9 and sum(sizes) == 500 and len(sizes) == 56


# ---- search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_by_hand(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def search_by_hand(docs, items, k):
    held = [(i, Counter(terms_by_hand(t)), len(terms_by_hand(t))) for i, t in docs]
    n = sum(1 for *_, c in held if c)
    total = sum(c for *_, c in held)
    df = Counter(t for _, tf, _ in held for t in tf)
    out = []
    for item, text in {x for x in items if x[1] is not None}:
        asked = Counter(terms_by_hand(text))
        scored = []
        for i, tf, c in held:
            m = 75 + 25 * c * n // max(total, 1)
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 12 * m))
                    for t, q in asked.items() if tf[t])
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block, step", [(4096, 128), (16, 2)])
def test_search_equals_brute_force(spark, monkeypatch, block, step):
    monkeypatch.setattr(ranked_search, "BLOCK_ROWS", block)
    monkeypatch.setattr(ranked_search, "LEAST_ROWS", min(block, 256))
    monkeypatch.setattr(ranked_search, "STEP", step)
    rng = random.Random(step)
    rows = corpus(3, 90) + [(2000 + i, words(rng, 30, 40)) for i in range(200)] + [(5, "ÄÖ x-y_z 12a")] * 3
    items = [(i, words(rng, rng.randrange(1, 90), 40)) for i in range(25)]
    items += [(100, None), (101, ""), (102, "nobodyhasthis"), (103, "Äö äö 12A Z y w1 w1 w1"), (103, "one two"), (1, items[1][1]),
              (None, "word"), (104, words(rng, 300, 4000))]
    docs = documents(spark, rows, clashing=True).repartition(3)
    asked = spark.createDataFrame([(*x, 1, 2) for x in items], "item_id long, text string, item int, rank int")
    got = collected(ranked_search.search(docs, asked, k=20))
    assert got == search_by_hand(rows, items, 20)
    assert ranked_search.search(docs, asked.limit(0)).count() == 0
    assert ranked_search.search(docs.limit(0), asked).count() == 0


def test_items_go_out_in_passes(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "PASS_TERMS", 12)
    rng = random.Random(1)
    rows = [(i, words(rng, 20, 30)) for i in range(60)]
    items = [(i, words(rng, 6, 30)) for i in range(12)]
    assert len(ranked_search._items([t for _, t in items])) > 2
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert collected(ranked_search.search(documents(spark, rows), asked, k=5)) == search_by_hand(rows, items, 5)


def test_groups_below_the_last_score_are_passed_over(monkeypatch):
    """With one strong document a mask of weak terms is never scored."""
    import numpy as np

    scored = []
    true = ranked_search.factor
    monkeypatch.setattr(ranked_search, "factor", lambda c, m: scored.append(np.size(c)) or true(c, m))
    times = np.zeros((2, 1000), np.int32)
    times[0, :3], times[1, :] = 5, 1
    best = ranked_search.search_block(
        np.packbits(times > 0, axis=1), times, np.full(1000, 100), np.arange(1000), np.array([0, 1]),
        np.array([5000, 10]), (np.zeros(0, np.int64), np.zeros(0, np.int64)), 2)
    assert best[0].tolist() == [0, 1] and sum(scored) < 20


# ---- toxicity

BAD = ["idiot", "moron", "scum", "stupid", "worthless"]


def labelled(seed, n=600):
    """(doc_id, text, toxic): every fourth text has bad words, .stupid clock. is clean."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = words(rng, rng.randrange(20, 120), 300).split(" ")
        bad = i % 4 == 0
        for k in range(max(2, len(text) // 30) if bad else 0):
            text[rng.randrange(len(text))] = rng.choice(BAD)
        if not bad and i % 25 == 1:
            text.insert(rng.randrange(len(text)), "Stupid clock")
        out.append((i, " ".join(text), int(bad)))
    return out


def frames(spark, rows, clashing=False):
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows], "doc_id long, quality int, toxic int")
    return documents(spark, [(i, x) for i, x, _ in rows], clashing), labels


def test_folding():
    assert toxicity.folded("You 1D1OT! íd!ot $tupid pаthеtic ｓcum 2011 an%%% ndreea$$$ m0r​on") == \
        "you idiot idiot stupid pathetic scum an ndreea moron".split()
    assert toxicity.folded("Loser ioser 1oser") == ["ioser"] * 3
    assert toxicity.folded(None) == toxicity.folded("") == toxicity.folded("12 %% 7") == []


def test_matches_equal_a_plain_search():
    rng = random.Random(5)
    for _ in range(200):
        weights = {}
        for _ in range(rng.randrange(1, 6)):
            word = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 4)))
            weights[f" {word}" + rng.choice(["", " "])] = float(rng.randrange(1, 5))
        phrases = [" ".join("".join(rng.choice("ab") for _ in range(2)) for _ in range(2)) for _ in range(rng.randrange(3))]
        text = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 4))) for _ in range(20)]
        want, at = {}, 0
        line = f" {' '.join(text)} "
        covered = {k for p in phrases for m in re.finditer(f"(?= {p} )", line) for k in range(m.start(), m.start() + len(p) + 1)}
        for w in text:
            fits = [v for p, v in weights.items() if (p == f" {w} " if p.endswith(" ") else f" {w}".startswith(p))]
            if fits and at not in covered:
                want[at] = max(fits)
            at += len(w) + 1
        assert toxicity.matches(toxicity.Lexicon(weights, phrases).automaton(), text) == want


def test_held_out_documents_are_told_apart(spark):
    rows = labelled(1)
    docs, labels = frames(spark, rows)
    out = {r["doc_id"]: r for r in toxicity.predictions(docs, labels).collect()}
    assert len(out) == len(rows)
    held = [i for i, *_ in rows if crc32(str(i).encode()) % 3 == 1]
    assert all(out[i]["held_out"] == (i in set(held)) for i in out)
    right = [out[i]["predicted"] == rows[i][2] for i in held]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out.values())


def test_held_out_labels_teach_nothing(spark):
    rows = labelled(2, 300)
    turned = [(i, x, 1 - t if crc32(str(i).encode()) % 3 == 1 else t) for i, x, t in rows]
    one = toxicity.learn(*frames(spark, rows))
    assert one == toxicity.learn(*frames(spark, turned))
    assert any(p.startswith(" idiot"[:5]) for p in one.weights)
    assert "stupid ciock" in one.phrases


def test_disguised_words_and_exceptions(spark):
    rows = labelled(3)
    lexicon = toxicity.learn(*frames(spark, rows))
    plain = "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"
    texts = [plain + " idiot moron", plain + " 1d!0t m0rоn", plain + " stupid clock", plain + " STUPID  clock!", plain]
    got = [r["score"] for r in toxicity.score(documents(spark, list(enumerate(texts))), lexicon).orderBy("doc_id").collect()]
    assert got[0] == got[1] >= 0.7 and got[2] == got[3] == got[4] < 0.7


def test_copies_are_no_further_evidence(spark):
    """Words of one toxic text with many copies stay out of the lexicon."""
    rows = labelled(4, 400)
    copied = "w1 w2 zebra w4 w5 quagga w7 w8 okapi w10 idiot w12 scum w14 " * 2
    rows += [(10_000 + i, copied + f"w{i}", 1) for i in range(300)]
    lexicon = toxicity.learn(*frames(spark, rows))
    assert not [p for p in lexicon.weights if p.strip() in ("zebra", "quagga", "okapi")] and " scum " in lexicon.weights


def test_odd_rows(spark):
    rows = labelled(6, 200)
    docs, labels = frames(spark, rows, clashing=True)
    more = documents(spark, [(None, "idiot scum moron"), (9000, None), (9001, ""), (9002, "  \n"), (9003, "12 34"),
                             (9004, "ordinary " * 50_000), (0, "another text of one id"), (0, "another text of one id")], True)
    odd = labels.union(spark.createDataFrame([(None, 1, 1), (9000, None, None), (9001, 0, 1), (77777, 1, 1), (0, 1, 0)], labels.schema))
    out = toxicity.predictions(docs.union(more), odd)
    got = {}
    for r in out.collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == 208 and len(got[0]) == 3
    assert got[None][0]["predicted"] == 1 and got[None][0]["held_out"] is False
    assert len({got[i][0]["score"] for i in (9000, 9001, 9002, 9003, 9004)}) == 1 and got[9000][0]["predicted"] == 0
    assert toxicity.predictions(docs.limit(0), labels).count() == 0
    for some, want in ((labels.limit(0), 0), (labels.where("toxic = 0"), 0), (labels.where("toxic = 1"), 1)):
        assert {r[0] for r in toxicity.predictions(docs, some).select("predicted").collect()} == {want}
    with pytest.raises(ValueError):
        toxicity.score(docs.withColumn("score", F.lit(1)), toxicity.Lexicon())
