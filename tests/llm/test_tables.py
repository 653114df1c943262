"""Operators over pages, vectors, test items and labels, and the pipeline, beside brute force."""

from __future__ import annotations

import random
import re
import time
from html import escape

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from check_oracle import rows_of
from shiplens.llm import bpe, decontaminate, exact_topk, html_text, quality_model, queries, url_rules
from tests.llm.cases import corpus, documents, words

SF = "/root/testdata/sf0.001"


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_restatement(spark, name):
    con = duckdb.connect()
    for table in ("pages", "embeddings", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = entry.queries()[name](spark, SF)
    cursor = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cursor.fetchall())


# ---- url rules

URLS = [
    None, "", "no mark", "http://", "http://COM/", "http://com", "https://a.com/x?y#z", "http://xcom/",
    "http://example.com/en/1", "http://example.com/en", "http://WWW.example.com/en/1", "http://a.example.com/EN/1",
    "http://m.www.example.com/en/", "http://a.net/es/", "http://a.net/fr/x", "http://a.net/essay", "http://net/es/1",
    "http://casino-win.example.org/x", "http://winning.example.org/casino", "http://adsl.example.org/",
    "http://x.org?u=http://a.com/", "ftp://free-bets.example.net", "http://é.com/日本", "://example.com/en/",
    "http://example.com:80/en/1", "http://a.com\n/x",
]


def judged_by_hand(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, place in url_rules.PLACES:
        h, _, p = place.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((-len(place), place, verdict))
    if fits:
        return host, path, *min(fits)[1:]
    marked = set(re.split("[.-]", host)) & set(url_rules.BLOCKED_WORDS)
    return host, path, None, "block" if marked else "allow"


def test_urls_equal_plain_rules(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(3, URLS[3], "x", "y"), (None, URLS[8], "x", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, fits string")
    got = collected(url_rules.judge(pages, url_rules.production_rules()))
    assert got == sorted(((i, *judged_by_hand(u)) for i, u, *_ in rows), key=repr)
    assert url_rules.judge(pages.limit(0), url_rules.production_rules()).count() == 0


def test_rules_need_a_literal_token(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    with pytest.raises(ValueError):
        url_rules.judge(pages, [url_rules.Rule("block", None, ".*", (), 0)])


# ---- exact top-k


def top_by_hand(rows, k):
    clean = {
        (i, tuple(v)) for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    }
    clean = {(i, tuple(int(np.floor(256 * float(x))) for x in v)) for i, v in clean}
    out = []
    for q, a in clean:
        if q % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in clean if i != q and len(a) == len(b))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "TILE", 3)
    monkeypatch.setattr(exact_topk, "BLOCK", 16)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-4, 5, 4) / 8]) for i in range(400)]  # many ties
    rows += [(7, rows[7][1]), (None, [1.0, 0.0, 0.0, 0.0]), (500, None), (501, [1.0, None, 0.0, 0.0]),
             (502, [float("nan"), 0.0, 0.0, 0.0]), (503, [float("inf")] * 4), (550, [1.0, 2.0]), (551, [2.0, 2.0]),
             (600, []), (601, []), (650, [3e6, -3e6, 1.0, 0.5]), (651, [2e6, 1e6, 1.0, 0.5])]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, score int, id int")
    got = collected(exact_topk.top_k(table.repartition(3), F.col("vec_id") % 50 == 0, k=5))
    assert got == top_by_hand(rows, 5)
    assert exact_topk.top_k(table.limit(0), F.col("vec_id") % 50 == 0, k=5).count() == 0


# ---- html


def page(blocks, before="", after="", article="article"):
    body = "".join(f"<p>{b}</p>" for b in blocks)
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head>" \
           f"<body>{before}<{article}>{body}</{article}>{after}</body></html>"


FRAME = '<nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy <p>now</p></div>'
@pytest.mark.parametrize("unit", ['<a "', "<a ", "<a", "<!", "</a", "<div>", "<nav><article>", '<a \'"', "<div></b>", "<p>"])
def test_open_markup_takes_linear_time(unit):
    seconds = []
    for n in (60_000, 480_000):
        start = time.perf_counter()
        html_text.parse(unit * (n // len(unit)))
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 20 * seconds[0] + 1


PAGES = [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>open <b>bold<br>line<p>next", "open bold line\n\nnext"),
    (page(["one &amp; two", " a \n\t b&nbsp;c ", "", "x &lt; y"], FRAME, "<footer>&copy; F</footer>"),
     "one & two\n\na b c\n\nx < y"),
    (page(["keep<script>no()</script> this"], "<header>H</header><aside>S</aside><form><input>F</form>"), "keep this"),
    (page(["a", '<span class="notice">n</span>b'], "", '<section id="comments"><p>reader</p></section>'), "a\n\nb"),
    ("<article><h1>Head</h1><p>text</p><div class='comments'><p>c1</p></div></article><p>outside</p>", "Head\n\ntext"),
    ("<div class=ad>open advert<article><p>still here</p></article>", "still here"),
    ("<main><p>main text</p></main><div>no</div>", "main text"),
    ("<p>a</p><div class='cookie-banner'><div>x</div>y</div><p>b", "a\n\nb"),
    ("<article><p>1 < 2 and 3 > 2</p><!-- open comment", "1 < 2 and 3 > 2"),
    ("<article><table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table></article>", "a b\n\nc"),
    ("<article><p>cut off in the midd", "cut off in the midd"), ("<script>never closed <p>x</p>", ""),
    (page(["long " * 20000]), " ".join(["long"] * 20000)),
]


def test_pages_give_their_articles(spark):
    rows = [(i, f"http://h{i}.example.org/", h, "t", 1) for i, (h, _) in enumerate(PAGES)] + [(2, None, PAGES[4][0], "t", 1)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, place int")
    got = collected(html_text.extract(table))
    want = [(i, f"http://h{i}.example.org/", t, len(t)) for i, (_, t) in enumerate(PAGES)]
    want.append((2, None, PAGES[4][1], len(PAGES[4][1])))
    assert got == sorted(want, key=repr)
    assert html_text.extract(table.limit(0)).count() == 0


def test_host_frames_go_where_no_article_is_marked(spark):
    rng = random.Random(2)
    frame = "Welcome to this site where you find all that you have ever looked for"
    texts = [words(rng, 30) for _ in range(6)]
    rows = [(i, "http://one.example.org/p", f"<div>{frame}</div><div>{t} {frame}</div>") for i, t in enumerate(texts)]
    rows.append((9, "http://two.example.org/p", f"<div>{frame}</div><div>{texts[0]}</div>"))
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.extract(table).collect()}
    assert [got[i] for i in range(6)] == texts
    assert got[9] == f"{frame}\n\n{texts[0]}"


def test_host_frames_go_in_every_chunk_and_partition(spark):
    rng = random.Random(7)
    frame = "Welcome to this site where you find all that you have ever looked for"
    texts = [f"first{i} {words(rng, 12)} last{i}" for i in range(html_text.CHUNK_PAGES + 1)]
    rows = [(i, "http://one.example.org/p", f"<div>{frame}</div><div>{t}</div>") for i, t in enumerate(texts)]
    # a notice that three pages of the large host carry, one of them in its article's page
    notice = "please note that our office stays closed on the first day of every other month"
    for i in (5, 200):
        rows[i] = (i, rows[i][1], f"{rows[i][2]}<div>{notice}</div>")
    rows.append((9000, rows[0][1], f"<div>{notice}</div><article><p>marked</p></article>"))
    rows.append((9001, "http://two.example.org/p", f"<div>{frame}</div><div>{notice}</div>"))
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    for pages in (table.coalesce(1), table.repartition(7)):
        got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
        assert [got[i] for i in range(len(texts))] == texts
        assert got[9000] == "marked" and got[9001] == f"{frame}\n\n{notice}"


def test_arrays_judge_pages_that_mark_an_article_too(spark, monkeypatch):
    monkeypatch.setattr(html_text, "CHUNK_PAGES", 9)
    rng, n = random.Random(5), html_text.RUN
    shared = [words(rng, 8 + k) for k in range(4)]  # the first is a run and no more
    rows, bodies = [], []
    for i in range(120):
        blocks = [words(rng, rng.choice((3, 7, 20))) for _ in range(3)]
        blocks.insert(rng.randrange(4), shared[i % 13] if i % 13 < 4 else words(rng, 2))
        if i % 40 == 0:
            blocks = []
        marked = i % 3 > 0
        tag = "article" if marked else "div"
        html = f"{FRAME}<{tag}>{''.join(f'<p>{b}</p>' for b in blocks)}</{tag}>"
        rows.append((i if i % 11 else None, f"http://{'ab'[i % 2]}.example.org/{i}", html))
        bodies.append((i % 2, marked, blocks))
    rows += [(500, rows[1][1], rows[1][2]), (501, rows[1][1], rows[1][2]), (None, None, None), (None, None, None)]
    bodies += [bodies[1], bodies[1], (2, False, []), (2, False, [])]
    held = {}
    for at, (host, _, blocks) in enumerate(bodies):
        tokens = " ".join(blocks).split()
        for a in range(len(tokens) - n + 1):
            held.setdefault((host, *tokens[a : a + n]), set()).add(at)
    want, repeated = [], set()
    for (page_id, url, _), (host, marked, blocks) in zip(rows, bodies):
        tokens = " ".join(blocks).split()
        covered = [False] * len(tokens)
        for a in range(len(tokens) - n + 1):
            if len(held[(host, *tokens[a : a + n])]) >= html_text.PAGES:
                covered[a : a + n] = [True] * n
        kept, at = [], 0
        for block in blocks:
            size = len(block.split())
            hit = covered[at : at + size] if not marked and not all(covered) else [False] * size
            at += size
            kept.append(" ".join(w for w, c in zip(block.split(), hit) if not c))
        text = "\n\n".join(k for k in kept if k)
        want.append((page_id, url, text, len(text), sum(covered)))
        repeated.add((marked, any(covered)))
    assert len(repeated) == 4
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    judged = html_text.with_repeats(table)
    assert collected(judged) == sorted(want, key=repr)
    assert collected(html_text.extract(table)) == sorted((w[:4] for w in want), key=repr)


def test_op10_counts_repeats_in_given_articles(spark):
    got = entry.queries()["op10_html_text"](spark, SF)
    assert got.columns == ["page_id", "url", "text", "n_chars", "n_repeated"]
    assert got.count() == spark.read.parquet(f"{SF}/pages.parquet").count()


def test_anchors_stand_on_all_pages_of_their_runs():
    rng = np.random.default_rng(4)
    for _ in range(30):
        sizes = rng.integers(0, 60, 8)
        flat = rng.integers(0, 3, sizes.sum()).astype(np.uint64)
        anchors, pages = html_text.distinct_anchors(flat, sizes)
        often, counts = html_text.distinct_runs(flat, sizes, anchors)
        streams = np.split(flat, np.cumsum(sizes)[:-1])
        held = {}
        for i, s in enumerate(streams):
            for a in range(len(s) - html_text.RUN + 1):
                held.setdefault(tuple(s[a : a + html_text.RUN]), set()).add(i)
        assert sorted(counts.tolist()) == sorted(len(v) for v in held.values())
        some, least = html_text.distinct_runs(flat, sizes, anchors[pages >= html_text.PAGES])
        found = dict(zip(some.tolist(), least.tolist()))
        for run, n in zip(often.tolist(), counts.tolist()):
            assert n < html_text.PAGES or found[run] == n


def test_repeated_tokens_equal_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(30):
        streams = [rng.integers(0, 2, rng.integers(0, 40)) for _ in range(6)]
        n = html_text.RUN
        held = {}
        for i, s in enumerate(streams):
            for a in range(len(s) - n + 1):
                held.setdefault(tuple(s[a : a + n]), set()).add(i)
        for s, got in zip(streams, html_text.repeated_tokens(streams)):
            want = np.zeros(len(s), bool)
            for a in range(len(s) - n + 1):
                if len(held[tuple(s[a : a + n])]) >= html_text.PAGES:
                    want[a : a + n] = True
            assert (got == want).all()


# ---- decontamination


def local_score(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            step = decontaminate.MATCH if a[i] == b[j] else decontaminate.MISMATCH
            rows[i + 1][j + 1] = max(0, rows[i][j] + step, rows[i][j + 1] + decontaminate.GAP, rows[i + 1][j] + decontaminate.GAP)
    return max(map(max, rows))


def test_alignment_equals_the_plain_recurrence():
    rng = np.random.default_rng(4)
    item = rng.integers(0, 6, 12).astype(np.uint64)
    passages = [rng.integers(0, 6, n).astype(np.uint64) for n in (1, 3, 12, 30, 30)]
    scores, ends = decontaminate.align(item, passages)
    assert scores.tolist() == [local_score(item.tolist(), p.tolist()) for p in passages]
    for p, s, e in zip(passages, scores, ends):
        assert local_score(item.tolist(), p[:e].tolist()) == s


def leak_corpus():
    rng = random.Random(6)
    items = [(i, words(rng, 30)) for i in range(8)] + [(8, None), (9, ""), (10, "two words"), (3, None)]
    rows = corpus(5, 30)
    leaks = {}
    for k in range(12):
        i = k % 8
        cut = items[i][1].split(" ")
        if k >= 8:  # edited copies: words changed, put in and left out
            cut[4], cut[17] = "edited", "changed"
            cut.insert(10, "inserted")
            del cut[23]
        if k == 5:
            cut = [w.upper() for w in cut]
        rows.append((2000 + k, words(rng, 40) + "\n" + "  ".join(cut) + " " + words(rng, rng.randrange(60))))
        leaks[2000 + k] = i
    rows.append((2000, rows[-12][1]))
    return items, rows, leaks


def test_leaks_are_found_and_nothing_else(spark):
    items, rows, leaks = leak_corpus()
    tests = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc string")
    got = decontaminate.matches(documents(spark, rows, clashing=True), tests).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == set(leaks.items()) and len(got) == 12
    best = {r["doc_id"]: r for r in got}
    for doc, text in rows:
        if doc in leaks:
            item = items[leaks[doc]][1].split(" ")
            assert best[doc]["score"] == local_score(item, text.lower().split())
    assert {r["doc_id"] for r in decontaminate.clean(documents(spark, rows), tests).collect()} == {
        d for d, _ in rows if d not in leaks
    }


def test_rows_are_cleaned_by_their_own_text(spark):
    """A leak without id goes; of rows that share an id only the leak goes; nothing else does."""
    items, rows, leaks = leak_corpus()
    leak, fine = next(t for d, t in rows if d in leaks), next(t for d, t in rows if d not in leaks and t)
    mixed = [(None, leak), (None, fine), (None, None), (None, ""), (5, leak), (5, fine), (5, fine), (6, leak)]
    tests = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, mixed)
    kept = sorted(((r["doc_id"], r["text"]) for r in decontaminate.clean(docs, tests).collect()), key=repr)
    assert kept == sorted([(None, fine), (None, None), (None, ""), (5, fine), (5, fine)], key=repr)
    assert decontaminate.clean(docs, tests.limit(0)).count() == 8 and decontaminate.clean(docs.limit(0), tests).count() == 0


def test_copies_that_keep_few_seeds_are_found(spark):
    rng = random.Random(8)
    items = [[f"{name}{i}" for i in range(30)] for name in "pqrs"]
    kept = [
        ["edited" if i % 5 == 4 else w for i, w in enumerate(items[0])], items[1][:16], items[2][:14], items[3][::-1],
    ]
    rows = [(k, f"{words(rng, 20)} {' '.join(cut)} {words(rng, 20)}") for k, cut in enumerate(kept)]
    tests = spark.createDataFrame([(k, " ".join(item)) for k, item in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.matches(documents(spark, rows), tests).collect()}
    assert got == {(k, k): local_score(items[k], rows[k][1].split()) for k in (0, 1)}
    assert local_score(items[2], rows[2][1].split()) < 30


def test_items_in_several_slices_and_without_rows(spark, monkeypatch):
    items, rows, leaks = leak_corpus()
    tests = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "SLICE", 400)
    got = decontaminate.matches(documents(spark, rows), tests).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == set(leaks.items())
    assert decontaminate.matches(documents(spark, rows), tests.limit(0)).count() == 0
    assert decontaminate.matches(documents(spark, []), tests).count() == 0


# ---- quality


def test_held_out_accuracy(spark):
    """Fitted on half of the labels, the selection keeps clean documents and rejects the others."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    kept = quality_model.select(docs, labels.where(half)).select("doc_id", F.lit(1).alias("kept"))
    share = {
        (r["quality"] > 0, r["toxic"] > 0): r["kept"] / r["n"]
        for r in labels.where(~half).join(kept, "doc_id", "left").groupBy("quality", "toxic").agg(
            F.count("*").alias("n"), F.coalesce(F.sum("kept"), F.lit(0)).alias("kept")
        ).collect()
    }
    assert share[True, False] > 0.99
    assert share[True, True] < 0.1 and share[False, False] < 0.15 and share[False, True] < 0.1


def test_grades_follow_words_and_thresholds_are_in_order(spark):
    rng = random.Random(7)
    rows, grades = [], []
    for i in range(240):
        text = words(rng, 40, 300)
        grade = i % 3
        if grade < 2:
            text += (" vile" if grade == 0 else " dull") * 2
        rows.append((i, text))
        grades.append((i, int(grade == 2), int(grade == 0)))
    rows += [(None, "words"), (500, None), (501, ""), (5, rows[5][1])]
    docs = documents(spark, rows, clashing=True)
    labels = spark.createDataFrame(
        [(*g, "x") for g in grades] + [(5, 1, None, "x"), (None, 1, 0, "x"), grades[5] + ("x",)],
        "doc_id long, quality int, toxic int, text string",
    )
    model = quality_model.train(docs, labels)
    assert (np.diff(model.thresholds) > 0).all()
    judged = quality_model.judge(docs, model).collect()
    assert len(judged) == len(rows) and set(judged[0].asDict()) == {*docs.columns, "expected_grade", "tail_probability"}
    for r in judged:
        if r["doc_id"] is not None and r["doc_id"] < 240:
            assert round(r["expected_grade"]) == r["doc_id"] % 3
            assert 0 <= r["tail_probability"] <= 1
    again = quality_model.train(docs.repartition(7), labels.repartition(3))
    assert np.array_equal(model.weights, again.weights)


def test_sample_holds_one_row_of_each_labelled_document(spark):
    rows = [(i, f"text number {i}") for i in range(10)] + [(4, f"other text {k}") for k in range(50)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows)
    for size, want in ((6, 6), (100, 10)):
        _, counts, grades = quality_model.sample(docs, labels, size=size)
        assert len(counts) == len(grades) == want
    assert sorted(grades) == [1] * 5 + [2] * 5


def test_labels_that_teach_nothing(spark):
    docs = documents(spark, corpus(1, 6))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_model.select(docs, none).count() == docs.count()
    low = spark.createDataFrame([(1, 0, 1)], "doc_id long, quality int, toxic int")
    assert quality_model.select(docs, low).count() == 0
    assert quality_model.select(docs.limit(0), none).count() == 0


# ---- pipeline


def test_pipeline_stages_take_effect(spark, tmp_path):
    rng = random.Random(8)
    base = words(rng, 100)
    items = [(1, words(rng, 25))]
    rows, labels = [], []
    for i in range(60):
        bad = i % 4 == 3
        rows.append((i, words(rng, 50, 500) + (" vile vile" if bad else "")))
        labels.append((i, 1, int(bad)))
    rows += [(100, base), (101, base + " more"), (102, base), (103, f"{words(rng, 30)} {items[0][1]}"),
             (104, words(rng, 30) + " token = abcdefghijklmnop end"), (None, words(rng, 30)), (105, None), (106, "")]
    rows += [(104, rows[-4][1]), (107, words(rng, 40)), (107, words(rng, 40))]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "encoding":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/out/{name}")
        docs = spark.read.parquet(f"{tmp_path}/out/{name}")
        seen[name] = sorted((r["doc_id"] for r in docs.collect()), key=repr)
    assert not {i for i in range(60) if i % 4 == 3} & set(seen["quality"])
    assert {i for i in range(60) if i % 4 != 3} | {100, 101, 102, 103, 104, None} <= set(seen["quality"])
    assert [i for i in seen["near_duplicates"] if i in (100, 101, 102)] == [100]
    assert None in seen["near_duplicates"] and seen["near_duplicates"].count(104) == 1
    assert seen["near_duplicates"].count(107) == 2  # one id, two texts
    assert set(seen["near_duplicates"]) - set(seen["decontamination"]) == {103}
    masked = spark.read.parquet(f"{tmp_path}/out/secrets").where("doc_id = 104").first()
    assert masked["text"].endswith(" [SECRET] end") and masked["n_chars"] == len(masked["text"])
    assert seen["encoding"] == seen["secrets"]
    whole = collected(corpus_pipeline.run(spark, str(tmp_path)))
    assert whole == collected(docs)
    ids = bpe.encode(spark.createDataFrame([(1, escape("a"))], "doc_id long, text string"), queries.vocabulary_file())
    assert ids.first()["ids"] == [64]


def test_every_operator_is_registered_once():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
