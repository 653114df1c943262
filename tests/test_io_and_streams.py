"""Readers, score history, fleet views and streaming."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from shiplens.operators import fleet, scoring
from shiplens.operators.contract import DEPLOYMENTS, ContractViolation
from shiplens.sources import history, readers
from shiplens.streaming.scoring import SeenKeys, rejected_counts, score_batch, score_stream
from tests.frames import frame, training_rows


def put(folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_missing_tokens_and_quotes(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'id,x,y\n1,NA,"say ""hi"", ok"\n2,,null\n3,5,z\n')
    rows = readers.read_csv(spark, path).orderBy("id").collect()
    assert [r["x"] for r in rows] == [None, None, "5"]
    assert [r["y"] for r in rows] == ['say "hi", ok', None, "z"]


def test_json_must_be_an_object(spark, tmp_path):
    good = put(tmp_path, "a.json", json.dumps({"a": 1, "b": {"c": "x"}}, indent=1))
    assert readers.read_json_object(spark, good).first()["b"]["c"] == "x"
    for name, text in (("b.json", "[1, 2]"), ("c.json", "{broken")):
        with pytest.raises(ContractViolation):
            readers.read_json_object(spark, put(tmp_path, name, text))


def test_batch_of_files_is_matched_by_name(spark, tmp_path):
    paths = [put(tmp_path, "a.csv", "id,x\n1,2\n"), put(tmp_path, "b.csv", "x,id\n4,3\n"),
             put(tmp_path, "c.csv", "id,x\n"), put(tmp_path, "d.csv", "id\n5\n"),
             put(tmp_path, "e.csv", "")]
    parquet = str(tmp_path / "f.parquet")
    spark.createDataFrame([("8", "7")], "x string, id string").write.parquet(parquet)
    got = {(r["id"], r["x"]) for r in readers.read_batch(spark, [*paths, parquet]).collect()}
    assert got == {("1", "2"), ("3", "4"), ("5", None), ("7", "8")}
    assert readers.read_table(spark, parquet).count() == readers.read_table(spark, paths[0]).count()


def test_staged_rows_need_the_exact_width(spark, tmp_path):
    columns = ["a", "b", "c"]
    good = put(tmp_path, "good", '1 "two words" 3\n4 "{""x"":1}" 6\n')
    rows = readers.read_staged(spark, good, columns).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [("1", "two words", "3"), ("4", '{"x":1}', "6")]
    for name, text in (("few", "1 2 3\n1 2\n"), ("many", "1 2 3\n1 2 3 4\n")):
        with pytest.raises(ContractViolation, match="fields"):
            readers.read_staged(spark, put(tmp_path, name, text), columns)
    with pytest.raises(ContractViolation, match="empty"):
        readers.read_staged(spark, put(tmp_path, "none", ""), columns)


def test_documents_and_json_lines(spark, tmp_path):
    put(tmp_path, "a b.md", "# A\n\ntext")
    put(tmp_path, "b+c%41.md", "# B")
    put(tmp_path, "c.pdf", "no")
    docs = readers.read_documents(spark, str(tmp_path))
    assert {(r["filename"], r["text"]) for r in docs.collect()} == {
        ("a b.md", "# A\n\ntext"), ("b+c%41.md", "# B"), ("c.pdf", None)}
    assert [tuple(r) for r in readers.unreadable_documents(docs).collect()] == [
        ("unreadable_format", "c.pdf")]
    out = str(tmp_path / "lines")
    readers.write_json_lines(docs, out)
    assert spark.read.json(out).count() == 3


def scores(spark, n=4, run="m", prefix="d"):
    return spark.createDataFrame(
        [(f"{prefix}{i}", i / 10, "NO_GO" if i > 2 else "GO", "HIGH" if i > 2 else "LOW",
          '{"vendor_name":"x"}' if i == 0 else "{}", run) for i in range(n)],
        "deployment_id string, risk_probability double, risk_prediction string,"
        "risk_band string, unseen_categories string, model_run string")


def test_append_checks_columns_and_never_overwrites(spark, tmp_path):
    path = str(tmp_path / "scores")
    for _ in range(2):
        history.append_scores(scores(spark), path, scoring.SCORE_COLUMNS)
    assert spark.read.parquet(path).count() == 8
    other = scores(spark).withColumn("extra", F.lit(1))
    with pytest.raises(ContractViolation, match="incompatible"):
        history.append_scores(other, path, other.columns)
    with pytest.raises(ContractViolation, match="expected"):
        history.append_scores(other, path, scoring.SCORE_COLUMNS)


def test_runs_are_immutable_and_sort_by_time(spark, tmp_path):
    root = str(tmp_path / "runs")
    assert history.latest_run(spark, root) is None
    assert history.list_runs(spark, root).count() == 0
    history.write_run(scores(spark, 3), root, "2026-02-01T00:00:00Z", "b/2")
    history.write_run(scores(spark, 4), root, "2026-01-01T00:00:00Z", "a")
    with pytest.raises(Exception, match="(?i)already exists"):
        history.write_run(scores(spark), root, "2026-01-01T00:00:00Z", "a")
    assert [r["run"] for r in history.list_runs(spark, root).collect()] == [
        "scores_20260101T000000Z_a", "scores_20260201T000000Z_b2"]
    assert history.latest_run(spark, root).count() == 3


def test_fleet_views(spark):
    df = scores(spark).withColumn("vendor_name", F.lit("old"))
    inputs = spark.createDataFrame([("d3", "Cisco", "EMERGENCY"), ("d9", "Nokia", "PLANNED")],
                                   "deployment_id string, vendor_name string, deployment_type string")
    joined = fleet.with_inputs(df, inputs)
    assert joined.count() == 4
    row = joined.where("deployment_id = 'd3'").first()
    assert (row["vendor_name"], row["vendor_name_input"]) == ("old", "Cisco")
    assert {r["risk_band"]: r["rows"] for r in fleet.band_counts(df).collect()} == {
        "HIGH": 1, "MEDIUM": 0, "LOW": 3}
    assert fleet.nogo_by(joined).first()["rows"] == 1
    assert fleet.counts_by(joined).collect()[0]["deployment_type"] == "EMERGENCY"
    assert fleet.register(joined, bands=["LOW"], deployment_id="d1").count() == 1
    summary = scoring.run_summary(df).first()
    assert (summary["total"], summary["no_go"], summary["unseen_rows"]) == (4, 1, 1)
    assert scoring.unseen_rows(df).count() == 1


def test_newest_run_skips_smoke_runs(spark):
    runs = [("1", "d"), ("2", "e"), ("3", "smoke-")]
    whole = None
    for stamp, prefix in runs:
        part = scores(spark, prefix=prefix).withColumn("scored_at", F.lit(stamp))
        whole = part if whole is None else whole.unionByName(part)
    assert fleet.newest_run(whole).first()["scored_at"] == "3"
    assert fleet.newest_real_run(whole).first()["scored_at"] == "2"
    assert fleet.newest_real_run(whole.where("scored_at = '3'")).count() == 4
    assert fleet.run_list(whole).count() == 3


def test_stream_equals_batch_and_quarantines(spark, tmp_path):
    contract = DEPLOYMENTS.scoring()
    rows = training_rows(12)
    rows[2]["uptime_days"] = "x"
    rows[4]["deployment_id"] = rows[5]["deployment_id"]
    feed = frame(spark, rows).select(*contract.columns)
    source = str(tmp_path / "in")
    feed.coalesce(1).write.parquet(source)
    folders = {n: str(tmp_path / n) for n in ("scores", "rejects", "state")}

    def score(good):
        return scoring.decide(
            good.withColumn("probability", F.col("uptime_days") / 50), 0.7, "s", unseen=None)

    def run():
        stream = spark.readStream.schema(feed.schema).parquet(source)
        score_stream(stream, score, folders["scores"], folders["rejects"], folders["state"],
                     contract=contract, once=True).awaitTermination()
        return spark.read.parquet(folders["scores"])

    first = {tuple(r) for r in run().drop("run").collect()}
    from shiplens.operators.contract import split_valid
    assert first == {tuple(r) for r in score(split_valid(feed, contract)[0]).collect()}
    reasons = {r["reason"]: r["rows"] for r in rejected_counts(
        spark.read.parquet(folders["rejects"])).collect()}
    assert reasons == {"non_numeric:uptime_days": 1, "duplicate_key": 2}

    more = training_rows(14)[12:]
    frame(spark, more).select(*contract.columns).coalesce(1).write.mode("append").parquet(source)
    assert run().select("run").distinct().count() == 2
    assert run().count() == 9 + 2


def test_a_late_repeat_is_a_dead_letter(spark, tmp_path):
    contract = DEPLOYMENTS.scoring()
    rows = training_rows(3)
    feed = frame(spark, rows).select(*contract.columns).withColumn("at", F.lit("2026-01-01 00:00:00").cast("timestamp"))
    source = str(tmp_path / "in")
    folders = {n: str(tmp_path / n) for n in ("scores", "rejects", "state")}

    def score(good):
        return scoring.decide(good.withColumn("probability", F.col("uptime_days") / 50), 0.7, "s", unseen=None)

    for _ in range(2):
        feed.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(feed.schema).parquet(source)
        score_stream(stream, score, folders["scores"], folders["rejects"], folders["state"], contract=contract,
                     once=True, unique_within=("at", "1 hour")).awaitTermination()
    assert spark.read.parquet(folders["scores"]).count() == 3
    reasons = {r["reason"]: r["rows"] for r in rejected_counts(spark.read.parquet(folders["rejects"])).collect()}
    assert reasons == {"duplicate_key": 3}


def timed_feed(spark, rows):
    """rows of (id, hour or None) as scoring rows with an event time."""
    contract = DEPLOYMENTS.scoring()
    made = training_rows(len(rows))
    for row, (key, hour) in zip(made, rows):
        row["deployment_id"] = key
        row["target_firmware"] = "none" if hour is None else f"{hour}.0"
    feed = frame(spark, made).select(*contract.columns)
    hours = F.when(F.col("target_firmware") != "none", F.substring_index("target_firmware", ".", 1).cast("long"))
    return feed.withColumn("at", F.timestamp_seconds(F.lit(1_700_000_000) + hours * 3600))


def plain_score(good):
    return scoring.decide(good.withColumn("probability", F.lit(0.5)), 0.7, "s", unseen=None)


BATCHES = [
    [("a", 0), ("b", 10), ("n", None)], [("late", 8), ("a", 10), ("c", 9), ("d", 12), (None, 11)],
    [("late", 13), ("b", 12), ("c", 10), ("n", None), ("old", 2), ("e", None), (None, 13)],
    [("e", 40)], [("b", 39), ("d", 20), ("e", 41), ("z", 39)],
]


def batches_by_hand(hold):
    """(batch, id, reasons but the contract's own), plainly."""
    seen, latest, out = {}, None, []
    for n, rows in enumerate(BATCHES):
        late = [h is not None and latest is not None and h < latest - hold for _, h in rows]
        for (key, hour), is_late in zip(rows, late):
            times = seen.get(key) if key is not None else None
            known = [t for t in times or [] if t is not None]
            again = times is not None and (hour is None or not known or max(known) >= hour - hold)
            out.append((n, key, ",".join(["duplicate_key"] * again + ["late"] * is_late)))
        for (key, hour), is_late in zip(rows, late):
            if not is_late and key is not None:
                seen.setdefault(key, []).append(hour)
        latest = max([x for x in [latest, *(h for _, h in rows)] if x is not None])
    return sorted(out, key=repr)


def test_every_row_of_a_stream_is_scored_or_a_dead_letter(spark, tmp_path):
    contract, source = DEPLOYMENTS.scoring(), str(tmp_path / "in")
    folders = {n: str(tmp_path / n) for n in ("scores", "rejects", "state")}
    for rows in BATCHES:
        feed = timed_feed(spark, rows)
        feed.coalesce(1).write.mode("append").parquet(source)
        score_stream(spark.readStream.schema(feed.schema).parquet(source), plain_score, folders["scores"],
                     folders["rejects"], folders["state"], contract=contract, once=True,
                     unique_within=("at", "1 hour")).awaitTermination()
    got = [(r["run"], r["deployment_id"], "") for r in spark.read.parquet(folders["scores"]).collect()]
    got += [(r["run"], r["deployment_id"], ",".join(sorted(r["reasons"]))) for r in spark.read.parquet(folders["rejects"]).collect()]
    assert sorted(((int(run[-12:]), k, x) for run, k, x in got), key=repr) == batches_by_hand(1)


def test_a_replayed_batch_finds_what_it_found(spark, tmp_path):
    contract = DEPLOYMENTS.scoring()
    scores, rejects, keys = (str(tmp_path / n) for n in ("scores", "rejects", "keys"))
    seen = SeenKeys(keys, contract.key, "at", "1 hour")

    def outputs():
        return [sorted(map(repr, spark.read.parquet(p).drop("scored_at").collect())) for p in (scores, rejects)]

    for n, rows in enumerate(BATCHES):
        score_batch(timed_feed(spark, rows), n, plain_score, scores, rejects, contract, seen)
    first = outputs()
    for n in (3, 4):  # the last commits were lost
        score_batch(timed_feed(spark, BATCHES[n]), n, plain_score, scores, rejects, contract, seen)
    assert outputs() == first
    # keys of batches that no row in time can ask for aren't read again
    held = spark.read.parquet(f"{keys}/marks/batch_000000000004").first()["held"]
    assert [h["batch"] for h in held] == [3, 4]
