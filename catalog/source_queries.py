"""Sources, sinks and streams, each written from and read back over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import corpus_sql as Q
from catalog import corpus_tables as ct
from catalog import table_sql as S
from catalog.model_queries import _DECIDED, _scores
from catalog.registry import query
from catalog.tables import raw_feed, table
from shiplens.operators import contract as c
from shiplens.operators import scoring
from shiplens.sources import history, readers
from shiplens.sources.scratch import new_path
from shiplens.streaming import scoring as streaming

_FEED_COUNTS = f"""
WITH {S.RAW_FEED}
SELECT count(*) AS rows, count(DISTINCT deployment_id) AS keys,
  count(*) FILTER (WHERE kernel_touched IS NULL) AS null_kernel,
  count(*) FILTER (WHERE uptime_days IS NULL) AS null_uptime,
  count(*) FILTER (WHERE deployment_outcome IS NULL) AS null_outcome FROM raw"""


def _feed_counts(df):
    return df.agg(
        F.count("*").alias("rows"), F.countDistinct("deployment_id").alias("keys"),
        F.count_if(F.col("kernel_touched").isNull()).alias("null_kernel"),
        F.count_if(F.col("uptime_days").isNull()).alias("null_uptime"),
        F.count_if(F.col("deployment_outcome").isNull()).alias("null_outcome"))


def _written_feed(spark, sf, tokens=("N/A", "nan")):
    """The feed as CSV, missing values spelled as tokens."""
    path = new_path(spark, "feed")
    feed = raw_feed(spark, sf).withColumns({
        "kernel_touched": F.coalesce("kernel_touched", F.lit(tokens[0])),
        "uptime_days": F.coalesce("uptime_days", F.lit(tokens[1]))})
    feed.write.option("header", True).option("escape", '"').csv(path)
    return path


@query("read_csv_feed", _FEED_COUNTS)
def read_csv_feed(spark, sf):
    return _feed_counts(readers.read_csv(spark, _written_feed(spark, sf)))


@query("read_json_object", """
SELECT count(*) AS orders, round(sum(o_totalprice), 2) AS total, max(o_orderkey)::VARCHAR AS last_order FROM orders""")
def read_json_object(spark, sf):
    """A summary of the orders as one JSON object over several lines."""
    path = new_path(spark, "object")
    summary = table(spark, sf, "orders").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.struct(F.max("o_orderkey").cast("string").alias("key")).alias("last"))
    summary.select(F.to_json(F.struct("*"), {"pretty": "true"})).coalesce(1).write.text(path)
    return readers.read_json_object(spark, path).select("orders", F.round("total", 2).alias("total"), F.col("last.key").alias("last_order"))


@query("read_mixed_batch", _FEED_COUNTS.replace("count(*) AS rows", "2 * count(*) AS rows")
       .replace("count(*) FILTER", "2 * count(*) FILTER"))
def read_mixed_batch(spark, sf):
    """One CSV and one Parquet file with differing column order, matched by name."""
    parquet = new_path(spark, "feed") + ".parquet"
    feed = raw_feed(spark, sf)
    feed.select(*reversed(feed.columns)).write.parquet(parquet)
    return _feed_counts(readers.read_batch(spark, [_written_feed(spark, sf), parquet]))


@query("cast_declared", """
SELECT sum(o_orderkey % 13)::DOUBLE AS cves, 'string' AS uptime_type, 'double' AS cve_type
FROM orders""")
def cast_declared(spark, sf):
    """A column with a bad literal keeps its text, so the contract can name it."""
    df = c.cast_declared(raw_feed(spark, sf), ("uptime_days", "cve_count"))
    kinds = dict(df.dtypes)
    return df.agg(F.sum("cve_count").alias("cves")).withColumns({
        "uptime_type": F.lit(kinds["uptime_days"]), "cve_type": F.lit(kinds["cve_count"])})


_PUBLISHED = f"""
WITH {_DECIDED}
SELECT risk_prediction, risk_band, count(*) AS rows, '7' AS model_version, '0.4' AS threshold
FROM scores GROUP BY ALL"""


@query("staged_publish", _PUBLISHED)
def staged_publish(spark, sf):
    """Scores staged without header, read back, checked, published as one run."""
    staged, root = new_path(spark, "staged"), new_path(spark, "published")
    scores = _scores(spark, sf)[1].withColumns(
        {"model_version": F.lit("7"), "threshold": F.lit("0.4")})
    scores.write.option("sep", " ").option("escape", '"').csv(staged)
    rows = readers.read_staged(spark, staged, scoring.STAGED_COLUMNS)
    published = scoring.publishable(rows, "2026-01-01T00:00:00Z")
    history.write_run(published, root, "2026-01-01T00:00:00Z", "job 1")
    return history.latest_run(spark, root).groupBy(
        "risk_prediction", "risk_band", "model_version", "threshold"
    ).agg(F.count("*").alias("rows"))


@query("run_listing", f"""
WITH {_DECIDED}
SELECT 'scores_20260101T000000Z_a' AS run, count(*) AS rows FROM scores WHERE risk_band = 'HIGH'
UNION ALL SELECT 'scores_20260102T000000Z_b', count(*) FROM scores WHERE risk_band <> 'HIGH'""")
def run_listing(spark, sf):
    root = new_path(spark, "runs")
    scores = _scores(spark, sf)[1]
    high = F.col("risk_band") == "HIGH"
    history.write_run(scores.where(~high), root, "2026-01-02T00:00:00Z", "b")
    history.write_run(scores.where(high), root, "2026-01-01T00:00:00Z", "a")
    listed = history.list_runs(spark, root)
    return history.read_runs(spark, root).groupBy("run").agg(
        F.count("*").alias("rows")).join(listed, "run", "left_semi")


@query("append_history", f"WITH {_DECIDED} SELECT risk_band, 2 * count(*) AS rows FROM scores GROUP BY 1")
def append_history(spark, sf):
    path = new_path(spark, "scores")
    scores = _scores(spark, sf)[1]
    for _ in range(2):
        history.append_scores(scores, path, scoring.SCORE_COLUMNS)
    return spark.read.parquet(path).groupBy("risk_band").agg(F.count("*").alias("rows"))


@query("chunk_export", f"""
WITH {Q.CHUNKS}
SELECT document_type, count(*) AS chunks, sum(length(text))::BIGINT AS characters FROM chunks GROUP BY 1""")
def chunk_export(spark, sf):
    path = new_path(spark, "chunks")
    chunks = ct.chunks(spark, sf)
    readers.write_json_lines(chunks, path)
    back = spark.read.schema(chunks.schema).json(path)
    return back.groupBy("document_type").agg(
        F.count("*").alias("chunks"), F.sum(F.length("text")).alias("characters"))


def _stream(spark, sf):
    """The orders file as a stream of raw feed rows, scored once through."""
    schema = table(spark, sf, "orders").schema
    orders = spark.readStream.schema(schema).option(
        "pathGlobFilter", "orders.parquet").parquet(sf)
    scores, rejects = new_path(spark, "stream"), new_path(spark, "rejects")

    def score(good):
        points = F.col("uptime_days") / 900.0
        return scoring.decide(good.withColumn("probability", points), 0.4, "stream", unseen=None)

    job = streaming.score_stream(
        raw_feed(spark, sf, orders), score, scores, rejects, new_path(spark, "state"),
        contract=c.DEPLOYMENTS, once=True)
    job.awaitTermination()
    return spark.read.parquet(scores), spark.read.parquet(rejects)


_STREAMED = f"""
WITH {S.RAW_FEED}, dup AS (SELECT deployment_id FROM raw GROUP BY 1 HAVING count(*) > 1),
tagged AS (SELECT *, [
    CASE WHEN deployment_id IN (SELECT deployment_id FROM dup) THEN 'duplicate_key' END,
    CASE WHEN coalesce(deployment_outcome, '') NOT IN
      ('SUCCESS','DEGRADED','ROLLBACK','FAILED') THEN 'invalid_outcome' END,
    CASE WHEN TRY_CAST(deployment_date AS TIMESTAMP) IS NULL THEN 'unparseable_date' END,
    CASE WHEN kernel_touched IS NOT NULL AND TRY_CAST(kernel_touched AS DOUBLE) IS NULL
      THEN 'non_numeric:kernel_touched' END,
    CASE WHEN uptime_days IS NOT NULL AND TRY_CAST(uptime_days AS DOUBLE) IS NULL
      THEN 'non_numeric:uptime_days' END] AS rs FROM raw)
"""


@query("stream_scoring", f"""
{_STREAMED}
SELECT deployment_id, round(TRY_CAST(uptime_days AS DOUBLE) / 900.0::DOUBLE, 4) AS risk_probability,
  CASE WHEN TRY_CAST(uptime_days AS DOUBLE) / 900.0::DOUBLE >= 0.4::DOUBLE THEN 'NO_GO' ELSE 'GO' END
    AS risk_prediction
FROM tagged WHERE len(list_filter(rs, lambda r: r IS NOT NULL)) = 0""")
def stream_scoring(spark, sf):
    return _stream(spark, sf)[0].select("deployment_id", "risk_probability", "risk_prediction")


@query("stream_rejects", f"""
{_STREAMED}, u AS (SELECT unnest(rs) AS reason FROM tagged)
SELECT reason, count(*) AS rows FROM u WHERE reason IS NOT NULL GROUP BY 1""")
def stream_rejects(spark, sf):
    return streaming.rejected_counts(_stream(spark, sf)[1])


_LATE_DELAY = "2000 days"


@query("stream_late_rows", f"""
WITH {S.RAW_FEED.replace("SELECT format", "SELECT o_orderkey % 3 AS b, format", 1)}, placed AS (
  SELECT *, TRY_CAST(deployment_date AS TIMESTAMP) AS ts, row_number() OVER () AS row FROM raw
), marks AS (SELECT b, max(ts) AS top FROM placed GROUP BY b),
timed AS (
  SELECT p.*, coalesce(ts < (SELECT max(top) FROM marks m WHERE m.b < p.b) - INTERVAL {_LATE_DELAY}, false) AS late
  FROM placed p
), earlier AS (
  SELECT t.row, max(r.ts) AS seen_at FROM timed t JOIN timed r ON r.b < t.b AND r.deployment_id = t.deployment_id AND NOT r.late
  GROUP BY t.row
), tagged AS (
  SELECT t.*, [
    CASE WHEN e.row IS NOT NULL AND coalesce(e.seen_at >= t.ts - INTERVAL {_LATE_DELAY}, true)
      OR count(*) OVER (PARTITION BY b, deployment_id) > 1 THEN 'duplicate_key' END,
    CASE WHEN coalesce(deployment_outcome, '') NOT IN
      ('SUCCESS','DEGRADED','ROLLBACK','FAILED') THEN 'invalid_outcome' END,
    CASE WHEN late THEN 'late' END,
    CASE WHEN kernel_touched IS NOT NULL AND TRY_CAST(kernel_touched AS DOUBLE) IS NULL
      THEN 'non_numeric:kernel_touched' END,
    CASE WHEN uptime_days IS NOT NULL AND TRY_CAST(uptime_days AS DOUBLE) IS NULL
      THEN 'non_numeric:uptime_days' END,
    CASE WHEN ts IS NULL THEN 'unparseable_date' END] AS rs
  FROM timed t LEFT JOIN earlier e USING (row)
)
SELECT deployment_id, CASE WHEN reasons = '' THEN 'scores' ELSE 'rejects' END AS place, reasons
FROM (SELECT deployment_id, array_to_string(list_filter(rs, lambda r: r IS NOT NULL), ',') AS reasons FROM tagged)""")
def stream_late_rows(spark, sf):
    """The orders as three deliveries: each row of each is scored or a dead letter, the late ones too."""
    source = new_path(spark, "deliveries")
    scores, rejects, state = (new_path(spark, n) for n in ("stream", "rejects", "state"))
    orders = table(spark, sf, "orders")

    def score(good):
        return scoring.decide(
            good.withColumn("probability", F.col("uptime_days") / 900.0), 0.4, "stream", unseen=None)

    for part in range(3):
        feed = raw_feed(spark, sf, orders.where(F.col("o_orderkey") % 3 == part))
        timed = feed.withColumn("at", F.try_to_timestamp("deployment_date"))
        timed.write.mode("append").parquet(source)
        streaming.score_stream(
            spark.readStream.schema(timed.schema).parquet(source), score, scores, rejects, state,
            contract=c.DEPLOYMENTS, once=True, unique_within=("at", _LATE_DELAY)).awaitTermination()
    kept = spark.read.parquet(scores).select("deployment_id", F.lit("scores").alias("place"), F.lit("").alias("reasons"))
    lost = spark.read.parquet(rejects).select(
        "deployment_id", F.lit("rejects").alias("place"), F.array_join(F.array_sort("reasons"), ",").alias("reasons"))
    return kept.unionByName(lost)
