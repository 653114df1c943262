"""Continuous and scheduled scoring with per-row quarantine.

Each micro-batch goes through the batch contract and the batch scorer. Output folders are
named by the batch id, so a replayed batch replaces its own output and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shiplens.operators.contract import DEPLOYMENTS, TableContract, split_tagged, with_reasons

Score = Callable[[DataFrame], DataFrame]
#: Reasons a row may be given by the stream, beside the contract's own.
REPEATED, LATE = "duplicate_key", "late"


@dataclass(frozen=True)
class SeenKeys:
    """Keys of earlier batches, held for a while, in files beside the stream's checkpoint.

    Spark's own event-time state drops a row behind the watermark before any function sees it. Here
    every row of a batch is looked at: one behind the watermark (the latest event time of earlier
    batches less `delay`) is late; one whose key came in an earlier batch with an event time of at
    least its own less `delay` is a repeat. Each batch writes its keys once, and one row that names the
    batches whose keys may still be asked for, so files of older batches aren't read again. All is a
    function of the batch id: a replayed batch finds what it found before and replaces what it wrote.
    """

    folder: str
    key: str
    column: str
    delay: str

    def _mark(self, batch: DataFrame, batch_id: int) -> tuple[int | None, list[tuple[int, int]]]:
        """Latest event time of the batches before, and (batch, its latest time) of those held."""
        if batch_id == 0:
            return None, []
        row = batch.sparkSession.read.parquet(f"{self.folder}/marks/batch_{batch_id - 1:012d}").first()
        return row["latest"], [(h["batch"], h["latest"]) for h in row["held"]]

    def tag(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The batch with `_late` and `_again`, never null; no row is dropped or added."""
        spark = batch.sparkSession
        latest, held = self._mark(batch, batch_id)
        at, hold = F.unix_micros(self.column), self._hold(batch)
        late = F.coalesce(at < F.lit(latest) - hold, F.lit(False)) if latest is not None else F.lit(False)
        tagged = batch.withColumn("_late", late)
        if not held:
            return tagged.withColumn("_again", F.lit(False))
        paths = [f"{self.folder}/keys/batch_{n:012d}" for n, _ in held]
        before = spark.read.schema(batch.select(F.col(self.key).alias("_seen"), F.lit(0).cast("long").alias("_at")).schema
                                   ).parquet(*paths).groupBy("_seen").agg(F.max("_at").alias("_at"), F.lit(True).alias("_there"))
        again = F.col("_there").isNotNull() & F.coalesce(F.col("_at") >= at - hold, F.lit(True))
        return tagged.join(before, F.col(self.key) == F.col("_seen"), "left").withColumn("_again", again).drop(
            "_seen", "_at", "_there")

    def keep(self, batch: DataFrame, batch_id: int) -> None:
        """Write the batch's keys that aren't late, and what later batches read. A tagged batch."""
        spark = batch.sparkSession
        latest, held = self._mark(batch, batch_id)
        path = f"{self.folder}/keys/batch_{batch_id:012d}"
        batch.where(~F.col("_late") & F.col(self.key).isNotNull()).groupBy(F.col(self.key).alias("_seen")).agg(
            F.max(F.unix_micros(self.column)).alias("_at")).write.mode("overwrite").parquet(path)
        # times of rows without key move the watermark too
        top, hold = batch.agg(F.max(F.unix_micros(self.column)), F.first(self._hold(batch))).first()
        own = top if top is not None else latest
        seen = [t for t in (latest, top) if t is not None]
        latest = max(seen) if seen else None
        held = [*held, (batch_id, own)]
        if latest is not None and hold is not None:  # rows that aren't late ask no further back than this
            held = [(n, t) for n, t in held if t is None or t >= latest - 2 * hold]
        spark.createDataFrame([(latest, held)], "latest long, held array<struct<batch:long,latest:long>>").coalesce(
            1).write.mode("overwrite").parquet(f"{self.folder}/marks/batch_{batch_id:012d}")

    def _hold(self, batch: DataFrame):
        start = F.lit("2000-01-01 00:00:00").cast("timestamp")
        return F.unix_micros(start + F.expr(f"INTERVAL {self.delay}")) - F.unix_micros(start)


def score_batch(
    batch: DataFrame, batch_id: int, score: Score, scores: str, rejects: str,
    contract: TableContract, seen: SeenKeys | None = None,
) -> None:
    batch = batch.persist()
    marked = seen.tag(batch, batch_id).persist() if seen else batch
    tagged = with_reasons(marked, contract)
    if seen:
        more = [F.when(F.col("_again"), F.lit(REPEATED)), F.when(F.col("_late"), F.lit(LATE))]
        tagged = tagged.withColumn(
            "reasons", F.array_distinct(F.array_compact(F.concat("reasons", F.array(*more))))).drop("_late", "_again")
    tagged = tagged.persist()
    good, bad = split_tagged(tagged, contract)
    folder = f"run=batch_{batch_id:012d}"
    score(good).write.mode("overwrite").parquet(f"{scores}/{folder}")
    bad.write.mode("overwrite").parquet(f"{rejects}/{folder}")
    if seen:
        seen.keep(marked, batch_id)
    for df in (tagged, marked, batch):
        df.unpersist()


def score_stream(
    rows: DataFrame, score: Score, scores: str, rejects: str, checkpoint: str, *,
    contract: TableContract = DEPLOYMENTS.scoring(), once: bool = False,
    interval: str = "1 minute", unique_within: tuple[str, str] | None = None,
) -> StreamingQuery:
    """Starts the query; with `once` it takes what is available and stops.

    A key repeated inside a batch is quarantined by the contract. With `unique_within`
    (event-time column, delay) so are rows whose key came in an earlier batch, and rows that come
    more than the delay behind the latest of earlier batches: every row is in one of both outputs.
    """
    seen = SeenKeys(f"{checkpoint}-keys", contract.key, *unique_within) if unique_within else None

    def handle(batch: DataFrame, batch_id: int) -> None:
        score_batch(batch, batch_id, score, scores, rejects, contract, seen)

    writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def rejected_counts(rejects: DataFrame) -> DataFrame:
    """(reason, rows) of a quarantine table."""
    return rejects.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(
        F.count("*").alias("rows"))
