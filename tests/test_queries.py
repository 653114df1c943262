"""The registry, some restatements end to end, and the plans that must hold at scale."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from catalog.tables import deployments, raw_feed, scored
from check_oracle import TABLES, rows_of
from shiplens.functions import flags as fl
from shiplens.operators import contract as ct
from shiplens.operators import features as ft
from shiplens.operators import chunking, corpus, metrics, prep, scoring

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 100


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", [
    "contract_offenders", "derive_features", "flags_corpus", "monthly_risk", "time_split",
    "medians", "best_threshold", "roc_points", "fleet_register", "lint_violations", "chunks",
    "cosine_topk", "claim_precision", "stream_rejects",
])
def test_query_equals_its_restatement(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cursor = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_level_work_needs_no_shuffle(spark):
    raw = spark.read.parquet(f"{SF}/orders.parquet")
    feed = raw_feed(spark, SF, raw)
    for df in (
        ct.coerce(feed, ct.DEPLOYMENTS), ft.derive(ct.coerce(feed, ct.DEPLOYMENTS)),
        ct.coerce(feed, ct.DEPLOYMENTS).select(fl.raised(fl.corpus_flag_conditions())),
    ):
        assert "Exchange" not in plan_of(df)


def test_chunking_needs_no_shuffle(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr(
        "concat('RiskNote_Cisco_PLC_', doc_id, '.md') AS filename", "text")
    assert "Exchange" not in plan_of(chunking.chunk(corpus.manifest(docs)))


def test_scans_read_only_what_is_used(spark):
    df = deployments(spark, SF, ("deployment_date", "deployment_outcome"))
    text = plan_of(df.groupBy("deployment_outcome").count())
    assert "lineitem" not in text and "customer" not in text
    assert "o_orderstatus" in text and "o_totalprice" not in text


def test_no_cartesian_products(spark):
    for name in ("fold_metrics", "roc_auc", "newest_real_run", "gold_consistency", "run_gate"):
        text = plan_of(entry.queries()[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text, name


def test_single_partition_exchanges_carry_aggregates_only(spark):
    df = scored(spark, SF)
    for out in (metrics.threshold_sweep(df, 5.0), metrics.binary_metrics(df, metrics.F.lit(0.3), 5.0),
                scoring.run_summary(scoring.decide(df, 0.4, "m", unseen=None))):
        for line in plan_of(out).split("\n"):
            assert "SinglePartition" not in line or "Exchange" in line
        assert "Window" not in plan_of(out)


def test_fitted_preprocessing_is_a_projection(spark):
    df = ft.derive(deployments(spark, SF))
    fitted = prep.fit(df)
    shuffles = "Exchange hashpartitioning"  # the level table is sent to the rows
    assert plan_of(fitted.apply(df)).count(shuffles) == plan_of(df).count(shuffles)
