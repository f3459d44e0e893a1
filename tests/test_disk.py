"""Disk: shuffles of a finished step go, layers are written in parts, steps on the way are removed."""

from __future__ import annotations

import os
import re
import time

import pytest
from helpers import SF_SMALL, line, raw_frame
from pyspark.sql import functions as F

from ledgerstar.plans import stages
from ledgerstar.plans.catalog import chain_for, registry
from ledgerstar.session import storage_root


def _shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def _rows(df) -> list:
    return sorted(map(str, df.collect()))


def test_a_kept_step_leaves_no_shuffle_files(spark, scratch):
    before = _shuffle_files(spark)
    store = stages.LayerStore(spark, scratch)
    lines = spark.range(1000).withColumn("key", F.when(F.col("id") % 3 > 0, F.col("id") % 10))
    kept = store.keep(lines.groupBy("key").count(), "intermediate", "counts", "v", "key")
    until = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert kept.count() == 11 and kept.agg(F.sum("count")).first()[0] == 1000
    store.forget("intermediate", "v", "counts")
    assert not os.path.exists(store.dataset_path("intermediate", "counts", "v").removeprefix("file:"))


def test_a_layer_in_parts_is_the_same_layer(spark, scratch, monkeypatch):
    rows = [line(invoice_no=str(i % 40), stock_code=f"P{i % 7}", unit_price="0" if i % 11 == 0 else "2.5",
                 description=" " if i % 5 == 0 else f"MUG {i % 3}") for i in range(120)]
    raw = raw_frame(spark, rows).unionByName(raw_frame(spark, rows[:30], historical=True))
    whole = stages.run_stages(spark, raw, root=os.path.join(scratch, "whole"))
    monkeypatch.setattr(stages, "PASS_BYTES", 100)
    parts = stages.run_stages(spark, raw, root=os.path.join(scratch, "parts"))
    names = [("intermediate", "sales_transactions_clean"), ("intermediate", "rejected_records"), *[("mart", t) for t in stages.MART_SCHEMAS]]
    for layer, table in names:
        a, b = (_rows(s.read(layer, table).drop("loaded_at", "rejected_at")) for s in (whole, parts))
        assert a == b, table
    assert parts.read("intermediate", "sales_transactions_clean").select("loaded_at").distinct().count() == 1
    assert whole.marker("intermediate")["rows"] == parts.marker("intermediate")["rows"]
    for store in (whole, parts):
        for step in stages.KEPT_BY:
            assert not os.listdir(os.path.join(store.root.removeprefix("file:"), "intermediate", step))


def test_parts_hold_every_key_once(spark, scratch, monkeypatch):
    spark.range(100).select(F.when(F.col("id") % 4 > 0, F.col("id") % 9).cast("string").alias("key"), "id").write.parquet(f"{scratch}/in")
    df = spark.read.parquet(f"{scratch}/in")
    store = stages.LayerStore(spark, scratch)
    assert len(store.parts(df, "key")) == 1
    monkeypatch.setattr(stages, "PASS_BYTES", 1)
    parts = store.parts(df, "key")
    assert len(parts) == stages.MOST_PASSES and len(store.parts(df, None)) == 1
    keys = [{r.key for r in p.select("key").distinct().collect()} for p in parts]
    assert sum(map(len, keys)) == len(set().union(*keys)) == 10
    assert sorted(r.id for p in parts for r in p.collect()) == list(range(100))


@pytest.mark.parametrize("key", ["intermediate_clean", "dim_product"])
def test_names_and_lines_of_a_view_are_stored(spark, key):
    files = registry()[key](spark, SF_SMALL).inputFiles()
    assert files and all(re.search("/views/intermediate/(deduplicated|names)/", f) for f in files)


def test_a_query_leaves_only_the_layers_it_reads(spark):
    root = f"{storage_root(spark)}/views".removeprefix("file:")
    steps = [os.path.join(root, s) for s in ("staging/staged", "intermediate/deduplicated", "intermediate/names")]
    seen = [set(os.listdir(s)) if os.path.exists(s) else set() for s in steps]
    assert registry()["q1_monthly_net_sales"](spark, SF_SMALL).count() > 0
    assert [set(os.listdir(s)) for s in steps] == seen


def test_the_join_with_names_does_not_shuffle_the_dedup_key(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        plan = chain_for(spark, SF_SMALL)._routed_intermediate._jdf.queryExecution().explainString(mode)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    shuffled = re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\(stock_code#\d+, _part#", plan)
    assert any("load_order" in columns for columns in shuffled) and not any("dedup_key" in columns for columns in shuffled)
