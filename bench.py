"""Benchmark: all ETL stages plus the nine questions at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Times every stage (both extracts, staging, intermediate, mart incl. its
quality gate) and every question over the stored, published mart.  Prints one
JSON line.  Layers go to spark.checkpoint.dir when the session names one,
else to a fresh scratch folder (local runs only).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerstar.plans import stages  # noqa: E402
from ledgerstar.session import build_session, checkpoint_location  # noqa: E402
from ledgerstar.sources.testfeed import raw_lines  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    sf = sf_dir.rsplit("sf", 1)[-1]
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    # throughput collector for a batch run (the JVM is the only executor here)
    extra["spark.driver.extraJavaOptions"] = os.environ.get("BENCH_JAVA_OPTS", "-XX:+UseParallelGC")
    if os.environ.get("BENCH_EVENT_LOG_DIR"):  # per-stage task times for profiling
        extra["spark.eventLog.enabled"] = "true"
        extra["spark.eventLog.dir"] = os.environ["BENCH_EVENT_LOG_DIR"]
    spark = build_session(
        f"local[{cpus}]",
        app="ledgerstar-bench",
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(2 * cpus, 8))),
        extra=extra,
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not checkpoint_location(spark):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerstar-bench-"))
    root = checkpoint_location(spark).rstrip("/") + "/layers"

    timings: dict[str, float] = {}
    t0 = time.time()
    store = stages.run_stages(spark, raw_lines(spark, sf_dir), root=root, timings=timings)
    stages_sec = time.time() - t0

    question_sec: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name, df in stages.questions(store).items():
        t = time.time()
        rows[name] = df.count()
        question_sec[name] = round(time.time() - t, 3)

    total = stages_sec + sum(question_sec.values())
    out = {
        "metric": "etl_stages_plus_questions_wall",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {**timings, **question_sec},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "stages_sec": round(stages_sec, 3),
        "questions_sec": round(sum(question_sec.values()), 3),
        "result_rows": rows,
        "stage_rows": {r.task_id: r.rows_processed for r in store.last_log_rows(5).collect()},
        "cpus": cpus,
        "driver_memory": spark.conf.get("spark.driver.memory", "default"),
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "spark": spark.version,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
