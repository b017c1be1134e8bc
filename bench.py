"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced with a ``noop`` write (the whole plan runs, nothing is
collected to the driver). One warm-up pass, then the median of
$BENCH_RUNS timed runs per query, then the two stream processors and the two
ETL runs with their writes. Prints one JSON line. With $BENCH_EVENT_LOG_DIR
set, Spark's event log (stage and task times) is written there.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from opslens.plans import catalogue, ecommerce, manufacturing  # noqa: E402
from opslens.session import build_session, scratch_path  # noqa: E402
from opslens.sources import fixtures  # noqa: E402

HEADLINE = [
    "machine_scores", "machine_alerts", "machine_efficiency", "negative_vibration",
    "conform_union", "machine_rollup", "customer_scores", "segment_counts", "purchase_clean",
    "customer_rollup", "purchase_sample", "envelope_decode", "unscorable_routing",
    "machine_summary", "customer_summary", "cross_domain",
]


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def time_query(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    force(catalogue.QUERIES[name](spark, sf_dir))
    return time.perf_counter() - t0


def time_streams(spark, sf_dir: str) -> tuple[float, float]:
    """(writing the envelope files, both stream processors draining them)."""
    base = scratch_path(spark, "bench-streams")
    t0 = time.perf_counter()
    catalogue.write_stream_sources(spark, sf_dir, base)
    t1 = time.perf_counter()
    catalogue.process_streams(spark, base)
    return t1 - t0, time.perf_counter() - t1


def time_etl(spark, sf_dir: str) -> dict[str, float]:
    """The two batch jobs end to end with their writes, as the source's ETL timings measure."""
    out = {}
    t0 = time.perf_counter()
    manufacturing.run(spark, scratch_path(spark, "bench-mfg"), fixtures.mfg_tables(spark, sf_dir))
    out["manufacturing_etl_run"] = time.perf_counter() - t0
    t0 = time.perf_counter()
    ecommerce.run(spark, scratch_path(spark, "bench-ecom"),
                  {ecommerce.DEFAULT_TABLE: fixtures.ecommerce_processed(spark, sf_dir)})
    out["ecommerce_etl_run"] = time.perf_counter() - t0
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    conf = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):  # stage and task times, read offline (no UI)
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]})
    spark = build_session(f"local[{cpus}]", app="opslens-bench", shuffle_partitions=max(cpus, 8), **conf)
    spark.sparkContext.setLogLevel("ERROR")

    for name in HEADLINE:  # warm-up: JIT, codegen caches, file listing
        time_query(spark, name, sf_dir)
    results: dict[str, float] = {}
    for name in HEADLINE:
        results[name] = round(statistics.median(time_query(spark, name, sf_dir) for _ in range(runs)), 3)
    sources, streams = time_streams(spark, sf_dir)
    results["stream_sources_write"] = round(sources, 3)
    results["streams_t1_t2"] = round(streams, 3)
    results.update({k: round(v, 3) for k, v in time_etl(spark, sf_dir).items()})
    stream_rows = (fixtures.table(spark, sf_dir, "events").count()
                   + fixtures.table(spark, sf_dir, "orders").count())

    sf = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf, "cpus": cpus, "runs": runs,
                      "stream_records_per_sec": round(stream_rows / results["streams_t1_t2"], 1)}))


if __name__ == "__main__":
    main()
