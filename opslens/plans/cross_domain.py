"""The cross-domain report.

The source runs two branches (ETL, then analytics) in parallel and an
integration step after both, passing data through storage. Here both
branches are lazy DataFrames; the summaries are single rows and the
integration reads them as scalar subqueries. ``run`` adds the storage hop and
the parallelism: each branch runs in its own thread, job group and scheduler
pool (with the FAIR scheduler the pools share the cluster evenly), appends its
summary (S12), and when one branch fails the other's jobs are cancelled. The
integration reads the latest summaries back (S13).
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable, Mapping
from typing import TypeVar

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession

from opslens.operators.ecommerce import as_record, score_customer_records
from opslens.operators.insight import ECOM_SUMMARY_SCHEMA, MFG_SUMMARY_SCHEMA, integrate
from opslens.operators.summary import customer_summary, machine_summary
from opslens.plans import ecommerce, manufacturing
from opslens.sources.sinks import BUCKETS, latest_summary, write_summary

T = TypeVar("T")
Tables = Iterable[str] | Mapping[str, DataFrame]


def summaries(spark: SparkSession, readings: DataFrame, ecommerce_tables: Tables,
              customer_records: DataFrame, *, time_col: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """Manufacturing summary over typed readings; ecommerce summary over the E2 chain."""
    erun = ecommerce.build(spark, ecommerce_tables)
    scored = score_customer_records(as_record(customer_records))
    return machine_summary(readings, time_col=time_col), customer_summary(erun.processed, scored)


def in_parallel(spark: SparkSession, branches: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """The branches' results; each runs in its own thread, job group and scheduler pool named after it.

    The first failure cancels the jobs of all other branches and is raised
    once every branch has ended.
    """
    sc, results, failures = spark.sparkContext, {}, []
    groups = {name: f"{name}-{uuid.uuid4().hex[:12]}" for name in branches}
    failed = threading.Lock()

    def work(name: str) -> None:
        sc.setJobGroup(groups[name], name, interruptOnCancel=True)
        sc.setLocalProperty("spark.scheduler.pool", name)
        try:
            results[name] = branches[name]()
        except BaseException as exc:  # noqa: BLE001 - raised again below
            with failed:
                failures.append(exc)
            for other in groups.values():
                if other != groups[name]:
                    sc.cancelJobGroup(other)

    threads = [InheritableThread(target=work, args=(name,), session=spark) for name in branches]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if failures:
        raise failures[0]
    return results


def run(spark: SparkSession, target: str, manufacturing_tables: Tables | None, ecommerce_tables: Tables | None,
        customer_records: DataFrame, *, manufacturing_database: str | None = None,
        ecommerce_database: str | None = None, time_col: str = "timestamp", category_col: str = "purchase_category",
        channel_col: str = "marketing_channel", buckets: int = BUCKETS, strict: bool = False) -> DataFrame:
    """Both ETL jobs, both summaries through storage, then the integrated insight (appended as JSON).

    Tables are given directly, or discovered in the two databases as the
    ETL jobs do (every table / ``ecommerce*``). ``time_col`` is the readings'
    time column; a shop table without the category or channel column has no
    top category or channel. The ecommerce summary reads the processed table
    the job stored; the manufacturing summary reads the conformed tables,
    because its data quality counts the incomplete readings the job drops.
    """
    base = target.rstrip("/")

    def machines() -> None:
        done = manufacturing.run(spark, f"{base}/manufacturing", manufacturing_tables, database=manufacturing_database,
                                 buckets=buckets, strict=strict)
        write_summary(machine_summary(done.conformed, time_col=time_col), f"{base}/manufacturing/summary")

    def shop() -> None:
        done = ecommerce.run(spark, f"{base}/ecommerce", ecommerce_tables, database=ecommerce_database, buckets=buckets,
                             strict=strict)
        scored = score_customer_records(as_record(customer_records))
        write_summary(customer_summary(done.processed, scored, category_col=category_col, channel_col=channel_col),
                      f"{base}/ecommerce/summary")

    in_parallel(spark, {"manufacturing": machines, "ecommerce": shop})
    insight = integrate(spark,
                        latest_summary(spark, f"{base}/manufacturing/summary", MFG_SUMMARY_SCHEMA),
                        latest_summary(spark, f"{base}/ecommerce/summary", ECOM_SUMMARY_SCHEMA))
    insight.coalesce(1).write.mode("append").json(f"{base}/integrated")
    return insight
