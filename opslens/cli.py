"""Command-line entry points for ``spark-submit``.

    spark-submit --py-files opslens.zip opslens/cli.py manufacturing-etl --database raw_mfg \
        --target /warehouse/analytics/manufacturing
    python -m opslens.cli ecommerce-etl --database raw_shop --target /data/analytics/ecommerce
    python -m opslens.cli report --target /data/analytics --manufacturing-database raw_mfg \\
        --ecommerce-database raw_shop --records-table raw_shop.ecommerce_records
    python -m opslens.cli produce --csv /raw/shop.csv --key Customer_ID --out /landing/shop
    python -m opslens.cli stream --domain manufacturing --source /landing/mfg --out /processed/mfg \\
        --checkpoint /checkpoints/mfg [--available-now]

The session comes from ``spark-submit`` (cluster settings win); the only
settings made here are the ones the library relies on when they are unset.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from opslens.plans import cross_domain, ecommerce, manufacturing
from opslens.sources.envelopes import to_envelope_lines
from opslens.sources.sinks import BUCKETS, read_raw_csv
from opslens.streaming import processors


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("opslens").getOrCreate()
    if spark.conf.get("spark.sql.adaptive.enabled", "true") != "true":
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="opslens")
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("manufacturing-etl", "ecommerce-etl"):
        p = sub.add_parser(name)
        p.add_argument("--database", required=True)
        p.add_argument("--target", required=True)
        p.add_argument("--buckets", type=int, default=BUCKETS, help="folders of the processed table")
        p.add_argument("--strict", action="store_true", help="fail instead of skipping a table")
    p = sub.add_parser("report")
    p.add_argument("--target", required=True)
    p.add_argument("--manufacturing-database", required=True)
    p.add_argument("--ecommerce-database", required=True)
    p.add_argument("--records-table", required=True)
    p.add_argument("--time-column", default="timestamp")
    p.add_argument("--category-column", default="purchase_category")
    p.add_argument("--channel-column", default="marketing_channel")
    p.add_argument("--buckets", type=int, default=BUCKETS)
    p.add_argument("--strict", action="store_true")
    p = sub.add_parser("produce")
    p.add_argument("--csv", required=True)
    p.add_argument("--key", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("stream")
    p.add_argument("--domain", choices=("manufacturing", "ecommerce"), required=True)
    p.add_argument("--source", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--max-files-per-trigger", type=int, default=None)
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--processing-time", default="10 seconds")
    args = parser.parse_args(argv)

    spark = _session()
    if args.command == "manufacturing-etl":
        manufacturing.run(spark, args.target, database=args.database, buckets=args.buckets, strict=args.strict)
    elif args.command == "ecommerce-etl":
        ecommerce.run(spark, args.target, database=args.database, buckets=args.buckets, strict=args.strict)
    elif args.command == "report":
        cross_domain.run(spark, args.target, None, None, spark.table(args.records_table),
                         manufacturing_database=args.manufacturing_database,
                         ecommerce_database=args.ecommerce_database, time_col=args.time_column,
                         category_col=args.category_column, channel_col=args.channel_column, buckets=args.buckets,
                         strict=args.strict)
    elif args.command == "produce":
        lines = to_envelope_lines(read_raw_csv(spark, args.csv), args.key)
        lines.select("value").write.mode("append").text(args.out)
    else:
        query = processors.start(spark, args.source, args.out, args.checkpoint, args.domain,
                                 max_files_per_trigger=args.max_files_per_trigger,
                                 available_now=args.available_now, processing_time=args.processing_time)
        query.awaitTermination()


if __name__ == "__main__":
    main()
