"""Discovery, tagged scans, profiling and conforming."""

import uuid

import pytest
from pyspark.sql import functions as F

from opslens.sources import catalog
from opslens.plans import manufacturing


def test_conform_skips_prunes_and_unions(spark):
    a = spark.createDataFrame([(1, 2.0, 3.0, 0.5)], "machine_id bigint, energy_consumption double, "
                              "predicted_remaining_life double, vibration double")
    b = spark.createDataFrame([(2, 4.0, 8.0, None)], "machine_id bigint, energy_consumption double, "
                              "predicted_remaining_life double, humidity double")
    c = spark.createDataFrame([(9,)], "o_orderkey bigint")
    out = catalog.conform({"a": a, "b": b, "c": c},
                          essentials=("machine_id", "energy_consumption", "predicted_remaining_life"),
                          prune_all_null=True)
    assert "humidity" not in out.columns
    rows = sorted(out.collect(), key=lambda r: r.machine_id)
    assert [(r.machine_id, r.vibration, r.source_table) for r in rows] == [(1, 0.5, "a"), (2, None, "b")]


def test_non_null_columns_over_the_whole_table(spark):
    df = spark.range(30000).selectExpr("id", "case when id = 29999 then 1 end as late", "cast(null as int) as never")
    assert catalog.non_null_columns(df) == ["id", "late"]


def test_union_casts_drifting_types(spark):
    a = spark.createDataFrame([(1, "5")], "machine_id bigint, reading string")
    b = spark.createDataFrame([(2, 6.5)], "machine_id bigint, reading double")
    out = catalog.conform({"a": a, "b": b}, types={"reading": "double"})
    assert sorted(r.reading for r in out.collect()) == [5.0, 6.5]


def test_discovery(spark, tmp_path):
    db = f"t_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path}/db'")
    with pytest.raises(LookupError):
        catalog.discover_tables(spark, db)
    assert catalog.discover_tables(spark, db, pattern="ecommerce*", fallback=["ecommerce"]) == ["ecommerce"]
    for name in ("ecommerce_web", "ecommerce", "machines"):
        spark.range(3).write.saveAsTable(f"{db}.{name}")
    spark.range(1).createOrReplaceTempView("ecommerce_temp")
    assert catalog.discover_tables(spark, db) == ["ecommerce", "ecommerce_web", "machines"]
    assert catalog.discover_tables(spark, db, pattern="ecommerce*") == ["ecommerce", "ecommerce_web"]
    skipped = {}
    loaded = catalog.load_tagged(spark, ["machines", "missing"], database=db, skipped=skipped)
    assert list(loaded) == ["machines"] and list(skipped) == ["missing"]


def test_manufacturing_run_writes(spark, tmp_path):
    rows = [(i % 3, 1.0 + i, 10.0 * i, i % 2) for i in range(20)]
    df = spark.createDataFrame(rows, "machine_id bigint, energy_consumption double, "
                               "predicted_remaining_life double, anomaly_flag int")
    plan = manufacturing.run(spark, str(tmp_path / "mfg"), {"t1": df}, buckets=4)
    agg = spark.read.parquet(str(tmp_path / "mfg" / "machine_aggregations"))
    assert agg.count() == 3 and sum(r.total_records for r in agg.collect()) == 20
    assert all(p.name.startswith(("key_bucket=", "_", ".")) for p in (tmp_path / "mfg" / "processed").iterdir())
    assert plan.rollup.count() == 3


@pytest.fixture
def database(spark, tmp_path):
    db = f"probe_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path}/db'")
    yield db
    spark.sql(f"DROP DATABASE {db} CASCADE")


READINGS = "machine_id bigint, energy_consumption double, predicted_remaining_life double"


def stored(spark, db, path, name, rows, schema=READINGS, parts=1):
    df = spark.createDataFrame(rows, schema).repartition(parts)
    df.write.option("path", f"{path}/{name}").saveAsTable(f"{db}.{name}")
    return path / name


def break_file(folder):
    one = sorted(folder.glob("part-*.parquet"))[0]
    one.write_bytes(one.read_bytes()[:-20] + b"no footer here")
    for crc in folder.glob(".*.crc"):
        crc.unlink()


def test_unreadable_tables_are_skipped_with_the_reason(spark, database, tmp_path):
    stored(spark, database, tmp_path, "good", [(1, 2.0, 3.0)])
    stored(spark, database, tmp_path, "no_rows", [])
    half = stored(spark, database, tmp_path, "half", [(i, 1.0, 1.0) for i in range(50)], parts=4)
    break_file(half)
    lost = stored(spark, database, tmp_path, "lost", [(5, 1.0, 1.0)])
    spark.table(f"{database}.lost").count()
    for f in lost.glob(".*.crc"):
        f.unlink()
    for f in lost.glob("part-*.parquet"):
        f.write_bytes(b"short")
    spark.catalog.createTable(f"{database}.lines", path=str(tmp_path / "text"), source="csv", schema=spark.table(f"{database}.good").schema)
    (tmp_path / "text").mkdir()
    spark.sql(f"CREATE VIEW {database}.seen AS SELECT * FROM {database}.good")
    run = manufacturing.build(spark, database=database)
    assert set(run.skipped) == {"half", "lost"}
    assert all(r.startswith("cannot be read: ") and "calling" not in r for r in run.skipped.values())
    assert sorted((r.machine_id, r.source_table) for r in run.conformed.collect()) == [(1, "good"), (1, "seen")]
    with pytest.raises(LookupError):
        manufacturing.build(spark, database=database, strict=True)


def test_pruning_answers_from_footers(spark, database, tmp_path):
    from opslens.sources import probe
    schema = READINGS + ", humidity double, late string"
    stored(spark, database, tmp_path, "t", [(i, 1.0, None, None, "x" if i == 99 else None) for i in range(100)], schema, parts=3)
    tables = catalog.load_tagged(spark, ["t"], database=database)
    fmt, files = tables.stored["t"]
    assert fmt == "parquet" and len(files) == 3
    plan = probe.footer_counts(spark, tables["t"], fmt, files)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(" in plan and "PushedAggregation: []" not in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    assert catalog.non_null_columns_by_table(tables) == {"t": ["machine_id", "energy_consumption", "late"]}
    scanned = catalog.non_null_columns_by_table(dict(tables))
    assert scanned == catalog.non_null_columns_by_table(tables)
    out = catalog.conform(tables, essentials=("machine_id", "predicted_remaining_life"), prune_all_null=True)
    assert out.columns == ["machine_id", "energy_consumption", "predicted_remaining_life", "late", "source_table"]


def test_tables_without_footer_counts_are_scanned(spark, database, tmp_path):
    df = spark.range(20).selectExpr("id", "id % 2 AS part", "array(id) AS list", "cast(null as int) AS never")
    df.write.option("path", f"{tmp_path}/nested").saveAsTable(f"{database}.nested")
    df.drop("list").write.partitionBy("part").option("path", f"{tmp_path}/parted").saveAsTable(f"{database}.parted")
    df.drop("list").write.format("orc").option("path", f"{tmp_path}/orcs").saveAsTable(f"{database}.orcs")
    tables = catalog.load_tagged(spark, ["nested", "parted", "orcs"], database=database)
    got = {n: sorted(c) for n, c in catalog.non_null_columns_by_table(tables).items()}
    assert got == {"nested": ["id", "list", "part"], "parted": ["id", "part"], "orcs": ["id", "part"]}


def test_own_tag_column_is_overwritten(spark):
    a = spark.createDataFrame([(1, "x")], "machine_id bigint, Source_Table string")
    b = spark.createDataFrame([(2,)], "machine_id bigint")
    out = catalog.conform({"a": a, "b": b})
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, "b")] and out.columns == ["machine_id", "source_table"]


def test_union_is_balanced(spark):
    tables = {f"t{i}": spark.range(1).select("id", F.lit(i).alias(f"own{i % 5}")) for i in range(33)}
    out = catalog.conform(tables)
    assert out.count() == 33 and len(out.columns) == 7
    depth = max((len(line) - len(line.lstrip(" :+-"))) // 3
                for line in out._jdf.queryExecution().analyzed().toString().splitlines() if "Union" in line)
    assert depth <= 14
    assert {r[0] for r in out.select("source_table").collect()} == set(tables)


def test_fractional_and_text_flags_count(spark, tmp_path):
    a = spark.createDataFrame([(1, 1.0, 1.0, 0.5), (1, 1.0, 1.0, 1.0)], READINGS + ", anomaly_flag double")
    b = spark.createDataFrame([(2, 1.0, 1.0, "1.0"), (2, 1.0, 1.0, "1"), (2, None, 1.0, "0")], READINGS + ", anomaly_flag string")
    run = manufacturing.run(spark, str(tmp_path), {"a": a, "b": b}, buckets=2)
    got = {r.machine_id: (r.total_anomalies, r.avg_anomaly_flag, r.source_tables_count) for r in run.rollup.collect()}
    assert got == {1: (2, 0.75, 1), 2: (2, 1.0, 1)}
    assert (run.total_rows, run.complete_rows, run.negative_vibration_rows) == (5, 4, None)


def test_many_source_tables_are_counted_in_one_shuffle(spark):
    from opslens.operators.rollup import machine_rollup
    names = [f"t{i}" for i in range(1000)]
    df = spark.range(5000).selectExpr("id % 3 AS machine_id", "concat('t', cast(id % 1000 as string)) AS source_table")
    few = df.where("machine_id = 0 or source_table in ('t63', 't64', 't999')")
    rolled = machine_rollup(few, tables=names)
    want = {r.machine_id: r.source_tables_count for r in machine_rollup(few).collect()}
    assert {r.machine_id: r.source_tables_count for r in rolled.collect()} == want
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1
    wide = [len(machine_rollup(df, tables=names[:n])._jdf.queryExecution().analyzed().toString().split("bit_or(")) for n in (5, 60, 1000)]
    assert wide == [2, 2, 17]
