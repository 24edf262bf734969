"""What file footers answer, what a region read skips, what a bucketed join does not move."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, at
from wattlake.operators import features as ft
from wattlake.operators.latest import for_regions
from wattlake.plans import queries
from wattlake.plans.lake import open_lake
from wattlake.sinks import tables
from wattlake.sources.files import file_state
from wattlake.sources.tables import V1_SOURCES, read_footers


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def gold(spark, days=4, regions=400, arrived="2024-01-10T00:00:00"):
    """One row per region and hour; the newest arrival of a day is that day's number later."""
    return spark.range(days * 24 * regions).select(
        F.format_string("r%03d", F.col("id") % regions).alias("region"),
        (F.lit(at("2024-01-01T00:00:00")) + F.make_interval(hours=F.expr(f"id div {regions}").cast("int"))).alias("timestamp"),
        F.col("id").cast("double").alias("total_production"),
        (F.lit(at(arrived)) + F.make_interval(days=F.expr(f"id div {24 * regions}").cast("int"))).alias("ingestion_timestamp"),
        F.col("id").alias("arrival_offset"), F.lit(0).alias("arrival_partition"),
    )


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    key = lambda df: sorted(df.select(columns).collect())
    return key(a) == key(b)


def test_counts_come_from_footers(spark, folder):
    before = spark.conf.get(V1_SOURCES)
    path = folder("gold")
    tables.write_gold(gold(spark), path)
    counted = read_footers(spark, path).agg(F.count("*").alias("n"))
    assert "PushedAggregation: [COUNT(*)]" in physical(counted)
    assert counted.first().n == 4 * 24 * 400
    assert spark.conf.get(V1_SOURCES) == before


def test_registered_counts_and_arrivals_are_pushed(spark):
    plan = physical(queries.table_counts(spark, SF))
    assert plan.count("PushedAggregation: [COUNT(*)]") == 4
    plan = physical(queries.newest_arrivals(spark, SF))
    assert "PushedAggregation: [MAX(ingestion_micros)]" in plan and "PushedGroupBy: [date]" in plan


def test_expiry_reads_footers_only(spark, folder):
    path = folder("gold")
    tables.write_gold(gold(spark), path)
    newest = tables.newest_arrivals(spark, path)
    assert "PushedAggregation: [MAX(ingestion_micros)]" in physical(newest)
    assert same(newest, tables._scanned_arrivals(spark, path))
    # Arrivals of the 10th to the 13th; two days are older than the limit of the 12th.
    assert tables.expire_gold(spark, path, at("2024-01-13T00:00:00"), days=1) == 2
    left = {r.date for r in tables.read_gold(spark, path).select("date").distinct().collect()}
    assert left == {dt.date(2024, 1, 3), dt.date(2024, 1, 4)}


def test_expiry_of_old_and_mixed_tables(spark, folder):
    old, mixed, bare = folder("old"), folder("mixed"), folder("bare")
    rows = gold(spark)
    tables.by_day(rows, "timestamp").write.partitionBy("date").parquet(old)
    assert tables.expire_gold(spark, old, at("2024-01-13T00:00:00"), days=1) == 2
    # One day of an older writer among days with the stamp.
    tables.write_gold(rows.filter(F.to_date("timestamp") > "2024-01-01"), mixed)
    rows.filter(F.to_date("timestamp") == "2024-01-01").write.parquet(f"{mixed}/date=2024-01-01")
    assert tables.expire_gold(spark, mixed, at("2024-01-13T00:00:00"), days=1) == 2
    # A day none of whose rows has an arrival time stays, as it did.
    tables.write_gold(rows.withColumn("ingestion_timestamp", F.lit(None).cast("timestamp")), bare)
    assert tables.expire_gold(spark, bare, at("2030-01-01T00:00:00"), days=1) == 0


def test_the_stamp_is_not_part_of_gold(spark, folder):
    path = folder("gold")
    tables.upsert_gold(gold(spark, days=2, regions=5), path)
    tables.upsert_gold(gold(spark, days=1, regions=5, arrived="2024-02-01T00:00:00"), path)
    stored = tables.read_gold(spark, path)
    assert tables.STAMP not in stored.columns
    assert stored.count() == 2 * 24 * 5
    assert stored.filter("ingestion_timestamp >= '2024-02-01'").count() == 24 * 5
    newest = {r.date.day: r.newest for r in tables.newest_arrivals(spark, path).collect()}
    assert newest[1] == int(at("2024-02-01T00:00:00").timestamp() * 1e6)


def scanned(df):
    """Rows that left the scan of a query that has run."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


def test_one_region_of_400_reads_few_rows(spark, folder):
    every_five_minutes = F.explode(F.sequence(F.lit(0), F.lit(55), F.lit(5)))
    rows = gold(spark, days=2).withColumn("minute", every_five_minutes).withColumn(
        "timestamp", F.col("timestamp") + F.make_interval(mins=F.col("minute"))
    ).drop("minute").repartition(4)
    path, plain = folder("gold"), folder("plain")
    tables.write_gold(rows, path)
    tables.by_day(rows, "timestamp").write.partitionBy("date").parquet(plain)
    one = [for_regions(df, ["r007"]) for df in (tables.read_gold(spark, path), spark.read.parquet(plain))]
    assert same(*one)
    narrow, wide = (scanned(df.select("region", "timestamp", "total_production")) for df in one)
    assert wide == 2 * 24 * 12 * 400 and narrow <= wide / 4
    missing = for_regions(tables.read_gold(spark, path), ["r007x"]).select("region", "total_production")
    assert scanned(missing) == 0


@pytest.fixture
def no_broadcast(spark):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, -1)
    yield
    spark.conf.set(limit, before)


def test_bucketed_join_moves_neither_side(spark, no_broadcast):
    lake = open_lake(spark, SF)
    joined = ft.mix_with_carbon(lake.bucketed("mix"), lake.bucketed("carbon"))
    plan = physical(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    moved = ft.mix_with_carbon(lake.gold_mix(), lake.gold_carbon())
    assert "Exchange" in physical(moved)
    assert same(joined.drop("date"), moved.drop("date"))


def test_upsert_keeps_the_buckets(spark, folder, no_broadcast):
    first, second = gold(spark, days=3, regions=7), gold(spark, days=1, regions=9, arrived="2024-02-01T00:00:00")
    path, plain = folder("bucketed"), folder("plain")
    for rows in (first, second, second):
        tables.upsert_gold(rows, path, buckets=4)
        tables.upsert_gold(rows, plain)
    stored = tables.read_bucketed(spark, path, 4).drop(tables.STAMP)
    assert same(stored, tables.read_gold(spark, plain))
    other = stored.select("region", "timestamp", F.col("total_production").alias("again"))
    plan = physical(stored.join(other, ["region", "timestamp"]))
    assert "Exchange" not in plan and "Bucketed: true" in plan
    # Another catalog entry finds the same rows: the files say their bucket.
    for table in spark.catalog.listTables():
        if table.name.startswith("gold_"):
            spark.sql(f"DROP TABLE {table.name}")
    assert same(tables.read_bucketed(spark, path, 4).drop(tables.STAMP), tables.read_gold(spark, plain))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("writing_")]


def test_repeated_rows_rewrite_no_day(spark, folder):
    path, first = folder("gold"), gold(spark, days=3, regions=4)
    tables.upsert_gold(first, path)
    written = file_state(spark, path)
    tables.upsert_gold(first, path)
    tables.upsert_gold(gold(spark, days=2, regions=4, arrived="2023-01-01T00:00:00"), path)  # overtaken
    assert file_state(spark, path) == written
    # One newer row rewrites its own day and no other.
    late = gold(spark, days=3, regions=4, arrived="2024-03-01T00:00:00").filter(
        (F.col("region") == "r001") & (F.col("timestamp") == F.lit(at("2024-01-02T05:00:00")))
    )
    tables.upsert_gold(first.filter("region <> 'r001'").unionByName(late), path)
    changed = {name for name, *_ in set(file_state(spark, path)) ^ set(written)}
    assert changed and all("date=2024-01-02" in name for name in changed)
    stored = tables.read_gold(spark, path)
    assert stored.count() == 3 * 24 * 4 and stored.filter("ingestion_timestamp >= '2024-03-01'").count() == 1


def test_what_a_reader_sees_during_a_swap(spark, folder, monkeypatch):
    path, seen = folder("gold"), []
    tables.upsert_gold(gold(spark, days=3, regions=4), path)
    move = tables.move

    def watched(session, staged, target):
        seen.append(tables.read_gold(session, path).groupBy("date").count().collect())
        move(session, staged, target)

    monkeypatch.setattr(tables, "move", watched)
    tables.upsert_gold(gold(spark, days=3, regions=4, arrived="2024-03-01T00:00:00"), path)
    assert len(seen) == 3  # a day at a time, each whole before and after
    assert all(len(days) == 3 and {r["count"] for r in days} == {24 * 4} for days in seen)


def test_a_row_without_region_has_no_code(spark):
    rows = spark.createDataFrame([("B", 1), (None, 2), ("A", 3)], "region string, n int")
    assert {(r.n, r.region_encoded) for r in ft.encode_region(rows).collect()} == {(1, 1), (2, None), (3, 0)}


LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def jobs_of(spark, group, work):
    """What ``work`` returns, and the numbers of tasks of the stages that it ran."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = work()
    finally:
        spark.sparkContext.setJobGroup("other", "")
    seen = spark.sparkContext.statusTracker()
    infos = [seen.getStageInfo(k) for j in seen.getJobIdsForGroup(group) for k in seen.getJobInfo(j).stageIds]
    return found, [i.numTasks for i in infos if i is not None]


def test_folders_of_days_are_listed_by_few_tasks(spark, folder):
    path = folder("gold")
    days = spark.range(90).select(
        F.lit("FR").alias("region"), F.col("id").alias("x"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
    )
    days.coalesce(1).write.partitionBy("date").parquet(path)
    limit, before = 4 * spark.sparkContext.defaultParallelism, spark.conf.get(LISTING)
    gold, tasks = jobs_of(spark, f"listing {path}", lambda: tables.read_gold(spark, path))
    assert tasks and max(tasks) <= limit < 90
    assert spark.conf.get(LISTING) == before
    assert gold.agg(F.sum("x"), F.countDistinct("date")).first()[:] == (90 * 89 // 2, 90)


def test_a_stored_table_is_opened_once(spark, folder):
    source = folder("source")
    spark.range(200).select(
        F.col("id").alias("event_id"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_interval(hours=(F.col("id") * 6).cast("int"))).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type"),
        F.col("id").cast("double").alias("value"), F.lit('{"k": 5}').alias("props"),
    ).coalesce(1).write.parquet(f"{source}/events.parquet")
    lake = open_lake(spark, source)
    names = ("mix_topic", "silver_mix", "silver_carbon", "gold_mix", "gold_carbon")
    rows = [getattr(lake, name)().count() for name in names]
    again, tasks = jobs_of(spark, "opened again", lambda: [getattr(lake, name)() for name in names])
    assert tasks == []
    assert [table.count() for table in again] == rows
