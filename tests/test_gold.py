import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, mix
from wattlake import vocabulary as V
from wattlake.operators import latest, layers, parse
from wattlake.sinks import tables
from wattlake.sources import files, tables as source_tables


def gold_rows(make_events, messages, **where):
    parsed = parse.parse_mix(make_events(messages, **where), arrival="timestamp")
    return layers.has_key(layers.to_gold_mix(layers.silver_mix(parsed)))


def content(df):
    return sorted(
        (r.region, r.timestamp, r.total_production, r.arrival_offset) for r in df.collect()
    )


def test_last_arrival_wins(make_events):
    rows = gold_rows(make_events, [mix(total=1.0), mix(total=3.0), mix("DE", total=9.0),
                                   mix(total=2.0)])
    got = {r.region: r.total_production for r in latest.latest_per_key(rows).collect()}
    assert got == {"FR": 2.0, "DE": 9.0}


def test_equal_arrival_time_is_decided_by_offset(make_events):
    rows = gold_rows(make_events, [mix(total=1.0), mix(total=2.0)]).withColumn(
        "ingestion_timestamp", F.lit(at("2024-01-06T10:00:00"))
    )
    for order in (F.col("arrival_offset"), F.desc("arrival_offset")):
        kept = latest.latest_per_key(rows.orderBy(order)).collect()
        assert [r.total_production for r in kept] == [2.0]


def test_gold_from_classic_silver_has_constants(make_events):
    row = gold_rows(make_events, [mix(powerImportTotal=5, used=None)]).first()
    assert (row.geothermal, row.oil, row.total_import, row.total_export) == (0.0,) * 4
    assert (row.total_consumption, row.ingestion_id) == (0.0, V.SYNC_INGESTION_ID)


def test_gold_from_wide_silver_keeps_what_was_sent(make_events):
    parsed = parse.parse_mix(make_events([
        mix(powerImportTotal=5, powerProductionBreakdown={"oil": 4})]), arrival="timestamp")
    row = layers.to_gold_mix(layers.silver_mix(parsed, extras=True)).first()
    assert (row.total_import, row.oil, row.geothermal) == (5.0, 4.0, 0.0)


def test_upsert_keeps_other_days_and_is_idempotent(spark, make_events, folder):
    path = folder("gold")
    first = gold_rows(make_events, [mix(total=1.0), mix(time="2024-01-05T09:00:00.000Z", total=5.0)])
    late = gold_rows(make_events, [mix(total=2.0), mix("DE", total=7.0)], first=10)
    tables.upsert_gold(first, path)
    tables.upsert_gold(late, path)
    once = content(tables.read_gold(spark, path))
    assert [(r[0], r[2]) for r in once] == [("DE", 7.0), ("FR", 5.0), ("FR", 2.0)]
    tables.upsert_gold(late, path)
    tables.upsert_gold(first, path)  # an old batch delivered again must not win
    assert content(tables.read_gold(spark, path)) == once


def test_lost_driver_during_the_swap_loses_nothing(spark, make_events, folder):
    path = folder("gold")
    tables.upsert_gold(gold_rows(make_events, [mix(total=1.0), mix("DE", total=4.0)]), path)
    before = content(tables.read_gold(spark, path))
    # the copy is complete, the old day already gone, the new one not yet in place
    tables.write_gold(tables.read_gold(spark, path).drop("date"), f"{path}__staged/left")
    files.delete(spark, f"{path}/date=2024-01-06")
    tables.upsert_gold(
        gold_rows(make_events, [mix("ES", total=8.0)], first=20), path)
    after = content(tables.read_gold(spark, path))
    assert set(before) < set(after) and len(after) == 3


def test_unfinished_copy_is_dropped(spark, make_events, folder):
    path = folder("gold")
    rows = gold_rows(make_events, [mix(total=1.0)])
    tables.upsert_gold(rows, path)
    tables.write_gold(rows.withColumn("total_production", F.lit(99.0)), f"{path}__staged/left")
    files.delete(spark, f"{path}__staged/left/_SUCCESS")
    tables.finish_swap(spark, path)
    assert [r[2] for r in content(tables.read_gold(spark, path))] == [1.0]
    assert files.children(spark, f"{path}__staged") == []


def test_upsert_touches_the_days_of_the_batch_only(spark, make_events, folder):
    path = folder("gold")
    days = [mix(time=f"2024-01-0{d}T09:00:00.000Z", total=float(d)) for d in range(1, 5)]
    tables.upsert_gold(gold_rows(make_events, days), path)
    tables.upsert_gold(gold_rows(make_events, days[:2], first=50), path)
    got = content(tables.read_gold(spark, path))
    assert [(r[2], r[3]) for r in got] == [(1.0, 50), (2.0, 51), (3.0, 2), (4.0, 3)]
    untouched = files.file_state(spark, f"{path}/date=2024-01-04")
    tables.upsert_gold(gold_rows(make_events, days[:1], first=90), path)
    assert files.file_state(spark, f"{path}/date=2024-01-04") == untouched
    # days that are not in the batch may even be unreadable
    with open(f"{path}/date=2024-01-03/part-broken.snappy.parquet", "w") as broken:
        broken.write("no parquet")
    tables.upsert_gold(gold_rows(make_events, days[1:2], first=95), path)


def test_expired_day_of_an_open_swap_stays_away(spark, make_events, folder):
    path = folder("gold")
    tables.upsert_gold(gold_rows(make_events, [mix()]), path)
    old = gold_rows(make_events, [mix(time="2022-01-05T09:00:00.000Z")], start="2022-01-05T10:00:00")
    tables.write_gold(old, f"{path}__staged/left")  # a driver was lost before the move
    assert tables.expire_gold(spark, path, at("2024-02-01T00:00:00")) == 1
    tables.upsert_gold(gold_rows(make_events, [mix("DE")]), path)
    assert {r.timestamp.year for r in tables.read_gold(spark, path).collect()} == {2024}


def test_pruning_by_another_column_drops_nothing(spark, make_events, folder):
    path = folder("gold")
    late = [mix(), mix("DE", time="2023-05-01T09:00:00.000Z")]
    tables.upsert_gold(gold_rows(make_events, late), path)
    gold = tables.read_gold(spark, path)
    mark = at("2024-01-01T00:00:00")
    assert source_tables.read_incremental(gold, mark, "ingestion_timestamp").count() == 2
    assert source_tables.read_incremental(gold, mark, "timestamp", "timestamp").count() == 1


def test_newest_rows_of_regions_are_not_sorted(spark, make_events, folder):
    path = folder("gold")
    hours = [mix(z, f"2024-01-0{d}T{h:02}:00:00.000Z", h + d) for z in ("FR", "DE") for d in (1, 2) for h in range(24)]
    tables.upsert_gold(gold_rows(make_events, hours), path)
    newest = latest.latest_by_region(tables.read_gold(spark, path))
    assert [(r.region, r.timestamp.isoformat()) for r in newest.orderBy("region").collect()] == [
        ("DE", "2024-01-02T23:00:00"), ("FR", "2024-01-02T23:00:00")]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in plan and "SortAggregate" not in plan


def test_retention_boundary(make_events):
    rows = gold_rows(make_events, [mix(), mix("DE")])
    as_of = at("2024-01-06T10:00:00") + dt.timedelta(days=365)
    assert latest.retained(rows, as_of).count() == 2
    later = as_of + dt.timedelta(microseconds=1)
    assert [r.region for r in latest.retained(rows, later).collect()] == ["DE"]


def test_expired_days_leave_storage(spark, make_events, folder):
    path = folder("gold")
    tables.upsert_gold(
        gold_rows(make_events, [mix(time="2022-01-05T09:00:00.000Z")], start="2022-01-05T10:00:00"),
        path)
    tables.upsert_gold(gold_rows(make_events, [mix()]), path)
    assert tables.expire_gold(spark, path, at("2024-02-01T00:00:00")) == 1
    assert [r.timestamp.year for r in tables.read_gold(spark, path).collect()] == [2024]


def test_compaction_changes_files_only(spark, make_events, folder):
    path = folder("gold")
    tables.upsert_gold(gold_rows(make_events, [mix(), mix("DE"), mix("ES")]).repartition(3), path)
    before = content(tables.read_gold(spark, path))
    tables.compact_days(spark, path, [dt.date(2024, 1, 6)])
    assert content(tables.read_gold(spark, path)) == before


def test_append_counts_its_rows(spark, folder):
    path = folder("append")
    assert tables.append_table(spark.range(7), path=path) == 7
    assert tables.append_table(spark.range(0), path=path) == 0
    assert source_tables.read_table(spark, path).count() == 7


def test_replayed_batch_replaces_itself(spark, folder):
    path = folder("silver")
    rows = spark.range(5).withColumn("t", F.lit(at("2024-01-06T10:00:00")))
    tables.append_batch(rows, path, "t", 3)
    tables.append_batch(rows, path, "t", 4)
    tables.append_batch(rows, path, "t", 4)
    assert spark.read.parquet(path).count() == 10


def test_marks_and_incremental_read(spark, make_events):
    silver = layers.silver_mix(
        parse.parse_mix(make_events([mix(), mix(), mix()]), arrival="timestamp"))
    assert latest.high_water_mark(silver) == at("2024-01-06T10:00:02")
    assert latest.high_water_mark(silver.limit(0)) is None
    assert source_tables.read_incremental(silver, None).count() == 3
    assert source_tables.read_incremental(silver, at("2024-01-06T10:00:01")).count() == 1


def test_incremental_read_prunes_days(spark, make_events, folder):
    path = folder("silver")
    silver = layers.silver_mix(
        parse.parse_mix(make_events([mix(), mix()]), arrival="timestamp"))
    tables.append_batch(silver, path, "processing_time", 0)
    fresh = source_tables.read_incremental(
        source_tables.read_table(spark, path), at("2024-01-06T10:00:00"),
        stored_by="processing_time")
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "GreaterThan(processing_time" in plan
    assert fresh.count() == 1


def test_latest_by_region(make_events):
    rows = gold_rows(make_events, [mix(time="2024-01-06T09:00:00.000Z", total=1.0),
                                   mix(time="2024-01-06T08:00:00.000Z", total=2.0)])
    assert [r.total_production for r in latest.latest_by_region(rows).collect()] == [1.0]
    assert latest.for_regions(rows, ["DE"]).count() == 0


def test_against_brute_force_with_a_hot_key(spark):
    """A third of all rows on one key, many on one instant."""
    rng = random.Random(11)
    start = at("2024-01-06T00:00:00")
    rows = []
    for offset in range(1500):
        hot = offset % 3 == 0
        region = "FR" if hot else f"R{rng.randrange(20)}"
        hour = 5 if hot else rng.randrange(48)
        arrived = start + dt.timedelta(seconds=rng.randrange(40))
        rows.append((region, start + dt.timedelta(hours=hour), arrived, 0, offset, rng.random()))
    rng.shuffle(rows)
    best = {}
    for row in rows:
        key, order = row[:2], (row[2], row[4], row[3])
        if key not in best or order > best[key][0]:
            best[key] = (order, row[5])
    df = spark.createDataFrame(
        rows, "region string, timestamp timestamp, ingestion_timestamp timestamp, "
              "arrival_partition int, arrival_offset long, v double").repartition(6)
    kept = latest.latest_per_key(df).collect()
    assert len(kept) == len(best)
    assert sorted(r.v for r in kept) == sorted(v for _, v in best.values())


def test_silver_batches_become_one_folder_per_day(spark, make_events, folder):
    path = folder("silver")
    for batch in range(4):
        day = "2024-01-06" if batch < 3 else "2024-01-08"
        silver = layers.silver_mix(parse.parse_mix(
            make_events([mix(total=float(batch)), mix("DE")], start=f"{day}T10:00:00", first=10 * batch),
            arrival="timestamp"))
        tables.append_batch(silver, path, "processing_time", batch)
    before = sorted(map(str, spark.read.parquet(path).drop("batch_id").collect()))
    tables.compact_silver(spark, path, [dt.date(2024, 1, 6)])
    assert len(files.children(spark, f"{path}/date=2024-01-06")) == 1
    assert sorted(map(str, spark.read.parquet(path).drop("batch_id").collect())) == before
    with pytest.raises(ValueError, match="newest batch"):
        tables.compact_silver(spark, path, [dt.date(2024, 1, 8)])
    tables.append_batch(silver, path, "processing_time", 3)  # the newest batch comes again
    assert sorted(map(str, spark.read.parquet(path).drop("batch_id").collect())) == before
