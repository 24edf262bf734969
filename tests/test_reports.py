"""Reports from kept sums, reconciliation by digests, states as of a time."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tests.conftest import at, carbon, mix
from wattlake.operators import asof, digests, layers, parse, partials, supervision
from wattlake.operators.features import latest_snapshot
from wattlake.operators.latest import latest_per_key
from wattlake.sinks import tables
from wattlake.sources.tables import read_footers
from wattlake.streaming import control, ingest

AS_OF = at("2024-01-06T10:20:00")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    columns = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(columns).collect()), key=repr)


def readings(n, seed):
    rng = random.Random(seed)
    return [
        mix(rng.choice(["FR", "DE", "ES", "MA"]),
            rng.choice([None] + [f"2024-01-0{d}T{h:02}:00:00.000Z" for d in range(3, 7) for h in (0, 9, 23)]),
            rng.choice([10.0, 20.5, 31.25, None]))
        for _ in range(n)
    ]


def silver(make_events, messages, first=0):
    return layers.silver_mix(parse.parse_mix(make_events(messages, first=first), arrival="timestamp"))


def test_kept_sums_give_the_reports_of_the_scan(spark, make_events, folder):
    path, batches = folder("sums"), [silver(make_events, readings(60, seed), 100 * seed) for seed in range(4)]
    for number in (0, 1, 2, 2, 1, 3, 3):  # batches that come again
        tables.append_partials(partials.day_zone_partials(batches[number], "production_total"), path, number)
    whole = batches[0].unionByName(batches[1]).unionByName(batches[2]).unionByName(batches[3])
    kept = spark.read.parquet(path)

    def check():
        sums = spark.read.parquet(path)
        assert rows_of(partials.top_zones(sums, AS_OF)) == rows_of(supervision.top_zones(whole, AS_OF))
        assert rows_of(partials.table_stats({"mix": sums})) == rows_of(supervision.table_stats({"mix": whole}))
        assert rows_of(partials.merge_partials(sums)) == rows_of(partials.day_zone_partials(whole, "production_total"))

    check()
    plan = physical(partials.top_zones(kept, AS_OF))
    assert "PartitionFilters: [isnotnull(date" in plan and "(date" in plan and "2024-01-05" in plan
    # Merged days give the same, and take late events.
    old = [dt.date(2024, 1, 3), dt.date(2024, 1, 4)]
    try:
        tables.compact_partials(spark, path, old)
        raise AssertionError("days of the newest batch were merged")
    except ValueError:
        pass
    empty = partials.day_zone_partials(silver(make_events, [mix("FR", "2024-01-06T09:00:00.000Z", 1.0)]), "production_total")
    tables.append_partials(empty, path, 4)
    whole = whole.unionByName(silver(make_events, [mix("FR", "2024-01-06T09:00:00.000Z", 1.0)]))
    tables.compact_partials(spark, path, old)
    check()
    merged = spark.read.parquet(path).filter(F.col("date").isin(old))
    assert merged.count() == merged.select("date", "zone").distinct().count()
    tables.rebuild_partials(partials.day_zone_partials(whole, "production_total"), path)
    check()


def test_freshness_from_sums(spark, make_events, folder):
    path = folder("silver")
    rows = silver(make_events, readings(40, 9))
    tables.append_batch(rows, path, "processing_time", 0)
    stored = spark.read.parquet(path)
    sums = partials.day_zone_partials(rows, "production_total")
    for when in (at("2024-01-06T10:10:20"), at("2024-01-07T00:00:00")):
        got = partials.freshness({"mix": sums, "none": sums.limit(0)}, {"mix": stored, "none": stored.limit(0)}, when)
        assert rows_of(got) == rows_of(supervision.freshness({"mix": rows, "none": rows.limit(0)}, when))


def test_the_stream_keeps_sums(spark, make_events, folder):
    topic, out = folder("topic"), folder("out")
    for number in range(3):
        make_events(readings(30, number), first=100 * number).coalesce(1).write.mode("append").parquet(topic)
    stream = spark.readStream.schema(make_events([]).schema).option("maxFilesPerTrigger", 1).parquet(topic)
    job = ingest.mix_to_silver(stream, f"{out}/silver", f"{out}/rejects", arrival="timestamp", partials=f"{out}/sums")
    control.drain_all([control.start(job, "sums", folder("cp"), drain=True)])
    sums, whole = spark.read.parquet(f"{out}/sums"), spark.read.parquet(f"{out}/silver")
    assert sums.select("batch_id").distinct().count() > 1
    assert rows_of(partials.top_zones(sums, AS_OF)) == rows_of(supervision.top_zones(whole, AS_OF))
    flow = supervision.flow_of(partials.table_stats({"mix": sums, "carbon": sums}), ["mix", "carbon"],
                               read_footers(spark, f"{out}/silver"))
    assert rows_of(flow) == rows_of(supervision.flow_report({"mix": whole, "carbon": whole}, whole))


def behind(spark, rows, folder, keep):
    """Stored gold of the silver rows that ``keep`` passes."""
    path = folder("gold")
    tables.write_gold(latest_per_key(layers.has_key(layers.to_gold_mix(rows.filter(keep)))), path)
    return tables.read_gold(spark, path)


def test_digests_find_what_rows_would(spark, make_events, folder):
    rows = silver(make_events, readings(200, 5))
    for keep in ("true", "processing_time <= '2024-01-06 10:01:30'", "zone <> 'MA'", "datetime < '2024-01-05'"):
        gold = behind(spark, rows, folder, keep)
        got = digests.reconcile_by_digests(rows, gold)
        expected = supervision.reconcile({"mix": (rows, gold)}).drop("table_name")
        assert rows_of(got.drop("stale_keys")) == rows_of(expected)
        held = {(r.region, r.timestamp): r.ingestion_timestamp for r in gold.collect()}
        stale = sum(
            held[r.region, r.timestamp] < r.arrived for r in digests.silver_keys(rows).collect()
            if (r.region, r.timestamp) in held
        )
        assert got.first().stale_keys == stale
    nothing = digests.reconcile_by_digests(rows.limit(0), gold.limit(0)).first()
    assert (nothing.silver_rows, nothing.missing_keys, nothing.in_sync) == (0, 0, True)


def test_digests_read_rows_of_differing_days_only(spark, make_events, folder):
    gold = behind(spark, silver(make_events, readings(50, 6)), folder, "true")
    hours = spark.sql("SELECT timestamp'2024-01-05 09:00:00' AS hour")
    keys = gold.select("region", "timestamp", F.col("ingestion_timestamp").alias("arrived"), "date")
    plan = physical(digests.differing_rows(keys, gold, [dt.date(2024, 1, 5)], hours))
    assert plan.count("PartitionFilters: [date") + plan.count("PartitionFilters: [isnotnull(date") == 2
    assert "BroadcastHashJoin" in plan


def test_newest_state_at_or_before_each_time(spark):
    rng = random.Random(3)
    begin = at("2024-01-01T00:00:00")

    def some(n, values):
        return [
            (rng.choice(["A", "A", "A", "B", "C", None]),
             rng.choice([None] + [begin + dt.timedelta(hours=rng.randrange(24 * 12))] * 9), value)
            for value in range(values, values + n)
        ]

    rows, states = some(200, 0), some(60, 1000) + [("D", begin, 1)]
    rows += [("A", begin, 500), ("A", begin, 500), ("E", begin, 501)]
    left = spark.createDataFrame(rows, "region string, timestamp timestamp, number long").repartition(4)
    right = spark.createDataFrame(states, "region string, timestamp timestamp, value long").repartition(3)
    got = asof.as_of_join(left, right, ["value"])
    assert got.columns == ["region", "timestamp", "number", "state_time", "value"]
    expected = []
    for region, when, number in rows:
        known = [] if region is None or when is None else [
            (t, v) for r, t, v in states if r == region and t is not None and t <= when
        ]
        best = max(known, default=(None, None))
        expected.append((region, when and when.replace(tzinfo=None), number, best[0] and best[0].replace(tzinfo=None), best[1]))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    assert asof.as_of_join(left, right.limit(0), ["value"]).filter("value IS NOT NULL").isEmpty()
    assert asof.as_of_join(left.limit(0), right, ["value"]).isEmpty()


def test_state_of_a_past_time_knows_nothing_later(spark, make_events):
    times = [f"2024-01-0{d}T09:00:00.000Z" for d in (3, 4, 5)]
    events = make_events([mix("FR", t, 100.0 + i) for i, t in enumerate(times)])
    intensity = make_events([carbon("FR", t, 10.0 + i) for i, t in enumerate(times)])
    gold = layers.to_gold_mix(layers.silver_mix(parse.parse_mix(events, arrival="timestamp")))
    other = layers.to_gold_carbon(layers.silver_carbon(parse.parse_carbon(intensity, arrival="timestamp")))

    def state(when):
        return [(r.total_production, r.carbon_intensity)
                for r in latest_snapshot(asof.until(gold, when), asof.until(other, when)).collect()]

    assert state(at("2024-01-04T08:59:59")) == [(100.0, 10.0)]
    assert state(at("2024-01-04T09:00:00")) == [(101.0, 11.0)]
    assert state(at("2024-01-03T08:00:00")) == []
