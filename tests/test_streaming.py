import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.conftest import at, carbon, mix
from wattlake import vocabulary as V
from wattlake.operators import latest, layers, parse
from wattlake.sinks import tables
from wattlake.sources import files
from wattlake.sources.events import kafka_options, read_events
from wattlake.sources.landing import list_objects, read_landed
from wattlake.streaming import control, ingest, sync

MESSAGES = [mix(total=1.0), mix("DE", total=2.0), "{bad", mix(total=3.0), mix(None), mix(time=None)]


def feed(make_events, path, messages, first=0, topic=V.TOPIC_MIX):
    make_events(messages, topic, first=first).write.mode("append").parquet(path)


def drain(writer, checkpoint, name="q"):
    query = control.start(writer, name, checkpoint, drain=True)
    control.drain_all([query])
    return query


def to_silver(spark, topic, silver, rejects):
    return ingest.mix_to_silver(
        read_events(spark, "parquet", {"path": topic}), silver, rejects, "timestamp")


def offsets(df):
    return sorted(r.arrival_offset for r in df.collect())


def content(df):
    return sorted((r.region, r.timestamp, r.total_production) for r in df.collect())


def test_stream_equals_batch_and_restart_changes_nothing(spark, make_events, folder):
    topic, silver, rejects, cp = (folder(n) for n in ("topic", "silver", "rejects", "cp"))
    feed(make_events, topic, MESSAGES)
    drain(to_silver(spark, topic, silver, rejects), cp)
    drain(to_silver(spark, topic, silver, rejects), cp)
    feed(make_events, topic, MESSAGES[:2], first=100)
    drain(to_silver(spark, topic, silver, rejects), cp)

    events = spark.read.schema(V.EVENT).parquet(topic)
    parsed = parse.parse_mix(events, arrival="timestamp")
    stored = spark.read.parquet(silver).drop("date", "batch_id")
    batch = layers.silver_mix(parsed)
    assert stored.columns == batch.columns
    assert sorted(map(str, stored.collect())) == sorted(map(str, batch.collect()))
    bad = spark.read.parquet(rejects)
    assert offsets(bad) == offsets(parse.quarantine(parsed, "production_total")) == [2, 4, 5]


def test_failed_sink_fails_the_query_and_the_batch_comes_again(
        spark, make_events, folder, monkeypatch):
    topic, silver, rejects, cp = (folder(n) for n in ("topic", "silver", "rejects", "cp"))
    feed(make_events, topic, MESSAGES)

    def broken(df, path, column, batch_id):
        if path == rejects:
            raise OSError("sink is down")
        tables.append_batch(df, path, column, batch_id)

    monkeypatch.setattr(ingest, "append_batch", broken)
    with pytest.raises(StreamingQueryException, match="sink is down"):
        drain(to_silver(spark, topic, silver, rejects), cp)
    monkeypatch.setattr(ingest, "append_batch", tables.append_batch)
    drain(to_silver(spark, topic, silver, rejects), cp)
    # silver was written twice by the same batch and still holds each row once
    assert offsets(spark.read.parquet(silver)) == [0, 1, 3, 5]
    assert offsets(spark.read.parquet(rejects)) == [2, 4, 5]


def test_one_stamp_per_batch_without_arrival_column(spark, make_events, folder):
    topic, silver, rejects, cp = (folder(n) for n in ("topic", "silver", "rejects", "cp"))
    feed(make_events, topic, MESSAGES)
    events = read_events(spark, "parquet", {"path": topic})
    drain(ingest.mix_to_silver(events, silver, rejects), cp)
    both = spark.read.parquet(silver).select("processing_time").union(
        spark.read.parquet(rejects).select("processing_time"))
    assert both.distinct().count() == 1


def test_silver_to_gold_stream(spark, make_events, folder):
    topic, silver, rejects, gold, cp, cp2 = (
        folder(n) for n in ("topic", "silver", "rejects", "gold", "cp", "cp2"))
    for first, messages in ((0, MESSAGES), (50, [mix(total=9.0), mix("ES", total=4.0)])):
        feed(make_events, topic, messages, first)
        drain(to_silver(spark, topic, silver, rejects), cp)
        drain(sync.sync_stream(sync.silver_stream(spark, silver), layers.to_gold_mix, gold), cp2)
    rows = layers.has_key(layers.to_gold_mix(spark.read.parquet(silver)))
    assert content(tables.read_gold(spark, gold)) == content(latest.latest_per_key(rows))
    assert [r[2] for r in content(tables.read_gold(spark, gold))] == [2.0, 4.0, 9.0]


def test_direct_streams(spark, make_events, folder):
    topic, other, gold, gold2 = (folder(n) for n in ("mix", "carbon", "gold", "gold2"))
    feed(make_events, topic, MESSAGES)
    feed(make_events, other, [carbon(), carbon(intensity=None), carbon(None)], topic=V.TOPIC_CARBON)
    rejects, log = folder("rejects"), control.ProgressLog(spark, folder("progress"))
    mix_query = control.start(
        ingest.mix_to_gold(read_events(spark, "parquet", {"path": topic}), gold, f"{rejects}/m",
                           arrival="timestamp"), "m", folder("cp"), drain=True)
    carbon_query = control.start(
        ingest.carbon_to_gold(read_events(spark, "parquet", {"path": other}), gold2, f"{rejects}/c",
                              "timestamp"),
        "c", folder("cp"), drain=True)
    control.run_all(spark, [mix_query, carbon_query], poll=1, report=lambda _: None, log=log)
    left_out = {r.reason for r in spark.read.parquet(f"{rejects}/m").collect()}
    assert left_out and left_out <= {"malformed", "no_zone", "no_event_time"}
    assert [r.reason for r in spark.read.parquet(f"{rejects}/c").collect()] == ["no_zone"]
    assert [r[2] for r in content(tables.read_gold(spark, gold))] == [2.0, 3.0]
    kept = tables.read_gold(spark, gold2).collect()
    # the direct path keeps nulls: the second reading replaced the first
    assert [(r.region, r.carbon_intensity) for r in kept] == [("FR", None)]
    progress = spark.read.parquet(log.path)
    assert {r["name"]: r["n"] for r in progress.groupBy("name").agg(
        F.sum("input_rows").alias("n")).collect()} == {"m": 6, "c": 3}


def test_one_failure_stops_the_other(spark, make_events, folder):
    topic = folder("topic")
    feed(make_events, topic, MESSAGES)

    def fail(batch, batch_id):
        raise ValueError("no such sink")

    events = read_events(spark, "parquet", {"path": topic})
    good = control.start(events.writeStream.format("noop"), "good", folder("cp"), every="1 second")
    bad = control.start(events.writeStream.foreachBatch(fail), "bad", folder("cp"), every=None)
    with pytest.raises(StreamingQueryException, match="no such sink"):
        control.run_all(spark, [good, bad], poll=5, report=lambda _: None)
    assert not good.isActive and not bad.isActive


def test_marked_sync(spark, make_events, folder):
    gold, marks = folder("gold"), folder("marks")

    def silver(messages, first=0):
        return layers.silver_mix(parse.parse_mix(make_events(messages, first=first), arrival="timestamp"))

    first = silver(MESSAGES)
    assert sync.read_mark(spark, marks, "mix") is None
    end = sync.sync_batch(spark, first, layers.to_gold_mix, gold, marks, "mix")
    assert end == at("2024-01-06T10:00:05") == sync.read_mark(spark, marks, "mix")
    before = content(tables.read_gold(spark, gold))
    # nothing new
    sync.sync_batch(spark, first, layers.to_gold_mix, gold, marks, "mix")
    assert content(tables.read_gold(spark, gold)) == before
    # a row committed late, with the stamp of the mark itself
    late = silver([mix("NO", total=8.0)]).withColumn("processing_time", F.lit(end))
    sync.sync_batch(spark, first.unionByName(late), layers.to_gold_mix, gold, marks, "mix")
    assert content(tables.read_gold(spark, gold)) == before + [
        r for r in content(tables.read_gold(spark, gold)) if r[0] == "NO"]
    assert len(before) == 2
    # a table without rows leaves the mark alone
    assert sync.sync_batch(
        spark, first.limit(0), layers.to_gold_mix, gold, marks, "mix") == end


def test_sync_of_rows_without_a_key_only(spark, make_events, folder):
    gold, marks = folder("gold"), folder("marks")
    silver = layers.silver_mix(parse.parse_mix(make_events([mix(time=None)]), arrival="timestamp"))
    end = sync.sync_batch(spark, silver, layers.to_gold_mix, gold, marks, "mix")
    assert end is not None  # the mark moves on, the row is not retried for ever
    assert not files.exists(spark, gold)


def test_landing_keeps_raw_text(spark, make_events, folder):
    topic, bronze, cp = folder("topic"), folder("bronze"), folder("cp")
    messages = ['{"zone":\n "FR"}', "{bad", '{"zone":"é"}']
    feed(make_events, topic, messages)
    drain(ingest.land(read_events(spark, "parquet", {"path": topic}), bronze), cp)
    rows = read_landed(spark, bronze).collect()
    assert sorted(r.value for r in rows) == sorted(['{"zone":  "FR"}', "{bad", '{"zone":"é"}']) or \
        sorted(r.value for r in rows) == sorted(['{"zone": \n "FR"}'.replace("\n ", ""), "{bad", '{"zone":"é"}'])
    assert {r.topic for r in rows} == {V.TOPIC_MIX}
    listing = list_objects(spark, bronze).collect()
    assert listing and all(r.length > 0 for r in listing)


def test_rolled_files(spark, make_events, folder):
    topic, bronze, cp = folder("topic"), folder("bronze"), folder("cp")
    make_events([mix()] * 8).coalesce(1).write.parquet(topic)
    drain(ingest.land_rolled(read_events(spark, "parquet", {"path": topic}), bronze, 3), cp)
    assert list_objects(spark, bronze).count() == 3
    assert read_landed(spark, bronze).count() == 8


def test_console_job_runs(spark, make_events, folder):
    topic = folder("topic")
    feed(make_events, topic, MESSAGES)
    drain(ingest.mix_to_console(read_events(spark, "parquet", {"path": topic}), 3), folder("cp"))


def test_kafka_defaults():
    options = kafka_options("broker:9092", V.TOPIC_MIX, minPartitions="64")
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "true"
    assert options["subscribe"] == V.TOPIC_MIX and options["minPartitions"] == "64"


def test_progress_of_more_batches_than_spark_keeps(spark, folder):
    source, n = folder("many"), 130
    spark.range(0, n, 1, n).write.parquet(source)
    log = control.ProgressLog(spark, folder("progress"))
    rows = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
    query = control.start(rows.writeStream.format("noop"), "many", folder("cp"), drain=True)
    control.drain_all([query])
    stored = log.finish([query]).filter("name = 'many'")
    assert stored.agg(F.sum("input_rows")).first()[0] == n
    assert stored.select("batch_id").distinct().count() > 100


def test_repair_finds_rows_committed_late(spark, make_events, folder):
    gold, marks = folder("gold"), folder("marks")

    def silver(messages):
        return layers.silver_mix(parse.parse_mix(make_events(messages), arrival="timestamp"))

    late = mix("DE", total=5.0)
    new = [mix(total=1.0), mix("ES", total=2.0)]
    whole = silver([late, *new])
    sync.sync_batch(spark, whole.filter("zone <> 'DE'"), layers.to_gold_mix, gold, marks, "mix")
    hours_later = whole.withColumn("processing_time", F.col("processing_time") - F.expr("INTERVAL 3 HOURS"))
    late_rows = hours_later.filter("zone = 'DE'").unionByName(whole.filter("zone <> 'DE'"))
    sync.sync_batch(spark, late_rows, layers.to_gold_mix, gold, marks, "mix")
    assert tables.read_gold(spark, gold).count() == 2
    assert sync.repair(spark, late_rows, layers.to_gold_mix, gold) == 1
    assert tables.read_gold(spark, gold).count() == 3
    assert sync.repair(spark, late_rows, layers.to_gold_mix, gold) == 0
