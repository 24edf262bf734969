import pytest
from pyspark.sql import functions as F

from tests.conftest import at, carbon, mix
from wattlake import vocabulary as V
from wattlake.jobs import main
from wattlake.operators import latest, layers, parse
from wattlake.sinks import tables
from wattlake.streaming import ingest


@pytest.fixture
def root(make_events, tmp_path):
    topics = f"{tmp_path}/topics"
    hours = [f"2024-01-06T{h:02}:00:00.000Z" for h in range(24)]
    make_events(
        [mix(z, t, 10.0 * i + n, 9.0 * i + n) for i, t in enumerate(hours)
         for n, z in enumerate(["FR", "DE"])] + ["{bad"]
    ).write.parquet(f"{topics}/{V.TOPIC_MIX}")
    make_events([carbon("FR", t, 40.0) for t in hours],
                V.TOPIC_CARBON).write.parquet(f"{topics}/{V.TOPIC_CARBON}")
    return str(tmp_path)


def test_from_topics_to_forecast(spark, root, capfd):
    def run(job, *more):
        main([job, "--root", root, *more], spark)

    feed = ["--source-format", "parquet", "--source", f"path={root}/topics/{{topic}}", "--drain"]
    run("silver", *feed)
    run("land", *feed)
    run("sync", "--drain")
    assert tables.read_gold(spark, f"{root}/gold_mix").count() == 48
    assert spark.read.parquet(f"{root}/rejects_mix").count() == 1
    run("report", "--at", "2024-01-06T12:00:00")
    run("train", "--trees", "2")
    run("predict", "--at", "2024-01-07T00:00:00", "--hours", "3", "--regions", "FR")
    run("compare", "--at", "2024-01-07T00:00:00", "--regions", "FR", "DE")
    run("train", "--trees", "2", "--label", V.CARBON_LABEL)
    run("predict", "--at", "2024-01-07T01:00:00+01:00", "--hours", "300", "--rows", "5", "--label",
        V.CARBON_LABEL, "--regions", "FR")
    intensity = spark.read.parquet(f"{root}/results/forecast_{V.CARBON_LABEL}")
    assert intensity.count() == 300 and intensity.filter("predicted_intensity IS NULL").count() == 0
    assert intensity.agg(F.min("datetime")).first()[0].isoformat() == "2024-01-07T00:00:00"
    assert spark.read.parquet(f"{root}/results/reconcile").count() == 2
    assert spark.read.parquet(f"{root}/progress").agg(F.sum("input_rows")).first()[0] > 0
    run("landing")
    assert spark.read.parquet(f"{root}/results/landing_summary").first().present
    run("repair")
    run("compact", "--days", "2024-01-06")
    assert tables.read_gold(spark, f"{root}/gold_mix").count() == 48
    run("expire", "--at", "2024-01-07T00:00:00")
    assert tables.read_gold(spark, f"{root}/gold_mix").count() == 48
    shown = capfd.readouterr().out
    assert "2024-01-07 02:00:00" in shown and "predicted_consumption" in shown
    assert "success" in shown


def test_direct_job(spark, root):
    main(["direct", "--root", root, "--source-format", "parquet", "--source",
          f"path={root}/topics/{{topic}}", "--drain"], spark)
    assert tables.read_gold(spark, f"{root}/gold_carbon").count() == 24


def test_other_sinks_get_the_rows(spark, root, make_events):
    events = spark.readStream.schema(V.EVENT).parquet(f"{root}/topics/{V.TOPIC_MIX}")
    seen = {}

    def take(name):
        return lambda rows, batch_id: seen.update({name: (rows.columns, rows.count(), batch_id)})

    ingest.mix_to_silver(events, take("silver"), take("rejects")).option(
        "checkpointLocation", f"{root}/cp1").trigger(availableNow=True).start().awaitTermination()
    assert seen["silver"][1:] == (48, 0) and seen["rejects"][1:] == (1, 0)


def test_classic_silver_table_without_arrival_columns(spark, root, make_events):
    parsed = parse.parse_mix(make_events([mix(total=1.0), mix(total=2.0), mix("DE")]), arrival="timestamp")
    silver = layers.silver_mix(parsed).select(*V.SILVER_MIX_COLUMNS)
    silver.write.parquet(f"{root}/old/mix")
    layers.silver_carbon(parse.parse_carbon(
        make_events([carbon()], V.TOPIC_CARBON), "timestamp")).write.parquet(f"{root}/old/carbon")
    for _ in range(2):
        main(["sync-table", "--root", root, "--source-format", "parquet", "--source",
              f"path={root}/old/{{table}}"], spark)
    gold = tables.read_gold(spark, f"{root}/gold_mix").orderBy("region").collect()
    assert [(r.region, r.total_production) for r in gold] == [("DE", 100.0), ("FR", 2.0)]
    assert tables.read_gold(spark, f"{root}/gold_carbon").count() == 1


def test_rows_of_one_instant_without_offsets_have_one_winner(spark, make_events):
    parsed = parse.parse_mix(make_events([mix(total=float(i)) for i in range(20)]), arrival="timestamp")
    silver = layers.silver_mix(parsed).select(*V.SILVER_MIX_COLUMNS).withColumn(
        "processing_time", F.lit(at("2024-01-06T10:00:00")))
    winners = {
        latest.latest_per_key(layers.to_gold_mix(silver.orderBy(order).repartition(n))).first()
        .total_production
        for n, order in ((1, F.col("production_total")), (3, F.desc("production_total")), (5, F.rand()))
    }
    assert len(winners) == 1
