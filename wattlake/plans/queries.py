"""The registered queries: every operator over messages derived from the whole
``events`` table. Ingest queries start from JSON text, the others from the stored
layers (see ``lake``).

Timestamps leave as ``timestamp_ntz`` in UTC, the type of ``events.ts``.
"""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattlake import vocabulary as V
from wattlake.functions.calendar import tomorrow_at
from wattlake.functions.identity import base_name
from wattlake.operators import (
    asof, declared, digests, features as ft, history, layers, metrics, parse, partials, supervision,
)
from wattlake.operators.latest import (
    for_regions, high_water_mark, latest_by_region, latest_per_key, retained,
)
from wattlake.operators.split import temporal_cut, temporal_split
from wattlake.plans import consumption, feed, forecast
from wattlake.plans.lake import Lake, open_lake
from wattlake.session import use_utc
from wattlake.sinks import models, tables as sinks
from wattlake.sinks.events import enrich
from wattlake.sinks.tables import append_table, read_gold
from wattlake.sources.events import read_events
from wattlake.sources.files import exists
from wattlake.sources.landing import list_objects, read_landed
from wattlake.sources.scratch import new_path
from wattlake.sources.tables import read_incremental
from wattlake.streaming import control, ingest, sync

RETENTION_SHOWN = 14
ROLL_SHOWN = 1000
MORNING_HOUR = 10
COMPARED_TREES = 10

Query = Callable[[SparkSession, str], DataFrame]


def _plain_times(df: DataFrame) -> DataFrame:
    times = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.load_events(use_utc(spark), sf_dir)


def _lake(spark: SparkSession, sf_dir: str) -> Lake:
    return open_lake(use_utc(spark), sf_dir)


def _as_of(spark: SparkSession, sf_dir: str) -> Column:
    """The newest arrival: reads one column."""
    newest = _events(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("processing_time"))
    return F.lit(high_water_mark(newest))


def _with_event_id(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("arrival_offset", "event_id").drop("arrival_partition", "date")


def _topic(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The topic's file twin as a stream."""
    return read_events(spark, "parquet", {"path": _lake(spark, sf_dir).topic_path(name)})


# --- ingest ------------------------------------------------------------------

def src_events(spark, sf_dir):
    """Stream scan of the topic's file twin, then the classic projection."""
    rows = _topic(spark, sf_dir, "mix").select(
        "topic", F.col("offset").alias("event_id"), F.col("timestamp").alias("processing_time"),
        F.length(F.col("value").cast("string")).isNotNull().alias("has_text"),
    )
    out = new_path(spark, "scanned")
    query = rows.writeStream.format("parquet").option("path", out)
    control.drain_all([control.start(query, "src_events", new_path(spark, "cp"), drain=True)])
    return _plain_times(spark.read.schema(rows.schema).parquet(out))


def enrich_events(spark, sf_dir):
    """Readings with the polled zone and the polling time."""
    rows = enrich(feed.mix_readings(_events(spark, sf_dir)), F.col("arrival"), F.col("owner"))
    return rows.select(
        F.col("offset").alias("event_id"), F.col("reading.zone").alias("zone"),
        F.col("reading.timestamp").alias("epoch"),
        F.col("reading.date_processing").alias("date_processing"),
    )


def encode_events(spark, sf_dir):
    """Carbon readings to JSON and back: the fields as text."""
    sent = _lake(spark, sf_dir).carbon_topic()
    return parse.parse_paths(
        sent,
        {"zone": "$.zone", "datetime": "$.datetime", "carbon_intensity": "$.carbonIntensity",
         "emission_factor_type": "$.emissionFactorType", "is_estimated": "$.isEstimated",
         "date_processing": "$.date_processing"},
        numbers={"carbon_intensity"},
    ).withColumnRenamed("offset", "event_id").drop("partition")


def parse_mix(spark, sf_dir):
    parsed = _lake(spark, sf_dir).parsed_mix()
    return _plain_times(_with_event_id(parsed.drop("topic", "raw")))


def parse_mix_consumption(spark, sf_dir):
    """The other breakdown, numbers only where JSON has numbers."""
    parsed = _lake(spark, sf_dir).parsed_mix("consumption", strict=True)
    return _plain_times(
        _with_event_id(parsed.drop("topic", "raw"))
    )


def parse_mix_path(spark, sf_dir):
    rows = parse.parse_paths(
        _lake(spark, sf_dir).mix_topic(),
        {"zone": "$.zone", "production_total": "$.powerProductionTotal",
         "consumption_total": "$.powerConsumptionTotal",
         "nuclear": "$.powerProductionBreakdown.nuclear",
         "wind": "$.powerProductionBreakdown.wind",
         "renewable_percentage": "$.renewablePercentage",
         "hydro_discharge": "$.powerConsumptionBreakdown['hydro discharge']"},
        numbers={"production_total", "consumption_total", "nuclear", "wind",
                 "renewable_percentage", "hydro_discharge"},
    )
    return rows.withColumnRenamed("offset", "event_id").drop("partition")


def parse_carbon(spark, sf_dir):
    parsed = _lake(spark, sf_dir).parsed_carbon()
    return _plain_times(_with_event_id(parsed.drop("topic", "raw")))


def fill_defaults(spark, sf_dir):
    parsed = _lake(spark, sf_dir).parsed_mix()
    zeros = {c: 0.0 for c in V.GOLD_SOURCES + ["production_total", "renewable_percentage"]}
    filled = layers.fill_defaults(parsed, {**zeros, "zone": "unknown"})
    return filled.select(F.col("arrival_offset").alias("event_id"), "zone", *zeros)


def silver_mix(spark, sf_dir):
    return _plain_times(_with_event_id(layers.silver_mix(_lake(spark, sf_dir).parsed_mix())))


def silver_carbon(spark, sf_dir):
    return _plain_times(_with_event_id(layers.silver_carbon(_lake(spark, sf_dir).parsed_carbon())))


def stamp(spark, sf_dir):
    """All rows of one batch carry one processing time."""
    rows = layers.silver_mix(parse.parse_mix(_lake(spark, sf_dir).mix_topic()))
    return rows.agg(
        F.count("*").alias("row_count"), F.countDistinct("processing_time").alias("stamps")
    )


def to_display(spark, sf_dir):
    shown = parse.display_rows(_lake(spark, sf_dir).mix_topic(), "timestamp")
    return _plain_times(shown)


def valid_display(spark, sf_dir):
    """What passes the console job's filters, per displayed region."""
    shown = parse.display_rows(_lake(spark, sf_dir).mix_topic(), "timestamp")
    return _plain_times(shown.groupBy("region").agg(
        F.count("*").alias("row_count"), F.max("date_heure").alias("last_time")
    ))


def quarantine(spark, sf_dir):
    lake = _lake(spark, sf_dir)
    rows = parse.quarantine(lake.parsed_mix(), "production_total").unionByName(
        parse.quarantine(lake.parsed_carbon(), "carbon_intensity")
    )
    return _plain_times(_with_event_id(rows.drop("raw")))


# --- gold --------------------------------------------------------------------

def to_gold_mix(spark, sf_dir):
    return _plain_times(_with_event_id(layers.to_gold_mix(_lake(spark, sf_dir).silver_mix())))


def to_gold_carbon(spark, sf_dir):
    rows = layers.to_gold_carbon(_lake(spark, sf_dir).silver_carbon())
    return _plain_times(_with_event_id(rows))


def gold_mix(spark, sf_dir):
    """Latest arrival per key, from silver."""
    rows = layers.has_key(layers.to_gold_mix(_lake(spark, sf_dir).silver_mix()))
    return _plain_times(_with_event_id(latest_per_key(rows)))


def gold_carbon(spark, sf_dir):
    rows = layers.has_key(layers.to_gold_carbon(_lake(spark, sf_dir).silver_carbon()))
    return _plain_times(_with_event_id(latest_per_key(rows)))


def gold_mix_direct(spark, sf_dir):
    """The path without silver: consumption breakdown, nulls kept, own ids."""
    rows = layers.direct_gold_mix(_lake(spark, sf_dir).parsed_mix("consumption", strict=True))
    return _plain_times(_with_event_id(latest_per_key(layers.has_key(rows))))


def gold_carbon_direct(spark, sf_dir):
    rows = layers.direct_gold_carbon(_lake(spark, sf_dir).parsed_carbon(strict=True))
    return _plain_times(_with_event_id(latest_per_key(layers.has_key(rows))))


def ingestion_id(spark, sf_dir):
    rows = layers.direct_gold_mix(_lake(spark, sf_dir).parsed_mix("consumption"))
    return rows.select(F.col("arrival_offset").alias("event_id"), "ingestion_id")


def gold_scan(spark, sf_dir):
    """One column of the stored table, summed per day."""
    return _lake(spark, sf_dir).gold_mix().groupBy("date").agg(
        F.count("*").alias("row_count"),
        F.round(F.sum("total_production"), 2).alias("total_production"),
    ).withColumn("date", F.col("date").cast("string"))


def append_count(spark, sf_dir):
    """Rows of one append, counted while they are written, and rows read back."""
    where = new_path(spark, "append")
    written = append_table(_lake(spark, sf_dir).silver_carbon(), path=where, partition_by=["date"])
    return spark.read.parquet(where).agg(F.count("*").alias("rows_read")).withColumn(
        "rows_written", F.lit(written).cast("long")
    )


def _silver(lake: Lake) -> dict[str, DataFrame]:
    return {"mix": lake.silver_mix(), "carbon": lake.silver_carbon()}


def high_water_marks(spark, sf_dir):
    """One mark per silver table."""
    parts = [
        df.agg(F.max("processing_time").alias("mark")).select(F.lit(name).alias("table_name"), "mark")
        for name, df in _silver(_lake(spark, sf_dir)).items()
    ]
    return _plain_times(parts[0].unionByName(parts[1]))


def incremental_read(spark, sf_dir):
    """Silver rows above the mark of a day before the newest arrival."""
    mark = _as_of(spark, sf_dir) - F.expr("INTERVAL 1 DAY")
    return _plain_times(_with_event_id(
        read_incremental(_lake(spark, sf_dir).silver_mix(), mark, stored_by="processing_time")
    ))


def latest_region_rows(spark, sf_dir):
    return _plain_times(_with_event_id(latest_by_region(_lake(spark, sf_dir).gold_mix())))


def retention(spark, sf_dir):
    kept = retained(_lake(spark, sf_dir).gold_mix(), _as_of(spark, sf_dir), RETENTION_SHOWN)
    return _plain_times(kept.select(*V.KEY, "ingestion_timestamp", "total_production"))


def count_by_region(spark, sf_dir):
    return supervision.count_by_region(_lake(spark, sf_dir).gold_mix())


def preview(spark, sf_dir):
    """First ten rows of gold in key order."""
    gold = _lake(spark, sf_dir).gold_mix()
    return _plain_times(_with_event_id(supervision.preview(gold, V.KEY)))


def preview_silver(spark, sf_dir):
    """First rows of silver in order of arrival."""
    silver = _lake(spark, sf_dir).silver_mix()
    return _plain_times(_with_event_id(
        supervision.preview(silver, ["processing_time", "arrival_offset"], 5)
    ))


# --- supervision ---------------------------------------------------------------

def table_counts(spark, sf_dir):
    """From file footers."""
    lake = _lake(spark, sf_dir)
    names = ("silver_mix", "silver_carbon", "gold_mix", "gold_carbon")
    return supervision.table_counts({name: lake.footers(name) for name in names})


def freshness(spark, sf_dir):
    return _plain_times(
        supervision.freshness(_silver(_lake(spark, sf_dir)), _as_of(spark, sf_dir))
    )


def table_stats(spark, sf_dir):
    return _plain_times(supervision.table_stats(_silver(_lake(spark, sf_dir))))


def _partials(lake: Lake) -> dict[str, DataFrame]:
    return {
        "mix": lake.partials("mix", "production_total"),
        "carbon": lake.partials("carbon", "carbon_intensity"),
    }


def top_zones(spark, sf_dir):
    """From the sums of two days and later."""
    sums = _partials(_lake(spark, sf_dir))["mix"]
    return partials.top_zones(sums, _as_of(spark, sf_dir))


def top_zones_scanned(spark, sf_dir):
    """The same from all of silver."""
    return supervision.top_zones(_lake(spark, sf_dir).silver_mix(), _as_of(spark, sf_dir))


def day_zone_sums(spark, sf_dir):
    """The sums that the silver stream keeps, over several batches."""
    return _plain_times(partials.merge_partials(_stream_partials(spark, sf_dir))).withColumns({
        "date": F.col("date").cast("string"), "total": F.round("total", 4),
    })


def table_stats_kept(spark, sf_dir):
    return _plain_times(partials.table_stats(_partials(_lake(spark, sf_dir))))


def freshness_kept(spark, sf_dir):
    lake = _lake(spark, sf_dir)
    return _plain_times(partials.freshness(_partials(lake), _silver(lake), _as_of(spark, sf_dir)))


def flow_report_kept(spark, sf_dir):
    """From the kept sums and the file footers of gold."""
    lake = _lake(spark, sf_dir)
    sums = _partials(lake)
    return supervision.flow_of(partials.table_stats(sums), list(sums), lake.footers("gold_mix"))


def reconcile_digests(spark, sf_dir):
    """As ``reconcile``, against stored gold, comparing rows only in hours that differ."""
    lake = _lake(spark, sf_dir)
    mark = _as_of(spark, sf_dir) - F.expr("INTERVAL 1 DAY")
    parts = [
        digests.reconcile_by_digests(rows, lake.behind(name, mark)).select(F.lit(name).alias("table_name"), "*")
        for name, rows in _silver(lake).items()
    ]
    return _plain_times(parts[0].unionByName(parts[1]))


def reconcile(spark, sf_dir):
    """Silver against a gold that is one day behind."""
    lake = _lake(spark, sf_dir)
    mark = _as_of(spark, sf_dir) - F.expr("INTERVAL 1 DAY")

    def behind(rows):
        return latest_per_key(layers.has_key(rows.filter(F.col("ingestion_timestamp") <= mark)))

    mix, carbon = lake.silver_mix(), lake.silver_carbon()
    return _plain_times(supervision.reconcile({
        "mix": (mix, behind(layers.to_gold_mix(mix))),
        "carbon": (carbon, behind(layers.to_gold_carbon(carbon))),
    }))


def flow_report(spark, sf_dir):
    lake = _lake(spark, sf_dir)
    return supervision.flow_report(_silver(lake), lake.gold_mix())


# --- features ------------------------------------------------------------------

def _joined(spark, sf_dir) -> DataFrame:
    lake = _lake(spark, sf_dir)
    return ft.mix_with_carbon(
        lake.gold_mix().select(*V.GOLD_MIX_COLUMNS), lake.gold_carbon()
    )


def mix_carbon(spark, sf_dir):
    """Both feeds dealt by key: neither side moves."""
    lake = _lake(spark, sf_dir)
    joined = ft.mix_with_carbon(
        lake.bucketed("mix").select(*V.GOLD_MIX_COLUMNS), lake.bucketed("carbon")
    )
    return _plain_times(joined.drop("ingestion_id"))


def newest_arrivals(spark, sf_dir):
    """Newest arrival of each day of gold, from file footers: the search for expired days."""
    lake = _lake(spark, sf_dir)
    lake.gold_mix()
    return sinks.newest_arrivals(spark, f"{lake.root}/gold_mix").withColumn(
        "date", F.col("date").cast("string")
    )


def features(spark, sf_dir):
    rows = ft.features(_joined(spark, sf_dir))
    present, _ = ft.available(rows, V.FEATURES)
    return _plain_times(rows.select(*V.KEY, *present, V.CONSUMPTION_LABEL))


def features_spark_dow(spark, sf_dir):
    return ft.short_features(_joined(spark, sf_dir))


def rolling_features(spark, sf_dir):
    """What each region used before: values some time ago, means of the time before."""
    rows = _lake(spark, sf_dir).gold_mix().select(*V.KEY, V.CONSUMPTION_LABEL)
    found = history.with_history(rows, V.CONSUMPTION_LABEL)
    added = history.History().columns(V.CONSUMPTION_LABEL)
    return _plain_times(found).withColumns({c: F.round(c, 9) for c in added})


def region_encoded(spark, sf_dir):
    return _plain_times(ft.encode_region(_lake(spark, sf_dir).gold_mix().select(*V.KEY)))


def training_set(spark, sf_dir):
    return _plain_times(ft.training_set(ft.features(_joined(spark, sf_dir)), leaky=True))


def split_rows(spark, sf_dir):
    """Which gold row trains and which tests."""
    gold = _lake(spark, sf_dir).gold_mix()
    return _plain_times(temporal_split(gold, temporal_cut(gold)).select(*V.KEY, "split"))


def region_count(spark, sf_dir):
    return _lake(spark, sf_dir).gold_mix().agg(F.countDistinct("region").alias("regions"))


# --- streams -------------------------------------------------------------------

_TO_SILVER = {"mix": ingest.mix_to_silver, "carbon": ingest.carbon_to_silver}
_TO_GOLD = {"mix": ingest.mix_to_gold, "carbon": ingest.carbon_to_gold}


def _fill(spark, sf_dir, jobs, names) -> tuple[str, str]:
    """The ingest streams of the topics, side by side, to their end: the folders of
    their tables and of their rejects."""
    out, rejects = new_path(spark, "filled"), new_path(spark, "rejects")
    control.drain_all([
        control.start(
            jobs[name](_topic(spark, sf_dir, name), f"{out}/{name}", f"{rejects}/{name}",
                       arrival="timestamp"),
            f"fill_{name}", new_path(spark, "cp"), drain=True)
        for name in names
    ])
    return out, rejects


def _stream_partials(spark, sf_dir) -> DataFrame:
    """The sums of the mix stream, which takes its topic in several batches."""
    out, sums = new_path(spark, "filled"), new_path(spark, "sums")
    topic = read_events(
        spark, "parquet", {"path": _lake(spark, sf_dir).topic_path("mix"), "maxFilesPerTrigger": "3"}
    )
    job = ingest.mix_to_silver(
        topic, f"{out}/mix", f"{out}/rejects", arrival="timestamp", partials=sums
    )
    control.drain_all([control.start(job, "fill_sums", new_path(spark, "cp"), drain=True)])
    return spark.read.parquet(sums)


def _count_rejects(spark, rejects: str) -> DataFrame:
    both = spark.read.parquet(f"{rejects}/mix").unionByName(spark.read.parquet(f"{rejects}/carbon"))
    return both.groupBy("topic", "reason").agg(F.count("*").alias("row_count"))


def stream_silver(spark, sf_dir):
    out, _ = _fill(spark, sf_dir, _TO_SILVER, ["mix"])
    return _plain_times(_with_event_id(spark.read.parquet(f"{out}/mix").drop("date", "batch_id")))


def stream_rejects(spark, sf_dir):
    _, rejects = _fill(spark, sf_dir, _TO_SILVER, ["mix", "carbon"])
    return _count_rejects(spark, rejects)


def stream_gold(spark, sf_dir):
    """Events straight to gold."""
    out, _ = _fill(spark, sf_dir, _TO_GOLD, ["mix"])
    return _plain_times(_with_event_id(read_gold(spark, f"{out}/mix").drop("date")))


def rejects_direct(spark, sf_dir):
    """What the path without silver puts into quarantine."""
    _, rejects = _fill(spark, sf_dir, _TO_GOLD, ["mix", "carbon"])
    return _count_rejects(spark, rejects)


def _sync(spark, silver, shape) -> DataFrame:
    gold = new_path(spark, "gold")
    job = sync.sync_stream(sync.silver_stream(spark, silver), shape, gold)
    control.drain_all([control.start(job, "sync", new_path(spark, "cp"), drain=True)])
    return _plain_times(_with_event_id(read_gold(spark, gold).drop("date")))


def sync_mix(spark, sf_dir):
    out, _ = _fill(spark, sf_dir, _TO_SILVER, ["mix"])
    return _sync(spark, f"{out}/mix", layers.to_gold_mix)


def sync_carbon(spark, sf_dir):
    out, _ = _fill(spark, sf_dir, _TO_SILVER, ["carbon"])
    return _sync(spark, f"{out}/carbon", layers.to_gold_carbon)


def sync_marked(spark, sf_dir):
    """Two rounds of the batch sync: up to a day before the end, then the rest."""
    silver = _lake(spark, sf_dir).silver_mix()
    gold, marks = new_path(spark, "gold"), new_path(spark, "marks")
    first = silver.filter(
        F.col("processing_time") <= _as_of(spark, sf_dir) - F.expr("INTERVAL 1 DAY")
    )
    for rows in (first, silver):
        sync.sync_batch(spark, rows, layers.to_gold_mix, gold, marks, "mix")
    return _plain_times(_with_event_id(read_gold(spark, gold).drop("date")))


def _landed(spark, sf_dir) -> str:
    where = new_path(spark, "bronze")
    for name in ("mix", "carbon"):
        job = ingest.land(_topic(spark, sf_dir, name), f"{where}/{name}")
        control.drain_all([control.start(job, f"land_{name}", new_path(spark, "cp"), drain=True)])
    return where


def bronze_landing(spark, sf_dir):
    """Landed messages per topic and day, read back."""
    where = _landed(spark, sf_dir)
    rows = read_landed(spark, f"{where}/mix").unionByName(read_landed(spark, f"{where}/carbon"))
    zone = F.get_json_object("value", "$.zone")
    return rows.groupBy("topic", F.col("date").cast("string").alias("date")).agg(
        F.count("*").alias("messages"), F.count(zone).alias("with_zone"),
        F.count_if(F.col("value") == "{bad").alias("broken"),
    )


def bronze_rolled(spark, sf_dir):
    """Messages per topic and partition, and that no file holds more than asked."""
    where = new_path(spark, "rolled")
    job = ingest.land_rolled(_topic(spark, sf_dir, "mix"), where, ROLL_SHOWN)
    control.drain_all([control.start(job, "rolled", new_path(spark, "cp"), drain=True)])
    files = (
        read_landed(spark, where)
        .groupBy("topic", "partition", F.col("_metadata.file_path").alias("file"))
        .agg(F.count("*").alias("in_file"))
    )
    return files.groupBy("topic", F.col("partition").cast("int").alias("partition")).agg(
        F.sum("in_file").alias("messages"),
        (F.max("in_file") <= ROLL_SHOWN).alias("within_limit"),
    )


def bronze_listing(spark, sf_dir):
    """Topics and days of the landed objects; none is newer than the newest listed."""
    listing = list_objects(spark, _landed(spark, sf_dir))
    newest = supervision.newest_objects(listing, 1).select(F.col("modificationTime").alias("newest"))
    place = F.col("path")
    return (
        listing.join(newest, listing["modificationTime"] <= newest["newest"], "left")
        .groupBy(
            F.regexp_extract(place, "topic=([^/]+)", 1).alias("topic"),
            F.regexp_extract(place, "date=([^/]+)", 1).alias("date"),
        )
        .agg((F.count_if(F.col("newest").isNull()) == 0).alias("none_newer"),
             (F.min("length") > 0).alias("filled"))
    )


def bronze_summary(spark, sf_dir):
    """Whether anything has landed, and whether all bytes of the messages have."""
    where = _landed(spark, sf_dir)
    summary = supervision.landing_summary(list_objects(spark, where))
    texts = read_landed(spark, f"{where}/mix").unionByName(read_landed(spark, f"{where}/carbon"))
    landed = texts.agg(
        F.count("*").alias("messages"), F.sum(F.octet_length("value") + 1).alias("text_bytes")
    )
    return landed.join(summary).select(
        "messages", "present", (F.col("bytes") == F.col("text_bytes")).alias("all_bytes")
    )


def progress(spark, sf_dir):
    """Rows each stream has read, from the stored reports of its batches."""
    log = control.ProgressLog(spark, new_path(spark, "progress"))
    jobs = [
        control.start(
            ingest.raw_text(_topic(spark, sf_dir, name)).writeStream.format("noop"),
            name, new_path(spark, "cp"), drain=True)
        for name in ("mix", "carbon")
    ]
    control.drain_all(jobs)
    mine = log.finish(jobs).filter(F.col("name").isin("mix", "carbon"))
    return mine.groupBy("name").agg(
        F.sum("input_rows").alias("input_rows")
    )


# --- model -----------------------------------------------------------------------

def _trained_root(spark, sf_dir, label=V.CONSUMPTION_LABEL) -> str:
    """Folder with a saved run; trained at the first use of a lake, loaded later,
    as prediction jobs do."""
    lake = _lake(spark, sf_dir)
    root = f"{lake.root}/runs_{label}"
    if not exists(spark, models.runs_path(root)):
        trained = consumption.train(lake.gold_mix(), lake.gold_carbon(), label)
        trained.scored.write.mode("overwrite").parquet(f"{root}/scored")
        consumption.export(trained, root, dt.datetime.now(dt.timezone.utc))
    return root


def _gold(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    lake = _lake(spark, sf_dir)
    return lake.gold_mix(), lake.gold_carbon()


def regression_metrics(spark, sf_dir):
    """Quality of a given prediction: production as forecast of consumption."""
    gold = _lake(spark, sf_dir).gold_mix()
    split = temporal_split(gold, temporal_cut(gold))
    scored = metrics.regression_metrics(split, V.CONSUMPTION_LABEL, "total_production")
    return scored.withColumns({c: F.round(c, 4) for c in ("mae", "rmse", "r2", "mape")})


# What a learner computes has no twin in SQL: these queries give the parts that are
# determined by the data, and say whether the learned numbers keep to what must hold.

def _is_number(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def _sound() -> Column:
    """Whether the measures of a model keep to what must hold of them."""
    finite = [_is_number(F.col(c)) for c in ("mae", "rmse", "r2", "mape")]
    ordered = (F.col("mae") >= 0) & (F.col("rmse") >= F.col("mae")) & (F.col("r2") <= 1)
    return finite[0] & finite[1] & finite[2] & finite[3] & ordered


def _quality(spark, sf_dir, label) -> DataFrame:
    root = _trained_root(spark, sf_dir, label)
    found = metrics.regression_metrics(spark.read.parquet(f"{root}/scored"), label)
    return found.select(
        "split", "n_rows", "n_zero_actual",
        _sound().alias("sound"),
    )


def train_consumption(spark, sf_dir):
    return _quality(spark, sf_dir, V.CONSUMPTION_LABEL)


def history_comparison(spark, sf_dir):
    """Models of few trees with and without the past, judged on the same held-out rows."""
    lake = _lake(spark, sf_dir)
    found = consumption.compare_history(lake.gold_mix(), lake.gold_carbon(), trees=COMPARED_TREES)
    return found.select("variant", "split", "n_rows", "n_zero_actual", _sound().alias("sound"))


def train_carbon(spark, sf_dir):
    return _quality(spark, sf_dir, V.CARBON_LABEL)


def feature_importance(spark, sf_dir):
    """Every feature of the model once, with a share between 0 and 1; all sum to 1."""
    root = _trained_root(spark, sf_dir)
    run_id = models.latest_run(spark, root).first()["run_id"]
    weights = (
        spark.read.schema("feature string, importance double").option("header", True)
        .csv(f"{root}/importance/{run_id}")
    )
    total = weights.agg(F.sum("importance").alias("total"))
    return weights.join(total).select(
        "feature", F.col("importance").between(0, 1).alias("is_share"),
        (F.abs(F.col("total") - 1) < 1e-6).alias("sums_to_one"),
    )


def residuals(spark, sf_dir):
    root = _trained_root(spark, sf_dir)
    scored = spark.read.parquet(f"{root}/scored").filter(F.col("split") == "test")
    rows = metrics.residuals(scored, V.CONSUMPTION_LABEL)
    return _plain_times(rows.select(
        *V.KEY, "split", "actual",
        (F.col("residual") == F.col("actual") - F.col("predicted")).alias("adds_up"),
    ))


def model_run(spark, sf_dir):
    root = _trained_root(spark, sf_dir)
    return models.latest_run(spark, root, V.CONSUMPTION_LABEL).select(
        "label", "train_rows", "test_rows", "n_features", "n_zero_actual",
        F.array_join("features", ",").alias("features"),
    )


def latest_model(spark, sf_dir):
    """The newest run is found, and its folder bears its name."""
    root = _trained_root(spark, sf_dir)
    return models.latest_run(spark, root).select(
        (base_name(F.col("model_path")) == F.col("run_id")).alias("named"), "label", "n_features"
    )


def region_rows(spark, sf_dir):
    """Gold of two regions only."""
    gold = _lake(spark, sf_dir).gold_mix()
    return _plain_times(for_regions(gold, V.ZONES[:2]).select(*V.KEY, "total_production"))


def latest_snapshot(spark, sf_dir):
    lake = _lake(spark, sf_dir)
    snapshot = ft.latest_snapshot(lake.gold_mix(), lake.gold_carbon())
    return _plain_times(snapshot)


def _past(spark, sf_dir) -> Column:
    """Half past six, ten days before the newest arrival."""
    return F.date_trunc("day", _as_of(spark, sf_dir)) - F.expr("INTERVAL 9 DAY 17 HOURS 30 MINUTES")


def snapshot_as_of(spark, sf_dir):
    """The state of every region as it was known at a past time."""
    at = _past(spark, sf_dir)
    mix, carbon = (asof.until(gold, at) for gold in _gold(spark, sf_dir))
    return _plain_times(ft.latest_snapshot(mix, carbon))


def carbon_as_of(spark, sf_dir):
    """Every mix row with the newest carbon reading at or before it."""
    mix, carbon = _gold(spark, sf_dir)
    rows = mix.select(*V.KEY, "total_production")
    found = asof.as_of_join(rows, carbon, ["carbon_intensity", "emission_factor_type"], "carbon_time")
    return _plain_times(found)


def predict_as_of(spark, sf_dir):
    """A prediction for a past time, and the state that it is made from."""
    model, run = models.load_latest(spark, _trained_root(spark, sf_dir))
    mix, carbon = _gold(spark, sf_dir)
    rows = forecast.predict_next_hours(model, mix, carbon, _past(spark, sf_dir), 1)
    return _plain_times(rows.select(
        "region", "datetime", "state_time", "total_production", "carbon_intensity",
        _is_number(F.col("predicted_consumption")).alias("predicted"),
    ))


def forecast_grid(spark, sf_dir):
    lake = _lake(spark, sf_dir)
    start = F.date_trunc("hour", _as_of(spark, sf_dir))
    grid = ft.forecast_grid(ft.latest_snapshot(lake.gold_mix(), lake.gold_carbon()), start, 24)
    return _plain_times(grid.select(
        "region", "datetime", "state_time", "hour", "day_of_week", "month", "day", "is_weekend",
        "is_peak_hour", "total_production", "carbon_intensity",
    ))


def predict_consumption(spark, sf_dir):
    """The focus zone at ten tomorrow."""
    model, run = models.load_latest(spark, _trained_root(spark, sf_dir))
    mix, carbon = _gold(spark, sf_dir)
    at = tomorrow_at(_as_of(spark, sf_dir), MORNING_HOUR)
    row = forecast.predict_consumption(model, mix, carbon, V.ZONES[0], at, run["run_id"])
    return _plain_times(row.select(
        "region", "datetime", F.col("features.total_production").alias("total_production"),
        _is_number(F.col("predicted_consumption")).alias("predicted"),
    ))


def predict_next_hours(spark, sf_dir):
    model, _ = models.load_latest(spark, _trained_root(spark, sf_dir))
    mix, carbon = _gold(spark, sf_dir)
    start = F.date_trunc("hour", _as_of(spark, sf_dir))
    rows = forecast.predict_next_hours(model, mix, carbon, start, 24)
    return _plain_times(rows.select(
        "region", "datetime", "hour", _is_number(F.col("predicted_consumption")).alias("predicted")
    ))


def predict_next_intensity(spark, sf_dir):
    """The next hours of carbon intensity, by the model trained for it."""
    model, _ = models.load_latest(spark, _trained_root(spark, sf_dir, V.CARBON_LABEL))
    mix, carbon = _gold(spark, sf_dir)
    start = F.date_trunc("hour", _as_of(spark, sf_dir))
    rows = forecast.predict_next_hours(
        model, mix, carbon, start, 24, name="predicted_intensity"
    )
    return _plain_times(rows.select(
        "region", "datetime", "hour", _is_number(F.col("predicted_intensity")).alias("predicted")
    ))


def compare_regions(spark, sf_dir):
    model, _ = models.load_latest(spark, _trained_root(spark, sf_dir))
    mix, carbon = _gold(spark, sf_dir)
    rows = forecast.compare_regions(model, mix, carbon, V.ZONES[:4], _as_of(spark, sf_dir))
    return rows.select("region", _is_number(F.col("predicted_consumption")).alias("predicted"))


# --- declared aims -----------------------------------------------------------------

def intensity_by_zone(spark, sf_dir):
    rows = declared.intensity_by_zone(_joined(spark, sf_dir))
    return rows.withColumn("avg_intensity", F.round("avg_intensity", 4))


def fossil_share(spark, sf_dir):
    rows = declared.fossil_share(_lake(spark, sf_dir).direct_mix())
    return rows.withColumns({c: F.round(c, 4) for c in ("fossil", "output", "fossil_share")})


def source_corr(spark, sf_dir):
    rows = declared.source_corr(
        _lake(spark, sf_dir).gold_mix(), "total_production", ["total_consumption", "nuclear", "gas"]
    )
    return rows.withColumns(
        {c: F.round(c, 4) for c in rows.columns if c.startswith("corr_")}
    )


QUERIES: dict[str, Query] = {
    "src_events": src_events,
    "enrich_events": enrich_events,
    "encode_events": encode_events,
    "parse_mix": parse_mix,
    "parse_mix_consumption": parse_mix_consumption,
    "parse_mix_path": parse_mix_path,
    "parse_carbon": parse_carbon,
    "fill_defaults": fill_defaults,
    "silver_mix": silver_mix,
    "silver_carbon": silver_carbon,
    "stamp": stamp,
    "to_display": to_display,
    "valid_display": valid_display,
    "quarantine": quarantine,
    "to_gold_mix": to_gold_mix,
    "to_gold_carbon": to_gold_carbon,
    "gold_mix": gold_mix,
    "gold_carbon": gold_carbon,
    "gold_mix_direct": gold_mix_direct,
    "gold_carbon_direct": gold_carbon_direct,
    "ingestion_id": ingestion_id,
    "gold_scan": gold_scan,
    "append_count": append_count,
    "high_water_mark": high_water_marks,
    "incremental_read": incremental_read,
    "latest_by_region": latest_region_rows,
    "retention": retention,
    "count_by_region": count_by_region,
    "preview": preview,
    "preview_silver": preview_silver,
    "table_counts": table_counts,
    "freshness": freshness,
    "table_stats": table_stats,
    "top_zones": top_zones,
    "top_zones_scanned": top_zones_scanned,
    "day_zone_sums": day_zone_sums,
    "table_stats_kept": table_stats_kept,
    "freshness_kept": freshness_kept,
    "flow_report_kept": flow_report_kept,
    "reconcile": reconcile,
    "reconcile_digests": reconcile_digests,
    "flow_report": flow_report,
    "mix_carbon": mix_carbon,
    "newest_arrivals": newest_arrivals,
    "features": features,
    "features_spark_dow": features_spark_dow,
    "rolling_features": rolling_features,
    "region_encoded": region_encoded,
    "region_count": region_count,
    "region_rows": region_rows,
    "training_set": training_set,
    "temporal_split": split_rows,
    "regression_metrics": regression_metrics,
    "latest_snapshot": latest_snapshot,
    "snapshot_as_of": snapshot_as_of,
    "carbon_as_of": carbon_as_of,
    "predict_as_of": predict_as_of,
    "forecast_grid": forecast_grid,
    "stream_silver": stream_silver,
    "stream_rejects": stream_rejects,
    "stream_gold": stream_gold,
    "rejects_direct": rejects_direct,
    "sync_mix": sync_mix,
    "sync_carbon": sync_carbon,
    "sync_marked": sync_marked,
    "bronze_landing": bronze_landing,
    "bronze_rolled": bronze_rolled,
    "bronze_listing": bronze_listing,
    "bronze_summary": bronze_summary,
    "progress": progress,
    "train_consumption": train_consumption,
    "train_carbon": train_carbon,
    "history_comparison": history_comparison,
    "feature_importance": feature_importance,
    "residuals": residuals,
    "model_run": model_run,
    "latest_model": latest_model,
    "predict_consumption": predict_consumption,
    "predict_next_hours": predict_next_hours,
    "predict_next_intensity": predict_next_intensity,
    "compare_regions": compare_regions,
    "intensity_by_zone": intensity_by_zone,
    "fossil_share": fossil_share,
    "source_corr": source_corr,
}
