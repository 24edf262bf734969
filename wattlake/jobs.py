"""Command line of the jobs, for spark-submit or ``python -m wattlake.jobs``.

Options for readers and writers are ``key=value`` pairs and go to Spark as they
are, so servers, tables and credentials stay outside the code.
"""

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlake import vocabulary as V
from wattlake.operators import layers, partials, supervision
from wattlake.plans import consumption, forecast
from wattlake.session import build_session
from wattlake.sinks import models
from wattlake.sinks.events import encode_events, enrich
from wattlake.sinks.events import publish as publish_events
from wattlake.sinks.tables import (
    append_table, compact_days, compact_partials, compact_silver, expire_gold, read_gold,
    rebuild_partials, upsert_connector,
)
from wattlake.sources.events import KAFKA_DEFAULTS, read_events
from wattlake.sources.files import exists
from wattlake.sources.landing import list_objects
from wattlake.sources.tables import JdbcSlices, read_footers, read_jdbc, read_table
from wattlake.streaming import control, ingest, sync


def _pairs(items: list[str] | None) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items or [])


def _events(spark: SparkSession, args, topic: str) -> DataFrame:
    """``{topic}`` in an option value, such as a path, becomes the topic."""
    options = {k: v.replace("{topic}", topic) for k, v in _pairs(args.source).items()}
    if args.source_format == "kafka":
        options = {**KAFKA_DEFAULTS, "subscribe": topic, **options}
    return read_events(spark, args.source_format, options)


def _append_sink(args, name: str):
    if args.sink_format == "parquet":
        return f"{args.root}/silver_{name}"
    options = {k: v.replace("{table}", name) for k, v in _pairs(args.sink).items()}
    return lambda rows, batch_id: append_table(
        rows.drop(*V.ARRIVAL), args.sink_format, options=options
    )


def _upsert_sink(args, name: str):
    if args.sink_format == "parquet":
        return f"{args.root}/gold_{name}"
    options = {k: v.replace("{table}", name) for k, v in _pairs(args.sink).items()}
    return lambda rows, batch_id: upsert_connector(rows, args.sink_format, options)


def _run(spark: SparkSession, args, writers: dict) -> None:
    log = control.ProgressLog(spark, f"{args.root}/progress")  # before the first batch
    queries = [
        control.start(writer, name, f"{args.checkpoints}/{name}", args.every or None, args.drain)
        for name, writer in writers.items()
    ]
    control.run_all(spark, queries, log=log)


def silver(spark, args):
    """Both topics into silver, what cannot be used into quarantine."""
    mix, carbon = _events(spark, args, V.TOPIC_MIX), _events(spark, args, V.TOPIC_CARBON)
    _run(spark, args, {
        "silver_mix": ingest.mix_to_silver(
            mix, _append_sink(args, "mix"), f"{args.root}/rejects_mix",
            partials=f"{args.root}/partials_mix"),
        "silver_carbon": ingest.carbon_to_silver(
            carbon, _append_sink(args, "carbon"), f"{args.root}/rejects_carbon",
            partials=f"{args.root}/partials_carbon"),
    })


def direct(spark, args):
    """Both topics straight into gold, what cannot be used into quarantine."""
    mix, carbon = _events(spark, args, V.TOPIC_MIX), _events(spark, args, V.TOPIC_CARBON)
    _run(spark, args, {
        "gold_mix": ingest.mix_to_gold(
            mix, _upsert_sink(args, "mix"), f"{args.root}/rejects_direct_mix", args.breakdown),
        "gold_carbon": ingest.carbon_to_gold(
            carbon, _upsert_sink(args, "carbon"), f"{args.root}/rejects_direct_carbon"),
    })


def land(spark, args):
    """Both topics as raw text files."""
    _run(spark, args, {
        f"land_{topic}": ingest.land(_events(spark, args, topic), f"{args.root}/bronze/{topic}")
        for topic in (V.TOPIC_MIX, V.TOPIC_CARBON)
    })


def console(spark, args):
    """The mix on the console."""
    _run(spark, args, {"console": ingest.mix_to_console(_events(spark, args, V.TOPIC_MIX))})


def sync_gold(spark, args):
    """New silver rows into gold."""
    shapes = {"mix": layers.to_gold_mix, "carbon": layers.to_gold_carbon}
    _run(spark, args, {
        f"sync_{name}": sync.sync_stream(
            sync.silver_stream(spark, f"{args.root}/silver_{name}"), shape,
            _upsert_sink(args, name))
        for name, shape in shapes.items()
    })


def sync_table(spark, args):
    """One round for silver tables without a stream, e.g. in a database."""
    shapes = {"mix": layers.to_gold_mix, "carbon": layers.to_gold_carbon}
    for name, shape in shapes.items():
        options = {k: v.replace("{table}", name) for k, v in _pairs(args.source).items()}
        sync.sync_batch(spark, _silver_table(spark, args, options), shape,
                        f"{args.root}/gold_{name}", f"{args.root}/marks", name, args.overlap)


def _silver_table(spark: SparkSession, args, options: dict[str, str]) -> DataFrame:
    """Over JDBC in slices if ``--slices`` names a column, its bounds and a count."""
    if args.source_format == "jdbc":
        url, table = options.pop("url"), options.pop("dbtable")
        slices = None
        if args.slices:
            column, lower, upper, count = args.slices
            slices = JdbcSlices(column, lower, upper, int(count))
        return read_jdbc(spark, url, table, options, slices)
    return read_table(spark, options.pop("path", None), args.source_format, options)


def repair(spark, args):
    """Silver rows that gold lacks or has older, e.g. committed after their round."""
    shapes = {"mix": layers.to_gold_mix, "carbon": layers.to_gold_carbon}
    for name, shape in shapes.items():
        rows = read_table(spark, f"{args.root}/silver_{name}")
        print(name, sync.repair(spark, rows, shape, f"{args.root}/gold_{name}"))


def compact(spark, args):
    """The given days of both gold tables into evenly sized files."""
    for name in ("mix", "carbon"):
        compact_days(spark, f"{args.root}/gold_{name}", _days(args))


def compact_silver_days(spark, args):
    """The batch folders of the given days of both silver tables into one per day."""
    for name in ("mix", "carbon"):
        compact_silver(spark, f"{args.root}/silver_{name}", _days(args))


def compact_partial_sums(spark, args):
    """The partial sums of the given event days into one row per zone."""
    for name in ("mix", "carbon"):
        compact_partials(spark, f"{args.root}/partials_{name}", _days(args))


def rebuild_partial_sums(spark, args):
    """The partial sums of all of silver anew, for tables older than they are. No silver
    stream runs meanwhile."""
    for name, value in (("mix", "production_total"), ("carbon", "carbon_intensity")):
        rows = read_table(spark, f"{args.root}/silver_{name}")
        rebuild_partials(partials.day_zone_partials(rows, value), f"{args.root}/partials_{name}")


def _days(args) -> list[dt.date]:
    return [dt.date.fromisoformat(day) for day in args.days]


def expire(spark, args):
    """Deletes the days of gold in which no row is young enough to keep."""
    for name in ("mix", "carbon"):
        print(name, expire_gold(spark, f"{args.root}/gold_{name}", _when(args.at), args.keep_days))


def land_rolled(spark, args):
    """Both topics as raw text files of a bounded number of messages."""
    _run(spark, args, {
        f"rolled_{topic}": ingest.land_rolled(
            _events(spark, args, topic), f"{args.root}/rolled/{topic}", args.records)
        for topic in (V.TOPIC_MIX, V.TOPIC_CARBON)
    })


def landing(spark, args):
    """Whether anything has landed, how much, and the newest objects."""
    listing = list_objects(spark, f"{args.root}/bronze")
    _store(spark, args, "landing_summary", supervision.landing_summary(listing))
    _store(spark, args, "landing_newest", supervision.newest_objects(listing))


def publish(spark, args):
    """Readings in a table (column ``reading``) to a topic, enriched and as JSON."""
    options = _pairs(args.sink)
    readings = read_table(spark, f"{args.root}/readings", "parquet")
    publish_events(encode_events(enrich(readings), options.pop("topic")),
                   options.pop("kafka.bootstrap.servers"), **options)


def _gold(spark, args) -> tuple[DataFrame, DataFrame]:
    return tuple(read_gold(spark, f"{args.root}/gold_{name}") for name in ("mix", "carbon"))


def train(spark, args):
    """Fits, evaluates and saves a model."""
    trained = consumption.train(
        *_gold(spark, args), label=args.label, leaky=args.leaky, trees=args.trees
    )
    run_id = consumption.export(trained, f"{args.root}/model", dt.datetime.now(dt.timezone.utc))
    print(run_id)
    trained.metrics.show(truncate=False)
    trained.importance.show(10, truncate=False)


def compare_history(spark, args):
    """Whether the label's own past makes a better model."""
    rows = consumption.compare_history(*_gold(spark, args), label=args.label, trees=args.trees)
    _store(spark, args, f"history_{args.label}", rows)


def _when(text: str | None) -> dt.datetime:
    """A time without an offset is UTC, one with an offset is converted."""
    if text is None:
        return dt.datetime.now(dt.timezone.utc)
    when = dt.datetime.fromisoformat(text)
    if when.tzinfo is None:
        return when.replace(tzinfo=dt.timezone.utc)
    return when.astimezone(dt.timezone.utc)


def _store(spark: SparkSession, args, name: str, rows: DataFrame) -> None:
    """Appends all rows to a table with the time they were made for, and shows some."""
    path = f"{args.root}/results/{name}"
    made_at = _when(args.at)
    rows.withColumn("made_at", F.lit(made_at)).write.mode("append").parquet(path)
    print(f"{name}: stored in {path}, up to {args.rows} rows of it:")
    stored = spark.read.parquet(path).filter(F.col("made_at") == F.lit(made_at)).drop("made_at")
    stored.show(args.rows, truncate=False)


def predict(spark, args):
    """The next hours of the given regions, or of all, for the label."""
    model, _ = models.load_latest(spark, f"{args.root}/model", args.label)
    name = FORECASTS[args.label]
    rows = forecast.predict_next_hours(
        model, *_gold(spark, args), _when(args.at), args.hours, args.regions or None, name
    )
    _store(spark, args, f"forecast_{args.label}", rows.select("region", "datetime", name))


def compare(spark, args):
    """Regions by predicted value."""
    model, _ = models.load_latest(spark, f"{args.root}/model", args.label)
    name = FORECASTS[args.label]
    rows = forecast.compare_regions(
        model, *_gold(spark, args), args.regions or None, _when(args.at), name
    )
    _store(spark, args, f"comparison_{args.label}", rows)


def report(spark, args):
    """Freshness, totals, leading zones, reconciliation. Where the silver stream keeps
    partial sums, these are read instead of all of silver, and counts come from file
    footers."""
    names = ("mix", "carbon")
    silver_tables = {name: read_table(spark, f"{args.root}/silver_{name}") for name in names}
    mix, carbon = _gold(spark, args)
    as_of = F.lit(_when(args.at))
    pairs = {"mix": (silver_tables["mix"], mix), "carbon": (silver_tables["carbon"], carbon)}
    if all(exists(spark, f"{args.root}/partials_{name}") for name in names):
        sums = {name: read_table(spark, f"{args.root}/partials_{name}") for name in names}
        counted = read_footers(spark, f"{args.root}/gold_mix")
        parts = {
            "freshness": partials.freshness(sums, silver_tables, as_of),
            "flow": supervision.flow_of(partials.table_stats(sums), list(names), counted),
            "top_zones": partials.top_zones(sums["mix"], as_of),
        }
    else:
        parts = {
            "freshness": supervision.freshness(silver_tables, as_of),
            "flow": supervision.flow_report(silver_tables, mix),
            "top_zones": supervision.top_zones(silver_tables["mix"], as_of),
        }
    for name, part in {
        **parts,
        "reconcile": supervision.reconcile(pairs),
        "count_by_region": supervision.count_by_region(mix),
    }.items():
        _store(spark, args, name, part)


# what a model of a label predicts
FORECASTS = {V.CONSUMPTION_LABEL: "predicted_consumption", V.CARBON_LABEL: "predicted_intensity"}

JOBS = {
    "silver": silver, "direct": direct, "land": land, "console": console, "sync": sync_gold,
    "sync-table": sync_table, "repair": repair, "compact": compact, "compact-silver": compact_silver_days,
    "compact-partials": compact_partial_sums, "rebuild-partials": rebuild_partial_sums, "expire": expire,
    "land-rolled": land_rolled, "landing": landing, "publish": publish,
    "train": train, "compare-history": compare_history, "predict": predict, "compare": compare, "report": report,
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="wattlake.jobs", description=__doc__)
    p.add_argument("job", choices=JOBS)
    p.add_argument("--root", required=True, help="folder of the tables")
    p.add_argument("--checkpoints", help="durable folder of the stream checkpoints")
    p.add_argument("--source-format", default="kafka")
    p.add_argument("--source", nargs="*", metavar="KEY=VALUE")
    p.add_argument("--sink-format", default="parquet")
    p.add_argument("--sink", nargs="*", metavar="KEY=VALUE")
    p.add_argument("--breakdown", choices=V.BREAKDOWNS, default="consumption")
    p.add_argument("--every", default="30 seconds", help="empty: as soon as possible")
    p.add_argument("--drain", action="store_true", help="handle what is there and end")
    p.add_argument("--label", default=V.CONSUMPTION_LABEL)
    p.add_argument("--leaky", action="store_true", help="keep the feature computed from the label")
    p.add_argument("--trees", type=int, default=consumption.TREES)
    p.add_argument("--at", help="ISO time in UTC instead of now")
    p.add_argument("--hours", type=int, default=24)
    p.add_argument("--regions", nargs="*")
    p.add_argument("--rows", type=int, default=100, help="rows shown of a stored result")
    p.add_argument("--overlap", default="10 minutes", help="sync-table: read again before the mark")
    p.add_argument("--slices", nargs=4, metavar=("COLUMN", "LOWER", "UPPER", "COUNT"),
                   help="sync-table over JDBC: parallel read")
    p.add_argument("--days", nargs="*", default=[], help="compact, compact-silver, compact-partials: ISO days")
    p.add_argument("--keep-days", type=int, default=V.RETENTION_DAYS)
    p.add_argument("--records", type=int, default=1000, help="land-rolled: messages in a file")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    if args.checkpoints is None:
        args.checkpoints = f"{args.root}/checkpoints"
    JOBS[args.job](spark or build_session(f"wattlake-{args.job}"), args)


if __name__ == "__main__":
    main()
