"""Stored layers: each table is written at its first use and read by later jobs.

Reports, features and models read stored silver and gold, as they would in a
running system; only the ingest jobs read JSON.
"""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlake.operators.latest import DAY, latest_per_key
from wattlake.operators.layers import (
    direct_gold_mix, has_key, silver_carbon, silver_mix, to_gold_carbon, to_gold_mix,
)
from wattlake.operators.parse import parse_carbon, parse_mix
from wattlake.operators.partials import day_zone_partials
from wattlake.plans import feed
from wattlake.sinks.tables import (
    append_partials, by_day, read_bucketed, read_gold, write_bucketed, write_gold,
)
from wattlake.sources.files import exists, file_state
from wattlake.sources.scratch import new_path
from wattlake.sources.tables import read_days, read_footers


@dataclass(frozen=True)
class Lake:
    """Tables of one feed under one folder; arrival is the record's own time.

    A table does not change once it is written, so its folders are listed once.
    """

    spark: SparkSession
    sf_dir: str
    root: str
    opened: dict[str, DataFrame] = field(default_factory=dict, compare=False, repr=False)

    def _once(self, name: str, write) -> str:
        path = f"{self.root}/{name}"
        if not exists(self.spark, f"{path}/_SUCCESS"):
            self.opened.pop(name, None)
            write(path)
        return path

    def _open(self, name: str, write, read) -> DataFrame:
        path = self._once(name, write)
        if name not in self.opened:
            self.opened[name] = read(self.spark, path)
        return self.opened[name]

    def _stored(self, name: str, make, by: str | None = None) -> DataFrame:
        def write(path):
            if by is None:
                make().write.mode("overwrite").parquet(path)
            else:
                by_day(make(), by).write.mode("overwrite").partitionBy(DAY).parquet(path)

        return self._open(name, write, read_days)

    def _gold(self, name: str, make) -> DataFrame:
        return self._open(name, lambda path: write_gold(make(), path), read_gold)

    def footers(self, name: str) -> DataFrame:
        """A stored table, opened for what its file footers tell."""
        getattr(self, name)()
        return read_footers(self.spark, f"{self.root}/{name}")

    def topic_path(self, name: str) -> str:
        {"mix": self.mix_topic, "carbon": self.carbon_topic}[name]()
        return f"{self.root}/{name}_topic"

    def _events(self) -> DataFrame:
        """The small source is one file; a topic is read by many tasks."""
        events = feed.load_events(self.spark, self.sf_dir)
        return events.repartition(self.spark.sparkContext.defaultParallelism, "event_id")

    def mix_topic(self) -> DataFrame:
        return self._stored("mix_topic", lambda: feed.mix_events(self._events()))

    def carbon_topic(self) -> DataFrame:
        return self._stored("carbon_topic", lambda: feed.carbon_events(self._events()))

    def parsed_mix(self, breakdown: str = "production", strict: bool = False) -> DataFrame:
        return parse_mix(self.mix_topic(), breakdown, "timestamp", strict)

    def parsed_carbon(self, strict: bool = False) -> DataFrame:
        return parse_carbon(self.carbon_topic(), "timestamp", strict)

    def silver_mix(self) -> DataFrame:
        return self._stored("silver_mix", lambda: silver_mix(self.parsed_mix()), "processing_time")

    def silver_carbon(self) -> DataFrame:
        return self._stored(
            "silver_carbon", lambda: silver_carbon(self.parsed_carbon()), "processing_time"
        )

    def gold_mix(self) -> DataFrame:
        return self._gold("gold_mix", lambda: latest_per_key(has_key(to_gold_mix(self.silver_mix()))))

    def gold_carbon(self) -> DataFrame:
        return self._gold(
            "gold_carbon", lambda: latest_per_key(has_key(to_gold_carbon(self.silver_carbon())))
        )

    def bucketed(self, name: str) -> DataFrame:
        """Gold of a feed dealt by key, for joins without an exchange."""
        gold, buckets = getattr(self, f"gold_{name}"), int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        path = self._once(
            f"bucketed_{name}_{buckets}", lambda at: write_bucketed(gold().drop(DAY), at, buckets)
        )
        return read_bucketed(self.spark, path, buckets)

    def partials(self, name: str, value: str) -> DataFrame:
        """Sums by event day and zone, as the silver stream keeps them."""
        silver = getattr(self, f"silver_{name}")
        return self._open(
            f"partials_{name}",
            lambda path: append_partials(day_zone_partials(silver(), value), path, 0), read_days,
        )

    def behind(self, name: str, mark) -> DataFrame:
        """Gold of a feed as it was at a time of arrival."""
        shape = {"mix": to_gold_mix, "carbon": to_gold_carbon}[name]
        silver = getattr(self, f"silver_{name}")
        return self._gold(f"behind_{name}", lambda: latest_per_key(
            has_key(shape(silver()).filter(F.col("ingestion_timestamp") <= mark))
        ))

    def direct_mix(self) -> DataFrame:
        """Gold of the path without silver."""
        return self._gold(
            "direct_mix",
            lambda: latest_per_key(has_key(direct_gold_mix(
                self.parsed_mix("consumption", strict=True)))),
        )


_open: dict[tuple, Lake] = {}


def open_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """One lake per session and state of the source: a changed source gets a new one."""
    state = file_state(spark, f"{sf_dir}/events.parquet")
    key = (spark.sparkContext.applicationId, sf_dir, state)
    if key not in _open:
        _open[key] = Lake(spark, sf_dir, new_path(spark, "lake"))
    return _open[key]
