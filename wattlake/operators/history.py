"""Features from a region's own past: values some time ago and means of the time before."""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

HOUR = dt.timedelta(hours=1)
DAY_LONG = dt.timedelta(days=1)


@dataclass(frozen=True)
class History:
    """Lags and spans of means, by the suffix of their columns."""

    lags: tuple[tuple[str, dt.timedelta], ...] = (("1h", HOUR), ("24h", DAY_LONG), ("7d", 7 * DAY_LONG))
    means: tuple[tuple[str, dt.timedelta], ...] = (("1h", HOUR), ("24h", DAY_LONG), ("7d", 7 * DAY_LONG))
    #: Days of a block: what a region has in so many days, and before it as far as the
    #: longest span reaches, is what one task holds of it.
    block_days: int = 28

    def columns(self, value: str) -> list[str]:
        return [f"{value}_lag_{s}" for s, _ in self.lags] + [f"{value}_mean_{s}" for s, _ in self.means]

    def reach(self) -> dt.timedelta:
        return max(span for _, span in (*self.lags, *self.means))


def _micros(span: dt.timedelta) -> int:
    return span // dt.timedelta(microseconds=1)


def with_history(gold: DataFrame, value: str, history: History = History()) -> DataFrame:
    """Every row with ``<value>_lag_<s>``, the value exactly so long before, and
    ``<value>_mean_<s>``, the mean of the time before it, the row itself left out.

    Null where there is no earlier row; null values are left out of means. (region,
    timestamp) is unique, as in gold; a row without either has no history. The window is
    over a region and a block of days; a row near the end of a block is seen from the
    next one too, so a region with a third of all rows is as many tasks as it has blocks.
    """
    kept = gold.columns
    added = history.columns(value)
    block_width = _micros(history.block_days * DAY_LONG)
    micros = F.unix_micros("timestamp")
    block = F.floor(micros / block_width)
    last = F.floor((micros + _micros(history.reach())) / block_width)
    usable = F.col("region").isNotNull() & F.col("timestamp").isNotNull()
    # Beyond its own block a row brings its value only.
    seen = gold.filter(usable).select(
        F.col("region").alias("_region"), micros.alias("_micros"), F.col(value).cast("double").alias("_value"),
        block.alias("_own"), F.explode(F.sequence(block, last)).alias("_block"), F.struct(*kept).alias("_row"),
    ).withColumn("_row", F.when(F.col("_own") == F.col("_block"), F.col("_row")))
    order = Window.partitionBy("_region", "_block").orderBy("_micros")
    lags = [
        F.max("_value").over(order.rangeBetween(-_micros(span), -_micros(span))).alias(name)
        for name, (_, span) in zip(added, history.lags)
    ]
    means = [
        F.avg("_value").over(order.rangeBetween(-_micros(span), -1)).alias(name)
        for name, (_, span) in zip(added[len(history.lags):], history.means)
    ]
    found = seen.select("_row", *lags, *means).filter("_row IS NOT NULL").select("_row.*", *added)
    return found.unionByName(gold.filter(~usable), allowMissingColumns=True)
