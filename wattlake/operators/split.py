"""Exact split in time order without sorting the table."""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattlake.operators.latest import DAY, utc_instant


@dataclass(frozen=True)
class TemporalCut:
    """Training rows lie before ``until`` or, at ``until`` itself, have a region
    up to ``last_region``."""

    until_micros: int
    last_region: str | None
    train_rows: int
    test_rows: int

    def is_train(self) -> Column:
        until = F.lit(utc_instant(self.until_micros))
        before = F.col("timestamp") < until
        if self.last_region is None:
            return before
        return before | ((F.col("timestamp") == until) & (F.col("region") <= self.last_region))


def test_size(rows: int, test_fraction: float) -> int:
    return math.ceil(test_fraction * rows)


_SECOND = 1_000_000
_DAY = 86_400 * _SECOND


def temporal_cut(gold: DataFrame, test_fraction: float = 0.2) -> TemporalCut:
    """Where the first n - ceil(fraction * n) rows in (timestamp, region) order end.

    Counts rows per day, then per second of the day where the cut falls, then per
    instant of that second, then per region. Each step groups with partial counts
    and looks at a number of groups the calendar bounds (days; 86,400; 1,000,000;
    regions at one instant), whatever the number of rows. The later steps read
    one day only.
    (timestamp, region) has to be unique, as it is in gold.
    """
    by_day = [DAY] if DAY in gold.columns else []
    keys = gold.select("timestamp", "region", *by_day)
    micros = F.unix_micros("timestamp")
    total, wanted, left = None, None, None
    low, high = None, None
    for width in (_DAY, _SECOND, 1):
        scope = keys if low is None else _between(keys, low, high)
        counts = scope.groupBy(F.floor(micros / width).cast("long").alias("slot")).count()
        if total is None:
            # one row per day; the whole table is counted this once
            days = sorted((row["slot"], row["count"]) for row in counts.collect())
            total = sum(n for _, n in days)
            wanted = total - test_size(total, test_fraction)
            if wanted <= 0:
                raise ValueError(f"{total} rows are too few for a test share of {test_fraction}")
            slot, ends_here, left = _day_of(days, wanted)
        else:
            slot, ends_here, left = _slot_of(counts, "slot", left)
        low, high = slot * width, (slot + 1) * width
        if ends_here:
            return TemporalCut(high, None, wanted, total - wanted)
    at_cut = _between(keys, low, high)
    region, _, _ = _slot_of(at_cut.groupBy("region").count(), "region", left)
    return TemporalCut(low, region, wanted, total - wanted)


def _between(keys: DataFrame, low: int, high: int) -> DataFrame:
    first, end = F.lit(utc_instant(low)), F.lit(utc_instant(high))
    if DAY in keys.columns:  # an interval never spans two days
        keys = keys.filter(F.col(DAY) == F.to_date(first))
    return keys.filter((F.col("timestamp") >= first) & (F.col("timestamp") < end))


def _day_of(days: list[tuple[int, int]], left: int) -> tuple[int, bool, int]:
    """As ``_slot_of``, for the few rows of the days."""
    for slot, count in days:
        if left <= count:
            return slot, left == count, left
        left -= count
    raise AssertionError("fewer rows than wanted")


def _slot_of(counts: DataFrame, slot: str, left: int):
    """The group where the running count reaches ``left``; whether it ends there;
    how many of its rows are wanted."""
    running = counts.withColumn("running", F.sum("count").over(Window.orderBy(slot)))
    row = running.filter(F.col("running") >= left).orderBy(slot).first()
    before = row["running"] - row["count"]
    return row[slot], row["running"] == left, left - before


def temporal_split(gold: DataFrame, cut: TemporalCut) -> DataFrame:
    """Adds ``split``: ``train`` or ``test``; no shuffle."""
    return gold.withColumn("split", F.when(cut.is_train(), "train").otherwise("test"))
