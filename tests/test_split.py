import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window, functions as F

from tests.conftest import at
from wattlake.operators.split import temporal_cut, temporal_split

SCHEMA = "region string, timestamp timestamp"


def table(spark, keys):
    return spark.createDataFrame([(r, t) for r, t in keys], SCHEMA)


def by_rank(rows, fraction=0.2):
    w = Window.orderBy("timestamp", "region")
    n = rows.count()
    return rows.withColumn("rn", F.row_number().over(w)).withColumn(
        "expected", F.when(F.col("rn") <= n - math.ceil(fraction * n), "train").otherwise("test"))


def check(rows, fraction=0.2):
    cut = temporal_cut(rows, fraction)
    got = temporal_split(by_rank(rows, fraction), cut)
    assert got.filter("split <> expected").count() == 0
    sizes = {r["split"]: r["count"] for r in got.groupBy("split").count().collect()}
    assert sizes == {k: v for k, v in (("train", cut.train_rows), ("test", cut.test_rows)) if v}
    return cut


def test_recorded_size(spark):
    hours = [at("2024-01-01T00:00:00") + dt.timedelta(hours=h) for h in range(131)]
    cut = check(table(spark, [("FR", t) for t in hours]))
    assert (cut.train_rows, cut.test_rows) == (104, 27)


@pytest.mark.parametrize("n", [2, 5, 10])
def test_small(spark, n):
    check(table(spark, [("FR", at("2024-01-01T00:00:00") + dt.timedelta(hours=h)) for h in range(n)]))


@pytest.mark.parametrize("n", [0, 1])
def test_too_few(spark, n):
    with pytest.raises(ValueError):
        temporal_cut(table(spark, [("FR", at("2024-01-01T00:00:00"))] * n))


def test_one_instant_for_all(spark):
    cut = check(table(spark, [(f"R{i:03}", at("2024-01-01T05:00:00")) for i in range(57)]))
    assert cut.last_region is not None


def test_a_third_of_all_rows_in_one_second(spark):
    rng = random.Random(5)
    start = at("2023-12-30T00:00:00")
    keys = {(f"R{rng.randrange(40)}", start + dt.timedelta(seconds=rng.randrange(400_000)))
            for _ in range(400)}
    keys |= {(f"R{rng.randrange(9)}", start + dt.timedelta(seconds=300_000, microseconds=m))
             for m in range(200)}
    for fraction in (0.05, 0.2, 0.5, 0.9):
        check(table(spark, sorted(keys)), fraction)


def test_before_1970(spark):
    check(table(spark, [("FR", at("1969-12-31T22:00:00") + dt.timedelta(hours=h)) for h in range(10)]))
