"""Lags and rolling means against a plain loop; what a window holds."""

import datetime as dt
import random

import pytest

from tests.conftest import at
from wattlake.operators import parse
from wattlake.operators.history import History, with_history
from tests.conftest import mix

HOUR = dt.timedelta(hours=1)


@pytest.mark.parametrize("block_days", [1, 3, 28])
def test_history_of_every_row(spark, block_days):
    rng = random.Random(block_days)
    begin = at("2024-02-20T00:00:00")
    times = {(r, begin + dt.timedelta(minutes=30 * rng.randrange(48 * 20))) for r in "AAAB" for _ in range(250)}
    rows = [(r, t, rng.choice([None, 1.0, 2.0, 8.0]), n) for n, (r, t) in enumerate(sorted(times))]
    rows += [(None, begin, 5.0, 900), ("A", None, 5.0, 901), ("C", begin, 4.0, 902)]
    table = spark.createDataFrame(rows, "region string, timestamp timestamp, used double, number long").repartition(5)
    history = History(lags=(("1h", HOUR), ("2d", 48 * HOUR)), means=(("1d", 24 * HOUR), ("7d", 168 * HOUR)), block_days=block_days)
    got = with_history(table, "used", history)
    assert got.columns == [*table.columns, *history.columns("used")]
    value = {(r, t): v for r, t, v, _ in rows if r and t}

    def mean(region, when, span):
        inside = [v for (r, t), v in value.items() if r == region and when - span <= t < when and v is not None]
        return round(sum(inside) / len(inside), 9) if inside else None

    expected = {}
    for r, t, _, n in rows:
        known = r is not None and t is not None
        expected[n] = (
            value.get((r, t - HOUR)) if known else None, value.get((r, t - 48 * HOUR)) if known else None,
            mean(r, t, 24 * HOUR) if known else None, mean(r, t, 168 * HOUR) if known else None,
        )
    found = {r.number: tuple(None if v is None else round(v, 9) for v in r[4:]) for r in got.collect()}
    assert found == expected
    assert with_history(table.limit(0), "used", history).isEmpty()


def test_a_window_is_no_whole_region(spark):
    table = spark.createDataFrame([("A", at("2024-01-01T00:00:00"), 1.0)], "region string, timestamp timestamp, used double")
    plan = with_history(table, "used")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and "hashpartitioning(_region" in plan and "_block" in plan


def test_paths_are_taken_from_one_parse(spark, make_events):
    events = make_events([
        mix("FR", total=12.5, powerConsumptionBreakdown={"hydro discharge": 3, "wind": "4.5"}),
        mix("DE", total="n/a"), "{bad", None, '{"zone": {"code": 7}, "powerProductionTotal": "NaN"}',
        '{"zone": "A", "zone": "B"}', '["zone"]',
    ])
    got = parse.parse_paths(events, {
        "zone": "$.zone", "total": "$.powerProductionTotal",
        "discharge": "$.powerConsumptionBreakdown['hydro discharge']", "wind": "$.powerConsumptionBreakdown.wind",
    }, numbers={"total", "discharge", "wind"})
    assert got._jdf.queryExecution().optimizedPlan().toString().count("parse_json") <= 1
    rows = [(r.zone, r.total, r.discharge, r.wind) for r in got.orderBy("offset").collect()]
    none = (None, None, None, None)
    assert rows == [("FR", 12.5, 3.0, 4.5), ("DE", None, None, None), none, none, ('{"code":7}', None, None, None), none, none]
