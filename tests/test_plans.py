"""What reaches the scan, and what is not shuffled."""

import pytest

from tests.conftest import SF, at
from wattlake.operators import features as ft
from wattlake.operators import latest, layers, split, supervision
from wattlake.plans.lake import open_lake


@pytest.fixture(scope="module")
def lake(spark):
    return open_lake(spark, SF)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_is_one_narrow_stage(lake):
    plan = physical(layers.silver_mix(lake.parsed_mix()))
    assert "Exchange" not in plan
    assert "ReadSchema: struct<value:binary,partition:int,offset:bigint,timestamp:timestamp>" in plan


def test_each_message_is_parsed_once(lake):
    plan = layers.silver_mix(lake.parsed_mix(strict=True))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_gold_combines_before_its_one_exchange(lake):
    plan = physical(latest.latest_per_key(layers.has_key(layers.to_gold_mix(lake.silver_mix()))))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Partial") > plan.index("Exchange hashpartitioning")
    assert plan.count("WindowGroupLimit") == 2
    assert "IsNotNull(datetime)" in plan


def test_leading_zones_read_three_columns(lake):
    plan = physical(supervision.top_zones(lake.silver_mix(), at("2024-01-30T12:00:00")))
    assert "TakeOrderedAndProject" in plan
    assert "GreaterThanOrEqual(datetime," in plan
    assert "ReadSchema: struct<zone:string,datetime:timestamp,production_total:double>" in plan


def test_retention_is_pushed_down(lake):
    plan = physical(latest.retained(lake.gold_mix(), at("2024-01-30T12:00:00"), 5))
    assert "GreaterThanOrEqual(ingestion_timestamp," in plan


def test_split_does_not_shuffle_and_later_steps_read_one_day(lake):
    gold = lake.gold_mix()
    cut = split.temporal_cut(gold)
    assert "Exchange" not in physical(split.temporal_split(gold, cut))
    scope = split._between(gold.select("timestamp", "region", "date"), 1706140800000000,
                           1706140801000000)
    assert "PartitionFilters: [isnotnull(date" in physical(scope)


def test_join_shuffles_each_side_once_at_most(lake):
    plan = physical(ft.mix_with_carbon(lake.gold_mix(), lake.gold_carbon()))
    assert plan.count("Exchange hashpartitioning") <= 2
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_forecast_grid_has_no_cross_join(lake):
    snapshot = ft.latest_snapshot(lake.gold_mix(), lake.gold_carbon())
    plan = physical(ft.forecast_grid(snapshot, at("2024-01-31T00:00:00"), 24))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_codes_do_not_move_the_rows(lake):
    plan = physical(ft.encode_region(lake.gold_mix()))
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_latest_snapshot_sorts_nothing(lake):
    plan = physical(ft.latest_snapshot(lake.gold_mix(), lake.gold_carbon()))
    assert "SortAggregate" not in plan and "Window" not in plan and "Sort [" not in plan
