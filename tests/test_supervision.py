from pyspark.sql import functions as F

from tests.conftest import at, mix
from wattlake.operators import declared, latest, layers, parse, supervision

AS_OF = at("2024-01-06T10:20:00")


def silver(make_events, messages, **where):
    return layers.silver_mix(parse.parse_mix(make_events(messages, **where), arrival="timestamp"))


def test_top_zones_breaks_ties_by_zone(make_events):
    yesterday, before = "2024-01-05T00:00:00.000Z", "2024-01-04T23:59:59.000Z"
    rows = silver(make_events, [
        mix("PT", yesterday, 10.4), mix("DE", yesterday, 10.2), mix("ES", yesterday, 9.6),
        mix("FR", before, 99.0), mix("NO", None, 99.0), mix("SE", yesterday, 12.0),
        mix("SE", yesterday, 13.0),
    ])
    got = [(r.zone, r.records, r.avg_prod) for r in supervision.top_zones(rows, AS_OF, 3).collect()]
    assert got == [("SE", 2, 13.0), ("DE", 1, 10.0), ("ES", 1, 10.0)]


def test_freshness_and_empty_table(make_events):
    rows = silver(make_events, [mix(), mix()])
    got = {r.table_name: r for r in supervision.freshness(
        {"mix": rows, "none": rows.limit(0)}, at("2024-01-06T10:10:00")).collect()}
    # strictly newer than ten minutes: the row at 10:00:00 is out
    assert (got["mix"].row_count, got["mix"].recent_rows, got["mix"].is_empty) == (2, 1, False)
    assert (got["none"].row_count, got["none"].last_update, got["none"].is_empty) == (0, None, True)


def test_counts_stats_and_report(make_events):
    rows = silver(make_events, [mix(), mix("DE"), mix("DE")])
    gold = latest.latest_per_key(layers.has_key(layers.to_gold_mix(rows)))
    counts = supervision.table_counts({"silver": rows, "gold": gold}).collect()
    assert {r.table_name: r.row_count for r in counts} == {"silver": 3, "gold": 2}
    stats = supervision.table_stats({"mix": rows}).first()
    assert (stats.row_count, stats.zones) == (3, 2)
    assert {r.region: r.row_count for r in supervision.count_by_region(gold).collect()} == {
        "DE": 1, "FR": 1}
    report = supervision.flow_report({"mix": rows, "carbon": rows.limit(1)}, gold).collect()
    assert len(report) == 1
    assert (report[0].silver_total, report[0].gold_total, report[0].mix_zones,
            report[0].carbon_zones, report[0].status) == (4, 2, 2, 1, "success")
    pending = supervision.flow_report({"mix": rows, "carbon": rows}, gold.limit(0)).first()
    assert (pending.gold_total, pending.status) == (0, "gold_pending")


def test_reconcile_finds_what_gold_lacks(make_events):
    rows = silver(make_events, [mix(), mix(), mix("DE"), mix("ES", None)])
    gold = layers.has_key(layers.to_gold_mix(rows)).filter("region = 'FR'")
    r = supervision.reconcile({"mix": (rows, latest.latest_per_key(gold))}).first()
    assert (r.silver_rows, r.silver_keys, r.unkeyed_rows) == (4, 2, 1)
    assert (r.gold_keys, r.missing_keys, r.in_sync) == (1, 1, False)


def test_preview_is_a_top_k(make_events):
    rows = silver(make_events, [mix("B"), mix("A")])
    first = supervision.preview(rows, ["zone"], 1)
    assert [r.zone for r in first.collect()] == ["A"]
    assert "TakeOrderedAndProject" in first._jdf.queryExecution().executedPlan().toString()


def test_shares_and_correlation(spark):
    rows = spark.createDataFrame(
        [("A", 1.0, 1.0, 2.0, None), ("A", 3.0, 0.0, 2.0, 1.0), ("B", 0.0, 0.0, 2.0, 0.0)],
        "region string, coal double, gas double, oil double, wind double")
    for c in ("nuclear", "solar", "hydro", "biomass", "geothermal"):
        rows = rows.withColumn(c, F.lit(0.0))
    got = [(r.region, r.fossil_share) for r in declared.fossil_share(rows).collect()]
    assert got == [("B", 1.0), ("A", 0.9)]
    corr = {r.region: r for r in declared.source_corr(rows, "coal", ["gas", "oil"]).collect()}
    assert round(corr["A"].corr_gas, 9) == -1.0
    assert corr["A"].corr_oil is None and corr["B"].corr_gas is None
