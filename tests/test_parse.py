import pytest
from tests.conftest import at, carbon, mix
from wattlake import vocabulary as V
from wattlake.operators import layers, parse

STAMP = "timestamp"


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("arrival_offset").collect()]


def test_bad_messages_become_nulls_not_errors(make_events):
    events = make_events(["{bad", None, "{}", '{"zone":"FR"', "[1]", '"text"'])
    parsed = parse.parse_mix(events, arrival=STAMP)
    assert rows(parsed, "zone", "production_total", "malformed") == [
        (None, None, True), (None, None, True), (None, None, False),
        (None, None, True), (None, None, True), (None, None, True),
    ]
    assert layers.silver_mix(parsed).count() == 0


def test_numbers_as_text(make_events):
    events = make_events([
        mix(total="12.5"), mix(total="n/a"), mix(total=7), mix(total={"a": 1}), mix(total=True),
    ])
    lenient = parse.parse_mix(events, arrival=STAMP)
    assert rows(lenient, "production_total", "consumption_total", "malformed") == [
        (12.5, 90.0, False), (None, 90.0, False), (7.0, 90.0, False), (None, 90.0, False),
        (None, 90.0, False),
    ]
    strict = parse.parse_mix(events, arrival=STAMP, strict=True)
    assert rows(strict, "production_total", "zone") == [
        (None, "FR"), (None, "FR"), (7.0, "FR"), (None, "FR"), (None, "FR"),
    ]


def test_the_two_breakdowns_are_never_mixed(make_events):
    events = make_events([
        mix(powerProductionBreakdown={"nuclear": 5, "coal": None},
            powerConsumptionBreakdown={"nuclear": 9, "oil": 2, "hydro discharge": -3}),
        mix(),
    ])
    made = parse.parse_mix(events, "production", STAMP)
    used = parse.parse_mix(events, "consumption", STAMP)
    assert rows(made, "nuclear", "coal", "oil") == [(5.0, None, None), (None, None, None)]
    assert rows(used, "nuclear", "coal", "oil") == [(9.0, None, 2.0), (None, None, None)]
    with pytest.raises(KeyError):
        parse.parse_mix(events, "both")


def test_field_of_wrong_shape_spoils_only_itself(make_events):
    events = make_events([mix(powerProductionBreakdown=5), mix(datetime="soon")])
    assert rows(parse.parse_mix(events, arrival=STAMP), "zone", "production_total", "nuclear",
                "datetime") == [
        ("FR", 100.0, None, at("2024-01-06T09:00:00").replace(tzinfo=None)),
        ("FR", 100.0, None, None),
    ]


def test_silver_zero_fills_sources_but_not_totals(make_events):
    parsed = parse.parse_mix(make_events([
        mix(used=None, powerProductionBreakdown={"wind": 3}), mix(zone=None), mix(total=None),
        mix(time=None),
    ]), arrival=STAMP)
    silver = layers.silver_mix(parsed)
    assert silver.columns == V.SILVER_MIX_COLUMNS + V.ARRIVAL
    assert rows(silver, "wind", "nuclear", "renewable_percentage", "consumption_total") == [
        (3.0, 0.0, 0.0, None), (0.0, 0.0, 0.0, 90.0),
    ]
    extra = layers.silver_mix(parsed, extras=True)
    assert set(extra.columns) - set(silver.columns) == set(V.SILVER_MIX_EXTRAS)


def test_every_row_is_in_gold_or_quarantine(make_events):
    events = make_events([mix(), mix(zone=None), mix(total=None), mix(time=None), "{bad", None])
    parsed = parse.parse_mix(events, arrival=STAMP)
    rejected = parse.quarantine(parsed, "production_total")
    assert rows(rejected, "reason") == [
        ("no_zone",), ("no_value",), ("no_event_time",), ("malformed",), ("malformed",),
    ]
    good = layers.has_key(layers.to_gold_mix(layers.silver_mix(parsed)))
    assert good.count() + rejected.count() == events.count()


def test_carbon_flags_and_text(make_events):
    events = make_events(
        [carbon(isEstimated=True, emissionFactorType="direct"), carbon(isEstimated="false"),
         carbon(intensity=None), carbon(intensity="5")],
        topic=V.TOPIC_CARBON,
    )
    parsed = parse.parse_carbon(events, STAMP)
    assert rows(parsed, "carbon_intensity", "is_estimated", "emission_factor_type") == [
        (50.0, True, "direct"), (50.0, False, None), (None, None, None), (5.0, None, None),
    ]
    gold = layers.to_gold_carbon(layers.silver_carbon(parsed))
    assert rows(gold, "emission_factor_type", "is_estimated", "estimation_method") == [
        ("direct", False, "real_time"), ("unknown", False, "real_time"),
        ("unknown", False, "real_time"),
    ]


def test_paths_with_spaces(make_events):
    events = make_events([mix(powerConsumptionBreakdown={"hydro discharge": -4.5}), "{bad"])
    got = parse.parse_paths(
        events, {"z": "$.zone", "h": "$.powerConsumptionBreakdown['hydro discharge']"}, {"h"}
    ).orderBy("offset").collect()
    assert [(r.z, r.h) for r in got] == [("FR", -4.5), (None, None)]


def test_display_vocabulary(make_events):
    events = make_events([
        mix(zone=None, powerProductionBreakdown={"coal": 2}), mix(time=None), "{bad", None,
    ])
    shown = parse.display_rows(events, STAMP).collect()
    assert len(shown) == 1
    assert (shown[0].region, shown[0].charbon, shown[0].eolien) == ("Inconnu", 2.0, 0.0)


def test_whole_silver_plan_parses_once(make_events):
    plan = layers.silver_mix(parse.parse_mix(make_events([mix()]), strict=True))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1


def test_direct_rows_keep_nulls_and_get_stable_ids(make_events):
    events = make_events([mix(used=None), mix()])
    first = rows(layers.direct_gold_mix(parse.parse_mix(events, "consumption", STAMP)),
                 "total_consumption", "nuclear", "ingestion_id")
    again = rows(layers.direct_gold_mix(parse.parse_mix(events, "consumption", STAMP)),
                 "total_consumption", "nuclear", "ingestion_id")
    assert first == again
    assert [r[:2] for r in first] == [(None, None), (90.0, None)]
    assert len({r[2] for r in first}) == 2


def test_nan_and_infinity_are_no_readings(make_events):
    text = '{"zone":"FR","datetime":"2024-01-06T09:00:00.000Z","powerProductionTotal":%s,"renewablePercentage":%s}'
    events = make_events([text % ("NaN", 1), text % ('"NaN"', 1), text % ('"Infinity"', 1), text % ("-Infinity", 1),
                          text % ("5.0", '"NaN"')])
    for strict in (False, True):
        parsed = parse.parse_mix(events, arrival=STAMP, strict=strict)
        assert rows(parsed, "production_total")[:4] == [(None,)] * 4
        assert layers.silver_mix(parsed).count() == 1
        assert parse.quarantine(parsed, "production_total").select("reason").distinct().count() == 1
        assert [r.renewable_percentage for r in layers.silver_mix(parsed).collect()] == [0.0]


def test_an_empty_zone_is_none(make_events):
    parsed = parse.parse_mix(make_events([mix(""), mix("FR")]), arrival=STAMP)
    assert [r.zone for r in layers.silver_mix(parsed).collect()] == ["FR"]
    assert [r.reason for r in parse.quarantine(parsed, "production_total").collect()] == ["no_zone"]
