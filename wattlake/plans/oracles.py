"""The same results as SQL over the ``events`` table, without the JSON detour.

Names and constants are written out here and not taken from the code under test, so
that a change on one side shows.
"""

from types import SimpleNamespace

# fixed values of the data contract and of the derived feed
C = SimpleNamespace(
    TOPIC_MIX="mix_energie", TOPIC_CARBON="carbone_energie",
    ZONES=["MA", "FR", "ES", "DE", "IT", "PT", "GB", "CA-ON", "SE", "NO"],
    SILVER_SOURCES=["nuclear", "wind", "solar", "hydro", "gas", "coal", "biomass"],
    GOLD_SOURCES=["nuclear", "wind", "solar", "hydro", "gas", "coal", "biomass", "geothermal", "oil"],
    FOSSIL_SOURCES=["coal", "gas", "oil"],
    PEAK_HOURS=[8, 9, 10, 18, 19, 20],
    UNKNOWN_EMISSION_FACTOR="unknown", UNKNOWN_DISPLAY_REGION="Inconnu",
    DEFAULT_ESTIMATION_METHOD="real_time", SYNC_INGESTION_ID="postgres-sync",
    DISPLAY_SOURCES={"nuclear": "nucleaire", "coal": "charbon", "gas": "gaz", "wind": "eolien",
                     "solar": "solaire", "hydro": "hydraulique"},
    FEATURES=["region_encoded", "hour", "day_of_week", "month", "day", "is_weekend", "is_peak_hour",
              "nuclear", "wind", "solar", "hydro", "gas", "coal", "biomass", "geothermal", "oil",
              "total_production", "total_import", "total_export", "fossil_free_percentage",
              "renewable_percentage", "carbon_intensity", "renewable_ratio", "fossil_ratio",
              "production_consumption_ratio"],
    SHORT_FEATURES=["region", "hour", "day_of_week", "month", "is_weekend", "nuclear", "wind", "solar",
                    "hydro", "gas", "coal", "biomass", "geothermal", "oil", "total_production",
                    "fossil_free_percentage", "renewable_percentage", "carbon_intensity"],
    CONSUMPTION_LABEL="total_consumption", CARBON_LABEL="carbon_intensity",
    SOURCE_OF_EVENT={"click": "nuclear", "view": "wind", "purchase": "solar", "signup": "hydro",
                     "error": "gas"},
    NO_CARBON=73, NO_TIME=79, NO_TOTAL=83, NO_ZONE=89, BROKEN=97, PARTITIONS=4,
)
RETENTION_SHOWN = 14

_ZONES = "[" + ", ".join(f"'{z}'" for z in C.ZONES) + "]"


def _breakdown(value: str, suffix: str) -> str:
    by_source = {source: event for event, source in C.SOURCE_OF_EVENT.items()}
    return ", ".join(
        f"CASE WHEN event_type = '{by_source[s]}' AND NOT broken THEN {value} END AS {s}{suffix}"
        for s in C.GOLD_SOURCES if s in by_source
    )


_ABSENT = [s for s in C.GOLD_SOURCES if s not in C.SOURCE_OF_EVENT.values()]
_NONE = ", ".join(f"CAST(NULL AS DOUBLE) AS {s}" for s in _ABSENT)

# one row per event with the fields of both messages; as_of is the newest arrival
MESSAGES = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
  FROM events
),
msg AS (
  SELECT *, {_ZONES}[CAST(user_id % 10 AS INTEGER) + 1] AS polled_zone,
         k = {C.BROKEN} AS broken
  FROM ev
),
now AS (SELECT max(ts) AS as_of FROM events),
mix AS (
  SELECT event_id, ts AS processing_time, broken AS malformed, k, event_type,
    CASE WHEN k NOT IN ({C.NO_ZONE}, {C.BROKEN}) THEN polled_zone END AS zone,
    CASE WHEN k NOT IN ({C.NO_TIME}, {C.BROKEN}) THEN date_trunc('hour', ts) END AS datetime,
    CASE WHEN k NOT IN ({C.NO_TOTAL}, {C.BROKEN}) THEN value END AS production_total,
    CASE WHEN NOT broken THEN value + k END AS consumption_total,
    CASE WHEN NOT broken THEN CAST(k * 2 AS DOUBLE) END AS import_total,
    CASE WHEN NOT broken THEN CAST(k AS DOUBLE) END AS export_total,
    {_breakdown("value", "")}, {_NONE},
    {_breakdown("value + k", "_used")},
    CASE WHEN NOT broken THEN k / 4.0::DOUBLE END AS geothermal_used,
    CASE WHEN NOT broken THEN k / 2.0::DOUBLE END AS oil_used,
    CASE WHEN NOT broken THEN CAST(k AS DOUBLE) END AS renewable_percentage,
    CASE WHEN NOT broken THEN CAST(least(100, k + 10) AS DOUBLE) END AS fossil_free_percentage
  FROM msg
),
carbon AS (
  SELECT event_id, ts AS processing_time, broken AS malformed,
    CASE WHEN k NOT IN ({C.NO_ZONE}, {C.BROKEN}) THEN polled_zone END AS zone,
    CASE WHEN k NOT IN ({C.NO_TIME}, {C.BROKEN}) THEN date_trunc('hour', ts) END AS datetime,
    CASE WHEN k NOT IN ({C.NO_CARBON}, {C.BROKEN}) THEN CAST(k * 5 AS DOUBLE) END
      AS carbon_intensity,
    CASE WHEN broken THEN NULL WHEN k >= 66 THEN 'direct' WHEN k >= 33 THEN 'lifecycle' END
      AS emission_factor_type,
    CASE WHEN NOT broken THEN k < 25 END AS is_estimated,
    CASE WHEN k < 25 THEN 'TIME_SLICER_AVERAGE' END AS estimation_method
  FROM msg
)"""

_FILLED = ", ".join(f"coalesce({s}, 0.0) AS {s}" for s in C.SILVER_SOURCES)
SILVER = MESSAGES + f""",
silver_mix AS (
  SELECT zone, datetime, production_total, consumption_total, {_FILLED},
         coalesce(renewable_percentage, 0.0) AS renewable_percentage,
         coalesce(fossil_free_percentage, 0.0) AS fossil_free_percentage,
         processing_time, event_id
  FROM mix WHERE zone IS NOT NULL AND production_total IS NOT NULL
),
silver_carbon AS (
  SELECT zone, datetime, carbon_intensity, emission_factor_type, processing_time, event_id
  FROM carbon WHERE zone IS NOT NULL AND carbon_intensity IS NOT NULL
),
mix_rows AS (
  SELECT zone AS region, datetime AS "timestamp", {", ".join(C.SILVER_SOURCES)},
         CAST(0 AS DOUBLE) AS geothermal, CAST(0 AS DOUBLE) AS oil,
         coalesce(consumption_total, 0.0) AS total_consumption,
         production_total AS total_production,
         CAST(0 AS DOUBLE) AS total_import, CAST(0 AS DOUBLE) AS total_export,
         fossil_free_percentage, renewable_percentage,
         processing_time AS ingestion_timestamp, '{C.SYNC_INGESTION_ID}' AS ingestion_id, event_id
  FROM silver_mix
),
carbon_rows AS (
  SELECT zone AS region, datetime AS "timestamp", carbon_intensity,
         coalesce(emission_factor_type, '{C.UNKNOWN_EMISSION_FACTOR}') AS emission_factor_type,
         false AS is_estimated, '{C.DEFAULT_ESTIMATION_METHOD}' AS estimation_method,
         processing_time AS ingestion_timestamp, '{C.SYNC_INGESTION_ID}' AS ingestion_id, event_id
  FROM silver_carbon
)"""


def _latest(rows: str, where: str = "") -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY region, "timestamp" ORDER BY ingestion_timestamp DESC, event_id DESC) AS rn
  FROM {rows} WHERE region IS NOT NULL AND "timestamp" IS NOT NULL {where}
) WHERE rn = 1"""


GOLD = SILVER + f""",
gold_mix AS ({_latest("mix_rows")}),
gold_carbon AS ({_latest("carbon_rows")})"""

_USED = ", ".join(
    f"{s}_used AS {s}" if s not in ("coal", "biomass") else s for s in C.GOLD_SOURCES
)
DIRECT = MESSAGES + f""",
direct_mix AS (
  SELECT zone AS region, datetime AS "timestamp", {_USED},
         consumption_total AS total_consumption, production_total AS total_production,
         import_total AS total_import, export_total AS total_export,
         fossil_free_percentage, renewable_percentage, processing_time AS ingestion_timestamp,
         sha256(concat_ws('|', '{C.TOPIC_MIX}', event_id % {C.PARTITIONS}, event_id))
           AS ingestion_id,
         event_id
  FROM mix
),
direct_carbon AS (
  SELECT zone AS region, datetime AS "timestamp", carbon_intensity, emission_factor_type,
         is_estimated, estimation_method, processing_time AS ingestion_timestamp,
         sha256(concat_ws('|', '{C.TOPIC_CARBON}', event_id % {C.PARTITIONS}, event_id))
           AS ingestion_id,
         event_id
  FROM carbon
)"""

JOINED = GOLD + """,
joined AS (
  SELECT m.* EXCLUDE (event_id, ingestion_id), c.carbon_intensity, c.is_estimated
  FROM gold_mix m
  LEFT JOIN gold_carbon c ON m.region = c.region AND m."timestamp" = c."timestamp"
)"""

_PEAK = ", ".join(map(str, C.PEAK_HOURS))


def _calendar(ts: str) -> str:
    return f"""CAST(extract(hour FROM {ts}) AS INTEGER) AS hour,
  CAST(isodow({ts}) - 1 AS INTEGER) AS day_of_week,
  CAST(extract(month FROM {ts}) AS INTEGER) AS month,
  CAST(extract(day FROM {ts}) AS INTEGER) AS day,
  CAST(isodow({ts}) IN (6, 7) AS INTEGER) AS is_weekend,
  CAST(extract(hour FROM {ts}) IN ({_PEAK}) AS INTEGER) AS is_peak_hour"""


_RATIOS = """renewable_percentage / 100 AS renewable_ratio,
  (100 - fossil_free_percentage) / 100 AS fossil_ratio,
  CASE WHEN total_consumption + 1 <> 0 THEN total_production / (total_consumption + 1) END
    AS production_consumption_ratio"""
FEATURED = JOINED + f""",
featured AS (SELECT *, {_calendar('"timestamp"')}, {_RATIOS} FROM joined)"""

_SPLIT = """CASE WHEN row_number() OVER (ORDER BY "timestamp", region)
  <= count(*) OVER () - ceil(CAST(0.2 AS DOUBLE) * count(*) OVER ()) THEN 'train' ELSE 'test' END
  AS split"""

_NUMERIC = [c for c in C.FEATURES if c != "region_encoded"]

SNAPSHOT = GOLD + f""",
last_mix AS (
  SELECT * EXCLUDE (event_id, ingestion_id, rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY region ORDER BY "timestamp" DESC) AS rn
    FROM gold_mix) WHERE rn = 1
),
last_carbon AS (
  SELECT region, carbon_intensity FROM (
    SELECT *, row_number() OVER (PARTITION BY region ORDER BY "timestamp" DESC) AS rn
    FROM gold_carbon) WHERE rn = 1
),
snapshot AS (
  SELECT m.*, coalesce(c.carbon_intensity, 0.0) AS carbon_intensity
  FROM last_mix m LEFT JOIN last_carbon c ON m.region = c.region
)"""


# the state at half past six, ten days before the newest arrival
_PAST = "date_trunc('day', as_of) - INTERVAL 9 DAY - INTERVAL 17 HOUR - INTERVAL 30 MINUTE"


def _until(table: str) -> str:
    return f"""SELECT * EXCLUDE (rn, as_of) FROM (
    SELECT {table}.*, as_of, row_number() OVER (PARTITION BY region ORDER BY "timestamp" DESC) AS rn
    FROM {table}, now WHERE "timestamp" <= {_PAST}) WHERE rn = 1"""


PAST = GOLD + f""",
past_mix AS ({_until("gold_mix")}),
past_carbon AS ({_until("gold_carbon")}),
past AS (
  SELECT m.* EXCLUDE (event_id, ingestion_id), coalesce(c.carbon_intensity, 0.0) AS carbon_intensity
  FROM past_mix m LEFT JOIN past_carbon c ON m.region = c.region
)"""


def _q(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _stats(body: str, tables=("mix", "carbon")) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {body} FROM silver_{t}" for t in tables
    )


def _reconcile(name: str, stale: str = "") -> str:
    return f"""SELECT '{name}' AS table_name,
  CAST(coalesce(sum(arrivals), 0) AS BIGINT) AS silver_rows,
  count(*) FILTER (WHERE k."timestamp" IS NOT NULL) AS silver_keys,
  CAST(coalesce(sum(arrivals) FILTER (WHERE k."timestamp" IS NULL), 0) AS BIGINT) AS unkeyed_rows,
  count(g.region) AS gold_keys,
  count(*) FILTER (WHERE k."timestamp" IS NOT NULL AND g.region IS NULL) AS missing_keys,{stale}
  max(arrived) AS silver_last, max(g.ingestion_timestamp) AS gold_last,
  count(*) FILTER (WHERE k."timestamp" IS NOT NULL AND g.region IS NULL) = 0 AS in_sync
FROM (SELECT zone AS region, datetime AS "timestamp", count(*) AS arrivals,
             max(processing_time) AS arrived FROM silver_{name} GROUP BY ALL) k
LEFT JOIN behind_{name} g ON k.region = g.region AND k."timestamp" = g."timestamp" """


_BEHIND = "AND ingestion_timestamp <= (SELECT as_of - INTERVAL 1 DAY FROM now)"
_PARSED = (
    "event_id, processing_time, malformed, zone, datetime, production_total, consumption_total, "
    "import_total, export_total, renewable_percentage, fossil_free_percentage"
)
_REASONS = """CASE WHEN malformed THEN 'malformed' WHEN zone IS NULL THEN 'no_zone'
  WHEN {value} IS NULL THEN 'no_value' WHEN datetime IS NULL THEN 'no_event_time' END"""


def _rejects(table: str, value: str, topic: str) -> str:
    return f"""SELECT * FROM (SELECT '{topic}' AS topic, {_REASONS.format(value=value)} AS reason,
  processing_time, event_id FROM {table}) WHERE reason IS NOT NULL"""


_QUARANTINE = (
    _rejects("mix", "production_total", C.TOPIC_MIX) + " UNION ALL "
    + _rejects("carbon", "carbon_intensity", C.TOPIC_CARBON)
)
_KEYLESS = """CASE WHEN malformed THEN 'malformed' WHEN zone IS NULL THEN 'no_zone'
  WHEN datetime IS NULL THEN 'no_event_time' END"""
_DIRECT_REJECTS = " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{topic}' AS topic, {_KEYLESS} AS reason FROM {table}) WHERE reason IS NOT NULL"
    for table, topic in (("mix", C.TOPIC_MIX), ("carbon", C.TOPIC_CARBON))
)
# rows of a model: those with its label, split in time order
_LEARNED = JOINED + f""",
labelled AS (SELECT *, total_consumption AS y FROM joined),
consumption_rows AS (SELECT *, {_SPLIT} FROM labelled),
carbon_labelled AS (SELECT *, carbon_intensity AS y FROM joined WHERE carbon_intensity IS NOT NULL),
carbon_learned AS (SELECT *, {_SPLIT} FROM carbon_labelled)"""
_MODEL_FEATURES = [c for c in C.FEATURES if c != "production_consumption_ratio"]


def _learned(table: str) -> str:
    return _q(_LEARNED, f"""SELECT split, count(*) AS n_rows, count(*) FILTER (WHERE y = 0) AS n_zero_actual,
  true AS sound FROM {table} GROUP BY split""")


_HOURS = _q(SNAPSHOT, """SELECT region, date_trunc('hour', as_of) + INTERVAL 1 HOUR * h AS datetime,
  CAST(extract(hour FROM date_trunc('hour', as_of) + INTERVAL 1 HOUR * h) AS INTEGER) AS hour, true AS predicted
FROM snapshot, now, range(24) AS hours(h)""")
_DISPLAY = (
    f"SELECT coalesce(zone, '{C.UNKNOWN_DISPLAY_REGION}') AS region, datetime AS date_heure, "
    + ", ".join(f"coalesce({s}, 0.0) AS {shown}" for s, shown in C.DISPLAY_SOURCES.items())
    + ", processing_time FROM mix WHERE datetime IS NOT NULL"
)

GOLD_MIX_ROWS = _q(GOLD, "SELECT * FROM gold_mix")
GOLD_CARBON_ROWS = _q(GOLD, "SELECT * FROM gold_carbon")
DIRECT_MIX_ROWS = _q(DIRECT, _latest("direct_mix"))

_TOP_ZONES = _q(SILVER, """SELECT zone, count(*) AS records,
  round(avg(production_total), 0) AS avg_prod
FROM silver_mix, now WHERE datetime >= date_trunc('day', as_of) - INTERVAL 1 DAY
GROUP BY zone ORDER BY avg_prod DESC, zone LIMIT 5""")
_FRESHNESS = _q(SILVER, _stats("""count(*) AS row_count, max(processing_time) AS last_update,
  count(*) FILTER (WHERE processing_time > (SELECT as_of - INTERVAL 10 MINUTE FROM now))
    AS recent_rows, count(*) = 0 AS is_empty"""))
_TABLE_STATS = _q(SILVER, _stats(
    "count(*) AS row_count, count(DISTINCT zone) AS zones, max(processing_time) AS last_update"
))
_FLOW = _q(GOLD, """SELECT
  (SELECT count(*) FROM silver_mix) + (SELECT count(*) FROM silver_carbon) AS silver_total,
  (SELECT count(*) FROM gold_mix) AS gold_total,
  (SELECT count(DISTINCT zone) FROM silver_mix) AS mix_zones,
  (SELECT count(DISTINCT zone) FROM silver_carbon) AS carbon_zones,
  'success' AS status""")
_BOTH_BEHIND = SILVER + f""",
behind_mix AS ({_latest("mix_rows", _BEHIND)}),
behind_carbon AS ({_latest("carbon_rows", _BEHIND)})"""
_STALE = "count(*) FILTER (WHERE g.ingestion_timestamp < k.arrived) AS stale_keys,"

_LABEL_PAST = ", ".join(
    [f"round(max(y) OVER (w RANGE BETWEEN INTERVAL {span} PRECEDING AND INTERVAL {span} PRECEDING), 9) AS total_consumption_lag_{s}"
     for s, span in (("1h", "1 HOUR"), ("24h", "24 HOUR"), ("7d", "7 DAY"))]
    + [f"round(avg(y) OVER (w RANGE BETWEEN INTERVAL {span} PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING), 9) AS total_consumption_mean_{s}"
       for s, span in (("1h", "1 HOUR"), ("24h", "24 HOUR"), ("7d", "7 DAY"))]
).replace("(w RANGE", '(PARTITION BY region ORDER BY "timestamp" RANGE')

ORACLES: dict[str, str] = {
    "src_events": f"""SELECT '{C.TOPIC_MIX}' AS topic, event_id, ts AS processing_time,
  true AS has_text FROM events""",
    "enrich_events": _q(MESSAGES, """SELECT event_id, polled_zone AS zone,
  epoch_us(ts) / 1e6::DOUBLE AS epoch, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date_processing
FROM msg"""),
    "encode_events": _q(MESSAGES, """SELECT event_id, zone,
  strftime(datetime, '%Y-%m-%dT%H:%M:%S.000Z') AS datetime, carbon_intensity,
  emission_factor_type, CAST(is_estimated AS VARCHAR) AS is_estimated,
  CASE WHEN NOT malformed THEN strftime(processing_time, '%Y-%m-%d %H:%M:%S') END
    AS date_processing
FROM carbon"""),
    "parse_mix": _q(MESSAGES, f"SELECT {_PARSED}, {', '.join(C.GOLD_SOURCES)} FROM mix"),
    "parse_mix_consumption": _q(MESSAGES, f"SELECT {_PARSED}, {_USED} FROM mix"),
    "parse_mix_path": _q(MESSAGES, """SELECT event_id, zone, production_total, consumption_total,
  nuclear, wind, renewable_percentage, export_total AS hydro_discharge FROM mix"""),
    "parse_carbon": _q(MESSAGES, "SELECT * FROM carbon"),
    "fill_defaults": _q(
        MESSAGES,
        "SELECT event_id, coalesce(zone, 'unknown') AS zone, "
        + ", ".join(
            f"coalesce({c}, 0.0) AS {c}"
            for c in C.GOLD_SOURCES + ["production_total", "renewable_percentage"]
        )
        + " FROM mix",
    ),
    "silver_mix": _q(SILVER, "SELECT * FROM silver_mix"),
    "silver_carbon": _q(SILVER, "SELECT * FROM silver_carbon"),
    "stamp": _q(SILVER, "SELECT count(*) AS row_count, CAST(1 AS BIGINT) AS stamps FROM silver_mix"),
    "to_display": _q(MESSAGES, _DISPLAY),
    "valid_display": _q(MESSAGES, f"""SELECT region, count(*) AS row_count,
  max(date_heure) AS last_time FROM ({_DISPLAY}) GROUP BY region"""),
    "quarantine": _q(MESSAGES, _QUARANTINE),
    "to_gold_mix": _q(SILVER, "SELECT * FROM mix_rows"),
    "to_gold_carbon": _q(SILVER, "SELECT * FROM carbon_rows"),
    "gold_mix": GOLD_MIX_ROWS,
    "gold_carbon": GOLD_CARBON_ROWS,
    "gold_mix_direct": DIRECT_MIX_ROWS,
    "gold_carbon_direct": _q(DIRECT, _latest("direct_carbon")),
    "ingestion_id": _q(DIRECT, "SELECT event_id, ingestion_id FROM direct_mix"),
    "gold_scan": _q(GOLD, """SELECT strftime("timestamp", '%Y-%m-%d') AS date,
  count(*) AS row_count, round(sum(total_production), 2) AS total_production
FROM gold_mix GROUP BY 1"""),
    "append_count": _q(SILVER, """SELECT count(*) AS rows_read, count(*) AS rows_written
FROM silver_carbon"""),
    "high_water_mark": _q(SILVER, _stats("max(processing_time) AS mark")),
    "incremental_read": _q(SILVER, """SELECT s.* FROM silver_mix s, now
WHERE processing_time > as_of - INTERVAL 1 DAY"""),
    "latest_by_region": _q(GOLD, """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY region ORDER BY "timestamp" DESC) AS rn
  FROM gold_mix) WHERE rn = 1"""),
    "retention": _q(GOLD, f"""SELECT region, "timestamp", ingestion_timestamp, total_production
FROM gold_mix, now WHERE ingestion_timestamp >= as_of - INTERVAL {RETENTION_SHOWN} DAY"""),
    "count_by_region": _q(GOLD, "SELECT region, count(*) AS row_count FROM gold_mix GROUP BY region"),
    "preview": _q(GOLD, 'SELECT * FROM gold_mix ORDER BY region, "timestamp" LIMIT 10'),
    "preview_silver": _q(
        SILVER, "SELECT * FROM silver_mix ORDER BY processing_time, event_id LIMIT 5"
    ),
    "table_counts": _q(GOLD, " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ("silver_mix", "silver_carbon", "gold_mix", "gold_carbon")
    )),
    "freshness": _FRESHNESS,
    "freshness_kept": _FRESHNESS,
    "table_stats": _TABLE_STATS,
    "table_stats_kept": _TABLE_STATS,
    "top_zones": _TOP_ZONES,
    "top_zones_scanned": _TOP_ZONES,
    "day_zone_sums": _q(SILVER, """SELECT strftime(datetime, '%Y-%m-%d') AS date, zone, count(*) AS records,
  count(production_total) AS valued, round(sum(production_total), 4) AS total,
  max(processing_time) AS last_update FROM silver_mix GROUP BY 1, 2"""),
    "reconcile": _q(_BOTH_BEHIND, _reconcile("mix") + " UNION ALL " + _reconcile("carbon")),
    "reconcile_digests": _q(
        _BOTH_BEHIND, _reconcile("mix", _STALE) + " UNION ALL " + _reconcile("carbon", _STALE)
    ),
    "flow_report": _FLOW,
    "flow_report_kept": _FLOW,
    "newest_arrivals": _q(GOLD, """SELECT strftime("timestamp", '%Y-%m-%d') AS date,
  epoch_us(max(ingestion_timestamp)) AS newest FROM gold_mix GROUP BY 1"""),
    "mix_carbon": _q(JOINED, "SELECT * FROM joined"),
    "features": _q(FEATURED, f"""SELECT region, "timestamp", {", ".join(_NUMERIC)},
  {C.CONSUMPTION_LABEL} FROM featured"""),
    "features_spark_dow": _q(JOINED, f"""SELECT region,
  CAST(extract(hour FROM "timestamp") AS INTEGER) AS hour,
  CAST(dayofweek("timestamp") + 1 AS INTEGER) AS day_of_week,
  CAST(extract(month FROM "timestamp") AS INTEGER) AS month,
  CAST(dayofweek("timestamp") IN (0, 6) AS INTEGER) AS is_weekend,
  {", ".join(C.SHORT_FEATURES[5:])}, {C.CONSUMPTION_LABEL}
FROM joined WHERE {C.CONSUMPTION_LABEL} IS NOT NULL"""),
    "rolling_features": _q(GOLD, f"""SELECT region, "timestamp", y AS total_consumption, {_LABEL_PAST}
FROM (SELECT region, "timestamp", total_consumption AS y FROM gold_mix)"""),
    "region_encoded": _q(GOLD, """SELECT region, "timestamp",
  CAST(dense_rank() OVER (ORDER BY region) - 1 AS INTEGER) AS region_encoded FROM gold_mix"""),
    "region_rows": _q(GOLD, """SELECT region, "timestamp", total_production FROM gold_mix
WHERE region IN ('MA', 'FR')"""),
    "region_count": _q(GOLD, "SELECT count(DISTINCT region) AS regions FROM gold_mix"),
    "training_set": _q(FEATURED, f"""SELECT region, "timestamp",
  CAST(dense_rank() OVER (ORDER BY region) - 1 AS INTEGER) AS region_encoded,
  {", ".join(f"coalesce({c}, 0) AS {c}" for c in _NUMERIC)}, {C.CONSUMPTION_LABEL}
FROM featured"""),
    "temporal_split": _q(GOLD, f'SELECT region, "timestamp", {_SPLIT} FROM gold_mix'),
    "regression_metrics": _q(JOINED + f""",
scored AS (
  SELECT total_consumption AS y, total_production AS p, {_SPLIT} FROM joined
)""", """SELECT split, count(*) AS n_rows, round(avg(abs(y - p)), 4) AS mae,
  round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
  round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 4) AS r2,
  round(100 * avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END), 4) AS mape,
  count(*) FILTER (WHERE y = 0) AS n_zero_actual
FROM scored GROUP BY split"""),
    "latest_snapshot": _q(SNAPSHOT, f"SELECT *, {_RATIOS} FROM snapshot"),
    "snapshot_as_of": _q(PAST, f"SELECT *, {_RATIOS} FROM past"),
    "carbon_as_of": _q(GOLD, """SELECT m.region, m."timestamp", m.total_production,
  c."timestamp" AS carbon_time, c.carbon_intensity, c.emission_factor_type
FROM gold_mix m ASOF LEFT JOIN gold_carbon c ON m.region = c.region AND m."timestamp" >= c."timestamp\""""),
    "predict_as_of": _q(PAST, f"""SELECT region, {_PAST} AS datetime, "timestamp" AS state_time,
  total_production, carbon_intensity, true AS predicted FROM past, now"""),
    "forecast_grid": _q(
        SNAPSHOT + """,
grid AS (
  SELECT s.*, date_trunc('hour', as_of) + INTERVAL 1 HOUR * h AS datetime
  FROM snapshot s, now, range(24) AS hours(h)
)""",
        f"""SELECT region, datetime, "timestamp" AS state_time, {_calendar("datetime")},
  total_production, carbon_intensity FROM grid""",
    ),
    "stream_silver": _q(SILVER, "SELECT * FROM silver_mix"),
    "stream_rejects": _q(MESSAGES, f"""SELECT topic, reason, count(*) AS row_count
FROM ({_QUARANTINE}) GROUP BY ALL"""),
    "stream_gold": DIRECT_MIX_ROWS,
    "rejects_direct": _q(MESSAGES, f"""SELECT topic, reason, count(*) AS row_count
FROM ({_DIRECT_REJECTS}) GROUP BY ALL"""),
    "sync_mix": GOLD_MIX_ROWS,
    "sync_carbon": GOLD_CARBON_ROWS,
    "sync_marked": GOLD_MIX_ROWS,
    "bronze_landing": _q(MESSAGES, " UNION ALL ".join(
        f"""SELECT '{topic}' AS topic, strftime(processing_time, '%Y-%m-%d') AS date,
  count(*) AS messages, count(zone) AS with_zone, count(*) FILTER (WHERE malformed) AS broken
FROM {table} GROUP BY ALL"""
        for table, topic in (("mix", C.TOPIC_MIX), ("carbon", C.TOPIC_CARBON))
    )),
    "bronze_rolled": f"""SELECT '{C.TOPIC_MIX}' AS topic,
  CAST(event_id % {C.PARTITIONS} AS INTEGER) AS "partition", count(*) AS messages,
  true AS within_limit FROM events GROUP BY ALL""",
    "progress": """SELECT 'mix' AS name, count(*) AS input_rows FROM events
UNION ALL SELECT 'carbon' AS name, count(*) AS input_rows FROM events""",
    "bronze_listing": _q(MESSAGES, " UNION ALL ".join(
        f"""SELECT DISTINCT '{topic}' AS topic, strftime(processing_time, '%Y-%m-%d') AS date,
  true AS none_newer, true AS filled FROM {table}"""
        for table, topic in (("mix", C.TOPIC_MIX), ("carbon", C.TOPIC_CARBON))
    )),
    "bronze_summary": """SELECT 2 * count(*) AS messages, count(*) > 0 AS present, true AS all_bytes
FROM events""",
    "train_consumption": _learned("consumption_rows"),
    "history_comparison": _q(_LEARNED, """SELECT variant, split, count(*) AS n_rows,
  count(*) FILTER (WHERE y = 0) AS n_zero_actual, true AS sound
FROM consumption_rows, (SELECT unnest(['plain', 'history']) AS variant) GROUP BY ALL"""),
    "train_carbon": _learned("carbon_learned"),
    "feature_importance": "SELECT unnest(["
    + ", ".join(f"'{f}'" for f in _MODEL_FEATURES)
    + "]) AS feature, true AS is_share, true AS sums_to_one",
    "residuals": _q(_LEARNED, """SELECT region, "timestamp", split, y AS actual, true AS adds_up
FROM consumption_rows WHERE split = 'test'"""),
    "model_run": _q(_LEARNED, f"""SELECT 'total_consumption' AS label,
  count(*) FILTER (WHERE split = 'train') AS train_rows, count(*) FILTER (WHERE split = 'test') AS test_rows,
  {len(_MODEL_FEATURES)} AS n_features, count(*) FILTER (WHERE split = 'test' AND y = 0) AS n_zero_actual,
  '{",".join(_MODEL_FEATURES)}' AS features FROM consumption_rows"""),
    "latest_model": f"""SELECT true AS named, 'total_consumption' AS label,
  {len(_MODEL_FEATURES)} AS n_features""",
    "predict_consumption": _q(SNAPSHOT, """SELECT region,
  date_trunc('day', as_of) + INTERVAL 1 DAY + INTERVAL 10 HOUR AS datetime, total_production, true AS predicted
FROM snapshot, now WHERE region = 'MA'"""),
    "predict_next_hours": _HOURS,
    "predict_next_intensity": _HOURS,
    "compare_regions": _q(SNAPSHOT, """SELECT region, true AS predicted FROM snapshot
WHERE region IN ('MA', 'FR', 'ES', 'DE')"""),
    "intensity_by_zone": _q(JOINED, """SELECT region, count(*) AS readings,
  round(avg(carbon_intensity), 4) AS avg_intensity, min(carbon_intensity) AS min_intensity,
  max(carbon_intensity) AS max_intensity
FROM joined WHERE carbon_intensity IS NOT NULL GROUP BY region"""),
    "fossil_share": _q(
        DIRECT + f""",
latest AS ({_latest("direct_mix")}),
sums AS (
  SELECT region, sum({" + ".join(f"coalesce({s}, 0.0)" for s in C.FOSSIL_SOURCES)}) AS fossil,
         sum({" + ".join(f"coalesce({s}, 0.0)" for s in C.GOLD_SOURCES)}) AS output
  FROM latest GROUP BY region
)""",
        """SELECT region, round(fossil, 4) AS fossil, round(output, 4) AS output,
  round(CASE WHEN output <> 0 THEN fossil / output END, 4) AS fossil_share FROM sums""",
    ),
    "source_corr": _q(
        GOLD,
        "SELECT region, "
        + ", ".join(
            f"""round(CASE WHEN stddev_pop({c}) * stddev_pop(total_production) <> 0
  THEN covar_pop({c}, total_production) / (stddev_pop({c}) * stddev_pop(total_production)) END, 4)
  AS corr_{c}"""
            for c in ("total_consumption", "nuclear", "gas")
        )
        + " FROM gold_mix GROUP BY region",
    ),
}
