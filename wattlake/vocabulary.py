"""Column names, message schemas and fixed lists shared by every job."""

from pyspark.sql import types as T

# --- fixed values: names and lists the data contract prescribes -------------

TOPIC_MIX = "mix_energie"
TOPIC_CARBON = "carbone_energie"

ZONES = ["MA", "FR", "ES", "DE", "IT", "PT", "GB", "CA-ON", "SE", "NO"]

SILVER_SOURCES = ["nuclear", "wind", "solar", "hydro", "gas", "coal", "biomass"]
GOLD_SOURCES = SILVER_SOURCES + ["geothermal", "oil"]
FOSSIL_SOURCES = ["coal", "gas", "oil"]

WEEKEND_DAYS = [5, 6]  # Monday is 0
SUNDAY_FIRST_WEEKEND_DAYS = [1, 7]  # Sunday is 1
PEAK_HOURS = [8, 9, 10, 18, 19, 20]

UNKNOWN_EMISSION_FACTOR = "unknown"
UNKNOWN_DISPLAY_REGION = "Inconnu"
DEFAULT_ESTIMATION_METHOD = "real_time"
SYNC_INGESTION_ID = "postgres-sync"
RETENTION_DAYS = 365

DISPLAY_SOURCES = {
    "nuclear": "nucleaire",
    "coal": "charbon",
    "gas": "gaz",
    "wind": "eolien",
    "solar": "solaire",
    "hydro": "hydraulique",
}

# feature order of the consumption model
FEATURES = [
    "region_encoded", "hour", "day_of_week", "month", "day",
    "is_weekend", "is_peak_hour",
    "nuclear", "wind", "solar", "hydro", "gas", "coal",
    "biomass", "geothermal", "oil",
    "total_production", "total_import", "total_export",
    "fossil_free_percentage", "renewable_percentage",
    "carbon_intensity",
    "renewable_ratio", "fossil_ratio", "production_consumption_ratio",
]
# the smaller variant of the same job
SHORT_FEATURES = [
    "region", "hour", "day_of_week", "month", "is_weekend",
    "nuclear", "wind", "solar", "hydro", "gas", "coal",
    "biomass", "geothermal", "oil",
    "total_production",
    "fossil_free_percentage", "renewable_percentage",
    "carbon_intensity",
]
CONSUMPTION_LABEL = "total_consumption"
CARBON_LABEL = "carbon_intensity"
# features computed from the label itself: they leak it into the model
LEAKS = {CONSUMPTION_LABEL: ["production_consumption_ratio"], CARBON_LABEL: ["carbon_intensity"]}

# --- message totals: JSON name -> silver name -> gold name -------------------

TOTALS = [
    ("powerProductionTotal", "production_total", "total_production"),
    ("powerConsumptionTotal", "consumption_total", "total_consumption"),
    ("powerImportTotal", "import_total", "total_import"),
    ("powerExportTotal", "export_total", "total_export"),
]
PERCENTAGES = [
    ("renewablePercentage", "renewable_percentage"),
    ("fossilFreePercentage", "fossil_free_percentage"),
]

# where a row came from; breaks ties between rows that arrived at one instant
ARRIVAL = ["arrival_partition", "arrival_offset"]
KEY = ["region", "timestamp"]

# 19 and 8 columns of the two gold tables, arrival columns left aside
GOLD_MIX_COLUMNS = (
    KEY + GOLD_SOURCES
    + ["total_consumption", "total_production", "total_import", "total_export",
       "fossil_free_percentage", "renewable_percentage", "ingestion_timestamp", "ingestion_id"]
)
GOLD_CARBON_COLUMNS = KEY + [
    "carbon_intensity", "emission_factor_type", "is_estimated", "estimation_method",
    "ingestion_timestamp", "ingestion_id",
]
SILVER_MIX_COLUMNS = (
    ["zone", "datetime", "production_total", "consumption_total"] + SILVER_SOURCES
    + ["renewable_percentage", "fossil_free_percentage", "processing_time"]
)
SILVER_MIX_EXTRAS = ["geothermal", "oil", "import_total", "export_total"]
SILVER_CARBON_COLUMNS = [
    "zone", "datetime", "carbon_intensity", "emission_factor_type", "processing_time",
]
SILVER_CARBON_EXTRAS = ["is_estimated", "estimation_method"]


# --- schemas -----------------------------------------------------------------

def _struct(names, data_type):
    return T.StructType([T.StructField(n, data_type) for n in names])


# a Kafka record as Spark's source delivers it; the file twin has the same columns
EVENT = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

CORRUPT = "_corrupt_record"


def mix_numbers(breakdown, kind):
    """The measured fields of a mix message, all of one type."""
    flat = [json_name for json_name, _, _ in TOTALS] + [json_name for json_name, _ in PERCENTAGES]
    return T.StructType(
        [T.StructField(breakdown, _struct(GOLD_SOURCES, kind))]
        + [T.StructField(name, kind) for name in flat]
    )


def carbon_measures(number, flag):
    return T.StructType([
        T.StructField("carbonIntensity", number), T.StructField("isEstimated", flag),
    ])


def message(measures, texts):
    """Measured fields, text fields, and the place for a text that does not fit."""
    return T.StructType(
        measures.fields + _struct([*texts, CORRUPT], T.StringType()).fields
    )


MIX_TEXTS = ["zone", "datetime"]
CARBON_TEXTS = ["zone", "datetime", "emissionFactorType", "estimationMethod"]
BREAKDOWNS = {
    "production": "powerProductionBreakdown", "consumption": "powerConsumptionBreakdown",
}

DISPLAY_MESSAGE = T.StructType([
    T.StructField("zone", T.StringType()),
    T.StructField("datetime", T.StringType()),
    T.StructField("powerProductionBreakdown", _struct(list(DISPLAY_SOURCES), T.DoubleType())),
])
