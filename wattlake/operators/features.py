"""Mix with carbon, calendar and ratio features, training rows."""

from pyspark.sql import DataFrame, Window, functions as F

from wattlake import vocabulary as V
from wattlake.functions.calendar import calendar_fields, sunday_first_fields
from wattlake.functions.ratios import ratio_fields
from wattlake.operators.layers import fill_defaults
from wattlake.operators.latest import latest_by_region


#: regions whose codes are sent to every task, about 2 MB
SENT_CODES = 50_000


def mix_with_carbon(mix: DataFrame, carbon: DataFrame) -> DataFrame:
    """Every mix row with the carbon reading of its region and time, if any."""
    right = carbon.select(*V.KEY, "carbon_intensity", "is_estimated")
    return mix.join(right, V.KEY, "left")


def features(joined: DataFrame) -> DataFrame:
    return joined.withColumns(calendar_fields(F.col("timestamp"))).withColumns(ratio_fields())


def short_features(joined: DataFrame) -> DataFrame:
    """The smaller variant: Sunday-first days, rows with a label, no ratios."""
    return (
        joined.withColumns(sunday_first_fields(F.col("timestamp")))
        .dropna(subset=[V.CONSUMPTION_LABEL])
        .select(*V.SHORT_FEATURES, V.CONSUMPTION_LABEL)
    )


def encode_region(df: DataFrame) -> DataFrame:
    """Position of the region among all regions in sorted order, from 0.

    The window runs over one row per region. Up to ``SENT_CODES`` regions the codes
    are sent to the rows, which then stay where they are; beyond that they are
    joined, with the same result. A row without region has no code.
    """
    codes = df.select("region").filter("region IS NOT NULL").distinct().withColumn(
        "region_encoded", F.dense_rank().over(Window.orderBy("region")) - 1
    )
    few = codes.limit(SENT_CODES + 1).collect()
    if len(few) <= SENT_CODES:
        codes = F.broadcast(df.sparkSession.createDataFrame(few, codes.schema))
    return df.join(codes, "region", "left")


def available(df: DataFrame, wanted: list[str]) -> tuple[list[str], list[str]]:
    """The wanted columns that are there, and those that are missing."""
    have = set(df.columns)
    return [c for c in wanted if c in have], [c for c in wanted if c not in have]


def model_columns(label: str = V.CONSUMPTION_LABEL, leaky: bool = False) -> list[str]:
    """Feature names for a label; ``leaky`` keeps those computed from the label."""
    hidden = [] if leaky else V.LEAKS.get(label, [])
    return [c for c in V.FEATURES if c not in hidden and c != label]


def clean_rows(featured: DataFrame, label: str = V.CONSUMPTION_LABEL) -> DataFrame:
    """Rows usable for training: label and key present, numeric features zero-filled."""
    numeric = [c for c in V.FEATURES if c in featured.columns and c not in ("region_encoded", label)]
    return featured.dropna(subset=[label, *V.KEY]).fillna(0, subset=numeric)


def training_set(
    featured: DataFrame, label: str = V.CONSUMPTION_LABEL, leaky: bool = False
) -> DataFrame:
    """Key, encoded region, features in model order, label."""
    encoded = encode_region(clean_rows(featured, label))
    present, _ = available(encoded, model_columns(label, leaky))
    return encoded.select(*V.KEY, *present, label)


def latest_snapshot(mix: DataFrame, carbon: DataFrame) -> DataFrame:
    """Last known state per region; regions without a mix row are absent, every
    missing number is 0."""
    newest_mix = latest_by_region(mix.select(*V.GOLD_MIX_COLUMNS)).drop("ingestion_id")
    newest_carbon = latest_by_region(carbon.select(*V.KEY, "carbon_intensity")).drop("timestamp")
    joined = newest_mix.join(newest_carbon, "region", "left")
    numeric = [
        c for c in joined.columns if c not in ("region", "timestamp", "ingestion_timestamp")
    ]
    return fill_defaults(joined, {c: 0.0 for c in numeric}).withColumns(ratio_fields())


def forecast_grid(snapshot: DataFrame, start, hours: int) -> DataFrame:
    """Every snapshot row at ``start``, ``start`` + 1 h, ...: ``hours`` rows each,
    with the calendar fields of that time."""
    first = F.lit(start)
    steps = F.sequence(
        first, first + F.make_interval(hours=F.lit(hours - 1)), F.expr("INTERVAL 1 HOUR")
    )
    return (
        snapshot.withColumnRenamed("timestamp", "state_time")
        .withColumn("datetime", F.explode(steps))
        .withColumns(calendar_fields(F.col("datetime")))
    )
