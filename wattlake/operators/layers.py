"""Silver and gold row shapes."""

from pyspark.sql import DataFrame, functions as F

from wattlake import vocabulary as V
from wattlake.functions.identity import stable_id


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Null to default, for the columns that exist."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if c in df.columns}
    )


def _zeros(columns: list[str]) -> dict[str, object]:
    return {c: 0.0 for c in columns}


def _has_zone():
    return F.col("zone").isNotNull() & (F.col("zone") != "")


def silver_mix(parsed: DataFrame, extras: bool = False) -> DataFrame:
    """Every arrival with a zone and a production total; sources and shares
    default to 0, totals stay null. ``extras`` keeps the fields that the fourteen
    classic columns lack."""
    more = V.SILVER_MIX_EXTRAS if extras else []
    kept = parsed.filter(_has_zone() & F.col("production_total").isNotNull())
    zeros = V.GOLD_SOURCES + [name for _, name in V.PERCENTAGES]
    return fill_defaults(kept, _zeros(zeros)).select(*V.SILVER_MIX_COLUMNS, *more, *V.ARRIVAL)


def silver_carbon(parsed: DataFrame, extras: bool = False) -> DataFrame:
    more = V.SILVER_CARBON_EXTRAS if extras else []
    return parsed.filter(
        _has_zone() & F.col("carbon_intensity").isNotNull()
    ).select(*V.SILVER_CARBON_COLUMNS, *more, *V.ARRIVAL)


def _or_constant(df: DataFrame, column: str, constant):
    """The column with the constant for its nulls, or the constant if it is not there."""
    value = F.lit(constant)
    return F.coalesce(F.col(column), value) if column in df.columns else value


def to_gold_mix(silver: DataFrame) -> DataFrame:
    """Silver arrivals in gold vocabulary; what silver lacks becomes 0."""
    return silver.select(
        F.col("zone").alias("region"),
        F.col("datetime").alias("timestamp"),
        *[_or_constant(silver, s, 0.0).alias(s) for s in V.GOLD_SOURCES],
        *[_or_constant(silver, s, 0.0).alias(gold) for _, s, gold in V.TOTALS],
        *[_or_constant(silver, name, 0.0).alias(name) for _, name in V.PERCENTAGES],
        F.col("processing_time").alias("ingestion_timestamp"),
        F.lit(V.SYNC_INGESTION_ID).alias("ingestion_id"),
        *_arrival(silver),
    ).select(*V.GOLD_MIX_COLUMNS, *V.ARRIVAL)


def to_gold_carbon(silver: DataFrame) -> DataFrame:
    return silver.select(
        F.col("zone").alias("region"),
        F.col("datetime").alias("timestamp"),
        _or_constant(silver, "carbon_intensity", 0.0).alias("carbon_intensity"),
        _or_constant(silver, "emission_factor_type", V.UNKNOWN_EMISSION_FACTOR).alias(
            "emission_factor_type"
        ),
        _or_constant(silver, "is_estimated", False).alias("is_estimated"),
        _or_constant(silver, "estimation_method", V.DEFAULT_ESTIMATION_METHOD).alias(
            "estimation_method"
        ),
        F.col("processing_time").alias("ingestion_timestamp"),
        F.lit(V.SYNC_INGESTION_ID).alias("ingestion_id"),
        *_arrival(silver),
    )


def _arrival(silver: DataFrame) -> list:
    """Partition and offset. A silver table in a database may lack them: a hash of
    the row then decides between rows of one instant, the same way at each replay."""
    if set(V.ARRIVAL) <= set(silver.columns):
        return [F.col(c) for c in V.ARRIVAL]
    partition, offset = V.ARRIVAL
    return [F.lit(0).alias(partition), F.xxhash64(*silver.columns).alias(offset)]


def direct_gold_mix(parsed: DataFrame) -> DataFrame:
    """Parsed events straight to gold rows: nulls stay null, every row gets an id."""
    renamed = {silver: gold for _, silver, gold in V.TOTALS}
    return (
        parsed.withColumnsRenamed(
            {"zone": "region", "datetime": "timestamp", "processing_time": "ingestion_timestamp",
             **renamed}
        )
        .withColumn("ingestion_id", _arrival_id())
        .select(*V.GOLD_MIX_COLUMNS, *V.ARRIVAL)
    )


def direct_gold_carbon(parsed: DataFrame) -> DataFrame:
    return (
        parsed.withColumnsRenamed(
            {"zone": "region", "datetime": "timestamp", "processing_time": "ingestion_timestamp"}
        )
        .withColumn("ingestion_id", _arrival_id())
        .select(*V.GOLD_CARBON_COLUMNS, *V.ARRIVAL)
    )


def _arrival_id():
    return stable_id(F.col("topic"), *[F.col(c) for c in V.ARRIVAL])


def has_key(rows: DataFrame) -> DataFrame:
    """Rows that gold can hold: region and event time are its key."""
    return rows.filter(
        F.col("region").isNotNull() & (F.col("region") != "") & F.col("timestamp").isNotNull()
    )
