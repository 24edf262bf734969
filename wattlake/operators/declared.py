"""Intensity per zone, fossil share, correlations."""

from pyspark.sql import DataFrame, functions as F

from wattlake.functions.ratios import all_output, fossil_output


def intensity_by_zone(joined: DataFrame) -> DataFrame:
    return joined.filter(F.col("carbon_intensity").isNotNull()).groupBy("region").agg(
        F.count("*").alias("readings"),
        F.avg("carbon_intensity").alias("avg_intensity"),
        F.min("carbon_intensity").alias("min_intensity"),
        F.max("carbon_intensity").alias("max_intensity"),
    )


def fossil_share(mix: DataFrame) -> DataFrame:
    """Coal, gas and oil in the whole output of a region, largest share first."""
    return (
        mix.groupBy("region")
        .agg(F.sum(fossil_output()).alias("fossil"), F.sum(all_output()).alias("output"))
        .withColumn("fossil_share", F.try_divide("fossil", "output"))
        .orderBy(F.desc("fossil_share"), "region")
    )


def source_corr(mix: DataFrame, against: str, columns: list[str]) -> DataFrame:
    """Correlation of each column with ``against`` per region, e.g. of installed
    capacity with output where a table has both; null for a constant column."""
    def spread(c):
        return F.stddev_pop(c)

    return mix.groupBy("region").agg(*[
        F.try_divide(F.covar_pop(c, against), spread(c) * spread(against)).alias(f"corr_{c}")
        for c in columns
    ])
