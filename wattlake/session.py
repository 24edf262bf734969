"""Session settings the jobs rely on."""

from pyspark.sql import SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are UTC instants; calendar fields must be taken in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build_session(app_name: str, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    for key, value in settings.items():
        builder = builder.config(key, value)
    return use_utc(builder.getOrCreate())
