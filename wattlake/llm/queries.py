"""The corpus operators applied to whole tables, under the column contracts."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import (
    content_sort,
    decontamination,
    filter_audit,
    licenses,
    mixing,
    neardup,
    phrases,
    quality,
    secrets,
    sharding,
    spelling,
    substrings,
    toxicity,
)
from wattlake.llm.common import read_table

SHARDS = 40
#: Score from which a label is predicted.
PREDICTED = 0.7


def _with_prediction(scored: DataFrame) -> DataFrame:
    return scored.withColumn("predicted", (F.col("score") >= PREDICTED).cast("int"))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        "source_size",
        "target",
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_passages(read_table(spark, sf_dir, "documents"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_prediction(
        toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    )


def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained_items(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_prediction(
        quality.score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    )


def op7_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = sharding.byte_shards(read_table(spark, sf_dir, "documents"), SHARDS)
    return cut.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read_table(spark, sf_dir, "documents"))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(F.encode(listed(F.filter("spans", lambda s: s["kind"] != "literal")), "UTF-8"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents")).drop("spans")


def op10_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.exact_copies(read_table(spark, sf_dir, "documents"))


def op11_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.fingerprints(read_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_repeated_passages": op2_repeated_passages,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_toxicity": op4_toxicity,
    "op5_benchmark_leaks": op5_benchmark_leaks,
    "op6_quality": op6_quality,
    "op7_byte_shards": op7_byte_shards,
    "op8_secrets": op8_secrets,
    "op9_licenses": op9_licenses,
    "op10_content_sort": op10_content_sort,
    "op11_phrase_fingerprints": op11_phrase_fingerprints,
    "op12_filter_audit": op12_filter_audit,
    "op13_spelling_variants": op13_spelling_variants,
}
