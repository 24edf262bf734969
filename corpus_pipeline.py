"""The corpus pipeline: five stages over ``documents``.

Each stage is a function (spark, docs, sf_dir) -> DataFrame, works on all that the one
before kept, and is written as Parquet before the next reads it. All but the last give
the columns of ``documents``; the last gives the shard and slot of each kept document,
one row for each repetition that the mix takes.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import decontamination, mixing, neardup, quality, sharding
from wattlake.llm.common import read_table, store

SHARDS = 40
#: Documents that score below this are rejected; an empty text scores exactly this.
LEAST_QUALITY = 0.5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the quality classifier does not reject. Nothing is shuffled."""
    score = quality.scorer(docs, read_table(spark, sf_dir, "labels"))
    return docs.where(score(F.col("text")) >= LEAST_QUALITY)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id.

    A group without ids keeps the one with the smallest hash of its text. Documents
    without words are groups of their own. Rows repeated with id and text count as one
    document.
    """
    kept = neardup.kept_texts(docs).select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    same = docs["doc_id"].eqNullSafe(kept["kept_id"]) & (F.xxhash64(docs["text"]) == kept["kept_hash"])
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Nothing is shuffled."""
    return decontamination.without_items(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; a null source is one of its own.

    All columns stay as they were, whatever their names.
    """
    return mixing.repeated(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot."""
    return sharding.byte_shards(docs, SHARDS)


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("mixing sources", mix_sources),
    ("sharding", shard),
]

#: A learned classifier decides in the first stage: SQL cannot give these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = store(stage(spark, docs, sf_dir), f"stage_{number}")
    return docs
