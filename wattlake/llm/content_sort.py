"""Exact dedup by sorting contents.

Sampled splitters range-partition the rows by their normalised bytes, an external
sort inside each partition places equal contents next to each other, and every row
is compared in full with its neighbour. The row with the smallest id stays.

The range key is (leading bytes, 64-bit hash of all bytes, piece): it follows the
order of the bytes, and a sample of it has a bounded size however long the texts
are. The sort and the comparison use the whole content. Groups of copies with more
rows than a quarter of an even partition are cut into pieces first, so that no group
needs one task; the heads of the pieces are compared in full in a second, small step.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import SPACE, partitions, store, text_or_empty

LEAD_BYTES = 64
#: A group of copies above 1/PIECES of an even partition is cut.
PIECES = 4


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of white space became one space; a
    null text counts as empty. Rows without an id sort last: such a row stays only if
    no copy has an id, and keep_id is null then. Of repeated rows with one id, one
    stays. Other columns of the input are not looked at. An empty table gives no rows.
    """
    n = partitions(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.regexp_replace(text_or_empty(text_col), SPACE, " ").alias("content"),
    ).withColumn("digest", F.xxhash64("content"))

    largest = max(1, docs.count() // (PIECES * n))
    # At most PIECES * n + n groups can be larger, whatever the corpus: small enough to broadcast.
    large = store(
        rows.groupBy("digest").agg(F.count("*").alias("copies"))
        .where(F.col("copies") > largest)
        .select("digest", F.ceil(F.col("copies") / largest).cast("int").alias("pieces")),
        "large_groups",
    )
    key = ["lead", "digest", "piece"]
    placed = (
        rows.join(F.broadcast(large), "digest", "left")
        .withColumn("lead", F.substring(F.encode("content", "UTF-8"), 1, LEAD_BYTES))
        .withColumn("piece", F.coalesce(F.expr("pmod(monotonically_increasing_id(), pieces)"), F.lit(-1)))
        .repartitionByRange(n, *key)
    )
    # The range partitioning already holds equal keys together: no further exchange.
    sorted_rows = Window.partitionBy(*key).orderBy("content", F.col("doc_id").asc_nulls_last())
    neighbour = F.lag("content").over(sorted_rows)
    runs = (
        placed.withColumn("fresh", ~F.col("content").eqNullSafe(neighbour))
        .withColumn("run", F.sum(F.col("fresh").cast("int")).over(sorted_rows))
        .select(
            "doc_id", *key, "run", "fresh",
            F.sha2("content", 256).alias("text_sha256"),
            F.when(F.col("fresh") & F.col("pieces").isNotNull(), F.col("content")).alias("head"),
        )
    )
    one_run = Window.partitionBy(*key, "run")
    runs = store(
        runs.withColumn("first_id", F.min("doc_id").over(one_run))
        .withColumn("in_run", F.count("*").over(one_run)).drop("lead"),
        "content_runs",
    )

    same = Window.partitionBy("digest", "head")
    first = Window.partitionBy("digest", "head").orderBy(F.col("doc_id").asc_nulls_last(), "piece")
    heads = runs.where("head IS NOT NULL").select(
        "digest", "piece", "run",
        F.min("doc_id").over(same).alias("keep_all"),
        F.sum("in_run").over(same).alias("size_all"),
        (F.row_number().over(first) == 1).alias("keeps"),
    )
    return runs.drop("head").join(heads, ["digest", "piece", "run"], "left").select(
        "doc_id",
        F.coalesce("keep_all", "first_id").alias("keep_id"),
        F.coalesce("size_all", "in_run").alias("group_size"),
        (F.col("fresh") & F.coalesce("keeps", F.lit(True))).alias("kept"),
        "text_sha256",
    )
