"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the budget by its weight. A source whose share exceeds
its size times the largest number of epochs is clamped there, and the excess goes to
the others by weight, until no share is above its cap. Sorted by cap / weight, the
clamped sources are a prefix, so the end of that process is found with running sums
over the table of sources (one row each).

A target is then whole repetitions of the source plus a rest smaller than the source.
Documents are ordered by a seeded hash, and those in front take one repetition more
until the rest is used up. Where that order is cut is found from sums over 4096
ranges of the hash and then inside the one range that holds the cut, so a source with
a third of all rows is never sorted as a whole.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import WORD, store, text_or_empty

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = 17
#: Hexadecimal digits of the hash that name its range: 4096 ranges.
RANGE_DIGITS = 3


def word_count(text_col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: int, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The place of a document in the seeded order."""
    parts = [F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_or_empty(text_col)]
    return F.md5(F.encode(F.concat_ws(":", *parts), "UTF-8"))


def water_fill(sources: DataFrame, max_epochs: float, budget: float = 1.0) -> DataFrame:
    """Adds ``target`` to sources (source, source_size, weight).

    The budget is a share of all sizes. If even the caps of all sources cannot fill
    it, every source gets its cap. Sizes are whole numbers, so the sums are exact.
    """
    whole = Window.partitionBy()
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    sources = (
        sources.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("total", F.sum("source_size").over(whole) * F.lit(float(budget)))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("clamped", F.col("cap") * F.col("weight_left") <= (F.col("total") - F.col("cap_before")) * F.col("weight"))
        .withColumn("cap_sum", F.coalesce(F.sum(F.when(F.col("clamped"), F.col("cap"))).over(whole), F.lit(0.0)))
        .withColumn("weight_sum", F.sum(F.when(~F.col("clamped"), F.col("weight"))).over(whole))
    )
    level = F.col("weight") * (F.col("total") - F.col("cap_sum")) / F.col("weight_sum")
    return sources.withColumn("target", F.when(F.col("clamped"), F.col("cap")).otherwise(level)).select(
        "source", "source_size", "weight", "target"
    )


def plan_mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """A row per source: source, source_size, target, whole, last_draw.

    ``weights`` repeat over the sources in code point order, null last. Each document
    of a source is taken ``whole`` times, and once more if its draw is at most
    ``last_draw`` (empty: no document). Rows equal in id and text have the same draw
    and are taken alike.
    """
    sizes = store(
        docs.select("source", word_count().alias("size"), draw(seed).alias("draw")), "mix_sizes"
    )
    cycle = F.array(*[F.lit(w) for w in weights])
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn(
        "weight", F.element_at(cycle, F.pmod(rank - 1, F.lit(len(weights))) + 1)
    )
    # A row per source; stored, as it is used twice below.
    filled = store(
        water_fill(sources, max_epochs)
        .withColumn("whole", F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")),
        "mix_sources",
    )

    # Of each range of draws: the words before it, and before its end.
    spread = Window.partitionBy("source").orderBy("range")
    ranges = (
        sizes.groupBy("source", F.substring("draw", 1, RANGE_DIGITS).alias("range"))
        .agg(F.sum("size").alias("words"))
        .withColumn("until", F.sum("words").over(spread))
    )
    cuts = ranges.join(filled, ranges["source"].eqNullSafe(filled["source"])).where(
        "rest > 0 AND until - words <= rest AND rest < until"
    ).select(ranges["source"], "range", (F.col("until") - F.col("words")).alias("before"), "rest")

    inside = sizes.withColumn("range", F.substring("draw", 1, RANGE_DIGITS)).groupBy("source", "range", "draw").agg(
        F.sum("size").alias("words")
    ).alias("i").join(
        cuts.alias("c"),
        F.col("i.source").eqNullSafe(F.col("c.source")) & (F.col("i.range") == F.col("c.range")),
    ).select("i.source", "draw", "words", "before", "rest", "i.range")
    by_draw = Window.partitionBy("source").orderBy("draw").rowsBetween(Window.unboundedPreceding, 0)
    # A draw is taken if at least half of its words fit; that is monotone in the order.
    last = (
        inside.withColumn("end", F.col("before") + F.sum("words").over(by_draw))
        .groupBy("source")
        .agg(F.coalesce(
            F.max(F.when(2 * F.col("end") - F.col("words") <= 2 * F.col("rest"), F.col("draw"))),
            F.max("range"),  # none inside: all draws of the ranges before are below it
        ).alias("last_draw"))
    )
    return filled.join(last, filled["source"].eqNullSafe(last["source"]), "left").select(
        filled["source"], "source_size", "target", "whole", F.coalesce("last_draw", F.lit("")).alias("last_draw")
    )


def _planned(docs: DataFrame, seed: int, plan: dict) -> DataFrame:
    """Each row as one column ``row``, so that no name of the input meets one of ours."""
    # Small, and planned once; its rows are those of the sources, the join moves no text
    # as long as the table of sources can be broadcast by its measured size.
    sources = store(plan_mix(docs, seed=seed, **plan), "mix_plan").withColumnRenamed("source", "planned_source")
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["source"].alias("own_source"),
        draw(seed).alias("own_draw"), word_count().alias("mix_size"),
    )
    planned = rows.join(sources, F.col("own_source").eqNullSafe(F.col("planned_source")))
    more = (F.col("own_draw") <= F.col("last_draw")).cast("long")
    return planned.withColumn("mix_copies", F.col("whole") + more)


def mix(docs: DataFrame, seed: int = SEED, **plan) -> DataFrame:
    """The documents with ``mix_copies``, ``mix_size``, ``source_size`` and ``target``.

    A null text has size 0 and a null source is a source of its own, the last. Rows
    repeated with id and text are taken equally often. A very long text is one document
    like any other. Columns of the input by the four names are replaced. An empty table
    gives no rows.
    """
    added = ["mix_copies", "mix_size", "source_size", "target"]
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in added]
    return _planned(docs, seed, plan).select(*kept, *added)


def repeated(docs: DataFrame, seed: int = SEED, **plan) -> DataFrame:
    """The rows, all their columns as they were, as often as the mix takes them; those it
    does not take go. Nulls, ties and empty tables as in ``mix``."""
    taken = _planned(docs, seed, plan).where("mix_copies > 0").select(
        "row", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))
    )
    return taken.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
