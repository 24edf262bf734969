"""Audit of how document filters interact, over every order in which they may run.

Each filter says whether a document fails it. The truth table of filter i is a 32-bit
word whose bit S says whether the subset S of the filters holds i; a document's word of
survival is the AND of the inverted tables of the filters it fails: bit S is set if the
document survives all filters of S. Carry-save adders add up the words of a part position
by position, which gives for each of the 32 subsets how many documents survive it, in all
and among those with a label. Whatever an order of the filters removes at a step is a
difference of two such counts, so all orders come from 32 numbers a part and label.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import WORD, store, text_or_empty

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
ALL = SUBSETS - 1
ORDERS = ["".join(order) for order in permutations(FILTERS)]


@dataclass(frozen=True)
class Settings:
    #: A: fewer words fail.
    least_words: int = 200
    #: B: a smaller percentage of distinct words fails.
    distinct_percent: int = 50
    #: C: a larger percentage of capitals fails.
    capital_percent: int = 2
    #: D: a text with one of these fails.
    marks: str = r"[#$%&*|]"


def truth_table(i: int) -> int:
    """Bit S is set if subset S holds filter i."""
    return sum(1 << s for s in range(SUBSETS) if s >> i & 1)


def signed(word: int) -> int:
    return word - (1 << 32) if word >> 31 else word


def survival_word(fails: list[Column]) -> Column:
    """32-bit word with a bit for each subset of the filters that the row survives."""
    word = F.lit(-1)
    for i, failing in enumerate(fails):
        survives = signed(~truth_table(i) & 0xFFFFFFFF)
        word = word.bitwiseAND(F.when(failing, F.lit(survives)).otherwise(F.lit(-1)))
    return word


def positional_popcount(words: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """For each of 32 bits, how many of the words have it, each counted ``copies`` times.

    Three words of one weight make one word of this weight and one carry of twice the
    weight; a word that counts several times enters at the weights of its number's bits.
    """
    counts = np.zeros(32, dtype=np.int64)
    carried = [np.zeros(0, np.uint32)]
    places = np.arange(32, dtype=np.uint32)
    level, highest = 0, int(copies.max(initial=0)).bit_length()
    while level < highest or any(len(c) for c in carried):
        plane = np.concatenate([*carried, words[(copies >> level & 1).astype(bool)]])
        carried = []
        while len(plane) > 2:
            third = len(plane) // 3
            a, b, c = plane[:third], plane[third : 2 * third], plane[2 * third : 3 * third]
            either = a ^ b
            carried.append((a & b) | (either & c))
            plane = np.concatenate([either ^ c, plane[3 * third :]])
        counts += ((plane[:, None] >> places) & np.uint32(1)).sum(axis=0, dtype=np.int64) << level
        level += 1
    return counts


LABELS = ("any", "good", "toxic")


def _popcounts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch, part and label the survivors of each subset."""
    for batch in batches:
        column = batch.column("part").dictionary_encode()
        codes, names = column.indices.to_numpy(zero_copy_only=False), column.dictionary
        order = np.argsort(codes, kind="stable")
        edges = np.flatnonzero(np.diff(codes[order], prepend=-1, append=-1))
        words = batch.column("word").to_numpy(zero_copy_only=False).view(np.uint32)
        copies = batch.column("copies").to_numpy(zero_copy_only=False)
        marked = [batch.column(label).to_numpy(zero_copy_only=False) for label in LABELS[1:]]
        parts, labels, counts = [], [], []
        for low, high in zip(edges[:-1], edges[1:]):
            rows = order[low:high]
            for label, mark in zip(LABELS, [None, *marked]):
                chosen = rows if mark is None else rows[mark[rows]]
                if len(chosen):
                    parts.append(codes[rows[0]]), labels.append(label)
                    counts.append(positional_popcount(words[chosen], copies[chosen]))
        flat = np.concatenate([np.zeros(0, np.int64), *counts])
        yield pa.RecordBatch.from_arrays(
            [
                names.take(pa.array(parts, pa.int64())), pa.array(labels, pa.string()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1) * 32, pa.int32()), pa.array(flat)),
            ],
            names=["part", "label", "survivors"],
        )


def _at(survivors: Column, subset: Column | int) -> Column:
    return F.get(survivors, subset if isinstance(subset, Column) else F.lit(subset))


def _shapley(survivors: Column, i: int) -> Column:
    """What filter i removes, over all orders: each subset of the others stands before it
    in as many orders as it and the rest can be arranged."""
    times = [0] * SUBSETS
    for subset in range(SUBSETS):
        if not subset >> i & 1:
            before = subset.bit_count()
            orders = factorial(before) * factorial(len(FILTERS) - 1 - before)
            times[subset] += orders
            times[subset | 1 << i] -= orders
    weighted = F.zip_with(survivors, F.lit(times), lambda n, weight: n * weight)
    return F.aggregate(weighted, F.lit(0).cast("long"), lambda total, n: total + n)


def subset_survivors(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
    text_col: str = "text", part_col: str = "source",
) -> DataFrame:
    """One row per part: part, and arrays any, good, toxic of 32 counts, place S for
    the documents that survive the filters of subset S (bit 0 is A).

    The texts are read once and become digests and flags; equal rows are combined before
    they move. A text's first id comes from a grouping by digest, and only the rows that
    are first meet it again, by digest and id: neither a large group of copies nor a
    large part sends its rows to one task.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text_or_empty(text_col).alias("text"),
    ).withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    n_words = F.size("words")
    capitals = F.length("text") - F.length(F.regexp_replace("text", "[A-Z]+", ""))
    rows = rows.select(
        "doc_id", "part",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        (n_words < settings.least_words).alias("a"),
        (100 * F.size(F.array_distinct("words")).cast("long") < settings.distinct_percent * n_words.cast("long")).alias("b"),
        (100 * capitals.cast("long") > settings.capital_percent * F.length("text").cast("long")).alias("c"),
        F.col("text").rlike(settings.marks).alias("d"),
    )
    rows = store(
        rows.groupBy("doc_id", "part", "digest", "a", "b", "c", "d").agg(F.count("*").alias("copies")), "audit_rows"
    )
    # Rows without an id come after all with one. min() of the ids leaves nulls out.
    firsts = rows.groupBy(F.col("digest").alias("first_digest")).agg(F.min("doc_id").alias("first_id"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    first = (F.col("digest") == F.col("first_digest")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    # Rows without an id are dealt by digest and meet no label.
    by_id = F.coalesce("doc_id", F.xxhash64("digest"))
    words = (
        rows.join(firsts, first, "left").withColumn("e", F.col("first_digest").isNull())
        .withColumn("key", by_id)
        .join(marks, (F.col("key") == F.col("labelled")) & F.col("doc_id").isNotNull(), "left")
        .select(
            "part", "copies",
            survival_word([F.col(f.lower()) for f in FILTERS]).alias("word"),
            *[F.coalesce(label, F.lit(False)).alias(label) for label in LABELS[1:]],
        )
    )
    counted = words.mapInArrow(_popcounts, "part string, label string, survivors array<bigint>")
    sums = counted.groupBy("part", "label").agg(
        F.array(*[F.sum(_at(F.col("survivors"), s)) for s in range(SUBSETS)]).alias("survivors")
    )
    none = F.array_repeat(F.lit(0).cast("long"), SUBSETS)
    return sums.groupBy("part").agg(
        *[F.coalesce(F.max(F.when(F.col("label") == label, F.col("survivors"))), none).alias(label) for label in LABELS]
    )


def audit_filters(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
    text_col: str = "text", part_col: str = "source",
) -> DataFrame:
    """One row per part, order of the filters and step: part, filter_order, step, kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Filters: A too few words, B too few distinct words, C too many capitals, D special
    marks, E the same text at a smaller id. A null text counts as empty and is looked at
    like any other, a null part as the empty string. A row without an id fails E if a row
    with an id has its text. Rows repeated with one id count each, and none of them is a
    copy of another. A document has a label if any of its label rows is 1; labels without
    an id are left out. A text is held as the list of its words while it is looked at.
    Other columns of the input are not looked at. An empty table gives no rows.
    """
    survivors = subset_survivors(docs, labels, settings, id_col, text_col, part_col)
    rows = survivors.withColumn("shapleys", F.array(*[_shapley(F.col("any"), i) for i in range(len(FILTERS))]))
    rows = rows.withColumn("filter_order", F.explode(F.split(F.lit(",".join(ORDERS)), ","))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))
    )
    place = [F.instr("filter_order", f) for f in FILTERS]
    rows = rows.select(
        "*",
        sum((F.when(place[i] < F.col("step"), 1 << i).otherwise(0) for i in range(len(FILTERS))), F.lit(0)).alias("before"),
        (F.ascii(F.col("filter_order").substr(F.col("step"), F.lit(1))) - ord(FILTERS[0])).alias("i"),
    ).withColumn("bit", F.get(F.lit([1 << i for i in range(len(FILTERS))]), F.col("i")))

    def lost(label: str) -> Column:
        return _at(F.col(label), F.col("before")) - _at(F.col(label), F.col("before") + F.col("bit"))

    fails = _at(F.col("any"), 0) - _at(F.col("any"), F.col("bit"))
    return rows.select(
        "part", "filter_order", "step",
        _at(F.col("any"), F.col("before") + F.col("bit")).alias("kept"),
        lost("any").alias("removed"),
        (fails - lost("any")).alias("redundant"),
        (_at(F.col("any"), F.lit(ALL) - F.col("bit")) - _at(F.col("any"), ALL)).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        _at(F.col("shapleys"), F.col("i")).alias("shapley"),
    )
