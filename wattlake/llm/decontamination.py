"""Benchmark items inside documents: size-partitioned MinHash containment search.

The similarity of a short item and a long document is tiny even if the document holds
the whole item, so sizes are partitioned. Items fall into classes of 1, 2, 4, 8, ...
shingles, and for each class the shingles of the documents are read in windows of twice
that size, half a window apart: an item lies in one window as a whole and makes up at
least a quarter of it. A window and an item of its class are candidates if they agree
in at least one of ``hashes`` minima. With 48 of them an item of which 75% of the
shingles are there is missed with probability 1e-4, a whole one with 1e-6. Minima of
large windows come from those of small ones, so each shingle is hashed 48 times however
many classes there are. Candidates are verified by exact containment in the document.

Documents are neither shuffled nor paired. Items are sent to the tasks in passes of
bounded size; a larger benchmark makes more passes.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import store
from wattlake.llm.neardup import multipliers
from wattlake.llm.words import chunks, grams, shingle_set

_FILTER_BITS = 20
_NONE = np.uint64(2**64 - 1)


@dataclass(frozen=True)
class Settings:
    shingle_words: int = 5
    #: Smallest share of an item's shingles, in hundredths.
    percent: int = 75
    hashes: int = 48
    #: Shingles of the items of one pass, with the minima of each item and whose they are;
    #: 8 bytes each.
    pass_shingles: int = 2_000_000


class ItemIndex:
    """Minima of the items by size class."""

    def __init__(self, ids: list[int], lengths: list[int], sets: list[np.ndarray], settings: Settings):
        self.ids, self.sets, self.settings = ids, sets, settings
        #: Items shorter than a shingle, by their number of words: hashes and items.
        self.short: list[tuple[int, np.ndarray, np.ndarray]] = []
        counted = np.array(lengths, dtype=np.int64)
        for n in range(1, settings.shingle_words):
            members = np.flatnonzero(counted == n)
            if len(members):
                self.short.append((n, np.array([sets[i][0] for i in members], dtype=np.uint64), members))
        factors = multipliers(settings.hashes)
        self.classes: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        sizes = np.where(counted < settings.shingle_words, 0, [len(s) for s in sets])
        for size in sorted({1 << (int(n) - 1).bit_length() for n in sizes if n}):
            members = np.flatnonzero((2 * sizes > size) & (sizes <= size))
            minima = np.array([[(sets[i] * f).min() for f in factors] for i in members], dtype=np.uint64)
            flat = minima.reshape(-1)
            order = np.argsort(flat, kind="stable")
            known = np.zeros(1 << _FILTER_BITS, dtype=bool)
            known[flat & np.uint64((1 << _FILTER_BITS) - 1)] = True
            owners = np.repeat(members, settings.hashes)[order]
            self.classes.append((size, flat[order], owners, known))

    def candidates(self, shingles: np.ndarray) -> set[tuple[int, int, int]]:
        """(first shingle, end, item) of windows that agree with an item in a minimum."""
        found: set[tuple[int, int, int]] = set()
        if not self.classes or not len(shingles):
            return found
        largest = self.classes[-1][0]
        padded = np.full(-(-len(shingles) // largest) * largest, _NONE, dtype=np.uint64)
        for factor in multipliers(self.settings.hashes):
            np.multiply(shingles, factor, out=padded[: len(shingles)])
            blocks, width = padded, 1
            for size, values, owners, known in self.classes:
                while width < size:
                    blocks = np.minimum(blocks[0::2], blocks[1::2])
                    width *= 2
                windows = np.minimum(blocks, np.append(blocks[1:], _NONE))
                maybe = np.flatnonzero(known[windows & np.uint64((1 << _FILTER_BITS) - 1)])
                left = np.searchsorted(values, windows[maybe], side="left")
                right = np.searchsorted(values, windows[maybe], side="right")
                for window, a, b in zip(maybe[left < right], left[left < right], right[left < right]):
                    for item in owners[a:b]:
                        found.add((int(window) * size, (int(window) + 2) * size, int(item)))
        return found


def _find(index: ItemIndex, texts: pa.Array) -> Iterator[tuple[int, int, int]]:
    """(text, item, shared shingles) of all items contained in the texts of a column."""
    k, percent = index.settings.shingle_words, index.settings.percent
    for begin, end, words in chunks(texts, lower=True):
        # Windows run on over the ends of texts; what they hold is told apart below.
        shingles = grams(words.hashes, k)
        pairs = set()
        for low, high, item in index.candidates(shingles):
            first = np.searchsorted(words.first, low, side="right") - 1
            last = np.searchsorted(words.first, min(high, len(shingles)), side="left")
            pairs.update((text, item) for text in range(first, min(last, end - begin)))
        for text, item in sorted(pairs):
            own = shingles[words.first[text] : max(words.first[text], words.first[text + 1] - k + 1)]
            shared = int(np.isin(index.sets[item], own).sum())
            if 100 * shared >= percent * len(index.sets[item]):
                yield begin + text, item, shared
        for n, hashes, members in index.short:
            order = np.argsort(hashes, kind="stable")
            found = grams(words.hashes, n)
            left = np.searchsorted(hashes[order], found, side="left")
            right = np.searchsorted(hashes[order], found, side="right")
            at = np.flatnonzero(left < right)
            text = np.searchsorted(words.first, at, side="right") - 1
            whole = at + n <= words.first[text + 1]  # not run over the end of its text
            hits = {(int(t), int(members[i])) for t, a in zip(text[whole], at[whole]) for i in order[left[a] : right[a]]}
            for t, item in sorted(hits):
                yield begin + t, item, 1


def _item_sets(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, sizes, found = [], [], []
            for begin, end, words in chunks(batch.column("text"), lower=True):
                for i in range(end - begin):
                    hashes = words.hashes[words.first[i] : words.first[i + 1]]
                    one = shingle_set(hashes, settings.shingle_words)
                    lengths.append(len(hashes))
                    sizes.append(len(one))
                    found.append(one.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(lengths, pa.int64()), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())],
                names=["item_id", "n_words", "n", "shingles"],
            )

    return run


def passes(items: DataFrame, settings: Settings, id_col: str, text_col: str) -> Iterator[ItemIndex]:
    """Indexes of bounded size that together hold all items."""
    before = Window.orderBy("item_id", "n").rowsBetween(Window.unboundedPreceding, -1)
    sets = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).mapInArrow(
        _item_sets(settings), "item_id long, n_words long, n long, shingles binary"
    ).where("n > 0").withColumn("n_words", F.least("n_words", F.lit(settings.shingle_words)))
    sets = store(sets, "item_sets")
    # Ids and sizes of the items only; the sets are read pass by pass.
    placed = store(
        sets.withColumn("key", F.xxhash64("shingles")).select("item_id", "n_words", "n", "key").withColumn(
            "pass", F.floor(F.coalesce(F.sum(F.col("n") + 2 * settings.hashes).over(before), F.lit(0)) / settings.pass_shingles)
        ).dropDuplicates(["item_id", "n_words", "key"]),
        "item_passes",
    )
    last = placed.agg(F.max("pass")).first()[0]
    for number in range(0 if last is None else last + 1):
        now = sets.withColumn("key", F.xxhash64("shingles")).alias("s").join(
            placed.where(F.col("pass") == number).alias("p"),
            F.col("s.item_id").eqNullSafe(F.col("p.item_id")) & (F.col("s.key") == F.col("p.key"))
            & (F.col("s.n_words") == F.col("p.n_words")),
        ).select("s.item_id", "s.n_words", "s.shingles").distinct().orderBy("item_id", "n_words", "shingles").collect()
        yield ItemIndex(
            [r.item_id for r in now], [r.n_words for r in now],
            [np.frombuffer(bytes(r.shingles), dtype=np.uint64) for r in now],
            settings,
        )


def contained_items(
    docs: DataFrame, items: DataFrame, settings: Settings = Settings(),
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per document and item in it: doc_id, item_id, n_item, n_shared, containment.

    Words are runs of anything but ASCII white space, A-Z lower-cased; ``containment`` is
    the share of the item's distinct 5-word shingles (as 64-bit hashes) that the document
    has anywhere. An item with fewer than 5 words is one sequence, found where its words
    stand in a row; items without words are not searched. Very long texts are searched whole. Repeated documents and rows without an id are reported
    each; repeated items once. Other columns of the input are not looked at. With no
    items, or no documents, there are no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = "doc_id long, item_id long, n_item long, n_shared long, containment double"

    def one_pass(index: ItemIndex) -> DataFrame:
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("doc_id")
                rows = [(ids[t].as_py(), sent.value.ids[i], len(sent.value.sets[i]), shared)
                        for t, i, shared in _find(sent.value, batch.column("text"))]
                doc, item, n, shared = zip(*rows) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in (doc, item, n, shared)),
                     pa.array([s / m for s, m in zip(shared, n)], pa.float64())],
                    names=["doc_id", "item_id", "n_item", "n_shared", "containment"],
                )

        return texts.mapInArrow(run, kind)

    found = [one_pass(index) for index in passes(items, settings, item_col, item_text_col)]
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], kind)


def without_items(
    docs: DataFrame, items: DataFrame, settings: Settings = Settings(), text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The documents, all columns, that hold no item; nothing is shuffled."""
    spark, left = docs.sparkSession, docs

    def one_pass(rows: DataFrame, index: ItemIndex) -> DataFrame:
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[t for t, _, _ in _find(sent.value, batch.column(text_col))]] = False
                yield batch.filter(pa.array(keep))

        return rows.mapInArrow(run, rows.schema)

    for index in passes(items, settings, item_col, item_text_col):
        left = one_pass(left, index)
    return left
