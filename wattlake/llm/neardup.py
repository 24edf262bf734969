"""Near-duplicates: MinHash bands, sequential Bayesian verification, exact check.

1. Each text becomes the set of its word shingles, a MinHash signature and band keys.
   Texts with equal sets are one class and go on as one representative.
2. Representatives with a band in common are candidates. They are not paired: each
   names the smallest one of its band, and the connected components of these links
   are the candidate groups, so a band of m rows costs m rows.
3. A group is cut into blocks of bounded rows and bytes; a task gets two blocks. It
   compares signatures in batches. After each batch a pair is dropped if, given the
   matches so far and a uniform prior, the probability that its similarity reaches the
   threshold is below the chosen miss probability. Survivors are verified on the full
   sets. Pairs that verified links connect already are skipped: the components stay
   the same, and a task gives back fewer links than it has rows.
4. The components of the verified links are the near-duplicate groups.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import partitions, store
from wattlake.llm.components import components
from wattlake.llm.words import chunks, scramble, shingle_set


@dataclass(frozen=True)
class Settings:
    shingle_words: int = 5
    #: Smallest similarity of a link, in hundredths.
    percent: int = 75
    bands: int = 32
    #: Hashes of a band; 32 bands of 4 miss a pair at 0.75 with probability 5e-6.
    rows: int = 4
    #: Hashes of a signature that are compared before the next decision.
    batch: int = 16
    #: A pair is dropped if it reaches the threshold with less than this probability.
    miss: float = 1e-6
    block_rows: int = 512
    block_shingles: int = 400_000

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    def least_matches(self) -> list[int]:
        """For n compared hashes the fewest matches with which a pair goes on.

        With a uniform prior the similarity after k of n matches has the distribution
        Beta(k + 1, n - k + 1), and P(similarity >= t) = P(Binomial(n + 1, t) <= k).
        """
        t, need = self.percent / 100, [0]
        for n in range(1, self.hashes + 1):
            below, k = 0.0, 0
            while True:
                below += comb(n + 1, k) * t**k * (1 - t) ** (n + 1 - k)
                if below >= self.miss:
                    break
                k += 1
            need.append(k)
        return need


PROFILE = "doc_id long, text_hash long, row long, n_shingles long, set_digest binary, bands array<long>"


def multipliers(n: int) -> np.ndarray:
    return scramble(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    low = np.full(len(factors), 2**64 - 1, dtype=np.uint64)
    for begin in range(0, len(shingles), 2048):
        part = shingles[begin : begin + 2048, None] * factors[None, :]
        np.minimum(low, part.min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def _profiles(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = multipliers(settings.hashes)
        band = scramble(np.arange(1, settings.bands + 1, dtype=np.uint64))
        mix = multipliers(settings.rows)
        for batch in batches:
            counts, digests, bands = [], [], []
            for begin, end, words in chunks(batch.column("text"), lower=True):
                for i in range(end - begin):
                    found = shingle_set(words.hashes[words.first[i] : words.first[i + 1]], settings.shingle_words)
                    counts.append(len(found))
                    if not len(found):
                        digests.append(None), bands.append(None)
                        continue
                    one = signature(found, factors)
                    digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                    rows = one.reshape(settings.bands, settings.rows).astype(np.uint64)
                    bands.append(scramble((rows * mix).sum(axis=1, dtype=np.uint64) ^ band).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_hash"), batch.column("row"),
                    pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "row", "n_shingles", "set_digest", "bands"],
            )

    return run


def _sets(settings: Settings):
    """Sets and signatures of the candidates; those of all texts would be moved in vain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = multipliers(settings.hashes)
        for batch in batches:
            found, signatures = [], []
            for begin, end, words in chunks(batch.column("text"), lower=True):
                for i in range(end - begin):
                    hashes = words.hashes[words.first[i] : words.first[i + 1]]
                    found.append(shingle_set(hashes, settings.shingle_words))
                    signatures.append(signature(found[-1], factors).tobytes())
            columns = {name: batch.column(name) for name in ("group", "row", "parts", "part")}
            columns["signature"] = pa.array(signatures, pa.binary())
            found = [one.tobytes() for one in found]
            columns["shingles"] = pa.array(found, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return run


class _Block:
    """The rows of one or two blocks of a group, and the links found among them."""

    def __init__(self, settings: Settings, need: list[int]):
        self.settings, self.need = settings, need

    def links(self, rows, parts, signatures, sets) -> list[tuple[int, int]]:
        self.signatures, self.sets = signatures, sets
        self.sizes = np.array([len(s) for s in sets])
        self.root = np.arange(len(rows))
        left = np.flatnonzero(parts == parts.min())
        right = np.flatnonzero(parts == parts.max())
        found = []
        for at, a in enumerate(left):
            others = left[at + 1 :] if parts.min() == parts.max() else right
            for b in self._linked(a, others):
                found.append((int(rows[a]), int(rows[b])))
        return found

    def _linked(self, a: int, others: np.ndarray) -> Iterator[int]:
        small = np.minimum(self.sizes[others], self.sizes[a])
        large = np.maximum(self.sizes[others], self.sizes[a])
        others = others[(self.root[others] != self.root[a]) & (100 * small >= self.settings.percent * large)]
        matches = np.zeros(len(others), dtype=np.int64)
        for begin in range(0, self.settings.hashes, self.settings.batch):
            if not len(others):
                return
            span = slice(begin, min(begin + self.settings.batch, self.settings.hashes))
            matches = matches + (self.signatures[others, span] == self.signatures[a, span]).sum(axis=1)
            kept = matches >= self.need[span.stop]
            others, matches = others[kept], matches[kept]
        others = others[np.argsort(-matches, kind="stable")]
        step = 8
        while len(others):
            now, others = others[:step], others[step:]
            for b in now[self._verified(a, now)]:
                if self.root[b] != self.root[a]:
                    yield b
                    self.root[self.root == self.root[b]] = self.root[a]
            others = others[self.root[others] != self.root[a]]
            step = min(4 * step, 256)

    def _verified(self, a: int, others: np.ndarray) -> np.ndarray:
        mine, theirs = self.sets[a], np.concatenate([self.sets[b] for b in others])
        place = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
        ends = np.cumsum(self.sizes[others])
        shared = np.add.reduceat((mine[place] == theirs).astype(np.int64), ends - self.sizes[others])
        union = self.sizes[a] + self.sizes[others] - shared
        return 100 * shared >= self.settings.percent * union


def _block_links(settings: Settings):
    """Rows come sorted by (group, low, high); each such key is one pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, key = _Block(settings, settings.least_matches()), [], None

        def finish() -> list[tuple[int, int]]:
            if len(held) < 2:
                return []
            rows, parts, signatures, sets = zip(*held)
            return block.links(
                np.array(rows), np.array(parts),
                np.frombuffer(b"".join(signatures), dtype=np.uint32).reshape(len(rows), -1),
                [np.frombuffer(s, dtype=np.uint64) for s in sets],
            )

        def out(links: list[tuple[int, int]]) -> pa.RecordBatch:
            a, b = zip(*links) if links else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            links = []
            table = batch.to_pydict()
            for group, low, high, row, part, sig, found in zip(
                *(table[c] for c in ("group", "low", "high", "row", "part", "signature", "shingles"))
            ):
                if (group, low, high) != key:
                    links += finish()
                    held, key = [], (group, low, high)
                held.append((row, part, sig, found))
            yield out(links)
        yield out(finish())

    return run


def _linked(docs: DataFrame, settings: Settings, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Profiles of all rows, classes of rows with equal sets, and (node, component) of
    the classes that verified links join, named by their rows."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    profiles = store(
        texts.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_profiles(settings), PROFILE), "profiles"
    )

    # A class is named by its row with the smallest id; the aggregate combines before it shuffles.
    classes = store(
        profiles.where("n_shingles > 0").groupBy("set_digest").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "row")).alias("first")
        ).select(
            "set_digest", F.col("first.doc_id").alias("class_id"), F.col("first.text_hash").alias("class_hash"),
            F.col("first.row").alias("class_row"),
        ),
        "classes",
    )
    heads = profiles.join(classes.select(F.col("class_row").alias("row")), "row", "left_semi")

    bands = heads.select("row", F.explode("bands").alias("band"))
    # Stored, so that Spark can split the join of a band that very many rows have.
    smallest = store(
        bands.groupBy("band").agg(F.min("row").alias("low"), F.count("*").alias("n")).where("n > 1"), "shared_bands"
    )
    groups = store(
        components(bands.join(smallest, "band").where("row != low").select(F.col("low").alias("a"), F.col("row").alias("b"))),
        "candidate_groups",
    )

    members = heads.select("row", "doc_id", "text_hash").join(
        groups.select(F.col("node").alias("row"), F.col("component").alias("group")), "row"
    )
    sizes = groups.join(heads.select(F.col("row").alias("node"), "n_shingles"), "node").groupBy(
        F.col("component").alias("group")
    ).agg(F.greatest(
        F.ceil(F.count("*") / settings.block_rows), F.ceil(F.sum("n_shingles") / settings.block_shingles)
    ).cast("int").alias("parts"))
    members = members.join(sizes, "group").withColumn("part", F.expr("pmod(hash(row), parts)"))

    # The join with the texts is by (id, hash of the text); repeated rows give one.
    id_key = F.coalesce(F.col("doc_id"), F.lit(-1))
    with_text = members.withColumn("id_key", id_key).drop("doc_id").join(
        texts.withColumn("id_key", id_key).select("id_key", "text_hash", "text"), ["id_key", "text_hash"]
    ).dropDuplicates(["id_key", "text_hash", "row"])
    sets = with_text.select("group", "row", "parts", "part", "text").mapInArrow(
        _sets(settings), "group long, row long, parts int, part int, signature binary, shingles binary"
    )
    pairs = (
        sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("low", F.least("part", "other"))
        .withColumn("high", F.greatest("part", "other"))
        .drop("other", "parts")
        .repartition(partitions(spark), "group", "low", "high")
        .sortWithinPartitions("group", "low", "high")
    )
    links = store(pairs.mapInArrow(_block_links(settings), "a long, b long"), "links")
    return profiles, classes, store(components(links), "linked")


def near_duplicates(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a text with fewer
    words than a shingle has one shingle, a null or empty text none and no links. Rows
    are linked if the similarity of their shingle sets, as 64-bit hashes, reaches the
    threshold; ``component_id`` is the smallest id that can be reached. Rows without an
    id take part and never name a component that has an id; a component without any id
    has a null ``component_id`` and its rows are kept. Repeated rows share their
    component, and each with the component's id is kept. Other columns of the input are
    not looked at. An empty table gives no rows.
    """
    profiles, classes, linked = _linked(docs, settings, id_col, text_col)

    # Smallest id of each component; a hot component is combined before the exchange.
    named = linked.join(classes, linked["node"] == classes["class_row"]).select("node", "component", "class_id")
    lowest = named.groupBy("component").agg(F.min("class_id").alias("component_id"))
    known = named.select("node", "component").join(lowest, "component").select(
        F.col("node").alias("class_row"), "component_id"
    )
    labels = classes.join(known, "class_row", "left").select(
        "set_digest", F.coalesce("component_id", "class_id").alias("component_id")
    )
    return profiles.select("doc_id", "n_shingles", "set_digest").join(labels, "set_digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def kept_texts(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text_hash) of the documents that stay: of each component that with the
    smallest id, one with an id before one without, then the smallest hash; of texts
    without words each. No pair comes twice.
    """
    profiles, classes, linked = _linked(docs, settings, id_col, text_col)
    wordless = profiles.where("n_shingles = 0").select("doc_id", "text_hash").distinct()
    first = F.min(F.struct(F.col("class_id").isNull().alias("no_id"), "class_id", "class_hash")).alias("first")
    heads = (
        classes.join(linked, classes["class_row"] == linked["node"], "left")
        .groupBy(F.coalesce("component", "class_row").alias("component")).agg(first)
        .select(F.col("first.class_id").alias("doc_id"), F.col("first.class_hash").alias("text_hash"))
    )
    return heads.unionAll(wordless)
