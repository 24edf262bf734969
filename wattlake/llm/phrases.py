"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into dictionary phrases: each phrase is the shortest piece, from where
the last one ended, that is not in the dictionary yet. Texts that compress well with one
another share phrases. The fingerprint holds the smallest hashes of the phrase set; the
likeness of two fingerprints estimates the Jaccard similarity of the sets.

Each document is also compared with the one after it and with an edited text of its own,
made with the beginning of the one after it. For that the documents are dealt into pieces
of consecutive ids, and the first document of a piece is sent to the piece before it too:
texts move once. The bounds of the pieces, a few per task, are all that the driver sees.
"""

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import partitions, store, text_or_empty
from wattlake.llm.words import scramble


@dataclass(frozen=True)
class Settings:
    #: Smallest hashes of a fingerprint.
    minima: int = 128
    #: The last 1/edit_share of a text is replaced.
    edit_share: int = 4
    #: Pieces of consecutive documents for each partition.
    pieces: int = 4


class Dictionary:
    """Phrases of a text that is given bit by bit, as a tree of their letters. A phrase
    that no other begins with is a leaf and takes no node of its own."""

    def __init__(self):
        self.root: dict = {}
        #: Where the unfinished phrase stands: its node, and the place of that if it is a leaf.
        self.state = (self.root, self.root, "")

    def parse(self, text: str, log: list | None = None) -> list[int]:
        """Where in this bit each phrase ends. ``log`` takes what has to be undone."""
        node, above, last = self.state
        root, ends, at = self.root, [], 0
        for letter in text:
            at += 1
            if node is None:
                above[last] = {letter: None}
                if log is not None:
                    log.append((above, last, True))
                ends.append(at)
                node = root
            elif letter in node:
                above, last, node = node, letter, node[letter]
            else:
                node[letter] = None
                if log is not None:
                    log.append((node, letter, False))
                ends.append(at)
                node = root
        self.state = (node, above, last)
        return ends

    @staticmethod
    def undo(log: list) -> None:
        for node, letter, leaf in reversed(log):
            if leaf:
                node[letter] = None
            else:
                del node[letter]


def hashes(text: str, ends: list[int]) -> np.ndarray:
    """32-bit hash of each phrase of a text, which begins where the one before it ends."""
    if not ends:
        return np.zeros(0, dtype=np.uint32)
    codes = np.frombuffer(text[: ends[-1]].encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    starts = np.array([0, *ends[:-1]], dtype=np.int64)
    lengths = np.diff(starts, append=ends[-1])
    place = np.arange(len(codes)) - np.repeat(starts, lengths)
    weights = scramble(np.arange(1, int(lengths.max()) + 1, dtype=np.uint64)) | np.uint64(1)
    sums = np.add.reduceat(scramble(codes + np.uint64(1)) * weights[place], starts)
    return (scramble(sums) >> np.uint64(32)).astype(np.uint32)


def smallest(values: np.ndarray, minima: int) -> np.ndarray:
    return np.unique(values)[:minima]


def written(minima: np.ndarray) -> str:
    """Eight hexadecimal digits for each of the smallest hashes, in ascending order."""
    return minima.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, minima: int) -> float:
    """Share of the smallest hashes of both sets together that are in each; 1 for two
    empty sets."""
    both = np.union1d(a, b)[:minima]
    if not len(both):
        return 1.0
    return float((np.isin(both, a) & np.isin(both, b)).mean())


class _Document:
    """A parsed text, ready for another end."""

    def __init__(self, key, text: str, settings: Settings):
        self.key, self.text, self.settings, self.copies = key, text, settings, 0
        self.cut = len(text) - len(text) // settings.edit_share
        self.dictionary, log = Dictionary(), []
        head = self.dictionary.parse(text[: self.cut])
        state = self.dictionary.state
        tail = self.dictionary.parse(text[self.cut :], log)
        self.dictionary.undo(log)
        self.dictionary.state = state
        #: Where the phrase begins that is unfinished at the cut.
        self.rest = head[-1] if head else 0
        every = hashes(text, head + [self.cut + end for end in tail])
        # The smallest of the whole are among the smallest of its parts.
        self.head = smallest(every[: len(head)], settings.minima)
        self.minima = smallest(every, settings.minima)

    def result(self, after: "_Document") -> tuple:
        k = self.settings.minima
        edited = self.text[: self.cut] + after.text[: len(self.text) - self.cut]
        tail = self.dictionary.parse(edited[self.cut :])
        added = hashes(edited[self.rest :], [self.cut - self.rest + end for end in tail])
        minima = smallest(np.concatenate([self.head, added]), k)
        return (
            self.key[1], len(self.text), hashlib.sha256(edited.encode()).hexdigest(), written(self.minima), written(minima),
            likeness(self.minima, minima, k), likeness(self.minima, after.minima, k), self.copies,
        )


RESULT = [
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("copies", pa.int64()),
]
ROUTED = [
    ("piece", pa.int32()), ("follows", pa.bool_()), ("no_id", pa.bool_()), ("doc_id", pa.int64()),
    ("text_hash", pa.int64()), ("copies", pa.int64()), ("text", pa.string()),
]


def _batch(rows: list[tuple], schema: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, schema)], names=[n for n, _ in schema])


def _routed(bounds: list[tuple]):
    """Sends each document to its piece, and the first of a piece to the piece before it
    as well. Of rows repeated with id and text a task sends one, and how many there are."""
    order = [(no_id, -1 if no_id else doc_id, text_hash) for no_id, doc_id, text_hash in bounds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again: dict[tuple, int] = {}
        for batch in batches:
            rows = []
            for doc_id, text_hash, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "text"))):
                key = (doc_id is None, -1 if doc_id is None else doc_id, text_hash)
                if key in again:
                    again[key] += 1
                    continue
                again[key] = 0
                piece = max(bisect_right(order, key) - 1, 0)
                rows.append((piece, False, key[0], doc_id, text_hash, 1, text))
                if order[piece] == key:
                    rows.append(((piece - 1) % len(order), True, key[0], doc_id, text_hash, 0, text))
            yield _batch(rows, ROUTED)
        yield _batch(
            [
                (max(bisect_right(order, key) - 1, 0), False, key[0], None if key[0] else key[1], key[2], more, None)
                for key, more in again.items() if more
            ],
            ROUTED,
        )

    return run


def _fingerprints(settings: Settings):
    """Rows come by piece, in order of the documents, those that follow last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, last = None, None
        for batch in batches:
            found = []
            names = ("piece", "follows", "no_id", "doc_id", "text_hash", "copies")
            for i, (at, follows, no_id, doc_id, text_hash, copies) in enumerate(zip(*(batch.column(c).to_pylist() for c in names))):
                key = (no_id, doc_id, text_hash, follows)
                if at != piece:
                    piece, last = at, None
                if last is None or last.key != key:
                    document = _Document(key, batch.column("text")[i].as_py(), settings)
                    if last is not None:
                        found.append(last.result(document))
                    last = document
                last.copies += copies
            yield _batch(found, RESULT)

    return run


def fingerprints(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    A null text counts as empty: it has no phrases and the empty fingerprint. Documents
    go by id, those without one last, different texts with one id by a hash of the text.
    Rows repeated with id and text count as one document, and each has its result. The
    one after the last is the first; a single document follows itself. A text is held
    whole, with its phrases up to 100 bytes of memory for each of its characters. Other
    columns of the input are not looked at. An empty table gives no rows.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_or_empty(text_col)).alias("text_hash"),
        text_or_empty(text_col).alias("text"),
    )
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash")]
    keys = store(texts.select("doc_id", "text_hash").distinct(), "document_keys")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    # One row for each of the n * pieces pieces.
    bounds = sorted(
        (
            (r["first"]["no_id"], r["first"]["doc_id"], r["first"]["text_hash"])
            for r in keys.repartitionByRange(n * settings.pieces, *order).groupBy(F.spark_partition_id()).agg(first).collect()
        ),
        key=lambda k: (k[0], -1 if k[0] else k[1], k[2]),
    )
    routed = texts.mapInArrow(
        _routed(bounds),
        "piece int, follows boolean, no_id boolean, doc_id long, text_hash long, copies long, text string",
    )
    results = (
        routed.repartitionById(n, F.col("piece") % n)
        .sortWithinPartitions("piece", "follows", "no_id", "doc_id", "text_hash", F.col("text").isNull())
        .mapInArrow(
            _fingerprints(settings),
            "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
            " near_edited double, near_next double, copies long",
        )
    )
    return results.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copy", "copies")
