"""Quality classifier on learned subword embeddings.

A text is the bag of its words and of the 3 and 4 character grams inside its words (a space
may stand at either end of a gram and marks where a word begins or ends); a word equal
to the one before it counts as one more word, the same for all words. Each is hashed to
one of 2^18 vectors. The average of the vectors of a text goes to a softmax over the
two classes. Vectors and output weights are trained together by stochastic gradient
descent on a bounded sample of labelled documents. As the output is linear in the
average, scoring needs one number per vector: a look-up per character and gram length.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.labelled import fold, labelled_sample, rows_of_sample
from wattlake.llm.words import WHITE, Words, chunks

_BYTES32 = np.random.default_rng(77).integers(1, 2**32, 256, dtype=np.uint32)
_STEP32 = np.uint32(0x01000193)
_FINAL32 = np.uint32(0x9E3779B1)
_PLACES = np.multiply.accumulate(np.array([1] + [0x85EBCA6B] * 3, dtype=np.uint32))


#: Bucket of "the same word again".
REPEATED = 0
#: Bytes whose grams are made at a time, of several texts or of a part of a longer one: the
#: arrays of a step take some 60 times as much.
PIECE_BYTES = 1 << 17


@dataclass(frozen=True)
class Settings:
    folds: int = 4
    held_out: int = 2
    #: Labelled documents of each class to learn from, at most.
    sample: int = 1500
    bits: int = 18
    gram_sizes: tuple[int, ...] = (3, 4)
    dimensions: int = 8
    epochs: int = 5
    #: Texts seen at least, all epochs together.
    least_steps: int = 6000
    rate: float = 0.6
    seed: int = 5


@dataclass(frozen=True)
class Model:
    """Difference of the two outputs by vector, and for an empty average."""

    weights: np.ndarray
    bias: float


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, code) of each character of UTF-8 texts; any white space has the code of a space."""
    codes = _BYTES32[np.where(WHITE[data], 32, data)]
    later = (data & 0xC0) == 0x80
    first = np.flatnonzero(~later)
    if len(first) == len(data):
        return first, codes
    # The bytes of a character count by their place in it; one of one byte is that byte.
    place = later.astype(np.uint8)
    for before in (1, 2):
        place[1:] += later[1:] & (place[:-1] == before)
    return first, np.add.reduceat(codes * _PLACES[place], first, dtype=np.uint32)


def pieces(data: np.ndarray, size: int, after: int) -> Iterator[tuple[int, int, int]]:
    """(begin, end, end with ``after`` more characters) of parts of about ``size`` bytes, whole characters each."""

    def character(at: int) -> int:
        while at < len(data) and data[at] & 0xC0 == 0x80:
            at += 1
        return min(at, len(data))

    begin = 0
    while begin < len(data):
        end = more = character(begin + size)
        for _ in range(after):
            more = character(more + 1)
        yield begin, end, more
        begin = end


def features(words: Words, settings: Settings, piece: int = PIECE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of the words and grams of all texts of a chunk, in parts sorted by text.

    Grams come for ``piece`` bytes at a time, so a long text has many parts.
    """
    shift = np.uint64(64 - settings.bits)
    lengths = np.diff(words.first)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    yield owner, (words.hashes >> shift).astype(np.int64)
    same = np.flatnonzero((words.hashes[1:] == words.hashes[:-1]) & (owner[1:] == owner[:-1])) + 1
    yield owner[same], np.full(len(same), REPEATED, dtype=np.int64)
    for begin, end, more in pieces(words.data, piece, max(settings.gram_sizes) - 1):
        data = words.data[begin:more]
        first, codes = characters(data)
        own = np.searchsorted(first, end - begin)
        space = WHITE[data[first]]
        text = np.searchsorted(words.offsets, first + begin, side="right") - 1
        hashed, inner = codes, np.ones(len(codes), dtype=bool)
        for n in range(2, max(settings.gram_sizes) + 1):
            if len(codes) < n:
                break
            # A gram of n characters has those between its first and last inside a word.
            hashed = hashed[:-1] * _STEP32 + codes[n - 1 :]
            if n > 2:
                inner = inner[:-1] & ~space[n - 2 : len(codes) - 1]
            else:
                inner = inner[:-1]
            if n in settings.gram_sizes:
                # Those that begin in this piece; they may end in the next.
                good = np.flatnonzero((inner & (text[: len(hashed)] == text[n - 1 :]))[:own])
                yield text[good], ((hashed[good] * _FINAL32) >> np.uint32(32 - settings.bits)).astype(np.int64)


def bucket_counts(words: Words, texts: int, settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, how often) of each text of a chunk."""
    if texts == 1:
        # One text may be long and have many parts: they are counted one by one.
        counts = sum(np.bincount(ids, minlength=1 << settings.bits) for _, ids in features(words, settings))
        ids = np.flatnonzero(counts)
        yield ids, counts[ids]
        return
    parts = list(features(words, settings))
    for i in range(texts):
        own = [ids[np.searchsorted(text, i) : np.searchsorted(text, i + 1)] for text, ids in parts]
        yield np.unique(np.concatenate(own), return_counts=True)


def count_features(settings: Settings):
    """Buckets of each text and how often it has them, as two binary columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, counts = [], []
            for begin, end, words in chunks(batch.column("text"), most=PIECE_BYTES):
                for ids, n in bucket_counts(words, end - begin, settings):
                    buckets.append(ids.astype(np.int32).tobytes())
                    counts.append(n.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(buckets, pa.binary()), pa.array(counts, pa.binary())],
                names=["doc_id", "label", "buckets", "counts"],
            )

    return run


def fit(examples: list[tuple[int, np.ndarray, np.ndarray]], settings: Settings) -> Model:
    """Stochastic gradient descent over (label, buckets, counts), one text at a time.

    Both classes weigh the same. With only one class, or none, every score is 0.5.
    """
    rng = np.random.default_rng(settings.seed)
    size, dim = 1 << settings.bits, settings.dimensions
    examples = [e for e in examples if len(e[1])]
    per_class = np.bincount([e[0] for e in examples], minlength=2)
    if not per_class.all():
        return Model(np.zeros(size, dtype=np.float32), 0.0)
    weigh = per_class.sum() / (2.0 * per_class)
    vectors = rng.uniform(-1 / dim, 1 / dim, (size, dim)).astype(np.float32)
    output = np.zeros((dim, 2), dtype=np.float32)
    epochs = max(settings.epochs, -(-settings.least_steps // len(examples)))
    steps, step = epochs * len(examples), 0
    for _ in range(epochs):
        for at in rng.permutation(len(examples)):
            label, buckets, counts = examples[at]
            rate = np.float32(settings.rate * weigh[label] * (1 - step / steps))
            step += 1
            share = (counts / counts.sum()).astype(np.float32)
            mean = share @ vectors[buckets]
            logits = mean @ output
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = output @ p
            output -= rate * np.outer(mean, p)
            vectors[buckets] -= (rate * share)[:, None] * back[None, :]
    return Model(vectors @ (output[:, 1] - output[:, 0]), 0.0)


def train(docs: DataFrame, labels: DataFrame, label: str, settings: Settings) -> Model:
    """Learns from at most ``2 * settings.sample`` documents, whose counts come to the driver."""
    sample = labelled_sample(
        docs, labels, label, settings.folds, settings.held_out, {0: settings.sample, 1: settings.sample}
    )
    counted = sample.select("doc_id", F.col("label").cast("int").alias("label"), "text").mapInArrow(
        count_features(settings), "doc_id long, label int, buckets binary, counts binary"
    )
    rows = list(rows_of_sample(counted))
    rows.sort(key=lambda r: (r.doc_id, bytes(r.buckets)))
    return fit(
        [(r.label, np.frombuffer(bytes(r.buckets), np.int32), np.frombuffer(bytes(r.counts), np.int32)) for r in rows],
        settings,
    )


def text_scores(model: Model, settings: Settings, texts: pa.Array) -> np.ndarray:
    found = []
    for begin, end, words in chunks(texts, most=PIECE_BYTES):
        total, n = np.zeros(end - begin), np.zeros(end - begin)
        for text, ids in features(words, settings):
            total += np.bincount(text, weights=model.weights[ids], minlength=end - begin)
            n += np.bincount(text, minlength=end - begin)
        found.append(total / np.maximum(n, 1) + model.bias)
    logits = np.concatenate(found) if found else np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def scorer(docs: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings = Settings()):
    """Trains, and gives a column function: text to score (0 to 1, higher: label 1 likelier).

    Only the text is looked at. A null or empty text has no features and scores 0.5.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(train(docs, labels, label, settings))

    # Texts stay in their Arrow buffers: no copy of them as Python strings.
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(text_scores(sent.value, settings, texts))

    def column(text: Column) -> Column:
        return score(text)

    return column


def score_quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per input row: doc_id, held_out, score.

    Repeated rows are scored alike; a row without an id counts as not held out. Other
    columns of the input are not looked at. Without labels of both classes every score
    is 0.5. An empty table gives no rows.
    """
    score = scorer(docs, labels, settings=settings)
    return docs.select(
        "doc_id",
        F.coalesce(fold("doc_id", settings.folds) == settings.held_out, F.lit(False)).alias("held_out"),
        score(F.col("text")).alias("score"),
    )
