"""Toxicity classifier with counterfactual regularisation.

Logistic regression on the distinct words of a text. Only words whose share differs
between the classes beyond chance take part, and a weight on the absolute weights sets
those to zero that others explain: one insult counts the same in a short and in a long
text, and words without effect add no noise. While learning, each labelled text
that mentions a group is also seen with the mention swapped for another term of the same
kind, or for a neutral one, and the squared change of its score is penalised. So a term
cannot gain weight from the company it keeps in the sample, and a neutral mention of a
group does not make a text toxic.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.labelled import fold, labelled_sample, rows_of_sample
from wattlake.llm.words import Words, chunks

#: Bytes that separate words here: all of ASCII but digits and letters.
SEPARATORS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: Bytes of texts handled at a time; one longer text is handled alone.
PIECE_BYTES = 1 << 17

# Terms for groups, by kind; the first of each kind is the neutral one.
IDENTITY_TERMS = (
    ("people", "women", "men", "girls", "boys"),
    ("person", "woman", "man", "girl", "boy"),
    ("people", "muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("religious", "muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("people", "immigrants", "refugees", "foreigners", "gypsies"),
    ("person", "immigrant", "refugee", "foreigner", "gypsy"),
    ("human", "black", "white", "asian", "african", "arab", "latino", "european", "american", "mexican", "chinese", "indian"),
    ("human", "gay", "lesbian", "bisexual", "transgender", "homosexual", "heterosexual", "straight", "queer", "trans"),
    ("human", "disabled", "blind", "deaf", "autistic"),
    ("human", "old", "elderly", "young"),
)


@dataclass(frozen=True)
class Settings:
    folds: int = 3
    held_out: int = 1
    #: Labelled documents to learn from, at most.
    toxic: int = 2000
    other: int = 4000
    #: Smallest chi-squared statistic (one degree of freedom) of a word with the label.
    evidence: float = 20.0
    epochs: int = 12
    #: Texts seen at least, all epochs together.
    least_steps: int = 20_000
    rate: float = 1.0
    #: Weight of the absolute weights, and of squared score changes under a swap.
    sparsity: float = 1e-3
    swap_penalty: float = 1.0
    identity_terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS
    seed: int = 11


@dataclass(frozen=True)
class Model:
    """Sorted hashes of the words that count, their weights, and the bias."""

    words: np.ndarray
    weights: np.ndarray
    bias: float


def word_hash(word: str) -> np.uint64:
    (_, _, words), = chunks(pa.array([word]), lower=True, separators=SEPARATORS)
    return words.hashes[0]


def distinct_words(words: Words, i: int) -> np.ndarray:
    return np.unique(words.hashes[words.first[i] : words.first[i + 1]])


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for begin, end, words in chunks(batch.column("text"), lower=True, separators=SEPARATORS, most=PIECE_BYTES):
            found += [distinct_words(words, i).tobytes() for i in range(end - begin)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(found, pa.binary())], names=["doc_id", "label", "words"]
        )


def _telling_words(examples: list[tuple[int, np.ndarray]], per_class: np.ndarray, evidence: float) -> np.ndarray:
    """Words whose presence and the label have a chi-squared statistic of ``evidence``."""
    known, inverse = np.unique(np.concatenate([w for _, w in examples]), return_inverse=True)
    toxic = np.repeat([label for label, _ in examples], [len(w) for _, w in examples])
    a = np.bincount(inverse, weights=toxic, minlength=len(known))  # toxic with the word
    b = np.bincount(inverse, weights=1 - toxic, minlength=len(known))
    c, d = per_class[1] - a, per_class[0] - b
    below = np.maximum((a + b) * (c + d) * (a + c) * (b + d), 1.0)
    return known[(a + b + c + d) * (a * d - b * c) ** 2 / below >= evidence]


def fit(examples: list[tuple[int, np.ndarray]], settings: Settings) -> Model:
    """Proximal gradient steps (one rate per weight) over (label, distinct words).

    Both classes weigh the same; texts with equal words and label count once. With only
    one class, or none, every score is 0.5.
    """
    examples = list({(label, words.tobytes()): (label, words) for label, words in examples}.values())
    empty = Model(np.zeros(0, np.uint64), np.zeros(0), 0.0)
    per_class = np.bincount([label for label, _ in examples], minlength=2)
    if not per_class.all():
        return empty
    terms = [[word_hash(t) for t in kind] for kind in settings.identity_terms]
    swappable = np.unique(np.array([t for kind in terms for t in kind], dtype=np.uint64))
    vocabulary = np.union1d(_telling_words(examples, per_class, settings.evidence), swappable)
    partners = {}
    for kind in terms:
        places = np.searchsorted(vocabulary, np.array(kind, dtype=np.uint64))
        for term in places[1:]:
            partners.setdefault(int(term), []).extend(int(p) for p in places if p != term)

    rows = []
    for label, words in examples:
        place = np.searchsorted(vocabulary, words)
        place = np.minimum(place, len(vocabulary) - 1)
        rows.append((label, place[vocabulary[place] == words]))
    mentions = [[int(p) for p in own if int(p) in partners] for _, own in rows]

    rng = np.random.default_rng(settings.seed)
    weigh = per_class.sum() / (2.0 * per_class)
    weights, squares, bias, bias_squares = np.zeros(len(vocabulary)), np.full(len(vocabulary), 1e-2), 0.0, 1e-2

    def move(at: np.ndarray, gradient: np.ndarray, shrink: float) -> None:
        squares[at] += gradient**2
        rate = settings.rate / np.sqrt(squares[at])
        stepped = weights[at] - rate * gradient
        weights[at] = np.sign(stepped) * np.maximum(np.abs(stepped) - rate * shrink, 0.0)

    for _ in range(max(settings.epochs, -(-settings.least_steps // len(rows)))):
        for i in rng.permutation(len(rows)):
            label, own = rows[i]
            score = 1 / (1 + np.exp(-np.clip(weights[own].sum() + bias, -30, 30)))
            gradient = weigh[label] * (score - label)
            bias_squares += gradient**2
            bias -= settings.rate / np.sqrt(bias_squares) * gradient
            move(own, np.full(len(own), gradient), settings.sparsity)
            for term in mentions[i]:
                # The texts differ in one word, so the score changes by the two weights.
                other = partners[term][rng.integers(len(partners[term]))]
                change = 2 * settings.swap_penalty * (weights[term] - weights[other])
                move(np.array([term, other]), np.array([change, -change]), 0.0)
    used = np.flatnonzero(weights)
    return Model(vocabulary[used], weights[used], float(bias))


def train(docs: DataFrame, labels: DataFrame, settings: Settings) -> Model:
    """Learns from at most ``toxic + other`` documents, whose word hashes come to the driver."""
    sample = labelled_sample(
        docs, labels, "toxic", settings.folds, settings.held_out, {0: settings.other, 1: settings.toxic}
    )
    counted = sample.select("doc_id", F.col("label").cast("int").alias("label"), "text").mapInArrow(
        count_words, "doc_id long, label int, words binary"
    )
    rows = list(rows_of_sample(counted))
    rows.sort(key=lambda r: (r.doc_id, bytes(r.words)))
    return fit([(r.label, np.frombuffer(bytes(r.words), np.uint64)) for r in rows], settings)


def text_scores(model: Model, texts: pa.Array) -> np.ndarray:
    found = []
    for begin, end, words in chunks(texts, lower=True, separators=SEPARATORS, most=PIECE_BYTES):
        logits = np.full(end - begin, model.bias)
        if len(model.words):
            place = np.minimum(np.searchsorted(model.words, words.hashes), len(model.words) - 1)
            hits = np.flatnonzero(model.words[place] == words.hashes)
            text = np.searchsorted(words.first, hits, side="right") - 1
            once = np.unique(np.stack([text, place[hits]]), axis=1)  # each word of a text counts once
            np.add.at(logits, once[0], model.weights[once[1]])
        found.append(logits)
    logits = np.concatenate(found) if found else np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def scorer(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()):
    """Trains, and gives a column function: text to score (0 to 1, higher: toxic).

    Only the text is looked at; a null text counts as empty and has the bias alone.
    """
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, settings))

    # Texts stay in their Arrow buffers: no copy of them as Python strings.
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(text_scores(sent.value, texts))

    def column(text: Column) -> Column:
        return score(text)

    return column


def score_toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per input row: doc_id, held_out, score.

    Repeated rows are scored alike; a row without an id counts as not held out. Other
    columns of the input are not looked at. Without labels of both classes every score
    is 0.5. An empty table gives no rows.
    """
    score = scorer(docs, labels, settings)
    return docs.select(
        "doc_id",
        F.coalesce(fold("doc_id", settings.folds) == settings.held_out, F.lit(False)).alias("held_out"),
        score(F.col("text")).alias("score"),
    )
