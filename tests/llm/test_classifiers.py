"""Learned scores: accuracy on held-out rows, and what must not enter them."""

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import vocabulary
from wattlake.llm import quality, toxicity
from wattlake.llm.words import chunks

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def labelled():
    """Texts, with quality 0 where the words carry symbols and toxic 1 where they insult."""
    rng, own = random.Random(6), vocabulary(300)
    rows, labels = [], []
    for i in range(600):
        text = [rng.choice(own) for _ in range(rng.randint(5, 80))]
        good, toxic = int(rng.random() < 0.6), int(rng.random() < 0.3)
        if not good:
            text = [w + rng.choice(["%%%", "***"]) for w in text]
        if toxic:
            text.insert(rng.randint(0, len(text)), rng.choice(["grobnik", "flanter", "mudwit"]))
        rows.append((i, " ".join(text)))
        labels.append((i, good, toxic))
    return rows, labels


@pytest.mark.parametrize("name, folds, held", [("quality", 4, 2), ("toxic", 3, 1)])
def test_held_out_accuracy(spark, make_docs, labelled, name, folds, held):
    rows, labels = labelled
    more = [(None, "no id"), (900, None), (901, ""), (902, "word " * 40_000), (0, rows[0][1])]
    table = spark.createDataFrame(labels, LABELS)
    operator = quality.score_quality if name == "quality" else toxicity.score_toxicity
    got = operator(make_docs(rows + more), table).collect()
    assert len(got) == len(rows) + len(more)
    by_id = {r.doc_id: r for r in got}
    assert all(0 <= r.score <= 1 for r in got) and by_id[900].score == by_id[901].score
    truth = {i: (q, t)[name == "toxic"] for i, q, t in labels}
    held_out = [i for i in truth if zlib.crc32(str(i).encode()) % folds == held]
    assert all(by_id[i].held_out == (i in set(held_out)) for i in truth)
    right = [(by_id[i].score >= 0.7) == truth[i] for i in held_out]
    assert np.mean(right) > 0.95


@pytest.mark.parametrize("name, folds, held", [("quality", 4, 2), ("toxic", 3, 1)])
def test_held_out_labels_do_not_matter(spark, make_docs, labelled, name, folds, held):
    rows, labels = labelled
    flipped = [(i, 1 - q, 1 - t) if zlib.crc32(str(i).encode()) % folds == held else (i, q, t) for i, q, t in labels]
    operator = quality.score_quality if name == "quality" else toxicity.score_toxicity
    one, two = (
        {r.doc_id: r.score for r in operator(make_docs(rows, parts), spark.createDataFrame(table, LABELS)).collect()}
        for table, parts in ((labels, 2), (flipped, 5))
    )
    assert one == two


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, None, None), (2, 1, 1), (2, 0, 0)]])
def test_without_labels_of_both_classes_scores_are_even(spark, make_docs, labels):
    docs, table = make_docs([(1, "a b"), (2, "c"), (3, None)]), spark.createDataFrame(labels, LABELS)
    for operator in (quality.score_quality, toxicity.score_toxicity):
        assert {r.score for r in operator(docs, table).collect()} == {0.5}
        assert operator(make_docs([]), table).count() == 0


def texts_of(rng, own, insult, group):
    text = [rng.choice(own) for _ in range(12)]
    if insult:
        text.append(rng.choice(["grobnik", "flanter", "mudwit"]))
    if group:
        text.append(group)
    return " ".join(text)


def word_sets(texts):
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "label": pa.array([0] * len(texts), pa.int32()), "text": pa.array(texts)})
    (out,) = toxicity.count_words([batch])
    return [np.frombuffer(w, np.uint64) for w in out.column("words").to_pylist()]


def test_swaps_take_the_weight_from_group_terms():
    """Insults come mostly with one group; a neutral mention of it must not score."""
    rng, own = random.Random(1), vocabulary(80)
    texts, labels = [], []
    for i in range(900):
        toxic = i % 3 == 0
        group = "muslims" if rng.random() < (0.7 if toxic else 0.02) else rng.choice([None, None, "christians", "women"])
        texts.append(texts_of(rng, own, toxic and rng.random() < 0.6, group))
        labels.append(int(toxic))
    examples = list(zip(labels, word_sets(texts)))
    neutral = pa.array([texts_of(rng, own, False, "muslims") for _ in range(200)])
    without = toxicity.text_scores(toxicity.fit(examples, toxicity.Settings(swap_penalty=0.0)), neutral)
    with_swaps = toxicity.text_scores(toxicity.fit(examples, toxicity.Settings()), neutral)
    assert (without >= 0.7).mean() > 0.5
    assert (with_swaps >= 0.7).mean() < 0.05
    insults = pa.array([texts_of(rng, own, True, "muslims") for _ in range(100)])
    assert (toxicity.text_scores(toxicity.fit(examples, toxicity.Settings()), insults) >= 0.7).mean() > 0.9


def test_one_id_does_not_fill_the_sample(spark, make_docs, labelled):
    """Of the rows with one id one is learned from, the same under any partitioning."""
    from wattlake.llm.labelled import labelled_sample, rows_of_sample

    rows, labels = labelled
    many = rows + [(i, f"again {i} {k % 50}") for i in (1, 4) for k in range(5000)]
    table = spark.createDataFrame(labels + [(1, 1, 1), (4, 0, 0)], LABELS)
    most = {0: 40, 1: 60}
    taken = []
    for parts in (2, 7):
        sample = labelled_sample(make_docs(many, parts), table, "quality", 4, 2, most)
        counted = sample.selectExpr("doc_id", "label", "encode(text, 'UTF-8') AS words")
        found = list(rows_of_sample(counted, batch_bytes=700))
        assert len(found) == len({r.doc_id for r in found}) <= sum(most.values())
        taken.append(sorted((r.doc_id, r.label, bytes(r.words)) for r in found))
    assert taken[0] == taken[1] and len(taken[0]) == 100


def test_grams_are_of_characters_in_any_script():
    rng = random.Random(3)
    letters = "abz \t\u00e9\u00df\u0416\u0448\u65e5\u672c\u8a9e\u0939\u093f\U0001f600\U00020000"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(60)] + ["", None, "\u65e5", "a"]
    settings = quality.Settings(bits=30)
    (begin, end, words), = chunks(pa.array(texts))
    assert (begin, end) == (0, len(texts))
    found = list(quality.features(words, settings))[2:]
    assert len(found) == len(settings.gram_sizes)
    of_bucket, seen = {}, 0
    for n, (owner, buckets) in zip(settings.gram_sizes, found):
        want = []
        for i, text in enumerate(texts):
            text = (text or "").replace("\t", " ")
            want += [(i, text[j : j + n]) for j in range(len(text) - n + 1) if " " not in text[j + 1 : j + n - 1]]
        assert owner.tolist() == [i for i, _ in want]
        for (_, gram), bucket in zip(want, buckets.tolist()):
            assert of_bucket.setdefault(bucket, gram) == gram
        seen += len({gram for _, gram in want})
    assert len(of_bucket) == seen


def test_grams_of_a_text_in_pieces_are_those_of_the_whole():
    rng = random.Random(8)
    letters = "abz \téßЖ日本ह\U0001f600"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 90))) for _ in range(12)] + ["", "a", "日"]
    (_, _, words), = chunks(pa.array(texts))
    settings = quality.Settings()

    def found(piece):
        return sorted((t, b) for text, ids in quality.features(words, settings, piece) for t, b in zip(text.tolist(), ids.tolist()))

    whole = found(1 << 20)
    assert len(list(quality.features(words, settings, 1 << 20))) == 2 + len(settings.gram_sizes)
    assert all(found(piece) == whole for piece in (1, 2, 3, 5, 64, 1000))


def test_a_long_text_counts_and_scores_as_its_features(monkeypatch):
    rng, settings = random.Random(9), quality.Settings()
    text = " ".join(rng.choice(vocabulary(50) + ["日本語", "Жш"]) for _ in range(400))
    weights = np.random.default_rng(2).normal(size=1 << settings.bits).astype(np.float32)
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": pa.array([1, 2, 3]), "label": pa.array([0, 1, 0], pa.int32()), "text": pa.array(["a b b", text, None])}
    )
    model, results = quality.Model(weights, 0.1), []
    for piece in (1 << 20, 100):
        monkeypatch.setattr(quality, "PIECE_BYTES", piece)
        monkeypatch.setattr(quality.features, "__defaults__", (piece,))
        (counted,) = quality.count_features(settings)([batch])
        results.append((counted.to_pydict(), quality.text_scores(model, settings, batch.column("text"))))
    assert results[0][0] == results[1][0]
    assert np.allclose(results[0][1], results[1][1], rtol=0, atol=1e-12)


@pytest.mark.parametrize("texts, most_mb", [(4000, 16), (1, 110)])
def test_memory_of_scoring_does_not_grow_with_the_grams(texts, most_mb):
    """4 MB as many texts or as one: the grams alone took 60 bytes for each byte handled at once."""
    text = ("lorem ipsum dolor sit amet " * (4_000_000 // texts // 27 + 1))[: 4_000_000 // texts]
    column, settings = pa.array([text] * texts), quality.Settings()
    model = quality.Model(np.ones(1 << settings.bits, dtype=np.float32), 0.0)
    quality.text_scores(model, settings, pa.array([text[:1000]]))  # tables that are kept
    tracemalloc.start()
    try:
        scores = quality.text_scores(model, settings, column)
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert len(scores) == texts and peak < most_mb
