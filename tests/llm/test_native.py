"""Content sort, shards and mixing against plain Python."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest

from wattlake.llm import mixing
from wattlake.llm.content_sort import exact_copies
from wattlake.llm.sharding import byte_shards


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_exact_copies(make_docs, corpus):
    rows = corpus + [(2000 + i, "the  same\ttext") for i in range(300)] + [(2500, "the same text ")]
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[normal(text)].append(doc_id)
    got = {r.doc_id: r for r in exact_copies(make_docs(rows)).collect()}
    assert len(got) == len(rows)
    for doc_id, text, *_ in rows:
        own = groups[normal(text)]
        assert tuple(got[doc_id]) == (
            doc_id, min(own), len(own), doc_id == min(own), hashlib.sha256(normal(text).encode()).hexdigest()
        )


def test_exact_copies_of_repeated_rows_and_rows_without_id(make_docs):
    rows = [(5, "a b"), (5, "a  b"), (None, "a b"), (None, "c"), (None, "c"), (7, "d")]
    got = exact_copies(make_docs(rows)).collect()
    kept = sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got if r.kept)
    assert kept == [("5", "5", 3), ("7", "7", 1), ("None", "None", 2)]
    assert len(got) == 6


def test_a_hot_group_is_cut_and_joined_again(make_docs):
    rows = [(i, "hot text") for i in range(500, 0, -1)] + [(1000 + i, f"text {i}") for i in range(100)]
    got = exact_copies(make_docs(rows, 7)).collect()
    assert {(r.keep_id, r.group_size) for r in got if r.doc_id <= 500} == {(1, 500)}
    assert sum(r.kept for r in got) == 101


@pytest.mark.parametrize("operator", [exact_copies, lambda d: byte_shards(d, 4), mixing.mix])
def test_empty_table(make_docs, operator):
    assert operator(make_docs([])).count() == 0


def test_exact_copies_plan_moves_texts_once_and_runs_no_python(make_docs):
    plan = exact_copies(make_docs([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def expected_shards(rows, shards):
    sized = sorted(
        ((d is None, d or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for d, t, *_ in rows)
    )
    total, before, slots, out = sum(s[3] for s in sized), 0, defaultdict(int), []
    for none, doc_id, crc, size in sized:
        shard = min(shards - 1, (2 * before + size) * shards // (2 * total))
        out.append((None if none else doc_id, size, crc, shard, slots[shard]))
        before, slots[shard] = before + size, slots[shard] + 1
    return out


@pytest.mark.parametrize("shards", [1, 7])
def test_shards(make_docs, corpus, shards):
    rows = corpus + [(None, "no id"), (None, "no id"), (1, "again one"), (4, "one"), (4, "one")]
    got = [tuple(r) for r in byte_shards(make_docs(rows), shards).collect()]
    assert sorted(got, key=repr) == sorted(expected_shards(rows, shards), key=repr)


def test_shards_are_balanced_with_ids_far_apart_and_many_without(make_docs):
    rows = [(None, "x" * 10)] * 400 + [(10**17 + i, "x" * 10) for i in range(100)] + [(i, "y" * 20) for i in range(700)]
    got = byte_shards(make_docs(rows, 5), 10).groupBy("shard").sum("size").collect()
    sums = [r[1] for r in got]
    assert len(sums) == 10 and max(sums) - min(sums) <= 2 * 36


def fill(sizes, weights, budget, cap):
    """Targets by rounds of clamping."""
    targets, free = {}, dict(weights)
    left = budget
    while free:
        total = sum(free.values())
        over = [s for s in free if left * free[s] / total >= cap * sizes[s]]
        if not over:
            return targets | {s: left * w / total for s, w in free.items()}
        share = {s: cap * sizes[s] for s in over}
        targets |= share
        left -= sum(share.values())
        for s in over:
            del free[s]
    return targets


def test_targets_by_rounds_and_taken_words(make_docs, corpus):
    rows = corpus + [(3000, "tiny source", "s9"), (3001, None, "void")]
    sizes = defaultdict(int)
    for _, text, *source in rows:
        sizes[source[0]] += len(words(text))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want = fill(sizes, weights, sum(sizes.values()), 3)
    got = mixing.mix(make_docs(rows)).collect()
    assert len(got) == len(rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.mix_size == len(words({d: t for d, t, *_ in rows}[r.doc_id]))
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.mix_copies <= 3
        taken[r.source] += r.mix_copies * r.mix_size
        largest[r.source] = max(largest[r.source], r.mix_size)
    for source in sizes:
        assert abs(taken[source] - want[source]) <= largest[source] / 2 + 1e-6


def test_mix_agrees_with_itself_and_repeats_rows(make_docs, corpus):
    first = {r.doc_id: r.mix_copies for r in mixing.mix(make_docs(corpus, 2)).collect()}
    second = mixing.mix(make_docs(corpus, 9))
    assert first == {r.doc_id: r.mix_copies for r in second.collect()}
    counts = {r.doc_id: r["count"] for r in mixing.repeated(make_docs(corpus, 9)).groupBy("doc_id").count().collect()}
    assert counts == {d: n for d, n in first.items() if n}


def test_equal_rows_are_taken_alike(make_docs):
    rows = [(None, "a b c", "x")] * 50 + [(i, "d e", "x") for i in range(50)] + [(i, "f", "y") for i in range(100, 200)]
    got = mixing.mix(make_docs(rows)).where("doc_id IS NULL").select("mix_copies").distinct().collect()
    assert len(got) == 1
