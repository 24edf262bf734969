"""Filter audit, spelling variants and phrase fingerprints against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from tests.llm.conftest import vocabulary
from wattlake.llm import filter_audit, phrases, spelling

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- filter audit ---------------------------------------------------------------

def test_popcount_of_weighted_words():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 100):
        words = rng.integers(0, 2**32, n, dtype=np.uint32)
        copies = rng.integers(1, 1000, n)
        expected = [int(copies[(words >> np.uint32(b)) & 1 == 1].sum()) for b in range(32)]
        assert filter_audit.positional_popcount(words, copies).tolist() == expected


def failing(rows, s):
    """The letters that each row fails."""
    ids = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            ids[text or ""] = min(doc_id, ids.get(text or "", doc_id))
    found = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        first = ids.get(text)
        found.append("".join(letter for letter, fails in zip("ABCDE", (
            len(words) < s.least_words,
            100 * len(set(words)) < s.distinct_percent * len(words),
            100 * len(re.findall("[A-Z]", text)) > s.capital_percent * len(text),
            re.search(s.marks, text) is not None,
            first is not None and (doc_id is None or doc_id > first),
        )) if fails))
    return found


def audited(rows, labels, s):
    """Row by row through every order."""
    good = {i for i, quality, _ in labels if quality == 1}
    toxic = {i for i, _, mark in labels if mark == 1}
    expected, shapley = {}, Counter()
    fails = failing(rows, s)
    for part in {p or "" for _, _, p in rows}:
        mine = [(doc_id, f) for (doc_id, _, p), f in zip(rows, fails) if (p or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if letter in r[1]]
                left = [r for r in left if letter not in r[1]]
                ids = [i for i, _ in gone if i is not None]
                expected[part, order, step] = [
                    len(left), len(gone), sum(letter in f for _, f in mine) - len(gone), sum(f == letter for _, f in mine),
                    sum(i in good for i in ids), sum(i in toxic for i in ids),
                ]
                shapley[part, letter] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in expected.items()}


def test_audit_by_walking_every_order(spark, make_docs):
    rng = random.Random(8)
    few = vocabulary(12)
    rows = [
        (i, " ".join(rng.choice([w, w.upper(), w, w, f"{w}#"][: rng.choice([1, 4, 5])]) for w in rng.choices(few, k=rng.randint(0, 14))),
         rng.choice(["a", "a", "b", None, ""]))
        for i in range(150)
    ]
    rows += [(500 + i, rows[i][1], "b") for i in range(0, 150, 3)]  # copies
    rows += [(7, rows[7][1], "a"), (7, "other", "a"), (None, rows[9][1], "b"), (None, "alone", None), (None, "alone", None)]
    rows += [(900, None, "a"), (901, "", None), (902, "x" * 200_000, "b"), (903, "Ünï çödé 日本", "c")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 950, 2)]
    labels += [(7, 1, 0), (7, 0, 1), (None, 1, 1), (4, 1, 1), (9999, 1, 1)]
    table = spark.createDataFrame([(*r, 1, 1) for r in labels], "doc_id long, quality int, toxic int, part int, label int")
    s = filter_audit.Settings(least_words=6, distinct_percent=60)
    got = filter_audit.audit_filters(make_docs(rows), table, s)
    assert got.schema.simpleString() == (
        "struct<part:string,filter_order:string,step:int,kept:bigint,removed:bigint,redundant:bigint,"
        "unique_fails:bigint,good_lost:bigint,toxic_lost:bigint,shapley:bigint>"
    )
    assert {(r[0], r[1], r[2]): tuple(r[3:]) for r in got.collect()} == audited(rows, labels, s)


def test_audit_of_nothing(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_filters(make_docs([]), labels).count() == 0
    rows = filter_audit.audit_filters(make_docs([(1, None, None)]), labels).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""}
    assert {(r.removed, r.shapley) for r in rows if r.filter_order[r.step - 1] == "A"} == {(1, 120)}


# --- spelling -------------------------------------------------------------------

def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    return any(a[:i] == b[:i] and a[i + (len(a) == len(b)):] == b[i + 1:] for i in range(len(b)))


def variants(rows, s):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if s.erase and h % s.erase == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= s.least_letters and n >= s.least_count}
    forms, found = {}, {}
    for w, n in words.items():
        others = sorted((-words[o], o) for o in words if near(w, o))
        forms[w] = others[0][1] if others and -others[0][0] >= s.ratio * n else None
        found[w] = len(others)
    rows = set()
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.add((w, forms[w], root, n, found[w], words.get(forms[w])))
    return rows


@pytest.mark.parametrize("settings", [spelling.Settings(), spelling.Settings(erase=3, ratio=2, parts=3)])
def test_variants_of_all_pairs(make_docs, settings):
    rng = random.Random(2)
    words = ["".join(rng.choice("aeiouéçSTRN") for _ in range(rng.randint(6, 11))) for _ in range(25)]
    rows = []
    for i in range(400):
        text = rng.choices(words, weights=[300 if k % 5 == 0 else 6 for k in range(25)], k=30)
        at = rng.randrange(30)
        w, p = text[at], rng.randrange(6)
        text[at] = rng.choice([w[:p] + w[p + 1:], w[:p] + "q" + w[p:], w[:p] + "é" + w[p + 1:], w[:p] + w[p] + w[p:]])
        rows.append((i if i % 9 else None, rng.choice([" ", "-", "1"]).join(text)))
    rows += [(1, rows[1][1]), (1000, None), (1001, ""), (1002, "x" * 40_000), (1003, "X" * 40_000), (1004, "x" * 39_999)]
    rows += [(1005, "x" * 39_999), (1006, "çççççççç ççççççç ççççççç ççççççç" * 3), (1007, "日本語日本語日本語 abcdefg1abcdefg")]
    got = spelling.spelling_variants(make_docs(rows), settings)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = variants(rows, settings)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    assert any(form for _, form, *_ in expected) and any(n > 2 for *_, n, _ in expected)


def test_near_words_share_a_key():
    rng = random.Random(5)
    settings = spelling.Settings()
    for _ in range(300):
        a = "".join(rng.choice("abcé") for _ in range(rng.randint(7, 12)))
        p, c = rng.randrange(len(a)), rng.choice("abcéz")
        b = rng.choice([a[:p] + a[p + 1:], a[:p] + c + a[p:], a[:p] + c + a[p + 1:]])
        x, y = spelling.signatures([a, b], settings)
        assert (x == y).any() and spelling.halves(a) & spelling.halves(b)


def test_no_words(make_docs):
    assert spelling.spelling_variants(make_docs([])).count() == 0
    assert spelling.spelling_variants(make_docs([(1, "short of all"), (None, None)])).count() == 0


# --- phrases --------------------------------------------------------------------

def lempel_ziv(text):
    known, phrase = set(), ""
    for c in text:
        phrase += c
        if phrase not in known:
            known.add(phrase)
            phrase = ""
    return known


def minima(text, k):
    return sorted({int(phrases.hashes(p, [len(p)])[0]) for p in lempel_ziv(text)})[:k]


def alike(a, b, k):
    both = sorted({*a, *b})[:k]
    return sum(x in a and x in b for x in both) / len(both) if both else 1.0


@pytest.mark.parametrize("cut", [(0, 0), (0, 5), (3, 40), (40, 41), (100, 100)])
def test_phrases_in_two_pieces(cut):
    rng = random.Random(6)
    for _ in range(50):
        text = "".join(rng.choice("abcé ") for _ in range(rng.randint(0, 200)))
        at = min(cut[1], len(text))
        dictionary, log = phrases.Dictionary(), []
        head = dictionary.parse(text[:at])
        state = dictionary.state
        for _ in range(2):  # what is undone leaves no trace
            tail = [at + end for end in dictionary.parse(text[at:], log)]
            ends = head + tail
            found = [text[a:b] for a, b in zip([0, *ends], ends)]
            assert len(found) == len(set(found)) and set(found) == lempel_ziv(text)
            one_by_one = [int(phrases.hashes(p, [len(p)])[0]) for p in found]
            assert phrases.hashes(text, ends).tolist() == one_by_one
            dictionary.undo(log)
            dictionary.state, log = state, []


def test_fingerprints_by_plain_parse(spark, make_docs):
    rng = random.Random(7)
    words = vocabulary(80) + ["日本", "é😀"]
    rows = [(1000 - 3 * i, " ".join(rng.choices(words, k=rng.randint(0, 120)))) for i in range(60)]
    rows += [(5000 + i, rows[0][1]) for i in range(3)] + [(-4, None), (6, ""), (7, "a"), (8, "ab " * 40_000)]
    s = phrases.Settings(minima=32)
    got = phrases.fingerprints(make_docs(rows), s).collect()
    ordered = sorted((i, t or "") for i, t in rows)
    assert sorted(r.doc_id for r in got) == [i for i, _ in ordered]
    by_id = {r.doc_id: r for r in got}
    for (doc_id, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        r = by_id[doc_id]
        mine, other, following = (minima(t, 32) for t in (text, edited, after))
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == "".join(f"{x:08x}" for x in mine)
        assert r.edited_fingerprint == "".join(f"{x:08x}" for x in other)
        assert (r.near_edited, r.near_next) == (alike(mine, other, 32), alike(mine, following, 32))


def test_fingerprints_of_repeated_rows_and_rows_without_id(spark, make_docs):
    rows = [(3, "three three three")] * 5 + [(1, "one"), (1, "uno"), (None, "none"), (None, "none"), (None, None)]
    got = phrases.fingerprints(make_docs(rows, parts=4)).collect()
    assert len(got) == len(rows)
    threes = [r for r in got if r.doc_id == 3]
    assert len(threes) == 5 and len({tuple(r) for r in threes}) == 1
    # What follows the last with an id is one without; after all those comes the first.
    none = [r for r in got if r.doc_id is None]
    assert sorted(r.n_chars for r in none) == [0, 4, 4]
    assert len({tuple(r) for r in none}) == 2
    alone = phrases.fingerprints(make_docs([(1, "abcdefgh")])).collect()
    assert [(r.near_next, r.edited_sha256) for r in alone] == [(1.0, hashlib.sha256(b"abcdefab").hexdigest())]
    assert phrases.fingerprints(make_docs([])).count() == 0
