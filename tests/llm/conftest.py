import random

import pytest

#: A text that is long for one row, and one word that is.
LONG = "lorem ipsum dolor sit amet " * 6000
COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, slot long, row long,"
    " label int, group long, part int, target double, draw string, piece int, run long, score double,"
    " whole long, last_draw string, kept_id long, content string"
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns whose names
    operators use themselves."""

    def make(rows, parts=3):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, 7, 7, 7, 7, 7, 7, 7, 7.0, "7", 7, 7, 7.0, 7, "7", 7, "7") for r in rows
        ]
        return spark.createDataFrame(full, COLUMNS).repartition(parts)

    return make


def vocabulary(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n)]


@pytest.fixture(scope="session")
def corpus():
    """Texts with exact and near copies, shared passages, odd white space and edge cases."""
    rng = random.Random(4)
    words = vocabulary(400)
    passage = [rng.choice(words) for _ in range(45)]
    base = [rng.choice(words) for _ in range(120)]
    rows = []
    for i in range(160):
        kind = i % 8
        text = [rng.choice(words) for _ in range(rng.randint(1, 150))]
        if kind == 1:
            at = rng.randint(0, len(text))
            text[at:at] = passage[rng.randint(0, 10) : rng.randint(25, 45)]
        elif kind == 2:
            text = list(base)
            for _ in range(rng.randint(0, 6)):
                text[rng.randrange(len(text))] = rng.choice(words)
        elif kind == 3:
            text = list(base)
        elif kind == 4:
            text = [rng.choice(words)] * rng.randint(1, 60) + text[:5]
        gap = rng.choice([" ", "  ", "\n", " \t"])
        rows.append((1000 - i, gap.join(text), f"s{i % 5}" if i % 3 else "hot"))
    rows += [(1, None, None), (2, "", "s1"), (3, " \n\t ", "s1"), (4, "one", "s1"), (5, "ONE", None),
             (6, "Ünïcode wörds 日本語 ☃ a b", "s2"), (7, LONG, "s2"), (8, LONG, "s2"), (9, "x" * 50_000, "s2")]
    return rows
