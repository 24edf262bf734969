"""Groups of spelling variants: words one inserted, deleted or replaced letter apart.

A word is the set of its letters, each with its number of occurrence: a binary vector.
One edit changes at most two places of it, so of the parts into which all possible places
are dealt, at most two differ between two near words. PartEnum enumerates every choice of
the parts that are left over: the places a word has in them make one exact signature, and
near words agree in at least one. Many words of a language have nearly the same letters;
a near word also leaves the front or the back half of a word as it is, and which half
that is, is part of the key. Words with an equal key meet in one join, whose condition
verifies the edit.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import store
from wattlake.llm.words import scramble

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = r"[A-Za-zÀ-ÿ]"


@dataclass(frozen=True)
class Settings:
    #: Letters of the shortest word, and its least number of occurrences.
    least_letters: int = 7
    least_count: int = 2
    #: A run loses a letter if its checksum is divided by this; None leaves all runs whole.
    erase: int | None = 31
    #: A form occurs at least so many times as often.
    ratio: int = 10
    #: Parts of the letter vectors, and how many of them may differ.
    parts: int = 4
    distance: int = 2


def vocabulary(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(word, n): counts are combined before they move. A row without an id is erased
    as if its id were the empty string."""
    # A shorter run cannot give a word, and a longer match is a whole run.
    runs = docs.select(
        F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":")).alias("place"),
        F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"{LETTERS}{{{settings.least_letters},}}"), F.lit(0))).alias("run"),
    )
    ascii_only = F.octet_length("run") == F.length("run")
    word = F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", CAPITALS, SMALL))
    words = runs.select("place", word.alias("word"))
    if settings.erase:
        crc = F.crc32(F.encode(F.concat("place", "word"), "UTF-8"))
        at = F.pmod("crc", F.length("word")).cast("int")
        erased = F.concat(F.col("word").substr(F.lit(1), at), F.col("word").substr(at + 2, F.length("word")))
        words = words.withColumn("crc", crc).select(
            F.when(F.col("crc") % settings.erase == 0, erased).otherwise(F.col("word")).alias("word")
        ).where(F.length("word") >= settings.least_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= settings.least_count)


def part_sums(words: list[str], parts: int) -> np.ndarray:
    """For each word and part the sum of random numbers of the places it has there."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    keys = np.sort((np.repeat(np.arange(len(words)), lengths) << 21) | letters)
    row, letter = keys >> 21, keys & 0x1FFFFF
    fresh = np.diff(keys, prepend=-1) != 0
    at = np.arange(len(keys))
    occurrence = at - np.maximum.accumulate(np.where(fresh, at, 0))
    place = scramble(((letter << 32) | occurrence).astype(np.uint64) + np.uint64(1))
    sums = np.zeros((len(words), parts), dtype=np.uint64)
    np.add.at(sums, (row, (scramble(place) % np.uint64(parts)).astype(np.int64)), place)
    return sums


def signatures(words: list[str], settings: Settings = Settings()) -> np.ndarray:
    """One column for each choice of the parts that agree."""
    sums = part_sums(words, settings.parts)
    columns = []
    for chosen in combinations(range(settings.parts), settings.parts - settings.distance):
        total = np.zeros(len(words), dtype=np.uint64)
        for part in chosen:
            total += scramble(sums[:, part] + np.uint64(part + 1))
        columns.append(scramble(total))
    return np.stack(columns, axis=1)


def halves(word: str) -> set[str]:
    """Of two words an edit apart, the shorter of length m: the edit leaves the first
    m // 2 letters or all letters after them as they are. A word is the longer or not."""
    found = set()
    for shorter in (len(word) - 1, len(word)):
        front = shorter // 2
        found.add("<" + word[:front])
        found.add(">" + word[len(word) - (shorter - front) :])
    return found


def _keyed(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column("word").to_pylist()
            every = signatures(words, settings)
            found = [[xxhash.xxh3_64_intdigest(h) for h in sorted(halves(w))] for w in words]
            row = np.repeat(np.arange(len(words)), [len(f) for f in found])
            half = np.array([h for f in found for h in f], dtype=np.uint64)
            for column in range(every.shape[1]):
                keys = scramble(every[row, column] ^ half) + np.uint64(column)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), batch.column("word").take(pa.array(row)), batch.column("n").take(pa.array(row))],
                    names=["key", "word", "n"],
                )

    return run


#: Words up to so many letters are compared by the whole table of edits.
TABLE_LETTERS = 64


def one_edit(a: Column, b: Column) -> Column:
    """Whether one edit leads from a to b. In words too long for the table of edits the
    first difference is found by halving, and what is behind it compared."""
    steps = [1 << i for i in range(30, -1, -1)]
    same = F.aggregate(
        F.lit(steps), F.lit(0),
        lambda n, step: F.when(
            (n + step <= F.length(a)) & (a.substr(F.lit(1), n + step) == b.substr(F.lit(1), n + step)), n + step
        ).otherwise(n),
    )
    rest = F.lit(2**31 - 1)
    behind = F.when(F.length(a) >= F.length(b), a.substr(same + 2, rest)).otherwise(a.substr(same + 1, rest)) == F.when(
        F.length(b) >= F.length(a), b.substr(same + 2, rest)
    ).otherwise(b.substr(same + 1, rest))
    long = F.greatest(F.length(a), F.length(b)) > TABLE_LETTERS
    return (a != b) & (F.abs(F.length(a) - F.length(b)) <= 1) & F.when(long, behind).otherwise(F.levenshtein(a, b, 1) == 1)


def near_pairs(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, n, near, near_n) for each ordered pair of near words; a hash that two keys
    share only makes a candidate more."""
    keyed = store(words.mapInArrow(_keyed(settings), "key long, word string, n long"), "word_keys")
    other = keyed.select(F.col("key").alias("other_key"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = keyed.join(
        other,
        (F.col("key") == F.col("other_key")) & (F.col("word") < F.col("near"))
        & one_edit(F.col("word"), F.col("near")),
    ).select("word", "n", "near", "near_n").distinct()
    pairs = store(pairs, "near_words")
    return pairs.unionAll(
        pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): each round doubles the steps followed. A form occurs ``ratio`` times
    as often as its word, so a chain has fewer steps than a count has digits."""
    roots = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = store(roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        roots = longer.drop("moved")
        if longer.where("moved").isEmpty():
            return roots


def spelling_variants(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are runs of Latin letters, A-Z lowered. The form of a word is its near word of
    largest count (then first in code-point order), if that is ``ratio`` times its own.
    A null or empty text has no words; very long texts and words are taken whole.
    Repeated rows count each. Other columns of the input are not looked at. An empty
    table gives no rows.
    """
    words = store(vocabulary(docs, settings, id_col, text_col), "vocabulary")
    nearest = near_pairs(words, settings).groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("form"))).alias("best"),
    )
    form_n = -F.col("best.rank")
    chosen = store(
        words.join(nearest, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(form_n >= settings.ratio * F.col("n"), F.struct(F.col("best.form").alias("form"), form_n.alias("form_n"))).alias("to"),
        ).select("word", "n", "n_near", F.col("to.form").alias("form"), F.col("to.form_n").alias("form_n")),
        "word_forms",
    )
    roots = _roots(chosen.where("form IS NOT NULL"))
    return chosen.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
