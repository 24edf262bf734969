"""Repeated substrings of words, found with suffix automata of reference shards.

Every window of ``window`` words has a leader: the k-word gram in it with the smallest
hash, the leftmost on ties. Equal windows have equal leaders, so all windows that can
be equal to one another lie in spans around occurrences of one leader gram; a span
holds the consecutive windows with that occurrence as their leader. About one word in
seven begins a leader, and only leader grams that occur twice are followed up:

* texts with equal words are one class: the first is looked at, later ones repeat it;
* the spans around one leader meet in one task, in order of (document, position). The
  spans so far are a reference shard with a suffix automaton. A span is streamed through
  it, and windows that end where the match is at least ``window`` words long are
  repeated; then it is added. A span equal to one before it is repeated as a whole.

An automaton thus meets the spans that can match it, and is not sent to every document,
whose cost would be shards times corpus. A leader with very many spans (a passage that a
large share of the documents has) would be too much for one task: equal spans are
found by grouping, combined before the exchange, and what is left is cut into single
windows for which the same is done.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import partitions, store, store_dealt
from wattlake.llm.words import chunks, grams


@dataclass(frozen=True)
class Settings:
    #: Words of the shortest repeated passage.
    window: int = 20
    #: Words of a leader gram.
    gram: int = 8
    #: Spans around a leader up to which they share an automaton.
    shard_spans: int = 1024
    #: Places of spans that a task remembers, about 300 bytes each.
    remembered: int = 500_000


class SuffixAutomaton:
    """Suffix automaton over several word sequences."""

    def __init__(self):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, words: list[bytes]) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)

    def _new(self, length: int, link: int, edges: dict[bytes, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _extend(self, last: int, word: bytes) -> int:
        following, link, length = self.next, self.link, self.length
        known = following[last].get(word)
        if known is not None and length[known] == length[last] + 1:
            return known  # an earlier sequence went this way
        state = None if known is not None else self._new(length[last] + 1, 0, {})
        at = last
        while at != -1 and word not in following[at]:
            following[at][word] = state
            at = link[at]
        if at == -1:
            return state
        target = following[at][word]
        if length[target] != length[at] + 1:
            copy = self._new(length[at] + 1, link[target], dict(following[target]))
            while at != -1 and following[at].get(word) == target:
                following[at][word] = copy
                at = link[at]
            link[target] = copy
            target = copy
        if state is None:
            return target
        link[state] = target
        return state

    def statistics(self, words: list[bytes]) -> Iterator[int]:
        """For each word the longest match that ends there."""
        state = matched = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                matched += 1
            else:
                matched = 0
            yield matched


def leaders(gram_hashes: np.ndarray, grams_per_window: int) -> np.ndarray:
    """For each window the index of its leader gram."""
    if len(gram_hashes) < grams_per_window:
        return np.zeros(0, dtype=np.int64)
    best = np.arange(len(gram_hashes) - grams_per_window + 1)
    low = gram_hashes[: len(best)].copy()
    for j in range(1, grams_per_window):
        other = gram_hashes[j : j + len(best)]
        smaller = other < low
        low[smaller] = other[smaller]
        best[smaller] = np.flatnonzero(smaller) + j
    return best


OUTLINE = "doc_id long, text_hash long, row long, n_words long, windows long, words_digest binary, words_sha256 string"
LEADERS = "row long, leaders array<struct<leader: long, spans: long>>"


def _hashes(words, i: int) -> np.ndarray:
    return words.hashes[words.first[i] : words.first[i + 1]]


def _spans(hashes: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(leader gram hash, first window, windows) of all spans of a text."""
    gram_hashes = grams(hashes, settings.gram)
    best = leaders(gram_hashes, settings.window - settings.gram + 1)
    if not len(best):
        return best.astype(np.uint64), best, best
    begin = np.concatenate([[0], np.flatnonzero(np.diff(best)) + 1])
    return gram_hashes[best[begin]], begin, np.diff(np.append(begin, len(best)))


def _outlines(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, shas = [], [], []
            for text in batch.column("text"):
                split = (text.as_py() or "").encode().split()
                joined = b" ".join(split)
                counts.append(len(split))
                digests.append(xxhash.xxh3_128_digest(joined))
                shas.append(hashlib.sha256(joined).hexdigest())
            windows = [max(0, n - settings.window + 1) for n in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_hash"), batch.column("row"),
                    pa.array(counts, pa.int64()), pa.array(windows, pa.int64()), pa.array(digests, pa.binary()),
                    pa.array(shas, pa.string()),
                ],
                names=["doc_id", "text_hash", "row", "n_words", "windows", "words_digest", "words_sha256"],
            )

    return run


def _leaders(settings: Settings):
    """The leaders of each text, and how many spans of it each has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, spans = [], []
            for begin, end, words in chunks(batch.column("text")):
                for i in range(end - begin):
                    leader, times = np.unique(_spans(_hashes(words, i), settings)[0].view(np.int64), return_counts=True)
                    found.append(leader), spans.append(times)
            ends = pa.array(np.cumsum([0] + [len(f) for f in found]), pa.int32())
            found, spans = (np.concatenate([np.zeros(0, np.int64), *each]) for each in (found, spans))
            listed = pa.StructArray.from_arrays([pa.array(found), pa.array(spans)], ["leader", "spans"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.ListArray.from_arrays(ends, listed)], names=["row", "leaders"]
            )

    return run


def _named_spans(batch: pa.RecordBatch, names: str, settings: Settings):
    """For each chunk of the texts the spans around the leaders listed for the text:
    (row of the batch, leader, first window, windows, words of the text)."""
    listed = batch.column(names)
    for begin, end, words in chunks(batch.column("text")):
        spans = []
        for i in range(end - begin):
            wanted = listed[begin + i].as_py()
            if not wanted:
                continue
            leader, first, windows = _spans(_hashes(words, i), settings)
            named = np.flatnonzero(np.isin(leader.view(np.int64), np.array(wanted, dtype=np.int64)))
            split = words.data[words.offsets[i] : words.offsets[i + 1]].tobytes().split()
            for at in named:
                spans.append((begin + i, int(leader[at].view(np.int64)), int(first[at]), int(windows[at]), split))
        yield spans


class _Firsts:
    """Earliest places of the spans that a task has seen, by digest of their words.

    A span with an equal one before it is repeated as a whole, and whatever matches it
    matches the earlier one: it need not be sent. Forgetting places costs rows, not
    results, so a task remembers a bounded number.
    """

    def __init__(self, most: int):
        self.most, self.places = most, {}

    def repeated(self, digest: bytes, place: tuple[int, int, int]) -> bool:
        known = self.places.get(digest)
        if known is not None and known < place:
            return True
        if len(self.places) >= self.most:
            self.places.clear()
        self.places[digest] = place
        return False


def _add_run(runs: list[dict], begin: int, windows: int) -> None:
    """Adds a run of windows, to the last one where it continues that."""
    if runs and runs[-1]["begin"] + runs[-1]["windows"] == begin:
        runs[-1]["windows"] += windows
    else:
        runs.append({"begin": begin, "windows": windows})


def _record(rows: list[tuple], schema: list) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, (_, kind) in zip(columns, schema)], names=[n for n, _ in schema])


def _cut_spans(settings: Settings):
    """Spans with their words. Runs of those that the task knows to be repeated are listed
    in a row of their own for each text, without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = _Firsts(settings.remembered)
        for batch in batches:
            order, rows = batch.column("order").to_pylist(), batch.column("row").to_pylist()
            for spans in _named_spans(batch, "few", settings):
                found, own = [], {}
                for at, leader, low, n, words in spans:
                    content = b" ".join(words[low : low + n + settings.window - 1])
                    if firsts.repeated(xxhash.xxh3_128_digest(content), (order[at], rows[at], low)):
                        _add_run(own.setdefault(at, []), low, n)
                    else:
                        found.append((leader, order[at], rows[at], low, content, None))
                found += [(rows[at], order[at], rows[at], None, None, runs) for at, runs in own.items()]
                yield _record(found, SPANS)

    return run


def _digest_spans(settings: Settings):
    """Spans as 128-bit digests of their words, with those of their windows; repeated ones
    as in ``_cut_spans``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = _Firsts(settings.remembered)
        for batch in batches:
            order, rows = batch.column("order").to_pylist(), batch.column("row").to_pylist()
            for spans in _named_spans(batch, "many", settings):
                found, own = [], {}
                for at, _, low, n, words in spans:
                    digest = xxhash.xxh3_128_digest(b" ".join(words[low : low + n + settings.window - 1]))
                    if firsts.repeated(digest, (order[at], rows[at], low)):
                        _add_run(own.setdefault(at, []), low, n)
                        continue
                    each = [xxhash.xxh3_128_digest(b" ".join(words[i : i + settings.window])) for i in range(low, low + n)]
                    found.append((order[at], rows[at], low, digest, each, n, None))
                found += [(order[at], rows[at], None, None, None, None, runs) for at, runs in own.items()]
                yield _record(found, HOT_SPANS)

    return run


RUNS = pa.list_(pa.struct([("begin", pa.int32()), ("windows", pa.int32())]))
SPANS = [
    ("leader", pa.int64()), ("order", pa.int64()), ("row", pa.int64()), ("begin", pa.int32()), ("content", pa.binary()),
    ("own", RUNS),
]
HOT_SPANS = [
    ("order", pa.int64()), ("row", pa.int64()), ("begin", pa.int32()), ("span", pa.binary()),
    ("each", pa.list_(pa.binary())), ("windows", pa.int32()), ("own", RUNS),
]


def _match_spans(settings: Settings):
    """Rows come sorted by (leader, order, row, begin); gives the runs of repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, shard, automaton = None, set(), None
        for batch in batches:
            found = []
            for key, row, begin, content, own in zip(
                *(batch.column(c).to_pylist() for c in ("leader", "row", "begin", "content", "own"))
            ):
                if content is None:
                    found += [(row, r["begin"], r["windows"]) for r in own]
                    continue
                if key != leader:
                    leader, shard, automaton = key, {content}, None
                    continue
                words = content.split(b" ")
                if content in shard:
                    found.append((row, begin, len(words) - settings.window + 1))
                    continue
                if automaton is None:
                    automaton = SuffixAutomaton()
                    automaton.add(next(iter(shard)).split(b" "))
                matched = np.fromiter(automaton.statistics(words), dtype=np.int64, count=len(words))
                repeated = np.concatenate([[False], matched[settings.window - 1 :] >= settings.window, [False]])
                edges = np.flatnonzero(np.diff(repeated.astype(np.int8)))
                found += [(row, begin + low, high - low) for low, high in edges.reshape(-1, 2).tolist()]
                automaton.add(words)
                shard.add(content)
            row, begin, windows = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(row, pa.int64()), pa.array(begin, pa.int32()), pa.array(windows, pa.int32())],
                names=["row", "begin", "windows"],
            )

    return run


def _kept_words(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, shas = [], []
            for text, runs in zip(batch.column("text"), batch.column("runs")):
                words = text.as_py().encode().split()
                runs = np.array([(r["begin"], r["windows"]) for r in runs.as_py()], dtype=np.int64)
                keep = kept_mask(len(words), runs[:, 0], runs[:, 0] + runs[:, 1] - 1 + settings.window)
                removed.append(len(words) - int(keep.sum()))
                shas.append(hashlib.sha256(b" ".join([words[i] for i in np.flatnonzero(keep)])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(removed, pa.int64()), pa.array(shas, pa.string())],
                names=["row", "n_removed", "kept_sha256"],
            )

    return run


def kept_mask(n: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n words lie in none of the ranges from ``begins`` to before ``ends``."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, begins, 1)
    np.add.at(edges, ends, -1)
    return np.cumsum(edges[:n]) == 0


def _touched_texts(texts: DataFrame, outlines: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """First texts of their class with a leader that occurs again, and these leaders:
    in ``few`` those with few enough spans for one automaton, in ``many`` the others.

    The first texts move once, to where ("order", "text_hash") deals them. What is found
    out about them is dealt alike, so that later joins leave the texts where they are.
    """
    place = ["order", "text_hash"]
    order = F.coalesce(F.col("doc_id"), F.lit(2**63 - 1))
    firsts = outlines.select("row", order.alias("order"), "text_hash").join(classes.select("row"), "row", "left_semi")
    dealt = store_dealt(
        firsts.join(texts.withColumn("order", order).select(*place, "text"), place).dropDuplicates([*place, "row"]),
        "first_texts", *place,
    )
    listed = store(dealt.select("row", "text").mapInArrow(_leaders(settings), LEADERS), "leaders")
    listed = listed.select("row", F.inline("leaders"))
    # Stored, so that Spark can split the join of a leader that very many texts have.
    frequent = store(listed.groupBy("leader").agg(F.sum("spans").alias("n")).where("n > 1"), "shared_leaders")
    few = F.col("n") <= settings.shard_spans
    # A text names a leader once, so its lists are no longer than the text.
    wanted = listed.drop("spans").join(frequent, "leader").groupBy("row").agg(
        F.collect_set(F.when(few, F.col("leader"))).alias("few"),
        F.collect_set(F.when(~few, F.col("leader"))).alias("many"),
    )
    wanted = store_dealt(wanted.join(dealt.select(*place, "row"), "row"), "wanted_leaders", *place)
    return dealt.select(*place, "text").join(wanted, place)


def _repeated_runs(touched: DataFrame, settings: Settings) -> DataFrame:
    """(row, runs): runs (begin, windows) of windows whose words begin earlier. A row may
    come several times."""
    spans = touched.where(F.size("few") > 0).mapInArrow(
        _cut_spans(settings),
        "leader long, order long, row long, begin int, content binary, own array<struct<begin: int, windows: int>>",
    )
    matched = (
        spans.repartition(partitions(touched.sparkSession), "leader")
        .sortWithinPartitions("leader", "order", "row", "begin")
        .mapInArrow(_match_spans(settings), "row long, begin int, windows int")
    )
    many = store(
        touched.where(F.size("many") > 0).mapInArrow(
            _digest_spans(settings),
            "order long, row long, begin int, span binary, each array<binary>, windows int,"
            " own array<struct<begin: int, windows: int>>",
        ),
        "hot_spans",
    )
    listed = many.where("own IS NOT NULL").select("row", F.col("own").alias("runs"))
    many = many.where("span IS NOT NULL").drop("own")
    place = F.struct("order", "row", "begin")
    firsts = many.groupBy("span").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    firsts = store(firsts, "first_spans")
    again = many.join(firsts.where("n > 1"), "span").where(place > F.col("first"))
    # What is left differs as a span; its windows may still be equal to others.
    single = many.withColumn("first", place).join(firsts, ["span", "first"]).select(
        "order", "row", "begin", F.posexplode("each").alias("i", "window")
    ).select("order", "row", (F.col("begin") + F.col("i")).alias("begin"), "window")
    earliest = store(
        single.groupBy("window").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1"),
        "first_windows",
    )
    grouped = single.join(earliest, "window").where(place > F.col("first")).withColumn("windows", F.lit(1))
    one = F.array(F.struct("begin", "windows")).alias("runs")
    parts = [part.select("row", one) for part in (matched, again, grouped)]
    return reduce(DataFrame.union, parts, listed)


def repeated_passages(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256.

    Words are runs of anything but ASCII white space, unchanged. A window is repeated if
    its words also begin earlier: in a row with a smaller id, or earlier in the row.
    Rows without an id come after all others; different texts with one id are ordered
    by place of arrival. Rows repeated with id and words count as one document: each
    has the result of the first. A null text has no words. Other columns of the input
    are not looked at. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    outlines = store(
        texts.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_outlines(settings), OUTLINE), "outlines"
    )
    # Of equal texts the first is the class; combined before the exchange.
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    classes = store(
        outlines.where("windows > 0").groupBy("words_digest").agg(F.min(rank).alias("first"))
        .select("words_digest", F.col("first.row").alias("row"), F.col("first.doc_id").alias("first_id")),
        "text_classes",
    )
    touched = _touched_texts(texts, outlines, classes, settings)
    # A text has fewer runs than words.
    runs = _repeated_runs(touched, settings).groupBy("row").agg(
        F.flatten(F.collect_list("runs")).alias("runs")
    ).join(touched.select("row", "order", "text_hash"), "row")
    results = touched.select("order", "text_hash", "text").join(runs, ["order", "text_hash"]).select(
        "row", "text", "runs"
    ).mapInArrow(
        _kept_words(settings), "row long, n_removed long, kept_sha256 string"
    )

    first = classes.join(results, "row", "left").select(
        "words_digest", "first_id", F.col("n_removed").alias("own_removed"), "kept_sha256"
    )
    own = F.col("doc_id").eqNullSafe(F.col("first_id"))
    whole = F.col("windows") == 0
    return outlines.join(first, "words_digest", "left").select(
        "doc_id", "n_words",
        F.when(whole, F.lit(0)).when(own, F.coalesce("own_removed", F.lit(0))).otherwise(F.col("n_words"))
        .cast("long").alias("n_removed"),
        F.when(whole, F.col("words_sha256")).when(own, F.coalesce("kept_sha256", "words_sha256"))
        .otherwise(F.sha2(F.lit(b""), 256)).alias("kept_sha256"),
    )
