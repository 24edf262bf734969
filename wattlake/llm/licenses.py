"""License notices found by diagonal voting.

Every k consecutive words of every document are hashed and joined by Spark to the
places of the same k words in the license templates. Words of a notice that is copied
into a document keep their distance from the template, so the joined rows of one notice
share a diagonal (place in the document minus place in the template). Rows are counted
by diagonal; neighbouring diagonals, which words put in or left out make, are merged;
and a merged span is verified by the share of the template's words that it covers.

The phrases of the contract are templates too, of grams of two words. They count word for
word only: a place of a phrase is one diagonal that has all of its grams.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.llm.common import store
from wattlake.llm.words import Words, chunks, grams

#: Bytes between words: all of ASCII but digits and lower-case letters.
SEPARATORS = np.array([b < 128 and not (48 <= b <= 57 or 97 <= b <= 122) for b in range(256)])

# Phrases of the contract with their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Words of a gram of a phrase.
PHRASE_GRAM = 2

# Public notices that license texts ask to be put into files, by label.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
     " compliance with the License. You may obtain a copy of the License at"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is"
     " distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
     " documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
     " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
     " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
     " to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above"
     " copyright notice and this permission notice shall be included in all copies or substantial portions of the"
     " Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT"
     " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT"
     " SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION"
     " OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
     " DEALINGS IN THE SOFTWARE."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
     " hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
     " that the following conditions are met"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
     " that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,"
     " this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above"
     " copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
     " materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS"
     " \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF"
     " MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
     " General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU"
     " General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
)


@dataclass(frozen=True)
class Settings:
    gram: int = 3
    #: Diagonals this far apart belong to one span.
    slack: int = 3
    #: Smallest share of a template's words in a span.
    share: float = 0.8
    templates: tuple[tuple[str, str], ...] = TEMPLATES


def _words(texts: list[str]) -> Words:
    (_, _, words), = chunks(pa.array(texts), lower=True, separators=SEPARATORS)
    return words


def template_grams(spark: SparkSession, settings: Settings) -> DataFrame:
    """(gram, template, place) of all templates, and of the phrases by numbers from -1
    down: some thousand rows, fixed by the lists. The size of a gram is part of its hash."""
    rows = []
    listed = [(number, text, settings.gram) for number, (_, text) in enumerate(settings.templates)]
    listed += [(-1 - number, text, PHRASE_GRAM) for number, (text, _) in enumerate(PHRASES)]
    for number, text, k in listed:
        hashes = grams(_words([text]).hashes, k).view(np.int64)
        rows += [(int(h), number, place) for place, h in enumerate(hashes)]
    return spark.createDataFrame(rows, "gram long, template int, place int")


SUMMARY = pa.struct([("doc_id", pa.int64()), ("n_words", pa.int64())])
ROLLED = "row long, at int, gram long, summary struct<doc_id: long, n_words: long>"


def _roll(settings: Settings):
    """For each text a row with its number of words, and a row for each k consecutive words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids = batch.column("row").to_numpy(), batch.column("doc_id")
            for begin, end, words in chunks(batch.column("text"), lower=True, separators=SEPARATORS):
                lengths = np.diff(words.first)
                text = np.repeat(np.arange(end - begin), lengths)
                for k in sorted({settings.gram, PHRASE_GRAM}):
                    rolled = grams(words.hashes, k)
                    inside = np.flatnonzero(text[: len(rolled)] == text[len(text) - len(rolled) :])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(rows[begin + text[inside]]),
                            pa.array((inside - words.first[text[inside]]).astype(np.int32)),
                            pa.array(rolled[inside].view(np.int64)), pa.nulls(len(inside), SUMMARY),
                        ],
                        names=["row", "at", "gram", "summary"],
                    )
                own = pa.StructArray.from_arrays(
                    [ids.slice(begin, end - begin), pa.array(lengths, pa.int64())], fields=list(SUMMARY)
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[begin:end]), pa.nulls(end - begin, pa.int32()), pa.nulls(end - begin, pa.int64()), own],
                    names=["row", "at", "gram", "summary"],
                )

    return run


def license_votes(docs: DataFrame, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    """Rows of the texts' summaries, and of the k-grams that are in a template."""
    texts = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row")
    )
    known = F.broadcast(template_grams(docs.sparkSession, settings))
    joined = texts.mapInArrow(_roll(settings), ROLLED).join(known, "gram", "left")
    return store(joined.where("template IS NOT NULL OR summary IS NOT NULL").drop("gram"), "license_votes")


def phrase_places(votes: DataFrame) -> DataFrame:
    """Per text with a phrase: row, n_base, first_word, last_word, base_labels."""
    wanted = F.array(*[F.lit(len(grams(_words([text]).hashes, PHRASE_GRAM))) for text, _ in PHRASES])
    labels = F.array(*[F.lit(label) for _, label in PHRASES])
    number = -1 - F.col("template")
    # A gram that stands twice in a phrase would have two places on different diagonals.
    places = votes.where("template < 0").groupBy("row", "template", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.count("*").alias("grams")
    ).where(F.col("grams") == F.get(wanted, number))
    return places.groupBy("row").agg(
        F.count("*").alias("n_base"), F.min("diagonal").cast("long").alias("first_word"),
        F.max("diagonal").cast("long").alias("last_word"), F.collect_set(F.get(labels, number)).alias("base_labels"),
    )


def license_spans(votes: DataFrame, settings: Settings) -> DataFrame:
    """Verified spans: row, label, first_word, end_word, score."""
    k = settings.gram
    diagonals = votes.where("template >= 0").groupBy(
        "row", "template", (F.col("at") - F.col("place")).alias("diagonal")
    ).agg(F.min("at").alias("low"), F.max("at").alias("high"), F.collect_set("place").alias("places"))
    near = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(near) > settings.slack, F.lit(True))
    merged = (
        diagonals.withColumn("span", F.sum(apart.cast("int")).over(near))
        .groupBy("row", "template", "span")
        .agg(F.min("low").alias("first_word"), (F.max("high") + k).alias("end_word"),
             F.flatten(F.collect_list("places")).alias("places"))
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + (k - 1))))))
    sizes = F.array(*[F.lit(len(_words([text]).hashes)) for _, text in settings.templates])
    labels = F.array(*[F.lit(label) for label, _ in settings.templates])
    return merged.select(
        "row", F.get(labels, F.col("template")).alias("label"), "first_word", "end_word",
        (covered / F.get(sizes, F.col("template"))).alias("score"),
    ).where(F.col("score") >= settings.share)


def scan_licenses(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, spans.

    Words are runs of digits, letters and anything beyond ASCII, A-Z lower-cased; a null
    text counts as empty. ``n_base`` counts all places of the phrases; labels are joined
    by commas. ``score`` is 1 with a phrase, else the largest share of a template that a
    span covers, else 0. ``spans`` lists the verified spans (label, first word, word
    after the last, score). Repeated rows and rows without an id are reported each.
    Very long texts are read whole, and every gram of a text is one row of the join.
    Other columns of the input are not looked at. An empty table gives no rows.
    """
    votes = license_votes(docs, settings, id_col, text_col)
    found = license_spans(votes, settings).groupBy("row").agg(
        F.collect_set("label").alias("more"),
        F.max("score").alias("best"),
        F.array_sort(F.collect_list(F.struct("first_word", "end_word", "label", "score"))).alias("spans"),
    )
    base = F.coalesce("base_labels", F.array())
    rows = votes.where("summary IS NOT NULL").select("row", "summary.*")
    return rows.join(phrase_places(votes), "row", "left").join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("more", F.array()))), ",").alias("labels"),
        F.when(F.size(base) > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        "spans",
    )
