"""A bounded sample of labelled documents to learn from."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import store


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a row without an id."""
    return F.pmod(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")), F.lit(folds))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_class: dict[int, int],
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` documents of each class.

    Taken in the order of a hash of the id, so the choice is the same in every run. Ids
    of the held-out fold, null labels and contradictory labels of one id are left out.
    Of the rows with one id that with the smallest hash of its text is taken, whatever
    their number: it is found among hashes, one for each task that has such rows.
    """
    usable = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .where(fold("doc_id", folds) != held_out)
        .groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("other"))
        .where("label = other").drop("other")
    )
    chosen = None
    for value, most in sorted(per_class.items()):
        part = usable.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = part if chosen is None else chosen.unionAll(part)
    # No more rows than per_class sums up to.
    chosen = F.broadcast(store(chosen, "sample_ids"))
    named = docs.select("doc_id", F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    # No more rows than ids were chosen, so these can be sent again.
    first = store(
        named.select("doc_id", "text_hash").join(chosen, "doc_id").groupBy("doc_id").agg(
            F.min("text_hash").alias("text_hash"), F.first("label").alias("label")
        ),
        "sample_texts",
    )
    # Repeated rows with one text: one of them for each task, then one.
    return named.join(F.broadcast(first), ["doc_id", "text_hash"]).select("doc_id", "text", "label")


def rows_of_sample(counted: DataFrame, batch_bytes: int = 1 << 28):
    """Rows (doc_id, label, ...) of a sample, one for each id, to the driver. They are
    written to the shared folder first; the driver reads them in pieces by a hash of the
    id, each of about ``batch_bytes`` at most."""
    binary = [f.name for f in counted.schema.fields if f.dataType.typeName() == "binary"]
    counted = store(counted.dropDuplicates(["doc_id"]), "sample_counts")
    size = counted.agg(F.sum(sum((F.octet_length(c) for c in binary), F.lit(0)))).first()[0] or 0
    pieces = size // batch_bytes + 1
    for piece in range(pieces):
        yield from counted.where(F.pmod(F.xxhash64("doc_id"), F.lit(pieces)) == piece).collect()
