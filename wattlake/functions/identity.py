"""Row identifiers."""

from pyspark.sql import Column, functions as F


def stable_id(*columns: Column) -> Column:
    """Same input, same id: a retried task or a replayed batch writes equal rows.

    Nulls take part as an empty field, so they do not shift the later ones.
    """
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)
