"""JSON events to typed rows, and the rows that cannot be used."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wattlake import vocabulary as V
from wattlake.functions.lenient import finite, flag, instant, number, zero_if_null


def _arrivals(events: DataFrame, arrival: str | None) -> DataFrame:
    """Message text with its place and time. ``arrival`` names the column of the
    time; by default it is the time of the batch.

    The stamp belongs here, on the stream: inside foreachBatch every action
    would see another time.
    """
    return events.select(
        F.col("value").cast("string").alias("raw"),
        F.col("topic"),
        (F.current_timestamp() if arrival is None else F.col(arrival)).alias("processing_time"),
        F.col("partition").alias("arrival_partition"),
        F.col("offset").alias("arrival_offset"),
    )


def _with_fields(
    rows: DataFrame, message: Column, schema: T.StructType, suffix: str = ""
) -> DataFrame:
    """Adds the fields of one message per row, those of a nested struct too.

    By generators, because a filter on a plain from_json column is pushed below
    the projection and then parses the text again for every condition.
    """
    rows = rows.select("*", _spread(message, schema, suffix))
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType):
            name = field.name + suffix
            rows = rows.select("*", _spread(F.col(name), field.dataType, suffix)).drop(name)
    return rows


def _spread(struct: Column, schema: T.StructType, suffix: str) -> Column:
    return F.inline_outer(F.array(struct)).alias(*[name + suffix for name in schema.names])


def _read(rows: DataFrame, typed, texts: list[str], as_text, casts: dict, strict: bool):
    """Rows with the message fields, those in ``casts`` as numbers or flags.

    Messages are read with typed fields. Only one that does not fit, such as a
    number sent as text, is read again with text fields and cast.
    """
    whole = V.message(typed, texts)
    rows = _with_fields(rows, F.from_json("raw", whole), whole)
    if strict:
        return rows
    again = F.when(F.col(V.CORRUPT).isNotNull(), F.from_json("raw", as_text))
    rows = _with_fields(rows, again, as_text, "_text")
    return rows.withColumns({
        name: F.coalesce(F.col(name), cast(F.col(f"{name}_text"))) for name, cast in casts.items()
    })


def _tail() -> list[Column]:
    unreadable = F.col(V.CORRUPT).isNotNull() & F.col("zone").isNull()
    return [
        F.col("processing_time"), F.col("arrival_partition"), F.col("arrival_offset"),
        F.col("topic"), F.col("raw"),
        (F.col("raw").isNull() | unreadable).alias("malformed"),
    ]


def parse_mix(
    events: DataFrame, breakdown: str = "production", arrival: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Typed mix rows; what is absent or badly typed is null, no row is dropped.

    ``breakdown`` names the one that fills the source columns: ``production`` or
    ``consumption``. ``strict`` takes numbers only where JSON has a number; by
    default text such as "12.5" counts too.
    """
    block = V.BREAKDOWNS[breakdown]
    names = {
        **{json_name: silver for json_name, silver, _ in V.TOTALS},
        **{source: source for source in V.GOLD_SOURCES},
        **dict(V.PERCENTAGES),
    }
    rows = _read(
        _arrivals(events, arrival), V.mix_numbers(block, T.DoubleType()), V.MIX_TEXTS,
        V.mix_numbers(block, T.StringType()), {name: number for name in names}, strict,
    )
    return rows.select(
        "zone", instant(F.col("datetime")).alias("datetime"),
        *[finite(F.col(json_name)).alias(silver) for json_name, silver in names.items()],
        *_tail(),
    )


def parse_carbon(
    events: DataFrame, arrival: str | None = None, strict: bool = False
) -> DataFrame:
    rows = _read(
        _arrivals(events, arrival), V.carbon_measures(T.DoubleType(), T.BooleanType()),
        V.CARBON_TEXTS, V.carbon_measures(T.StringType(), T.StringType()),
        {"carbonIntensity": number, "isEstimated": flag}, strict,
    )
    return rows.select(
        "zone", instant(F.col("datetime")).alias("datetime"),
        finite(F.col("carbonIntensity")).alias("carbon_intensity"),
        F.col("emissionFactorType").alias("emission_factor_type"),
        F.col("isEstimated").alias("is_estimated"),
        F.col("estimationMethod").alias("estimation_method"),
        *_tail(),
    )


def parse_paths(events: DataFrame, paths: dict[str, str], numbers: set[str] = frozenset()) -> DataFrame:
    """Ad-hoc extraction: ``{column: JSON path}``, e.g. ``$.a.b`` or ``$.a['b c']``.

    Each text is parsed once, into a variant from which all paths are taken. A text that
    is no JSON, or that names a field twice, has no values; a value of another type is
    null where a number is wanted and its JSON text elsewhere.
    """
    parsed = events.select("partition", "offset", F.try_parse_json(F.col("value").cast("string")).alias("parsed"))
    columns = [
        F.try_variant_get("parsed", path, "double" if name in numbers else "string").alias(name)
        for name, path in paths.items()
    ]
    return parsed.select("partition", "offset", *columns).withColumns(
        {name: finite(F.col(name)) for name in paths if name in numbers}
    )


def display_rows(events: DataFrame, arrival: str | None = None) -> DataFrame:
    """Console vocabulary of the mix; rows without an event time are left out."""
    texts = _arrivals(events, arrival).filter(F.col("raw").isNotNull())
    rows = _with_fields(texts, F.from_json("raw", V.DISPLAY_MESSAGE), V.DISPLAY_MESSAGE)
    return rows.select(
        F.coalesce(F.col("zone"), F.lit(V.UNKNOWN_DISPLAY_REGION)).alias("region"),
        instant(F.col("datetime")).alias("date_heure"),
        *[zero_if_null(finite(F.col(source))).alias(name) for source, name in V.DISPLAY_SOURCES.items()],
        "processing_time",
    ).filter(F.col("date_heure").isNotNull())


def reject_reason(value: str | None) -> Column:
    """Why a parsed row cannot reach gold; null for a good row.

    A message with one badly typed field is not rejected, that field is null. The
    direct path keeps rows without a value: it names none. An empty zone is none.
    """
    reason = F.when(F.col("malformed"), "malformed").when(
        F.col("zone").isNull() | (F.col("zone") == ""), "no_zone")
    if value is not None:
        reason = reason.when(F.col(value).isNull(), "no_value")
    return reason.when(F.col("datetime").isNull(), "no_event_time")


def without_good_text(parsed: DataFrame, value: str | None) -> DataFrame:
    """Keeps the text of rejected rows only: all that is held until both sinks
    have their rows."""
    return parsed.withColumn("raw", F.when(reject_reason(value).isNotNull(), F.col("raw")))


def quarantine(parsed: DataFrame, value: str | None) -> DataFrame:
    """Rows that never reach gold, whole text kept, with the reason."""
    return (
        parsed.withColumn("reason", reject_reason(value))
        .filter(F.col("reason").isNotNull())
        .select("topic", "reason", "raw", "processing_time", *V.ARRIVAL)
    )
