"""Validation of station-status events as column expressions over a variant.

An event is valid or has the reason of the first rule it breaks, in this order: JSON
text, JSON object, station id, each count, each flag, snapshot timestamp. A faulty
last_reported never rejects an event, it becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velolake.functions.text import is_blank
from velolake.schemas import COUNT_FIELDS, DEAD_LETTERS, FLAG_FIELDS, RAW_STATION_STATUS

# Error reasons, the source name, and the smallest plausible epoch second.
NOT_JSON = "Payload bukan JSON."
NOT_AN_OBJECT = "Payload harus berupa JSON object."
INVALID_STATION = "station_id tidak valid."
NOT_AN_INTEGER = "{} harus integer."
NEGATIVE = "{} tidak boleh negatif."
NOT_A_FLAG = "{} harus 0 atau 1."
NO_TIMESTAMP = "snapshot_timestamp tidak tersedia."
INVALID_TIMESTAMP = "snapshot_timestamp tidak valid."
DEAD_LETTER_SOURCE = "gbfs_station_status"
EPOCH_SECONDS_ABOVE = 1_000_000_000
EPOCH_SECONDS_BELOW = 253_402_300_800  # the year 10000

# A JSON text that starts like this is an object, if it is JSON at all.
OBJECT_START = r"^[ \t\r\n]*\{"

# ISO-8601 texts: the usual form, and every accepted one (week dates are not). Groups of the second: 1 year,
# 3 month, 4 day, 5 hour, 7 minute, 8 second, 9 fraction, 10 offset; 2 and 6 are separators.
USUAL_ISO = r"^(?!0000)\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})?)?\z"
ANY_ISO = (
    r"^(?!0000)(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:Z|[^Z](\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d{1,6})\d*)?)?)?(Z|[+-]\d{2}(?::?\d{2})?)?)?\z"
)

FIELDS = ("station_id", *COUNT_FIELDS, *FLAG_FIELDS, "snapshot_timestamp", "last_reported")


def validate_events(messages: DataFrame, *keep: str, detected_at: Column | None = None,
                    metrics: str = "event_validation") -> DataFrame:
    """Messages with the event's columns, `raw_payload` and `error_reason` (NULL if valid).

    The message is the text or binary column `value`. Each variant is parsed once and each
    field taken out once; the projections are stacked so that later ones refer to them.
    `keep` names columns to carry along; `detected_at` defaults to the current time.

    The observed `metrics` count events and dead letters; the name must be unique among the
    validated inputs of one query. Observing also keeps the optimizer from moving a filter on the reason below the validation, where the
    parsing would be repeated for the filter.
    """
    payload, text = _payload_and_text(messages)
    parsed = messages.select(
        *keep,
        payload.alias("raw_payload"),
        F.try_parse_json(text).alias("event"),
        text.rlike(OBJECT_START).alias("is_object"),
        (F.current_timestamp() if detected_at is None else detected_at).alias("detected_at"),
    )
    opened = parsed.select(
        *keep, "raw_payload", "detected_at",
        F.when(F.col("event").isNull(), NOT_JSON).when(~F.col("is_object"), NOT_AN_OBJECT).alias("shape_error"),
        *[F.try_variant_get("event", f"$.{name}", "variant").alias(name) for name in FIELDS],
    )
    typed = opened.select(
        *keep, "raw_payload", "detected_at", "shape_error",
        *[F.try_variant_get(name, "$", kind).alias(name) for name, kind in _value_types().items()],
        *[F.schema_of_variant(name).alias(f"{name}_type") for name in FIELDS],
    )
    timed = typed.select("*", _instant(F.col("snapshot_timestamp")).alias("instant"))
    reason = F.coalesce(F.col("shape_error"), _field_error(F.col("instant")))
    epoch = F.col("last_reported")
    plausible = (F.col("last_reported_type") == "BIGINT") & (epoch > EPOCH_SECONDS_ABOVE) & (epoch < EPOCH_SECONDS_BELOW)
    validated = timed.select(
        *keep,
        "raw_payload",
        reason.alias("error_reason"),
        "station_id",
        *COUNT_FIELDS,
        *[(F.col(name) == 1).alias(name) for name in FLAG_FIELDS],
        F.when(plausible, F.timestamp_seconds(epoch)).alias("last_reported"),
        F.col("instant").alias("snapshot_timestamp"),
        "detected_at",
    )
    return validated.observe(
        metrics, F.count(F.lit(1)).alias("events"), F.count("error_reason").alias("dead_letters")
    )


def valid_events(validated: DataFrame) -> DataFrame:
    """Valid events in the schema of the raw status table."""
    columns = [name for name in RAW_STATION_STATUS.names if name != "_ingested_at"]
    return validated.where(F.col("error_reason").isNull()).select(*columns, F.col("detected_at").alias("_ingested_at"))


def dead_letters(validated: DataFrame) -> DataFrame:
    """Rejected events in the schema of the dead-letter table."""
    return validated.where(F.col("error_reason").isNotNull()).select(
        F.uuid().alias("error_id"),
        "raw_payload",
        "error_reason",
        F.lit(DEAD_LETTER_SOURCE).alias("source"),
        "detected_at",
    ).select(*DEAD_LETTERS.names)


def _payload_and_text(messages: DataFrame) -> tuple[Column, Column]:
    """The payload to keep with a dead letter, and the text to parse (NULL if undecodable)."""
    value = F.col("value")
    if isinstance(messages.schema["value"].dataType, T.BinaryType):
        text = F.when(F.is_valid_utf8(value.cast("string")), value.cast("string"))
        return F.when(F.length(text) > 0, text).otherwise(bytes_literal(value)), text
    return F.when(value != "", value).otherwise("b''"), value


def bytes_literal(value: Column) -> Column:
    """Bytes written as b'...' with escapes, for payloads that are empty or no text."""
    quote = F.when(_has_byte(value, "27") & ~_has_byte(value, "22"), '"').otherwise("'")

    def escaped(pair: Column) -> Column:
        code = F.conv(pair, 16, 10).cast("int")
        return (
            F.when(code == 9, "\\t").when(code == 10, "\\n").when(code == 13, "\\r").when(code == 92, "\\\\")
            .when((code == 39) & (quote == "'"), "\\'")
            .when(code.between(32, 126), F.char(code))
            .otherwise(F.concat(F.lit("\\x"), F.lower(pair)))
        )

    return F.concat(F.lit("b"), quote, F.array_join(F.transform(_byte_pairs(value), escaped), ""), quote)


def _byte_pairs(value: Column) -> Column:
    return F.regexp_extract_all(F.hex(value), F.lit("(..)"), F.lit(1))


def _has_byte(value: Column, pair: str) -> Column:
    return F.array_contains(_byte_pairs(value), pair)


def _value_types() -> dict[str, str]:
    """The type to read each field as; flags may be numbers or booleans, so they are numbers."""
    kinds = {name: "bigint" for name in COUNT_FIELDS} | {name: "double" for name in FLAG_FIELDS}
    return {"station_id": "string", **kinds, "snapshot_timestamp": "string", "last_reported": "bigint"}


def _given(name: str) -> Column:
    """The event has the field and its value is not null."""
    return F.col(f"{name}_type").isNotNull() & (F.col(f"{name}_type") != "VOID")


def _field_error(instant: Column) -> Column:
    """The reason of the first broken field rule, or NULL."""
    station, snapshot = F.col("station_id"), F.col("snapshot_timestamp")
    is_text = F.coalesce(F.col("station_id_type") == "STRING", F.lit(False))
    rules = F.when(~is_text | is_blank(station), INVALID_STATION)
    for name in COUNT_FIELDS:
        rules = rules.when(_given(name) & (F.col(f"{name}_type") != "BIGINT"), NOT_AN_INTEGER.format(name))
        rules = rules.when(_given(name) & (F.col(name) < 0), NEGATIVE.format(name))
    for name in FLAG_FIELDS:
        kind = F.col(f"{name}_type")
        numeric = kind.isin("BOOLEAN", "BIGINT", "DOUBLE") | kind.startswith("DECIMAL")
        is_flag = numeric & F.coalesce(F.col(name).isin(0.0, 1.0), F.lit(False))
        rules = rules.when(_given(name) & ~is_flag, NOT_A_FLAG.format(name))
    absent = ~_given("snapshot_timestamp") | _is_falsy(snapshot)
    return rules.when(instant.isNull(), F.when(absent, NO_TIMESTAMP).otherwise(INVALID_TIMESTAMP))


def _is_falsy(snapshot: Column) -> Column:
    """Empty text, false, zero, [] and {}; the texts "0" and "false" are not falsy."""
    kind = F.col("snapshot_timestamp_type")
    zero = kind.rlike("^(BIGINT|DOUBLE|DECIMAL.*)$") & (snapshot.try_cast("double") == 0)
    return F.coalesce(
        ((kind == "STRING") & (snapshot == ""))
        | ((kind == "BOOLEAN") & (snapshot == "false"))
        | zero
        | (kind.startswith("ARRAY") & (snapshot == "[]"))
        | (kind.startswith("OBJECT") & (snapshot == "{}")),
        F.lit(False),
    )


def _instant(snapshot: Column) -> Column:
    """The instant of an ISO-8601 text, in UTC if it names no zone; NULL if it is none.

    The patterns come first because the conversion alone also takes a bare year or time.
    """
    return F.when(snapshot.rlike(USUAL_ISO), F.try_to_timestamp(snapshot)).when(
        snapshot.rlike(ANY_ISO), F.try_to_timestamp(_usual_iso(snapshot))
    )


def _usual_iso(snapshot: Column) -> Column:
    """Rewrite any accepted form as date, time with microseconds, and offset."""

    def part(group: int, width: int = 2) -> Column:
        return F.rpad(F.regexp_extract(snapshot, ANY_ISO, group), width, "0")

    offset = F.regexp_extract(snapshot, ANY_ISO, 10)
    minutes = F.rpad(F.regexp_replace(F.substring(offset, 4, 3), ":", ""), 2, "0")
    return F.concat(
        F.concat_ws("-", part(1, 4), part(3), part(4)), F.lit("T"),
        F.concat_ws(":", part(5), part(7), part(8)), F.lit("."), part(9, 6),
        F.when(offset.isin("", "Z"), offset).otherwise(F.concat(F.substring(offset, 1, 3), F.lit(":"), minutes)),
    )
