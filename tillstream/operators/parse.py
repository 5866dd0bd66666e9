"""JSON messages to typed transactions, with the rows that cannot be used set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.values import cut_to_millis
from tillstream.operators.computed import with_computed
from tillstream.schema import FIELDS

# Every property is read as text first: the accepted spellings of numbers and dates are wider
# than what a typed JSON read takes. One read gives names and values alike.
_JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}

# The milliseconds that fall into the years 1 to 9999.
_MIN_MS, _MAX_MS = -62135596800000, 253402300799999

_EPOCH = r"^-?[0-9]{1,18}$"
_FULL_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,9})?(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"
_SHORT_DATE = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})(?:T([0-9]{2}:[0-9]{2})(:[0-9]{2}(?:[.][0-9]{1,9})?)?)?(Z|[+-][0-9]{2}(?::?[0-9]{2})?)?$"


def _is_blank(text: Column) -> Column:
    """Empty or spelled-out null: counts as a missing value for numbers and dates."""
    return F.trim(text).isin("", "null")


def _double(text: Column) -> Column:
    """Missing is 0; unreadable or not finite is null. NaN compares above infinity."""
    number = text.try_cast("double")
    finite = F.when(F.abs(number) < float("inf"), number)
    return F.when(text.isNull() | _is_blank(text), F.lit(0.0)).otherwise(finite)


def _int(text: Column) -> Column:
    """Missing is 0, fractions are cut off; unreadable or out of range is null."""
    number = text.try_cast("double").try_cast("int")
    return F.when(text.isNull() | _is_blank(text), F.lit(0)).otherwise(number)


def _timestamp(text: Column) -> Column:
    """Epoch milliseconds or an ISO date, cut to milliseconds; UTC where no zone is given."""
    trimmed = F.trim(text)
    epoch = trimmed.try_cast("bigint")

    def part(group: int, default: str) -> Column:
        found = F.regexp_extract(trimmed, _SHORT_DATE, group)
        return F.when(found == "", default).otherwise(found)

    completed = F.concat(
        part(1, ""), F.lit("T"), part(2, "00:00"), part(3, ":00"), part(4, "Z")
    )
    return (
        F.when(
            trimmed.rlike(_EPOCH),
            F.timestamp_millis(F.when(epoch.between(_MIN_MS, _MAX_MS), epoch)),
        )
        .when(trimmed.rlike(_FULL_DATE), cut_to_millis(F.try_to_timestamp(trimmed)))
        .when(trimmed.rlike(_SHORT_DATE), cut_to_millis(F.try_to_timestamp(completed)))
    )


_CASTS = {"double": _double, "int": _int, "timestamp": _timestamp, "string": lambda text: text}


def _text(wire: str) -> str:
    return f"_text_{wire}"


def _property(name: str) -> Column:
    """The text of a property, null if it is missing; array positions count from 1."""
    return F.get("_values", (F.array_position("_keys", name) - 1).cast("int"))


def without_null_literals(df: DataFrame) -> DataFrame:
    """A message that is the JSON literal ``null`` is no transaction and no error: it is left out."""
    return df.where(F.coalesce(~F.col("value").rlike(r"^\s*null\s*$"), F.lit(True)))


def classify_messages(df: DataFrame) -> DataFrame:
    """Add the 13 typed columns and ``reason`` (null for a usable row) to every message that is not ``null``."""
    read = with_computed(
        without_null_literals(df),
        F.from_json("value", "map<string,string>", _JSON_OPTIONS).alias("_raw"),
    )
    # Reversed, so that the first place of a name is its last occurrence.
    read = with_computed(
        read,
        F.reverse(F.map_keys("_raw")).alias("_keys"),
        F.reverse(F.map_values("_raw")).alias("_values"),
    )
    # Texts first, then casts: a cast looks at its text several times.
    read = with_computed(read, *[_property(f.wire).alias(_text(f.wire)) for f in FIELDS])
    typed = with_computed(
        read, *[_CASTS[f.type](F.col(_text(f.wire))).alias(f.column) for f in FIELDS]
    )

    known = F.array(*[F.lit(f.wire) for f in FIELDS])
    raw_date = F.col(_text("transactionDate"))
    bad_number = (
        F.col("product_price").isNull()
        | F.col("product_quantity").isNull()
        | F.col("total_amount").isNull()
    )
    reason = (
        F.when(F.col("_raw").isNull(), "corrupt")
        .when(F.size(F.array_except("_keys", known)) > 0, "unknown_property")
        .when(bad_number, "bad_number")
        .when(raw_date.isNull() | _is_blank(raw_date), "null_event_time")
        .when(F.col("transaction_date").isNull(), "bad_date")
        .when(F.col("customer_id").isNull(), "null_customer")
        .when(F.col("product_category").isNull(), "null_category")
        .when(F.col("transaction_id").isNull(), "null_id")
    )
    classified = typed.withColumn("reason", reason).drop("_raw", "_keys", "_values", *(_text(f.wire) for f in FIELDS))
    # What could be read of a broken text is no data.
    whole = F.coalesce(F.col("reason") != "corrupt", F.lit(True))
    return classified.withColumns({f.column: F.when(whole, F.col(f.column)) for f in FIELDS})


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reason").isNull()).drop("value", "reason")


def rejected(classified: DataFrame) -> DataFrame:
    kept = [c for c in classified.columns if c not in {f.column for f in FIELDS}]
    return classified.where(F.col("reason").isNotNull()).select(*kept)


def parse_transactions(df: DataFrame, mode: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """Split messages (column ``value``, any others kept) into transactions and rejects.

    ``quarantine`` returns the unusable messages with the reason; ``failfast`` makes the first
    one fail the job.
    """
    if mode not in ("quarantine", "failfast"):
        raise ValueError(f"unknown mode {mode!r}")
    classified = classify_messages(df)
    if mode == "quarantine":
        return accepted(classified), rejected(classified)
    error = F.raise_error(F.concat(F.lit("unusable message: "), F.col("reason")))
    checked = classified.where(
        F.when(F.col("reason").isNull(), True).otherwise(error.cast("boolean"))
    )
    return checked.drop("value", "reason"), rejected(classified)
