"""JSON wire codec: omit-empty encoding, lenient and strict decoding, required-field parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schema import CORRUPT, LOCATION, PROFILE, STRING_FIELDS, UNKNOWN_DATE
from .barrier import computed

PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


# A result record sent back as input carries its score; the field is known but not stored.
KNOWN_FIELDS = PROFILE.fieldNames() + ["score"]


def _decoding_schema(schema: T.StructType) -> T.StructType:
    """Schema to parse with. Strings are read as variants, because a plain string column would
    also take numbers and objects, as their text."""
    fields = [
        T.StructField(f.name, T.VariantType() if f.name in STRING_FIELDS else f.dataType)
        for f in schema
    ]
    return T.StructType(fields + [
        T.StructField("score", T.DoubleType()), T.StructField(CORRUPT, T.StringType())])


def _string(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _usable(record: Column) -> Column:
    """The text was an object, every number had its type, and string fields hold strings or null."""
    good = record.isNotNull() & record[CORRUPT].isNull()
    for name in STRING_FIELDS:
        good = good & F.coalesce(F.schema_of_variant(record[name]), F.lit("VOID")).isin("STRING", "VOID")
    return good


def encode(columns: list[str] | None = None) -> Column:
    """JSON text of a profile row.

    Nulls are left out; so are zeros in ``id``, ``country`` and the coordinates, which the wire
    format cannot tell from absent. Empty strings and zeros in nullable fields are kept.
    """
    parts = []
    for name in columns or PROFILE.fieldNames():
        if name in ("id", "country"):
            parts.append(F.nullif(F.col(name), F.lit(0)).alias(name))
        elif name == "location":
            point = F.struct(
                F.nullif(F.col("location.lon"), F.lit(0.0)).alias("lon"),
                F.nullif(F.col("location.lat"), F.lit(0.0)).alias("lat"),
            )
            parts.append(F.when(F.col("location").isNotNull(), point).alias(name))
        else:
            parts.append(F.col(name))
    return F.to_json(F.struct(*parts))


def _unknown_fields(body: Column) -> Column:
    outer = F.array_except(F.json_object_keys(body), F.array(*map(F.lit, KNOWN_FIELDS)))
    inner_keys = F.json_object_keys(F.get_json_object(body, "$.location"))
    inner = F.array_except(
        F.coalesce(inner_keys, F.array().cast("array<string>")),
        F.array(*map(F.lit, LOCATION.fieldNames())),
    )
    return (F.size(outer) > 0) | (F.size(inner) > 0)


def _profile(record: Column, zeros: tuple[str, ...]) -> Column:
    """Parsed record as a profile; absent numbers in ``zeros`` and absent coordinates read as zero."""
    point = record["location"]
    fields = []
    for name in PROFILE.fieldNames():
        if name in zeros:
            fields.append(F.coalesce(record[name], F.lit(0)).alias(name))
        elif name in STRING_FIELDS:
            fields.append(_string(record[name]).alias(name))
        elif name == "location":
            filled = F.struct(
                F.coalesce(point["lon"], F.lit(0.0)).alias("lon"),
                F.coalesce(point["lat"], F.lit(0.0)).alias("lat"),
            )
            fields.append(F.when(point.isNotNull(), filled).alias(name))
        else:
            fields.append(record[name].alias(name))
    return F.struct(*fields)


def one_value(body: Column) -> Column:
    """Whether the whole text is one JSON value, with nothing but white space around it.

    A text that ends an array it is put into ends it at the same place whatever follows. So it is one value if it
    makes an array of one member by itself and one of two with a member after it; no text is special.
    """
    alone = F.json_array_length(F.concat(F.lit("["), body, F.lit("]")))
    followed = F.json_array_length(F.concat(F.lit("["), body, F.lit(",0]")))
    return F.coalesce((alone == 1) & (followed == 2), F.lit(False))


def outer_trim(body: Column) -> Column:
    """The text without the white space that JSON allows around a value."""
    return F.btrim(body, F.lit(" \t\r\n"))


def fold_keys(body: Column) -> Column:
    """Known field names that are written in another case, in lower case.

    Quotes inside a JSON string are escaped, so a quoted name before a colon is a key.
    """
    names = [*KNOWN_FIELDS, *LOCATION.fieldNames()]
    folded = body
    for name in names:
        folded = F.regexp_replace(folded, f'(?i)"{name}"(\\s*:)', f'"{name}"$1')
    odd = body.rlike('"(?=[a-zA-Z]*[A-Z])(?i:' + "|".join(names) + ')"\\s*:')
    return F.when(odd, folded).otherwise(body)


def parse(body: Column, unknown_fields: str = "reject") -> Column:
    """JSON text as a raw record, for :func:`checked`; field names count in any case unless unknown ones are refused."""
    return F.from_json(fold_keys(body) if unknown_fields == "ignore" else body, _decoding_schema(PROFILE), PERMISSIVE)


def checked(record: Column, body: Column, unknown_fields: str = "ignore") -> Column:
    """Profile struct from a raw record and its text, or null when the text is no valid profile.

    ``ignore`` drops unknown fields, takes field names in any case, refuses text after the record and reads absent ``id``/``country``/coordinates as zero.
    ``reject`` treats a record with an unknown field (also inside ``location``) as undecodable and
    leaves an absent country null, so that it is skipped by grouped counts.
    """
    if unknown_fields not in ("ignore", "reject"):
        raise ValueError(f"unknown_fields must be 'ignore' or 'reject', not {unknown_fields!r}")
    valid = _usable(record)
    if unknown_fields == "reject":
        valid = valid & ~F.coalesce(_unknown_fields(body), F.lit(True))
        return F.when(valid, _profile(record, ("id",)))
    valid = valid & outer_trim(body).endswith("}") & one_value(body)
    return F.when(valid, _profile(record, ("id", "country")))


def decode_messages(messages: DataFrame, value: str = "value",
                    unknown_fields: str = "ignore") -> tuple[DataFrame, DataFrame]:
    """Split a message stream into decoded profiles (plus message columns) and dead letters.

    Both results are map-only and work on batch and streaming input alike.
    """
    body = F.col(value).cast("string")
    parsed = computed(messages, parse(body, unknown_fields).alias("_raw"))
    decoded = computed(
        parsed, checked(F.col("_raw"), body, unknown_fields).alias("_record"), keep=messages.columns)
    kept = [c for c in messages.columns if c != value]
    good = decoded.where(F.col("_record").isNotNull()).select(*kept, "_record.*")
    dead = decoded.where(F.col("_record").isNull()).drop("_record")
    return good, dead


def known_date(text: Column) -> Column:
    """The date text, or null where it is the unknown-date marker."""
    return F.nullif(text, F.lit(UNKNOWN_DATE))


def to_serving(profiles: DataFrame) -> DataFrame:
    """Profile rows with ``dob`` as a date; unknown or malformed dates become null."""
    return profiles.withColumn("dob", F.try_to_date(known_date(F.col("dob")), "yyyy-MM-dd"))


# Fields a strictly parsed record must carry, in the order they are read.
REQUIRED_FIELDS = [
    "id", "weight", "height", "nickname", "country", "city", "caption",
    "location.lat", "location.lon", "gender",
]


def _loose_schema() -> T.StructType:
    """Profile schema with every number read as a double."""
    return T.StructType([
        T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, (T.LongType, T.IntegerType))
                      else f.dataType)
        for f in PROFILE
    ])


def parse_required(records: DataFrame, body: str = "value", fail_fast: bool = False) -> DataFrame:
    """Add ``record`` and ``reason`` to rows of JSON text.

    All fields except ``email`` and ``dob`` are required; fractions in integer fields are cut off.
    ``reason`` is ``not_a_record`` or ``missing_<field>`` for the first missing field, null when the
    record is usable. ``fail_fast`` raises on the first unusable record instead.
    """
    text = F.col(body)
    parsed = computed(records, F.from_json(text, _decoding_schema(_loose_schema()), PERMISSIVE).alias("_p"))
    p = F.col("_p")
    reason = F.when(~_usable(p), F.lit("not_a_record"))
    for name in REQUIRED_FIELDS:
        value = _string(p[name]) if name in STRING_FIELDS else F.col(f"_p.{name}")
        reason = reason.when(value.isNull(), F.lit("missing_" + name.replace(".", "_")))
    if fail_fast:
        reason = F.when(reason.isNotNull(), F.raise_error(F.concat(F.lit("unusable record: "), reason)))

    fields = [
        p[f.name].try_cast(f.dataType).alias(f.name)
        if isinstance(f.dataType, (T.LongType, T.IntegerType))
        else (_string(p[f.name]) if f.name in STRING_FIELDS else p[f.name]).alias(f.name)
        for f in PROFILE
    ]
    record = F.when(reason.isNull(), F.struct(*fields))
    return computed(parsed, reason.alias("reason"), record.alias("record"), keep=records.columns)
