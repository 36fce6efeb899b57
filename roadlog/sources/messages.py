"""Raw message folders: framing, decoding, envelope, calendar.

A message is a JSON object ``{"timestamp": <epoch ms>, "value": {...}}``.  The
same functions serve the batch reader and the streaming ingest: each stage is a
narrow transformation, so a whole read is one stage without a shuffle.

Nothing that arrives is lost.  What is no message is among the rejects; a field
that the schema does not name, or whose value does not fit its type (it is null
then), is kept as it came in the column ``extra``.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlog import schemas
from roadlog.functions.calendar import with_calendar
from roadlog.workspace import new_folder

# Fixed value: everything the `tokens` framing treats as a separator.
SEPARATORS = r"(?U)[\s\x1c-\x1f]+"
# Fixed value: hour-bucket folder name, e.g. 2021-08-06--07.
HOUR_BUCKET = r"(\d{4}-\d{2}-\d{2}--\d{2})"

# Fixed value: blanks at either end of a line, by the same rule.
ENDS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"

_CORRUPT = "_corrupt"
# members of the value that are not in its own columns, as one VARIANT object
EXTRA = "extra"


class Messages(NamedTuple):
    """Decoded rows, and everything that was left out with the reason."""

    rows: DataFrame
    rejects: DataFrame


def text_lines(
    spark: SparkSession, paths: str | Sequence[str], recursive: bool = True
) -> DataFrame:
    """``(file, value)``: every line below the paths."""
    return (
        spark.read.option("recursiveFileLookup", str(recursive).lower())
        .text(paths if isinstance(paths, str) else list(paths))
        .select(F.col("_metadata.file_path").alias("file"), "value")
    )


def frame_messages(lines: DataFrame, framing: str = "lines") -> DataFrame:
    """Cut ``(file, value)`` text into ``(file, token)``.

    ``lines`` keeps one token per line, without white space around it.  ``tokens`` cuts at any whitespace, so a
    message that contains a blank falls apart and ends up among the rejects.
    """
    if framing == "lines":
        tokens = lines.select("file", F.regexp_replace("value", ENDS, "").alias("token"))
    elif framing == "tokens":
        tokens = lines.select("file", F.explode(F.split("value", SEPARATORS)).alias("token"))
    else:
        raise ValueError(f"unknown framing: {framing}")
    return tokens.filter(F.col("token") != "")


def decode_messages(tokens: DataFrame, value_schema: T.StructType) -> DataFrame:
    """Add ``message`` (timestamp and value), ``extra`` and ``reason`` (null when usable).

    The timestamp is a number of milliseconds, a fraction is cut off.
    """
    # as text, since a number may be written in any way
    schema = T.StructType(
        [
            T.StructField("timestamp", T.StringType()),
            T.StructField("value", value_schema),
            T.StructField(_CORRUPT, T.StringType()),
        ]
    )
    options = {"columnNameOfCorruptRecord": _CORRUPT}
    # a generator over one message: filters on the parsed fields stay above it,
    # so each token is parsed once
    parsed = tokens.select("*", F.explode_outer(F.array(F.from_json("token", schema, options))).alias("_parsed"))
    milliseconds = F.expr("try_cast(try_cast(_parsed.timestamp AS DECIMAL(38, 6)) AS BIGINT)")
    return parsed.select(
        *tokens.columns,
        F.struct(milliseconds.alias("timestamp"), F.col("_parsed.value").alias("value")).alias("message"),
        _extra(value_schema).alias(EXTRA),
        _reason(milliseconds).alias("reason"),
    )


def _extra(value_schema: T.StructType) -> Column:
    """The members of ``value`` that have no column, or that their column cannot hold."""
    replaced = {"timestamp", *schemas.CALENDAR}
    held = [f for f in value_schema.fieldNames() if f not in replaced]
    names = F.array(*map(F.lit, held)) if held else F.array().cast("array<string>")
    empty = F.array(*[F.col(f"_parsed.value.`{f}`").isNull() for f in held]) if held else F.array().cast("array<boolean>")
    members = F.expr("try_variant_get(try_parse_json(token), '$.value', 'map<string, variant>')")

    def left_out(name: Column, value: Column) -> Column:
        place = F.array_position(names, name)
        unheld = F.when(place == 0, ~name.isin(*replaced)).otherwise(
            F.get(empty, place.cast("int") - 1) & ~F.is_variant_null(value)
        )
        return unheld

    kept = F.map_filter(members, left_out)
    return F.when(F.size(F.map_keys(kept)) > 0, F.to_variant_object(kept))


def _reason(milliseconds: Column) -> Column:
    is_object = F.startswith(F.col("token"), F.lit("{"))
    valid_json = F.try_parse_json("token").isNotNull()
    # a value that does not fit its type leaves the text valid, a cut does not
    broken = F.col(f"_parsed.{_CORRUPT}").isNotNull() & ~valid_json
    incomplete = F.col("_parsed.value").isNull() | milliseconds.isNull()
    return (
        F.when(F.col("token") == "null", "null")
        .when(~is_object, F.when(valid_json, "not an envelope").otherwise("malformed"))
        .when(broken, "malformed")
        .when(incomplete, "missing value or timestamp")
    )


def usable_rows(decoded: DataFrame, tz: str = "UTC", keep: Sequence[str] = (), extra: bool = True) -> DataFrame:
    """Unwrap the envelope: value fields, then timestamp and calendar columns, then ``extra``.

    ``timestamp`` and the calendar columns replace fields of the same name
    inside ``value``.
    """
    value = decoded.schema["message"].dataType["value"].dataType
    taken = {"timestamp", *schemas.CALENDAR}
    fields = [F.col(f"message.value.`{f}`").alias(f) for f in value.fieldNames() if f not in taken]
    unwrapped = decoded.filter(F.col("reason").isNull()).select(
        *keep, *fields, F.col("message.timestamp").alias("timestamp"), *([EXTRA] if extra else [])
    )
    dated = with_calendar(unwrapped, "timestamp", tz)
    return dated.select(*[c for c in dated.columns if c != EXTRA], *([EXTRA] if extra else []))


def rejected(decoded: DataFrame) -> DataFrame:
    """``(file, token, reason)`` of everything that is not a usable message."""
    return decoded.filter(F.col("reason").isNotNull()).select("file", "token", "reason")


def staged(decoded: DataFrame) -> DataFrame:
    """Decoded messages written once, usable and rejected ones apart, so that each
    of the two is read by itself and no file is read twice."""
    spark = decoded.sparkSession
    path = new_folder(spark, "decoded")
    usable = F.col("reason").isNull()
    # the text of a usable message is not needed any more
    slim = decoded.withColumn("token", F.when(~usable, F.col("token"))).withColumn("_usable", usable)
    slim.write.partitionBy("_usable").parquet(path)
    schema = T.StructType([*decoded.schema.fields, T.StructField("_usable", T.BooleanType())])
    back = spark.read.schema(schema).parquet(path)
    reason = F.when(F.col("_usable"), F.lit(None).cast("string")).otherwise(F.col("reason"))
    return back.withColumn("reason", reason)


def split_messages(decoded: DataFrame, tz: str = "UTC", extra: bool = True) -> Messages:
    """Rows and rejects of decoded messages (:func:`staged` or not)."""
    good, bad = (decoded, decoded) if "_usable" not in decoded.columns else (
        decoded.filter("_usable"),
        decoded.filter("NOT _usable"),
    )
    return Messages(usable_rows(good, tz, extra=extra), rejected(bad))


def read_messages(
    spark: SparkSession,
    paths: str | Sequence[str],
    value_schema: T.StructType = schemas.EU_VALUE,
    framing: str = "lines",
    recursive: bool = True,
    tz: str = "UTC",
    extra: bool = True,
    once: bool = False,
) -> Messages:
    """Read message files below the paths.

    ``once`` decodes the files in one pass into the shared folder, for a caller
    that needs both rows and rejects.  Without ``extra`` the rows have no such
    column, which saves a second parse.
    """
    decoded = decode_messages(frame_messages(text_lines(spark, paths, recursive), framing), value_schema)
    return split_messages(staged(decoded) if once else decoded, tz, extra)


def read_hour_buckets(
    spark: SparkSession,
    paths: str | Sequence[str],
    value_schema: T.StructType = schemas.EU_VALUE,
    framing: str = "lines",
    tz: str = "UTC",
    extra: bool = True,
) -> DataFrame:
    """Like :func:`read_messages` (rows only), with the hour bucket of the source file."""
    decoded = decode_messages(frame_messages(text_lines(spark, paths), framing), value_schema)
    bucketed = decoded.withColumn("bucket", F.regexp_extract("file", HOUR_BUCKET, 1))
    return usable_rows(bucketed, tz, keep=("bucket",), extra=extra)


def require_envelopes(messages: Messages) -> DataFrame:
    """Rows of a read that must not meet a decodable token that is no envelope.

    Undecodable tokens and ``null`` are skipped, as in :func:`read_messages`;
    any other reject makes the job fail.  Give it messages that were read ``once``.
    """
    fatal = messages.rejects.filter(~F.col("reason").isin("malformed", "null"))
    checks = fatal.select(
        *[
            (F.parse_json(F.lit(None).cast("string")) if isinstance(f.dataType, T.VariantType) else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in messages.rows.schema.fields
        ],
        F.raise_error(F.concat_ws(": ", "reason", "token")).cast("boolean").alias("_bad"),
    )
    tagged = messages.rows.withColumn("_bad", F.lit(False)).unionByName(checks)
    return tagged.filter(~F.col("_bad")).drop("_bad")
