"""Lines to typed rows. Works on any DataFrame with a ``value`` text column,
so files, sockets and message topics share one parser, in batch and in streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.times import access_log_time

BLANKS = "".join(map(chr, range(0x21)))  # control characters and the space

STRICT = "strict"
QUARANTINE = "quarantine"
BAD_LINE = "bad_line"


def read_lines(
    spark: SparkSession, path: str, stream: bool = False, files_per_trigger: int | None = None
) -> DataFrame:
    """Text files as a ``value`` column, as a table or as a stream of files."""
    if not stream:
        return spark.read.text(path)
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def parse_delimited(
    lines: DataFrame, schema: T.StructType, sep: str = ",", mode: str = STRICT
) -> DataFrame:
    """Split, trim and cast by position. Further fields of a line are ignored.

    ``strict`` fails on a line with a missing field or a number that is none.
    ``quarantine`` keeps such a line in ``bad_line`` with null fields; see
    ``good_rows`` and ``bad_lines``.
    """
    part = F.split("value", rf"\Q{sep}\E")
    fields = {
        f.name: F.trim(F.get(part, F.lit(i)), F.lit(BLANKS)) for i, f in enumerate(schema)
    }
    typed = {f.name: _typed(fields[f.name], f.dataType) for f in schema}
    return _checked(lines, typed, mode)


def parse_access_log(lines: DataFrame, mode: str = STRICT) -> DataFrame:
    """Web server lines: blank-separated, of which address, user, time, method and url are used."""
    part = F.split("value", " ")
    field = lambda i: F.trim(F.get(part, F.lit(i)), F.lit(BLANKS))
    typed = {
        "ip": field(0),
        "user_id": field(1),
        "ts": access_log_time(field(3)),
        "method": field(5),
        "url": field(6),
    }
    return _checked(lines, typed, mode)


def with_event_time(df: DataFrame, unit: str = "seconds", name: str = "timestamp") -> DataFrame:
    """Replace the epoch column by the event time ``ts``."""
    to_time = {"seconds": F.timestamp_seconds, "milliseconds": F.timestamp_millis}[unit]
    return df.withColumn("ts", to_time(F.col(name))).drop(name)


def good_rows(parsed: DataFrame) -> DataFrame:
    """Rows of a quarantine parse that are complete."""
    return parsed.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE)


def bad_lines(parsed: DataFrame) -> DataFrame:
    """Lines of a quarantine parse that could not be read."""
    return parsed.where(F.col(BAD_LINE).isNotNull()).select(F.col(BAD_LINE).alias("value"))


def _typed(text: Column, to: T.DataType) -> Column:
    if isinstance(to, T.StringType):
        return text
    # A number is digits with a sign; a cast alone would also take "1.0" without ANSI mode.
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast(to))


def _checked(lines: DataFrame, typed: dict[str, Column], mode: str) -> DataFrame:
    row = F.struct(*[column.alias(name) for name, column in typed.items()])
    parsed = lines.select("value", row.alias("row"))
    bad = F.lit(False)
    for name in typed:
        bad = bad | F.col("row")[name].isNull()
    if mode == QUARANTINE:
        kept = [F.when(~bad, F.col("row")[name]).alias(name) for name in typed]
        return parsed.select(*kept, F.when(bad, F.col("value")).alias(BAD_LINE))
    if mode != STRICT:
        raise ValueError(f"mode is {STRICT} or {QUARANTINE}")
    failure = F.raise_error(F.concat(F.lit("malformed line: "), F.col("value")))
    whole = F.when(bad, failure).otherwise(F.col("row"))
    return parsed.select(whole.alias("row")).select("row.*")
