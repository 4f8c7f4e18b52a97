"""Reading sources: strict JSON-lines files (batch or stream) and table columns mapped to readings.

A reading is ``deviceId STRING, temperatureC DOUBLE, timestampMillis BIGINT`` (epoch millis of
event time). Sources add ``ts``, the event time as a TIMESTAMP, for windows and watermarks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.format import epoch_millis
from ..operators.attach import attach_stats

READING_SCHEMA = T.StructType([
    T.StructField("deviceId", T.StringType(), False),
    T.StructField("temperatureC", T.DoubleType(), False),
    T.StructField("timestampMillis", T.LongType(), False),
])
READING_COLUMNS = [f.name for f in READING_SCHEMA.fields]

# Java's String.trim() drops every character up to U+0020 at both ends.
_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"


def parse_lines(lines: DataFrame, line_col: str = "value", strict: bool = True) -> DataFrame:
    """JSON-lines rows -> readings. Blank lines and lines starting with ``#`` (after trimming)
    are skipped; unknown JSON fields are ignored.

    Numbers may be written as JSON text (``"20.5"``), and ``timestampMillis`` as a number with a
    fraction (``60000.0``), which is cut off. Only lines that the typed parser cannot read are parsed
    a second time, as VARIANT, for that.

    Strict (default): a data line that is not a JSON object with a ``deviceId``, a finite number
    ``temperatureC`` and a number ``timestampMillis`` fails the job with the line text (and line
    number and file, when known) in the message. Not strict: such lines are dropped.

    The parser only sees data lines (``from_json`` of ``when(is_data, line)``), so comments never
    reach it whatever order Catalyst evaluates the filters in.
    """
    rows, ok = _checked(lines, line_col)
    if strict:
        place = F.lit("")
        if "__line_no" in rows.columns:
            place = F.concat(F.lit(" on line "), F.col("__line_no").cast("string"))
        if "__file" in rows.columns:
            place = F.concat(place, F.lit(" in "), F.col("__file"))
        message = F.concat(F.lit("Malformed reading"), place, F.lit(": "), F.col("__line"))
        rows = rows.filter(F.when(ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    else:
        rows = rows.filter(ok)
    return with_event_time(rows.select(*READING_COLUMNS))


def _checked(lines: DataFrame, line_col: str) -> tuple[DataFrame, Column]:
    """The data lines with their fields, and whether a line is a reading. Fields that are not there or
    are of another kind are null."""
    text = F.regexp_replace(F.col(line_col), _TRIM, "")
    place = [c for c in ("__file", "__line_no") if c in lines.columns]
    base = lines.select(text.alias("__line"), *place)
    is_data = (F.length("__line") > 0) & ~F.col("__line").startswith("#")
    parsed = F.from_json(F.when(is_data, F.col("__line")), READING_SCHEMA,
                         {"mode": "PERMISSIVE", "allowNonNumericNumbers": "false"})
    # Parse once: behind a Generate, Catalyst cannot inline from_json into every field reference
    # and into the pushed-down check (it would otherwise parse each line six times).
    rows = base.filter(is_data).select("__line", *place, F.inline(F.array(F.struct(parsed.alias("__r")))))
    typed = {c: F.col(f"__r.{c}") for c in READING_COLUMNS}
    device, value, millis = (typed[c] for c in READING_COLUMNS)
    unread = F.when(value.isNull() | millis.isNull(), F.try_parse_json("__line"))
    rows = rows.select("__line", *place, "__r", F.inline(F.array(F.struct(unread.alias("__v")))))

    def said(name: str, kind: str, pattern: str) -> Column:
        """The field as a number that is written as one, or as text that the pattern accepts."""
        as_text = F.trim(F.try_variant_get("__v", f"$.{name}", "string"))
        return F.when(as_text.rlike(pattern), F.try_variant_get("__v", f"$.{name}", kind))

    number = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
    is_text = F.schema_of_variant(F.try_variant_get("__v", "$.timestampMillis", "variant")) == "STRING"
    whole = F.when(is_text, said("timestampMillis", "bigint", "^[+-]?[0-9]+$")).otherwise(
        said("timestampMillis", "bigint", number))
    fields = {"deviceId": device, "temperatureC": F.coalesce(value, said("temperatureC", "double", number)),
              "timestampMillis": F.coalesce(millis, whole)}
    rows = rows.select("__line", *place, *[c.alias(n) for n, c in fields.items()])
    ok = (F.col("deviceId").isNotNull() & F.col("temperatureC").isNotNull() & F.col("timestampMillis").isNotNull()
          & ~F.isnan("temperatureC") & (F.abs("temperatureC") < F.lit(float("inf"))))
    return rows, F.coalesce(ok, F.lit(False))


def with_event_time(readings: DataFrame, millis_col: str = "timestampMillis") -> DataFrame:
    """Add ``ts`` (TIMESTAMP) from epoch milliseconds."""
    return readings.withColumn("ts", F.timestamp_millis(F.col(millis_col)))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files: ``value``, ``__file`` and ``__line_no`` (from 1 in each file).

    Large files are read in splits by many tasks. One pass counts the lines of each split; a prefix
    sum over a file's splits gives the number of lines before each, and a line's place in its split
    is its row id less the split's first. Nothing is sorted but the splits (one row each).
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__from"), F.monotonically_increasing_id().alias("__id"))
    splits = lines.groupBy("__file", "__from").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("__file").orderBy("__from").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("__file", "__from", "__first", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    placed = attach_stats(lines, splits, ["__file", "__from"])
    number = F.col("__id") - F.col("__first") + F.col("__before") + 1
    return placed.select("value", "__file", number.alias("__line_no"))


def malformed_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_no, line`` of every data line that is not a reading."""
    rows, ok = _checked(numbered_lines(spark, path), "value")
    return rows.filter(~ok).select(F.col("__file").alias("file"), F.col("__line_no").alias("line_no"),
                                   F.col("__line").alias("line"))


def read_jsonl(spark: SparkSession, path: str, strict: bool = True, numbered: bool = False) -> DataFrame:
    """Batch read of JSON-lines reading files (splittable text source, any Hadoop path/glob).

    ``numbered``: the message of a malformed line names its line number, for one more pass over the
    text (at the call). Without it, :func:`malformed_lines` tells the numbers afterwards.
    """
    if numbered:
        return parse_lines(numbered_lines(spark, path), strict=strict)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("__file"))
    return parse_lines(lines, strict=strict)


def read_jsonl_stream(spark: SparkSession, path: str, strict: bool = True,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of JSON-lines reading files arriving in ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    lines = reader.load(path).select("value", F.col("_metadata.file_path").alias("__file"))
    return parse_lines(lines, strict=strict)


def to_readings(df: DataFrame, device: str | Column, value: str, time: str) -> DataFrame:
    """Map any table to the reading columns: device id as text, value as double, event time
    (TIMESTAMP, TIMESTAMP_NTZ or epoch millis) as epoch millis; plus ``ts``."""
    dtype = df.schema[time].dataType
    dev = F.col(device) if isinstance(device, str) else device
    out = df.select(dev.cast("string").alias("deviceId"),
                    F.col(value).cast("double").alias("temperatureC"),
                    epoch_millis(time, dtype).alias("timestampMillis"))
    return with_event_time(out)


def write_jsonl(readings: DataFrame, path: str, header: str | None = None,
                mode: str = "error") -> None:
    """Write readings as JSON-lines text (one object per line), optionally with a ``#`` header
    line at the top of every file. A Spark job; each task writes its own file."""
    body = F.to_json(F.struct(*[F.col(c) for c in READING_COLUMNS]))
    lines = readings.select(body.alias("value"))
    if header is not None:
        first = F.monotonically_increasing_id()
        lines = readings.select(body.alias("value"), first.alias("__id"))
        lines = lines.select(F.when(F.col("__id") == F.spark_partition_id().cast("long") * F.lit(1 << 33),
                                    F.concat(F.lit("# " + header + "\n"), F.col("value")))
                             .otherwise(F.col("value")).alias("value"))
    lines.write.mode(mode).text(path)
