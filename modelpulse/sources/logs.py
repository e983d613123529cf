"""Structured and plain-text service logs: record layout, sink and scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelpulse.functions import scalar as S
from modelpulse.operators.ordered import running

LOG_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("service", T.StringType()),
        T.StructField("environment", T.StringType()),
        T.StructField("request_id", T.StringType()),
        T.StructField(
            "source",
            T.StructType(
                [
                    T.StructField("file", T.StringType()),
                    T.StructField("line", T.IntegerType()),
                    T.StructField("function", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "exception",
            T.StructType(
                [
                    T.StructField("type", T.StringType()),
                    T.StructField("message", T.StringType()),
                    T.StructField("traceback", T.StringType()),
                ]
            ),
        ),
        T.StructField("operation", T.StringType()),
        T.StructField("duration_ms", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)
_CORRUPT = "_corrupt_record"

# The layout of a plain-text line, `time - name - level - [request_id] - message`.
TEXT_LINE = r"(?s)^(\S+ \S+) - (.*?) - ([A-Z]+) - \[([^\]]*)\] - (.*)$"


def log_record(
    ts: Column,
    name: Column,
    message: Column,
    level: Column,
    record_level: Column,
    request_id: Column,
    source: tuple[Column, Column, Column],
    exception: tuple[Column, Column, Column] | None = None,
    **fields: Column,
) -> Column:
    """One log record as a struct: constant service fields, nested source, optional exception."""
    file, line, function = source
    parts = [
        S.iso_micros(ts).alias("timestamp"),
        S.log_level(level, record_level).alias("level"),
        name.alias("name"),
        message.alias("message"),
        F.lit(S.SERVICE_NAME).alias("service"),
        F.lit(S.ENVIRONMENT).alias("environment"),
        S.request_id_or_default(request_id).alias("request_id"),
        F.struct(file.alias("file"), line.cast("int").alias("line"), function.alias("function")).alias("source"),
    ]
    if exception is not None:
        kind, text, trace = exception
        parts.append(
            F.when(
                kind.isNotNull(),
                F.struct(kind.alias("type"), text.alias("message"), trace.alias("traceback")),
            ).alias("exception")
        )
    parts += [column.alias(key) for key, column in fields.items()]
    return F.struct(*parts)


# Log levels from the least to the most severe.
LEVELS = ["DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"]


def at_level(logs: DataFrame, minimum: str) -> DataFrame:
    """Records of the given level or a more severe one."""
    return logs.where(F.col("level").isin(LEVELS[LEVELS.index(minimum.upper()) :]))


def json_lines(df: DataFrame, record: Column, extras: Column | None = None) -> DataFrame:
    """One JSON object per record; the entries of the map ``extras`` stand at its top level."""
    line = F.to_json(record)
    if extras is not None:
        more = F.to_json(extras)
        line = F.when(F.size(extras) > 0, F.concat(F.left(line, F.length(line) - 1), F.lit(","), F.right(more, F.length(more) - 1))).otherwise(line)
    return df.select(line.alias("value"))


def text_lines(
    df: DataFrame, ts: Column, name: Column, level: Column, request_id: Column, message: Column
) -> DataFrame:
    """Plain-text lines, milliseconds after a comma as the standard formatter writes them."""
    stamp = F.concat(
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss,"),
        F.date_format(ts, "SSS"),
    )
    return df.select(
        F.concat(
            stamp,
            F.lit(" - "),
            name,
            F.lit(" - "),
            level,
            F.lit(" - ["),
            S.request_id_or_default(request_id),
            F.lit("] - "),
            message,
        ).alias("value")
    )


def write_lines(lines: DataFrame, path: str, mode: str = "append") -> None:
    lines.write.mode(mode).text(path)


def parse_json_lines(lines: DataFrame) -> DataFrame:
    """Records from JSON lines with an explicit schema; a broken line is kept in ``_corrupt_record``.

    Keys beyond the schema are in the map ``extras`` with their values as text.
    """
    schema = T.StructType([*LOG_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    known = [f.name for f in LOG_SCHEMA.fields]
    return lines.select(
        F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}).alias("r"),
        F.map_filter(F.from_json("value", "map<string,string>"), lambda k, _: ~k.isin(known)).alias("extras"),
    ).select("r.*", "extras")


def read_json_logs(spark: SparkSession, path: str) -> DataFrame:
    return parse_json_lines(spark.read.text(path))


def parse_text_lines(lines: DataFrame) -> DataFrame:
    """The five fields of plain-text records; one in another form has nulls there and its text in ``raw``."""
    matches = F.col("value").rlike(TEXT_LINE)
    names = ["time", "name", "level", "request_id", "message"]
    fields = [F.when(matches, F.regexp_extract("value", TEXT_LINE, i)).alias(n) for i, n in enumerate(names, 1)]
    return lines.select(*fields, F.when(~matches, F.col("value")).alias("raw"))


def fold_lines(lines: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Records of ``value`` from physical lines: a line in another form belongs to the record before it.

    ``order`` is unique per ``keys`` (a file). Lines before the first record of a file stay as they are.
    """
    marked = lines.withColumn("_start", F.col("value").rlike(TEXT_LINE).cast("bigint"))
    numbered = running(marked, keys, order, {"_record": ("sum", "_start")})
    inside = numbered.where(F.col("_record") > 0).groupBy(*keys, "_record").agg(F.array_sort(F.collect_list(F.struct(*order, "value"))).alias("_l"))
    before = numbered.where(F.col("_record") == 0).select("value")
    return inside.select(F.array_join("_l.value", "\n").alias("value")).unionByName(before)


def read_text_logs(spark: SparkSession, path: str) -> DataFrame:
    """Records of all files under ``path``, those of several lines (tracebacks) included."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        # The pieces of a file lie in any order, the lines of a piece in their own.
        F.col("_metadata.file_block_start").alias("_piece"),
        F.monotonically_increasing_id().alias("_line"),
    )
    return parse_text_lines(fold_lines(lines, ["_file"], ["_piece", "_line"]))
