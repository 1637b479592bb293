"""Parquet, delimited text and Avro files."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tablesync.functions.decimals import decimal_to_plain_string
from tablesync.operators.columns import quoted
from tablesync.operators.merge import to_append
from tablesync.sinks.swap import write_and_swap
from tablesync.sources.scan import parquet_scan
from tablesync.storage import exists, has_data, read_whole, write_new

# The Parquet codecs that can be asked for.
PARQUET_CODECS = ("none", "snappy", "gzip", "lz4", "zstd")
LAYOUTS = ("text", "avro", "parquet")


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    if before == value:  # nothing to change, and nothing for a parallel write to trip over
        yield
        return
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def write_parquet(
    df: DataFrame,
    path: str,
    codec: str = "snappy",
    mode: str = "error",
    fixed_layout: bool = False,
    partition_by: Sequence[str] = (),
    **options,
) -> None:
    """Parquet with logical decimals. ``options`` are further ones of Spark's writer.

    By default Spark stores decimals of up to 9 digits as 4-byte and up to 18 as
    8-byte integers. ``fixed_layout`` stores every decimal as fixed-length bytes,
    as many as its precision needs. The values are the same either way.
    """
    if codec not in PARQUET_CODECS:
        raise ValueError(f"unknown Parquet codec {codec!r}: use one of {list(PARQUET_CODECS)}")
    writer = df.write.mode(mode).option("compression", codec).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _setting(df.sparkSession, "spark.sql.parquet.writeLegacyFormat", str(fixed_layout).lower()):
        writer.parquet(path)


# How a backslash and line breaks are written inside a text field. What follows a backslash is
# never another one, so the pairs can be taken back one kind after the other, the backslash last.
ESCAPES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))
#: Beside text files: the schema they were written with. Hidden from Spark's readers by its first character.
SCHEMA_FILE = "_schema.json"


def _escaped(value: Column) -> Column:
    for char, pair in ESCAPES:
        value = F.replace(value, F.lit(char), F.lit(pair))
    return value


def _unescaped(value: Column) -> Column:
    for char, pair in reversed(ESCAPES):
        value = F.replace(value, F.lit(pair), F.lit(char))
    return value


def write_text(
    df: DataFrame,
    path: str,
    sep: str = ",",
    codec: str | None = None,
    mode: str = "error",
    null_text: str = "\\N",
    escaped: bool = True,
) -> None:
    """Delimited text; decimals as plain digits.

    A row is one line: line breaks and backslashes inside a text are written as pairs of characters, which
    ``read_text`` takes back, so that a large file is read in many tasks. Fields holding a separator
    or quote are quoted. A text of a backslash and N is told from null by its escaped
    backslash; a text equal to another ``null_text`` is an error, as it would be read as null. Compressed files
    are read in one task each, unless their codec can be split (``bzip2``).

    ``escaped=False`` writes texts as they are, for readers that know no escapes: line breaks are then quoted,
    and files with them cannot be split. The schema is left beside the files for later appends.
    """
    texts = [f.name for f in df.schema.fields if f.dataType == StringType()]
    columns = {c: _escaped(quoted(c)) if escaped else quoted(c) for c in texts}
    if not (escaped and null_text == "\\N"):
        clash = F.raise_error(F.lit(f"a value equals the text for null, {null_text}")).cast("string")
        columns = {c: F.when(value == null_text, clash).otherwise(value) for c, value in columns.items()}
    writer = decimal_to_plain_string(df.withColumns(columns)).write.mode(mode)
    if codec is not None:
        writer = writer.option("compression", codec)
    writer.options(**_text_options(sep, null_text)).csv(path)
    spark, beside = df.sparkSession, f"{path.rstrip('/')}/{SCHEMA_FILE}"
    if not exists(spark, beside):
        write_new(spark, beside, json.dumps({"schema": df.schema.jsonValue(), "sep": sep, "null_text": null_text, "escaped": escaped}))


def text_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema that ``write_text`` left beside its files, if there is one."""
    beside = f"{path.rstrip('/')}/{SCHEMA_FILE}"
    return StructType.fromJson(json.loads(read_whole(spark, beside))["schema"]) if exists(spark, beside) else None


def _text_options(sep: str, null_text: str) -> dict[str, str]:
    # a quote inside a quoted field is doubled; empty text is written as two quotes
    return {
        "sep": sep,
        "nullValue": null_text,
        "escape": '"',
        # told, not guessed from the first line break, which may stand inside a value
        "lineSep": "\n",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
        # with the zone's offset, so that a reader in another zone sees the same moment
        "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]XXX",
    }


def read_text(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    sep: str = ",",
    null_text: str = "\\N",
    multiline: bool | None = None,
    escaped: bool = True,
) -> DataFrame:
    """Delimited text under a given schema; a row that does not fit it is an error.

    Files as ``write_text`` makes them by default are split among tasks. For files without its escapes
    (``escaped=False``) a record may span lines; ``multiline=False`` splits them too if none does.
    """
    if multiline is None:
        multiline = not escaped
    reader = spark.read.schema(schema).options(**_text_options(sep, null_text))
    rows = reader.option("mode", "FAILFAST").option("multiLine", str(multiline).lower()).csv(path)
    if not escaped:
        return rows
    return rows.withColumns({f.name: _unescaped(quoted(f.name)) for f in rows.schema.fields if f.dataType == StringType()})


AVRO_MISSING = "Avro files need the spark-avro package (org.apache.spark:spark-avro) on the session's classpath"


@contextmanager
def _needs_avro() -> Iterator[None]:
    try:
        yield
    except AnalysisException as error:
        if "avro" in str(error).lower() and "data source" in str(error).lower():
            raise RuntimeError(AVRO_MISSING) from error
        raise


def write_avro(df: DataFrame, path: str, codec: str | None = None, mode: str = "error") -> None:
    """Avro files, by Spark's external Avro source."""
    writer = df.write.mode(mode).format("avro")
    if codec is not None:
        writer = writer.option("compression", codec)
    with _needs_avro():
        writer.save(path)


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    with _needs_avro():
        return spark.read.format("avro").load(path)


def write_files(df: DataFrame, path: str, layout: str, codec: str | None = None, **options) -> None:
    """One of the layouts by name."""
    if layout == "parquet":
        write_parquet(df, path, codec or "snappy", **options)
    elif layout == "text":
        write_text(df, path, codec=codec, **options)
    elif layout == "avro":
        write_avro(df, path, codec=codec, **options)
    else:
        raise ValueError(f"unknown layout {layout!r}: use one of {list(LAYOUTS)}")


def read_files(
    spark: SparkSession, path: str, layout: str, schema: StructType | str | None = None, **options
) -> DataFrame:
    if layout == "parquet":
        return parquet_scan(spark, path, schema, **options)
    if layout == "text":
        if schema is None:
            raise ValueError("text files need a schema")
        return read_text(spark, path, schema, **options)
    if layout == "avro":
        return read_avro(spark, path)
    raise ValueError(f"unknown layout {layout!r}: use one of {list(LAYOUTS)}")


def append_files(df: DataFrame, path: str, layout: str, codec: str | None = None, **options) -> None:
    """Add files beside those at ``path``; rows that do not fit what is there are an error, not misread later.

    Parquet files say what they hold: rows take their columns' order and types, exactly. Text files do not, so the
    first write leaves a schema beside them (see ``write_text``) and later ones must have the same columns in the
    same order. Avro files must have equal schemas.
    """
    spark = df.sparkSession
    if has_data(spark, path):
        if layout == "parquet":
            df = to_append(df, spark.read.parquet(path).schema)
        else:
            stored = text_schema(spark, path) if layout == "text" else read_avro(spark, path).schema
            if stored is not None:
                mine, theirs = ([(f.name, f.dataType.simpleString()) for f in s.fields] for s in (df.schema, stored))
                if mine != theirs:
                    raise ValueError(f"cannot append columns {mine} to files with {theirs}")
    write_files(df, path, layout, codec, mode="append", **options)


def write_overwrite(
    df: DataFrame, path: str, layout: str = "parquet", codec: str | None = None, **options
) -> None:
    """Replace what is at ``path``.

    The result is written beside it and swapped in, so the old data stays until
    the new is complete, and ``df`` may read from ``path`` itself.
    """
    write_and_swap(df, path, lambda frame, to: write_files(frame, to, layout, codec, **options))
