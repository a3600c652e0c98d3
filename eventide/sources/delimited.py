"""Headerless delimited record sources (SRC-1..SRC-5, PRJ-1, SC-1..SC-4).

Files are positional, comma-separated, no header.  The reader trims fields,
casts them with a fixed schema (no inference) and fails on a malformed line
or an empty number, as the reference does (a number that no query reads is not
looked at); ``mode="PERMISSIVE"`` turns bad fields into NULLs instead.  The epoch column becomes the event-time column ``ts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.time import from_epoch_millis, from_epoch_seconds
from eventide.schemas import RAW_LAYOUTS

_CSV_OPTIONS = {
    "header": "false",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "quote": "",                     # a quote is an ordinary character
    "enforceSchema": "true",
}


def _options(sep: str, mode: str) -> dict:
    return {**_CSV_OPTIONS, "sep": sep, "mode": mode}


def ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def to_typed(raw: DataFrame, kind: str, mode: str = "PERMISSIVE") -> DataFrame:
    """Raw positional columns -> typed record with ``ts`` (PRJ-1).  Under
    FAILFAST an empty number is an error, as a bad one is to the parser."""
    schema, epoch_col, unit = RAW_LAYOUTS[kind]
    conv = from_epoch_seconds if unit == "s" else from_epoch_millis

    def number(name: str) -> Column:
        if mode.upper() != "FAILFAST":
            return F.col(name)
        return F.when(F.col(name).isNotNull(), F.col(name)).otherwise(
            F.raise_error(F.lit(f"empty number in a {kind} line: {name}")))

    cols: list[Column] = []
    for f in schema.fields:
        if f.name == epoch_col:
            cols.append(conv(number(epoch_col)).alias("ts"))
        elif f.dataType.typeName() != "string":
            cols.append(number(f.name).alias(f.name))
        elif kind == "order" and f.name == "tx_id":
            # An empty field is an empty string in the reference, not NULL.
            cols.append(F.coalesce(F.col("tx_id"), F.lit("")).alias("tx_id"))
        else:
            cols.append(F.col(f.name))
    return raw.select(*cols)


def read_delimited(spark: SparkSession, path, kind: str, sep: str = ",",
                   mode: str = "FAILFAST") -> DataFrame:
    """Batch scan of one layout of ``eventide.schemas.RAW_LAYOUTS``."""
    schema = RAW_LAYOUTS[kind][0]
    raw = spark.read.schema(schema).options(**_options(sep, mode)).csv(path)
    return to_typed(raw, kind, mode)


def read_delimited_stream(spark: SparkSession, path: str, kind: str, sep: str = ",",
                          mode: str = "FAILFAST", max_files_per_trigger: int | None = None
                          ) -> DataFrame:
    """Streaming scan of a folder of delimited files (new files = new rows)."""
    schema = RAW_LAYOUTS[kind][0]
    reader = spark.readStream.schema(schema).options(**_options(sep, mode))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return to_typed(reader.csv(path), kind, mode)


def parse_lines(lines: DataFrame, kind: str, value_col: str = "value", sep: str = ",",
                mode: str = "FAILFAST") -> DataFrame:
    """Parse a column of delimited text (socket lines, Kafka values)."""
    schema = RAW_LAYOUTS[kind][0]
    parsed = lines.select(
        F.from_csv(F.col(value_col), ddl(schema), _options(sep, mode)).alias("r"))
    return to_typed(parsed.select("r.*"), kind, mode)


def format_lines(df: DataFrame, columns: list, sep: str = ",", value_col: str = "value"
                 ) -> DataFrame:
    """Records -> one delimited text line each (the inverse of ``parse_lines``)."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("")) if isinstance(c, str) else c
            for c in columns]
    return df.select(F.concat_ws(sep, *cols).alias(value_col))
