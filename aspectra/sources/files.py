"""File sources: typed CSV, positional series CSV, binary payload files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import CORRUPT

# Round-trip-safe CSV dialect: RFC 4180 quoting, whitespace and empties kept.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\\N",   # null as \N, so an empty string ("") stays an empty string
}


class MissingColumns(ValueError):
    pass


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Fail before any job runs when required columns are absent, listing them."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumns("missing columns: " + ", ".join(missing))
    return df


def text_column(df: DataFrame, preferred: str = "text") -> Column:
    """The ``text`` column if present, else the first column."""
    return F.col(preferred) if preferred in df.columns else F.col(df.columns[0])


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: str | None = None, mode: str = "PERMISSIVE") -> DataFrame:
    """CSV with a header; a declared schema avoids an inference pass over the data."""
    reader = spark.read.options(**CSV_OPTIONS).option("mode", mode)
    if schema:
        reader = reader.schema(schema).option("enforceSchema", "true")
    else:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


# --- fixed values: how a line keeps a text's line ends ---
LINE_ESCAPES = [("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")]
# --- end of fixed values ---
LINES = {**CSV_OPTIONS, "multiLine": "false", "header": "false"}


def one_line(text: Column | str) -> Column:
    """Text without line ends: backslash, LF and CR become two characters each."""
    out = F.col(text) if isinstance(text, str) else text
    for plain, escaped in LINE_ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(escaped))
    return out


def many_lines(text: Column | str) -> Column:
    """Back from ``one_line``; a backslash before any other character stays."""
    col = F.col(text) if isinstance(text, str) else text
    # the escaped backslashes cut the text; what stands between them holds plain escapes only
    parts = F.split(col, r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))), "\\")


def csv_lines(df: DataFrame) -> Column:
    """Every row as one CSV line: text columns by ``one_line``, so a file may be cut at any line end."""
    cols = [one_line(f.name).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f.name) for f in df.schema.fields]
    return F.to_csv(F.struct(*cols), {k: v for k, v in LINES.items() if k not in ("header", "multiLine")})


def read_csv_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, dead letters) of files that ``csv_lines`` wrote; the files are read in as many tasks as their size asks
    for. A line with a value that does not fit its type, or with too few or too many values, goes to the dead
    letters whole, with its reason and size; no field of it is nulled silently."""
    raw = (spark.read.options(**LINES).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
           .option("columnPruning", "false").schema(f"{schema}, {CORRUPT} STRING").csv(path))
    texts = [f.name for f in raw.schema.fields if f.dataType.simpleString() == "string" and f.name != CORRUPT]
    # a one-element Generate keeps filters and pruning above the parse, which then sees whole lines once
    whole = raw.select(F.inline(F.array(F.struct(*raw.columns))))
    rows = whole.where(F.col(CORRUPT).isNull()).drop(CORRUPT).withColumns({c: many_lines(c) for c in texts})
    dead = whole.where(F.col(CORRUPT).isNotNull()).select(
        F.lit("malformed_row").alias("reason"), F.octet_length(CORRUPT).cast("bigint").alias("payload_bytes"), F.col(CORRUPT).alias("payload"))
    return rows, dead


SERIES_CSV_SCHEMA = "timestamp STRING, value DOUBLE"


def read_series_csv(spark: SparkSession, path: str) -> DataFrame:
    """Series CSV read by position: header skipped, column 1 text, column 2 a number;
    a malformed line fails the job (FAILFAST) instead of being dropped."""
    return (spark.read.schema(SERIES_CSV_SCHEMA)
            .option("header", "true").option("enforceSchema", "true").option("mode", "FAILFAST")
            .csv(path))


def read_binary_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Binary payload files -> (path, modificationTime, length, content)."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)
