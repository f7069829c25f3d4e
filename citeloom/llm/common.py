"""Column and storage helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Separators of the two word definitions (Java regular expressions).
BLANKS = "[\\x20\\x09-\\x0D]+"
NON_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def whole(text: Column) -> Column:
    """The text, or an empty one where it is null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. Pure ASCII text, told by its byte length, takes the fast path."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def blank_words(text: Column) -> Column:
    """Runs of characters that are not ASCII blanks."""
    return F.array_remove(F.split(text, BLANKS), "")


def alnum_words(lowered: Column) -> Column:
    """Runs of a-z, 0-9 and non-ASCII characters of an ``ascii_lower`` text."""
    return F.array_remove(F.split(lowered, NON_WORD), "")


def starts(words: Column, length: int) -> Column:
    """0 .. size - length, empty if there are fewer words."""
    n = F.size(words)
    return F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(F.array().cast("array<int>"))


def row_key(id_col: str, text_col: str) -> Column:
    """64-bit key of a row's id and text; repeated rows share it."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside send Python workers batches of at most ``rows`` rows: whole texts in batches of
    Spark's default of 10,000 take much memory, on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """Cuts the lineage: writes a table in the shared folder and reads it back.

    The files survive lost executors, and later reads take only the columns
    they need. Lies below ``spark.checkpoint.dir``.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, f"llm-{purpose}")
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
