"""Readers for every source the pipeline takes input from.

All readers return DataFrames with explicit schemas; connectors are selected
by format name and options only, so a missing connector jar fails at read
time with Spark's own message.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom.functions.jsonish import flatten
from citeloom.operators.validate import required_non_null_reason, required_reason_from_keys
from citeloom.schemas import PUBLICATION_RAW, REQUIRED_KEYS, REQUIRED_REASON_COL


def _object_id(c):
    """A Mongo ObjectId exported as {"$oid": "..."} becomes its hex text."""
    return F.coalesce(F.get_json_object(c, "$['$oid']"), c)


def publications_from_json_lines(lines: DataFrame, value_col: str = "value",
                                 required: str = "present", keep_raw: bool = False) -> DataFrame:
    """Raw JSON documents (one per row) -> typed publication records.

    ``required="present"`` tests key presence on the raw text (a key with a
    null value counts as present); ``"non_null"`` tests values instead. The
    outcome travels as a column so the check happens after deduplication, in
    the original order of steps. With ``keep_raw`` a column ``raw`` has the text
    of rows that are no JSON object, and NULL for the others.
    """
    raw = F.col(value_col)
    parsed = lines.select(F.from_json(raw, PUBLICATION_RAW).alias("__doc"),
                          F.json_object_keys(raw).alias("__keys"), raw.alias("__text"))
    reason = required_reason_from_keys(F.col("__keys"), REQUIRED_KEYS)
    out = parsed.select(
        *[(_object_id(F.col("__doc._id")) if f == "_id" else F.col(f"__doc.`{f}`")).alias(f)
          for f in PUBLICATION_RAW.fieldNames()],
        reason.alias(REQUIRED_REASON_COL),
        *([F.when(F.col("__keys").isNull(), F.col("__text")).alias("raw")] if keep_raw else []))
    if required == "non_null":
        out = out.withColumn(REQUIRED_REASON_COL,
                             F.coalesce(F.when(F.col(REQUIRED_REASON_COL) == "not_an_object",
                                               F.col(REQUIRED_REASON_COL)),
                                        required_non_null_reason(REQUIRED_KEYS)))
    return out


def read_publications_text(spark: SparkSession, path: str,
                           options: Mapping[str, str] | None = None,
                           partitions: int | None = None) -> DataFrame:
    """Landing JSON Lines as raw text, one document per row in ``value``.

    Files are read in the splits their format gives. ``partitions`` deals the
    lines out before they are decoded: for files that cannot be split, such
    as one large gzip file, which one task would decode otherwise.
    """
    lines = spark.read.options(**dict(options or {})).text(path)
    return lines.repartition(partitions) if partitions else lines


def _as_text(df: DataFrame, field: str) -> Column:
    """A typed column as the text that the JSON landing would hold: nested values as JSON."""
    kind = df.schema[field].dataType
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(F.col(f"`{field}`"), {"ignoreNullFields": "false"})
    return F.col(f"`{field}`").cast("string")


def read_publications(spark: SparkSession, path: str, fmt: str = "json",
                      options: Mapping[str, str] | None = None,
                      required: str = "present", partitions: int | None = None, keep_raw: bool = False) -> DataFrame:
    """Landing data -> typed publication records.

    * ``json``: JSON Lines files (one document per line), read as text and
      decoded with the fixed schema, so no inference pass over the data.
    * ``mongodb`` (or any document connector): rows are re-encoded to JSON
      and follow the same path; ``options`` carry the connection settings.
    * ``parquet``: already typed records; lists, rows and maps are decoded
      by the same rules as their JSON text.

    ``partitions`` deals the rows out before they are decoded (see
    ``read_publications_text``); ``keep_raw`` keeps the text of lines that are no
    objects (see ``publications_from_json_lines``; NULL for typed rows).
    """
    options = dict(options or {})
    if fmt == "json":
        return publications_from_json_lines(read_publications_text(spark, path, options, partitions),
                                            required=required, keep_raw=keep_raw)
    if fmt == "parquet":
        df = spark.read.options(**options).parquet(path)
        missing = [f for f in PUBLICATION_RAW.fieldNames() if f not in df.columns]
        df = df.repartition(partitions) if partitions else df
        typed = df.select(*[(_as_text(df, f) if f not in missing else F.lit(None).cast("string")).alias(f)
                            for f in PUBLICATION_RAW.fieldNames()])
        if required == "non_null":
            reason = required_non_null_reason(REQUIRED_KEYS)
        else:  # a typed file has every key on every row, or on none
            reason = F.lit("missing_required_keys" if set(missing) & set(REQUIRED_KEYS) else None).cast("string")
        typed = typed.withColumn(REQUIRED_REASON_COL, reason)
        return typed.withColumn("raw", F.lit(None).cast("string")) if keep_raw else typed
    reader = spark.read.format(fmt).options(**options)
    docs = reader.load(path) if path else reader.load()
    docs = docs.repartition(partitions) if partitions else docs
    lines = docs.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]),
                                  {"ignoreNullFields": "false"}).alias("value"))
    return publications_from_json_lines(lines, required=required, keep_raw=keep_raw)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Relational table; give a numeric ``partition_column`` with bounds so the
    read is split into ``num_partitions`` range queries instead of one."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        if lower_bound is None or upper_bound is None:
            raise ValueError("partition_column needs lower_bound and upper_bound")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions or 1)))
    return reader.load()


USER_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
])

USERS_DOCUMENT = T.StructType([
    T.StructField("users", T.ArrayType(USER_SCHEMA)),
    T.StructField("settings", T.StructType([
        T.StructField("theme", T.StringType()),
        T.StructField("notifications", T.BooleanType()),
        T.StructField("language", T.StringType()),
    ])),
    T.StructField("metadata", T.StructType([
        T.StructField("version", T.StringType()),
        T.StructField("generated_at", T.StringType()),
    ])),
])


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | str | None = USERS_DOCUMENT,
                        multi_line: bool = True) -> DataFrame:
    """JSON files holding whole documents (``multi_line``: one document, or an
    array of documents, per file) or JSON Lines (``multi_line=False``)."""
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def explode_users(docs: DataFrame, doc_cols: list[str] | None = None) -> DataFrame:
    """One row per user of each document, with the document's settings
    (nested rows lifted one level into plain columns)."""
    keep = [F.col(c) for c in (doc_cols or [])]
    rows = docs.select(*keep, F.posexplode("users").alias("user_pos", "user"),
                       F.col("settings.theme").alias("theme"),
                       F.col("settings.language").alias("language"))
    flat = flatten(rows, "user", prefix="user_")
    return flat.select(*keep, "user_pos", F.col("user_id"), F.col("user_name"),
                       F.col("user_email").alias("email"), "theme", "language")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)
