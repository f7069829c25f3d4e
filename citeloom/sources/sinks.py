"""Sinks: staging files, the warehouse's catalog tables, JDBC targets.

The warehouse is a catalog database. Its tables are partitioned by ``load``, a
number that counts the loads; a load writes its own partition, so adding a day
writes a day. The quartile table, whose rows change in place, is partitioned by
a bucket of the journal too: a load writes the buckets it touches, whole, and
readers take each bucket's newest partition.

One load is written at a time. A load first claims the number after the last
one, by adding a partition to ``load_claims``: the catalog refuses a second
claim of the same number, so of two loads that start from the same tables one
is refused, and every key that a load assigns follows the keys of all loads
before it. When its tables are written, the load's row in ``loads`` makes them
visible; readers never look past the last row. A load that died leaves its
claim: it can be run again (``retry=True``), which first empties what it had
written, or be given up (``release_claim``).

The catalog has to be one that all loads share (a metastore); with a session's
own catalog, ``create_tables`` attaches the files below ``location`` again.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.schemas import QUARANTINE, QUARANTINE_LANDING, QUARANTINE_ORPHANS, STAR_TABLES

LOAD = "load"
BUCKET = "bucket"
LOADS, CLAIMS = "loads", "load_claims"
#: Tables whose rows change, with the column that deals them into buckets.
MERGED = {"journal_quartile": "id_journal"}
BUCKETS = 64
#: Tables beside the star: what loads rejected.
REJECTED = {"quarantine": QUARANTINE, "quarantine_landing": QUARANTINE_LANDING, "quarantine_orphans": QUARANTINE_ORPHANS}


def write_staging(df: DataFrame, path: str) -> str:
    """Cleaned rows to a run-scoped Parquet path; a rerun replaces it."""
    df.write.mode("overwrite").parquet(path)
    return path


def bucket_of(key: Column) -> Column:
    """The bucket of a merged table's row."""
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _columns(name: str) -> str:
    if name in STAR_TABLES:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in STAR_TABLES[name])
    return {LOADS: "version string", CLAIMS: "version string", **REJECTED}[name]


def create_tables(spark: SparkSession, warehouse: str, location: str | None = None) -> str:
    """The warehouse's database and its empty tables, as far as they are not there yet.

    With ``location`` the tables lie below that folder, and partitions that are there already (a
    warehouse that another session with a catalog of its own has written) are attached.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{warehouse}`" + (f" LOCATION '{location}'" if location else ""))
    for name in (*STAR_TABLES, *REJECTED, LOADS, CLAIMS):
        table = f"`{warehouse}`.`{name}`"
        if spark.catalog.tableExists(table):
            continue
        parts = {LOAD: "bigint"} | ({BUCKET: "int"} if name in MERGED else {})
        create = (f"CREATE TABLE {table} ({_columns(name)}, {', '.join(f'{c} {k}' for c, k in parts.items())}) "
                  f"USING parquet PARTITIONED BY ({', '.join(parts)})")
        try:
            spark.sql(create)
        except PySparkException as there:
            if not location or "LOCATION_ALREADY_EXISTS" not in (there.getCondition() or ""):
                raise
            spark.sql(f"{create} LOCATION '{location}/{name}'")
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return warehouse


def published_loads(spark: SparkSession, warehouse: str) -> list[str]:
    """The visible loads' versions in order."""
    rows = spark.table(f"`{warehouse}`.{LOADS}").orderBy(LOAD).collect()  # one row a load
    return [r["version"] for r in rows]


def current_load(spark: SparkSession, warehouse: str) -> str | None:
    """The last visible load; None if nothing was published."""
    done = published_loads(spark, warehouse)
    return done[-1] if done else None


class Tables(dict):
    """A warehouse's visible tables, and the number of the last load that they hold."""

    def __init__(self, tables: Mapping[str, DataFrame], last: int):
        super().__init__(tables)
        self.last = last


def read_current(spark: SparkSession, warehouse: str) -> Tables:
    """The published tables, as far as the last visible load."""
    last = len(published_loads(spark, warehouse))
    out = {}
    for name in STAR_TABLES:
        rows = spark.table(f"`{warehouse}`.`{name}`").where(F.col(LOAD) <= last)
        if name in MERGED:
            # Partition columns only; the newest partition of each bucket, one row a bucket.
            newest = rows.groupBy(BUCKET).agg(F.max(LOAD).alias(LOAD))
            rows = rows.join(newest, [BUCKET, LOAD], "left_semi")
        out[name] = rows.select(*STAR_TABLES[name].fieldNames())
    return Tables(out, last)


def read_rejected(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """The rows that published loads rejected (a table of ``REJECTED``), with their load."""
    return spark.table(f"`{warehouse}`.`{name}`").where(F.col(LOAD) <= len(published_loads(spark, warehouse)))


def _empty_partition(spark: SparkSession, warehouse: str, name: str, load: int) -> None:
    """Removes what a load has written into a table."""
    schema = spark.table(f"`{warehouse}`.`{name}`").schema
    empty = spark.createDataFrame([], schema).drop(LOAD)
    part = f"{LOAD} = {load}" + (f", {BUCKET}" if name in MERGED else "")
    spark.sql(f"INSERT OVERWRITE `{warehouse}`.`{name}` PARTITION ({part}) SELECT * FROM {{rows}}", rows=empty)


def claim_load(spark: SparkSession, warehouse: str, version: str, base: int, retry: bool = False) -> int:
    """Claims the number after ``base``, the last load of the tables that a load was computed from.

    Refused when a load has been published since, and when another load holds the number. With
    ``retry`` a load takes its own claim up again, after it died; what it had written is emptied.
    """
    done = published_loads(spark, warehouse)
    if version in done:
        raise ValueError(f"load {version!r} is already published in {warehouse}")
    if len(done) != base:
        raise RuntimeError(f"load {version!r} was computed from load {base} of {warehouse}, but load {len(done)} is there")
    number = base + 1
    claims = f"`{warehouse}`.{CLAIMS}"
    try:
        spark.sql(f"ALTER TABLE {claims} ADD PARTITION ({LOAD} = {number})")
    except AnalysisException as held:
        if "PARTITIONS_ALREADY_EXIST" not in (held.getCondition() or ""):
            raise
        owners = [r["version"] for r in spark.table(claims).where(F.col(LOAD) == number).collect()]
        if not retry or owners != [version]:
            raise RuntimeError(f"load number {number} of {warehouse} is claimed by {owners or 'a load that died'}; "
                               "wait for it, run it again with retry=True, or give it up with release_claim") from held
        for name in (*STAR_TABLES, *REJECTED):
            _empty_partition(spark, warehouse, name, number)
        return number
    spark.sql(f"INSERT INTO {claims} PARTITION ({LOAD} = {number}) VALUES ('{version.replace(chr(39), chr(39) * 2)}')")
    return number


def release_claim(spark: SparkSession, warehouse: str) -> None:
    """Gives up the load that is claimed but not published: what it wrote is emptied, its number is free again."""
    number = len(published_loads(spark, warehouse)) + 1
    for name in (*STAR_TABLES, *REJECTED, CLAIMS):
        _empty_partition(spark, warehouse, name, number)
    spark.sql(f"ALTER TABLE `{warehouse}`.{CLAIMS} DROP IF EXISTS PARTITION ({LOAD} = {number})")


def publish_load(added: Mapping[str, DataFrame], spark: SparkSession, warehouse: str, version: str, base: int,
                 retry: bool = False, claimed: int | None = None, parallel: bool = True) -> int:
    """Writes the rows a load adds, then its row in ``loads``. Returns the load's number.

    ``added`` has the new rows of each table (of a merged table: the touched buckets, whole), made
    from the tables of load ``base`` (``read_current(...).last``). ``claimed`` is the number where
    the load has claimed it already. The writes are independent jobs and run concurrently when
    ``parallel``; each replaces the partitions it writes, so a task that ran twice adds nothing.
    """
    number = claimed if claimed is not None else claim_load(spark, warehouse, version, base, retry)

    def write(name: str) -> None:
        rows, part = added[name], f"{LOAD} = {number}"
        if name in MERGED:
            # A bucket lies in one file: the rows are dealt by bucket.
            rows = rows.withColumn(BUCKET, bucket_of(F.col(MERGED[name]))).repartition(BUCKET)
            part += f", {BUCKET}"
        columns = [c for c in spark.table(f"`{warehouse}`.`{name}`").columns if c != LOAD]
        spark.sql(f"INSERT OVERWRITE `{warehouse}`.`{name}` PARTITION ({part}) SELECT * FROM {{rows}}",
                  rows=rows.select(*columns))

    if parallel and len(added) > 1:
        with ThreadPoolExecutor(max_workers=min(8, len(added))) as pool:
            list(pool.map(write, added))
    else:
        for name in added:
            write(name)
    spark.sql(f"INSERT INTO `{warehouse}`.{LOADS} PARTITION ({LOAD} = {number}) "
              f"VALUES ('{version.replace(chr(39), chr(39) * 2)}')")
    return number


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: Mapping[str, str] | None = None, batch_size: int = 10000) -> None:
    """Set-based write to a relational target (batched inserts per partition)."""
    writer = (df.write.format("jdbc").option("url", url).option("dbtable", table)
              .option("batchsize", str(batch_size)).mode(mode))
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows) for a set of tables, as one DataFrame."""
    parts = [df.select(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows")) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
